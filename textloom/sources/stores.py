"""Stores of texts, vectors, reputations and logs: written, read back, validated, resumed.

Every store is a folder of Parquet or JSON lines. Readers state what they do
with records that lack fields. Writers replace their folder or add a
generation; a generation is whole once its ``_SUCCESS`` file is there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def remove(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


# Page documents.


def write_documents(docs: DataFrame, path: str) -> None:
    """Documents (filename, total_text, ...) as JSON lines: whole under ``detailed``, names and texts under ``simple``."""
    docs.write.mode("overwrite").json(f"{path}/detailed")
    docs.select("filename", F.col("total_text").alias("text")).write.mode("overwrite").json(f"{path}/simple")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(filename, text): the first of text, content, total_text and body that is a string; JSON lines of objects or lists of them. Names that lack are numbered in their line."""
    rows = spark.read.text(path).select(F.expr("try_parse_json(value)").alias("v")).where("v IS NOT NULL")
    single = rows.where("schema_of_variant(v) LIKE 'OBJECT%'").select(F.lit(0).alias("pos"), F.col("v").alias("value"))
    many = rows.where("schema_of_variant(v) LIKE 'ARRAY%'").lateralJoin(spark.tvf.variant_explode(F.col("v").outer())).select("pos", "value")
    text = F.expr("coalesce(" + ", ".join(f"CASE WHEN schema_of_variant(try_variant_get(value, '$.{k}', 'variant')) = 'STRING' THEN try_variant_get(value, '$.{k}', 'string') END" for k in ("text", "content", "total_text", "body")) + ")")
    name = F.expr("coalesce(try_variant_get(value, '$.filename', 'string'), concat('document_', pos, '.pdf'))")
    return single.unionByName(many).select(name.alias("filename"), text.alias("text")).where("text IS NOT NULL")


# Texts with their metadata.

RECORD = "source string, author string, conversation_id string, timestamp string, filename string"


def validated(store: DataFrame) -> DataFrame:
    """(item_id, text, metadata) of a store (item_id, text, metadata: JSON).

    Records without text or whose metadata is no object go, and conversations
    without an author. Sources, conversation ids, timestamps and file names that
    lack get their defaults.
    """
    m = F.from_json("metadata", RECORD)
    is_object = F.expr("schema_of_variant(try_parse_json(metadata)) LIKE 'OBJECT%'")
    rows = store.where((F.col("text") != "") & is_object).withColumn("m", m)
    source = F.coalesce("m.source", F.lit("unknown"))
    rows = rows.withColumn("s", source).where((F.col("s") != "conversation") | F.col("m.author").isNotNull())
    given = lambda kind, column, default: F.when(F.col("s") == kind, F.coalesce(column, F.lit(default))).otherwise(F.col(column))
    made = F.struct(
        F.col("s").alias("source"), F.col("m.author").alias("author"), given("conversation", "m.conversation_id", "unknown").alias("conversation_id"),
        given("conversation", "m.timestamp", "0").alias("timestamp"), given("pdf", "m.filename", "unknown_pdf").alias("filename"),
    )
    return rows.select("item_id", "text", made.alias("metadata"))


def normalised_metadata(metadata: Column) -> Column:
    """A struct with ids and times as strings and themes without blank ones, nested structs alike."""
    return metadata.withField("themes", F.filter(metadata["themes"], lambda t: F.trim(t) != "")).withField("conversation_id", metadata["conversation_id"].cast("string")).withField("message_id", metadata["message_id"].cast("string")).withField("timestamp", metadata["timestamp"].cast("string"))


def write_memory_store(rows: DataFrame, path: str, config: dict) -> None:
    """Vectors, texts and metadata of (id, embedding, text, metadata) in folders of their own, and the settings."""
    import json

    for name, columns in (("vectors", ["id", "embedding"]), ("texts", ["id", "text"]), ("metadata", ["id", "metadata"])):
        rows.select(*columns).write.mode("overwrite").parquet(f"{path}/{name}")
    rows.sparkSession.createDataFrame([(json.dumps(config, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/config")


def read_memory_store(spark: SparkSession, path: str, schema) -> tuple[DataFrame, dict]:
    """The rows joined by id again, and the settings; vectors of another size than the settings name are dropped."""
    import json

    config = json.loads(spark.read.text(f"{path}/config").first()[0])  # one line
    part = lambda name, *c: spark.read.parquet(f"{path}/{name}").select("id", *c)
    rows = part("vectors", "embedding").where(F.size("embedding") == config["dim"]).join(part("texts", "text"), "id").join(part("metadata", "metadata"), "id")
    return rows.select(*schema), config


# Work that goes on after an interruption.


def in_batches(rows: DataFrame, key: str, path: str, make: Callable[[DataFrame], DataFrame], batches: int, stop_after: int | None = None) -> DataFrame:
    """``make`` of the rows batch by batch (by hash of ``key``), each under its own folder. Batches that are whole are not made again; ``stop_after`` ends early."""
    spark = rows.sparkSession
    done = 0
    for k in range(batches):
        folder = f"{path}/batch={k}"
        if not _exists(spark, f"{folder}/_SUCCESS"):
            if stop_after is not None and done >= stop_after:
                break
            make(rows.where(F.pmod(F.xxhash64(key), F.lit(batches)) == k)).write.mode("overwrite").parquet(folder)
            done += 1
    return spark.read.parquet(*[f"{path}/batch={k}" for k in range(batches) if _exists(spark, f"{path}/batch={k}/_SUCCESS")])


def cached(spark: SparkSession, path: str, schema, make: Callable[[], DataFrame]) -> DataFrame:
    """The table at ``path``; where it is not whole, cannot be read or has other columns it is removed and made again."""
    if _exists(spark, path):
        try:
            found = spark.read.parquet(path)
            if _exists(spark, f"{path}/_SUCCESS") and [(f.name, f.dataType) for f in found.schema] == [(f.name, f.dataType) for f in schema]:
                found.agg(F.count(F.lit(1))).first()
                return found
        except Exception:  # noqa: BLE001 - a damaged cache is made again, whatever is wrong with it
            pass
        remove(spark, path)
    make().write.parquet(path)
    return spark.read.schema(schema).parquet(path)


# Generations.


def latest_generation(spark: SparkSession, path: str) -> int:
    """The highest whole generation below a folder, 0 without any. One folder name a generation reaches the driver."""
    if not _exists(spark, path):
        return 0
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    whole = [int(n.partition("=")[2]) for n in names if n.startswith("generation=") and _exists(spark, f"{path}/{n}/_SUCCESS")]
    return max(whole, default=0)


def save_generation(df: DataFrame, path: str) -> int:
    """Adds the next generation; earlier ones stay."""
    n = latest_generation(df.sparkSession, path) + 1
    df.write.mode("overwrite").parquet(f"{path}/generation={n}")
    return n


def load_generation(spark: SparkSession, path: str) -> DataFrame | None:
    """The latest generation with its number, or None."""
    n = latest_generation(spark, path)
    return spark.read.parquet(f"{path}/generation={n}").withColumn("generation", F.lit(n)) if n else None


# Logs, reputations, ingestion.


def audit(events: DataFrame, path: str) -> None:
    """Adds entries (timestamp, event_type, user, endpoint, status, details: map) to a log of JSON lines."""
    details = F.coalesce("details", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))
    events.select(F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"), "event_type", "user", "endpoint", "status", details.alias("details")).write.mode("append").json(path)


def reputations(rewards: DataFrame, alpha: float = 0.1, start: float = 0.5) -> DataFrame:
    """(name, n, reward_sum, reward_sq, last_seen, ema_reward, failures) of rewards (name, id, reward, seen) in order of id.

    The moving average is a weighted sum over each name's ranks, so that rewards
    are added up in every task.
    """
    from pyspark.sql import Window

    w = Window.partitionBy("name").orderBy(F.desc("id"))
    rows = rewards.withColumn("back", F.row_number().over(w) - 1)
    share = F.pow(F.lit(1 - alpha), F.col("back"))
    n = F.count(F.lit(1))
    return rows.groupBy("name").agg(
        n.alias("n"), F.sum("reward").alias("reward_sum"), F.sum(F.col("reward") * F.col("reward")).alias("reward_sq"), F.max("seen").alias("last_seen"),
        (F.sum(alpha * share * F.col("reward")) + F.pow(F.lit(1 - alpha), n) * start).alias("ema_reward"), F.sum(F.when(F.col("reward") < 0, 1).otherwise(0)).alias("failures"),
    )


def reputation_score(n: Column, total: Column, squares: Column) -> Column:
    """Mean plus confidence, within 0 and 1; a half for names without rewards."""
    mean = total / n
    spread = F.sqrt(F.greatest(squares / n - mean * mean, F.lit(0.0)))
    return F.when(n == 0, 0.5).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), mean + F.sqrt(2 * F.log(n + 1.0) / n) * spread)))


def ingest(items: DataFrame, known: DataFrame, key: str, order: str, most: int = 2000) -> tuple[DataFrame, DataFrame]:
    """Of the first ``most`` items those whose key is not known, one a key; and their number. The limit is the endpoint's own."""
    taken = items.orderBy(order).limit(most)
    new = taken.dropDuplicates([key]).join(known.select(key), key, "left_anti")
    return new, new.agg(F.count(F.lit(1)).alias("count"))


# Profiles of files.


def container(v: str = "v") -> Column:
    """What kind of export a parsed file is."""
    first = f"try_variant_get({v}, '$[0]', 'variant')"
    at = lambda base, key: f"try_variant_get({base}, '$.{key}', 'variant') IS NOT NULL"
    is_list, is_object = f"schema_of_variant({v}) LIKE 'ARRAY%'", f"schema_of_variant({v}) LIKE 'OBJECT%'"
    return F.expr(f"""CASE WHEN {v} IS NULL THEN 'malformed' WHEN {is_list} AND {at(first, 'chat_messages')} THEN 'list of chat_messages' WHEN {is_list} AND {at(first, 'mapping')} THEN 'list of mappings'
      WHEN {is_list} AND {at(first, 'messages')} THEN 'list of messages' WHEN {is_list} AND {at(first, 'text')} THEN 'list of texts' WHEN {is_list} THEN 'list' WHEN {is_object} AND {at(v, 'conversations')} THEN 'conversations'
      WHEN {is_object} AND {at(v, 'mapping')} THEN 'mapping' WHEN {is_object} AND {at(v, 'messages')} THEN 'messages' WHEN {is_object} THEN 'object' ELSE 'value' END""")


def profiled(files: DataFrame) -> DataFrame:
    """(file, format, kind, length, keys, expected) of files (file, j: JSON text): form, root type, number of root entries, keys of the root or of its first entry, and items to expect."""
    rows = files.select("file", "j", F.expr("try_parse_json(j)").alias("v")).withColumn("format", container())
    kind = F.expr("CASE WHEN v IS NULL THEN 'none' WHEN schema_of_variant(v) LIKE 'ARRAY%' THEN 'list' WHEN schema_of_variant(v) LIKE 'OBJECT%' THEN 'object' ELSE 'value' END")
    size = lambda path: f"coalesce(size(try_variant_get(v, '{path}', 'array<variant>')), 0)"
    entries = lambda path: f"coalesce(size(map_keys(try_variant_get(v, '{path}', 'map<string,variant>'))), 0)"
    rows = rows.withColumn("kind", kind).withColumn("length", F.expr(f"CASE kind WHEN 'list' THEN {size('$')} WHEN 'object' THEN {entries('$')} ELSE 0 END"))
    keys = F.expr("array_join(array_sort(CASE WHEN kind = 'list' THEN map_keys(try_variant_get(v, '$[0]', 'map<string,variant>')) ELSE map_keys(try_variant_get(v, '$', 'map<string,variant>')) END), ',')")
    inner = "try_variant_get({}, '$.chat_messages', 'array<variant>')"
    expected = F.expr(f"""CASE WHEN format = 'list of chat_messages' THEN aggregate(transform(try_variant_get(v, '$', 'array<variant>'), c -> coalesce(size({inner.format('c')}), 1)), 0, (a, x) -> a + x)
      WHEN kind = 'list' THEN length WHEN format = 'conversations' THEN {size('$.conversations')} WHEN format = 'mapping' THEN {entries('$.mapping')} WHEN format = 'messages' THEN {size('$.messages')}
      WHEN kind = 'object' THEN aggregate(transform(map_values(try_variant_get(v, '$', 'map<string,variant>')), x -> coalesce(size(try_variant_get(x, '$', 'array<variant>')), size(map_keys(try_variant_get(x, '$', 'map<string,variant>'))), 1)), 0, (a, x) -> a + x) ELSE 0 END""")
    return rows.select("file", "format", "kind", F.col("length").cast("long").alias("length"), F.coalesce(keys, F.lit("")).alias("keys"), F.coalesce(expected, F.lit(0)).cast("long").alias("expected"))
