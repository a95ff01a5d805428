"""Structured Streaming over tables as file sources: sessions, counters and deduplication.

Each query runs over what is there (``availableNow``) into a Parquet table; state
and progress live in the shared folder, so a restarted run goes on where it stopped.
Watermarks bound the state.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators.recall import fit_cells, in_cells
from textloom.sources.scratch import scratch


def read_stream(spark: SparkSession, sf_dir: str, table: str, files: int = 16) -> DataFrame:
    """A table's folder, or its single file, as a stream of at most ``files`` files a batch."""
    schema = spark.read.parquet(f"{sf_dir}/{table}.parquet").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(f"{sf_dir}/{table}.parquet*")


def drain(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Runs a stream over all input and returns what it wrote. Complete mode keeps the last batch's table."""
    spark = stream.sparkSession
    at = scratch(spark, name)
    writer = stream.writeStream.option("checkpointLocation", f"{at}/state").trigger(availableNow=True)
    if mode == "append":
        query = writer.format("parquet").outputMode(mode).start(f"{at}/rows")
    else:
        # A repeated batch overwrites its own output.
        query = writer.outputMode(mode).foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(f"{at}/rows")).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{at}/rows")


def count_by(stream: DataFrame, *keys: str) -> DataFrame:
    return stream.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def first_seen(stream: DataFrame, key: str, ts: str, late: str = "1 day") -> DataFrame:
    """Rows whose key was not seen within the watermark."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


def sessions(stream: DataFrame, user: str, ts: str, gap: str = "15 minutes", late: str = "1 day") -> DataFrame:
    """Closed sessions of a user: a gap of ``gap`` ends one."""
    at = F.session_window(ts, gap)
    return stream.withWatermark(ts, late).groupBy(user, at.alias("at")).agg(F.count(F.lit(1)).alias("n")).select(user, F.col("at.start").alias("first_ts"), "n")


def for_each(stream: DataFrame, step: Callable, state: str):
    """Starts a sink of one's own: ``step(batch, batch_id)`` must bear repeats of a batch."""
    return stream.writeStream.foreachBatch(step).option("checkpointLocation", state).trigger(availableNow=True).start()


def x1_ingest(spark, sf_dir):
    return drain(read_stream(spark, sf_dir, "conversations").select("conv_id", "turn", F.md5("text").alias("text_md5")), "x1")


def x3_dedup(spark, sf_dir):
    stream = read_stream(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return drain(first_seen(stream, "event_id", "ts", "60 days").select("event_id"), "x3")


def x4_sessions(spark, sf_dir):
    """Sessions that the watermark (one second here) has closed; the last of the stream stay open."""
    stream = read_stream(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return drain(sessions(stream, "user_id", "ts", late="1 second"), "x4").select("user_id", F.unix_micros("first_ts").alias("first_us"), "n")


def x11_counters(spark, sf_dir):
    return drain(count_by(read_stream(spark, sf_dir, "events"), "event_type"), "x11", "complete")


# The events of a query, in order.
PHASES = ["init", "phase", "proposal", "winner", "result", "complete"]


def query_events(stream: DataFrame) -> DataFrame:
    """(conv_id, turn, seq, event): the event rows of each user turn, in append mode."""
    seen = stream.where("role = 'user'").select("conv_id", "turn", F.posexplode(F.array(*[F.lit(p) for p in PHASES])).alias("seq", "event"))
    return seen.withColumn("seq", F.col("seq").cast("long"))


def index_vectors(spark: SparkSession, sf_dir: str, cells: int = 16, files: int = 16) -> DataFrame:
    """(vec_id, cell): an inverted file kept up to date batch by batch, each vector in its nearest cell.

    Centres are fitted once, on a bounded sample. A batch holds at most ``files`` files and
    overwrites its own folder, so a repeated batch adds nothing twice. Zero and null vectors are not indexed.
    """
    good = F.exists("embedding", lambda x: x != 0)
    stored = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("id"), "embedding").where(good)
    centres = fit_cells(stored, cells)
    at = scratch(spark, "index")

    def step(batch: DataFrame, number: int) -> None:
        rows = in_cells(batch.select(F.col("vec_id").alias("id"), "embedding").where(good), centres, 1)
        rows.select(F.col("id").alias("vec_id"), "cell").write.mode("overwrite").parquet(f"{at}/rows/batch={number}")

    for_each(read_stream(spark, sf_dir, "embeddings", files), step, f"{at}/state").awaitTermination()
    return spark.read.schema("vec_id long, cell long, batch long").parquet(f"{at}/rows").drop("batch")


def x7_events(spark, sf_dir):
    return drain(query_events(read_stream(spark, sf_dir, "conversations").select("conv_id", "turn", "role")), "x7")


# State of one's own, a key at a time.


def _steps(df: DataFrame, key: str, order: list[str], step: Callable, start: tuple, out: str, state: str) -> DataFrame:
    """``step(state, row) -> (state, output tuples)`` over each key's rows in order within a batch; the state goes on to the next batch."""
    import pandas as pd
    from pyspark.sql.streaming.state import GroupStateTimeout

    names = [c.split()[0] for c in out.split(", ")]

    def run(k, frames, held):
        now = tuple(held.get) if held.exists else start
        rows = pd.concat(list(frames)).sort_values(order)
        made = []
        for row in rows.itertuples(index=False):
            now, some = step(now, row)
            made += some
        held.update(now)
        yield pd.DataFrame(made, columns=names)

    return df.groupBy(key).applyInPandasWithState(run, out, state, "append", GroupStateTimeout.NoTimeout)


def limited(stream: DataFrame, cap: float = 100.0) -> DataFrame:
    """(id, allowed) of requests (user, id, us) by a token bucket of ``cap`` that gains one token a second; the bucket is kept between batches."""

    def step(state, row):
        left, at = state
        if at >= 0:
            left = min(cap, left + (row.us - at) / 1e6)
        ok = left >= 1
        return (left - ok, row.us), [(row.id, bool(ok))]

    return _steps(stream, "user", ["us", "id"], step, (cap, -1), "id long, allowed boolean", "left double, at long")


def averaged(stream: DataFrame, alpha: float = 0.1) -> DataFrame:
    """(user, id, n, ema): the moving average after each reward (user, id, reward), from 0.5."""

    def step(state, row):
        n, ema = state[0] + 1, state[1] + alpha * (row.reward - state[1])
        return (n, ema), [(row.user, row.id, n, ema)]

    return _steps(stream, "user", ["id"], step, (0, 0.5), "user long, id long, n long, ema double", "n long, ema double")


def spoken(stream: DataFrame, mode: str = "sentence", least: int = 10, lines: int = 3) -> DataFrame:
    """(conv_id, turn, part): what of growing texts (conv_id, turn, text) can be said: up to the last sentence end, or line by line once ``lines`` lines are there.

    Parts of ``least`` characters or fewer wait for more; what has no end waits, too.
    A turn of role ``end`` closes a conversation: more than five characters that are left are said.
    """
    import re

    def step(state, row):
        rest, begun = state[0] + (row.text or ""), state[1]
        out = []
        ends = [m.end() for m in re.finditer(r"[.!?]+(?:\s|$)" if mode == "sentence" else r"\n+", rest)]
        if ends and (mode == "sentence" or begun or len(ends) >= lines):
            part = rest[: ends[-1]].strip()
            if len(part) > least:
                out.append((row.conv_id, row.turn, part))
            if len(part) > least or mode != "sentence":
                rest, begun = rest[ends[-1] :], True
        if row.role == "end":
            if len(rest.strip()) > 5:
                out.append((row.conv_id, row.turn, rest.strip()))
            rest = ""
        return (rest, begun), out

    return _steps(stream, "conv_id", ["turn"], step, ("", False), "conv_id long, turn long, part string", "rest string, begun boolean")


def run_timed(stream: DataFrame, step: Callable, state: str, every: str = "5 seconds"):
    """Micro-batches whenever ``every`` has passed, until all that is there is taken in; batches are bounded by the source's options."""
    query = stream.writeStream.foreachBatch(step).option("checkpointLocation", state).trigger(processingTime=every).start()
    query.processAllAvailable()
    query.stop()
    return query


def _in_files(spark: SparkSession, sf_dir: str, table: str, files: int, name: str) -> str:
    at = scratch(spark, name)
    spark.read.parquet(f"{sf_dir}/{table}.parquet").repartition(files).write.parquet(at)
    return at


def x2_indexer(spark, sf_dir):
    """Vectors from several files, indexed in timed micro-batches of two files."""
    good = F.exists("embedding", lambda x: x != 0)
    stored = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("id"), "embedding").where(good)
    centres = fit_cells(stored, 16)
    at = scratch(spark, "x2")
    source = _in_files(spark, sf_dir, "embeddings", 6, "x2-source")
    stream = spark.readStream.schema(spark.read.parquet(source).schema).option("maxFilesPerTrigger", 2).parquet(source)

    def step(batch: DataFrame, number: int) -> None:
        rows = in_cells(batch.select(F.col("vec_id").alias("id"), "embedding").where(good), centres, 1)
        rows.select(F.col("id").alias("vec_id"), "cell").write.mode("overwrite").parquet(f"{at}/rows/batch={number}")

    run_timed(stream, step, f"{at}/state", "1 second")
    found = spark.read.schema("vec_id long, cell long, batch long").parquet(f"{at}/rows")
    return found.select("vec_id", (F.col("cell") >= 0).alias("placed"))


def x5_limits(spark, sf_dir):
    """With three tokens, as events lie minutes apart."""
    stream = read_stream(spark, sf_dir, "events").select(F.col("user_id").alias("user"), F.col("event_id").alias("id"), (F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000)).cast("long").alias("us"))
    return drain(limited(stream, 3.0), "x5")


def x6_bounded(spark, sf_dir):
    """Turns from eight files, two a batch, whatever has piled up; the batch of each turn."""
    source = _in_files(spark, sf_dir, "conversations", 8, "x6-source")
    stream = spark.readStream.schema(spark.read.parquet(source).schema).option("maxFilesPerTrigger", 2).parquet(source)
    at = scratch(spark, "x6")
    for_each(stream, lambda batch, n: batch.select("conv_id", "turn").write.mode("overwrite").parquet(f"{at}/rows/batch={n}"), f"{at}/state").awaitTermination()
    found = spark.read.schema("conv_id long, turn long, batch long").parquet(f"{at}/rows")
    return found.select("conv_id", "turn", (F.col("batch") < 4).alias("in_four"))


def x8_spoken(spark, sf_dir):
    stream = read_stream(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return drain(spoken(stream), "x8").select("conv_id", "turn", F.md5("part").alias("part_md5"))


def x9_running(spark, sf_dir):
    stream = read_stream(spark, sf_dir, "events").select(F.col("user_id").alias("user"), F.col("event_id").alias("id"), (F.col("value") / 1000).alias("reward"))
    return drain(averaged(stream), "x9").select("id", "n", F.round("ema", 6).alias("ema"))


def x10_saved(spark, sf_dir):
    """Counters that are stopped after the first files and go on from their saved state when more have come."""
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    at, source = scratch(spark, "x10"), scratch(spark, "x10-source")
    for half in (0, 1):
        rows.where(F.col("event_id") % 2 == half).write.mode("append").parquet(source)
        stream = spark.readStream.schema(rows.schema).parquet(source)
        writer = count_by(stream, "event_type").writeStream.outputMode("complete").option("checkpointLocation", f"{at}/state").trigger(availableNow=True)
        writer.foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(f"{at}/rows")).start().awaitTermination()
    return spark.read.schema("event_type string, n long").parquet(f"{at}/rows")


PROGRAMS = {"X2_timed_indexer": x2_indexer, "X5_stream_limits": x5_limits, "X6_bounded_batches": x6_bounded, "X8_spoken_parts": x8_spoken, "X9_running_average": x9_running, "X10_saved_counters": x10_saved, "X7_query_events": x7_events, "V6_index_upkeep": index_vectors, "X1_ingest": x1_ingest, "X3_stream_dedup": x3_dedup, "X4_sessions": x4_sessions, "X11_theme_counters": x11_counters}

ORACLE_SQL = {
    "X1_ingest": "SELECT conv_id, turn, md5(text) AS text_md5 FROM conversations",
    "X3_stream_dedup": "SELECT DISTINCT event_id FROM events",
    "X4_sessions": """SELECT user_id, min(us) AS first_us, CAST(count(*) AS BIGINT) AS n FROM (
      SELECT user_id, us, sum(fresh) OVER (PARTITION BY user_id ORDER BY us, event_id) AS s FROM (
        SELECT user_id, event_id, us, CASE WHEN us - lag(us) OVER (PARTITION BY user_id ORDER BY us, event_id) < 900000000 THEN 0 ELSE 1 END AS fresh
        FROM (SELECT user_id, event_id, epoch_us(ts) AS us FROM events) a) b) c
      GROUP BY user_id, s HAVING max(us) + 900000000 <= (SELECT max(epoch_us(ts)) FROM events) - 1000000""",
    "X7_query_events": f"SELECT conv_id, turn, CAST(k AS BIGINT) AS seq, event FROM conversations CROSS JOIN (VALUES {', '.join(f'({i}, {chr(39)}{p}{chr(39)})' for i, p in enumerate(PHASES))}) v(k, event) WHERE role = 'user'",
    "X2_timed_indexer": "SELECT vec_id, true AS placed FROM embeddings",
    "X5_stream_limits": """WITH RECURSIVE o AS (SELECT user_id, event_id AS id, epoch_us(ts) // 1000 AS us, row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts) // 1000, event_id) AS i FROM events),
s AS (SELECT user_id, i, id, us, true AS allowed, 2e0 AS held FROM o WHERE i = 1 UNION ALL SELECT user_id, i, id, us, h >= 1, CASE WHEN h >= 1 THEN h - 1 ELSE h END FROM (SELECT o.user_id, o.i, o.id, o.us, least(3e0, s.held + (o.us - s.us) / 1e6) AS h FROM s JOIN o ON o.user_id = s.user_id AND o.i = s.i + 1) z)
SELECT id, allowed FROM s""",
    "X6_bounded_batches": "SELECT conv_id, turn, true AS in_four FROM conversations",
    "X9_running_average": """WITH RECURSIVE o AS (SELECT user_id, event_id AS id, value / 1000 AS r, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events),
s AS (SELECT user_id, id, i, 0.5e0 + 0.1e0 * (r - 0.5e0) AS ema FROM o WHERE i = 1 UNION ALL SELECT o.user_id, o.id, o.i, s.ema + 0.1e0 * (o.r - s.ema) FROM s JOIN o ON o.user_id = s.user_id AND o.i = s.i + 1) SELECT id, i AS n, round(ema, 6) AS ema FROM s""",
    "X10_saved_counters": "SELECT event_type, count(*) AS n FROM events GROUP BY event_type",
    "X11_theme_counters": "SELECT event_type, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY event_type",
}
