"""Helpers that the operators of this subpackage share: scratch tables, row-wise Arrow stages, word splitting."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Lower-cases A-Z and turns every byte that is not 0-9, a-z or >= 0x80 into a blank.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def fold_words(text: bytes) -> list[bytes]:
    """Words [0-9a-z and all beyond ASCII] of a UTF-8 text, A-Z lower-cased."""
    return text.translate(FOLD).split()


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. In local mode (tests) a temporary folder stands in where it is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="textloom-"))
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # noqa: BLE001 - the session may have ended; the folder is the cluster's scratch space
        pass


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed when the driver ends."""
    path = f"{shared_dir(spark)}/textloom/{name}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table written to the shared folder: later stages survive the loss of any executor, and lineage ends here."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def arrow_stage(df: DataFrame, inputs: dict[str, str], outputs: T.StructType, fn: Callable, keep: list[str] | None = None) -> DataFrame:
    """Adds columns that ``fn`` makes from each batch of rows.

    inputs: name for ``fn`` -> column of df. fn gets a dict of Arrow arrays and
    returns a list of Arrow arrays in the order of ``outputs``. keep: columns of
    df that go on unchanged (all by default). Output names replace kept columns
    of the same name; callers that must not replace any take names from spare().
    """
    new = {f.name for f in outputs}
    kept = [c for c in (df.columns if keep is None else keep) if c not in new]
    # An input that goes on unchanged travels once.
    more = [c for c in dict.fromkeys(inputs.values()) if c not in kept]
    src = df.select(*[F.col(f"`{c}`") for c in kept], *[F.col(f"`{c}`").alias(f"__in_{i}") for i, c in enumerate(more)])
    schema = T.StructType([src.schema[i] for i in range(len(kept))] + list(outputs.fields))
    places, n_kept = {k: [*kept, *more].index(c) for k, c in inputs.items()}, len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                b = batch.slice(at, 2048)
                made = fn({k: b.column(i) for k, i in places.items()})
                yield pa.RecordBatch.from_arrays([b.column(i) for i in range(n_kept)] + made, names=[f.name for f in schema])

    return src.mapInArrow(run, schema)


def small_table(spark: SparkSession, rows: list[tuple], schema: str | T.StructType) -> DataFrame:
    """A few rows of the driver as part of the plan. From a list, createDataFrame makes an RDD, for which every executor starts a second Python daemon with workers of its own that outlive the stage."""
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    table = pa.Table.from_pylist([dict(zip(kind.names, r, strict=True)) for r in rows], schema=to_arrow_schema(kind))
    return spark.createDataFrame(table, kind)


def spare(columns: list[str], *names: str) -> list[str]:
    """The names, each with as many underscores before it as it takes to differ from all columns (in any case)."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def hashed_share(rows: DataFrame, key: Column, limit: int) -> Column:
    """A condition on the hash of ``key`` that about ``limit`` of its distinct values meet, or a few more; true where there are no more.

    So a bounded sample never gathers more than its bound, however many tasks
    there are and however often a value repeats.
    """
    h = F.xxhash64(key)
    n = rows.agg(F.approx_count_distinct(h, 0.02)).first()[0]
    if n * 0.9 <= limit:
        return F.lit(True)
    return F.shiftrightunsigned(h, 1) < int((1 << 63) * min(1.0, 1.2 * limit / n))


def whole_groups(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[pa.Table, list[int]]]:
    """Tables of rows sorted by their first ``n_keys`` columns, cut between groups, and the rows at which their groups begin."""
    held: list[pa.RecordBatch] = []

    def done():
        table = pa.Table.from_batches(held).combine_chunks()
        return table, [0, *changes(table)] if table.num_rows else []

    def changes(table) -> list[int]:
        new = np.zeros(max(table.num_rows - 1, 0), dtype=bool)
        for i in range(n_keys):
            c = table.column(i).to_numpy(zero_copy_only=False) if isinstance(table, pa.RecordBatch) else table.column(i).to_numpy()
            new |= c[1:] != c[:-1]
        return (np.flatnonzero(new) + 1).tolist()

    for batch in batches:
        if not batch.num_rows:
            continue
        cuts = changes(batch)
        if held and any(held[-1].column(i)[-1] != batch.column(i)[0] for i in range(n_keys)):
            yield done()
            held = []
        if cuts:
            held.append(batch.slice(0, cuts[-1]))
            yield done()
            held = [batch.slice(cuts[-1])]
        else:
            held.append(batch)
    if held:
        yield done()


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def texts_by_few(column: pa.Array, few: int = 256) -> Iterator[list[bytes]]:
    """texts() of a long column, ``few`` rows at a time, so that a batch is not held twice."""
    for at in range(0, len(column), few):
        yield texts(column.slice(at, few))


def sample_ids(labels: DataFrame, column: str, remainder_ok, limit: int) -> DataFrame:
    """At most ``limit`` labelled documents (doc_id, label), chosen by hash; repeated labels count as their largest."""
    rows = labels.select("doc_id", F.col(column).cast("int").alias("label")).where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & remainder_ok)
    rows = rows.where(hashed_share(rows, F.col("doc_id"), limit)).groupBy("doc_id").agg(F.max("label").alias("label"))
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def labelled_texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, text, label) of the sampled documents, one row an id: of rows that repeat it the smallest text. Null texts count as empty."""
    known = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(ids), "doc_id")  # as many ids as the sample's bound
    return known.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label"))


def remainder(n: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n
