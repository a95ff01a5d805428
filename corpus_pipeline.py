"""A training corpus from the documents table: five stages, each working on all that its predecessor kept.

Every stage returns the columns of documents but the last, which places the
documents in shards. Documents go for one reason a stage: a toxicity score of
0.5 or more; a near copy (Jaccard of five-word shingles 0.8 or more) with a
smaller id; a benchmark window in the text; the draw of the mixing weights.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm.common import load, written
from textloom.llm.decontamination import drop_contaminated
from textloom.llm.mixing import sample_mix
from textloom.llm.sharding import kd_shards
from textloom.llm.simhash import drop_near_duplicates
from textloom.llm.toxicity import learn, score_toxicity


#: Bytes of text that a shard should hold; shards are split until there are as many as the corpus needs for it.
SHARD_BYTES = 64 << 20


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score of 0.5 or more go. Learns from all labels; null ids and labels teach nothing. Null and empty texts score as clean; repeated rows are judged each. Without labels all stay."""
    model = learn(docs, load(spark, sf_dir, "labels"))
    found = score_toxicity(docs, model, score="__score", passages="__passages")
    return found.where("__score < 0.5").select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the smallest id, null ids last. Texts without words (null, empty) are one group; rows equal in every column are one."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share a window with a benchmark item go. Null texts share none; items without words are ignored, an empty benchmark drops nothing."""
    return drop_contaminated(docs, load(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are kept by the draw of their id's hash against their cell's probability. Null sources and languages are in the class of all others; rows that repeat an id stay or go together."""
    return sample_mix(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row; equal texts share a shard, ties are ordered by a hash of the text. An empty table has no rows."""
    return kd_shards(docs, target_bytes=SHARD_BYTES)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: The stages learn, hash and draw beyond SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again by the next."""
    docs = load(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, f"pipeline-{name}")
    return docs
