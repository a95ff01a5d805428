"""Memory and labels: retrieval previews, tags, proposals and trust, adaptive labels, prompts, tokens, profiles and stored memories.

Proposals, rewards and sessions are the events table; a memory is a row of
embeddings, its content the document of the same number.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.operators.text import c7_summary, doubles
from textloom.sources.scratch import scratch


def f18_context(q):
    return "SELECT conv_id, turn FROM conversations WHERE length(text) >= 50"


def j8_tags(q):
    """Words that a turn shares with the one before it, and the attention that adds to a score of a half."""
    words = q.distinct(q.words("lower(text)"))
    rows = f"SELECT conv_id, turn, w, lag(w) OVER (PARTITION BY conv_id ORDER BY turn) AS p FROM (SELECT conv_id, turn, {words} AS w FROM conversations) a"
    shared = q.size(q.intersect("w", "p"))
    return doubles(q, f"SELECT conv_id, turn, {shared} AS overlap, round(0.5D + 0.1D * {shared} / CAST(greatest({q.size('p')}, 1) AS DOUBLE), 6) AS score FROM ({rows}) b WHERE p IS NOT NULL")


def v3_insert(q):
    return doubles(q, f"SELECT e.vec_id, 0.5D AS r, 0D AS b FROM embeddings e WHERE {q.size('e.embedding')} = 64 AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = e.vec_id)")


def v11_rehearse(q):
    """Documents that are not of good quality keep only their summary."""
    return f"SELECT d.doc_id, md5(CASE WHEN l.quality = 1 THEN d.text ELSE s.summary END) AS content_md5 FROM documents d JOIN ({c7_summary(q)}) s ON d.doc_id = s.doc_id LEFT JOIN labels l ON d.doc_id = l.doc_id"


def k9_vectors(spark, sf_dir, dim: int = 64):
    """A vector memory written as compressed JSON and read back; vectors of another size than ``dim`` are dropped."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", F.array(F.col("label").cast("string")).alias("tags"))
    path = scratch(spark, "k9")
    rows.write.option("compression", "gzip").json(path)
    back = spark.read.schema(rows.schema).json(path).where(F.size("embedding") == dim)
    total = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double"))
    return back.select("vec_id", F.element_at("tags", 1).alias("tag"), F.round(total, 5).alias("total"))


QUERIES = {
    "F18_min_context": f18_context, "J8_tag_overlap": j8_tags, "V3_insert": v3_insert, "V11_rehearse": v11_rehearse, }
PROGRAMS = {"K9_vector_memory": k9_vectors, }
ORACLE_SQL = {
    "K9_vector_memory": "SELECT vec_id, CAST(label AS VARCHAR) AS tag, round(list_sum(CAST(embedding AS DOUBLE[])), 5) AS total FROM embeddings WHERE len(embedding) = 64",
    }
