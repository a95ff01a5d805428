"""Order-dependent operators where Spark splits partitions."""

import numpy as np
import pandas as pd

from textloom.functions.embedding import word_hash
from textloom.operators import connectors, folds, sequences


def test_threads_of_a_large_source_stay_in_one_task(spark):
    """Where Spark splits the large partitions of a join, the rows of a source still follow each other."""
    rng = np.random.default_rng(3)
    rows = [(0 if i % 50 else 1 + i % 7, i, rng.standard_normal(4).astype(np.float32).tolist()) for i in range(6000)]
    want = {}
    for source in range(8):
        found = folds.Threads(0.3, 4)
        for r in pd.DataFrame([r for r in rows if r[0] == source], columns=["source", "id", "embedding"]).itertuples():
            want |= dict(found.step(r))
        want |= dict(found.end())
    small = {"autoBroadcastJoinThreshold": "-1", "shuffle.partitions": "16", "adaptive.advisoryPartitionSizeInBytes": "4096", "adaptive.coalescePartitions.minPartitionSize": "1024", "adaptive.skewJoin.skewedPartitionThresholdInBytes": "8192", "adaptive.skewJoin.skewedPartitionFactor": "1"}
    before = {k: spark.conf.get(f"spark.sql.{k}") for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(f"spark.sql.{k}", v)
        found = sequences.linked(spark.createDataFrame(rows, "source int, id long, embedding array<float>").repartition(8), near=0.3)
        got, plan = found.collect(), found._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(f"spark.sql.{k}", v)
    assert {r["id"]: int(r["thread_id"][7:]) for r in got} == want
    assert "SortMergeJoin" in plan and "REPARTITION_BY_COL" in plan  # a shuffle of its own after the join


def test_batches_of_texts_whose_counts_cancel(spark, tmp_path):
    """Two words of one place and opposite signs: the vector is still of unit length, as K7's SQL has it."""
    words = [f"w{i}" for i in range(2000)]
    up = next(w for w in words if word_hash(w) & 0x80000000)
    down = next(w for w in words if not word_hash(w) & 0x80000000 and word_hash(w) % 64 == word_hash(up) % 64)
    rows = [(0, f"{up} {down}"), (1, up), (2, "..."), (3, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert {r["doc_id"]: r["square"] for r in connectors.k7_batches(spark, str(tmp_path)).collect()} == {0: 1.0, 1: 1.0, 2: 0.0, 3: 0.0}
