"""Plug-in stages, embedders, tokenisers, the command line, PDF files and defaults on hand-written rows."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom import __main__ as cli
from textloom.functions.embedding import embed_column, similarity_column
from textloom.functions.tokens import tokenise_column
from textloom.operators import dialogue, folds, labels, recall, sequences
from textloom.operators.knowledge import WordLengths
from textloom.plans.stages import Stages
from textloom.sources import pdf, stores


def unit(*xs):
    v = np.zeros(64)
    v[: len(xs)] = xs
    return (v / np.linalg.norm(v)).tolist()


def test_stages(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, t string")
    stages = Stages().register("up", lambda c: c.withColumn("t", F.upper("t")), phase="map")
    assert stages.propose(df).count() == 0
    stages.register("say", lambda c: c.withColumn("action", F.when(F.col("t") == "A", "go")), ("x",)).register("say", lambda c: c.limit(0))
    stages.register("cut", lambda p, c: p.where("id < 5"), phase="filter")
    assert [(r.id, r.action, r.origin, r.tags) for r in stages.propose(df).collect()] == [(1, "GO", "say", ["x"])]
    assert stages.propose(df, F.col("t") != "A").count() == 0
    stages.unregister("say")
    assert stages.propose(df).count() == 0
    with pytest.raises(ValueError):
        stages.register("x", None, phase="later")


def test_embedders_and_tokenisers(spark):
    df = spark.createDataFrame([("a b", "c"), (None, "")], "x string, y string")
    assert [list(r[0]) for r in df.select(embed_column(F.col("x"), WordLengths())).collect()] == [[2.0] + [0.0] * 7, [0.0] * 8]
    assert [r[0] for r in df.select(similarity_column(F.col("x"), F.col("y"), WordLengths())).collect()] == pytest.approx([1.0, 0.0])
    assert [list(r[0]) for r in df.select(tokenise_column(F.col("x"), str.split, 1)).collect()] == [["a"], []]


def test_defaults(spark):
    """Thresholds that the tables at hand do not reach, on rows made for them."""
    near, far = unit(1, 0.5), unit(0, 0, 1)
    rows = spark.createDataFrame([(1, 0, unit(1), 900), (1, 1, near, 900), (1, 2, near, 900), (1, 3, far, 10), (2, 4, far, 10)], "source int, id long, embedding array<double>, length long")
    assert [(r.first_id, r.merged_from) for r in folds.merge_consecutive(rows).orderBy("source", "part").collect()] == [(0, 2), (2, 1), (3, 1), (4, 1)]
    got = {r.id: (r.thread_size, r.thread_position) for r in sequences.linked(rows).collect()}
    assert got == {0: (3, 1), 1: (3, 2), 2: (3, 3), 3: (1, 1), 4: (1, 1)}
    calls = spark.createDataFrame([(1, i, 0) for i in range(101)] + [(1, 200, 1_000_000)], "user long, id long, us long")
    assert [r.id for r in folds.limit_rate(calls).where("NOT allowed").collect()] == [100]
    found = spark.createDataFrame([(1, 5, 1, 0.4), (1, 6, 2, 0.39)], "query long, id long, rank long, score double")
    texts = spark.createDataFrame([(5, "x" * 300), (6, "y")], "id long, content string")
    assert [r.preview for r in recall.previews(found, texts).collect()] == ["[0.40] " + "x" * 200 + "..."]
    assert recall.evaluate(found, found.select("query", "id").limit(1)).first()["recall"] == 1.0


def test_packing_in_ranges(spark):
    """Packing range by range is packing one by one."""
    rng = np.random.default_rng(2)
    lengths = rng.integers(0, 30, 400).tolist() + [50, 20, 20, 1]
    rows = spark.createDataFrame(list(enumerate(lengths)), "id long, length long").repartition(13)
    pack, room, want = 0, None, {}
    for i, n in enumerate(min(n, 20) for n in lengths):
        if room is None or n > room:
            pack, room = (0, 20) if room is None else (pack + 1, 20)
        room -= n
        want[i] = pack
    assert {r.id: r["pack"] for r in sequences.pack_in_order(rows, 20).collect()} == want
    assert sequences.pack_in_order(rows.limit(0), 20).count() == 0


def test_exact_and_indexed(spark, monkeypatch):
    rng = np.random.default_rng(6)
    centres = rng.standard_normal((12, 64))
    m = (centres[rng.integers(0, 12, 600)] + 0.4 * rng.standard_normal((600, 64))).astype(np.float32)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)] + [(900, [0.0] * 64), (901, None)], "id long, embedding array<float>")
    unit_ = m.astype(float) / np.linalg.norm(m, axis=1, keepdims=True)
    best = {q: set(np.lexsort((np.arange(600), -np.round(unit_ @ unit_[q], 9) + 9.0 * (np.arange(600) == q)))[:5].tolist()) for q in range(0, 600, 20)}
    monkeypatch.setattr(recall, "BLOCK", 7)  # several blocks of queries
    got = {}
    for r in recall.exact_nearest(rows, rows.where("id % 20 = 0")).collect():
        got.setdefault(r["query"], set()).add(r["id"])
    assert got == best
    found = {}
    for r in recall.nearest(rows, rows.where("id % 20 = 0")).collect():
        found.setdefault(r["query"], set()).add(r["id"])
    assert np.mean([len(found[q] & best[q]) / 5 for q in best]) >= 0.9
    assert recall.nearest(rows.limit(0), rows.limit(0)).count() == 0


def test_pdf(spark, tmp_path):
    pages = [[("Contents", 14), ("1.1 Intro ..... 2", 10), ("12", 10), ("2 End ..... 3", 10), ("stop here", 10), ("3 No ..... 4", 10)], [("", 10)], [("2.1 Größe (all)", 12), ("text\\ here", 10)]]
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.pdf").write_bytes(pdf.make_pdf(pages))
    (tmp_path / "y.PDF").write_bytes(pdf.make_pdf(pages, damaged=True, packed=False))
    (tmp_path / "z.pdf").write_bytes(b"no pdf")
    plain = b"%PDF\n1 0 obj\n<< /Type /Catalog /Pages 2 0 R >>\nendobj\n2 0 obj\n<< /Kids [3 0 R] >>\nendobj\n3 0 obj\n<< /Contents 4 0 R >>\nendobj\n4 0 obj\n<< /Length 52 >>\nstream\nBT /F1 9 Tf (a\\(b\\)) Tj [(c) -20 (d)] TJ T* (e) Tj ET    \nendstream\nendobj\n"
    (tmp_path / "w.pdf").write_bytes(plain)
    rows = pdf.read_pages(pdf.scan_folder(spark, str(tmp_path)))
    got = {(r.filename, r.page): (r.text, r.method) for r in rows.collect()}
    assert got["x.pdf", 3] == ("2.1 Größe (all)\ntext\\ here", "pages") and ("x.pdf", 2) not in got
    assert got["y.PDF", 1][1] == "whole" and got["z.pdf", None] == (None, "failed") and got["w.pdf", 1][0] == "a(b)cd\ne"
    assert {r.filename: (r.n_pages, r.status) for r in pdf.assemble(rows).collect()} == {"x.pdf": (2, "ok"), "y.PDF": (1, "ok"), "z.pdf": (0, "failed"), "w.pdf": (1, "ok")}
    one = rows.where("filename = 'x.pdf'")
    assert [tuple(r) for r in pdf.contents(one).collect()] == [("x.pdf", "1.1", "Intro", 2), ("x.pdf", "2", "End", 3)]
    assert {(r.title, r.page) for r in pdf.sections(one).collect()} == {("Contents", 1), ("2.1 Größe (all)", 3)}


def test_stores(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id long, x string")
    at = str(tmp_path / "m")
    assert stores.load_generation(spark, at) is None and stores.save_generation(rows, at) == 1 and stores.save_generation(rows.limit(1), at) == 2
    assert [r.generation for r in stores.load_generation(spark, at).collect()] == [2]
    made = []
    make = lambda b: made.append(1) or b
    stores.in_batches(rows, "id", str(tmp_path / "b"), make, 4, stop_after=2)
    assert stores.in_batches(rows, "id", str(tmp_path / "b"), make, 4).count() == 2 and len(made) == 4
    bad = spark.createDataFrame([(1, "", "{}"), (2, "t", "[1]"), (3, "t", None), (4, "t", '{"source":"conversation"}'), (5, "t", "{}")], "item_id long, text string, metadata string")
    assert [(r.item_id, r.metadata.source) for r in stores.validated(bad).collect()] == [(5, "unknown")]


def test_command_line(spark, tmp_path):
    chat = [{"id": f"c{i}", "messages": [{"role": "user", "content": f"What is the {w} of the house number {i} in this street?"}, {"role": "assistant", "content": f"The {w} of the house number {i} in this street is quite remarkable, they say."}]} for i, w in enumerate(["size", "age", "color", "price"] * 5)]
    (tmp_path / "chat.json").write_text(json.dumps(chat))
    out = str(tmp_path / "out")
    assert cli.main(["curate", str(tmp_path / "chat.json"), out, "--no-gzip", "--pair-gate", "0.1"]) == 0
    found = spark.read.json(f"{out}/dataset")
    assert found.count() == 20 and {r.split for r in found.select("split").distinct().collect()} == {"train", "validation", "test"}
    assert spark.read.json(f"{out}/summary").first()["total_pairs"] == 20
    assert cli.main(["ingest", "chats", str(tmp_path / "chat.json"), f"{out}/store", "--batches", "2"]) == 0
    assert spark.read.parquet(f"{out}/store").count() == 40
    with pytest.raises(SystemExit):
        cli.main(["nothing"])


def test_predicates(spark):
    t = F.col("t")
    df = spark.createDataFrame([("Have we met?",), ("hi",), ("please summarize and find it",), ("Analyze this",), (None,), ("",)], "t string")
    got = df.select(dialogue.needs_retrieval(t), dialogue.generation_config(t), dialogue.generation_config(t, "phi"), F.array_join(dialogue.plan_of(t), ","), labels.content_type(t)).collect()
    assert [bool(r[0]) for r in got] == [True, False, True, False, False, False]
    assert [r[1] for r in got][:4] == [2, 2, 0, 1] and {r[2] for r in got} == {2}
    assert [r[3] for r in got][:3] == [None, None, "RETRIEVE,SUMMARIZE"]
    kinds = spark.createDataFrame([("The abstract of a house",), ("study",), ("1 2 3 x",), ("def f",), ("why",), ("plain",), ("  ",)], "t string").select(labels.content_type(t)).collect()
    assert [r[0] for r in kinds] == ["structured_document", "research_content", "data_content", "code_content", "question_content", "general_content", "general_content"]
