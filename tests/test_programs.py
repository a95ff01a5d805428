"""Operators beyond SQL against brute force and hand-written cases."""

import json
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.functions import cleaning
from textloom.operators import folds, programs, recall
from textloom.sources import chat, sinks

SF = "/root/testdata/sf0.001"


def one(spark, clean, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string").select("i", clean(F.col("t")).alias("c")).collect()
    return [r["c"] for r in sorted(rows, key=lambda r: r["i"])]


HARD = ["a\tb   c", "x --- y", "Intro # Head\ntext 1. one 2. two", "#\n##  **\nz", "wow \U0001F600\U0001F601\U0001F602 ok", "a\n\n\n\nb", "zero\u200bwidth\ufeff", "hyphen- ated na\u00efve- t\u00e9", 'say \\"hi\\\\\'', "don9t doin9 it9s 9em 19 9 x9y", 'end!?"', '"Word" and "A phrase."', '*"star"*', "caf\u00e9\u00a0\u3000bar", "", "   ", "l O5 5O rn vvord a|b", "cost $1 \\1"]


def by_hand(text, rules):
    for pattern, to in rules:
        pattern = re.sub(r"\\x\{([0-9A-F]+)\}", lambda m: f"\\U{int(m[1], 16):08x}", pattern)
        text = re.sub(pattern, to, text)
    return text.strip()


@pytest.mark.parametrize("clean,rules", [(cleaning.clean_structured, cleaning.STRUCTURED_RULES), (cleaning.clean_flat, cleaning.FLAT_RULES)])
def test_rules_as_in_python(spark, clean, rules):
    docs = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    texts = HARD + docs
    assert one(spark, clean, texts) == [by_hand(t, rules) for t in texts]


def test_cleaners_by_hand(spark):
    assert one(spark, cleaning.clean_structured, ["don9t", "doin9 it", "a---b", "x\n##\ny", None]) == ["don't", "doing it", "a\n\n---\n\nb", "x\n\ny", None]
    assert one(spark, cleaning.clean_scanned, ["h\nh\nh\nh\n\nk", "h\nh\nh\nk", "l am"]) == ["k", "h h h k", "I am"]
    assert one(spark, cleaning.clean_speech, ["Hi* there\n\nBob.Then", "***", None]) == ["Hi there. Bob. Then", "", None]
    assert one(spark, cleaning.clean_response, ["Assistant: yes<|im_end|>no", "<think>a\nb</think> ok\nUser: more", ""]) == ["yes", "ok", ""]
    assert one(spark, lambda c: cleaning.clean_response(c, show_reasoning=True), ["<think> why </think>so"]) == ["💭 **Reasoning:**\nwhy\n\n**Answer:**\nso"]
    by = lambda family, text: one(spark, lambda c: cleaning.clean_response(c, family), [text])[0]
    assert by("gemma", "yes<end_of_turn>\n<start_of_turn>user") == "yes" and by("llama", "a<|end_header_id|>b<|eot_id|>c") == "ab" and by("mistral", "ok [INST] more") == "ok"
    assert by("phi", "<|assistant|>Two.<|end|>No") == "Two." and by("phi", "It is two. In conclusion, numbers are fine.") == "It is two."
    assert by("phi", "B. Paris is it\n" + "x" * 600) == "B. Paris is it"


def test_encoding_repair(spark):
    plain = ["Café – “naïve” costs 5 €", "already fine: café", "ASCII", "", None, "Ã alone"]
    broken = lambda t: t.encode().decode("cp1252", "ignore")
    assert one(spark, cleaning.repair_encoding, plain) == plain
    fits = ["Café costs", "déjà vu – “so”", "5 €"]
    fits = [t for t in fits if all(b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D) for b in t.encode())]
    assert len(fits) >= 2 and one(spark, cleaning.repair_encoding, [broken(t) for t in fits]) == fits
    assert one(spark, cleaning.repair_encoding, [broken(broken("Café"))]) == ["Café"]


def vectors(n, dim, seed=3):
    v = np.random.default_rng(seed).standard_normal((n, dim))
    return [[float(np.float32(x)) for x in r] for r in v]


def test_merge_and_threads(spark):
    vs = vectors(60, 3)
    rows = [(i % 2, i, vs[i], 300) for i in range(60)]
    df = spark.createDataFrame(rows, "source int, id long, embedding array<float>, length long")
    unit = lambda v: np.array(v) / (np.linalg.norm(v) + 1e-8)
    groups, threads = set(), {}
    for s in (0, 1):
        mine = [r for r in rows if r[0] == s]
        open_, part = [], 0
        for r in mine:
            total = sum((unit(x[2]) for x in open_), np.zeros(3))
            if open_ and 300 * (len(open_) + 1) <= 900 and unit(total) @ unit(r[2]) >= 0.2:
                open_.append(r)
                continue
            if open_:
                groups.add((s, part, open_[0][1], len(open_), 300 * len(open_)))
                part += 1
            open_ = [r]
        groups.add((s, part, open_[0][1], len(open_), 300 * len(open_)))
        for i, r in enumerate(mine):
            if r[1] not in threads:
                threads[r[1]] = r[1]
                for x in mine[i + 1 : i + 5]:
                    if x[1] not in threads and unit(r[2]) @ unit(x[2]) >= 0.5:
                        threads[x[1]] = r[1]
    assert {tuple(r) for r in folds.merge_consecutive(df, 0.2, 900).collect()} == groups
    assert dict(map(tuple, folds.link_threads(df, 0.5).collect())) == threads


def test_packing_rate_average(spark):
    items = spark.createDataFrame([("a", 1, 5), ("a", 2, 5), ("a", 3, 1), ("a", 4, 99), ("a", 5, 0), ("b", 6, 10)], "source string, id long, length long")
    got = {r["id"]: r["pack"] for r in folds.pack_sequences(items, 10).collect()}
    assert got == {1: 0, 2: 0, 3: 1, 4: 2, 5: 3, 6: 0}
    calls = spark.createDataFrame([(1, i, t) for i, t in enumerate([0, 0, 0, 10**6, 10**6])], "user long, id long, us long")
    assert [r["allowed"] for r in folds.limit_rate(calls, 2).orderBy("id").collect()] == [True, True, False, True, False]
    rewards = spark.createDataFrame([(1, 1, 1.0), (1, 2, 0.0)], "user long, id long, reward double")
    assert folds.moving_average(rewards).first()["ema"] == pytest.approx((0.5 * 0.9 + 0.1) * 0.9)
    assert folds.pack_sequences(items.limit(0)).count() == 0


def test_semantic_duplicates(spark):
    vs = vectors(80, 64)
    rows = [(i, v) for i, v in enumerate(vs)]
    rows += [(100 + i, [x + 0.02 * y for x, y in zip(vs[i], vs[(i + 1) % 80], strict=True)]) for i in range(40)]
    rows += [(200 + i, vs[0]) for i in range(30)] + [(300, [0.0] * 64), (301, None)]
    m = {i: np.float32(v).astype(float) for i, v in rows if v is not None}
    cos = lambda a, b: a @ b / (np.linalg.norm(a) * np.linalg.norm(b) or 1)
    want = {i: not any(j < i and cos(m[i], m[j]) >= 0.95 for j in m) if i in m else True for i, _ in rows}
    got = programs.semantic_duplicates(spark.createDataFrame(rows, "id long, embedding array<float>"))
    assert {r["id"]: r["kept"] for r in got.collect()} == want
    assert sum(not k for k in want.values()) == 70


def test_nearest_recall(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    m = {r[0]: np.array(r[1]) for r in rows}
    want = {q: set(sorted((i for i in m if i != q), key=lambda i: (-float(m[q] @ m[i]), i))[:5]) for q in m if q % 50 == 0}
    got = {}
    for r in recall.v5_nearest(spark, SF).collect():
        got.setdefault(r["query"], set()).add(r["vec_id"])
    assert sum(len(got[q] & want[q]) for q in want) / (5 * len(want)) >= 0.9


def test_chat_shapes(spark, tmp_path):
    msg = {"role": "Human", "content": "hello"}
    shapes = {
        "list": [{"uuid": "u1", "chat_messages": [{"uuid": "m1", "sender": "human", "text": "a", "created_at": "2024"}, {"sender": "ai", "content": [{"text": "b"}, "c"]}]}],
        "map": [{"id": "u2", "mapping": {"n1": {"message": {"author": {"role": "assistant"}, "content": {"parts": ["p", "q"]}, "create_time": 1.5}}, "n2": {"message": None}}}],
        "custom": {"conversations": [{"id": "u3", "messages": [{"author": "user", "content": "x", "timestamp": 0}]}]},
        "dict": {"u4": [msg, {"role": "tool", "content": ""}]},
        "bare": msg,
        "single": {"id": "u5", "messages": [msg]},
    }
    for name, shape in shapes.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(shape, indent=1))
    (tmp_path / "broken.json").write_text("{")
    got = sorted((r["conversation_id"], r["author"], r["text"], r["timestamp"]) for r in chat.read_chats(spark, str(tmp_path)).collect())
    assert sorted(got, key=str) == sorted([("u1", "user", "a", "2024"), ("u1", "assistant", "b c", None), ("u2", "assistant", "p", "1.5"), ("u3", "user", "x", None), ("u4", "user", "hello", None), ("0", "user", "hello", None), ("u5", "user", "hello", None)], key=str)


def test_pages_and_sinks(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps([{"filename": "f", "total_text": "t"}, {"text": "u"}, {"pages": []}]))
    assert sorted(map(tuple, chat.read_pages(spark, str(tmp_path)).collect())) == [("document_1.pdf", "u"), ("f", "t")]
    html = one(spark, chat.html_text, ["<p>a &amp; b</p><script>x</script><!-- c -->d", None, ""])
    assert html == ["a & b d", None, ""]
    rows = spark.createDataFrame([("train", 1), ("test", 2)], "split string, x long")
    sinks.write_memory(rows, str(tmp_path / "m"), 1)
    sinks.write_memory(rows.limit(1), str(tmp_path / "m"), 2)
    assert spark.read.parquet(str(tmp_path / "m")).where("generation = 1").count() == 2
    sinks.append_log(rows, str(tmp_path / "log"))
    sinks.append_log(rows, str(tmp_path / "log"))
    assert spark.read.json(str(tmp_path / "log")).count() == 4
