"""The learning step against the same step over dense tables, and operators' defaults on hand-written rows."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.operators import labels, learning

SF = "/root/testdata/sf0.001"


def dense_rake(table, rows, columns, seed=0.1, tolerance=0.01, most=100):
    m = table + seed
    r, c = np.ones(len(rows)), np.ones(len(columns))
    for i in range(most):
        new = rows / (m @ c)
        if i and np.abs(r / new - 1).max() < tolerance:
            break
        r = new
        c = columns / (r @ m)
    return m * r[:, None] * c


def dense_learn(records, names, co):
    """records: lists (themes, phrases, words). names, co: counts of the generation before."""
    names, co = Counter(names), Counter(co)
    for themes, phrases, words in records:
        for kind, xs in (("theme", themes), ("phrase", phrases), ("word", words)):
            names.update((kind, x) for x in xs)
        co.update((a, b) for a in themes for b in themes if a != b)
    counts = {x: n for (k, x), n in names.items() if k == "theme"}
    by = defaultdict(dict)
    for (a, b), n in co.items():
        by[a][b] = n
    groups, seen = [], set()
    for t in sorted(by, key=lambda t: (-counts[t], t)):
        best = [b for b, n in sorted(by[t].items(), key=lambda x: (-x[1], x[0])) if n >= 3][:5]
        if t not in seen and best:
            groups.append([t, *best])
            seen |= {t, *best}
    weights = {t: 1 + math.log1p(n) / 10 + (min(2 * len(by[t]) / max(sum(by[t].values()), 1), 1.0) if by[t] else 0) for t, n in counts.items()}
    tree = {(b, a) for (a, b), n in co.items() if n / counts[a] > 0.7 and counts[b] > 2 * counts[a]}
    order = sorted(counts)
    at = {t: i for i, t in enumerate(order)}
    table = np.zeros((len(order), len(order)))
    for (a, b), n in co.items():
        table[at[a], at[b]] = n
    goal = np.array([max(0.1, counts[t]) for t in order], dtype=float)
    raked = dense_rake(table, goal, goal)
    pairs = {}
    for i, a in enumerate(order):
        for j, b in enumerate(order):
            v = math.floor(raked[i, j] + 1e-9)
            if i != j and (v > 0 or table[i, j] > 0):
                pairs[a, b] = v if v > 0 else int(table[i, j])
    balance = {}
    if tree:
        ps, cs = sorted({p for p, _ in tree}), sorted({c for _, c in tree})
        t2 = np.array([[pairs.get((p, c), 1.0) if (p, c) in tree else 0.0 for c in cs] for p in ps])
        got = dense_rake(t2, np.array([counts[p] for p in ps], dtype=float), np.array([counts[c] for c in cs], dtype=float))
        balance = {(p, c): got[i, j] / (counts[p] + 1e-8) for i, p in enumerate(ps) for j, c in enumerate(cs) if (p, c) in tree}
    total = sum(counts.values())
    mi = {(a, b): round(n / total * math.log2(n / total / (counts[a] / total * counts[b] / total + 1e-10)), 9) for (a, b), n in pairs.items() if a < b}
    top = sorted(mi.items(), key=lambda x: (-x[1], x[0]))[:20]
    return names, pairs, groups, weights, balance, dict(top)


def rows_of(df):
    return [(list(r.themes), list(r.phrases), list(r.words)) for r in df.collect()]


def test_learning_over_generations(spark):
    first = labels.labelled(labels.candidates(labels.turns(spark, SF)))
    one = dense_learn(rows_of(first), {}, {})
    memory = learning.learn(first)
    assert {(r["kind"], r["name"]): r["n"] for r in memory["names"].collect()} == dict(one[0])
    assert {(r.a, r.b): r.n for r in memory["pairs"].collect()} == one[1]
    got = {(r.parent, r.child): r.weight for r in memory["tree"].collect()}
    assert got.keys() == one[4].keys() and all(abs(got[k] - one[4][k]) < 1e-6 for k in got)
    assert {(r.a, r.b): r.mi for r in memory["mutual"].collect()} == pytest.approx(one[5])
    known = labels.themes_of(memory["names"]), memory["pairs"], memory["weights"], memory["mutual"]
    second = labels.adaptive(labels.candidates(labels.documents(spark, SF)), *known)
    two = dense_learn(rows_of(second), one[0], one[1])
    found = {(r["kind"], r.a, r.b): r.value for r in learning.b9_learn(spark, SF).collect()}
    want = {(k, x, ""): float(n) for (k, x), n in two[0].items()} | {("pair", a, b): float(n) for (a, b), n in two[1].items()}
    want |= {("coherence", t, ""): round(w, 6) for t, w in two[3].items()} | {("hierarchy", *k): round(w, 6) for k, w in two[4].items()}
    want |= {("information", *k): round(w, 6) for k, w in two[5].items()} | {("cluster", str(i), t): 1.0 for i, g in enumerate(two[2]) for t in dict.fromkeys(g)}
    assert found.keys() == want.keys()
    assert not {k: (found[k], want[k]) for k in found if found[k] != pytest.approx(want[k], abs=2e-6)}


def test_learning_of_nothing(spark):
    nothing = spark.createDataFrame([], "themes array<string>, phrases array<string>, words array<string>")
    assert all(df.count() == 0 for df in learning.learn(nothing).values())
    one = spark.createDataFrame([(["a"], [], ["a"])], nothing.schema)
    memory = learning.learn(one)
    assert memory["names"].count() == 2 and memory["pairs"].count() == 0
    assert learning.learn(one.where(F.lit(False)), memory)["names"].count() == 2


def test_raking_by_joins(spark, monkeypatch):
    """Large tables are raked by joins to the same factors."""
    rng = np.random.default_rng(4)
    rows = spark.createDataFrame([(f"r{i}", float(rng.integers(1, 50))) for i in range(6)], "a string, goal double")
    columns = spark.createDataFrame([(f"c{i}", float(rng.integers(1, 50))) for i in range(5)], "b string, goal double")
    cells = spark.createDataFrame([(f"r{i}", f"c{j}", float(rng.integers(1, 9))) for i in range(6) for j in range(5) if rng.random() < 0.5], "a string, b string, n double")
    near = learning.rake(rows, columns, cells, most=3)
    monkeypatch.setattr(learning, "LOCAL", 0)
    far = learning.rake(rows, columns, cells, most=3)
    for x, y in zip(near[:2], far[:2], strict=True):
        assert {r[0]: r["f"] for r in x.collect()} == pytest.approx({r[0]: r["f"] for r in y.collect()})
