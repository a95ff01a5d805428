"""URL filter: host and path rules first, gradient-boosted trees on lexical features for the rest; DataFrame functions only.

Trees are fitted on the driver from a bounded sample of labelled URLs
(``sample`` distinct ones, chosen by hash) and scored as one SQL expression, so judging
URLs is a narrow projection. Null URLs and URLs without '://' have an empty
host and path; they are judged by the trees like any URL without a rule. With
no labelled URLs of both kinds the trees reduce to a constant.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm.common import hashed_share, load

OUTPUT = ("host", "path", "rule", "score", "verdict")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: verdict, host and path.
RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def parsed(df: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host`` (A-Z lower-cased) and ``path``."""
    u = F.coalesce(F.col(url), F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"\A([^/?#]*)", 1)
    return df.withColumns({"host": F.translate(host, UPPER, LOWER), "path": F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)})


def rule_of(rules: list[tuple[str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, else null."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: len(r[1])):
        h, _, p = text.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def count_of(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def features(url: str = "url") -> dict[str, Column]:
    """Lexical features over ``url``, ``host`` and ``path``."""
    u, host, path = F.coalesce(F.col(url), F.lit("")), F.col("host"), F.col("path")
    n, size = F.length(u).cast("double"), F.greatest(F.length(host), F.lit(1))
    chars = F.sort_array(F.filter(F.split(host, ""), lambda c: c != ""))
    starts = F.filter(F.sequence(F.lit(0), F.size(chars)), lambda i: (i == 0) | ~F.get(chars, i).eqNullSafe(F.get(chars, i - 1)))
    runs = F.transform(F.slice(starts, 2, F.greatest(F.size(starts), F.lit(1))), lambda e, i: (e - F.get(starts, i)).cast("double"))
    entropy = F.when(host == "", F.lit(0.0)).otherwise(F.log2(size.cast("double")) - F.aggregate(runs, F.lit(0.0), lambda a, c: a + c * F.log2(c)) / size)
    rest = F.substring(u, F.instr(u, "://") + 3, F.length(u))
    return {
        "length": n,
        "host_length": F.length(host).cast("double"),
        "path_length": F.length(path).cast("double"),
        "depth": count_of(path, "[^/]+"),
        "labels": count_of(host, r"[^.]+"),
        "digit_ratio": count_of(u, "[0-9]") / F.greatest(n, F.lit(1.0)),
        "host_digits": count_of(host, "[0-9]"),
        "host_hyphens": count_of(host, "-"),
        "entropy": entropy,
        "parameters": count_of(F.regexp_extract(rest, r"\?([^#]*)", 1), "[^&]+"),
        "fragment": F.when(rest.contains("#"), 1.0).otherwise(0.0),
        "https": F.when(u.startswith("https:"), 1.0).otherwise(0.0),
        "extension": F.when(path.rlike(r"\.[A-Za-z0-9]{1,5}\z"), 1.0).otherwise(0.0),
        "trailing_slash": F.when(path.endswith("/"), 1.0).otherwise(0.0),
    }


def suffixes() -> dict[str, Column]:
    """Parts of a URL whose labelled shares become features."""
    host, path = F.col("host"), F.col("path")
    return {
        "tld": F.regexp_extract(host, r"([^.]*)\z", 1),
        "domain": F.regexp_extract(host, r"([^.]*\.[^.]*)\z", 1),
        "first_label": F.regexp_extract(host, r"\A([^.]*)", 1),
        "first_segment": F.concat_ws(" ", F.regexp_extract(host, r"([^.]*)\z", 1), F.regexp_extract(path, r"\A/([^/]*)", 1)),
    }


@dataclass(frozen=True)
class Tree:
    """Inner node: feature, threshold, left (value <= threshold), right; leaf: value."""

    feature: str = ""
    threshold: float = 0.0
    left: Tree | None = None
    right: Tree | None = None
    value: float = 0.0

    def column(self) -> Column:
        if self.left is None:
            return F.lit(float(self.value))
        return F.when(F.col(self.feature) <= self.threshold, self.left.column()).otherwise(self.right.column())


def fit_trees(x: np.ndarray, y: np.ndarray, names: list[str], trees: int = 30, depth: int = 3, rate: float = 0.3, bins: int = 32, l2: float = 1.0) -> tuple[float, list[Tree]]:
    """Newton boosting of the logistic loss over histograms of ``bins`` quantile bins."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) if len(c) else np.zeros(0) for c in x.T]
    code = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)], axis=1) if len(x) else np.zeros((0, len(names)), dtype=int)
    p = float(np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99))
    base = float(np.log(p / (1 - p)))
    margin, made = np.full(len(y), base), []

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, level: int) -> Tree:
        gs, hs = g[rows].sum(), h[rows].sum()
        leaf = Tree(value=-rate * gs / (hs + l2))
        best = (1e-6, None, None)
        if level and len(rows) > 1:
            for f, e in enumerate(edges):
                if len(e):
                    gl = np.cumsum(np.bincount(code[rows, f], g[rows], len(e) + 1))[:-1]
                    hl = np.cumsum(np.bincount(code[rows, f], h[rows], len(e) + 1))[:-1]
                    gain = gl**2 / (hl + l2) + (gs - gl) ** 2 / (hs - hl + l2) - gs**2 / (hs + l2)
                    k = int(np.argmax(gain))
                    if gain[k] > best[0]:
                        best = (gain[k], f, k)
        if best[1] is None:
            margin[rows] += leaf.value
            return leaf
        _, f, k = best
        low = code[rows, f] <= k
        return Tree(names[f], float(edges[f][k]), grow(rows[low], g, h, level - 1), grow(rows[~low], g, h, level - 1))

    for _ in range(trees):
        q = 1 / (1 + np.exp(-margin))
        made.append(grow(np.arange(len(y)), q - y, q * (1 - q), depth))
    return base, made


def judge_urls(df: DataFrame, rules: list[tuple[str, str]] | None = None, url: str = "url", keep: list[str] | None = None, labelled: DataFrame | None = None, sample: int = 20_000) -> DataFrame:
    """Adds host, path, rule, score (chance of block) and verdict.

    labelled: rows (url, label 0/1) to learn from; by default the URLs that a
    rule decides. Repeated URLs teach once. Extra columns are dropped unless
    named in ``keep``; the added ones replace kept columns of the same name.
    """
    rules = RULES if rules is None else rules
    keep = [c for c in keep or [] if c not in OUTPUT]
    rows = parsed(df.select(*keep, F.col(url).alias("__url")), "__url")
    rule, verdict = rule_of(rules, F.col("host"), F.col("path"))
    rows = rows.withColumns({"rule": rule, "__said": verdict})
    if labelled is None:
        known = rows.where("rule IS NOT NULL").select("__url", "host", "path", F.when(F.col("__said") == "block", 1).otherwise(0).alias("label"))
    else:
        known = parsed(labelled.select(F.col("url").alias("__url"), F.col("label").cast("int").alias("label")).where("label IS NOT NULL"), "__url")
    made, parts = features("__url"), suffixes()
    # Each URL teaches once, with its largest label.
    known = known.where(hashed_share(known, F.col("__url"), sample)).groupBy("__url", "host", "path").agg(F.max("label").alias("label"))
    known = known.orderBy(F.xxhash64("__url"), "__url").limit(sample).select("label", (F.xxhash64("__url") % 2 == 0).alias("half"), *[c.alias(k) for k, c in made.items()], *[c.alias(k) for k, c in parts.items()]).collect()
    y = np.array([r["label"] for r in known], dtype=float)
    mean = float(y.mean()) if len(y) else 0.5

    def label_shares(some: list) -> dict[str, dict[str, float]]:
        """Of each part's values the smoothed share of label 1; values seen fewer than 20 times count as unknown."""
        out = {}
        for k in parts:
            sums: dict[str, list[float]] = {}
            for r in some:
                s = sums.setdefault(r[k], [0.0, 0.0])
                s[0], s[1] = s[0] + r["label"], s[1] + 1
            top = sorted((v for v in sums.items() if v[1][1] >= 20), key=lambda v: (-v[1][1], v[0]))[:64]
            out[k] = {v: (a + 5 * mean) / (n + 5) for v, (a, n) in top}
        return out

    shares = label_shares(known)
    # Trees learn from shares that come from the other half of the URLs, so that no URL's label is among its own features.
    other = {half: label_shares([r for r in known if r["half"] != half]) for half in (True, False)}
    names = list(made) + list(parts)
    x = np.array([[r[k] for k in made] + [other[r["half"]][k].get(r[k], mean) for k in parts] for r in known], dtype=float).reshape(-1, len(names))
    base, trees = fit_trees(x, y, names)
    numeric = {k: c for k, c in made.items()}
    for k, c in parts.items():
        value = F.lit(mean)
        for v, share in shares[k].items():
            value = F.when(c == v, F.lit(share)).otherwise(value)
        numeric[k] = value
    rows = rows.withColumns({f"__f_{k}": c for k, c in numeric.items()})
    total = F.lit(base)
    for t in trees:
        total = total + renamed(t).column()
    rows = rows.withColumn("score", 1 / (1 + F.exp(-total)))
    decided = F.coalesce(F.col("__said"), F.when(F.col("score") >= 0.5, "block").otherwise("allow"))
    return rows.withColumn("verdict", decided).select(*keep, "host", "path", "rule", "score", "verdict")


def renamed(t: Tree) -> Tree:
    return t if t.left is None else Tree(f"__f_{t.feature}", t.threshold, renamed(t.left), renamed(t.right))


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's host, path, rule and verdict."""
    return judge_urls(load(spark, sf_dir, "pages"), keep=["page_id"])
