"""Quality by Bradley-Terry pairwise ranking.

Documents are described by shape features (symbols, case, repetition, line and
sentence form ...), each spread over quantile bins. Every pair of a good and a
bad labelled document says that the good one wins; weights are fitted by the
logistic loss of the differences of the pairs' features. The threshold is the
quantile of the scores at which the labelled documents are told apart best, and
scores are mapped to 0..1 so that it comes to 0.7.

Learning uses at most ``sample`` labelled documents (by hash of the id) and
``pairs_each`` pairs a document. Null and empty texts have the features of an
empty text. Null labels are ignored, repeated ones count as their largest; of
rows that repeat a labelled id the smallest text is learned from. Null ids are
never learned from, and op8's held_out is null for them.
Without good or bad examples every score is the share of good labels (0.5 if
there are none). Repeated rows are scored each; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm.common import arrow_stage, labelled_texts, load, remainder, sample_ids, texts, written

THRESHOLD = 0.7
#: Pairs whose differences are held at once.
PAIRS = 1 << 13
FEATURES = ["log_bytes", "word_length", "symbols", "punctuation", "digits", "upper", "blanks", "unique_words", "top_word", "line_words", "repeated_lines", "repeated_pairs", "ends", "pipes", "symbol_words", "packed", "bad_bytes", "urls", "short_words", "run"]
_UPPER = bytes(b for b in range(256) if not 65 <= b <= 90)
_DIGIT = bytes(b for b in range(256) if not 48 <= b <= 57)
_PUNCT = bytes(b for b in range(256) if b not in b".,;:!?'\"()-")
_SYMBOL = bytes(b for b in range(256) if b not in b"#$%&*+/<=>@[\\]^_`{|}~")
_BLANK = bytes(b for b in range(256) if b not in b" \t\n\r\x0b\x0c")
_RUN = re.compile(rb"(.)\1{3,}", re.S)


def describe(text: bytes) -> list[float]:
    """The features of a whole text, in the order of FEATURES."""
    n = len(text)
    if not n:
        return [0.0] * len(FEATURES)
    count = lambda drop: len(text.translate(None, drop)) / n
    words = text.split()
    m = max(len(words), 1)
    lower = text.lower().split()
    lines = [x for x in (y.strip() for y in text.split(b"\n")) if x]
    counts = Counter(lower)
    pairs = len(set(zip(lower, lower[1:], strict=False)))
    symbol_words = sum(1 for w in words if w[-1:] in b"#$%&*~^|<>=@_" or w[-2:] == b"!!")
    return [
        math.log(n),
        sum(map(len, words)) / m,
        count(_SYMBOL),
        count(_PUNCT),
        count(_DIGIT),
        count(_UPPER),
        count(_BLANK),
        len(counts) / math.sqrt(m),
        max(counts.values(), default=0) / m,
        min(m / max(len(lines), 1), 200.0),
        1 - len(set(lines)) / len(lines) if lines else 0.0,
        1 - pairs / (len(lower) - 1) if len(lower) > 1 else 0.0,
        sum(1 for x in lines if x[-1:] in b".!?") / max(len(lines), 1),
        text.count(b"|") / m,
        symbol_words / m,
        sum(len(zlib.compress(text[i : i + 65536], 1)) for i in range(0, n, 65536)) / n,
        (text.count(b"\xef\xbf\xbd") + text.count(b"\x00")) / n,
        (text.count(b"http") + text.count(b"www.")) / m,
        sum(1 for w in words if len(w) <= 2) / m,
        sum(x.end() - x.start() for x in _RUN.finditer(text)) / n,
    ]


@dataclass
class Ranker:
    """edges: of each feature's quantile bins; weights: of all bins; scale and centre map the ranking to a score."""

    edges: list = field(default_factory=list)
    weights: np.ndarray | None = None
    centre: float = 0.0
    scale: float = 1.0
    constant: float = 0.5

    def codes(self, x: np.ndarray) -> np.ndarray:
        """One-hot bins of each row, as column numbers."""
        at, out = 0, []
        for e, c in zip(self.edges, x.T, strict=True):
            out.append(at + np.searchsorted(e, c, side="right"))
            at += len(e) + 1
        return np.stack(out, axis=1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.weights[self.codes(x)].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.constant)
        z = np.clip(self.scale * (self.raw(x) - self.centre), -30, 30) + math.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-z))


def rank(x: np.ndarray, y: np.ndarray, bins: int = 12, pairs_each: int = 8, l2: float = 3.0, seed: int = 7) -> Ranker:
    """Fits a ranker to features and labels."""
    model = Ranker()
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        model.constant = float(y.mean()) if len(y) else 0.5
        return model
    model.edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    codes = model.codes(x)
    width = sum(len(e) + 1 for e in model.edges)
    draw = np.random.default_rng(seed)
    wins = np.concatenate([np.repeat(good, pairs_each), draw.choice(good, len(bad) * pairs_each)])
    loses = np.concatenate([draw.choice(bad, len(good) * pairs_each), np.repeat(bad, pairs_each)])
    w = np.zeros(width)
    for _ in range(12):
        grad, hess = l2 * w, l2 * np.eye(width)
        for at in range(0, len(wins), PAIRS):
            diff = np.zeros((min(PAIRS, len(wins) - at), width), dtype=np.float32)
            rows = np.arange(len(diff))[:, None]
            np.add.at(diff, (rows, codes[wins[at : at + PAIRS]]), 1.0)
            np.add.at(diff, (rows, codes[loses[at : at + PAIRS]]), -1.0)
            p = 1 / (1 + np.exp(np.clip(diff @ w, -30, 30)))  # chance that the pair came out the other way
            grad -= (diff.T @ p) / pairs_each
            hess += (diff.T * (p * (1 - p)).astype(np.float32)) @ diff / pairs_each
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-5:
            break
    model.weights = w
    raw = model.raw(x)
    # Threshold by quantile: of the quantiles of all scores, the one that tells most labels right.
    cuts = np.quantile(raw, np.linspace(0.0, 1.0, 401))
    right = [((raw >= c) == (y == 1)).mean() for c in cuts]
    top = np.flatnonzero(np.array(right) >= max(right) - 1e-9)
    model.centre = float(cuts[top[len(top) // 2]])
    model.scale = 1.0
    return model


def learn(docs: DataFrame, labels: DataFrame, allowed=None, sample: int = 20_000) -> Ranker:
    """A ranker from labelled documents (doc_id, quality)."""
    ids = sample_ids(labels, "quality", F.lit(True) if allowed is None else allowed, sample)
    known = labelled_texts(docs, ids)
    out = T.StructType([T.StructField("x", T.ArrayType(T.DoubleType()))])
    rows = written(arrow_stage(known, {"text": "text"}, out, lambda cols: [pa.array([describe(t) for t in texts(cols["text"])], pa.list_(pa.float64()))], ["doc_id", "label"]), "quality-known")
    got = rows.orderBy(F.xxhash64("doc_id"), "doc_id").collect()  # at most ``sample`` rows
    return rank(np.array([r["x"] for r in got], dtype=float).reshape(-1, len(FEATURES)), np.array([r["label"] for r in got], dtype=int))


def score_quality(df: DataFrame, model: Ranker, text: str = "text", keep: list[str] | None = None, score: str = "score") -> DataFrame:
    """Adds the score. One narrow pass."""

    def fn(cols):
        x = np.array([describe(t) for t in texts(cols["text"])], dtype=float).reshape(-1, len(FEATURES))
        return [pa.array(model.score(x), pa.float64())]

    return arrow_stage(df, {"text": text}, T.StructType([T.StructField(score, T.DoubleType())]), fn, keep)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; rows whose id's CRC-32 leaves 2 when divided by 4 are never learned from."""
    docs = load(spark, sf_dir, "documents")
    model = learn(docs, load(spark, sf_dir, "labels"), remainder(4) != 2)
    found = score_quality(docs, model, keep=["doc_id"])
    return found.select("doc_id", (remainder(4) == 2).alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
