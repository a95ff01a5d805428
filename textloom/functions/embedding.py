"""Embeddings of texts. An embedder is any callable from a list of texts to a matrix, with a number of columns ``dim``; it must be picklable.

The default needs no model: signed word counts in ``dim`` places, by the first
eight hex digits of the word's MD5, scaled to unit length. Columns are Arrow
UDFs, a batch of texts at a time.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from functools import lru_cache
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = re.compile(r"\w+")


class Embedder(Protocol):
    dim: int

    def __call__(self, texts: list[str]) -> np.ndarray: ...


@lru_cache(maxsize=1 << 16)
def word_hash(word: str) -> int:
    """32 bits of a word."""
    return int(hashlib.md5(word.encode()).hexdigest()[:8], 16)


@dataclass(frozen=True)
class HashedWords:
    """Unit vectors of signed word counts; zero for texts without words, and where all counts cancel out, unless ``whole``: then counts without signs stand in."""

    dim: int = 64
    whole: bool = False

    def __call__(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dim))
        for row, text in zip(out, texts, strict=True):
            h = np.array([word_hash(w) for w in WORD.findall(text.lower())], dtype=np.int64)
            np.add.at(row, h % self.dim, np.where(h & 0x80000000, 1.0, -1.0))
            if self.whole and not row.any():
                np.add.at(row, h % self.dim, 1.0)
        return out / np.maximum(np.sqrt((out * out).sum(axis=1, keepdims=True)), 1e-300)


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of rows; zero where either is zero."""
    size = np.sqrt((a * a).sum(axis=1) * (b * b).sum(axis=1))
    return np.divide((a * b).sum(axis=1), size, out=np.zeros(len(a)), where=size > 0)


def _plain(texts) -> list[str]:
    return ["" if t is None else t for t in texts]


def embed_column(text: Column, embedder: Embedder | None = None) -> Column:
    """array<double> of a text; null counts as empty."""
    made = embedder or HashedWords()

    @F.pandas_udf("array<double>")
    def run(t: pd.Series) -> pd.Series:
        return pd.Series(list(np.asarray(made(_plain(t)), dtype=float)))

    return run(text)


def similarity_column(a: Column, b: Column, embedder: Embedder | None = None) -> Column:
    """Cosine of two texts."""
    made = embedder or HashedWords()

    @F.pandas_udf("double")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series(cosines(made(_plain(x)), made(_plain(y))))

    return run(a, b)


def vector_similarity(a: Column, b: Column) -> Column:
    """Cosine of two vectors of equal size."""

    @F.pandas_udf("double")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series(cosines(np.stack(x), np.stack(y)) if len(x) else [], dtype=float)

    return run(a, b)


def coherence(text: str, embedder: Embedder) -> float:
    """Mean cosine of neighbouring sentences, 0.5 for fewer than two."""
    sentences = [s for s in re.split(r"[.!?]+", text) if s.strip()]
    if len(sentences) < 2:
        return 0.5
    v = embedder(sentences)
    return float(cosines(v[:-1], v[1:]).mean())


def coherence_column(text: Column, embedder: Embedder | None = None) -> Column:
    made = embedder or HashedWords()

    @F.pandas_udf("double")
    def run(t: pd.Series) -> pd.Series:
        return pd.Series([coherence(x, made) for x in _plain(t)], dtype=float)

    return run(text)
