"""Tokens of texts. A tokeniser is any callable from a text to a list of tokens (strings or ids as strings); it must be picklable."""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

PATTERN = re.compile(r"[A-Za-z0-9]+|[^A-Za-z0-9 ]")


def by_pattern(text: str) -> list[str]:
    """Runs of ASCII letters and digits, and single other characters but blanks."""
    return PATTERN.findall(text)


class FromFile:
    """A tokeniser of a vocabulary file in the format of the ``tokenizers`` library, read once in each process."""

    def __init__(self, path: str):
        self.path = path

    def __call__(self, text: str) -> list[str]:
        return _loaded(self.path).encode(text, add_special_tokens=False).tokens


_HELD: dict[str, object] = {}


def _loaded(path: str):
    if path not in _HELD:
        from tokenizers import Tokenizer

        _HELD[path] = Tokenizer.from_file(path)
    return _HELD[path]


def tokenise_column(text: Column, tokeniser: Callable[[str], list[str]] = by_pattern, most: int | None = 512) -> Column:
    """array<string> of at most ``most`` tokens; null counts as empty."""

    @F.pandas_udf("array<string>")
    def run(t: pd.Series) -> pd.Series:
        return pd.Series([tokeniser(x or "")[:most] for x in t])

    return run(text)
