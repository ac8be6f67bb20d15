"""Text similarities that have no built-in expression, in Arrow batches."""

from __future__ import annotations

import unicodedata
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Signs that a literal form does not have at its ends.
DECORATION = " *#_:.-–—=|~"


@F.pandas_udf(T.DoubleType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp ratio; the order of the arguments matters. Null if either is null."""
    return pd.Series([None if x is None or y is None else SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)], dtype="float64")


def self_repeat_ratio(least: float = 0.0):
    """Ratio of a text's two halves, with white space collapsed; 0 below 40 characters, for null and below least.

    The halves' characters bound the ratio from above; most texts are done with that.
    """

    def one(t: str | None) -> float:
        s = " ".join((t or "").split())
        half = len(s) // 2
        if len(s) < 40:
            return 0.0
        m = SequenceMatcher(None, s[:half].strip().lower(), s[half:].strip().lower())
        if least and m.quick_ratio() < least:
            return 0.0
        r = m.ratio()
        return r if r >= least else 0.0

    @F.pandas_udf(T.DoubleType())
    def measure(text: pd.Series) -> pd.Series:
        return pd.Series([one(t) for t in text], dtype="float64")

    return measure


@F.pandas_udf(T.StringType())
def nfkc(text: pd.Series) -> pd.Series:
    """Compatibility form; Spark has no built-in for it."""
    return pd.Series([None if t is None else unicodedata.normalize("NFKC", t) for t in text], dtype="object")


@F.pandas_udf(T.StringType())
def normalize_literal(text: pd.Series) -> pd.Series:
    """NFKC, lower case, single blanks, without decoration at the ends."""
    return pd.Series([None if t is None else " ".join(unicodedata.normalize("NFKC", t).lower().split()).strip(DECORATION) for t in text], dtype="object")
