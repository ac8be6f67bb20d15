"""Text gate: an ordered cascade of character shares, as one CASE; all but one share are built-in expressions."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scriptoria.functions import patterns as P
from scriptoria.functions.text import strip


def _class(chars: str) -> str:
    return "".join("\\" + c if not c.isalnum() else c for c in chars)


NOISE = rf"(?U)[^\p{{L}}\p{{N}}\s\x1c-\x1f{_class(P.CLEAN_PUNCTUATION)}]"
CONTROL = r"[\p{Cc}\p{Cn}\p{Co}\p{Cs}&&[^\n\r\t]]"


def count_of(text: Column, pattern: str) -> Column:
    """Characters of text that match a one-character pattern."""
    return F.regexp_count(text, F.lit(pattern))


@F.pandas_udf(T.IntegerType())
def most_frequent_char(text: pd.Series) -> pd.Series:
    """Occurrences of the most frequent character, 0 for an empty text; no built-in counts characters without sorting
    them, so the texts go through Arrow and a count of their codes."""

    def one(t: str | None) -> int:
        if not t:
            return 0
        if t.isascii():
            return int(np.bincount(np.frombuffer(t.encode(), np.uint8)).max())
        return Counter(t).most_common(1)[0][1]

    return pd.Series([one(t) for t in text], dtype="int32")


def assess(df: DataFrame, text: str = "text", min_chars: int = 20) -> DataFrame:
    """df with q_reason (null: clean), q_kind (the reason without its figure), q_chars, q_confidence.

    Shares are of the text without outer white space. Null text is `empty_extraction`.
    """
    t = strip(F.coalesce(F.col(text), F.lit("")))
    base = df.withColumn("_t", t).withColumn("_n", F.length("_t"))
    base = base.withColumn("_fffd", count_of(F.col("_t"), "�")).withColumn("_ctrl", count_of(F.col("_t"), CONTROL)).withColumn("_noise", count_of(F.col("_t"), NOISE))
    base = base.withColumn("_most", most_frequent_char(F.col("_t")))
    share = lambda c: F.try_divide(F.col(c), F.col("_n"))
    shown = lambda c, d: F.format_string(f"%.{d}f", share(c).cast("double"))
    kind = (
        F.when(F.col(text).isNull(), "empty_extraction")
        .when(F.col("_n") < min_chars, "too_short")
        .when(share("_fffd") > P.REPLACEMENT_MOST, "replacement_chars")
        .when(share("_ctrl") > P.CONTROL_MOST, "control_chars")
        .when(share("_most") > P.SAME_CHAR_MOST, "repeated_char_spam")
        .when(share("_noise") > P.NOISE_MOST, "high_noise_ratio")
    )
    base = base.withColumn("q_kind", kind)
    figure = F.when(F.col("q_kind") == "replacement_chars", shown("_fffd", 3)).when(F.col("q_kind") == "control_chars", shown("_ctrl", 3)).when(F.col("q_kind") == "repeated_char_spam", shown("_most", 2)).when(F.col("q_kind") == "high_noise_ratio", shown("_noise", 2))
    clean = F.least(F.lit(0.9), F.lit(0.55) + F.lit(0.35) * (1 - share("_noise")) * F.least(F.col("_n") / 500.0, F.lit(1.0)))
    low = F.create_map(*[F.lit(x) for kv in (("empty_extraction", 0.0), ("too_short", 0.1), ("replacement_chars", 0.1), ("control_chars", 0.15), ("repeated_char_spam", 0.15), ("high_noise_ratio", 0.2)) for x in kv])
    base = base.withColumn("q_reason", F.concat_ws(":", "q_kind", figure)).withColumn("q_reason", F.nullif("q_reason", F.lit("")))
    base = base.withColumn("q_confidence", F.when(F.col("q_kind").isNull(), F.round(clean, 3)).otherwise(low[F.col("q_kind")]))
    return base.withColumn("q_chars", F.coalesce("_n", F.lit(0))).drop("_t", "_n", "_fffd", "_ctrl", "_noise", "_most")


def rollup_flags(pages: DataFrame, documents: DataFrame) -> DataFrame:
    """(document_id, flags): per document what its pages lack, in order of page.

    A page is pending or failed before garbled before low in confidence; a document without pages has one flag.
    """
    why = (
        F.when(F.col("extraction_method").isin("pending_vision", "failed"), F.concat(F.lit("page_"), F.col("page"), F.lit("_"), F.col("extraction_method")))
        .when(F.col("is_garbled"), F.concat(F.lit("page_"), F.col("page"), F.lit("_garbled:"), F.coalesce("garbled_reason", F.lit(""))))
        .when(F.col("confidence") < 0.6, F.concat(F.lit("page_"), F.col("page"), F.lit("_low_confidence")))
    )
    flagged = pages.withColumn("why", why).dropDuplicates(["document_id", "page", "why"]).groupBy("document_id").agg(F.array_sort(F.collect_list(F.when(F.col("why").isNotNull(), F.struct("page", "why")))).alias("x"))
    out = documents.select("document_id").distinct().join(flagged, "document_id", "left")
    return out.select("document_id", F.when(F.col("x").isNull(), F.array(F.lit("no_pages_extracted"))).otherwise(F.col("x.why")).alias("flags"))
