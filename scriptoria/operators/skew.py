"""Joins whose key may hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with fewer rows is no burden for one task. The number doesn't grow with the table.
HARMLESS = 100_000
#: Hot keys are at most so many: beyond HARMLESS * MOST_HOT rows a key counts as hot from a MOST_HOT-th of them.
MOST_HOT = 1 << 20
FIND = object()


def hot_keys(df: DataFrame, key: str) -> DataFrame | None:
    """The keys with more than HARMLESS rows, as a table of at most MOST_HOT keys; None where there is none.

    The counts are aggregated before the shuffle; two numbers reach the driver. A table known to have too few
    rows for a hot key isn't read.
    """
    if getattr(df, "_scratch_rows", HARMLESS + 1) <= HARMLESS:
        return None
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    seen = counts.agg(F.max("n").alias("most"), F.sum("n").alias("total")).first()
    least = max(HARMLESS, (seen["total"] or 0) // MOST_HOT)
    return counts.filter(F.col("n") > least).select(key) if (seen["most"] or 0) > least else None


def salted_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner", hot: DataFrame | None | object = FIND, salts: int = 32) -> DataFrame:
    """left join right on key; rows of left with a hot key are spread over `salts` tasks.

    right may repeat a key; only its rows with a hot key are copied, once per salt. The hot keys are marked on
    both sides by a broadcast table of at most MOST_HOT keys.
    """
    hot = hot_keys(left, key) if hot is FIND else hot
    if hot is None:
        return left.join(right, key, how)
    mark = F.broadcast(hot.select(F.col(key).alias("_hot")))
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in left.columns if dict(left.dtypes)[c][:3] != "map"]), F.lit(salts)).cast("int")
    is_hot = F.col("_hot").isNotNull()
    a = left.join(mark, F.col(key) == F.col("_hot"), "left").withColumn("_salt", F.when(is_hot, spread).otherwise(0)).drop("_hot")
    b = right.join(mark, F.col(key) == F.col("_hot"), "left").withColumn("_salt", F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0))))).drop("_hot")
    return a.join(b, [key, "_salt"], how).drop("_salt")
