"""Problem 5: references to records that do not exist.

Reference and existence are signed counts per key, kept up by deltas (+1 when a reference or a target
appears, -1 when it goes). A key with positive references and no positive existence is an orphan; a
target that arrives later lifts its key out of the report without touching the references.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptoria.functions.text import clean_key
from scriptoria.operators.incremental import CommitStore
from scriptoria.operators.skew import salted_join

STATE = "ref_field string, key string, refs bigint, targets bigint"


def reference_deltas(rows: DataFrame, fields: list[str], sign: int = 1) -> DataFrame:
    """One row per reference: (ref_field, key, refs, targets). Null and blank references are none."""
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("ref_field"), clean_key(F.col(f)).alias("key")) for f in fields]))
    return rows.select(pairs.alias("x")).select("x.*").filter("key is not null").select("ref_field", "key", F.lit(sign).cast("bigint").alias("refs"), F.lit(0).cast("bigint").alias("targets"))


def target_deltas(rows: DataFrame, ref_field: str, key: str, sign: int = 1) -> DataFrame:
    return rows.select(F.lit(ref_field).alias("ref_field"), clean_key(F.col(key)).alias("key"), F.lit(0).cast("bigint").alias("refs"), F.lit(sign).cast("bigint").alias("targets")).filter("key is not null")


def merge_counts(state: DataFrame | None, *deltas: DataFrame) -> DataFrame:
    """The state after the deltas; keys whose counts are both zero leave it.

    The sums are combined before the shuffle, so a key with any share of the rows sends one row per task.
    """
    parts = [x for x in (state, *deltas) if x is not None]
    return reduce(DataFrame.unionByName, parts).groupBy("ref_field", "key").agg(F.sum("refs").alias("refs"), F.sum("targets").alias("targets")).filter("refs <> 0 or targets <> 0")


def orphan_keys(state: DataFrame) -> DataFrame:
    return state.filter("refs > 0 and targets <= 0").select("ref_field", "key")


def orphan_report(rows: DataFrame, orphans: DataFrame, fields: list[str], id_col: str, time_col: str) -> DataFrame:
    """(ref_field, question_id, missing_key, ref_month) of every reference to an orphan key, distinct.

    The key is shown as written, the month is null where the time is; a null id stays a null id.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("ref_field"), F.col(f).alias("missing_key")) for f in fields]))
    refs = rows.select(F.col(id_col).alias("question_id"), F.date_format(F.to_utc_timestamp(F.col(time_col), F.current_timezone()), "yyyy-MM").alias("ref_month"), pairs.alias("x")).select("question_id", "ref_month", "x.*")
    refs = refs.withColumn("key", clean_key(F.col("missing_key"))).filter("key is not null")
    refs = refs.withColumn("at", F.concat_ws("\x01", "ref_field", "key")).drop("key")
    keys = orphans.select(F.concat_ws("\x01", "ref_field", "key").alias("at"))
    return salted_join(refs, keys, "at").select("ref_field", "question_id", "missing_key", "ref_month").distinct()


def orphan_step(deltas: list[DataFrame]) -> Callable:
    """Step for CommitStore.apply: (orphan keys after the deltas, counts after them)."""

    def step(before: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        state = merge_counts(before, *deltas)
        return orphan_keys(state), state

    return step


FIELDS = ["duplicate_of_question_id", "document_id", "profile_id"]


def all_deltas(review: DataFrame, sources: DataFrame, profiles: DataFrame, sign: int = 1) -> list[DataFrame]:
    """Deltas of needs_review rows, live documents and layout profiles that appear (or go, with sign -1)."""
    return [
        reference_deltas(review, FIELDS, sign),
        target_deltas(review, "duplicate_of_question_id", "question_id", sign),
        target_deltas(sources, "document_id", "document_id", sign),
        target_deltas(profiles, "profile_id", "profile_id", sign),
    ]


def find_orphans(review: DataFrame, sources: DataFrame, profiles: DataFrame, store: CommitStore, number: int = 1) -> DataFrame:
    """Orphan references of needs_review rows to questions, live documents and layout profiles.

    The counts are kept in the store: a later call with the next number adds only its own deltas (see
    orphan_step). Works on empty tables (no rows out), repeated rows (counts grow, the report stays distinct)
    and tables with further columns of any name.
    """
    entry = store.apply(number, orphan_step(all_deltas(review, sources.filter("removed_at is null"), profiles)))
    orphans = review.sparkSession.read.schema("ref_field string, key string").parquet(entry["output"])
    return orphan_report(review, orphans, FIELDS, "question_id", "exported_at")


def orphan_counts_over_time(review: DataFrame, sources: DataFrame, profiles: DataFrame, store: CommitStore) -> DataFrame:
    """(step, ref_field, orphans, references): the kept counts after each of two runs of deltas.

    The first run has what was there at half of the time of the exports; the second only the changes since:
    later exports, later documents and profiles, and documents removed meanwhile, with sign -1. Rows without
    time come with the second run.
    """
    spark = review.sparkSession
    t = review.agg(((F.min(F.unix_micros(F.col("exported_at").cast("timestamp"))) + F.max(F.unix_micros(F.col("exported_at").cast("timestamp")))) / 2).cast("bigint").alias("t")).first()["t"] or 0
    early = lambda c: F.coalesce(F.unix_micros(F.col(c).cast("timestamp")) <= F.lit(t), F.lit(False))
    gone = F.col("removed_at").isNotNull()
    live_then = early("ingested_at") & ~early("removed_at")
    store.apply(1, orphan_step(all_deltas(review.filter(early("exported_at")), sources.filter(live_then), profiles.filter(early("created_at")))))
    first = store.last()
    changes = all_deltas(review.filter(~early("exported_at")), sources.filter(~early("ingested_at") & ~gone), profiles.filter(~early("created_at")))
    changes.append(target_deltas(sources.filter(live_then & gone), "document_id", "document_id", -1))
    store.apply(2, orphan_step(changes))
    second = store.last()
    parts = []
    for n, entry in ((1, first), (2, second)):
        state = spark.read.schema(STATE).parquet(entry["state"])
        bad = F.when((F.col("refs") > 0) & (F.col("targets") <= 0), 1)
        parts.append(state.groupBy("ref_field").agg(F.count(bad).alias("orphans"), F.sum(F.when(bad == 1, F.col("refs")).otherwise(0)).alias("references")).select(F.lit(n).cast("bigint").alias("step"), "ref_field", "orphans", "references"))
    return parts[0].unionByName(parts[1])
