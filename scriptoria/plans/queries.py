"""Queries of the core and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptoria.functions.text import clean_key
from scriptoria.operators.incremental import CommitStore, plan_next_run
from scriptoria.operators.references import find_orphans, orphan_counts_over_time
from scriptoria.plans import documents
from scriptoria.plans.registry import QUERIES, SQL, query
from scriptoria.session import Scratch
from scriptoria.sources.tables import table


@query("""
WITH last AS (SELECT *, row_number() OVER (PARTITION BY lower(trim(original_path)) ORDER BY seen_at DESC NULLS LAST, scan_id DESC NULLS LAST) AS n FROM file_scans WHERE trim(original_path) <> ''),
done AS (SELECT lower(trim(m.file_hash)) AS h FROM manifest m JOIN ingest_runs r ON lower(trim(r.status)) = 'succeeded'
  AND CAST(m.processed_at AS TIMESTAMPTZ) BETWEEN CAST(r.started_at AS TIMESTAMPTZ) AND CAST(r.finished_at AS TIMESTAMPTZ)
  WHERE lower(trim(m.pipeline_version)) = (SELECT lower(trim(arg_max(pipeline_version, started_at))) FROM ingest_runs))
SELECT DISTINCT file_hash FROM last WHERE n = 1 AND change_type <> 'removed' AND trim(file_hash) <> '' AND lower(trim(file_hash)) NOT IN (SELECT h FROM done WHERE h IS NOT NULL)
""")
def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return plan_next_run(spark, table(spark, d, "file_scans"), table(spark, d, "manifest"), table(spark, d, "ingest_runs"), Scratch(spark, "p2").path("store"))


@query("""
WITH m AS (SELECT (min(scan_id) + max(scan_id)) // 2 AS mid FROM file_scans), s AS (SELECT 1 AS run UNION ALL SELECT 2),
last AS (SELECT run, f.*, row_number() OVER (PARTITION BY run, lower(trim(original_path)) ORDER BY seen_at DESC NULLS LAST, scan_id DESC NULLS LAST) AS n FROM file_scans f, s, m WHERE trim(original_path) <> '' AND (run = 2 OR scan_id <= mid)),
done AS (SELECT lower(trim(m.file_hash)) AS h FROM manifest m JOIN ingest_runs r ON lower(trim(r.status)) = 'succeeded'
  AND CAST(m.processed_at AS TIMESTAMPTZ) BETWEEN CAST(r.started_at AS TIMESTAMPTZ) AND CAST(r.finished_at AS TIMESTAMPTZ)
  WHERE lower(trim(m.pipeline_version)) = (SELECT lower(trim(arg_max(pipeline_version, started_at))) FROM ingest_runs)),
p AS (SELECT DISTINCT run, file_hash, lower(trim(file_hash)) AS h FROM last WHERE n = 1 AND change_type <> 'removed' AND trim(file_hash) <> '' AND lower(trim(file_hash)) NOT IN (SELECT h FROM done WHERE h IS NOT NULL))
SELECT run::BIGINT AS run, file_hash FROM p WHERE run = 1 OR h NOT IN (SELECT h FROM p WHERE run = 1)
""")
def p2_two_runs(spark: SparkSession, d: str) -> DataFrame:
    """What each of two runs over one store hands out; the second reads only the rows after the first's watermark
    and hands out nothing that the first did."""
    scans, store = table(spark, d, "file_scans"), Scratch(spark, "p2t").path("store")
    mid = scans.agg(((F.min("scan_id") + F.max("scan_id")) / 2).cast("bigint").alias("mid")).first()["mid"]
    first = plan_next_run(spark, scans.filter(F.col("scan_id") <= F.lit(mid)), table(spark, d, "manifest"), table(spark, d, "ingest_runs"), store)
    second = plan_next_run(spark, scans, table(spark, d, "manifest"), table(spark, d, "ingest_runs"), store)
    key = clean_key(F.col("file_hash")).alias("h")
    new = second.withColumn("h", key).join(first.select(key).distinct(), "h", "left_anti").select("file_hash")
    return first.select(F.lit(1).cast("bigint").alias("run"), "file_hash").unionByName(new.select(F.lit(2).cast("bigint").alias("run"), "file_hash"))


@query("""
WITH r AS (
  SELECT 'duplicate_of_question_id' AS ref_field, question_id, duplicate_of_question_id AS missing_key, exported_at FROM needs_review
  UNION ALL SELECT 'document_id', question_id, document_id, exported_at FROM needs_review
  UNION ALL SELECT 'profile_id', question_id, profile_id, exported_at FROM needs_review),
t AS (
  SELECT 'duplicate_of_question_id' AS ref_field, lower(trim(question_id)) AS k FROM needs_review
  UNION SELECT 'document_id', lower(trim(document_id)) FROM source_documents WHERE removed_at IS NULL
  UNION SELECT 'profile_id', lower(trim(profile_id)) FROM layout_profiles)
SELECT DISTINCT ref_field, question_id, missing_key, strftime(exported_at::TIMESTAMPTZ AT TIME ZONE 'UTC', '%Y-%m') AS ref_month
FROM r WHERE trim(missing_key) <> '' AND NOT EXISTS (SELECT 1 FROM t WHERE t.ref_field = r.ref_field AND t.k = lower(trim(r.missing_key)))
""")
def p5_found(spark: SparkSession, d: str) -> DataFrame:
    store = CommitStore(spark, Scratch(spark, "p5").path("store"))
    return find_orphans(table(spark, d, "needs_review"), table(spark, d, "source_documents"), table(spark, d, "layout_profiles"), store)


@query("""
WITH t AS (SELECT CAST(floor((min(epoch_us(exported_at)) + max(epoch_us(exported_at))) / 2) AS BIGINT) AS t FROM needs_review),
s AS (SELECT 1 AS step UNION ALL SELECT 2),
v AS (SELECT step, n.* FROM needs_review n, s, t WHERE step = 2 OR epoch_us(exported_at) <= t),
r AS (SELECT step, 'duplicate_of_question_id' AS ref_field, lower(trim(duplicate_of_question_id)) AS k FROM v UNION ALL SELECT step, 'document_id', lower(trim(document_id)) FROM v UNION ALL SELECT step, 'profile_id', lower(trim(profile_id)) FROM v),
g AS (SELECT step, 'duplicate_of_question_id' AS ref_field, lower(trim(question_id)) AS k FROM v
  UNION SELECT step, 'document_id', lower(trim(document_id)) FROM source_documents, s, t WHERE step = 2 AND removed_at IS NULL OR step = 1 AND epoch_us(ingested_at) <= t AND coalesce(epoch_us(removed_at) > t, true)
  UNION SELECT step, 'profile_id', lower(trim(profile_id)) FROM layout_profiles, s, t WHERE step = 2 OR epoch_us(created_at) <= t)
SELECT step::BIGINT AS step, ref_field, count(DISTINCT CASE WHEN g.k IS NULL THEN r.k END) AS orphans, sum(CASE WHEN g.k IS NULL THEN 1 ELSE 0 END)::BIGINT AS references
FROM r LEFT JOIN g USING (step, ref_field, k) WHERE k <> '' GROUP BY step, ref_field
""")
def p5_two_runs(spark: SparkSession, d: str) -> DataFrame:
    """Orphan keys by field after each of two runs over one kept state, the second of changes only."""
    store = CommitStore(spark, Scratch(spark, "p5t").path("store"))
    return orphan_counts_over_time(table(spark, d, "needs_review"), table(spark, d, "source_documents"), table(spark, d, "layout_profiles"), store)


__all__ = ["QUERIES", "SQL", "documents"]
