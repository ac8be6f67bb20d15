"""Queries of this subpackage and, where SQL can say the same over whole tables, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptoria.llm import encodings, groups, leaks, near_duplicates, packing, repetition, scan_noise, spam
from scriptoria.session import Scratch
from scriptoria.sources.tables import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return repetition.repeating_records(table(spark, d, "needs_review"))


def p1_shares(spark: SparkSession, d: str) -> DataFrame:
    """The share of repeated content of every question_id."""
    return repetition.repeated_shares(table(spark, d, "needs_review"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return groups.duplicate_groups(table(spark, d, "needs_review"), Scratch(spark, "p3"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return near_duplicates.near_duplicate_pairs(table(spark, d, "needs_review"), Scratch(spark, "p4"))


def p4_classes(spark: SparkSession, d: str) -> DataFrame:
    return near_duplicates.near_duplicate_summary(table(spark, d, "needs_review"), Scratch(spark, "p4c"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return scan_noise.scan_noise(table(spark, d, "page_extractions"), table(spark, d, "needs_review"), Scratch(spark, "p6"))


def p6_repaired(spark: SparkSession, d: str) -> DataFrame:
    return scan_noise.repaired_texts(table(spark, d, "page_extractions"), table(spark, d, "needs_review"), Scratch(spark, "p6r"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return encodings.garbled_keys(table(spark, d, "page_extractions"))


def p7_restored(spark: SparkSession, d: str) -> DataFrame:
    pages = encodings.repair_pages(table(spark, d, "page_extractions"))
    return pages.filter("garbled").select("document_id", "page", "restored_text", "spans", "lost", F.array_join("codecs", ",").alias("codecs")).distinct()


def p8_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(table(spark, d, "documents"), Scratch(spark, "p8"))


def p8_placement(spark: SparkSession, d: str) -> DataFrame:
    """Of each text whether all of it is placed, whether pieces are missing, and whether a container of it holds too much."""
    items = packing.pack(table(spark, d, "documents"), Scratch(spark, "p8p"))
    items = Scratch(spark, "p8p").cut(items, "placed")
    full = items.filter("container is not null").groupBy("container").agg(F.sum("tokens").alias("held"))
    rows = items.join(full, "container", "left")
    sizes = rows.groupBy("doc_id").agg(
        F.bool_and(F.col("container").isNotNull()).alias("placed"), (F.count_distinct("piece") != F.max("piece") + 1).alias("gaps"),
        F.coalesce(F.bool_or(F.col("held") > packing.CAPACITY), F.lit(False)).alias("overfull"), (F.bool_or((F.col("tokens") < packing.CAPACITY) & (F.col("first_token") > 0)) & (F.max("piece") == 0)).alias("split_needlessly"),
    )
    return sizes


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return leaks.leaked_items(table(spark, d, "documents"), table(spark, d, "heldout_items")).select("doc_id", "item_id")


def p9_with_edits(spark: SparkSession, d: str) -> DataFrame:
    """Passages within two edits as well, with the words found."""
    return leaks.leaked_items(table(spark, d, "documents"), table(spark, d, "heldout_items"), edits=2)


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return spam.spam_pages(table(spark, d, "documents")).filter("is_spam and doc_id is not null").select("doc_id").distinct()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    made = [p1_found, p1_shares, p3_found, p4_found, p4_classes, p6_found, p6_repaired, p7_found, p7_restored, p8_packing, p8_placement, p9_found, p9_with_edits, p10_found]
    return {f.__name__: f for f in made}


WORDS = r"regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}]+')"

P1 = rf"""
WITH q AS (SELECT DISTINCT question_id, question_text, options FROM needs_review WHERE question_id IS NOT NULL),
t AS (SELECT row_number() OVER () AS r, question_id, {WORDS.format("question_text")} AS w, options FROM q),
g AS (SELECT r, i, w[i:i+4] AS run FROM t, LATERAL (SELECT unnest(range(1, len(w) - 3)) AS i) WHERE len(w) >= 10),
l AS (SELECT r, i FROM (SELECT r, i, row_number() OVER (PARTITION BY r, run ORDER BY i) AS k FROM g) WHERE k > 1),
c AS (SELECT r, count(DISTINCT i + o) AS n FROM l, (SELECT unnest(range(5)) AS o) GROUP BY r),
k AS (SELECT r, regexp_replace(lower(nfc_normalize(translate(u.label,
  'ＡＢＣＤＥＦＧＨａｂｃｄｅｆｇｈ０１２３４５６７８９', 'ABCDEFGHabcdefgh0123456789'))), '[^\p{{L}}\p{{N}}]+', '', 'g') AS key
  FROM (SELECT r, unnest(options) AS u FROM t)),
b AS (SELECT r FROM k WHERE key <> '' GROUP BY r HAVING count(*) > count(DISTINCT key))
SELECT DISTINCT question_id FROM t WHERE r IN (SELECT r FROM b)
  OR r IN (SELECT c.r FROM c JOIN t USING (r) WHERE c.n * 10 >= len(w) * 3)
"""

P1_SHARES = rf"""
WITH t AS (SELECT row_number() OVER () AS r, question_id, w FROM (SELECT DISTINCT question_id, {WORDS.format("coalesce(question_text, '')")} AS w FROM needs_review WHERE question_id IS NOT NULL)),
g AS (SELECT r, i, w[i:i+4] AS run FROM t, LATERAL (SELECT unnest(range(1, len(w) - 3)) AS i) WHERE len(w) >= 10),
l AS (SELECT r, i FROM (SELECT r, i, row_number() OVER (PARTITION BY r, run ORDER BY i) AS k FROM g) WHERE k > 1),
c AS (SELECT r, count(DISTINCT i + o) AS n FROM l, (SELECT unnest(range(5)) AS o) GROUP BY r)
SELECT DISTINCT question_id, coalesce(c.n, 0) / greatest(len(w), 1)::DOUBLE AS repeated_share FROM t LEFT JOIN c USING (r)
"""

P3 = """
WITH RECURSIVE ids AS (SELECT DISTINCT question_id, lower(trim(question_id)) AS v FROM needs_review WHERE trim(question_id) <> ''),
e AS (SELECT DISTINCT lower(trim(question_id)) AS a, lower(trim(duplicate_of_question_id)) AS b FROM needs_review
  WHERE lower(trim(duplicate_of_question_id)) IN (SELECT v FROM ids) AND lower(trim(question_id)) <> lower(trim(duplicate_of_question_id))),
both_ways AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
reach(a, b) AS (SELECT a, b FROM both_ways UNION SELECT r.a, x.b FROM reach r JOIN both_ways x ON r.b = x.a)
SELECT i.question_id, min(j.question_id) AS group_id
FROM reach r JOIN ids i ON r.a = i.v JOIN ids j ON r.b = j.v OR r.a = j.v GROUP BY i.question_id
"""

P4 = rf"""
WITH q AS (SELECT row_number() OVER () AS r, question_id, w FROM (SELECT DISTINCT question_id, {WORDS.format("question_text")} AS w FROM needs_review WHERE question_id IS NOT NULL)),
s AS (SELECT DISTINCT r, question_id, w[i:i+2] AS run FROM q, LATERAL (SELECT unnest(range(1, len(w) - 1)) AS i) WHERE len(w) >= 3),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
p AS (SELECT x.r AS a, y.r AS b, count(*) AS c FROM s x JOIN s y ON x.run = y.run AND x.r < y.r AND x.question_id <> y.question_id GROUP BY x.r, y.r)
SELECT DISTINCT least(qa.question_id, qb.question_id) AS question_id_1, greatest(qa.question_id, qb.question_id) AS question_id_2
FROM p JOIN n na ON na.r = a JOIN n nb ON nb.r = b JOIN q qa ON qa.r = a JOIN q qb ON qb.r = b WHERE c * 2 >= na.n + nb.n - c
"""

P4_CLASSES = rf"""
WITH q AS (SELECT DISTINCT question_id, {WORDS.format("question_text")} AS w FROM needs_review WHERE question_id IS NOT NULL AND question_text IS NOT NULL),
k AS (SELECT row_number() OVER () AS r, w, class_id FROM (SELECT w, min(question_id) AS class_id FROM q WHERE len(w) >= 3 GROUP BY w)),
s AS (SELECT DISTINCT r, w[i:i+2] AS run FROM k, LATERAL (SELECT unnest(range(1, len(w) - 1)) AS i)),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
p AS (SELECT x.r AS a, y.r AS b, count(*) AS c FROM s x JOIN s y ON x.run = y.run AND x.r <> y.r GROUP BY x.r, y.r),
l AS (SELECT a, count(*) AS links FROM p JOIN n na ON na.r = a JOIN n nb ON nb.r = b WHERE c * 2 >= na.n + nb.n - c GROUP BY a)
SELECT question_id, class_id, coalesce(links, 0) AS class_links FROM q JOIN k USING (w) LEFT JOIN l ON l.a = k.r
"""

P8 = "SELECT doc_id, coalesce(text, '') <> '' AS placed, false AS gaps, false AS overfull, false AS split_needlessly FROM documents"

P9 = rf"""
WITH d AS (SELECT doc_id, {WORDS.format("text")} AS w FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL),
i AS (SELECT item_id, {WORDS.format("text")} AS w FROM heldout_items),
g AS (SELECT DISTINCT item_id, array_to_string(w[k:k+11], ' ') AS run FROM i, LATERAL (SELECT unnest(range(1, len(w) - 10)) AS k) WHERE len(w) >= 12),
h AS (SELECT DISTINCT doc_id, array_to_string(w[k:k+11], ' ') AS run FROM d, LATERAL (SELECT unnest(range(1, len(w) - 10)) AS k) WHERE len(w) >= 12)
SELECT DISTINCT doc_id, item_id FROM h JOIN g USING (run)
"""


def oracle_sql() -> dict[str, str]:
    return {"p1_found": P1, "p1_shares": P1_SHARES, "p3_found": P3, "p4_found": P4, "p4_classes": P4_CLASSES, "p8_placement": P8, "p9_found": P9}
