"""Queries over whole tables for the document operators, with SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scriptoria.functions import patterns as P
from scriptoria.functions import replies
from scriptoria.operators import dedupe, keys, layouts, ledger, lines, quality, review
from scriptoria.plans import questions
from scriptoria.plans.registry import query
from scriptoria.session import Scratch
from scriptoria.sources import files
from scriptoria.sources.tables import table

#: Pages once each: the same page is delivered more than once.
PAGES = "SELECT document_id, page, any_value(text) AS text FROM page_extractions GROUP BY document_id, page"
TRIM = r"regexp_replace({}, '^[\s\p{{Z}}\x1c-\x1f\x85]+|[\s\p{{Z}}\x1c-\x1f\x85]+$', '', 'g')"
LINES = rf"""
p AS ({PAGES}),
r AS (SELECT document_id, page, {TRIM.format("unnest(string_split(text, chr(10)))")} AS text, generate_subscripts(string_split(text, chr(10)), 1) AS k FROM p WHERE text IS NOT NULL),
l AS (SELECT document_id, page, row_number() OVER (PARTITION BY document_id, page ORDER BY k) - 1 AS idx, text, trim(lower(regexp_replace(text, '[\s\p{{Z}}\x1c-\x1f\x85]+', ' ', 'g')), ' .') AS norm FROM r WHERE text <> '')
"""
RUNNING = """
t AS (SELECT document_id, count(DISTINCT page) AS doc_pages FROM l GROUP BY document_id),
f AS (SELECT document_id, norm, count(DISTINCT page) AS n_pages, doc_pages FROM l JOIN t USING (document_id)
  WHERE length(norm) <= 60 AND norm <> '' GROUP BY document_id, norm, doc_pages HAVING count(DISTINCT page) >= 3 AND count(DISTINCT page) * 1000 >= doc_pages * 300)
"""
#: Lines marked as furniture, as SQL: whether a key entry stands alone is told without looking behind.
MARKED = r"""
k AS (SELECT l.*, f.norm IS NOT NULL AS run,
  regexp_full_match(text, '[\s|:\-.&,a-fA-F0-9)(]+') AND regexp_matches(text, '[0-9]') AND regexp_matches(text, '[a-fA-F]') AND regexp_matches(text, '(^|[^\p{L}\p{N}_])\d{1,3}\s*[-.):|]?\s*[a-fA-F](\s*[&,]\s*[a-fA-F])*($|[^\p{L}\p{N}_])')
  OR regexp_full_match(text, '(?i)(correct\s+answer|answer|ans|key)\s*[:.\-=)]*\s*\(?[a-f](\s*[&,]\s*[a-f])*\)?\.?\s*') AS answer,
  regexp_full_match(text, '\d{1,4}') OR regexp_full_match(text, '(?i)\d{1,4}\s*\|\s*p\s*a\s*g\s*e\.?') OR regexp_full_match(text, '`{3,}\w*') AS bare
  FROM l LEFT JOIN f USING (document_id, norm)),
m AS (SELECT *, bare OR (run AND NOT answer) AS furniture FROM k)
"""


#: Content lines by section, as SQL.
SECTIONS = rf"""
WITH {LINES}, {RUNNING}, {MARKED},
h AS (SELECT document_id, page, idx, text, CASE WHEN regexp_full_match(text, '(?i)m\.?\s*c\.?\s*q''?s?\.?') THEN 'mcq' WHEN regexp_full_match(text, '(?i)fill\s+in\s+the\s+blanks?') THEN 'fill_in_blank' WHEN regexp_full_match(text, '(?i)(cross[\s-]*)?matching') THEN 'matching' WHEN regexp_full_match(text, '(?i)model\s+answers?') THEN 'answer_key' END AS h,
  regexp_full_match(text, '(\p{{L}}{{1,2}}[\s\p{{Z}}]+)?\p{{Nd}}{{1,3}}[\s\p{{Z}}]*[-:.)]+\.?[\s\p{{Z}}]*.*') AS stem, regexp_full_match(text, '[a-fA-F][\s\p{{Z}}]*[-.)·][\s\p{{Z}}]*.*') AS opt FROM m WHERE NOT furniture),
w AS (SELECT *, count(h) OVER o AS section, last_value(h IGNORE NULLS) OVER o AS last, last_value(CASE WHEN h <> 'answer_key' THEN h END IGNORE NULLS) OVER o AS kind,
  max(CASE WHEN h <> 'answer_key' THEN 1 ELSE 0 END) OVER (PARTITION BY document_id) AS typed FROM h
  WINDOW o AS (PARTITION BY document_id ORDER BY page, idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
g AS (SELECT document_id FROM w WHERE section = 0 AND coalesce(typed, 0) = 0 GROUP BY document_id HAVING sum(CASE WHEN stem THEN 1 ELSE 0 END) >= 5 AND sum(CASE WHEN opt THEN 1 ELSE 0 END) >= 2 * sum(CASE WHEN stem THEN 1 ELSE 0 END)),
sec AS (SELECT document_id, page, idx, text, section, stem, opt, CASE WHEN document_id IN (SELECT document_id FROM g) THEN 'mcq' ELSE kind END AS kind, coalesce(last = 'answer_key', false) AS is_key, document_id IN (SELECT document_id FROM g) AS grouped FROM w WHERE h IS NULL)
"""
#: Question blocks of content sections, and entries of numbered keys by page, as SQL.
BLOCKS = rf"""{SECTIONS},
b AS (SELECT *, CASE WHEN kind = 'matching' THEN regexp_full_match(text, '(?i)\p{{Nd}}{{1,3}}[\s\p{{Z}}]*[-.)]+[\s\p{{Z}}]*match.*') ELSE stem END AS is_stem FROM sec WHERE NOT is_key AND kind IS NOT NULL),
k2 AS (SELECT *, sum(CASE WHEN is_stem THEN 1 ELSE 0 END) OVER (PARTITION BY document_id, section ORDER BY page, idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS block FROM b)
"""
ENTRY = r"(?i)(\d{1,3}|\bso\b)\s*[-.]\s*([a-e])(?:$|[^\p{L}\p{N}_])"
TOKENS = rf"""{SECTIONS},
kt AS (SELECT document_id, section, page, string_agg(text, ' ' ORDER BY idx) AS t FROM sec WHERE is_key AND kind = 'mcq' AND NOT grouped GROUP BY ALL),
tok AS (SELECT document_id, section, page, lower(unnest(regexp_extract_all(t, '{ENTRY}', 1))) AS number, lower(unnest(regexp_extract_all(t, '{ENTRY}', 2))) AS answer, generate_subscripts(regexp_extract_all(t, '{ENTRY}', 1), 1) AS ord FROM kt)
"""


def pages_once(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "page_extractions").dropDuplicates(["document_id", "page"])


def lines_of(spark: SparkSession, d: str) -> DataFrame:
    rows = lines.explode_lines(pages_once(spark, d))
    return lines.mark_furniture(rows, lines.running_lines(rows))


def lines_once(spark: SparkSession, d: str, scratch: Scratch) -> DataFrame:
    """lines_of, written once: the pages are shuffled once, by document, and their lines not at all."""
    pages = table(spark, d, "page_extractions").select("document_id", "page", "text").repartition("document_id").dropDuplicates(["document_id", "page"])
    return scratch.cut(lines.mark_documents(lines.explode_lines(pages)), "lines", release=True)


def section_rows(spark: SparkSession, d: str) -> DataFrame:
    """Content lines by section, written once, as several steps read them."""
    return Scratch(spark, "sections").cut(lines.assign_sections(lines.content_lines(lines_of(spark, d))), "rows")


def signatures_of(spark: SparkSession, d: str) -> DataFrame:
    marked = Scratch(spark, "layouts").cut(lines_of(spark, d), "lines")
    return Scratch(spark, "layouts").cut(layouts.signatures(layouts.layout_features(marked)), "signatures")


def questions_once(spark: SparkSession, d: str, *wanted: str) -> DataFrame:
    """The last export of every question, with the columns wanted or all."""
    rows = table(spark, d, "needs_review")
    cols = [c for c in wanted or rows.columns if c != "question_id"]
    return rows.groupBy("question_id").agg(F.max_by(F.struct(*cols), F.struct("exported_at", F.xxhash64("document_id", "question_text", "duplicate_of_question_id"))).alias("x")).select("question_id", "x.*")


@query(rf"""
WITH p AS ({PAGES}), s AS (SELECT document_id, page, text IS NULL AS gone, {TRIM.format("coalesce(text, '')")} AS t FROM p),
c AS (SELECT *, length(t) AS n, len(regexp_extract_all(t, '\x{{FFFD}}')) AS fffd, len(regexp_extract_all(t, '[\p{{Cc}}\p{{Co}}]')) - len(regexp_extract_all(t, '[\n\r\t]')) AS ctrl FROM s),
m AS (SELECT document_id, page, max(k) AS most FROM (SELECT document_id, page, ch, count(*) AS k FROM (SELECT document_id, page, unnest(string_split(t, '')) AS ch FROM s) GROUP BY ALL) GROUP BY ALL)
SELECT document_id, page, n AS q_chars, CASE WHEN gone THEN 'empty_extraction' WHEN n < 20 THEN 'too_short' WHEN fffd > 0.01 * n THEN 'replacement_chars' WHEN ctrl > 0.02 * n THEN 'control_chars' WHEN most > 0.4 * n THEN 'repeated_char_spam' ELSE 'other' END AS gate
FROM c LEFT JOIN m USING (document_id, page)
""")
def quality_gate(spark: SparkSession, d: str) -> DataFrame:
    """The gate's kind by page; noise and clean are told apart in quality_reasons."""
    rows = quality.assess(pages_once(spark, d))
    gate = F.when(F.col("q_kind").isNull() | (F.col("q_kind") == "high_noise_ratio"), "other").otherwise(F.col("q_kind"))
    return rows.select("document_id", "page", F.col("q_chars").cast("bigint").alias("q_chars"), gate.alias("gate"))


@query(rf"""
WITH p AS ({PAGES}), s AS (SELECT document_id, page, text IS NULL AS gone, {TRIM.format("coalesce(text, '')")} AS t FROM p),
c AS (SELECT *, length(t) AS n, len(regexp_extract_all(t, '\x{{FFFD}}')) AS fffd, len(regexp_extract_all(t, '[\p{{Cc}}\p{{Co}}]')) - len(regexp_extract_all(t, '[\n\r\t]')) AS ctrl,
  len(regexp_extract_all(t, '[^\p{{L}}\p{{N}}\s\p{{Z}}\x0b\x1c-\x1f\x85.,;:!?()\[\]{{}}''"\-_/\\%&+=<>*#@°ºµ±×÷√∞≈≠≤≥→←↔$€£¥|~^`]')) AS noise FROM s),
m AS (SELECT document_id, page, max(k) AS most FROM (SELECT document_id, page, ch, count(*) AS k FROM (SELECT document_id, page, unnest(string_split(t, '')) AS ch FROM s) GROUP BY ALL) GROUP BY ALL)
SELECT document_id, page, CASE WHEN gone THEN 'empty_extraction' WHEN n < 20 THEN 'too_short' WHEN fffd > 0.01 * n THEN printf('replacement_chars:%.3f', fffd / n::DOUBLE) WHEN ctrl > 0.02 * n THEN printf('control_chars:%.3f', ctrl / n::DOUBLE)
  WHEN most > 0.4 * n THEN printf('repeated_char_spam:%.2f', most / n::DOUBLE) WHEN noise > 0.15 * n THEN printf('high_noise_ratio:%.2f', noise / n::DOUBLE) END AS q_reason,
  CASE WHEN gone THEN 0.0 WHEN n < 20 OR fffd > 0.01 * n THEN 0.1 WHEN ctrl > 0.02 * n OR most > 0.4 * n THEN 0.15 WHEN noise > 0.15 * n THEN 0.2 ELSE round(least(0.9::DOUBLE, 0.55::DOUBLE + 0.35::DOUBLE * (1 - noise / n::DOUBLE) * least(n / 500.0::DOUBLE, 1::DOUBLE)), 3) END::DOUBLE AS q_confidence
FROM c LEFT JOIN m USING (document_id, page)
""")
def quality_reasons(spark: SparkSession, d: str) -> DataFrame:
    return quality.assess(pages_once(spark, d)).select("document_id", "page", "q_reason", "q_confidence")


@query(rf"""
WITH p AS (SELECT document_id, page, any_value(text) AS text, any_value(extraction_method) AS extraction_method FROM page_extractions GROUP BY document_id, page), s AS (SELECT document_id, page, extraction_method, text IS NULL AS gone, {TRIM.format("coalesce(text, '')")} AS t FROM p),
c AS (SELECT *, length(t) AS n, len(regexp_extract_all(t, '\x{{FFFD}}')) AS fffd, len(regexp_extract_all(t, '[\p{{Cc}}\p{{Co}}]')) - len(regexp_extract_all(t, '[\n\r\t]')) AS ctrl,
  len(regexp_extract_all(t, '[^\p{{L}}\p{{N}}\s\p{{Z}}\x0b\x1c-\x1f\x85.,;:!?()\[\]{{}}''"\-_/\\%&+=<>*#@°ºµ±×÷√∞≈≠≤≥→←↔$€£¥|~^`]')) AS noise FROM s),
m AS (SELECT document_id, page, max(k) AS most FROM (SELECT document_id, page, ch, count(*) AS k FROM (SELECT document_id, page, unnest(string_split(t, '')) AS ch FROM s) GROUP BY ALL) GROUP BY ALL)
SELECT extraction_method, CASE WHEN gone THEN 'empty_extraction' WHEN n < 20 THEN 'too_short' WHEN fffd > 0.01 * n THEN 'replacement_chars' WHEN ctrl > 0.02 * n THEN 'control_chars' WHEN most > 0.4 * n THEN 'repeated_char_spam' WHEN noise > 0.15 * n THEN 'high_noise_ratio' ELSE 'clean' END AS verdict, count(*) AS pages
FROM c LEFT JOIN m USING (document_id, page) GROUP BY ALL
""")
def quality_summary(spark: SparkSession, d: str) -> DataFrame:
    rows = quality.assess(pages_once(spark, d))
    return rows.groupBy("extraction_method", F.coalesce("q_kind", F.lit("clean")).alias("verdict")).agg(F.count(F.lit(1)).alias("pages"))


@query(r"""
SELECT lang, count(*) AS documents, sum(CASE WHEN text IS NULL THEN 1 ELSE 0 END) AS without_text, sum(length(text)) AS chars FROM documents GROUP BY lang
""")
def documents_by_lang(spark: SparkSession, d: str) -> DataFrame:
    n = F.count(F.lit(1)).alias("documents")
    return table(spark, d, "documents").groupBy("lang").agg(n, F.sum(F.col("text").isNull().cast("bigint")).alias("without_text"), F.sum(F.length("text").cast("bigint")).alias("chars"))


@query(f"WITH {LINES} SELECT document_id, page, idx, text, norm FROM l")
def line_explode(spark: SparkSession, d: str) -> DataFrame:
    return lines.explode_lines(pages_once(spark, d)).select("document_id", "page", F.col("idx").cast("bigint").alias("idx"), "text", "norm")


@query(f"WITH {LINES}, {RUNNING} SELECT document_id, norm, n_pages, doc_pages FROM f")
def furniture_lines(spark: SparkSession, d: str) -> DataFrame:
    return lines.running_lines(lines.explode_lines(pages_once(spark, d))).select("document_id", "norm", "n_pages", "doc_pages")


@query(f"WITH {LINES}, {RUNNING}, {MARKED} SELECT document_id, sum(CASE WHEN furniture THEN 0 ELSE 1 END)::BIGINT AS content, sum(CASE WHEN furniture THEN 1 ELSE 0 END)::BIGINT AS furniture FROM m GROUP BY document_id")
def strip_furniture(spark: SparkSession, d: str) -> DataFrame:
    """Content lines by document and how many were taken out."""
    rows = lines_of(spark, d)
    return rows.groupBy("document_id").agg(F.sum((~F.col("furniture")).cast("bigint")).alias("content"), F.sum(F.col("furniture").cast("bigint")).alias("furniture"))


@query(rf"""{SECTIONS} SELECT document_id, section, kind, is_key, count(*) AS n_lines FROM sec GROUP BY ALL""")
def sections(spark: SparkSession, d: str) -> DataFrame:
    rows = lines.assign_sections(lines.content_lines(lines_of(spark, d)))
    return rows.groupBy("document_id", "section", "kind", "is_key").agg(F.count(F.lit(1)).alias("n_lines"))


def segmented(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return questions.segment(section_rows(spark, d), Scratch(spark, "questions"))


@query()
def mcq_questions(spark: SparkSession, d: str) -> DataFrame:
    """Multiple-choice questions of all pages with their keys."""
    q = segmented(spark, d)[0].filter("section_type = 'mcq'")
    return q.select("question_id", "document_id", "number", "label", "question_text", F.size("options").alias("n_options"), "source_answer", F.array_join("anomalies", ";").alias("anomalies"))


@query()
def fill_in_questions(spark: SparkSession, d: str) -> DataFrame:
    q = segmented(spark, d)[0].filter("section_type = 'fill_in_blank'")
    return q.select("question_id", "document_id", "number", "question_text", "source_answer", F.array_join(F.transform("pages", lambda p: p.cast("string")), ",").alias("pages"), F.array_join("anomalies", ";").alias("anomalies"))


@query()
def matching_questions(spark: SparkSession, d: str) -> DataFrame:
    q = segmented(spark, d)[0].filter("section_type = 'matching'")
    return q.select("question_id", "document_id", "number", "question_text", F.size("pairs").alias("n_pairs"), "source_answer", F.array_join("anomalies", ";").alias("anomalies"))


@query()
def unmatched_keys(spark: SparkSession, d: str) -> DataFrame:
    return segmented(spark, d)[1]


@query()
def question_review_reasons(spark: SparkSession, d: str) -> DataFrame:
    """What every document is to be reviewed for, with how often."""
    return questions.review_reasons(*segmented(spark, d)).groupBy("document_id", "reason").agg(F.count(F.lit(1)).alias("times"))


@query(rf"""{BLOCKS} SELECT document_id, section, kind, block::BIGINT AS block, count(*) AS n_lines, count(CASE WHEN opt AND NOT is_stem THEN 1 END) AS n_options FROM k2 GROUP BY ALL""")
def question_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Lines and options of every question block; block 0 is what stands before the first question of a section."""
    rows = lines.question_blocks(section_rows(spark, d))
    option = F.col("text").rlike(P.OPTION) & ~F.col("is_stem")
    return rows.groupBy("document_id", "section", "kind", F.col("block").cast("bigint").alias("block")).agg(F.count(F.lit(1)).alias("n_lines"), F.count(F.when(option, 1)).alias("n_options"))


@query(rf"""{TOKENS} SELECT document_id, section, number, arg_max(answer, page * 1000000 + ord) AS answer, max(page) AS page FROM tok WHERE number <> 'so' GROUP BY ALL""")
def key_entries(spark: SparkSession, d: str) -> DataFrame:
    """The entry that counts of every number of every numbered key."""
    return keys.numbered_entries(keys.page_key_tokens(section_rows(spark, d)))


@query(rf"""{TOKENS}, n AS (SELECT document_id, section, page, count(DISTINCT number::INT) AS n, min(number::INT) AS lo, max(number::INT) AS hi, sum(DISTINCT number::INT) AS s FROM tok WHERE number <> 'so' GROUP BY ALL)
SELECT document_id, section, page, ((lo + hi) * (hi - lo + 1) / 2 - s)::INTEGER AS gap FROM n WHERE n >= 2 AND hi - lo + 1 - n = 1""")
def key_sequence_gaps(spark: SparkSession, d: str) -> DataFrame:
    rows = section_rows(spark, d)
    return keys.sequence_gaps(keys.page_key_tokens(rows))


@query()
def grouped_keys(spark: SparkSession, d: str) -> DataFrame:
    rows = lines.assign_sections(lines.content_lines(lines_of(spark, d)))
    return keys.grouped_entries(rows).select("document_id", "section", "key_label", "number", "answer", F.size("others").alias("conflicts"))


@query("""
WITH p AS (SELECT DISTINCT document_id, page FROM page_extractions), n AS (SELECT document_id, min(page) AS lo, max(page) AS hi, count(*) AS n, sum(page) AS s FROM p GROUP BY document_id)
SELECT document_id, CAST((lo + hi) * (hi - lo + 1) / 2 - s AS BIGINT) AS missing_page FROM n WHERE n >= 2 AND hi - lo + 1 - n = 1
""")
def page_sequence_gaps(spark: SparkSession, d: str) -> DataFrame:
    """The one page missing between a document's first and last, where exactly one is."""
    n = table(spark, d, "page_extractions").select("document_id", "page").distinct().groupBy("document_id").agg(F.min("page").alias("lo"), F.max("page").alias("hi"), F.count(F.lit(1)).alias("n"), F.sum("page").alias("s"))
    missing = ((F.col("lo") + F.col("hi")) * (F.col("hi") - F.col("lo") + 1) / 2 - F.col("s")).cast("bigint")
    return n.filter("n >= 2 and hi - lo + 1 - n = 1").select("document_id", missing.alias("missing_page"))


@query("""
WITH h AS (SELECT doc_id, sha256(text) AS content_hash FROM documents WHERE text IS NOT NULL), b AS (SELECT content_hash, min(doc_id) AS keeper, count(*) AS copies FROM h GROUP BY content_hash)
SELECT doc_id, content_hash, keeper, copies FROM h JOIN b USING (content_hash)
""")
def exact_copies(spark: SparkSession, d: str) -> DataFrame:
    return dedupe.exact_copies(table(spark, d, "documents"), "doc_id", F.col("text"))


@query()
def repeated_blocks(spark: SparkSession, d: str) -> DataFrame:
    """The first block of a document that is said again, blocks being lines."""
    return dedupe.repeated_blocks(table(spark, d, "documents"), ["doc_id"], separator="\n")


@query(r"""
WITH r AS (SELECT DISTINCT question_id, list_transform(options, lambda x: lower(trim(x.label))) AS o, list_transform(matching_pairs, lambda x: lower(trim(x.left_label))) AS l, list_transform(matching_pairs, lambda x: lower(trim(x.right_label))) AS r FROM needs_review)
SELECT DISTINCT question_id, coalesce(len(list_distinct(o)) < len(o), false) AS option_labels_repeat, coalesce(len(list_distinct(l)) < len(l), false) AS left_labels_repeat, coalesce(len(list_distinct(r)) < len(r), false) AS right_labels_repeat FROM r
""")
def label_dup_flags(spark: SparkSession, d: str) -> DataFrame:
    return dedupe.structural_flags(table(spark, d, "needs_review"))


@query()
def doubled_texts(spark: SparkSession, d: str) -> DataFrame:
    return dedupe.doubled_texts(table(spark, d, "needs_review"))


@query(r"""
WITH s AS (SELECT DISTINCT document_id, original_path FROM source_documents), r AS (SELECT document_id, string_split(replace(original_path, '/srv/bank/input/', ''), '/') AS p FROM s)
SELECT DISTINCT document_id, CASE WHEN len(p) > 1 THEN p[1] END AS subject, CASE WHEN len(p) > 2 THEN p[2] END AS topic FROM r
""")
def subject_topic(spark: SparkSession, d: str) -> DataFrame:
    subject, topic = files.subject_topic(F.col("original_path"), "/srv/bank/input")
    return table(spark, d, "source_documents").select("document_id", subject.alias("subject"), topic.alias("topic")).distinct()


@query("""
SELECT CASE lower(regexp_extract(original_path, '\\.([A-Za-z0-9]+)$', 1)) WHEN 'pdf' THEN 'pdf' WHEN 'docx' THEN 'docx' WHEN 'png' THEN 'image' WHEN 'jpg' THEN 'image' WHEN 'jpeg' THEN 'image' WHEN 'webp' THEN 'image' END AS file_type, count(*) AS files
FROM (SELECT DISTINCT original_path FROM file_scans) GROUP BY 1
""".replace("\\\\", "\\"))
def file_types(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "file_scans").select("original_path").distinct().groupBy(files.file_type(F.col("original_path")).alias("file_type")).agg(F.count(F.lit(1)).alias("files"))


@query("""
SELECT file_hash, max(CAST(processed_at AS TIMESTAMPTZ)) AT TIME ZONE 'UTC' AS last_processed, count(DISTINCT pipeline_version) AS versions FROM manifest GROUP BY file_hash
""")
def manifest_latest(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "manifest")
    last = files.upsert_manifest(rows.limit(0), rows).select("file_hash", F.try_to_timestamp(F.col("processed_at")).cast("timestamp_ntz").alias("last_processed"))
    return last.join(rows.groupBy("file_hash").agg(F.countDistinct("pipeline_version").alias("versions")), "file_hash")


@query("""
WITH f AS (SELECT DISTINCT document_id, page, CASE WHEN extraction_method IN ('pending_vision', 'failed') THEN 'page_' || page || '_' || extraction_method WHEN is_garbled THEN 'page_' || page || '_garbled:' || coalesce(garbled_reason, '') WHEN confidence < 0.6 THEN 'page_' || page || '_low_confidence' END AS why FROM page_extractions),
a AS (SELECT document_id, string_agg(why, ';' ORDER BY page, why) AS flags FROM f GROUP BY document_id)
SELECT d.document_id, CASE WHEN a.document_id IS NULL THEN 'no_pages_extracted' ELSE coalesce(a.flags, '') END AS flags FROM (SELECT DISTINCT document_id FROM source_documents) d LEFT JOIN a ON a.document_id = d.document_id
""")
def document_flags(spark: SparkSession, d: str) -> DataFrame:
    out = quality.rollup_flags(table(spark, d, "page_extractions"), table(spark, d, "source_documents"))
    return out.select("document_id", F.array_join("flags", ";").alias("flags"))


@query(r"""
WITH q AS (SELECT DISTINCT question_id, source_answer, options FROM needs_review WHERE source_answer IS NOT NULL),
p AS (SELECT DISTINCT question_id, source_answer, lower(trim(unnest(regexp_split_to_array(source_answer, '[&,]')))) AS part, list_transform(options, lambda x: lower(x.label)) AS labels FROM q)
SELECT DISTINCT question_id, part AS bad_letter FROM p WHERE part <> '' AND NOT coalesce(list_contains(labels, part), false)
""")
def key_letters_without_option(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "needs_review").select("question_id", "source_answer", F.coalesce("options", F.array().cast("array<struct<label:string,text:string>>")).alias("options")).distinct()
    return keys.answers_not_in_options(rows).select("question_id", F.explode("bad_letters").alias("bad_letter")).distinct()


@query("""
SELECT DISTINCT question_id, coalesce(nullif(verified_answer, ''), source_answer) AS answer FROM needs_review
""")
def effective_answers(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "needs_review").select("question_id", layouts.effective(F.col("verified_answer"), F.col("source_answer")).alias("answer")).distinct()


@query("""
SELECT regexp_replace(a, ':.*', '') AS anomaly, count(*) AS records FROM (SELECT DISTINCT question_id, unnest(anomalies) AS a FROM needs_review) GROUP BY 1
""")
def anomaly_counts(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "needs_review").select("question_id", F.explode("anomalies").alias("a")).distinct()
    return rows.groupBy(F.regexp_replace("a", ":.*", "").alias("anomaly")).agg(F.count(F.lit(1)).alias("records"))


@query()
def layout_signatures(spark: SparkSession, d: str) -> DataFrame:
    return signatures_of(spark, d)


@query()
def layout_matches(spark: SparkSession, d: str) -> DataFrame:
    """Each document with the three most similar of the layouts that two or more documents have."""
    sigs = signatures_of(spark, d)
    return layouts.match_layouts(sigs, layouts.layout_classes(sigs).filter("documents >= 2"))


def stored_questions(spark: SparkSession, d: str) -> DataFrame:
    """The last export of every question in the form of extracted ones."""
    q = questions_once(spark, d, "document_id", "section_type", "group_label", "question_number", "question_text", "options", "matching_pairs", "source_answer", "anomalies")
    none = F.lit(None).cast("string")
    return q.select("question_id", "document_id", "section_type", F.col("group_label").alias("label"), F.col("question_number").alias("number"), "question_text", "options", F.col("matching_pairs").alias("pairs"), "source_answer", "anomalies", none.alias("first_ref"), none.alias("last_ref"))


def stored_report(spark: SparkSession, d: str) -> DataFrame:
    scratch = Scratch(spark, "validation")
    # the references, null in all of them, stay out of the table: the plan then has no join for them
    none = F.lit(None).cast("string")
    q = scratch.cut(stored_questions(spark, d).drop("first_ref", "last_ref"), "questions", release=True).withColumns({"first_ref": none, "last_ref": none})
    marked = lines_once(spark, d, scratch)
    return layouts.validation_report(q, marked, layouts.layout_features(marked), q.select("document_id").limit(0))


@query()
def validation_checks(spark: SparkSession, d: str) -> DataFrame:
    return stored_report(spark, d)


@query()
def validation_scores(spark: SparkSession, d: str) -> DataFrame:
    return layouts.report_scores(stored_report(spark, d))


#: The layout of the banks with headers, as one of the closed grammar.
BANK = layouts.Layout(
    stem=layouts.Marker("number", "", "", "-.)"), option=layouts.Marker("both", "", "", "-.)"), key_mode="section", separators="-.",
    headers={"M.C.Q's": "mcq", "Multiple choice questions": "mcq", "Fill in the blanks": "fill_in_blank", "Cross matching": "matching", "Matching": "matching", "Model answers": "answer_key", "Model answer": "answer_key"},
)


def bank_extraction(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    scratch = Scratch(spark, "bank")
    marked = lines_once(spark, d, scratch)
    return (marked, *questions.extract_with_layout(marked, BANK, scratch))


@query()
def layout_questions(spark: SparkSession, d: str) -> DataFrame:
    """Questions that the layout of the banks finds in all pages."""
    q = bank_extraction(spark, d)[1]
    return q.select("question_id", "document_id", "section_type", "number", "question_text", F.size("options").alias("n_options"), "source_answer", F.array_join("anomalies", ";").alias("anomalies"), "first_ref", "last_ref")


def layout_anomalies(spark: SparkSession, d: str) -> DataFrame:
    """What documents are to be reviewed for after that, with how often."""
    _, q, unmatched, notes = bank_extraction(spark, d)
    return questions.review_reasons(q, unmatched, notes).groupBy("document_id", "reason").agg(F.count(F.lit(1)).alias("times"))


def layout_choice(spark: SparkSession, d: str) -> DataFrame:
    """For each document the better of the built-in rules and the layout of the banks, where that applies."""
    scratch = Scratch(spark, "choice")
    marked, q, unmatched, _ = bank_extraction(spark, d)
    features = scratch.cut(layouts.layout_features(marked), "features")
    fits = layouts.applicable(marked, BANK).filter("applies").select("document_id")
    mine, lost, _ = questions.segment(scratch.cut(lines.assign_sections(lines.content_lines(marked)), "rows"), scratch)
    none = F.lit(None).cast("string")
    scored = lambda qs, un, name: layouts.report_scores(layouts.validation_report(qs, marked, features, un)).withColumn("candidate", F.lit(name))
    both = scored(mine.withColumn("first_ref", none).withColumn("last_ref", none), lost, "builtin").unionByName(scored(q, unmatched, "bank").join(fits, "document_id", "left_semi"))
    return layouts.best_candidates(scratch.cut(both, "scores"))


@query(rf"""
WITH {LINES}, {RUNNING}, {MARKED}, c AS (SELECT document_id, norm, count(*) AS n, min((page, idx)) AS pl FROM m WHERE NOT furniture AND (
  regexp_matches(norm, '(?i)^(?:model\s+)?(?:answers?|answer\s+key|key|solutions?)(?:\s+sheet)?$') OR regexp_matches(norm, '(?i)^(?:m\.?\s*c\.?\s*q''?s?|fill in the blanks?|(?:cross[\s-]*)?matching)$')
  OR (len(string_split(trim(regexp_replace(text, '[\s\p{{Z}}-]+', ' ', 'g')), ' ')) BETWEEN 1 AND 8 AND NOT regexp_matches(text, '\p{{Nd}}') AND regexp_matches(text[1], '\p{{Lu}}') AND NOT regexp_matches(text, '[.?:;,!]$')
  AND NOT regexp_full_match(text, '(\p{{L}}{{1,2}}[\s\p{{Z}}]+)?\p{{Nd}}{{1,3}}[\s\p{{Z}}]*[-:.)]+\.?[\s\p{{Z}}]*.*') AND NOT regexp_full_match(text, '[a-fA-F][\s\p{{Z}}]*[-.)·][\s\p{{Z}}]*.*'))) GROUP BY ALL),
hr AS (SELECT *, concat('p', pl[1], ':', pl[2]) AS ref FROM c)
SELECT document_id, norm, n, ref, rank FROM (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY n DESC, ref) AS rank FROM hr) WHERE rank <= 14
""")
def header_candidates(spark: SparkSession, d: str) -> DataFrame:
    out = layouts.header_candidates(lines_of(spark, d))
    return out.withColumn("rank", F.col("rank").cast("bigint"))


@query("""
WITH RECURSIVE e AS (SELECT user_id, event_id, epoch_us(ts) AS t, CAST(floor(value) AS BIGINT) AS a, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
r AS (SELECT user_id, event_id, t, n, CAST(0 AS BIGINT) AS level_before, a * 1000000 AS level FROM e WHERE n = 1
  UNION ALL SELECT e.user_id, e.event_id, e.t, e.n, greatest(0, r.level - CAST(floor((e.t - r.t) * 60 / 3600.0) AS BIGINT)), greatest(0, r.level - CAST(floor((e.t - r.t) * 60 / 3600.0) AS BIGINT)) + e.a * 1000000 FROM r JOIN e ON e.user_id = r.user_id AND e.n = r.n + 1)
SELECT user_id, event_id, level_before, level FROM r
""")
def leaky_bucket(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").select("user_id", "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("t"), F.floor("value").alias("a"))
    return ledger.leaky_levels(rows, ["user_id"], "t", "a", ["t", "event_id"], 60, 3600).select("user_id", "event_id", "level_before", "level")


@query("""
WITH RECURSIVE e AS (SELECT user_id, event_id, epoch_us(ts) AS t, CAST(floor(value) AS BIGINT) AS a, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
r AS (SELECT user_id, event_id, t, n, a, CAST(0 AS BIGINT) AS before, a * 1000000 AS level FROM e WHERE n = 1
  UNION ALL SELECT e.user_id, e.event_id, e.t, e.n, e.a, greatest(0, r.level - CAST(floor((e.t - r.t) * 60 / 3600.0) AS BIGINT)), greatest(0, r.level - CAST(floor((e.t - r.t) * 60 / 3600.0) AS BIGINT)) + e.a * 1000000 FROM r JOIN e ON e.user_id = r.user_id AND e.n = r.n + 1)
SELECT user_id, event_id, CASE WHEN a > 54 THEN -1 ELSE CAST(ceil(greatest(0, before + a * 1000000 - 54000000) * 60 / 1000000.0) AS BIGINT) END AS wait_s FROM r
""")
def budget_wait(spark: SparkSession, d: str) -> DataFrame:
    """Whole seconds until each charge fits under nine tenths of the limit; -1 if it never does."""
    rows = table(spark, d, "events").select("user_id", "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("t"), F.floor("value").alias("a"))
    rows = ledger.leaky_levels(rows, ["user_id"], "t", "a", ["t", "event_id"], 60, 3600)
    wait = ledger.wait_needed(F.col("level_before") / 1_000_000, F.col("a").cast("double"), 60, 3600)
    micro = F.ceil(F.greatest(F.lit(0), F.col("level_before") + F.col("a") * 1_000_000 - 54_000_000) * 60 / F.lit(1_000_000)).cast("bigint")
    return rows.select("user_id", "event_id", F.when(wait == float("inf"), F.lit(-1)).otherwise(micro).cast("bigint").alias("wait_s"))


@query()
def routed_calls(spark: SparkSession, d: str) -> DataFrame:
    """Which of three models takes each event as a call, one session for each user."""
    calls = table(spark, d, "events").select(F.col("user_id").cast("string").alias("session"), "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("t"), F.floor(F.coalesce("value", F.lit(0))).alias("v"))
    w = Window.partitionBy("session").orderBy("t", "event_id")
    calls = calls.select("session", F.row_number().over(w).cast("bigint").alias("n"), (F.col("t") / 1_000_000).alias("at"), (F.lit(200) + F.col("v")).alias("prompt"), F.lit(630).alias("reserve"), (F.lit(400) + F.col("v")).alias("used"))
    return ledger.route_calls(calls, [("first", 30, 1000, 8000, 3000), ("second", 30, 1000, 8000, 3000), ("third", 30, 1000, 8000, 3000)]).select("session", "n", "model")


@query("""
WITH e AS (SELECT user_id, epoch_us(ts) AS b, epoch_us(ts) + 1800000000 AS f FROM events),
m AS (SELECT *, max(f) OVER (PARTITION BY user_id ORDER BY b, f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM e),
s AS (SELECT *, sum(CASE WHEN p IS NULL OR b > p THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY b, f ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS span FROM m)
SELECT user_id, CAST(span AS BIGINT) AS span, min(b) AS b, max(f) AS f FROM s GROUP BY user_id, span
""")
def interval_merge(spark: SparkSession, d: str) -> DataFrame:
    """Spans of activity: half an hour from each event, merged."""
    b = F.unix_micros(F.col("ts").cast("timestamp"))
    rows = table(spark, d, "events").select("user_id", b.alias("b"), (b + 1_800_000_000).alias("f"))
    return ledger.merge_intervals(rows, ["user_id"], "b", "f").select("user_id", "span", "b", "f")


@query("""
SELECT document_id, page, CAST(greatest(1, length(text) // 3) AS INTEGER) AS tokens FROM (SELECT document_id, page, any_value(text) AS text FROM page_extractions GROUP BY ALL) WHERE text IS NOT NULL
""")
def token_estimates(spark: SparkSession, d: str) -> DataFrame:
    return pages_once(spark, d).filter("text is not null").select("document_id", "page", replies.estimate_tokens(F.col("text")).alias("tokens"))


@query("""
SELECT DISTINCT document_id, page FROM page_extractions WHERE extraction_method = 'pending_vision' AND trim(rendered_image_path) <> ''
""")
def pending_pages(spark: SparkSession, d: str) -> DataFrame:
    return review.pending_pages(table(spark, d, "page_extractions")).select("document_id", "page").distinct()


@query()
def transcription_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """How a transcription of each page would be judged."""
    return review.transcription_outcome(pages_once(spark, d)).groupBy("outcome").agg(F.count(F.lit(1)).alias("pages"))


@query(r"""
WITH q AS (SELECT DISTINCT question_id, document_id, source_spans[1].pages[1] AS page FROM needs_review),
p AS (SELECT document_id, page, min(nullif(trim(rendered_image_path), '')) AS image FROM page_extractions GROUP BY ALL)
SELECT DISTINCT question_id, q.document_id, q.page, image FROM q LEFT JOIN p ON p.document_id = q.document_id AND p.page = q.page
""")
def question_images(spark: SparkSession, d: str) -> DataFrame:
    return review.question_images(table(spark, d, "needs_review"), table(spark, d, "page_extractions"))


@query(r"""
WITH h AS (SELECT question_id, exported_at, check_agrees IS NOT NULL AS checked, sha1(concat_ws(chr(31), coalesce(question_text, ''), coalesce(list_aggregate(list_transform(options, lambda o: concat_ws(chr(30), coalesce(o.label, ''), coalesce(o.text, ''))), 'string_agg', chr(29)), ''), coalesce(source_answer, ''))) AS h FROM needs_review),
g AS (SELECT question_id, count(DISTINCT h) AS contents, bool_or(checked) AS checked FROM h GROUP BY question_id)
SELECT question_id, contents, checked, CASE WHEN NOT checked THEN 'unchecked' WHEN contents > 1 THEN 'changed' ELSE 'current' END AS state FROM g
""")
def check_states(spark: SparkSession, d: str) -> DataFrame:
    """Whether each question has to be checked: never checked, or its exports differ in what a check reads."""
    return review.check_states(table(spark, d, "needs_review"))


@query(r"""
SELECT coalesce(ai_model_used, '') AS model, count(*) AS reviews, count(ai_confidence) AS with_confidence, CAST(round(1000 * avg(ai_confidence)) AS BIGINT) AS mean_per_mille, count(CASE WHEN check_agrees THEN 1 END) AS agreed
FROM (SELECT DISTINCT question_id, ai_model_used, ai_confidence, check_agrees FROM needs_review) GROUP BY ALL
""")
def review_stats(spark: SparkSession, d: str) -> DataFrame:
    return review.model_stats(table(spark, d, "needs_review").select("question_id", "ai_model_used", "ai_confidence", "check_agrees").distinct())


@query(r"""
WITH e AS (SELECT question_id, exported_at, options, matching_pairs, row_number() OVER (PARTITION BY question_id ORDER BY exported_at, hash(options::VARCHAR || coalesce(matching_pairs::VARCHAR, ''))) AS k FROM (SELECT DISTINCT question_id, exported_at, options, matching_pairs FROM needs_review))
SELECT a.question_id, count(*) AS exports, count(CASE WHEN a.options IS DISTINCT FROM b.options OR a.matching_pairs IS DISTINCT FROM b.matching_pairs THEN 1 END) AS changes FROM e a LEFT JOIN e b ON b.question_id = a.question_id AND b.k = 1 GROUP BY a.question_id
""")
def structure_changes(spark: SparkSession, d: str) -> DataFrame:
    """Exports of each question, and how many of them differ from the first in options or pairs."""
    return review.structure_changes(table(spark, d, "needs_review"))


@query("""
WITH q AS (SELECT question_id, document_id, section_type, try_cast(question_number AS INTEGER) AS n, question_number FROM needs_review GROUP BY ALL)
SELECT question_id, document_id, row_number() OVER (PARTITION BY document_id ORDER BY section_type NULLS FIRST, n NULLS LAST, question_number NULLS FIRST, question_id) AS position FROM q
""")
def question_order(spark: SparkSession, d: str) -> DataFrame:
    """The place of each question in its document: by type, then number as a number, others last."""
    rows = table(spark, d, "needs_review").select("question_id", "document_id", "section_type", F.col("question_number").try_cast("int").alias("n"), "question_number").distinct()
    w = Window.partitionBy("document_id").orderBy("section_type", F.asc_nulls_last("n"), "question_number", "question_id")
    return rows.select("question_id", "document_id", F.row_number().over(w).cast("bigint").alias("position"))
