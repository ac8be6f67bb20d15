"""From section rows to questions with their answers: records, duplicates, keys of all kinds, anomalies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptoria.functions import patterns as P
from scriptoria.operators import dedupe, keys, lines, spec
from scriptoria.operators.layouts import Layout
from scriptoria.session import Scratch

UNMATCHED = ["document_id", "section_type", "raw_token", "raw_value", "page"]


def _none(kind: str = "string"):
    return F.array().cast(f"array<{kind}>")


def question_records(rows: DataFrame) -> DataFrame:
    """All questions of section rows, of the three kinds, before duplicates are resolved."""
    blocks = lines.question_blocks(rows)
    pair = "struct<left_label:string,left_text:string,right_label:string,right_text:string>"
    option = "struct<label:string,text:string>"
    mcq = lines.mcq_records(lines.chapter_groups(blocks)).withColumn("section_type", F.lit("mcq")).withColumn("pairs", _none(pair))
    plain = lambda df, kind: df.withColumn("section_type", F.lit(kind)).withColumn("options", _none(option)).withColumn("grouped", F.lit(False)).withColumn("chapter", F.lit(None).cast("bigint")).withColumn("label", F.lit(None).cast("string"))
    fib = plain(lines.fill_in_records(blocks).withColumn("anomalies", _none()).withColumn("pairs", _none(pair)), "fill_in_blank")
    match = plain(lines.matching_records(blocks), "matching")
    return mcq.unionByName(fib).unionByName(match)


def segment(rows: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(questions, unmatched, anomalies) of section rows by the built-in rules; as attach_keys.

    In a numbered key the last entry of a number counts; a misread number "so" is never attached.
    """
    rows = rows if hasattr(rows, "_scratch_rows") else scratch.cut(rows, "rows")
    records = scratch.cut(question_records(rows), "records")
    tokens = keys.page_key_tokens(rows)
    questions, unmatched, notes = attach_keys(records, rows, keys.numbered_entries(tokens), keys.fill_in_entries(rows), keys.grouped_entries(rows), scratch)
    lost = tokens.filter("number = 'so'").select("document_id", F.lit("mcq").alias("section_type"), F.col("number").alias("raw_token"), F.col("answer").alias("raw_value"), "page")
    return questions, unmatched.unionByName(lost), notes


def attach_keys(records: DataFrame, rows: DataFrame, numbered: DataFrame, fill_in: DataFrame, grouped: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(questions, unmatched, anomalies) of records and the entries of the keys.

    questions: every question_id once, with source_answer, anomalies, pages. unmatched: key entries without
    question. anomalies: (document_id, anomaly) of documents.
    """
    records = records.withColumn("given", F.lit(None).cast("string")) if "given" not in records.columns else records
    q = scratch.cut(dedupe.resolve_duplicates(records), "questions")
    plain = q.filter("not grouped and copy_of is null")
    unmatched: list[DataFrame] = []
    answers: list[DataFrame] = []
    notes: list[DataFrame] = []

    def attach(entries: DataFrame, kind: str, shown: bool) -> None:
        own = plain.filter(F.col("section_type") == kind).select("document_id", "number", "question_id")
        met = entries.join(own, ["document_id", "number"], "left")
        unmatched.append(met.filter("question_id is null").select("document_id", F.lit(kind).alias("section_type"), F.col("number").alias("raw_token"), F.col("answer").alias("raw_value"), "page"))
        answers.append(keys.final_answers(met.filter("question_id is not null"), ["document_id", "question_id"], shown))

    attach(numbered, "mcq", True)
    attach(fill_in, "fill_in_blank", False)

    matching = scratch.cut(keys.matching_entries(rows, plain.filter("section_type = 'matching'")), "matching")
    unmatched.append(matching.filter("question_id is null").select("document_id", F.lit("matching").alias("section_type"), F.concat(F.lit("("), "grp", F.lit(")")).alias("raw_token"), F.col("answer").alias("raw_value"), "page"))
    known = matching.filter("question_id is not null")
    doubt = known.filter("ambiguous").groupBy("document_id", "question_id").agg(F.array_repeat(F.lit("matching_answer_key_possibly_misaligned:answer_key_batch_short_a_token"), F.count(F.lit(1)).cast("int")).alias("doubt"))
    final = keys.final_answers(known, ["document_id", "question_id"], False).join(doubt, ["document_id", "question_id"], "left")
    answers.append(final.select("document_id", "question_id", "source_answer", F.concat("key_anomalies", F.coalesce("doubt", _none())).alias("key_anomalies")))

    entries = scratch.cut(grouped, "grouped")
    chapters = q.filter("grouped and label is not null and copy_of is null").select("document_id", "number", "question_id", "section", "block", "label", lines.label_key(F.col("label")).alias("content_key"))
    target = keys.match_labels(entries, chapters.withColumnRenamed("content_key", "label_key"))
    met = entries.join(target, ["document_id", "label_key"], "left")
    notes.append(met.filter("content_key is null").select("document_id", F.concat(F.lit("answer_key_group_unmatched:"), "key_label").alias("anomaly")).distinct())
    said = lambda x: F.concat(F.lit("answer_key_repeat_conflict:"), x["label"], F.lit("-"), "number", F.lit(":"), "answer", F.lit("_vs_"), x["answer"])
    notes.append(entries.select("document_id", F.explode(F.transform("others", said)).alias("anomaly")))
    last = chapters.groupBy("document_id", "content_key", "number").agg(F.max_by("question_id", F.struct("section", "block")).alias("question_id"))
    found = met.filter("content_key is not null").join(last, ["document_id", "content_key", "number"], "left")
    unmatched.append(found.filter("question_id is null").select("document_id", F.lit("mcq").alias("section_type"), F.concat("key_label", F.lit(":"), "number").alias("raw_token"), F.col("answer").alias("raw_value"), "page"))
    answers.append(keys.final_answers(found.filter("question_id is not null").withColumn("section", F.struct("section", "ord")), ["document_id", "question_id"]))
    seen = rows.filter("is_key and grouped").select("document_id", "section").distinct()
    first = chapters.groupBy("document_id", "content_key").agg(F.min_by("label", F.struct("section", "block")).alias("label"))
    lacking = seen.join(first, "document_id").join(met.filter("content_key is not null").select("document_id", "section", "content_key").distinct(), ["document_id", "section", "content_key"], "left_anti")
    notes.append(lacking.select("document_id", F.concat(F.lit("no_answer_key_for_group:"), "label").alias("anomaly")))

    notes.append(records.filter("grouped and label is null").select("document_id", "section", "chapter").distinct().select("document_id", F.concat(F.lit("group_heading_not_found:group_"), (F.col("chapter") - 1).cast("string")).alias("anomaly")))
    notes.append(q.filter("copy_of is not null").select("document_id", F.concat("section_type", F.lit("_q"), "copy_of", F.lit("_conflicting_duplicates")).alias("anomaly")))
    notes.append(rows.groupBy("document_id").agg(F.bool_or(~F.col("is_key") & F.col("kind").isNotNull()).alias("any")).filter("not any").select("document_id", F.lit("no_sections_detected").alias("anomaly")))

    told = reduce(DataFrame.unionByName, answers)
    out = q.join(told, ["document_id", "question_id"], "left").withColumn("source_answer", F.coalesce("source_answer", "given")).drop("given").withColumn("anomalies", F.concat("anomalies", F.coalesce("key_anomalies", _none()))).drop("key_anomalies")
    return out, reduce(DataFrame.unionByName, unmatched).select(*UNMATCHED), reduce(DataFrame.unionByName, notes)


def extract_with_layout(marked: DataFrame, layout: Layout, scratch: Scratch) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(questions, unmatched, anomalies) of lines marked for furniture, by the rules of a layout; as attach_keys.

    Raises ValueError if the layout breaks its own rules.
    """
    if layout.problems():
        raise ValueError("; ".join(layout.problems()))
    rows, notes = spec.layout_sections(marked, layout, scratch)
    rows = scratch.cut(rows, "rows")
    records = scratch.cut(spec.layout_records(rows, layout), "records")
    keyed = rows if layout.key_mode == "section" else rows.filter("not is_key")
    numbered, told = spec.numbered_with_layout(keyed, layout)
    numbered, told = scratch.cut(numbered, "numbered"), scratch.cut(told, "told")
    heading = lines.is_heading(F.col("text")) & ~F.col("text").rlike(layout.stem.pattern())
    grouped = keys.grouped_entries(keyed, P.ANY_KEY_LINE.replace(")(", ""), spec.entry_pattern(layout), heading)
    questions, unmatched, more = attach_keys(records, keyed, numbered, keys.fill_in_entries(keyed, layout.stem.pattern()), grouped, scratch)
    notes = notes.unionByName(told).unionByName(more)
    if layout.key_mode == "section":
        notes = notes.unionByName(rows.groupBy("document_id").agg(F.bool_or("is_key").alias("any")).filter("not any").select("document_id", F.lit("answer_key_section_not_found").alias("anomaly")))
    return spec.flag_answers(questions, layout), unmatched, notes


def review_reasons(questions: DataFrame, unmatched: DataFrame, anomalies: DataFrame) -> DataFrame:
    """(document_id, reason): what a document is to be reviewed for: its own anomalies, those of its questions, unmatched entries."""
    q = questions.select("document_id", "question_id", F.explode("anomalies").alias("a")).select("document_id", F.concat("question_id", F.lit(":"), "a").alias("reason"))
    u = unmatched.select("document_id", F.concat(F.lit("unmatched_answer_key:"), "raw_token", F.lit("@p"), "page").alias("reason"))
    return anomalies.select("document_id", F.col("anomaly").alias("reason")).unionByName(q).unionByName(u)
