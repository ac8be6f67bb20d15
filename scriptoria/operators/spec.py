"""A layout run over documents: sections by its headers, questions by its markers, answers by its kind of key.

The grammar of a layout is closed; all patterns are built here from its parts. What the rules of a layout do
otherwise than the built-in ones: headers may be nearly equal; of repeated key entries the first counts and a
repeat that differs is told; an entry may run over the end of a page; the usual number of options is that of
the document; answers may stand beside the questions.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptoria.functions import patterns as P
from scriptoria.functions.similarity import DECORATION, normalize_literal, ratio
from scriptoria.functions.text import collapse, strip
from scriptoria.operators import keys, lines
from scriptoria.operators.layouts import Layout, one_of, take_mark
from scriptoria.session import Scratch

LETTERS = "[a-f](?: *[&,] *[a-f])*"
PAIR = "struct<left_label:string,left_text:string,right_label:string,right_text:string>"
OPTION = "struct<label:string,text:string>"


def entry_pattern(layout: Layout) -> str:
    """A key entry anywhere in a text: number, what may stand between, letters joined by & or commas."""
    between = []
    if layout.separators:
        between.append(r"\s*" + one_of(layout.separators) + r"\s*")
    if layout.allow_space or not between:
        between.append(r"\s+")
    return rf"(?i)(\d{{1,3}})(?:{'|'.join(between)})({LETTERS.replace(' *', chr(92) + 's*')})\b"


def _beside(layout: Layout) -> str:
    return "(?:" + "|".join(re.escape(p) for p in sorted(layout.prefixes, key=lambda p: (-len(p), p))) + ")"


def answer_line(layout: Layout) -> str:
    """A line that gives the letters of its question's answer after one of the layout's prefixes."""
    return rf"(?i)^{_beside(layout)}[\s:.\-=)]*\(?({LETTERS.replace(' *', chr(92) + 's*')})\)?\.?\s*$"


def answer_text(layout: Layout) -> str:
    """A line that gives the text of its question's answer after a prefix and a mark."""
    return rf"(?i)^{_beside(layout)}\s*[:\-=]\s*(.+)$"


def layout_sections(rows: DataFrame, layout: Layout, scratch: Scratch, least: float = 0.9) -> tuple[DataFrame, DataFrame]:
    """(content lines with section, kind, is_key, grouped; (document_id, anomaly)).

    A line of at most 80 characters is a header if its literal form equals one of the layout's, or is nearly
    equal to one of four letters or more; the latter is told. Lines before any header are of default_kind.
    Different texts are compared once each, and only with headers of about their length. The literal form of
    ASCII texts is an expression, as their compatibility form is themselves.
    """
    kinds = sorted((" ".join(h.lower().split()).strip(DECORATION), k) for h, k in layout.headers.items())
    kinds = [(h, k) for h, k in kinds if h]
    heads = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(h).alias("h"), F.lit(k).alias("k")) for i, (h, k) in enumerate(kinds)]).cast("array<struct<i:int,h:string,k:string>>")
    body = rows.filter("not furniture")
    short = body.filter(F.length("text") <= 80).select("text")
    ascii_only = F.length("text") == F.octet_length("text")
    plain = short.filter(ascii_only).withColumn("n", F.btrim(F.regexp_replace(F.lower("text"), r"[\t-\r\x1c-\x1f ]+", " "), F.lit(DECORATION)))
    near = (F.length("h") >= 4) & (F.abs(F.length("n") - F.length("h")) <= 3) & (F.levenshtein("n", "h") <= F.length("h") / 2)
    met = lambda df: df.select("text", "n", F.explode(heads).alias("x")).select("text", "n", "x.*").withColumn("other", F.col("n") != F.col("h")).filter((F.col("n") == F.col("h")) | near)
    pairs = scratch.cut(met(plain).unionByName(met(short.filter(~ascii_only).distinct().withColumn("n", normalize_literal("text")))).distinct(), "pairs")
    # equal and nearly equal ones apart: as one condition the optimizer has every pair compared
    met = pairs.filter("not other").unionByName(pairs.filter("other").withColumn("r", ratio("n", "h")).filter(F.col("r") >= least).drop("r"))
    found = scratch.cut(met.groupBy("text").agg(F.min(F.struct("other", "i", "h", "k")).alias("x")).select("text", F.col("x.other").alias("_f"), F.col("x.h").alias("_to"), F.col("x.k").alias("_h")), "headers")
    scratch.drop(pairs)
    body = body.join(found, "text", "left")
    w = Window.partitionBy("document_id").orderBy(*lines.ORDER)
    body = body.withColumn("section", F.count("_h").over(w)).withColumn("_last", F.last("_h", True).over(w))
    kind = F.coalesce(F.last(F.when(F.col("_h") != "answer_key", F.col("_h")), True).over(w), F.lit(layout.default_kind))
    body = body.withColumn("kind", kind).withColumn("is_key", F.coalesce(F.col("_last") == "answer_key", F.lit(False))).withColumn("grouped", (F.col("kind") == "mcq") & F.lit(layout.grouped))
    body = scratch.cut(body, "sections")
    notes = body.filter("_f").select("document_id", F.concat(F.lit("fuzzy_section_header:"), F.substring(strip("text"), 1, 40), F.lit("->"), "_to").alias("anomaly")).distinct()
    loose = body.filter("_h = 'answer_key' and kind is null").select("document_id", F.concat(F.lit("answer_key_without_content_kind@"), lines.ref(F.col("page"), F.col("idx"))).alias("anomaly"))
    return body.filter("_h is null").drop("_f", "_to", "_h", "_last"), notes.unionByName(loose)


def _ordered(c: Column, text: str) -> Column:
    return F.transform(F.array_sort(F.collect_list(F.when(c, F.struct("page", "idx", F.col(text).alias("v"))))), lambda x: x["v"])


def mcq_with_layout(chapters: DataFrame, layout: Layout) -> DataFrame:
    """As lines.mcq_records, with given: the answer that stands beside the question, and first_ref, last_ref."""
    option = layout.option.pattern() if layout.option else "(?!)"
    w = Window.partitionBy("document_id", "section", "block").orderBy(*lines.ORDER)
    beside = F.col("rest").rlike(answer_line(layout)) if layout.key_mode == "inline_label" else F.lit(False)
    rows = chapters.filter("kind = 'mcq' and block > 0").withColumn("_i", beside)
    work, marked = take_mark(F.col("rest"), layout.mark, layout.mark_first) if layout.key_mode == "marked_option" else (F.col("rest"), F.lit(False))
    rows = rows.withColumn("_w", work).withColumn("_o", ~F.col("_i") & F.col("_w").rlike(option)).withColumn("opt", F.sum(F.col("_o").cast("int")).over(w)).withColumn("_m", marked & ~F.col("_i") & (F.col("opt") > 0))
    rows = rows.withColumn("_l", F.when(F.col("_o"), F.regexp_extract("_w", option, 1))).withColumn("_t", F.when(F.col("_o"), strip(F.regexp_extract("_w", option, 2))).when(F.col("opt") > 0, F.col("_w")).otherwise(F.col("rest")))
    given = F.when(F.col("_i"), F.lower(collapse(F.regexp_extract("rest", answer_line(layout), 1)))) if layout.key_mode == "inline_label" else F.lit(None).cast("string")
    at = F.struct("page", "idx")
    part = rows.withColumn("_g", given).groupBy("document_id", "section", "block", "opt").agg(
        F.max("_l").alias("olabel"), F.array_join(_ordered(~F.col("_i") & (F.col("_t") != ""), "_t"), " ").alias("t"), F.bool_or("_m").alias("m"), F.collect_set("page").alias("pages"), F.max(F.when(F.col("_i"), F.struct("page", "idx", "_g"))).alias("g"),
        F.max("number").alias("number"), F.max("chapter").alias("chapter"), F.max("label").alias("label"), F.bool_or("grouped").alias("grouped"), F.min(at).alias("lo"), F.max(at).alias("hi"),
    )
    items = F.array_sort(F.collect_list(F.when(F.col("opt") > 0, F.struct("opt", F.col("olabel").alias("label"), F.col("t").alias("text"), "m"))))
    q = part.groupBy("document_id", "section", "block").agg(
        F.max("number").alias("number"), F.max("chapter").alias("chapter"), F.max("label").alias("label"), F.bool_or("grouped").alias("grouped"), F.max(F.when(F.col("opt") == 0, F.col("t"))).alias("question_text"),
        items.alias("o"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("pages")))).alias("pages"), F.max("g").alias("g"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
    )
    sizes = q.filter(F.size("o") > 0).groupBy("document_id", F.size("o").alias("n")).agg(F.count(F.lit(1)).alias("times"), F.min(F.struct("section", "block")).alias("first"))
    usual = sizes.groupBy("document_id").agg(F.max(F.struct("times", (-F.col("first.section")).alias("s"), (-F.col("first.block")).alias("b"), "n"))["n"].alias("usual"))
    q = q.join(usual, "document_id", "left")
    many = F.max("chapter").over(Window.partitionBy("document_id", "section")) > 1
    middle = F.when(many, F.concat(F.coalesce(lines.slug(F.col("label")), F.concat(F.lit("g"), (F.col("chapter") - 1).cast("string"))), F.lit("-"))).otherwise("")
    labels = F.transform("o", lambda x: F.lower(x["label"]))
    odd = ~((F.size("o") == F.coalesce("usual", F.lit(4))) | (F.array_join(labels, "") == "abcde"))
    chosen = F.array_distinct(F.transform(F.filter("o", lambda x: x["m"]), lambda x: F.lower(x["label"])))
    note = lambda cond, text: F.when(cond, F.array(text)).otherwise(F.array().cast("array<string>"))
    return q.select(
        F.concat("document_id", F.lit("-mcq-"), middle, "number").alias("question_id"), "document_id", "section", "block", "grouped", "chapter", "label", "number", F.coalesce("question_text", F.lit("")).alias("question_text"),
        F.transform("o", lambda x: F.struct(x["label"].alias("label"), x["text"].alias("text"))).alias("options"), "pages",
        F.concat(note(odd, F.concat(F.lit("unexpected_option_count:"), F.size("o").cast("string"))), note(F.col("g").isNull() & (F.size(chosen) > 1), F.concat(F.lit("multiple_marked_options:"), F.array_join(chosen, ",")))).alias("anomalies"),
        F.coalesce(F.col("g._g"), F.nullif(F.array_join(chosen, " & "), F.lit(""))).alias("given"), lines.ref(F.col("lo.page"), F.col("lo.idx")).alias("first_ref"), lines.ref(F.col("hi.page"), F.col("hi.idx")).alias("last_ref"),
    )


def fill_in_with_layout(blocks: DataFrame, layout: Layout) -> DataFrame:
    """As lines.fill_in_records, with given, first_ref and last_ref."""
    beside = F.col("rest").rlike(answer_text(layout)) if layout.key_mode == "inline_label" else F.lit(False)
    rows = blocks.filter("kind = 'fill_in_blank' and block > 0").withColumn("_i", beside)
    given = F.when(F.col("_i"), strip(F.regexp_extract("rest", answer_text(layout), 1))) if layout.key_mode == "inline_label" else F.lit(None).cast("string")
    at = F.struct("page", "idx")
    q = rows.withColumn("_g", given).groupBy("document_id", "section", "block").agg(
        F.max("number").alias("number"), F.array_join(_ordered(~F.col("_i") & (F.col("rest") != ""), "rest"), " ").alias("question_text"), F.array_sort(F.collect_set("page")).alias("pages"),
        F.max(F.when(F.col("_i"), F.struct("page", "idx", "_g")))["_g"].alias("given"), F.min(at).alias("lo"), F.max(at).alias("hi"),
    )
    return q.select(F.concat("document_id", F.lit("-fib-"), "number").alias("question_id"), "document_id", "section", "block", "number", "question_text", "pages", "given", lines.ref(F.col("lo.page"), F.col("lo.idx")).alias("first_ref"), lines.ref(F.col("hi.page"), F.col("hi.idx")).alias("last_ref"))


def tokens_with_lines(rows: DataFrame, by: list[str], pattern: str) -> DataFrame:
    """by + (ord, number, answer, page, idx): entries of the joined text of all rows of a group, each with the line
    it begins in: the last line whose start is not after the entry's.

    The pattern marks each entry's begin in the text; the lengths before the marks are the offsets.
    """
    line = F.transform(F.array_sort(F.collect_list(F.struct("page", "idx", "text"))), lambda x: x)
    g = rows.groupBy(*by).agg(line.alias("ls")).withColumn("t", F.array_join(F.transform("ls", lambda x: F.concat(x["text"], F.lit(" "))), ""))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
    starts = F.aggregate("ls", start, lambda acc, x: F.struct((acc["at"] + F.length(x["text"]) + 1).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])
    pieces = F.split(F.regexp_replace("t", pattern, "\x01$0"), "\x01")
    offsets = F.aggregate(pieces, start, lambda acc, x: F.struct((acc["at"] + F.length(x)).alias("at"), F.concat(acc["out"], F.array(acc["at"] + F.length(x))).alias("out")), lambda acc: acc["out"])
    g = g.withColumn("starts", starts).withColumn("offsets", offsets)
    found = F.arrays_zip(F.regexp_extract_all("t", F.lit(pattern), 1).alias("number"), F.regexp_extract_all("t", F.lit(pattern), 2).alias("answer"))
    out = g.select(*by, "ls", "starts", "offsets", F.posexplode(found).alias("ord", "x"))
    at = F.greatest(F.size(F.filter("starts", lambda s: s <= F.get("offsets", F.col("ord")))) - 1, F.lit(0))
    return out.withColumn("l", F.get("ls", at)).select(*by, "ord", "x.number", F.lower(collapse(F.col("x.answer"))).alias("answer"), "l.page", "l.idx")


def numbered_with_layout(rows: DataFrame, layout: Layout) -> tuple[DataFrame, DataFrame]:
    """(entries, anomalies): the first entry of a number in a section counts; a repeat that differs is told."""
    t = tokens_with_lines(rows.filter("is_key and kind = 'mcq' and not grouped"), ["document_id", "section"], entry_pattern(layout))
    first = t.groupBy("document_id", "section", "number").agg(F.min(F.struct("ord", "answer", "page")).alias("f"))
    entries = first.select("document_id", "section", "number", "f.answer", "f.page")
    told = t.join(first, ["document_id", "section", "number"]).filter(F.col("answer") != F.col("f.answer"))
    return entries, told.select("document_id", F.concat(F.lit("answer_key_repeat_conflict:"), "number", F.lit(":"), "f.answer", F.lit("_vs_"), "answer").alias("anomaly"))


def layout_records(rows: DataFrame, layout: Layout) -> DataFrame:
    """All questions of the sections of a layout, before duplicates are resolved."""
    blocks = lines.question_blocks(rows, layout.stem.pattern())
    heading = lines.is_heading(F.col("text")) & ~F.col("is_stem") & ~F.col("text").rlike(layout.stem.pattern())
    if layout.option:
        heading = heading & ~F.col("text").rlike(layout.option.pattern())
    none = lambda kind: F.array().cast(f"array<{kind}>")
    mcq = mcq_with_layout(lines.chapter_groups(blocks, heading), layout).withColumn("section_type", F.lit("mcq")).withColumn("pairs", none(PAIR))
    plain = lambda df, kind: df.withColumn("section_type", F.lit(kind)).withColumn("options", none(OPTION)).withColumn("grouped", F.lit(False)).withColumn("chapter", F.lit(None).cast("bigint")).withColumn("label", F.lit(None).cast("string"))
    fib = plain(fill_in_with_layout(blocks, layout).withColumn("anomalies", none("string")).withColumn("pairs", none(PAIR)), "fill_in_blank")
    match = plain(lines.matching_records(blocks), "matching").withColumn("given", F.lit(None).cast("string")).withColumn("first_ref", F.lit(None).cast("string")).withColumn("last_ref", F.lit(None).cast("string"))
    return mcq.unionByName(fib).unionByName(match)


def flag_answers(questions: DataFrame, layout: Layout) -> DataFrame:
    """questions with no_answer_key_entry where the layout has a key but the question no answer, and
    answer_not_in_options where a letter of a multiple-choice answer names no option."""
    bad = keys.answers_not_in_options(questions.select("document_id", "question_id", "source_answer", "options").filter("source_answer is not null and size(options) > 0")).filter(F.size("bad_letters") > 0).select("document_id", "question_id", F.lit(True).alias("_bad"))
    q = questions.join(bad, ["document_id", "question_id"], "left")
    add = lambda cond, text: F.when(cond, F.array(text)).otherwise(F.array().cast("array<string>"))
    lacking = F.col("source_answer").isNull() & F.lit(layout.key_mode != "none")
    wrong = F.coalesce("_bad", F.lit(False)) & (F.col("section_type") == "mcq")
    return q.withColumn("anomalies", F.concat("anomalies", add(lacking, F.lit("no_answer_key_entry")), add(wrong, F.concat(F.lit("answer_not_in_options:"), "source_answer")))).drop("_bad")
