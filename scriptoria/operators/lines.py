"""Pages into lines: cleaning, running lines, predicates on lines, sections, blocks, options and records.

One exchange by document serves all window steps: every window partitions by document_id first and orders by
page and line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptoria.functions import patterns as P
from scriptoria.functions.similarity import nfkc
from scriptoria.functions.text import collapse, strip

ORDER = ["page", "idx"]


def norm_line(c: Column) -> Column:
    """Lower case, single blanks, no blanks or dots at the ends."""
    return F.btrim(F.lower(F.regexp_replace(c, r"(?U)\s+", " ")), F.lit(" ."))


def explode_lines(pages: DataFrame) -> DataFrame:
    """(document_id, page, idx, text, norm): non-blank lines, numbered within the page from 0."""
    parts = F.filter(F.transform(F.split("text", "\n"), strip), lambda s: s != "")
    rows = pages.filter("text is not null").select("document_id", "page", F.posexplode(parts).alias("idx", "text"))
    return rows.withColumn("norm", norm_line(F.col("text")))


def running_lines(lines: DataFrame, min_pages: int = P.FURNITURE_PAGES, min_share: float = P.FURNITURE_SHARE, max_chars: int = P.FURNITURE_CHARS) -> DataFrame:
    """(document_id, norm, n_pages, doc_pages): short lines on at least min_pages pages and min_share of them.

    Pages count if they have text. Counts are combined before the shuffle.
    """
    share = int(round(min_share * 1000))
    total = lines.groupBy("document_id").agg(F.countDistinct("page").alias("doc_pages"))
    found = lines.filter((F.length("norm") <= max_chars) & (F.col("norm") != "")).groupBy("document_id", "norm").agg(F.countDistinct("page").alias("n_pages")).filter(F.col("n_pages") >= min_pages)
    return found.join(total, "document_id").filter(F.col("n_pages") * 1000 >= F.col("doc_pages") * share)


def is_furniture(text: Column, running: Column) -> Column:
    """Running lines, page numbers, page labels and fences. Answers are rescued."""
    bare = text.rlike(P.PAGE_NUMBER) | text.rlike(P.PAGE_LABEL) | text.rlike(P.FENCE)
    return bare | (F.coalesce(running, F.lit(False)) & ~(is_key_like(text) | text.rlike(P.INLINE_ANSWER)))


def mark_furniture(lines: DataFrame, running: DataFrame) -> DataFrame:
    """lines with furniture."""
    hit = running.select("document_id", "norm", F.lit(True).alias("_run"))
    return lines.join(hit, ["document_id", "norm"], "left").withColumn("furniture", is_furniture(F.col("text"), F.col("_run"))).drop("_run")


def mark_documents(lines: DataFrame, min_pages: int = P.FURNITURE_PAGES, min_share: float = P.FURNITURE_SHARE, max_chars: int = P.FURNITURE_CHARS) -> DataFrame:
    """mark_furniture(lines, running_lines(lines)) by windows: lines that are partitioned by document stay where they are."""
    share = int(round(min_share * 1000))
    said = F.size(F.collect_set("page").over(Window.partitionBy("document_id", "norm")))
    pages = F.size(F.collect_set("page").over(Window.partitionBy("document_id")))
    rows = lines.withColumn("_said", said).withColumn("_pages", pages)
    run = F.col("document_id").isNotNull() & (F.length("norm") <= max_chars) & (F.col("norm") != "") & (F.col("_said") >= min_pages) & (F.col("_said") * 1000 >= F.col("_pages") * share)
    return rows.withColumn("furniture", is_furniture(F.col("text"), run)).drop("_said", "_pages")


def content_lines(lines: DataFrame) -> DataFrame:
    return lines.filter(~F.col("furniture"))


def is_key_like(c: Column) -> Column:
    return c.rlike(P.ANY_KEY_LINE) & c.rlike("[0-9]") & c.rlike("[a-fA-F]") & c.rlike(P.ANY_KEY_TOKEN)


def is_heading(c: Column) -> Column:
    """One to eight words, no digit, a capital first, no closing mark, neither stem nor option."""
    words = F.size(F.split(collapse(c), " "))
    first = F.substring(c, 1, 1)
    return (words.between(1, 8)) & (c != "") & ~c.rlike(r"(?U)\d") & first.rlike(r"\p{Lu}") & ~c.rlike(r"[.?:;,!]$") & ~c.rlike(P.STEM) & ~c.rlike(P.OPTION)


def ref(page: Column, idx: Column) -> Column:
    return F.concat(F.lit("p"), page, F.lit(":"), idx)


def parse_ref(c: Column) -> tuple[Column, Column]:
    """(page, idx) of a reference like p7:12; null where it isn't one."""
    ok = c.rlike(r"^p\d+:\d+$")
    return F.when(ok, F.regexp_extract(c, r"^p(\d+):", 1).cast("int")), F.when(ok, F.regexp_extract(c, r":(\d+)$", 1).cast("int"))


def header_kind(c: Column) -> Column:
    case = None
    for kind, pattern in P.SECTION_HEADERS.items():
        case = F.when(c.rlike(pattern), kind) if case is None else case.when(c.rlike(pattern), kind)
    return case


def assign_sections(lines: DataFrame) -> DataFrame:
    """lines with section (ordinal), kind (of content), is_key and grouped; header lines are left out.

    A key section belongs to the last content kind before it. A document without any header of content whose
    lines before the first key run like questions (five stems, twice as many options) is one MCQ section of
    chapters, its key sections included: these rows are `grouped`.
    """
    w = Window.partitionBy("document_id").orderBy(*ORDER)
    doc = Window.partitionBy("document_id")
    rows = lines.withColumn("_h", header_kind(F.col("text")))
    rows = rows.withColumn("section", F.count("_h").over(w)).withColumn("_last", F.last("_h", True).over(w))
    rows = rows.withColumn("kind", F.last(F.when(F.col("_h") != "answer_key", F.col("_h")), True).over(w)).withColumn("is_key", F.coalesce(F.col("_last") == "answer_key", F.lit(False)))
    first = F.col("section") == 0
    stems = F.sum((first & F.col("text").rlike(P.STEM)).cast("int")).over(doc)
    options = F.sum((first & F.col("text").rlike(P.OPTION)).cast("int")).over(doc)
    typed = F.max((F.col("_h").isNotNull() & (F.col("_h") != "answer_key")).cast("int")).over(doc)
    rows = rows.withColumn("grouped", (typed == 0) & (stems >= 5) & (options >= 2 * stems)).withColumn("kind", F.when(F.col("grouped"), "mcq").otherwise(F.col("kind")))
    return rows.filter("_h is null").drop("_h", "_last")


def question_blocks(rows: DataFrame, stem_pattern: str = P.STEM) -> DataFrame:
    """Content rows with block (0 before the first stem), number, rest: the stem's number and text."""
    w = Window.partitionBy("document_id", "section").orderBy(*ORDER)
    stem = F.when(F.col("kind") == "matching", F.col("text").rlike(P.MATCHING_STEM)).otherwise(F.col("text").rlike(stem_pattern))
    out = rows.filter("not is_key and kind is not null").withColumn("is_stem", stem).withColumn("block", F.sum(F.col("is_stem").cast("int")).over(w))
    part = lambda k: F.when(F.col("kind") == "matching", F.regexp_extract("text", P.MATCHING_STEM, k)).otherwise(F.regexp_extract("text", stem_pattern, k))
    return out.withColumn("number", F.last(F.when(F.col("is_stem"), part(1)), True).over(w)).withColumn("rest", F.when(F.col("is_stem"), strip(part(2))).otherwise(F.col("text")))


def chapter_groups(blocks: DataFrame, heading: Column | None = None) -> DataFrame:
    """Blocks with chapter (from 1) and label: in a grouped section numbering starts a chapter at its first stem
    and at 1 after a number other than 0 and 1. Other sections are one chapter without label.

    The last text before such a stem names the chapter if it is a heading, and leaves its block. heading: another
    test of the column rest for that.
    """
    w = Window.partitionBy("document_id", "section").orderBy(*ORDER)
    # the last line before a stem has the previous block's number
    before = F.lag("number").over(w)
    starts = F.col("grouped") & F.col("is_stem") & ((F.col("block") == 1) | ((F.col("number") == "1") & ~F.coalesce(before, F.lit("0")).isin("0", "1")))
    rows = blocks.withColumn("_start", starts)
    named = F.coalesce(F.lead("_start").over(w), F.lit(False)) & (is_heading(F.col("rest")) if heading is None else heading)
    rows = rows.withColumn("_named", named).withColumn("_label", F.when(F.col("_start") & F.coalesce(F.lag("_named").over(w), F.lit(False)), F.lag("rest").over(w)))
    rows = rows.withColumn("chapter", F.sum(F.col("_start").cast("int")).over(w))
    rows = rows.withColumn("label", F.first("_label", True).over(Window.partitionBy("document_id", "section", "chapter")))
    return rows.filter("not _named or is_stem").withColumn("rest", F.when(F.col("_named"), "").otherwise(F.col("rest"))).drop("_start", "_named", "_label")


def slug(c: Column) -> Column:
    """Lower-case ASCII words of the compatibility form joined by hyphens, at most 40 characters, x where nothing is left."""
    made = F.regexp_replace(F.regexp_replace(F.lower(nfkc(c)), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.when(c.isNotNull(), F.coalesce(F.nullif(F.substring(made, 1, 40), F.lit("")), F.lit("x")))


def label_key(c: Column) -> Column:
    """A chapter's label as it is compared with that of a key: letters and digits of ASCII in the compatibility form."""
    return F.regexp_replace(F.lower(nfkc(c)), "[^a-z0-9]+", "")


def _joined(items: Column) -> Column:
    """Texts of (page, idx, text) structs in order, one blank between."""
    return F.array_join(F.transform(F.array_sort(items), lambda x: x["rest"]), " ")


def mcq_records(chapters: DataFrame) -> DataFrame:
    """(question_id, document_id, section, block, grouped, chapter, label, number, question_text, options, pages, anomalies).

    The first option ends the stem; other lines after it belong to the option before them. Ids carry the
    chapter where a document has several.
    """
    w = Window.partitionBy("document_id", "section", "block").orderBy(*ORDER)
    rows = chapters.filter("kind = 'mcq' and block > 0").withColumn("_o", F.col("rest").rlike(P.OPTION)).withColumn("opt", F.sum(F.col("_o").cast("int")).over(w))
    rows = rows.withColumn("_l", F.when(F.col("_o"), F.regexp_extract("rest", P.OPTION, 1))).withColumn("rest", F.when(F.col("_o"), strip(F.regexp_extract("rest", P.OPTION, 2))).otherwise(F.col("rest")))
    part = rows.groupBy("document_id", "section", "block", "opt").agg(
        F.max("_l").alias("olabel"),
        F.collect_list(F.when(F.col("rest") != "", F.struct("page", "idx", "rest"))).alias("items"),
        F.collect_set(F.when((F.col("rest") != "") | F.col("_o"), F.col("page"))).alias("pages"),
        F.max("number").alias("number"), F.max("chapter").alias("chapter"), F.max("label").alias("label"), F.bool_or("grouped").alias("grouped"),
    )
    q = part.groupBy("document_id", "section", "block").agg(
        F.max("number").alias("number"), F.max("chapter").alias("chapter"), F.max("label").alias("label"), F.bool_or("grouped").alias("grouped"),
        F.max(F.when(F.col("opt") == 0, _joined(F.col("items")))).alias("question_text"),
        F.array_sort(F.collect_list(F.when(F.col("opt") > 0, F.struct("opt", F.col("olabel").alias("label"), _joined(F.col("items")).alias("text"))))).alias("o"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("pages")))).alias("pages"),
    )
    many = F.max("chapter").over(Window.partitionBy("document_id", "section")) > 1
    middle = F.when(many, F.concat(F.coalesce(slug(F.col("label")), F.concat(F.lit("g"), (F.col("chapter") - 1).cast("string"))), F.lit("-"))).otherwise("")
    labels = F.transform("o", lambda x: F.lower(x["label"]))
    odd = ~((F.size("o") == 4) | (F.array_join(labels, "") == "abcde"))
    return q.select(
        F.concat("document_id", F.lit("-mcq-"), middle, "number").alias("question_id"), "document_id", "section", "block", "grouped", "chapter", "label", "number", F.coalesce("question_text", F.lit("")).alias("question_text"),
        F.transform("o", lambda x: F.struct(x["label"].alias("label"), x["text"].alias("text"))).alias("options"), "pages",
        F.when(odd, F.array(F.concat(F.lit("unexpected_option_count:"), F.size("o").cast("string")))).otherwise(F.array().cast("array<string>")).alias("anomalies"),
    )


def fill_in_records(blocks: DataFrame) -> DataFrame:
    """(question_id, document_id, section, block, number, question_text, pages) of fill-in questions."""
    q = blocks.filter("kind = 'fill_in_blank' and block > 0").groupBy("document_id", "section", "block").agg(F.max("number").alias("number"), _joined(F.collect_list(F.when(F.col("rest") != "", F.struct("page", "idx", "rest")))).alias("question_text"), F.array_sort(F.collect_set("page")).alias("pages"))
    return q.select(F.concat("document_id", F.lit("-fib-"), "number").alias("question_id"), "document_id", "section", "block", "number", "question_text", "pages")


def matching_records(blocks: DataFrame) -> DataFrame:
    """(question_id, document_id, section, block, number, question_text, pairs, pages, anomalies) of matching questions.

    A fold over the block's lines: a number line waits for a letter line; a second number line while one
    waits is dropped; plain lines join the stem until the first pair; what still waits is an anomaly.
    """
    item = F.struct("page", "idx", "is_stem", "rest")
    q = blocks.filter("kind = 'matching' and block > 0").groupBy("document_id", "section", "block").agg(F.max("number").alias("number"), F.array_sort(F.collect_list(item)).alias("items"), F.array_sort(F.collect_set(F.when(F.col("rest") != "", F.col("page")))).alias("pages"))
    pair = "struct<left_label:string,left_text:string,right_label:string,right_text:string>"
    start = F.struct(F.lit("").alias("stem"), F.array().cast(f"array<{pair}>").alias("pairs"), F.lit(None).cast("string").alias("n"), F.lit(None).cast("string").alias("t"))
    left, right = r"(?U)^(\d{1,2})\s*[-.)]\s*(.*)$", r"(?U)^([A-Za-z])\s*[-.)]\s*(.*)$"

    def step(acc: Column, x: Column) -> Column:
        s, waits = x["rest"], acc["n"].isNotNull()
        skip = s.isin("(A)", "(B)", "")
        number = ~skip & s.rlike(left) & ~waits
        letter = ~skip & s.rlike(right) & waits
        plain = ~skip & ~number & ~letter & (F.size(acc["pairs"]) == 0) & ~waits
        made = F.struct(acc["n"].alias("left_label"), acc["t"].alias("left_text"), F.upper(F.regexp_extract(s, right, 1)).alias("right_label"), strip(F.regexp_extract(s, right, 2)).alias("right_text"))
        return F.struct(
            F.when(plain, F.concat_ws(" ", F.nullif(acc["stem"], F.lit("")), s)).otherwise(acc["stem"]).alias("stem"),
            F.when(letter, F.concat(acc["pairs"], F.array(made))).otherwise(acc["pairs"]).alias("pairs"),
            F.when(letter, F.lit(None)).when(number, F.regexp_extract(s, left, 1)).otherwise(acc["n"]).alias("n"),
            F.when(letter, F.lit(None)).when(number, strip(F.regexp_extract(s, left, 2))).otherwise(acc["t"]).alias("t"),
        )

    q = q.withColumn("r", F.aggregate("items", start, step))
    return q.select(F.concat("document_id", F.lit("-match-"), "number").alias("question_id"), "document_id", "section", "block", "number", F.col("r.stem").alias("question_text"), F.col("r.pairs").alias("pairs"), "pages", F.when(F.col("r.n").isNotNull(), F.array(F.concat(F.lit("unpaired_left_item:"), "r.n"))).otherwise(F.array().cast("array<string>")).alias("anomalies"))
