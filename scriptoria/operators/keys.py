"""Answer keys: tokens and entries by kind of section, conflicts, gaps, keys by chapter and matching keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptoria.functions import patterns as P
from scriptoria.functions.similarity import ratio
from scriptoria.functions.text import strip
from scriptoria.operators.lines import is_heading, label_key


def page_key_tokens(rows: DataFrame, pattern: str = P.KEY_TOKEN) -> DataFrame:
    """(document_id, section, page, ord, number, answer) of the key sections of a kind; an entry may span lines of a page."""
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "text"))), lambda x: x["text"]), " ")
    pages = rows.filter("is_key and kind = 'mcq' and not grouped").groupBy("document_id", "section", "page").agg(joined.alias("t"))
    pairs = F.arrays_zip(F.regexp_extract_all("t", F.lit(pattern), 1).alias("number"), F.regexp_extract_all("t", F.lit(pattern), 2).alias("answer"))
    return pages.select("document_id", "section", "page", F.posexplode(pairs).alias("ord", "x")).select("document_id", "section", "page", "ord", F.lower("x.number").alias("number"), F.lower("x.answer").alias("answer"))


def sequence_gaps(tokens: DataFrame) -> DataFrame:
    """(document_id, section, page, gap): the only number missing between the least and greatest of a page."""
    seen = tokens.filter(F.col("number").rlike(r"^\d+$")).groupBy("document_id", "section", "page").agg(F.collect_set(F.col("number").cast("int")).alias("s"))
    gaps = F.array_except(F.sequence(F.array_min("s"), F.array_max("s")), F.col("s"))
    return seen.filter(F.size("s") >= 2).withColumn("g", gaps).filter(F.size("g") == 1).select("document_id", "section", "page", F.col("g")[0].alias("gap"))


def _conflicts(shown: bool) -> Column:
    """The anomalies of an ordered list of a question's answers, one for each that differs from the one before."""
    return lambda a: F.transform(
        F.filter(F.sequence(F.lit(1), F.greatest(F.size(a) - 1, F.lit(1))), lambda i: F.get(a, i).isNotNull() & (F.get(a, i) != F.get(a, i - 1))),
        lambda i: F.concat(F.lit("conflicting_answer_key_value:"), F.get(a, i - 1), F.lit("_vs_"), F.get(a, i)) if shown else F.lit("conflicting_answer_key_value"),
    )


def final_answers(entries: DataFrame, key: list[str], shown: bool = True) -> DataFrame:
    """entries(key..., section, answer), one per section -> key + (source_answer, key_anomalies): the last section wins, each change is told."""
    got = entries.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct("section", "answer"))), lambda x: x["answer"]).alias("a"))
    return got.select(*key, F.element_at("a", -1).alias("source_answer"), _conflicts(shown)(F.col("a")).alias("key_anomalies"))


def numbered_entries(tokens: DataFrame) -> DataFrame:
    """(document_id, section, number, answer, page): in a section the last entry of a number wins silently."""
    return tokens.filter(F.col("number") != "so").groupBy("document_id", "section", "number").agg(F.max_by("answer", F.struct("page", "ord")).alias("answer"), F.max("page").alias("page"))


def fill_in_entries(rows: DataFrame, stem_pattern: str = P.STEM) -> DataFrame:
    """(document_id, section, number, answer, page): numbered texts of the key sections of fill-in questions; page is the section's first."""
    w = Window.partitionBy("document_id", "section").orderBy("page", "idx")
    key = rows.filter("is_key and kind = 'fill_in_blank'").withColumn("_s", F.col("text").rlike(stem_pattern)).withColumn("block", F.sum(F.col("_s").cast("int")).over(w)).withColumn("_p", F.first("page").over(w))
    key = key.withColumn("rest", F.when(F.col("_s"), strip(F.regexp_extract("text", stem_pattern, 2))).otherwise(F.col("text"))).withColumn("number", F.when(F.col("_s"), F.regexp_extract("text", stem_pattern, 1)))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("rest") != "", F.struct("page", "idx", "rest")))), lambda x: x["rest"]), " ")
    blocks = key.filter("block > 0").groupBy("document_id", "section", "block").agg(F.max("number").alias("number"), text.alias("answer"), F.max("_p").alias("page")).filter("answer <> ''")
    return blocks.groupBy("document_id", "section", "number").agg(F.max_by("answer", "block").alias("answer"), F.max("page").alias("page"))


def grouped_entries(rows: DataFrame, line_pattern: str = P.KEY_LINE, token_pattern: str = P.GROUPED_KEY_TOKEN, heading: Column | None = None) -> DataFrame:
    """(document_id, section, key_label, label_key, ord, number, answer, others, page) of the key sections of chapters.

    Lines made of key characters count for the heading before them, also across pages; an entry may span such
    lines. Those before the first heading are left out. A repeated number keeps its first answer, others are
    the later ones that differ. page is the section's first; ord the order of labels.
    """
    w = Window.partitionBy("document_id", "section").orderBy("page", "idx")
    key_line = F.col("text").rlike(line_pattern) & F.col("text").rlike("[0-9]")
    marked = rows.filter("is_key and grouped and kind = 'mcq'").withColumn("_k", key_line).withColumn("_l", F.when(~F.col("_k") & (is_heading(F.col("text")) if heading is None else heading), F.col("text")))
    marked = marked.withColumn("label", F.last("_l", True).over(w)).withColumn("run", F.count("_l").over(w)).withColumn("_p", F.first("page").over(w))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "idx", "text"))), lambda x: x["text"]), " ")
    runs = marked.filter("_k and label is not null").groupBy("document_id", "section", "run", "label").agg(text.alias("t"), F.max("_p").alias("page"))
    pairs = F.arrays_zip(F.regexp_extract_all("t", F.lit(token_pattern), 1).alias("number"), F.regexp_extract_all("t", F.lit(token_pattern), 2).alias("answer"))
    found = runs.select("document_id", "section", "page", F.col("label").alias("key_label"), label_key(F.col("label")).alias("label_key"), F.col("run").alias("r"), F.posexplode(pairs).alias("o", "x"))
    found = found.select("document_id", "section", "page", "key_label", "label_key", F.struct("r", "o").alias("at"), "x.number", F.lower(F.regexp_replace("x.answer", r"(?U)\s+", " ")).alias("answer"))
    out = found.groupBy("document_id", "section", "label_key", "number").agg(
        F.max("page").alias("page"), F.min("at").alias("at"), F.min_by("answer", "at").alias("answer"), F.transform(F.array_sort(F.collect_list(F.struct("at", "key_label", "answer"))), lambda x: F.struct(x["key_label"].alias("label"), x["answer"].alias("answer"))).alias("all"),
    )
    names = found.groupBy("document_id", "section", "label_key").agg(F.min_by("key_label", "at").alias("key_label"), F.min("at").alias("first"))
    out = out.join(names, ["document_id", "section", "label_key"])
    return out.select("document_id", "section", "key_label", "label_key", F.col("first.r").alias("ord"), "number", "answer", F.filter("all", lambda x: x["answer"] != F.col("answer")).alias("others"), "page")


def match_labels(key_labels: DataFrame, content_labels: DataFrame, least: float = 0.85) -> DataFrame:
    """(document_id, label_key, content_key, score): each key group's chapter, equal or the most similar one.

    Both sides have (document_id, label_key); labels of one document meet each other only, and of equal scores
    the first in order stands.
    """
    a = key_labels.select("document_id", "label_key").distinct()
    b = content_labels.select("document_id", F.col("label_key").alias("content_key")).distinct()
    equal = a.join(b, (a.document_id == b.document_id) & (a.label_key == b.content_key)).select(a.document_id, "label_key", "content_key", F.lit(1.0).alias("score"))
    rest = a.join(equal.select("document_id", "label_key"), ["document_id", "label_key"], "left_anti")
    near = rest.join(b, "document_id").withColumn("score", ratio("label_key", "content_key")).filter(F.col("score") >= least)
    best = near.groupBy("document_id", "label_key").agg(F.min(F.struct((-F.col("score")).alias("s"), "content_key")).alias("x"))
    return equal.unionByName(best.select("document_id", "label_key", "x.content_key", (-F.col("x.s")).alias("score")))


def matching_batches(rows: DataFrame) -> DataFrame:
    """(document_id, section, batch, grps, tokens, page) of the key sections of matching questions.

    Entries of a page are read as one text; a marker (n) after pairs begins a batch, several markers in a row
    share one. Pairs before any marker belong to no batch.
    """
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "text"))), lambda x: x["text"]), " ")
    pages = rows.filter("is_key and kind = 'matching'").groupBy("document_id", "section", "page").agg(joined.alias("t"))
    part = lambda k: F.regexp_extract_all("t", F.lit(P.MATCHING_TOKEN), k)
    tokens = pages.select("document_id", "section", "page", F.posexplode(F.arrays_zip(part(1).alias("g"), part(2).alias("n"), part(3).alias("l"))).alias("o", "x"))
    w = Window.partitionBy("document_id", "section").orderBy("page", "o")
    marker = F.col("x.g") != ""
    tokens = tokens.withColumn("_m", marker).withColumn("batch", F.sum((marker & ~F.coalesce(F.lag("_m").over(w), F.lit(False))).cast("int")).over(w)).withColumn("_p", F.first("page").over(w))
    in_order = lambda c, v: F.transform(F.array_sort(F.collect_list(F.when(c, F.struct("page", "o", v.alias("v"))))), lambda x: x["v"])
    out = tokens.groupBy("document_id", "section", "batch").agg(F.array_distinct(in_order(F.col("_m"), F.col("x.g"))).alias("grps"), in_order(~F.col("_m"), F.concat("x.n", F.lit("-"), F.upper("x.l"))).alias("tokens"), F.min("_p").alias("page"))
    return out.filter((F.size("grps") > 0) & (F.size("tokens") > 0))


def matching_entries(rows: DataFrame, questions: DataFrame) -> DataFrame:
    """(document_id, section, grp, question_id, answer, ambiguous, page): a key's n-th group is the n-th matching
    question by number; question_id is null where there is none."""
    w = Window.partitionBy("document_id").orderBy(F.asc_nulls_last(F.when(F.col("number").rlike("^[0-9]+$"), F.col("number").try_cast("bigint"))), "section", "block")
    ranked = questions.select("document_id", "question_id", F.row_number().over(w).cast("string").alias("grp"), F.size("pairs").alias("n"))
    batches = matching_batches(rows).withColumn("batch_id", F.concat_ws("/", "document_id", "section", "batch"))
    slots = batches.select("document_id", "batch_id", F.posexplode("grps").alias("i", "grp")).join(ranked.select("document_id", "grp", "n"), ["document_id", "grp"], "left")
    slots = slots.groupBy("batch_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "grp", "n"))), lambda x: F.struct(x["grp"].alias("grp"), x["n"].alias("n"))).alias("expected"))
    given = round_robin_key(batches.join(slots, "batch_id")).filter("answer <> ''").join(batches.select("batch_id", "document_id", "section", "batch", "page"), "batch_id")
    whole = given.groupBy("document_id", "section", "grp").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("batch", "answer"))), lambda x: x["answer"]), ",").alias("answer"), F.bool_or("ambiguous").alias("ambiguous"), F.min("page").alias("page"))
    return whole.join(ranked.select("document_id", "grp", "question_id"), ["document_id", "grp"], "left").select("document_id", "section", "grp", "question_id", "answer", "ambiguous", "page")


def round_robin_key(batches: DataFrame) -> DataFrame:
    """batches(batch_id, expected array<struct<grp, n>>, tokens array<string>) -> (batch_id, grp, answer, ambiguous).

    Tokens go round the groups, skipping full ones; when all are full the current one takes the rest. A
    group without expected number takes five. Fewer tokens than expected make every group ambiguous.
    """
    slots = F.transform("expected", lambda g: F.struct(g["grp"].alias("grp"), F.coalesce(g["n"], F.lit(5)).alias("n"), F.array().cast("array<string>").alias("got")))
    start = F.struct(slots.alias("s"), F.lit(0).alias("at"))

    def step(acc: Column, token: Column) -> Column:
        s, n = acc["s"], F.greatest(F.size(acc["s"]), F.lit(1))
        order = F.transform(F.sequence(F.lit(0), n - 1), lambda k: (acc["at"] + k) % n)
        free = F.filter(order, lambda k: F.size(F.get(s, k)["got"]) < F.get(s, k)["n"])
        to = F.coalesce(F.get(free, F.lit(0)), acc["at"] % n)
        put = F.transform(s, lambda x, i: F.struct(x["grp"].alias("grp"), x["n"].alias("n"), F.when(i == to, F.concat(x["got"], F.array(token))).otherwise(x["got"]).alias("got")))
        return F.struct(put.alias("s"), ((to + 1) % n).alias("at"))

    short = F.size("tokens") < F.aggregate("expected", F.lit(0), lambda a, g: a + F.coalesce(g["n"], F.lit(5)))
    done = batches.filter(F.size("expected") > 0).select("batch_id", short.alias("ambiguous"), F.aggregate("tokens", start, step, lambda acc: acc["s"]).alias("s"))
    return done.select("batch_id", F.explode("s").alias("x"), "ambiguous").select("batch_id", "x.grp", F.array_join("x.got", ",").alias("answer"), "ambiguous")


def answers_not_in_options(questions: DataFrame) -> DataFrame:
    """Questions with bad_letters: parts of the answer that are no option label."""
    parts = F.filter(F.transform(F.split("source_answer", "[&,]"), lambda x: F.lower(F.trim(x))), lambda x: x != "")
    labels = F.transform("options", lambda o: F.lower(o["label"]))
    return questions.withColumn("bad_letters", F.when(F.col("source_answer").isNotNull(), F.array_except(parts, labels)))
