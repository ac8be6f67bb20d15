"""Equal texts, repeated blocks, structural repetition and duplicate question numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptoria.functions.similarity import ratio, self_repeat_ratio
from scriptoria.functions.text import collapse
from scriptoria.operators.skew import salted_join


def exact_copies(df: DataFrame, id_col: str, content: Column) -> DataFrame:
    """(id, content_hash, keeper, copies): per row the least id with the same content and the copies' number.

    Counting and the least id are combined before the shuffle; the join back on the hash is salted.
    """
    hashed = df.select(F.col(id_col), F.sha2(content, 256).alias("content_hash")).filter("content_hash is not null")
    best = hashed.groupBy("content_hash").agg(F.min(id_col).alias("keeper"), F.count(F.lit(1)).alias("copies"))
    return salted_join(hashed, best, "content_hash").select(id_col, "content_hash", "keeper", "copies")


def repeated_blocks(df: DataFrame, keys: list[str], text: str = "text", separator: str = r"\n\s*\n", min_chars: int = 60, least: float | None = None) -> DataFrame:
    """keys + (first_block, second_block): the first pair of equal (or, with least, similar) long blocks of a text.

    Blocks pair only within their own text, as array expressions: no row is ever joined. With least set the
    pairs of different blocks are compared by similarity in Arrow batches after the equal ones.
    """
    long = F.filter(F.split(text, separator), lambda b: F.length(b) >= min_chars)
    blocks = F.filter(F.transform(long, collapse), lambda b: F.length(b) >= min_chars)
    rows = df.filter(F.col(text).isNotNull() & (F.length(text) >= 2 * min_chars)).select(*keys, blocks.alias("b")).filter(F.size("b") >= 2)
    numbered = F.transform("b", lambda x, i: F.struct(i.alias("i"), x.alias("x")))
    if least is None:
        rows = rows.filter(has_repeats(F.col("b")))
        firsts = F.transform(numbered, lambda p: F.struct((F.array_position(F.col("b"), p["x"]) - 1).cast("int").alias("i"), p["i"].alias("j")))
        hits = F.array_sort(F.filter(firsts, lambda p: p["i"] < p["j"]))
        return rows.withColumn("h", hits).filter(F.size("h") > 0).select(*keys, F.col("h")[0]["i"].alias("first_block"), F.col("h")[0]["j"].alias("second_block"))
    pairs = rows.select(*keys, F.explode(numbered).alias("p"), "b").select(*keys, "p", F.explode(F.transform("b", lambda x, i: F.struct(i.alias("i"), x.alias("x")))).alias("q")).filter("p.i < q.i")
    near = pairs.withColumn("r", ratio("p.x", "q.x")).filter(F.col("r") >= least)
    first = near.groupBy(*keys).agg(F.min(F.struct(F.col("p.i").alias("i"), F.col("q.i").alias("j"))).alias("m"))
    return first.select(*keys, F.col("m.i").alias("first_block"), F.col("m.j").alias("second_block"))


def has_repeats(items: Column) -> Column:
    return F.size(F.array_distinct(items)) < F.size(items)


def structural_flags(questions: DataFrame) -> DataFrame:
    """(question_id, option_labels_repeat, left_labels_repeat, right_labels_repeat), as written, distinct."""
    low = lambda c: F.transform(c, lambda x: F.lower(F.trim(x)))
    return questions.select(
        "question_id", F.coalesce(has_repeats(low("options.label")), F.lit(False)).alias("option_labels_repeat"),
        F.coalesce(has_repeats(low("matching_pairs.left_label")), F.lit(False)).alias("left_labels_repeat"), F.coalesce(has_repeats(low("matching_pairs.right_label")), F.lit(False)).alias("right_labels_repeat"),
    ).distinct()


def doubled_texts(questions: DataFrame, least: float = 0.85) -> DataFrame:
    """(question_id, repeat_ratio) of texts whose second half says the first again."""
    return questions.select("question_id", self_repeat_ratio(least)("question_text").alias("repeat_ratio")).filter(F.col("repeat_ratio") >= least).distinct()


def resolve_duplicates(questions: DataFrame, least: float = 0.85) -> DataFrame:
    """Records with every question_id once per document; questions needs question_id, document_id, section, block,
    number, question_text, pages and anomalies, and keeps its other columns. copy_of is the number of a conflicting copy.

    Copies of an id at least `least` similar to the first merge into it, with the union of the pages; others
    stay as id~conflictK, both sides naming each other. Records whose id is alone are not compared.
    """
    w = Window.partitionBy("document_id", "question_id").orderBy("section", "block")
    every = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = questions.withColumn("_k", F.row_number().over(w)).withColumn("_n", F.count(F.lit(1)).over(every)).withColumn("_first", F.first("question_text").over(w))
    alone = rows.filter("_n = 1").withColumn("copy_of", F.lit(None).cast("string"))
    many = rows.filter("_n > 1").withColumn("_sim", F.coalesce(ratio("_first", "question_text"), F.lit(0.0)))
    many = many.withColumn("_merged", (F.col("_k") > 1) & (F.col("_sim") >= least)).withColumn("_c", F.sum(((F.col("_k") > 1) & ~F.col("_merged")).cast("int")).over(w))
    clash = (F.col("_k") > 1) & ~F.col("_merged")
    many = many.withColumn("_shown", F.format_string("%.2f", "_sim")).withColumn("_new", F.when(clash, F.concat("question_id", F.lit("~conflict"), "_c")).otherwise(F.col("question_id")))
    told = lambda other: F.concat(F.lit("duplicate_question_number_conflict:sim_"), "_shown", F.lit(":conflicts_with="), other)
    note = F.when(F.col("_merged"), F.concat(F.lit("duplicate_question_merged:sim_"), "_shown")).when(clash, told(F.col("_new")))
    many = many.withColumn("_note", note).withColumn("_notes", F.transform(F.array_sort(F.collect_list(F.when(F.col("_note").isNotNull(), F.struct("_k", "_note"))).over(every)), lambda x: x["_note"]))
    many = many.withColumn("_pages", F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.when(~clash, F.col("pages"))).over(every)))))
    many = many.filter("not _merged").withColumn("anomalies", F.concat("anomalies", F.when(clash, F.array(told(F.col("question_id")))).otherwise(F.col("_notes"))))
    many = many.withColumn("pages", F.when(clash, F.col("pages")).otherwise(F.col("_pages"))).withColumn("copy_of", F.when(clash, F.col("number")))
    many = many.withColumn("number", F.when(clash, F.concat("number", F.lit("~conflict"), "_c")).otherwise(F.col("number"))).withColumn("question_id", F.col("_new"))
    cols = [*questions.columns, "copy_of"]
    return alone.select(*cols).unionByName(many.select(*cols))
