"""What surrounds transcription, review and checks: what is pending, how outcomes are judged, what has changed.

The models themselves are functions to plug in; these operators prepare their input and read their replies.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptoria.functions import replies
from scriptoria.operators import dedupe, quality

#: What a suffix tells a model service about an image.
MEDIA_TYPES = {"png": "image/png", "jpg": "image/jpeg", "jpeg": "image/jpeg", "webp": "image/webp", "gif": "image/gif"}


def media_type(path: Column) -> Column:
    """The media type of an image by its suffix, png where it is another."""
    known = F.create_map(*[F.lit(x) for kv in MEDIA_TYPES.items() for x in kv])
    return F.coalesce(known[F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))], F.lit("image/png"))


def pending_pages(pages: DataFrame, force: bool = False) -> DataFrame:
    """Pages that wait for transcription and have an image; with force all that have one."""
    image = F.coalesce(F.trim("rendered_image_path") != "", F.lit(False))
    return pages.filter(image & ((F.col("extraction_method") == "pending_vision") | F.lit(force)))


def transcription_outcome(pages: DataFrame) -> DataFrame:
    """pages with outcome, outcome_reason, outcome_confidence: garbled by the gate of short texts, then repeated content, else clean."""
    base = quality.assess(pages, min_chars=5)
    said = dedupe.repeated_blocks(pages, ["document_id", "page"]).withColumn("again", F.concat(F.lit("repeated_content:"), "first_block", F.lit("_"), "second_block")).select("document_id", "page", "again")
    out = base.join(said, ["document_id", "page"], "left")
    reason = F.coalesce("q_reason", "again")
    return out.withColumn("outcome", F.when(F.col("q_reason").isNotNull(), "garbled").when(F.col("again").isNotNull(), "repeated").otherwise("clean")).withColumn("outcome_reason", reason).withColumn("outcome_confidence", F.when(reason.isNotNull(), F.lit(0.3)).otherwise(F.col("q_confidence"))).drop("again", "q_reason", "q_kind", "q_chars", "q_confidence")


def question_images(questions: DataFrame, pages: DataFrame) -> DataFrame:
    """(question_id, document_id, page, image): the image of the first page of each question, distinct; null where there is none."""
    q = questions.select("question_id", "document_id", F.try_element_at(F.try_element_at("source_spans", F.lit(1))["pages"], F.lit(1)).alias("page")).distinct()
    images = pages.groupBy("document_id", "page").agg(F.min(F.nullif(F.trim("rendered_image_path"), F.lit(""))).alias("image"))
    return q.join(images, ["document_id", "page"], "left").select("question_id", "document_id", "page", "image")


def input_hash(text: Column, options: Column, answer: Column) -> Column:
    """A hash of what a check reads: text, options in order, answer; null counts as empty."""
    said = lambda c: F.coalesce(c, F.lit(""))
    listed = F.array_join(F.transform(options, lambda o: F.concat_ws("\x1e", said(o["label"]), said(o["text"]))), "\x1d")
    return F.sha1(F.concat_ws("\x1f", said(text), said(listed), said(answer)))


def check_states(exports: DataFrame) -> DataFrame:
    """(question_id, contents, checked, state): contents counts the different inputs of a question's exports."""
    h = input_hash(F.col("question_text"), F.col("options"), F.col("source_answer"))
    seen = exports.select("question_id", h.alias("h"), F.col("check_agrees").isNotNull().alias("c")).groupBy("question_id").agg(F.countDistinct("h").alias("contents"), F.bool_or("c").alias("checked"))
    return seen.withColumn("state", F.when(~F.col("checked"), "unchecked").when(F.col("contents") > 1, "changed").otherwise("current"))


def model_stats(reviews: DataFrame) -> DataFrame:
    """(model, reviews, with_confidence, mean_per_mille, agreed), one row per model."""
    mean = F.round(1000 * F.avg("ai_confidence")).cast("bigint")
    return reviews.groupBy(F.coalesce("ai_model_used", F.lit("")).alias("model")).agg(F.count(F.lit(1)).alias("reviews"), F.count("ai_confidence").alias("with_confidence"), mean.alias("mean_per_mille"), F.count(F.when(F.col("check_agrees"), 1)).alias("agreed"))


def structure_changes(exports: DataFrame) -> DataFrame:
    """(question_id, exports, changes): different exports of each question, and how many differ from its first in options or pairs."""
    e = exports.select("question_id", "exported_at", "options", "matching_pairs").distinct().withColumn("s", F.struct("options", "matching_pairs"))
    first = e.groupBy("question_id").agg(F.min_by("s", F.struct("exported_at", F.xxhash64("s"))).alias("f"))
    met = e.join(first, "question_id")
    return met.groupBy("question_id").agg(F.count(F.lit(1)).alias("exports"), F.count(F.when(~F.col("s").eqNullSafe(F.col("f")), 1)).alias("changes"))


def merge_concerns(reviews: DataFrame) -> DataFrame:
    """reviews(confidence, concerns, notes, flags) with the structural flags added to the concerns, once each; with any
    flag the confidence is at most 0.2 and an empty note is filled."""
    some = F.size(F.coalesce("flags", F.array().cast("array<string>"))) > 0
    none = F.array().cast("array<string>")
    out = reviews.withColumn("concerns", F.concat(F.coalesce("concerns", none), F.array_except(F.coalesce("flags", none), F.coalesce("concerns", none))))
    return out.withColumn("confidence", F.when(some, F.least("confidence", F.lit(0.2))).otherwise(F.col("confidence"))).withColumn("notes", F.when(some & (F.coalesce(F.trim("notes"), F.lit("")) == ""), F.concat(F.lit("structural: "), F.array_join("flags", ", "))).otherwise(F.col("notes")))


def question_prompt(text: Column, options: Column, answer: Column | None = None) -> Column:
    """What a model is asked about a question: its text, its options line by line, the answer if there is one."""
    listed = F.array_join(F.transform(options, lambda o: F.concat(o["label"], F.lit(") "), o["text"])), "\n")
    parts = [F.concat(F.lit("Question: "), F.coalesce(text, F.lit(""))), F.nullif(listed, F.lit(""))]
    return F.concat_ws("\n", *parts, *([F.when(answer.isNotNull(), F.concat(F.lit("Answer: "), answer))] if answer is not None else []))


def ask(rows: DataFrame, prompt: str, model: Callable[[str], str], reply: str = "reply") -> DataFrame:
    """rows with the model's reply to the column prompt and the error of a call that failed; a failure costs its row only."""

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            said, error = [], []
            for p in b[prompt]:
                try:
                    said.append(model(p))
                    error.append(None)
                except Exception as e:
                    said.append(None)
                    error.append(f"{type(e).__name__}: {e}")
            yield b.assign(**{reply: said, "error": error})

    kinds = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes)
    return rows.mapInPandas(call, f"{kinds}, {reply} string, error string")


def probe_checker(questions: DataFrame, model: Callable[[str], str]) -> DataFrame:
    """(question_id, injected, given, agrees): each question with its key and with a wrong one, and whether the checker agrees.

    The wrong key is the label after the right one. A reply that can't be used leaves agrees null.
    """
    wrong = replies.cyclic_wrong_answer(F.col("options"), F.col("source_answer"))
    cases = F.array(F.struct(F.lit(False).alias("injected"), F.col("source_answer").alias("given")), F.struct(F.lit(True).alias("injected"), wrong.alias("given")))
    rows = questions.select("question_id", "question_text", "options", F.explode(cases).alias("c")).select("question_id", "question_text", "options", "c.*").filter("given is not null")
    asked = ask(rows.withColumn("prompt", question_prompt(F.col("question_text"), F.col("options"), F.col("given"))).select("question_id", "injected", "given", "prompt", F.to_json("options").alias("o")), "prompt", model)
    back = asked.withColumn("options", F.from_json("o", "array<struct<label:string,text:string>>"))
    return back.select("question_id", "injected", "given", replies.normalize_verdict(F.col("reply"), F.col("options"), F.col("given"))["agrees"].alias("agrees"))


def caught_rate(probes: DataFrame) -> DataFrame:
    """(usable, caught, false_alarms): of the usable replies, the share of wrong keys that were told and of right keys that were doubted."""
    return probes.filter("agrees is not null").agg(F.count(F.lit(1)).alias("usable"), F.avg(F.when(F.col("injected"), (~F.col("agrees")).cast("double"))).alias("caught"), F.avg(F.when(~F.col("injected"), (~F.col("agrees")).cast("double"))).alias("false_alarms"))


def excerpt_lines(lines: DataFrame, around: DataFrame, reach: int, budget: int, width: int = 150) -> DataFrame:
    """(document_id, page, idx, line): windows of `reach` lines on both sides of landmarks, merged, in order, as far as the budget of characters goes.

    around(document_id, page, idx) are the landmarks. A line is shown as reference and text, cut at width.
    """
    from pyspark.sql import Window

    w = Window.partitionBy("document_id").orderBy("page", "idx")
    rows = lines.join(around.select("document_id", "page", "idx", F.lit(1).alias("_mark")).distinct(), ["document_id", "page", "idx"], "left")
    near = F.max("_mark").over(w.rowsBetween(-reach, reach))
    shown = F.concat(F.lit("p"), F.col("page").cast("string"), F.lit(":"), F.col("idx").cast("string"), F.lit("| "), F.when(F.length("text") > width, F.concat(F.substring("text", 1, width - 1), F.lit("…"))).otherwise(F.col("text")))
    rows = rows.withColumn("_near", near).filter("_near = 1").withColumn("line", shown)
    return rows.withColumn("_sum", F.sum(F.length("line") + 1).over(w.rowsBetween(Window.unboundedPreceding, 0))).filter(F.col("_sum") <= budget).select("document_id", "page", "idx", "line")


def last_signatures(outcomes: DataFrame, keep: int = 8) -> DataFrame:
    """outcomes(profile_id, at, verdict, signature) -> (profile_id, signatures): the last `keep` different signatures of passed documents, oldest first."""
    seen = outcomes.filter("verdict = 'pass'").groupBy("profile_id", "signature").agg(F.max("at").alias("at"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("at", "signature"))), lambda x: x["signature"])
    return seen.groupBy("profile_id").agg(ordered.alias("s")).select("profile_id", F.slice("s", F.greatest(F.size("s") - (keep - 1), F.lit(1)), keep).alias("signatures"))
