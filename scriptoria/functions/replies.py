"""Parsing of model replies, durations and budgets as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNITS = {"ms": 0.001, "s": 1.0, "m": 60.0, "h": 3600.0, "d": 86400.0}


def parse_duration(c: Column) -> Column:
    """Seconds of a text like 2m59.56s or 7; null for anything else."""
    pattern = r"(\d+(?:\.\d+)?)(ms|[smhd])"
    whole = F.trim(F.lower(c))
    numbers = F.regexp_extract_all(whole, F.lit(pattern), 1)
    units = F.regexp_extract_all(whole, F.lit(pattern), 2)
    factor = F.create_map(*[F.lit(x) for kv in UNITS.items() for x in kv])
    total = F.aggregate(F.zip_with(numbers, units, lambda n, u: n.cast("double") * factor[u]), F.lit(0.0), lambda a, x: a + x)
    return F.when(whole.rlike(r"^\d+(\.\d+)?$"), whole.try_cast("double")).when(whole.rlike(rf"^({pattern})+$"), total)


def estimate_tokens(c: Column) -> Column:
    """A third of the characters, at least 1."""
    return F.greatest(F.lit(1), F.floor(F.length(c) / 3).cast("int"))


def reply_json(c: Column) -> Column:
    """The outermost JSON object of a reply, without thinking blocks and code fences; null if there is none."""
    bare = F.regexp_replace(F.regexp_replace(c, r"(?is)<think>.*?</think>", ""), r"`{3,}\w*", "")
    found = F.regexp_extract(bare, r"(?s)(\{.*\})", 1)
    return F.nullif(found, F.lit(""))


def parse_review(c: Column) -> Column:
    """struct(confidence clamped to [0, 1], concerns, notes) of a review reply; null where it isn't JSON."""
    parsed = F.from_json(reply_json(c), "confidence double, concerns array<string>, notes string")
    confidence = F.least(F.greatest(parsed["confidence"], F.lit(0.0)), F.lit(1.0))
    return F.when(parsed["confidence"].isNotNull(), F.struct(confidence.alias("confidence"), F.coalesce(parsed["concerns"], F.array().cast("array<string>")).alias("concerns"), parsed["notes"].alias("notes")))


def normalize_verdict(reply: Column, options: Column, given: Column) -> Column:
    """struct(agrees, suggested, concerns): agreement is derived by comparing the suggestion with the given answer.

    A suggestion that is no option is dropped and told; without a usable suggestion the reply's own flag
    stands; a reply with neither is null, and the record stays unchecked.
    """
    v = F.from_json(reply_json(reply), "agrees boolean, suggested string, explanation string")
    labels = F.transform(options, lambda o: F.lower(F.trim(o["label"])))
    said = F.lower(F.nullif(F.trim(v["suggested"]), F.lit("")))
    valid = F.when(F.array_contains(labels, said), said)
    derived = F.when(valid.isNotNull(), valid == F.lower(F.trim(given))).otherwise(v["agrees"])
    concern = lambda cond, name: F.when(cond, F.array(F.lit(name))).otherwise(F.array().cast("array<string>"))
    concerns = F.concat(
        concern(said.isNotNull() & valid.isNull(), "suggested_answer_not_an_option"),
        concern(valid.isNotNull() & v["agrees"].isNotNull() & (derived != v["agrees"]), "agrees_flag_inconsistent"),
        concern(valid.isNull(), "no_valid_suggested_option"),
        concern(F.coalesce(F.trim(v["explanation"]), F.lit("")) == "", "missing_explanation"),
    )
    return F.when(derived.isNotNull(), F.struct(derived.alias("agrees"), valid.alias("suggested"), concerns.alias("concerns")))


def cyclic_wrong_answer(options: Column, given: Column) -> Column:
    """The label after the given one, the first after the last; null where the given one is no label."""
    labels = F.transform(options, lambda o: o["label"])
    at = F.array_position(labels, given)
    return F.when(at > 0, F.try_element_at(labels, (at % F.size(labels) + 1).cast("int")))
