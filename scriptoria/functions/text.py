"""Column expressions on text and keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The characters that count as blanks around a key.
BLANKS = " \t\n\r\x0b\x0c   　​﻿"


def clean_key(c: Column) -> Column:
    """A key as it is compared: without outer blanks, in lower case; blank keys become null."""
    return F.nullif(F.lower(F.btrim(c, F.lit(BLANKS))), F.lit(""))


def words(c: Column) -> Column:
    """Maximal runs of letters or digits of any script, lower-cased; null text has none."""
    return F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(r"([\p{L}\p{N}]+)"), 1)


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def collapse(c: Column) -> Column:
    return F.regexp_replace(strip(c), r"(?U)\s+", " ")
