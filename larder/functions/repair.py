"""Repair of extracted text: bytes read in the wrong encoding, compatibility forms, invisible characters, punctuation of books."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from larder.functions.text import standard_whitespace

#: Fixed values, in this order: what UTF-8 looks like when read as Windows-1252, and what stands for it.
MOJIBAKE = (
    ("â€™", "'"), ("â€œ", '"'), ("â€\u009d", '"'), ("â€“", "-"), ("â€”", "-"), ("Â", " "),
    ("â€¦", "..."), ("Ã©", "é"), ("Ã¨", "è"), ("Ã®", "î"), ("Ã", "à"),
)
#: Punctuation of books as plain characters, and fractions.
PUNCTUATION = {"“": '"', "”": '"', "‘": "'", "’": "'", "–": "-", "—": "-", "⁄": "/"}
FRACTIONS = {"½": "1/2", "⅓": "1/3", "⅔": "2/3", "¼": "1/4", "¾": "3/4", "⅛": "1/8", "⅜": "3/8", "⅝": "5/8", "⅞": "7/8"}
INVISIBLE = "[­​‌‍⁠﻿]"


def fix_mojibake(x: Column) -> Column:
    for bad, good in MOJIBAKE:
        x = F.replace(x, F.lit(bad), F.lit(good))
    return x


@F.pandas_udf(StringType())
def _compatible(x: pd.Series) -> pd.Series:
    return x.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFKC", t))


def compatible(x: Column) -> Column:
    """The compatibility form (NFKC), by a vectorised function: Spark has no expression for it. ASCII texts come back as they are."""
    return _compatible(x)


def normalised(x: Column) -> Column:
    """Mojibake repaired, compatibility forms, white space standardised; empty for null."""
    return standard_whitespace(compatible(fix_mojibake(F.coalesce(x, F.lit("")))))


def book_text(x: Column) -> Column:
    """normalised(), and without invisible characters, with plain punctuation and written-out fractions."""
    t = F.regexp_replace(fix_mojibake(F.coalesce(x, F.lit(""))), INVISIBLE, "")
    for table in (PUNCTUATION, FRACTIONS):
        for bad, good in table.items():
            t = F.replace(t, F.lit(bad), F.lit(good))
    t = F.replace(F.regexp_replace(compatible(t), INVISIBLE, ""), F.lit("⁄"), F.lit("/"))
    return standard_whitespace(t)
