"""Filters stated as data: clauses of field, operator and value, combined per field and over all fields."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import IllegalArgumentException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions.fields import is_blank, maybe_number, rule_value, text_of

#: Operators that need no value.
UNARY = ("is_empty", "not_empty")
_COMPARED = {"gt": "__gt__", "gte": "__ge__", "lt": "__lt__", "lte": "__le__"}


def _number(value: object) -> float | None:
    text = str(value).strip()
    return float(text) if re.fullmatch(r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?", text) else None


class PatternError(ValueError):
    """A regular expression that the engine can't read."""


def check_pattern(pattern: str) -> None:
    """Raises PatternError where Java, whose dialect the filters follow, can't compile a pattern."""
    jvm = SparkSession.active().sparkContext._jvm
    try:
        jvm.java.util.regex.Pattern.compile(f"(?i){pattern}")
    except IllegalArgumentException as e:
        raise PatternError(f"{pattern!r}: {str(e).splitlines()[0]}") from e


def broken_patterns(groups: Mapping[str, Mapping]) -> dict[str, str]:
    """field: what is wrong, for the fields of grouped() with a regular expression that can't be read."""
    out = {}
    for field, group in groups.items():
        for c in cleaned(group["clauses"]):
            if c["operator"] == "regex":
                try:
                    check_pattern(c["value"])
                except PatternError as e:
                    out[field] = str(e)
    return out


def condition(x: Column, operator: str, expected: object = "") -> Column:
    """Whether a value meets one clause; never null. An unknown operator means contains; a broken pattern raises PatternError."""
    wanted = "" if expected is None else str(expected)
    text, low = rule_value(x), wanted.strip().lower()
    number = _number(wanted)
    if operator == "is_empty":
        return is_blank(x)
    if operator == "not_empty":
        return ~is_blank(x)
    if operator in _COMPARED:
        if number is None:
            return F.lit(False)
        return F.coalesce(getattr(maybe_number(x), _COMPARED[operator])(F.lit(number)), F.lit(False))
    if operator in ("eq", "neq"):
        same = text == low
        if number is not None:
            same = F.coalesce(maybe_number(x) == F.lit(number), same)
        return same if operator == "eq" else ~same
    if operator == "starts_with":
        return F.startswith(text, F.lit(low))
    if operator == "ends_with":
        return F.endswith(text, F.lit(low))
    if operator == "regex":
        check_pattern(wanted)
        return F.coalesce(text_of(x), F.lit("")).rlike(f"(?i){wanted}")
    inside = F.contains(text, F.lit(low))
    return ~inside if operator == "not_contains" else inside


def cleaned(clauses: Sequence[Mapping]) -> list[dict]:
    """Clauses without blank values (unless they need none) and without repeats."""
    out, seen = [], set()
    for c in clauses:
        operator, value = c.get("operator", "contains"), str(c.get("value") or "")
        key = (operator, value.strip().lower())
        if (value.strip() or operator in UNARY) and key not in seen:
            seen.add(key)
            out.append({"operator": operator, "value": value})
    return out


def combined(parts: Sequence[Column], mode: str) -> Column:
    return reduce((lambda a, b: a | b) if mode == "or" else (lambda a, b: a & b), parts) if parts else F.lit(True)


def grouped(groups: Mapping[str, Mapping], mode: str = "and", without: str | None = None) -> Column:
    """{field: {mode, clauses}} as one condition; `without` leaves a field out, as its own facet asks."""
    parts = []
    for field, group in groups.items():
        clauses = cleaned(group["clauses"])
        if clauses and field != without:
            parts.append(combined([condition(F.col(field), c["operator"], c["value"]) for c in clauses], group.get("mode", "and")))
    return combined(parts, mode)


def quick_filtered(df: DataFrame, steps: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that pass every step, and one row: total and how many each step in turn removes."""
    passed, counts = F.lit(True), [F.count("*").alias("total")]
    for name, ok in steps.items():
        ok = F.coalesce(ok, F.lit(False))
        counts.append(F.count_if(passed & ~ok).alias(name))
        passed = passed & ok
    return df.filter(passed), df.agg(*counts)


def suggestion_score(text: Column, query: str) -> Column:
    """How well a facet value fits what was typed: exact, prefix, word start, inside, in order; -1 for none."""
    q, t = query.strip().lower(), F.lower(F.trim(text))
    if not q:
        return F.lit(500)
    at = F.instr(t, q) - 1
    word = F.regexp_instr(t, F.lit(rf"(?<=[^a-z0-9]){re.escape(q)}")) - 1
    scattered = t.rlike(".*".join(map(re.escape, q)))
    return F.when(t == q, 2000).when(F.startswith(t, F.lit(q)), 1500 - F.least(F.lit(300), F.char_length(t) - len(q))).when(word > 0, 1300 - word).when(at >= 0, 1100 - at).when(scattered, 900).otherwise(-1)


def facet(df: DataFrame, field: str, groups: Mapping[str, Mapping], query: str = "", mode: str = "and", most: int = 20) -> DataFrame:
    """field, n, score: values under all other fields' filters, best first."""
    counts = df.filter(grouped(groups, mode, field)).filter(~is_blank(F.col(field))).groupBy(F.col(field).cast("string").alias(field)).agg(F.count("*").alias("n"))
    scored = counts.withColumn("score", suggestion_score(F.col(field), query)).filter("score >= 0")
    return scored.orderBy(F.desc("score"), F.desc("n"), F.char_length(field), field).limit(most)
