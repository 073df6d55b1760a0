"""Recipes in the blocks of a book: where each begins and ends. One book's blocks are one task's list."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.recipes import line_kind, starts_with_quantity
from larder.functions.text import title_like
from larder.operators.folds import per_sequence

FLAGS = ("is_yield", "is_time", "ingredients", "section", "variation", "title", "ingredient", "instruction", "excluded")


@dataclass(frozen=True)
class Reach:
    """How far to look back for a title from a yield and from a heading of ingredients, how long a title may be, and how many ingredients in a row make a run."""

    from_yield: int = 8
    from_header: int = 20
    title: int = 90
    run: int = 2
    within: int = 6


def flagged(blocks: DataFrame, key: str, order: str, text: str, level: str | None = None, excluded: str | None = None) -> DataFrame:
    """key, place (from 0), text and FLAGS: what the search for recipes looks at. level: a block's heading level, if known."""
    # A row works out its text, kind and lower case once, not for each flag; and after the shuffle, as a small file is read by few tasks.
    given = {"_level": F.col(level) if level else F.lit(None).cast("int"), "_excluded": F.col(excluded) if excluded else F.lit(False)}
    place = F.row_number().over(Window.partitionBy(key).orderBy(order)) - 1
    lines = blocks.select(key, place.cast("long").alias("place"), F.trim(F.coalesce(text, F.lit(""))).alias("text"), *(c.alias(n) for n, c in given.items()))
    lines = lines.withColumns({"_kind": line_kind(F.col("text")), "_low": F.regexp_replace(F.lower("text"), ":+$", "")})
    t, kind, low, depth = (F.col(c) for c in ("text", "_kind", "_low", "_level"))
    flags = {
        "is_yield": kind == "yield", "is_time": kind == "time", "ingredients": low.isin("ingredients", "ingredient"), "section": F.coalesce(depth == 1, F.lit(False)) | low.rlike(r"^(?:chapter|part)\s+(?:\d+|[ivxlc]+|one|two|three|four|five|six|seven|eight|nine|ten)\b"),
        "variation": low.rlike(r"^(?:variations?|variants?)\b.{0,30}$"), "title": (title_like(t) & (kind == "prose")) | F.coalesce(depth > 1, F.lit(False)), "ingredient": (kind == "ingredient") | (starts_with_quantity(t) & ~t.rlike("[.!?]$")),
        "instruction": kind.isin("instruction", "numbered"), "excluded": F.col("_excluded"),
    }
    return lines.select(key, "place", "text", *(F.coalesce(c, F.lit(False)).alias(n) for n, c in flags.items()))


#: A flag's bit in what _Book gets.
BITS = {f: 1 << i for i, f in enumerate(FLAGS)}
_STOPS, _PASSED = BITS["excluded"] | BITS["ingredients"] | BITS["section"], BITS["is_yield"] | BITS["is_time"]


class _Book:
    """One book's flags and lengths of texts, by place. rows: tuples that begin with the length and the flags' bits, in order."""

    def __init__(self, rows: list[tuple], reach: Reach):
        self.length, self.bits = [r[0] for r in rows], [r[1] for r in rows]
        self.n, self.reach = len(rows), reach

    def has(self, flag: str, i: int) -> bool:
        return bool(self.bits[i] & BITS[flag])

    def count(self, flag: str, start: int, end: int) -> int:
        return sum(1 for b in self.bits[start:end] if b & BITS[flag])

    def stops(self, i: int) -> bool:
        return bool(self.bits[i] & _STOPS)

    def passed(self, i: int) -> bool:
        return bool(self.bits[i] & _PASSED)

    def title_before(self, anchor: int, limit: int) -> int | None:
        """The nearest title before an anchor, from the first of adjoining ones; else the nearest short line that is neither ingredient nor instruction."""
        spare = None
        for i in range(anchor - 1, max(-1, anchor - limit - 1), -1):
            if self.stops(i):
                break
            if self.passed(i):
                continue
            if self.has("title", i):
                while i > max(0, anchor - limit) and self.has("title", i - 1) and not self.stops(i - 1) and not self.passed(i - 1):
                    i -= 1
                return i
            if spare is None and self.length[i] <= self.reach.title and not self.has("ingredient", i) and not self.has("instruction", i):
                spare = i
        return spare

    def begins_recipe(self, i: int) -> bool:
        """Whether a title has a run of ingredients close behind."""
        run = 0
        for j in range(i + 1, min(self.n, i + 1 + self.reach.within)):
            if self.has("title", j) and not self.has("title", j - 1):  # adjoining titles are one
                return False
            run = run + 1 if self.has("ingredient", j) else 0
            if run >= self.reach.run:
                return True
        return False

    def end_after(self, anchor: int) -> int:
        """Where the recipe of an anchor ends: at what is excluded, at a section, at the next recipe's title or ingredients; variations belong to it."""
        for i in range(anchor + 1, self.n):
            if self.has("excluded", i) or (self.has("section", i) and not self.has("variation", i)):
                return i
            if self.has("variation", i):
                continue
            if self.has("ingredients", i):
                before = self.title_before(i, self.reach.from_header)
                if before is not None and before > anchor:
                    return before
                if self.count("ingredient", anchor, i):
                    return i
            elif self.has("title", i) and self.begins_recipe(i):
                return i
        return self.n

    def candidates(self) -> Iterator[tuple[int, int, int, float]]:
        """(start, end, anchor, score) by yields, where there are any, else by headings of ingredients and titles with a run of them."""
        yields = [i for i in range(self.n) if self.has("is_yield", i) and not self.has("excluded", i)]
        end = 0
        if yields:
            starts = {}
            for i in yields:
                start = self.title_before(i, self.reach.from_yield)
                starts.setdefault(i if start is None else start, i)
            anchors = sorted(starts.items())
        else:
            anchors = [(None, i) for i in range(self.n) if not self.has("excluded", i) and (self.has("ingredients", i) or (self.has("title", i) and self.begins_recipe(i)))]
        for start, anchor in anchors:
            if anchor < end:
                continue
            if start is None:
                before = None if self.has("title", anchor) else self.title_before(anchor, self.reach.from_header)
                start = anchor if before is None else before
            if start < end:
                continue
            end = self.end_after(anchor)
            yield start, end, anchor, self.score(start, end)

    def score(self, start: int, end: int) -> float:
        """A third each for a title, for two ingredients and for an instruction."""
        has = (self.has("title", start), self.count("ingredient", start, end) >= 2, self.count("instruction", start, end) > 0)
        return round(sum(map(bool, has)) / 3, 6)


def _packed(rows: DataFrame, key: str) -> DataFrame:
    """key, place, _n, _b: the length of each text and its flags as bits, which is all that the search looks at."""
    bits = reduce(Column.bitwiseOR, (F.when(F.col(f), bit).otherwise(0) for f, bit in BITS.items()))
    return rows.select(key, "place", F.char_length("text").alias("_n"), bits.alias("_b"))


def candidates(rows: DataFrame, key: str, reach: Reach = Reach()) -> DataFrame:
    """key, start, end (exclusive), anchor, score of the recipes of each book; rows: from flagged()."""
    return per_sequence(_packed(rows, key), [key], "place", ["_n", "_b"], lambda found: _Book(found, reach).candidates(), "start long, end long, anchor long, score double")


def split_sections(rows: DataFrame, key: str, least: int = 2) -> DataFrame:
    """key, place, part: a block of lines that may hold several recipes, cut before each title that has evidence on both sides: `least` ingredients or instructions since the last cut, and a run of ingredients or a yield soon after."""

    def fold(found: list[tuple]) -> Iterator[tuple[int, int]]:
        book, part, seen = _Book(found, Reach()), 0, 0
        for i, (_, _, place) in enumerate(found):
            soon = book.begins_recipe(i) or book.count("is_yield", i + 1, i + 2) > 0
            if i and book.has("title", i) and seen >= least and soon:
                part, seen = part + 1, 0
            seen += int(book.has("ingredient", i) or book.has("instruction", i))
            yield place, part

    return per_sequence(_packed(rows, key), [key], "place", ["_n", "_b", "place"], fold, "place long, part int")


def owned(rows: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """rows with the start of the candidate that holds them, null outside; an equi-join on places."""
    spread = found.select(key, F.col("start").alias("recipe"), F.explode(F.sequence(F.col("start"), F.col("end") - 1)).alias("place"))
    return rows.join(spread, [key, "place"], "left")

