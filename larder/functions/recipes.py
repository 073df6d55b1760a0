"""Recipe text: quantities, durations, temperatures, yields, line kinds, and scores of how much a text is a recipe.

Vocabularies are parameters; the defaults are short and English.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

UNITS = ("cups?", "tbsps?", "tablespoons?", "tsps?", "teaspoons?", "oz", "ounces?", "lbs?", "pounds?", "grams?", "g", "kg", "ml", "l", "liters?", "pinch(?:es)?", "cloves?", "cans?", "packages?", "sticks?")
VERBS = ("add", "bake", "beat", "blend", "boil", "bring", "combine", "cook", "cool", "cover", "drain", "fold", "fry", "grill", "heat", "knead", "mix", "place", "pour", "preheat", "reduce", "remove", "roast", "season", "serve", "simmer", "slice", "sprinkle", "stir", "whisk")
_QUANTITY = r"(?:\d+(?:[./]\d+)?|[¼½¾⅓⅔⅛⅜⅝⅞])"
#: Seconds of a unit, by its first letter.
_SECONDS = {"s": 1, "m": 60, "h": 3600, "d": 86400}
_TIME = r"(?i)\b(\d+)(?:\s*(?:-|–|to)\s*(\d+))?\s*(seconds?|secs?|minutes?|mins?|hours?|hrs?|days?)\b"
_HEAT = r"(?i)\b(\d{2,3})\s*(?:°|º|degrees?)?\s*(fahrenheit|celsius|f|c)\b"


def durations(x: Column) -> Column:
    """Seconds of every duration in a text; a range counts as its midpoint."""
    parts = [F.regexp_extract_all(x, F.lit(_TIME), F.lit(g)) for g in (1, 2, 3)]
    rows = F.zip_with(F.zip_with(parts[0], parts[1], lambda a, b: F.struct(a.cast("double").alias("a"), F.nullif(b, F.lit("")).cast("double").alias("b"))), parts[2], lambda n, u: F.struct(n["a"].alias("a"), n["b"].alias("b"), F.lower(F.substring(u, 1, 1)).alias("u")))
    unit = lambda u: F.when(u == "s", _SECONDS["s"]).when(u == "h", _SECONDS["h"]).when(u == "d", _SECONDS["d"]).otherwise(_SECONDS["m"])
    return F.transform(rows, lambda r: F.floor((r["a"] + F.coalesce(r["b"], r["a"])) / 2 * unit(r["u"])).cast("long"))


def total_seconds(x: Column, how: str = "sum") -> Column:
    """All durations summed, or the longest; null without any."""
    found = durations(x)
    total = F.array_max(found) if how == "max" else F.aggregate(found, F.lit(0).cast("long"), lambda a, v: a + v)
    return F.when(F.size(found) > 0, total)


def temperatures_celsius(x: Column) -> Column:
    """Whole degrees Celsius of every temperature in a text."""
    values, units = (F.regexp_extract_all(x, F.lit(_HEAT), F.lit(g)) for g in (1, 2))
    return F.zip_with(values, units, lambda v, u: F.when(F.lower(F.substring(u, 1, 1)) == "c", v.cast("double")).otherwise(F.bround((v.cast("double") - 32) * 5 / 9, 0)))


def servings(x: Column) -> Column:
    """The number that a yield phrase states: dozens count twelve, ranges their midpoint, always rounded up; null for none."""
    t = F.lower(F.trim(x))
    names = "one two three four five six seven eight nine ten eleven twelve".split()
    word = F.regexp_extract(t, r"\b(" + "|".join(names) + r")\b", 1)
    spelled = F.nullif(F.array_position(F.array(*map(F.lit, names)), word), F.lit(0)).cast("double")
    pair = r"(\d+(?:\.\d+)?)\s*(?:-|–|to)\s*(\d+(?:\.\d+)?)"
    low, high = (F.nullif(F.regexp_extract(t, pair, g), F.lit("")).cast("double") for g in (1, 2))
    single = F.nullif(F.regexp_extract(t, r"(\d+(?:\.\d+)?)", 1), F.lit("")).cast("double")
    count = F.coalesce((low + high) / 2, single, spelled)
    dozen = t.rlike(r"\bdozens?\b")
    value = F.when(dozen, F.coalesce(count, F.lit(1.0)) * 12).otherwise(count)
    return F.when(value > 0, F.greatest(F.lit(1), F.ceil(value).cast("int")))


def range_up(low: Column, high: Column) -> Column:
    """A quantity's range as its midpoint rounded up."""
    return F.ceil((low + high) / 2).cast("int")


def starts_with_quantity(x: Column) -> Column:
    return F.trim(x).rlike(rf"^{_QUANTITY}")


def has_unit(x: Column, units: Sequence[str] = UNITS) -> Column:
    return F.lower(x).rlike(rf"(?:^|[\s\d½¼¾])(?:{'|'.join(units)})\b")


def starts_with_verb(x: Column, verbs: Sequence[str] = VERBS) -> Column:
    return F.lower(F.trim(x)).rlike(rf"^(?:\d+[.)]\s*)?(?:\w+\s+){{0,2}}?(?:{'|'.join(verbs)})\b")


def line_kind(x: Column, units: Sequence[str] = UNITS, verbs: Sequence[str] = VERBS) -> Column:
    """The first that fits of: blank, yield, time, heading, note, ingredient, numbered, instruction, prose."""
    t = F.trim(x)
    low = F.lower(t)
    ends = t.rlike("[.!?]$")
    kinds = [
        ("blank", t == ""),
        ("yield", low.rlike(r"^(?:serves?|yields?|makes|servings?)\b.*(?:\d|\b(?:one|two|three|four|five|six|eight|ten|twelve)\b)")),
        ("time", low.rlike(r"^(?:prep|cook|total|active)\w*\s*(?:time)?\s*:?\s*\d")),
        ("heading", low.rlike(r"^(?:ingredients|directions|instructions|method|notes?|for the .{1,40})\s*:?$")),
        ("note", low.rlike(r"^(?:note|tip|variation)s?\s*:")),
        ("ingredient", starts_with_quantity(t) & ~ends & (has_unit(t, units) | (F.size(F.split(t, r"\s+")) <= 6)) & ~t.rlike(r"^\d+[.)]\s")),
        ("numbered", t.rlike(r"^\d+[.)]\s")),
        ("instruction", starts_with_verb(t, verbs)),
    ]
    out = F.lit("prose")
    for name, when in reversed(kinds):
        out = F.when(when, name).otherwise(out)
    return out


def row_cells(x: Column) -> Column:
    """Cells of a table-like line: by pipes, tabs or runs of blanks; null under two cells."""
    t = F.trim(x)
    split = F.when(F.contains(t, F.lit("|")), F.split(F.regexp_replace(t, r"^\||\|$", ""), r"\|")).when(F.contains(t, F.lit("\t")), F.split(t, "\t")).otherwise(F.split(t, r" {2,}"))
    cells = F.filter(F.transform(split, lambda c: F.trim(c)), lambda c: (c != "") & ~c.rlike(r"^:?-{2,}:?$"))
    return F.when(F.size(cells) >= 2, cells)


def text_quality(x: Column, units: Sequence[str] = UNITS, verbs: Sequence[str] = VERBS) -> Column:
    """0.45 of length, 0.30 of lines, 0.25 of recipe-like lines, each up to a full score; a third of it for very short texts."""
    rows = F.filter(F.transform(F.split(x, "\n"), lambda r: F.trim(r)), lambda r: r != "")
    hits = F.size(F.filter(rows, lambda r: starts_with_verb(r, verbs) | (starts_with_quantity(r) & has_unit(r, units))))
    cap = lambda v, most: F.least(F.lit(1.0), v / F.lit(float(most)))
    n = F.char_length(x)
    score = cap(n, 6000) * 0.45 + cap(F.size(rows), 120) * 0.30 + cap(hits, 24) * 0.25
    return F.when(n == 0, 0.0).when(n < 120, score * 0.35).otherwise(score)


def title_quality(x: Column, generic: Sequence[str] = ("recipe", "untitled", "ingredients", "directions", "instructions")) -> Column:
    t = F.trim(F.coalesce(x, F.lit("")))
    n = F.char_length(t)
    return F.when(n == 0, 0.0).when(F.lower(t).isin(*generic), 0.25).when(F.lower(t).rlike(r"\.(?:txt|pdf|docx?|html?|epub)$"), 0.4).when(n < 4, 0.35).when(n > 90, 0.55).otherwise(1.0)


def _mean_of_first(lines: Column, points, share: float, full: float) -> Column:
    """share of the mean points of the first eight lines, and the rest by how many lines there are."""
    some = F.slice(lines, 1, 8)
    total = F.aggregate(F.transform(some, points), F.lit(0.0), lambda a, v: a + v)
    ratio = total / F.greatest(F.lit(1), F.size(some))
    return F.when(F.size(lines) > 0, F.least(F.lit(1.0), ratio * share + F.least(F.lit(1.0), F.size(lines) / F.lit(full)) * (1 - share))).otherwise(0.0)


def ingredient_quality(lines: Column, units: Sequence[str] = UNITS, verbs: Sequence[str] = VERBS) -> Column:
    def points(x: Column) -> Column:
        quantity, unit, verb = starts_with_quantity(x), has_unit(x, units), starts_with_verb(x, verbs)
        few = F.size(F.split(F.trim(x), r"\s+")) <= 6
        return F.when(quantity & unit, 1.0).when(quantity & ~verb, 0.85).when(unit & ~verb, 0.75).when(x.rlike(r"^\s*[-*•]\s+"), 0.6).when(few, 0.5).otherwise(0.0)

    return _mean_of_first(lines, points, 0.65, 6.0)


def instruction_quality(lines: Column, verbs: Sequence[str] = VERBS) -> Column:
    def points(x: Column) -> Column:
        words = F.size(F.split(F.trim(x), r"\s+"))
        sentence = starts_with_verb(x, verbs) & F.trim(x).rlike("[.!?]$")
        return F.when(sentence, 1.0).when(starts_with_verb(x, verbs), 0.8).when(x.rlike(r"^\s*(\d+[.)]|[-*•])\s+"), 0.7).when(words >= 8, 0.4).when(words >= 2, 0.5).otherwise(0.0)

    return _mean_of_first(lines, points, 0.7, 5.0)


@dataclass(frozen=True)
class Tiers:
    """Least scores of the tiers, and least lines for keeping a recipe whole."""

    gold: float = 0.75
    silver: float = 0.55
    bronze: float = 0.35
    ingredients: int = 1
    instructions: int = 1


def likeness(title: Column, ingredients: Column, steps: Column, has_yield: Column, description: Column, has_source: Column, anchored: Column) -> Column:
    """0 to 1: weighted title, ingredient, instruction, balance, metadata and anchor scores, less penalties for noise and odd lengths."""
    described = F.coalesce(F.trim(description), F.lit("")) != ""
    n, m = F.size(ingredients), F.size(steps)
    both = F.greatest(F.lit(1), n + m)
    balance = F.least(F.lit(1.0), n / both / 0.6) * 0.5 + F.least(F.lit(1.0), m / both / 0.6) * 0.5
    meta = F.when(has_yield, 0.35).otherwise(0.0) + F.when(described, 0.35).otherwise(0.0) + F.when(has_source, 0.3).otherwise(0.0)
    text = F.trim(F.concat_ws("\n", title, F.array_join(ingredients, "\n"), F.array_join(steps, "\n"), description))
    length = F.char_length(text)
    noise = (length - F.char_length(F.regexp_replace(text, r"[^\w\s.,;:!?()'\"/%°½¼¾⅓⅔&-]", ""))) / F.greatest(F.lit(1), length)
    penalty = F.when(noise > 0.02, F.least(F.lit(0.14), (noise - 0.02) * 2.5)).otherwise(0.0)
    penalty = penalty + F.when(length < 80, F.least(F.lit(0.1), (80 - length) / 80 * 0.1)).otherwise(0.0)
    penalty = penalty + F.when(length > 12000, F.least(F.lit(0.16), (length - 12000) / 12000 * 0.16)).otherwise(0.0)
    score = title_quality(title) * 0.20 + ingredient_quality(ingredients) * 0.31 + instruction_quality(steps) * 0.31 + balance * 0.08 + meta * 0.06 + F.when(anchored, 0.04).otherwise(0.0)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), score - penalty))


def tier(score: Column, t: Tiers = Tiers()) -> Column:
    return F.when(score >= t.gold, "gold").when(score >= t.silver, "silver").when(score >= t.bronze, "bronze").otherwise("reject")


def gate(name: Column, ingredients: Column, steps: Column, t: Tiers = Tiers()) -> Column:
    """reject, keep_partial (bronze, or too few lines of a kind) or keep_full."""
    return F.when(name == "reject", "reject").when((name == "bronze") | (F.size(ingredients) < t.ingredients) | (F.size(steps) < t.instructions), "keep_partial").otherwise("keep_full")


def label_name(x: Column) -> Column:
    """Upper case with blanks and hyphens as underscores."""
    return F.upper(F.regexp_replace(F.trim(x), r"[\s-]+", "_"))


def distinct_tags(tags: Column) -> Column:
    """Tags trimmed, the first form of each key (letters and digits in lower case) kept."""
    key = lambda t: F.regexp_replace(F.lower(t), r"[^\p{L}\p{N}]+", "")
    clean = F.filter(F.transform(tags, lambda t: F.trim(F.regexp_replace(t, r"\s+", " "))), lambda t: key(t) != "")
    keys = F.transform(clean, key)
    return F.filter(clean, lambda t, i: F.array_position(keys, key(t)) == i + 1)
