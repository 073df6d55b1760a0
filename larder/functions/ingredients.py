"""Ingredient lines as quantity, unit, name, preparation and note; units by their names; yields from several places of a recipe.

All are column expressions. Vocabularies are parameters.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from larder.functions.fields import let
from larder.functions.recipes import servings

#: Short and plural forms of units.
UNIT_NAMES = {
    "teaspoon": ("tsp", "tsp.", "tsps", "teaspoons"), "tablespoon": ("tbsp", "tbsp.", "tbsps", "tbs", "tbs.", "tablespoons"), "cup": ("c", "c.", "cups"), "ounce": ("oz", "oz.", "ounces"), "pound": ("lb", "lb.", "lbs", "lbs.", "pounds"),
    "gram": ("g", "g.", "gr", "grams"), "kilogram": ("kg", "kg.", "kgs", "kilograms"), "milliliter": ("ml", "ml.", "milliliters"), "liter": ("l", "l.", "liters", "litres", "litre"), "quart": ("qt", "qt.", "quarts"), "pint": ("pt", "pt.", "pints"), "pinch": ("pinches",), "dash": ("dashes",),
}
#: Units that are things; they keep their form.
CONTAINERS = ("can", "cans", "tin", "tins", "jar", "jars", "clove", "cloves", "stalk", "stalks", "bunch", "bunches", "sprig", "sprigs", "package", "packages", "packet", "packets", "stick", "sticks", "bottle", "bottles", "bag", "bags", "box", "boxes", "slice", "slices", "head", "heads")
SIZES = ("small", "medium", "large", "extra-large", "jumbo")
_FRACTIONS = {"½": "1/2", "⅓": "1/3", "⅔": "2/3", "¼": "1/4", "¾": "3/4", "⅛": "1/8", "⅜": "3/8", "⅝": "5/8", "⅞": "7/8"}
_TASTE = r"(?i)\b(?:to taste|as needed|as desired)\b"
_N = r"\d+\s+\d+/\d+|\d+/\d+|\d+(?:\.\d+)?"


def unit_name(x: Column, names: Mapping[str, Sequence[str]] = UNIT_NAMES, containers: Sequence[str] = CONTAINERS) -> Column:
    """The unit's full singular name; containers as they are, unknown units in lower case."""
    low = F.lower(F.trim(x))
    table = F.create_map(*(F.lit(v) for full, forms in names.items() for form in forms for v in (form, full)))
    return F.when(low.isin(*containers), F.trim(x)).otherwise(F.coalesce(F.element_at(table, low), low))


def tidy_line(x: Column) -> Column:
    """Dashes as hyphens, written fractions, no blanks inside fractions and ranges, one blank around parentheses."""
    t = F.regexp_replace(F.coalesce(x, F.lit("")), "[–—−]", "-")
    for sign, text in _FRACTIONS.items():
        t = F.regexp_replace(t, rf"(?<=\d){sign}", f" {text}")
        t = F.replace(t, F.lit(sign), F.lit(text))
    t = F.regexp_replace(F.regexp_replace(t, r"\s*\(\s*", " ("), r"\s*\)\s*", ") ")
    t = F.regexp_replace(F.regexp_replace(t, r"(\d)\s*/\s*(\d)", "$1/$2"), r"(\d)\s*-\s*(\d)", "$1-$2")
    return F.trim(F.regexp_replace(t, r"\s+", " "))


def packaging(x: Column) -> Column:
    """A struct of text and note: '2 (14 oz) cans beans' and '2 x 400g tins beans' as '2 can beans' and 'pkg: 14 oz'; others as they are, without a note."""
    shapes = [r"^\s*(\d+(?:\.\d+)?(?:\s+\d+/\d+)?)\s*\(([^)]+)\)\s*([A-Za-z][A-Za-z-]*?)s?\s+(.+)$", r"^\s*(\d+(?:\.\d+)?)\s*[xX×]\s*(\d+(?:\.\d+)?\s*[A-Za-z]+)\s*([A-Za-z][A-Za-z-]*?)s?\s+(.+)$"]
    part = lambda shape, g: F.trim(F.regexp_extract(x, shape, g))
    text, note = x, F.lit(None).cast("string")
    for shape in reversed(shapes):
        fits = x.rlike(shape)
        text = F.when(fits, F.concat_ws(" ", part(shape, 1), part(shape, 3), part(shape, 4))).otherwise(text)
        note = F.when(fits, F.concat(F.lit("pkg: "), part(shape, 2))).otherwise(note)
    return F.struct(text.alias("text"), note.alias("note"))


def number(x: Column) -> Column:
    """'1 1/2', '3/4' or '2.5' as a number; null for others."""
    return let(x, _number)


def _number(x: Column) -> Column:
    whole, top, bottom = (F.regexp_extract(x, r"^(?:(\d+)\s+)?(\d+)/(\d+)$", g) for g in (1, 2, 3))
    fraction = F.try_divide(F.nullif(top, F.lit("")).cast("double"), F.nullif(bottom, F.lit("")).cast("double"))
    return F.when(x.rlike(r"^\d+(?:\.\d+)?$"), x.try_cast("double")).when(top != "", F.coalesce(F.nullif(whole, F.lit("")).cast("double"), F.lit(0.0)) + fraction)


def ingredient(x: Column, units: Mapping[str, Sequence[str]] = UNIT_NAMES, containers: Sequence[str] = CONTAINERS, sizes: Sequence[str] = SIZES, with_packaging: bool = False) -> Column:
    """A struct of kind (header, exact, approximate, unquantified or empty), quantity, unit, name, preparation, note and optional.

    A range counts as its midpoint rounded up. What follows the first comma is the preparation, what is in parentheses a
    note, and so is a size that stands as a unit. 'to taste' and the like make a line approximate.
    """
    split = lambda raw: let(tidy_line(raw), lambda tidy: let(packaging(tidy) if with_packaging else F.struct(tidy.alias("text"), F.lit(None).cast("string").alias("note")), lambda p: _split(raw, p["text"], p["note"])))
    named = lambda p: let(_worded(p, units, containers, sizes), lambda w: _ingredient(p, w, units, containers))
    return let(F.trim(F.coalesce(x, F.lit(""))), lambda raw: let(split(raw), named))


def _split(raw: Column, line: Column, pack: Column) -> Column:
    """A struct of a line's parts: what is in parentheses, the numbers that it begins with, and the rest."""
    body = F.trim(F.regexp_replace(F.regexp_replace(line, r"\([^)]*\)", " "), r"\s+", " "))

    def parts(body: Column) -> Column:
        first, second = (F.regexp_extract(body, rf"^({_N})(?:\s*(?:-|to)\s*({_N}))?(?=\s|$|[A-Za-z])", g) for g in (1, 2))
        rest = F.trim(F.regexp_replace(body, rf"^(?:{_N})(?:\s*(?:-|to)\s*(?:{_N}))?(?=\s|$|[A-Za-z])", ""))
        inside = F.regexp_extract_all(line, F.lit(r"\(([^)]*)\)"), F.lit(1))
        return F.struct(raw.alias("raw"), F.lower(line).alias("low"), pack.alias("pack"), inside.alias("inside"), number(first).alias("a"), number(F.nullif(second, F.lit(""))).alias("b"), rest.alias("rest"))

    return let(body, parts)


def _worded(p: Column, units: Mapping[str, Sequence[str]], containers: Sequence[str], sizes: Sequence[str]) -> Column:
    """A struct of the word after the numbers, whether it is a unit or a size, and what follows, without words of vagueness."""
    forms = sorted({f for full, fs in units.items() for f in (full, *fs)} | set(containers))

    def after(word: Column) -> Column:
        is_unit, is_size = p["a"].isNotNull() & F.lower(word).isin(*forms), p["a"].isNotNull() & F.lower(word).isin(*sizes)
        left = F.when(is_unit | is_size, F.trim(F.substring(p["rest"], F.length(word) + 1, F.length(p["rest"])))).otherwise(p["rest"])
        left = F.when(is_unit, F.regexp_replace(left, r"(?i)^of\s+", "")).otherwise(left)
        clean = F.trim(F.regexp_replace(F.regexp_replace(left, rf"{_TASTE}|(?i)\boptional\b", ""), r"\s+", " "))
        return F.struct(word.alias("word"), is_unit.alias("is_unit"), is_size.alias("is_size"), clean.alias("clean"))

    return let(F.regexp_extract(p["rest"], r"^([A-Za-z-]+\.?)(?=\s|$)", 1), after)


def _ingredient(p: Column, w: Column, units: Mapping[str, Sequence[str]], containers: Sequence[str]) -> Column:
    raw, low, a, b, clean = p["raw"], p["low"], p["a"], p["b"], w["clean"]
    header = F.endswith(raw, F.lit(":")) | (low.rlike(r"^for the [a-z ]{2,40}$"))
    quantity = F.when(b.isNotNull() & (a != b), F.ceil((a + b) / 2).cast("double")).otherwise(a)
    vague = low.rlike(r"\b(?:to taste|as needed|as desired|a few|a handful|some)\b")
    optional = low.rlike(r"\boptional\b")
    name = F.regexp_replace(F.trim(F.substring_index(clean, ",", 1)), r"^[\s,;:-]+|[\s,;:-]+$", "")
    preparation = F.nullif(F.regexp_replace(F.trim(F.substring(clean, F.length(F.substring_index(clean, ",", 1)) + 2, F.length(clean))), r"^[\s,;:-]+|[\s,;:-]+$", ""), F.lit(""))
    notes = F.filter(F.concat(F.transform(p["inside"], lambda n: F.trim(n)), F.array(F.when(w["is_size"], F.lower(w["word"])), F.nullif(F.regexp_extract(low, _TASTE, 0), F.lit("")), p["pack"])), lambda n: n.isNotNull() & (n != "") & (F.lower(n) != "optional"))
    kind = F.when(raw == "", "empty").when(header, "header").when(quantity.isNotNull(), "exact").when(vague, "approximate").otherwise("unquantified")
    plain = header | (raw == "")
    given = lambda c: F.when(~plain, c)
    return F.struct(
        kind.alias("kind"), given(quantity).alias("quantity"), given(F.when(w["is_unit"], unit_name(w["word"], units, containers))).alias("unit"), F.when(header, F.regexp_replace(raw, r"\s*:+$", "")).otherwise(F.nullif(name, F.lit(""))).alias("name"),
        given(preparation).alias("preparation"), given(F.nullif(F.array_join(notes, "; "), F.lit(""))).alias("note"), given(optional).alias("optional"),
    )


#: What a yield is worth by where it stands, and what its text adds.
PLACES = {"yield": 100, "description": 70, "instruction": 65, "comment": 60}
PREFIXED, NUMBERED, LENGTHY, NUTRITION = 20, 15, -20, -80


def yield_score(x: Column, place: Column) -> Column:
    """How likely a text states the yield, by where it stands."""
    t = F.lower(F.trim(F.regexp_replace(x, r"\s+", " ")))
    base = F.coalesce(F.element_at(F.create_map(*(F.lit(v) for kv in PLACES.items() for v in kv)), place), F.lit(0))
    points = lambda when, n: F.when(when, n).otherwise(0)
    return base + points(t.rlike(r"^(?:serves?|servings?|yields?|makes?)\b"), PREFIXED) + points(t.rlike(r"\d"), NUMBERED) + points(F.char_length(t) > 96, LENGTHY) + points(t.rlike(r"\b(?:calories?|kcal|protein|fat|carb(?:s|ohydrates?)?|sodium|cholesterol|fiber|daily value)\b"), NUTRITION)


def yield_fields(stated: Column, description: Column, steps: Column, comments: Column) -> Column:
    """A struct of phrase, place, units (1 where none is stated) and candidates: the best of the stated yield and of lines that begin like one elsewhere."""
    prefix = r"(?i)^\s*(?:serves?|servings?|yields?|makes?)\b"
    none = F.array().cast("array<string>")

    def options(texts: Column, place: str, only: bool = True) -> Column:
        tidy = F.transform(F.coalesce(texts, none), lambda t: F.trim(F.regexp_replace(t, r"\s+", " ")))
        kept = F.filter(tidy, lambda t: (t != "") & (t.rlike(prefix) if only else F.lit(True)))
        return F.transform(kept, lambda t: F.struct(yield_score(t, F.lit(place)).alias("score"), F.lit(PLACES[place]).alias("rank"), t.alias("text"), F.lit(place).alias("place")))

    every = F.concat(options(F.array(F.coalesce(stated, F.lit(""))), "yield", False), options(F.split(F.coalesce(description, F.lit("")), "\n"), "description"), options(steps, "instruction"), options(comments, "comment"))
    best = F.get(F.array_sort(F.transform(F.filter(every, lambda c: c["score"] > 0), lambda c: F.struct((-c["score"]).alias("s"), (-c["rank"]).alias("r"), c["text"].alias("text"), c["place"].alias("place")))), 0)
    phrase = F.coalesce(best["text"], F.nullif(F.trim(stated), F.lit("")))
    return F.struct(phrase.alias("phrase"), best["place"].alias("place"), F.coalesce(servings(phrase), F.lit(1)).alias("units"), F.size(every).alias("candidates"))
