"""Text expressions: whitespace, keys, excerpts, scores, durations; and lines with offsets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def line_offsets(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, line, text, start, end of every line that isn't blank; blank ones count in the offsets only."""
    rows = df.select(key, F.posexplode(F.split(text, "\n")).alias("_i", "_t"))
    w = Window.partitionBy(key).orderBy("_i")
    placed = rows.withColumn("start", F.coalesce(F.sum(F.char_length("_t") + 1).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long")))
    kept = placed.filter(F.trim("_t") != "")
    return kept.select(key, (F.row_number().over(w) - 1).alias("line"), F.col("_t").alias("text"), "start", (F.col("start") + F.char_length("_t")).alias("end"))


def one_space(x: Column) -> Column:
    return F.trim(F.regexp_replace(x, r"\s+", " "))


def standard_whitespace(x: Column) -> Column:
    """No-break spaces and carriage returns replaced, blanks collapsed within lines, lines stripped."""
    t = F.regexp_replace(F.regexp_replace(x, " ", " "), r"\r\n?", "\n")
    t = F.regexp_replace(t, r"[ \t\x0B\f]+", " ")
    return F.regexp_replace(F.regexp_replace(t, r" ?\n ?", "\n"), r"^\s+|\s+$", "")


def joined_hyphens(x: Column) -> Column:
    """Words broken by a hyphen at a line end, where the next line begins in lower case, are joined."""
    return F.regexp_replace(x, r"-\n(?=\p{Ll})", "")


def spaced_fractions(x: Column) -> Column:
    """'1 / 2' as '1/2'."""
    return F.regexp_replace(one_space(x), r"(?<!\d)(\d+)\s*/\s*(\d+)(?!\d)", "$1/$2")


def excerpt(x: Column, most: int = 120) -> Column:
    t = one_space(x)
    return F.when(F.char_length(t) > most, F.concat(F.rtrim(F.substring(t, 1, most - 3)), F.lit("..."))).otherwise(t)


def slug(x: Column) -> Column:
    """Lower case with runs of other characters than letters and digits as underscores; 'unknown' for none."""
    t = F.regexp_replace(F.regexp_replace(F.lower(F.trim(x)), "[^a-z0-9]+", "_"), "^_+|_+$", "")
    return F.coalesce(F.nullif(t, F.lit("")), F.lit("unknown"))


def tag_key(x: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(x)), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def title_pattern(x: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(x), r"[^a-z0-9]+", " "), " +", " "))


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays as sets; 0 where both are empty."""
    return F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))), F.lit(0.0))


def celsius(f: Column) -> Column:
    return F.bround((f - 32) * 5 / 9, 0)


def token_estimate(x: Column) -> Column:
    return F.ceil(F.char_length(x) / 4).cast("long")


def sentences(x: Column) -> Column:
    """Parts that end with . ! or ? before white space."""
    return F.filter(F.split(one_space(x), r"(?<=[.!?])\s+"), lambda s: s != "")


def duration_iso(x: Column) -> Column:
    """'1 hr 20 min' as PT1H20M; ISO texts in upper case; a bare number is minutes; null for none or zero."""
    t = F.lower(F.trim(x))

    def of(unit: str) -> Column:
        found = F.regexp_extract_all(t, F.lit(rf"(\d+(?:\.\d+)?)\s*(?:{unit})\b"), F.lit(1))
        return F.aggregate(F.transform(found, lambda v: v.cast("double")), F.lit(0.0), lambda a, v: a + v)

    minutes = of("hours?|hrs?|h") * 60 + of("minutes?|mins?|m")
    minutes = F.when(t.rlike(r"^\d+$"), t.try_cast("double")).otherwise(minutes)
    total = F.round(minutes).cast("long")
    hours, rest = F.floor(total / 60).cast("long"), total % 60
    text = F.concat(F.lit("PT"), F.when(hours > 0, F.concat(hours.cast("string"), F.lit("H"))).otherwise(""), F.when(rest > 0, F.concat(rest.cast("string"), F.lit("M"))).otherwise(""))
    return F.when(F.upper(F.trim(x)).rlike(r"^P(T?\d|\d)"), F.upper(F.trim(x))).when(total > 0, text)


def keyword_score(x: Column, cues: dict[str, tuple[float, float]]) -> Column:
    """Sum over cues (pattern: weight, cap) of min(cap, hits * weight * 500 / length), clamped to 0..1."""
    n = F.greatest(F.char_length(x), F.lit(1))
    parts = [F.least(F.lit(cap), F.regexp_count(x, F.lit(p)) * F.lit(w * 500.0) / n) for p, (w, cap) in cues.items()]
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), sum(parts[1:], parts[0])))


def first_by_priority(labels: Column, order: list[str], other: str = "OTHER") -> Column:
    found = F.get(F.filter(F.array(*map(F.lit, order)), lambda x: F.array_contains(labels, x)), 0)
    return F.coalesce(found, F.lit(other))


def urn(kind: str, source: Column, place: Column) -> Column:
    return F.concat_ws(":", F.lit("urn"), F.lit(kind), source, place)


def title_like(x: Column) -> Column:
    """A short line that starts in upper case (after markdown or a number) and doesn't end a sentence."""
    t = F.regexp_replace(F.trim(x), r"^(#+\s*|\d+[.)]\s*)", "")
    return (F.char_length(t).between(1, 90)) & (F.size(F.split(t, r"\s+")) <= 12) & t.rlike(r"^\p{Lu}") & ~F.endswith(t, F.lit("."))


def contents_score(x: Column) -> Column:
    """How much a line looks like one of a table of contents, up to 1.6."""
    t = F.trim(x)
    words = F.size(F.split(t, r"\s+"))
    heading = t.rlike(r"(?i)^(table of )?contents$")
    score = F.when(heading, 1.0).otherwise(0.0) + F.when(t.rlike(r"\.{3,}|(\. ){3,}"), 0.6).otherwise(0.0) + F.when(t.rlike(r"\s\d{1,4}$"), 0.35).otherwise(0.0)
    score = score + F.when(t.rlike(r"(?i)^(part|chapter|section|index|appendix)\b"), 0.25).otherwise(0.0) + F.when(words.between(2, 16), 0.15).otherwise(0.0) + F.when(F.char_length(t) <= 120, 0.1).otherwise(0.0)
    return F.least(F.lit(1.6), F.when((words == 1) & ~heading, score * 0.4).otherwise(score))


def lemma(word: Column) -> Column:
    """A word's stem by suffix: -ies as y, -oes as o, -ing and -ed off longer words (double consonants undone), -es, -s."""
    w = F.lower(F.trim(word))
    n = F.char_length(w)

    def cut(k: int) -> Column:
        stem = F.substring(w, F.lit(1), n - k)
        return F.when(stem.rlike(r"([bdfgmnprt])\1$"), F.substring(stem, F.lit(1), F.char_length(stem) - 1)).otherwise(stem)

    off = lambda k, add="": F.concat(F.substring(w, F.lit(1), n - k), F.lit(add))
    return (
        F.when((n > 4) & F.endswith(w, F.lit("ies")), off(3, "y")).when((n > 4) & F.endswith(w, F.lit("oes")), off(2)).when((n > 5) & F.endswith(w, F.lit("ing")), cut(3)).when((n > 4) & F.endswith(w, F.lit("ed")), cut(2))
        .when((n > 4) & w.rlike("(?:ch|sh|ss|x|z)es$"), off(2)).when((n > 3) & F.endswith(w, F.lit("s")) & ~F.endswith(w, F.lit("ss")), off(1)).otherwise(w)
    )


def line_scores(ingredient: Column, instruction: Column, other: Column, is_ingredient: Column) -> Column:
    """label and share of three raw scores: ingredient needs its flag and wins ties, then instruction; other for none."""
    total = ingredient + instruction + other
    label = F.when(total <= 0, "other").when(is_ingredient & (ingredient >= instruction) & (ingredient >= other), "ingredient").when(instruction >= other, "instruction").otherwise("other")
    score = F.when(total <= 0, 1.0).otherwise(F.when(label == "ingredient", ingredient).when(label == "instruction", instruction).otherwise(other) / F.nullif(total, F.lit(0.0)))
    return F.struct(label.alias("label"), score.alias("share"))


def tiny_merged(fragments: Column, words: int = 2, chars: int = 14) -> Column:
    """Fragments of few words or characters joined to the one before, or, at the beginning, to the next."""
    tiny = lambda x: (F.size(F.split(F.trim(x), r"\s+")) <= words) | (F.char_length(F.trim(x)) <= chars)
    start = F.array().cast("array<string>")

    def step(acc: Column, x: Column) -> Column:
        last = F.element_at(acc, -1)
        head = F.slice(acc, F.lit(1), F.size(acc) - 1)
        joined = F.concat(head, F.array(F.concat_ws(" ", last, x)))
        first_is_tiny = (F.size(acc) == 1) & tiny(last)
        return F.when(F.size(acc) == 0, F.array(x)).when(tiny(x) | first_is_tiny, joined).otherwise(F.concat(acc, F.array(x)))

    return F.aggregate(fragments, start, step)
