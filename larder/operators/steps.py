"""Steps of instructions: splitting of run-on ones, and which ingredients each step uses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.text import lemma, tiny_merged

_MARK = r"(?i)(?<!\w)(?:step\s*)?\d{1,2}[.)](?=\s)"
_BULLET = r"\s+[•●▪◦]\s+"
_SENTENCE = r"""(?<=[.!?])\s+(?=[A-Z0-9"'(\[])"""


def _tidy(steps: Column) -> Column:
    lines = F.transform(F.coalesce(steps, F.array().cast("array<string>")), lambda s: F.trim(F.regexp_replace(F.coalesce(s, F.lit("")), r"\s+", " ")))
    return F.filter(lines, lambda s: s != "")


def _words(s: Column) -> Column:
    return F.regexp_count(s, F.lit("[A-Za-z0-9]+"))


def _sentences(s: Column) -> Column:
    return F.size(F.split(s, _SENTENCE))


def needs_splitting(steps: Column) -> Column:
    """Whether instructions run on: numbers or bullets within a line; a single line of three sentences; or long lines with several breaks, or many words, in two or three lines."""
    lines = F.filter(_tidy(steps), lambda s: ~F.lower(s).rlike(r"^(?:for the .{1,40}|.{1,40}:)$"))
    n = F.size(lines)
    marked = F.exists(lines, lambda s: (F.regexp_count(s, F.lit(_MARK)) >= 2) | s.rlike(_BULLET) | (s.rlike(_MARK) & ~s.rlike(r"(?i)^(?:step\s*)?\d{1,2}[.)]\s")))
    one = F.get(lines, 0)
    single = (n == 1) & (_sentences(one) >= 3) & (_words(one) >= 16)
    long = F.filter(lines, lambda s: (F.char_length(s) >= 200) | (_words(s) >= 35))
    breaks = F.aggregate(long, F.lit(0), lambda a, s: a + _sentences(s) - 1)
    total = F.aggregate(lines, F.lit(0).cast("int"), lambda a, s: a + _words(s).cast("int"))
    return F.coalesce(marked | single | ((F.size(long) > 0) & (((breaks >= 2) & (n <= 2)) | ((n <= 3) & (total >= 70)))), F.lit(False))


def segmented(steps: Column, policy: str = "auto", most: int = 80) -> Column:
    """Steps split at inner numbers, bullets and sentences, small pieces joined to their neighbours. policy: off, auto (where needs_splitting) or always; more than `most` pieces mean the text wasn't steps, and it stays."""
    if policy not in ("off", "auto", "always"):
        raise ValueError(f"{policy!r} is none of off, auto and always")
    lines = _tidy(steps)
    if policy == "off":
        return lines
    # A sign that no text holds stands where a step begins.
    marked = F.transform(lines, lambda s: F.regexp_replace(F.regexp_replace(s, _MARK, "\u0001"), _BULLET, "\u0001"))
    pieces = F.flatten(F.transform(marked, lambda s: F.split(s, "\u0001")))
    sentences = F.flatten(F.transform(F.filter(F.transform(pieces, lambda p: F.trim(p)), lambda p: p != ""), lambda p: F.split(p, _SENTENCE)))
    out = tiny_merged(sentences)
    out = F.when((F.size(out) > 0) & (F.size(out) <= most), out).otherwise(lines)
    return out if policy == "always" else F.when(needs_splitting(steps), out).otherwise(lines)


def tokens(x: Column, lemmas: bool = False) -> Column:
    """Words of a text in lower case; as stems where asked for."""
    found = F.filter(F.split(F.lower(F.coalesce(x, F.lit(""))), r"[^a-z0-9]+"), lambda t: t != "")
    return F.transform(found, lemma) if lemmas else found


#: Words that say nothing about which ingredient is meant.
GENERIC = ("fresh", "large", "small", "medium", "chopped", "sliced", "diced", "ground", "dried", "whole", "extra", "finely", "optional", "taste", "more", "cup", "cups", "and", "or", "of", "the", "a")
USE = ("add", "stir", "mix", "whisk", "fold", "combine", "pour", "sprinkle", "toss", "beat", "blend", "season", "top")
REFERENCE = ("remaining", "reserved", "cooked", "mixture")


def aliases(ingredients: DataFrame, keys: Sequence[str], item: str, name: str, lemmas: bool = False, generic: Sequence[str] = GENERIC) -> DataFrame:
    """keys, item, alias (an array of words), source: an ingredient's name without generic words (2), and its last word (1)."""
    core = F.filter(tokens(F.col(name), lemmas), lambda t: ~t.isin(*generic))
    rows = ingredients.select(*keys, item, core.alias("_c")).filter(F.size("_c") > 0)
    every = F.array(F.struct(F.col("_c").alias("alias"), F.lit(2).alias("source")), F.struct(F.slice("_c", -1, 1).alias("alias"), F.lit(1).alias("source")))
    return rows.select(*keys, item, F.explode(every).alias("_a")).select(*keys, item, "_a.alias", "_a.source").groupBy(*keys, item, "alias").agg(F.max("source").alias("source"))


def mentions(steps: DataFrame, names: DataFrame, keys: Sequence[str], step: str, text: str, item: str, lemmas: bool = False, most_words: int = 6) -> DataFrame:
    """keys, step, item, alias, source, at, similarity (1): aliases whose words stand in a row in a step; of each step and item the longest. An equi-join on runs of words."""
    words = steps.select(*keys, step, tokens(F.col(text), lemmas).alias("_w")).filter(F.size("_w") > 0)
    runs = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(most_words)), lambda n: F.when(n <= F.size("_w"), F.transform(F.sequence(F.lit(1), F.size("_w") - n + 1), lambda i: F.struct(i.alias("at"), F.slice("_w", i, n).alias("run")))).otherwise(F.array().cast("array<struct<at:int,run:array<string>>>"))))
    met = words.select(*keys, step, F.explode(runs).alias("_r")).select(*keys, step, F.col("_r.at").alias("at"), F.col("_r.run").alias("alias")).join(names, [*keys, "alias"])
    order = Window.partitionBy(*keys, step, item).orderBy(F.desc(F.size("alias")), F.desc("source"), "at")
    best = met.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")
    return best.select(*keys, step, item, "alias", "source", "at", F.lit(1.0).alias("similarity"))


def partial_ratio(short: Column, long: Column) -> Column:
    """How much of a shorter text a longer one holds: one less the least edit distance to a window of its length, over that length."""
    n = F.char_length(short)
    windows = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.char_length(long) - n + 1)), lambda i: F.substring(long, i, n))
    least = F.array_min(F.transform(windows, lambda w: F.levenshtein(short, w)))
    return F.when(n > 0, F.greatest(F.lit(0.0), 1 - least / n))


def fuzzy_mentions(steps: DataFrame, names: DataFrame, keys: Sequence[str], step: str, text: str, item: str, least: float = 0.85, shortest: int = 4, generic: Sequence[str] = GENERIC) -> DataFrame:
    """The same columns for aliases that a step nearly holds: all steps and aliases of one recipe meet, which are few; of each step and item the most similar."""
    flat = steps.select(*keys, step, F.array_join(tokens(F.col(text), True), " ").alias("_t")).filter("_t <> ''")
    able = names.withColumn("_a", F.array_join("alias", " ")).filter((F.size("alias") > 1) | (F.char_length("_a") >= shortest)).filter(~F.forall("alias", lambda w: w.isin(*generic)))
    met = flat.join(able, list(keys)).withColumn("similarity", F.when(F.char_length("_a") <= F.char_length("_t"), partial_ratio(F.col("_a"), F.col("_t"))).otherwise(0.0)).filter(F.col("similarity") >= least)
    order = Window.partitionBy(*keys, step, item).orderBy(F.desc("similarity"), F.desc(F.size("alias")), "_a")
    return met.withColumn("_n", F.row_number().over(order)).filter("_n = 1").select(*keys, step, item, "alias", "source", F.lit(None).cast("int").alias("at"), "similarity")


def context(step_tokens: Column, use: Sequence[str] = USE, reference: Sequence[str] = REFERENCE) -> Column:
    """10 where a step uses what it names, -5 where it only refers to it, else 0."""
    has = lambda words: F.arrays_overlap(step_tokens, F.array(*map(F.lit, words)))
    return F.when(has(reference), -5.0).when(has(use), 10.0).otherwise(0.0)


def mention_score(alias: Column, source: Column, context_: Column, similarity: Column, step: Column) -> Column:
    """100 a word, 1 a character and 10 a source; the context, half a hundred for similarity, 5 for several words, and a tenth less for each later step."""
    chars = F.aggregate(alias, F.lit(0).cast("int"), lambda a, w: a + F.char_length(w))
    return F.size(alias) * 100 + chars + source * 10 + context_ + similarity * 50.0 + F.when(F.size(alias) > 1, 5.0).otherwise(0.0) - step * 0.1


#: Shares that words state; a remaining share is -1.
SHARES = {"half": 0.5, "third": 1 / 3, "quarter": 0.25, "remaining": -1.0, "rest": -1.0}


def stated_share(step_tokens: Column, at: Column) -> Column:
    """The share that the three words before a mention state; null for none."""
    before = F.slice(step_tokens, F.greatest(F.lit(1), at - 3), F.least(F.lit(3), at - 1))
    table = F.create_map(*(F.lit(x) for kv in SHARES.items() for x in kv))
    return F.get(F.filter(F.transform(F.reverse(F.when(at > 1, before).otherwise(F.array().cast("array<string>"))), lambda w: F.element_at(table, w)), lambda s: s.isNotNull()), 0)


def shares(uses: DataFrame, keys: Sequence[str], share: str) -> DataFrame:
    """uses with `part`: stated shares as they are, what is left over the remaining ones; even shares where some step states none; null where no step does, or there is one step only."""
    w = Window.partitionBy(*keys)
    stated, rest = F.col(share) >= 0, F.col(share) < 0
    left = 1.0 - F.coalesce(F.sum(F.when(stated, F.col(share))).over(w), F.lit(0.0))
    n, known, remaining = F.count("*").over(w), F.count(share).over(w), F.count(F.when(rest, 1)).over(w)
    part = F.when((n < 2) | (known == 0), F.lit(None).cast("double")).when(known < n, 1.0 / n).when(rest, left / remaining).otherwise(F.col(share))
    return uses.withColumn("part", part)


def linked(steps: DataFrame, ingredients: DataFrame, keys: Sequence[str], step: str, text: str, item: str, name: str) -> DataFrame:
    """keys, item, step, way (exact, stem, fuzzy or all), score, part: the steps that use each ingredient.

    Items found by their words are linked by these; the others by stems, else by likeness. The best step is kept, and
    others that state a share of it. 'All ingredients' in a step takes every item that no other step has.
    """
    words = steps.select(*keys, step, tokens(F.col(text)).alias("_w"))
    ways = []
    for way, names in (("exact", aliases(ingredients, keys, item, name)), ("stem", aliases(ingredients, keys, item, name, True))):
        ways.append(mentions(steps, names, keys, step, text, item, way == "stem").withColumn("way", F.lit(way)))
    ways.append(fuzzy_mentions(steps, aliases(ingredients, keys, item, name, True), keys, step, text, item).withColumn("way", F.lit("fuzzy")))
    found = ways[0].unionByName(ways[1]).unionByName(ways[2])
    rank = F.when(F.col("way") == "exact", 0).when(F.col("way") == "stem", 1).otherwise(2)
    first = found.withColumn("_r", rank).withColumn("_b", F.min("_r").over(Window.partitionBy(*keys, item))).filter("_r = _b").drop("_r", "_b")
    scored = first.join(words, [*keys, step]).withColumn("share", stated_share(F.col("_w"), F.col("at")))
    scored = scored.withColumn("score", mention_score(F.col("alias"), F.col("source"), context(F.col("_w")), F.col("similarity"), F.col(step)))
    placed = scored.withColumn("_n", F.row_number().over(Window.partitionBy(*keys, item).orderBy(F.desc("score"), step)))
    kept = placed.filter((F.col("_n") == 1) | F.col("share").isNotNull())
    uses = shares(kept, [*keys, item], "share").select(*keys, item, step, "way", "score", "part")
    everything = words.filter(F.array_join("_w", " ").rlike(r"\ball (?:the |of the )?(?:remaining )?ingredients\b")).groupBy(*keys).agg(F.min(step).alias(step))
    others = ingredients.select(*keys, item).join(uses.select(*keys, item), [*keys, item], "left_anti").join(everything, list(keys))
    return uses.unionByName(others.select(*keys, item, step, F.lit("all").alias("way"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("part")))
