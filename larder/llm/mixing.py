"""Mixing to target weights: iterative proportional fitting of token weights, then calibrated sampling.

Documents are counted into cells of source, language and topic. Sweeps over the three margins rescale the
cells' weights until every margin has its target share of the tokens. A document's factor is its cell's
weight over the cell's tokens; it is kept with probability min(1, c * factor), where c makes the expected
tokens `keep` of all. Kept documents carry factor / probability, so that weighted tokens meet the targets
also where the probability is held at 1. The draw is a hash of the document's id and text.

Cells are far fewer than documents. Where their count is checked to be small they go to one partition, so
that the sweeps move nothing, and are broadcast to the documents; otherwise the same plan shuffles.

Defined results. Null source, language or topic are values of their own. A null text has no tokens; such a
document has its cell's factor. A cell without tokens has factor 1. Repeated rows get the same draw. No
documents give no rows. Other columns pass through `mix` unchanged; the columns that it adds start with mix_ and
take the place of columns of the same name (whatever the case of its letters).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import every, settled, whole_text

MARGINS = ("mix_source", "mix_lang", "mix_topic")
SWEEPS = 12
KEEP = 0.75
#: Exponents that turn a margin's shares into its targets: 1 keeps them, 0 makes them equal.
TEMPER = {"mix_source": 0.7, "mix_lang": 0.7, "mix_topic": 0.8}
#: Up to so many cells stay in one partition and are broadcast: some 100 bytes each.
SMALL_CELLS = 50_000
#: Places at which each of three passes looks for c.
STEPS = 40
WORDS = r"[^\x20\x09-\x0D]+"


def topic(text: Column) -> Column:
    """A coarse topic by the whole text's form: its share of capitals, length and lines."""
    n, lines = F.char_length(text), F.char_length(text) - F.char_length(F.replace(text, F.lit("\n")))
    capitals = F.regexp_count(text, F.lit("[A-Z]"))
    return F.when((n > 0) & (capitals * 10 >= n * 3), "loud").when(n < 500, "note").when(n >= 10000, "book").when(lines * 200 >= n, "list").otherwise("prose")


def tokens(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORDS)).cast("long")


def described(docs: DataFrame) -> DataFrame:
    text = whole_text()
    return docs.withColumns({"mix_source": F.coalesce(F.col("source").cast("string"), F.lit("")), "mix_lang": F.coalesce(F.col("lang").cast("string"), F.lit("")), "mix_topic": topic(text), "mix_tokens": tokens(text)})


def tempered(cells: DataFrame, margin: str, power: float) -> DataFrame:
    """margin, target: shares of the tokens, each to a power, scaled to 1."""
    by = cells.groupBy(margin).agg(F.sum("tokens").cast("double").alias("m")).withColumn("m", F.pow("m", F.lit(power)))
    total = by.agg(F.sum("m")).first()[0] or 1.0
    return by.select(margin, (F.col("m") / F.lit(total)).alias("target"))


def raked(cells: DataFrame, targets: dict[str, DataFrame], sweeps: int = SWEEPS) -> DataFrame:
    """The cells with weight: their tokens rescaled until each margin's shares are its targets."""
    known = cells
    for margin, t in targets.items():
        known = known.join(t.select(margin, F.col("target").alias(f"to_{margin}")), margin, "left")
    known = known.withColumn("weight", F.col("tokens").cast("double"))
    for _ in range(sweeps):
        for margin in targets:
            now = known.groupBy(margin).agg(F.sum("weight").alias("now"))
            scaled = F.col("weight") * F.coalesce(F.try_divide(F.coalesce(F.col(f"to_{margin}"), F.lit(0.0)) * F.lit(1.0), F.col("now")), F.lit(0.0))
            known = known.join(now, margin).withColumn("weight", scaled).drop("now")
    return known.drop(*(f"to_{m}" for m in targets))


def _rake_small(cells: DataFrame, targets: dict[str, DataFrame], sweeps: int) -> DataFrame:
    """raked() for cells of one partition: windows need no exchange there."""
    from pyspark.sql import Window

    known = cells
    for margin, t in targets.items():
        known = known.join(t.select(margin, F.col("target").alias(f"to_{margin}")), margin, "left")
    known = known.coalesce(1).withColumn("weight", F.col("tokens").cast("double"))
    for _ in range(sweeps):
        for margin in targets:
            now = F.sum("weight").over(Window.partitionBy(margin))
            known = known.withColumn("weight", F.col("weight") * F.coalesce(F.try_divide(F.col(f"to_{margin}"), now), F.lit(0.0)))
    return known.drop(*(f"to_{m}" for m in targets))


def calibrated(cells: DataFrame, keep: float) -> DataFrame:
    """The cells with factor and probability min(1, c * factor), c by bisection over the cells' sums."""
    tokens, weight = (x or 0 for x in cells.agg(F.sum("tokens"), F.sum("weight")).first())
    scale = tokens / weight if weight else 0.0
    cells = cells.withColumn("factor", F.coalesce(F.try_divide(F.col("weight") * F.lit(scale), F.col("tokens")), F.lit(1.0)))
    # Expected tokens at c = 2^k for many k in one pass, then finer steps between the two that enclose the target.
    low, high = -20.0, 20.0
    for _ in range(3):
        steps = [low + (high - low) * i / STEPS for i in range(STEPS + 1)]
        kept = cells.agg(*(F.sum(F.col("tokens") * F.least(F.lit(1.0), F.col("factor") * F.lit(2.0**s))).alias(f"s{i}") for i, s in enumerate(steps))).first()
        if not tokens:
            break
        enough = [i for i in range(STEPS + 1) if kept[f"s{i}"] >= keep * tokens]
        i = enough[0] if enough else STEPS
        low, high = steps[max(0, i - 1)], steps[i]
    return cells.withColumn("probability", F.least(F.lit(1.0), F.col("factor") * F.lit(2.0**high)))


def cells_of(docs: DataFrame, temper: dict[str, float] = TEMPER, keep: float = KEEP, sweeps: int = SWEEPS, targets: Callable | None = None) -> tuple[DataFrame, int]:
    """The cells with factor and probability, and how many there are. docs: from described(). targets(cells) may give own targets."""
    cells = settled(docs.groupBy(*MARGINS).agg(F.sum("mix_tokens").alias("tokens"), F.count("*").alias("documents")), "cells")
    n = cells.count()
    if n <= SMALL_CELLS:
        cells = cells.coalesce(1)
    wanted = targets(cells) if targets else {m: tempered(cells, m, temper[m]) for m in MARGINS}
    if n <= SMALL_CELLS:
        fitted = settled(_rake_small(cells, wanted, sweeps), "raked")
    else:
        fitted = cells
        for _ in range(sweeps):  # a written table cuts the plan
            fitted = settled(raked(fitted.drop("weight"), wanted, 1) if "weight" not in fitted.columns else _again(fitted, wanted), "raked")
    return settled(calibrated(fitted, keep), "calibrated"), n


def _again(cells: DataFrame, targets: dict[str, DataFrame]) -> DataFrame:
    """One more sweep over cells that have weights."""
    start = cells.withColumnRenamed("tokens", "kept_tokens").withColumnRenamed("weight", "tokens")
    return raked(start, targets, 1).drop("tokens").withColumnRenamed("kept_tokens", "tokens")


def mix(docs: DataFrame, temper: dict[str, float] = TEMPER, keep: float = KEEP, sweeps: int = SWEEPS, targets: Callable | None = None, seed: int = 7) -> DataFrame:
    """docs with mix_source, mix_lang, mix_topic, mix_tokens, mix_factor, mix_probability, mix_kept and mix_weight."""
    added = [*MARGINS, "mix_tokens", "mix_factor", "mix_probability", "mix_kept", "mix_weight"]
    docs = docs.select(*(x for c, x in zip(docs.columns, every(docs)) if c.lower() not in added))
    known = described(docs)
    cells, n = cells_of(known, temper, keep, sweeps, targets)
    fitted = cells.select(*MARGINS, F.col("factor").alias("mix_factor"), F.col("probability").alias("mix_probability"))
    joined = known.join(F.broadcast(fitted) if n <= SMALL_CELLS else fitted, list(MARGINS), "left")
    draw = F.conv(F.substring(F.sha2(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.sha2(whole_text().cast("binary"), 256)).cast("binary"), 256), 1, 13), 16, 10).cast("double") / F.lit(2.0**52)
    return joined.withColumn("mix_kept", draw < F.col("mix_probability")).withColumn("mix_weight", F.col("mix_factor") / F.col("mix_probability")).select(*every(docs), *added)
