"""Rows of blocks: how a block of text splits into lines that mean one thing each, what each line is, and its label among its neighbours.

Features, roles and labels are column expressions and windows; splitting is a function of one block's text.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions import recipes as R
from larder.functions.fields import cascade, let
from larder.functions.text import title_like

INGREDIENT_HEADERS = ("ingredients", "ingredient list", "you will need", "for the ingredients")
INSTRUCTION_HEADERS = ("instructions", "directions", "method", "preparation", "steps")


@dataclass(frozen=True)
class Splitting:
    """Words that begin something new, and how long prose rows may be."""

    units: tuple[str, ...] = R.UNITS
    verbs: tuple[str, ...] = R.VERBS
    yields: tuple[str, ...] = ("makes", "serves?", "servings", "yields?")
    headings: tuple[str, ...] = ("to make", "to serve", "for serving", "for garnish", "for the")
    long: int = 320
    fair: int = 220
    absurd: int = 450
    small: int = 70


_NUMBER = r"(?:\d+\s+\d+/\d+|\d+/\d+|\d+(?:\.\d+)?(?:\s*(?:to|-)\s*\d+(?:\.\d+)?)?)"
_QUANTITY = re.compile(rf"(?<![\w/.]){_NUMBER}\s+(?=[A-Za-z])", re.I)
_SENTENCE_END = re.compile(r"""(?:[!?]|\.(?!\d))["')\]}”’]*(?=\s+["'(\[{“‘]*[A-Z\d]|\s*$)""")


def tidy(text: str) -> str:
    """One line, one blank between words, fractions without blanks."""
    return re.sub(r"(?<!\d)(\d+)\s*/\s*(\d+)(?!\d)", r"\1/\2", " ".join(text.split()))


def sentence_spans(text: str) -> list[tuple[int, int]]:
    """Places of the sentences of a line; a point between digits ends none."""
    spans, start = [], 0
    for m in _SENTENCE_END.finditer(text):
        spans.append((start, m.end()))
        start = m.end() + len(text[m.end() :]) - len(text[m.end() :].lstrip())
    return spans + [(start, len(text))] if start < len(text) else spans


@lru_cache
def _cues(s: Splitting) -> list[re.Pattern]:
    """What a new row begins with: notes, yields with an amount, headings of components, numbered steps."""
    amount = r"(?=\W+(?:about |around |approximately )?(?:\d|a |an |one|two|three|four|five|six|eight|ten|twelve))"
    return [
        re.compile(r"(?<![A-Za-z0-9])note\s*:", re.I),
        re.compile(rf"(?<![A-Za-z0-9])(?<!to )(?:{'|'.join(s.yields)})\b{amount}", re.I),
        re.compile(rf"(?:(?<=[.!?;:]\s)|^)(?:{'|'.join(s.headings)})\b[^.!?]{{0,40}}(?=:|$)", re.I),
        re.compile(r"(?<!\w)(?:step\s*)?\d{1,2}[.)]\s+(?=\D)", re.I),
    ]


def _is_control(row: str, cues: Sequence[re.Pattern]) -> bool:
    return any(c.match(row) for c in cues)


def _quantity_runs(row: str, s: Splitting) -> list[str]:
    """A row of several ingredients as one row for each quantity; prose with numbers stays whole."""
    starts = [m.start() for m in _QUANTITY.finditer(row)]
    if len(starts) < 2:
        return [row]
    parts = [row[a:b].strip(" ,;") for a, b in zip(starts, [*starts[1:], len(row)])]
    head = row[: starts[0]].strip(" ,;")
    words = len(head.split())
    unit = re.compile(rf"\b(?:{'|'.join(s.units)})\b", re.I)
    verbs = re.compile(rf"\b(?:{'|'.join(s.verbs)})\b", re.I)
    # A verb, a sentence, or a dangling part such as "1 cup/" say that the numbers belong together.
    if verbs.search(head) or words > 6 or any(not p or p.endswith(("/", "-")) or verbs.match(p.split(maxsplit=1)[-1]) for p in parts):
        return [row]
    if re.search(r"[.!?]\s+[A-Z]", row) or sum(bool(unit.search(p)) for p in parts) * 2 < len(parts):
        return [row]
    return ([head] if head else []) + parts


def _structural(row: str, s: Splitting, cues: Sequence[re.Pattern]) -> bool:
    """Rows that prose repair leaves alone: controls, headings, ingredients."""
    few = len(row.split()) <= 8 and row[-1:] not in ".!?"
    quantity = re.match(rf"\s*{_NUMBER}\s", row) is not None
    return _is_control(row, cues) or row.endswith(":") or (quantity and len(row) < 90) or (few and row[:1].isupper() and row == row.title())


def _prose(rows: list[str], s: Splitting, cues: Sequence[re.Pattern]) -> list[str]:
    """Rows broken within a sentence are joined; long ones are split at sentences, small sentences staying with the one before."""
    joined: list[str] = []
    for row in rows:
        last = joined[-1] if joined else ""
        if last and not _structural(last, s, cues) and not _structural(row, s, cues) and not last.rstrip("\"')]}”’").endswith((".", "!", "?")) and row[:1].islower():
            joined[-1] = f"{last} {row}"
        else:
            joined.append(row)
    out: list[str] = []
    for row in joined:
        spans = sentence_spans(row)
        needs = len(row) > s.long or len(spans) >= 3 or (len(row) > s.fair and len(spans) >= 2)
        if _structural(row, s, cues) or not needs:
            out.append(row)
            continue
        parts: list[str] = []
        for a, b in spans:
            sentence = row[a:b].strip()
            if parts and (len(sentence) < s.small or len(parts[-1]) < s.small) and len(parts[-1]) + len(sentence) < s.fair:
                parts[-1] = f"{parts[-1]} {sentence}"
            else:
                parts.append(sentence)
        for part in parts:
            while len(part) > s.absurd:
                cut = max(part.rfind(", ", s.fair // 2, s.absurd), part.rfind(": ", s.fair // 2, s.absurd))
                cut = cut + 1 if cut > 0 else part.rfind(" ", 1, s.absurd)
                if cut <= 0:
                    break
                out.append(part[:cut].strip())
                part = part[cut:].strip()
            out.append(part)
    return out


def split_text(text: str, s: Splitting = Splitting()) -> list[str]:
    """The rows of a block."""
    rows, cues = [tidy(text)], _cues(s)
    for cue in cues:
        rows = [p for r in rows for p in _cut(r, [m.start() for m in cue.finditer(r) if m.start()])]
    # A semicolon parts for good; what cues or quantities part may be joined again.
    groups: list[list[str]] = [[]]
    for row in rows:
        first, *more = row.split(";")
        groups[-1].append(first)
        groups += [[m] for m in more]
    split = lambda r: [r] if _is_control(r, cues) else _quantity_runs(r, s)
    return [p for g in groups for p in _prose([x.strip(" ,") for r in g if r.strip(" ,") for x in split(r.strip(" ,")) if x.strip(" ,")], s, cues)]


def _cut(row: str, starts: Sequence[int]) -> list[str]:
    return [p for a, b in zip([0, *starts], [*starts, len(row)]) if (p := row[a:b].strip(" ,;"))]


def offsets(text: str, rows: Sequence[str]) -> list[tuple[int, int]]:
    """Where the rows stand in the text, one after another, white space aside; a row that isn't found stands at the end of the one before, empty."""
    out, cursor, bare, places = [], 0, None, []
    for row in rows:
        row_bare = "".join(row.split())
        if not row_bare:
            out.append((cursor, cursor))
            continue
        at = cursor
        while at < len(text) and text[at].isspace():
            at += 1
        if text.startswith(row, at) and not row[0].isspace():  # nothing can match earlier
            end = at + len(row.rstrip())
        else:
            if bare is None:  # the text without white space, and where its characters stand
                bare, places = "".join(text.split()), [i for i, c in enumerate(text) if not c.isspace()]
            found = bare.find(row_bare, bisect_left(places, cursor))
            at, end = (places[found], places[found + len(row_bare) - 1] + 1) if found >= 0 else (cursor, cursor)
        out.append((at, end))
        cursor = end
    return out


def rule_tags(x: Column, units: Sequence[str] = R.UNITS, verbs: Sequence[str] = R.VERBS) -> Column:
    """What a row looks like by itself, as names; several may hold."""
    return let(R.line_kind(x, units, verbs), lambda kind: let(F.lower(F.trim(x)), lambda low: _rule_tags(x, kind, low)))


def _rule_tags(x: Column, kind: Column, low: Column) -> Column:
    words = F.size(F.split(F.trim(x), r"\s+"))
    timed = low.rlike(r"\b\d+\s*(?:seconds?|secs?|minutes?|mins?|hours?|hrs?)\b")
    prose = (words >= 10) & F.trim(x).rlike(r"[.!?][\"')]*$")
    tags = {
        "note_prefix": kind == "note", "yield_prefix": kind == "yield", "time_metadata": kind == "time", "heading": (kind == "heading") | (F.endswith(low, F.lit(":")) & (words <= 8)),
        "numbered": kind == "numbered", "ingredient_like": kind == "ingredient", "instruction_like": kind.isin("instruction", "numbered"), "instruction_with_time": kind.isin("instruction", "numbered") & timed,
        "variant_heading": low.rlike(r"^variations?\b.{0,30}$"), "title_like": title_like(x) & (kind == "prose"), "prose": prose & (kind == "prose"),
        "advice": low.rlike(r"\b(?:you can|you may|if you like|if desired|make sure|do not|don't|the key is)\b"), "storage": low.rlike(r"\b(?:keeps? (?:for|up to)|store (?:in|at)|refrigerate (?:for|up to)|freezes? well|leftovers)\b"),
    }
    return F.filter(F.array(*(F.when(c, F.lit(n)) for n, c in tags.items())), lambda t: t.isNotNull())


def source_rows(blocks: DataFrame, key: str, block: str, text: str, rules: Splitting = Splitting()) -> DataFrame:
    """key, row, block, ordinal, start, end, text, row_id, tags: the rows of each block with their places in its text."""
    names = [key, "block", "ordinal", "start", "end", "text"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for k, b, t in zip(batch[key], batch[block], batch[text]):
                rows = split_text(t or "", rules)
                out += [(k, b, i, *at, r) for i, (r, at) in enumerate(zip(rows, offsets(t or "", rows)))]
            yield pd.DataFrame(out, columns=names)

    kinds = [blocks.schema[c].dataType.simpleString() for c in (key, block)]
    split = blocks.select(key, block, text).mapInPandas(run, f"{key} {kinds[0]}, block {kinds[1]}, ordinal int, start int, end int, text string")
    w = Window.partitionBy(key).orderBy("block", "ordinal")
    row_id = F.concat_ws(":", F.lit("urn:row"), F.col(key).cast("string"), F.col("block").cast("string"), F.col("ordinal").cast("string"))
    return split.select(key, (F.row_number().over(w) - 1).alias("row"), "block", "ordinal", "start", "end", "text", row_id.alias("row_id"), rule_tags(F.col("text"), rules.units, rules.verbs).alias("tags"))


def ordered_blocks(blocks: DataFrame, keys: Sequence[str], order: str, id_: str, text: str) -> DataFrame:
    """Blocks with text, and their place (from 0) by order and id beside the order itself."""
    kept = blocks.filter(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " ")) != "")
    return kept.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(order, id_)) - 1)


def atoms(blocks: DataFrame, key: str, block: str, text: str) -> DataFrame:
    """key, block, atom, kind, text: paragraphs (parted by blank lines) as one line each, and list items, each its own."""
    item = r"^\s*(?:[-*•]|\d+[.)])\s+"
    # A marker that no text holds stands where an atom begins.
    marked = F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), r"\n\s*\n", "\u0001"), r"(?m)^(?=\s*(?:[-*•]|\d+[.)])\s)", "\u0001")
    # A line after a list item is a paragraph of its own unless it is indented.
    parts = blocks.select(key, F.col(block).alias("block"), F.posexplode(F.split(marked, "\u0001")).alias("_i", "_t"))
    line = F.trim(F.regexp_replace("_t", r"\s+", " "))
    rows = parts.withColumn("kind", F.when(F.col("_t").rlike(item), "item").otherwise("paragraph")).withColumn("text", F.trim(F.regexp_replace(line, r"^(?:[-*•]|\d+[.)])\s+", ""))).filter("text <> ''")
    w = Window.partitionBy(key, "block").orderBy("_i")
    return rows.select(key, "block", (F.row_number().over(w) - 1).alias("atom"), "kind", "text")


def features(x: Column, units: Sequence[str] = R.UNITS, verbs: Sequence[str] = R.VERBS, ingredient_headers: Sequence[str] = INGREDIENT_HEADERS, instruction_headers: Sequence[str] = INSTRUCTION_HEADERS) -> Column:
    """A struct of what a block looks like: quantity, unit, number, verb (among its first three words), headers, yield and time."""
    t = F.trim(F.coalesce(x, F.lit("")))
    low = F.regexp_replace(F.lower(t), ":+$", "")
    quantity, unit, number = R.starts_with_quantity(t), R.has_unit(t, units), t.rlike(r"^(?:step\s*)?\d{1,2}[.)]\s")
    first = F.slice(F.split(F.lower(t), r"\s+"), 1, 3)
    verb = F.exists(first, lambda w: F.regexp_replace(w, r"^[.,:;]+|[.,:;]+$", "").isin(*verbs))
    # Title case: every run of letters begins in upper and goes on in lower case.
    title_case = t.rlike(r"\p{L}") & ~t.rlike(r"(?<!\p{L})\p{Ll}|\p{L}\p{Lu}")
    is_ingredient, is_instruction = low.isin(*ingredient_headers), low.isin(*instruction_headers)
    kind = R.line_kind(t, units, verbs)
    short = F.char_length(F.coalesce(x, F.lit(""))) < 50
    parts = {
        "quantity": quantity, "unit": unit, "ingredient": quantity & unit, "number": number, "verb": verb, "instruction": number | verb, "short": short, "title_case": title_case,
        "header": short & (title_case | is_ingredient | is_instruction | F.endswith(t, F.lit(":"))), "ingredient_header": is_ingredient, "instruction_header": is_instruction, "is_yield": kind == "yield", "is_time": kind == "time",
    }
    return F.struct(*(c.alias(n) for n, c in parts.items()))


def block_role(x: Column, f: Column, heading_level: Column) -> Column:
    """One of metadata, ingredient_line, instruction_line, section_heading, recipe_title, tip_like, narrative, other; heading_level is null for text."""
    t = F.trim(F.coalesce(x, F.lit("")))
    words = F.size(F.filter(F.split(t, r"\s+"), lambda w: w != ""))
    tip = F.lower(t).rlike(r"^(?:note|tip|hint|variation|(?:chef|cook)'?s?\s+(?:note|tip))\s*[:—–-]")
    return cascade(
        (t == "", "other"), (f["is_yield"] | f["is_time"], "metadata"), (f["ingredient_header"] | f["ingredient"] | f["quantity"], "ingredient_line"), (f["instruction_header"] | f["instruction"], "instruction_line"),
        ((heading_level <= 2) & (F.char_length(t) < 60), "section_heading"), (heading_level.isNotNull() & (F.char_length(t) <= 80), "recipe_title"), (heading_level.isNotNull(), "section_heading"),
        (tip, "tip_like"), (words >= 4, "narrative"), other="other",
    )


#: Labels of the policy.
TITLE, INGREDIENT, INSTRUCTION, HOWTO, YIELD, TIME, NOTES, VARIANT, OTHER = "RECIPE_TITLE", "INGREDIENT_LINE", "INSTRUCTION_LINE", "HOWTO_SECTION", "YIELD_LINE", "TIME_LINE", "RECIPE_NOTES", "RECIPE_VARIANT", "OTHER"


def line_roles(rows: DataFrame, keys: Sequence[str], pos: str, text: str, tags: str, inside: str | None = None, ahead: int = 6, near: int = 3) -> DataFrame:
    """rows with label and reason by what a row looks like and what stands around it; both null where rules don't decide.

    A title needs an ingredient or a yield within the next `ahead` rows, with no other title between; a heading counts as
    one of a component where a recipe's lines stand within `near` rows; lines after a heading of variations, up to the
    next heading or title, belong to it. inside (true, false, null for unknown) says whether the row is in a recipe.
    """
    has = lambda *names: F.arrays_overlap(F.col(tags), F.array(*map(F.lit, names)))
    w = Window.partitionBy(*keys).orderBy(pos)
    within = F.col(inside) if inside else F.lit(None).cast("boolean")
    marked = rows.withColumns({"_core": has("ingredient_like", "yield_prefix"), "_line": has("ingredient_like", "instruction_like", "yield_prefix"), "_in": within})
    marked = marked.withColumn("_near", F.coalesce(F.max("_line").over(w.rowsBetween(-near, near)), F.lit(False)))
    after = w.rowsBetween(1, ahead)
    marked = marked.withColumn("_like", has("title_like") & ~has("prose", "heading"))
    next_core, next_like = (F.min(F.when(F.col(c), F.col(pos))).over(after) for c in ("_core", "_like"))
    between = F.coalesce(F.lag("_core").over(w) & F.lead("_core").over(w), F.lit(False))
    marked = marked.withColumn("_title", F.col("_like") & next_core.isNotNull() & F.coalesce(next_like > next_core, F.lit(True)) & ~between)
    stop = F.when(has("variant_heading"), 1).when(has("heading") | F.col("_title"), 0)
    marked = marked.withColumn("_variant", F.coalesce(F.last(stop, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)) == 1, F.lit(False)))
    outside, prose = ~F.coalesce("_in", F.lit(True)), has("prose") & ~has("ingredient_like", "yield_prefix", "heading")
    rules = [
        ("variant_heading", has("variant_heading"), VARIANT), ("variant_run", F.col("_variant") & ~has("heading") & ~F.col("_title") & ~has("yield_prefix"), VARIANT), ("note_prefix", has("note_prefix"), NOTES),
        ("storage_note", has("storage") & ~has("instruction_like", "ingredient_like"), NOTES), ("outside_advice", outside & has("advice") & prose, NOTES), ("outside_prose", outside & prose, OTHER), ("unknown_prose", F.col("_in").isNull() & prose & ~has("advice"), OTHER),
        ("yield_prefix", has("yield_prefix"), YIELD), ("time_metadata", has("time_metadata") & ~has("instruction_like"), TIME), ("howto_heading", has("heading") & F.col("_near"), HOWTO), ("title_like", F.col("_title"), TITLE),
        ("ingredient_like", has("ingredient_like"), INGREDIENT), ("instruction_with_time", has("instruction_with_time"), INSTRUCTION), ("instruction_like", has("instruction_like"), INSTRUCTION), ("advice", has("advice") & prose, NOTES), ("outside", outside, OTHER),
    ]
    label, reason = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, when, value in reversed(rules):
        label, reason = F.when(when, value).otherwise(label), F.when(when, name).otherwise(reason)
    return marked.withColumns({"label": label, "reason": reason}).drop("_core", "_line", "_in", "_near", "_like", "_title", "_variant")


def fallback_label(label: Column, inside: Column, why: str) -> Column:
    """A struct of label and reasons where rules or a model leave a row open: notes within a recipe, else a candidate of what isn't one."""
    known = label.isNotNull()
    other = F.when(F.coalesce(inside, F.lit(False)), NOTES).otherwise("NONRECIPE_CANDIDATE")
    return F.struct(F.coalesce(label, other).alias("label"), F.array(F.lit(why), F.when(known, "recovered").otherwise("unavailable")).alias("reasons"))


def spans_of_labels(rows: DataFrame, keys: Sequence[str], pos: str, label: str, allowed: Sequence[str], other: str = OTHER) -> DataFrame:
    """rows with line (their place from 0) and label: upper case, those that aren't allowed as other."""
    clean = F.upper(F.trim(F.coalesce(F.col(label), F.lit(""))))
    return rows.withColumns({"line": F.row_number().over(Window.partitionBy(*keys).orderBy(pos)) - 1, label: F.when(clean.isin(*allowed), clean).otherwise(other)})


def span_decisions(rows: DataFrame, keys: Sequence[str], pos: str, label: str, title: str = TITLE, needed: Sequence[str] = (INGREDIENT, INSTRUCTION)) -> DataFrame:
    """keys (with the span's), start, end, n, title_row, missing, accepted, reason: a span is a recipe if it has a title and one of each needed label."""
    has = lambda name: F.coalesce(F.max(F.col(label) == name), F.lit(False))
    sums = rows.groupBy(*keys).agg(F.min(pos).alias("start"), F.max(pos).alias("end"), F.count("*").alias("n"), F.min(F.when(F.col(label) == title, F.col(pos))).alias("title_row"), *(has(n).alias(f"_{i}") for i, n in enumerate(needed)))
    missing = F.filter(F.array(*(F.when(~F.col(f"_{i}"), F.lit(n)) for i, n in enumerate(needed))), lambda x: x.isNotNull())
    out = sums.withColumn("missing", missing).drop(*(f"_{i}" for i in range(len(needed))))
    reason = F.when(F.col("title_row").isNull(), "no title").when(F.size("missing") == len(needed), "no recipe lines").when(F.size("missing") > 0, F.concat(F.lit("no "), F.get("missing", F.lit(0))))
    return out.withColumn("reason", reason).withColumn("accepted", F.col("reason").isNull())


def trimmed_starts(spans: DataFrame, pairs: DataFrame, keys: Sequence[str], reach: int = 8, most: int = 40) -> DataFrame:
    """spans (start, end) with trimmed: the later of the first pair of repeated titles (first, second) near a span's start, if it is inside and not too far."""
    p = pairs.select(*keys, F.col("first").alias("_f"), F.col("second").alias("_s"))
    near = (F.col("_f") >= F.col("start")) & (F.col("_f") <= F.col("start") + reach) & (F.col("_s") > F.col("start")) & (F.col("_s") < F.col("end")) & (F.col("_s") - F.col("start") <= most)
    hit = spans.select(*keys, "start", "end").join(p, list(keys)).filter(near).groupBy(*keys, "start", "end").agg(F.min(F.struct("_f", "_s"))["_s"].alias("trimmed"))
    return spans.join(hit, [*keys, "start", "end"], "left").withColumn("trimmed", F.coalesce("trimmed", "start"))


def settled_categories(rows: DataFrame, row: str, categories: DataFrame, excluded: DataFrame, category: str, other: str = "other") -> DataFrame:
    """row, category of rows with a final say: excluded ones are other, else what categories says; only rows that exist."""
    known = rows.select(row).distinct()
    out = excluded.select(row).distinct().withColumn("_x", F.lit(True))
    said = categories.groupBy(row).agg(F.max(category).alias(category))
    joined = known.join(said, row, "left").join(out, row, "left")
    return joined.filter(F.col(category).isNotNull() | F.col("_x")).select(row, F.when(F.col("_x"), other).otherwise(F.col(category)).alias(category))


def refined_categories(current: DataFrame, candidates: DataFrame, updates: DataFrame, row: str, category: str) -> DataFrame:
    """row, category, before, changed, reviewed: updates count for candidate rows only; a change needs an earlier category that differs."""
    allowed = updates.groupBy(row).agg(F.max(category).alias("_new")).join(candidates.select(row).distinct(), row, "left_semi")
    both = current.select(row, F.col(category).alias("before")).join(allowed, row, "full")
    reviewed = F.col("_new").isNotNull()
    return both.select(row, F.coalesce("_new", "before").alias(category), "before", (reviewed & F.coalesce(F.col("_new") != F.col("before"), F.lit(False))).alias("changed"), reviewed.alias("reviewed"))


def evidence(settled: DataFrame, candidates: DataFrame, row: str, category: str, wanted: str = "knowledge") -> DataFrame:
    """row, state: rows of the wanted category, and candidates without a final say (unresolved)."""
    sure = settled.filter(F.col(category) == wanted).select(row, F.lit(wanted).alias("state"))
    open_ = candidates.select(row).distinct().join(settled.select(row), row, "left_anti").withColumn("state", F.lit("unresolved"))
    return sure.unionByName(open_)


def rows_in_range(rows: DataFrame, wanted: DataFrame, keys: Sequence[str], line: str, row: str) -> DataFrame:
    """keys, id and row of the rows whose line lies in a wanted range (id, s, e), else in the range shifted by -1, then by 1; where no line does, the same by row number.

    The six ways are one equi-join on the key; each id keeps the first that finds anything.
    """
    joined = wanted.select(*keys, "id", "s", "e").join(rows.select(*keys, line, F.col(row).alias("_row")), list(keys))
    ways = [F.when(F.col(c).between(F.col("s") + d, F.col("e") + d), F.lit(i)) for i, (c, d) in enumerate([(c, d) for c in (line, "_row") for d in (0, -1, 1)])]
    found = joined.withColumn("_way", F.explode(F.filter(F.array(*ways), lambda x: x.isNotNull())))
    first = found.groupBy(*keys, "id").agg(F.min("_way").alias("_way"))
    return found.join(first, [*keys, "id", "_way"]).select(*keys, "id", F.col("_row").alias(row))


def split_variants(steps: Column) -> Column:
    """A struct of variants and remaining: lines after a heading of variations, up to the next heading, and lines that begin with one; the heading goes."""
    low = lambda x: F.lower(F.trim(x))
    heading = lambda x: low(x).rlike(r"^(?:variations?|variants?)\s*:?$")
    section = lambda x: low(x).rlike(r"^(?:for the .{1,40}|ingredients|directions|instructions|method|notes?|to serve)\s*:?$")
    inline = lambda x: low(x).rlike(r"^(?:variations?|variants?)\s*[:—–-]\s*\S")
    start = F.struct(F.array().cast("array<string>").alias("variants"), F.array().cast("array<string>").alias("remaining"), F.lit(False).alias("on"))

    def step(acc: Column, x: Column) -> Column:
        opens, closes = heading(x), acc["on"] & section(x)
        variant = ~opens & ~closes & (acc["on"] | inline(x))
        add = lambda old, when, value: F.when(when, F.concat(old, F.array(value))).otherwise(old)
        return F.struct(add(acc["variants"], variant, F.trim(x)).alias("variants"), add(acc["remaining"], ~opens & ~variant, x).alias("remaining"), (opens | (acc["on"] & ~closes)).alias("on"))

    folded = F.aggregate(F.coalesce(steps, F.array().cast("array<string>")), start, step)
    return F.struct(folded["variants"].alias("variants"), folded["remaining"].alias("remaining"))

