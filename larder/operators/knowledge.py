"""What isn't a recipe: chunks of prose by lane (knowledge or noise), their topics and highlights, and tips with tags.

Scores are sums of cues over a text; cues are tables of patterns and weights that can be given. Lanes and tips are column
expressions, tags are an equi-join of words with a small table, and containers of topics are a fold over one sequence. Where `may` is given
(by `cues_of`), a pattern runs only where its cue may occur.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions import recipes as R
from larder.functions.cues import cue_bits, cues_of
from larder.functions.fields import let
from larder.operators.folds import cut_by_size, per_sequence
from larder.operators.steps import tokens


@dataclass(frozen=True)
class Lanes:
    """Patterns of knowledge and of narrative (pattern to weight and cap, for 500 characters), and of noise (pattern to points a hit and cap)."""

    knowledge: Mapping[str, tuple[float, float]] = field(
        default_factory=lambda: {
            r"\b(?:use|add|keep|avoid|try|choose|store|heat|cook|let)\b": (0.05, 0.3), r"\b(?:should|must|can|may|need to)\b": (0.04, 0.2), r"\b(?:because|so that|causes?|which means|prevents?|allows?)\b": (0.1, 0.3),
            r"\b(?:if (?:it|the|your)|when (?:it|the)|too (?:dry|wet|hot|thick|thin))\b": (0.1, 0.2), r"\b\d+\s*(?:°|degrees?|minutes?|hours?)": (0.05, 0.15),
        }
    )
    narrative: Mapping[str, tuple[float, float]] = field(default_factory=lambda: {r"\b(?:i|my|me|we|our)\b": (0.03, 0.3), r"\b(?:love|favou?rite|delicious|wonderful)\b": (0.1, 0.2)})
    anecdote: str = r"\b(?:when i was|years ago|i remember|my (?:mother|grandmother|father)|one day)\b"
    mechanism: str = r"\b(?:because|so that|causes?|which means|prevents?|allows?)\b"
    noise: Mapping[str, tuple[float, float]] = field(default_factory=lambda: {r"\b(?:brilliant|stunning|beautiful|must-have|masterpiece|essential)\b": (0.1, 0.3), r"\b(?:this book|these pages|author|chapter|cookbook|publisher)\b": (0.1, 0.3)})
    marketing: str = r"\b(?:bestselling|award-winning|praise for|available now|copyright|all rights reserved|isbn)\b"
    front_titles: tuple[str, ...] = ("introduction", "preface", "foreword", "acknowledgments", "about the author", "dedication")
    navigation_titles: tuple[str, ...] = ("contents", "table of contents", "index", "cover", "title page", "copyright")

    def patterns(self) -> list[str]:
        return [*self.knowledge, FIRST_PERSON, *self.narrative, self.anecdote, self.mechanism, *self.noise, self.marketing]


FIRST_PERSON = r"\bi\b"
May = Mapping[str, Column]


def _hits(x: Column, pattern: str, may: May | None = None) -> Column:
    return _where(pattern, F.regexp_count(x, F.lit(f"(?i){pattern}")), F.lit(0), may)


def _occurs(x: Column, pattern: str, may: May | None = None) -> Column:
    return _where(pattern, x.rlike(f"(?i){pattern}"), F.lit(False), may)


def _where(pattern: str, value: Column, none: Column, may: May | None) -> Column:
    return F.when(may[pattern], value).otherwise(none) if may and pattern in may else value


def _clamp(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def _cues(x: Column, table: Mapping[str, tuple[float, float]], scale: Column, may: May | None = None) -> Column:
    out = F.lit(0.0)
    for pattern, (weight, cap) in table.items():
        out = out + F.least(F.lit(cap), _hits(x, pattern, may) * F.lit(weight) * scale)
    return out


def _if(when: Column, points: float) -> Column:
    return F.when(when, points).otherwise(0.0)


def knowledge_score(x: Column, c: Lanes = Lanes(), may: May | None = None) -> Column:
    scale = F.lit(500.0) / F.greatest(F.char_length(x), F.lit(1))
    return _clamp(_cues(x, c.knowledge, scale, may) - _if(_occurs(x, FIRST_PERSON, may), 0.1) - _if(_occurs(x, c.anecdote, may), 0.15))


def narrative_score(x: Column, c: Lanes = Lanes(), may: May | None = None) -> Column:
    scale = F.lit(500.0) / F.greatest(F.char_length(x), F.lit(1))
    return _clamp(_cues(x, c.narrative, scale, may) + _if(_occurs(x, c.anecdote, may), 0.3) - _if(_occurs(x, c.mechanism, may), 0.15))


def noise_score(x: Column, title: Column, c: Lanes = Lanes(), may: May | None = None) -> Column:
    """Praise, talk of books, marketing, front matter and navigation by title, and texts that are mostly quoted lines."""
    t = F.regexp_replace(F.lower(F.trim(F.coalesce(title, F.lit("")))), r"\s*:+$", "")
    lines = F.filter(F.transform(F.split(x, "\n"), lambda v: F.trim(v)), lambda v: v != "")
    quoted = let(lines, lambda v: F.size(F.filter(v, lambda q: q.rlike(r"""^["“].*["”]$"""))) / F.greatest(F.size(v), F.lit(1)))
    quotes = F.contains(x, F.lit('"')) | F.contains(x, F.lit("“"))
    short = (F.char_length(x) < 300) & _occurs(x, next(iter(c.noise)), may) & ~_occurs(x, next(iter(c.knowledge)), may)
    return _clamp(_cues(x, c.noise, F.lit(1.0), may) + _if(t.isin(*c.front_titles), 0.3) + _if(t.isin(*c.navigation_titles), 0.85) + _if(_occurs(x, c.marketing, may), 0.45) + _if(quotes & (quoted > 0.5), 0.3) + _if(short, 0.2))


def lane(x: Column, title: Column, has_table: Column, roles: Mapping[str, Column] | None = None, c: Lanes = Lanes(), may: May | None = None) -> Column:
    """knowledge or noise. roles: the number of blocks of each role of the chunk; recipe-like and tip-like ones speak for knowledge, others for noise."""
    k, n = knowledge_score(x, c, may), narrative_score(x, c, may)
    if roles:
        total = F.greatest(sum((v for v in list(roles.values())[1:]), next(iter(roles.values()))), F.lit(1))
        share = lambda *names: sum((roles.get(v, F.lit(0)) for v in names[1:]), roles.get(names[0], F.lit(0))) / total
        k = F.least(F.lit(1.0), k + share("ingredient_line", "instruction_line", "recipe_title", "metadata") * 0.25 + F.least(F.lit(0.1), share("tip_like") * 0.15))
        n = F.least(F.lit(1.0), n + share("other") * 0.1)
    # Each score is worked out once, and that of knowledge only where that of narrative speaks for noise.
    decided = lambda k, n: F.when((k >= 0.5) & (k > n), "knowledge").when((n >= 0.4) & (n > k), "noise").when(k >= 0.3, "knowledge").when(n >= 0.2, "noise").otherwise("knowledge")
    by_score = let(n, lambda n: F.when(n < 0.2, "knowledge").otherwise(let(k, lambda k: decided(k, n))))
    return F.when(F.coalesce(has_table, F.lit(False)), "knowledge").when(noise_score(x, title, c, may) >= 0.6, "noise").otherwise(by_score)


def topic_key(headings: Column, tags: Column) -> Column:
    """The path of headings, else the sorted tags; null for neither."""
    path = F.array_join(F.filter(F.transform(F.coalesce(headings, F.array().cast("array<string>")), lambda h: F.lower(F.trim(h))), lambda h: h != ""), " > ")
    sorted_tags = F.array_join(F.array_sort(F.array_distinct(F.coalesce(tags, F.array().cast("array<string>")))), ",")
    return F.coalesce(F.nullif(path, F.lit("")), F.nullif(sorted_tags, F.lit("")))


#: Cues of tips: points if a pattern occurs.
TIP_CUES = {
    r"^(?:always|never|don't|do not|make sure|remember|use|try|avoid|keep|store|choose|let|add)\b": 0.35, r"\b(?:should|must|always|never|be sure|make sure)\b": 0.3, r"\b(?:best|better|instead|ideal|recommend|works well)\b": 0.2,
    r"\b(?:if|when|unless|until)\b": 0.1, r"\b(?:if (?:it|the|your).{1,40}(?:too|not)|means (?:it|the)|sign (?:of|that))\b": 0.35, r"\b(?:keeps|prevents?|helps?|ensures?|makes it)\b": 0.3, r"\b(?:because|so that|since)\b": 0.2,
}
PREFIXES = {"strong": 0.6, "weak": 0.35}


PREFIX_PATTERNS = {"strong": r"^(?:pro |chef'?s? |cook'?s? )?(?:tips?|hint|secret|trick)\s*[:—–-]", "weak": r"^(?:note|nb|remember)\s*[:—–-]"}


def tip_prefix(x: Column, may: May | None = None) -> Column:
    """strong for 'Tip:' and the like, weak for 'Note:', null for others."""
    low = F.lower(F.trim(x))
    strong, weak = (_where(p, low.rlike(p), F.lit(False), may) for p in PREFIX_PATTERNS.values())
    return F.when(strong, "strong").when(weak, "weak")


def _advice(t: Column, prefix: Column, header: Column | None, cues: Mapping[str, float], may: May | None = None) -> Column:
    """Points for a prefix, a header of tips and cues of advice."""
    head = F.lit(0.0) if header is None else F.when(F.lower(header).rlike(r"\b(?:tips?|hints|secrets|tricks)\b"), 0.4).when(F.lower(header).rlike(r"\b(?:notes?|advice)\b"), 0.2).otherwise(0.0)
    score = F.when(prefix == "strong", PREFIXES["strong"]).when(prefix == "weak", PREFIXES["weak"]).otherwise(0.0) + head
    for pattern, points in cues.items():
        score = score + _if(_occurs(t, pattern, may), points)
    return score


def tipness(x: Column, header: Column | None = None, cues: Mapping[str, float] = TIP_CUES) -> Column:
    """0 to 1: prefix, a header of tips, cues of advice; less for ingredients, yields, times, plain instructions and stories."""
    t = F.trim(F.coalesce(x, F.lit("")))
    prefix, advice = tip_prefix(t), _occurs(t, list(cues)[1])
    score = _advice(t, prefix, header, cues)
    score = let(R.line_kind(t), lambda kind: score - _if(kind.isin("instruction", "numbered") & ~F.coalesce(prefix == "strong", F.lit(False)), 0.15) - _if(kind == "ingredient", 0.4) - _if(kind.isin("yield", "time"), 0.4)) - _if((_hits(t, r"\b(?:i|my|we)\b") >= 2) & ~advice, 0.35)
    return F.when(t == "", 0.0).otherwise(_clamp(score))


def generality(x: Column, title: Column, ingredients: Column, cues: Mapping[str, float] = TIP_CUES) -> Column:
    """0 to 1, 0.5 without cues: advice speaks for a general tip; 'this recipe', words of the title and of the ingredients against it."""
    low = F.lower(F.coalesce(x, F.lit("")))
    score = F.lit(0.5)
    for pattern, points in zip(cues, (0.15, 0.1, 0.1, 0.0, 0.2, 0.1, 0.0)):
        score = score + _if(_hits(low, pattern) > 0, points)
    words = tokens(title)
    matches = F.size(F.filter(words, lambda w: F.contains(low, w)))
    in_title = F.when((F.size(words) == 1) & (matches == 1), F.when(F.array_contains(ingredients, F.get(words, 0)), 0.05).otherwise(0.2)).when((F.size(words) > 1) & (matches >= 2), 0.2).otherwise(0.0)
    named = F.size(F.filter(F.coalesce(ingredients, F.array().cast("array<string>")), lambda w: F.contains(low, w)))
    return _clamp(score - _if(_hits(low, r"\b(?:this (?:recipe|dish|cake|sauce|soup)|these (?:cookies|muffins))\b") > 0, 0.25) - in_title - F.when(named >= 3, 0.25).when(named >= 2, 0.15).otherwise(0.0))


def _sentences(text: Column) -> Column:
    return F.filter(F.transform(F.split(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "), r"(?<=[.!?])\s+(?=[A-Z0-9\"'])"), lambda s: F.trim(s)), lambda s: s != "")


def _refused(s: Column) -> Column:
    """References to other places, and sentences of a few words without a prefix or an opening of advice."""
    low = F.lower(s)
    return low.rlike(r"\b(?:see (?:page|recipe|above|below)|page \d+)\b") | ((F.size(F.split(s, " ")) < 6) & tip_prefix(s).isNull() & ~low.rlike(next(iter(TIP_CUES))))


def _standalone(s: Column, shortest: int = 40) -> Column:
    return (F.char_length(s) >= shortest) & ~F.lower(s).rlike(r"^(?:but|however|this|that|these|those|it|they|then|otherwise)\b")


def tips(texts: DataFrame, keys: Sequence[str], text: str, title: Column, ingredients: Column, header: Column | None = None, least: float = 0.45, general: float = 0.5, shortest: int = 40) -> DataFrame:
    """keys, tip, text, tipness, generality, scope (general, recipe_specific or not_tip), standalone: the sentences of each text, judged as tips."""
    rows = texts.select(*keys, title.alias("_t"), ingredients.alias("_i"), *([header.alias("_h")] if header is not None else []), F.posexplode(_sentences(F.col(text))).alias("tip", "text"))
    scored = rows.withColumns({"tipness": tipness(F.col("text"), F.col("_h") if header is not None else None), "generality": generality(F.col("text"), F.col("_t"), F.col("_i"))})
    scope = F.when(_refused(F.col("text")) | (F.col("tipness") < least), "not_tip").when(F.col("generality") >= general, "general").otherwise("recipe_specific")
    return scored.withColumns({"scope": scope, "standalone": _standalone(F.col("text"), shortest)}).drop("_t", "_i", "_h")


def partitioned_tips(df: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """General tips that stand alone, tips of a recipe, and what is none."""
    return df.filter("scope = 'general' AND standalone"), df.filter("scope = 'recipe_specific'"), df.filter("scope = 'not_tip'")


def tagged(texts: DataFrame, keys: Sequence[str], text: Column, taxonomy: DataFrame, most_words: int = 3) -> DataFrame:
    """keys, category, tags: terms of a taxonomy (category, term) whose words stand in a text, sorted; an equi-join on runs of words."""
    words = tokens(text)
    runs = F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(1), F.lit(most_words)), lambda n: F.when(n <= F.size("_w"), F.transform(F.sequence(F.lit(1), F.size("_w") - n + 1), lambda i: F.array_join(F.slice("_w", i, n), " "))).otherwise(F.array().cast("array<string>")))))
    rows = texts.select(*keys, words.alias("_w")).select(*keys, F.explode(runs).alias("_r"))
    terms = taxonomy.select("category", F.array_join(tokens(F.col("term")), " ").alias("_r"), F.col("term")).distinct()
    return rows.join(terms, "_r").groupBy(*keys, "category").agg(F.array_sort(F.collect_set("term")).alias("tags"))


def highlights(chunks: DataFrame, keys: Sequence[str], text: str, lane_of: str, least: float = 0.45, may: May | None = None, carried: Sequence[str] = ()) -> DataFrame:
    """keys, carried columns, highlights (struct of text and self_contained, in order), n, density (for 1000 characters) of knowledge chunks; others have none.

    Sentences are looked at in an array of their chunk, so no rows move; only where points of advice suffice are they judged in full.
    """
    t = F.col(text)
    enough = F.lit(least - 1e-9)  # the points are summed in the same order; the margin costs nothing
    first = [_where(p, F.lit(points), F.lit(0.0), may) for p, points in [*((p, PREFIXES[k]) for k, p in PREFIX_PATTERNS.items()), *TIP_CUES.items()]]
    reached = sum(first[1:], first[0]) >= enough
    tip = lambda s: (_advice(s, tip_prefix(s, may), None, TIP_CUES, may) >= enough) & ~_refused(s) & (tipness(s) >= least)
    contrast = lambda s: F.lower(s).rlike(r"\b(?:but|however|instead|unlike|on the other hand)\b") & (F.char_length(s) < 80)
    found = F.transform(F.filter(_sentences(t), tip), lambda s: F.struct(s.alias("text"), (_standalone(s) & ~contrast(s)).alias("self_contained")))
    none = F.array().cast("array<struct<text:string,self_contained:boolean>>")
    # An exploded array of one keeps later columns from working the sentences out again.
    out = chunks.select(*keys, *carried, t.alias("_t"), F.explode(F.array(F.when((F.col(lane_of) == "knowledge") & reached, found).otherwise(none))).alias("highlights"))
    return out.select(*keys, *carried, "highlights", F.size("highlights").alias("n"), (F.size("highlights") / (F.greatest(F.char_length("_t"), F.lit(1)) / 1000.0)).alias("density"))


def topic_containers(blocks: DataFrame, keys: Sequence[str], order: str, words: str, anchors: str, header: str, long: int = 25) -> DataFrame:
    """keys, order, container: a new one begins at a header, where a block's anchors (array) share none with the container's, and at long blocks (words) without anchors in a container that has some."""

    def fold(rows: list[tuple]) -> Iterator[tuple]:
        n, known, begun = -1, set(), False
        for place, size, found, head in rows:
            found = set(found) if found is not None else set()
            apart = bool(found and known and not found & known) or bool(not found and known and size > long)
            if head or not begun or apart:
                n, known, begun = n + 1, set(), True
            known |= found
            yield place, n

    kind = blocks.schema[order].dataType.simpleString()
    return per_sequence(blocks, keys, order, [order, words, anchors, header], fold, f"{order} {kind}, container int")


def bridged(chunks: DataFrame, keys: Sequence[str], order: str, start: str, end: str, text: str, has_table: str, most: int = 120) -> DataFrame:
    """keys, order, merged: a heading by itself or a tiny chunk goes into the next one, where that follows on without a table in either.

    What is joined is judged as a whole again, so several headings in a row go together.
    """

    kind = chunks.schema[order].dataType.simpleString()
    return per_sequence(chunks, keys, order, [order, start, end, text, has_table], lambda rows: _bridged(rows, most), f"{order} {kind}, merged int")


def _bridged(rows: Iterable[tuple], most: int = 120) -> Iterator[tuple]:
    n, pending = -1, None  # pending: end, text, whether it has a table
    for place, a, b, t, table in rows:
        if pending is not None and pending[0] + 1 == a and not table and not pending[2] and _bridge(pending[1], most):
            pending = (b, f"{pending[1]}\n{t}", table)
        else:
            n, pending = n + 1, (b, t or "", bool(table))
        yield place, n


def _bridge(text: str, most: int) -> bool:
    lines = [x.strip() for x in (text or "").splitlines() if x.strip()]
    one = len(lines) == 1 and len(lines[0]) <= 80 and len(lines[0].split()) <= 8 and not lines[0].endswith((".", "!", "?"))
    heading = one and (lines[0].isupper() or lines[0].istitle() or lines[0].endswith(":"))
    return heading or (bool(lines) and len(" ".join(lines)) <= most and len(lines) <= 2 and not any(c.isdigit() for c in text) and not lines[-1].endswith((".", "!", "?")))


def knowledge_chunks(blocks: DataFrame, keys: Sequence[str], order: str, text: str, most: int = 2000, c: Lanes = Lanes()) -> DataFrame:
    """keys, chunk, start, end, text, lane, n, density: blocks in chunks of a bounded size that headings begin, headings bridged, with their lane and highlights."""
    heading = (F.char_length(text) <= 80) & (F.size(F.split(F.trim(F.col(text)), r"\s+")) <= 8) & ~F.trim(F.col(text)).rlike(r"[.!?]$") & F.trim(F.col(text)).rlike(r"^\p{Lu}")
    marked = blocks.filter(F.col(order).isNotNull()).select(*keys, order, text, F.char_length(text).alias("_n"), heading.alias("_h"))

    def fold(rows: list[tuple]) -> Iterator[tuple]:
        parts = _spans(((o, o, t) for o, t, *_ in rows), (i for _, i in cut_by_size([(o, n, h) for o, _, n, h in rows], most)))
        merged = _spans(parts, (i for _, i in _bridged((i, a, b, t, False) for i, (a, b, t) in enumerate(parts))))
        yield from ((i, *part) for i, part in enumerate(merged))

    kind = blocks.schema[order].dataType.simpleString()
    chunks = per_sequence(marked, keys, order, [order, text, "_n", "_h"], fold, f"chunk int, start {kind}, end {kind}, text string")
    patterns = [*c.patterns(), *PREFIX_PATTERNS.values(), *TIP_CUES]
    may = cues_of(F.col("_cues"), patterns)
    cued = chunks.withColumn("_cues", cue_bits(F.col("text"), patterns))
    laned = cued.withColumn("lane", lane(F.col("text"), F.lit(None).cast("string"), F.lit(False), c=c, may=may))
    return highlights(laned, [*keys, "chunk"], "text", "lane", may=may, carried=["start", "end", "text", "lane"]).drop("highlights")


def _spans(rows: Iterable[tuple], groups: Iterable[int]) -> list[tuple]:
    """start, end and the joined texts of each group of rows of these, where groups are numbered in order."""
    out: list[list] = []
    for (a, b, t), i in zip(rows, groups):
        if i == len(out):
            out.append([a, b, []])
        out[-1][1] = b
        out[-1][2] += [t] if t is not None else []
    return [(a, b, "\n".join(t)) for a, b, t in out]
