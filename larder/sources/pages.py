"""More of pages: table rows, elements with what marks them, broken lines as blocks, main text, and blocks cleaned for books."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.recipes import starts_with_quantity, text_quality
from larder.functions.repair import book_text
from larder.sources import html as H
from larder.sources.lines import markdown_blocks

_HEADINGS = tuple(f"h{i}" for i in range(1, 7))


def _parsed_rows(pages: DataFrame, key: str, html: str, parse: Callable[[str], Iterator[tuple]], columns: str) -> DataFrame:
    names = [key, *(c.split()[0] for c in columns.split(", "))]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            yield pd.DataFrame([(k, i, *r) for k, h in zip(df[key], df[html]) for i, r in enumerate(parse(h or ""))], columns=names)

    return pages.select(key, html).mapInPandas(run, f"{key} {pages.schema[key].dataType.simpleString()}, {columns}")


class _Rows(HTMLParser):
    """Cells of table rows; a row of header cells only is a header."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found: list[tuple[list[str], bool]] = []
        self.rows: list[list[list]] = []  # open rows: cells of [text parts, whether it's a header]

    def handle_starttag(self, tag, attrs):
        if tag == "tr":
            self.rows.append([])
        elif tag in ("td", "th") and self.rows:
            self.rows[-1].append([[], tag == "th"])
        elif tag == "br":
            self.handle_data(" ")

    def handle_endtag(self, tag):
        if tag == "tr" and self.rows:
            cells = [(" ".join("".join(parts).split()), head) for parts, head in self.rows.pop()]
            if any(t for t, _ in cells):
                self.found.append(([t for t, _ in cells], all(h for _, h in cells)))

    def handle_data(self, data):
        if self.rows and self.rows[-1]:
            self.rows[-1][-1][0].append(data)


def table_rows(pages: DataFrame, key: str, html: str) -> DataFrame:
    """key, row, cells, is_header of every table row with text; a row that isn't closed is left out."""

    def parse(text: str) -> Iterator[tuple]:
        p = _Rows()
        p.feed(text)
        p.close()
        return iter(p.found)

    return _parsed_rows(pages, key, html, parse, "row int, cells array<string>, is_header boolean")


class _Elements(HTMLParser):
    """Blocks with the characters of their links and emphasis."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found: list[tuple] = []
        self.open, self.silent, self.depth = ["body"], 0, 0
        self.text: list[str] = []
        self.within = {"a": 0, "strong": 0}
        self.counts = {"a": 0, "strong": 0}

    def _flush(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            self.found.append((self.open[-1], self.depth, text, min(len(text), self.counts["a"]), min(len(text), self.counts["strong"])))
        self.text, self.counts = [], {"a": 0, "strong": 0}

    def handle_starttag(self, tag, attrs):
        if tag in H.SILENT_TAGS:
            self.silent += 1
        elif tag in ("ul", "ol"):
            self._flush()
            self.depth += 1
        elif tag in H.BLOCK_TAGS:
            self._flush()
            self.open.append(tag)
        elif tag == "br":
            self._flush()
        elif tag in ("a", "strong", "b", "em", "i"):
            self.within["a" if tag == "a" else "strong"] += 1

    def handle_endtag(self, tag):
        if tag in H.SILENT_TAGS:
            self.silent = max(0, self.silent - 1)
        elif tag in ("ul", "ol"):
            self._flush()
            self.depth = max(0, self.depth - 1)
        elif tag in H.BLOCK_TAGS and tag in self.open:
            self._flush()
            while self.open.pop() != tag:
                pass
        elif tag in ("a", "strong", "b", "em", "i"):
            name = "a" if tag == "a" else "strong"
            self.within[name] = max(0, self.within[name] - 1)

    def handle_data(self, data):
        if not self.silent:
            self.text.append(data)
            for name, n in self.within.items():
                if n:
                    self.counts[name] += len(data.strip())


def elements(pages: DataFrame, key: str, html: str) -> DataFrame:
    """key, block, tag, depth, text, link_chars, strong_chars, kind (Title, ListItem, Table, NarrativeText or Text) of a page's blocks."""

    def parse(text: str) -> Iterator[tuple]:
        p = _Elements()
        p.feed(text)
        p.close()
        p._flush()
        return iter(p.found)

    rows = _parsed_rows(pages, key, html, parse, "block int, tag string, depth int, text string, link_chars int, strong_chars int")
    short = F.char_length("text") <= 80
    bold = short & (F.col("strong_chars") >= 0.9 * F.char_length("text")) & ~F.col("text").rlike("[.!?]$")
    kind = F.when(F.col("tag").isin(*_HEADINGS) | bold, "Title").when((F.col("tag") == "li") | (F.col("depth") > 0), "ListItem").when(F.col("tag").isin("td", "th", "tr"), "Table").when(F.col("text").rlike(r"[.!?][\"')]*$"), "NarrativeText").otherwise("Text")
    return rows.withColumn("kind", kind)


_BLOCK = re.compile(r"(?is)<(p|div|li)\b([^>]*)>((?:(?!</?(?:p|div|li)\b).)*)</\1\s*>")
_NOISE = re.compile(r"(?is)<(script|style|noscript|svg)\b[^>]*>.*?</\1\s*>")
_BREAK = re.compile(r"(?i)<br\s*/?>")


def split_breaks(html: str) -> str:
    """Pages whose paragraphs, divisions and list items are one line each: broken ones become several; scripts and the like go, and so do empty blocks."""

    def apart(m: re.Match) -> str:
        tag, attributes, inner = m.groups()
        parts = [p for p in _BREAK.split(inner) if re.sub(r"<[^>]*>|&nbsp;", "", p).strip()]
        return "".join(f"<{tag}{attributes}>{p}</{tag}>" for p in parts)

    return _BLOCK.sub(apart, _NOISE.sub("", html or ""))


MODES = ("none", "split_breaks")


def prepared(pages: DataFrame, key: str, html: str, mode: str = "split_breaks") -> DataFrame:
    """key, html made ready for block extraction."""
    if mode not in MODES:
        raise ValueError(f"{mode!r} is none of {', '.join(MODES)}")
    if mode == "none":
        return pages.select(key, html)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            yield pd.DataFrame({key: df[key], html: df[html].map(split_breaks)})

    return pages.select(key, html).mapInPandas(run, f"{key} {pages.schema[key].dataType.simpleString()}, {html} string")


#: Ways to a page's main text, as conditions on its elements.
WAYS: dict[str, Callable[[], Column]] = {
    "all": lambda: F.lit(True),
    "unlinked": lambda: F.col("link_chars") <= 0.4 * F.char_length("text"),
    "paragraphs": lambda: F.col("tag").isin("p", "li", "blockquote", *_HEADINGS),
    "dense": lambda: (F.size(F.split("text", " ")) >= 8) & (F.col("link_chars") <= 0.25 * F.char_length("text")),
    "prose": lambda: F.col("kind") == "NarrativeText",
}


def main_text(pages: DataFrame, key: str, html: str, way: str = "best") -> DataFrame:
    """key, text, way, quality: a page's text by one of WAYS; `best` takes the way of the best quality, then the longest text. Pages without text have an empty one."""
    if way != "best" and way not in WAYS:
        raise ValueError(f"{way!r} is none of best, {', '.join(WAYS)}")
    tried = list(WAYS) if way == "best" else [way]
    rows = elements(pages, key, html)
    dealt = rows.withColumn("way", F.explode(F.array(*(F.when(WAYS[w](), F.lit(w)) for w in tried)))).filter("way IS NOT NULL")
    texts = dealt.groupBy(key, "way").agg(F.array_sort(F.collect_list(F.struct("block", "text"))).alias("_t")).select(key, "way", F.array_join(F.transform("_t", lambda r: r["text"]), "\n").alias("text"))
    scored = texts.withColumn("quality", F.round(text_quality(F.col("text")), 9))
    order = Window.partitionBy(key).orderBy(F.desc("quality"), F.desc(F.char_length("text")), "way")
    best = scored.withColumn("_r", F.row_number().over(order)).filter("_r = 1").drop("_r")
    return pages.select(key).join(best, key, "left").select(key, F.coalesce("text", F.lit("")).alias("text"), F.coalesce("way", F.lit("none")).alias("way"), F.coalesce("quality", F.lit(0.0)).alias("quality"))


def as_markdown(rows: DataFrame, key: str) -> DataFrame:
    """key, text: blocks (key, block, tag, depth, text) as Markdown, one paragraph a block."""
    level = F.substring("tag", 2, 1).try_cast("int")
    line = F.when(F.col("tag").isin(*_HEADINGS), F.concat(F.repeat(F.lit("#"), level), F.lit(" "), F.col("text"))).when(F.col("tag") == "li", F.concat(F.lit("- "), F.col("text"))).otherwise(F.col("text"))
    out = rows.withColumn("_l", line).groupBy(key).agg(F.array_sort(F.collect_list(F.struct("block", "_l"))).alias("_t"))
    return out.select(key, F.array_join(F.transform("_t", lambda r: r["_l"]), "\n\n").alias("text"))


#: Extractors of blocks by name: pages, key and html to key, block and text at least.
EXTRACTORS: dict[str, Callable[[DataFrame, str, str], DataFrame]] = {
    "blocks": H.blocks,
    "elements": elements,
    "markdown": lambda pages, key, html: markdown_blocks(as_markdown(H.blocks(pages, key, html), key), key, "text"),
}


def extracted(pages: DataFrame, key: str, html: str, extractor: str = "blocks") -> DataFrame:
    if extractor not in EXTRACTORS:
        raise ValueError(f"{extractor!r} is none of {', '.join(EXTRACTORS)}")
    return EXTRACTORS[extractor](pages, key, html)


def cleaned_blocks(rows: DataFrame, keys: list[str], order: str, text: str, tag: str) -> DataFrame:
    """keys, order, part, text: blocks repaired, page numbers dropped, and blocks of several lines split where these are list items, cells, ingredients or three short lines; else joined."""
    clean = rows.select(*keys, order, tag, book_text(F.col(text)).alias("_t")).filter("_t <> ''").filter(~F.lower("_t").rlike(r"^(?:page\s*)?\d{1,4}$"))
    lines = F.filter(F.transform(F.split("_t", "\n"), lambda v: F.trim(F.regexp_replace(F.trim(v), r"^(?:[•●◦▪‣·*]|[-–—])\s+", ""))), lambda v: v != "")
    n = F.size("_l")
    quantities = F.size(F.filter("_l", lambda v: starts_with_quantity(v)))
    split = F.col(tag).isin("li", "td", "th", "tr") | (quantities * 2 >= n) | ((n >= 3) & (F.array_max(F.transform("_l", lambda v: F.char_length(v))) <= 90))
    parts = F.when((n <= 1) | split, F.col("_l")).otherwise(F.array(F.array_join("_l", " ")))
    return clean.withColumn("_l", lines).select(*keys, order, F.posexplode(parts).alias("part", "text"))


def health(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """keys, blocks, chars, empty, repeated (share of blocks with a text seen before), long (share of blocks over 2000 characters), warnings."""
    first = F.row_number().over(Window.partitionBy(*keys, text).orderBy(F.lit(0)))
    marked = rows.select(*keys, F.trim(F.coalesce(text, F.lit(""))).alias(text)).withColumn("_r", first)
    n = F.count("*")
    sums = marked.groupBy(*keys).agg(n.alias("blocks"), F.sum(F.char_length(text)).alias("chars"), F.count_if(F.col(text) == "").alias("empty"), (F.count_if((F.col("_r") > 1) & (F.col(text) != "")) / n).alias("repeated"), (F.count_if(F.char_length(text) > 2000) / n).alias("long"))
    found = [F.when(F.col("chars") < 500, F.lit("little text")), F.when(F.col("repeated") > 0.2, F.lit("many repeats")), F.when(F.col("long") > 0.2, F.lit("long blocks"))]
    return sums.withColumn("warnings", F.filter(F.array(*found), lambda w: w.isNotNull()))
