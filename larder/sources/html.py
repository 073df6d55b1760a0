"""Pages to titles, links and text blocks."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 li td th dt dd blockquote pre figcaption div section article tr".split())
SILENT_TAGS = frozenset("script style head nav footer noscript template".split())


def _plain(x: Column) -> Column:
    t = F.trim(F.regexp_replace(F.regexp_replace(x, "<[^>]+>", ""), r"\s+", " "))
    return F.nullif(t, F.lit(""))


def title(html: Column, fallback: str = "untitled") -> Column:
    """The first heading that isn't empty, else the title, else the fallback."""
    h1 = _plain(F.regexp_extract(html, r"(?is)<h1[^>]*>(.*?)</h1>", 1))
    return F.coalesce(h1, _plain(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)), F.lit(fallback))


def canonical(html: Column) -> Column:
    """The canonical link, else og:url."""
    link = F.regexp_extract(html, r'(?is)<link[^>]*rel="canonical"[^>]*href="([^"]*)"', 1)
    return F.coalesce(F.nullif(link, F.lit("")), F.nullif(F.regexp_extract(html, r'(?is)<meta[^>]*property="og:url"[^>]*content="([^"]*)"', 1), F.lit("")))


def links(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(r'(?i)<a\s[^>]*href="([^"]*)"'), F.lit(1))


def json_ld(html: Column) -> Column:
    """Texts of the JSON-LD scripts."""
    return F.regexp_extract_all(html, F.lit(r"(?is)<script[^>]*ld\+json[^>]*>(.*?)</script>"), F.lit(1))


class _Blocks(HTMLParser):
    """Text runs between block tags, with the innermost block tag and the depth of lists."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found: list[tuple[str, int, str]] = []
        self.open, self.text, self.silent, self.depth = ["body"], [], 0, 0

    def _flush(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            self.found.append((self.open[-1], self.depth, text))
        self.text = []

    def handle_starttag(self, tag, attrs):
        if tag in SILENT_TAGS:
            self.silent += 1
        elif tag in ("ul", "ol"):
            self._flush()
            self.depth += 1
        elif tag == "br":
            self._flush()
        elif tag in BLOCK_TAGS:
            self._flush()
            self.open.append(tag)

    def handle_endtag(self, tag):
        if tag in SILENT_TAGS:
            self.silent = max(0, self.silent - 1)
        elif tag in ("ul", "ol"):
            self._flush()
            self.depth = max(0, self.depth - 1)
        elif tag in BLOCK_TAGS:
            self._flush()
            if tag in self.open[1:]:
                while self.open.pop() != tag:
                    pass

    def handle_data(self, data):
        if not self.silent:
            self.text.append(data)


def _parsed(html: str | None) -> list[tuple[str, int, str]]:
    p = _Blocks()
    p.feed(html or "")
    p.close()
    p._flush()
    return p.found


def blocks(pages: DataFrame, key: str, html: str) -> DataFrame:
    """key, block, tag, depth, text: the pages' text blocks in order."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            rows = [(k, i, *b) for k, h in zip(df[key], df[html]) for i, b in enumerate(_parsed(h))]
            yield pd.DataFrame(rows, columns=[key, "block", "tag", "depth", "text"])

    kind = pages.schema[key].dataType.simpleString()
    return pages.select(key, html).mapInPandas(run, f"{key} {kind}, block int, tag string, depth int, text string")
