"""Personal data in texts: offsets of e-mail addresses, IPv4 addresses, card and phone numbers, also disguised.

Base detection follows four fixed patterns. Then a chain of transducers rewrites the text (look-alike
characters, bracketed or spelled "at" and "dot", spelled digits), keeping for every character that it
emits the source span it came from; the same patterns run over the rewritten text, and what they find
is mapped back to code points of the source. A mapped span is added where it overlaps no base span of
its kind or holds more than those that it overlaps; base spans always stay.

Defined results. A null text is empty and has no spans. Repeated rows give repeated results, other
columns are ignored. Every pattern is matched in time linear in the text, also on very long runs.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.memory import lean

KINDS = ("email", "ip", "card", "phone")
RESULT = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of local@label.label..., leftmost and non-overlapping, by walking the @ signs."""
    low, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > low and text[start - 1] in _LOCAL:
            start -= 1
        low = at + 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            low = m.end()
        at = text.find("@", low)


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _DOTTED.finditer(text):
        parts, at = m[0].split("."), m.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in four):
                yield at, end
            at = end + 1


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(d * 2 - 9 * (d > 4) for d in map(int, digits[-2::-2]))) % 10 == 0


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 10 <= len(_digits(m[0])) <= 15:
            yield m.span()


_FIND = dict(zip(KINDS, (_emails, _ips, _cards, _phones)))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind as listed."""
    found = [(k, s, e) for k, find in _FIND.items() for s, e in find(text)]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


#: Cyrillic and Greek letters that look like Latin ones, and those that regular expressions take for Latin ones of the other case.
_ALIKE = dict(zip("АВЕКМНОРСТХаеорсухіјѕΑΒΕΖΗΙΚΜΝΟΡΤΥΧοİıſ\u212a", "ABEKMHOPCTXaeopcyxijsABEZHIKMNOPTYXoIisK"))
#: Other hyphens, blanks that aren't the space, and characters without width.
_DASHES, _GAPS, _NOTHING = "\u2010\u2011\u2012\u2013\u2014\u2212\ufe63", "\u00a0\u2002\u2003\u2007\u2009\u202f\u3000", "\u200b\u200c\u200d\u2060\ufeff\u00ad"


def _look_alikes() -> dict[int, str]:
    """Characters to what they look like: compatibility forms of ASCII, digits of any script, and the tables above."""
    out = {}
    digits = [c for c in range(0x80, 0x110000) if unicodedata.decimal(chr(c), None) is not None]
    for c in map(chr, [*digits, 0xB2, 0xB3, 0xB9, *range(0x2070, 0x20A0), *range(0xFE50, 0xFE70), *range(0xFF01, 0xFF5F), *range(0x1D400, 0x1D800)]):
        plain = unicodedata.normalize("NFKC", c)
        digit = unicodedata.decimal(c, None)
        if digit is not None:
            out[ord(c)] = str(digit)
        elif len(plain) == 1 and "!" <= plain <= "~":
            out[ord(c)] = plain
    out |= {ord(c): x for c, x in _ALIKE.items()}
    out |= {ord(c): x for group, x in ((_DASHES, "-"), (_GAPS, " "), (_NOTHING, "")) for c in group}
    out[ord("。")] = out[ord("․")] = "."
    return out


_MAP = _look_alikes()
_ODD = re.compile("[" + "".join(re.escape(chr(c)) for c in sorted(_MAP)) + "]")

#: The digits' names.
_NAMES = {
    "en": "zero one two three four five six seven eight nine",
    "de": "null eins zwei drei vier fünf sechs sieben acht neun",
    "fr": "zéro un deux trois quatre cinq six sept huit neuf",
    "es": "cero uno dos tres cuatro cinco seis siete ocho nueve",
}
_DIGIT = {w: str(i) for names in _NAMES.values() for i, w in enumerate(names.split())} | {"oh": "0"}
_ONE = "(?:" + "|".join(sorted(_DIGIT, key=len, reverse=True)) + ")"
#: At least this many spelled digits in a row are read as a number; fewer where they touch figures or a plus sign.
SPELLED = 4
_SPELLED = re.compile(rf"(?<!\w)(?:plus[ \t]+)?{_ONE}(?:[ \t,.-]{{1,2}}{_ONE}){{{SPELLED - 1},}}(?!\w)", re.I)
_BESIDE = r"[ \t,.()-]"
_ROW = rf"{_ONE}(?:[ \t,.-]{{1,2}}{_ONE})*(?!\w)"
_MIXED = re.compile(rf"(?:(?<=[0-9]{_BESIDE})|(?<=[0-9]{_BESIDE}{{2}})|(?<=\+)|(?<!\w)plus[ \t]+){_ROW}|(?<!\w){_ROW}(?={_BESIDE}{{1,2}}[0-9])|(?<!\w)plus[ \t]+(?=[0-9])", re.I)
_TOKEN = re.compile(rf"(?<!\w)(?:plus|{_ONE})(?!\w)", re.I)
_OPEN, _SHUT = r"[\[({<]", r"[\])}>]"
_BRACKETED = re.compile(rf"[ \t]{{0,3}}{_OPEN}[ \t]{{0,3}}(?:(at|@)|(dot|punkt|point|punto|\.))[ \t]{{0,3}}{_SHUT}[ \t]{{0,3}}|&#64;|&commat;|%40|&#46;", re.I)
_LABEL = r"[A-Za-z0-9-]{1,63}"
#: What the last label must be where it stands apart behind a plain dot, as at a sentence's end.
_LAST = "(?:com|org|net|edu|gov|mil|int|info|biz|name|io|co|me|tv|app|dev|ai|eu|uk|us|de|fr|es|it|nl|be|ch|at|pl|pt|se|no|dk|fi|cz|ie|ru|ua|cn|jp|kr|in|br|mx|ar|ca|au|nz|za)"
#: Words that no address ends in, where its last label is a word of no known list.
_NO_LABEL = "(?:a|about|after|all|also|am|an|and|any|are|as|at|be|been|before|but|by|can|could|did|do|does|dot|down|each|else|for|from|had|has|have|he|her|here|him|his|how|i|if|in|into|is|it|its|just|like|may|me|more|most|much|must|my|no|nor|not|now|of|off|on|one|only|or|our|out|over|she|so|some|such|than|that|the|their|them|then|there|these|they|this|those|to|too|under|until|up|upon|us|very|was|we|were|what|when|where|which|while|who|why|will|with|would|you|your)"
_SAID = re.compile(rf"(?<=[A-Za-z0-9_])[ \t]{{1,3}}at[ \t]{{1,3}}(?={_LABEL}(?:[ \t]{{1,3}}dot[ \t]{{1,3}}{_LABEL})*[ \t]{{1,3}}dot[ \t]{{1,3}}(?:{_LAST}|(?!{_NO_LABEL}(?![A-Za-z0-9-]))[A-Za-z]{{2,24}})(?![A-Za-z0-9-]))|(?<=[A-Za-z0-9])[ \t]{{1,3}}dot[ \t]{{1,3}}(?=[A-Za-z0-9])", re.I)
#: A local part has at most 64 characters and an address at most 320.
_SPACED = re.compile(rf"[A-Za-z0-9._%+-]{{1,64}}[ \t]{{1,3}}@[ \t]{{1,3}}{_LABEL}(?:[ \t]{{0,3}}\.[ \t]{{0,3}}{_LABEL}){{0,8}}[ \t]{{0,3}}\.[ \t]{{0,3}}{_LAST}(?![A-Za-z0-9-])", re.I)
_OCTET, _STOP = rf"(?:{_ONE}(?:[ \t-]{{1,2}}{_ONE}){{0,2}}|[0-9]{{1,3}})", "(?:dot|point|punkt|punto)"
#: Four numbers of figures or spelled digits with spelled dots between.
_OCTETS = re.compile(rf"(?<![\w.]){_OCTET}(?:(?:[ \t]{{1,3}}{_STOP}[ \t]{{1,3}}|\.){_OCTET}){{3}}(?!\w)", re.I)
_OCTET_TOKEN = re.compile(rf"{_STOP}|\.|[0-9]|{_ONE}", re.I)


#: What a text must hold for any transducer to change it; every alternative of theirs has one here that is as wide or wider.
_DIGITLIKE = rf"(?:{_ONE}|[0-9])"
TRIGGER = (
    "["
    + "".join(f"\\x{{{c:x}}}" for c in sorted(_MAP))
    + rf"]|(?i:{_OPEN}[ \t]*(?:at|@|dot|punkt|point|punto|\.)[ \t]*{_SHUT}|&#64;|&commat;|%40|&#46;|[ \t]@[ \t]|[ \t]dot[ \t]|(?:{_ONE}[ \t,.-]{{1,2}}){{{SPELLED - 1}}}"
    + rf"|(?:[0-9]{_BESIDE}{{1,2}}|\+|plus[ \t]+){_ONE}\b|{_ONE}{_BESIDE}{{1,2}}[0-9]|plus[ \t]+[0-9]|{_DIGITLIKE}[ \t]+{_STOP}[ \t]+{_DIGITLIKE}|{_ONE}\.{_DIGITLIKE}|[0-9]\.{_ONE})"
)


class Mapped:
    """A rewritten text; character i came from source code points starts[i] to ends[i]."""

    def __init__(self, text: str, starts: np.ndarray | None = None, ends: np.ndarray | None = None):
        self.text = text
        self.starts = np.arange(len(text)) if starts is None else starts
        self.ends = np.arange(1, len(text) + 1) if ends is None else ends

    def rewritten(self, pattern: re.Pattern, to) -> Mapped:
        """Every match m replaced by to(m), a list of (text, start, end) with places in this text."""
        parts, starts, ends, done = [], [], [], 0

        def keep(a: int, b: int) -> None:
            parts.append(self.text[a:b])
            starts.append(self.starts[a:b])
            ends.append(self.ends[a:b])

        for m in pattern.finditer(self.text):
            keep(done, m.start())
            for text, a, b in to(m):
                parts.append(text)
                starts.append(np.full(len(text), self.starts[a]))
                ends.append(np.full(len(text), self.ends[b - 1]))
            done = m.end()
        if not parts:
            return self
        keep(done, len(self.text))
        return Mapped("".join(parts), np.concatenate(starts), np.concatenate(ends))

    def source(self, start: int, end: int) -> tuple[int, int]:
        return int(self.starts[start]), int(self.ends[end - 1])


def _whole(text):
    return lambda m: [(text(m), m.start(), m.end())]


def _spelled(m: re.Match) -> list[tuple[str, int, int]]:
    return [("+" if t[0].lower() == "plus" else _DIGIT[t[0].lower()], m.start() + t.start(), m.start() + t.end()) for t in _TOKEN.finditer(m[0])]


def normalised(text: str) -> Mapped:
    """The text with its disguises taken off, as far as known."""
    x = Mapped(text)
    x = x.rewritten(_ODD, _whole(lambda m: _MAP[ord(m[0])]))
    x = x.rewritten(_BRACKETED, _whole(lambda m: "." if m[2] or m[0] == "&#46;" else "@"))
    if re.search("dot", x.text, re.I):
        x = _said_addresses(x)
    if re.search(r"[ \t]@[ \t]", x.text):
        x = x.rewritten(_SPACED, lambda m: [(c, m.start() + i, m.start() + i + 1) for i, c in enumerate(m[0]) if c not in " \t"])
    x = x.rewritten(_OCTETS, _numbered)
    return x.rewritten(_SPELLED, _spelled)


def _numbered(m: re.Match) -> list[tuple[str, int, int]]:
    plain = lambda t: t if t.isdigit() else _DIGIT.get(t.lower(), ".")
    return [(plain(t[0]), m.start() + t.start(), m.start() + t.end()) for t in _OCTET_TOKEN.finditer(m[0])]


def _said_addresses(x: Mapped) -> Mapped:
    """"name at host dot label" as an address; a lone "dot" counts only after an @ or a spelled at."""
    ok = [False]

    def to(m: re.Match) -> list[tuple[str, int, int]]:
        if "at" in m[0].lower():
            ok[0] = m.end()
            return [("@", m.start(), m.end())]
        since = x.text[max(ok[0] or 0, x.text.rfind("@", 0, m.start()) + 1, m.start() - 320) : m.start()]
        known = ok[0] or "@" in x.text[max(0, m.start() - 320) : m.start()]
        if known and re.fullmatch(r"[A-Za-z0-9.-]*(?:[ \t]{1,3}dot[ \t]{1,3}[A-Za-z0-9.-]+)*", since, re.I):
            return [(".", m.start(), m.end())]
        return [(m[0][0], m.start(), m.start() + 1), *((c, m.start() + i, m.start() + i + 1) for i, c in enumerate(m[0]) if i)]

    return x.rewritten(_SAID, to)


def all_spans(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """The base spans and those that only the rewritten text shows."""
    x = normalised(text)
    # Short runs only make numbers that nothing else shows: words after a number don't lengthen it.
    mixed = x.rewritten(_MIXED, _spelled)
    if mixed.text == text:
        return base
    taken = {k: [(s, e) for kind, s, e in base if kind == k] for k in KINDS}
    added = []
    for kind, s, e in base_spans(x.text):
        a, b = x.source(s, e)
        if not any(s2 < b and a < e2 and not (a <= s2 and e2 <= b and (a, b) != (s2, e2)) for s2, e2 in taken[kind]):
            added.append((kind, a, b))
            taken[kind].append((a, b))
    for kind, s, e in base_spans(mixed.text) if mixed is not x else ():
        a, b = mixed.source(s, e)
        if not any(s2 < b and a < e2 for s2, e2 in taken[kind]):
            added.append((kind, a, b))
            taken[kind].append((a, b))
    return sorted(base + added, key=lambda y: (y[1], KINDS.index(y[0]), y[2]))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    none = hashlib.sha256(b"").hexdigest()
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        digit = pc.match_substring_regex(texts, "[0-9@]").fill_null(False).to_numpy(zero_copy_only=False)
        odd = pc.match_substring_regex(texts, TRIGGER).fill_null(False).to_numpy(zero_copy_only=False)
        n = len(batch)
        counts, digests, spans, added = np.zeros((4, n), np.int64), [none] * n, [""] * n, np.zeros(n, np.int64)
        for i in np.flatnonzero(digit | odd):
            text = texts[int(i)].as_py()
            base = base_spans(text) if digit[i] else []
            found = all_spans(text, base) if odd[i] else base
            if base:
                digests[i] = hashlib.sha256(joined(base).encode()).hexdigest()
            if found:
                spans[i] = joined(found)
                added[i] = len(found) - len(base)
                for k, kind in enumerate(KINDS):
                    counts[k, i] = sum(x[0] == kind for x in found)
        yield pa.record_batch([ids, *map(pa.array, counts), pa.array(digests), pa.array(spans, pa.string()), pa.array(added)], ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])


def find(docs: DataFrame) -> DataFrame:
    """One row per document, see RESULT: counts and places of all spans, and a digest of the base ones."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(lean(_found), RESULT)
