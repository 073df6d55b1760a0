"""Which cues a text may hold: a quick look by another engine, so that the patterns themselves run where they can match.

Java's patterns take some 80 ns a character with word boundaries, RE2 (in Arrow) about 2. The two differ in words of other letters, in
cases and in white space, so RE2 gets a wider form of a pattern and only tells where a pattern can't occur.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: What a widened pattern may be made of: blanks, digits, groups, anchors, bounded dots, plain classes, letters and marks.
_PIECE = re.compile(r"\\b|\\s[*+]?|\\d\+?|\(\?:|\)\??|\||\^|\.\{\d+,\d+\}|\[[^]\[\\^& -]+-?\]| |[A-Za-z0-9'°-]\??")
_WIDER = {"^": "", " ": r"[\s\x0B]+", r"\s": r"[\s\x0B]+", r"\s*": r"[\s\x0B]*", r"\s+": r"[\s\x0B]+"}


def _pieces(pattern: str) -> list[str] | None:
    found = _PIECE.findall(pattern)
    return found if "".join(found) == pattern else None


def _alternatives(pieces: Sequence[str]) -> list[list[str]]:
    out, depth = [[]], 0
    for p in pieces:
        depth += (p == "(?:") - p.startswith(")")
        if p == "|" and not depth:
            out.append([])
        else:
            out[-1].append(p)
    return out


def _close(pieces: Sequence[str], start: int) -> int:
    depth = 0
    for i in range(start, len(pieces)):
        depth += (pieces[i] == "(?:") - pieces[i].startswith(")")
        if not depth:
            return i
    raise ValueError("unbalanced group")


def _word(piece: str) -> bool:
    return piece.startswith(r"\d") or (len(piece) == 1 and piece.isascii() and piece.isalnum())


def _begins(pieces: Sequence[str]) -> bool:
    """Whether every match begins with an ASCII letter or digit."""
    if not pieces or pieces[0] != "(?:":
        return bool(pieces) and _word(pieces[0])
    end = _close(pieces, 0)
    return pieces[end] == ")" and all(map(_begins, _alternatives(pieces[1:end])))


def _ends(pieces: Sequence[str]) -> bool:
    """Whether every match ends with an ASCII letter or digit."""
    if not pieces or not pieces[-1].startswith(")"):
        return bool(pieces) and (_word(pieces[-1]) or (pieces[-1][-1] == "?" and _word(pieces[-1][0]) and _ends(pieces[:-1])))
    start = next((i for i in range(len(pieces) - 1, -1, -1) if pieces[i] == "(?:" and _close(pieces, i) == len(pieces) - 1), None)
    return start is not None and pieces[-1] == ")" and all(map(_ends, _alternatives(pieces[start + 1 : -1])))


def wider(pattern: str) -> str | None:
    """A pattern of RE2 that matches wherever this one does in any case, before or after runs of white space become blanks; null if that isn't sure.

    A boundary stays only beside an ASCII letter or digit of the pattern: what bounds a word there for Java does so for RE2. Patterns are
    taken as those of the text itself; one for the text in lower case may use this if it has no boundaries (a Kelvin sign becomes a k).
    """
    pieces = _pieces(pattern)
    if pieces is None:
        return None
    try:
        kept = [p != r"\b" or _begins(pieces[i + 1 :]) or _ends(pieces[:i]) for i, p in enumerate(pieces)]
    except ValueError:
        return None
    whole = "".join("(?s:.*)" if p.startswith(".{") else _WIDER.get(p, p) for p, k in zip(pieces, kept) if k)
    try:
        pc.match_substring_regex(pa.array([""]), pattern=whole, ignore_case=True)
    except pa.ArrowInvalid:
        return None
    return whole


def _wide(patterns: Sequence[str]) -> list[tuple[str, str]]:
    found = ((p, wider(p)) for p in dict.fromkeys(patterns))
    return [(p, w) for p, w in found if w is not None][:63]


def cue_bits(text: Column, patterns: Sequence[str]) -> Column:
    """A number whose bits tell which of the patterns may occur in a text; `cues_of` reads it."""
    wide = [w for _, w in _wide(patterns)]

    @F.arrow_udf("long")
    def bits(texts: pa.Array) -> pa.Array:
        out = pa.array([0] * len(texts), pa.int64())
        for i, w in enumerate(wide):
            hit = pc.match_substring_regex(texts, pattern=w, ignore_case=True).cast(pa.int64())
            out = pc.bit_wise_or(out, pc.shift_left(hit, pa.scalar(i, pa.int64())))
        return out

    return bits(text)


def cues_of(bits: Column, patterns: Sequence[str]) -> dict[str, Column]:
    """For each pattern that has a bit, whether it may occur; the others may anywhere."""
    return {p: F.getbit(bits, F.lit(i)) == 1 for i, (p, _) in enumerate(_wide(patterns))}
