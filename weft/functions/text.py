"""Text column expressions (JVM-side, no Python in the hot path).

C1 collapse whitespace, C2 Unicode strip, C3 split on LF, C4 length/substring,
C5 lower/prefix, F1 drop blank lines, F4 verdict predicate, token lists.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The whitespace set of Python's ``str.isspace`` (what ``\s`` and
# ``str.strip()`` match on text), written as one explicit class so that Java's
# regex and DuckDB's agree with it code point for code point:
# U+0009-U+000D, U+001C-U+0020, U+0085, U+00A0, U+1680, U+2000-U+200A,
# U+2028, U+2029, U+202F, U+205F, U+3000.
WS_CLASS = r"[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
WS_RUN = WS_CLASS + "+"
# What C1 has to replace, for Java's regex: a run of two or more, or one that is not
# U+0020. Most characters are told apart by the first, plain range.
_WS = r"[[^\x21-\x7e]&&" + WS_CLASS + "]"
UNEVEN_WS = r"[[^\x20-\x7e]&&" + WS_CLASS + "]" + _WS + r"*|\x20" + _WS + "+"
# The same set as one string of its characters.
WS_CHARS = "".join(chr(c) for lo, hi in ((0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
                                         (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)) for c in range(lo, hi + 1))


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def let(value: Column, body) -> Column:
    """``body`` of ``value``, evaluated once however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def normalize_ws(col: Column | str) -> Column:
    """Every whitespace run becomes one space, then both ends are trimmed.
    After the collapse the only whitespace left is U+0020, so ``trim`` suffices."""
    return F.trim(F.regexp_replace(_c(col), UNEVEN_WS, " "))


def ustrip(col: Column | str) -> Column:
    """Strip Unicode whitespace from both ends (Spark's ``trim`` only removes U+0020)."""
    return F.trim(_c(col), F.lit(WS_CHARS))


def lines(col: Column | str) -> Column:
    """Split on LF only; CR is left for ``ustrip`` to remove."""
    return F.split(_c(col), "\n")


def nonblank_lines(col: Column | str) -> Column:
    """strip each line first, then drop the empty ones (array<string>)."""
    stripped = F.transform(lines(col), ustrip)
    return F.filter(stripped, lambda x: x != F.lit(""))


def tokens(col: Column | str, normalized: bool = False) -> Column:
    """Lower-cased tokens of the normalised text, split on the single space
    left by C1. Empty text yields an empty array. ``normalized=True`` skips the
    C1 pass for text that is already normalised (e.g. chunk text): its only
    whitespace is single U+0020 spaces, at most one at each end, which the
    empty-token filter drops, so the tokens are the same."""
    norm = F.lower(_c(col) if normalized else normalize_ws(col))
    return F.filter(F.split(norm, " "), lambda x: x != F.lit(""))


def is_yes(col: Column | str) -> Column:
    """accepted iff the stripped, lower-cased evaluation starts with ``yes``
    (a prefix test: ``Yesterday`` accepts, ``**Yes**`` does not). NULL → false."""
    return F.coalesce(F.startswith(F.lower(ustrip(col)), F.lit("yes")), F.lit(False))
