"""Text helpers: whitespace tokenisation, word sets, character counts.

Python's ``str.split()`` splits on Unicode whitespace and drops empty
strings; Spark's ``split`` keeps empty strings and ``trim`` strips spaces
only.  The class below lists the characters for which ``str.isspace()`` is
true, written in a syntax both Java regex and RE2 accept.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points Python's str.isspace() accepts.
WS_CLASS = (
    r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
WS_RUN = WS_CLASS + "+"
# The same characters in two parts: the regex engine tests a class of ASCII characters with one
# table lookup, but walks a wider class range by range.
WS_ASCII = r"[\t\n\x0B\f\r\x1C\x1D\x1E\x1F ]"
WS_WIDE = "".join(map(chr, [0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
NON_WS = WS_CLASS.replace("[", "[^", 1)


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_ws(text: Column | str) -> Column:
    """``text.split()``: tokens on whitespace runs, no empty strings; NULL -> [].  Wide
    whitespace, which only a text with multi-byte characters can hold, becomes a space first."""
    t = F.coalesce(col_(text), F.lit(""))
    plain = F.when(F.octet_length(t) == F.length(t), t).otherwise(F.translate(t, WS_WIDE, " " * len(WS_WIDE)))
    return F.filter(F.split(plain, WS_ASCII), lambda w: w != F.lit(""))


def word_set(text: Column | str) -> Column:
    """``set(text.lower().split())`` as a distinct array."""
    return F.array_distinct(split_ws(F.lower(col_(text))))


def has_content(text: Column | str) -> Column:
    """``bool(text.strip())``: at least one non-whitespace character."""
    return F.coalesce(col_(text).rlike(NON_WS), F.lit(False))


def truthy(text: Column | str) -> Column:
    """Python truthiness of an optional string: not NULL and not ''."""
    c = col_(text)
    return c.isNotNull() & (c != F.lit(""))


def n_chars(text: Column | str) -> Column:
    """Length in code points (Python ``len``)."""
    return F.coalesce(F.length(col_(text)), F.lit(0))


def rouge_tokens(text: Column | str) -> Column:
    """ROUGE tokeniser without stemming: lowercase, non [a-z0-9] runs become
    separators, empty tokens dropped."""
    cleaned = F.regexp_replace(F.lower(F.coalesce(col_(text), F.lit(""))), r"[^a-z0-9]+", " ")
    return F.filter(F.split(cleaned, " "), lambda w: w != F.lit(""))


def sentences(text: Column | str) -> Column:
    """Sentences: split on runs of . ! ? and newlines, trimmed, empty dropped."""
    parts = F.split(F.coalesce(col_(text), F.lit("")), r"[.!?\n]+")
    trimmed = F.transform(parts, lambda s: F.regexp_replace(s, "^" + WS_RUN + "|" + WS_RUN + "$", ""))
    return F.filter(trimmed, lambda s: s != F.lit(""))
