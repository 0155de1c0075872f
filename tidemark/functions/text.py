"""Text columns: content hash, composed text, preprocessing, tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Code points that a Unicode-aware strip removes (fixed values).
STRIP_CODE_POINTS = [
    0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680,
    0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007, 0x2008, 0x2009, 0x200A,
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]
STRIP_CHARS = "".join(chr(c) for c in STRIP_CODE_POINTS)

#: Characters kept for a model with a token limit (fixed value); other scorers read whole texts.
MAX_CHARS = 400


def text_or_empty(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))


def strip(col: Column) -> Column:
    """Unicode strip of both ends; ``trim`` alone removes spaces only."""
    return F.btrim(col, F.lit(STRIP_CHARS))


def content_hash(title: Column, content: Column) -> Column:
    """Lower-case SHA-256 of title, newline, body; a missing part counts as ''.

    The result is never null. Saying so keeps Spark from computing the hash a
    second time to filter null join keys.
    """
    digest = F.sha2(F.concat(text_or_empty(title), F.lit("\n"), text_or_empty(content)), 256)
    return text_or_empty(digest)


def compose_text(title: Column, content: Column) -> Column:
    """Title and body joined and stripped, or the title as it is without a body."""
    body = text_or_empty(content)
    head = text_or_empty(title)
    return F.when(body != "", strip(F.concat(head, F.lit(". "), body))).otherwise(head)


def preprocess_text(col: Column, max_chars: int | None = None) -> Column:
    """Null to '', stripped, and with ``max_chars`` cut to so many code points (not stripped again)."""
    whole = strip(text_or_empty(col))
    return whole if max_chars is None else F.substring(whole, 1, max_chars)


def is_blank_text(col: Column) -> Column:
    """True where nothing is left for a scorer to read."""
    return preprocess_text(col) == ""


def tokens(col: Column) -> Column:
    """Lower-cased runs of letters; may hold '' at the ends."""
    return F.split(F.lower(col), r"[^\p{L}]+")
