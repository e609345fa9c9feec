"""Text functions with the Unicode semantics the extraction rules need, as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space in the wide sense: what a Unicode-aware strip removes, of which Java's own classes are only parts.
WS = r"[\s\x1c-\x1f\x85\p{Z}]"
#: Letters, digits of any kind and the underscore.
WORD = r"\p{L}\p{N}_"
CYRILLIC = r"[\x{0400}-\x{04FF}]"


def ustrip(c: Column) -> Column:
    """Strip white space of all kinds at both ends."""
    return F.regexp_replace(c, rf"^{WS}+|{WS}+\z", "")


def is_blank(c: Column) -> Column:
    return ~c.rlike(rf"[^\s\x1c-\x1f\x85\p{{Z}}]")


def clean_key(c: Column) -> Column:
    """Stripped, with runs of white space as one space."""
    return F.regexp_replace(ustrip(c), rf"{WS}+", " ")


def normalize_header(c: Column) -> Column:
    """Lower case, everything but words a space, single spaces."""
    words = F.regexp_replace(F.lower(c), rf"[^{WORD}\s\x1c-\x1f\x85\p{{Z}}]", " ")
    return ustrip(F.regexp_replace(words, rf"{WS}+", " "))


def compact(c: Column) -> Column:
    """A normalised header without its spaces."""
    return F.replace(c, F.lit(" "), F.lit(""))


def cyrillic_score(c: Column) -> Column:
    """How many characters are Cyrillic."""
    return F.regexp_count(c, F.lit(CYRILLIC))


def has_cyrillic(c: Column) -> Column:
    return c.rlike(CYRILLIC)


def file_stem(path: Column) -> Column:
    """The name in a path without its last suffix; a name that begins with its only dot has none."""
    name = F.regexp_extract(path, r"([^/]*)/*\z", 1)
    return F.regexp_replace(name, r"(?<=.)\.[^.]*\z", "")
