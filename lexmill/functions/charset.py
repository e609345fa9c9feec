"""Repair of file names that were decoded with the wrong code page.

The single-byte trials could be written with translate(), but the trials that re-encode to UTF-8 make several
characters of one, and the rule compares all trials; so they stay one Arrow UDF, run on distinct names.
``compat`` scores by the raw count of Cyrillic characters and keeps the earliest best, as the original rule does,
wrong winners included; ``ratio`` scores by the share of Cyrillic among letters and repairs what it should.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The trials in their order.
TRIALS = (
    ("latin-1", "cp1251"), ("latin-1", "cp866"), ("cp1252", "cp1251"), ("cp1252", "cp866"),
    ("utf-8", "cp1251"), ("utf-8", "cp866"), ("cp437", "cp866"), ("cp437", "cp1251"),
)
ARCHIVE_PAGES = ("cp866", "cp1251", "utf-8", "latin-1")


def score(text: str, mode: str = "compat") -> float:
    n = sum("Ѐ" <= c <= "ӿ" for c in text)
    if mode == "compat" or not n:
        return n
    return n / sum(c.isalpha() or ord(c) > 127 for c in text)


def _recoded(name: str, page_from: str, page_to: str) -> str | None:
    try:
        return name.encode(page_from).decode(page_to)
    except UnicodeError:
        return None


def _best(name: str, tried, mode: str) -> str:
    best, most = name, score(name, mode)
    for text in tried:
        if text is not None and score(text, mode) > most:
            best, most = text, score(text, mode)
    return best


def fixed_name(name: str | None, mode: str = "compat") -> str | None:
    """A repaired file name; null, empty names and names with Cyrillic letters stay."""
    if not name or score(name):
        return name
    return _best(name, (_recoded(name, a, b) for a, b in TRIALS), mode)


def archive_name(name: str | None, page: str = "cp866", mode: str = "compat") -> str | None:
    """A member name of an archive, read as cp437, in the given page or (``auto``) in the best of several."""
    if not name or score(name):
        return name
    pages = ARCHIVE_PAGES if page == "auto" else (page,)
    best, most = name, 0.0
    for p in pages:
        text = _recoded(name, "cp437", p)
        if text is not None and score(text, mode) > most:
            best, most = text, score(text, mode)
    return fixed_name(best, mode)


def _udf(f, *args):
    @F.pandas_udf("string")
    def run(names: pd.Series) -> pd.Series:
        return names.map(lambda n: f(n, *args), na_action="ignore")

    return run


def fix_names(df: DataFrame, column: str, out: str, mode: str = "compat") -> DataFrame:
    """``df`` with the repaired ``column`` as ``out``; each distinct name without Cyrillic is tried once."""
    return _by_distinct(df, column, out, _udf(fixed_name, mode))


def decode_archive_names(df: DataFrame, column: str, out: str, page: str = "cp866", mode: str = "compat") -> DataFrame:
    return _by_distinct(df, column, out, _udf(archive_name, page, mode))


def _by_distinct(df: DataFrame, column: str, out: str, f) -> DataFrame:
    names = df.select(F.col(column).alias("_name")).where("_name is not null").where(~F.col("_name").rlike(r"[\x{0400}-\x{04FF}]|^[\x00-\x7F]*$")).distinct()
    fixed = names.select("_name", f(F.col("_name")).alias("_fixed"))
    return df.join(fixed, df[column] == fixed["_name"], "left").withColumn(out, F.coalesce("_fixed", column)).drop("_name", "_fixed")


def fix_path(path: Column, f=None) -> Column:
    """A path with every component repaired (names are few in a path, so the UDF sees whole components)."""
    parts = F.split(path, "/")

    @F.pandas_udf("array<string>")
    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda v: None if v is None else [fixed_name(p) for p in v])

    return F.array_join(run(parts), "/")
