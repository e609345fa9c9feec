"""Key and value pairs from lines and from two-column tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexmill.functions.language import ABBREVIATIONS, TERMS
from lexmill.functions.text import WS, clean_key, is_blank, ustrip

# Separators, numbering, longest keys, height of a table row.
SEPARATOR = rf"{WS}*[-–—:]{WS}*|{WS}{{2,}}|\t"
NUMBERING = rf"^{WS}*\p{{Nd}}+[.)]{WS}*"
ABBREVIATION_KEY, TERM_KEY, LINE_KEY = 20, 120, 80
ROW_HEIGHT = 8


def strip_numbering(line: Column) -> Column:
    """The line without its number, one level of it, stripped."""
    return ustrip(F.regexp_replace(line, NUMBERING, ""))


def parse_pair(line: Column, key_max: int = LINE_KEY) -> Column:
    """``struct(key, value)`` of a line, or null.

    The line is split at its first separator; a hyphen within a word is one too. Only if a side is blank, that is
    where the line begins with a separator, the first `` - `` is tried, for keys of at most ``key_max`` characters.
    """
    bare = strip_numbering(line)
    parts = F.split(bare, SEPARATOR, 2)
    left, right = parts[0], F.try_element_at(parts, F.lit(2))
    by_first = (F.size(parts) == 2) & ~is_blank(left) & ~is_blank(right)
    dash = F.split(bare, " - ", 2)
    dleft, dright = dash[0], F.try_element_at(dash, F.lit(2))
    by_dash = (F.size(dash) == 2) & ~is_blank(dleft) & ~is_blank(dright) & (F.length(dleft) <= key_max)
    pair = lambda a, b: F.struct(clean_key(a).alias("key"), clean_key(b).alias("value"))
    return F.when(F.length(bare) >= 3, F.when(by_first, pair(left, right)).when(by_dash, pair(dleft, dright)))


def pairs_of_lines(lines: DataFrame, key_max: int = LINE_KEY) -> DataFrame:
    """``lines`` that hold a pair, with ``key`` and ``value``; ``source_line`` is the line as it was."""
    return lines.withColumn("pair", parse_pair(F.col("text"), key_max)).where("pair is not null").select("*", "pair.key", "pair.value", F.col("text").alias("source_line")).drop("pair", "text")


def first_wins(pairs: DataFrame, *order: str) -> DataFrame:
    """The first pair of each (document, kind, key, value), case ignored. The whole row is carried, so page and source
    line are those of the first; a plain distinct would take any."""
    same = W.partitionBy("doc_id", "kind", F.lower("key"), F.lower("value")).orderBy(*order)
    return pairs.withColumn("_rank", F.row_number().over(same)).where("_rank = 1").drop("_rank")


def looks_like_abbreviation(key: Column) -> Column:
    """Short, not of digits and signs only, and either very short or mostly capitals."""
    k, n = ustrip(key), F.length(ustrip(key))
    signs = k.rlike(r"^(?:\p{Nd}|[^\p{L}\p{N}_])+\z")
    return n.between(1, ABBREVIATION_KEY) & ~signs & ((F.regexp_count(k, F.lit(r"\p{IsUppercase}")) / n > 0.4) | (n <= 6))


def fallback_pairs(stream: DataFrame) -> DataFrame:
    """Pairs of all lines of a document: short keys that look like it as abbreviations, and, independently, keys of 3
    to 120 characters as terms; values of at least 4 characters."""
    pairs = pairs_of_lines(stream, TERM_KEY).where(F.length("value") >= 4)
    as_abbreviation = F.when((F.length("key") <= ABBREVIATION_KEY) & looks_like_abbreviation(F.col("key")), F.lit(ABBREVIATIONS))
    as_term = F.when(F.length("key").between(3, TERM_KEY), F.lit(TERMS))
    return pairs.withColumn("kind", F.explode(F.array_compact(F.array(as_abbreviation, as_term))))


def table_rows(blocks: DataFrame) -> DataFrame:
    """Rows of a two-column layout: ``(doc_id, kind, page_number, y, mid, left_text, right_text)``; null where a side is missing.

    The column border is the upper median of ``x_min`` on the page; heights are rounded half-even to rows; of several
    lines in one cell the leftmost counts, the first on ties. Pages and cells are aggregated without a join of the sides.
    """
    page = ["doc_id", "kind", "page_number"]
    mid = F.element_at(F.sort_array(F.collect_list("x_min")), F.expr("int(count(x_min) div 2 + 1)"))
    mids = blocks.groupBy(*page).agg(mid.alias("mid"))
    cells = blocks.join(mids, page).withColumn("y", F.rint(F.col("y_center") / ROW_HEIGHT) * ROW_HEIGHT)
    first = lambda side: F.min_by(F.when(side, F.col("text")), F.when(side, F.struct("x_min", "line_ord")))
    left = F.col("x_min") < F.col("mid")
    return cells.groupBy(*page, "y", "mid").agg(first(left).alias("left_text"), first(~left).alias("right_text"))


def pairs_of_tables(blocks: DataFrame) -> DataFrame:
    """``(doc_id, kind, page_number, y, key, value, source_line)``: rows with both sides, first of equal ones (by page and height,
    case ignored, white space within as it is)."""
    rows = table_rows(blocks).where("left_text is not null and right_text is not null")
    rows = rows.select("doc_id", "kind", "page_number", "y", ustrip(F.col("left_text")).alias("key"), ustrip(F.col("right_text")).alias("value")).where("key <> '' and value <> ''")
    rows = first_wins(rows, "page_number", "y").withColumn("source_line", F.concat_ws(" | ", "key", "value"))
    return rows.withColumn("key", clean_key(F.col("key"))).withColumn("value", clean_key(F.col("value")))
