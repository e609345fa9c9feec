"""Sections of abbreviations and of terms: header and stop lines, spans, and what lies within."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexmill.functions.language import ABBREVIATIONS, RUSSIAN, TERMS, LanguagePack, alternation
from lexmill.functions.text import compact, normalize_header

KINDS = (ABBREVIATIONS, TERMS)


def _is_header(pack: LanguagePack, kind: str) -> Column:
    by_pattern = (F.length("norm") <= pack.longest_header) & F.col("norm").rlike(alternation(pack.headers[kind]))
    by_keyword = reduce(lambda a, b: a | b, (F.contains(F.col("compact"), F.lit(k)) for k in pack.keywords[kind]))
    return by_pattern | ((F.length("compact") <= pack.longest_keyword_line) & by_keyword)


def line_flags(lines: DataFrame, pack: LanguagePack = RUSSIAN) -> DataFrame:
    """``lines`` with ``norm``, ``compact``, and for each kind whether the line is its header or ends its section."""
    out = lines.withColumn("norm", normalize_header(F.col("text"))).withColumn("compact", compact(F.col("norm")))
    out = out.select("*", *(_is_header(pack, k).alias(f"is_hdr_{k}") for k in KINDS))
    stop = (F.length("norm") <= pack.longest_header) & F.col("norm").rlike(alternation(pack.stops))
    return out.select("*", *((stop & ~F.col(f"is_hdr_{k}")).alias(f"is_stop_{k}") for k in KINDS))


def with_spans(stream: DataFrame, pack: LanguagePack = RUSSIAN) -> DataFrame:
    """The line stream with ``start_<kind>`` and ``end_<kind>`` of its document (null: no section).

    A section begins after the first header and ends before the first stop line after it, but never before its own
    first line, so a stop line right after the header is content. Without a stop it runs to the last line; a header
    that is the last line begins nothing. Both kinds share one partitioning by document, without a self-join.
    """
    doc = W.partitionBy("doc_id")
    out = line_flags(stream, pack).withColumn("n_lines", F.count("*").over(doc))
    out = out.select("*", *(F.min(F.when(F.col(f"is_hdr_{k}"), F.col("seq"))).over(doc).alias(f"h_{k}") for k in KINDS))
    out = out.select("*", *(F.min(F.when(F.col(f"is_stop_{k}") & (F.col("seq") > F.col(f"h_{k}")), F.col("seq"))).over(doc).alias(f"e_{k}") for k in KINDS))
    for k in KINDS:
        h, e = F.col(f"h_{k}"), F.col(f"e_{k}")
        end = F.when(e.isNotNull(), F.greatest(e - 1, h + 1)).when(h + 1 < F.col("n_lines"), F.col("n_lines") - 1)
        out = out.withColumn(f"end_{k}", end).withColumn(f"start_{k}", F.when(F.col(f"end_{k}").isNotNull(), h + 1))
    return out.drop("n_lines", *(f"{c}_{k}" for c in "he" for k in KINDS))


def section_spans(stream: DataFrame, pack: LanguagePack = RUSSIAN) -> DataFrame:
    """``(doc_id, kind, start_seq, end_seq, start_page, end_page)`` of the sections that exist."""
    return spans_of(with_spans(stream, pack))


def spans_of(spans: DataFrame) -> DataFrame:
    """The sections of a line stream that has their bounds."""
    kinds = F.array(*(F.struct(F.lit(k).alias("kind"), F.col(f"start_{k}").alias("start_seq"), F.col(f"end_{k}").alias("end_seq")) for k in KINDS))
    out = spans.select("doc_id", "page_number", "seq", F.explode(kinds).alias("s")).where("s.end_seq is not null")
    page = lambda c: F.max(F.when(F.col("seq") == F.col(f"s.{c}"), F.col("page_number")))
    return out.groupBy("doc_id", F.col("s.kind").alias("kind"), F.col("s.start_seq").alias("start_seq"), F.col("s.end_seq").alias("end_seq")).agg(
        page("start_seq").alias("start_page"), page("end_seq").alias("end_page")
    )


def section_text(stream: DataFrame, pack: LanguagePack = RUSSIAN) -> DataFrame:
    """``(doc_id, kind, page_number, seq, text)``: the lines within each section. Sections may overlap."""
    return text_within(with_spans(stream, pack))


def text_within(spans: DataFrame) -> DataFrame:
    """The lines within the sections of a line stream that has their bounds."""
    inside = F.array_compact(F.array(*(F.when(F.col("seq").between(F.col(f"start_{k}"), F.col(f"end_{k}")), F.lit(k)) for k in KINDS)))
    return spans.select("doc_id", F.explode(inside).alias("kind"), "page_number", "seq", "text")


def section_blocks(lines: DataFrame, spans: DataFrame) -> DataFrame:
    """All lines, with geometry, of the whole pages a section reaches over; text beside the section comes along."""
    return lines.join(spans.select("doc_id", "kind", "start_page", "end_page"), "doc_id").where("page_number between start_page and end_page").drop("start_page", "end_page")
