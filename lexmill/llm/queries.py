"""Queries of the training-text operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm import copies, lookalikes, mojibake, packing, residue, scans, split, tokens, truncation, versions
from lexmill.shared import cut, table

Query = Callable[[SparkSession, str], DataFrame]


def _tagged(df: DataFrame, name: str) -> DataFrame:
    return df.select(F.lit(name).alias("source_table"), "*")


def _field_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.field_texts(table(spark, sf_dir, "terms"), table(spark, sf_dir, "registry"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.truncated(_field_texts(spark, sf_dir)).select(F.col("field").alias("source_table"), "row_id")


def p1_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.shares(_field_texts(spark, sf_dir))


def p1_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.limits(_field_texts(spark, sf_dir).where(F.col("text").rlike(r"\S")).select("field", "source", "text"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.split_pages(table(spark, sf_dir, "ocr_pages")).where("piece_no = 1").select("doc_id", "page_number").distinct()


def p2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.split_pages(table(spark, sf_dir, "ocr_pages"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mojibake.restore(mojibake.name_values(table(spark, sf_dir, "registry"))).select("id", "field_name")


def p3_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mojibake.restore(mojibake.name_values(table(spark, sf_dir, "registry")))


def _scanned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.values(table(spark, sf_dir, "terms"), table(spark, sf_dir, "abbreviations"), table(spark, sf_dir, "ocr_pages"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.defects(_scanned(spark, sf_dir))


def p4_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scans.repaired(_scanned(spark, sf_dir))


_COPY_FIELDS = {"terms": ("term", "definition"), "abbreviations": ("short_form", "full_form")}


def _per_table(spark: SparkSession, sf_dir: str, op, fields: dict) -> DataFrame:
    out = None
    for name, args in fields.items():
        part = _tagged(op(table(spark, sf_dir, name), "id", *args), name)
        out = part if out is None else out.unionByName(part)
    return out


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_table(spark, sf_dir, copies.formatting_copies, _COPY_FIELDS)


def p5_collapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_table(spark, sf_dir, copies.collapsed, _COPY_FIELDS)


_FORM_FIELDS = {"terms": ("term",), "abbreviations": ("short_form",)}


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_table(spark, sf_dir, lookalikes.inconsistent, _FORM_FIELDS)


def p6_consistent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_table(spark, sf_dir, lookalikes.consistent_form, _FORM_FIELDS)


def _versioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms, abbreviations = table(spark, sf_dir, "terms"), table(spark, sf_dir, "abbreviations")
    a = terms.select(F.lit("terms").alias("source_table"), "id", F.col("definition").alias("value"))
    return a.unionByName(abbreviations.select(F.lit("abbreviations").alias("source_table"), "id", F.col("full_form").alias("value")))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.version_pairs(_versioned(spark, sf_dir))


def p7_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.version_groups(_versioned(spark, sf_dir))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encode_corpus(table(spark, sf_dir, "documents"))


def p9_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(tokens.count_tokens(table(spark, sf_dir, "documents")))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residue.residue(table(spark, sf_dir, "documents")).select("doc_id")


def p10_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residue.content(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {k: v for k, v in globals().items() if k[0] == "p" and k[1].isdigit() and callable(v)}


_P5 = r"""
WITH r AS (
  SELECT 'terms' AS source_table, id, lower(regexp_replace(term, '[^\p{L}\p{N}]+', '', 'g')) AS a, lower(regexp_replace(definition, '[^\p{L}\p{N}]+', '', 'g')) AS b FROM terms
  UNION ALL
  SELECT 'abbreviations', id, lower(regexp_replace(short_form, '[^\p{L}\p{N}]+', '', 'g')), lower(regexp_replace(full_form, '[^\p{L}\p{N}]+', '', 'g')) FROM abbreviations),
g AS (SELECT source_table, id, min(id) OVER w AS first_id, count(*) OVER w AS copies FROM r
      WINDOW w AS (PARTITION BY source_table, least(a, b), greatest(a, b)))
"""


def oracle_sql() -> dict[str, str]:
    return {
        "p2_found": "SELECT DISTINCT doc_id, page_number FROM ocr_pages WHERE length(full_text) > 3000",
        "p5_found": _P5 + "SELECT source_table, first_id, id AS row_id FROM g WHERE id <> first_id",
        "p5_collapsed": _P5 + "SELECT source_table, id AS first_id, copies FROM g WHERE id = first_id",
    }
