"""Test tables in the shapes the operators take, in Spark and as SQL (each pair is the same table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexmill.shared import table

LINES_PER_PAGE = 40


def doc_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of all documents of the corpus, 40 to a page."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("i", "text"))
    page, ord_ = F.expr(f"int(i div {LINES_PER_PAGE} + 1)"), F.col("i") % LINES_PER_PAGE
    return docs.select("doc_id", page.alias("page_number"), ord_.alias("line_ord"), "text", F.lit(40.0).alias("x_min"), (ord_ * 20.0).alias("y_center"))


DOC_LINES = """
doc_lines AS (
  SELECT doc_id, CAST((i - 1) // 40 + 1 AS INTEGER) AS page_number, CAST((i - 1) % 40 AS INTEGER) AS line_ord, text,
         CAST(40 AS DOUBLE) AS x_min, CAST(((i - 1) % 40) * 20 AS DOUBLE) AS y_center
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents))"""


def page_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of all recognised pages; of several texts of one page the smallest."""
    pages = table(spark, sf_dir, "ocr_pages").groupBy("doc_id", "page_number").agg(F.min("full_text").alias("t"))
    lines = pages.select("doc_id", "page_number", F.posexplode(F.split("t", "\n")).alias("line_ord", "text"))
    return lines.withColumn("x_min", F.lit(40.0)).withColumn("y_center", F.col("line_ord") * 20.0)


PAGE_LINES = """
page_lines AS (
  SELECT doc_id, page_number, CAST(i - 1 AS INTEGER) AS line_ord, text, CAST(40 AS DOUBLE) AS x_min, CAST((i - 1) * 20 AS DOUBLE) AS y_center
  FROM (SELECT doc_id, page_number, unnest(string_split(t, chr(10))) AS text, generate_subscripts(string_split(t, chr(10)), 1) AS i
        FROM (SELECT doc_id, page_number, min(full_text) AS t FROM ocr_pages GROUP BY ALL)))"""


def layout_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with geometry in two columns, from all line items."""
    li = table(spark, sf_dir, "lineitem")
    page = F.expr("int((l_linenumber - 1) div 4 + 1)")
    y = F.col("l_linenumber") * 20.0 + F.col("l_discount") * 50
    left = li.select(F.col("l_orderkey").alias("doc_id"), page.alias("page_number"), (40.0 + F.col("l_suppkey") % 7).cast("double").alias("x_min"), y.alias("y_center"), F.concat(F.lit("K"), F.col("l_partkey")).alias("text"))
    right = li.select(F.col("l_orderkey").alias("doc_id"), page.alias("page_number"), (300.0 + F.col("l_tax") * 100).alias("x_min"), (y + F.col("l_tax") * 20).alias("y_center"), F.concat_ws(" ", "l_returnflag", "l_linestatus", F.col("l_quantity").cast("int")).alias("text"))
    order = W.partitionBy("doc_id", "page_number").orderBy("y_center", "x_min", "text")
    return left.unionByName(right).withColumn("line_ord", F.row_number().over(order) - 1).withColumn("kind", F.lit("terms"))


LAYOUT_LINES = """
layout_lines AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY doc_id, page_number ORDER BY y_center, x_min, text) - 1 AS INTEGER) AS line_ord, 'terms' AS kind
  FROM (SELECT l_orderkey AS doc_id, CAST((l_linenumber - 1) // 4 + 1 AS INTEGER) AS page_number, CAST(40 + l_suppkey % 7 AS DOUBLE) AS x_min,
               l_linenumber * CAST(20 AS DOUBLE) + l_discount * CAST(50 AS DOUBLE) AS y_center, 'K' || CAST(l_partkey AS VARCHAR) AS text FROM lineitem
        UNION ALL
        SELECT l_orderkey, CAST((l_linenumber - 1) // 4 + 1 AS INTEGER), CAST(300 AS DOUBLE) + l_tax * CAST(100 AS DOUBLE),
               l_linenumber * CAST(20 AS DOUBLE) + l_discount * CAST(50 AS DOUBLE) + l_tax * CAST(20 AS DOUBLE),
               l_returnflag || ' ' || l_linestatus || ' ' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) FROM lineitem))"""


def sheet_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All terms as two-column sheets under a header, 20 rows to a page; ids of documents are negative."""
    terms = table(spark, sf_dir, "terms").withColumn("rn", F.row_number().over(W.partitionBy("document_id").orderBy("id")))
    row = (F.col("rn") - 1) % 20 + 1
    base = terms.select((-F.col("document_id")).alias("doc_id"), F.expr("int((rn - 1) div 20 + 1)").alias("page_number"), (row * 20).alias("y"), "id", "rn", "term", "definition")
    left = base.select("doc_id", "page_number", F.lit(40.0).alias("x_min"), F.col("y").cast("double").alias("y_center"), F.col("term").alias("text"))
    right = base.select("doc_id", "page_number", F.lit(300.0).alias("x_min"), (F.col("y") + F.col("id") % 4).cast("double").alias("y_center"), F.col("definition").alias("text"))
    head = base.where("rn = 1").select("doc_id", F.lit(1).alias("page_number"), F.lit(40.0).alias("x_min"), F.lit(0.0).alias("y_center"), F.lit("Термины и определения").alias("text"))
    order = W.partitionBy("doc_id", "page_number").orderBy("y_center", "x_min")
    return head.unionByName(left).unionByName(right).withColumn("line_ord", F.row_number().over(order) - 1)


SHEET_LINES = """
sheet_rows AS (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY id) AS rn FROM terms),
sheet_lines AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY doc_id, page_number ORDER BY y_center, x_min) - 1 AS INTEGER) AS line_ord
  FROM (SELECT -document_id AS doc_id, 1 AS page_number, CAST(40 AS DOUBLE) AS x_min, CAST(0 AS DOUBLE) AS y_center, 'Термины и определения' AS text FROM sheet_rows WHERE rn = 1
        UNION ALL SELECT -document_id, CAST((rn - 1) // 20 + 1 AS INTEGER), 40, ((rn - 1) % 20 + 1) * 20, term FROM sheet_rows
        UNION ALL SELECT -document_id, CAST((rn - 1) // 20 + 1 AS INTEGER), 300, ((rn - 1) % 20 + 1) * 20 + id % 4, definition FROM sheet_rows))"""


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts of the corpus taken as replies of a model, one to a document."""
    docs = table(spark, sf_dir, "documents").where("text is not null")
    return docs.select("doc_id", F.lit(1).alias("chunk_no"), F.lit(1).alias("start_page"), F.lit(4).alias("end_page"), F.col("text").alias("raw"))


def rescanned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scan that finds all registered files again under two paths, a third of them with other content."""
    reg = table(spark, sf_dir, "registry")
    hash_ = F.when(F.col("id") % 3 == 0, F.sha2(F.concat(F.lit("n"), F.col("id")).cast("binary"), 256)).otherwise(F.col("file_hash"))
    rows = reg.select(F.concat(F.lit("new_"), F.coalesce("filename", F.lit(""))).alias("filename"), F.concat(F.coalesce("title", F.lit("")), F.lit(" (2)")).alias("title"), hash_.alias("file_hash"), (F.col("file_size") + 1).alias("file_size"), "id")
    paths = F.explode(F.array(F.concat(F.lit("/data/input/again/"), F.col("id")), F.concat(F.lit("/data/input/zzz/"), F.col("id"))))
    return rows.select("filename", "title", "file_hash", "file_size", paths.alias("source_path"))


RESCANNED = """
rescanned AS (
  SELECT 'new_' || coalesce(filename, '') AS filename, coalesce(title, '') || ' (2)' AS title,
         CASE WHEN id % 3 = 0 THEN sha256('n' || CAST(id AS VARCHAR)) ELSE file_hash END AS file_hash, file_size + 1 AS file_size,
         unnest(['/data/input/again/' || CAST(id AS VARCHAR), '/data/input/zzz/' || CAST(id AS VARCHAR)]) AS source_path
  FROM registry)"""


def children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms and abbreviations in one form."""
    t = table(spark, sf_dir, "terms").select("document_id", F.lit("terms").alias("kind"), "id", F.col("term").alias("key"), F.col("definition").alias("value"))
    a = table(spark, sf_dir, "abbreviations").select("document_id", F.lit("abbreviations").alias("kind"), "id", F.col("short_form").alias("key"), F.col("full_form").alias("value"))
    return t.unionByName(a)


CHILDREN = """
children AS (
  SELECT document_id, 'terms' AS kind, id, term AS key, definition AS value FROM terms
  UNION ALL SELECT document_id, 'abbreviations', id, short_form, full_form FROM abbreviations)"""
