"""The line stream of documents: order as columns.

``lines`` has ``doc_id, page_number, line_ord, text`` and, where geometry is known, ``x_min, y_center``. Rows of Spark
have no order, so all "first wins" rules use ``seq``, the place of a non-blank line in its document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexmill.functions.text import is_blank


def line_stream(lines: DataFrame) -> DataFrame:
    """Non-blank lines with ``line_idx`` (from 0 in the page) and ``seq`` (from 0 in the document). One exchange, on
    ``doc_id``, serves both numbers and what follows by document."""
    seq = W.partitionBy("doc_id").orderBy("page_number", "line_ord")
    out = lines.where(~is_blank(F.col("text"))).withColumn("seq", F.row_number().over(seq) - 1)
    first = F.min("seq").over(W.partitionBy("doc_id", "page_number"))
    return out.withColumn("line_idx", F.col("seq") - first)


def page_full_text(lines: DataFrame) -> DataFrame:
    """``(doc_id, page_number, full_text)``: all lines of a page, blank ones too, joined in order."""
    ordered = F.sort_array(F.collect_list(F.struct("line_ord", "text")))
    return lines.groupBy("doc_id", "page_number").agg(F.array_join(F.transform(ordered, lambda x: x["text"]), "\n").alias("full_text"))


def line_counts(lines: DataFrame) -> DataFrame:
    """``(doc_id, pages, lines)``: what a document had to be read from; blank lines count."""
    return lines.groupBy("doc_id").agg(F.countDistinct("page_number").alias("pages"), F.count("*").alias("lines"))


def unread_documents(documents: DataFrame, lines: DataFrame) -> DataFrame:
    """Ids of ``documents(doc_id)`` without a line: they fail, as rows, not as a job."""
    return documents.select("doc_id").join(lines.select("doc_id").distinct(), "doc_id", "left_anti")


def detected_lines(detections: DataFrame) -> DataFrame:
    """Lines from ``(doc_id, page_number, det_ord, box, text, conf)`` of a text detector.

    Blank texts go; ``x_min``/``x_max`` are the extremes and ``y_center`` the mean of the box's corners. Lines are in the
    order of (y_center, x_min); equal places keep the detector's order.
    """
    from lexmill.functions.text import ustrip

    xs, ys = F.transform("box", lambda p: p[0]), F.transform("box", lambda p: p[1])
    mean = F.aggregate(ys, F.lit(0.0), lambda a, y: a + y) / F.size(ys)
    out = detections.where(~is_blank(F.col("text"))).select(
        "doc_id", "page_number", "det_ord", ustrip(F.col("text")).alias("text"), F.col("conf").alias("confidence"),
        F.array_min(xs).alias("x_min"), F.array_max(xs).alias("x_max"), mean.alias("y_center"),
    )
    order = W.partitionBy("doc_id", "page_number").orderBy("y_center", "x_min", "det_ord")
    return out.withColumn("line_ord", F.row_number().over(order) - 1).drop("det_ord")
