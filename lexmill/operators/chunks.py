"""Texts of documents in chunks for a language model: whole pages, halved until they fit."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexmill.functions.language import RUSSIAN, LanguagePack
from lexmill.functions.text import is_blank

PAGES, CHARS = 4, 12_000


def page_texts(lines: DataFrame, pack: LanguagePack = RUSSIAN) -> DataFrame:
    """``(doc_id, page_number, pos, page_text)`` of every page: its mark and its non-blank lines, null if it has none.
    ``pos`` counts the pages of a document from 0."""
    before, after = pack.page_mark.split("{}")
    ordered = F.sort_array(F.collect_list(F.when(~is_blank(F.col("text")), F.struct("line_ord", "text"))))
    pages = lines.groupBy("doc_id", "page_number").agg(F.transform(ordered, lambda x: x["text"]).alias("t"))
    mark = F.concat(F.lit(before), F.col("page_number"), F.lit(after))
    pages = pages.withColumn("page_text", F.when(F.size("t") > 0, F.array_join(F.concat(F.array(mark), "t"), "\n"))).drop("t")
    return pages.withColumn("pos", F.row_number().over(W.partitionBy("doc_id").orderBy("page_number")) - 1)


def document_text(lines: DataFrame, pack: LanguagePack = RUSSIAN) -> DataFrame:
    """``(doc_id, text)``: all pages of a document, joined in order; null if all are blank."""
    pages = page_texts(lines, pack).groupBy("doc_id").agg(F.sort_array(F.collect_list(F.when(F.col("page_text").isNotNull(), F.struct("pos", "page_text")))).alias("p"))
    return pages.select("doc_id", F.when(F.size("p") > 0, F.array_join(F.transform("p", lambda x: x["page_text"]), "\n")).alias("text"))


def chunk_spans(pages: DataFrame, pages_per_chunk: int = PAGES, max_chars: int = CHARS) -> DataFrame:
    """``(doc_id, batch, lo, hi)``: ranges of ``pos`` [lo, hi) that become chunks.

    Batches of consecutive pages; a batch whose text is too long is halved (the first half the smaller), again until
    it fits or is one page. The length of a text is additive in its pages, so prefix sums by window give it for any
    range, and the halvings are a fixed number of levels, logarithmic in the batch, without recursion.
    """
    k = max(1, pages_per_chunk)
    doc = W.partitionBy("doc_id").orderBy("pos")
    pages = pages.select("doc_id", "pos", F.coalesce(F.length("page_text") + 1, F.lit(0)).alias("len"))
    pages = pages.withColumn("batch", F.expr(f"int(pos div {k})")).withColumn("upto", F.sum("len").over(doc))
    batches = pages.groupBy("doc_id", "batch").agg(F.min("pos").alias("lo"), (F.max("pos") + 1).alias("hi"), F.min(F.col("upto") - F.col("len")).alias("before"), F.sort_array(F.collect_list(F.struct("pos", "upto"))).alias("sums"))
    node = F.array(F.struct("lo", "hi"))
    length = lambda n: (
        F.element_at("sums", n["hi"] - F.col("lo"))["upto"] - F.when(n["lo"] == F.col("lo"), F.col("before")).otherwise(F.element_at("sums", F.greatest(n["lo"] - F.col("lo"), F.lit(1)))["upto"]) - 1
    )
    nodes = batches.withColumn("nodes", node)
    for _ in range(math.ceil(math.log2(k)) if k > 1 else 0):
        mid = lambda n: (n["lo"] + F.floor((n["hi"] - n["lo"]) / 2)).cast("int")
        whole = lambda n: F.array(F.struct(n["lo"].cast("int").alias("lo"), n["hi"].cast("int").alias("hi")))
        split = lambda n: F.array(F.struct(n["lo"].cast("int").alias("lo"), mid(n).alias("hi")), F.struct(mid(n).alias("lo"), n["hi"].cast("int").alias("hi")))
        nodes = nodes.withColumn("nodes", F.flatten(F.transform("nodes", lambda n: F.when((length(n) > max_chars) & (n["hi"] - n["lo"] > 1), split(n)).otherwise(whole(n)))))
    nodes = nodes.withColumn("nodes", F.filter("nodes", lambda n: length(n) > 0))
    return nodes.select("doc_id", "batch", F.explode("nodes").alias("n")).select("doc_id", "batch", F.col("n.lo").cast("int").alias("lo"), F.col("n.hi").cast("int").alias("hi"))


def chunks(lines: DataFrame, pages_per_chunk: int = PAGES, max_chars: int = CHARS, pack: LanguagePack = RUSSIAN) -> DataFrame:
    """``(doc_id, chunk_no, start_page, end_page, text)``; blank ranges have none, and the range of a chunk counts its blank
    pages. A single page that is too long is cut at ``max_chars``."""
    pages = page_texts(lines, pack)
    spans = chunk_spans(pages, pages_per_chunk, max_chars)
    k = max(1, pages_per_chunk)
    pages = pages.withColumn("batch", F.expr(f"int(pos div {k})"))
    of = pages.join(spans, ["doc_id", "batch"]).where("pos >= lo and pos < hi")
    out = of.groupBy("doc_id", "lo").agg(
        F.min("page_number").alias("start_page"), F.max("page_number").alias("end_page"),
        F.sort_array(F.collect_list(F.when(F.col("page_text").isNotNull(), F.struct("pos", "page_text")))).alias("p"),
    )
    text = F.substring(F.array_join(F.transform("p", lambda x: x["page_text"]), "\n"), 1, max_chars)
    number = F.row_number().over(W.partitionBy("doc_id").orderBy("lo"))
    return out.select("doc_id", number.alias("chunk_no"), "start_page", "end_page", text.alias("text"))
