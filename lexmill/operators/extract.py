"""The whole rule-based extraction of a document's lists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexmill.functions.language import RUSSIAN, LanguagePack
from lexmill.operators.chunks import CHARS, PAGES, chunks
from lexmill.operators.lines import line_stream
from lexmill.operators.pairs import fallback_pairs, first_wins, pairs_of_lines, pairs_of_tables
from lexmill.operators.replies import complete, prompts, reply_lists, reply_status
from lexmill.operators.sections import section_blocks, spans_of, text_within, with_spans
from lexmill.shared import cut

_OUT = ["doc_id", "kind", "key", "value", "page_number", "source_line", "rank", "place"]
#: A list with fewer pairs calls for the next way of finding them.
FEW = 2
#: Why a document fails whose reply holds no JSON.
NO_JSON = "Ответ модели не содержит JSON"


def _placed(pairs: DataFrame, rank: int, *place: str) -> DataFrame:
    parts = [F.col(c).cast("double") for c in place] + [F.lit(0.0)] * (2 - len(place))
    return pairs.withColumn("rank", F.lit(rank)).withColumn("place", F.struct(parts[0].alias("a"), parts[1].alias("b"))).select(*_OUT)


def merged(a: DataFrame, b: DataFrame) -> DataFrame:
    """All of ``a``, then what is new in ``b`` (by key and value, case ignored)."""
    return first_wins(a.unionByName(b), "rank", "place")


def extract_lists(lines: DataFrame, pack: LanguagePack = RUSSIAN) -> DataFrame:
    """``(doc_id, kind, key, value, page_number, source_line, rank, place)`` from ``lines`` with geometry.

    Pairs of the sections' lines; for a kind with fewer than two, those of its pages' two-column layout are merged in;
    where both kinds still have fewer than two, both are replaced by the pairs of all lines. ``rank`` tells the way
    (0, 1, 2) and ``place`` the order within it. Documents without any pair have no rows.
    """
    bounds = [f"{c}_{k}" for c in ("start", "end") for k in ("abbreviations", "terms")]
    # every later step starts from the numbered lines and the bounds of their sections; they are made once
    stream = cut(with_spans(line_stream(lines), pack).select("doc_id", "page_number", "seq", "text", *bounds), "stream")
    by_line = cut(_placed(first_wins(pairs_of_lines(text_within(stream)), "seq"), 0, "seq"), "by_line")
    enough = by_line.groupBy("doc_id", "kind").count().where(F.col("count") >= FEW).select("doc_id", "kind")
    needy = spans_of(stream).join(enough, ["doc_id", "kind"], "left_anti")
    by_table = _placed(pairs_of_tables(section_blocks(lines, needy)), 1, "page_number", "y")
    found = cut(merged(by_line, by_table), "found")
    rich = found.groupBy("doc_id", "kind").count().where(F.col("count") >= FEW).select("doc_id").distinct()
    kept = found.join(rich, "doc_id", "left_semi")
    by_all = first_wins(_placed(fallback_pairs(stream.drop(*bounds).join(rich, "doc_id", "left_anti")), 2, "seq"), "place")
    return kept.unionByName(by_all)


def model_lists(lines: DataFrame, backend: Callable[[str], str], pages_per_chunk: int = PAGES, max_chars: int = CHARS) -> tuple[DataFrame, DataFrame]:
    """The lists a language model finds, as ``extract_lists`` gives them, and ``(doc_id, message)`` of the documents that fail.

    Chunks are prompted once each and the replies written before they are used, for a model is slow and not
    deterministic. One reply without JSON, or an error of the model, fails its document, which has no lists then.
    """
    replies = cut(complete(prompts(chunks(lines, pages_per_chunk, max_chars), max_chars), backend).drop("prompt", "text"), "replies")
    fatal = reply_status(replies).where("status = 'fatal'")
    failed = fatal.groupBy("doc_id").agg(F.min_by(F.coalesce("error", F.lit(NO_JSON)), "chunk_no").alias("message"))
    return _placed(reply_lists(replies), 0, "chunk_no", "place"), failed


def numbered(lists: DataFrame) -> DataFrame:
    """The lists with ``pos``, the place of a pair in its document's list, from 1."""
    order = W.partitionBy("doc_id", "kind").orderBy("rank", "place")
    return lists.withColumn("pos", F.row_number().over(order)).drop("rank", "place")


def result_counts(documents: DataFrame, lists: DataFrame) -> DataFrame:
    """``(doc_id, abbreviations, terms)`` of every document, zeros too."""
    counts = lists.groupBy("doc_id").agg(F.count_if(F.col("kind") == "abbreviations").alias("abbreviations"), F.count_if(F.col("kind") == "terms").alias("terms"))
    return documents.select("doc_id").distinct().join(counts, "doc_id", "left").fillna(0, ["abbreviations", "terms"])
