"""Pieces of oversized texts by pointer doubling over their boundaries.

The boundaries of a text (paragraph, sentence, line and word ends) form one table. Every boundary is joined
to its farthest legal successor: the end of the longest piece that, overlap included, begins there.
Squaring that successor table (each entry replaced by the entry of its entry) doubles the reach of every
pointer, so all cuts of the greedy split are marked in a logarithmic number of rounds without walking
through the text piece by piece. A text's table never meets another's, so the whole of it is done on the
Arrow batch that holds the text and only long texts leave the JVM.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT, OVERLAP = 3000, 200
_STRONG = re.compile(r"(?:\r\n|\r|\n)(?:[^\S\r\n]*(?:\r\n|\r|\n))+|[.!?…;][\"»”')\]]*\s+|[。！？]")
_WEAK = re.compile(r"\s+")


def _boundaries(text: str, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions where a piece may end, in order, and whether each is the end of a sentence or paragraph."""
    strong = {m.end() for m in _STRONG.finditer(text)}
    ends = np.array(sorted({0, len(text)} | strong | {m.end() for m in _WEAK.finditer(text)}), dtype=np.int64)
    wide = np.flatnonzero(np.diff(ends) > reach)
    if wide.size:  # no natural boundary within reach: cut by length, but not inside a character with its marks
        hard = []
        for k in wide:
            at = ends[k] + reach
            while at < ends[k + 1]:
                p = int(at)
                while p > ends[k] + reach // 2 and (unicodedata.combining(text[p]) or text[p] in "‍️" or text[p - 1] == "‍"):
                    p -= 1
                hard.append(p)
                at = p + reach
        ends = np.union1d(ends, np.array(hard, dtype=np.int64))
    return ends, np.isin(ends, np.fromiter(strong | {len(text)}, dtype=np.int64))


def pieces(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    """``(start, end)`` of each piece of a text, in characters."""
    if len(text) <= limit:
        return [(0, len(text))]
    at, strong = _boundaries(text, limit - overlap)
    n = len(at)
    # where the piece after the cut at[k] starts: the first boundary not more than overlap before it, or that very place
    start = at[np.searchsorted(at, at - overlap, "left")]
    bare = (start == at) & (at > 0)
    start[bare] = at[bare] - overlap
    start = np.maximum(start, 0)
    farthest = np.searchsorted(at, start + limit, "right") - 1
    last_strong = np.maximum.accumulate(np.where(strong, np.arange(n), -1))
    preferred = last_strong[farthest]
    good = (preferred > np.arange(n)) & (at[np.maximum(preferred, 0)] > start + limit // 2)
    successor = np.where(good, preferred, farthest)
    successor[-1] = n - 1
    # a cut must also move the start of the next piece
    marked = np.zeros(n, dtype=bool)
    marked[0] = True
    jump = successor
    for _ in range(int(n).bit_length()):
        marked[jump[marked]] = True
        jump = jump[jump]
    cuts = np.flatnonzero(marked)
    return [(int(start[a]), int(at[b])) for a, b in zip(cuts[:-1], cuts[1:])]


def split_pages(pages: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """``(doc_id, page_number, version, piece_no, start, end, piece)`` of every page longer than ``limit``.

    A piece has at most ``limit`` characters and, but for the first, begins with up to ``overlap`` characters
    of the end of the one before. Pages of at most ``limit`` characters and null texts have no rows. Exact
    repeats of a row come once; if one ``(doc_id, page_number)`` has several different texts, ``version``
    tells them apart (1 otherwise). Null ids are kept as they are.
    """
    long = pages.select(F.col("doc_id").cast("bigint"), F.col("page_number").cast("int"), "full_text").where(F.length("full_text") > limit)
    long = long.withColumn("mark", F.xxhash64("full_text")).dropDuplicates(["doc_id", "page_number", "mark"])

    def cut_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [
                (doc, page, mark, k, a, b, text[a:b])
                for doc, page, text, mark in zip(batch["doc_id"], batch["page_number"], batch["full_text"], batch["mark"])
                for k, (a, b) in enumerate(pieces(text, limit, overlap), 1)
            ]
            yield pd.DataFrame(out, columns=["doc_id", "page_number", "mark", "piece_no", "start", "end", "piece"])

    cut = long.mapInPandas(cut_batches, "doc_id bigint, page_number int, mark bigint, piece_no int, start int, end int, piece string")
    versions = long.groupBy("doc_id", "page_number").agg(F.sort_array(F.collect_set("mark")).alias("marks")).where(F.size("marks") > 1)
    same = cut.doc_id.eqNullSafe(versions.doc_id) & cut.page_number.eqNullSafe(versions.page_number)
    return cut.join(versions, same, "left").select(
        cut.doc_id, cut.page_number, F.coalesce(F.array_position("marks", cut.mark), F.lit(1)).cast("int").alias("version"), "piece_no", "start", "end", "piece"
    )
