"""Ids of texts by a public byte-level tokenizer, through chunks that are encoded once for the whole corpus.

A text is cut where a rolling hash of its last characters meets a fixed condition, so equal passages are cut alike
in whatever document and at whatever offset they stand. Encoding a chunk by itself is wrong near its ends, so
every cut is repaired: a window around it grows on both sides until the ids on either side agree whatever the
context, which is where a single space stands between two characters that are no space, for no pre-token of
the vocabulary's pattern reaches over such a place. Windows are encoded where they stand; windows that
touch are one, and a text without such a place is a window as a whole. What is left between the windows of
a document are pieces that can be encoded by themselves. Equal pieces of all documents are brought together by
a 128-bit hash and encoded once there, so their ids need no join; the parts of a document meet again by
its place. A piece that a large share of all documents holds makes a partition that the adaptive rebalancing
splits, and is then encoded once for each split. Ids travel as packed binary.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Where the vocabularies are; a parameter of every function here.
TOKENIZERS = os.environ.get("LEXMILL_TOKENIZERS", "/opt/tokenizers")
#: Fixed value: the splitting pattern that belongs to the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters of the rolling hash (a power of two), and mean distance of cuts in characters.
WINDOW, DISTANCE = 16, 1024
_BASE = 0x9E3779B97F4A7C15
_SPACE = np.array([chr(c).isspace() for c in range(0x3001)])
_encoders: dict[str, object] = {}


def encoder(folder: str = TOKENIZERS, name: str = "byte_bpe_50k"):
    """The tokenizer's own function from a text to ids, without special tokens; the vocabulary is read once per worker."""
    import tiktoken

    path = f"{folder}/{name}.tiktoken"
    if path not in _encoders:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encoders[path] = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    return _encoders[path]


def cuts(codes: np.ndarray, distance: int = DISTANCE) -> np.ndarray:
    """Places after which a text (in code points) is cut: where the hash of the last ``WINDOW`` characters is 0 modulo ``distance``."""
    if len(codes) < WINDOW:
        return np.zeros(0, dtype=np.int64)
    h, width, base = codes.astype(np.uint64), 1, _BASE
    while width < WINDOW:  # from the hash of a window to that of one twice as long
        h = h[width:] + h[:-width] * np.uint64(base)
        width, base = 2 * width, base * base & 0xFFFFFFFFFFFFFFFF
    return np.flatnonzero((h >> np.uint64(33)) % np.uint64(distance) == 0) + WINDOW


def sound(codes: np.ndarray) -> np.ndarray:
    """Places of single spaces between characters that are no space: a pre-token begins there in every context."""
    blank = _SPACE[np.minimum(codes, 0x3000)] & (codes <= 0x3000)
    return np.flatnonzero((codes[1:-1] == 32) & ~blank[:-2] & ~blank[2:]) + 1 if len(codes) > 2 else np.zeros(0, dtype=np.int64)


def parts(text: str, distance: int = DISTANCE) -> list[tuple[int, int, bool]]:
    """``(begin, end, shared)`` of the windows (not shared) and pieces of a text, in order, without gaps."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    n, at, places = len(codes), cuts(codes, distance), sound(codes)
    k = np.searchsorted(places, at, "right")
    bounds = np.concatenate([[0], places, [n]])
    out, end = [], 0
    for a, b in zip(bounds[k].tolist(), bounds[k + 1].tolist()):  # the last sound place up to the cut, and the next
        if a > end:
            out.append((end, a, True))
        elif out and not out[-1][2]:
            a = out.pop()[0]
        else:
            a = end
        out.append((a, b, False))
        end = b
    if end < n:
        out.append((end, n, True))
    return out


def _packing(encode) -> str:
    return "<u2" if encode.__self__.n_vocab <= 1 << 16 else "<u4"


def pieces(docs: DataFrame, folder: str = TOKENIZERS, name: str = "byte_bpe_50k", distance: int = DISTANCE) -> DataFrame:
    """``(place, doc_id, seq, of, before, piece)``: the pieces of each row, ``before`` each the packed ids of the window that precedes it.

    ``place`` tells rows apart and ``of`` is their number of parts. A row ends in a part without a piece if it ends in a
    window; null and empty texts have one part with neither.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, place = encoder(folder, name), TaskContext.get().partitionId() << 40
        packing = _packing(encode)
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch["doc_id"], batch["text"]):
                before, mine = b"", []
                for a, b, shared in parts(text, distance) if text else []:
                    if shared:
                        mine.append((before, text[a:b]))
                        before = b""
                    else:
                        before = np.array(encode(text[a:b]), dtype=packing).tobytes()
                if before or not mine:
                    mine.append((before, None))
                rows += [(place, doc, k, len(mine), *x) for k, x in enumerate(mine)]
                place += 1
            yield pd.DataFrame(rows, columns=["place", "doc_id", "seq", "of", "before", "piece"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInPandas(run, "place bigint, doc_id bigint, seq int, of int, before binary, piece string")


def encode_corpus(docs: DataFrame, folder: str = TOKENIZERS, name: str = "byte_bpe_50k", distance: int = DISTANCE) -> DataFrame:
    """``(doc_id, ids)`` of every row: the tokenizer's ids of ``text`` without special tokens.

    Null and empty texts have an empty list. Blank texts, unpaired line ends, very long texts and texts with
    the spelling of special tokens are ordinary texts. Repeated rows come as often as they stand.
    """

    def once(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(folder, name)
        packing, key, packed = _packing(encode), None, b""
        for batch in batches:
            out = []
            for h1, h2, before, piece in zip(batch["h1"], batch["h2"], batch["before"], batch["piece"]):
                if piece is None:
                    out.append(before)
                    continue
                if (h1, h2) != key:  # equal pieces stand one after another
                    key, packed = (h1, h2), np.array(encode(piece), dtype=packing).tobytes()
                out.append(before + packed)
            yield batch[["place", "doc_id", "seq", "of"]].assign(packed=out)

    def joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packing = _packing(encoder(folder, name))
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "ids": [np.frombuffer(b"".join(x["packed"] for x in p), dtype=packing).astype(np.int32) for p in batch["p"]]})

    made = pieces(docs, folder, name, distance)
    # parts without a piece are spread by their place
    made = made.withColumn("h1", F.xxhash64(F.coalesce("piece", F.col("place").cast("string")))).withColumn("h2", F.xxhash64(F.lit(7), "piece"))
    together = made.hint("rebalance", "h1", "h2").sortWithinPartitions("h1", "h2")
    done = together.mapInPandas(once, "place bigint, doc_id bigint, seq int, of int, packed binary")
    whole = done.groupBy("place").agg(F.first("doc_id").alias("doc_id"), F.array_sort(F.collect_list(F.struct("seq", "packed"))).alias("p"))
    return whole.select("doc_id", "p").mapInPandas(joined, "doc_id bigint, ids array<int>")


def count_tokens(docs: DataFrame, folder: str = TOKENIZERS, name: str = "byte_bpe_50k") -> DataFrame:
    """``(doc_id, tokens)`` of every row; 0 for null and empty texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(folder, name)
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "tokens": [len(encode(t)) if t else 0 for t in batch["text"]]})

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInPandas(run, "doc_id bigint, tokens int")
