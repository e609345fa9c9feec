"""Containers of fixed capacity by hierarchical residual packing.

Sizes and ids are mixed by hash, so that sorted input gives every partition all kinds of items, and each partition
packs its items best-fit in decreasing order. Nearly full containers are final; the others, all of
them, go on as items of their own to a round with fewer partitions, mixed by hash so that each sees all kinds
of rests, until one partition is left. A round has so many partitions that none takes on more than about
``CARRY`` containers. Where that number does not fall any more (rests that fit nothing, as of items above
half the capacity) a last round leaves them as they are. Containers are never opened again.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.shared import cut

CAPACITY = 2048
#: A container filled to this share is final.
NEARLY_FULL = 0.998
#: Containers that a partition of a later round takes on, about.
CARRY = 20_000
#: A round that leaves more than this share of its containers open makes no progress.
STUCK = 0.99
_SCHEMA = "container string, part int, used int, members array<struct<doc_id:bigint,part_no:int,tokens:int>>"


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Indices of the items of each container: largest first, each into the fullest container that takes it."""
    bins: list[list[int]] = []
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    gaps = 0  # bit g: some container has a gap of g
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fit = gaps >> sizes[i]
        if fit:
            gap = sizes[i] + (fit & -fit).bit_length() - 1
            b = by_gap[gap].pop()
            if not by_gap[gap]:
                gaps &= ~(1 << gap)
        else:
            gap, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        rest = gap - sizes[i]
        if rest:
            by_gap[rest].append(b)
            gaps |= 1 << rest
    return bins


def pack(sizes: DataFrame, capacity: int = CAPACITY, nearly_full: float = NEARLY_FULL) -> DataFrame:
    """``(container, doc_id, part_no, tokens, used)``: the items of ``sizes(doc_id, tokens)`` in containers.

    Items of 0 tokens, null sizes and null ids have no rows. An item above ``capacity`` is split into full
    parts and a rest, numbered from 1; all others have the one part 1. ``container`` names the round,
    the partition and the place where it was made. Rows repeated under one id are items of their own.
    """
    cap = F.lit(capacity)
    items = (
        sizes.select(F.col("doc_id").cast("bigint"), F.col("tokens").cast("int"))
        .where("doc_id is not null and tokens > 0")
        .select("doc_id", F.col("tokens").alias("all"), F.explode(F.sequence(F.lit(1), F.ceil(F.col("tokens") / cap).cast("int"))).alias("part_no"))
        .select("doc_id", "part_no", F.least(cap, F.col("all") - (F.col("part_no") - 1) * cap).cast("int").alias("tokens"))
    )
    bins = items.select(F.lit("").alias("container"), F.lit(0).alias("part"), F.col("tokens").alias("used"), F.array(F.struct("doc_id", "part_no", "tokens")).alias("members"))

    def round_of(number: int):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            here = TaskContext.get().partitionId()
            used: list[int] = []
            members: list = []
            for batch in batches:
                used += batch["used"].tolist()
                members += batch["members"].tolist()
            made = [(sum(used[i] for i in b), [m for i in b for m in members[i]]) for b in best_fit(used, capacity)]
            for at in range(0, len(made), 2000):
                rows = [(f"{number}-{here}-{at + k}", -1 if u >= nearly_full * capacity else 0, u, m) for k, (u, m) in enumerate(made[at : at + 2000])]
                yield pd.DataFrame(rows, columns=["container", "part", "used", "members"])

        return run

    mixed = bins.repartition(F.expr("xxhash64(members[0].doc_id, members[0].part_no)"))
    made = cut(mixed.mapInPandas(round_of(0), _SCHEMA), "bins")
    done, number, before = [made.where("part = -1")], 0, None
    while True:
        bins = made.where("part = 0")
        left, number = bins.count(), number + 1
        parts = max(1, -(-left // CARRY))
        if parts > 1 and before is not None and left > before * STUCK:
            done.append(bins)
            break
        bins = bins.repartition(parts, F.expr(f"xxhash64({number}, members[0].doc_id, members[0].part_no)"))
        made, before = cut(bins.mapInPandas(round_of(number), _SCHEMA), "bins"), left
        if parts == 1:
            done.append(made)
            break
        done.append(made.where("part = -1"))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.select("container", "used", F.explode("members").alias("m")).select("container", "m.doc_id", "m.part_no", "m.tokens", "used")
