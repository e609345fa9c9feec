"""Edited versions of one text: all pairs whose word sets have a Jaccard similarity of at least a threshold.

Meet-in-the-middle ball hashing. The fingerprint of a text is its ``budget + L`` rarest words in one global order,
where ``budget`` is how many of its words a similar text may lack. Between two similar texts' fingerprints
at most ``budget`` words have to go on either side, so the ball to search has a radius of twice that in
deletions and insertions; every fingerprint emits all its variants within half of it, the deletions, and two
similar texts meet in a common variant: a set of L words. A word that few texts hold is variant enough by
itself, so words of the fingerprint that are rare are emitted singly, and sets of L only of the others.
That loses nothing: of the L or more words that two fingerprints share, one is rare or all are not.

Variants are shuffled by their hash; pairs that meet are filtered by size and by a bit signature whose
difference bounds the words that differ, deduplicated, and verified on the whole word sets. Texts equal but
for formatting are one class throughout, however many they are.

A variant that many classes hold tells little, and its pairs are not made. Similar texts of ``a`` and ``b`` words
share at least ``t / (1 + t) * (a + b)``, so of the classes that hold a crowded variant of L words those pairs
whose sizes bound the shared words by L are similar for certain and are joined by their sizes; any other
similar pair shares a word more. The first L + 1 words they share in the global order are the first L and a
later one, so each crowded variant is extended by the later words of the (longer) fingerprint, and again while
variants are crowded. What is made is thus a result, or a pair out of at most ``CROWD`` classes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexmill.llm.copies import SALTS, letters_and_digits
from lexmill.shared import cut

THRESHOLD = 0.8
#: A word is rare if at most so many classes hold it.
RARE = 128
#: Frequent words that are broadcast with their counts, the most frequent first: 12 bytes each, 12 MB at most.
#: A word beyond them counts as rare, which costs time but loses nothing.
WORDS = 1_000_000
#: Words of a variant by the size of the text: up to this size (exclusive) and from this size on.
SIZES = ((3, 0, 100), (2, 80, 1250), (1, 1000, 1 << 60))
#: A variant that more classes hold is refined: variants of one more word take its place.
CROWD = 200
#: Members of a class that one task expands at most (about); classes with more are spread.
SPREAD = 4096
#: Bits that tell the classes asked for before words are shuffled; they are broadcast as 524,288 numbers at most.
#: Where more are set, more classes pass that nobody asked for, which costs shuffle and loses nothing.
MARKS = 1 << 25
#: Variants are handed over in batches of about so many.
_BATCH = 500_000


def _hash(seed: int, *cols) -> F.Column:
    return F.xxhash64(F.lit(seed), *cols)


def classes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of ``rows(source_table, id, value)``: the classes ``(source_table, cid, k1, words)`` with ``words`` the hashes of the distinct
    words, and the members ``(source_table, cid, id)``. Values without words have no class."""
    value = F.col("value")
    keyed = rows.where("id is not null and value is not null").select("source_table", "id", letters_and_digits(value).alias("key"), F.array_distinct(F.regexp_extract_all(F.lower(value), F.lit(r"([\p{L}\p{N}]+)"), 1)).alias("w"))
    keyed = keyed.where(F.size("w") > 0).select("source_table", "id", F.xxhash64("key").alias("k1"), F.sort_array(F.transform("w", lambda x: F.xxhash64(x))).alias("words"))
    # a class may hold a large share of all rows: it is counted in salted parts, and its members meet the first by part
    keyed = cut(keyed.withColumn("k2", F.xxhash64("words")).withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")), "words")
    parts = keyed.groupBy("source_table", "k1", "k2", "salt").agg(F.min("id").alias("part_first"))
    first = parts.groupBy("source_table", "k1", "k2").agg(F.min("part_first").alias("cid"))
    spread = parts.drop("part_first").join(first, ["source_table", "k1", "k2"])
    members = keyed.select("source_table", "k1", "k2", "salt", "id").join(spread, ["source_table", "k1", "k2", "salt"])
    members = cut(members.select("source_table", "cid", "id").distinct(), "members")
    reps = keyed.join(members.where("cid = id").select("source_table", "id"), ["source_table", "id"], "left_semi")
    reps = cut(reps.select("source_table", F.col("id").alias("cid"), "k1", "words").dropDuplicates(["source_table", "cid"]), "classes")
    return reps, members


def _frequent(reps: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    counted = reps.select(F.explode("words").alias("w")).groupBy("w").count().where(F.col("count") > RARE)
    top = counted.orderBy(F.desc("count"), "w").limit(WORDS).toPandas()  # at most WORDS rows
    top = top.sort_values("w")
    return top["w"].to_numpy(np.int64), top["count"].to_numpy(np.int64)


def _mix(a: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        a = a.astype(np.uint64)
        a = (a ^ (a >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        return a ^ (a >> np.uint64(29))


def _least(threshold: float, n: int) -> int:
    """Words that a text similar to one of ``n`` words has and shares with it, at least."""
    return int(np.ceil(threshold * n - 1e-9))


def _first_sizes(n: int, threshold: float) -> list[int]:
    """Sizes of the first variants of a text of ``n`` words. Short texts share fewer words than a full variant has: a pair meets in
    the size of its smaller text, so the sizes of all smaller texts that may be similar are emitted too."""
    least = _least(threshold, n)
    return sorted({k for size, low, high in SIZES if low <= n < high for k in range(min(size, _least(threshold, least)), min(size, least) + 1)})


def _key(sums: np.ndarray, size) -> np.ndarray:
    """A commutative hash of a set from the sum of its mixed words, other for every set size."""
    return _mix(sums + np.asarray(size, dtype=np.uint64)).view(np.int64)


def _steps(common: np.ndarray, combos: np.ndarray, sums: np.ndarray, size: int, crowded: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Of variants (positions in ``common`` and sums of their words) those that are crowded, each extended by every later word before ``limit``."""
    hit = np.isin(_key(sums, size), crowded)
    combos, sums = combos[hit], sums[hit]
    more = np.maximum(limit - 1 - combos[:, -1], 0)
    at = np.repeat(np.arange(len(combos)), more)
    later = combos[at, -1] + 1 + (np.arange(len(at)) - np.repeat(np.cumsum(more) - more, more))
    return np.column_stack([combos[at], later]), sums[at] + common[later]


def _variants(batches: Iterator[pd.DataFrame], frequent, threshold: float, step: int) -> Iterator[pd.DataFrame]:
    """Variants ``(tab, key, cid, n, sig, size)`` of classes ``(tab, cid, words, crowded)``: at step 0 all of the first size, at a
    later one the extensions of those in ``crowded``, which has the crowded keys of all steps before."""
    words, counts = frequent
    sets: dict[tuple[int, int], np.ndarray] = {}
    first_sizes: dict[int, list[int]] = {}
    tabs, cids, sums_of, sizes, ns, sigs, held = [], [], [], [], [], [], 0

    def out() -> pd.DataFrame:
        reps = [len(k) for k in sums_of]
        frame = {c: np.repeat(np.array(v, dtype=d), reps) for c, v, d in (("tab", tabs, np.int64), ("cid", cids, np.int64), ("n", ns, np.int32), ("sig", sigs, np.int64), ("size", sizes, np.int32))}
        return pd.DataFrame({"tab": frame["tab"], "key": _key(np.concatenate(sums_of), frame["size"].astype(np.uint64)), "cid": frame["cid"], "n": frame["n"], "sig": frame["sig"], "size": frame["size"]})

    for batch in batches:
        each = [np.asarray(w, dtype=np.int64) for w in batch["words"]]
        if not each:
            continue
        # whole batches at a time: mixed words, how many classes hold them (0: rare), signatures
        flat, ends = np.concatenate(each), np.cumsum([len(w) for w in each])
        place = np.minimum(np.searchsorted(words, flat), max(len(words) - 1, 0))
        often = np.where(words[place] == flat, counts[place], 0) if len(words) else np.zeros(len(flat), dtype=np.int64)
        # rare words come first in the global order, so of the first shared words one is rare or none of all
        order = np.lexsort((flat, often, np.repeat(np.arange(len(each)), np.diff(ends, prepend=0))))
        sig_of = np.bitwise_or.reduceat(np.left_shift(np.uint64(1), flat.view(np.uint64) % np.uint64(64)), ends - np.diff(ends, prepend=0)).view(np.int64).tolist()
        all_mixed, all_rare = _mix(flat[order].view(np.uint64)), np.concatenate([[0], np.cumsum(often[order] == 0)])
        for tab, cid, end, sig, w, crowd in zip(batch["tab"], batch["cid"], ends.tolist(), sig_of, each, batch["crowded"]):
            n = len(w)
            mixed, rare_from = all_mixed[end - n : end], all_rare[end - n : end + 1]
            least = _least(threshold, n)
            if n not in first_sizes:
                first_sizes[n] = _first_sizes(n, threshold)
            for size in first_sizes[n]:
                first = min(n, n - least + size)
                rare = int(rare_from[first] - rare_from[0])
                common, q = mixed[rare:], first - rare
                made: list[tuple[np.ndarray, int]] = [(mixed[:rare], 1)] if rare and not step else []
                if q >= size:
                    if (q, size) not in sets:
                        if len(sets) > 200:
                            sets.clear()
                        sets[q, size] = np.array(list(combinations(range(q), size)), dtype=np.int64)
                    combos = sets[q, size]
                    sums = common[combos].sum(axis=1)
                    if not step:
                        made.append((sums, size))
                    else:
                        crowd = np.asarray(crowd, dtype=np.int64)
                        # a few variants at a time: their extensions are many where a long text has only frequent words
                        for low in range(0, len(combos), 1 << 14):
                            part, total = combos[low : low + (1 << 14)], sums[low : low + (1 << 14)]
                            for k in range(step):
                                part, total = _steps(common, part, total, size + k, crowd, min(n, n - least + size + k + 1) - rare)
                                if not len(part):
                                    break
                            if len(part):
                                made.append((total, size + step))
                                held += len(total)
                                if held > _BATCH:
                                    for key, s in made:
                                        tabs.append(tab), cids.append(cid), sums_of.append(key), sizes.append(s), ns.append(n), sigs.append(sig)
                                    yield out()
                                    tabs, cids, sums_of, sizes, ns, sigs, held, made = [], [], [], [], [], [], 0, []
                for key, s in made:
                    tabs.append(tab), cids.append(cid), sums_of.append(key), sizes.append(s), ns.append(n), sigs.append(sig)
                    held += len(key) if not step else 0
            if held > _BATCH:
                yield out()
                tabs, cids, sums_of, sizes, ns, sigs, held = [], [], [], [], [], [], 0
    if sums_of:
        yield out()


def _meet(variants: DataFrame, threshold: float, *by: str) -> DataFrame:
    """Pairs of classes that share a variant (and agree in ``by``, a side's own size and its partner's) and pass the filters, each once."""
    a = variants.select("tab", "key", F.col("cid").alias("a"), F.col("n").alias("na"), F.col("sig").alias("sa"), *(F.col(c).alias(f"_{i}") for i, c in enumerate(by)))
    b = variants.select("tab", "key", F.col("cid").alias("b"), F.col("n").alias("nb"), F.col("sig").alias("sb"), *(F.col(c).alias(f"_{i}") for i, c in enumerate(reversed(by))))
    met = a.join(b, ["tab", "key", *(f"_{i}" for i in range(len(by)))]).where("a < b")
    met = met.where((F.col("na") >= F.col("nb") * (threshold - 1e-9)) & (F.col("nb") >= F.col("na") * (threshold - 1e-9)))
    # words that differ: at most (1 - t) / (1 + t) of the sum of sizes; each differing bit needs one of its own
    apart = F.floor((F.col("na") + F.col("nb")) * ((1 - threshold) / (1 + threshold)) + 1e-9)
    return met.where(F.bit_count(F.col("sa").bitwiseXOR(F.col("sb"))) <= apart).select("tab", "a", "b").distinct()


def _certain(crowded: DataFrame, threshold: float) -> DataFrame:
    """Pairs of classes in crowded variants that are similar by their sizes alone: each class asks for the sizes its partner may have."""
    most = F.floor(F.col("size") * ((1 + threshold) / threshold) + 1e-9).cast("int") - F.col("n")
    asked = crowded.where(most >= F.col("size")).withColumn("m", F.explode(F.sequence(F.col("size"), most)))
    return _meet(asked, threshold, "n", "m")


def _held(variants: DataFrame, label: str) -> DataFrame:
    """Variants of more than one class, with their number of classes; those of one class are the most, and gone before pairs are made.
    They are counted where they meet, so that each passes one exchange and those of one class are never written."""
    held = F.count("*").over(Window.partitionBy("tab", "key"))
    return cut(variants.withColumn("held", held).where("held > 1"), label)


def _marked(reps: DataFrame, ids: DataFrame, label: str) -> DataFrame:
    """Those of ``reps`` that ``ids(tab, cid)`` has, and few others, without an exchange of ``reps``."""
    bit = F.pmod(F.xxhash64("tab", "cid"), F.lit(MARKS))
    at, mask = F.shiftright(bit, 6).alias("at"), F.expr(f"shiftleft(1L, cast(pmod(xxhash64(tab, cid), {MARKS}L) & 63 as int))")
    marks = ids.select(at, mask.alias("bits")).groupBy("at").agg(F.bit_or("bits").alias("bits"))  # at most MARKS / 64 rows
    return cut(reps.select("*", at).join(F.broadcast(marks), "at").where(F.col("bits").bitwiseAND(mask) != 0).select(*reps.columns), label)


def similar(reps: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(source_table, a, b)``, a < b: the pairs of different classes that are similar."""
    sent = reps.sparkSession.sparkContext.broadcast(_frequent(reps))
    schema = "tab bigint, key bigint, cid bigint, n int, sig bigint, size int"
    reps = reps.withColumn("tab", F.xxhash64("source_table"))
    plain = reps.select("tab", "cid", "words")
    first = plain.withColumn("crowded", F.array().cast("array<bigint>"))
    met = _held(first.mapInPandas(lambda batches: _variants(batches, sent.value, threshold, 0), schema), "variants")
    pairs = cut(_meet(met.where(F.col("held") <= CROWD), threshold), "pairs")
    step, known = 0, None
    while True:
        crowded = met.where(F.col("held") > CROWD)
        if crowded.isEmpty():
            break
        step += 1
        certain = _certain(crowded, threshold)
        keys = crowded.select("tab", "cid", "key")
        known = keys if known is None else known.unionByName(keys)
        asked = known.join(keys.select("tab", "cid").distinct(), ["tab", "cid"], "left_semi").groupBy("tab", "cid").agg(F.collect_set("key").alias("crowded"))
        plain = _marked(plain, keys, "asked")  # a later step asks only for classes of the one before
        again = plain.join(asked, ["tab", "cid"])
        met = _held(again.mapInPandas(lambda batches, step=step: _variants(batches, sent.value, threshold, step), schema), f"variants{step}")
        pairs = pairs.unionByName(cut(certain.unionByName(_meet(met.where(F.col("held") <= CROWD), threshold)), "pairs"))
    pairs = cut(pairs.distinct(), "pairs")
    ends = pairs.select("tab", F.col("a").alias("cid")).unionByName(pairs.select("tab", F.col("b").alias("cid")))
    words = _marked(reps.select("source_table", "tab", "cid", "k1", "words"), ends, "met")
    a = words.select("source_table", "tab", F.col("cid").alias("a"), F.col("k1").alias("ka"), F.col("words").alias("wa"))
    b = words.select("tab", F.col("cid").alias("b"), F.col("k1").alias("kb"), F.col("words").alias("wb"))
    whole = pairs.join(a, ["tab", "a"]).join(b, ["tab", "b"]).where("ka <> kb")
    both = F.size(F.array_intersect("wa", "wb"))
    either = F.size("wa") + F.size("wb") - both
    return whole.where(both >= either * (threshold - 1e-9)).select("source_table", "a", "b")


def version_pairs(rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(source_table, id_a, id_b)`` of ``rows(source_table, id, value)``: all pairs of rows with similar word sets whose values are not
    equal but for formatting. Null values and values without words have no pairs; a repeated id is one row."""
    reps, members = classes(rows)
    pairs = similar(reps, threshold)
    # a class may hold a large share of all rows: its members are parts, and its pairs meet every part
    large = members.groupBy("source_table", "cid").agg(F.ceil(F.count("*") / SPREAD).cast("int").alias("parts")).where("parts > 1")
    parts = F.coalesce("parts", F.lit(1))
    members = members.join(large, ["source_table", "cid"], "left").withColumn("part", F.pmod(F.xxhash64("id"), parts).cast("int"))
    for side in ("a", "b"):
        pairs = pairs.join(large.withColumnRenamed("cid", side), ["source_table", side], "left").withColumn(f"p{side}", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    a = members.select("source_table", F.col("cid").alias("a"), F.col("part").alias("pa"), F.col("id").alias("x"))
    b = members.select("source_table", F.col("cid").alias("b"), F.col("part").alias("pb"), F.col("id").alias("y"))
    out = pairs.join(a, ["source_table", "a", "pa"]).join(b, ["source_table", "b", "pb"])
    return out.select("source_table", F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b")).distinct()


def version_groups(rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(source_table, id, group_id, versions)`` of every row with words: ``group_id`` is the smallest id among all rows that
    are connected by similarity or equal but for formatting, ``versions`` the number of links of the row's class."""
    reps, members = classes(rows)
    links = cut(similar(reps, threshold), "links")
    ends = links.unionByName(links.select("source_table", F.col("b").alias("a"), F.col("a").alias("b")))
    # equal values with other word boundaries belong together too
    by_key = reps.groupBy("source_table", "k1").agg(F.min("cid").alias("b"), F.count("*").alias("n")).where("n > 1")
    twins = reps.join(by_key, ["source_table", "k1"]).where("cid <> b").select("source_table", F.col("cid").alias("a"), "b")
    edges = cut(ends.unionByName(twins).unionByName(twins.select("source_table", F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = cut(edges.groupBy("source_table", "a").agg(F.least(F.col("a"), F.min("b")).alias("label")), "labels")
    while True:  # labels of neighbours, then of labels: components of diameter d need about log d rounds
        near = edges.join(labels.select("source_table", F.col("a").alias("b"), "label"), ["source_table", "b"]).select("source_table", "a", "label")
        low = near.unionByName(labels).groupBy("source_table", "a").agg(F.min("label").alias("label"))
        hop = labels.select("source_table", F.col("a").alias("label"), F.col("label").alias("further"))
        new = low.join(hop, ["source_table", "label"], "left").select("source_table", "a", F.least("label", F.coalesce("further", "label")).alias("label"))
        new = cut(new, "labels")
        changed = new.alias("n").join(labels.alias("o"), ["source_table", "a"]).where("n.label <> o.label").limit(1).count()
        labels = new
        if not changed:
            break
    degree = ends.groupBy("source_table", "a").agg(F.count("*").alias("versions"))
    own = labels.join(degree, ["source_table", "a"], "left").withColumnRenamed("a", "cid")
    out = members.join(own, ["source_table", "cid"], "left")
    return out.select("source_table", "id", F.coalesce("label", "cid").alias("group_id"), F.coalesce("versions", F.lit(0)).alias("versions"))
