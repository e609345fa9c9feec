"""Copies that differ only in formatting: fingerprint grouping with field verification.

Each normalised field value is hashed and the hashes of a row are combined by a commutative sum, so that
rows agree whatever the order of their fields. Rows are grouped by the 124-bit fingerprint with hash
aggregation; nothing is sorted to find a group. A group is counted in salted parts first, and its members
meet their representative by (fingerprint, salt), so a group that holds a third of all rows is spread over
``SALTS`` tasks. Every member is then compared with its representative field by field; members that
differ (a hash collision) are regrouped by their fields themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.shared import cut

#: Parts a fingerprint group may be spread over.
SALTS = 32


def letters_and_digits(value: Column) -> Column:
    """The letters and digits (Unicode categories L and N) of a value in lower case; null stays null."""
    return F.lower(F.regexp_replace(value, r"[^\p{L}\p{N}]+", ""))


def _hash(value: Column, seed: int) -> Column:
    # 62 bits each, so that a sum of two cannot overflow
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), value, value.isNull()), 2)


def _keyed(rows: DataFrame, id_col: str, left: str, right: str) -> DataFrame:
    rows = rows.select(
        F.col(id_col).cast("bigint").alias("id"), letters_and_digits(F.col(left)).alias("a"), letters_and_digits(F.col(right)).alias("b")
    )
    a, b = F.col("a"), F.col("b")
    return rows.select(
        "id", "a", "b",
        (_hash(a, 11) + _hash(b, 11)).alias("h1"),
        (_hash(a, 12) + _hash(b, 12)).alias("h2"),
        F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int").alias("salt"),
    )


def _parts(keyed: DataFrame) -> DataFrame:
    return keyed.groupBy("h1", "h2", "salt").agg(F.min("id").alias("part_first"), F.count("*").alias("part_n"))


def formatting_copies(rows: DataFrame, id_col: str, left: str, right: str) -> DataFrame:
    """``(first_id, row_id)`` for every row that repeats an earlier one except for formatting.

    Two rows are equal if their two fields agree in letters and digits with case ignored, in the same or in
    swapped places. Null equals only null; values without any letter or digit equal each other. A null id
    is left out, rows repeated under one id count once. An empty table gives no rows. Columns of ``rows``
    other than the three named do not matter, whatever their names.
    """
    keyed = _keyed(rows, id_col, left, right).where("id is not null")
    parts = _parts(keyed)
    groups = parts.groupBy("h1", "h2").agg(F.min("part_first").alias("first_id"), F.sum("part_n").alias("n")).where("n > 1")
    first = keyed.select(F.col("id").alias("first_id"), F.col("a").alias("fa"), F.col("b").alias("fb")).dropDuplicates(["first_id"])
    spread = parts.select("h1", "h2", "salt").join(groups.select("h1", "h2", "first_id").join(first, "first_id"), ["h1", "h2"])
    met = keyed.join(spread, ["h1", "h2", "salt"]).where("id <> first_id")
    same = (F.col("a").eqNullSafe(F.col("fa")) & F.col("b").eqNullSafe(F.col("fb"))) | (
        F.col("a").eqNullSafe(F.col("fb")) & F.col("b").eqNullSafe(F.col("fa"))
    )
    met = cut(met.select("id", "first_id", same.alias("same"), F.when(~same, F.col("a")).alias("a"), F.when(~same, F.col("b")).alias("b")), "copies")
    unequal = met.where("not same").withColumn("turn", F.coalesce(F.col("a"), F.lit("")) > F.coalesce(F.col("b"), F.lit("")))
    unequal = unequal.select("id", F.when(F.col("turn"), F.col("b")).otherwise(F.col("a")).alias("u"), F.when(F.col("turn"), F.col("a")).otherwise(F.col("b")).alias("v"))
    again = unequal.groupBy("u", "v").agg(F.min("id").alias("first_id"))
    regrouped = unequal.join(again, unequal.u.eqNullSafe(again.u) & unequal.v.eqNullSafe(again.v)).where("id <> first_id")
    return met.where("same").select("first_id", F.col("id").alias("row_id")).unionByName(regrouped.select("first_id", F.col("id").alias("row_id"))).distinct()


def collapsed(rows: DataFrame, id_col: str, left: str, right: str) -> DataFrame:
    """``(first_id, copies)``: one row for each set of equal rows, with the number of its rows (ids)."""
    copies = formatting_copies(rows, id_col, left, right)
    counted = copies.groupBy("first_id").agg(F.count("*").alias("n"))
    ids = rows.select(F.col(id_col).cast("bigint").alias("first_id")).where("first_id is not null").distinct()
    kept = ids.join(copies.select(F.col("row_id").alias("first_id")), "first_id", "left_anti")
    return kept.join(counted, "first_id", "left").select("first_id", (F.coalesce(F.col("n"), F.lit(0)) + 1).alias("copies"))
