"""The registry of documents: upsert by content, the status machine, and the lists by title.

All of it is projections and joins over tables; ``now`` is a parameter, so a replay gives the same registry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexmill.shared import cut, partitions

STATUSES = ("pending", "processing", "completed", "failed", "skipped")
MESSAGE_CHARS = 4000
STALE_MESSAGE = "Сброшено: зависшая обработка"


def file_hash(content: Column) -> Column:
    return F.sha2(content, 256)


def latest_by_hash(scanned: DataFrame) -> DataFrame:
    """Of files with the same content the one whose path comes last."""
    return scanned.groupBy("file_hash").agg(F.max_by(F.struct("filename", "title", "file_size", "source_path"), "source_path").alias("f")).select("file_hash", "f.*")


def upsert(registry: DataFrame, scanned: DataFrame, now: Column) -> DataFrame:
    """The registry after a scan: known content has its name, title, size and path renewed and keeps its status; new content
    is pending, under ids that go on from the highest in the order of paths."""
    new = latest_by_hash(scanned).select("file_hash", *(F.col(c).alias(f"_{c}") for c in ("filename", "title", "file_size", "source_path")))
    both = registry.join(new, "file_hash", "full_outer")
    fresh = F.col("id").isNull()
    renewed = F.col("_source_path").isNotNull()
    out = both.select(
        "id", *(F.when(renewed, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in ("filename", "title")), "file_hash",
        F.when(renewed, F.col("_file_size")).otherwise(F.col("file_size")).alias("file_size"), "page_count",
        F.when(fresh, "pending").otherwise(F.col("status")).alias("status"), "error_message",
        F.when(renewed, F.col("_source_path")).otherwise(F.col("source_path")).alias("source_path"), "processed_at",
        F.when(fresh, now).otherwise(F.col("created_at")).alias("created_at"), F.when(renewed, now).otherwise(F.col("updated_at")).alias("updated_at"),
    )
    known = out.where("id is not null")
    top = registry.agg(F.max("id")).first()[0] or 0
    return known.unionByName(numbered_from(out.where("id is null").drop("id"), "source_path", top).select(known.columns))


def numbered_from(rows: DataFrame, order: str, top: int) -> DataFrame:
    """``rows`` with ``id`` = ``top`` + place in ``order``, without gathering them in one task: rows are put in ranges of
    ``order``, the sizes of the ranges (as many as partitions) are summed up, and rows are numbered within each."""
    ranged = cut(rows.repartitionByRange(partitions(rows), order).withColumn("_part", F.spark_partition_id()), "ranges")
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    offsets = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    within = F.row_number().over(W.partitionBy("_part").orderBy(order, "file_hash"))
    return ranged.join(F.broadcast(offsets), "_part").withColumn("id", F.lit(top) + F.col("_before") + within).drop("_part", "_before")


def by_value(registry: DataFrame, column: str, value: str) -> DataFrame:
    """The row with a hash, title or file name; of several the one with the lowest id."""
    return registry.where(F.col(column) == value).orderBy("id").limit(1)


def should_process(status: Column) -> Column:
    return status.isin("pending", "failed", "processing")


def _marked(registry: DataFrame, chosen: DataFrame, **new: Column) -> DataFrame:
    """``registry`` with columns changed in the rows whose id is in ``chosen(id, ...)``."""
    keys = chosen.withColumn("_hit", F.lit(True))
    extra = [c for c in chosen.columns if c != "id"]
    out = registry.join(keys.select("id", "_hit", *(F.col(c).alias(f"_{c}") for c in extra)), "id", "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    return out.select(*(F.when(hit, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in registry.columns))


def mark_processing(registry: DataFrame, ids: DataFrame, now: Column) -> DataFrame:
    return _marked(registry, ids.select("id").distinct(), status=F.lit("processing"), error_message=F.lit(None).cast("string"), updated_at=now)


def mark_failed(registry: DataFrame, failures: DataFrame, now: Column, status: str = "failed") -> DataFrame:
    """``failures(id, message)``: status and the message, cut at 4,000 characters. Also for ``skipped``."""
    one = failures.groupBy("id").agg(F.max("message").alias("message"))
    return _marked(registry, one, status=F.lit(status), error_message=F.substring("_message", 1, MESSAGE_CHARS), updated_at=now)


def mark_completed(registry: DataFrame, done: DataFrame, now: Column) -> DataFrame:
    """``done(id, page_count)``: completed, with the time, without an error."""
    return _marked(registry, done.dropDuplicates(["id"]), status=F.lit("completed"), page_count=F.col("_page_count"), processed_at=now, error_message=F.lit(None).cast("string"), updated_at=now)


def _stale(now: Column, minutes: int) -> Column:
    return (F.col("status") == "processing") & (F.col("updated_at") < now - F.make_dt_interval(mins=F.lit(minutes)))


def reset_stale(registry: DataFrame, now: Column, minutes: int = 120) -> DataFrame:
    """Rows in processing for longer than ``minutes`` are pending again, with a message."""
    stale = _stale(now, minutes)
    new = {"status": F.lit("pending"), "error_message": F.lit(STALE_MESSAGE), "updated_at": now}
    return registry.select(*(F.when(stale, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in registry.columns))


def pending(registry: DataFrame) -> DataFrame:
    """Rows to be processed, in the order of their creation."""
    return registry.where(F.col("status").isin("pending", "failed")).orderBy("created_at", "id")


def replace_children(existing: DataFrame, new: DataFrame, done: DataFrame) -> DataFrame:
    """Child rows after the documents in ``done(document_id)`` were read again: theirs are replaced, all others stay."""
    return existing.join(done.select("document_id").distinct(), "document_id", "left_anti").select(new.columns).unionByName(new)


def delete_documents(gone: DataFrame, children: DataFrame, log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Children and log after documents ``gone(id)`` were deleted: their children go, their log rows lose the reference."""
    ids = gone.select(F.col("id").alias("document_id")).distinct()
    kept = children.join(ids, "document_id", "left_anti").select(children.columns)
    orphaned = log.join(ids.withColumn("_gone", F.lit(True)), "document_id", "left")
    return kept, orphaned.select(*(F.when(F.col("_gone").isNull(), F.col(c)).alias(c) if c == "document_id" else F.col(c) for c in log.columns))


def lists_by_title(registry: DataFrame, children: DataFrame, title: str | None = None) -> DataFrame:
    """``(title, document_id, kind, pos, key, value)``: the lists of the document with each title (the lowest id of several), or of
    one title. ``children`` has ``document_id, kind, id, key, value``; lists are in the order of ids."""
    docs = registry if title is None else registry.where(F.col("title") == title)
    docs = docs.where("title is not null").groupBy("title").agg(F.min("id").alias("document_id"))
    order = W.partitionBy("document_id", "kind").orderBy("id")
    return children.join(docs, "document_id").select("title", "document_id", "kind", F.row_number().over(order).alias("pos"), "key", "value")


def report_lines(lists: DataFrame) -> DataFrame:
    """The lists as lines of a report; values longer than 120 characters are cut there and end in three dots."""
    value = F.when((F.col("kind") == "terms") & (F.length("value") > 120), F.concat(F.substring("value", 1, 120), F.lit("..."))).otherwise(F.col("value"))
    return lists.select("title", "kind", "pos", F.concat_ws(" — ", "key", value).alias("line"))


def archive_names(files: DataFrame, taken: DataFrame) -> DataFrame:
    """``files(filename, file_hash, ...)`` with ``archived_as``: the name, or, if it is in ``taken(filename)``, with part of the hash."""
    stem, suffix = F.regexp_extract("filename", r"^(.+?)(\.[^.]*)?$", 1), F.regexp_extract("filename", r"^(.+?)(\.[^.]*)?$", 2)
    clash = taken.select(F.col("filename")).distinct().withColumn("_clash", F.lit(True))
    name = F.when(F.col("_clash"), F.concat(stem, F.lit("_"), F.substring("file_hash", 1, 8), suffix)).otherwise(F.col("filename"))
    return files.join(clash, "filename", "left").withColumn("archived_as", name).drop("_clash")


def log_rows(entries: DataFrame, now: Column, level: str = "info") -> DataFrame:
    """Rows for the append-only log from ``entries(document_id, message)``."""
    return entries.select("document_id", F.lit(level).alias("level"), "message", now.alias("created_at"))
