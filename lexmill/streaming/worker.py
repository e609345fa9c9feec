"""Continuous import: files of lines or PDFs arrive in a folder, lists and registry are kept up.

The state is parquet in version folders with a pointer file: a batch writes a new version of the registry and the lists,
appends to the log, and then swaps the pointer, which names version and batch. A batch that is run again after a failure
finds its number in the pointer and does nothing, so every file counts once. The new pointer is complete before the
old one goes, and is found by its other name if the swap breaks off in between. Moving files away comes after it.

Documents that failed, or were left pending, are read again from their paths with every batch and at the start, as
long as they have attempts left and their file is still there.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions.charset import fix_names
from lexmill.operators import registry as R
from lexmill.operators.extract import extract_lists, model_lists, numbered
from lexmill.operators.lines import detected_lines
from lexmill.operators.replies import SYSTEM
from lexmill.shared import cut, ship
from lexmill.sources.files import members_of, scanned, unpacked_pdfs
from lexmill.sources.recognition import detections, http_backend

REGISTRY = (
    "id bigint, filename string, title string, file_hash string, file_size bigint, page_count int, status string, error_message string, "
    "source_path string, processed_at timestamp_ntz, created_at timestamp_ntz, updated_at timestamp_ntz"
)
CHILDREN = "document_id bigint, kind string, pos int, key string, value string, page_number int, source_line string"
LOG = "document_id bigint, level string, message string, created_at timestamp_ntz"
TABLES = {"registry": REGISTRY, "children": CHILDREN, "log": LOG}


class State:
    """The tables of an import, in ``folder`` (any file system Hadoop knows)."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def pointer(self) -> dict:
        """The newest complete pointer: ``CURRENT``, or ``NEW`` where a swap broke off."""
        found = {"batch": -1, "version": -1}
        for name in ("CURRENT", "NEW"):
            at = self._path(f"{self.folder}/{name}")
            if not self._fs.exists(at):
                continue
            stream = self._fs.open(at)
            try:
                read = json.loads(stream.readUTF())
            except Exception:  # noqa: BLE001, S112  a pointer that was not written to its end
                continue
            finally:
                stream.close()
            if read["version"] > found["version"]:
                found = read
        return found

    def table(self, name: str) -> DataFrame:
        version = self.pointer()["version"]
        if version < 0:
            return self.spark.createDataFrame([], TABLES[name])
        if name == "log":
            return self.spark.read.schema(f"{LOG}, v int").parquet(f"{self.folder}/log").where(F.col("v") <= version).drop("v")
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.folder}/v={version}/{name}")

    def commit(self, batch: int | None, tables: dict[str, DataFrame]) -> None:
        """Write the tables (of the log what is new) and swap the pointer; no ``batch``: that of before."""
        old = self.pointer()
        version = old["version"] + 1
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{self.folder}/log/v={version}" if name == "log" else f"{self.folder}/v={version}/{name}")
        new, at = self._path(f"{self.folder}/NEW"), self._path(f"{self.folder}/CURRENT")
        stream = self._fs.create(new, True)
        stream.writeUTF(json.dumps({"batch": old["batch"] if batch is None else batch, "version": version}))
        stream.close()
        self._fs.delete(at, False)
        self._fs.rename(new, at)
        gone = self._path(f"{self.folder}/v={version - 2}")
        if self._fs.exists(gone):
            self._fs.delete(gone, True)


NO_TEXT, NO_PAIRS = "Не распознан текст ни на одной странице", "Ничего не извлечено"


def process_batch(state: State, batch: int | None, found: DataFrame, lines: DataFrame, now: Column, minutes: int = 120, mode: str = "compat", outcomes: DataFrame | None = None, backend: Callable[[str], str] | None = None, settings=None) -> int:
    """One batch: stale rows reset, the scan registered, pending documents read, their lists replaced, all logged.

    ``found`` has the registry's columns of files, ``lines`` their lines by ``file_hash``. ``outcomes(file_hash, page_count,
    error)`` has what reading came to; without it pages are counted by their lines. With a ``backend`` a language model
    finds the lists, else the rules do. A document without lines fails, with its error if there is one; one that fails
    does not hold up others. Returns the number of documents completed.
    """
    if batch is not None and state.pointer()["batch"] >= batch:
        return 0
    registry = R.reset_stale(state.table("registry"), now, minutes)
    found = fix_names(found, "title", "title_fixed", mode).drop("title").withColumnRenamed("title_fixed", "title")
    registry = cut(R.upsert(registry, found, now), "registry")
    here = found.select("file_hash").distinct()
    todo = R.pending(registry).select(F.col("id").alias("doc_id"), "file_hash").join(here, "file_hash", "left_semi")
    read = cut(lines.join(todo, "file_hash").drop("file_hash"), "read")
    if backend is None:
        lists, refused = numbered(extract_lists(read)), None
    else:
        from lexmill.config import Settings

        given = settings or Settings()
        lists, refused = model_lists(read, backend, given.llm_pages_per_chunk, given.llm_max_chars_per_chunk)
        lists = numbered(lists)
    lists = cut(lists, "lists")
    counted = read.groupBy("doc_id").agg(F.max("page_number").alias("last_page"))
    pages = todo.join(counted, "doc_id", "left")
    outcomes = outcomes if outcomes is not None else todo.select("file_hash", F.lit(None).cast("int").alias("page_count"), F.lit(None).cast("string").alias("error"))
    pages = pages.join(outcomes.groupBy("file_hash").agg(F.max("page_count").alias("page_count"), F.max("error").alias("error")), "file_hash", "left")
    if refused is not None:
        pages = pages.join(refused, "doc_id", "left").withColumn("error", F.coalesce("message", "error")).drop("message")
    bad = F.col("last_page").isNull() | (F.lit(False) if refused is None else F.col("error").isNotNull())
    pages = cut(pages.withColumn("bad", bad), "pages")
    failed = pages.where("bad").select(F.col("doc_id").alias("id"), F.coalesce("error", F.lit(NO_TEXT)).alias("message"))
    done = pages.where("not bad").select(F.col("doc_id").alias("id"), F.coalesce("page_count", "last_page").alias("page_count"))
    registry = R.mark_failed(R.mark_completed(registry, done, now), failed, now)
    new = lists.select(F.col("doc_id").alias("document_id"), "kind", "pos", "key", "value", "page_number", "source_line")
    new = new.join(done.select(F.col("id").alias("document_id")), "document_id", "left_semi")
    children = R.replace_children(state.table("children"), new, done.select(F.col("id").alias("document_id")))
    counts = new.groupBy("document_id").agg(F.count("*").alias("n"))
    said = done.select(F.col("id").alias("document_id")).join(counts, "document_id", "left")
    some = said.where("n is not null").select("document_id", F.concat(F.lit("Извлечено пар: "), "n").alias("message"))
    none = said.where("n is null").select("document_id", F.lit(NO_PAIRS).alias("message"))
    log = R.log_rows(some, now).unionByName(R.log_rows(none, now, "warning")).unionByName(R.log_rows(failed.select(F.col("id").alias("document_id"), "message"), now, "error"))
    state.commit(batch, {"registry": registry, "children": children, "log": log})
    return done.count()


def waiting(state: State, max_attempts: int | None, most: int) -> list[str]:
    """Paths of documents to be read again, the oldest ``most`` of them (the others come with a later batch)."""
    rows = R.pending(state.table("registry")).where("source_path is not null")
    if max_attempts is not None:
        tried = state.table("log").where("level = 'error'").groupBy("document_id").agg(F.count("*").alias("tried"))
        rows = rows.join(tried.where(F.col("tried") >= max_attempts), rows["id"] == tried["document_id"], "left_anti")
    return [r["source_path"] for r in rows.orderBy("created_at", "id").select("source_path").limit(most).collect()]


def run_pages(spark: SparkSession, source: str, state_dir: str, checkpoint: str, now: Column | None = None, schema: str = "doc_id bigint, page_number int, full_text string"):
    """A streaming query over parquet files of recognised pages: available files are processed, each once.
    ``source`` is a folder or a pattern of files."""
    state = State(spark, state_dir)
    now = F.current_timestamp().cast("timestamp_ntz") if now is None else now

    def batch(pages: DataFrame, number: int) -> None:
        pages = pages.where("doc_id is not null and full_text is not null").dropDuplicates(["doc_id", "page_number", "full_text"])
        hashed = pages.withColumn("file_hash", F.sha2(F.col("doc_id").cast("string"), 256))
        lines = hashed.select("file_hash", "page_number", F.posexplode(F.split("full_text", "\n")).alias("line_ord", "text"))
        lines = lines.withColumn("x_min", F.lit(0.0)).withColumn("y_center", F.col("line_ord") * 20.0)
        name = F.concat(F.lit("doc_"), F.col("doc_id"))
        files = hashed.groupBy("doc_id", "file_hash").agg(F.sum(F.length("full_text")).alias("file_size"))
        found = files.select(F.concat(name, F.lit(".pdf")).alias("filename"), name.alias("title"), "file_hash", "file_size", F.concat(F.lit("/data/input/"), name).alias("source_path"))
        process_batch(state, number, found, lines, now)

    ship(spark)
    stream = spark.readStream.schema(schema).parquet(source)
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


#: Documents that are read again with one batch.
AGAIN = 1000


def run_files(spark: SparkSession, folder: str, state_dir: str, checkpoint: str, rasteriser, detector, settings=None, now: Column | None = None, poll: bool = False, backend: Callable[[str], str] | None = None):
    """A streaming query over a folder of PDFs and archives of PDFs, with factories for a rasteriser and a detector.

    Files are read, hashed, registered, recognised and extracted, each once; with ``poll`` the folder is looked at
    again and again, else what is there is done and the query ends. With an archive folder in the settings, files of
    completed documents are moved there after the commit. With ``extractor = "llm"`` lists come from ``backend``, or from the
    model server of the settings. Documents that failed or are pending are tried again, first of all at the start.
    """
    from lexmill.config import Settings

    settings = settings or Settings()
    if settings.extractor == "llm" and backend is None:
        backend = http_backend(settings.llm_base_url, settings.llm_model, SYSTEM, settings.llm_request_timeout)
    backend = backend if settings.extractor == "llm" else None
    state = State(spark, state_dir)
    now = F.current_timestamp().cast("timestamp_ntz") if now is None else now
    ship(spark)

    def again() -> DataFrame | None:
        """The loose files that are to be read again and are still there; members of archives come with their archive."""
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        there = [p for p in waiting(state, settings.max_attempts, AGAIN) if (q := jvm.org.apache.hadoop.fs.Path(p)).getFileSystem(conf).exists(q)]
        return spark.read.format("binaryFile").load(there).select("path", "length", "content") if there else None

    def batch(arrived: DataFrame | None, number: int | None) -> None:
        files = again()
        if arrived is not None:
            loose = arrived.where(F.col("path").endswith(".pdf")).select("path", "length", "content")
            packed = unpacked_pdfs(members_of(arrived.where(F.col("path").endswith(".zip")), settings.zip_filename_encoding, settings.name_repair))
            new = loose.unionByName(packed)
            files = new if files is None else new.unionByName(files.join(new.select("path"), "path", "left_anti"))
        if files is None:
            return
        found = cut(scanned(files), "scanned")
        # which path stands for a content is decided on hashes; the bytes are read for those paths only
        one = found.groupBy("file_hash").agg(F.max("source_path").alias("path"))
        content = files.join(one, "path").select(F.col("file_hash").alias("doc_id"), "content")
        seen = cut(detections(content, rasteriser, detector, settings.dpi, settings.max_pages_per_doc, "string"), "detections")
        lines = detected_lines(seen.where("det_ord is not null")).withColumnRenamed("doc_id", "file_hash")
        outcomes = seen.groupBy(F.col("doc_id").alias("file_hash")).agg(F.max("page_count").alias("page_count"), F.max("error").alias("error"))
        process_batch(state, number, found, lines.select("file_hash", "page_number", "line_ord", "text", "x_min", "y_center"), now, settings.stale_processing_minutes, settings.name_repair, outcomes, backend, settings)
        if settings.archive_processed:
            _archive(spark, state, found, settings.archive_dir)

    batch(None, None)
    stream = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary")
    stream = stream.option("pathGlobFilter", "*.{pdf,zip}").option("recursiveFileLookup", "true").load(folder)
    write = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (write.trigger(processingTime=f"{settings.poll_interval_seconds} seconds") if poll else write.trigger(availableNow=True)).start()


def _archive(spark: SparkSession, state: State, found: DataFrame, folder: str) -> None:
    """Move the files of a batch whose documents are completed; a name that is taken gets part of the hash."""
    jvm = spark.sparkContext._jvm
    path_of, conf = jvm.org.apache.hadoop.fs.Path, spark.sparkContext._jsc.hadoopConfiguration()
    done = state.table("registry").where("status = 'completed'").select("file_hash")
    for r in found.join(done, "file_hash", "left_semi").select("source_path", "filename", "file_hash").toLocalIterator():
        source = path_of(r["source_path"])
        fs = source.getFileSystem(conf)
        if not fs.exists(source):  # a member of an archive, or moved before
            continue
        fs.mkdirs(path_of(folder))
        target = path_of(f"{folder}/{r['filename']}")
        if fs.exists(target):
            stem, dot, suffix = r["filename"].rpartition(".")
            target = path_of(f"{folder}/{stem or suffix}_{r['file_hash'][:8]}{dot}{suffix if stem else ''}")
        fs.rename(source, target)
