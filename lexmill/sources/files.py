"""Files and archives as tables."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions.charset import archive_name, score
from lexmill.functions.text import file_stem
from lexmill.operators.registry import file_hash

#: Files go to Python a few at a time, for they are large.
FILES_PER_BATCH = 4


def pdf_files(spark: SparkSession, folder: str) -> DataFrame:
    """``path, modificationTime, length, content`` of all ``*.pdf`` below ``folder`` (lower-case suffix; names that begin
    with ``_`` or ``.`` are hidden by Spark). Content is read only where it is used."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").option("recursiveFileLookup", "true").load(folder)


def safe_member(name: Column) -> Column:
    """Whether a member of an archive stays below the folder it is unpacked to."""
    return ~F.replace(name, F.lit("\\"), F.lit("/")).rlike(r"^/|(?:^|/)\.\.(?:/|$)")


def zip_members(spark: SparkSession, folder: str, page: str = "cp866", mode: str = "compat") -> DataFrame:
    """The members of the archives in ``folder``, as ``members_of`` gives them."""
    return members_of(spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(folder), page, mode)


def members_of(files: DataFrame, page: str = "cp866", mode: str = "compat") -> DataFrame:
    """``zip_path, member_ord, member_name, raw_name, is_dir, safe, error, content`` of archives ``files(path, content)``.

    Raw names are read as cp437 and decoded anew; the UTF-8 flag is trusted only for names with Cyrillic letters.
    A broken archive is one row with ``error``; unsafe members have no content.
    """
    files = files.select("path", "content")

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["zip_path", "member_ord", "member_name", "raw_name", "is_dir", "error", "content"]
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                try:
                    with zipfile.ZipFile(io.BytesIO(content), metadata_encoding="cp437") as archive:
                        for k, info in enumerate(archive.infolist()):
                            trusted = info.flag_bits & 0x800 and score(info.filename)
                            name = info.filename if trusted else archive_name(info.filename, page, mode)
                            inside = not name.replace("\\", "/").startswith("/") and ".." not in name.replace("\\", "/").split("/")
                            data = None if info.is_dir() or not inside else archive.read(info)
                            yield pd.DataFrame([(path, k, name, info.filename, info.is_dir(), None, data)], columns=columns)
                except (zipfile.BadZipFile, RuntimeError, NotImplementedError, ValueError, OSError) as e:
                    yield pd.DataFrame([(path, -1, None, None, False, str(e)[:500], None)], columns=columns)

    schema = "zip_path string, member_ord int, member_name string, raw_name string, is_dir boolean, error string, content binary"
    out = files.mapInPandas(members, schema)
    return out.select("zip_path", "member_ord", "member_name", "raw_name", "is_dir", safe_member(F.col("member_name")).alias("safe"), "error", "content")


def unpacked_pdfs(members: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``path, length, content`` of the PDFs among archive members; of several with one name the last. Archives in
    ``known(zip_path)`` are left out; unsafe members and directories are too."""
    if known is not None:
        members = members.join(known.select("zip_path").distinct(), "zip_path", "left_anti")
    good = members.where("error is null and safe and not is_dir").where(F.col("member_name").endswith(".pdf"))
    folder = F.regexp_replace("zip_path", r"\.zip$", "")
    last = good.groupBy("zip_path", "member_name").agg(F.max_by("content", "member_ord").alias("content"))
    return last.select(F.concat_ws("/", folder, F.replace("member_name", F.lit("\\"), F.lit("/"))).alias("path"), F.length("content").cast("bigint").alias("length"), "content")


def scanned(files: DataFrame) -> DataFrame:
    """``filename, title, file_hash, file_size, source_path`` of ``files(path, length, content)``, for the registry; titles are
    the stems of names, still to be repaired."""
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    return files.select(name.alias("filename"), file_stem(F.col("path")).alias("title"), file_hash(F.col("content")).alias("file_hash"), F.col("length").alias("file_size"), F.col("path").alias("source_path"))


def discover(spark: SparkSession, folder: str, page: str = "cp866", mode: str = "compat", known: DataFrame | None = None) -> DataFrame:
    """All PDFs below ``folder`` and in the archives in it, as ``path, length, content``."""
    loose = pdf_files(spark, folder).select("path", "length", "content")
    return loose.unionByName(unpacked_pdfs(zip_members(spark, folder, page, mode), known)).dropDuplicates(["path"])
