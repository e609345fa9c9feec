"""Registry, files and the streaming import."""

import datetime
import io
import zipfile

from pyspark.sql import functions as F
from tests.conftest import rows

from lexmill.operators import registry as R
from lexmill.sources import files, recognition
from lexmill.config import Settings
from lexmill.streaming.worker import REGISTRY, State, run_files, run_pages

T = datetime.datetime(2024, 1, 1)
NOW = datetime.datetime(2024, 6, 1)


def now():
    return F.lit(NOW).cast("timestamp_ntz")


def reg(spark, *some):
    base = {"filename": "f.pdf", "title": "f", "file_size": 1, "page_count": None, "error_message": None, "source_path": "/p", "processed_at": None, "created_at": T, "updated_at": T}
    cols = [c.split()[0] for c in REGISTRY.split(", ")]
    return spark.createDataFrame([tuple((base | s).get(c) for c in cols) for s in some], REGISTRY)


def test_upsert(spark):
    r = reg(spark, {"id": 7, "file_hash": "h1", "status": "completed"}, {"id": 9, "file_hash": "h2", "status": "failed"})
    scan = spark.createDataFrame([("b.pdf", "b", "h1", 5, "/b"), ("a.pdf", "a", "h1", 5, "/a"), ("n.pdf", "n", "h3", 6, "/z"), ("m.pdf", "m", "h4", 6, "/c")], "filename string, title string, file_hash string, file_size bigint, source_path string")
    out = R.upsert(r, scan, now())
    got = rows(out, "id", "file_hash", "filename", "status")
    assert got == sorted([(7, "h1", "b.pdf", "completed"), (9, "h2", "f.pdf", "failed"), (10, "h4", "m.pdf", "pending"), (11, "h3", "n.pdf", "pending")], key=str)
    assert rows(R.upsert(out, scan, now()), "id", "file_hash") == rows(out, "id", "file_hash")
    assert R.upsert(r.where("false"), scan, now()).agg(F.min("id")).first()[0] == 1


def test_status_machine(spark):
    r = reg(spark, {"id": 1, "file_hash": "a", "status": "processing", "updated_at": NOW - datetime.timedelta(minutes=121)}, {"id": 2, "file_hash": "b", "status": "processing", "updated_at": NOW}, {"id": 3, "file_hash": "c", "status": "failed", "created_at": NOW}, {"id": 4, "file_hash": "d", "status": "skipped"})
    assert rows(R.reset_stale(r, now()), "id", "status") == [(1, "pending"), (2, "processing"), (3, "failed"), (4, "skipped")]
    assert [x.id for x in R.pending(R.reset_stale(r, now())).collect()] == [1, 3]
    failed = R.mark_failed(r, spark.createDataFrame([(2, "x" * 5000), (2, "a")], "id bigint, message string"), now())
    assert failed.where("id = 2").select(F.length("error_message"), "status").first() == (4000, "failed")
    done = R.mark_completed(failed, spark.createDataFrame([(2, 12)], "id bigint, page_count int"), now())
    assert done.where("id = 2").select("status", "page_count", "error_message", "processed_at").first() == ("completed", 12, None, NOW)
    assert rows(R.mark_processing(r, r.where("id = 3"), now()).where("status = 'processing'"), "id") == [(1,), (2,), (3,)]
    assert R.by_value(r, "title", "f").first().id == 1


def test_children(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "document_id bigint, term string")
    new = spark.createDataFrame([(2, "d")], "document_id bigint, term string")
    assert rows(R.replace_children(old, new, spark.createDataFrame([(2,), (3,)], "document_id bigint"))) == [(1, "a"), (2, "d")]
    log = spark.createDataFrame([(2, "m"), (None, "n")], "document_id bigint, message string")
    kept, orphaned = R.delete_documents(spark.createDataFrame([(2,)], "id bigint"), old, log)
    assert rows(kept) == [(1, "a")] and rows(orphaned) == [(None, "m"), (None, "n")]


def test_report_and_archive_names(spark):
    r = reg(spark, {"id": 5, "file_hash": "h5", "status": "completed"}, {"id": 3, "file_hash": "h3", "status": "completed"})
    kids = spark.createDataFrame([(3, "terms", 2, "b", "y" * 130), (3, "terms", 1, "a", "x"), (5, "terms", 9, "c", "z")], "document_id bigint, kind string, id bigint, key string, value string")
    lists = R.lists_by_title(r, kids, "f")
    assert rows(lists, "document_id", "pos", "key") == [(3, 1, "a"), (3, 2, "b")]
    assert rows(R.report_lines(lists), "line") == [("a — x",), ("b — " + "y" * 120 + "...",)]
    f = spark.createDataFrame([("a.pdf", "0123456789"), ("b.pdf", "abcdefghij")], "filename string, file_hash string")
    assert rows(R.archive_names(f, f.where("filename = 'a.pdf'")), "archived_as") == [("a_01234567.pdf",), ("b.pdf",)]


def test_files_and_archives(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "Отчёт.pdf").write_bytes(b"one")
    (tmp_path / "skip.PDF").write_bytes(b"two")
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        for name, data in (("in/a.pdf", b"first"), ("../evil.pdf", b"x"), ("b.txt", b"t"), ("in/a.pdf", b"second")):
            z.writestr(name, data)
        info = zipfile.ZipInfo("Документ.pdf".encode("cp866").decode("cp437"))
        z.writestr(info, b"three")
    (tmp_path / "bad.zip").write_bytes(b"no archive")
    members = files.zip_members(spark, str(tmp_path))
    assert members.where("error is not null").count() == 1 and rows(members.where("not safe"), "member_name") == [("../evil.pdf",)]
    found = files.discover(spark, str(tmp_path))
    names = rows(files.scanned(found), "filename", "title", "file_size")
    assert names == sorted([("a.pdf", "a", 6), ("Документ.pdf", "Документ", 5), ("Отчёт.pdf", "Отчёт", 3)], key=str)
    known = members.select("zip_path").distinct()
    assert files.unpacked_pdfs(members, known).count() == 0


def test_recognition_backends(spark):
    class Raster:
        def pages(self, content, dpi, max_pages):
            if content == b"bad":
                raise ValueError("broken file")
            n = len(content)
            return n, (recognition.PageImage(k + 1, 1, 1, b"") for k in range(min(n, max_pages or n)))

    class Detect:
        def detect(self, page):
            return [([[0.0, 0.0], [1.0, 1.0]], f"line {page.page_number}", 1.0)] if page.page_number < 3 else []

    df = spark.createDataFrame([(1, bytearray(b"aaaa")), (2, bytearray(b"bad")), (3, bytearray(b""))], "doc_id bigint, content binary")
    out = recognition.detections(df, Raster, Detect, max_pages=3)
    assert rows(out, "doc_id", "page_count", "page_number", "text", "error") == sorted([(1, 4, 1, "line 1", None), (1, 4, 2, "line 2", None), (1, 4, 3, None, None), (2, None, None, None, "broken file"), (3, 0, None, None, None)], key=str)


def test_stream_counts_every_file_once(spark, tmp_path):
    source, state = str(tmp_path / "in"), str(tmp_path / "state")
    page = "Перечень сокращений\nАСУ — система управления\nНД — надзор"
    schema = "doc_id bigint, page_number int, full_text string"
    spark.createDataFrame([(1, 1, page), (1, 1, page), (2, 1, " "), (None, 1, page), (3, 1, None)], schema).coalesce(1).write.parquet(source)
    for _ in range(2):  # the second run has nothing to do
        run_pages(spark, source, state, str(tmp_path / "ck"), now()).awaitTermination()
    s = State(spark, state)
    assert rows(s.table("registry"), "title", "status") == [("doc_1", "completed"), ("doc_2", "completed")]
    assert rows(s.table("children"), "document_id", "key").__len__() == 2 and s.table("log").count() == 2
    spark.createDataFrame([(1, 1, page + "\nЯ — ядро"), (4, 1, page)], schema).coalesce(1).write.mode("append").parquet(source)
    run_pages(spark, source, state, str(tmp_path / "ck"), now()).awaitTermination()
    assert s.table("registry").count() == 3 and s.pointer()["batch"] == 1


class Lines:
    """A rasteriser and detector for files that hold their lines as text."""

    def pages(self, content, dpi, max_pages):
        text = content.decode()
        if text.startswith("bad"):
            raise ValueError("broken file")
        pages = text.split("\f")
        return len(pages), [recognition.PageImage(k + 1, 0, 0, p.encode()) for k, p in enumerate(pages)]

    def detect(self, page):
        return [([[40.0, 20.0 * k], [90.0, 20.0 * k + 8]], t, 1.0) for k, t in enumerate(page.rgb.decode().split("\n"))]


def test_stream_of_files(spark, tmp_path, monkeypatch, capsys):
    from lexmill.__main__ import main

    source, state, kept = tmp_path / "in", str(tmp_path / "state"), tmp_path / "kept"
    (source / "sub").mkdir(parents=True)
    page = "Перечень сокращений\nАСУ — система управления\fНД — надзор"
    (source / "Отчёт.pdf").write_bytes(page.encode())
    (source / "sub" / "b.pdf").write_bytes(b"bad one")
    with zipfile.ZipFile(source / "z.zip", "w") as z:
        z.writestr("c.pdf", page + "\nЯ — ядро")
    settings = Settings(archive_processed=True, archive_dir=str(kept))
    for _ in range(2):
        run_files(spark, str(source), state, str(tmp_path / "ck"), Lines, Lines, settings, now()).awaitTermination()
    s = State(spark, state)
    assert rows(s.table("registry"), "title", "status", "page_count") == sorted([("b", "failed", None), ("c", "completed", 2), ("Отчёт", "completed", 2)], key=str)
    assert s.table("children").groupBy("document_id").count().select("count").distinct().count() == 2
    assert (kept / "Отчёт.pdf").exists() and not (source / "Отчёт.pdf").exists() and (source / "sub" / "b.pdf").exists()
    monkeypatch.setenv("STATE_DIR", state)
    assert main(["query", "Отчёт"]) == 0 and "АСУ — система управления" in capsys.readouterr().out
    assert main(["query", "нет"]) == 1


def test_failed_files_come_back(spark, tmp_path):
    """A failure keeps its message and is tried again at the next start, as often as the settings allow; pages without text count."""
    source, state = tmp_path / "in", str(tmp_path / "state")
    source.mkdir()
    page = "Перечень сокращений\nАСУ — система управления\fНД — надзор\f\f"
    (source / "a.pdf").write_bytes(page.encode())
    (source / "b.pdf").write_bytes(b"bad one")
    go = lambda **k: run_files(spark, str(source), state, str(tmp_path / "ck"), Lines, Lines, Settings(**k), now()).awaitTermination()
    go()
    s = State(spark, state)
    assert rows(s.table("registry"), "title", "status", "page_count", "error_message") == sorted([("a", "completed", 4, None), ("b", "failed", None, "broken file")], key=str)
    go(max_attempts=1)
    assert s.table("log").where("level = 'error'").count() == 1
    go(max_attempts=2)
    assert s.table("log").where("level = 'error'").count() == 2
    (source / "b.pdf").write_bytes(page.replace("надзор", "норма").encode())
    go()
    assert "completed" in {r.status for r in s.table("registry").where("title = 'b'").collect()}


def test_a_swap_that_breaks_off_loses_nothing(spark, tmp_path):
    s = State(spark, str(tmp_path / "state"))
    for batch in range(2):
        s.commit(batch, {"registry": reg(spark, {"id": batch, "file_hash": "h", "status": "pending"}), "children": s.table("children"), "log": s.table("log")})
    (tmp_path / "state" / "CURRENT").rename(tmp_path / "state" / "NEW")
    assert s.pointer() == {"batch": 1, "version": 1} and s.table("registry").first().id == 1
    s.commit(2, {"registry": s.table("registry"), "children": s.table("children"), "log": s.table("log")})
    (tmp_path / "state" / "NEW").write_bytes(b"")
    assert s.pointer()["batch"] == 2


def test_lists_by_a_model(spark, tmp_path):
    source, state = tmp_path / "in", str(tmp_path / "state")
    source.mkdir()
    (source / "a.pdf").write_bytes("один".encode())
    (source / "b.pdf").write_bytes("два".encode())

    def backend(prompt):
        return '{"terms": [{"term": "узел", "definition": "часть сети"}]}' if "один" in prompt else "не знаю"

    run_files(spark, str(source), state, str(tmp_path / "ck"), Lines, Lines, Settings(extractor="llm"), now(), backend=backend).awaitTermination()
    s = State(spark, state)
    assert rows(s.table("registry"), "title", "status") == [("a", "completed"), ("b", "failed")]
    assert rows(s.table("children"), "key", "value", "source_line") == [("узел", "часть сети", "[LLM стр.1-1]")]
