"""Lines, sections, pairs, tables, chunks and replies against list models and hand-made cases."""

import random
import re

import pytest
from pyspark.sql import functions as F
from tests.conftest import rows

from lexmill.functions.language import ABBREVIATIONS, RUSSIAN, TERMS
from lexmill.operators import chunks, extract, lines, pairs, replies, sections

LINES = "doc_id bigint, page_number int, line_ord int, text string, x_min double, y_center double"


def as_lines(spark, docs):
    """Documents as lists of pages, a page a list of lines (or of (text, x, y))."""
    out = []
    for d, pages in docs.items():
        for p, page in enumerate(pages, 1):
            for k, line in enumerate(page):
                t, x, y = line if isinstance(line, tuple) else (line, 40.0, 20.0 * k)
                out.append((d, p, k, t, float(x), float(y)))
    return spark.createDataFrame(out, LINES)


def header(line, kind):
    n = re.sub(r"\s+", " ", re.sub(r"[^\w\s]", " ", line.lower())).strip()
    c = n.replace(" ", "")
    return (len(n) <= 120 and any(re.search(p, n) for p in RUSSIAN.headers[kind])) or (len(c) <= 80 and any(k in c for k in RUSSIAN.keywords[kind]))


def stop(line, kind):
    n = re.sub(r"\s+", " ", re.sub(r"[^\w\s]", " ", line.lower())).strip()
    return len(n) <= 120 and not header(line, kind) and any(re.search(p, n) for p in RUSSIAN.stops)


def span(texts, kind):
    """The section of a kind by walking over the lines."""
    at = next((i for i, t in enumerate(texts) if header(t, kind)), None)
    if at is None:
        return None
    for i in range(at + 1, len(texts)):
        if stop(texts[i], kind):
            return at + 1, max(i - 1, at + 1)
    return (at + 1, len(texts) - 1) if at + 1 < len(texts) else None


POOL = ["Перечень сокращений", "Термины и определения", "Введение", "АСУ — система", "текст", " ", "ГОСТ 12", "Приложение А", "обозначения", "x: y", "о" * 130 + " термины", "СОДЕРЖАНИЕ"]


def test_spans_follow_the_walk(spark):
    rng = random.Random(1)
    docs = {d: [[rng.choice(POOL) for _ in range(rng.randint(0, 5))] for _ in range(rng.randint(1, 3))] for d in range(150)}
    got = {(d, k): (a, b) for d, k, a, b, _, _ in rows(sections.section_spans(lines.line_stream(as_lines(spark, docs))))}
    for d, pages in docs.items():
        texts = [t for p in pages for t in p if t.strip()]
        for kind in (ABBREVIATIONS, TERMS):
            assert got.get((d, kind)) == span(texts, kind), (texts, kind)


def test_stop_after_header_is_content(spark):
    out = rows(sections.section_text(lines.line_stream(as_lines(spark, {1: [["Перечень сокращений", "Введение", "АСУ — система"]]}))), "kind", "text")
    assert out == [(ABBREVIATIONS, "Введение")]


@pytest.mark.parametrize(
    ("line", "pair"),
    [
        ("1. АСУ — система", ("АСУ", "система")), ("1.2. x — y", ("2. x", "y")), ("- foo - bar", ("- foo", "bar")), ("по-русски слово", ("по", "русски слово")), ("foo -", None), ("ab", None),
        ("x  y  z", ("x", "y z")), ("a\tb", ("a", "b")), ("a\u00a0\u2003b c", ("a", "b c")), ("a b c", None), ("x  y", ("x", "y")), ("- " + "f" * 81 + " - bar", None), ("12) НД: надзор", ("НД", "надзор")),
    ],
)
def test_pair_lines(spark, line, pair):
    got = spark.createDataFrame([(line,)], "t string").select(pairs.parse_pair(F.col("t")).alias("p")).first().p
    assert (tuple(got) if got else None) == pair


def test_first_pair_wins(spark):
    docs = {1: [["Перечень сокращений", "АСУ — система", "асу — СИСТЕМА", "НД — надзор"], ["АСУ — система"]]}
    got = rows(pairs.first_wins(pairs.pairs_of_lines(sections.section_text(lines.line_stream(as_lines(spark, docs)))), "seq"), "key", "page_number", "source_line")
    assert got == [("АСУ", 1, "АСУ — система"), ("НД", 1, "НД — надзор")]


def table_model(page):
    """Two columns of one page by dictionaries."""
    xs = sorted(x for _, x, _ in page)
    mid = xs[len(xs) // 2]
    left, right = {}, {}
    for t, x, y in page:
        side, at = (left if x < mid else right), round(y / 8) * 8
        if at not in side or x < side[at][1]:
            side[at] = (t, x)
    return [(left[y][0].strip(), right[y][0].strip()) for y in sorted(set(left) & set(right))]


def test_tables_follow_the_model(spark):
    rng = random.Random(3)
    docs = {d: [[(rng.choice(["А", "Б", " в ", "г"]) + str(rng.randint(0, 3)), rng.choice([40, 41, 42, 300, 301]), rng.choice([4, 12, 20, 28, 36, 37, 44.5])) for _ in range(rng.randint(1, 9))] for _ in range(2)] for d in range(80)}
    got = rows(pairs.pairs_of_tables(as_lines(spark, docs).withColumn("kind", F.lit("terms"))), "doc_id", "page_number", "key", "value")
    want = set()
    for d, pages in docs.items():
        seen = set()
        for p, page in enumerate(pages, 1):
            for k, v in table_model(page):
                if k and v and (k.lower(), v.lower()) not in seen:
                    seen.add((k.lower(), v.lower()))
                    want.add((d, p, k, v))
    assert set(got) == want and len(got) == len(want)


@pytest.mark.parametrize(("key", "looks"), [("АСУ", True), ("ABCDEFG", True), ("абвгдеж", False), ("12.3", False), ("абвгде", True), ("А" * 21, False), (" ", False), ("Ⅳ секция", False)])
def test_abbreviations(spark, key, looks):
    assert spark.createDataFrame([(key,)], "k string").select(pairs.looks_like_abbreviation(F.col("k"))).first()[0] is looks


def test_extraction_ways(spark):
    docs = {
        1: [["Перечень сокращений", "АСУ — система", "НД — надзор", "Термины и определения", "узел: часть сети", "сеть: связь узлов", "Приложение"]],
        2: [["Термины и определения", ("узел", 40, 104), ("часть сети", 300, 105), ("сеть", 40, 120), ("связь узлов", 300, 121), ("дата", 300, 200), ("Приложение А", 300, 300)]],
        3: [["АСУ — система управления", "длинный ключ строки: значение"]],
        4: [["Перечень сокращений", "АСУ — система"]],
        5: [["текст без пар"]],
    }
    got = extract.numbered(extract.extract_lists(as_lines(spark, docs)))
    by = {}
    for d, k, key, _ in rows(got.orderBy("doc_id", "kind", "pos"), "doc_id", "kind", "key", "pos"):
        by.setdefault((d, k), set()).add(key)
    assert by[1, ABBREVIATIONS] == {"АСУ", "НД"} and by[1, TERMS] == {"узел", "сеть"} and by[2, TERMS] == {"узел", "сеть"}
    assert by[3, ABBREVIATIONS] == {"АСУ"} and by[3, TERMS] == {"АСУ", "длинный ключ строки"}
    # a lone pair is given up for the scan of all lines, which takes it as a term too
    assert by[4, ABBREVIATIONS] == {"АСУ"} and by[4, TERMS] == {"АСУ"} and (5, TERMS) not in by
    counts = dict((d, (a, t)) for d, a, t in rows(extract.result_counts(spark.createDataFrame([(d,) for d in docs], "doc_id bigint"), got)))
    assert counts[5] == (0, 0) and counts[1] == (2, 2)


def chunk_model(pages, k, most):
    """Chunks by recursion, a single page cut."""
    out = []

    def text(batch):
        parts = []
        for p, page in batch:
            if any(t.strip() for t in page):
                parts += [f"--- Страница {p} ---", *(t for t in page if t.strip())]
        return "\n".join(parts)

    def flush(batch):
        t = text(batch)
        if not t.strip():
            return
        if len(t) > most and len(batch) > 1:
            flush(batch[: len(batch) // 2])
            flush(batch[len(batch) // 2 :])
        else:
            out.append((batch[0][0], batch[-1][0], t[:most]))

    numbered = list(enumerate(pages, 1))
    for i in range(0, len(numbered), max(k, 1)):
        flush(numbered[i : i + max(k, 1)])
    return out


@pytest.mark.parametrize("k", [0, 1, 3, 4, 7])
def test_chunks_follow_the_model(spark, k):
    rng = random.Random(k)
    docs = {d: [[rng.choice(["a" * 30, "бб", " "]) for _ in range(rng.randint(1, 5))] for _ in range(rng.randint(1, 12))] for d in range(25)}
    got = {}
    for d, n, a, b, t in rows(chunks.chunks(as_lines(spark, docs), k, 120)):
        got.setdefault(d, []).append((n, a, b, t))
    for d, pages in docs.items():
        assert [x[1:] for x in sorted(got.get(d, []))] == chunk_model(pages, k, 120)


def test_replies(spark):
    raw = [
        '{"abbreviations":[7,{"short_form":" АСУ ","full_form":"система"},{"short_form":null,"full_form":"x"}],"terms":null}', 'Ответ: {"terms":[{"term":"узел","definition":"часть"}]} всё', "нет данных", "{broken}", "[]",
        '{"abbreviations":5}', '{"abbreviations":"abc","terms":[{"term":"a","definition":"b"}]}', None, '{"terms":{"term":"x"}}', "5.1 текст",
    ]
    df = spark.createDataFrame([(i, 1, 5, 8, r) for i, r in enumerate(raw)], "doc_id bigint, chunk_no int, start_page int, end_page int, raw string")
    assert [s for _, s in rows(replies.reply_status(df), "doc_id", "status")] == ["ok", "ok", "fatal", "skipped", "skipped", "skipped", "ok", "fatal", "ok", "fatal"]
    assert rows(replies.reply_pairs(df), "doc_id", "kind", "key", "value", "page_number", "source_line") == [(0, "abbreviations", "АСУ", "система", 5, "[LLM стр.5-8]"), (1, "terms", "узел", "часть", 5, "[LLM стр.5-8]"), (6, "terms", "a", "b", 5, "[LLM стр.5-8]")]


def test_replies_fail_the_document_and_keep_the_first(spark):
    one = '{"terms":[{"term":"узел","definition":"часть"},{"term":"УЗЕЛ","definition":"часть"}]}'
    df = spark.createDataFrame([(1, 1, 1, 4, one), (1, 2, 5, 8, one), (2, 1, 1, 4, one), (2, 2, 5, 8, "нет")], "doc_id bigint, chunk_no int, start_page int, end_page int, raw string")
    assert rows(replies.reply_lists(df), "doc_id", "key", "page_number") == [(1, "узел", 1)]


def test_model_backend(spark):
    def backend(prompt):
        if "Страницы 3" in prompt:
            raise RuntimeError("down")
        return '{"terms":[]}'

    df = spark.createDataFrame([(1, 1, 1, 2, "a"), (1, 2, 3, 4, "b")], "doc_id bigint, chunk_no int, start_page int, end_page int, text string")
    out = replies.complete(replies.prompts(df), backend)
    assert rows(out, "chunk_no", "raw", "error") == [(1, '{"terms":[]}', None), (2, None, "down")]


def test_detected_lines(spark):
    box = lambda x, y: [[x, y], [x + 10.0, y], [x + 10.0, y + 4.0], [x, y + 4.0]]
    df = spark.createDataFrame([(1, 1, 0, box(50.0, 10.0), " b ", 0.9), (1, 1, 1, box(5.0, 10.0), "a", 0.8), (1, 1, 2, box(5.0, 1.0), " ", 0.7), (1, 1, 3, box(5.0, 10.0), "tie", 0.6)], "doc_id bigint, page_number int, det_ord int, box array<array<double>>, text string, conf double")
    assert rows(lines.detected_lines(df), "line_ord", "text", "x_min", "x_max", "y_center") == [(0, "a", 5.0, 15.0, 12.0), (1, "tie", 5.0, 15.0, 12.0), (2, "b", 50.0, 60.0, 12.0)]
