"""Queries over the test tables, one for each operator, each with the SQL it is checked against."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions import charset, text
from lexmill.functions.language import ABBREVIATIONS, RUSSIAN, TERMS, alternation
from lexmill.operators import chunks, extract, lines, pairs, registry, replies, sections
from lexmill.plans import adapters as A
from lexmill.shared import shared_dir, table
from lexmill.sources.files import safe_member

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
NOW = datetime.datetime(2024, 6, 1)


def _query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _now():
    return F.lit(NOW).cast("timestamp_ntz")


# SQL counterparts of the text functions
_WS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


def _clean(x: str) -> str:
    return f"regexp_replace({_strip(x)}, '{_WS}+', ' ', 'g')"


def _blank(x: str) -> str:
    return rf"NOT regexp_matches({x}, '[^\s\x0b\x1c-\x1f\x{{85}}\p{{Z}}]')"


def _norm(x: str) -> str:
    words = rf"regexp_replace(lower({x}), '[^\p{{L}}\p{{N}}_\s\x0b\x1c-\x1f\x{{85}}\p{{Z}}]', ' ', 'g')"
    return _strip(f"regexp_replace({words}, '{_WS}+', ' ', 'g')")


def _stream(source: str) -> str:
    return f"""
stream AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY page_number, line_ord) - 1 AS INTEGER) AS seq,
         CAST(row_number() OVER (PARTITION BY doc_id, page_number ORDER BY line_ord) - 1 AS INTEGER) AS line_idx
  FROM {source} WHERE NOT ({_blank('text')}))"""


def _hdr(kind: str) -> str:
    keys = " OR ".join(f"contains(compact, '{k}')" for k in RUSSIAN.keywords[kind])
    return f"((length(norm) <= 120 AND regexp_matches(norm, '{alternation(RUSSIAN.headers[kind])}')) OR (length(compact) <= 80 AND ({keys})))"


_STOP = f"(length(norm) <= 120 AND regexp_matches(norm, '{alternation(RUSSIAN.stops)}'))"
_FLAGS = f"""
normed AS (SELECT *, {_norm('text')} AS norm FROM stream),
compacted AS (SELECT *, replace(norm, ' ', '') AS compact FROM normed),
headed AS (SELECT *, {_hdr(ABBREVIATIONS)} AS is_hdr_abbreviations, {_hdr(TERMS)} AS is_hdr_terms, {_STOP} AS stop FROM compacted),
flags AS (SELECT *, stop AND NOT is_hdr_abbreviations AS is_stop_abbreviations, stop AND NOT is_hdr_terms AS is_stop_terms FROM headed)"""
_SPANS = _FLAGS + """,
kinds AS (
  SELECT doc_id, page_number, seq, 'abbreviations' AS kind, is_hdr_abbreviations AS hdr, is_stop_abbreviations AS stops FROM flags
  UNION ALL SELECT doc_id, page_number, seq, 'terms', is_hdr_terms, is_stop_terms FROM flags),
heads AS (SELECT doc_id, kind, min(seq) FILTER (hdr) AS h, count(*) AS n FROM kinds GROUP BY ALL),
ends AS (SELECT k.doc_id, k.kind, any_value(h) AS h, any_value(n) AS n, min(seq) FILTER (stops AND seq > h) AS e FROM kinds k JOIN heads USING (doc_id, kind) WHERE h IS NOT NULL GROUP BY ALL),
bounds AS (SELECT doc_id, kind, h + 1 AS start_seq, CASE WHEN e IS NOT NULL THEN greatest(e - 1, h + 1) WHEN h + 1 < n THEN n - 1 END AS end_seq FROM ends),
spans AS (
  SELECT b.doc_id, b.kind, CAST(b.start_seq AS INTEGER) AS start_seq, CAST(b.end_seq AS INTEGER) AS end_seq, s.page_number AS start_page, t.page_number AS end_page
  FROM bounds b JOIN stream s ON s.doc_id = b.doc_id AND s.seq = b.start_seq JOIN stream t ON t.doc_id = b.doc_id AND t.seq = b.end_seq WHERE b.end_seq IS NOT NULL),
section_text AS (SELECT l.doc_id, kind, page_number, seq, text FROM stream l JOIN spans s ON s.doc_id = l.doc_id AND seq BETWEEN start_seq AND end_seq)"""
_SEP = rf"(?:{_WS}*[-–—:]{_WS}*|{_WS}{{2,}}|\t)"


def _pairs(source: str, name: str, key_max: int) -> str:
    """CTEs up to ``name``: rows of ``source`` whose text holds a pair."""
    first = rf"regexp_extract(bare, '(?s)^(.*?){_SEP}(.*)$'"
    left, right = f"{first}, 1)", f"{first}, 2)"
    dl, dr = "substr(bare, 1, strpos(bare, ' - ') - 1)", "substr(bare, strpos(bare, ' - ') + 3)"
    return rf"""
{name}_bare AS (SELECT *, {_strip(rf"regexp_replace(text, '^{_WS}*\p{{Nd}}+[.)]{_WS}*', '')")} AS bare FROM {source}),
{name}_cut AS (SELECT *, {left} AS l1, {right} AS r1, CASE WHEN strpos(bare, ' - ') > 0 THEN {dl} END AS l2, CASE WHEN strpos(bare, ' - ') > 0 THEN {dr} END AS r2 FROM {name}_bare WHERE length(bare) >= 3),
{name}_way AS (SELECT *, NOT ({_blank('l1')}) AND NOT ({_blank('r1')}) AS by_first, l2 IS NOT NULL AND NOT ({_blank('l2')}) AND NOT ({_blank('r2')}) AND length(l2) <= {key_max} AS by_dash FROM {name}_cut),
{name} AS (SELECT * EXCLUDE (bare, l1, r1, l2, r2, by_first, by_dash, text), {_clean('CASE WHEN by_first THEN l1 ELSE l2 END')} AS key, {_clean('CASE WHEN by_first THEN r1 ELSE r2 END')} AS value, text AS source_line
  FROM {name}_way WHERE by_first OR by_dash)"""


def _first(source: str, order: str) -> str:
    return f"SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY doc_id, kind, lower(key), lower(value) ORDER BY {order}) = 1"


_LOOKS = rf"""(length({_strip('key')}) BETWEEN 1 AND 20 AND NOT regexp_full_match({_strip('key')}, '(?:\p{{Nd}}|[^\p{{L}}\p{{N}}_])+')
  AND (length(regexp_replace({_strip('key')}, '[^\p{{Lu}}Ⅰ-ⅯⒶ-Ⓩ]', '', 'g')) / CAST(length({_strip('key')}) AS DOUBLE) > 0.4 OR length({_strip('key')}) <= 6))"""
_FALLBACK = f"""
fallback AS (
  SELECT 'abbreviations' AS kind, * FROM all_pairs WHERE length(value) >= 4 AND length(key) <= 20 AND {_LOOKS}
  UNION ALL SELECT 'terms', * FROM all_pairs WHERE length(value) >= 4 AND length(key) BETWEEN 3 AND 120)"""


def _tables(source: str) -> str:
    return f"""
mids AS (SELECT doc_id, kind, page_number, list_sort(list(x_min))[count(*) // 2 + 1] AS mid FROM {source} GROUP BY ALL),
cells AS (SELECT b.*, mid, round_even(y_center / 8, 0) * 8 AS y, x_min < mid AS is_left FROM {source} b JOIN mids USING (doc_id, kind, page_number)),
table_rows AS (
  SELECT doc_id, kind, page_number, y, mid, min_by(text, (x_min, line_ord)) FILTER (is_left) AS left_text, min_by(text, (x_min, line_ord)) FILTER (NOT is_left) AS right_text
  FROM cells GROUP BY ALL),
table_raw AS (SELECT doc_id, kind, page_number, y, {_strip('left_text')} AS key, {_strip('right_text')} AS value FROM table_rows WHERE left_text IS NOT NULL AND right_text IS NOT NULL),
table_first AS ({_first("(SELECT * FROM table_raw WHERE key <> '' AND value <> '')", 'page_number, y')}),
table_pairs AS (SELECT doc_id, kind, page_number, y, {_clean('key')} AS key, {_clean('value')} AS value, key || ' | ' || value AS source_line FROM table_first)"""


def _stream_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_stream(A.doc_lines(spark, sf_dir))


_BASE = f"WITH {A.DOC_LINES}, {_stream('doc_lines')}"


# --- lines
@_query(_BASE + " SELECT doc_id, page_number, line_idx, seq, text FROM stream")
def line_stream(spark, sf_dir):
    return _stream_of(spark, sf_dir).select("doc_id", "page_number", "line_idx", "seq", "text")


@_query(f"WITH {A.PAGE_LINES} SELECT doc_id, page_number, string_agg(text, chr(10) ORDER BY line_ord) AS full_text FROM page_lines GROUP BY ALL")
def full_text_per_page(spark, sf_dir):
    return lines.page_full_text(A.page_lines(spark, sf_dir))


@_query(f"WITH {A.PAGE_LINES} SELECT doc_id, count(DISTINCT page_number) AS pages, count(*) AS lines FROM page_lines GROUP BY ALL")
def doc_line_counts(spark, sf_dir):
    return lines.line_counts(A.page_lines(spark, sf_dir))


@_query("SELECT DISTINCT id AS doc_id FROM registry WHERE id NOT IN (SELECT doc_id FROM ocr_pages WHERE doc_id IS NOT NULL)")
def empty_ocr_docs(spark, sf_dir):
    return lines.unread_documents(table(spark, sf_dir, "registry").select(F.col("id").alias("doc_id")), A.page_lines(spark, sf_dir))


_BOX = "SELECT l_orderkey AS doc_id, CAST(l_linenumber AS INTEGER) AS page_number, [l_tax * 100, l_tax * 100 + 50] AS xs, [l_discount * 10, l_discount * 10, l_discount * 10 + 8] AS ys, '  ' || l_returnflag || ' ' AS text, l_partkey FROM lineitem"


@_query(f"WITH b AS ({_BOX}) SELECT doc_id, page_number, trim(text) AS text, CAST(list_min(xs) AS DOUBLE) AS x_min, CAST(list_max(xs) AS DOUBLE) AS x_max, CAST(round(list_avg(ys), 6) AS DOUBLE) AS y_center, CAST(row_number() OVER (PARTITION BY doc_id, page_number ORDER BY list_avg(ys), list_min(xs), l_partkey) - 1 AS INTEGER) AS line_ord FROM b")
def detected_lines(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    x, y = F.col("l_tax") * 100, F.col("l_discount") * 10
    box = F.array(F.array(x, y), F.array(x + 50, y), F.array(x, y + 8))
    found = li.select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").cast("int").alias("page_number"), F.col("l_partkey").alias("det_ord"), box.alias("box"), F.concat(F.lit("  "), "l_returnflag", F.lit(" ")).alias("text"), F.lit(1.0).alias("conf"))
    return lines.detected_lines(found).withColumn("y_center", F.round("y_center", 6)).drop("confidence")


# --- sections
@_query(_BASE + f" SELECT doc_id, seq, {_norm('text')} AS norm, replace({_norm('text')}, ' ', '') AS compact FROM stream")
def header_normalize(spark, sf_dir):
    return sections.line_flags(_stream_of(spark, sf_dir)).select("doc_id", "seq", "norm", "compact")


@_query(_BASE + "," + _FLAGS + " SELECT doc_id, seq, is_hdr_abbreviations, is_hdr_terms FROM flags")
def header_flags(spark, sf_dir):
    return sections.line_flags(_stream_of(spark, sf_dir)).select("doc_id", "seq", "is_hdr_abbreviations", "is_hdr_terms")


@_query(_BASE + "," + _FLAGS + " SELECT doc_id, seq, is_stop_abbreviations, is_stop_terms FROM flags")
def stop_flags(spark, sf_dir):
    return sections.line_flags(_stream_of(spark, sf_dir)).select("doc_id", "seq", "is_stop_abbreviations", "is_stop_terms")


@_query(_BASE + "," + _SPANS + " SELECT * FROM spans")
def section_spans(spark, sf_dir):
    return sections.section_spans(_stream_of(spark, sf_dir))


@_query(_BASE + "," + _SPANS + " SELECT * FROM section_text")
def section_text(spark, sf_dir):
    return sections.section_text(_stream_of(spark, sf_dir))


@_query(_BASE + "," + _SPANS + " SELECT l.*, kind FROM doc_lines l JOIN spans s ON s.doc_id = l.doc_id AND page_number BETWEEN start_page AND end_page")
def section_blocks(spark, sf_dir):
    return sections.section_blocks(A.doc_lines(spark, sf_dir), sections.section_spans(_stream_of(spark, sf_dir)))


# --- pairs
@_query(_BASE + "," + rf""" x AS (SELECT doc_id, seq, text FROM stream) SELECT doc_id, seq, {_strip(rf"regexp_replace(text, '^{_WS}*\p{{Nd}}+[.)]{_WS}*', '')")} AS bare FROM x""")
def num_prefix_strip(spark, sf_dir):
    return _stream_of(spark, sf_dir).select("doc_id", "seq", pairs.strip_numbering(F.col("text")).alias("bare"))


@_query(_BASE + "," + _pairs("stream", "all_pairs", 80) + " SELECT doc_id, page_number, seq, key, value, source_line FROM all_pairs")
def pair_lines(spark, sf_dir):
    return pairs.pairs_of_lines(_stream_of(spark, sf_dir)).select("doc_id", "page_number", "seq", "key", "value", "source_line")


@_query(_BASE + "," + _SPANS + "," + _pairs("section_text", "section_pairs", 80) + " " + _first("section_pairs", "seq"))
def pairs_dedup_first(spark, sf_dir):
    return pairs.first_wins(pairs.pairs_of_lines(sections.section_text(_stream_of(spark, sf_dir))), "seq")


@_query(f"SELECT id, key, coalesce({_LOOKS}, false) AS looks FROM (SELECT id, short_form AS key FROM abbreviations)")
def abbrev_predicate(spark, sf_dir):
    return table(spark, sf_dir, "abbreviations").select("id", F.col("short_form").alias("key"), F.coalesce(pairs.looks_like_abbreviation(F.col("short_form")), F.lit(False)).alias("looks"))


@_query(_BASE + "," + _pairs("stream", "all_pairs", 120) + "," + _FALLBACK + f", won AS ({_first('fallback', 'seq')}) SELECT doc_id, kind, page_number, seq, key, value, source_line FROM won")
def fallback_scan(spark, sf_dir):
    out = pairs.first_wins(pairs.fallback_pairs(_stream_of(spark, sf_dir)), "seq")
    return out.select("doc_id", "kind", "page_number", "seq", "key", "value", "source_line")


_LAYOUT = f"WITH {A.LAYOUT_LINES}, {_tables('layout_lines')}"


@_query(_LAYOUT + " SELECT doc_id, page_number, mid FROM mids")
def table_mid(spark, sf_dir):
    return pairs.table_rows(A.layout_lines(spark, sf_dir)).select("doc_id", "page_number", "mid").distinct()


@_query(_LAYOUT + " SELECT doc_id, page_number, y, left_text, right_text FROM table_rows")
def table_rows(spark, sf_dir):
    return pairs.table_rows(A.layout_lines(spark, sf_dir)).select("doc_id", "page_number", "y", "left_text", "right_text")


@_query(_LAYOUT + " SELECT * FROM table_pairs")
def table_pairs(spark, sf_dir):
    return pairs.pairs_of_tables(A.layout_lines(spark, sf_dir))


@_query(f"WITH {A.CHILDREN}, c AS (SELECT document_id AS doc_id, 'all' AS kind, key, value, id, CASE kind WHEN 'terms' THEN 0 ELSE 1 END AS rank FROM children), w AS ({_first('c', 'rank, id')}) SELECT * FROM w")
def merge_pairs(spark, sf_dir):
    rows = A.children(spark, sf_dir).select(F.col("document_id").alias("doc_id"), F.lit("all").alias("kind"), "key", "value", "id", F.when(F.col("kind") == "terms", 0).otherwise(1).alias("rank"))
    return pairs.first_wins(rows, "rank", "id")


_EXTRACT = f"""WITH {A.DOC_LINES}, {A.SHEET_LINES},
lines AS (SELECT doc_id, page_number, line_ord, text, x_min, y_center FROM doc_lines UNION ALL SELECT doc_id, page_number, line_ord, text, x_min, y_center FROM sheet_lines),
{_stream('lines')}, {_SPANS}, {_pairs('section_text', 'section_pairs', 80)},
by_line AS ({_first('section_pairs', 'seq')}),
needy AS (SELECT * FROM spans WHERE (doc_id, kind) NOT IN (SELECT (doc_id, kind) FROM by_line GROUP BY doc_id, kind HAVING count(*) >= 2)),
blocks AS (SELECT l.*, kind FROM lines l JOIN needy s ON s.doc_id = l.doc_id AND page_number BETWEEN start_page AND end_page), {_tables('blocks')},
both_ways AS (SELECT doc_id, kind, key, value, page_number, source_line, 0 AS rank, CAST(seq AS DOUBLE) AS a, CAST(0 AS DOUBLE) AS b FROM by_line
  UNION ALL SELECT doc_id, kind, key, value, page_number, source_line, 1, page_number, y FROM table_pairs),
found AS ({_first('both_ways', 'rank, a, b')}),
rich AS (SELECT DISTINCT doc_id FROM (SELECT doc_id FROM found GROUP BY doc_id, kind HAVING count(*) >= 2)),
poor AS (SELECT * FROM stream WHERE doc_id NOT IN (SELECT doc_id FROM rich)), {_pairs('poor', 'all_pairs', 120)}, {_FALLBACK},
won AS ({_first('fallback', 'seq')}),
lists AS (SELECT * FROM found WHERE doc_id IN (SELECT doc_id FROM rich)
  UNION ALL SELECT doc_id, kind, key, value, page_number, source_line, 2, seq, 0 FROM won)"""


def _lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ["doc_id", "page_number", "line_ord", "text", "x_min", "y_center"]
    return extract.extract_lists(A.doc_lines(spark, sf_dir).select(cols).unionByName(A.sheet_lines(spark, sf_dir).select(cols)))


@_query(_EXTRACT + " SELECT doc_id, kind, CAST(row_number() OVER (PARTITION BY doc_id, kind ORDER BY rank, a, b) AS INTEGER) AS pos, key, value, page_number, source_line FROM lists")
def extract_lists(spark, sf_dir):
    return extract.numbered(_lists(spark, sf_dir))


@_query(_EXTRACT + " SELECT d.doc_id, count(*) FILTER (kind = 'abbreviations') AS abbreviations, count(*) FILTER (kind = 'terms') AS terms FROM documents d LEFT JOIN lists l ON l.doc_id = d.doc_id GROUP BY ALL")
def result_counts(spark, sf_dir):
    return extract.result_counts(table(spark, sf_dir, "documents"), _lists(spark, sf_dir))


# --- chunks
_PAGES = f"""WITH RECURSIVE {A.DOC_LINES},
marked AS (SELECT doc_id, page_number, string_agg(text, chr(10) ORDER BY line_ord) FILTER (NOT ({_blank('text')})) AS t FROM doc_lines GROUP BY ALL),
pages AS (SELECT doc_id, page_number, CASE WHEN t IS NOT NULL THEN '--- Страница ' || CAST(page_number AS VARCHAR) || ' ---' || chr(10) || t END AS page_text,
  CAST(row_number() OVER (PARTITION BY doc_id ORDER BY page_number) - 1 AS INTEGER) AS pos FROM marked)"""
_CHUNKS = _PAGES + """,
sums AS (SELECT doc_id, pos, sum(coalesce(length(page_text) + 1, 0)) OVER (PARTITION BY doc_id ORDER BY pos) AS s, count(*) OVER (PARTITION BY doc_id) AS n FROM pages),
nodes AS (
  SELECT DISTINCT doc_id, pos // 4 AS batch, pos // 4 * 4 AS lo, least(pos // 4 * 4 + 4, n) AS hi FROM sums
  UNION ALL
  SELECT v.doc_id, v.batch, unnest([v.lo, v.lo + (v.hi - v.lo) // 2]), unnest([v.lo + (v.hi - v.lo) // 2, v.hi])
  FROM nodes v JOIN sums e ON e.doc_id = v.doc_id AND e.pos = v.hi - 1 LEFT JOIN sums b ON b.doc_id = v.doc_id AND b.pos = v.lo - 1
  WHERE e.s - coalesce(b.s, 0) - 1 > 12000 AND v.hi - v.lo > 1),
leaves AS (
  SELECT v.doc_id, CAST(v.batch AS INTEGER) AS batch, CAST(v.lo AS INTEGER) AS lo, CAST(v.hi AS INTEGER) AS hi FROM nodes v JOIN sums e ON e.doc_id = v.doc_id AND e.pos = v.hi - 1 LEFT JOIN sums b ON b.doc_id = v.doc_id AND b.pos = v.lo - 1
  WHERE e.s - coalesce(b.s, 0) - 1 > 0 AND (e.s - coalesce(b.s, 0) - 1 <= 12000 OR v.hi - v.lo = 1)),
chunks AS (
  SELECT l.doc_id, lo, min(page_number) AS start_page, max(page_number) AS end_page, substr(string_agg(page_text, chr(10) ORDER BY pos), 1, 12000) AS text
  FROM leaves l JOIN pages p ON p.doc_id = l.doc_id AND p.pos >= lo AND p.pos < hi GROUP BY ALL)"""


@_query(_PAGES + " SELECT * FROM pages")
def page_text(spark, sf_dir):
    return chunks.page_texts(A.doc_lines(spark, sf_dir))


@_query(_PAGES + " SELECT doc_id, string_agg(page_text, chr(10) ORDER BY pos) AS text FROM pages GROUP BY ALL")
def document_text(spark, sf_dir):
    return chunks.document_text(A.doc_lines(spark, sf_dir))


@_query(_CHUNKS + " SELECT doc_id, batch, lo, hi FROM leaves")
def chunk_split(spark, sf_dir):
    return chunks.chunk_spans(chunks.page_texts(A.doc_lines(spark, sf_dir)))


@_query(_CHUNKS + " SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY lo) AS INTEGER) AS chunk_no, start_page, end_page, text FROM chunks")
def chunk_text(spark, sf_dir):
    return chunks.chunks(A.doc_lines(spark, sf_dir))


# --- replies of a language model
_SCALAR = r"-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?|true|false|null"
_REPLIES = rf"""WITH raws AS (SELECT doc_id, {_strip('text')} AS raw, regexp_extract(text, '(\{{[\s\S]*\}})', 1) AS braced FROM documents WHERE text IS NOT NULL),
datas AS (SELECT *, CASE WHEN regexp_matches(raw, '^[\[{{"]|^(?:{_SCALAR})$') AND json_valid(raw) THEN CAST(raw AS JSON) WHEN braced <> '' AND json_valid(braced) THEN CAST(braced AS JSON) END AS data FROM raws),
odd AS (SELECT *, list_bool_or([coalesce(json_type(data, k) IN ('UBIGINT', 'BIGINT', 'DOUBLE') AND TRY_CAST(json_extract_string(data, k) AS DOUBLE) <> 0 OR json_type(data, k) = 'BOOLEAN' AND json_extract_string(data, k) = 'true', false) FOR k IN ['$.abbreviations', '$.terms']]) AS odd FROM datas),
statuses AS (SELECT *, CASE WHEN data IS NULL THEN CASE WHEN braced <> '' THEN 'skipped' ELSE 'fatal' END WHEN json_type(data) <> 'OBJECT' OR odd THEN 'skipped' ELSE 'ok' END AS status FROM odd),
items AS (
  SELECT doc_id, kind, unnest(CAST(json_extract(data, '$.' || kind) AS JSON[])) AS item, generate_subscripts(CAST(json_extract(data, '$.' || kind) AS JSON[]), 1) - 1 AS place
  FROM statuses, (SELECT unnest(['abbreviations', 'terms']) AS kind) WHERE status = 'ok' AND json_type(data, '$.' || kind) = 'ARRAY'),
fields AS (
  SELECT doc_id, 1 AS chunk_no, kind, CAST(place AS INTEGER) AS place, {_strip("coalesce(json_extract_string(item, CASE kind WHEN 'terms' THEN '$.term' ELSE '$.short_form' END), '')")} AS key,
         {_strip("coalesce(json_extract_string(item, CASE kind WHEN 'terms' THEN '$.definition' ELSE '$.full_form' END), '')")} AS value, 1 AS page_number, '[LLM стр.1-4]' AS source_line
  FROM items WHERE json_type(item) = 'OBJECT'),
reply_pairs AS (SELECT * FROM fields WHERE key <> '' AND value <> '')"""


@_query(_REPLIES + " SELECT doc_id, status FROM statuses")
def llm_reply_status(spark, sf_dir):
    return replies.reply_status(A.replies(spark, sf_dir)).select("doc_id", "status")


@_query(_REPLIES + " SELECT * FROM reply_pairs")
def llm_payload_parse(spark, sf_dir):
    return replies.reply_pairs(A.replies(spark, sf_dir))


@_query(_REPLIES + " " + _first("reply_pairs", "chunk_no, place"))
def llm_dedup(spark, sf_dir):
    return replies.reply_lists(A.replies(spark, sf_dir))


@_query(_CHUNKS + ", p AS (SELECT doc_id, start_page, end_page, text FROM chunks) SELECT doc_id, start_page, end_page, '" + replies.TEMPLATE.replace("\n", "' || chr(10) || '").replace("{start}", "' || CAST(start_page AS VARCHAR) || '").replace("{end}", "' || CAST(end_page AS VARCHAR) || '").replace("{text}", "' || substr(text, 1, 12000) || '") + "' AS prompt FROM p")
def llm_prompts(spark, sf_dir):
    return replies.prompts(chunks.chunks(A.doc_lines(spark, sf_dir))).select("doc_id", "start_page", "end_page", "prompt")


# --- registry
_TS = "TIMESTAMP '2024-06-01 00:00:00'"


@_query(f"WITH {A.RESCANNED} SELECT file_hash, max_by(filename, source_path) AS filename, max_by(title, source_path) AS title, max_by(file_size, source_path) AS file_size, max(source_path) AS source_path FROM rescanned GROUP BY ALL")
def latest_by_hash(spark, sf_dir):
    return registry.latest_by_hash(A.rescanned(spark, sf_dir))


@_query(f"""WITH {A.RESCANNED},
new AS (SELECT file_hash, max_by(filename, source_path) AS filename, max_by(title, source_path) AS title, max_by(file_size, source_path) AS file_size, max(source_path) AS source_path FROM rescanned GROUP BY ALL)
SELECT r.id, coalesce(n.filename, r.filename) AS filename, coalesce(n.title, r.title) AS title, r.file_hash, coalesce(n.file_size, r.file_size) AS file_size, page_count, status, error_message, coalesce(n.source_path, r.source_path) AS source_path, processed_at, created_at,
       CASE WHEN n.file_hash IS NOT NULL THEN {_TS} ELSE updated_at END AS updated_at FROM registry r LEFT JOIN new n USING (file_hash)
UNION ALL
SELECT (SELECT max(id) FROM registry) + row_number() OVER (ORDER BY source_path, file_hash), filename, title, file_hash, file_size, NULL, 'pending', NULL, source_path, NULL, {_TS}, {_TS} FROM new WHERE file_hash NOT IN (SELECT file_hash FROM registry)""")
def registry_upsert(spark, sf_dir):
    return registry.upsert(table(spark, sf_dir, "registry"), A.rescanned(spark, sf_dir), _now())


@_query("SELECT id, status, created_at, row_number() OVER (ORDER BY created_at, id) AS place FROM registry WHERE status IN ('pending', 'failed')")
def registry_pending(spark, sf_dir):
    rows = registry.pending(table(spark, sf_dir, "registry")).select("id", "status", "created_at", F.col("created_at").cast("string").alias("file_hash"), F.concat_ws("|", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lpad(F.col("id").cast("string"), 20, "0")).alias("source_path"))
    numbered = registry.numbered_from(rows.withColumnRenamed("id", "doc"), "source_path", 0)
    return numbered.select(F.col("doc").alias("id"), "status", "created_at", F.col("id").cast("bigint").alias("place"))


@_query(f"SELECT * EXCLUDE (stale) REPLACE (CASE WHEN stale THEN 'pending' ELSE status END AS status, CASE WHEN stale THEN 'Сброшено: зависшая обработка' ELSE error_message END AS error_message, CASE WHEN stale THEN {_TS} ELSE updated_at END AS updated_at) FROM (SELECT *, status = 'processing' AND updated_at < {_TS} - INTERVAL 120 MINUTE AS stale FROM registry)")
def registry_stale_reset(spark, sf_dir):
    return registry.reset_stale(table(spark, sf_dir, "registry"), _now())


@_query(f"SELECT * REPLACE (CASE WHEN status = 'processing' THEN 'failed' ELSE status END AS status, CASE WHEN status = 'processing' THEN substr(repeat(filename || ' ', 80), 1, 4000) ELSE error_message END AS error_message, CASE WHEN status = 'processing' THEN {_TS} ELSE updated_at END AS updated_at) FROM registry")
def registry_mark_failed(spark, sf_dir):
    reg = table(spark, sf_dir, "registry")
    return registry.mark_failed(reg, reg.where("status = 'processing'").select("id", F.repeat(F.concat("filename", F.lit(" ")), F.lit(80)).alias("message")), _now())


@_query(f"SELECT * REPLACE (CASE WHEN status IN ('pending', 'failed') THEN 'processing' ELSE status END AS status, CASE WHEN status IN ('pending', 'failed') THEN NULL ELSE error_message END AS error_message, CASE WHEN status IN ('pending', 'failed') THEN {_TS} ELSE updated_at END AS updated_at) FROM registry")
def registry_mark_processing(spark, sf_dir):
    reg = table(spark, sf_dir, "registry")
    return registry.mark_processing(reg, registry.pending(reg).select("id"), _now())


@_query(f"""WITH d AS (SELECT doc_id AS id, max(page_number) AS pages FROM ocr_pages GROUP BY ALL)
SELECT r.* REPLACE (CASE WHEN pages IS NOT NULL THEN 'completed' ELSE status END AS status, CASE WHEN pages IS NOT NULL THEN pages ELSE page_count END AS page_count, CASE WHEN pages IS NOT NULL THEN {_TS} ELSE processed_at END AS processed_at,
  CASE WHEN pages IS NOT NULL THEN NULL ELSE error_message END AS error_message, CASE WHEN pages IS NOT NULL THEN {_TS} ELSE updated_at END AS updated_at) FROM registry r LEFT JOIN d USING (id)""")
def registry_mark_completed(spark, sf_dir):
    done = table(spark, sf_dir, "ocr_pages").groupBy(F.col("doc_id").alias("id")).agg(F.max("page_number").alias("page_count"))
    return registry.mark_completed(table(spark, sf_dir, "registry"), done, _now())


@_query(f"""WITH {A.PAGE_LINES}, {_stream('page_lines')}, {_pairs('stream', 'all_pairs', 120)}, {_FALLBACK},
won AS ({_first("(SELECT * FROM fallback WHERE kind = 'terms')", 'seq')})
SELECT document_id, term, definition, page_number, source_line FROM terms WHERE document_id NOT IN (SELECT doc_id FROM page_lines) OR document_id IS NULL
UNION ALL SELECT doc_id, key, value, page_number, source_line FROM won""")
def replace_children(spark, sf_dir):
    stream = lines.line_stream(A.page_lines(spark, sf_dir))
    new = pairs.first_wins(pairs.fallback_pairs(stream).where("kind = 'terms'"), "seq")
    new = new.select(F.col("doc_id").alias("document_id"), F.col("key").alias("term"), F.col("value").alias("definition"), "page_number", "source_line")
    done = A.page_lines(spark, sf_dir).select(F.col("doc_id").alias("document_id"))
    return registry.replace_children(table(spark, sf_dir, "terms"), new, done)


_BY_TITLE = f"""WITH {A.CHILDREN}, t AS (SELECT title, min(id) AS document_id FROM registry WHERE title IS NOT NULL GROUP BY ALL),
lists AS (SELECT title, document_id, kind, CAST(row_number() OVER (PARTITION BY document_id, kind ORDER BY c.id) AS INTEGER) AS pos, key, value FROM t JOIN children c USING (document_id))"""


@_query(_BY_TITLE + " SELECT * FROM lists")
def lists_by_title(spark, sf_dir):
    return registry.lists_by_title(table(spark, sf_dir, "registry"), A.children(spark, sf_dir))


@_query(_BY_TITLE + " SELECT title, kind, pos, key || ' — ' || CASE WHEN kind = 'terms' AND length(value) > 120 THEN substr(value, 1, 120) || '...' ELSE value END AS line FROM lists")
def query_report(spark, sf_dir):
    return registry.report_lines(registry.lists_by_title(table(spark, sf_dir, "registry"), A.children(spark, sf_dir)))


@_query("SELECT doc_id, sha256(text) AS file_hash FROM documents WHERE text IS NOT NULL")
def file_hash(spark, sf_dir):
    return table(spark, sf_dir, "documents").where("text is not null").select("doc_id", registry.file_hash(F.col("text").cast("binary")).alias("file_hash"))


@_query("SELECT id, CASE WHEN filename IN (SELECT title || '.pdf' FROM registry WHERE title IS NOT NULL) THEN regexp_extract(filename, '^(.+?)(\\.[^.]*)?$', 1) || '_' || substr(file_hash, 1, 8) || regexp_extract(filename, '^(.+?)(\\.[^.]*)?$', 2) ELSE filename END AS archived_as FROM registry".replace("\\\\", "\\"))
def archive_name(spark, sf_dir):
    reg = table(spark, sf_dir, "registry")
    taken = reg.select(F.concat("title", F.lit(".pdf")).alias("filename")).where("filename is not null")
    return registry.archive_names(reg.select("id", "filename", "file_hash"), taken).select("id", "archived_as")


@_query(r"SELECT id, regexp_replace(regexp_extract(source_path, '([^/]*)/*$', 1), '(.)\.[^.]*$', '\1') AS title FROM registry WHERE source_path IS NOT NULL")
def title_from_path(spark, sf_dir):
    return table(spark, sf_dir, "registry").where("source_path is not null").select("id", text.file_stem(F.col("source_path")).alias("title"))


@_query(r"""WITH n AS (SELECT id, unnest([filename, '../' || filename, '/' || filename, 'a\..\' || filename, 'a/' || filename, 'a..b/' || filename]) AS name FROM registry)
SELECT id, name, NOT regexp_matches(replace(name, '\', '/'), '^/|(?:^|/)\.\.(?:/|$)') AS safe FROM n WHERE name IS NOT NULL""")
def safe_member_filter(spark, sf_dir):
    f = F.col("filename")
    names = F.array(f, F.concat(F.lit("../"), f), F.concat(F.lit("/"), f), F.concat(F.lit("a\\..\\"), f), F.concat(F.lit("a/"), f), F.concat(F.lit("a..b/"), f))
    return table(spark, sf_dir, "registry").select("id", F.explode(names).alias("name")).where("name is not null").select("id", "name", safe_member(F.col("name")).alias("safe"))


@_query(r"SELECT id, CAST(length(regexp_replace(filename, '[^\x{0400}-\x{04FF}]', '', 'g')) AS INTEGER) AS score, regexp_matches(filename, '[\x{0400}-\x{04FF}]') AS cyrillic FROM registry")
def cyrillic_score(spark, sf_dir):
    return table(spark, sf_dir, "registry").select("id", text.cyrillic_score(F.col("filename")).alias("score"), text.has_cyrillic(F.col("filename")).alias("cyrillic"))


@_query()
def mojibake_fix(spark, sf_dir):
    return charset.fix_names(table(spark, sf_dir, "registry").select("id", "filename"), "filename", "fixed")


@_query()
def zip_name_decode(spark, sf_dir):
    return charset.decode_archive_names(table(spark, sf_dir, "registry").select("id", "filename"), "filename", "decoded", "auto")


@_query("SELECT DISTINCT id, document_id, lower(level) AS level, message FROM processing_log")
def log_entries(spark, sf_dir):
    """The log without its repeated rows and with one spelling of levels."""
    return table(spark, sf_dir, "processing_log").select("id", "document_id", F.lower("level").alias("level"), "message").distinct()


@_query()
def worker_stream(spark, sf_dir):
    """Lists of all recognised pages, by the streaming import run to the end of the available files."""
    from lexmill.streaming.worker import State, run_pages

    at = f"{shared_dir(spark)}/lexmill/{uuid.uuid4().hex}-worker"
    run_pages(spark, f"{sf_dir}/ocr_pages.parque[t]", f"{at}/state", f"{at}/checkpoint", _now()).awaitTermination()
    return State(spark, f"{at}/state").table("children")
