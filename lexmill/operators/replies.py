"""Extraction through a language model: prompts out, replies in.

The model is a pluggable scalar function; all that is relational on either side is native. Replies are parsed as
VARIANT, because a typed JSON schema would lose a whole list for one odd element.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.language import ABBREVIATIONS, TERMS
from lexmill.functions.text import ustrip
from lexmill.operators.pairs import first_wins

SYSTEM = "Извлеки из распознанного текста нормативного документа сокращения и термины. Ответ — только JSON."
TEMPLATE = (
    "Страницы {start} — {end}. Верни объект с двумя списками: abbreviations (поля short_form, full_form) и terms (поля term, definition). "
    "Бери только то, что есть в тексте; если ничего нет, верни пустые списки.\n\n{text}"
)
# Fields of the lists in a reply.
FIELDS = {ABBREVIATIONS: ("short_form", "full_form"), TERMS: ("term", "definition")}


def prompts(chunks: DataFrame, max_chars: int = 12_000) -> DataFrame:
    """``chunks`` with ``prompt``."""
    head, rest = TEMPLATE.split("{start}")
    between, rest = rest.split("{end}")
    middle, tail = rest.split("{text}")
    return chunks.withColumn("prompt", F.concat(F.lit(head), F.col("start_page"), F.lit(between), F.col("end_page"), F.lit(middle), F.substring("text", 1, max_chars), F.lit(tail)))


def complete(prompted: DataFrame, backend: Callable[[str], str]) -> DataFrame:
    """``prompted`` with ``raw`` and ``error``. ``backend(prompt)`` runs once per row in Python workers; what it raises
    becomes the row's error. Write the result before using it twice: a model is slow and not deterministic."""

    @F.pandas_udf("struct<raw:string,error:string>")
    def run(prompt: pd.Series) -> pd.DataFrame:
        out = []
        for p in prompt:
            try:
                out.append((backend(p), None))
            except Exception as e:  # noqa: BLE001
                out.append((None, str(e)[:500]))
        return pd.DataFrame(out, columns=["raw", "error"])

    return prompted.withColumn("_r", run.asNondeterministic()("prompt")).select("*", "_r.raw", "_r.error").drop("_r")


def parsed(raw: Column) -> Column:
    """The VARIANT in a reply: the whole, or what stands between its first and last brace."""
    # the parser stops after the first value, so only a text that is one as a whole is given to it whole
    whole = raw.rlike(r'^(?s)(?:\{.*\}|\[.*\]|".*"|-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?|true|false|null)\z')
    return F.coalesce(F.when(whole, F.try_parse_json(raw)), F.try_parse_json(F.regexp_extract(raw, r"(\{[\s\S]*\})", 1)))


def reply_status(replies: DataFrame) -> DataFrame:
    """``replies`` with ``data`` and ``status``: ``ok``; ``skipped`` for broken JSON, a root that is no object or a list that is
    a number or true; ``fatal``, which fails the document, for no JSON at all or an error of the model."""
    out = replies.withColumn("data", parsed(ustrip(F.col("raw"))))
    kind = F.schema_of_variant("data")
    listed = lambda k: F.schema_of_variant(F.try_variant_get("data", f"$.{k}", "variant"))
    number = lambda k: F.coalesce(listed(k).rlike("^(BIGINT|DOUBLE|DECIMAL|FLOAT)") & (F.try_variant_get("data", f"$.{k}", "double") != 0), F.lit(False)) | F.coalesce(F.try_variant_get("data", f"$.{k}", "boolean") & (listed(k) == "BOOLEAN"), F.lit(False))
    brace = F.col("raw").rlike(r"\{[\s\S]*\}")
    status = (
        F.when(F.col("raw").isNull(), "fatal")
        .when(F.col("data").isNull(), F.when(brace, "skipped").otherwise("fatal"))
        .when(~kind.startswith("OBJECT"), "skipped")
        .when(number("abbreviations") | number("terms"), "skipped")
        .otherwise("ok")
    )
    return out.withColumn("status", status)


def reply_pairs(replies: DataFrame) -> DataFrame:
    """``(doc_id, chunk_no, kind, place, key, value, page_number, source_line)`` from ``replies(doc_id, chunk_no, start_page, end_page, raw)``.

    Elements that are no objects and pairs with a blank side are left out; JSON null is blank.
    """
    ok = reply_status(replies).where("status = 'ok'")
    out = None
    for kind, (key, value) in FIELDS.items():
        items = ok.select("doc_id", "chunk_no", "start_page", "end_page", F.posexplode(F.try_variant_get("data", f"$.{kind}", "array<variant>")).alias("place", "item"))
        items = items.where(F.schema_of_variant("item").startswith("OBJECT"))
        field = lambda f: ustrip(F.coalesce(F.try_variant_get("item", f"$.{f}", "string"), F.lit("")))
        part = items.select("doc_id", "chunk_no", F.lit(kind).alias("kind"), "place", field(key).alias("key"), field(value).alias("value"), F.col("start_page").alias("page_number"),
                            F.concat(F.lit("[LLM стр."), F.col("start_page"), F.lit("-"), F.col("end_page"), F.lit("]")).alias("source_line"))
        part = part.where("key <> '' and value <> ''")
        out = part if out is None else out.unionByName(part)
    return out


def reply_lists(replies: DataFrame) -> DataFrame:
    """The pairs of all replies of a document, the first of equal ones; documents with a fatal reply have none."""
    failed = reply_status(replies).where("status = 'fatal'").select("doc_id").distinct()
    return first_wins(reply_pairs(replies).join(failed, "doc_id", "left_anti"), "chunk_no", "place")
