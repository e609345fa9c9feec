"""Noise of scanning: broken words, misread characters, running headings and page numbers.

Misread words: all words are grouped by a skeleton in which glyphs that scanning confuses are one; the frequent
forms of a group stand, and a form that is rare beside them, or that mixes letters with digits or alphabets,
is a misreading. One rule finds and repairs. Of several frequent forms of one skeleton the repair takes the one that
the word before it supports most, by the counts of both together in all texts, and on ties the more frequent;
which rows are found does not depend on that choice. All frequent forms count, however many: tables of forms are
broadcast only if they were counted to be small, and joined otherwise.

Headings: digits are masked and the segments at the edges of a document's pages, or standing between wide
gaps or line breaks inside its rows, are counted per document; what recurs is a heading. First words of
headings that recur in several documents show single headings elsewhere.

Repair: segments that are headings or page numbers are dropped, broken words rejoined, misread words replaced
and lines flowed into paragraphs, whose starts are found by windows over the lines.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexmill.shared import cut

#: Forms that are broadcast at most, some 60 bytes each; more of them are joined by a shuffle.
FORMS = 100_000
#: A form is frequent from so many occurrences on.
FREQUENT = 20
#: A form is a misreading if it is at most this share of the frequent form.
RARE_SHARE = 0.04
#: Lines at the top and at the bottom of a page where headings and page numbers are looked for.
EDGE = 3

# Glyphs that scanning confuses, in words with Cyrillic letters and in Latin words.
_CYRILLIC_GROUPS = [("/1", "л"), ("/l", "л"), ("ьl", "ы"), ("ьі", "ы"), ("ь1", "ы"), ("ьi", "ы")]
_CYRILLIC_MAP = {
    "a": "а", "e": "е", "o": "о", "0": "о", "c": "с", "p": "р", "x": "х", "y": "у", "k": "к", "m": "т", "t": "т", "h": "н", "и": "н", "u": "н", "r": "г", "n": "л", "п": "л", "д": "л",
    "b": "ь", "3": "з", "8": "в", "9": "я", "4": "ч", "6": "б", "w": "ш", "i": "і", "g": "д",
}
_LATIN_GROUPS = [("cl", "d"), ("rn", "m"), ("ii", "u"), ("li", "h")]
_LATIN_MAP = {"c": "e", "5": "s", "0": "o", "9": "g", "1": "i", "|": "i", "l": "i", "6": "b", "2": "z"}

_WORD = r"[\p{L}\p{N}\p{M}|/]*\p{L}[\p{L}\p{N}\p{M}|/]*"
_BREAK = r"(?:(?<=\p{Ll})(?:[-‐‑]|[¬\x{AD}](?=\s*[\r\n]))\s+(?=\p{Ll})(?!(?:и|или|либо|and|or|to)\s)|(?<=\p{Lu})[-‐‑¬\x{AD}][ \t]*[\r\n]+\s*(?=\p{Lu}))"
_NUMBER_SIGNED = r"(?:\[ ?\p{Nd}{1,4} ?\]|[—–-] ?\p{Nd}{1,4} ?[—–-]|(?:Стр\.|Страница|Лист|Page|СТР\.|ЛИСТ|PAGE) ?\p{Nd}{1,4})"
_NUMBER_BARE = r"\p{Nd}{1,4}"
_GAP = r"\r\n|\r|\n|[ \t]{2,}"


def _translated(word: Column, groups, mapping) -> Column:
    word = reduce(lambda w, g: F.replace(w, F.lit(g[0]), F.lit(g[1])), groups, word)
    return F.translate(word, "".join(mapping), "".join(mapping.values()))


def skeleton(word: Column) -> Column:
    """The confusable-glyph skeleton of a lower-case word."""
    return F.when(word.rlike(r"[а-яё]"), _translated(word, _CYRILLIC_GROUPS, _CYRILLIC_MAP)).otherwise(_translated(word, _LATIN_GROUPS, _LATIN_MAP))


def _sized(forms: DataFrame) -> DataFrame:
    """A written table of forms, to be broadcast if it was counted to have at most ``FORMS`` rows."""
    return F.broadcast(forms) if forms.limit(FORMS + 1).count() <= FORMS else forms


def values(terms: DataFrame, abbreviations: DataFrame, pages: DataFrame) -> DataFrame:
    """``(source_table, field_name, row_key, doc, text)`` of all values that scanning may have damaged."""

    def part(df: DataFrame, table: str, field: str, key: Column, doc: str) -> DataFrame:
        return df.select(F.lit(table).alias("source_table"), F.lit(field).alias("field_name"), key.alias("row_key"), F.col(doc).cast("bigint").alias("doc"), F.col(field).cast("string").alias("text"))

    key = F.col("id").cast("string")
    out = part(terms, "terms", "definition", key, "document_id").unionByName(part(terms, "terms", "source_line", key, "document_id"))
    out = out.unionByName(part(abbreviations, "abbreviations", "full_form", key, "document_id"))
    out = out.unionByName(part(pages, "ocr_pages", "full_text", F.concat_ws(":", F.col("doc_id"), F.col("page_number")), "doc_id"))
    return out.where(F.col("text").rlike(r"\S"))


_KEY = ["source_table", "field_name", "row_key"]


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.regexp_replace(text, _BREAK, ""), F.lit(rf"({_WORD})"), 1)


def frequent_forms(vals: DataFrame) -> DataFrame:
    """``(form, n, skeleton, best, best_n)``: the frequent forms of one alphabet; ``best`` is the most frequent form of the
    skeleton. Forms that are rare beside it are left out."""
    words = vals.select(F.explode(_words(F.col("text"))).alias("w")).where(F.col("w").rlike(r"^(?:[А-ЯЁ]?[а-яё]{2,}|[A-Z]?[a-z]{2,})$"))
    # names start with a capital; a word that is also written small is a common word
    counted = words.groupBy(F.lower("w").alias("form")).agg(F.count("*").alias("n"), F.sum(F.col("w").rlike(r"^\p{Ll}").cast("int")).alias("small"))
    counted = counted.where((F.col("n") >= FREQUENT) & (F.col("small") >= F.col("n") * 0.3)).select("form", "n", skeleton(F.col("form")).alias("skeleton"))
    group = W.partitionBy("skeleton")
    top = counted.withColumn("best_n", F.max("n").over(group)).where(F.col("n") > F.col("best_n") * RARE_SHARE)
    return cut(top.withColumn("best", F.max_by("form", F.struct("n", "form")).over(group)), "forms")


def _misread(words: DataFrame, forms: DataFrame) -> DataFrame:
    """Of ``words`` with ``w`` those that are misread, with ``form`` in small letters, ``skeleton`` and ``best`` (null: unknown)."""
    # forms of codes (capitals and numbers), numbers with units, and names written in one alphabet cannot be judged
    words = words.where(~F.col("w").rlike(r"^(?:\p{Lu}[\p{Ll}ё]+|[\p{Lu}\p{N}/|]*)$|^\p{N}+[/|]?\p{L}+$|/\p{L}{2,}|^[/|]|[/|]$") | F.col("w").rlike(r"^\p{Lu}\p{Ll}{3,}$|/[1l]"))
    words = words.withColumn("form", F.lower("w")).where(F.length("form") >= 3)
    rest = words.join(_sized(forms.select("form")), "form", "left_anti").withColumn("skeleton", skeleton(F.col("form")))
    mixed = F.col("form").rlike(r"[а-яё][a-z]|[a-z][а-яё]")
    odd = F.col("form").rlike(r"\p{L}[\p{N}|/]+\p{L}|^[\p{N}|]\p{Ll}{3}|\p{Ll}{3}[\p{N}|]$")
    rest = rest.join(_sized(forms.where("form = best").select("skeleton", "best", "best_n")), "skeleton", "left")
    capital = F.col("w").rlike(r"^\p{Lu}")
    known = F.col("best").isNotNull() & (F.length("form") >= 4) & (~capital | mixed | odd | (F.col("best_n") >= 10 * FREQUENT))
    return rest.where(mixed | known)


def misread(vals: DataFrame) -> DataFrame:
    """Keys of the values that hold a misread word."""
    words = vals.select(*_KEY, F.explode(F.array_distinct(_words(F.col("text")))).alias("w"))
    return _misread(words, frequent_forms(vals)).select(*_KEY).distinct()


def _with_previous(text: Column) -> Column:
    """The words of a text, each with the word before it (in small letters)."""
    words = _words(text)
    return F.arrays_zip(F.concat(F.array(F.lit("")), F.transform(words, F.lower)).alias("prev"), words.alias("w"))


def corrections(vals: DataFrame) -> DataFrame:
    """``(source_table, field_name, row_key, copy, prev, w, right)``: the misread words of each value that have a right form.

    Of the frequent forms of a skeleton the one that stands most often after the word before is right, on ties the most
    frequent. Only words of skeletons with several forms are counted with their neighbours.
    """
    forms = frequent_forms(vals)
    words = vals.select(*_KEY, "copy", F.explode(F.array_distinct(_with_previous(F.col("text")))).alias("p")).select(*_KEY, "copy", F.col("p.prev").alias("prev"), F.col("p.w").alias("w")).where("w is not null")
    wrong = cut(_misread(words, forms).where("best is not null").select(*_KEY, "copy", "prev", "w", "skeleton", "best"), "misread")
    several = cut(forms.join(forms.where("form <> best").select("skeleton").distinct(), "skeleton", "left_semi").select("skeleton", "form", "n"), "several")
    beside = vals.select(F.explode(_with_previous(F.col("text"))).alias("p")).select(F.col("p.prev").alias("prev"), F.lower("p.w").alias("form")).join(_sized(several.select("form")), "form", "left_semi")
    support = beside.groupBy("prev", "form").agg(F.count("*").alias("beside"))
    places = wrong.select("prev", "skeleton").distinct().join(several, "skeleton").join(support, ["prev", "form"], "left")
    chosen = places.groupBy("prev", "skeleton").agg(F.max_by("form", F.struct(F.coalesce("beside", F.lit(0)).alias("a"), "n", "form")).alias("form"))
    right = F.coalesce("form", "best")
    right = F.when(F.col("w").rlike(r"^\p{Lu}"), F.initcap(right)).otherwise(right)
    return wrong.join(chosen, ["prev", "skeleton"], "left").select(*_KEY, "copy", "prev", "w", right.alias("right"))


def _letters(segment: Column) -> Column:
    return F.regexp_replace(F.lower(F.regexp_replace(segment, r"\p{N}+", "#")), r"[\s]+", "")


def _collapsed(text: Column) -> Column:
    # spaced capitals become words; their gaps are no gaps between segments
    return F.regexp_replace(text, r"(?<=(?<!\p{L})\p{Lu}) {1,3}(?=\p{Lu}(?!\p{L}))", "")


def _segments(vals: DataFrame) -> DataFrame:
    """Segments of each value between line breaks or wide gaps: ``pos`` from 1, ``last``, and for pages whether it
    is at an edge. Only segments that may be a heading or a page number."""
    pages = vals.where("source_table = 'ocr_pages'").withColumn("lines", F.filter(F.split(_collapsed(F.col("text")), r"\r\n|\r|\n"), lambda s: s.rlike(r"\S")))
    n = F.size("lines")
    edge = F.concat(F.slice("lines", 1, EDGE), F.when(n > EDGE, F.slice("lines", F.greatest(n - EDGE + 1, F.lit(EDGE + 1)), F.lit(EDGE))).otherwise(F.array().cast("array<string>")))
    pages = pages.select(*_KEY, "doc", F.xxhash64("row_key").alias("context"), F.explode(edge).alias("line"))
    pages = pages.select(*_KEY, "doc", "context", F.trim("line").alias("line"), F.lit(True).alias("inner"), F.explode(F.split(F.trim("line"), r"[ \t]{2,}")).alias("segment"))
    inline = vals.where("source_table <> 'ocr_pages'").where(F.col("text").rlike(rf"(?:{_GAP})\S"))
    inline = inline.select(*_KEY, "doc", F.xxhash64(F.substring(F.regexp_replace(F.lower("text"), r"[^\p{L}]+", ""), 1, 24)).alias("context"), F.posexplode(F.split(_collapsed(F.col("text")), _GAP)).alias("pos", "segment"))
    inline = inline.where("pos > 0").select(*_KEY, "doc", "context", F.trim("segment").alias("line"), F.lit(False).alias("inner"), F.trim("segment").alias("segment"))
    out = pages.unionByName(inline).where(F.length("segment").between(1, 110))
    signed = rf"^{_NUMBER_SIGNED}$"
    bare = F.regexp_replace(F.regexp_replace("segment", rf"\s*{_NUMBER_SIGNED}$", ""), rf"^{_NUMBER_SIGNED}\s*", "")
    out = out.withColumn("number", F.when(F.col("segment").rlike(signed), "alone").when(F.col("segment") != bare, "beside").when(F.col("line").rlike(rf"^{_NUMBER_BARE}$"), "bare").when(F.col("segment").rlike(rf"^{_NUMBER_BARE}$"), "gap"))
    out = out.withColumn("heading", F.trim(bare)).withColumn("key", _letters(F.trim(bare)))
    shape = F.col("heading").rlike(r"^[\p{Lu}\p{N}«]") & ~F.col("heading").rlike(r"[.,;:!?…-]$|^\p{N}+[.)]?(?:\s|$)") & (F.length(F.regexp_replace("heading", r"[^\p{L}]", "")) >= 6)
    return out.withColumn("shape", shape).where(F.col("shape") | F.col("number").isNotNull())


def _headings(segs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Headings by document, and first words of headings that recur in documents."""
    by = segs.where("shape").groupBy("doc", "key").agg(
        F.countDistinct("context").alias("seen"), F.countDistinct(F.when(F.col("inner"), F.col("row_key"))).alias("pages"), F.first(F.lower(F.regexp_extract("heading", r"^([\p{L}]+)", 1))).alias("first")
    )
    by = by.where((F.col("pages") >= 2) | (F.col("seen") >= 2))
    firsts = by.where("length(first) >= 5").groupBy("first").agg(F.countDistinct("doc").alias("docs"), F.countDistinct("key").alias("keys")).where("docs >= 3 and keys >= 3")
    return by.select("doc", "key", (F.col("pages") >= 2).alias("on_pages")), firsts.select("first")


def edge_noise(vals: DataFrame) -> DataFrame:
    """``(source_table, field_name, row_key, segment, heading, number)`` of the segments that are a running heading,
    a page number, or both."""
    segs = cut(_segments(vals.where("field_name in ('definition', 'source_line', 'full_text', 'full_form')")), "segments")
    by_doc, firsts = _headings(segs)
    segs = segs.withColumn("first", F.lower(F.regexp_extract("heading", r"^([\p{L}]+)", 1)))
    segs = segs.join(by_doc.withColumn("recurs", F.lit(True)), ["doc", "key"], "left").join(firsts.withColumn("usual", F.lit(True)), "first", "left")
    edition = F.lower("heading").rlike(r"^\S+(?: \S+)? редакция \p{N}+$")
    short = F.length("heading") <= 75
    recurs = F.coalesce("recurs", F.lit(False)) & (F.col("inner") | F.col("on_pages") | ~F.col("heading").rlike(r"\p{Ll}"))
    heading = F.col("shape") & (recurs | (~F.col("inner") & short & (F.coalesce("usual", F.lit(False)) | edition)) | (F.col("inner") & edition))
    segs = segs.withColumn("is_heading", F.coalesce(heading, F.lit(False)))
    beside = F.max(F.col("is_heading").cast("int")).over(W.partitionBy(*_KEY, "line")) == 1
    # a bare number on a page is printed if it runs with the pages: by the same offset on other pages, or by a small one
    offset = F.when(F.col("inner") & (F.col("number") == "bare"), F.regexp_extract("segment", r"(\p{Nd}+)", 1).cast("int") - F.element_at(F.split("row_key", ":"), -1).try_cast("int"))
    segs = segs.withColumn("offset", offset)
    often = segs.where("offset is not null").groupBy("doc", "offset").agg(F.count("*").alias("same")).where("same >= 2")
    segs = segs.join(often, ["doc", "offset"], "left")
    runs = ~F.col("inner") | F.col("same").isNotNull() | F.col("offset").between(0, 6)
    number = (F.col("number") == "alone") | ((F.col("number") == "bare") & runs) | ((F.col("number") == "beside") & F.col("is_heading")) | ((F.col("number") == "gap") & F.col("inner") & beside)
    segs = segs.withColumn("is_number", F.coalesce(number, F.lit(False)))
    return segs.where("is_heading or is_number").select(*_KEY, "segment", F.col("is_heading").alias("heading"), F.col("is_number").alias("number"))


def broken(vals: DataFrame) -> DataFrame:
    """Keys of the values that hold a word broken at a line end or at its hyphen."""
    return vals.where(F.col("text").rlike(_BREAK)).select(*_KEY)


def defects(vals: DataFrame) -> DataFrame:
    """``(source_table, field_name, row_key, defect)``, each once. Null and blank values have no defect; rows
    repeated under one key are one; a page without line breaks has no headings."""
    noise = edge_noise(vals)
    out = broken(vals).withColumn("defect", F.lit("hyphenation")).unionByName(misread(vals).withColumn("defect", F.lit("misread")))
    kinds = F.array_compact(F.array(F.when(F.col("heading"), "running_header"), F.when(F.col("number"), "page_number")))
    found = noise.where("field_name <> 'full_form'").select(*_KEY, F.explode(kinds).alias("defect"))
    return out.unionByName(found).distinct()


def repaired(vals: DataFrame) -> DataFrame:
    """``(source_table, field_name, row_key, text)`` of every value, flowed into paragraphs without the noise.

    Paragraphs are separated by a newline. Repeated rows of one key with the same text come once.
    """
    vals = vals.withColumn("copy", F.xxhash64("text")).dropDuplicates([*_KEY, "copy"])
    right = corrections(vals).groupBy(*_KEY, "copy").agg(F.collect_list(F.struct("prev", "w", "right")).alias("right"))

    def replaced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        word = regex.compile(_WORD)
        for batch in batches:
            out = []
            for text, right in zip(batch["text"], batch["right"]):
                if text and right is not None:
                    known = {(r["prev"], r["w"]): r["right"] for r in right}
                    anywhere = {r["w"]: r["right"] for r in right}
                    prev = ""

                    def one(m, known=known, anywhere=anywhere):  # the flow may have put another word before
                        nonlocal prev
                        w = m.group()
                        new, prev = known.get((prev, w)) or anywhere.get(w, w), w.lower()
                        return new

                    text = word.sub(one, text)
                out.append(text)
            yield batch.assign(text=out).drop(columns="right")

    noise = edge_noise(vals).select(*_KEY, F.xxhash64("segment").alias("h")).distinct().withColumn("drop", F.lit(True))
    joined = F.regexp_replace(_collapsed(F.col("text")), _BREAK, "")
    lines = vals.select(*_KEY, "copy", F.posexplode(F.split(joined, r"(?:\r\n|\r|\n)")).alias("line_no", "line"))
    # headings and page numbers are dropped only where they are looked for: in lines at the edges of pages, not at the beginning of other texts
    full = (~(F.trim("line") == "")).cast("int")
    every = W.partitionBy(*_KEY, "copy")
    lines = lines.withColumn("from_top", F.sum(full).over(every.orderBy("line_no"))).withColumn("from_end", F.sum(full).over(every) - F.col("from_top") + 1)
    edge = (F.col("source_table") == "ocr_pages") & (F.least("from_top", "from_end") <= EDGE)
    segs = lines.select(*_KEY, "copy", "line_no", edge.alias("edge"), (F.trim("line") == "").alias("blank"), F.posexplode(F.split(F.trim("line"), r"[ \t]{2,}")).alias("seg_no", "segment"))
    segs = segs.withColumn("h", F.xxhash64(F.trim("segment"))).join(noise, [*_KEY, "h"], "left")
    searched = F.col("edge") | ((F.col("source_table") != "ocr_pages") & ((F.col("line_no") > 0) | (F.col("seg_no") > 0)))
    segs = segs.where(F.col("drop").isNull() | ~searched)
    order = W.partitionBy(*_KEY, "copy").orderBy("line_no", "seg_no")
    before, gap = F.lag("segment").over(order), F.lag("blank").over(order)
    new_line = F.coalesce(F.col("line_no") > F.lag("line_no").over(order), F.lit(True))
    starts = F.coalesce(gap, F.lit(False)) | (new_line & F.col("segment").rlike(r"^(?:\p{N}+(?:[.)]|\.\p{N}+)+\s|[—–•-]\s|\p{Lu})") & F.coalesce(before.rlike(r"[.!?;:…]$"), F.lit(True)))
    segs = segs.withColumn("paragraph", F.sum(F.when(starts, 1).otherwise(0)).over(order))
    flowed = segs.where("segment <> ''").groupBy(*_KEY, "copy", "paragraph").agg(F.sort_array(F.collect_list(F.struct("line_no", "seg_no", "segment"))).alias("s"))
    flowed = flowed.select(*_KEY, "copy", "paragraph", F.array_join(F.transform("s", lambda x: x["segment"]), " ").alias("p"))
    flowed = flowed.groupBy(*_KEY, "copy").agg(F.sort_array(F.collect_list(F.struct("paragraph", "p"))).alias("s"))
    text = flowed.select(*_KEY, "copy", F.array_join(F.transform("s", lambda x: x["p"]), "\n").alias("text")).join(right, [*_KEY, "copy"], "left").drop("copy")
    return text.mapInPandas(replaced, "source_table string, field_name string, row_key string, text string")
