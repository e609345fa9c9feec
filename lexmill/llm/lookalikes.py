"""One consistent form for text that looks the same: segments that may be unstable are found, made canonical
with their boundary context and spliced back into the text, which otherwise stays as it is.

A quick check on the JVM side (one regular expression) tells texts whose every character is known to be
stable under compatibility composition and whose words keep to one alphabet; they never leave the JVM.
In the rest, segments are the maximal runs that hold an unstable character, together with the base
character before and the marks after, and words of more than one alphabet. Only the segments are changed.

The consistent form: compatibility composition (NFKC); zero-width and soft-hyphen characters dropped; every
blank but tab, newline and carriage return a plain space; the non-breaking hyphen and dashes of other
widths a hyphen; letters of a foreign alphabet inside a word replaced by the look-alike of the word's own
alphabet. Common punctuation, letter case, the numero sign, plain spaces, tabs and newlines stay.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Pairs of letters that look alike.
CYRILLIC_LATIN = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x",
    "А": "A", "В": "B", "Е": "E", "З": "3", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X",
    "і": "i", "І": "I", "ј": "j", "Ј": "J", "ѕ": "s", "Ѕ": "S", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "Ү": "Y",
    "Ғ": "F", "Ԍ": "G", "ӏ": "l", "Ӏ": "I", "ё": "ë", "Ё": "Ë", "ї": "ï", "Ї": "Ï",
}
GREEK_LATIN = {
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ο": "o", "ν": "v", "α": "a", "ι": "i", "κ": "k", "ρ": "p", "υ": "u", "χ": "x", "ε": "e", "τ": "t", "β": "b", "η": "n", "γ": "y", "ω": "w",
}
GREEK_CYRILLIC = {
    "Α": "А", "Β": "В", "Ε": "Е", "Η": "Н", "Κ": "К", "Μ": "М", "Ο": "О", "Ρ": "Р", "Τ": "Т", "Υ": "У", "Χ": "Х", "Φ": "Ф", "Γ": "Г", "Π": "П",
    "ο": "о", "α": "а", "κ": "к", "ρ": "р", "χ": "х", "ε": "е", "τ": "т", "π": "п", "φ": "ф", "γ": "у", "υ": "у", "β": "в", "ι": "і", "ν": "у",
}
_LATIN_SURE = set("aceopxyABCEHKMOPTXY")
_CYRILLIC_SURE = set("асеорухАВЕКМНОРСТУХіІјЈѕЅ")

_STABLE = r"\t\n\r -~«»“”„‘’‚—–…№°±§·•†‡‰€£¥©®¡-§«¬®-±¶·»¿À-ÖØ-öø-ıĴ-ľŁ-ňŊ-žА-Яа-яЁёЂ-џҐ-ґҒ-ӿΆΈ-ΊΌΎ-ώ"
#: Quick check: a character outside the known stable ones, or two alphabets within one word.
QUICK_CHECK = rf"[^{_STABLE}]|[A-Za-zÀ-ž][Ͱ-ӿ]|[Ͱ-Ͽ][A-Za-zÀ-žЀ-ӿ]|[Ѐ-ӿ][A-Za-zÀ-žͰ-Ͽ]"
_KEPT = frozenset("№…™")
_DROPPED = frozenset("​‌‍⁠﻿­᠎‎‏‪‫‬‭‮⁡⁢⁣⁤️︎͏")
_HYPHENS = frozenset("‐‑﹣－‒⁃")
_LETTERS = re.compile(r"[^\W\d_]+(?:[^\W_]*[^\W\d_])?")


def _script(ch: str) -> str:
    o = ord(ch)
    if not ch.isalpha():
        return "?"
    if o < 0x250 or 0x1E00 <= o < 0x1F00:
        return "L"
    if 0x400 <= o < 0x530:
        return "C"
    if 0x370 <= o < 0x400 or 0x1F00 <= o < 0x2000:
        return "G"
    return "?"


_TO = {
    "C": {**{v: k for k, v in reversed(list(CYRILLIC_LATIN.items())) if v.isalpha()}, **GREEK_CYRILLIC},
    "L": {**{k: v for k, v in CYRILLIC_LATIN.items() if v.isalpha()}, **GREEK_LATIN},
    "G": {v: k for k, v in reversed(list(GREEK_LATIN.items()))} | {v: k for k, v in reversed(list(GREEK_CYRILLIC.items()))},
}
# of several source letters the plain Russian one is the look-alike
_TO["C"].update({"i": "і", "I": "І", "j": "ј", "s": "ѕ", "S": "Ѕ", "h": "һ", "Y": "У", "b": "ь"})


def _one_alphabet(word: str) -> str:
    """A word of several alphabets in the one it mostly has; letters without a look-alike decide first, and among equals
    Cyrillic, then Latin: the order of a set is another in every process."""
    scripts = [_script(c) for c in word]
    kinds = set(scripts) - {"?"}
    if len(kinds) < 2:
        return word
    own = {k: sum(s == k and (c not in _CYRILLIC_SURE if k == "C" else c not in _LATIN_SURE if k == "L" else False) for c, s in zip(word, scripts)) for k in kinds}
    count = {k: scripts.count(k) for k in kinds}
    to = max(kinds, key=lambda k: (own[k] > 0, own[k] + count[k], count[k], "GLC".index(k)))
    return "".join(_TO[to].get(c, c) if s not in (to, "?") else c for c, s in zip(word, scripts))


def _joining() -> frozenset[str]:
    """Characters whose quick-check value is MAYBE: they may compose with what stands before (the second halves of
    canonical pairs, and the vowels and final consonants of Hangul syllables)."""
    out = {chr(c) for a, b in ((0x1161, 0x1176), (0x11A8, 0x11C3)) for c in range(a, b)}
    for c in range(0xC0, 0x12000):
        pair = unicodedata.decomposition(chr(c)).split()
        if len(pair) == 2 and not pair[0].startswith("<"):
            out.add(chr(int(pair[1], 16)))
    return frozenset(out)


_JOINING = _joining()


def _joins(ch: str) -> bool:
    return ch in _JOINING or unicodedata.combining(ch) != 0


def _unstable(ch: str) -> bool:
    if ch in _KEPT or ch.isascii():
        return False
    return ch in _DROPPED or ch in _HYPHENS or _joins(ch) or (ch.isspace() and ch not in "\t\n\r") or not unicodedata.is_normalized("NFKC", ch)


def _canonical_segment(segment: str) -> str:
    kept = "".join("-" if c in _HYPHENS else " " if c.isspace() and c not in "\t\n\r" else c for c in segment if c not in _DROPPED)
    parts, run = [], ""
    for c in kept:  # characters that stay as they are split the composition
        if c in _KEPT:
            parts += [unicodedata.normalize("NFKC", run), c]
            run = ""
        else:
            run += c
    return "".join(parts) + unicodedata.normalize("NFKC", run)


def consistent(text: str) -> str:
    """The consistent form of one text."""
    n, at, out = len(text), 0, []
    i = 0
    while i < n:
        if not _unstable(text[i]):
            i += 1
            continue
        a = i
        if _joins(text[i]):  # boundary context: the base before
            while a > at and (_joins(text[a]) or text[a] in _DROPPED):
                a -= 1
        b = i + 1
        while b < n and _unstable(text[b]):
            b += 1
        out += [text[at:a], _canonical_segment(text[a:b])]
        at = i = b
    out.append(text[at:])
    spliced = "".join(out)
    spliced = _LETTERS.sub(lambda m: _one_alphabet(m.group()), spliced)
    return _whole_words(spliced)


def _whole_words(text: str) -> str:
    """Whole words of look-alikes in a text that otherwise has the other alphabet only, not in compounds."""
    words = list(_LETTERS.finditer(text))
    scripts = [{_script(c) for c in m.group() if c.isalpha()} for m in words]
    if len({s for x in scripts for s in x}) < 2:
        return text
    out = text
    for k, m in enumerate(words):
        w, rest = m.group(), [x for j, x in enumerate(scripts) if j != k]
        if len(scripts[k]) != 1 or not rest or (len(w) > 1 and w.isupper()):
            continue
        if text[m.start() - 1 : m.start()] == "-" or text[m.end() : m.end() + 1] == "-":
            continue
        for to, sure, other in (("C", _LATIN_SURE, _CYRILLIC_SURE), ("L", _CYRILLIC_SURE, _LATIN_SURE)):
            firm = any(not set(x.group()) <= other for j, x in enumerate(words) if j != k)  # not look-alikes themselves
            if firm and all(x == {to} for x in rest) and set(w) <= sure:
                out = out[: m.start()] + "".join(_TO[to].get(c, c) for c in w) + out[m.end() :]
    return out


def quick_check(value: Column) -> Column:
    """False where a value is certainly in its consistent form; words written in another alphabet count as doubtful."""
    latin, greek, cyrillic = value.rlike("[A-Za-zÀ-ž]"), value.rlike("[Ͱ-Ͽ]"), value.rlike("[Ѐ-ӿ]")
    return value.rlike(QUICK_CHECK) | (latin & (greek | cyrillic)) | (greek & cyrillic)


def consistent_form(rows: DataFrame, id_col: str, value_col: str) -> DataFrame:
    """``(row_id, value, canonical)`` of every row. Null values stay null, empty ones empty; repeated rows and
    null ids stay as they are; other columns do not matter."""
    rows = rows.select(F.col(id_col).cast("bigint").alias("row_id"), F.col(value_col).cast("string").alias("value"))
    doubtful = F.coalesce(quick_check(F.col("value")), F.lit(False))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(canonical=[consistent(v) for v in batch["value"]])

    sure = rows.where(~doubtful).withColumn("canonical", F.col("value"))
    return sure.unionByName(rows.where(doubtful).mapInPandas(run, "row_id bigint, value string, canonical string"))


def inconsistent(rows: DataFrame, id_col: str, value_col: str) -> DataFrame:
    """``row_id`` of the rows whose value the consistent form would change, each once."""
    rows = rows.select(F.col(id_col).cast("bigint").alias("row_id"), F.col(value_col).cast("string").alias("value")).where(quick_check(F.col("value")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.loc[[consistent(v) != v for v in batch["value"]], ["row_id"]]

    return rows.mapInPandas(run, "row_id bigint").distinct()
