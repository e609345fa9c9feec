"""Text decoded with the wrong character encoding: found and, where possible, restored.

A swap of single-byte code pages is a substitution cipher on the letters. For every source and every page
a text may have been read with, doubtful words are counted as pairs of neighbouring bytes, and the byte-to-letter
mapping is learned by expectation-maximization against the letter bigrams of the clean names of the same table. Words
that a known page explains tolerably start from that page, which is a prior that counts can overrule; all others
start from letter frequencies alone and are deciphered, whatever the swap was. A deciphered mapping is believed if
it has pairs enough for its letters and makes the words about as likely as clean ones are. The mapping of a
source is applied with translate(); a word is taken in its new form only if the bigrams find it much more likely than
the old one. UTF-8 read as single bytes leaves sequences that only UTF-8 can have made; they are decoded, as
often as they were nested. Both work on parts of a value.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.shared import cut

#: Pages a text may wrongly have been read with, and pages it may have been written in.
READ_AS = ("cp1251", "cp1252", "cp866", "cp437", "koi8-r", "mac-roman")
WRITTEN_IN = ("cp1251", "cp866", "koi8-r", "mac-cyrillic", "iso8859-5")
LETTERS = "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯабвгдежзийклмнопрстуфхцчшщъыьэюяЁё"
_CLEAN = r"^[\t -~А-Яа-яЁё«»№—–“”’]*$"
#: Letters in the order small, capital, capital within a word are no word of a name.
_SWAPPED = r"[а-яё][А-ЯЁ]{2}"
_FLOOR = -9.0
#: Needed gain in log-likelihood of the changed words, and their least mean per letter pair.
GAIN, LEAST = 14.0, -4.3
_ROUNDS = 12
_PRIOR = 20.0
#: Needed probability of a letter that departs from the known page.
SURE = 0.95
#: A deciphered mapping needs so many pairs for each of its bytes, and a mean log-likelihood at most so far below that of clean names.
PAIRS_A_BYTE, BELOW = 25, 0.4
#: A mapping that leaves so large a share of the text as it is belongs to a related language, not to a swap.
SAME = 0.4


def _char_byte(page: str) -> dict[str, int]:
    out = {}
    for b in range(128, 256):
        try:
            out[bytes([b]).decode(page)] = b
        except UnicodeDecodeError:
            pass
    for b in range(128, 160):  # bytes the page does not define come through as control characters
        out.setdefault(chr(b), b)
    return out


_BYTES = {p: _char_byte(p) for p in READ_AS}
_CHARS = {p: {b: c for c, b in reversed(list(m.items()))} for p, m in _BYTES.items()}


def _utf8_runs(text: str, to_byte: dict[str, int]) -> tuple[str, int]:
    """The text with sequences of UTF-8 decoded that were read as single bytes, and how many there were."""
    codes = [to_byte.get(c, -1 if ord(c) > 127 else ord(c)) for c in text]
    found: list[tuple[int, int, str]] = []
    i, n = 0, len(codes)
    while i < n:
        lead = codes[i]
        size = 2 if 0xC2 <= lead <= 0xDF else 3 if 0xE0 <= lead <= 0xEF else 4 if 0xF0 <= lead <= 0xF4 else 0
        if size and i + size <= n and all(0x80 <= c <= 0xBF for c in codes[i + 1 : i + size]):
            try:
                c = bytes(codes[i : i + size]).decode("utf-8")
                # letters of European alphabets, signs and punctuation only: others are chance sequences
                if "\xa0" <= c <= "\u052f" or "\u1e00" <= c <= "\u1eff" or "\u2010" <= c <= "\u2044" or "\u20a0" <= c <= "\u20bf" or c in "№™" or "\x80" <= c < "\xa0" and "\xc2" in text or c == "\ufeff":
                    found.append((i, i + size, c))
                    i += size
                    continue
            except UnicodeDecodeError:
                pass
        i += 1
    if not found:
        return text, 0
    # sequences count if they stand together, or are of three bytes; a lone pair may be a letter beside a sign
    keep, k = [], 0
    while k < len(found):
        j = k
        while j + 1 < len(found) and found[j + 1][0] == found[j][1]:
            j += 1
        run = found[k : j + 1]
        if len(run) >= 2 or run[0][1] - run[0][0] >= 3:
            keep += run
        k = j + 1
    lone = [f for f in found if f not in keep]
    for f in lone:
        sign = not text[f[0] + 1].isalpha()  # what follows the lead is no letter in this reading
        bare = not text[f[0] - 1 : f[0]].isalpha() and not text[f[1] : f[1] + 1].isalpha()
        if text[f[0]] in "┬├─┼╨╤╥╬" or (text[f[0]] in "ÃÂ" and sign) or (sign and (bool(keep) or (bare and len(found) >= 2))):
            keep.append(f)
    out, at = [], 0
    for a, b, c in sorted(keep):
        out += [text[at:a], c]
        at = b
    return "".join(out) + text[at:], len(keep)


def unnested(text: str) -> tuple[str, int]:
    """A text with UTF-8 read as single bytes undone, however often it was nested; how many sequences there were."""
    total = 0
    while True:  # each round makes the text shorter
        best = max((_utf8_runs(text, _BYTES[p]) for p in READ_AS), key=lambda x: x[1])
        if not best[1]:
            break
        text, total = best[0], total + best[1]
    return text, total


def _index() -> dict[str, int]:
    return {c: i + 1 for i, c in enumerate(LETTERS)}


def bigram_model(values: DataFrame) -> np.ndarray:
    """Log-probabilities of letter pairs, 0 being the edge of a word, from the clean values. A pair counts by the share of the
    other sources that have it too, so that one source of garbled letters does not make them usual (with two sources or
    fewer all count). The counts that come to
    the driver are of pairs of letters, so their number is bounded by the alphabet."""
    words = values.where(F.col("value").rlike(_CLEAN) & ~F.col("value").rlike(_SWAPPED)).select("source", F.explode(F.regexp_extract_all("value", F.lit("([А-Яа-яЁё]{3,})"), 1)).alias("w"))
    padded = F.concat(F.lit(" "), F.col("w"), F.lit(" "))
    pairs = words.select("source", F.explode(F.transform(F.sequence(F.lit(1), F.length(padded) - 1), lambda i: F.substring(padded, i, F.lit(2)))).alias("p"))
    index = _index() | {" ": 0}
    counts = np.full((len(LETTERS) + 1,) * 2, 0.02)
    by = pairs.groupBy("p", "source").agg(F.count("*").alias("n")).groupBy("p").agg(F.sum("n").alias("n"), F.count("*").alias("sources")).collect()
    most = max((r["sources"] for r in by), default=1)
    for r in by:
        counts[index[r["p"][0]], index[r["p"][1]]] += r["n"] * ((r["sources"] - 1) / (most - 1) if most > 2 else 1)
    return np.log(counts / counts.sum(axis=1, keepdims=True))


def _usual(model: np.ndarray) -> tuple[np.ndarray, float]:
    """The frequencies of letters (0: edge) in the long run of a bigram model, and the mean log-likelihood of its pairs."""
    t, pi = np.exp(model), np.full(len(model), 1 / len(model))
    for _ in range(200):
        pi = pi @ t
    return pi, float((pi[:, None] * t * model).sum())


def _page_letters() -> np.ndarray:
    """Letters (0: none) of the 128 high bytes in each page a text may have been written in."""
    to, index = np.zeros((len(WRITTEN_IN), 128), dtype=int), _index()
    for k, p in enumerate(WRITTEN_IN):
        for b in range(128):
            try:
                to[k, b] = index.get(bytes([128 + b]).decode(p), 0)
            except UnicodeDecodeError:
                pass
    return to


_TO = _page_letters()


def explained_by(run: list[int], page: str, model: np.ndarray) -> int:
    """The known page that explains a word's bytes best, or -1 if none does tolerably."""
    b = np.array(run) - 128
    letters = _TO[:, b]
    score = model[np.pad(letters, ((0, 0), (1, 0))), np.pad(letters, ((0, 0), (0, 1)))]
    mean = np.where((letters == 0).any(axis=1), -np.inf, np.maximum(score, _FLOOR).mean(axis=1))
    if page in WRITTEN_IN:
        mean[WRITTEN_IN.index(page)] = -np.inf
    return int(mean.argmax()) if mean.max() > -5.5 else -1


def _joint(emit: np.ndarray, counts: np.ndarray, joint: np.ndarray) -> np.ndarray:
    """Expected counts of (symbol, letter) under ``emit(symbol | letter)``, for pairs of symbols ``counts``; symbol 0 is the edge, as letter 0."""
    a = counts / np.maximum(emit @ joint @ emit.T, 1e-300)
    return emit * (a @ (emit @ joint.T) + a.T @ (emit @ joint))


def learn(pairs: pd.DataFrame, known: int, model: np.ndarray) -> np.ndarray:
    """The letter (0: none) of each high byte, from counts ``b1, b2, n`` of byte pairs (0: edge of a word), by
    expectation-maximization from the mapping of page ``known``, or by deciphering if that is -1."""
    b1, b2, n = (pairs[c].to_numpy() for c in ("b1", "b2", "n"))
    seen = np.unique(np.concatenate([[0], b1, b2]))
    counts = np.zeros((len(seen), len(seen)))
    np.add.at(counts, (np.searchsorted(seen, b1), np.searchsorted(seen, b2)), n)
    out = np.zeros(128, dtype=int)
    if known < 0:
        best = decipher(counts, model)
        if best is not None:
            out[seen[1:] - 128] = best[1:]
        return out
    pi, _ = _usual(model)
    letters = np.concatenate([[0], _TO[known][seen[1:] - 128]])
    prior = np.full((len(seen), len(model)), 0.05 / len(model))
    prior[np.arange(len(seen)), letters] += 1
    prior[1:, 0], prior[0] = 1e-9, 0
    prior[0, 0] = 1
    emit = prior / prior.sum(axis=0)
    for _ in range(_ROUNDS):
        new = _joint(emit, counts, pi[:, None] * np.exp(model)) + prior * _PRIOR
        new[0], new[1:, 0] = 0, 1e-9
        new[0, 0] = 1
        emit = new / np.maximum(new.sum(axis=0), 1e-300)
    chance = new[1:] / np.maximum(new[1:].sum(axis=1, keepdims=True), 1e-300)
    best, page = chance.argmax(axis=1), letters[1:]
    out[:] = _TO[known]
    out[seen[1:] - 128] = np.where(chance.max(axis=1) >= SURE, best, page)
    return out


def decipher(counts: np.ndarray, model: np.ndarray) -> np.ndarray | None:
    """The letter of each symbol of a substitution cipher from its pair counts (symbol 0 is the edge), or None if it cannot be believed.

    Expectation-maximization starts from how frequent symbols and letters are; its most probable one-to-one mapping is
    improved by exchanging letters as long as the likelihood of all pairs grows, from a few disturbed starts.
    """
    k, total = len(counts), counts.sum()
    pi, clean = _usual(model)
    if k < 2 or total < PAIRS_A_BYTE * (k - 1) or k > len(model):
        return None
    share = counts.sum(axis=0)[1:] / counts[:, 1:].sum()
    letters = pi[1:] / pi[1:].sum()
    near = np.exp(-0.5 * ((np.log(share + 1e-6)[:, None] - np.log(letters + 1e-6)[None, :]) / 0.8) ** 2) + 1e-4
    emit = np.zeros((k, len(model)))
    emit[1:, 1:], emit[0, 0] = near, 1
    emit[1:, 1:] *= share[:, None]
    emit /= emit.sum(axis=0)
    joint = pi[:, None] * np.exp(model)
    for _ in range(60):
        new = _joint(emit, counts, joint) + 1e-6
        new[0], new[:, 0] = 0, 0
        new[0, 0] = 1
        emit = new / new.sum(axis=0)
    chance = new[1:, 1:] / new[1:, 1:].sum(axis=1, keepdims=True)
    score = lambda m: float((counts * model[np.ix_(m, m)]).sum())

    def climbed(m: np.ndarray) -> tuple[float, np.ndarray]:
        at, moved = score(m), True
        while moved:
            moved = False
            free = np.setdiff1d(np.arange(1, len(model)), m)
            for i in range(1, k):
                for j in [*range(i + 1, k), *(-free)]:
                    new = m.copy()
                    if j > 0:
                        new[i], new[j] = m[j], m[i]
                    else:
                        new[i] = -j
                    if (s := score(new)) > at + 1e-9:
                        free = np.setdiff1d(np.arange(1, len(model)), new) if j < 0 else free
                        at, m, moved = s, new, True
        return at, m

    first, order = np.zeros(k, dtype=int), np.argsort(-chance.max(axis=1))
    for i in order:
        first[i + 1] = next(c + 1 for c in np.argsort(-chance[i]) if c + 1 not in first)
    rng = np.random.default_rng(k)
    tries = [climbed(first)]
    for _ in range(6):
        m = max(tries, key=lambda x: x[0])[1].copy()
        swap = rng.permutation(np.arange(1, k))[: max(2, k // 4)]
        m[swap] = m[np.roll(swap, 1)]
        tries.append(climbed(m))
    at, m = max(tries, key=lambda x: x[0])
    return m if at / total >= clean - BELOW else None


def _score(word: str, model: np.ndarray, index: dict[str, int]) -> tuple[float, int]:
    """Log-likelihood of the letters of a word and their number of pairs; signs and digits are edges, foreign letters improbable."""
    total, n, last = 0.0, 0, 0
    for c in word + " ":
        k = index.get(c)
        if k is None:
            if c.isascii() or c in "«»№—–“”’":
                k = 0
            else:
                total, n, last = total + _FLOOR, n + 1, 0
                continue
        if k or last:
            total, n = total + max(model[last, k], _FLOOR), n + 1
        last = k
    return total, n


def _doubtful_words(text: str, to_byte: dict[str, int]) -> list[list[int]]:
    """Words of ``text`` in bytes of a page, if they are of high bytes only (apart from signs and digits)."""
    out = []
    for w in re.split(r"[ \t_.()]+", text):
        if re.search(r"[A-Za-z]", w):
            continue
        run: list[int] = []
        for c in w + "-":
            b = to_byte.get(c)
            if b is not None:
                run.append(b)
            elif c.isascii():
                if len(run) >= 3:
                    out.append(run)
                run = []
            else:
                run = []
                break
    return out


def improbable(text: str, model: np.ndarray, index: dict[str, int]) -> bool:
    """Whether the words of a text in clean letters are much less likely than those of clean names."""
    total, pairs = 0.0, 0
    for w in re.findall("[А-Яа-яЁё]{4,}", text):
        s, n = _score(w, model, index)
        total, pairs = total + s, pairs + n
    return pairs >= 5 and LEAST * pairs - total >= GAIN / 2


def mappings(values: DataFrame, model: np.ndarray) -> DataFrame:
    """``(source, page, from_chars, to_chars)``: the learned mapping of each source and page, for translate()."""

    def pairs_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = _index()
        for batch in batches:
            count: dict[tuple, int] = {}
            for source, value in zip(batch["source"], batch["value"]):
                text, _ = unnested(value)
                if not re.search(r"[^\t -~А-Яа-яЁё«»№—–“”’]|" + _SWAPPED, text) and not improbable(text, model, index):
                    continue
                for page in READ_AS:
                    for run in _doubtful_words(text, _BYTES[page]):
                        known = explained_by(run, page, model)
                        if known < 0:  # only what is no word as it stands is left to be deciphered
                            total, n = _score("".join(_CHARS[page][b] for b in run), model, index)
                            if total >= (LEAST - 0.5) * n:
                                continue
                        for pair in zip([0, *run], [*run, 0]):
                            key = (source, page, known, *pair)
                            count[key] = count.get(key, 0) + 1
            yield pd.DataFrame([(*k, n) for k, n in count.items()], columns=["source", "page", "known", "b1", "b2", "n"])

    counted = values.mapInPandas(pairs_of, "source string, page string, known int, b1 int, b2 int, n bigint").groupBy("source", "page", "known", "b1", "b2").agg(F.sum("n").alias("n"))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        source, page, known = pdf["source"].iloc[0], pdf["page"].iloc[0], int(pdf["known"].iloc[0])
        best = learn(pdf, known, model)
        pairs = [(c, LETTERS[best[b - 128] - 1]) for c, b in _BYTES[page].items() if best[b - 128] > 0]
        if known < 0 and pairs:
            to, n = dict(pairs), pdf.groupby("b2")["n"].sum().to_dict()
            of = {c: n.get(b, 0) for c, b in _BYTES[page].items()}
            if sum(of[c] for c in to if to[c] == c) >= SAME * max(1, sum(of[c] for c in to)):
                pairs = []
        return pd.DataFrame([(source, f"{page}:{known}", "".join(a for a, _ in pairs), "".join(b for _, b in pairs))], columns=["source", "page", "from_chars", "to_chars"])

    return counted.groupBy("source", "page", "known").applyInPandas(fit, "source string, page string, from_chars string, to_chars string").where("from_chars <> ''")


def judged(value: str, plain: str, sequences: int, variants: dict[str, str], model: np.ndarray, index: dict[str, int]) -> tuple[bool, str]:
    """Whether a value is garbled, and its restored form. ``variants`` are translations of ``plain``, letter for letter."""
    best, best_gain = plain, 0.0
    for _, new in sorted(variants.items()):
        if new == plain:
            continue
        gain = pairs = 0.0
        likelihood = 0.0
        out, at = [], 0
        for m in re.finditer(r"[^ \t_.()]+", plain):
            a, b = plain[m.start() : m.end()], new[m.start() : m.end()]
            take = False
            if a != b and not re.search(r"[A-Za-z]", a):
                (s0, _), (s1, n1) = _score(a, model, index), _score(b, model, index)
                if s1 > s0 + 2 and s1 / max(n1, 1) > -6:
                    take, gain, likelihood, pairs = True, gain + s1 - s0, likelihood + s1, pairs + n1
            out += [plain[at : m.start()], b if take else a]
            at = m.end()
        out.append(plain[at:])
        if gain > best_gain and gain >= GAIN and likelihood / max(pairs, 1) >= LEAST:
            # what is left of the value went the same way
            best_gain, rest = gain, re.compile(r"[^ \t_.()]*[^\x00-\x7fА-Яа-яЁё «»№—–“”’][^ \t_.()]*")
            best = "".join(out)
            best = rest.sub(lambda m: new[m.start() : m.end()] if re.fullmatch(r"[\x00-\x7fА-Яа-яЁё«»№—–]+", new[m.start() : m.end()]) else m.group(), best)
    return sequences > 0 or best_gain > 0 or "�" in value or bool(re.search(_SWAPPED, value)), best


def restore(values: DataFrame) -> DataFrame:
    """``(id, field_name, source, value, restored)`` of the garbled values of ``values(id, field_name, source, value)``.

    ``restored`` is the original text as far as it can be had; characters lost in transfer (U+FFFD) stay.
    Null, empty and clean values have no row; names in other languages are clean. Repeated rows come once.
    """
    values = values.where("value is not null").select("id", "field_name", F.coalesce("source", F.lit("")).alias("source"), "value").distinct()
    model = bigram_model(values)
    strange = ~F.col("value").rlike(_CLEAN) | F.col("value").rlike(_SWAPPED)

    def unlikely(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = _index()
        for batch in batches:
            yield batch[[improbable(v, model, index) for v in batch["value"]]]

    plausible = values.where(~strange & F.col("value").rlike("[А-Яа-яЁё]{4}")).mapInPandas(unlikely, values.schema)
    suspects = cut(values.where(strange).unionByName(plausible), "suspects")
    maps = cut(mappings(suspects.select("source", "value"), model), "maps")

    def plain_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            done = [unnested(v) for v in batch["value"]]
            yield batch.assign(plain=[d[0] for d in done], sequences=[d[1] for d in done])

    plain = suspects.mapInPandas(plain_of, "id bigint, field_name string, source string, value string, plain string, sequences int")
    # a source has one mapping for each page at most, so a value meets a bounded number of them
    tried = plain.join(maps, "source", "left").withColumn("new", F.expr("translate(plain, from_chars, to_chars)"))
    tried = tried.groupBy("id", "field_name", "source", "value", "plain", "sequences").agg(F.map_from_entries(F.collect_list(F.when(F.col("page").isNotNull(), F.struct("page", "new")))).alias("variants"))

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = _index()
        for batch in batches:
            rows = [judged(v, p, s, dict(x or {}), model, index) for v, p, s, x in zip(batch["value"], batch["plain"], batch["sequences"], batch["variants"])]
            batch = batch.assign(restored=[r[1] for r in rows])
            yield batch.loc[[r[0] for r in rows], ["id", "field_name", "source", "value", "restored"]]

    return tried.mapInPandas(judge, "id bigint, field_name string, source string, value string, restored string")


def name_values(registry: DataFrame) -> DataFrame:
    """``(id, field_name, source, value)`` of the file names and titles; the source is the batch in the path."""
    source = F.nullif(F.regexp_extract("source_path", r"^/data/input/([^/]+)/", 1), F.lit(""))
    cols = F.array(F.struct(F.lit("filename").alias("field_name"), F.col("filename").alias("value")), F.struct(F.lit("title").alias("field_name"), F.col("title").alias("value")))
    return registry.select(F.col("id").cast("bigint"), source.alias("source"), F.explode(cols).alias("v")).select("id", "v.field_name", "source", "v.value")
