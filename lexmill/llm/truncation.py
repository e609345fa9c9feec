"""Texts that lost their end: length hazards per source, and the evidence of an ending itself.

A field limit shows in the lengths. For every source, the discrete hazard of each length (texts that end
at it, of those at least as long) is computed by window functions, in characters and in UTF-8 bytes, and
tested against the hazards of the neighbouring lengths. All lengths from the shortest to the longest are tests,
also those that no text has, and Benjamini-Hochberg control within a source keeps false discoveries down.
A limit in one unit makes bumps in the other: a text at several significant lengths counts for the
strongest, and the others have to be significant without it. Because any unevenness becomes significant in
enough rows, a limit must also stand out in size, by ``PILE`` times its neighbours. Repeats of one text count
once. At significant lengths every ending without closing punctuation is flagged.

A transfer that broke off shows in the ending. All words of the field tell, by what follows them, how often
a word (after the word before it) ends a sentence and how often it does not. A text without closing
punctuation is flagged if its last word occurs nowhere else as a whole word, or hardly ever beside the longer
words that begin with it, or goes on in practically all other places, or if a bracket is still open. A complete
text without a final stop has none of these. Endings are counted over distinct texts and measured by how often
the field goes on there, in the same word or after it, so that more data does not make a cut look complete.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexmill.shared import cut

#: Rate of false discoveries among the significant lengths of a source.
FDR = 0.01
#: Lengths on either side that a hazard is tested against.
NEIGHBOURS = 12
#: A limit has so many times the texts that its neighbours let expect; all sources together, so many times.
PILE, PILE_ALL = 3, 10
#: So many distinct texts may end alike where nothing tells how the field goes on.
FEW = 4
#: A whole word that makes up at most this share of the longer words that begin with it is a part of one.
PART_SHARE = 0.01
_LETTER = r"\p{L}"
#: A token where every run of digits is one 0.
_TOKEN = r"[\p{L}\p{M}]++|0(?:[.,:]0)*+|\S"
# Words that a stop may follow without ending the text; what they announce is missing.
_ABBREVIATIONS = r"(?i)(?<!т\. ?)(?<![\p{L}\p{N}])(?<!\p{N}\s)(?:стр|рис|табл|разд|см|гл|ст|п|fig|sec|p|pp|vol|ch|no)\.$"
#: Dots that stand for what is missing.
_DOTS = "(?:\ufffd|(?<=[\\p{L}\\p{N} (,])(?:…|\\.\\.\\.))$"
_CLOSED = r"[.!?;][\"»”')\]]*$"
#: So many last characters show the marks above, which are shorter, as the whole text does.
_END = 24
#: Characters that ``cleaned`` looks for: unusual ones anywhere, and blanks and line ends at the end.
_UNUSUAL = "‐‑¬\u00ad\u200b\u200c\u200d\u2060\ufeff"
_BLANKS = " \t\n\x0b\f\r\x85\u00a0\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u3000"
#: A token that begins a sentence says little about how it would end one.
_BEGINS = ("", ".", "!", "?", ";", ":", "…")


def cleaned(text: Column) -> Column:
    """The text with words rejoined that were broken at line ends, and no blanks at its end."""
    # few texts have any of it, and these tests cost a fraction of the replacements
    unusual = reduce(or_, (text.contains(c) for c in _UNUSUAL)) | F.substring(text, -1, 1).isin(*_BLANKS) | text.rlike(r"-\s")
    joined = F.regexp_replace(text, rf"(?<={_LETTER})[-‐‑¬\x{{AD}}]\s+(?=\p{{Ll}})", "")
    clean = F.regexp_replace(F.regexp_replace(joined, r"[\x{AD}\x{200B}-\x{200D}\x{2060}\x{FEFF}]", ""), r"[\s\x{A0}\x{2000}-\x{200A}\x{202F}\x{3000}]+$", "")
    return F.when(unusual, clean).otherwise(text)


def _tokens(text: Column) -> Column:
    masked = F.regexp_replace(F.lower(text), r"\p{N}+", "0")
    return F.transform(F.regexp_extract_all(masked, F.lit(_TOKEN), F.lit(0)), lambda t: F.replace(t, F.lit("0"), F.lit("#")))


def _closed(clean: Column) -> Column:
    """Whether a cleaned text ends as complete ones do."""
    end = F.substring(clean, -_END, _END)
    return (end.rlike(rf"{_CLOSED}|\.\p{{L}}{{2,4}}$") | clean.rlike(_CLOSED)) & ~end.rlike(_ABBREVIATIONS) & ~end.rlike(_DOTS)


def limits(texts: DataFrame) -> DataFrame:
    """``(field, source, unit, size, n, expected, p)``: the lengths at which texts of a source end too often.

    ``texts`` has ``field``, ``source`` and ``text``. ``unit`` is ``chars`` or ``bytes``; ``whole`` marks the rows of all sources
    together, which are tested as a source of their own (null). The tail of the Poisson distribution is bounded
    after Chernoff. The windows run over distinct lengths, whose number does not grow with the rows.
    """
    bare = F.regexp_replace("text", "\ufffd+$", "")
    broken = F.col("text").endswith("\ufffd").cast("int")
    once = texts.select("field", "source", F.length("text").alias("chars"), (F.octet_length(bare) + broken).alias("bytes"), F.xxhash64("text").alias("h")).distinct()
    once = cut(once, "lengths")  # read for the counts and again for what stronger lengths explain
    long = once.select("field", "source", "h", F.explode(F.create_map(F.lit("chars"), "chars", F.lit("bytes"), "bytes")).alias("unit", "size"))
    by = long.groupBy("field", "source", "unit", "size").agg(F.count("*").alias("n"))
    total = long.groupBy("field", "unit", "size").agg(F.countDistinct("h").alias("n")).select("field", F.lit(None).cast("string").alias("source"), "unit", "size", "n")
    by = by.withColumn("whole", F.lit(False)).unionByName(total.withColumn("whole", F.lit(True)))
    by = _tested(by)
    last = F.max(F.when(F.col("under"), F.col("p"))).over(_one())
    found = cut(by.withColumn("last", last).where("p <= last").where(_piled(F.col("n"))).select("field", "source", "whole", "unit", "size", "expected", "p", "last"), "significant")
    # what a text at a stronger length explains is no evidence for another
    at = long.join(found.where("not whole"), ["field", "source", "unit", "size"]).select("field", "source", "h", "unit", "size", "whole", "p")
    at = at.unionByName(long.select("field", "h", "unit", "size").distinct().join(found.where("whole").drop("source"), ["field", "unit", "size"]).select("field", F.lit(None).cast("string").alias("source"), "h", "unit", "size", "whole", "p"))
    best = at.groupBy("field", "whole", "source", "h").agg(F.min_by(F.struct("unit", "size"), F.struct("p", "unit", "size")).alias("b")).groupBy("field", "whole", "source", "b.unit", "b.size").agg(F.count("*").alias("n"))
    same = found.withColumn("source", F.coalesce("source", F.lit(""))).join(best.withColumn("source", F.coalesce("source", F.lit(""))), ["field", "whole", "source", "unit", "size"])
    same = same.where((_tail(F.col("n"), F.col("expected")) <= F.col("last")) & _piled(F.col("n")))
    return same.select("field", F.nullif("source", F.lit("")).alias("source"), "whole", "unit", "size", "n", "expected", "p")


def _one():
    return W.partitionBy("field", "whole", "source", "unit")


def _tail(n: Column, expected: Column) -> Column:
    """Chernoff's bound on the probability of ``n`` or more where ``expected`` are."""
    return F.exp(F.when(n > expected, n - expected - n * F.log(n / expected)).otherwise(0.0))


def _piled(n: Column) -> Column:
    return n >= F.col("expected") * F.when(F.col("whole"), PILE_ALL).otherwise(PILE)


def _tested(by: DataFrame) -> DataFrame:
    """Counts of lengths with hazard, ``expected`` number, ``p`` and whether p is ``under`` its bound."""
    at_risk = F.sum("n").over(_one().orderBy(F.desc("size")).rowsBetween(W.unboundedPreceding, 0))
    near = _one().orderBy("size").rangeBetween(-NEIGHBOURS, NEIGHBOURS)
    by = by.withColumn("risk", at_risk).withColumn("hazard", F.col("n") / F.col("risk"))
    # lengths that do not occur have hazard 0: the mean is over the 2 * NEIGHBOURS neighbours, not over the rows
    around = (F.sum("hazard").over(near) - F.col("hazard")) / (2 * NEIGHBOURS)
    by = by.withColumn("expected", F.greatest(around * F.col("risk"), F.lit(0.05)))
    by = by.withColumn("p", _tail(F.col("n"), F.col("expected")))
    tests = F.max("size").over(_one()) - F.min("size").over(_one()) + 1
    return by.withColumn("under", F.col("p") <= F.row_number().over(_one().orderBy("p", "size")) / tests * FDR)


def _longer(endings: DataFrame, counted: DataFrame, on: list[str], n: str, name: str) -> DataFrame:
    """``(on, tok, name)``: how often ``counted(on, tok, n)`` has longer words that begin with ``tok`` of ``endings(on, tok)``."""
    endings = endings.select(*on, "tok", F.substring("tok", 1, 2).alias("start")).distinct()
    longer = counted.where(F.length("tok") > 1).select(*on, F.col("tok").alias("longer"), n, F.explode(F.array(F.substring("tok", 1, 1), F.substring("tok", 1, 2))).alias("start"))
    met = endings.join(longer, [*on, "start"]).where(F.col("longer").startswith(F.col("tok")) & (F.col("longer") != F.col("tok")))
    return met.groupBy(*on, "tok").agg(F.sum(n).alias(name))


def truncated(texts: DataFrame) -> DataFrame:
    """``(field, row_id, source, why)`` of each row of ``texts(field, row_id, source, text)`` that lost its end.

    ``why`` is ``limit``, ``fragment``, ``dangling``, ``open`` or ``mark``. Null and blank texts are no case; a null
    source counts with all sources only; repeated rows are judged alike and come once.
    """
    texts = texts.where(F.col("text").rlike(r"\S"))
    texts = texts.select("field", "row_id", "source", "text", cleaned(F.col("text")).alias("clean"))
    # how words go on, over all texts
    tokens = _tokens(F.col("clean"))
    word = r"^[\p{L}\p{M}#]"
    grams = texts.select("field", tokens.alias("t"))
    grams = grams.select("field", F.inline(F.arrays_zip(F.concat(F.array(F.lit("")), "t"), "t", F.slice("t", 2, 2**31 - 1)))).toDF("field", "prev", "tok", "next")
    # tokens of several characters are words or numbers
    grams = grams.where(F.col("next").isNotNull() & ((F.length("tok") > 1) | F.col("tok").rlike(word))).withColumn("ends", F.col("next").isin(".", ";", "!", "?").cast("int"))
    pairs = grams.groupBy("field", "prev", "tok").agg(F.count("*").alias("pair_n"), F.sum("ends").alias("pair_ends"))
    pairs = cut(pairs, "pairs")
    begins = F.col("prev").isin(*_BEGINS)
    words = pairs.groupBy("field", "tok").agg(F.sum("pair_n").alias("word_n"), F.sum(F.when(~begins, F.col("pair_n")).otherwise(0)).alias("inner_n"), F.sum(F.when(~begins, F.col("pair_ends")).otherwise(0)).alias("word_ends"))
    # rows whose ending has to be looked at
    clean = F.col("clean")
    tail = F.when(F.length(clean) > 160, F.substring(clean, -160, 160)).otherwise(clean)
    size_of = {"chars": F.length("text"), "bytes": F.octet_length(F.regexp_replace("text", "\ufffd+$", "")) + F.col("text").endswith("\ufffd").cast("int")}
    brackets = F.length(F.replace(clean, F.lit(")"), F.lit(""))) > F.length(F.replace(clean, F.lit("("), F.lit("")))
    doubtful = texts.where(F.exists(F.array(clean), lambda c: ~_closed(c)))  # so the text is cleaned once
    doubtful = doubtful.select("field", "row_id", "source", *(v.alias(k) for k, v in size_of.items()), brackets.alias("brackets"), F.xxhash64("text").alias("h"), tail.alias("clean"))
    capital = F.regexp_extract(clean, r"([\p{L}\p{M}]+)$", 1).rlike(r"^\p{Lu}\p{Ll}")
    # all that is asked of the ending, so that the text itself travels no further
    end = F.substring(clean, -_END, _END)
    asks = {"at_word": clean.rlike(r"[\p{L}\p{M}\p{N}]$"), "capital": capital, "quoted": clean.rlike(r"[»”)]$"), "mark": end.rlike(_DOTS), "open": F.col("brackets") | clean.rlike(r"[(\[«“„/,—–:-]$") | end.rlike(_ABBREVIATIONS)}
    asks["code"] = clean.rlike(r"\p{N}\p{L}+$|\p{Lu}{2,}$|\p{IsLatin}\p{IsCyrillic}+$|\p{IsCyrillic}\p{IsLatin}+$")
    doubtful = doubtful.select("field", "row_id", "source", *size_of, "h", *(v.alias(k) for k, v in asks.items()), _tokens(clean).alias("tail"))
    doubtful = doubtful.withColumn("tok", F.try_element_at("tail", F.lit(-1))).withColumn("prev", F.coalesce(F.try_element_at("tail", F.lit(-2)), F.lit(""))).drop("tail")
    doubtful = cut(doubtful.withColumn("suffix", F.when(F.col("capital") & (F.length("tok") > 4), F.substring(F.col("tok"), -3, 3))), "doubtful")
    sizes = doubtful.select("field", "row_id", "source", F.explode(F.create_map(F.lit("chars"), "chars", F.lit("bytes"), "bytes")).alias("unit", "size"))
    finals = doubtful.where("at_word").groupBy("field", "prev", "tok").agg(F.countDistinct("h").alias("pair_final"), F.count("*").alias("pair_rows"))
    finals = cut(finals.join(words, ["field", "tok"], "left").join(pairs, ["field", "prev", "tok"], "left"), "finals")
    n, inner, ends, pn, pends = (F.coalesce(F.col(c), F.lit(0)) for c in ("word_n", "inner_n", "word_ends", "pair_n", "pair_ends"))
    # longer words in the same place are looked for where the counts of the ending itself do not decide
    asked = finals.where(~F.col("tok").startswith("#") & ((n >= 3) | (F.col("pair_final") > F.greatest(F.lit(FEW), pn * 0.5))))
    beside = cut(_longer(asked, pairs, ["field", "prev"], "pair_n", "pair_longer"), "beside")
    parts = finals.join(beside, ["field", "prev", "tok"]).where((n >= 3) & (pn <= F.col("pair_longer") * PART_SHARE))
    finals = finals.join(beside, ["field", "prev", "tok"], "left").join(_longer(parts, words, ["field"], "word_n", "word_longer"), ["field", "tok"], "left")
    doubtful = doubtful.join(finals, ["field", "prev", "tok"], "left")
    # endings of capitalised words (names): how common the last three letters are
    names = words.where(F.length("tok") > 4).groupBy("field", F.substring("tok", -3, 3).alias("suffix")).agg(F.count("*").alias("suffix_n"))
    names = names.withColumn("suffix_share", F.col("suffix_n") / F.sum("suffix_n").over(W.partitionBy("field")))
    doubtful = doubtful.join(names.select("field", "suffix", "suffix_share"), ["field", "suffix"], "left")
    lim = limits(texts.select("field", "source", "text"))
    own = sizes.join(lim.where("not whole").select("field", "source", "unit", "size"), ["field", "source", "unit", "size"], "left_semi")
    all_ = sizes.join(lim.where("whole").select("field", "unit", "size"), ["field", "unit", "size"], "left_semi")
    at_limit = own.select("field", "row_id").union(all_.select("field", "row_id")).distinct().withColumn("limit", F.lit(True))
    doubtful = doubtful.join(at_limit, ["field", "row_id"], "left")
    final, copies, longer, word_longer = (F.coalesce(F.col(c), F.lit(0)) for c in ("pair_final", "pair_rows", "pair_longer", "word_longer"))
    # a message that always stops there is complete; where the place never goes on, its copies count too
    rare = (final <= F.greatest(F.lit(FEW), pn * 0.5)) & ((pn > 0) | (copies <= FEW))
    rare_part = final <= F.greatest(F.lit(FEW), (pn + longer) * 0.5)
    part = (n < 3) | ((pn <= longer * PART_SHARE) & (n <= word_longer * PART_SHARE))
    number = F.col("tok").startswith("#")
    at_word = F.col("at_word")
    fragment = at_word & rare_part & ~number & part & (F.col("suffix").isNull() | (F.coalesce("suffix_share", F.lit(0.0)) < 0.004)) & ~F.col("code")
    goes_on = ((pn >= 12) & (pends == 0) & (ends < inner * 0.04)) | ((pn >= 80) & (pends < pn * 0.003)) | ((inner >= 40) & (ends <= inner * 0.006) & (pends <= pn * 0.05))
    dangling = at_word & rare & ~F.col("capital") & (n >= 3) & goes_on
    why = F.when(F.col("limit") & ~F.col("quoted"), "limit").when(F.col("mark"), "mark").when(F.col("open"), "open").when(dangling, "dangling").when(fragment, "fragment")
    return doubtful.withColumn("why", why).where("why is not null").groupBy("field", "row_id").agg(F.first("source").alias("source"), F.min("why").alias("why"))


def batch_of(path: Column) -> Column:
    """The batch (source) in a source path."""
    return F.nullif(F.regexp_extract(path, r"^/data/input/([^/]+)/", 1), F.lit(""))


def field_texts(terms: DataFrame, registry: DataFrame) -> DataFrame:
    """``(field, row_id, source, text)`` of ``terms.definition`` and ``registry.error_message``."""
    batches = registry.select(F.col("id").alias("document_id"), batch_of(F.col("source_path")).alias("source")).dropDuplicates(["document_id"])
    a = terms.select(F.col("id").alias("row_id"), "document_id", F.col("definition").alias("text")).join(batches, "document_id", "left")
    b = registry.select(F.col("id").alias("row_id"), batch_of(F.col("source_path")).alias("source"), F.col("error_message").alias("text"))
    a, b = (x.select(F.lit(n).alias("field"), F.col("row_id").cast("bigint"), "source", F.col("text").cast("string")) for x, n in ((a, "terms"), (b, "registry")))
    return a.unionByName(b)


def shares(texts: DataFrame) -> DataFrame:
    """``(field, source, texts, cut_texts, share)``: how often each source truncates."""
    found = truncated(texts).select("field", "row_id", F.lit(1).alias("cut"))
    out = texts.where(F.col("text").rlike(r"\S")).join(found, ["field", "row_id"], "left")
    out = out.groupBy("field", "source").agg(F.count("*").alias("texts"), F.count("cut").alias("cut_texts"))
    return out.withColumn("share", F.col("cut_texts") / F.col("texts"))
