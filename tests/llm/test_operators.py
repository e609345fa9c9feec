"""Small cases of the training-text operators, with nulls, ties, repeats, empty tables and foreign columns."""

import os
import random
import re
import subprocess
import sys

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from tests.conftest import rows

from lexmill.llm import copies, lookalikes, mojibake, packing, residue, scans, split, tokens, truncation, versions


def clashing(df):
    """``df`` with columns named as the operators name their own."""
    for c in ("a", "b", "h1", "h2", "n", "salt", "key", "value", "tok", "why", "copies", "text_", "first_id"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit("x"))
    return df


# --- copies
PAIRS = "id bigint, term string, definition string"


def test_copies_differ_in_formatting_only(spark):
    df = spark.createDataFrame(
        [
            (5, "АСУ", "Система  управления."), (3, "асу ", "система управления"), (9, "Система управления", "АСУ"), (4, "АСУ", "система измерения"),
            (7, None, "x"), (8, None, "X!"), (6, "x", None), (10, None, None), (11, "", "--"), (12, "!", ""), (None, "АСУ", "система управления"), (3, "асу ", "система управления"),
        ], PAIRS)
    found = rows(copies.formatting_copies(clashing(df), "id", "term", "definition"))
    assert found == sorted([(3, 5), (3, 9), (6, 7), (6, 8), (11, 12)], key=str)
    kept = dict(rows(copies.collapsed(df, "id", "term", "definition")))
    assert kept == {3: 3, 4: 1, 6: 3, 10: 1, 11: 2}


def test_copies_of_an_empty_table_and_a_hot_group(spark):
    empty = spark.createDataFrame([], PAIRS)
    assert copies.formatting_copies(empty, "id", "term", "definition").count() == 0
    hot = spark.range(500).select("id", F.lit("A").alias("term"), F.lit("b c").alias("definition"))
    found = copies.formatting_copies(hot, "id", "term", "definition")
    assert found.count() == 499 and found.where("first_id <> 0").count() == 0


def test_copies_verify_collisions(spark, monkeypatch):
    monkeypatch.setattr(copies, "_hash", lambda value, seed: F.lit(1).cast("bigint"))
    df = spark.createDataFrame([(1, "a", "b"), (2, "c", "d"), (3, "D", "c"), (4, "b", "A"), (5, "e", None)], PAIRS)
    assert rows(copies.formatting_copies(df, "id", "term", "definition")) == [(1, 4), (2, 3)]


# --- pieces
def naive_pieces(text, limit, overlap):
    at, strong = split._boundaries(text, limit - overlap)
    out, cut = [], 0
    while cut < len(text):
        start = 0 if cut == 0 else min([p for p in at if cut - overlap <= p < cut], default=cut - overlap)
        ends = [(p, s) for p, s in zip(at, strong) if cut < p <= start + limit]
        good = [p for p, s in ends if s and p > start + limit // 2]
        end = max(good) if good else max(p for p, _ in ends)
        out.append((int(start), int(end)))
        cut = end
    return out


@pytest.mark.parametrize("seed", range(30))
def test_pieces_follow_the_greedy_split(seed):
    rng = random.Random(seed)
    parts = ["слово", "два", "x" * 37, "конец.", "end!", "\n", "\n\n", "\r\n", " ", "  ", "é", "й"]
    text = "".join(rng.choice(parts) + rng.choice([" ", " ", "\n", ""]) for _ in range(rng.randint(20, 150)))
    limit, overlap = 60, 15
    got = split.pieces(text, limit, overlap)
    assert got == naive_pieces(text, limit, overlap) or len(text) <= limit
    assert got[0][0] == 0 and got[-1][1] == len(text)
    for (a, b), (c, d) in zip(got, got[1:]):
        assert b - a <= limit and d - c <= limit and b - overlap <= c <= b < d


def test_pieces_without_boundaries():
    got = split.pieces("ж" * 10_000)
    assert all(b - a <= 3000 for a, b in got) and got[-1][1] == 10_000 and all(c == b - 200 for (_, b), (c, _) in zip(got, got[1:]))


def test_split_pages(spark):
    long = "Предложение номер. " * 400
    df = spark.createDataFrame([(1, 1, long), (1, 1, long), (1, 2, "short"), (2, None, long), (None, 3, long + "!"), (3, 1, None), (4, 1, ""), (1, 1, long + "x")], "doc_id bigint, page_number int, full_text string")
    out = split.split_pages(clashing(df))
    assert rows(out.where("piece_no = 1"), "doc_id", "page_number", "version") == sorted([(1, 1, 1), (1, 1, 2), (2, None, 1), (None, 3, 1)], key=str)
    whole = rows(out.where("doc_id = 2").orderBy("piece_no"), "piece_no", "start", "end", "piece")
    assert all(long[a:b] == p for _, a, b, p in whole)
    assert split.split_pages(df.where("false")).count() == 0


# --- tokens
@pytest.fixture(scope="module")
def reference():
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(f"{tokens.TOKENIZERS}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


def by_parts(text, distance):
    encode, out, end = tokens.encoder(), [], 0
    for a, b, _ in tokens.parts(text, distance):
        assert a == end < b
        out, end = out + encode(text[a:b]), b
    assert end == len(text)
    return out


def test_ids_by_parts_are_the_tokenizers_own(reference):
    rng = random.Random(5)
    some = ["слово", "word", "don't", "I'M", " ", "  ", "\n", "\r\n", "\t", "\u00a0", "\u3000", "123", "№ 5", "<|endoftext|>", "e\u0301", "й", "😀", "—", "…", "x" * 50, "'s", " '", "\u200b", "\x1c", "\x85", "Ｆｕｌｌ"]
    for k in range(600):
        text = "".join(rng.choice(some) + rng.choice(["", " "]) for _ in range(rng.randint(0, 60)))
        assert by_parts(text, rng.choice([1, 2, 8, 40])) == reference(text), text
    for text in (" ".join(["повтор"] * 30_000), "x" * 5000, " " * 5000, "а б " * 5000):
        assert by_parts(text, 64) == reference(text)


def test_equal_passages_are_cut_alike():
    rng = random.Random(1)
    passage = " ".join("".join(rng.choice("абвгдежз") for _ in range(rng.randint(1, 9))) for _ in range(3000))
    one, two = "Начало документа. " + passage, "x yy zzz " * 40 + passage + " конец"
    shared = [{t[a:b] for a, b, s in tokens.parts(t, 128) if s} for t in (one, two)]
    assert len(shared[0] & shared[1]) >= len(shared[0]) - 2 > 50


def test_encode_corpus(spark, reference):
    df = spark.createDataFrame([(1, "Система  управления\r\n"), (2, ""), (3, None), (3, None), (4, "  \n"), (None, "x")], "doc_id bigint, text string")
    got = rows(tokens.encode_corpus(clashing(df)))
    assert (2, []) in got and got.count((3, [])) == 2 and (1, reference("Система  управления\r\n")) in got and (4, reference("  \n")) in got and len(got) == 6
    assert tokens.encode_corpus(df.where("false")).count() == 0
    long = [(i, " ".join(f"слово{(k * k) % 97} строка" for k in range(400)) + "  \n" * (i % 3) + "т" * i) for i in range(12)]
    ids = dict(rows(tokens.encode_corpus(spark.createDataFrame(long, "doc_id bigint, text string"), distance=64)))
    assert ids == {i: reference(t) for i, t in long}


# --- containers
def test_containers(spark):
    rng = random.Random(2)
    items = [(i, rng.choice([0, 1, 7, 300, 900, 2048, 2049, 5000, rng.randint(1, 700)])) for i in range(3000)] + [(9999, None), (None, 5), (5, 40)]
    df = spark.createDataFrame(items, "doc_id bigint, tokens int").repartition(7)
    out = packing.pack(clashing(df)).collect()
    total = sum(t for d, t in items if d is not None and t)
    assert sum(r["tokens"] for r in out) == total
    by = {}
    for r in out:
        by.setdefault(r["container"], []).append(r)
    assert all(sum(r["tokens"] for r in rs) == rs[0]["used"] <= 2048 for rs in by.values())
    split_ids = {r["doc_id"] for r in out if r["part_no"] > 1}
    assert split_ids == {d for d, t in items if d is not None and t and t > 2048}
    assert len(by) <= -(-total // 2048) * 1.03 + 1
    assert packing.pack(df.where("false")).count() == 0


def test_no_container_is_left_behind(spark, monkeypatch):
    """More open containers than a task takes on, sorted so that those that fill each other begin far apart."""
    monkeypatch.setattr(packing, "CARRY", 40)
    df = spark.createDataFrame([(i, 1500 if i < 400 else 548) for i in range(800)], "doc_id bigint, tokens int").repartitionByRange(6, "doc_id")
    out = packing.pack(df)
    assert out.select("container").distinct().count() <= 420 and out.count() == 800
    stuck = spark.createDataFrame([(i, 1100) for i in range(300)], "doc_id bigint, tokens int")
    assert packing.pack(stuck).select("container").distinct().count() == 300


def test_best_fit_takes_the_fullest_container():
    assert packing.best_fit([6, 5, 4, 4, 1], 10) == [[0, 2], [1, 3, 4]]


# --- look-alikes
@pytest.mark.parametrize(
    ("text", "form"),
    [
        ("ＡＳＵ", "ASU"), ("cистeмa", "система"), ("gatеwаy", "gateway"), ("Ρешение", "Решение"), ("схе​ма", "схема"), ("до­кумент", "документ"), ("а б", "а б"), ("отчйт", "отчйт"),
        ("SQL‑запрос", "SQL-запрос"), ("SQL-запрос", "SQL-запрос"), ("β-модуль", "β-модуль"), ("Wi-Fi сеть", "Wi-Fi сеть"), ("№ 5 «Ёж»…", "№ 5 «Ёж»…"), ("a\tb\nc", "a\tb\nc"), ("Café", "Café"), ("", ""),
        ("узел o связи", "узел о связи"), ("\u1112\u1161\u11ab\u1100\u1161", "\ud55c\uac00"), ("\u0b47\u0b3e", "\u0b4b"), ("АРI-ключ", "API-ключ"), ("ﬁnal", "final"),
    ],
)
def test_consistent_form(text, form):
    assert lookalikes.consistent(text) == form
    assert lookalikes.consistent(form) == form


def test_the_form_is_the_same_in_every_process():
    """Words with as much of one alphabet as of another, under several seeds of string hashes."""
    code = "from lexmill.llm.lookalikes import consistent; print(ascii([consistent(t) for t in ('\\u0391c', 'c\\u03b2', 'P\\u0391', '\\uff21\\u03b2', '\\u0391\\u0441', '\\u03b2A-\\u0439A')]))"
    forms = {subprocess.run([sys.executable, "-c", code], env=os.environ | {"PYTHONHASHSEED": str(seed), "PYTHONPATH": os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))}, capture_output=True, text=True, check=True).stdout.strip() for seed in range(6)}
    assert forms == {ascii(["Ac", "cb", "PA", "Ab", "\u0410\u0441", "bA-\u0439\u0410"])}


def test_quick_check_misses_nothing(spark):
    rng = random.Random(8)
    chars = list("абвAPcе -«»№…—éйЁβΑ0\t\n") + ["​", "­", " ", "　", "̆", "Ａ", "ﬁ", "‑", "²", "ⅷ", "і"]
    texts = ["".join(rng.choice(chars) for _ in range(rng.randint(0, 9))) for _ in range(3000)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, "x"), (3, None)], "id bigint, term string")
    got = {r["row_id"]: r["canonical"] for r in lookalikes.consistent_form(clashing(df), "id", "term").collect() if r["row_id"] is not None and r["value"] is not None}
    assert all(got[i] == lookalikes.consistent(t) for i, t in enumerate(texts))
    assert {r[0] for r in lookalikes.inconsistent(df, "id", "term").collect()} == {i for i, t in enumerate(texts) if lookalikes.consistent(t) != t}
    assert lookalikes.inconsistent(df.where("false"), "id", "term").count() == 0


# --- versions
def words_of(text):
    return set(re.findall(r"[^\W_]+", text.lower()))


def brute(data):
    out = set()
    for i, a in data:
        for j, b in data:
            if i < j and a and b and words_of(a) and words_of(b) and re.sub(r"[\W_]+", "", a.lower()) != re.sub(r"[\W_]+", "", b.lower()):
                both = len(words_of(a) & words_of(b))
                if both >= 0.8 * len(words_of(a) | words_of(b)) - 1e-9:
                    out.add((i, j))
    return out


@pytest.mark.parametrize(("rare", "crowd"), [(32, 200), (8, 40)])
def test_versions_are_all_similar_pairs(spark, monkeypatch, rare, crowd):
    monkeypatch.setattr(versions, "RARE", rare)
    monkeypatch.setattr(versions, "CROWD", crowd)
    rng = random.Random(rare)
    vocabulary = [f"w{i}" for i in range(60)]
    data = []
    for _ in range(40):
        base = rng.choices(vocabulary, k=rng.choice([1, 2, 3, 4, 5, 9, 17, 30, 120]))
        for _ in range(rng.randint(1, 5)):
            text = list(base)
            for _ in range(rng.randint(0, max(1, len(text) // 8))):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                rng.shuffle(text)
            data.append((len(data), " ".join(text)))
    data += [(900, None), (901, ""), (902, "..."), (903, "w1 W1"), (904, "w1")]
    df = spark.createDataFrame(data, "id bigint, value string").withColumn("source_table", F.lit("t"))
    got = {(a, b) for _, a, b in rows(versions.version_pairs(clashing(df)))}
    assert got == brute(data)
    groups = {i: g for _, i, g, _ in rows(versions.version_groups(df))}
    for a, b in got:
        assert groups[a] == groups[b]
    assert groups.keys() == {i for i, t in data if t and words_of(t)}
    assert all(groups[g] == g and g <= i for i, g in groups.items())


@pytest.mark.parametrize("size", [5, 6])
def test_crowded_versions_of_different_sizes_meet(spark, monkeypatch, size):
    monkeypatch.setattr(versions, "RARE", 2)
    monkeypatch.setattr(versions, "CROWD", 5)
    base = [f"w{i}" for i in range(size)]
    data = [(0, " ".join(base))] + [(i, " ".join([*base, f"x{i}"])) for i in range(1, 13)]
    df = spark.createDataFrame(data, "id bigint, value string").withColumn("source_table", F.lit("t"))
    got = {(a, b) for _, a, b in rows(versions.version_pairs(df))}
    assert got == brute(data) and {(0, i) for i in range(1, 13)} <= got


def meet_locally(data, rare, crowd, threshold=0.8):
    """The steps of ``similar`` on word sets, with dictionaries in place of joins: pairs that meet in a variant."""
    counts = {}
    for w in data.values():
        for x in w:
            counts[x] = counts.get(x, 0) + 1
    frequent = sorted((w, n) for w, n in counts.items() if n > rare)
    frequent = np.array([w for w, _ in frequent], dtype=np.int64), np.array([n for _, n in frequent], dtype=np.int64)
    found, known, step = set(), {c: set() for c in data}, 0
    asked = list(data)
    while asked:
        frame = pd.DataFrame({"tab": 0, "cid": asked, "words": [data[c] for c in asked], "crowded": [sorted(known[c]) for c in asked]})
        by = {}
        for out in versions._variants(iter([frame]), frequent, threshold, step):
            for key, c, n, size in zip(out["key"], out["cid"], out["n"], out["size"]):
                by.setdefault((key, size), {})[c] = n
        asked = set()
        for (key, size), held in by.items():
            if len(held) > crowd:
                for c in held:
                    known[c].add(key)
                    asked.add(c)
            most = (1 + threshold) / threshold * size + 1e-9
            found |= {(a, b) for a in held for b in held if a < b and (len(held) <= crowd or held[a] + held[b] <= most)}
        asked, step = sorted(asked), step + 1
    return found


@pytest.mark.parametrize("seed", range(12))
@pytest.mark.parametrize(("rare", "crowd"), [(1, 2), (4, 10), (0, 1)])
def test_every_similar_pair_meets_whatever_is_crowded(seed, rare, crowd):
    rng = random.Random(seed)
    data = {i: sorted(rng.sample(range(-20, 20), rng.randint(1, rng.choice([5, 7, 12])))) for i in range(120)}
    for i in range(120, 200):
        base = set(data[rng.randrange(i)]) ^ set(rng.sample(range(-20, 20), rng.randint(0, 2)))
        data[i] = sorted(base) or [1]
    similar = {(a, b) for a in data for b in data if a < b and len(set(data[a]) & set(data[b])) >= 0.8 * len(set(data[a]) | set(data[b])) - 1e-9}
    assert similar <= meet_locally(data, rare, crowd)


def test_crowded_versions_of_few_words():
    """Texts of six words around one of five, whose common variants are all crowded."""
    pool = range(10, 22)
    data = dict(enumerate([[1, 2, 3, 4, 5]] + [[1, 2, 3, 4, 5, v] for v in pool] + [[1, 2, 3, 4, v] for v in pool] + [[1, 2, u, v] for u in pool for v in pool if u < v] + [[3, 4, 5, u, v] for u in pool for v in pool if u < v]))
    similar = {(a, b) for a in data for b in data if a < b and len(set(data[a]) & set(data[b])) >= 0.8 * len(set(data[a]) | set(data[b])) - 1e-9}
    met = meet_locally(data, 4, 10)
    assert similar <= met and {(0, k) for k in range(1, 13)} <= similar


def test_a_long_crowded_text(monkeypatch):
    """Extensions of a text of 1,200 frequent words come in batches and only of its crowded variants."""
    monkeypatch.setattr(versions, "_BATCH", 20_000)
    words = sorted(range(1, 1201))
    frequent = np.array(words), np.array([1000 + w for w in words])
    frame = pd.DataFrame({"tab": [1], "cid": [5], "words": [words], "crowded": [[]]})
    first = pd.concat(list(versions._variants(iter([frame]), frequent, 0.8, 0)))
    two = first[first["size"] == 2]
    assert len(two) == 242 * 241 // 2 and first["key"].is_unique
    frame["crowded"] = [two["key"].tolist()]
    more = list(versions._variants(iter([frame]), frequent, 0.8, 1))
    assert sum((b["size"] == 3).sum() for b in more) == sum(243 - j for j in range(2, 243) for _ in range(j - 1)) and max(map(len, more)) < 5_000_000


def shuffled(spark, run):
    """What ``run`` returns, and the records that its stages shuffled."""
    sc = spark.sparkContext._jsc.sc()
    gateway = spark.sparkContext._gateway

    def stages():
        sc.listenerBus().waitUntilEmpty()
        kept = sc.statusStore().stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList())
        return {(s.stageId(), s.attemptId()): s.shuffleWriteRecords() for s in (kept.apply(i) for i in range(kept.size()))}

    before = stages().keys()
    out = run()
    return out, sum(n for k, n in stages().items() if k not in before)


def test_only_classes_that_meet_are_shuffled_again(spark, monkeypatch):
    """Every variant passes one exchange; the words of texts without a similar one pass none but that of their counts."""
    monkeypatch.setattr(versions, "RARE", 2)
    monkeypatch.setattr(versions, "CROWD", 5)
    lone = [(100 + i, [1000 + 5 * i + k for k in range(5)]) for i in range(3000)]
    crowd = [(0, list(range(6)))] + [(i, [*range(6), 100 + i]) for i in range(1, 13)]
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        reps = spark.createDataFrame([("t", c, c, w) for c, w in lone + crowd], "source_table string, cid bigint, k1 bigint, words array<bigint>")
        got, records = shuffled(spark, lambda: rows(versions.similar(reps), "a", "b"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert len(got) == 12 and all(a == 0 for a, _ in got)
    words, variants = 5 * len(lone), 4 * len(lone)
    assert words + variants <= records < words + variants + len(lone)


def test_marks_keep_every_class_asked_for(spark, monkeypatch):
    reps = spark.range(500).select((F.col("id") % 2 - 1).alias("tab"), F.col("id").alias("cid"), F.array("id").alias("words"))
    ids = reps.where("cid % 7 = 0").select("tab", "cid")
    assert rows(versions._marked(reps, ids.unionByName(ids), "t"), "cid") == [(i,) for i in sorted(range(0, 500, 7), key=lambda i: str((i,)))]
    assert versions._marked(reps, ids.where("false"), "t").count() == 0
    monkeypatch.setattr(versions, "MARKS", 64)
    assert {(i,) for i in range(0, 500, 7)} <= set(rows(versions._marked(reps, ids, "t"), "cid"))


def test_versions_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "source_table string, id bigint, value string")
    assert versions.version_pairs(empty).count() == 0 and versions.version_groups(empty).count() == 0


def test_versions_of_a_hot_class(spark):
    hot = spark.range(400).select(F.lit("t").alias("source_table"), "id", F.when(F.col("id") == 7, "один два три четыре пять шесть").otherwise("один два три четыре пять").alias("value"))
    got = rows(versions.version_pairs(hot), "id_a", "id_b")
    assert len(got) == 399 and all(7 in p for p in got)


# --- residue
@pytest.mark.parametrize(
    ("text", "case"),
    [
        ("404 Not Found — Request id 5b829a", True), ("Страница не найдена!\nКод обращения: 5839e30.", True), ("Please enable JavaScript to view this catalogue.", True),
        ("Для работы портала требуется поддержка скриптов и cookies.№ 28f0e05", True), ("Образец текста. Образец текста.\nTODO: добавить определение", True),
        ("Исполнитель: {{ definition }}. Согласовано: {{ date }}.", True), ("Уважаемый #ваш текст#! От #ВСТАВИТЬ ДАТУ#.", True), ("Дата: <УКАЖИТЕ НАИМЕНОВАНИЕ>.", True), ("%term% — %page_no%", True),
        ("В языке шаблонов двойные фигурные скобки, например {{ doc_title }}, обозначают подстановку.", False), ('for f in "${BATCH_DIR}"/*.pdf; do sha256sum "$f"; done', False),
        ("Служба отдала ответ 404 для 763 файлов; причиной стала замена оборудований, ссылки исправлены.", False), ("Шаг 4. Откройте настройки браузера, включите JavaScript и убедитесь, что форма отображается.", False),
        ("Макет содержал текст-заполнитель Lorem ipsum на 4 страницах, редактор заменил его содержанием модулей.", False), ("Ipsen nibra nibra perindi amini amini perindi ipsen perindi perindi ipsen labelli ipsen sactae.", True),
        ('{"abbreviations": [], "terms": []}', False), ("See section 4.2 on the rendering of a secondary queue.", False), ("", False), ("  ", False), (None, False),
    ],
)
def test_residue(spark, text, case):
    df = spark.createDataFrame([(1, text, None), (1, text, "s"), (None, text, "s")], "doc_id bigint, text string, source string")
    assert (rows(residue.residue(clashing(df)), "doc_id") == [(1,)]) is case
    assert residue.content(df).count() == (1 if case else 3)


LOREM = "Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt ut labore et dolore magna aliqua."
PARAGRAPH = LOREM + " Ut enim ad minim veniam, quis nostrud exercitation ullamco laboris nisi ut aliquip ex ea commodo consequat. Duis aute irure dolor in reprehenderit in voluptate velit esse cillum dolore eu fugiat nulla pariatur."


@pytest.mark.parametrize(
    ("text", "case"),
    [
        ("Образец текста. " * 200, True), ("Страница не найдена.\n" + "Главная | Поиск | Контакты\n" * 80 + "Повторите попытку.", True), (LOREM, True), (PARAGRAPH, True), (PARAGRAPH * 9, True),
        ("Журнал хранится в архиве и ведётся по разделам. " * 60 + "Страница не найдена.", False), ("Lorem ipsum is the usual filler of printers, and the editor has replaced it with the text of the modules.", False),
    ],
)
def test_residue_of_long_messages_and_sentences(spark, text, case):
    test_residue(spark, text, case)


def test_widely_recurring_messages_need_less_evidence(spark):
    unseen = "Упс, сбой на нашей стороне ({}). Попробуйте зайти позже."
    data = [(i, unseen.format(i), f"s{i % 12}") for i in range(60)] + [(100 + i, "Отчёт о сбоях за квартал сдан в архив.\nОшибки учтены в журнале.\nПлан работ утверждён.\nСостав приложен.", f"s{i % 12}") for i in range(60)]
    data += [(200, "Сбой в узле связи устранён за 4 часа.", "s1"), (201, "Порядок дан в разделе 2. Скобки, например {{ title }}, обозначают подстановку. Журнал ведётся.", "s1")]
    df = spark.createDataFrame(data, "doc_id bigint, text string, source string")
    assert rows(residue.residue(clashing(df)), "doc_id") == sorted([(i,) for i in range(60)], key=str)
    assert residue.residue(df.where("doc_id < 60 and source = 's1'")).count() == 0  # in one source it is a text like any other


def test_residue_of_an_empty_table(spark):
    assert residue.residue(spark.createDataFrame([], "doc_id bigint, text string, source string")).count() == 0


# --- truncation
def test_limits_and_endings(spark):
    rng = random.Random(4)
    words = ["система", "порядок", "журнал", "модуль", "отчёт", "процесс"]
    sentence = lambda: f"{rng.choice(words).capitalize()} {rng.choice(words)} {rng.randint(1, 10 ** rng.randint(1, 12))} применяется без участия {rng.choice(words)} и хранится в составе {rng.choice(words)}."
    data = []
    for i in range(900):
        text = " ".join(sentence() for _ in range(rng.randint(1, 4)))
        source = "short" if i % 3 == 0 else "long"
        data.append(("terms", i, source, text[:100] if source == "short" else text))
    cut_ids = {i for _, i, s, t in data if s == "short" and not t.endswith(".")}
    data += [("terms", 1001, "long", "Система применяется без участ"), ("terms", 1002, "long", "Система журнал применяется без"), ("terms", 1003, "long", "Система применяется (модуль"), ("terms", 1004, None, "Журнал хранится в составе модуль"),
             ("terms", 1005, None, None), ("terms", 1006, "long", " "), ("terms", 1007, "long", "Модуль�"), ("terms", 1001, "long", "Система применяется без участ")]
    df = spark.createDataFrame(data, "field string, row_id bigint, source string, text string")
    limits = rows(truncation.limits(df.where("trim(text) <> ''")), "source", "unit", "size")
    assert ("short", "chars", 100) in limits and not any(s == "long" and u == "chars" for s, u, _ in limits)
    found = {i for _, i in rows(truncation.truncated(clashing(df)), "field", "row_id")}
    assert cut_ids | {1001, 1002, 1003, 1007} <= found and not found & {1004, 1005, 1006}
    assert found - cut_ids == {1001, 1002, 1003, 1007}
    shares = {s: c for _, s, _, c, _ in rows(truncation.shares(df))}
    assert shares["short"] == len(cut_ids)


def test_recurring_cuts_are_found_and_recurring_names_are_not(spark):
    whole = [f"Канал {w} номер {i} хранится со сроком хранения до года." for i, w in enumerate(["связи", "учёта", "записи"] * 200)]
    cuts = [f"Опытный канал {'а' * (i % 7)}б номер {i} хранится со сроком хра" for i in range(12)]
    apart = [f"Знак {i} хра стоит отдельно, как видно здесь." for i in range(4)]  # the fragment as a word, 4 among 600 longer ones
    names = [f"Опытный канал {'а' * (i % 7)}в номер {i} хранится на площадке вуханофорис драфоседруйка" for i in range(12)]
    texts = whole + cuts + apart + names + ["Архивный канал хранится на складе бумаги и там без учё"] * 9 + ["Канал хранится без учёта и описи."] * 40
    df = spark.createDataFrame([("terms", i, None, t) for i, t in enumerate(texts)], "field string, row_id bigint, source string, text string")
    found = {texts[i] for _, i in rows(truncation.truncated(df), "field", "row_id")}
    assert set(cuts) <= found and not found & set(names + whole + apart) and "Архивный канал хранится на складе бумаги и там без учё" in found


def test_dots_announced_numbers_and_fixed_messages(spark):
    whole = [f"Канал {w} номер {i} хранится согласно таблице на стр. {i % 70}." for i, w in enumerate(["связи", "учёта", "записи"] * 100)]
    cuts = ["Канал связи номер 7 хранится сог...", "Канал записи хранится согласно таблице на стр.", "Канал учёта хранится и…"]
    fixed = ["Сброшено: зависшая обработка"] * 50 + [f"Обработка номер {i} сброшена, как видно здесь." for i in range(60)]
    texts = whole + cuts + fixed + ["Канал связи и прочие сведения и т. п.", "Журнал на 40 стр."]
    df = spark.createDataFrame([("terms", i, f"s{i % 3}", t) for i, t in enumerate(texts)], "field string, row_id bigint, source string, text string")
    assert {texts[i] for _, i in rows(truncation.truncated(df), "field", "row_id")} == set(cuts)


def test_a_limit_in_bytes_is_none_in_characters(spark):
    rng = random.Random(6)
    data = []
    for i in range(1500):
        text = "".join(rng.choice("абвгде ") for _ in range(rng.randint(40, 400)))
        data.append(("terms", i, "s", text.encode()[:255].decode(errors="replace") if i % 2 else text))
    df = spark.createDataFrame(data, "field string, row_id bigint, source string, text string")
    assert {(u, n) for u, n in rows(truncation.limits(df).where("not whole"), "unit", "size")} <= {("bytes", 254), ("bytes", 255)}


def test_each_text_is_cleaned_once_and_travels_no_further(spark, monkeypatch):
    plans, columns, cut = {}, {}, truncation.cut
    monkeypatch.setattr(truncation, "cut", lambda df, label: (plans.update({label: df._jdf.queryExecution().optimizedPlan().toString()}), columns.update({label: df.columns}), cut(df, label))[2])
    df = spark.createDataFrame([("terms", 1, "s", "Система применяется без участ"), ("terms", 2, "s", "Система применяется.")], "field string, row_id bigint, source string, text string")
    truncation.truncated(df).collect()
    cleanings = {label: plan.count("(?<=\\p{L})[-") for label, plan in plans.items()}
    assert cleanings["pairs"] == 1 and cleanings["doubtful"] == 2  # to judge all, and for those kept
    assert not {"text", "clean"} & set(columns["doubtful"])


def test_short_ways_of_truncation_equal_the_long_ones(spark):
    rng = random.Random(11)
    pieces = ["а", "Б", "e", "т. п.", "стр.", " стр.", "5", "²", "#", "#.", ".", "...", "…", ",", ":", "-", "‐", "¬", " ", "\n", "\t", "\x85", "\u2028", "\xa0", "\u3000", "\xad", "\u200b", "\ufeff", "\ufffd", ")", "(", "»", "\"", "0", "0.5", "1:2", "İ", "е\u0301", "😀", ").)"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 14))) for _ in range(6000)] + ["Конец." + "»" * n for n in (1, 22, 23, 24, 25, 40)] + ["слово-\nслово", "слово \x85", "слово \u2028", "я" * 30 + ".pdf"]
    clean = F.regexp_replace("t", r"(?<=\p{L})[-‐‑¬\x{AD}]\s+(?=\p{Ll})", "")
    clean = F.regexp_replace(F.regexp_replace(clean, r"[\x{AD}\x{200B}-\x{200D}\x{2060}\x{FEFF}]", ""), r"[\s\x{A0}\x{2000}-\x{200A}\x{202F}\x{3000}]+$", "")
    tokens_ = F.transform(F.regexp_extract_all(F.lower("t"), F.lit(r"(\p{N}+(?:[.,:]\p{N}+)*|[\p{L}\p{M}]+|[^\s\p{L}\p{M}\p{N}])"), 1), lambda t: F.regexp_replace(t, r"\p{N}+", "#"))
    t = F.col("t")
    closed = t.rlike(r"[.!?;][\"»”')\]]*$|\.\p{L}{2,4}$") & ~t.rlike(truncation._ABBREVIATIONS) & ~t.rlike(truncation._DOTS)
    df = spark.createDataFrame([(x,) for x in texts], "t string")
    got = df.select("t", truncation.cleaned(t), clean, truncation._tokens(t), tokens_, truncation._closed(t), closed).collect()
    assert [r[0] for r in got if (r[1], r[3], r[5]) != (r[2], r[4], r[6])] == []
    assert len({r[5] for r in got}) == 2 and any(r[0] != r[1] for r in got)


def test_truncation_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "field string, row_id bigint, source string, text string")
    assert truncation.truncated(empty).count() == 0 and truncation.shares(empty).count() == 0


# --- encodings
CLEAN = ["Журнал хранения основных процедур", "Методика проверки сетевых модулей", "Паспорт настройки контрольных систем", "Инструкция обработки плановых отчётов", "Регламент учёта рабочих объектов"]
SWAPS = [("cp1251", "cp1252"), ("cp1251", "cp866"), ("cp866", "cp1251"), ("cp866", "cp437"), ("koi8-r", "cp1251"), ("utf-8", "cp1251"), ("utf-8", "cp866")]


def test_garbled_names_are_restored(spark):
    data = [(i, "filename", f"s{i % 4}", f"{CLEAN[i % 5]} {i}.pdf") for i in range(200)]
    origin = {}
    for k, (written, read) in enumerate(SWAPS):
        for j, text in enumerate(CLEAN):
            try:
                garbled = text.encode(written).decode(read)
            except UnicodeDecodeError:
                continue
            origin[1000 + 10 * k + j] = text
            data.append((1000 + 10 * k + j, "title", "s1", garbled))
    twice = "Порядок".encode().decode("latin-1").encode().decode("latin-1")
    origin[2000] = "Порядок"
    data.append((2000, "title", None, twice))
    origin[2001] = "Журнал хранения систем"
    data.append((2001, "title", "s2", "Журнал " + "хранения систем".encode().decode("cp1251", "replace").replace("�", "\x98")))
    legit = ["Résumé 60", "Größenliste 8", "Ґанок і під'їзд", "Звіт із їзди", "Тізім № 4 ү", "Џеп Ђурђа", "Допуск ±7° α-2 §25", "plan_ledger_2023", "АРХИВ «КОНТУР»", "", None]
    data += [(3000 + i, "title", "s1", t) for i, t in enumerate(legit)]
    df = spark.createDataFrame(data, "id bigint, field_name string, source string, value string")
    got = {r["id"]: r["restored"] for r in mojibake.restore(clashing(df.drop("value_")).select(df.columns)).collect()}
    assert set(got) == set(origin)
    wrong = {i: (got[i], t) for i, t in origin.items() if got[i] != t}
    assert len(wrong) <= len(origin) * 0.1, wrong


def ciphered(text, key):
    return "".join(key.get(c, c) for c in text)


@pytest.mark.parametrize("seed", range(4))
def test_an_unknown_swap_is_deciphered(seed):
    """Pair counts under a random exchange of letters, with the bigrams of the same language."""
    rng = random.Random(seed)
    words = [w for t in CLEAN for w in re.findall("[А-Яа-яё]+", t)]
    index = mojibake._index()
    counts = np.full((len(mojibake.LETTERS) + 1,) * 2, 0.02)
    text = rng.choices(words, k=1500)
    for w in text:
        for a, b in zip([0, *(index[c] for c in w)], [*(index[c] for c in w), 0]):
            counts[a, b] += 1
    model = np.log(counts / counts.sum(axis=1, keepdims=True))
    seen = sorted({index[c] for w in words for c in w})
    place = {c: k + 1 for k, c in enumerate(rng.sample(seen, len(seen)))}
    pairs = np.zeros((len(seen) + 1,) * 2)
    for w in rng.choices(words, k=600):
        for a, b in zip([0, *(place[index[c]] for c in w)], [*(place[index[c]] for c in w), 0]):
            pairs[a, b] += 1
    got = mojibake.decipher(pairs, model)
    assert got is not None and sum(got[place[c]] == c for c in seen) >= 0.9 * len(seen)
    noise = np.random.default_rng(seed).integers(0, 9, pairs.shape).astype(float)
    assert mojibake.decipher(noise, model) is None and mojibake.decipher(np.minimum(pairs, 1) * 0.2, model) is None


def test_a_source_with_an_unknown_swap_is_restored(spark):
    rng = random.Random(9)
    words = [w for t in CLEAN for w in t.split()]
    name = lambda: " ".join(rng.choice(words) for _ in range(4))
    small, large = "абвгдежзийклмнопрстуфхцчшщъыьэюяё", "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯЁ"
    key = dict(zip(small, rng.sample(small, 33))) | dict(zip(large, rng.sample(large, 33)))
    data = [(i, "title", f"s{i % 8}", name()) for i in range(400)]
    origin = {1000 + i: name() for i in range(60)}
    data += [(i, "title", "odd", ciphered(t, key)) for i, t in origin.items()]
    df = spark.createDataFrame(data, "id bigint, field_name string, source string, value string")
    got = {r["id"]: r["restored"] for r in mojibake.restore(df).collect()}
    assert len(set(got) & set(origin)) >= 55 and not set(got) - set(origin)
    assert sum(got.get(i) == t for i, t in origin.items()) >= 50


def test_encodings_of_an_empty_table(spark):
    assert mojibake.restore(spark.createDataFrame([], "id bigint, field_name string, source string, value string")).count() == 0


# --- scans
def scan_values(spark, data):
    return spark.createDataFrame(data, "source_table string, field_name string, row_key string, doc bigint, text string")


def test_scan_noise(spark):
    body = ["порядок проверки сетевого модуля на основе контрольных данных", "методика хранения основного журнала без участия системы", "система проверки и хранения данных журнала"]
    data = [("terms", "definition", str(i), i % 9, body[i % 3]) for i in range(120)]
    data += [("ocr_pages", "full_text", f"50:{p}", 50, f"РЕГЛАМЕНТ ЗАМЕНЫ ШАБЛОНОВ\n{body[p % 3]}\nи далее {p}.\n\n{body[0]} на стр. 7.\n— {p} —") for p in range(1, 6)]
    noisy = {
        "901": ("порядок про-\nверки модуля", {"hyphenation"}), "902": ("порядок прове- рки модуля", {"hyphenation"}), "903": ("пор9док проверки", {"misread"}), "904": ("мeтодика хранения", {"misread"}),
        "905": ("порядок хра/1ения журнала", set()), "906": ("порядок проверки\n[12]\nмодуля", {"page_number"}), "907": ("методика хранения согласно форме А376ГМ6 и таблице на стр. 5", set()),
        "908": ("научно-технический журнал", set()), "909": ("чёрно- и белый журнал", set()), "910": ("журналу", set()),
    }
    data += [("terms", "definition", k, 3, t) for k, (t, _) in noisy.items()]
    data += [("terms", "definition", "950", 3, None), ("terms", "definition", "951", None, "порядок"), ("terms", "definition", "951", None, "порядок"), ("ocr_pages", "full_text", "60:1", 60, "слово " * 30_000), ("ocr_pages", "full_text", "61:1", 61, "")]
    found = {}
    for _, _, k, d in rows(scans.defects(clashing(scan_values(spark, data)))):
        found.setdefault(k, set()).add(d)
    for k, (t, want) in noisy.items():
        if k != "905":
            assert found.get(k, set()) == want, (k, t, found.get(k))
    assert all(found[f"50:{p}"] == {"running_header", "page_number"} for p in range(1, 6))
    assert not {"950", "951", "60:1", "61:1"} & set(found)
    fixed = {r["row_key"]: r["text"] for r in scans.repaired(scan_values(spark, data)).collect()}
    assert fixed["901"] == fixed["902"] == "порядок проверки модуля" and fixed["903"] == "порядок проверки" and fixed["906"] == "порядок проверки модуля"
    assert "РЕГЛАМЕНТ" not in fixed["50:2"] and "— 2 —" not in fixed["50:2"] and fixed["50:2"].startswith(f"{body[2]} и далее 2.")


def test_the_word_before_chooses_the_form(spark):
    """Two frequent forms of one skeleton, a misreading of both, and a heading within a page."""
    text = ["новые дома строят", "железного лома собрано много", "порядок работы"]
    data = [("terms", "definition", str(i), i, text[i % 3 if i % 5 else 0]) for i in range(200)]
    data += [("terms", "definition", "901", 1, "новые пoма строят"), ("terms", "definition", "902", 1, "железного пома собрано")]
    page = "ЖУРНАЛ УЧЁТА\n" + "порядок работы\n" * 5 + "ЖУРНАЛ УЧЁТА\n" + "порядок работы\n" * 5 + "ЖУРНАЛ УЧЁТА"
    data += [("ocr_pages", "full_text", f"7:{p}", 7, page) for p in range(1, 4)]
    df = scan_values(spark, data)
    fixed = {r["row_key"]: r["text"] for r in scans.repaired(df).collect()}
    assert fixed["901"] == "новые дома строят" and fixed["902"] == "железного лома собрано"
    assert {"901", "902"} <= {k for k, d in rows(scans.defects(df), "row_key", "defect") if d == "misread"}
    assert fixed["7:1"].count("ЖУРНАЛ УЧЁТА") == 1


def test_scans_of_an_empty_table(spark):
    empty = scan_values(spark, [])
    assert scans.defects(empty).count() == 0 and scans.repaired(empty).count() == 0
