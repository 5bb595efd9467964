"""Quality rules, language and toxicity."""

import random
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
from pyspark.sql import functions as F

from skyweave.llm import toxicity as spelling
from skyweave.llm.langid import SAMPLE_TEXTS, UNKNOWN, Sizes, dictionaries, language, plain
from skyweave.llm.quality import LineLimits, filtered, quality, without_lines
from skyweave.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measures(text):
    text = text or ""
    words = WORD.findall(text)
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if times[w] > 1 for j in range(5)}
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered), failed


SCHEMA = "doc_id long, text string, source string, lines string, row_id int"


def test_measures(spark, workspace):
    rng = random.Random(2)
    parts = ["a", "b", "é€", "#*", "x|y", " ", "  ", "\t", "\n", "\n\n", "\x0b", "\xa0", "a b c d e f"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 120))) for _ in range(400)] + [None, "", "w " * 5000]
    rows = [(i, t, rng.choice(["s", "t", None]), "x", 1) for i, t in enumerate(texts)]
    for r in quality(spark.createDataFrame(rows, SCHEMA), workspace).collect():
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert got == measures(texts[r.in_doc_id])
        assert not (r.base_failed and r.kept)


def hosted():
    rng = random.Random(5)
    fresh = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    rows = [(i, "Menu Home About\n" + fresh(40), "a", "x", 1) for i in range(30)]
    rows += [(100 + i, f"menu  home ABOUT\n{fresh(1)}\nw w2 w3\n{fresh(1)}\nv v2 v3\n{fresh(1)}", "a", "x", 1) for i in range(12)]
    copy = "\n".join(fresh(12) for _ in range(3))
    rows += [(200 + i, copy, "a", "x", 1) for i in range(60)]
    rows += [(300 + i, "Menu Home About\n" + fresh(12), "b", "x", 1) for i in range(3)]
    return rows


def test_lines_of_a_host(spark, workspace):
    limits = LineLimits(documents=10, share=0.01, left_words=4, left_share=0.1)
    found = quality(spark.createDataFrame(hosted(), SCHEMA), workspace, limits=limits)
    for r in found.withColumn("clean", without_lines(F.col("in_text"), F.col("removed_lines"))).collect():
        depleted = 100 <= r.in_doc_id < 200
        assert r.kept == (not depleted), r.in_doc_id
        shared = r.in_doc_id < 30
        if shared:
            assert r.removed_words == 3 and r.clean == r.in_text.split("\n", 1)[1]
        if 200 <= r.in_doc_id:
            assert r.removed_words == 0 and r.clean == r.in_text


def test_lines_count_distinct_documents(spark, workspace):
    """Documents that are mostly shared lines are distinct documents, however alike; copies are one."""
    rng = random.Random(6)
    fresh = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    shared = [fresh(10) for _ in range(10)]
    rows = [(i, "\n".join([*shared, fresh(10)]), "a", "x", 1) for i in range(150)]
    lone = "\n".join(fresh(12) for _ in range(3))
    rows += [(200 + i, lone.replace(" ", " " * (1 + i % 2)), "a", "x", 1) for i in range(150)]
    for r in quality(spark.createDataFrame(rows, SCHEMA), workspace).collect():
        depleted = r.in_doc_id < 200
        assert r.removed_words == (100 if depleted else 0)
        assert r.kept == (not depleted)


def boilerplate(rows):
    """Brute force of the registered limits: the lines that go, by host; and a text's words, removed words and verdict."""
    normal = lambda line: " ".join(WORD.findall(line)).lower()
    distinct = {}
    for text, host in rows:
        lines = tuple(x for x in map(normal, (text or "").split("\n")) if x)
        distinct.setdefault(host, set()).add(lines)
    gone = {}
    for host, texts in distinct.items():
        times = Counter(x for lines in texts for x in set(lines))
        gone[host] = {x for x, n in times.items() if n > 5 and (100 * n > len(texts) or n > 100)}

    def judge(text, host):
        words = len(WORD.findall(text or ""))
        removed = sum(len(WORD.findall(x)) for x in (text or "").split("\n") if normal(x) in gone[host])
        left = words - removed
        return removed, not measures(text)[-1] and not (removed and (left < 5 or left < 0.1 * words))

    return gone, judge


def test_lines_at_the_registered_limits(spark, tmp_path):
    rng = random.Random(7)
    fresh = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    rows = [(i, "Menu Home\n" + fresh(20), "small") for i in range(8)]
    rows += [(10 + i, f"Menu  HOME\n{fresh(3)}", "small") for i in range(4)]
    rows += [(20 + i, "Menu Home\n" + fresh(20), "rare") for i in range(5)]
    rows += [(1000 + i, ("Far Side\n" if i < 101 else "Near Side\n" if i < 201 else "") + fresh(12), "large") for i in range(11_000)]
    rows += [(100 + i, f"Legal notice of the house\nall rights\n{fresh(4)}", "small") for i in range(6)] + [(999, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    gone, judge = boilerplate([r[1:] for r in rows])
    assert gone["small"] == {"menu home", "legal notice of the house", "all rights"}
    assert gone["rare"] == set() and gone["large"] == {"far side"}
    found = {r.doc_id: (r.removed_words, r.kept) for r in QUERIES["op5_quality_rules"](spark, str(tmp_path)).collect()}
    assert found == {d: judge(t, s) for d, t, s in rows}
    assert not any(found[100 + i][1] for i in range(6))


def test_lines_of_the_given_tables(spark):
    folder = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    gone, judge = boilerplate([(r.text, r.source) for r in rows.values()])
    assert any(gone.values())
    for r in QUERIES["op5_quality_rules"](spark, folder).collect():
        assert (r.removed_words, r.kept) == judge(rows[r.doc_id].text, rows[r.doc_id].source)


def test_filtered_keeps_columns(spark, workspace):
    rows = [*hosted(), (None, None, None, None, None), (1, " ".join("abcdefghijkl"), None, "x", 3)]
    df = spark.createDataFrame(rows, SCHEMA)
    kept = filtered(df, workspace)
    assert kept.columns == df.columns and kept.exceptAll(df).count() == 0
    assert kept.where("row_id = 3").count() == 1 and kept.where("doc_id is null").count() == 0
    empty = filtered(df.limit(0), workspace.__class__(spark, "t"))
    assert empty.columns == df.columns and empty.count() == 0


def test_language_held_out(spark, con):
    found = QUERIES["op6_language_id"](spark, "/root/testdata/sf0.01").where("held_out").collect()
    lang = dict(con.sql("select doc_id, lang from '/root/testdata/sf0.01/documents.parquet'").fetchall())
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in found)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in found]) > 0.95
    accepted = [r for r in found if r.accepted]
    assert len(accepted) > 0.9 * len(found) and all(0 <= r.score <= 1 for r in found)


def test_language_of_odd_rows(spark):
    rows = [(i, "der die das und nicht " * 5 + str(i), "de", "x") for i in range(6)]
    rows += [(10 + i, "the and of not this " * 5 + str(i), "en", "x") for i in range(6)]
    odd = [(20, None, "de"), (21, "", "en"), (22, "123 !?", "en"), (23, "und das", None), (24, "this of " * 40_000, None), (24, "this of", None)]
    df = spark.createDataFrame(rows + [(*r, "x") for r in odd], "doc_id long, text string, lang string, score string")
    found = sorted((r.doc_id, r.lang_pred) for r in language(df, F.lit(True)).collect() if r.doc_id >= 20)
    assert found == [(20, UNKNOWN), (21, UNKNOWN), (22, UNKNOWN), (23, "de"), (24, "en"), (24, "en")]
    assert language(df.limit(0), F.lit(True)).count() == 0
    assert {r.lang_pred for r in language(df, F.lit(False)).collect()} == {UNKNOWN}


def test_language_sees_the_whole_text():
    sizes = Sizes({"a": b" alpha beta gamma delta " * 30, "b": b" uno dos tres cuatro " * 30})
    assert sizes.predict("alpha beta " * 3 + "uno dos tres cuatro " * 500)[0] == "b"


def test_one_measure_at_every_length():
    """Close sizes are decided by phrases, whatever the length; clear ones by the sizes alone."""
    rng = random.Random(4)
    raw = {x: " ".join("".join(rng.choice(x) for _ in range(5)) for _ in range(400)).encode() for x in ("abcdefg", "hijklmn")}
    sizes = Sizes(raw)
    parts = {x: raw[x].decode().split() for x in raw}
    for count in (1, 3, 40, 2000):
        for x in raw:
            assert sizes.predict(" ".join(rng.choices(parts[x], k=count)))[0] == x
    even = " ".join(rng.choices(parts["abcdefg"], k=300) + rng.choices(parts["hijklmn"], k=300))
    plain = [sum(len(t.compress(f" {even} "[i : i + 1500].encode())) for i in range(0, len(even) + 2, 1500)) for t in sizes._tools]
    added = sizes.of(even) - plain
    assert (added > 0).all() if abs(plain[0] - plain[1]) <= 8 else not added.any()


def test_dictionaries_take_the_smallest_hashes(spark):
    rows = [(f"text {'x' * (i % 7)} {chr(97 + i % 26)} {i}", "de") for i in range(3000)] + [("copy of one", "de")] * 2000 + [("uno", "es")]
    df = spark.createDataFrame(rows, "text string, lang string")
    hashes = df.where("lang = 'de'").select(F.xxhash64("text").alias("h"), "text").distinct().orderBy("h").limit(SAMPLE_TEXTS).collect()
    raw = dictionaries(df)
    assert raw["de"].decode() == " " + " ".join(plain(r.text) for r in hashes) + " " and raw["es"] == b" uno "


FOLD = "crc32(cast(doc_id as string)) % 5"


def test_toxicity_held_out(spark, con):
    found = QUERIES["op9_toxicity"](spark, "/root/testdata/sf0.1").where("held_out").collect()
    label = dict(con.sql("select doc_id, toxic from '/root/testdata/sf0.1/labels.parquet'").fetchall())
    lang = dict(con.sql("select doc_id, lang from '/root/testdata/sf0.1/documents.parquet'").fetchall())
    known = [(r.predicted, label[r.doc_id], lang[r.doc_id]) for r in found if r.doc_id in label]
    assert np.mean([p == t for p, t, _ in known]) > 0.97
    assert np.mean([t for p, t, _ in known if p == 1]) > 0.97
    for lang in ("en", "de", "fr", "es"):
        assert np.mean([p for p, t, x in known if t == 1 and x == lang]) > 0.8, lang


def test_toxicity_of_odd_rows(spark, workspace):
    rng = random.Random(1)
    plain = [f"{a}{b}" for a in ("wor", "sto", "lin") for b in ("d", "ne", "e", "ry")]
    rows, labels = [], []
    for i in range(400):
        words = [rng.choice(plain) for _ in range(30)]
        if i % 4 == 0:
            words[rng.randrange(30)] = "zgrub" + rng.choice(["ig", "est", "ling"])
        rows.append((i, " ".join(words), "x"))
        labels.append((i, int(i % 4 == 0), "y"))
    rows += [(1000, None, "x"), (1001, "", "x"), (1002, "zgrubous", "x"), (None, "word stone", "x"), (1002, "zgrubous", "x")]
    rows += [(1003, "word stone line " * 300_000, "x"), (1004, "word " * 300_000 + "zgrubish", "x")]
    labels += [(5, None, "y"), (None, 1, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int, text string")
    found = spelling.toxicity(docs, marks, F.expr(FOLD), workspace).collect()
    assert len(found) == len(rows)
    by = {r.doc_id: r for r in found}
    assert all(by[i].predicted == int(i % 4 == 0) for i in range(400))
    assert by[1002].predicted == by[1004].predicted == 1 and by[1000].predicted == by[1001].predicted == by[1003].predicted == 0
    assert by[1000].score == by[1001].score and not by[None].held_out
    empty = spelling.toxicity(docs.limit(0), marks, F.expr(FOLD), workspace.__class__(spark, "t"))
    assert empty.count() == 0
    blind = spelling.toxicity(docs, marks.limit(0), F.expr(FOLD), workspace.__class__(spark, "u"))
    assert {r.predicted for r in blind.collect()} == {0}


def plain_ratios(texts):
    """Kneser-Ney by dictionaries: ratios of known words, ratios of beginnings, and the probabilities below every node."""
    path = lambda w: ["", *[w[:c] for c in (3, 5, 7) if len(w) > c], w + "$"]
    count, below = Counter(), {}
    kinds = {w for text, _ in texts for w in spelling.words_of(text)}
    for text, y in texts:
        for w in spelling.words_of(text):
            count.update((y, k) for k in path(w))
    types = Counter(k for w in kinds for k in path(w))
    for w in kinds:
        for parent, key in zip(path(w), path(w)[1:]):
            below.setdefault(parent, set()).add(key)

    def freed(y, node):
        n = count[y, node]
        return 0.75 * sum(count[y, k] > 0 for k in below[node]) / n if n else 1.0

    def share(y, node, key):
        n = count[y, node]
        return (max(count[y, key] - 0.75, 0) / n if n else 0.0) + freed(y, node) * types[key] / types[node]

    ratio = {"": 0.0}
    for w in kinds:
        for parent, key in zip(path(w), path(w)[1:]):
            ratio[key] = ratio[parent] + np.log(share(1, parent, key) / share(0, parent, key))
    words = {w: ratio[w + "$"] for w in kinds}
    begun = {k: ratio[k] + np.log(freed(1, k) / freed(0, k)) for k in below if k}
    sums = {(y, node): sum(share(y, node, k) for k in keys) for node, keys in below.items() for y in (0, 1)}
    return words, begun, sums


def test_kneser_ney_by_brute_force(spark, workspace):
    rng = random.Random(9)
    make = lambda: "".join(rng.choice(["ba", "ßo", "é", "nt", "и", "l"]) for _ in range(rng.randint(1, 7)))
    stock = [make() for _ in range(300)] + ["漢字仮名", "漢字"]
    texts = [(" ".join(rng.choices(stock, k=25)).title(), int(i % 5 == 0)) for i in range(200)] + [("", 1), ("12 _", 0)]
    words, begun, sums = plain_ratios(texts)
    assert all(abs(x - 1) < 1e-9 for x in sums.values())
    table = workspace.keep(spelling.counted(spark.createDataFrame(texts, "text string, toxic int")), "counted")
    model = spelling.fitted(table, workspace)
    for found, wanted in ((model.words, words), (model.beginnings, begun)):
        found = {r[0]: r.ratio for r in found.collect()}
        assert found.keys() == wanted.keys()
        assert all(abs(found[k] - wanted[k]) < 1e-9 for k in wanted)

    def value(word):
        if word in words:
            return words[word]
        return next((begun[word[:c]] for c in (7, 5, 3) if len(word) > c and word[:c] in begun), 0.0)

    fresh = texts + [(" ".join(w + make() for w in rng.choices(stock, k=20)), 0) for _ in range(100)]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(fresh)], "doc_id long, text string")
    for r in spelling.described(docs, model, workspace).collect():
        seen = spelling.words_of(fresh[r.doc_id][0])
        strong = [v for v in map(value, seen) if v >= spelling.LEAST]
        assert abs(r.strongest - max(strong, default=0)) < 1e-5
        assert abs(r.excess - sum(strong) / max(1, len(seen)) ** 0.5) < 1e-4


def test_whole_texts_are_compared(spark, workspace, monkeypatch):
    """Words that are likelier in ordinary documents, or a little likelier in toxic ones, count too, in any cut into blocks."""
    rng = random.Random(4)
    stock = ["".join(rng.choice("abcdef") for _ in range(rng.randint(2, 9))) for _ in range(120)]
    texts = [(" ".join(rng.choices(stock[: 80 if i % 2 else 120], k=20)), i % 2) for i in range(200)]
    words, begun, _ = plain_ratios(texts)
    table = workspace.keep(spelling.counted(spark.createDataFrame(texts, "text string, toxic int")), "counted")
    model = spelling.fitted(table, workspace)
    rows = [(i, t) for i, (t, _) in enumerate(texts)] + [(900, None), (901, "  "), (902, stock[100] + "zz xyzzy"), (None, stock[3]), (0, stock[90])]
    expected = []
    for i, text in rows:
        seen = spelling.words_of(text or "")
        known = (words.get(w, next((begun[w[:c]] for c in (7, 5, 3) if len(w) > c and w[:c] in begun), 0.0)) for w in seen)
        expected.append((str(i), len(seen), sum(known) / max(1, len(seen))))
    assert sum(c < -0.5 for _, _, c in expected) > 20
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    for n, held in enumerate((spelling.HELD_WORDS, 30)):
        monkeypatch.setattr(spelling, "HELD_WORDS", held)
        monkeypatch.setattr(spelling, "CHUNK_BYTES", 2_000_000 if n == 0 else 300)
        found = spelling.described(docs, model, workspace.__class__(spark, f"blocks{n}")).collect()
        assert len({r.row_id for r in found}) == len(rows)
        found = sorted((str(r.doc_id), round(np.expm1(r.size)), r.comparison) for r in found)
        for got, wanted in zip(found, sorted(expected), strict=True):
            assert got[:2] == wanted[:2] and abs(got[2] - wanted[2]) < 1e-5


def test_words_travel_packed(spark, workspace, monkeypatch):
    """A block sends a row for each part and not for each word, and keeps nothing it no longer needs."""
    rng = random.Random(8)
    monkeypatch.setattr(spelling, "HELD_WORDS", 400)
    monkeypatch.setattr(spelling, "CHUNK_BYTES", 1000)
    stock = ["".join(rng.choice("abéß漢") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    texts = [" ".join(rng.choices(stock, k=rng.randint(0, 40))) for _ in range(90)] + [None, "", "12 _"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = workspace.keep(spelling.indexed(docs.coalesce(1), 4), "packed").collect()
    sent = [r for r in rows if r.words is not None]
    blocks = {r.block for r in sent}
    assert len(blocks) > 3 and len(sent) <= 4 * len(blocks)
    found = {(r.block, r.at): (r.doc_id, r.n_words, set()) for r in rows if r.words is None}
    for r in sent:
        held, words = spelling.unpacked(r.held), r.words.split(" ")
        assert {zlib.crc32(w.encode()) % 4 for w in words} == {r.part}
        ends = len(words) + np.cumsum(held[: len(words)])
        for word, places in zip(words, np.split(held[len(words) :], ends[:-1] - len(words))):
            for at in places:
                found[r.block, at][2].add(word)
    assert sorted(d for d, _, _ in found.values()) == list(range(len(texts)))
    assert all(seen == spelling.words_of(texts[d] or "") and n == len(seen) for d, n, seen in found.values())

    table = workspace.keep(spelling.counted(docs.withColumn("toxic", F.lit(1)).fillna("")), "counted")
    spelling.described(docs, spelling.fitted(table, workspace), workspace).count()
    left = {p.name for p in Path(workspace.path.removeprefix("file:")).iterdir()}
    assert "described" in left and not left & {"indexed", "seen", "rated", "answers", "nodes-7"}


def test_packed_numbers():
    for numbers in ([0], [1, -1, 2**31 - 1, -(2**31)], list(range(-500, 500))):
        assert spelling.unpacked(spelling.packed(np.array(numbers))).tolist() == numbers


def test_words_of_scripts():
    assert spelling.words_of("Über-Maß x1y Ёлка") == {"über", "maß", "x", "y", "ёлка"}
    assert spelling.words_of("漢字仮 ab") == {"漢字", "字仮", "ab"}
