import hashlib
import random
import re

from pyspark.sql import functions as F

from skyweave.llm.pii import Disclosure, base_spans, personal_data, sanitised, spans_text


def luhn(digits):
    doubled = [int(c) * (2 if i % 2 else 1) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def expected(text):
    text = text or ""
    out = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [
        ("ip", m)
        for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
        if all(int(x) <= 255 for x in m[0].split("."))
    ]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m))
    out += [
        ("phone", m)
        for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15
    ]
    return ",".join(f"{k}:{m.start()}:{m.end()}" for k, m in out)


SCHEMA = "doc_id long, text string, source string, base string, row_id int"

PARTS = (
    "a|b.|@|.|1|23|255|256|007| |-|+|(|)|%|_|4111111111111111|4111 1111-1111 1111|é|\U0001f600|x@y.z|1.2.3.4|"
    "+1 (555) 123-4567|\n|--|9.9"
).split("|")


def test_patterns(spark):
    rng = random.Random(8)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 45))) for _ in range(3000)] + ["", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    found = df.select("i", spans_text(base_spans(F.coalesce("t", F.lit("")))).alias("s")).collect()
    assert [(texts[r.i], r.s) for r in found if r.s != expected(texts[r.i])] == []


def test_very_long_texts(spark):
    texts = ["x" * 300_000, "1 " * 30_000 + "4111111111111111", "a." * 60_000 + "@b" + ".c" * 20_000, "+1" * 50_000]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: r.s for r in df.select("i", spans_text(base_spans(F.col("t"))).alias("s")).collect()}
    assert got == {0: "", 1: "", 2: f"email:0:{len(texts[2])}", 3: ""}


def test_many_matches_in_one_text(spark, workspace):
    """20,000 addresses in one text take seconds, places and clean text included."""
    import time

    text = " ".join(f"name{i} n{i}@host{i % 50}.example wrote é" for i in range(20_000))
    df = spark.createDataFrame([(1, text, "s", "b", 1)], SCHEMA)
    start = time.perf_counter()
    found = personal_data(df, workspace, kept_cols=["text"])
    clean = found.select(spans_text(F.col("base")).alias("s"), sanitised(F.col("in_text"), F.col("base"), F.col("terms")).alias("c")).first()
    assert time.perf_counter() - start < 60
    assert clean.s == expected(text)
    assert clean.c == re.sub(r"n[0-9]+@host[0-9]+\.example", "[EMAIL]", text)


def private_corpus():
    """One address always beside one rare name, each time in other words; common words are everywhere."""
    rng = random.Random(1)
    vocabulary = [f"word{i:x}" for i in range(40)]
    rows = []
    for i in range(400):
        words = [rng.choice(vocabulary) for _ in range(30)]
        if i % 40 == 0:
            words[10:12] = ["Zaphod", "zaphod@example.com"]
        elif i % 57 == 0:
            words[5] = f"u{i}@example.com"
        rows.append((i, " ".join(words), "s", "k", i))
    return rows


def test_disclosing_terms(spark, workspace):
    df = spark.createDataFrame(private_corpus(), SCHEMA)
    found = personal_data(df, workspace, Disclosure(), kept_cols=["text"]).withColumn(
        "clean", sanitised(F.col("in_text"), F.col("base"), F.col("terms"))
    )
    named = 0
    for r in found.collect():
        terms = [r.in_text[t.start : t.end] for t in r.terms]
        if r.doc_id % 40 == 0:
            named += 1
            assert terms == ["Zaphod"]
            assert "aphod" not in r.clean and "[EMAIL]" in r.clean
        else:
            assert terms == []
        assert ("@" in r.in_text) == (r.clean != r.in_text)
    assert named == 10


def test_copies_of_a_text_disclose_nothing(spark, workspace):
    text = "rare words around someone@example.org stand here alone"
    rows = [(i, text, "s", "b", 1) for i in range(30)] + [(100 + i, f"plain text {i}", None, None, None) for i in range(50)]
    found = personal_data(spark.createDataFrame(rows, SCHEMA), workspace)
    assert found.where(F.size("terms") > 0).count() == 0
    assert found.where(F.size("base") == 1).count() == 30


def test_null_empty_and_repeated_rows(spark, workspace):
    rows = [(1, None, None, "x", 1), (1, "", None, "x", 1), (None, "a@b.cc", None, "x", 1), (None, "a@b.cc", None, "x", 1)]
    found = personal_data(spark.createDataFrame(rows, SCHEMA), workspace, kept_cols=["base", "row_id"]).collect()
    assert sorted((str(r.doc_id), len(r.base)) for r in found) == [("1", 0), ("1", 0), ("None", 1), ("None", 1)]
    empty = spark.createDataFrame([], SCHEMA)
    assert personal_data(empty, workspace.__class__(spark, "t")).count() == 0


def test_sanitised_overlaps(spark):
    text = "call +1 (555) 123-4567 or 10.0.0.1@host.example now"
    df = spark.createDataFrame([(text,)], "t string").withColumn("base", base_spans(F.col("t")))
    none = F.array().cast("array<struct<start:int,end:int,remove:boolean>>")
    assert df.select(sanitised(F.col("t"), F.col("base"), none)).first()[0] == "call [PHONE] or [EMAIL] now"


def test_sanitised_tails(spark):
    """A span that starts in an earlier one and ends behind it leaves nothing in the text."""
    texts = ["pay x@mail.4111 1111 1111 1111 now", "pay x@mail.4111 1111 1111 1111", "a@b.cd, x@mail.4111-1111-1111-1111 e@f.gh"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").withColumn("base", base_spans(F.col("t")))
    none = F.array().cast("array<struct<start:int,end:int,remove:boolean>>")
    found = [r[0] for r in df.orderBy("i").select(sanitised(F.col("t"), F.col("base"), none)).collect()]
    assert found == ["pay [EMAIL] now", "pay [EMAIL]", "[EMAIL], [EMAIL] [EMAIL]"]


def test_digest_of_the_query(spark, folder, con):
    from skyweave.llm.queries import QUERIES

    texts = dict(con.sql("select doc_id, text from documents").fetchall())
    for r in QUERIES["op2_personal_data"](spark, folder).collect():
        spans = expected(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(spans.encode()).hexdigest()
        assert r.spans.startswith(spans)
        assert r.n_email == spans.count("email:")
