import re

from pyspark.sql import functions as F

import corpus_pipeline
from skyweave.llm.neardup import Similarity


def test_stages(spark, folder, workspace):
    from test_documents import measures
    from test_neardup import brute

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    tables = []
    for name, stage in corpus_pipeline.STAGES:
        docs = workspace.keep(stage(spark, docs, folder), name)
        tables.append(docs)
    quality, single, clean, mix, packed = tables
    assert all(t.columns == ["doc_id", "text", "lang", "source", "n_chars"] for t in tables[:-1])

    kept = {r.doc_id: r for r in quality.collect()}
    assert set(kept) == {d for d, r in rows.items() if not measures(r.text)[-1]}
    assert all(rows[d] == r for d, r in kept.items())

    texts = [(d, r.text) for d, r in sorted(kept.items())]
    alone = sorted(d for d, _, least in brute(texts, Similarity(5, 80)) if d == least)
    assert sorted(r.doc_id for r in single.collect()) == alone

    cleaned = {r.doc_id: r for r in clean.collect()}
    assert sorted(cleaned) == alone
    assert not any(re.search(r"[\w.]+@\w+\.\w+|\d+\.\d+\.\d+\.\d+", r.text) for r in cleaned.values())
    assert all(r.n_chars == len(r.text) for r in cleaned.values())

    repeats = {}
    for r in mix.collect():
        assert r == cleaned[r.doc_id]
        repeats[r.doc_id] = repeats.get(r.doc_id, 0) + 1
    assert max(repeats.values()) <= 3

    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    total = sum(n * words(cleaned[d].text) for d, n in repeats.items())
    assert sum(r.length for r in packed.collect()) == total
    assert corpus_pipeline.run(spark, folder).count() == packed.count()


def test_quality_stage_removes_lines(spark, workspace):
    """The texts the stage hands on, against brute force."""
    from test_documents import boilerplate

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    odd = [
        (-1 - i, f"Menu  Home\n\n word{i} and ten more {i} b c d e f g é\n\tmenu home \n", "en", "odd" if i % 2 else None, None)
        for i in range(14)
    ]
    odd.append((-99, "Menu Home\n" + " ".join(f"v{i}" for i in range(20)), "en", "other", 7))
    rows = [*map(tuple, docs.collect()), *odd]
    gone, judge = boilerplate([(r[1], r[3]) for r in rows])
    assert gone["odd"] == gone[None] == {"menu home"} and not gone["other"]
    expected = {}
    for doc_id, text, lang, source, n_chars in rows:
        removed, kept = judge(text, source)
        if kept:
            lines = (text or "").split("\n")
            clean = "\n".join(x for x in lines if " ".join(x.split()).lower() not in gone[source]) if removed else text
            expected[doc_id] = (doc_id, clean, lang, source, len(clean) if removed else n_chars)
    stage = workspace.keep(corpus_pipeline.quality_rules(spark, spark.createDataFrame(rows, docs.schema), ""), "quality")
    assert {r.doc_id: tuple(r) for r in stage.collect()} == expected
    assert sum(expected[r[0]][1] != r[1] for r in rows if r[0] in expected) > 100


def test_empty_documents(spark, workspace):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        docs = workspace.keep(stage(spark, docs, ""), name)
    assert docs.count() == 0


def test_odd_rows_and_clashing_names(spark, workspace):
    """Nulls everywhere, repeated rows, a long text, and columns named like those the stages use inside."""
    names = ["row_id", "cls", "base", "terms", "kept", "positions", "in_text", "size", "target", "n_words", "bucket", "text_x"]
    clean = " ".join(f"word{i}" for i in range(40))
    rows = [
        (1, clean, "en", "a", 1), (1, clean, "en", "a", 1), (None, clean + " more", "en", None, None), (2, None, None, None, None),
        (3, "", "en", "a", 0), (4, " ".join(f"x{i}" for i in range(200_000)), None, "b", 5), (None, None, None, None, None),
        (5, "write to someone@example.org " + " ".join(f"y{i}" for i in range(30)), "de", "b", 2),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, schema)
    for i, name in enumerate(names):
        docs = docs.withColumn(name, F.lit(f"{name}-{i}"))
    before = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = workspace.keep(stage(spark, docs, ""), name)
        assert docs.columns == before
        found = docs.collect()
        assert all(r[n] == f"{n}-{i}" for r in found for i, n in enumerate(names))
        if name == "near_dedup":
            assert sorted(str(r.doc_id) for r in found) == ["1", "4", "5"]
        if name == "personal_data":
            assert [r.text[:17] for r in found if r.doc_id == 5] == ["write to [EMAIL] "]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
    assert {r.doc_id for r in packed} <= {1, 4, 5} and max(r.length for r in packed) <= 4096
