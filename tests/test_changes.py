"""Change application and snapshots, checked by what must always hold."""

from pyspark.sql import functions as F

from skyweave.operators import changes


def feed(spark):
    rows = [("hot", i, "D" if i % 50 == 49 else "U", i) for i in range(200)]
    rows += [("gone", 1, "U", 5), ("gone", 2, "D", None), ("one", 1, "U", 9)]
    return spark.createDataFrame(rows, "k string, seq bigint, op string, v bigint")


def test_latest_drops_deleted_keys(spark):
    state = changes.apply_latest(feed(spark), "k", "seq", F.col("op") == "D").collect()
    assert {(r.k, r.v) for r in state} == {("one", 9)}


def test_history_intervals_do_not_overlap(spark):
    history = changes.apply_history(feed(spark), "k", "seq", F.col("op") == "D").collect()
    for key in ("hot", "gone", "one"):
        spans = sorted((r.valid_from, r.valid_to) for r in history if r.k == key)
        for (_, end), (start, _) in zip(spans, spans[1:]):
            assert end is not None and end <= start
    assert [r.k for r in history if r.is_current] == ["one"]


def test_diff_applied_to_the_old_gives_the_new(spark):
    old = spark.createDataFrame([(1, "a"), (2, None), (3, "c"), (4, "d")], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (2, "b"), (4, None), (5, "e")], "k int, v string")
    diff = {r.k: r for r in changes.snapshot_diff(old, new, "k", ["v"]).collect()}
    assert {k: r.change for k, r in diff.items()} == {2: "update", 3: "delete", 4: "update", 5: "insert"}
    state = {r.k: r.v for r in old.collect()}
    for k, r in diff.items():
        if r.change == "delete":
            del state[k]
        else:
            state[k] = r.new_v
    assert state == {r.k: r.v for r in new.collect()}
