"""Hexagons, places and routes, shapes of tracks, and differences found by digests, against plain loops."""

import math
import random

import pytest
from pyspark.sql import functions as F

from skyweave.functions.geo import hex_cell, hex_centre, hex_parent
from skyweave.operators import changes, profile, routes, tracks
from skyweave.session import scratch_path


def test_hexagons(spark):
    """The nearest centre is the cell's; the 180th meridian and the poles belong to one cell from either side."""
    rng, columns = random.Random(2), 24
    points = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(400)]
    points += [(90.0, 0.0), (-90.0, 0.0), (0.0, 180.0), (0.0, -180.0), (12.5, 179.999999), (12.5, -180.000001), (95.0, 10.0), (90.0, 10.0)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "i int, lat double, lon double")
    found = df.withColumn("c", hex_cell(F.col("lat"), F.col("lon"), columns))
    centre = hex_centre(F.col("c.hex_column"), F.col("c.hex_row"), columns)
    cells = {}
    for r in found.withColumn("centre", centre).collect():
        cells[r.i] = tuple(r.c)
        x, y = (r.lon + 180) % 360 / 360 * columns, math.sin(math.radians(max(-90, min(90, r.lat)))) * columns / (2 * math.pi)
        best = None
        for row in range(-6, 7):
            for column in range(columns):
                cx, cy = (column + row / 2) % columns, row * math.sqrt(3) / 2
                dx = abs(x - cx) % columns
                d = math.hypot(min(dx, columns - dx), y - cy)
                if best is None or d < best[0] - 1e-9:
                    best = (d, (column, row))
        near = (r.c.hex_column + r.c.hex_row / 2) % columns
        dx = abs(x - near) % columns
        assert math.hypot(min(dx, columns - dx), y - r.c.hex_row * math.sqrt(3) / 2) <= best[0] + 1e-9
        assert -180 <= r.centre.longitude < 180 and -90 <= r.centre.latitude <= 90
    n = 400
    assert cells[n + 2] == cells[n + 3] and cells[n + 4] == cells[n + 5] and cells[n + 6] == cells[n + 7]
    odd = spark.createDataFrame([(None, 1.0), (1.0, None), (float("nan"), 1.0), (1.0, float("inf"))], "lat double, lon double")
    assert odd.select(hex_cell(F.col("lat"), F.col("lon"), 24).alias("c")).where("c is not null").count() == 0


def test_children_add_up_to_parents(spark):
    rng = random.Random(3)
    rows = [(f"k{i % 17}", math.degrees(math.asin(rng.uniform(-1, 1))), rng.uniform(-180, 180)) for i in range(2000)]
    df = spark.createDataFrame(rows, "icao24 string, latitude double, longitude double")
    fine = profile.hex_density(df, 96)
    coarse = profile.hex_rollup(fine, 96, 24)
    assert coarse.agg(F.sum("n_rows")).first()[0] == fine.agg(F.sum("n_rows")).first()[0] == 2000
    assert coarse.agg(F.sum("n_children")).first()[0] == fine.count()
    parents = fine.select(hex_parent(F.col("hex_column"), F.col("hex_row"), 96, 24).alias("p"), "n_rows")
    expected = {tuple(r.p): r.n for r in parents.groupBy("p").agg(F.sum("n_rows").alias("n")).collect()}
    assert {(r.hex_column, r.hex_row): r.n_rows for r in coarse.collect()} == expected


def plain_places(ends, degrees, least):
    around, rows = round(360 / degrees), round(180 / degrees)

    def cell(p):
        return min(math.floor((p[0] + 90) / degrees), rows - 1), math.floor((p[1] + 180) / degrees) % around

    counts = {}
    for o, d in ends:
        for p in (o, d):
            counts[cell(p)] = counts.get(cell(p), 0) + 1
    dense = {c for c, n in counts.items() if n >= least}
    place = {}
    for start in sorted(dense):
        if start in place:
            continue
        group, waiting = set(), [start]
        while waiting:
            c = waiting.pop()
            if c in group:
                continue
            group.add(c)
            waiting += [
                n for r in (-1, 0, 1) for k in (-1, 0, 1) if (n := (c[0] + r, (c[1] + k) % around)) in dense
            ]
        for c in group:
            place[c] = min(r * around + k for r, k in group)
    flights = {}
    for o, d in ends:
        pair = place.get(cell(o)), place.get(cell(d))
        flights[pair] = flights.get(pair, 0) + 1
    return flights


@pytest.mark.parametrize("seed", [1, 2])
def test_route_map(spark, seed):
    rng = random.Random(seed)
    centres = [(rng.uniform(-85, 85), rng.uniform(-180, 180)) for _ in range(6)] + [(10.0, 179.9), (10.0, -179.9), (90.0, 0.0)]
    point = lambda: tuple(
        max(lo, min(hi, c + rng.gauss(0, 3))) for c, lo, hi in zip(rng.choice(centres), (-90.0, -180.0), (90.0, 180.0))
    )
    ends = [(point(), point()) for _ in range(400)] + [(centres[0], point()) for _ in range(300)]
    df = spark.createDataFrame(
        [(f"k{i}", 1, o, d) for i, (o, d) in enumerate(ends)],
        "icao24 string, segment long, origin struct<latitude:double,longitude:double>, destination struct<latitude:double,longitude:double>",
    )
    got = {(r.origin, r.destination): r.n_flights for r in routes.route_map(df, 2.0, 4).collect()}
    assert got == plain_places(ends, 2.0, 4)
    assert routes.route_map(df.limit(0), 2.0, 4).count() == 0


def test_chains_of_cells_are_one_place(spark):
    """A winding chain across half the globe: rounds grow slowly, the result is one root."""
    edges = spark.createDataFrame([((i * 7919) % 503, ((i + 1) * 7919) % 503) for i in range(502)], "a long, b long")
    found = routes.components(edges)
    assert found.count() == 503 and found.select("root").distinct().collect() == [(0,)]


def plain_shape(rows, points):
    """The rows kept of one track: (time in seconds, id, value), sorted."""
    rows = sorted(rows)
    if len(rows) < 3:
        return sorted(r[1] for r in rows)
    t0, length = rows[0][0], rows[-1][0] - rows[0][0]
    buckets = {-1: [rows[0]], points - 2: [rows[-1]]}
    for r in rows[1:-1]:
        b = min(math.floor((r[0] - t0) * 1e6 * (points - 2) / max(length * 1e6, 1)), points - 3)
        buckets.setdefault(b, []).append(r)
    names = sorted(buckets)
    mean = {b: (sum(r[0] - t0 for r in v) / len(v), sum(r[2] for r in v) / len(v)) for b, v in buckets.items()}
    out = []
    for before, b, after in zip([None, *names], names, [*names[1:], None]):
        if before is None or after is None:
            out.append(buckets[b][0][1])
            continue
        (x0, y0), (x1, y1) = mean[before], mean[after]
        area = lambda r: round(abs((r[0] - t0 - x0) * (y1 - y0) - (x1 - x0) * (r[2] - y0)) / 2, 3)  # noqa: E731,B023
        out.append(min(buckets[b], key=lambda r: (-area(r), r[0], r[1]))[1])
    return sorted(out)


def test_shape_is_kept(spark):
    rng = random.Random(4)
    rows = []
    for k, n in (("hot", 3000), ("a", 40), ("b", 2), ("c", 1), ("d", 9)):
        for j in range(n):
            rows.append((len(rows), k, rng.randint(0, 900) if k != "d" else 5, float(rng.randint(-50, 50)) if j % 50 else 1000.0))
    rows += [(len(rows), "e", None, 1.0), (len(rows) + 1, "e", 5, None)]
    df = spark.createDataFrame(rows, "event_id long, icao24 string, s long, v double").withColumn(
        "time_position", F.timestamp_seconds("s").cast("timestamp_ntz")
    )
    kept = tracks.keep_shape(df, "v", max_points=10)
    assert kept.columns == df.columns
    got = {}
    for r in kept.collect():
        got.setdefault(r.icao24, []).append(r.event_id)
    for k in "hot a b c d".split():
        mine = [(s, i, v) for i, key, s, v in rows if key == k]
        assert sorted(got[k]) == plain_shape(mine, 10) and len(got[k]) <= 10
    assert "e" not in got
    with pytest.raises(ValueError):
        tracks.keep_shape(df, "v", max_points=2)


def test_only_differing_ranges_are_read(spark):
    root = scratch_path(spark, "test-digests")
    rows = [(i, f"v{i % 7}", None if i % 5 else float(i)) for i in range(5000)]
    after = [r for r in rows if r[0] not in (4000, 4001)] + [(9000, "new", None), (-5, "low", 1.0)]
    after = [(i, "changed" if i == 4002 else v, x) for i, v, x in after]
    schema = "k long, v string, x double"
    for name, data in (("before", rows), ("after", after)):
        spark.createDataFrame(data, schema).repartitionByRange(8, "k").write.parquet(f"{root}/{name}")
    old, new = (spark.read.parquet(f"{root}/{n}") for n in ("before", "after"))
    cuts = changes.key_cuts(old, "k", 20)
    assert cuts == list(range(250, 5000, 250))
    digests = [changes.digest_table(df, "k", ["v", "x"], cuts) for df in (old, new)]
    assert changes.differing_ranges(*digests) == [0, 16, 19]
    found = changes.digest_diff(old, new, "k", ["v", "x"], cuts, *digests)
    expected = changes.snapshot_diff(old, new, "k", ["v", "x"])
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect())) and found.count() == 5
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PushedFilters") >= 2 and "LessThan(k,250)" in plan
    same = [digests[0], digests[0]]
    assert changes.digest_diff(old, old, "k", ["v", "x"], cuts, *same).count() == 0
