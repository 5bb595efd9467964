"""Per-entity sequence operators: positions, tracks, deltas, loops and segments.

Everything that looks along an entity's time line goes through ``ordered_scan``; nothing collects a
track into an array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyweave.functions.geo import haversine_m, heading_change
from skyweave.functions.hashing import row_digest
from skyweave.functions.labels import altitude_band
from skyweave.operators.sequence import Slices, ordered_scan, plan_slices, trailing_sums
from skyweave.session import materialise
from skyweave.sources.telemetry import KEY, ROW_ID, TIME

# Fixed-point type of accumulated measures: totals do not depend on the order of addition.
EXACT = "decimal(28,9)"


def pick_row(df: DataFrame, keys: list[str], rank: Column, *, newest: bool = True) -> DataFrame:
    """One whole row per key: the one with the largest (or smallest) rank.

    An aggregate, so each task reduces a hot key to one row before the shuffle; a window would move
    and sort all of its rows. A row of any types is no fixed-width buffer, so Spark aggregates by sorting: on the map side
    too, each task sorts its rows by key.
    """
    rest = [c for c in df.columns if c not in keys]
    choose = F.max_by if newest else F.min_by
    return df.groupBy(*keys).agg(choose(F.struct(*rest), rank).alias("__row")).select(*keys, "__row.*")


def random_row_per_key(df: DataFrame, key: str = KEY, row_id: str = ROW_ID, seed: int = 42) -> DataFrame:
    """One pseudo-random row per key among the rows given; the same one on every run."""
    return pick_row(df, [key], F.struct(row_digest(seed, F.col(row_id)), F.col(row_id)), newest=False)


def in_envelope(df: DataFrame, limits: dict[str, tuple[float, float]]) -> DataFrame:
    """Rows inside every closed range. Apply after picking: a key whose pick is outside disappears."""
    for column, (low, high) in limits.items():
        df = df.where(F.col(column).between(low, high))
    return df


def latest_row(df: DataFrame, key: str = KEY, ts: str = TIME, row_id: str = ROW_ID) -> DataFrame:
    """Most recent row of every key."""
    return pick_row(df, [key], F.struct(ts, row_id))


def busiest(df: DataFrame, key: str = KEY, n: int = 120) -> DataFrame:
    """The n keys with the most rows, ties by key."""
    return (
        df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")).orderBy(F.desc("n_rows"), F.asc(key)).limit(n)
    )


def tracks_of(df: DataFrame, chosen: DataFrame, key: str = KEY) -> DataFrame:
    """All rows of the chosen keys. Spark broadcasts the list by its own size check; it may be any length."""
    return df.join(chosen.select(key), key, "left_semi")


def chronological(
    df: DataFrame, key: str = KEY, ts: str = TIME, row_id: str = ROW_ID, slices: Slices | None = None
) -> DataFrame:
    """Number the points of each track in time order and give the track's length."""
    one = F.lit(1)
    return ordered_scan(
        df, [key], ts, row_id, running={"point_no": one}, totals={"n_points": one}, slices=slices
    )


def downsample(
    df: DataFrame,
    key: str = KEY,
    ts: str = TIME,
    row_id: str = ROW_ID,
    max_points: int = 20,
    slices: Slices | None = None,
) -> DataFrame:
    """Keep every k-th point of a track, k chosen per track so that at most ``max_points`` remain."""
    numbered = chronological(df, key, ts, row_id, slices)
    step = F.ceil(F.col("n_points") / max_points)
    return numbered.where((F.col("point_no") - 1) % step == 0)


def keep_shape(
    df: DataFrame,
    value: str,
    key: str = KEY,
    ts: str = TIME,
    row_id: str = ROW_ID,
    max_points: int = 20,
) -> DataFrame:
    """At most ``max_points`` rows of each track that show the shape of ``value`` over time.

    The first and the last row stay. The time between is cut into equal buckets, and of each the row stays that spans the largest
    triangle with the mean points of the nearest buckets with rows before and after it, ties to the earlier row; with the means in
    place of the chosen neighbours all buckets are decided at once. All steps are aggregates by (track, bucket), so a
    hot track is spread over its buckets and reduced before each shuffle. Rows without a value or a time are left out; columns come
    through as they are.
    """
    if max_points < 3:
        raise ValueError("a shape needs three points or more")
    known = df.where(F.col(key).isNotNull() & F.col(ts).isNotNull() & F.col(value).isNotNull())
    place = F.struct(F.col(ts).alias("t"), F.col(row_id).alias("i"))
    ends = known.groupBy(key).agg(F.min(place).alias("__first"), F.max(place).alias("__last"))
    since = _micros(F.col(ts)) - _micros(F.col("__first.t"))
    length = _micros(F.col("__last.t")) - _micros(F.col("__first.t"))
    inner = F.least(F.floor(since * (max_points - 2) / F.greatest(length, F.lit(1))), F.lit(max_points - 3))
    bucket = F.when(place == F.col("__first"), -1).when(place == F.col("__last"), max_points - 2).otherwise(inner)
    cut = known.join(ends, key).withColumn("__bucket", bucket.cast("int")).withColumn("__t", since / 1e6).drop("__first", "__last")
    means = cut.groupBy(key, "__bucket").agg(F.avg("__t").alias("t"), F.avg(F.col(value).cast("double")).alias("v"))
    # At most max_points rows of a track.
    along = Window.partitionBy(key).orderBy("__bucket")
    sides = means.select(
        key, "__bucket", F.lag("t").over(along).alias("__t0"), F.lag("v").over(along).alias("__v0"),
        F.lead("t").over(along).alias("__t1"), F.lead("v").over(along).alias("__v1"),
    )
    x, y = F.col("__t"), F.col(value).cast("double")
    area = F.abs((x - F.col("__t0")) * (F.col("__v1") - F.col("__v0")) - (F.col("__t1") - F.col("__t0")) * (y - F.col("__v0"))) / 2
    judged = cut.join(sides, [key, "__bucket"]).withColumn("__area", F.round(F.coalesce(area, F.lit(0.0)), 3))
    rank = F.struct(-F.col("__area"), F.col(ts), F.col(row_id))
    return pick_row(judged.select(*df.columns, "__bucket", "__area"), [key, "__bucket"], rank, newest=False).select(*df.columns)


def deltas(
    df: DataFrame,
    columns: dict[str, str],
    key: str = KEY,
    ts: str = TIME,
    row_id: str = ROW_ID,
    slices: Slices | None = None,
) -> DataFrame:
    """Change of each column since the previous row of the key; ``columns`` maps output to input."""
    held = {f"__was_{out}": F.col(source) for out, source in columns.items()}
    scanned = ordered_scan(df, [key], ts, row_id, previous=held, slices=slices)
    changed = {out: F.col(source) - F.col(f"__was_{out}") for out, source in columns.items()}
    return scanned.withColumns(changed).drop(*held)


def stale_fixes(
    df: DataFrame,
    stamp: str = "last_pos_update",
    key: str = KEY,
    ts: str = TIME,
    row_id: str = ROW_ID,
    slices: Slices | None = None,
) -> DataFrame:
    """Mark rows whose position stamp repeats the previous row's."""
    scanned = ordered_scan(df, [key], ts, row_id, previous={"__was": F.col(stamp)}, slices=slices)
    return scanned.withColumn("is_stale", F.coalesce(F.col("__was") == F.col(stamp), F.lit(False))).drop("__was")


def steps(
    df: DataFrame, key: str = KEY, ts: str = TIME, row_id: str = ROW_ID, slices: Slices | None = None
) -> DataFrame:
    """Distance, time and implied speed since the previous fix of the key.

    Rows without a position are left out first, so a step always joins two known positions.
    """
    known = df.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    scanned = ordered_scan(
        known,
        [key],
        ts,
        row_id,
        previous={"__lat": F.col("latitude"), "__lon": F.col("longitude"), "__ts": F.col(ts)},
        slices=slices,
    )
    distance = haversine_m(F.col("__lat"), F.col("__lon"), F.col("latitude"), F.col("longitude"))
    seconds = (_micros(F.col(ts)) - _micros(F.col("__ts"))) / 1e6
    return (
        scanned.withColumn("step_m", distance)
        .withColumn("step_s", seconds)
        .withColumn("implied_mps", F.when(seconds > 0, distance / seconds))
        .drop("__lat", "__lon", "__ts")
    )


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def segments(
    df: DataFrame,
    gap_seconds: int = 1800,
    key: str = KEY,
    ts: str = TIME,
    row_id: str = ROW_ID,
    slices: Slices | None = None,
) -> DataFrame:
    """Number the flights of each key; a gap of at least ``gap_seconds`` starts a new one."""
    if slices is None:
        slices = plan_slices(df, ts, row_id)
    stepped = ordered_scan(df, [key], ts, row_id, previous={"__ts": F.col(ts)}, slices=slices)
    gap = (_micros(F.col(ts)) - _micros(F.col("__ts"))) / 1e6
    return _numbered(stepped.withColumn("__gap", gap).drop("__ts"), "__gap", gap_seconds, key, ts, row_id, slices).drop("__gap")


def _numbered(
    df: DataFrame, gap: str, gap_seconds: int, key: str, ts: str, row_id: str, slices: Slices
) -> DataFrame:
    """Number the flights where the seconds since the previous row are known already."""
    flagged = df.withColumn("__new", F.when(F.col(gap).isNull() | (F.col(gap) >= gap_seconds), 1).otherwise(0))
    if not slices.single:
        # Two branches read the flags; a written copy keeps the first scan from running twice.
        flagged = materialise(flagged, "segment-flags")
    return ordered_scan(
        flagged, [key], ts, row_id, running={"segment": F.col("__new")}, slices=slices
    ).drop("__new")


def segment_routes(
    df: DataFrame,
    gap_seconds: int = 1800,
    key: str = KEY,
    ts: str = TIME,
    row_id: str = ROW_ID,
    slices: Slices | None = None,
) -> DataFrame:
    """One row per flight: start, end, points, duration and flown distance."""
    known = df.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    if slices is None:
        slices = plan_slices(known, ts, row_id)
    stepped = steps(known, key, ts, row_id, slices)
    slim = stepped.select(key, ts, row_id, "step_m", "step_s")
    numbered = _numbered(slim, "step_s", gap_seconds, key, ts, row_id, slices)
    inside = F.when(F.col("step_s") < gap_seconds, F.col("step_m")).cast(EXACT)
    return numbered.groupBy(key, "segment").agg(
        F.min(ts).alias("start_ts"),
        F.max(ts).alias("end_ts"),
        F.count(F.lit(1)).alias("n_points"),
        ((_micros(F.max(ts)) - _micros(F.min(ts))) / 1e6).alias("duration_s"),
        (F.coalesce(F.sum(inside).cast("double"), F.lit(0.0)) / 1000.0).alias("length_km"),
    )


def rolling_features(
    df: DataFrame, seconds: int = 3600, key: str = KEY, ts: str = TIME, slices: Slices | None = None
) -> DataFrame:
    """Observations and mean velocity over the trailing window, one row per (key, instant)."""
    summed = trailing_sums(
        df,
        [key],
        ts,
        seconds,
        {
            "n_obs": F.lit(1).cast("bigint"),
            "n_velocity": F.when(F.col("velocity").isNotNull(), 1).otherwise(0).cast("bigint"),
            "sum_velocity": F.coalesce(F.col("velocity"), F.lit(0.0)).cast(EXACT),
        },
        slices=slices,
    )
    mean = F.when(
        F.col("n_velocity") > 0, F.col("sum_velocity").cast("double") / F.col("n_velocity").cast("double")
    )
    return summed.select(key, ts, "n_obs", mean.alias("avg_velocity"))


def holding_loops(
    df: DataFrame,
    seconds: int = 1200,
    turn_degrees: float = 360.0,
    key: str = KEY,
    ts: str = TIME,
    row_id: str = ROW_ID,
    heading: str = "true_track",
    slices: Slices | None = None,
) -> DataFrame:
    """Instants at which an entity has turned a full circle within the trailing window."""
    known = df.where(F.col(heading).isNotNull())
    row_slices = slices or plan_slices(known, ts, row_id)
    turning = ordered_scan(known, [key], ts, row_id, previous={"__was": F.col(heading)}, slices=row_slices)
    turn = F.coalesce(heading_change(F.col("__was"), F.col(heading)), F.lit(0.0)).cast(EXACT)
    turned = turning.select(key, ts, turn.alias("__turn"))
    if not row_slices.single:
        turned = materialise(turned, "turns")
    summed = trailing_sums(turned, [key], ts, seconds, {"turn_degrees": F.col("__turn")}, slices=slices)
    return summed.where(F.abs("turn_degrees") >= turn_degrees).select(
        key, ts, F.col("turn_degrees").cast("double").alias("turn_degrees")
    )


def glyph_points(df: DataFrame, ts: str = TIME, altitude: str = "baro_altitude") -> DataFrame:
    """Polar coordinates of a day: angle from the time of day, radius from the altitude.

    Midnight is at angle 0 and time runs clockwise. The radius is scaled by the bounds of ``df`` itself;
    a single altitude everywhere gives radius 0.
    """
    known = df.where(F.col(altitude).isNotNull())
    bounds = known.agg(F.struct(F.min(altitude).alias("low"), F.max(altitude).alias("high"))).scalar()
    low, high = bounds["low"], bounds["high"]
    second = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    value = F.col(altitude)
    return (
        known.withColumn("angle", 2 * F.pi() * second / 86400.0)
        .withColumn("radius", F.when(high > low, (value - low) / (high - low)).otherwise(0.0))
        .withColumn("band", altitude_band(value))
    )
