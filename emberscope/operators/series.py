"""Series evaluated on a step grid: ``labels, ts, value`` at every step."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberscope.functions.attrs import label_set
from emberscope.functions.timegrid import MINUTE, Grid
from emberscope.operators.metrics import AGGREGATES, identity, increases, recorded, source, stale
from emberscope.plans.predicates import all_of, in_range
from emberscope.plans.specs import TimeRange

# How far back a sample still counts at a step.
LOOKBACK = 5 * MINUTE


def _within(rows: DataFrame, grid: Grid, before: int) -> DataFrame:
    """Rows in ``(start - before, end]``; the range reaches the ``day`` partitions."""
    seen = TimeRange(grid.start - before + 1, grid.end + 1)
    return rows.where(all_of(in_range("time_unix_nano", seen, rows.columns)))


def _fill(rows: DataFrame, grid: Grid) -> DataFrame:
    """One row per step in ``[_first, _last]``, with the step's time as ``ts``."""
    return (
        rows.where(F.col("_first") <= F.col("_last"))
        .withColumn("_step", F.explode(F.sequence("_first", "_last")))
        .withColumn("ts", grid.time_at(F.col("_step")))
    )


def instant_grid(points: DataFrame, grid: Grid, lookback: int = LOOKBACK) -> DataFrame:
    """At each step the latest sample in ``(ts - lookback, ts]`` of every series.

    Only the newest sample of each interval between two steps can ever be the
    latest at a step, so samples are reduced to that one before the shuffle; a
    series then has no more rows than the grid has steps. A stale sample ends
    the series until its next sample.
    """
    time = F.col("time_unix_nano")
    inside = _within(points, grid, lookback)
    newest = F.max(F.struct("time_unix_nano", "value", stale(F.col("flags")).alias("gone")))
    per_slot = (
        inside.groupBy("labels", grid.clip_low(grid.index_at_or_after(time)).alias("_first"))
        .agg(newest.alias("_s"))
    )
    following = F.lead("_first").over(Window.partitionBy("labels").orderBy("_first"))
    expires = grid.index_before(F.col("_s.time_unix_nano") + F.lit(lookback))
    held = per_slot.withColumn(
        "_last", F.least(F.coalesce(following - 1, F.lit(grid.last)), grid.clip_high(expires))
    )
    return _fill(held.where(~F.col("_s.gone")), grid).select(
        "labels", "ts", F.col("_s.value").alias("value")
    )


#: Increases are added up exactly, to so many decimal places; sums of doubles that come and go would not return to zero.
_EXACT = "decimal(38,12)"


def rate(points: DataFrame, grid: Grid, range_ns: int) -> DataFrame:
    """Per-second rate of a cumulative counter over ``(ts - range, ts]``.

    An increase counts at the steps whose window holds both of its samples. A series with fewer than two samples in
    a window has no value there. Every sample enters the window at one step and leaves it at another, so the sum is
    the running total of what entered less what left, less the increase of the oldest sample inside, whose own
    predecessor lies outside. Both are summed per step before the window, which makes a series at most two rows per
    step, however many samples and steps a range holds. A window that meets an increase beyond 10^26, or
    one that is no number, has the value NaN.
    """
    slots = _slots(points, grid, range_ns)
    keys = identity(slots)
    onward = Window.partitionBy(*keys).orderBy("_first")
    upto = onward.rowsBetween(Window.unboundedPreceding, 0)
    later = Window.partitionBy(*keys).orderBy(F.col("_first").desc()).rowsBetween(Window.unboundedPreceding, -1)
    held = slots.select(
        "labels",
        "_first",
        (F.lead("_first").over(onward) - 1).alias("_last"),
        F.sum("_in").over(upto).alias("_sum"),
        F.sum("_n").over(upto).alias("_held"),
        F.sum("_bad").over(upto).alias("_bad"),
        F.last("_oldest", ignorenulls=True).over(later).alias("_oldest"),
    ).where(F.col("_held") > 1)
    seconds = range_ns / 1_000_000_000
    total = (F.col("_sum") - F.col("_oldest.gain")).cast("double")
    value = F.when(F.col("_bad") > F.col("_oldest.odd"), F.lit(float("nan"))).otherwise(total / F.lit(seconds))
    spread = _fill(held.withColumn("value", value), grid)
    if keys == ["labels"]:
        return spread.select("labels", "ts", "value")
    return spread.groupBy("labels", "ts").agg(F.sum("value").alias("value"))


def _slots(points: DataFrame, grid: Grid, range_ns: int) -> DataFrame:
    """What changes for a series at a step: samples and increases that enter and leave, and the oldest sample leaving."""
    time = F.col("time_unix_nano")
    inside = recorded(_within(points, grid, range_ns))
    gained = increases(inside.select("labels", *source(points), "time_unix_nano", "value"))
    gain, none = F.col("increase").try_cast(_EXACT), F.lit(0).cast(_EXACT)
    # What leaves after the last step stands just behind the grid: it may be the oldest sample inside.
    leaves = F.least(grid.clip_low(grid.index_at_or_after(time + F.lit(range_ns))), F.lit(grid.count).cast("bigint"))
    moves = F.array(
        F.struct(grid.clip_low(grid.index_at_or_after(time)).alias("at"), F.lit(1).alias("sign")),
        F.struct(leaves.alias("at"), F.lit(-1).alias("sign")),
    )
    left = F.col("_m.sign") < 0
    oldest = F.when(left, F.struct(F.col("_gain").alias("gain"), F.col("_odd").alias("odd")))
    return (
        gained.withColumn("_odd", F.when(gain.isNull(), 1).otherwise(0))
        .withColumn("_gain", F.coalesce(gain, none))
        .withColumn("_m", F.explode(moves))
        .groupBy(*identity(gained), F.col("_m.at").alias("_first"))
        .agg(
            F.sum(F.when(left, -F.col("_gain")).otherwise(F.col("_gain"))).alias("_in"),
            F.sum("_m.sign").alias("_n"),
            F.sum(F.col("_m.sign") * F.col("_odd")).alias("_bad"),
            F.min_by(oldest, F.when(left, F.struct("time_unix_nano", "value"))).alias("_oldest"),
        )
    )


def aggregate(series: DataFrame, aggregation: str, by: Sequence[str] = ()) -> DataFrame:
    """Combine the series of each step, grouped by some of their labels."""
    if aggregation not in AGGREGATES:
        raise ValueError(f"aggregation {aggregation!r} is not one of {', '.join(AGGREGATES)}")
    names = {key: f"_g{i}" for i, key in enumerate(by)}
    groups = [_json_label(key).alias(name) for key, name in names.items()]
    combined = series.groupBy("ts", *groups).agg(
        AGGREGATES[aggregation]("value").cast("double").alias("value")
    )
    labels = label_set({key: F.col(name) for key, name in names.items()})
    return combined.select(labels.alias("labels"), "ts", "value")


def _json_label(key: str) -> Column:
    """A label out of the canonical JSON; keys may hold dots."""
    return F.try_element_at(F.from_json("labels", "MAP<STRING,STRING>"), F.lit(key))


def count_over_time(logs: DataFrame, grid: Grid, range_ns: int) -> DataFrame:
    """Rows per service in ``(ts - range, ts]`` at each step: ``labels, ts, value``.

    Each row adds one at the first step that sees it and takes it away after the
    last. Those changes are summed per step before the running total, so a
    service has at most two rows per step whatever its log volume.
    """
    time = F.col("time_unix_nano")
    inside = _within(logs, grid, range_ns)
    enters = grid.clip_low(grid.index_at_or_after(time))
    leaves = grid.index_at_or_after(time + F.lit(range_ns))
    changes = (
        inside.groupBy("service", enters.alias("_in"), leaves.alias("_out"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_in") < F.col("_out"))
        .select(
            "service",
            F.explode(
                F.array(
                    F.struct(F.col("_in").alias("at"), F.col("_n").alias("n")),
                    F.struct(F.col("_out").alias("at"), (-F.col("_n")).alias("n")),
                )
            ).alias("_c"),
        )
        .groupBy("service", F.col("_c.at").alias("_first"))
        .agg(F.sum("_c.n").alias("_n"))
    )
    in_order = Window.partitionBy("service").orderBy("_first")
    levels = changes.select(
        "service",
        "_first",
        F.sum("_n").over(in_order.rowsBetween(Window.unboundedPreceding, 0)).alias("_level"),
        grid.clip_high(F.lead("_first").over(in_order) - 1).alias("_last"),
    ).where(F.col("_level") > 0)
    return _fill(levels, grid).select(
        label_set({"service": F.col("service")}).alias("labels"),
        "ts",
        F.col("_level").cast("double").alias("value"),
    )
