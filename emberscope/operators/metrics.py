"""Scalar metric queries: range, rate, instant, raw points."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberscope.functions.attrs import attr
from emberscope.functions.timegrid import SECOND, bucket
from emberscope.operators.ordered import HALO, chunk_window, with_previous_row
from emberscope.plans.predicates import points_predicate, series_predicate
from emberscope.plans.specs import MetricQuery, PointsQuery

AGGREGATES: dict[str, Callable[[Column], Column]] = {
    "sum": F.sum,
    "avg": F.avg,
    "min": F.min,
    "max": F.max,
    "count": F.count,
}

_POINT_COLUMNS = ("time_unix_nano", "service", "metric", "labels")


def recorded(points: DataFrame) -> DataFrame:
    """Points that carry a value: flag bit 0 (no recorded value) not set."""
    return points.where(~stale(F.col("flags")))


def stale(flags: Column) -> Column:
    return F.coalesce(flags, F.lit(0)).bitwiseAND(F.lit(1)) == 1


def group_columns(keys: Sequence[str], columns: Sequence[str]) -> list[Column]:
    """Group-by labels as columns ``g0..gN``."""
    return [attr(key, columns).alias(f"g{i}") for i, key in enumerate(keys)]


def _series(points: DataFrame, q: MetricQuery) -> DataFrame:
    return recorded(points.where(series_predicate(q, points.columns)))


def range_query(points: DataFrame, q: MetricQuery) -> DataFrame:
    """Aggregated value per step bucket and group: ``bucket, g0..gN, v``."""
    rows = _series(points, q)
    groups = group_columns(q.group_by, points.columns)
    names = [f"g{i}" for i in range(len(groups))]
    at = bucket(F.col("time_unix_nano"), q.step_ns).alias("bucket")
    seconds = q.step_ns / SECOND
    if q.rate == "off":
        value = AGGREGATES[q.aggregation](F.col("value")).cast("double").alias("v")
        return rows.groupBy(at, *groups).agg(value)

    if q.rate == "counter":
        gained = increases(rows.select("labels", *source(points), "time_unix_nano", "value", *groups))
        rows, gain = gained, F.col("increase")
    else:
        rows = rows.select("labels", *source(points), "time_unix_nano", "value", *groups)
        gain = F.col("value")
    if q.aggregation == "sum":
        # Sums of sums: no need to go through the single series first.
        return rows.groupBy(at, *names).agg((F.sum(gain) / F.lit(seconds)).alias("v"))
    per_series = rows.groupBy(at, *identity(rows), *names).agg((F.sum(gain) / F.lit(seconds)).alias("_v"))
    value = AGGREGATES[q.aggregation](F.col("_v")).cast("double").alias("v")
    return per_series.groupBy("bucket", *names).agg(value)


_SOURCE = "_resource"


def source(points: DataFrame) -> list[Column]:
    """What tells apart series of equal labels: the resource they come from, as a hash."""
    if "resource" not in points.columns:
        return []
    return [F.xxhash64(F.sort_array(F.map_entries("resource"))).alias(_SOURCE)]


def identity(samples: DataFrame) -> list[str]:
    return ["labels", *([_SOURCE] if _SOURCE in samples.columns else [])]


def increases(samples: DataFrame) -> DataFrame:
    """Reset-aware increase of every cumulative sample over the one before it.

    Takes ``labels, time_unix_nano, value`` and any constant-per-series columns;
    adds ``previous_time`` and ``increase``. Samples from different resources are
    different series, if :func:`source` is among the columns. After a reset the whole new value
    counts; the first sample of a series has increase 0 and no previous time.
    """
    keys, order = identity(samples), ["time_unix_nano", "value"]
    w = chunk_window(keys, order)
    previous = F.lag(F.struct(*order)).over(w)
    return (
        with_previous_row(samples, keys, order)
        .withColumn("_previous", previous)
        .where(~F.col(HALO))
        .select(
            *samples.columns,
            F.col("_previous.time_unix_nano").alias("previous_time"),
            increase(F.col("value"), F.col("_previous.value")).alias("increase"),
        )
    )


def increase(value: Column, previous: Column) -> Column:
    return (
        F.when(previous.isNull(), F.lit(0.0))
        .when(value >= previous, value - previous)
        .otherwise(value)
    )


def instant(points: DataFrame, q: MetricQuery) -> DataFrame:
    """Last sample of every series in the range: ``labels, timestamp, value``."""
    newest = F.max(F.struct("time_unix_nano", "value")).alias("_s")
    return (
        _series(points, q)
        .groupBy("labels")
        .agg(newest)
        .select(
            "labels",
            F.col("_s.time_unix_nano").alias("timestamp"),
            F.col("_s.value").alias("value"),
        )
    )


def points(table: DataFrame, q: PointsQuery) -> DataFrame:
    """Raw samples, newest first. Histogram rows carry bounds and bucket counts."""
    values = ("explicit_bounds", "bucket_counts") if q.kind == "histogram" else ("value",)
    newest = [F.col("time_unix_nano").desc(), F.col("metric"), F.col("labels"), *values]
    return (
        table.where(points_predicate(q, table.columns))
        .orderBy(*newest)
        .limit(q.row_limit)
        .select(*_POINT_COLUMNS, *values)
    )


def summary_quantiles(summaries: DataFrame) -> DataFrame:
    """One row per (series, time, quantile) of a summary table."""
    return summaries.select(
        *_POINT_COLUMNS, F.explode("quantile_values").alias("_q")
    ).select(
        *_POINT_COLUMNS,
        F.col("_q.quantile").alias("quantile"),
        F.col("_q.value").alias("value"),
    )


