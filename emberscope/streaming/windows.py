"""Windowed streaming aggregates with watermarks, and duplicate removal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberscope.functions.timegrid import bucket, timestamp_of

EVENT_TIME = "_ts"


def _micros(ns: int) -> str:
    return f"{ns // 1000} microseconds"


def with_event_time(rows: DataFrame, time: str, delay_ns: int) -> DataFrame:
    """Add the TIMESTAMP that watermarks and windows work on."""
    return rows.withColumn(EVENT_TIME, timestamp_of(F.col(time))).withWatermark(
        EVENT_TIME, _micros(delay_ns)
    )


def _start(window: str = "window") -> Column:
    return F.unix_micros(f"{window}.start") * 1000


def _end(window: str = "window") -> Column:
    return F.unix_micros(f"{window}.end") * 1000


def volume(logs: DataFrame, step_ns: int, delay_ns: int) -> DataFrame:
    """Rows per tumbling bucket and service; rows behind the watermark are left out."""
    return (
        with_event_time(logs, "time_unix_nano", delay_ns)
        .groupBy(F.window(EVENT_TIME, _micros(step_ns)), "service")
        .agg(F.count(F.lit(1)).alias("count"))
        .select(_start().alias("bucket_time"), "service", "count")
    )


PERCENTILES = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
#: Size of the quantile sketches: ranks are off by about 0.65 % of a group at most; up to so many values are kept exactly.
SKETCH_K = 400


def red_sketches(spans: DataFrame, step_ns: int, delay_ns: int) -> DataFrame:
    """Calls, errors and a mergeable sketch of durations per bucket and service: ``bucket, service, calls, errors, durations``."""
    return (
        with_event_time(spans, "start_time_unix_nano", delay_ns)
        .groupBy(F.window(EVENT_TIME, _micros(step_ns)), "service")
        .agg(
            F.count(F.lit(1)).alias("calls"),
            F.count_if(F.col("status") == "ERROR").alias("errors"),
            F.kll_sketch_agg_bigint("duration_ns", SKETCH_K).alias("durations"),
        )
        .select(_start().alias("bucket"), "service", "calls", "errors", "durations")
    )


def red_counts(spans: DataFrame, step_ns: int, delay_ns: int) -> DataFrame:
    """Calls and errors per bucket, service and duration: ``bucket, service, duration_ns, calls, errors``.

    What :func:`exact_red` needs. Rows of a bucket are spread over its durations, so no state holds a bucket.
    """
    return (
        with_event_time(spans, "start_time_unix_nano", delay_ns)
        .groupBy(F.window(EVENT_TIME, _micros(step_ns)), "service", "duration_ns")
        .agg(F.count(F.lit(1)).alias("calls"), F.count_if(F.col("status") == "ERROR").alias("errors"))
        .select(_start().alias("bucket"), "service", "duration_ns", "calls", "errors")
    )


def exact_red(counts: DataFrame) -> DataFrame:
    """Stored :func:`red_counts` read out as :func:`red` does, with exact percentiles whatever the size of a bucket.

    A percentile is the least duration that so many of the bucket's spans do not exceed.
    """
    keys = ["bucket", "service"]
    timed = F.col("duration_ns").isNotNull()
    # Counts are merged first, as later appends may repeat a duration.
    merged = counts.groupBy(*keys, "duration_ns").agg(F.sum("calls").alias("calls"), F.sum("errors").alias("errors"))
    own = Window.partitionBy(*keys)
    weight = F.when(timed, F.col("calls")).otherwise(0)
    reached = F.sum(weight).over(own.orderBy("duration_ns").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = merged.withColumns({"_n": F.sum(weight).over(own), "_reached": reached})
    values = [
        F.min(F.when(timed & (F.col("_reached") * 100 >= F.col("_n") * round(p * 100)), F.col("duration_ns"))).alias(name)
        for name, p in PERCENTILES.items()
    ]
    return ranked.groupBy(*keys).agg(F.sum("calls").alias("calls"), F.sum("errors").alias("errors"), *values)


def coarser(sketches: DataFrame, step_ns: int, fine_ns: int | None = None) -> DataFrame:
    """Stored :func:`red_sketches` merged to longer buckets, without a look at the spans.

    ``fine_ns``, the step they were made with, is checked to divide the new one, if given.
    """
    if fine_ns is not None and step_ns % fine_ns:
        raise ValueError(f"{step_ns} is no multiple of {fine_ns}")
    return sketches.groupBy(bucket(F.col("bucket"), step_ns).alias("bucket"), "service").agg(
        F.sum("calls").alias("calls"), F.sum("errors").alias("errors"), F.kll_merge_agg_bigint("durations").alias("durations")
    )


def red(sketches: DataFrame) -> DataFrame:
    """Sketches read out: ``bucket, service, calls, errors, p50, p95, p99``; a percentile is a duration that occurred."""
    held = F.kll_sketch_get_n_bigint("durations") > 0
    values = [F.when(held, F.kll_sketch_get_quantile_bigint("durations", F.lit(p))).alias(name) for name, p in PERCENTILES.items()]
    return sketches.select("bucket", "service", "calls", "errors", *values)


def span_metrics(spans: DataFrame, step_ns: int, delay_ns: int) -> DataFrame:
    """Calls, errors and sketched duration percentiles per bucket and service."""
    return red(red_sketches(spans, step_ns, delay_ns))


def count_over_time(logs: DataFrame, range_ns: int, step_ns: int, delay_ns: int) -> DataFrame:
    """Rows per service in the sliding window ``[ts - range, ts)`` at each step."""
    return (
        with_event_time(logs, "time_unix_nano", delay_ns)
        .groupBy(F.window(EVENT_TIME, _micros(range_ns), _micros(step_ns)), "service")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("service", _end().alias("ts"), F.col("_n").cast("double").alias("value"))
    )


def distinct_spans(spans: DataFrame, delay_ns: int) -> DataFrame:
    """Spans without repeated deliveries, recognised within the watermark delay."""
    return (
        with_event_time(spans, "start_time_unix_nano", delay_ns)
        .dropDuplicatesWithinWatermark(["trace_id", "span_id"])
        .drop(EVENT_TIME)
    )
