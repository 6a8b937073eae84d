"""Joins across logs, spans and metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberscope.operators.ordered import HALO, chunk_window, with_previous_row
from emberscope.operators.series import LOOKBACK
from emberscope.plans.predicates import all_of

_SPAN_KEYS = ["trace_id", "span_id"]


def _apart(spans: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Prefix span columns whose names the other side has too, join keys excepted."""
    taken = set(other.columns) - set(keys)
    return spans.withColumnsRenamed({c: f"span_{c}" for c in spans.columns if c in taken})


def logs_with_spans(logs: DataFrame, spans: DataFrame, how: str = "inner") -> DataFrame:
    """Logs joined to the span they were written in; ``how`` is inner or left.

    In a left join the logs without a span context bypass the join: their keys
    are null, and shuffling them would send all of them to one task.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"join type {how!r} is not inner or left")
    has_context = F.col("trace_id").isNotNull() & F.col("span_id").isNotNull()
    spans = _apart(spans, logs, _SPAN_KEYS)
    joined = logs.where(has_context).join(spans, _SPAN_KEYS, how)
    if how == "inner":
        return joined
    added = [f for f in spans.schema.fields if f.name not in _SPAN_KEYS]
    alone = logs.where(~has_context).withColumns(
        {f.name: F.lit(None).cast(f.dataType) for f in added}
    )
    return joined.unionByName(alone)


def spans_of_failed_traces(spans: DataFrame) -> DataFrame:
    """All spans of traces that have an error span."""
    failed = spans.where(F.col("status") == "ERROR").select("trace_id").distinct()
    return spans.join(failed, "trace_id", "left_semi")


def traces_without_logs(spans: DataFrame, logs: DataFrame) -> DataFrame:
    """Ids of traces no log refers to: ``trace_id``."""
    logged = logs.where(F.col("trace_id").isNotNull()).select("trace_id").distinct()
    return spans.select("trace_id").distinct().join(logged, "trace_id", "left_anti")


def exemplars_with_spans(exemplars: DataFrame, spans: DataFrame) -> DataFrame:
    """Exemplars joined to the span they were sampled in."""
    return exemplars.join(_apart(spans, exemplars, _SPAN_KEYS), _SPAN_KEYS)


# Interval classes: widths of 2^4k ns. A span is filed under the narrowest class
# not shorter than it and so touches at most two intervals of that class.
_CLASS_BITS = 4


def _class_of(length: Column) -> Column:
    """Smallest k with 2^(4k) >= length."""
    bits = F.length(F.bin(F.greatest(length, F.lit(1).cast("bigint")) - 1))
    bits = F.when(length <= 1, F.lit(0)).otherwise(bits)
    return F.ceil(bits / _CLASS_BITS).cast("int")


def _slot(time: Column, klass: Column) -> Column:
    return F.call_function("shiftright", time, klass * _CLASS_BITS)


def logs_in_spans(logs: DataFrame, spans: DataFrame) -> DataFrame:
    """Logs written during a span of the same service, ``start <= t < end``.

    Span columns that logs have too come out with the prefix ``span_``.

    An equi join on (service, length class, time slot) with the exact time test
    on top. Slot width follows each span's own length, so short spans are only
    tried against logs close by and long ones are not copied into many slots. A
    log is looked up once per length class that occurs, of at most 16.
    """
    spans = _apart(spans, logs, ["service"])
    start, end = F.col("start_time_unix_nano"), F.col("end_time_unix_nano")
    classed = spans.where(end > start).withColumn("_class", _class_of(end - start))
    filed = classed.withColumn(
        "_slot",
        F.explode(F.sequence(_slot(start, F.col("_class")), _slot(end - 1, F.col("_class")))),
    )
    present = classed.agg(F.sort_array(F.collect_set("_class"))).scalar()
    looked_up = (
        logs.withColumn("_classes", present)
        .withColumn("_class", F.explode("_classes"))
        .drop("_classes")
        .withColumn("_slot", _slot(F.col("time_unix_nano"), F.col("_class")))
    )
    time = F.col("time_unix_nano")
    return (
        looked_up.join(filed, ["service", "_class", "_slot"])
        .where((time >= start) & (time < end))
        .drop("_class", "_slot")
    )


def metric_at_log(
    logs: DataFrame,
    points: DataFrame,
    keys: Sequence[str] = ("service",),
    lookback: int = LOOKBACK,
) -> DataFrame:
    """Each log with the newest metric sample of its key in ``(t - lookback, t]``.

    Adds ``metric_time`` and ``metric_value``, null without such a sample. Both
    sides become one timeline on which the sample is carried forward. Of several
    samples at the same time the largest value counts. A log with a null key
    matches nothing and bypasses the timeline.
    """
    keyed = all_of(F.col(k).isNotNull() for k in keys)
    alone = logs.where(~keyed).withColumns(
        {"metric_time": F.lit(None).cast("bigint"), "metric_value": F.lit(None).cast("double")}
    )
    logs, points = logs.where(keyed), points.where(keyed)
    carried = [c for c in logs.columns if c not in keys]
    left = logs.select(
        *keys,
        F.col("time_unix_nano").alias("_t"),
        F.lit(1).alias("_side"),
        F.lit(None).cast("double").alias("_v"),
        F.struct(*carried).alias("_log"),
    )
    none = F.lit(None).cast(left.schema["_log"].dataType)
    right = points.select(
        *keys,
        F.col("time_unix_nano").alias("_t"),
        F.lit(0).alias("_side"),
        F.col("value").alias("_v"),
        none.alias("_log"),
    )
    order = ["_t", "_side", "_v"]
    is_sample = F.col("_side") == 0
    timeline = with_previous_row(left.unionByName(right), keys, order, carried=is_sample)
    newest = F.last(F.when(is_sample, F.struct("_t", "_v")), ignorenulls=True)
    held = timeline.withColumn("_m", newest.over(chunk_window(keys, order))).where(
        ~is_sample & ~F.col(HALO)
    )
    fresh = F.col("_t") - F.col("_m._t") < lookback
    matched = held.select(
        *keys,
        "_log.*",
        F.when(fresh, F.col("_m._t")).alias("metric_time"),
        F.when(fresh, F.col("_m._v")).alias("metric_value"),
    )
    return matched.unionByName(alone)
