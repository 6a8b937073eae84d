"""Trace search, span RED metrics, single traces and spanset matches."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberscope.functions.attrs import attr
from emberscope.functions.timegrid import bucket
from emberscope.operators.ordered import grouped_percentiles
from emberscope.plans.predicates import (
    all_of,
    in_range,
    span_metrics_predicate,
    span_predicate,
)
from emberscope.plans.specs import SpanFilters, SpanMetricsQuery, TimeRange, TraceQuery
from emberscope.sources.trace_index import TraceIndex, on_days

# Group-by names that mean a span field, not an attribute.
_SPAN_FIELDS = ("name", "kind", "status")

PERCENTILES = {"p50": 0.5, "p95": 0.95, "p99": 0.99}


def _beginning_in(spans: DataFrame, within: TimeRange, index: TraceIndex | None) -> DataFrame:
    """All spans of the traces whose first span starts in the range; whole days outside are not read.

    Candidates have a span in the range. Those with a span before it began earlier and
    are left out; what remains has no span before the range. An index tells the traces and their
    days by itself, so that no span before the range is read.
    """
    time = "start_time_unix_nano"
    if within.start is None and within.end is None:
        return spans
    if index is not None:
        begun = index.beginning_in(within)
        return on_days(spans, begun).join(begun.select("trace_id"), "trace_id", "left_semi")
    begun = spans.where(all_of(in_range(time, within, spans.columns))).select("trace_id").distinct()
    if within.start is not None:
        before = spans.where(all_of(in_range(time, TimeRange(None, within.start), spans.columns)))
        before = before.select("trace_id").join(begun, "trace_id", "left_semi").distinct()
        begun = begun.join(before, "trace_id", "left_anti")
        spans = spans.where(all_of(in_range(time, TimeRange(within.start, None), spans.columns)))
    return spans.join(begun, "trace_id", "left_semi")


def search(spans: DataFrame, q: TraceQuery, index: TraceIndex | None = None) -> DataFrame:
    """Summaries of traces with a span satisfying the query's span conditions.

    One aggregation by trace; every aggregate combines map-side, so a trace
    holding much of the table still arrives as one row per map task. With a time
    range only traces that begin in it are read whole, see :func:`_beginning_in`.
    """
    spans = _beginning_in(spans, q.range, index)
    is_root = F.col("parent_span_id").isNull()
    root = F.struct("start_time_unix_nano", "span_id", "service", "name", "duration_ns")
    start, end = F.col("start_time_unix_nano"), F.col("end_time_unix_nano")
    traces = spans.groupBy("trace_id").agg(
        F.min(F.when(is_root, root)).alias("_root"),
        F.min(start).alias("start_time"),
        (F.max(end) - F.min(start)).alias("_extent"),
        F.count(F.lit(1)).alias("span_count"),
        F.bool_or(F.coalesce(F.col("status") == "ERROR", F.lit(False))).alias("error"),
        F.bool_or(F.coalesce(span_predicate(q, spans.columns), F.lit(False))).alias("_hit"),
    )
    summaries = traces.where(F.col("_hit")).select(
        "trace_id",
        F.col("_root.service").alias("root_service"),
        F.col("_root.name").alias("root_name"),
        "start_time",
        F.coalesce(F.col("_root.duration_ns"), F.col("_extent")).alias("duration_ns"),
        "span_count",
        "error",
    )
    tests = in_range("start_time", q.range)
    if q.service is not None:
        tests.append(F.col("root_service") == q.service)
    if q.min_duration_ns is not None:
        tests.append(F.col("duration_ns") >= q.min_duration_ns)
    if q.max_duration_ns is not None:
        tests.append(F.col("duration_ns") <= q.max_duration_ns)
    return (
        summaries.where(all_of(tests))
        .orderBy(F.col("start_time").desc(), "trace_id")
        .limit(q.row_limit)
    )


def span_metrics(spans: DataFrame, q: SpanMetricsQuery, approximate: bool = False) -> DataFrame:
    """Calls, errors and duration percentiles: ``bucket, g0..gN, calls, errors, p50, p95, p99``.

    Percentiles are exact. ``approximate`` trades that for one pass with
    mergeable sketches.
    """
    groups = [
        (F.col(key) if key in _SPAN_FIELDS else attr(key, spans.columns)).alias(f"g{i}")
        for i, key in enumerate(q.group_by)
    ]
    keys = ["bucket", *[f"g{i}" for i in range(len(groups))]]
    rows = spans.where(span_metrics_predicate(q, spans.columns)).select(
        bucket(F.col("start_time_unix_nano"), q.step_ns).alias("bucket"),
        *groups,
        "duration_ns",
        (F.col("status") == "ERROR").alias("_error"),
    )
    totals = {"calls": F.count(F.lit(1)), "errors": F.count_if("_error")}
    if not approximate:
        return grouped_percentiles(rows, keys, "duration_ns", PERCENTILES, totals)
    sketched = [
        F.percentile_approx("duration_ns", p).cast("double").alias(name)
        for name, p in PERCENTILES.items()
    ]
    return rows.groupBy(*keys).agg(*[t.alias(name) for name, t in totals.items()], *sketched)


def get_trace(spans: DataFrame, trace_id: str, index: TraceIndex | None = None) -> DataFrame:
    """All spans of one trace, in start order; an absent trace has no rows. With an index only its days are read."""
    if not re.fullmatch(r"[0-9A-Fa-f]{32}", trace_id):
        raise ValueError(f"trace id {trace_id!r} is not 32 hex characters")
    if index is not None:
        spans = on_days(spans, index.one(trace_id.lower()))
    return spans.where(F.col("trace_id") == trace_id.lower()).orderBy(
        "start_time_unix_nano", "span_id"
    )


def match(spans: DataFrame, q: SpanFilters, start: int, end: int, service: str | None = None) -> DataFrame:
    """Spans in ``[start, end)`` satisfying the conditions, as ``trace_id, span_id``."""
    tests = in_range("start_time_unix_nano", TimeRange(start, end), spans.columns)
    if service is not None:
        tests.append(F.col("service") == service)
    return spans.where(all_of([*tests, span_predicate(q, spans.columns)])).select(
        "trace_id", "span_id"
    )


def whole_traces(spans: DataFrame, matched: DataFrame, index: TraceIndex | None = None) -> DataFrame:
    """Every span of the traces that have a match; with an index only the days of these traces are read."""
    if index is not None:
        spans = on_days(spans, index.of(matched))
    return spans.join(matched.select("trace_id").distinct(), "trace_id", "left_semi")
