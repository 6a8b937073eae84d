from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberscope.operators import correlate, ordered, traces
from emberscope.operators.ordered import HALO, chunk_window, grouped_percentiles
from emberscope.operators.ordered import with_previous_row, with_previous_rows
from emberscope.plans.specs import SpanFilters, SpanMetricsQuery, TimeRange, TraceQuery
from tests.helpers import S, logs, samples, spans, tuples

A, B = "a" * 32, "b" * 32


def span(trace, sid, parent, start, end, **more):
    return {
        "trace_id": trace,
        "span_id": sid,
        "parent_span_id": parent,
        "start_time_unix_nano": start,
        "end_time_unix_nano": end,
        "duration_ns": end - start,
        **more,
    }


@pytest.fixture(scope="module")
def two(spark):
    return spans(
        spark,
        span(A, "1", None, 10, 50, name="GET /cart", service="web"),
        span(A, "2", "1", 20, 90, name="query", service="db", status="ERROR", attributes={"k": "v"}),
        span(B, "3", "gone", 5, 25, name="GET /cart", service="db"),
        span(B, "4", "3", 7, 30, name="query", service="web"),
    )


def test_search_summaries(two):
    assert tuples(traces.search(two, TraceQuery())) == [
        (A, "web", "GET /cart", 10, 40, 2, True),
        (B, None, None, 5, 25, 2, False),  # no root: extent of the trace
    ]
    assert [r[0] for r in tuples(traces.search(two, TraceQuery(service="web")))] == [A]
    assert traces.search(two, TraceQuery(service="db")).count() == 0


def test_search_conditions_hold_on_one_span_together(two):
    assert traces.search(two, TraceQuery(name="query", status="error")).count() == 1
    assert traces.search(two, TraceQuery(name="GET /cart", status="error")).count() == 0
    assert traces.search(two, TraceQuery(text="cart")).count() == 2
    assert traces.search(two, TraceQuery(attr_exists=["k"])).count() == 1


def test_search_duration_range_and_limit(two):
    assert [r[0] for r in tuples(traces.search(two, TraceQuery(min_duration_ns=40)))] == [A]
    assert [r[0] for r in tuples(traces.search(two, TraceQuery(max_duration_ns=39)))] == [B]
    assert [r[0] for r in tuples(traces.search(two, TraceQuery(range=TimeRange(5, 10))))] == [B]
    assert [r[0] for r in traces.search(two, TraceQuery(limit=1)).collect()] == [A]
    assert TraceQuery().row_limit == 20


def test_get_trace(two):
    assert [r.span_id for r in traces.get_trace(two, A.upper()).collect()] == ["1", "2"]
    absent = traces.get_trace(two, "0" * 32)
    assert absent.count() == 0 and absent.columns == two.columns
    with pytest.raises(ValueError):
        traces.get_trace(two, "not-a-hex-id")


def test_spanset_match_and_whole_traces(two):
    matched = traces.match(two, SpanFilters(kind="server", name="query"), 0, 10)
    assert tuples(matched) == [(B, "4")]
    assert tuples(traces.whole_traces(two, matched), "span_id") == [("3",), ("4",)]
    with pytest.raises(ValueError):
        SpanFilters(kind="SIDEWAYS")


def test_red_groups_by_missing_key_and_field(spark):
    rows = spans(
        spark,
        *[span(A, str(i), None, 0, d, attributes={"z": "1"}) for i, d in enumerate((10, 20, 40))],
        span(A, "9", None, 0, 7, status="ERROR"),
    )
    got = tuples(traces.span_metrics(rows, SpanMetricsQuery(group_by=["z"])))
    assert got == [(0, "1", 3, 0, 20.0, 38.0, 39.6), (0, None, 1, 1, 7.0, 7.0, 7.0)]
    by_status = tuples(traces.span_metrics(rows, SpanMetricsQuery(group_by=["status"])), "g0", "calls")
    assert by_status == [("ERROR", 1), ("UNSET", 3)]
    approximate = traces.span_metrics(rows, SpanMetricsQuery(), approximate=True)
    assert approximate.columns == ["bucket", "calls", "errors", "p50", "p95", "p99"]


# --- order-dependent steps on skewed keys -------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of the rows in one key, a third of those at the same time."""
    i = F.col("id")
    key = F.when(i % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), (i % 7).cast("string")))
    t = F.when(i % 6 == 0, 500).otherwise((i * 7919) % 1000)
    return spark.range(3000).select(key.alias("key"), t.alias("t"), i.alias("n"), ((i * 31) % 257).alias("v"))


def expected_previous(rows, k):
    out = {}
    for key in {r.key for r in rows}:
        mine = sorted((r.t, r.n, r.v) for r in rows if r.key == key)
        for at, (t, n, _) in enumerate(mine):
            out[(key, t, n)] = [v for _, _, v in mine[max(0, at - k) : at]]
    return out


@pytest.mark.parametrize("chunks", [2, 3, 16, 61])
def test_previous_row_across_chunks(skewed, chunks):
    framed = with_previous_row(skewed, ["key"], ["t", "n"], chunks=chunks)
    lagged = framed.withColumn("p", F.lag("v").over(chunk_window(["key"], ["t", "n"]))).where(~F.col(HALO))
    want = expected_previous(skewed.collect(), 1)
    got = {(r.key, r.t, r.n): [] if r.p is None else [r.p] for r in lagged.collect()}
    assert got == want


@pytest.mark.parametrize("chunks", [2, 40])
def test_previous_rows_across_chunks(skewed, chunks):
    framed = with_previous_rows(skewed, ["key"], ["t", "n"], 5, chunks=chunks)
    w = chunk_window(["key"], ["t", "n"]).rowsBetween(-5, -1)
    seen = framed.withColumn("p", F.collect_list("v").over(w)).where(~F.col(HALO))
    assert {(r.key, r.t, r.n): r.p for r in seen.collect()} == expected_previous(skewed.collect(), 5)


def test_chunks_bound_the_group_size(skewed):
    sizes = (
        with_previous_row(skewed, ["key"], ["n"], chunks=30).groupBy("key", "_chunk").count().collect()
    )
    assert max(r["count"] for r in sizes) < 3 * 3000 / 30


@pytest.mark.parametrize("chunks", [2, 9, 64])
def test_percentiles_match_numpy(skewed, chunks):
    fractions = {"p0": 0.0, "p37": 0.37, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    totals = {"calls": F.count(F.lit(1))}
    got = grouped_percentiles(skewed, ["key"], "v", fractions, totals, chunks)
    rows = skewed.collect()
    for r in got.collect():
        values = [x.v for x in rows if x.key == r.key]
        assert r.calls == len(values)
        assert np.allclose([r[n] for n in fractions], np.quantile(values, list(fractions.values())))
    assert got.count() == 8


def test_only_large_keys_are_cut_into_chunks(skewed, monkeypatch):
    whole = with_previous_row(skewed, ["key"], ["t", "n"])
    assert [r[0] for r in whole.select("_chunk").distinct().collect()] == [0]
    monkeypatch.setattr(ordered, "ROWS_PER_TASK", 400)
    assert ordered.chunks_needed(skewed.where("key <> 'hot'"), ["key"]) == 1
    assert ordered.chunks_needed(skewed, ["key"]) == 4  # the rows of the hot key alone
    assert ordered.chunks_needed(skewed.where("v < 0"), ["key"]) == 1
    cut = with_previous_row(skewed, ["key"], ["t", "n"])
    assert cut.select("_chunk").distinct().count() > 1
    assert [r[0] for r in cut.where("key <> 'hot'").select("_chunk").distinct().collect()] == [0]
    assert cut.where("_halo AND key <> 'hot'").count() == 0
    lagged = cut.withColumn("p", F.lag("v").over(chunk_window(["key"], ["t", "n"]))).where(~F.col(HALO))
    want = expected_previous(skewed.collect(), 1)
    assert {(r.key, r.t, r.n): [] if r.p is None else [r.p] for r in lagged.collect()} == want


def test_percentiles_are_the_same_at_every_size(spark, skewed, monkeypatch):
    fractions = {"p1": 0.01, "p37": 0.37, "p50": 0.5, "p95": 0.95, "p999": 0.999}
    rows = skewed.withColumn("v", F.col("v") / 7)
    whole = tuples(grouped_percentiles(rows, ["key"], "v", fractions, {"calls": F.count(F.lit(1))}))
    for chunks in (2, 7, 64):
        assert tuples(grouped_percentiles(rows, ["key"], "v", fractions, {"calls": F.count(F.lit(1))}, chunks)) == whole
    monkeypatch.setattr(ordered, "ROWS_PER_TASK", 100)
    assert tuples(grouped_percentiles(rows, ["key"], "v", fractions, {"calls": F.count(F.lit(1))})) == whole


def test_a_value_that_dominates_a_group_counts_once(spark, monkeypatch):
    i = F.col("id")
    rows = spark.range(20_000).select(F.when(i % 2 == 0, F.lit("hot")).alias("key"), F.when(i % 20 < 18, 7).otherwise(i % 900).alias("v"))
    monkeypatch.setattr(ordered, "ROWS_PER_TASK", 500)
    weighted = rows.groupBy("key", "v").count()
    assert ordered.chunks_needed(rows, ["key"]) == 40 and ordered.chunks_needed(weighted, ["key"]) == 1
    got = {r.key: r for r in grouped_percentiles(rows, ["key"], "v", {"p50": 0.5, "p95": 0.95}).collect()}
    for key in (None, "hot"):
        values = sorted(7 if n % 20 < 18 else n % 900 for n in range(20_000) if (n % 2 == 0) == (key == "hot"))
        assert np.allclose([got[key].p50, got[key].p95], np.quantile(values, [0.5, 0.95]))


def test_percentiles_of_nothing(skewed):
    nothing = skewed.where("v < 0")
    assert grouped_percentiles(nothing, ["key"], "v", {"p50": 0.5}).count() == 0


# --- joins -----------------------------------------------------------------------------


def test_left_join_keeps_logs_without_span(spark, two):
    rows = logs(
        spark,
        {"time_unix_nano": 1, "body": "in", "trace_id": A, "span_id": "2"},
        {"time_unix_nano": 2, "body": "lost", "trace_id": A, "span_id": "77"},
        {"time_unix_nano": 3, "body": "none"},
    )
    left = correlate.logs_with_spans(rows, two, "left")
    assert tuples(left, "body", "name") == [("in", "query"), ("lost", None), ("none", None)]
    assert tuples(correlate.logs_with_spans(rows, two), "body", "span_service") == [("in", "db")]
    with pytest.raises(ValueError):
        correlate.logs_with_spans(rows, two, "outer")


def test_logs_in_spans_against_brute_force(spark):
    made = [
        span(A, f"s{i}", None, start, start + length, service="ab"[i % 2])
        for i, (start, length) in enumerate(
            [(0, 1), (5, 3), (7, 64), (8, 65), (100, 0), (100, 1000), (511, 2), (600, 512), (-50, 120)]
        )
    ]
    times = [*range(-60, 130), 511, 512, 513, 599, 600, 1099, 1100, 1111, 1112]
    rows = logs(spark, *[{"time_unix_nano": t, "service": s, "body": str(t)} for t in times for s in "ab"])
    got = tuples(correlate.logs_in_spans(rows, spans(spark, *made)), "service", "time_unix_nano", "span_span_id")
    want = [
        (m["service"], t, m["span_id"])
        for t in times
        for m in made
        if m["start_time_unix_nano"] <= t < m["end_time_unix_nano"]
    ]
    assert got == sorted(want, key=repr)


def test_asof_lookback_and_ties(spark):
    points = samples(
        spark,
        "metrics_gauge",
        {"time_unix_nano": 10 * S, "value": 1.0},
        {"time_unix_nano": 10 * S, "value": 5.0},
        {"time_unix_nano": 20 * S, "value": 2.0},
        {"time_unix_nano": 20 * S, "value": 9.0, "service": "b"},
    )
    rows = logs(spark, *[{"time_unix_nano": t * S, "service": "a", "body": "x"} for t in (9, 10, 19, 20, 320)])
    got = correlate.metric_at_log(rows, points)
    assert [(t // S, v) for t, v in sorted(tuples(got, "time_unix_nano", "metric_value"))] == [
        (9, None), (10, 5.0), (19, 5.0), (20, 2.0), (320, None),
    ]


def test_semi_and_anti(spark, two):
    assert tuples(correlate.spans_of_failed_traces(two), "span_id") == [("1",), ("2",)]
    rows = logs(spark, {"time_unix_nano": 1, "trace_id": A}, {"time_unix_nano": 1})
    assert tuples(correlate.traces_without_logs(two, rows)) == [(B,)]
