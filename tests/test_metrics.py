from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from emberscope import schema
from emberscope.functions.quantiles import explicit_buckets, linear_quantile
from emberscope.functions.timegrid import Grid
from emberscope.operators import discovery, histograms, metrics, series
from emberscope.plans.specs import ExpHistogramQuery, HistogramQuery, MetricQuery, PointsQuery
from tests.helpers import S, samples, table, tuples


def counter(spark, *points, labels="{}"):
    return samples(
        spark, schema.SUM, *[{"time_unix_nano": t, "value": float(v), "labels": labels} for t, v in points]
    )


def test_counter_rate_resets_and_single_sample(spark):
    rows = counter(spark, (0, 10), (10 * S, 15), (20 * S, 3), (70 * S, 4)).unionByName(
        counter(spark, (5 * S, 100), labels='{"x":"y"}')
    )
    q = MetricQuery(metric="m", table=schema.SUM, rate="counter", step_ns=60 * S)
    # 5 before the reset, 3 after it; then 1. The lone sample adds nothing.
    assert tuples(metrics.range_query(rows, q)) == [(0, 8 / 60), (60 * S, 1 / 60)]


def test_delta_rate_and_default_aggregations(spark):
    rows = counter(spark, (0, 3), (30 * S, 3))
    q = MetricQuery(metric="m", table=schema.SUM, rate="delta", step_ns=60 * S)
    assert tuples(metrics.range_query(rows, q)) == [(0, 0.1)]
    assert MetricQuery(metric="m").aggregation == "avg"
    assert MetricQuery(metric="m", table=schema.SUM).aggregation == "sum"
    assert MetricQuery(metric="m").step_ns == 60 * S


def test_label_selectors_treat_missing_as_empty(spark):
    rows = samples(
        spark,
        schema.GAUGE,
        {"time_unix_nano": 1, "value": 1.0, "attributes": {"zone": "a"}},
        {"time_unix_nano": 2, "value": 2.0, "attributes": {"zone": ""}},
        {"time_unix_nano": 3, "value": 3.0},
    )

    def hits(*f):
        q = MetricQuery(metric="m", aggregation="sum", step_ns=1, filters=f)
        return [v for _, v in tuples(metrics.range_query(rows, q))]

    assert hits(("zone", "=", "")) == [2.0, 3.0]
    assert hits(("zone", "!=", "")) == [1.0]
    assert hits(("zone", "=~", "a?")) == [1.0, 2.0, 3.0]
    assert hits(("zone", "!~", "a")) == [2.0, 3.0]
    with pytest.raises(ValueError):
        MetricQuery(metric="m", filters=[("zone", "~", "a")])


def test_stale_points_do_not_count(spark):
    rows = samples(
        spark,
        schema.GAUGE,
        {"time_unix_nano": 1, "value": 1.0},
        {"time_unix_nano": 2, "value": 0.0, "flags": 1},
    )
    assert metrics.recorded(rows).count() == 1
    assert tuples(metrics.instant(rows, MetricQuery(metric="m"))) == [("{}", 1, 1.0)]


def test_points_limit_zero_is_hundred_and_newest_first(spark):
    rows = samples(spark, schema.GAUGE, *[{"time_unix_nano": t, "value": 1.0} for t in range(150)])
    got = metrics.points(rows, PointsQuery(kind="gauge")).collect()
    assert len(got) == 100 and got[0].time_unix_nano == 149
    empty = metrics.points(rows, PointsQuery(kind="gauge", metric="other"))
    assert empty.count() == 0 and "value" in empty.columns


def test_instant_grid_gap_and_staleness(spark):
    rows = samples(
        spark,
        schema.GAUGE,
        {"time_unix_nano": 0, "value": 1.0},
        {"time_unix_nano": 125 * S, "value": 2.0},
        {"time_unix_nano": 190 * S, "value": 0.0, "flags": 1},
        {"time_unix_nano": 600 * S, "value": 3.0},
    )
    grid = Grid(0, 960 * S, 60 * S)
    got = {t // S: v for _, t, v in tuples(series.instant_grid(rows, grid))}
    held = {0: 1.0, 60: 1.0, 120: 1.0, 180: 2.0, **{t: 3.0 for t in range(600, 900, 60)}}
    assert got == held  # (t - 5m, t]: 900 is just out of reach of 600


def test_rate_needs_two_samples_inside_the_window(spark):
    rows = counter(spark, (10 * S, 1), (50 * S, 5), (130 * S, 2))
    grid = Grid(0, 240 * S, 60 * S)
    got = {t // S: round(v * 60, 6) for _, t, v in tuples(series.rate(rows, grid, 60 * S))}
    assert got == {60: 4.0}
    wide = {t // S: round(v * 120, 6) for _, t, v in tuples(series.rate(rows, grid, 120 * S))}
    assert wide == {60: 4.0, 120: 4.0}


def brute_rate(points, grid, range_ns):
    out = {}
    for i in range(grid.count):
        ts = grid.start + i * grid.step
        window = [p for p in points if ts - range_ns < p[0] <= ts]
        if len(window) >= 2:
            gain = sum(b - a if b >= a else b for (_, a), (_, b) in zip(window, window[1:]))
            out[ts] = gain / (range_ns / S)
    return out


def test_rate_against_brute_force(spark):
    points = [(7 * i * S + (i * i % 5) * S, (i * 37) % 101) for i in range(200)]
    points.sort()
    grid = Grid(30 * S, 1300 * S, 17 * S)
    for span in (20 * S, 65 * S, 301 * S):
        got = {t: v for _, t, v in tuples(series.rate(counter(spark, *points), grid, span))}
        want = brute_rate(points, grid, span)
        assert got.keys() == want.keys()
        assert all(math.isclose(got[t], want[t], abs_tol=1e-9) for t in want)


def test_rate_stays_at_two_rows_a_step(spark):
    points = [(i * S, (i * 37) % 101) for i in range(2000)]
    grid = Grid(0, 2000 * S, 100 * S)
    rows = counter(spark, *points).unionByName(counter(spark, *points, labels='{"x":"y"}'))
    assert series._slots(rows, grid, 1000 * S).count() <= 2 * (grid.count + 1)
    fine = Grid(0, 2000 * S, S // 2)  # far more steps than samples: two rows a sample
    assert series._slots(rows, fine, 1000 * S).count() <= 2 * 2 * 2000
    got = {t: v for k, t, v in tuples(series.rate(rows, grid, 1000 * S)) if k == "{}"}
    want = brute_rate(points, grid, 1000 * S)
    assert got.keys() == want.keys() and all(math.isclose(got[t], want[t], abs_tol=1e-9) for t in want)


def test_rate_of_values_that_are_no_numbers(spark):
    rows = counter(spark, (0, 1), (10 * S, math.nan), (20 * S, 1e300), (30 * S, 5), (40 * S, 7), (50 * S, 7.25))
    got = {t // S: v for _, t, v in tuples(series.rate(rows, Grid(0, 60 * S, 10 * S), 20 * S))}
    assert math.isnan(got[10]) and math.isnan(got[20]) and got[40] == 0.1 and got[50] == 0.0125 and 60 not in got


def test_series_aggregate_over_labels(spark):
    rows = spark.createDataFrame(
        [('{"a":"1","b":"x"}', 5, 2.0), ('{"a":"1","b":"y"}', 5, 3.0), ('{"b":"z"}', 5, 7.0)],
        "labels STRING, ts BIGINT, value DOUBLE",
    )
    assert tuples(series.aggregate(rows, "sum", ["a"])) == [('{"a":"1"}', 5, 5.0), ("{}", 5, 7.0)]
    assert tuples(series.aggregate(rows, "max")) == [("{}", 5, 7.0)]
    with pytest.raises(ValueError):
        series.aggregate(rows, "median")


def test_grid_limits():
    with pytest.raises(ValueError):
        Grid(10, 0, 1)
    with pytest.raises(ValueError):
        Grid(0, 100, 1, most=100)
    assert Grid(0, 99, 0, most=100).count == 100
    assert Grid(0, 50_000, 1).count == 50_001


def quantile_of(spark, bounds, counts, phi):
    row = spark.createDataFrame([(bounds, counts)], "b ARRAY<DOUBLE>, c ARRAY<BIGINT>")
    return row.select(linear_quantile(explicit_buckets(F.col("b"), F.col("c")), phi)).first()[0]


@pytest.mark.parametrize(
    "bounds, counts, phi, want",
    [
        ([10.0, 20.0], [0, 10, 0], 0.5, 15.0),
        ([10.0, 20.0], [10, 0, 0], 0.5, 5.0),
        ([-5.0, 20.0], [4, 0, 0], 0.5, -5.0),
        ([10.0, 20.0], [0, 0, 7], 0.5, 20.0),
        ([10.0, 20.0], [2, 0, 2], 0.75, 20.0),
        ([10.0, 20.0], [0, 5, 5], 0.0, 10.0),
        ([10.0], [0, 0], 0.5, None),
        ([], [], 0.5, None),
        ([], [3], 0.5, None),
    ],
)
def test_explicit_quantile_edges(spark, bounds, counts, phi, want):
    assert quantile_of(spark, bounds, counts, phi) == want


def hist(spark, t, bounds, counts):
    return samples(
        spark, schema.HISTOGRAM, {"time_unix_nano": t, "explicit_bounds": bounds, "bucket_counts": counts}
    )


def test_histogram_merge_keeps_different_bounds_apart(spark):
    rows = (
        hist(spark, 1, [10.0, 20.0], [0, 4, 0])
        .unionByName(hist(spark, 2, [10.0, 20.0], [4, 0, 0]))
        .unionByName(hist(spark, 3, [100.0], [2, 0]))
    )
    q = HistogramQuery(metric="m", phi=0.5, step_ns=100)
    assert tuples(histograms.quantile(rows, q)) == [(0, 10.0), (0, 50.0)]
    assert HistogramQuery(metric="m").phi == 0.95
    with pytest.raises(ValueError):
        HistogramQuery(metric="m", phi=1.5)


def exp_point(spark, t, scale, positive=(0, []), negative=(0, []), zero=0):
    return samples(
        spark,
        schema.EXP_HISTOGRAM,
        {
            "time_unix_nano": t,
            "scale": scale,
            "zero_count": zero,
            "positive": positive,
            "negative": negative,
        },
    )


def exp_quantile(df, phi, step=100):
    q = ExpHistogramQuery(metric="m", phi=phi, step_ns=step)
    return [v for _, v in tuples(histograms.exponential_quantile(df, q))]


def test_exponential_quantile_sides_and_zero(spark):
    one = exp_point(spark, 1, 0, positive=(1, [4]), negative=(1, [4]), zero=2)
    for step in (100, None):
        assert exp_quantile(one, 0.5, step) == [0.0]
        (low,), (high,) = exp_quantile(one, 0.2, step), exp_quantile(one, 0.8, step)
        assert math.isclose(low, -4 * (0.5**0.5))
        assert math.isclose(high, 2 * (2**0.5))
        assert exp_quantile(one, 1.0, step) == [4.0]


def test_exponential_merge_of_two_scales(spark):
    fine = exp_point(spark, 1, 1, positive=(-3, [1, 1, 1, 1]))  # indexes -3..0 at base sqrt(2)
    coarse = exp_point(spark, 2, 0, positive=(-2, [1, 1, 1]))  # indexes -2..0 at base 2
    # merged at base 2: index -2 has 1+1, -1 has 2+1, 0 has 1+1
    (got,) = exp_quantile(fine.unionByName(coarse), 0.5)
    assert math.isclose(got, 0.5 * 2 ** ((3.5 - 2) / 3))
    assert exp_quantile(exp_point(spark, 1, 0), 0.5, None) == [None]


def test_catalog_and_resolution(spark):
    stored = {
        schema.GAUGE: samples(spark, schema.GAUGE, {"time_unix_nano": 1, "metric": "cpu.load", "unit": "1"}),
        schema.SUM: samples(
            spark, schema.SUM, {"time_unix_nano": 1, "metric": "http.requests", "temporality": "DELTA"}
        ),
        schema.SUMMARY: table(spark, schema.SUMMARY, []),
    }
    assert tuples(discovery.metric_catalog(stored)) == [
        ("cpu.load", "1", None, "gauge"),
        ("http.requests", None, "DELTA", "sum"),
    ]
    assert discovery.resolve_metric(stored, "http_requests") == ("http.requests", "cumulative_counter")
    with pytest.raises(ValueError, match="cpu_seconds"):
        discovery.resolve_metric(stored, "cpu_seconds")
    assert tuples(discovery.points_of(stored, "cpu_load"), "metric") == [("cpu.load",)]
    assert tuples(discovery.points_of(stored, "http_requests"), "temporality") == [("DELTA",)]
    nothing = {n: table(spark, n, []) for n in schema.METRIC_TABLES}
    empty = discovery.metric_catalog(nothing)
    assert empty.columns == ["metric", "unit", "temporality", "kind"] and empty.count() == 0
    assert discovery.metric_exemplars(nothing, "m").columns == [
        "time", "value", "trace_id", "span_id", "attributes",
    ]


def test_two_hosts_with_equal_labels_are_two_counters(spark):
    rows = [(10, 1000.0, "a"), (11, 10.0, "b"), (20, 1002.0, "a"), (21, 12.0, "b")]
    points = samples(
        spark, schema.SUM, *[{"time_unix_nano": t * S, "value": v, "resource": {"host": h}} for t, v, h in rows]
    )
    grid = Grid(30 * S, 30 * S, S)
    assert tuples(series.rate(points, grid, 30 * S), "value") == [(4 / 30,)]
    q = MetricQuery(metric="m", step_ns=100 * S, rate="counter", aggregation="sum")
    assert tuples(metrics.range_query(points, q), "v") == [(4 / 100,)]


def _histogram(spark, *rows):
    return samples(
        spark,
        schema.HISTOGRAM,
        *[
            {"temporality": "CUMULATIVE", "labels": "{}", "time_unix_nano": t * S, "start_time_unix_nano": start, "count": sum(counts), "explicit_bounds": bounds, "bucket_counts": counts, "resource": {"host": host}}
            for host, t, start, bounds, counts in rows
        ],
    )


def test_cumulative_histograms_count_by_their_gains(spark):
    q = HistogramQuery(metric="m", phi=1.0, step_ns=1000 * S)
    bounds = [1.0, 2.0, 4.0]
    # Nothing is known before a first point, so a lone point has no value.
    assert histograms.quantile(_histogram(spark, ("a", 1, 0, bounds, [5, 5, 5, 0])), q).count() == 0
    # Gains of one in the second bucket; the large start of the first point does not count.
    rows = _histogram(spark, ("a", 1, 0, bounds, [0, 0, 9, 0]), ("a", 2, 0, bounds, [0, 1, 9, 0]))
    assert tuples(histograms.quantile(rows, q)) == [(0, 2.0)]
    # Another host of equal labels is another series.
    rows = rows.unionByName(_histogram(spark, ("b", 3, 0, bounds, [9, 0, 0, 0]), ("b", 4, 0, bounds, [12, 0, 0, 0])))
    assert tuples(histograms.quantile(rows, HistogramQuery(metric="m", phi=0.75, step_ns=1000 * S))) == [(0, 1.0)]
    # Resets: a new start time, a bucket that fell, other bounds. All counts are new then.
    for again in (("a", 2, 7, bounds, [0, 1, 9, 1]), ("a", 2, 0, bounds, [1, 0, 8, 9]), ("a", 2, 0, [1.0, 3.0, 4.0], [0, 0, 9, 1])):
        out = histograms.quantile(_histogram(spark, ("a", 1, 0, bounds, [0, 1, 9, 0]), again), HistogramQuery(metric="m", phi=0.5, step_ns=1000 * S))
        assert [2.0 < r.v <= 4.0 for r in out.collect()] == [True]
    none = _histogram(spark, ("a", 1, 0, bounds, [0, 1, 0, 0]), ("a", 2, 0, bounds, [0, 1, 0, 0]))
    assert [r.v for r in histograms.quantile(none, q).collect()] == [None]


def _exponential(spark, *rows):
    side = lambda offset, counts: {"offset": offset, "bucket_counts": counts}
    return samples(
        spark,
        schema.EXP_HISTOGRAM,
        *[
            {"temporality": "CUMULATIVE", "labels": "{}", "time_unix_nano": t * S, "start_time_unix_nano": 0, "count": zero + sum(counts), "scale": scale, "zero_count": zero, "zero_threshold": threshold, "positive": side(offset, counts), "negative": side(0, [])}
            for t, scale, threshold, zero, offset, counts in rows
        ],
    )


def test_cumulative_exponential_histograms(spark):
    q = ExpHistogramQuery(metric="m", phi=1.0, step_ns=1000 * S)
    # From scale 1 to 0: buckets 4 and 5 of (4, 8] become bucket 2; two more fall into bucket 3, (8, 16].
    rows = _exponential(spark, (1, 1, 0.0, 0, 4, [3, 4]), (2, 0, 0.0, 0, 2, [7, 2]))
    assert [round(r.v, 9) for r in histograms.exponential_quantile(rows, q).collect()] == [16.0]
    low = histograms.exponential_quantile(rows, ExpHistogramQuery(metric="m", phi=0.01, step_ns=1000 * S)).first().v
    assert 8.0 < low < 8.2
    # The zero bucket grows over bucket -1, (0.5, 1]: its counts moved there, only bucket 0 gained.
    rows = _exponential(spark, (1, 0, 0.0, 1, -1, [5, 1]), (2, 0, 1.0, 6, 0, [4]))
    assert [round(r.v, 9) for r in histograms.exponential_quantile(rows, q).collect()] == [2.0]
    low = histograms.exponential_quantile(rows, ExpHistogramQuery(metric="m", phi=0.01, step_ns=1000 * S)).first().v
    assert 1.0 < low < 1.1
    # A smaller count is a reset.
    rows = _exponential(spark, (1, 0, 0.0, 0, 5, [9]), (2, 0, 0.0, 0, 1, [3]))
    assert [round(r.v, 9) for r in histograms.exponential_quantile(rows, q).collect()] == [4.0]
