"""Label selectors, scalar metrics, histograms and grid-evaluated series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberscope import schema
from emberscope.acceptance.fixtures import FIRST_DAY_NS, LAST_NS, ZERO_THRESHOLD, Fixture
from emberscope.acceptance.registry import query
from emberscope.functions.timegrid import DAY, HOUR, MINUTE, SECOND, Grid
from emberscope.operators import discovery, histograms, logs, metrics, series
from emberscope.plans.predicates import series_predicate
from emberscope.plans.specs import ExpHistogramQuery, HistogramQuery, MetricQuery, PointsQuery

# --- label selectors -------------------------------------------------------------


def _selector(name: str, where: str, *filters: tuple[str, str, str]) -> None:
    @query(name, f"SELECT time_unix_nano, labels, value FROM f_gauge WHERE {where}", ("f_gauge",))
    def build(fx: Fixture) -> DataFrame:
        q = MetricQuery(metric="event.value", filters=filters)
        return fx.gauge.where(series_predicate(q, fx.gauge.columns)).select(
            "time_unix_nano", "labels", "value"
        )


_selector("metric_label_eq", "service = 'cart'", ("service", "=", "cart"), ("zone", "=", ""))
_selector("metric_label_ne", "event_type <> 'click'", ("event.type", "!=", "click"), ("zone", "!=", "a"))
_selector(
    "metric_label_regex",
    "regexp_full_match(event_type, 'c.*|view')",
    ("event.type", "=~", "c.*|view"),
)
_selector(
    "metric_label_not_regex",
    "NOT regexp_full_match(event_type, 'c.*|vie')",
    ("event.type", "!~", "c.*|vie"),
    ("zone", "!~", ".+"),
)

# --- range, rate, instant, points --------------------------------------------------


def _range(agg: str, sql_value: str) -> None:
    @query(
        f"metric_range_{agg}",
        f"""SELECT time_unix_nano - time_unix_nano % {HOUR} AS bucket, service AS g0, event_type AS g1,
              {sql_value} AS v
            FROM f_gauge WHERE flags = 0 GROUP BY ALL""",
        ("f_gauge",),
    )
    def build(fx: Fixture) -> DataFrame:
        q = MetricQuery(
            metric="event.value", aggregation=agg, group_by=["service", "event.type"], step_ns=HOUR
        )
        out = metrics.range_query(fx.gauge, q)
        return out.withColumn("v", F.round("v", 6))


for _agg in ("sum", "avg", "min", "max"):
    _range(_agg, f"round({_agg}(value), 6)")
_range("count", "CAST(count(value) AS double)")


@query(
    "metric_rate_delta",
    f"""SELECT time_unix_nano - time_unix_nano % {5 * MINUTE} AS bucket, service AS g0,
          round(sum(value) / 300.0::double, 6) AS v FROM f_sum_delta GROUP BY ALL""",
    ("f_sum_delta",),
)
def _rate_delta(fx: Fixture) -> DataFrame:
    q = MetricQuery(
        metric="event.delta", table=schema.SUM, rate="delta", group_by=["service"], step_ns=5 * MINUTE
    )
    return metrics.range_query(fx.sum, q).withColumn("v", F.round("v", 6))


_INCREASES = """i AS (SELECT *, lag(time_unix_nano) OVER w AS prev_t,
      CASE WHEN lag(value) OVER w IS NULL THEN 0 WHEN value >= lag(value) OVER w
           THEN value - lag(value) OVER w ELSE value END AS inc
    FROM f_sum WINDOW w AS (PARTITION BY labels ORDER BY time_unix_nano, value))"""


@query(
    "metric_rate_counter",
    f"""WITH {_INCREASES} SELECT time_unix_nano - time_unix_nano % {HOUR} AS bucket, service AS g0,
          round(sum(inc) / 3600.0::double, 6) AS v FROM i GROUP BY ALL""",
    ("f_sum",),
)
def _rate_counter(fx: Fixture) -> DataFrame:
    q = MetricQuery(
        metric="event.count", table=schema.SUM, rate="counter", group_by=["service"], step_ns=HOUR
    )
    return metrics.range_query(fx.sum, q).withColumn("v", F.round("v", 6))


@query(
    "metric_rate_counter_max",
    f"""WITH {_INCREASES}, s AS (SELECT time_unix_nano - time_unix_nano % {HOUR} AS bucket, labels,
          sum(inc) / 3600.0::double AS v FROM i GROUP BY ALL)
        SELECT bucket, round(max(v), 6) AS v FROM s GROUP BY ALL""",
    ("f_sum",),
)
def _rate_counter_max(fx: Fixture) -> DataFrame:
    q = MetricQuery(
        metric="event.count", table=schema.SUM, rate="counter", aggregation="max", step_ns=HOUR
    )
    return metrics.range_query(fx.sum, q).withColumn("v", F.round("v", 6))


_INSTANT_SQL = """SELECT labels, max(time_unix_nano) AS timestamp,
    arg_max(value, time_unix_nano) AS value FROM f_gauge WHERE flags = 0 GROUP BY labels"""


@query("metric_instant", _INSTANT_SQL, ("f_gauge",))
def _instant(fx: Fixture) -> DataFrame:
    return metrics.instant(fx.gauge, MetricQuery(metric="event.value"))


@query(
    "metric_points_gauge",
    """SELECT time_unix_nano, service, metric, labels, value FROM f_gauge
       WHERE event_type = 'click' ORDER BY time_unix_nano DESC, metric, labels, value LIMIT 100""",
    ("f_gauge",),
)
def _points_gauge(fx: Fixture) -> DataFrame:
    q = PointsQuery(kind="gauge", metric="event.value", attr_eq=[("event.type", "click")])
    return metrics.points(fx.gauge, q)


@query(
    "metric_points_sum",
    """SELECT time_unix_nano, service, metric, labels, value FROM
         (SELECT * FROM f_sum UNION ALL SELECT * FROM f_sum_delta)
       WHERE service = 'auth' ORDER BY time_unix_nano DESC, metric, labels, value LIMIT 250""",
    ("f_sum", "f_sum_delta"),
)
def _points_sum(fx: Fixture) -> DataFrame:
    return metrics.points(fx.sum, PointsQuery(kind="sum", attr_eq=[("service", "auth")], limit=250))


@query(
    "metric_points_histogram",
    """SELECT time_unix_nano, service, 'event.latency' AS metric, labels,
         CAST(to_json(explicit_bounds) AS varchar) AS explicit_bounds,
         CAST(to_json(bucket_counts) AS varchar) AS bucket_counts
       FROM f_hist ORDER BY time_unix_nano DESC, metric, labels LIMIT 100""",
    ("f_hist",),
)
def _points_histogram(fx: Fixture) -> DataFrame:
    out = metrics.points(fx.histogram, PointsQuery(kind="histogram", metric="event.latency"))
    return out.withColumns({c: F.to_json(c) for c in ("explicit_bounds", "bucket_counts")})


@query(
    "metric_drop_stale",
    """SELECT service, count(*) AS points, round(sum(value), 6) AS total
       FROM f_gauge WHERE flags = 0 GROUP BY service""",
    ("f_gauge",),
)
def _drop_stale(fx: Fixture) -> DataFrame:
    return (
        metrics.recorded(fx.gauge)
        .groupBy("service")
        .agg(F.count(F.lit(1)).alias("points"), F.round(F.sum("value"), 6).alias("total"))
    )


@query(
    "summary_quantiles",
    """SELECT time_unix_nano, service, 'event.spread' AS metric, labels, quantile, value FROM (
         SELECT time_unix_nano, service, labels, 0.0::double AS quantile, min AS value FROM f_summary
         UNION ALL SELECT time_unix_nano, service, labels, 1.0::double, max FROM f_summary)""",
    ("f_summary",),
)
def _summary(fx: Fixture) -> DataFrame:
    return metrics.summary_quantiles(fx.summary)


# --- histogram quantiles -----------------------------------------------------------

# Walk of cumulated counts; ``cells`` gives keys, walking order, low, high, n.
_WALK = """c AS (SELECT *, sum(n) OVER w AS upto, sum(n) OVER (PARTITION BY bucket, g0) AS total
      FROM cells WINDOW w AS (PARTITION BY bucket, g0 ORDER BY pos ROWS UNBOUNDED PRECEDING)),
    hit AS (SELECT bucket, g0, arg_min(low, pos) AS low, arg_min(high, pos) AS high,
      arg_min((rank - (upto - n)) / n, pos) AS share FROM (SELECT *, {phi}::double * total AS rank FROM c)
      WHERE n > 0 AND upto >= rank GROUP BY ALL)"""


def _hist_cells(bucket: str) -> str:
    return f"""cells AS (SELECT {bucket} AS bucket, service AS g0, i AS pos,
          CAST(CASE WHEN i = 1 THEN 0 ELSE explicit_bounds[i - 1] END AS double) AS low,
          coalesce(explicit_bounds[i], explicit_bounds[-1]) AS high,
          CAST(sum(bucket_counts[i]) AS double) AS n
        FROM f_hist, range(1, 7) r(i) GROUP BY ALL)"""


def _hist_sql(bucket: str, phi: float) -> str:
    return f"""WITH {_hist_cells(bucket)}, {_WALK.format(phi=phi)}
        SELECT bucket, g0, round(low + (high - low) * share, 6) AS v FROM hit"""


_WEEK = f"time_unix_nano - time_unix_nano % {7 * DAY}"


@query("histogram_quantile_point", _hist_sql("time_unix_nano", 0.95), ("f_hist",))
def _hist_point(fx: Fixture) -> DataFrame:
    q = HistogramQuery(metric="event.latency", group_by=["service"])
    return histograms.quantile(fx.histogram, q).withColumn("v", F.round("v", 6))


@query("histogram_quantile_step", _hist_sql(_WEEK, 0.9), ("f_hist",))
def _hist_step(fx: Fixture) -> DataFrame:
    q = HistogramQuery(metric="event.latency", phi=0.9, group_by=["service"], step_ns=7 * DAY)
    return histograms.quantile(fx.histogram, q).withColumn("v", F.round("v", 6))


def _exp_sql(bucket: str, phi: float) -> str:
    """Buckets are brought to the lowest scale of their group, then walked geometrically."""
    return f"""WITH p AS (SELECT *, {_DAY_END} AS time_unix_nano FROM f_exp_cells),
      s AS (SELECT *, {bucket} AS bucket, min(scale) OVER (PARTITION BY service, {bucket}) AS low_scale FROM p),
      m AS (SELECT bucket, service AS g0, low_scale, sign, idx >> (scale - low_scale) AS i,
              CAST(sum(n) AS double) AS n FROM s GROUP BY ALL),
      cells AS (SELECT bucket, g0, sign * 1000 + sign * i AS pos, n,
          CASE sign WHEN 1 THEN pow(base, i) WHEN -1 THEN -pow(base, i + 1) ELSE 0 END AS low,
          CASE sign WHEN 1 THEN pow(base, i + 1) WHEN -1 THEN -pow(base, i) ELSE 0 END AS high
        FROM (SELECT *, pow(2.0, pow(2.0, -low_scale)) AS base FROM m)),
      {_WALK.format(phi=phi)}
      SELECT bucket, g0, round(CASE WHEN low = high THEN low ELSE low * pow(high / low, share) END, 6) AS v FROM hit"""


_DAY_END = f"epoch_us(day::timestamp) * 1000 + {DAY - SECOND}"


@query("exp_histogram_quantile", _exp_sql(_WEEK, 0.95), ("f_exp_cells",))
def _exp_step(fx: Fixture) -> DataFrame:
    q = ExpHistogramQuery(metric="event.skew", group_by=["service"], step_ns=7 * DAY)
    return histograms.exponential_quantile(fx.exp_histogram, q).withColumn("v", F.round("v", 6))


@query("exp_histogram_quantile_point", _exp_sql("time_unix_nano", 0.05), ("f_exp_cells",))
def _exp_point(fx: Fixture) -> DataFrame:
    q = ExpHistogramQuery(metric="event.skew", phi=0.05, group_by=["service"])
    return histograms.exponential_quantile(fx.exp_histogram, q).withColumn("v", F.round("v", 6))


@query(
    "histogram_quantile_cumulative",
    _hist_sql(_WEEK, 0.9).replace("FROM f_hist,", "FROM f_hist_gained,"),
    ("f_hist_gained",),
)
def _hist_cumulative(fx: Fixture) -> DataFrame:
    """Two hosts with equal labels, reset every ten days."""
    q = HistogramQuery(metric="event.latency.total", phi=0.9, group_by=["service"], step_ns=7 * DAY)
    return histograms.quantile(fx.histogram_cumulative, q).withColumn("v", F.round("v", 6))


_ENDS_IN_ZERO = f"pow(pow(2.0, pow(2.0, -low_scale)), (idx >> (scale - low_scale)) + 1) <= {ZERO_THRESHOLD}"


@query(
    "exp_histogram_quantile_cumulative",
    _exp_sql(_WEEK, 0.3)
    .replace("FROM f_exp_cells)", "FROM f_exp_cells_gained)")
    .replace(
        "low_scale, sign, idx >> (scale - low_scale) AS i,",
        f"low_scale, CASE WHEN {_ENDS_IN_ZERO} THEN 0 ELSE sign END AS sign, CASE WHEN {_ENDS_IN_ZERO} THEN 0 ELSE idx >> (scale - low_scale) END AS i,",
    ),
    ("f_exp_cells_gained",),
)
def _exp_cumulative(fx: Fixture) -> DataFrame:
    """As above; besides, the scale falls from 0 to -1 between resets, and a zero threshold swallows small buckets."""
    q = ExpHistogramQuery(metric="event.skew.total", phi=0.3, group_by=["service"], step_ns=7 * DAY)
    return histograms.exponential_quantile(fx.exp_histogram_cumulative, q).withColumn("v", F.round("v", 6))


# --- series on a grid ---------------------------------------------------------------

_FINE = Grid(FIRST_DAY_NS, LAST_NS, 5 * MINUTE)
_HOURLY = Grid(FIRST_DAY_NS, LAST_NS, HOUR)


def _steps(grid: Grid) -> str:
    return f"steps AS (SELECT {grid.start} + i * {grid.step} AS ts FROM range(0, {grid.count}) r(i))"


@query(
    "series_instant_grid",
    f"""WITH {_steps(_FINE)}, n AS (SELECT labels, time_unix_nano AS t, value, flags,
          coalesce(lead(time_unix_nano) OVER (PARTITION BY labels ORDER BY time_unix_nano, value), {2**62}) AS nxt
        FROM f_gauge)
        SELECT labels, ts, value FROM steps JOIN n ON t <= ts AND ts < least(nxt, t + {5 * MINUTE})
        WHERE flags = 0""",
    ("f_gauge",),
)
def _grid(fx: Fixture) -> DataFrame:
    return series.instant_grid(fx.gauge.where(F.col("metric") == "event.value"), _FINE)


_RATE_SQL = f"""r AS (SELECT labels, service, ts, sum(inc) / {6 * 3600}.0::double AS value
        FROM steps JOIN i ON time_unix_nano <= ts AND prev_t > ts - {6 * HOUR}
        GROUP BY ALL)"""


@query(
    "series_rate",
    f"WITH {_steps(_HOURLY)}, {_INCREASES}, {_RATE_SQL} SELECT labels, ts, round(value, 6) AS value FROM r",
    ("f_sum",),
)
def _series_rate(fx: Fixture) -> DataFrame:
    counter = fx.sum.where(F.col("metric") == "event.count")
    return series.rate(counter, _HOURLY, 6 * HOUR).withColumn("value", F.round("value", 6))


@query(
    "series_sum_by",
    f"""WITH {_steps(_HOURLY)}, {_INCREASES}, {_RATE_SQL}
        SELECT '{{"service":"' || service || '"}}' AS labels, ts, round(sum(value), 6) AS value
        FROM r GROUP BY ALL""",
    ("f_sum",),
)
def _series_sum_by(fx: Fixture) -> DataFrame:
    counter = fx.sum.where(F.col("metric") == "event.count")
    rates = series.rate(counter, _HOURLY, 6 * HOUR)
    return series.aggregate(rates, "sum", ["service"]).withColumn("value", F.round("value", 6))


@query(
    "log_count_over_time",
    f"""WITH {_steps(_HOURLY)}
        SELECT '{{"service":"' || service || '"}}' AS labels, ts, CAST(count(*) AS double) AS value
        FROM steps JOIN f_logs ON time_unix_nano <= ts AND time_unix_nano > ts - {3 * HOUR}
        WHERE contains(body, 'error') GROUP BY ALL""",
    ("f_logs",),
)
def _count_over_time(fx: Fixture) -> DataFrame:
    return series.count_over_time(logs.selected(fx.logs, contains=["error"]), _HOURLY, 3 * HOUR)


# --- catalog ------------------------------------------------------------------------

_STORED = """(VALUES ('event.value', 's', NULL, 'gauge', 'f_gauge'),
    ('event.count', '1', 'CUMULATIVE', 'sum', 'f_sum'), ('event.delta', '1', 'DELTA', 'sum', 'f_sum'),
    ('event.latency', 's', 'DELTA', 'histogram', 'f_hist'),
    ('event.skew', 's', 'DELTA', 'exp_histogram', 'f_hist'),
    ('event.spread', 's', NULL, 'summary', 'f_summary')) c(metric, unit, temporality, kind, source)
    WHERE EXISTS (SELECT 1 FROM b)"""


@query("metric_catalog", f"SELECT metric, unit, temporality, kind FROM {_STORED}", ("b",))
def _catalog(fx: Fixture) -> DataFrame:
    return discovery.metric_catalog(fx.tables)


@query(
    "metric_resolve",
    f"""SELECT replace(metric, '.', '_') AS query_name, metric AS storage_name,
          CASE kind WHEN 'sum' THEN 'cumulative_counter' WHEN 'histogram' THEN 'cumulative_histogram'
               ELSE 'gauge' END AS kind FROM {_STORED}""",
    ("b",),
)
def _resolve(fx: Fixture) -> DataFrame:
    return discovery.metric_names(fx.tables)
