"""Span filters, trace search, RED metrics, spansets, discovery and cross-signal joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberscope.acceptance.fixtures import FIRST_DAY_NS, LAST_NS, Fixture
from emberscope.acceptance.registry import query
from emberscope.functions.timegrid import DAY, HOUR, SECOND
from emberscope.operators import correlate, discovery, metrics, traces
from emberscope.plans.predicates import span_predicate
from emberscope.plans.specs import MetricQuery, SpanFilters, SpanMetricsQuery, TimeRange, TraceQuery


def _spans(key: str, where: str, **conditions) -> None:
    sql = f"SELECT trace_id, span_id, name, kind, status, duration_ns FROM f_spans WHERE {where}"

    @query(key, sql, ("f_spans",))
    def build(fx: Fixture) -> DataFrame:
        q = SpanFilters(**conditions)
        return fx.spans.where(span_predicate(q, fx.spans.columns)).select(
            "trace_id", "span_id", "name", "kind", "status", "duration_ns"
        )


_spans("spans_by_name", "name = 'signup'", name="signup")
_spans("spans_by_kind", "kind = 'SERVER'", kind="server")
_spans("spans_by_status", "status = 'ERROR'", status="error")

# --- trace search -----------------------------------------------------------------


def _search_sql(hit: str, where: str, limit: int = 20) -> str:
    return f"""SELECT trace_id, root_service, root_name, start_time, duration_ns, span_count, error FROM (
        SELECT trace_id, max(service) FILTER (parent_span_id IS NULL) AS root_service,
          max(name) FILTER (parent_span_id IS NULL) AS root_name, min(start_time_unix_nano) AS start_time,
          coalesce(max(duration_ns) FILTER (parent_span_id IS NULL),
                   max(end_time_unix_nano) - min(start_time_unix_nano)) AS duration_ns,
          count(*) AS span_count, bool_or(status = 'ERROR') AS error, bool_or({hit}) AS hit
        FROM f_spans GROUP BY trace_id) WHERE hit AND {where}
        ORDER BY start_time DESC, trace_id LIMIT {limit}"""


@query(
    "trace_search",
    _search_sql("name = 'error' AND status = 'ERROR'", "root_service = 'checkout'"),
    ("f_spans",),
)
def _search(fx: Fixture) -> DataFrame:
    return traces.search(fx.spans, TraceQuery(service="checkout", text="error", status="ERROR"))


@query(
    "trace_search_by_attr",
    _search_sql("k >= 90 AND CAST(user_id AS varchar) LIKE '1%' AND kind = 'CLIENT'", "true", 50),
    ("f_spans",),
)
def _search_attr(fx: Fixture) -> DataFrame:
    q = TraceQuery(attr_num=[("k", ">=", 90)], attr_regex=[("user.id", "^1")], kind="CLIENT", limit=50)
    return traces.search(fx.spans, q)


@query(
    "traces_duration_range",
    _search_sql("true", f"duration_ns >= {20 * SECOND} AND duration_ns <= {60 * SECOND}"),
    ("f_spans",),
)
def _search_duration(fx: Fixture) -> DataFrame:
    q = TraceQuery(min_duration_ns=20 * SECOND, max_duration_ns=60 * SECOND)
    return traces.search(fx.spans, q)


_FROM, _TO = FIRST_DAY_NS + 9 * DAY + 12 * HOUR, FIRST_DAY_NS + 11 * DAY + 2 * HOUR


@query(
    "trace_search_range",
    _search_sql("true", f"start_time >= {_FROM} AND start_time < {_TO}", 100),
    ("f_spans",),
)
def _search_range(fx: Fixture) -> DataFrame:
    """A day and a half over two edges of days; traces that began earlier stay out."""
    return traces.search(fx.spans, TraceQuery(range=TimeRange(_FROM, _TO), limit=100))


def _red_sql(group: str, where: str) -> str:
    quantiles = ", ".join(
        f"round(quantile_cont(duration_ns::double, {p}), 3) AS {name}" for name, p in traces.PERCENTILES.items()
    )
    return f"""SELECT start_time_unix_nano - start_time_unix_nano % {HOUR} AS bucket, {group} AS g0,
        count(*) AS calls, count(*) FILTER (status = 'ERROR') AS errors, {quantiles}
        FROM f_spans WHERE {where} GROUP BY ALL"""


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({p: F.round(p, 3) for p in traces.PERCENTILES})


@query("span_metrics_red", _red_sql("service", "true"), ("f_spans",))
def _red(fx: Fixture) -> DataFrame:
    return _rounded(traces.span_metrics(fx.spans, SpanMetricsQuery(group_by=["service"], step_ns=HOUR)))


@query("span_metrics_by_name", _red_sql("name", "service = 'cart' AND k <> 5"), ("f_spans",))
def _red_by_name(fx: Fixture) -> DataFrame:
    q = SpanMetricsQuery(
        service="cart", attr_not_in=[("k", ["5"])], group_by=["name"], step_ns=HOUR
    )
    return _rounded(traces.span_metrics(fx.spans, q))


_ONE_TRACE = f"{7:032x}"


@query(
    "get_trace",
    f"""SELECT trace_id, span_id, parent_span_id, service, name, start_time_unix_nano, duration_ns
        FROM f_spans WHERE trace_id = '{_ONE_TRACE}'""",
    ("f_spans",),
)
def _get_trace(fx: Fixture) -> DataFrame:
    return traces.get_trace(fx.spans, _ONE_TRACE).select(
        "trace_id", "span_id", "parent_span_id", "service", "name", "start_time_unix_nano", "duration_ns"
    )


_SPANSET = SpanFilters(status="ERROR", kind="INTERNAL", attr_num=[("k", ">", 80)])


@query(
    "spanset_match",
    "SELECT trace_id, span_id FROM f_spans WHERE status = 'ERROR' AND kind = 'INTERNAL' AND k > 80",
    ("f_spans",),
)
def _match(fx: Fixture) -> DataFrame:
    return traces.match(fx.spans, _SPANSET, FIRST_DAY_NS, LAST_NS)


@query(
    "spanset_traces",
    """SELECT trace_id, span_id, name FROM f_spans WHERE trace_id IN
       (SELECT trace_id FROM f_spans WHERE status = 'ERROR' AND kind = 'INTERNAL' AND k > 80)""",
    ("f_spans",),
)
def _whole(fx: Fixture) -> DataFrame:
    matched = traces.match(fx.spans, _SPANSET, FIRST_DAY_NS, LAST_NS)
    return traces.whole_traces(fx.spans, matched).select("trace_id", "span_id", "name")


# --- discovery ----------------------------------------------------------------------


@query(
    "attr_names",
    """SELECT name FROM (SELECT unnest(['service.name', 'event.type', 'k', 'user.id']) AS name
         WHERE EXISTS (SELECT 1 FROM b)
       UNION SELECT 'amount' WHERE EXISTS (SELECT 1 FROM f_logs WHERE amount IS NOT NULL))""",
    ("f_logs",),
)
def _names(fx: Fixture) -> DataFrame:
    return discovery.attr_names(fx.tables)


@query("attr_values", "SELECT DISTINCT CAST(user_id AS varchar) AS value FROM b", ("b",))
def _values(fx: Fixture) -> DataFrame:
    return discovery.attr_values(fx.tables, "user.id")


@query("metric_series", "SELECT DISTINCT labels FROM f_gauge", ("f_gauge",))
def _series(fx: Fixture) -> DataFrame:
    return discovery.metric_series(fx.tables, "event.value")


@query(
    "metric_exemplars",
    """SELECT time_unix_nano AS time, value, trace_id, span_id,
         '{"user.id":"' || user_id || '"}' AS attributes FROM f_gauge WHERE event_type = 'error'""",
    ("f_gauge",),
)
def _exemplars(fx: Fixture) -> DataFrame:
    return discovery.metric_exemplars(fx.tables, "event.value")


@query(
    "metric_exemplars_sum",
    """SELECT time_unix_nano AS time, g.value, trace_id, span_id,
         '{"user.id":"' || user_id || '"}' AS attributes FROM f_gauge g WHERE event_type = 'purchase'""",
    ("f_gauge",),
)
def _exemplars_sum(fx: Fixture) -> DataFrame:
    return discovery.metric_exemplars(fx.tables, "event.delta")


# --- joins ----------------------------------------------------------------------------


def _join_sql(kind: str) -> str:
    return f"""SELECT l.time_unix_nano, l.body, l.trace_id, l.span_id, s.name, s.duration_ns
        FROM f_logs l {kind} JOIN f_spans s ON l.trace_id = s.trace_id AND l.span_id = s.span_id"""


def _log_side(fx: Fixture) -> DataFrame:
    return fx.logs.select("time_unix_nano", "body", "trace_id", "span_id")


def _span_side(fx: Fixture) -> DataFrame:
    return fx.spans.select("trace_id", "span_id", "name", "duration_ns")


@query("join_logs_spans", _join_sql("INNER"), ("f_logs", "f_spans"))
def _join(fx: Fixture) -> DataFrame:
    return correlate.logs_with_spans(_log_side(fx), _span_side(fx))


@query("join_logs_spans_left", _join_sql("LEFT"), ("f_logs", "f_spans"))
def _join_left(fx: Fixture) -> DataFrame:
    return correlate.logs_with_spans(_log_side(fx), _span_side(fx), "left")


@query(
    "semi_error_traces",
    """SELECT trace_id, span_id, status FROM f_spans WHERE trace_id IN
       (SELECT trace_id FROM f_spans WHERE status = 'ERROR')""",
    ("f_spans",),
)
def _failed(fx: Fixture) -> DataFrame:
    return correlate.spans_of_failed_traces(fx.spans.select("trace_id", "span_id", "status"))


@query(
    "anti_traces_without_logs",
    """SELECT DISTINCT trace_id FROM f_spans WHERE trace_id NOT IN
       (SELECT trace_id FROM f_logs WHERE trace_id IS NOT NULL)""",
    ("f_logs", "f_spans"),
)
def _unlogged(fx: Fixture) -> DataFrame:
    return correlate.traces_without_logs(fx.spans, fx.logs)


@query(
    "join_exemplar_span",
    """SELECT e.trace_id, e.span_id, e.time_unix_nano AS time, e.value, s.name, s.duration_ns
       FROM f_gauge e JOIN f_spans s ON e.trace_id = s.trace_id AND e.span_id = s.span_id
       WHERE e.event_type = 'error'""",
    ("f_gauge", "f_spans"),
)
def _exemplar_span(fx: Fixture) -> DataFrame:
    exemplars = discovery.metric_exemplars(fx.tables, "event.value").drop("attributes")
    return correlate.exemplars_with_spans(exemplars, _span_side(fx))


@query(
    "join_on_labels",
    """SELECT labels, a.value AS last_value, b2.total FROM
         (SELECT labels, arg_max(value, time_unix_nano) AS value FROM f_gauge WHERE flags = 0 GROUP BY labels) a
       JOIN (SELECT labels, sum(value) AS total FROM f_sum_delta GROUP BY labels) b2 USING (labels)""",
    ("f_gauge", "f_sum_delta"),
)
def _on_labels(fx: Fixture) -> DataFrame:
    last = metrics.instant(fx.gauge, MetricQuery(metric="event.value"))
    totals = (
        fx.sum.where(F.col("metric") == "event.delta").groupBy("labels").agg(F.sum("value").alias("total"))
    )
    return last.join(totals, "labels").select("labels", F.col("value").alias("last_value"), "total")


@query(
    "join_logs_in_span",
    """SELECT l.service, l.time_unix_nano, l.body, s.span_id, s.name
       FROM f_logs l JOIN f_spans s ON l.service = s.service
         AND l.time_unix_nano >= s.start_time_unix_nano AND l.time_unix_nano < s.end_time_unix_nano""",
    ("f_logs", "f_spans"),
)
def _in_span(fx: Fixture) -> DataFrame:
    spans = fx.spans.select("service", "span_id", "name", "start_time_unix_nano", "end_time_unix_nano")
    logs = fx.logs.select("service", "time_unix_nano", "body")
    return correlate.logs_in_spans(logs, spans).select(
        "service", "time_unix_nano", "body", "span_id", "name"
    )


@query(
    "asof_log_metric",
    f"""SELECT l.service, l.time_unix_nano, l.body,
          CASE WHEN l.time_unix_nano - m.t < {HOUR} THEN m.t END AS metric_time,
          CASE WHEN l.time_unix_nano - m.t < {HOUR} THEN m.value END AS metric_value
        FROM f_logs l ASOF LEFT JOIN (SELECT service, time_unix_nano AS t, max(value) AS value FROM f_gauge
          WHERE event_type = 'click' AND flags = 0 GROUP BY ALL) m
        ON l.service = m.service AND l.time_unix_nano >= m.t""",
    ("f_logs", "f_gauge"),
)
def _asof(fx: Fixture) -> DataFrame:
    clicks = metrics.recorded(fx.gauge).where(F.col("attributes")["event.type"] == "click")
    logs = fx.logs.select("service", "time_unix_nano", "body")
    return correlate.metric_at_log(logs, clicks, lookback=HOUR).select(
        "service", "time_unix_nano", "body", "metric_time", "metric_value"
    )
