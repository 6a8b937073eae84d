"""Plain SQL over the registered views."""

from __future__ import annotations

from pyspark.sql import DataFrame

from emberscope.acceptance.fixtures import Fixture
from emberscope.acceptance.registry import query
from emberscope.functions.timegrid import HOUR
from emberscope.operators.ordered import with_previous_rows
from emberscope.sources import tables


def _sql(name: str, text: str, oracle: str | None = None, views: tuple[str, ...] = ("f_logs",)) -> None:
    """The Spark text reads ``logs`` / ``spans``; the twin reads the fixture views."""
    twin = oracle or text
    for view in ("logs", "spans"):
        twin = twin.replace(f"FROM {view}", f"FROM f_{view}").replace(f"JOIN {view}", f"JOIN f_{view}")

    @query(name, twin, views)
    def build(fx: Fixture) -> DataFrame:
        return tables.sql(fx.spark, {"logs": fx.logs, "spans": fx.spans}, text)


_BOTH = ("f_logs", "f_spans")

_sql("sql_count_by_service", "SELECT service, count(*) AS n FROM logs GROUP BY service")
_sql(
    "sql_order_by_severity",
    """SELECT service, body, severity_number, time_unix_nano FROM logs
       ORDER BY severity_number DESC, time_unix_nano DESC, body LIMIT 50""",
)
_sql(
    "sql_count_distinct",
    f"""SELECT time_unix_nano - time_unix_nano % {HOUR} AS hour, count(DISTINCT attributes['user.id']) AS users,
          count(DISTINCT service) AS services FROM logs GROUP BY time_unix_nano - time_unix_nano % {HOUR}""",
    f"""SELECT time_unix_nano - time_unix_nano % {HOUR} AS hour, count(DISTINCT user_id) AS users,
          count(DISTINCT service) AS services FROM logs GROUP BY ALL""",
)
for _kind, _clause in (
    ("cube", "CUBE (service, severity_number)"),
    ("rollup", "ROLLUP (service, severity_number)"),
    ("grouping_sets", "GROUPING SETS ((service), (severity_number), ())"),
):
    _sql(
        f"sql_{_kind}",
        f"""SELECT service, severity_number, count(*) AS n, min(time_unix_nano) AS first_time
            FROM logs GROUP BY {_clause}""",
    )
_sql(
    "sql_window_rank",
    """SELECT service, span_id, duration_ns, rn, rk, drk FROM (
         SELECT service, span_id, duration_ns,
           row_number() OVER (PARTITION BY service ORDER BY duration_ns DESC, span_id) AS rn,
           rank() OVER (PARTITION BY service ORDER BY duration_ns DESC, span_id) AS rk,
           dense_rank() OVER (PARTITION BY service ORDER BY duration_ns DESC, span_id) AS drk
         FROM spans) r WHERE rn <= 3""",
    """SELECT service, span_id, duration_ns, CAST(rn AS int) AS rn, CAST(rk AS int) AS rk, CAST(drk AS int) AS drk
       FROM (SELECT service, span_id, duration_ns,
           row_number() OVER w AS rn, rank() OVER w AS rk, dense_rank() OVER w AS drk FROM spans
         WINDOW w AS (PARTITION BY service ORDER BY duration_ns DESC, span_id)) WHERE rn <= 3""",
    ("f_spans",),
)


def _framed(name: str, rows_before: int, column: str, value: str) -> None:
    """A window with a bounded look-back, run per (service, chunk) instead of per service.

    ``chunked_logs`` repeats before every chunk the rows its frames reach back to.
    """
    order = "time_unix_nano, severity_number, body"
    twin = f"SELECT service, time_unix_nano, body, {value} AS {column} FROM f_logs WINDOW w AS " + (
        f"(PARTITION BY service ORDER BY {order})"
        if rows_before == 1
        else f"(PARTITION BY service ORDER BY {order} ROWS BETWEEN {rows_before} PRECEDING AND CURRENT ROW)"
    )

    @query(name, twin, ("f_logs",))
    def build(fx: Fixture) -> DataFrame:
        rows = fx.logs.select("time_unix_nano", "service", "severity_number", "body")
        chunked = with_previous_rows(rows, ["service"], order.split(", "), rows_before)
        chunked.createOrReplaceTempView("chunked_logs")
        window = twin.split(" WINDOW w AS ")[1].replace("BY service", "BY service, _chunk", 1)
        return fx.spark.sql(
            f"""SELECT service, time_unix_nano, body, {column} FROM (
                  SELECT *, {value} AS {column} FROM chunked_logs WINDOW w AS {window})
                WHERE NOT _halo"""
        )


_framed("sql_window_lag", 1, "gap", "time_unix_nano - lag(time_unix_nano) OVER w")
_framed("sql_window_moving_avg", 4, "moving_avg", "round(CAST(avg(severity_number) OVER w AS double), 6)")

_sql(
    "sql_union_timeline",
    """SELECT time_unix_nano AS t, service, 'log' AS signal, body AS what FROM logs
       UNION ALL SELECT start_time_unix_nano, service, 'span', name FROM spans""",
    views=_BOTH,
)
_sql(
    "sql_intersect",
    """SELECT service FROM logs WHERE severity_number >= 17
       INTERSECT SELECT service FROM spans WHERE status = 'ERROR'""",
    views=_BOTH,
)
_sql(
    "sql_except",
    """SELECT service, body AS what FROM logs
       EXCEPT SELECT service, body FROM logs WHERE severity_number < 9""",
    views=_BOTH,
)
_sql(
    "sql_scalars",
    """SELECT span_id, upper(service) AS upper_service, substring(trace_id, 29, 4) AS tail,
         date_format(date_trunc('HOUR', timestamp_micros(start_time_unix_nano div 1000)), 'yyyy-MM-dd HH:mm:ss') AS hour,
         round(duration_ns / 1000000000D, 3) AS seconds, attributes['k'] AS k,
         get_json_object(to_json(attributes), '$.k') AS json_k, length(name) AS name_length
       FROM spans""",
    """SELECT span_id, upper(service) AS upper_service, substring(trace_id, 29, 4) AS tail,
         strftime(date_trunc('hour', make_timestamp(start_time_unix_nano // 1000)), '%Y-%m-%d %H:%M:%S') AS hour,
         round(duration_ns / 1000000000.0::double, 3) AS seconds, CAST(k AS varchar) AS k,
         CAST(k AS varchar) AS json_k, CAST(length(name) AS int) AS name_length
       FROM spans""",
    ("f_spans",),
)
_sql(
    "sql_subquery_having",
    """SELECT s.name, count(*) AS n, max(duration_ns) AS slowest FROM spans s
       WHERE duration_ns > (SELECT avg(duration_ns) FROM spans m WHERE m.name = s.name)
       GROUP BY s.name HAVING count(*) > (SELECT count(*) / 20.0 FROM spans) ORDER BY s.name""",
    views=("f_spans",),
)
