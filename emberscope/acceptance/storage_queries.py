"""Ingest, promotion, export and upkeep jobs. Each writes to a fresh directory and reads it back."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberscope import schema
from emberscope.acceptance import envelopes
from emberscope.acceptance.fixtures import _DAY_LABELS, _DAY_NS, FIRST_DAY_NS, Fixture
from emberscope.acceptance.registry import query
from emberscope.functions.timegrid import DAY, HOUR
from emberscope.operators import discovery, logs, metrics, stats, traces, upkeep
from emberscope.plans.specs import LogQuery, MetricQuery, SpanFilters, SpanMetricsQuery, TimeRange, TraceQuery
from emberscope.session import scratch_dir
from emberscope.sources import catalog, otlp, tables, trace_index


def delivered(fx: Fixture, table: str) -> DataFrame:
    """Envelopes for a table, written as OTLP/JSON files and read back from there."""
    signal = otlp.signal_of(table)
    path = scratch_dir(fx.spark, f"otlp-{table}")
    if signal == "logs":
        made = envelopes.logs(fx)
    elif signal == "traces":
        made = envelopes.spans(fx)
    else:
        made = envelopes.metrics(fx, table)
    made.write.json(path)
    return otlp.read_envelopes(fx.spark, signal, path)


def _ingested(fx: Fixture, table: str) -> DataFrame:
    """Envelope files to table files to rows."""
    root = scratch_dir(fx.spark, "tables")
    rows = otlp.accepted(otlp.rows_of(delivered(fx, table), table))
    tables.append(rows, root, table, clustered=True)
    return tables.scan(fx.spark, root, table)


_VALID = "user_id % 50 <> 0"


@query(
    "ingest_logs",
    """SELECT time_unix_nano, observed_time_unix_nano, service, severity_number, severity_text, body, trace_id,
         span_id, event_type AS event_type, CAST(user_id AS varchar) AS user_id, CAST(amount AS varchar) AS amount, day
       FROM f_logs""",
    ("f_logs",),
)
def _logs(fx: Fixture) -> DataFrame:
    def key(name: str):
        return F.try_element_at("attributes", F.lit(name))

    return _ingested(fx, schema.LOGS).select(
        "time_unix_nano", "observed_time_unix_nano", "service", "severity_number", "severity_text", "body",
        "trace_id", "span_id", key("event.type").alias("event_type"), key("user.id").alias("user_id"),
        key("amount").alias("amount"), "day",
    )


@query(
    "ingest_spans",
    f"""SELECT trace_id, span_id, parent_span_id, service, name, kind, start_time_unix_nano, end_time_unix_nano,
          duration_ns, status, CASE WHEN status = 'ERROR' THEN CAST(k AS varchar) END AS exception_code, day
        FROM f_spans WHERE {_VALID}""",
    ("f_spans",),
)
def _spans(fx: Fixture) -> DataFrame:
    first_event = F.get("events", F.lit(0))
    return _ingested(fx, schema.SPANS).select(
        "trace_id", "span_id", "parent_span_id", "service", "name", "kind", "start_time_unix_nano",
        "end_time_unix_nano", "duration_ns", "status",
        F.try_element_at(first_event["attributes"], F.lit("exception.code")).alias("exception_code"), "day",
    )


@query(
    "ingest_metrics_gauge",
    """SELECT time_unix_nano, service, metric, 's' AS unit, labels, CAST(flags AS bigint) AS flags, value, day,
         CASE WHEN event_type = 'error' THEN span_id END AS exemplar_span FROM f_gauge""",
    ("f_gauge",),
)
def _gauge(fx: Fixture) -> DataFrame:
    return _ingested(fx, schema.GAUGE).select(
        "time_unix_nano", "service", "metric", "unit", "labels", "flags", "value", "day",
        F.get("exemplars", F.lit(0))["span_id"].alias("exemplar_span"),
    )


@query(
    "ingest_metrics_sum",
    """SELECT time_unix_nano, service, metric, temporality, true AS is_monotonic, labels, value FROM (
         SELECT *, 'CUMULATIVE' AS temporality FROM f_sum UNION ALL SELECT *, 'DELTA' FROM f_sum_delta)""",
    ("f_sum", "f_sum_delta"),
)
def _sum(fx: Fixture) -> DataFrame:
    return _ingested(fx, schema.SUM).select(
        "time_unix_nano", "service", "metric", "temporality", "is_monotonic", "labels", "value"
    )


@query(
    "ingest_metrics_histogram",
    """SELECT time_unix_nano, service, labels, count, sum, min, max,
         CAST(to_json(explicit_bounds) AS varchar) AS explicit_bounds,
         CAST(to_json(bucket_counts) AS varchar) AS bucket_counts FROM f_hist""",
    ("f_hist",),
)
def _histogram(fx: Fixture) -> DataFrame:
    return _ingested(fx, schema.HISTOGRAM).select(
        "time_unix_nano", "service", "labels", "count", "sum", "min", "max",
        F.to_json("explicit_bounds").alias("explicit_bounds"), F.to_json("bucket_counts").alias("bucket_counts"),
    )


@query(
    "ingest_metrics_exp_histogram",
    f"""SELECT {_DAY_NS} + {DAY - 1_000_000_000} AS time_unix_nano, service, {_DAY_LABELS} AS labels, scale, sign,
          idx::int AS idx, n FROM f_exp_cells WHERE sign <> 0""",
    ("f_exp_cells",),
)
def _exp_histogram(fx: Fixture) -> DataFrame:
    rows = _ingested(fx, schema.EXP_HISTOGRAM)

    def side(name: str, sign: int) -> DataFrame:
        return rows.select(
            "time_unix_nano", "service", "labels", "scale", F.lit(sign).alias("sign"),
            F.col(f"{name}.offset").alias("_offset"), F.posexplode(f"{name}.bucket_counts").alias("_i", "n"),
        )

    return (
        side("positive", 1)
        .unionByName(side("negative", -1))
        .where(F.col("n") > 0)
        .select("time_unix_nano", "service", "labels", "scale", "sign", (F.col("_offset") + F.col("_i")).alias("idx"), "n")
    )


@query(
    "ingest_metrics_summary",
    "SELECT time_unix_nano, service, labels, count, sum, min AS lowest, max AS highest FROM f_summary",
    ("f_summary",),
)
def _summary(fx: Fixture) -> DataFrame:
    return _ingested(fx, schema.SUMMARY).select(
        "time_unix_nano", "service", "labels", "count", "sum",
        F.get("quantile_values", F.lit(0))["value"].alias("lowest"),
        F.get("quantile_values", F.lit(1))["value"].alias("highest"),
    )


@query(
    "ingest_receipt",
    f"""SELECT 'traces' AS signal, CASE WHEN {_VALID} THEN 'accepted' ELSE 'bad trace id' END AS reason,
          count(*) AS count FROM f_spans GROUP BY ALL
        UNION ALL SELECT 'logs', 'accepted', count(*) FROM f_logs HAVING count(*) > 0""",
    ("f_spans", "f_logs"),
)
def _receipt(fx: Fixture) -> DataFrame:
    counts = [
        otlp.receipt(otlp.rows_of(delivered(fx, table), table), otlp.signal_of(table))
        for table in (schema.SPANS, schema.LOGS)
    ]
    return counts[0].unionByName(counts[1])


@query(
    "promote_keys",
    """SELECT time_unix_nano, service, body, event_type AS attr_event_2e_type, CAST(amount AS varchar) AS attr_amount
       FROM f_logs WHERE event_type = 'purchase'""",
    ("f_logs",),
)
def _promote(fx: Fixture) -> DataFrame:
    root, keys = scratch_dir(fx.spark, "promoted"), ["event.type", "amount"]
    tables.append(fx.logs, root, schema.LOGS, promote_keys=keys)
    stored = tables.scan(fx.spark, root, schema.LOGS)
    found = logs.matching(stored, LogQuery(attr_eq=[("event.type", "purchase")]))
    return found.select("time_unix_nano", "service", "body", "attr_event_2e_type", "attr_amount")


_ALL_COUNTS = " UNION ALL ".join(
    f"SELECT '{table}' AS \"table\", count(*) AS rows FROM {source}"
    for table, source in (
        (schema.LOGS, "f_logs"),
        (schema.SPANS, "f_spans"),
        (schema.GAUGE, "f_gauge"),
        (schema.SUM, "(SELECT labels FROM f_sum UNION ALL SELECT labels FROM f_sum_delta)"),
        (schema.HISTOGRAM, "f_hist"),
        (schema.EXP_HISTOGRAM, "f_hist"),
        (schema.SUMMARY, "f_summary"),
    )
)
_ALL_VIEWS = ("f_logs", "f_spans", "f_gauge", "f_sum", "f_sum_delta", "f_hist", "f_summary")


def _stored(fx: Fixture, *names: str) -> str:
    """The derived tables written under a fresh root."""
    root = scratch_dir(fx.spark, "tables")
    for name in names or schema.TABLE_NAMES:
        tables.append(fx.tables[name], root, name)
    return root


@query("scan_counts", _ALL_COUNTS, _ALL_VIEWS)
def _scan_counts(fx: Fixture) -> DataFrame:
    return tables.scan_counts(tables.scan_all(fx.spark, _stored(fx)))


_FROM, _TO = FIRST_DAY_NS + 4 * DAY + 1000, FIRST_DAY_NS + 12 * DAY


@query(
    "export_range",
    f"""SELECT format, trace_id, span_id, service, duration_ns, '{{"k":"' || k || '","user.id":"' || user_id || '"}}' AS attributes
        FROM f_spans, (VALUES ('parquet'), ('orc'), ('json'), ('csv')) v(format)
        WHERE start_time_unix_nano >= {_FROM} AND start_time_unix_nano < {_TO}""",
    ("f_spans",),
)
def _export(fx: Fixture) -> DataFrame:
    layout = schema.table_schema(schema.SPANS)
    columns = ["trace_id", "span_id", "service", "duration_ns"]
    out = None
    for fmt in tables.EXPORT_FORMATS:
        path = scratch_dir(fx.spark, f"export-{fmt}")
        tables.export(fx.spans, schema.SPANS, path, _FROM, _TO, fmt)
        if fmt == "csv":
            flat = [f"{f.name} {f.dataType.simpleString() if 'MAP' not in f.dataType.simpleString().upper() and 'ARRAY' not in f.dataType.simpleString().upper() else 'string'}" for f in layout]
            back = fx.spark.read.schema(", ".join(flat)).option("header", True).option("escape", "\\").csv(path)
            attributes = F.col("attributes")
        else:
            back = fx.spark.read.schema(layout).format(fmt).load(path)
            attributes = F.to_json("attributes")
        part = back.select(F.lit(fmt).alias("format"), *columns, attributes.alias("attributes"))
        out = part if out is None else out.unionByName(part)
    return out


# --- upkeep ----------------------------------------------------------------------------

_TODAY = date(2024, 1, 30)


@query(
    "retention_keep",
    """SELECT day, count(*) AS rows FROM f_logs WHERE day > DATE '2024-01-20' GROUP BY day""",
    ("f_logs",),
)
def _retention(fx: Fixture) -> DataFrame:
    root, out = _stored(fx, schema.LOGS), scratch_dir(fx.spark, "retained")
    upkeep.retain(fx.spark, root, out, retention_days=10, today=_TODAY)
    kept = tables.scan(fx.spark, out, schema.LOGS)
    return kept.groupBy("day").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "compact_rows_unchanged",
    "SELECT day, service, count(*) AS rows, min(time_unix_nano) AS first_time FROM f_logs GROUP BY ALL",
    ("f_logs",),
)
def _compact(fx: Fixture) -> DataFrame:
    root, out = _stored(fx, schema.LOGS), scratch_dir(fx.spark, "compacted")
    upkeep.compact(fx.spark, root, schema.LOGS, out)
    return (
        tables.scan(fx.spark, out, schema.LOGS)
        .groupBy("day", "service")
        .agg(F.count(F.lit(1)).alias("rows"), F.min("time_unix_nano").alias("first_time"))
    )


@query("segments")
def _segments(fx: Fixture) -> DataFrame:
    return upkeep.segments(fx.spark, _stored(fx, schema.LOGS, schema.SPANS))


@query("segment_files")
def _segment_files(fx: Fixture) -> DataFrame:
    return upkeep.segment_files(fx.spark, _stored(fx, schema.LOGS), schema.LOGS)


def _per_table(select: str) -> str:
    """A select over each table's rows as ``v`` with its time as ``t``."""
    sources = {
        schema.LOGS: "SELECT time_unix_nano AS t FROM f_logs",
        schema.SPANS: "SELECT start_time_unix_nano FROM f_spans",
        schema.GAUGE: "SELECT time_unix_nano FROM f_gauge",
        schema.SUM: "SELECT time_unix_nano FROM f_sum UNION ALL SELECT time_unix_nano FROM f_sum_delta",
        schema.HISTOGRAM: "SELECT time_unix_nano FROM f_hist",
        schema.EXP_HISTOGRAM: "SELECT time_unix_nano FROM f_hist",
        schema.SUMMARY: "SELECT time_unix_nano FROM f_summary",
    }
    return " UNION ALL ".join(select.format(table=n, rows=f"({q}) v(t)") for n, q in sources.items())


_DAY_OF = f"DATE '1970-01-01' + CAST(t // {DAY} AS INTEGER)"


@query(
    "segment_days",
    _per_table(f"SELECT '{{table}}' AS \"table\", CAST({_DAY_OF} AS DATE) AS day, count(*) AS rows, min(t) AS min_time, max(t) AS max_time FROM {{rows}} GROUP BY ALL"),
    _ALL_VIEWS,
)
def _segment_days(fx: Fixture) -> DataFrame:
    return upkeep.day_stats(fx.spark, _stored(fx))


@query(
    "table_stats",
    _per_table("SELECT '{table}' AS \"table\", count(*) AS rows, min(t) AS min_time, max(t) AS max_time, true AS has_files FROM {rows}"),
    _ALL_VIEWS,
)
def _table_stats(fx: Fixture) -> DataFrame:
    found = upkeep.table_stats(fx.spark, _stored(fx))
    return found.select("table", "rows", "min_time", "max_time", (F.col("files") > 0).alias("has_files"))


@query(
    "retention_bytes",
    """SELECT day, trace_id, body FROM f_logs
       WHERE day IN (SELECT day FROM (SELECT day FROM f_logs UNION SELECT day FROM f_spans) ORDER BY day DESC LIMIT 5)""",
    ("f_logs", "f_spans"),
)
def _retention_bytes(fx: Fixture) -> DataFrame:
    root, out = _stored(fx, schema.LOGS, schema.SPANS), scratch_dir(fx.spark, "retained")
    newest = upkeep.day_sizes(fx.spark, root).orderBy(F.col("day").desc()).limit(6)
    # One byte short of what six days take.
    upkeep.retain(fx.spark, root, out, max_bytes=newest.agg(F.sum("bytes").alias("b")).first()["b"] - 1)
    return tables.scan(fx.spark, out, schema.LOGS).select("day", "trace_id", "body")


@query("snapshot_rows", _ALL_COUNTS, _ALL_VIEWS)
def _snapshot(fx: Fixture) -> DataFrame:
    directory = scratch_dir(fx.spark, "snapshot")
    upkeep.snapshot(fx.spark, _stored(fx), directory)
    return tables.scan_counts(tables.scan_all(fx.spark, directory))


# --- what is kept beside the tables ------------------------------------------------------


@query(
    "promote_then_overwrite",
    "SELECT time_unix_nano, service, body, event_type AS attr_event_2e_type FROM f_logs WHERE event_type = 'purchase'",
    ("f_logs",),
)
def _overwrite(fx: Fixture) -> DataFrame:
    """A table with a promoted key is overwritten without naming it; the filter on the key still finds its rows."""
    root = scratch_dir(fx.spark, "promoted")
    tables.append(fx.logs.where("event_name = 'click'"), root, schema.LOGS, promote_keys=["event.type"])
    tables.append(fx.logs, root, schema.LOGS, mode="overwrite")
    found = logs.matching(tables.scan(fx.spark, root, schema.LOGS), LogQuery(attr_eq=[("event.type", "purchase")]))
    return found.select("time_unix_nano", "service", "body", "attr_event_2e_type")


@query(
    "promote_then_compact",
    """SELECT time_unix_nano, service, body, event_type AS attr_event_2e_type, CAST(amount AS varchar) AS attr_amount
       FROM f_logs WHERE event_type = 'purchase'""",
    ("f_logs",),
)
def _promote_compact(fx: Fixture) -> DataFrame:
    """A key promoted only by the second append becomes a column of all rows when the table is rewritten."""
    root, out = scratch_dir(fx.spark, "promoted"), scratch_dir(fx.spark, "compacted")
    half = F.col("day") < date(2024, 1, 15)
    tables.append(fx.logs.where(half), root, schema.LOGS, promote_keys=["event.type"])
    tables.append(fx.logs.where(~half), root, schema.LOGS, promote_keys=["amount"])
    upkeep.compact(fx.spark, root, schema.LOGS, out)
    found = logs.matching(tables.scan(fx.spark, out, schema.LOGS), LogQuery(attr_eq=[("event.type", "purchase")]))
    return found.select("time_unix_nano", "service", "body", "attr_event_2e_type", "attr_amount")


_ALL_ENTRIES = """WITH r AS (
    SELECT 'logs' AS "table", day, service, event_type, k, user_id, amount FROM f_logs
    UNION ALL SELECT 'spans', day, service, NULL, k, user_id, NULL FROM f_spans
    UNION ALL SELECT 'metrics_gauge', day, service, event_type, NULL, NULL, NULL FROM f_gauge
    UNION ALL SELECT 'metrics_sum', day, service, event_type, NULL, NULL, NULL FROM f_sum
    UNION ALL SELECT 'metrics_histogram', day, service, NULL, NULL, NULL, NULL FROM f_hist
    UNION ALL SELECT 'metrics_exp_histogram', day, service, NULL, NULL, NULL, NULL FROM f_hist
    UNION ALL SELECT 'metrics_summary', day, service, NULL, NULL, NULL, NULL FROM f_summary),
  v AS (SELECT "table", day, 'event.type' AS name, event_type AS value FROM r WHERE event_type IS NOT NULL
    UNION SELECT "table", day, 'k', CAST(k AS varchar) FROM r WHERE k IS NOT NULL
    UNION SELECT "table", day, 'user.id', CAST(user_id AS varchar) FROM r WHERE user_id IS NOT NULL
    UNION SELECT "table", day, 'amount', CAST(amount AS varchar) FROM r WHERE amount IS NOT NULL
    UNION SELECT "table", day, 'service', service FROM r)
  SELECT "table", day, 'value' AS kind, name, value FROM v
  UNION ALL SELECT DISTINCT "table", day, 'key', CASE name WHEN 'service' THEN 'service.name' ELSE name END, NULL FROM v
  UNION ALL SELECT DISTINCT r."table", day, 'metric', m.metric, NULL FROM r JOIN (VALUES ('metrics_gauge', 'event.value'),
    ('metrics_sum', 'event.count'), ('metrics_sum', 'event.delta'), ('metrics_histogram', 'event.latency'),
    ('metrics_exp_histogram', 'event.skew'), ('metrics_summary', 'event.spread')) m(of, metric) ON r."table" = m.of"""


@query("catalog_entries", _ALL_ENTRIES, _ALL_VIEWS)
def _entries(fx: Fixture) -> DataFrame:
    """The catalog after every table was appended in two parts."""
    root = scratch_dir(fx.spark, "tables")
    for name in schema.TABLE_NAMES:
        for part in (F.col("service") < "cart", F.col("service") >= "cart"):
            tables.append(fx.tables[name].where(part), root, name)
    return catalog.read(fx.spark, root).select("table", "day", "kind", "name", "value")


@query(
    "catalog_after_retention",
    """SELECT DISTINCT 'user.id' AS name, CAST(user_id AS varchar) AS value FROM b WHERE day > DATE '2024-01-20'
       UNION SELECT 'event.type', event_type FROM b WHERE day > DATE '2024-01-20'""",
    ("b",),
)
def _retained_entries(fx: Fixture) -> DataFrame:
    """Values of two keys looked up in the catalog once the days before have been dropped."""
    root, out = _stored(fx, schema.LOGS), scratch_dir(fx.spark, "retained")
    upkeep.retain(fx.spark, root, out, retention_days=10, today=_TODAY)
    known = catalog.read(fx.spark, out)
    parts = [discovery.attr_values(known, key).select(F.lit(key).alias("name"), "value") for key in ("user.id", "event.type")]
    return parts[0].unionByName(parts[1])


# --- ranges and statistics on stored tables ----------------------------------------------

_EARLY, _LATE = FIRST_DAY_NS + 4 * DAY, FIRST_DAY_NS + 8 * DAY
_RANGE = TimeRange(_EARLY, _LATE)
_RED = SpanMetricsQuery(range=_RANGE, group_by=["service"], step_ns=HOUR)
_AVERAGE = MetricQuery(metric="event.value", range=_RANGE, aggregation="avg", group_by=["service"], step_ns=HOUR)


@query(
    "metric_range_stored",
    f"""SELECT time_unix_nano - time_unix_nano % {HOUR} AS bucket, service AS g0, round(avg(value), 6) AS v FROM f_gauge
        WHERE flags = 0 AND time_unix_nano >= {_EARLY} AND time_unix_nano < {_LATE} GROUP BY ALL""",
    ("f_gauge",),
)
def _range_stored(fx: Fixture) -> DataFrame:
    gauge = tables.scan(fx.spark, _stored(fx, schema.GAUGE), schema.GAUGE)
    return metrics.range_query(gauge, _AVERAGE).withColumn("v", F.round("v", 6))


@query(
    "span_metrics_stored",
    f"""SELECT start_time_unix_nano - start_time_unix_nano % {HOUR} AS bucket, service AS g0, count(*) AS calls,
          count(*) FILTER (status = 'ERROR') AS errors, round(quantile_cont(duration_ns::double, 0.5), 3) AS p50,
          round(quantile_cont(duration_ns::double, 0.95), 3) AS p95, round(quantile_cont(duration_ns::double, 0.99), 3) AS p99
        FROM f_spans WHERE start_time_unix_nano >= {_EARLY} AND start_time_unix_nano < {_LATE} GROUP BY ALL""",
    ("f_spans",),
)
def _red_stored(fx: Fixture) -> DataFrame:
    spans = tables.scan(fx.spark, _stored(fx, schema.SPANS), schema.SPANS)
    return traces.span_metrics(spans, _RED).withColumns({p: F.round(p, 3) for p in traces.PERCENTILES})


@query(
    "trace_search_stored",
    f"""SELECT trace_id, start_time, span_count FROM (SELECT trace_id, min(start_time_unix_nano) AS start_time, count(*) AS span_count
          FROM f_spans GROUP BY trace_id) WHERE start_time >= {_EARLY} AND start_time < {_LATE}
        ORDER BY start_time DESC, trace_id LIMIT 200""",
    ("f_spans",),
)
def _search_stored(fx: Fixture) -> DataFrame:
    spans = tables.scan(fx.spark, _stored(fx, schema.SPANS), schema.SPANS)
    return traces.search(spans, TraceQuery(range=_RANGE, limit=200)).select("trace_id", "start_time", "span_count")


# --- the trace index ----------------------------------------------------------------------


def _indexed(fx: Fixture) -> tuple[DataFrame, trace_index.TraceIndex]:
    """Spans appended in three parts that share traces, the first two compacted, and their index."""
    root, out = scratch_dir(fx.spark, "parts"), scratch_dir(fx.spark, "compacted")
    parts = [fx.spans.where(F.pmod(F.xxhash64("span_id"), F.lit(3)) == i) for i in range(3)]
    tables.append(parts[0], root, schema.SPANS)
    tables.append(parts[1], root, schema.SPANS)
    upkeep.compact(fx.spark, root, schema.SPANS, out)
    tables.append(parts[2], out, schema.SPANS)
    return tables.scan(fx.spark, out, schema.SPANS), trace_index.read(fx.spark, out)


@query(
    "trace_index",
    "SELECT trace_id, min(start_time_unix_nano) AS first, max(start_time_unix_nano) AS last FROM f_spans GROUP BY trace_id",
    ("f_spans",),
)
def _index(fx: Fixture) -> DataFrame:
    return _indexed(fx)[1].merge()


@query(
    "trace_search_indexed",
    f"""SELECT trace_id, start_time, span_count FROM (SELECT trace_id, min(start_time_unix_nano) AS start_time, count(*) AS span_count
          FROM f_spans GROUP BY trace_id) WHERE start_time >= {_EARLY} AND start_time < {_LATE}
        ORDER BY start_time DESC, trace_id LIMIT 200""",
    ("f_spans",),
)
def _search_indexed(fx: Fixture) -> DataFrame:
    spans, index = _indexed(fx)
    return traces.search(spans, TraceQuery(range=_RANGE, limit=200), index).select("trace_id", "start_time", "span_count")


@query(
    "get_trace_indexed",
    f"SELECT trace_id, span_id, name, start_time_unix_nano FROM f_spans WHERE trace_id = '{7:032x}'",
    ("f_spans",),
)
def _get_indexed(fx: Fixture) -> DataFrame:
    spans, index = _indexed(fx)
    return traces.get_trace(spans, f"{7:032x}", index).select("trace_id", "span_id", "name", "start_time_unix_nano")


@query(
    "spanset_traces_indexed",
    f"""SELECT trace_id, span_id, name FROM f_spans WHERE trace_id IN (SELECT trace_id FROM f_spans WHERE status = 'ERROR'
          AND k > 80 AND start_time_unix_nano >= {_EARLY} AND start_time_unix_nano < {_LATE})""",
    ("f_spans",),
)
def _whole_indexed(fx: Fixture) -> DataFrame:
    spans, index = _indexed(fx)
    matched = traces.match(spans, SpanFilters(status="ERROR", attr_num=[("k", ">", 80)]), _EARLY, _LATE)
    return traces.whole_traces(spans, matched, index).select("trace_id", "span_id", "name")


def _newest(rows: int) -> str:
    """Logs of the days that hold the newest ``rows`` of the range."""
    return f"""(SELECT count(*) FROM f_logs WHERE time_unix_nano < {_LATE} AND day >= (SELECT min(day) FROM (SELECT day FROM f_logs
        WHERE time_unix_nano >= {_EARLY} AND time_unix_nano < {_LATE} ORDER BY time_unix_nano DESC LIMIT {rows})))"""


_IN_RANGE = f"time_unix_nano >= {_EARLY} AND time_unix_nano < {_LATE}"
_IN_SPANS = f"start_time_unix_nano >= {_EARLY} AND start_time_unix_nano < {_LATE}"


@query(
    "query_stats",
    f"""SELECT 'logs' AS call, {_newest(50)} AS rows_scanned, least(50, count(*)) AS rows_returned, true AS has_files FROM f_logs WHERE {_IN_RANGE}
        UNION ALL SELECT 'page', {_newest(100)}, least(50, greatest(count(*) - 50, 0)), true FROM f_logs WHERE {_IN_RANGE}
        UNION ALL SELECT 'range', (SELECT count(*) FROM f_gauge WHERE {_IN_RANGE}), count(DISTINCT (time_unix_nano // {HOUR}, service)), true
          FROM f_gauge WHERE flags = 0 AND {_IN_RANGE}
        UNION ALL SELECT 'red', count(*), count(DISTINCT (start_time_unix_nano // {HOUR}, service)), true FROM f_spans WHERE {_IN_SPANS}""",
    ("f_logs", "f_gauge", "f_spans"),
)
def _query_stats(fx: Fixture) -> DataFrame:
    """Rows read and given back by four calls on stored tables; a range reads its own days only."""
    db = tables.scan_all(fx.spark, _stored(fx, schema.LOGS, schema.GAUGE, schema.SPANS))
    q = LogQuery(range=_RANGE, limit=50)
    calls = {
        "logs": logs.query(db[schema.LOGS], q),
        "page": logs.page(db[schema.LOGS], q, after=50).rows,
        "range": metrics.range_query(db[schema.GAUGE], _AVERAGE),
        "red": traces.span_metrics(db[schema.SPANS], _RED),
    }
    found = {name: stats.collect(df)[1] for name, df in calls.items()}
    rows = [(name, s.rows_scanned, s.rows_returned, s.files > 0 and s.bytes > 0 and s.elapsed_ns > 0) for name, s in found.items()]
    return fx.spark.createDataFrame(rows, "call STRING, rows_scanned BIGINT, rows_returned BIGINT, has_files BOOLEAN")
