"""OTLP/JSON envelopes flattened into table rows; the same code for batch and stream.

Each ``*_rows`` function takes a frame of envelopes and gives records that carry
a ``reject_reason`` (null = accepted). ``accepted`` and ``rejected`` split them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberscope import schema
from emberscope.functions.attrs import canonical_json
from emberscope.functions.timegrid import day_of

REASON = "reject_reason"
_BAD = "_corrupt_record"

_KINDS = ("UNSPECIFIED", "INTERNAL", "SERVER", "CLIENT", "PRODUCER", "CONSUMER")
_STATUSES = ("UNSET", "OK", "ERROR")
_TEMPORALITIES = ("UNSPECIFIED", "DELTA", "CUMULATIVE")


def read_envelopes(spark: SparkSession, signal: str, path: str) -> DataFrame:
    """OTLP/JSON files (one envelope per line) of ``logs``, ``traces`` or ``metrics``."""
    return spark.read.schema(_readable(signal)).option("columnNameOfCorruptRecord", _BAD).json(path)


def stream_envelopes(spark: SparkSession, signal: str, path: str, **options) -> DataFrame:
    """The same as a stream over files arriving in a directory."""
    reader = spark.readStream.schema(_readable(signal)).option("columnNameOfCorruptRecord", _BAD)
    return reader.options(**options).json(path)


def _readable(signal: str) -> str:
    """The envelope's fields and the text of lines that are no such envelope."""
    return f"{_ddl(signal)}, {_BAD} STRING"


def malformed(envelopes: DataFrame) -> DataFrame:
    """Lines that hold no readable envelope: ``line`` and the reject reason."""
    outer = next(c for c in envelopes.columns if c != _BAD)
    bad = F.col(_BAD).isNotNull() & F.col(outer).isNull()
    return envelopes.where(bad).select(F.col(_BAD).alias("line"), F.lit("malformed").alias(REASON))


def _ddl(signal: str) -> str:
    if signal not in schema.ENVELOPE_DDL:
        raise ValueError(f"unknown signal {signal!r}, expected logs, traces or metrics")
    return schema.ENVELOPE_DDL[signal]


def any_text(value: Column) -> Column:
    """An AnyValue as text: scalars as written, arrays and lists as key-sorted JSON."""
    nested = F.coalesce(value["arrayValue"], value["kvlistValue"])
    return F.coalesce(
        value["stringValue"],
        value["boolValue"],
        value["intValue"],
        value["doubleValue"],
        value["bytesValue"],
        F.to_json(F.try_parse_json(nested)),
    )


def attribute_map(pairs: Column) -> Column:
    """Key/value list to MAP<STRING,STRING>; of a repeated key the first one counts."""
    present = F.filter(pairs, lambda p: p["key"].isNotNull())
    keys = F.transform(present, lambda p: p["key"])
    first = F.filter(present, lambda p, i: F.array_position(keys, p["key"]) == i + 1)
    entries = F.transform(
        first, lambda p: F.struct(p["key"].alias("key"), any_text(p["value"]).alias("value"))
    )
    return F.coalesce(F.map_from_entries(entries), F.create_map().cast("map<string,string>"))


def _hex_id(column: Column, digits: int) -> Column:
    """Lower-case id, or null when it is malformed or all zero."""
    text = F.lower(column)
    good = text.rlike(rf"\A[0-9a-f]{{{digits}}}\z") & ~text.rlike(r"\A0+\z")
    return F.when(good, text)


def _long(column: Column) -> Column:
    return column.try_cast("bigint")


def _enum(column: Column, prefix: str, names: tuple[str, ...]) -> Column:
    """An enum given as its number or as its prefixed name."""
    by_number = F.get(F.array(*[F.lit(n) for n in names]), column.try_cast("int"))
    by_name = F.regexp_replace(F.upper(column), f"^{prefix}", "")
    return F.coalesce(by_number, F.when(by_name.isin(*names), by_name), F.lit(names[0]))


def _unnest(envelopes: DataFrame, outer: str, scopes: str, records: str) -> DataFrame:
    """resource -> scope -> record by three explodes, as columns resource, scope, r."""
    return (
        envelopes.select(F.explode(outer).alias("_o"))
        .select(
            attribute_map(F.col("_o.resource.attributes")).alias("resource"),
            F.explode(f"_o.{scopes}").alias("_s"),
        )
        .select("resource", F.col("_s.scope").alias("scope"), F.explode(f"_s.{records}").alias("r"))
    )


def _service() -> Column:
    return F.try_element_at("resource", F.lit("service.name"))


def _finish(df: DataFrame, table: str, reason: Column) -> DataFrame:
    """Cast to the table's layout and add the reject reason."""
    fields = schema.table_schema(table).fields
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields], reason.alias(REASON))


def accepted(rows: DataFrame) -> DataFrame:
    return rows.where(F.col(REASON).isNull()).drop(REASON)


def rejected(rows: DataFrame) -> DataFrame:
    return rows.where(F.col(REASON).isNotNull())


def refusals(rows: DataFrame, table: str) -> DataFrame:
    """Refused records as ``table, reject_reason, record``, the record being JSON of what was read of it."""
    bad = rejected(rows)
    return bad.select(F.lit(table).alias("table"), REASON, F.to_json(F.struct(*[c for c in bad.columns if c != REASON])).alias("record"))


def receipt(rows: DataFrame, signal: str, envelopes: DataFrame | None = None) -> DataFrame:
    """Accepted and rejected counts of an ingest: ``signal, reason, count``.

    With the envelopes as read, lines that hold none are counted as malformed.
    """
    reasons = rows.select(REASON)
    if envelopes is not None:
        reasons = reasons.unionAll(malformed(envelopes).select(REASON))
    return (
        reasons.groupBy(F.coalesce(REASON, F.lit("accepted")).alias("reason"))
        .agg(F.count(F.lit(1)).alias("count"))
        .select(F.lit(signal).alias("signal"), "reason", "count")
    )


def log_rows(envelopes: DataFrame) -> DataFrame:
    """A zero event time is replaced by the observed time; with neither the log is refused."""
    flat = _unnest(envelopes, "resourceLogs", "scopeLogs", "logRecords")
    time, observed = _long(F.col("r.timeUnixNano")), _long(F.col("r.observedTimeUnixNano"))
    at = F.coalesce(F.nullif(time, F.lit(0)), F.nullif(observed, F.lit(0)))
    rows = flat.select(
        at.alias("time_unix_nano"),
        F.nullif(observed, F.lit(0)).alias("observed_time_unix_nano"),
        _service().alias("service"),
        F.col("r.severityNumber").alias("severity_number"),
        F.col("r.severityText").alias("severity_text"),
        any_text(F.col("r.body")).alias("body"),
        _hex_id(F.col("r.traceId"), 32).alias("trace_id"),
        _hex_id(F.col("r.spanId"), 16).alias("span_id"),
        F.col("r.eventName").alias("event_name"),
        F.coalesce("r.flags", F.lit(0)).alias("flags"),
        F.col("scope.name").alias("scope_name"),
        F.col("scope.version").alias("scope_version"),
        "resource",
        attribute_map(F.col("r.attributes")).alias("attributes"),
        day_of(at).alias("day"),
    )
    return _finish(rows, schema.LOGS, F.when(F.col("time_unix_nano").isNull(), "no time"))


def span_rows(envelopes: DataFrame) -> DataFrame:
    """Spans with an invalid trace or span id are refused."""
    flat = _unnest(envelopes, "resourceSpans", "scopeSpans", "spans")
    start = F.coalesce(_long(F.col("r.startTimeUnixNano")), F.lit(0).cast("bigint"))
    end = F.coalesce(_long(F.col("r.endTimeUnixNano")), F.lit(0).cast("bigint"))
    events = F.transform(
        "r.events",
        lambda e: F.struct(
            _long(e["timeUnixNano"]).alias("time"),
            e["name"].alias("name"),
            attribute_map(e["attributes"]).alias("attributes"),
        ),
    )
    links = F.transform(
        "r.links",
        lambda k: F.struct(
            _hex_id(k["traceId"], 32).alias("trace_id"),
            _hex_id(k["spanId"], 16).alias("span_id"),
            k["traceState"].alias("trace_state"),
            attribute_map(k["attributes"]).alias("attributes"),
        ),
    )
    rows = flat.select(
        _hex_id(F.col("r.traceId"), 32).alias("trace_id"),
        _hex_id(F.col("r.spanId"), 16).alias("span_id"),
        _hex_id(F.col("r.parentSpanId"), 16).alias("parent_span_id"),
        _service().alias("service"),
        F.col("r.name").alias("name"),
        _enum(F.col("r.kind"), "SPAN_KIND_", _KINDS).alias("kind"),
        start.alias("start_time_unix_nano"),
        end.alias("end_time_unix_nano"),
        (end - start).alias("duration_ns"),
        _enum(F.col("r.status.code"), "STATUS_CODE_", _STATUSES).alias("status"),
        F.col("r.status.message").alias("status_message"),
        F.col("r.traceState").alias("trace_state"),
        F.coalesce("r.flags", F.lit(0)).alias("flags"),
        F.coalesce(events, F.array()).alias("events"),
        F.coalesce(links, F.array()).alias("links"),
        F.col("scope.name").alias("scope_name"),
        F.col("scope.version").alias("scope_version"),
        "resource",
        attribute_map(F.col("r.attributes")).alias("attributes"),
        day_of(start).alias("day"),
    )
    bad = F.when(F.col("trace_id").isNull(), "bad trace id").when(
        F.col("span_id").isNull(), "bad span id"
    )
    return _finish(rows, schema.SPANS, bad)


def _exemplars(points: Column) -> Column:
    return F.coalesce(
        F.transform(
            points,
            lambda e: F.struct(
                _long(e["timeUnixNano"]).alias("time"),
                F.coalesce(e["asDouble"], e["asInt"].try_cast("double")).alias("value"),
                _hex_id(e["traceId"], 32).alias("trace_id"),
                _hex_id(e["spanId"], 16).alias("span_id"),
                canonical_json(attribute_map(e["filteredAttributes"])).alias("attributes"),
            ),
        ),
        F.array(),
    )


def labels_of(attributes: Column, service: Column) -> Column:
    """Canonical label JSON of a metric point: its attributes and its service."""
    own = F.map_filter(attributes, lambda k, _: k != "service")
    with_service = F.map_concat(own, F.create_map(F.lit("service"), service))
    return canonical_json(F.when(service.isNull(), attributes).otherwise(with_service))


# What each kind adds to the common point columns, from the exploded point ``p``
# and the metric ``r``.
def _number() -> dict[str, Column]:
    return {"value": F.coalesce(F.col("p.asDouble"), F.col("p.asInt").try_cast("double"))}


def _longs(array: Column) -> Column:
    return F.transform(array, _long)


def _side(name: str) -> Column:
    side = F.col(f"p.{name}")
    return F.struct(
        F.coalesce(side["offset"], F.lit(0)).alias("offset"),
        F.coalesce(_longs(side["bucketCounts"]), F.array()).alias("bucket_counts"),
    )


def _totals() -> dict[str, Column]:
    return {
        "count": _long(F.col("p.count")),
        "sum": F.col("p.sum"),
        "min": F.col("p.min"),
        "max": F.col("p.max"),
    }


def _kind_columns(table: str) -> tuple[str, dict[str, Column]]:
    if table == schema.GAUGE:
        return "gauge", _number()
    if table == schema.SUM:
        monotonic = F.coalesce(F.col("r.sum.isMonotonic"), F.lit(False))
        return "sum", {**_number(), "is_monotonic": monotonic}
    if table == schema.HISTOGRAM:
        return "histogram", {
            **_totals(),
            "explicit_bounds": F.coalesce(F.col("p.explicitBounds"), F.array()),
            "bucket_counts": F.coalesce(_longs(F.col("p.bucketCounts")), F.array()),
        }
    if table == schema.EXP_HISTOGRAM:
        return "exponentialHistogram", {
            **_totals(),
            "scale": F.coalesce(F.col("p.scale"), F.lit(0)),
            "zero_count": F.coalesce(_long(F.col("p.zeroCount")), F.lit(0)),
            "zero_threshold": F.coalesce(F.col("p.zeroThreshold"), F.lit(0.0)),
            "positive": _side("positive"),
            "negative": _side("negative"),
        }
    if table == schema.SUMMARY:
        return "summary", {
            "count": _long(F.col("p.count")),
            "sum": F.col("p.sum"),
            "quantile_values": F.coalesce(F.col("p.quantileValues"), F.array()),
        }
    raise ValueError(f"{table!r} is not a metric table")


def metric_rows(envelopes: DataFrame, table: str) -> DataFrame:
    """Points of one metric kind; a point without a time or without a value is refused."""
    kind, extra = _kind_columns(table)
    metrics = _unnest(envelopes, "resourceMetrics", "scopeMetrics", "metrics")
    flat = metrics.where(F.col(f"r.{kind}").isNotNull()).select(
        "resource",
        F.struct("r.name", "r.description", "r.unit", f"r.{kind}").alias("r"),
        F.explode(f"r.{kind}.dataPoints").alias("p"),
    )
    temporality = F.lit(None).cast("string")
    if table in (schema.SUM, schema.HISTOGRAM, schema.EXP_HISTOGRAM):
        code = F.col(f"r.{kind}.aggregationTemporality")
        temporality = _enum(code, "AGGREGATION_TEMPORALITY_", _TEMPORALITIES)
    columns = {
        "time_unix_nano": _long(F.col("p.timeUnixNano")),
        "start_time_unix_nano": _long(F.col("p.startTimeUnixNano")),
        "service": _service(),
        "metric": F.col("r.name"),
        "unit": F.col("r.unit"),
        "description": F.col("r.description"),
        "temporality": temporality,
        "flags": F.coalesce(F.col("p.flags"), F.lit(0)),
        "attributes": attribute_map(F.col("p.attributes")),
        "resource": F.col("resource"),
        **extra,
    }
    if table != schema.SUMMARY:
        columns["exemplars"] = _exemplars(F.col("p.exemplars"))
    rows = flat.select(*[c.alias(n) for n, c in columns.items()])
    rows = rows.withColumns(
        {
            "labels": labels_of(F.col("attributes"), F.col("service")),
            "day": day_of(F.col("time_unix_nano")),
        }
    )
    measured = F.col("value") if "value" in columns else F.col("count")
    # A point flagged "no recorded value" is a staleness marker and needs none.
    marker = F.col("flags").bitwiseAND(F.lit(1)) == 1
    bad = F.when(F.coalesce("time_unix_nano", F.lit(0)) == 0, "no time").when(
        measured.isNull() & ~marker, "no value"
    )
    return _finish(rows, table, bad)


def rows_of(envelopes: DataFrame, table: str) -> DataFrame:
    """Records for one table out of the envelopes of its signal."""
    if table == schema.LOGS:
        return log_rows(envelopes)
    if table == schema.SPANS:
        return span_rows(envelopes)
    return metric_rows(envelopes, table)


def signal_of(table: str) -> str:
    return {schema.LOGS: "logs", schema.SPANS: "traces"}.get(table, "metrics")
