"""OTLP/JSON envelopes made from the derived tables, as input for the ingest queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberscope import schema
from emberscope.acceptance.fixtures import Fixture

# Records per envelope; a bound, so that no envelope grows with the data.
BATCH = 256
# Envelopes per file. Compressed files are not split, so their size bounds a task's share.
FILE = 2048


def _pairs(mapping: Column | str) -> Column:
    """A string map as an OTLP key/value list."""
    return F.transform(
        F.map_entries(mapping),
        lambda e: F.struct(e["key"].alias("key"), F.struct(e["value"].alias("stringValue")).alias("value")),
    )


def _text(column: str | Column) -> Column:
    return F.col(column).cast("string") if isinstance(column, str) else column.cast("string")


def _wrap(records: DataFrame, outer: str, scopes: str, inner: str, by: list[str]) -> DataFrame:
    """Group records of one service into envelopes of at most ``BATCH`` records."""
    grouped = records.groupBy("service", *by).agg(F.collect_list("_r").alias(inner))
    scope = F.struct(F.lit("events").alias("name"), F.lit("1").alias("version"))
    resource = F.struct(_pairs(F.create_map(F.lit("service.name"), F.col("service"))).alias("attributes"))
    return grouped.select(
        F.array(
            F.struct(
                resource.alias("resource"),
                F.array(F.struct(scope.alias("scope"), F.col(inner).alias(inner))).alias(scopes),
            )
        ).alias(outer)
    )


def logs(fx: Fixture, before: int | None = None) -> DataFrame:
    """Log envelopes, of all records or of those from before a time."""
    record = F.struct(
        _text("time_unix_nano").alias("timeUnixNano"),
        _text("observed_time_unix_nano").alias("observedTimeUnixNano"),
        F.col("severity_number").alias("severityNumber"),
        F.col("severity_text").alias("severityText"),
        F.struct(F.col("body").alias("stringValue")).alias("body"),
        _pairs("attributes").alias("attributes"),
        F.col("trace_id").alias("traceId"),
        F.col("span_id").alias("spanId"),
        F.col("event_name").alias("eventName"),
    )
    records = fx._log_frame("event_id")
    if before is not None:
        records = records.where(F.col("time_unix_nano") < before)
    rows = records.select("service", F.expr(f"event_id div {BATCH}").alias("_n"), record.alias("_r"))
    return _wrap(rows, "resourceLogs", "scopeLogs", "logRecords", ["_n"])


def spans(fx: Fixture) -> DataFrame:
    events = F.transform(
        "events",
        lambda e: F.struct(
            e["time"].cast("string").alias("timeUnixNano"),
            e["name"].alias("name"),
            _pairs(e["attributes"]).alias("attributes"),
        ),
    )
    record = F.struct(
        # Every user divisible by 50 sends an id that is not valid.
        F.when(F.try_element_at("attributes", F.lit("user.id")).cast("bigint") % 50 == 0, F.lit("0" * 32))
        .otherwise(F.upper("trace_id"))
        .alias("traceId"),
        F.col("span_id").alias("spanId"),
        F.coalesce("parent_span_id", F.lit("")).alias("parentSpanId"),
        F.col("name"),
        F.concat(F.lit("SPAN_KIND_"), F.col("kind")).alias("kind"),
        _text("start_time_unix_nano").alias("startTimeUnixNano"),
        _text("end_time_unix_nano").alias("endTimeUnixNano"),
        _pairs("attributes").alias("attributes"),
        events.alias("events"),
        F.struct(
            F.when(F.col("status") == "ERROR", "2").when(F.col("status") == "OK", "STATUS_CODE_OK").alias("code")
        ).alias("status"),
    )
    rows = fx._span_frame("event_id").select("service", F.expr(f"event_id div {BATCH}").alias("_n"), record.alias("_r"))
    return _wrap(rows, "resourceSpans", "scopeSpans", "spans", ["_n"])


def _point(*extra: Column) -> Column:
    return F.struct(
        _pairs("attributes").alias("attributes"),
        _text("start_time_unix_nano").alias("startTimeUnixNano"),
        _text("time_unix_nano").alias("timeUnixNano"),
        F.col("flags").cast("bigint").alias("flags"),
        *extra,
    )


def _exemplars() -> Column:
    # attributes of the derived exemplars are JSON objects of strings
    return F.transform(
        "exemplars",
        lambda e: F.struct(
            _pairs(F.from_json(e["attributes"], "map<string,string>")).alias("filteredAttributes"),
            e["time"].cast("string").alias("timeUnixNano"),
            e["value"].alias("asDouble"),
            e["trace_id"].alias("traceId"),
            e["span_id"].alias("spanId"),
        ),
    ).alias("exemplars")


def _metrics(points: DataFrame, kind: str, by: list[str], point: Column, *fields: Column) -> DataFrame:
    """Points grouped into metrics, metrics into envelopes; groups have at most ``BATCH`` points."""
    names = [f"_f{i}" for i in range(len(fields))]
    keyed = points.select(
        "service",
        "metric",
        "unit",
        "description",
        *by,
        *[f.alias(n) for f, n in zip(fields, names)],
        point.alias("_p"),
    )
    grouped = keyed.groupBy("service", "metric", "unit", "description", *by, *names).agg(
        F.collect_list("_p").alias("dataPoints")
    )
    body = [F.col("dataPoints"), *[F.col(n).alias(_FIELD_NAMES[i]) for i, n in enumerate(names)]]
    metric = F.struct(
        F.col("metric").alias("name"), "unit", "description", F.struct(*body).alias(kind)
    )
    return _wrap(grouped.select("service", "metric", *by, metric.alias("_r")), "resourceMetrics", "scopeMetrics", "metrics", [*by, "metric"])


_FIELD_NAMES = ("aggregationTemporality", "isMonotonic")


def metrics(fx: Fixture, table: str) -> DataFrame:
    """Envelopes that hold the points of one metric table."""
    temporality = F.concat(F.lit("AGGREGATION_TEMPORALITY_"), F.col("temporality"))
    if table in (schema.GAUGE, schema.SUM):
        frame = fx._gauge_frame("event_id") if table == schema.GAUGE else fx._sum_frame("event_id")
        rows = frame.withColumn("_n", F.expr(f"event_id div {BATCH}"))
        point = _point(F.col("value").alias("asDouble"), _exemplars())
        if table == schema.GAUGE:
            return _metrics(rows, "gauge", ["_n"], point)
        return _metrics(rows, "sum", ["_n"], point, temporality, F.col("is_monotonic"))
    rows = fx.tables[table]
    month = rows.withColumn("_n", F.trunc("day", "month").cast("string"))
    totals = [_text("count").alias("count"), F.col("sum")]
    if table == schema.HISTOGRAM:
        point = _point(
            *totals,
            "min",
            "max",
            F.transform("bucket_counts", lambda c: c.cast("string")).alias("bucketCounts"),
            F.col("explicit_bounds").alias("explicitBounds"),
        )
        return _metrics(month, "histogram", ["_n"], point, temporality)
    if table == schema.EXP_HISTOGRAM:

        def side(name: str) -> Column:
            counts = F.transform(f"{name}.bucket_counts", lambda c: c.cast("string"))
            return F.struct(F.col(f"{name}.offset").alias("offset"), counts.alias("bucketCounts")).alias(name)

        point = _point(
            *totals,
            "min",
            "max",
            "scale",
            _text("zero_count").alias("zeroCount"),
            F.col("zero_threshold").alias("zeroThreshold"),
            side("positive"),
            side("negative"),
        )
        return _metrics(month, "exponentialHistogram", ["_n"], point, temporality)
    point = _point(*totals, F.col("quantile_values").alias("quantileValues"))
    return _metrics(month, "summary", ["_n"], point)


def deliver(made: DataFrame, path: str) -> None:
    """Add envelopes to a folder as OTLP/JSON files, compressed: as text they take over twenty times the space of the tables."""
    made.write.mode("append").option("compression", "gzip").option("maxRecordsPerFile", FILE).json(path)
