"""Streams over the derived tables, run until their input is used up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberscope import schema
from emberscope.acceptance import envelopes
from emberscope.acceptance.fixtures import FIRST_DAY_NS, LAST_NS, Fixture
from emberscope.acceptance.registry import query
from emberscope.functions.timegrid import DAY, HOUR, bucket
from emberscope.operators import metrics
from emberscope.session import scratch_dir, shuffles_dropped
from emberscope.sources import otlp, tables
from emberscope.streaming import counter, ingest, windows

_ONCE = {"availableNow": True}


def _drain(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Run a stream into Parquet files until all present input has been taken."""
    (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**_ONCE)
        .start()
        .awaitTermination()
    )


def _run(fx: Fixture, stream: DataFrame) -> DataFrame:
    path = scratch_dir(fx.spark, "stream")
    _drain(stream, path, scratch_dir(fx.spark, "checkpoint"))
    return fx.spark.read.schema(stream.schema).parquet(path)


def _files(fx: Fixture, df: DataFrame) -> DataFrame:
    """A table written to files and opened as a stream."""
    path = scratch_dir(fx.spark, "arrivals")
    df.write.parquet(path)
    return fx.spark.readStream.schema(df.schema).parquet(path)


def _taken(fx: Fixture) -> str:
    """All derived tables sent as OTLP/JSON, with some lines that are none, and taken by streams; the tables' root."""
    sources = {signal: scratch_dir(fx.spark, signal) for signal in ("logs", "traces", "metrics")}
    torn = fx.base.where("event_type = 'error'").select(F.concat(F.lit('{"resourceLogs": [{"event": '), "event_id").alias("value"))
    with shuffles_dropped(fx.spark):
        envelopes.deliver(envelopes.logs(fx), sources["logs"])
        envelopes.deliver(envelopes.spans(fx), sources["traces"])
        for name in schema.METRIC_TABLES:
            envelopes.deliver(envelopes.metrics(fx, name), sources["metrics"])
        torn.write.mode("append").option("compression", "gzip").text(sources["logs"])
    root, checkpoint = scratch_dir(fx.spark, "tables"), scratch_dir(fx.spark, "checkpoint")
    promoted = {schema.LOGS: ["event.type"], schema.SPANS: ["user.id"]}
    for stream in ingest.start_all(fx.spark, sources, root, checkpoint, _ONCE, promoted):
        stream.awaitTermination()
    return root


_EVERY_TABLE = """WITH every AS (
    SELECT 'logs' AS "table", service, time_unix_nano AS t, event_type AS promoted FROM f_logs
    UNION ALL SELECT 'spans', service, start_time_unix_nano, CAST(user_id AS varchar) FROM f_spans WHERE user_id % 50 <> 0
    UNION ALL SELECT 'metrics_gauge', service, time_unix_nano, NULL FROM f_gauge
    UNION ALL SELECT 'metrics_sum', service, time_unix_nano, NULL FROM f_sum
    UNION ALL SELECT 'metrics_sum', service, time_unix_nano, NULL FROM f_sum_delta
    UNION ALL SELECT 'metrics_histogram', service, time_unix_nano, NULL FROM f_hist
    UNION ALL SELECT 'metrics_exp_histogram', service, time_unix_nano, NULL FROM f_hist
    UNION ALL SELECT 'metrics_summary', service, time_unix_nano, NULL FROM f_summary)
    SELECT "table", service, count(*) AS rows, min(t) AS first_time, max(t) AS last_time, max(promoted) AS last_promoted FROM every GROUP BY ALL"""
_EVERY_VIEW = ("f_logs", "f_spans", "f_gauge", "f_sum", "f_sum_delta", "f_hist", "f_summary")


@query("stream_ingest", _EVERY_TABLE, _EVERY_VIEW)
def _ingest(fx: Fixture) -> DataFrame:
    """Rows of all seven tables, and the keys promoted on the way."""
    root, out = _taken(fx), None
    for name, rows in tables.scan_all(fx.spark, root).items():
        column = {schema.LOGS: "attr_event_2e_type", schema.SPANS: "attr_user_2e_id"}.get(name)
        part = rows.groupBy("service").agg(
            F.count(F.lit(1)).alias("rows"),
            F.min(schema.TIME_COLUMN[name]).alias("first_time"),
            F.max(schema.TIME_COLUMN[name]).alias("last_time"),
            F.max(column if column else F.lit(None).cast("string")).alias("last_promoted"),
        )
        part = part.withColumn("table", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "stream_rejects",
    """SELECT 'traces' AS signal, 'spans' AS "table", 'bad trace id' AS reason, span_id AS record FROM f_spans WHERE user_id % 50 = 0
       UNION ALL SELECT 'logs', NULL, 'malformed', '{"resourceLogs": [{"event": ' || event_id FROM b WHERE event_type = 'error'""",
    ("f_spans",),
)
def _rejects(fx: Fixture) -> DataFrame:
    """Every record refused by the streams, by its span id, and every line that is no envelope."""
    refused = ingest.rejects(fx.spark, _taken(fx))
    span = F.get_json_object("record", "$.span_id")
    record = F.when(F.col("table").isNull(), F.col("record")).otherwise(span)
    return refused.select("signal", "table", F.col("reject_reason").alias("reason"), record.alias("record"))


@query(
    "stream_receipts",
    """SELECT 'traces' AS signal, 'spans' AS "table", CASE WHEN user_id % 50 <> 0 THEN 'accepted' ELSE 'bad trace id' END AS reason,
         count(*) AS count FROM f_spans GROUP BY ALL
       UNION ALL SELECT 'logs', 'logs', 'accepted', count(*) FROM f_logs HAVING count(*) > 0
       UNION ALL SELECT 'logs', NULL, 'malformed', count(*) FROM b WHERE event_type = 'error' HAVING count(*) > 0
       UNION ALL SELECT 'metrics', 'metrics_gauge', 'accepted', count(*) FROM f_gauge HAVING count(*) > 0
       UNION ALL SELECT 'metrics', 'metrics_sum', 'accepted', 2 * count(*) FROM f_sum HAVING count(*) > 0
       UNION ALL SELECT 'metrics', 'metrics_histogram', 'accepted', count(*) FROM f_hist HAVING count(*) > 0
       UNION ALL SELECT 'metrics', 'metrics_exp_histogram', 'accepted', count(*) FROM f_hist HAVING count(*) > 0
       UNION ALL SELECT 'metrics', 'metrics_summary', 'accepted', count(*) FROM f_summary HAVING count(*) > 0""",
    ("f_spans", "f_logs", "f_gauge", "f_sum", "f_hist", "f_summary"),
)
def _receipts(fx: Fixture) -> DataFrame:
    return ingest.receipts(fx.spark, _taken(fx))


# A window is final once the watermark has passed its end. After the only batch
# the watermark is the newest event time less the delay, in milliseconds.
_DELAY = HOUR
_WATERMARK = f"(SELECT (max(time_unix_nano) // 1000000) * 1000000 - {_DELAY} FROM f_logs)"


@query(
    "stream_volume",
    f"""SELECT * FROM (SELECT time_unix_nano - time_unix_nano % {HOUR} AS bucket_time, service, count(*) AS count
          FROM f_logs GROUP BY ALL) WHERE bucket_time + {HOUR} <= {_WATERMARK}""",
    ("f_logs",),
)
def _volume(fx: Fixture) -> DataFrame:
    logs = _files(fx, fx.logs.select("time_unix_nano", "service"))
    return _run(fx, windows.volume(logs, HOUR, _DELAY))


@query(
    "stream_red",
    f"""SELECT * FROM (SELECT start_time_unix_nano - start_time_unix_nano % {HOUR} AS bucket, service,
            count(*) AS calls, count(*) FILTER (status = 'ERROR') AS errors,
            quantile_disc(duration_ns, 0.5) AS p50, quantile_disc(duration_ns, 0.95) AS p95,
            quantile_disc(duration_ns, 0.99) AS p99 FROM f_spans GROUP BY ALL)
        WHERE bucket + {HOUR} <= {_WATERMARK}""",
    ("f_spans", "f_logs"),
)
def _red(fx: Fixture) -> DataFrame:
    """Percentiles are exact: the stream stores how often each duration occurs."""
    spans = _files(fx, fx.spans.select("start_time_unix_nano", "service", "status", "duration_ns"))
    counter.use_state_store(fx.spark)
    return windows.exact_red(_run(fx, windows.red_counts(spans, HOUR, _DELAY)))


@query(
    "stream_red_by_day",
    f"""SELECT bucket - bucket % {DAY} AS bucket, service, CAST(sum(calls) AS bigint) AS calls, CAST(sum(errors) AS bigint) AS errors FROM (
          SELECT start_time_unix_nano - start_time_unix_nano % {HOUR} AS bucket, service,
            count(*) AS calls, count(*) FILTER (status = 'ERROR') AS errors FROM f_spans GROUP BY ALL)
        WHERE bucket + {HOUR} <= {_WATERMARK} GROUP BY ALL""",
    ("f_spans", "f_logs"),
)
def _red_by_day(fx: Fixture) -> DataFrame:
    """Hours that a stream has stored, merged to days; tests bound the error of the merged percentiles."""
    spans = _files(fx, fx.spans.select("start_time_unix_nano", "service", "status", "duration_ns"))
    hours = _run(fx, windows.red_sketches(spans, HOUR, _DELAY))
    return windows.red(windows.coarser(hours, DAY)).drop(*windows.PERCENTILES)


@query(
    "stream_count_over_time",
    f"""SELECT service, ts, CAST(count(*) AS double) AS value FROM (
          SELECT service, time_unix_nano - time_unix_nano % {HOUR} + i * {HOUR} AS ts FROM f_logs, range(1, 4) r(i))
        WHERE ts <= {_WATERMARK} GROUP BY ALL""",
    ("f_logs",),
)
def _count_over_time(fx: Fixture) -> DataFrame:
    logs = _files(fx, fx.logs.select("time_unix_nano", "service"))
    return _run(fx, windows.count_over_time(logs, 3 * HOUR, HOUR, _DELAY))


@query(
    "stream_late",
    f"""WITH t AS (SELECT service, count(*) AS table_rows FROM (SELECT service FROM f_logs
            UNION ALL SELECT service FROM f_logs WHERE time_unix_nano < {FIRST_DAY_NS + DAY}) GROUP BY service),
          v AS (SELECT service, CAST(sum(n) AS bigint) AS counted_rows FROM (
            SELECT service, time_unix_nano - time_unix_nano % {HOUR} AS bucket_time, count(*) AS n FROM f_logs GROUP BY ALL)
            WHERE bucket_time + {HOUR} <= {_WATERMARK} GROUP BY service)
        SELECT * FROM t JOIN v USING (service)""",
    ("f_logs",),
)
def _late(fx: Fixture) -> DataFrame:
    """The first day arrives again after everything else: kept by ingest, not counted again."""
    arrivals, out = scratch_dir(fx.spark, "arrivals"), scratch_dir(fx.spark, "volume")
    root = scratch_dir(fx.spark, "tables")
    checkpoints = [scratch_dir(fx.spark, "checkpoint") for _ in range(2)]

    def pass_over() -> None:
        stored = ingest.writer(fx.spark, schema.LOGS, arrivals, root, checkpoints[0])
        stored.trigger(**_ONCE).start().awaitTermination()
        rows = otlp.accepted(otlp.log_rows(otlp.stream_envelopes(fx.spark, "logs", arrivals)))
        _drain(windows.volume(rows, HOUR, _DELAY), out, checkpoints[1])

    envelopes.logs(fx).write.json(arrivals)
    pass_over()
    envelopes.logs(fx, before=FIRST_DAY_NS + DAY).write.mode("append").json(arrivals)
    pass_over()
    stored = tables.scan(fx.spark, root, schema.LOGS).groupBy("service").agg(
        F.count(F.lit(1)).alias("table_rows")
    )
    counted = (
        fx.spark.read.schema("bucket_time BIGINT, service STRING, count BIGINT")
        .parquet(out)
        .groupBy("service")
        .agg(F.sum("count").alias("counted_rows"))
    )
    return stored.join(counted, "service")


_FLUSH_NS = LAST_NS + 400 * DAY  # a sample so far ahead makes all others final


def _increases(fx: Fixture, delay_ns: int, *waves: DataFrame) -> DataFrame:
    """Increases of ``event.count`` after its samples have arrived in waves, the flush being the last."""
    flush = fx.spark.createDataFrame([("flush", 0, _FLUSH_NS, 0.0)], "labels STRING, _resource BIGINT, time_unix_nano BIGINT, value DOUBLE")
    arrivals, out, checkpoint = (scratch_dir(fx.spark, n) for n in ("samples", "increases", "checkpoint"))
    for wave in (*waves, flush):
        wave.write.mode("append").parquet(arrivals)
        stream = counter.increases(fx.spark.readStream.schema(flush.schema).parquet(arrivals), delay_ns)
        _drain(stream, out, checkpoint)
    return fx.spark.read.schema(stream.schema).parquet(out).groupBy("labels", bucket(F.col("time_unix_nano"), HOUR).alias("bucket")).agg(
        F.round(F.sum("increase") / F.lit(3600.0), 6).alias("v")
    )


def _counter(fx: Fixture) -> DataFrame:
    points = fx.sum.where(F.col("metric") == "event.count")
    return points.select("labels", *metrics.source(points), "time_unix_nano", "value")


_RATE_SQL = f"""WITH i AS (SELECT labels, time_unix_nano, CASE WHEN lag(value) OVER w IS NULL THEN 0
            WHEN value >= lag(value) OVER w THEN value - lag(value) OVER w ELSE value END AS inc
          FROM f_sum WINDOW w AS (PARTITION BY labels ORDER BY time_unix_nano, value))
        SELECT labels, time_unix_nano - time_unix_nano % {HOUR} AS bucket, round(sum(inc) / 3600.0::double, 6) AS v
        FROM i GROUP BY ALL"""


@query("stream_rate", _RATE_SQL, ("f_sum",))
def _rate(fx: Fixture) -> DataFrame:
    return _increases(fx, HOUR, _counter(fx))


@query("stream_rate_late", _RATE_SQL, ("f_sum",))
def _rate_late(fx: Fixture) -> DataFrame:
    """A third of the samples of two days arrives only with those of the time after them; none is lost."""
    samples, middle = _counter(fx), FIRST_DAY_NS + 15 * DAY
    late = (F.col("time_unix_nano") >= middle) | ((F.col("time_unix_nano") >= middle - 2 * DAY) & (F.col("value") % 3 == 0))
    return _increases(fx, 3 * DAY, samples.where(~late), samples.where(late))


@query("stream_dedup", "SELECT trace_id, span_id, service, start_time_unix_nano FROM f_spans", ("f_spans",))
def _dedup(fx: Fixture) -> DataFrame:
    spans = fx.spans.select("trace_id", "span_id", "service", "start_time_unix_nano")
    twice = spans.unionByName(spans)
    return _run(fx, windows.distinct_spans(_files(fx, twice), _DELAY))
