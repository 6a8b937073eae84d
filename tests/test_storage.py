from __future__ import annotations

import json
from datetime import date

import pytest

from emberscope import schema
from pyspark.sql import functions as F

from emberscope.functions.attrs import promoted_column
from emberscope.functions.timegrid import DAY, HOUR
from emberscope.operators import discovery, logs, upkeep
from emberscope.plans.predicates import log_predicate
from emberscope.plans.specs import LogQuery, TimeRange
from emberscope.session import scratch_dir
from emberscope.sources import otlp, tables
from emberscope.streaming import ingest, windows
from tests.helpers import S, logs as make_logs, samples, spans, tuples


def put(path, *envelopes):
    with open(path, "w") as f:
        f.writelines(json.dumps(e) + "\n" for e in envelopes)
    return str(path)


def kv(key, **value):
    return {"key": key, "value": value}


SERVICE = {"attributes": [kv("service.name", stringValue="checkout")]}


def log_envelope(*records):
    scope = {"scope": {"name": "lib"}, "logRecords": list(records)}
    return {"resourceLogs": [{"resource": SERVICE, "scopeLogs": [scope]}]}


def span_envelope(*records):
    return {"resourceSpans": [{"resource": SERVICE, "scopeSpans": [{"scope": {}, "spans": list(records)}]}]}


def metric_envelope(*metrics):
    return {"resourceMetrics": [{"resource": SERVICE, "scopeMetrics": [{"metrics": list(metrics)}]}]}


def read(spark, signal, fresh, *envelopes):
    return otlp.read_envelopes(spark, signal, put(f"{fresh}/in.json", *envelopes))


def test_log_records(spark, fresh):
    envelope = log_envelope(
        {"timeUnixNano": "1400", "severityNumber": 13, "body": {"stringValue": "disk of node 4 is nearly full"}},
        {"timeUnixNano": "0", "observedTimeUnixNano": "2000", "severityNumber": 9, "body": {"intValue": "7"}},
        {"severityNumber": 9, "body": {"stringValue": "no time"}},
        {
            "timeUnixNano": "3000",
            "traceId": "A" * 32,
            "spanId": "0" * 16,
            "body": {"kvlistValue": {"values": [{"value": {"boolValue": True}, "key": "x"}]}},
            "attributes": [
                kv("b", boolValue=True), kv("i", intValue="5"), kv("d", doubleValue=1.5), kv("e"),
                kv("l", arrayValue={"values": [{"stringValue": "s"}]}), kv("b", stringValue="again"),
            ],
        },
    )
    rows = otlp.log_rows(read(spark, "logs", fresh, envelope))
    kept = otlp.accepted(rows)
    assert kept.schema.simpleString() == schema.table_schema(schema.LOGS).simpleString()
    assert tuples(kept, "time_unix_nano", "service", "severity_number", "body")[:2] == [
        (1400, "checkout", 13, "disk of node 4 is nearly full"),
        (2000, "checkout", 9, "7"),
    ]
    last = kept.where("time_unix_nano = 3000").first()
    assert last.trace_id == "a" * 32 and last.span_id is None
    assert last.body == '{"values":[{"key":"x","value":{"boolValue":true}}]}'
    assert last.attributes == {
        "b": "true", "i": "5", "d": "1.5", "e": None, "l": '{"values":[{"stringValue":"s"}]}',
    }
    assert tuples(otlp.receipt(rows, "logs")) == [("logs", "accepted", 3), ("logs", "no time", 1)]
    names = discovery.attr_names({schema.LOGS: kept})
    assert {"service.name", "b", "l"} <= {r.name for r in names.collect()}
    assert tuples(discovery.attr_values({schema.LOGS: kept}, "service.name")) == [("checkout",)]


def test_span_records(spark, fresh):
    base = {"traceId": "1" * 32, "spanId": "2" * 16, "startTimeUnixNano": "5", "endTimeUnixNano": "9"}
    rows = otlp.span_rows(
        read(
            spark,
            "traces",
            fresh,
            span_envelope(
                {**base, "kind": 2, "status": {"code": 2, "message": "m"}, "parentSpanId": ""},
                {**base, "kind": "SPAN_KIND_CLIENT", "parentSpanId": "3" * 16},
                {**base, "traceId": "0" * 32},
                {**base, "spanId": "xyz"},
            ),
        )
    )
    assert tuples(otlp.accepted(rows), "kind", "status", "duration_ns", "parent_span_id") == [
        ("CLIENT", "UNSET", 4, "3" * 16),
        ("SERVER", "ERROR", 4, None),
    ]
    assert tuples(otlp.rejected(rows), otlp.REASON) == [("bad span id",), ("bad trace id",)]


def test_metric_points_go_to_their_tables(spark, fresh):
    point = {"timeUnixNano": "10", "attributes": [kv("z", stringValue="1"), kv("a", intValue="2")]}
    envelopes = read(
        spark,
        "metrics",
        fresh,
        metric_envelope(
            {
                "name": "g",
                "gauge": {
                    "dataPoints": [
                        {**point, "asInt": "3"}, {**point, "asDouble": 0.0}, {"timeUnixNano": "0", "asInt": "1"},
                        point, {**point, "flags": 1},
                    ]
                },
            },
            {"name": "s", "sum": {"dataPoints": [{**point, "asDouble": 1.5}], "aggregationTemporality": 2, "isMonotonic": True}},
            {"name": "h", "histogram": {"dataPoints": [{**point, "count": "3", "bucketCounts": ["1", "2"], "explicitBounds": [5.0]}]}},
            {"name": "e", "exponentialHistogram": {"dataPoints": [{**point, "count": "1", "scale": 3, "positive": {"offset": -1, "bucketCounts": ["1"]}}]}},
            {"name": "q", "summary": {"dataPoints": [{**point, "count": "1", "sum": 2.0, "quantileValues": [{"quantile": 0.5, "value": 2.0}]}]}},
        ),
    )
    gauge = otlp.metric_rows(envelopes, schema.GAUGE)
    assert tuples(otlp.accepted(gauge), "value", "flags") == [(0.0, 0), (3.0, 0), (None, 1)]
    assert tuples(otlp.rejected(gauge), otlp.REASON) == [("no time",), ("no value",)]
    assert otlp.accepted(gauge).first().labels == '{"a":"2","service":"checkout","z":"1"}'
    assert tuples(otlp.metric_rows(envelopes, schema.SUM), "temporality", "is_monotonic") == [("CUMULATIVE", True)]
    assert tuples(otlp.metric_rows(envelopes, schema.HISTOGRAM), "bucket_counts") == [([1, 2],)]
    exp = otlp.metric_rows(envelopes, schema.EXP_HISTOGRAM).first()
    assert (exp.scale, exp.positive.offset, exp.negative.bucket_counts) == (3, -1, [])
    assert otlp.metric_rows(envelopes, schema.SUMMARY).first().quantile_values[0].value == 2.0


def days_of_logs(spark, days=4):
    return make_logs(
        spark,
        *[
            {"time_unix_nano": d * DAY + h * HOUR, "body": f"{d}-{h}", "attributes": {"k": str(h)}}
            for d in range(days)
            for h in range(24)
        ],
    )


def test_partition_pruning_and_promoted_pushdown(spark, fresh):
    rows = days_of_logs(spark)
    tables.append(rows, fresh, schema.LOGS, promote_keys=["k"])
    stored = tables.scan(spark, fresh, schema.LOGS)
    q = LogQuery(range=TimeRange(DAY, 2 * DAY), attr_eq=[("k", "3")])
    found = stored.where(log_predicate(q, stored.columns))
    assert [r.body for r in found.collect()] == ["1-3"]
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    plan = found.select("body")._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PartitionFilters: [isnotnull(day" in plan
    assert "EqualTo(attr_k,3)" in plan and "GreaterThanOrEqual(time_unix_nano" in plan


def test_malformed_lines_are_counted(spark, fresh):
    record = {"timeUnixNano": "7", "body": {"stringValue": "ok"}, "flags": 4294967295}
    good = {"resourceLogs": [{"scopeLogs": [{"logRecords": [record, {"body": {"stringValue": "x"}}]}]}]}
    lines = [json.dumps(good), "{broken", '"text"', json.dumps({"resourceLogs": []})]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(f"{fresh}/in")
    envelopes = otlp.read_envelopes(spark, "logs", f"{fresh}/in")
    rows = otlp.log_rows(envelopes)
    got = {r["reason"]: r["count"] for r in otlp.receipt(rows, "logs", envelopes).collect()}
    assert got == {"accepted": 1, "no time": 1, "malformed": 2}
    assert sorted(r.line for r in otlp.malformed(envelopes).collect()) == ['"text"', "{broken"]
    assert otlp.accepted(rows).first().flags == 4294967295


def test_promotion_never_hides_rows(spark, fresh):
    rows, q = days_of_logs(spark), LogQuery(attr_eq=[("k", "3")])

    def found(root):
        stored = tables.scan(spark, root, schema.LOGS)
        hits = sorted(r.body for r in stored.where(log_predicate(q, stored.columns)).collect())
        return hits, "attr_k" in stored.columns

    once, _ = sorted(r.body for r in rows.where(F.col("attributes")["k"] == "3").collect()), None
    tables.append(rows, f"{fresh}/late", schema.LOGS)
    tables.append(rows, f"{fresh}/late", schema.LOGS, promote_keys=["k"])
    assert found(f"{fresh}/late") == (sorted(once * 2), False)
    upkeep.compact(spark, f"{fresh}/late", schema.LOGS, f"{fresh}/compacted")
    assert found(f"{fresh}/compacted") == (sorted(once * 2), True)
    tables.append(rows, f"{fresh}/compacted", schema.LOGS)
    assert found(f"{fresh}/compacted") == (sorted(once * 3), True)
    upkeep.snapshot(spark, f"{fresh}/compacted", f"{fresh}/copy")
    assert found(f"{fresh}/copy") == (sorted(once * 3), True)


def test_promoted_keys_never_share_a_column():
    keys = ["event.type", "event_type", "Event.Type", "event-type", "eventtype", "event_2e_type"]
    assert len({promoted_column(k).lower() for k in keys}) == len(keys)


def test_export_zero_range_is_everything(spark, fresh):
    rows = days_of_logs(spark)
    tables.export(rows, schema.LOGS, f"{fresh}/all", 0, 0, "json")
    assert spark.read.schema(schema.table_ddl(schema.LOGS)).json(f"{fresh}/all").count() == 96
    tables.export(rows, schema.LOGS, f"{fresh}/some", DAY, DAY + 1, "orc")
    assert [r.body for r in spark.read.orc(f"{fresh}/some").collect()] == ["1-0"]
    with pytest.raises(ValueError):
        tables.export(rows, schema.LOGS, f"{fresh}/x", fmt="xml")


def test_upkeep(spark, fresh):
    root = f"{fresh}/db"
    for part in days_of_logs(spark).repartition(3), days_of_logs(spark).repartition(2):
        tables.append(part, root, schema.LOGS)
    before = {r.table: r for r in upkeep.table_stats(spark, root).collect()}
    assert before["logs"].rows == 192 and before["logs"].files == 20
    assert (before["spans"].rows, before["spans"].files, before["spans"].min_time) == (0, 0, None)

    report = upkeep.compact(spark, root, schema.LOGS, f"{fresh}/compacted")
    assert report == {"merged": 20, "created": 4}
    old, new = (tables.scan(spark, r, schema.LOGS) for r in (root, f"{fresh}/compacted"))
    assert old.select("body", "day").exceptAll(new.select("body", "day")).count() == 0

    listed = upkeep.segments(spark, f"{fresh}/compacted").orderBy("min_time_unix_nano").collect()
    assert [r.rows for r in listed] == [48] * 4
    assert listed[1].min_time_unix_nano == DAY and listed[1].max_time_unix_nano == DAY + 23 * HOUR
    paths = [r.path for r in upkeep.segment_files(spark, f"{fresh}/compacted", schema.LOGS).collect()]
    assert sorted(paths) == sorted(r.relative_path for r in listed)
    assert all(p.startswith("logs/day=1970-01-0") for p in paths)

    assert upkeep.snapshot(spark, root, f"{fresh}/copy")["logs"] > 0
    assert tables.scan(spark, f"{fresh}/copy", schema.LOGS).count() == 192


def test_statistics_come_from_footers_and_listings(spark, fresh):
    root = f"{fresh}/db"
    assert upkeep.day_stats(spark, root).count() == 0
    assert {(r.table, r.files, r.rows) for r in upkeep.table_stats(spark, root).collect()} == {(n, 0, 0) for n in schema.TABLE_NAMES}
    for batch in ("a", "b"):
        tables.append(days_of_logs(spark).repartition(2), root, schema.LOGS, batch=batch)
    found = upkeep.day_stats(spark, root)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)" in plan and "FileScan parquet" not in plan
    assert "FileScan parquet" not in upkeep.table_stats(spark, root)._jdf.queryExecution().executedPlan().toString()
    own = tables.scan(spark, root, schema.LOGS).groupBy("day").agg(F.count("*"), F.min("time_unix_nano"), F.max("time_unix_nano"))
    assert sorted(tuples(found.drop("table"))) == sorted(tuples(own))
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
    listed = upkeep.day_sizes(spark, root)
    assert "ReadSchema: struct<length:bigint>" in listed._jdf.queryExecution().executedPlan().toString()
    assert listed.agg(F.sum("files")).first()[0] == upkeep.segment_files(spark, root, schema.LOGS).count() == 16


def test_footers_of_files_from_rows_in_another_column_order(spark, fresh):
    rows = days_of_logs(spark)
    turned = rows.select(*reversed(rows.columns)).drop("observed_time_unix_nano")
    tables.append(turned, fresh, schema.LOGS)
    found = upkeep.table_stats(spark, fresh).where("rows > 0").collect()
    assert [(r.table, r.rows, r.min_time, r.max_time) for r in found] == [("logs", *rows.agg(F.count("*"), F.min("time_unix_nano"), F.max("time_unix_nano")).first())]


def test_retention_by_age_and_bytes(spark, fresh):
    root = f"{fresh}/db"
    tables.append(days_of_logs(spark).coalesce(1), root, schema.LOGS)
    by_age = upkeep.kept_days(spark, root, retention_days=2, today=date(1970, 1, 4))
    assert tuples(by_age) == [(date(1970, 1, 3),), (date(1970, 1, 4),)]
    sizes = {r.day: r.bytes for r in upkeep.day_sizes(spark, root).collect()}
    newest_two = sizes[date(1970, 1, 4)] + sizes[date(1970, 1, 3)]
    by_size = upkeep.kept_days(spark, root, max_bytes=newest_two)
    assert tuples(by_size) == [(date(1970, 1, 3),), (date(1970, 1, 4),)]
    upkeep.retain(spark, root, f"{fresh}/kept", max_bytes=newest_two - 1)
    assert tuples(tables.scan(spark, f"{fresh}/kept", schema.LOGS).select("day").distinct()) == [(date(1970, 1, 4),)]


def test_scratch_uses_the_shared_folder():
    class Conf(dict):
        get = dict.get

    class Context:
        master = "local[2]"

    class Session:
        conf = Conf()
        sparkContext = Context

    assert scratch_dir(Session, "x").startswith("/tmp/run-")
    Session.conf = Conf({"spark.checkpoint.dir": "s3://shared/"})
    assert scratch_dir(Session, "x").startswith("s3://shared/emberscope/x-")
    Session.conf, Context.master = Conf(), "spark://host:7077"
    with pytest.raises(ValueError):
        scratch_dir(Session, "x")


# --- streams ----------------------------------------------------------------------------


def run(writer):
    writer.trigger(availableNow=True).start().awaitTermination()


def test_stream_ingest_takes_each_file_once(spark, fresh):
    import os

    os.makedirs(f"{fresh}/in")
    writer = lambda: ingest.writer(spark, schema.LOGS, f"{fresh}/in", f"{fresh}/db", f"{fresh}/cp")
    put(f"{fresh}/in/1.json", log_envelope({"timeUnixNano": "1", "body": {"stringValue": "a"}}, {"body": {}}))
    run(writer())
    put(f"{fresh}/in/2.json", log_envelope({"timeUnixNano": "2", "body": {"stringValue": "b"}}))
    run(writer())
    run(writer())
    assert tuples(tables.scan(spark, f"{fresh}/db", schema.LOGS), "body") == [("a",), ("b",)]


def test_a_table_is_either_streamed_or_appended(spark, fresh):
    import os

    os.makedirs(f"{fresh}/in")
    put(f"{fresh}/in/1.json", log_envelope({"timeUnixNano": "1", "body": {"stringValue": "a"}}))
    run(ingest.writer(spark, schema.LOGS, f"{fresh}/in", f"{fresh}/streamed", f"{fresh}/cp"))
    rows = days_of_logs(spark, 1)
    with pytest.raises(ValueError, match="written by a stream"):
        tables.append(rows, f"{fresh}/streamed", schema.LOGS)
    tables.append(rows, f"{fresh}/appended", schema.LOGS)
    with pytest.raises(ValueError, match="no stream wrote"):
        ingest.writer(spark, schema.LOGS, f"{fresh}/in", f"{fresh}/appended", f"{fresh}/cp2")


def test_clustered_append_keeps_files_few(spark, fresh):
    rows = days_of_logs(spark).repartition(8)
    tables.append(rows, f"{fresh}/loose", schema.LOGS)
    tables.append(rows, f"{fresh}/tight", schema.LOGS, clustered=True)
    loose, tight = (upkeep.segment_files(spark, f"{fresh}/{r}", schema.LOGS).count() for r in ("loose", "tight"))
    assert loose == 32 and tight <= 12
    assert tables.scan(spark, f"{fresh}/tight", schema.LOGS).count() == 96


def test_late_rows_are_not_counted_again(spark, fresh):
    def arrive(*times):
        make_logs(spark, *[{"time_unix_nano": t * S} for t in times]).write.mode("append").parquet(f"{fresh}/in")

    def count():
        stream = spark.readStream.schema(schema.table_ddl(schema.LOGS)).parquet(f"{fresh}/in")
        w = windows.volume(stream, 60 * S, 30 * S).writeStream.format("parquet").outputMode("append")
        run(w.option("path", f"{fresh}/out").option("checkpointLocation", f"{fresh}/cp"))
        rows = spark.read.schema("bucket_time BIGINT, service STRING, count BIGINT").parquet(f"{fresh}/out")
        return sorted((t // S, n) for t, n in tuples(rows, "bucket_time", "count"))

    arrive(1, 2, 61, 100)
    assert count() == [(0, 2)]
    arrive(3, 62, 200)
    assert count() == [(0, 2), (60, 3)]


def test_duplicate_spans_are_dropped(spark, fresh):
    one = {"trace_id": "a", "span_id": "b", "start_time_unix_nano": S}
    rows = spans(spark, one, one, {**one, "span_id": "c"})
    for _ in range(2):
        rows.write.mode("append").parquet(f"{fresh}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{fresh}/in")
    distinct = windows.distinct_spans(stream, 60 * S)
    w = distinct.writeStream.format("parquet").option("path", f"{fresh}/out")
    run(w.option("checkpointLocation", f"{fresh}/cp"))
    assert tuples(spark.read.parquet(f"{fresh}/out"), "span_id") == [("b",), ("c",)]


def test_logs_query_on_stored_table_is_a_top_k(spark, fresh):
    tables.append(days_of_logs(spark), fresh, schema.LOGS)
    top = logs.query(tables.scan(spark, fresh, schema.LOGS), LogQuery(limit=3))
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()
    assert [r.body for r in top.collect()] == ["3-23", "3-22", "3-21"]


def test_compaction_gives_a_task_no_more_rows_than_it_should_sort(spark, fresh, monkeypatch):
    monkeypatch.setattr(upkeep, "TASK_ROWS", 100, raising=False)
    rows = make_logs(spark, *[{"time_unix_nano": i * S, "service": "ab"[i % 2], "body": f"b{i}"} for i in range(1000)])
    tables.append(rows, f"{fresh}/t", schema.LOGS)
    upkeep.compact(spark, f"{fresh}/t", schema.LOGS, f"{fresh}/out")
    files = upkeep.segments(spark, f"{fresh}/out").collect()
    assert sum(f.rows for f in files) == 1000 and max(f.rows for f in files) < 250
    assert sorted(r.body for r in tables.scan(spark, f"{fresh}/out", schema.LOGS).collect()) == sorted(f"b{i}" for i in range(1000))


def shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for f in manager.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}


def test_what_streams_are_sent_takes_little_disk(spark, fresh, monkeypatch):
    import gzip
    import os
    import time

    from emberscope.acceptance import envelopes, stream_queries
    from emberscope.acceptance.fixtures import Fixture

    monkeypatch.setattr(stream_queries, "scratch_dir", lambda _, label: f"{fresh}/{label}")
    monkeypatch.setattr(envelopes, "FILE", 10, raising=False)
    before, setting = shuffle_files(spark), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(setting, None)
    stream_queries._taken(Fixture(spark, "/root/testdata/sf0.001"))
    assert spark.conf.get(setting, None) == was
    sent = [os.path.join(d, f) for s in ("logs", "traces", "metrics") for d, _, files in os.walk(f"{fresh}/{s}") for f in files if f.startswith("part-")]
    texts = {f: gzip.open(f).read() for f in sent if f.endswith(".gz")}
    assert len(texts) == len(sent) > 0
    # The text is not written as it is, and no file grows with the data.
    assert sum(os.path.getsize(f) for f in sent) < sum(map(len, texts.values())) / 5
    assert max(t.count(b"\n") for f, t in texts.items() if f.endswith(".json.gz")) == 10
    # Nothing shuffled on the way stays until the driver collects garbage.
    for _ in range(50):
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.2)
    assert not left
