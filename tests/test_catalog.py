from __future__ import annotations

import os
from datetime import date

import pytest

from emberscope import schema
from emberscope.operators import discovery, logs, upkeep
from emberscope.plans.specs import LogQuery
from emberscope.sources import catalog, tables
from emberscope.streaming import ingest
from tests.helpers import S, samples, tuples
from tests.helpers import logs as make_logs
from tests.test_storage import kv, log_envelope, metric_envelope, put

DAY = 86_400 * S


def days(spark):
    return make_logs(
        spark,
        {"time_unix_nano": 1, "attributes": {"a": "1", "b": None}, "resource": {"a": "2", "b": "3", "service.name": "x"}, "service": "x"},
        {"time_unix_nano": DAY + 1, "attributes": {"c": "4"}, "service": None},
        {"time_unix_nano": 2 * DAY + 1},
    )


def test_entries_are_what_lookups_find(spark, fresh):
    rows = days(spark)
    tables.append(rows.where("time_unix_nano < 2 * 86400000000000"), fresh, schema.LOGS)
    tables.append(rows, fresh, schema.LOGS)
    known, stored = catalog.read(spark, fresh), {schema.LOGS: rows}
    assert tuples(discovery.attr_names(known)) == tuples(discovery.attr_names(stored)) == [("a",), ("b",), ("c",), ("service.name",)]
    for key in ("a", "b", "c", "service", "service.name", "none"):
        assert tuples(discovery.attr_values(known, key)) == tuples(discovery.attr_values(stored, key))
    assert tuples(discovery.attr_names(catalog.read(spark, fresh, first=date(1970, 1, 2), last=date(1970, 1, 2)))) == [("c",)]


def test_lookups_read_the_catalog_only(spark, fresh):
    tables.append(days(spark), fresh, schema.LOGS)
    tables.append(samples(spark, schema.GAUGE, {"time_unix_nano": 1, "metric": "cpu.load", "unit": "1"}), fresh, schema.GAUGE)
    known = catalog.read(spark, fresh)
    for found in (discovery.attr_names(known), discovery.attr_values(known, "a"), discovery.metric_names(known)):
        assert found.inputFiles() and all("/_catalog/" in f for f in found.inputFiles())
    assert tuples(discovery.metric_catalog(known)) == [("cpu.load", "1", None, "gauge")]
    stored = tables.scan_all(spark, fresh)
    assert tuples(discovery.points_of(stored, "cpu_load", known), "metric") == [("cpu.load",)]
    assert catalog.read(spark, f"{fresh}/nowhere").count() == 0


def test_metrics_are_found_in_their_own_table(spark, fresh):
    stored = {
        schema.GAUGE: samples(spark, schema.GAUGE, {"time_unix_nano": 1, "metric": "both"}),
        schema.SUMMARY: samples(spark, schema.SUMMARY, {"time_unix_nano": 1, "metric": "spread"}, {"time_unix_nano": 1, "metric": "both"}),
        schema.EXP_HISTOGRAM: samples(spark, schema.EXP_HISTOGRAM, {"time_unix_nano": 1, "metric": "skew"}),
    }
    assert "quantile_values" in discovery.points_of(stored, "spread").columns
    assert "zero_threshold" in discovery.points_of(stored, "skew").columns
    with pytest.raises(ValueError, match="metrics_gauge.*metrics_summary"):
        discovery.points_of(stored, "both")


def test_rebuilt_and_carried_entries_are_equal(spark, fresh):
    for part in days(spark).randomSplit([1.0, 1.0], seed=1):
        tables.append(part, f"{fresh}/db", schema.LOGS)
    made = tuples(catalog.read(spark, f"{fresh}/db"))
    upkeep.compact(spark, f"{fresh}/db", schema.LOGS, f"{fresh}/compacted")
    upkeep.snapshot(spark, f"{fresh}/db", f"{fresh}/copy")
    assert tuples(catalog.read(spark, f"{fresh}/compacted")) == tuples(catalog.read(spark, f"{fresh}/copy")) == made
    catalog.rebuild({schema.LOGS: tables.scan(spark, f"{fresh}/db", schema.LOGS)}, f"{fresh}/new")
    assert tuples(catalog.read(spark, f"{fresh}/new")) == made
    upkeep.retain(spark, f"{fresh}/db", f"{fresh}/kept", retention_days=2, today=date(1970, 1, 3))
    assert tuples(catalog.read(spark, f"{fresh}/kept").select("day").distinct()) == [(date(1970, 1, 2),), (date(1970, 1, 3),)]
    tables.append(days(spark).where("attributes['c'] = '4'"), f"{fresh}/db", schema.LOGS, mode="overwrite")
    assert tuples(discovery.attr_names(catalog.read(spark, f"{fresh}/db"))) == [("c",)]


def test_overwriting_keeps_promoted_keys(spark, fresh):
    tables.append(days(spark), fresh, schema.LOGS, promote_keys=["a"])
    tables.append(days(spark), fresh, schema.LOGS, promote_keys=["c"], mode="overwrite")
    stored = tables.scan(spark, fresh, schema.LOGS)
    assert {"attr_a", "attr_c"} <= set(stored.columns)
    assert logs.matching(stored, LogQuery(attr_eq=[("a", "1")])).count() == logs.matching(stored, LogQuery(attr_eq=[("c", "4")])).count() == 1


def test_streams_fill_all_tables_once(spark, fresh):
    for signal in ("logs", "metrics"):
        os.makedirs(f"{fresh}/{signal}")

    def take():
        sources = {"logs": f"{fresh}/logs", "metrics": f"{fresh}/metrics"}
        for q in ingest.start_all(spark, sources, f"{fresh}/db", f"{fresh}/cp", {"availableNow": True}, {schema.LOGS: ["k"]}):
            q.awaitTermination()

    def log(time, text, **attributes):
        return {"timeUnixNano": str(time), "body": {"stringValue": text}, "attributes": [kv(k, stringValue=v) for k, v in attributes.items()]}

    put(f"{fresh}/logs/1.json", log_envelope(log(5, "a", k="x"), {"body": {"stringValue": "timeless"}}))
    point = {"timeUnixNano": "7", "asInt": "3"}
    put(f"{fresh}/metrics/1.json", metric_envelope({"name": "g", "gauge": {"dataPoints": [point, {"timeUnixNano": "8"}]}}, {"name": "s", "sum": {"dataPoints": [point]}}))
    take()
    with open(f"{fresh}/logs/2.json", "w") as f:
        f.write("no envelope\n")
    put(f"{fresh}/logs/3.json", log_envelope(log(6, "b", k="y")))
    take()
    take()
    root = f"{fresh}/db"

    def state():
        return (
            tuples(tables.scan(spark, root, schema.LOGS), "body", "attr_k"),
            [tables.scan(spark, root, t).count() for t in schema.METRIC_TABLES],
            sorted(((r.signal, r.table, r.reject_reason) for r in ingest.rejects(spark, root).collect()), key=repr),
            tuples(ingest.receipts(spark, root)),
            tuples(discovery.attr_names(catalog.read(spark, root))),
        )

    first = state()
    assert first[0] == [("a", "x"), ("b", "y")] and first[1] == [1, 1, 0, 0, 0]
    assert first[2] == [("logs", "logs", "no time"), ("logs", None, "malformed"), ("metrics", "metrics_gauge", "no value")]
    assert ("logs", "logs", "accepted", 2) in first[3] and ("logs", None, "malformed", 1) in first[3]
    # A batch that comes again writes the same folders.
    again = otlp_batch(spark, f"{fresh}/logs/1.json")
    ingest.take(again, 0, "logs", root, {schema.LOGS: ["k"]})
    assert state() == first
    # Rows may be appended beside the streams' batches; a plain table takes no batch.
    tables.append(make_logs(spark, {"time_unix_nano": 9, "body": "c", "attributes": {"k": "z"}}), root, schema.LOGS)
    assert tuples(tables.scan(spark, root, schema.LOGS), "body", "attr_k") == [("a", "x"), ("b", "y"), ("c", "z")]
    tables.append(days(spark), f"{fresh}/plain", schema.LOGS)
    with pytest.raises(ValueError, match="outside batches"):
        tables.append(days(spark), f"{fresh}/plain", schema.LOGS, batch="1")
    with pytest.raises(ValueError, match="consists of batches"):
        tables.append(days(spark), root, schema.LOGS, mode="overwrite")


def test_a_batch_takes_a_bounded_share_of_what_waits(spark, fresh, monkeypatch):
    os.makedirs(f"{fresh}/logs")
    for i in range(5):
        put(f"{fresh}/logs/{i}.json", log_envelope({"timeUnixNano": str(i + 1), "attributes": [kv("k", stringValue=str(i))]}, {"body": {}}))

    def taken(root, **options):
        for q in ingest.start_all(spark, {"logs": f"{fresh}/logs"}, root, f"{root}-cp", {"availableNow": True}, {schema.LOGS: ["k"]}, **options):
            q.awaitTermination()
        return len([d for d in os.listdir(f"{root}/logs") if d.startswith("batch=")])

    def state(root):
        rows = tuples(tables.scan(spark, root, schema.LOGS), "time_unix_nano", "attr_k")
        return rows, tuples(ingest.receipts(spark, root)), ingest.rejects(spark, root).count()

    # However much waits, a batch, which is held on disk, is bounded; small folders still make one batch.
    assert taken(f"{fresh}/small") == 1
    monkeypatch.setattr(ingest, "BATCH_BYTES", 1, raising=False)
    assert taken(f"{fresh}/large") == 5
    assert taken(f"{fresh}/own", maxFilesPerTrigger=3) == 2
    assert state(f"{fresh}/small") == state(f"{fresh}/large") == state(f"{fresh}/own")
    assert state(f"{fresh}/large")[0] == [(i + 1, str(i)) for i in range(5)] and state(f"{fresh}/large")[2] == 5


def otlp_batch(spark, path):
    from emberscope.sources import otlp

    return otlp.read_envelopes(spark, "logs", path)


def test_rows_give_each_pair_once_and_no_keys_beside_them(spark):
    from emberscope.operators import stats

    rows = make_logs(spark, *[{"time_unix_nano": 1, "attributes": {"a": "1", "b": None}, "resource": {"a": "2", "b": "3", "service.name": "x"}}] * 50)
    df = catalog.entries(rows, "logs")
    got = sorted(((r.kind, r.name, r.value) for r in df.collect()), key=repr)
    assert got == [("key", "a", None), ("key", "b", None), ("key", "service.name", None), ("value", "a", "1"), ("value", "b", "3"), ("value", "service", "checkout")]
    made = [n.metrics().apply("numOutputRows").value() for n in stats._nodes(df._jdf.queryExecution().executedPlan()) if n.nodeName() == "Generate"]
    assert max(made) <= 50 * 5  # two pairs, two of the resource that are not hidden, the service
