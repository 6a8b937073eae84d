from __future__ import annotations

import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from emberscope import schema
from emberscope.operators import logs as L
from emberscope.operators import stats
from emberscope.plans.predicates import in_range
from emberscope.plans.specs import INT64_MAX, INT64_MIN, LogQuery, TimeRange
from emberscope.sources import tables
from tests.helpers import S, logs, tuples


@pytest.fixture(scope="module")
def three(spark):
    return logs(
        spark,
        {"time_unix_nano": 1000, "body": "a"},
        {"time_unix_nano": 1000, "body": "b"},
        {"time_unix_nano": 1000, "body": "c"},
    )


def bodies(df):
    return [r.body for r in df.collect()]


def test_pages_of_two_then_one(three):
    q = LogQuery(limit=2)
    first = L.page(three, q)
    assert bodies(first.rows) == ["c", "b"]
    assert (first.next_offset, first.has_more) == (2, True)
    second = L.page(three, q, after=first.next_offset)
    assert bodies(second.rows) == ["a"]
    assert (second.next_offset, second.has_more) == (3, False)


def test_page_cursor_replaces_offset_and_default_limit_never_has_more(three):
    page = L.page(three, LogQuery(offset=2))
    assert len(bodies(page.rows)) == 3
    assert not page.has_more


def test_keyset_pages_cover_everything_once(three):
    q, seen, last = LogQuery(limit=1), [], None
    while rows := L.page_after(three, q, last).collect():
        seen.append(rows[0].body)
        last = L.next_cursor(rows, last)
    assert seen == ["c", "b", "a"]
    forward = LogQuery(limit=2, direction="forward")
    assert bodies(L.page_after(three, forward, (1000, "checkout", 9, "a"))) == ["b", "c"]


@pytest.mark.parametrize("direction", ["backward", "forward"])
def test_keyset_pages_lose_no_row_that_ties(spark, direction):
    alike = [{"time_unix_nano": 5, "body": "x", "attributes": {"k": "v", 'q"': "é"}}] * 5
    near = [{"time_unix_nano": 5, "body": "x", "trace_id": t} for t in ("a", None, "b")]
    frame = logs(spark, *alike, *near, {"time_unix_nano": 9, "body": None}, {"time_unix_nano": 1, "body": "z"})
    q, seen, last = LogQuery(limit=2, direction=direction), [], None
    while rows := L.page_after(frame, q, last).collect():
        seen += rows
        last = L.next_cursor(rows, last)
    whole = L.query(frame, LogQuery(limit=100, direction=direction)).collect()
    assert len(seen) == 10 and seen == whole


def test_count_ignores_limit_offset_direction(three):
    q = LogQuery(limit=1, offset=2, direction="forward")
    assert L.count(three, q).first()["count"] == 3


def test_query_stats(three):
    rows, stats = L.query_with_stats(three, LogQuery(text="a", limit=5))
    assert bodies(rows) == ["a"]
    assert (stats.rows_scanned, stats.rows_returned) == (3, 1)
    assert stats.elapsed_ns > 0


def test_volume_total_has_empty_label_set_and_step_floor(three):
    assert tuples(L.volume(three, LogQuery(), 0)) == [(1000, "{}", 3)]
    assert tuples(L.volume(three, LogQuery(), 7)) == [(994, "{}", 3)]


def test_volume_bucket_before_epoch_floors(spark):
    rows = logs(spark, {"time_unix_nano": -1, "body": "x"})
    assert tuples(L.volume(rows, LogQuery(), 10)) == [(-10, "{}", 1)]


def test_missing_group_key_is_left_out_of_the_label_set(spark):
    rows = logs(
        spark,
        {"time_unix_nano": 5, "attributes": {"zone": "z"}},
        {"time_unix_nano": 6, "attributes": {}},
    )
    got = tuples(L.volume(rows, LogQuery(), 10, ["zone"]), "labels", "count")
    assert got == [('{"zone":"z"}', 1), ("{}", 1)]


def test_attribute_conditions(spark):
    rows = logs(
        spark,
        {"time_unix_nano": 1, "body": "num", "attributes": {"k": "5"}},
        {"time_unix_nano": 2, "body": "text", "attributes": {"k": "five"}},
        {"time_unix_nano": 3, "body": "none"},
        {"time_unix_nano": 4, "body": "resource", "resource": {"k": "7"}},
        {"time_unix_nano": 5, "body": "both", "attributes": {"k": "1"}, "resource": {"k": "7"}},
    )

    def hits(**conditions):
        return sorted(r.body for r in L.matching(rows, LogQuery(**conditions)).collect())

    assert hits(attr_num=[("k", ">=", 5)]) == ["num", "resource"]
    assert hits(attr_num=[("k", "<", 5)]) == ["both"]
    assert hits(attr_not_in=[("k", ["5", "7"])]) == ["both", "none", "text"]
    assert hits(attr_in=[("k", ["1", "5"])]) == ["both", "num"]
    assert hits(attr_exists=["k"]) == ["both", "num", "resource", "text"]
    assert hits(attr_eq=[("k", "7")]) == ["resource"]
    assert hits(attr_regex=[("k", "iv")]) == ["text"]
    assert hits(attr_eq=[("service.name", "checkout")], text="num") == ["num"]


def test_text_needs_all_whole_tokens_in_any_order(spark):
    rows = logs(
        spark,
        {"time_unix_nano": 1, "body": "Payment ERROR: gateway-timeout"},
        {"time_unix_nano": 2, "body": "errors in payment"},
        {"time_unix_nano": 3, "body": "Überweisung fehlgeschlagen; error_payment"},
        {"time_unix_nano": 4, "body": None},
    )

    def hits(text):
        return sorted(r.time_unix_nano for r in L.matching(rows, LogQuery(text=text)).collect())

    assert hits("error payment") == [1, 3]
    assert hits("GATEWAY, timeout") == [1]
    assert hits("überweisung") == [3]
    assert hits("!?") == []


def test_range_is_half_open_and_prunes_days(spark):
    rows = logs(spark, *[{"time_unix_nano": t, "body": str(t)} for t in (9, 10, 19, 20)])
    got = L.matching(rows, LogQuery(range=TimeRange(10, 20)))
    assert sorted(bodies(got)) == ["10", "19"]
    assert len(in_range("time_unix_nano", TimeRange(10, 20), rows.columns)) == 4
    assert in_range("time_unix_nano", TimeRange(INT64_MIN, INT64_MAX), rows.columns) == []


def test_lines_selector_and_filters(spark):
    rows = logs(
        spark,
        {"time_unix_nano": 1, "service": "cart", "body": "an error"},
        {"time_unix_nano": 2, "service": "carts", "body": "an error"},
        {"time_unix_nano": 3, "service": None, "body": "an error"},
        {"time_unix_nano": 4, "service": "cart", "body": "fine"},
    )

    def times(**kw):
        return [r.time_unix_nano for r in L.lines(rows, 0, 100, **kw).collect()]

    assert times(service=[("=~", "car.")]) == [4, 1]
    assert times(service=[("=", "")]) == [3]
    assert times(service=[("!~", "cart.*")], contains=["error"]) == [3]
    assert times(service=[("!=", "")], regex=["^an"], limit=1) == [2]
    with pytest.raises(ValueError):
        L.lines(rows, 10, 5)


@pytest.mark.parametrize(
    "bad",
    [
        {"min_severity": 0},
        {"min_severity": 25},
        {"direction": "sideways"},
        {"limit": -1},
        {"attr_num": [("k", "==", 1)]},
        {"range": "no"},
    ],
)
def test_bad_queries_are_refused(bad):
    with pytest.raises((ValueError, AttributeError)):
        q = LogQuery(**bad)
        q.range.start


def test_sql_projection_aggregate_empty_and_unknown_table(spark, three):
    views = {schema.LOGS: three, schema.SPANS: tables.scan(spark, "/tmp/run-none", schema.SPANS)}
    got = tables.sql(spark, views, "SELECT CAST(count(*) AS BIGINT) n, service FROM logs GROUP BY service")
    assert tuples(got) == [(3, "checkout")]
    empty = tables.sql(spark, views, "SELECT service, name FROM spans")
    assert empty.columns == ["service", "name"] and empty.count() == 0
    assert tables.sql(spark, views, "SELECT 1 AS one").first().one == 1
    with pytest.raises(AnalysisException):
        tables.sql(spark, views, "SELECT * FROM no_such_table")
    with pytest.raises(ValueError):
        tables.scan(spark, "/tmp/run-none", "no_such_table")


@pytest.mark.parametrize("direction", ["backward", "forward"])
def test_deep_offsets_are_located(spark, monkeypatch, direction):
    draw = random.Random(3)
    times = [draw.choice([5, 10**6, 10**6 + 1, draw.randint(0, 10**15), 86_400 * S * 3]) for _ in range(1500)]
    rows = logs(spark, *[{"time_unix_nano": t, "body": f"{i:04d}"} for i, t in enumerate(times)])
    want = sorted(((t, f"{i:04d}") for i, t in enumerate(times)), reverse=direction == "backward")
    monkeypatch.setattr(L, "DEEP", 20)
    for offset, limit in ((21, 5), (300, 40), (700, 10), (1100, 300), (1490, 50), (1500, 5), (4000, 5), (30, 1470)):
        got = L.query(rows, LogQuery(offset=offset, limit=limit, direction=direction)).collect()
        assert [(r.time_unix_nano, r.body) for r in got] == want[offset : offset + limit]
    assert L.query(rows.where("false"), LogQuery(offset=50)).count() == 0


def test_a_located_page_orders_few_rows(spark, monkeypatch):
    monkeypatch.setattr(L, "DEEP", 100)
    rows = logs(spark, *[{"time_unix_nano": i * 1000, "body": str(i)} for i in range(5000)])
    within, skip = L._located(rows, True, 2500, 2510)
    held = rows.where((F.col("time_unix_nano") >= within.start) & (F.col("time_unix_nano") < within.end)).count()
    assert 10 <= held <= 110 and 0 <= skip < held


def test_run_stats_count_what_was_read(spark, fresh):

    tables.append(logs(spark, *[{"time_unix_nano": d * 86_400 * S + i, "body": "b"} for d in range(4) for i in range(25)]), fresh, schema.LOGS)
    stored = tables.scan(spark, fresh, schema.LOGS)
    rows, run = stats.collect(stored.where("day = DATE '1970-01-02'").groupBy("service").count())
    assert (run.rows_scanned, run.rows_returned, len(rows)) == (25, 1, 1) and run.files >= 1 and run.bytes > 0
    once = run.elapsed_ns
    assert run.elapsed_ns == once > 0
    both = stored.join(stored.select("time_unix_nano"), "time_unix_nano")
    assert stats.collect(both)[1].rows_scanned in (100, 200)
    assert stats.collect(spark.range(5))[1].rows_returned == 5


@pytest.mark.parametrize("direction", ["backward", "forward"])
def test_large_pages_are_walked_without_a_limit_over_the_page(spark, monkeypatch, direction):
    monkeypatch.setattr(L, "DEEP", 5)
    frame = logs(spark, *[{"time_unix_nano": S + (i * 7) % 40, "body": "same" if i % 3 else f"b{i % 5}"} for i in range(170)]).repartition(4)
    q, cursor, got = LogQuery(limit=25, direction=direction), None, []
    while True:
        page = L.page_after(frame, q, cursor)
        rows = page.collect()
        behind = L.cursor_behind(page, q, cursor)
        assert behind == L.next_cursor(rows, cursor)
        if not rows:
            break
        assert len(rows) == min(25, 170 - len(got))
        assert "TakeOrderedAndProject(limit=25" not in page._jdf.queryExecution().toString()
        got, cursor = got + [(r.time_unix_nano, r.body) for r in rows], behind
    assert got == sorted(got, reverse=direction == "backward") and len(got) == 170
    assert sorted(got) == sorted((r.time_unix_nano, r.body) for r in frame.collect())
