from __future__ import annotations

import re
from datetime import date

import pytest

from emberscope import schema
from emberscope.operators import traces, upkeep
from emberscope.plans.specs import TimeRange, TraceQuery
from emberscope.sources import tables, trace_index
from tests.helpers import S, spans, tuples

DAY = 86_400 * S
A, B, C, D = ("a" * 32, "b" * 32, "c" * 32, "d" * 32)


def row(trace, start, span):
    return {"trace_id": trace, "span_id": f"{span:016x}", "start_time_unix_nano": start, "end_time_unix_nano": start + S, "duration_ns": S}


#: A lies within a day, B begins a day before C does and ends after it, D comes late; some rows have no trace.
FIRST = [row(A, 10, 1), row(A, 20, 2), row(B, DAY + 5, 3), row(C, 2 * DAY + 5, 4), row(None, 3 * DAY, 9)]
LATER = [row(B, 3 * DAY + 7, 5), row(C, DAY - 1, 6), row(D, 2 * DAY + 1, 7)]
ENTRIES = [(A, 10, 20), (B, DAY + 5, 3 * DAY + 7), (C, DAY - 1, 2 * DAY + 5), (D, 2 * DAY + 1, 2 * DAY + 1)]
RANGES = [TimeRange(0, DAY), TimeRange(DAY, 2 * DAY), TimeRange(2 * DAY, 3 * DAY), TimeRange(2 * DAY, None), TimeRange(None, DAY), TimeRange(9 * DAY, 10 * DAY)]


@pytest.fixture()
def two_appends(spark, fresh):
    tables.append(spans(spark, *FIRST), fresh, schema.SPANS)
    tables.append(spans(spark, *LATER), fresh, schema.SPANS)
    return fresh


def compacted(spark, root):
    out = f"{root}/out"
    upkeep.compact(spark, root, schema.SPANS, out)
    return out


@pytest.mark.parametrize("merged", [False, True])
def test_searches_find_the_same_with_and_without_an_index(spark, two_appends, merged):
    root = compacted(spark, two_appends) if merged else two_appends
    index, rows = trace_index.read(spark, root), tables.scan(spark, root, schema.SPANS)
    assert (index.fresh is None) == merged
    assert tuples(index.merge()) == ENTRIES
    for within in RANGES:
        q = TraceQuery(range=within)
        assert tuples(traces.search(rows, q, index)) == tuples(traces.search(rows, q))
        begin, end = within.start or 0, within.end or 99 * DAY
        assert tuples(index.beginning_in(within)) == [e for e in ENTRIES if begin <= e[1] < end]
    for trace in (A, B, "f" * 32):
        assert tuples(traces.get_trace(rows, trace, index), "span_id") == tuples(traces.get_trace(rows, trace), "span_id")
    some = rows.where("span_id = '0000000000000003'")
    assert tuples(traces.whole_traces(rows, some, index), "span_id") == [("0000000000000003",), ("0000000000000005",)]


def test_only_days_of_the_traces_are_read(spark, two_appends):
    for root in (two_appends, compacted(spark, two_appends)):
        index, rows = trace_index.read(spark, root), tables.scan(spark, root, schema.SPANS)
        kept = trace_index.on_days(rows, index.beginning_in(TimeRange(2 * DAY, 3 * DAY)))
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PartitionFilters: \[[^]]*day#\d+ = 1970-01-03", plan)
        assert tuples(kept.select("day").distinct()) == [(date(1970, 1, 3),)]
        assert tuples(trace_index.on_days(rows, index.one(B)).select("day").distinct()) == [(date(1970, 1, d),) for d in (2, 3, 4)]


def test_index_of_merged_entries_asks_no_history(spark, two_appends):
    index = trace_index.read(spark, compacted(spark, two_appends))
    plan = index.beginning_in(TimeRange(2 * DAY, 3 * DAY))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_entries_written_again_change_nothing(spark, fresh):
    for batch in ("0", "1", "0"):
        tables.append(spans(spark, *(FIRST if batch == "0" else LATER)), fresh, schema.SPANS, batch=batch)
    assert tuples(trace_index.read(spark, fresh).merge()) == ENTRIES


def test_overwriting_and_retention(spark, two_appends):
    out = f"{two_appends}/kept"
    upkeep.retain(spark, two_appends, out, retention_days=3, today=date(1970, 1, 4))
    want = [e for e in ENTRIES[1:] if e[0] != C]
    assert tuples(trace_index.read(spark, out).merge()) == sorted([*want, (C, 2 * DAY + 5, 2 * DAY + 5)])
    tables.append(spans(spark, *LATER[2:]), out, schema.SPANS, mode="overwrite")
    assert tuples(trace_index.read(spark, out).merge()) == ENTRIES[3:]


def test_no_index_is_begun_for_rows_written_without_one(spark, fresh):
    assert trace_index.read(spark, fresh) is None
    tables.writer(spans(spark, *FIRST), schema.SPANS).parquet(tables.table_path(fresh, schema.SPANS))
    tables.append(spans(spark, *LATER), fresh, schema.SPANS)
    assert trace_index.read(spark, fresh) is None
    trace_index.rebuild(tables.scan(spark, fresh, schema.SPANS), fresh)
    assert tuples(trace_index.read(spark, fresh).merge()) == ENTRIES


def test_empty_table(spark, fresh):
    tables.append(spans(spark), fresh, schema.SPANS)
    index = trace_index.read(spark, fresh)
    assert index.merge().count() == 0
    assert traces.search(tables.scan(spark, fresh, schema.SPANS), TraceQuery(range=TimeRange(0, DAY)), index).count() == 0
