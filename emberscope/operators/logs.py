"""Log queries: rows, pages, counts, volume and scan statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import cached_property
from time import monotonic_ns

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F

from emberscope.functions.attrs import attr, canonical_json, label_set
from emberscope.functions.timegrid import bucket, day_of, floor_div
from emberscope.plans.predicates import all_of, in_range, label_conditions, log_predicate
from emberscope.plans.specs import LINE_LIMIT, LogQuery, TimeRange

# Rows are put in order by all these, so rows that tie are alike and limits are repeatable.
ORDER = (
    "time_unix_nano",
    "service",
    "severity_number",
    "body",
    "trace_id",
    "span_id",
    "attributes",
    "resource",
    "observed_time_unix_nano",
    "severity_text",
    "event_name",
    "flags",
    "scope_name",
    "scope_version",
)
_MAPS = ("attributes", "resource")


def _key(name: str, column: Column | None = None) -> Column:
    """A column as it is put in order: maps by their canonical text."""
    column = F.col(name) if column is None else column
    return canonical_json(column) if name in _MAPS else column


def _ordering(direction: str, columns: Sequence[str] = ORDER) -> list[Column]:
    newest_first = direction == "backward"
    keys = [_key(c) for c in ORDER if c in columns]
    return [k.desc() if newest_first else k.asc() for k in keys]


def matching(logs: DataFrame, q: LogQuery) -> DataFrame:
    """All rows the query's filters accept, unordered and without a limit."""
    return logs.where(log_predicate(q, logs.columns))


def query(logs: DataFrame, q: LogQuery) -> DataFrame:
    """Matching rows, newest first unless the query says forward; a top-k, not a sort."""
    return _top(matching(logs, q), q, q.offset)


def _top(hits: DataFrame, q: LogQuery, offset: int = 0) -> DataFrame:
    """First rows of ``hits`` in the query's direction.

    The time of the last row wanted is found first, from the time column and the
    columns the filters need. Whole rows are then read only on this side of it,
    which prunes days and row groups. Behind a deep offset both ends of the page are found from
    counts, and only the rows between them are put in order. The end of a large page is found likewise; only
    the rows around it are limited, so that no task holds the page.
    """
    time, newest_first = F.col(ORDER[0]), q.direction == "backward"
    if offset > DEEP:
        within, offset = _located(hits, newest_first, offset, offset + q.row_limit) or (TimeRange(0, 0), 0)
        near = in_range(ORDER[0], within, hits.columns)
    elif not offset and q.row_limit > DEEP:
        end = _located(hits, newest_first, q.row_limit - 1, q.row_limit)
        rows = hits.where(time.isNotNull())
        if end is not None:
            around, before = end
            inner = TimeRange(around.end, None) if newest_first else TimeRange(None, around.start)
            last = hits.where(all_of(in_range(ORDER[0], around, hits.columns)))
            last = last.orderBy(*_ordering(q.direction, hits.columns)).limit(before + 1)
            rows = hits.where(all_of(in_range(ORDER[0], inner, hits.columns))).unionByName(last)
        return rows.orderBy(*_ordering(q.direction, hits.columns))
    else:
        edge = (
            hits.select(time)
            .orderBy(time.desc() if newest_first else time.asc())
            .limit(offset + q.row_limit)
            .agg((F.min if newest_first else F.max)(time))
            .scalar()
        )
        near = [time >= edge if newest_first else time <= edge]
        if "day" in hits.columns:
            near.append(F.col("day") >= day_of(edge) if newest_first else F.col("day") <= day_of(edge))
    rows = hits.where(all_of(near)).orderBy(*_ordering(q.direction, hits.columns))
    return (rows.offset(offset) if offset else rows).limit(q.row_limit)


#: Rows that a task may put in order to skip an offset or to end a page.
DEEP = 10_000
_SLICES = 1024


def _located(hits: DataFrame, newest_first: bool, first: int, last: int) -> tuple[TimeRange, int] | None:
    """The times between which the rows of the ranks ``[first, last)`` lie, and how many ranks to skip there; none behind all rows.

    Counts per slice of time, 1,024 at most, tell in which slices the ranks lie; these are cut again until
    few rows lie before the ranks, or a slice is one nanosecond. No row leaves its task.
    """
    time = F.col(ORDER[0])
    low, high = hits.agg(F.min(time), F.max(time)).first()
    if low is None:
        return None
    while True:
        width = -(-(high - low + 1) // _SLICES)
        inside = hits.where(all_of(in_range(ORDER[0], TimeRange(low, high + 1), hits.columns)))
        from_edge = F.lit(high) - time if newest_first else time - F.lit(low)
        counts = inside.groupBy(floor_div(from_edge, width).alias("slice")).count().orderBy("slice").collect()
        seen, begin, end, before = 0, None, None, 0
        for r in counts:
            if begin is None and seen + r["count"] > first:
                begin, before = r["slice"], seen
            seen += r["count"]
            if begin is not None:
                end = r["slice"]
                if seen >= last:
                    break
        if begin is None:  # the ranks lie behind all rows
            return None
        was = low, high
        low, high = (high - (end + 1) * width + 1, high - begin * width) if newest_first else (low + begin * width, low + (end + 1) * width - 1)
        first, last = first - before, last - before
        if seen - before <= DEEP + last - first or width == 1 or (low, high) == was:
            return TimeRange(low, high + 1), first


def count(logs: DataFrame, q: LogQuery) -> DataFrame:
    """Number of matching rows; limit, offset and direction do not matter."""
    return matching(logs, q).agg(F.count(F.lit(1)).alias("count"))


def volume(logs: DataFrame, q: LogQuery, step_ns: int, group_by: Sequence[str] = ()) -> DataFrame:
    """Rows per time bucket and label set: ``bucket_time, labels, count``."""
    names = {key: f"_g{i}" for i, key in enumerate(group_by)}
    groups = [attr(key, logs.columns).alias(name) for key, name in names.items()]
    counted = (
        matching(logs, q)
        .groupBy(bucket(F.col("time_unix_nano"), step_ns).alias("bucket_time"), *groups)
        .agg(F.count(F.lit(1)).alias("count"))
    )
    labels = label_set({key: F.col(name) for key, name in names.items()})
    return counted.select("bucket_time", labels.alias("labels"), "count")


@dataclass(frozen=True)
class Page:
    """One page of rows. The cursor is known once ``rows`` has been executed."""

    rows: DataFrame
    after: int
    limit: int
    _seen: Observation

    @property
    def returned(self) -> int:
        return self._seen.get["returned"]

    @property
    def next_offset(self) -> int:
        return self.after + self.returned

    @property
    def has_more(self) -> bool:
        """True only for a full page of a query that sets its limit."""
        return self.limit > 0 and self.returned >= self.limit


def page(logs: DataFrame, q: LogQuery, after: int = 0) -> Page:
    """The page starting at row ``after``, which replaces the query's own offset.

    Cost grows with ``after``; for deep paging see :func:`page_after`.
    """
    seen = Observation()
    rows = query(logs, replace(q, offset=after))
    return Page(rows.observe(seen, F.count(F.lit(1)).alias("returned")), after, q.limit, seen)


@dataclass(frozen=True)
class Cursor:
    """Where a page ended: the ``ORDER`` values of its last row, and how many rows alike have been shown."""

    values: tuple
    shown: int


def next_cursor(rows: Sequence[Row], before: Cursor | None = None) -> Cursor | None:
    """The cursor after a collected page that followed ``before``; an empty page keeps it."""
    if not rows:
        return before
    keys = [tuple(row[c] if c in row else None for c in ORDER) for row in rows]
    alike = next((i for i, k in enumerate(reversed(keys)) if k != keys[-1]), len(keys))
    if alike == len(keys) and before is not None and before.values == keys[-1]:
        alike += before.shown
    return Cursor(keys[-1], alike)


def cursor_behind(page: DataFrame, q: LogQuery, before: Cursor | None = None) -> Cursor | None:
    """What :func:`next_cursor` says, found by Spark: one row comes to the driver, so a page may be of any size."""
    backwards = [k.asc() if q.direction == "backward" else k.desc() for k in (_key(c) for c in ORDER if c in page.columns)]
    last = page.orderBy(*backwards).first()
    if last is None:
        return before
    values = tuple(last[c] if c in last else None for c in ORDER)
    types = dict(page.dtypes)
    same = [_key(c).eqNullSafe(_key(c, _literal(v, types[c]))) for c, v in zip(ORDER, values, strict=True) if c in types]
    shown = page.where(all_of(same)).count()
    # A page that ends where the one before it ended holds nothing but rows alike.
    return Cursor(values, shown + before.shown if before is not None and before.values == values else shown)


def page_after(logs: DataFrame, q: LogQuery, last: Cursor | Sequence | None = None) -> DataFrame:
    """The page following a cursor; cost does not grow with the number of pages.

    No row is lost or shown twice when rows are alike: the cursor counts them. A plain
    sequence of leading ``ORDER`` values means the first row beyond all that have them.
    """
    rows = matching(logs, q)
    if last is None:
        return _top(rows, q)
    values = last.values if isinstance(last, Cursor) else tuple(last)
    types = dict(logs.dtypes)
    names = [c for c in ORDER[: len(values)] if c in types]
    given = {c: _literal(values[ORDER.index(c)], types[c]) for c in names}
    here = F.struct(*[_key(c).alias(c) for c in names])
    there = F.struct(*[_key(c, given[c]).alias(c) for c in names])
    newest_first = q.direction == "backward"
    # The plain comparison on time, and on the day, is what the scan can use.
    edge = F.col(ORDER[0])
    side = TimeRange(None, values[0] + 1) if newest_first else TimeRange(values[0], None)
    rows = rows.where(all_of(in_range(ORDER[0], side, logs.columns)))
    beyond = rows.where(here < there if newest_first else here > there)
    if isinstance(last, Cursor):
        alike = rows.where((edge == values[0]) & here.eqNullSafe(there))
        beyond = alike.offset(last.shown).limit(q.row_limit).unionByName(beyond)
    return _top(beyond, q)


def _literal(value, kind: str) -> Column:
    if isinstance(value, Mapping):
        pairs = [F.lit(x) for pair in value.items() for x in pair]
        return F.create_map(*pairs).cast(kind)
    return F.lit(value).cast(kind)


@dataclass
class QueryStats:
    """What a query read and gave back. Known once its rows have been executed."""

    _scanned: Observation
    _returned: Observation
    _started: int

    @property
    def rows_scanned(self) -> int:
        return self._scanned.get["rows"]

    @property
    def rows_returned(self) -> int:
        return self._returned.get["rows"]

    @cached_property
    def elapsed_ns(self) -> int:
        """From the query's start to the first look at this figure after its end; it then stays."""
        self._returned.get
        return monotonic_ns() - self._started


def query_with_stats(logs: DataFrame, q: LogQuery) -> tuple[DataFrame, QueryStats]:
    """The query's rows and its counts; "scanned" are the rows within its time range.

    The range is applied below the counter, since filters do not move past it
    and the scan would otherwise read every day.
    """
    logs = logs.where(all_of(in_range(ORDER[0], q.range, logs.columns)))
    scanned, returned = Observation(), Observation()
    counted = F.count(F.lit(1)).alias("rows")
    rows = matching(logs.observe(scanned, counted), q).orderBy(*_ordering(q.direction, logs.columns))
    rows = (rows.offset(q.offset) if q.offset else rows).limit(q.row_limit).observe(returned, counted)
    return rows, QueryStats(scanned, returned, monotonic_ns())


def lines(
    logs: DataFrame,
    start: int,
    end: int,
    *,
    service: Sequence[tuple[str, str]] = (),
    contains: Sequence[str] = (),
    excludes: Sequence[str] = (),
    regex: Sequence[str] = (),
    limit: int = 0,
) -> DataFrame:
    """Log lines of a stream selector with line filters, newest first.

    ``service`` lists ``(operator, value)`` tests of the only stream label; the
    line filters are case-sensitive substring or search-pattern tests on the body.
    """
    selected = _selected(logs, service, contains, excludes, regex)
    wanted = limit if limit > 0 else LINE_LIMIT
    return query(selected, LogQuery(range=TimeRange(start, end), limit=wanted))


def _selected(logs, service, contains=(), excludes=(), regex=()) -> DataFrame:
    tests = label_conditions([("service", op, v) for op, v in service])
    body = F.col("body")
    tests += [F.contains(body, F.lit(s)) for s in contains]
    tests += [~F.contains(body, F.lit(s)) for s in excludes]
    tests += [body.rlike(p) for p in regex]
    return logs.where(all_of(tests))


def selected(logs: DataFrame, *, service=(), contains=(), excludes=(), regex=()) -> DataFrame:
    """The stream selector and line filters alone, for range aggregations."""
    return _selected(logs, service, contains, excludes, regex)
