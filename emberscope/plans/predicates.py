"""Query descriptions compiled to one boolean Column each; conditions are AND-ed."""

from __future__ import annotations

from collections.abc import Collection, Iterable
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from emberscope.functions.attrs import attr, label
from emberscope.functions.text import matches
from emberscope.functions.timegrid import DAY
from emberscope.plans.specs import (
    AttrFilters,
    LogQuery,
    PointsQuery,
    SpanFilters,
    SpanMetricsQuery,
    TimeRange,
)

_EPOCH = date(1970, 1, 1)
_COMPARE = {
    ">": Column.__gt__,
    ">=": Column.__ge__,
    "<": Column.__lt__,
    "<=": Column.__le__,
}


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def in_range(time: str, within: TimeRange, columns: Collection[str] = ()) -> list[Column]:
    """Half-open time test, repeated on the ``day`` partition column so files prune."""
    tests: list[Column] = []
    partitioned = "day" in columns
    if within.start is not None:
        if partitioned:
            tests.append(F.col("day") >= F.lit(_day(within.start)))
        tests.append(F.col(time) >= F.lit(within.start))
    if within.end is not None:
        if partitioned:
            tests.append(F.col("day") <= F.lit(_day(within.end - 1)))
        tests.append(F.col(time) < F.lit(within.end))
    return tests


def _day(ns: int) -> date:
    return _EPOCH + timedelta(days=ns // DAY)


def attr_conditions(q: AttrFilters, columns: Collection[str] = ()) -> list[Column]:
    def value(key: str) -> Column:
        return attr(key, columns)

    out = [value(k) == v for k, v in q.attr_eq]
    out += [value(k).isNotNull() for k in q.attr_exists]
    out += [matches(value(k), text) for k, text in q.attr_matches]
    out += [value(k).rlike(pattern) for k, pattern in q.attr_regex]
    out += [value(k).isin(list(vs)) for k, vs in q.attr_in]
    out += [value(k).isNull() | ~value(k).isin(list(vs)) for k, vs in q.attr_not_in]
    out += [_COMPARE[op](value(k).try_cast("double"), F.lit(float(v))) for k, op, v in q.attr_num]
    return out


def label_conditions(
    filters: Iterable[tuple[str, str, str]], columns: Collection[str] = ()
) -> list[Column]:
    """PromQL-style selectors; patterns are anchored at both ends."""
    out = []
    for key, op, wanted in filters:
        value = label(key, columns)
        if op == "=":
            out.append(value == wanted)
        elif op == "!=":
            out.append(value != wanted)
        else:
            whole = value.rlike(rf"\A(?:{wanted})\z")
            out.append(whole if op == "=~" else ~whole)
    return out


def log_predicate(q: LogQuery, columns: Collection[str] = ()) -> Column:
    out = in_range("time_unix_nano", q.range, columns)
    if q.service is not None:
        out.append(F.col("service") == q.service)
    if q.min_severity is not None:
        out.append(F.col("severity_number") >= q.min_severity)
    if q.text is not None:
        out.append(matches(F.col("body"), q.text))
    return all_of(out + attr_conditions(q, columns))


def span_predicate(q: SpanFilters, columns: Collection[str] = ()) -> Column:
    """Conditions on one span: name, text, status, kind and attributes together."""
    out = []
    if q.name is not None:
        out.append(F.col("name") == q.name)
    if q.status is not None:
        out.append(F.col("status") == q.status)
    if q.kind is not None:
        out.append(F.col("kind") == q.kind)
    if q.text is not None:
        out.append(matches(F.col("name"), q.text))
    return all_of(out + attr_conditions(q, columns))


def span_metrics_predicate(q: SpanMetricsQuery, columns: Collection[str] = ()) -> Column:
    out = in_range("start_time_unix_nano", q.range, columns)
    if q.service is not None:
        out.append(F.col("service") == q.service)
    return all_of([*out, span_predicate(q, columns)])


def points_predicate(q: PointsQuery, columns: Collection[str] = ()) -> Column:
    out = in_range("time_unix_nano", q.range, columns)
    if q.metric is not None:
        out.append(F.col("metric") == q.metric)
    return all_of(out + [attr(k, columns) == v for k, v in q.attr_eq])


def series_predicate(q, columns: Collection[str] = ()) -> Column:
    """Metric name, time range and label selectors of a metric or histogram query."""
    out = [F.col("metric") == q.metric, *in_range("time_unix_nano", q.range, columns)]
    return all_of(out + label_conditions(q.filters, columns))
