"""Typed query descriptions. Bad values are refused when a query is made."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from emberscope import schema
from emberscope.functions.timegrid import MINUTE

# Row limits used when a query leaves its limit at 0.
LOG_LIMIT = 100
TRACE_LIMIT = 20
POINT_LIMIT = 100
LINE_LIMIT = 1000

# Bounds that stand for "unbounded" on their side.
INT64_MIN = -(2**63)
INT64_MAX = 2**63 - 1

NUM_OPS = (">", ">=", "<", "<=")
LABEL_OPS = ("=", "!=", "=~", "!~")
AGGREGATIONS = ("sum", "avg", "min", "max", "count")
RATE_MODES = ("off", "delta", "counter")
SPAN_STATUSES = ("UNSET", "OK", "ERROR")
SPAN_KINDS = ("UNSPECIFIED", "INTERNAL", "SERVER", "CLIENT", "PRODUCER", "CONSUMER")
POINT_KINDS = {"gauge": schema.GAUGE, "sum": schema.SUM, "histogram": schema.HISTOGRAM}

Pair = tuple[str, str]
Many = tuple[str, Sequence[str]]
NumTest = tuple[str, str, float]


def _member(value: str, allowed: Sequence[str], what: str) -> None:
    if value not in allowed:
        raise ValueError(f"{what} {value!r} is not one of {', '.join(allowed)}")


def _not_negative(value: int, what: str) -> None:
    if value < 0:
        raise ValueError(f"{what} must not be negative, got {value}")


@dataclass(frozen=True)
class TimeRange:
    """Half-open ``[start, end)`` in unix nanoseconds; None or an int64 bound is open."""

    start: int | None = None
    end: int | None = None

    def __post_init__(self) -> None:
        if self.start == INT64_MIN:
            object.__setattr__(self, "start", None)
        if self.end == INT64_MAX:
            object.__setattr__(self, "end", None)
        if self.start is not None and self.end is not None and self.end < self.start:
            raise ValueError(f"time range ends at {self.end}, before its start {self.start}")


UNBOUNDED = TimeRange()


@dataclass(frozen=True, kw_only=True)
class AttrFilters:
    """Conditions on attributes; all must hold."""

    attr_eq: Sequence[Pair] = ()
    attr_exists: Sequence[str] = ()
    attr_matches: Sequence[Pair] = ()
    attr_regex: Sequence[Pair] = ()
    attr_in: Sequence[Many] = ()
    attr_not_in: Sequence[Many] = ()
    attr_num: Sequence[NumTest] = ()

    def __post_init__(self) -> None:
        for _, op, _ in self.attr_num:
            _member(op, NUM_OPS, "numeric operator")


@dataclass(frozen=True, kw_only=True)
class LogQuery(AttrFilters):
    service: str | None = None
    min_severity: int | None = None
    text: str | None = None
    range: TimeRange = UNBOUNDED
    limit: int = 0
    direction: str = "backward"
    offset: int = 0

    def __post_init__(self) -> None:
        super().__post_init__()
        if self.min_severity is not None and not 1 <= self.min_severity <= 24:
            raise ValueError(f"severity must be in 1..24, got {self.min_severity}")
        _member(self.direction, ("backward", "forward"), "direction")
        _not_negative(self.limit, "limit")
        _not_negative(self.offset, "offset")

    @property
    def row_limit(self) -> int:
        return self.limit or LOG_LIMIT


@dataclass(frozen=True, kw_only=True)
class SpanFilters(AttrFilters):
    """Conditions that a single span has to satisfy together."""

    name: str | None = None
    text: str | None = None
    status: str | None = None
    kind: str | None = None

    def __post_init__(self) -> None:
        super().__post_init__()
        if self.status is not None:
            object.__setattr__(self, "status", self.status.upper())
            _member(self.status, SPAN_STATUSES, "span status")
        if self.kind is not None:
            object.__setattr__(self, "kind", self.kind.upper())
            _member(self.kind, SPAN_KINDS, "span kind")


@dataclass(frozen=True, kw_only=True)
class TraceQuery(SpanFilters):
    """Trace search. ``service`` and the durations are those of the root span."""

    service: str | None = None
    min_duration_ns: int | None = None
    max_duration_ns: int | None = None
    range: TimeRange = UNBOUNDED
    limit: int = 0

    def __post_init__(self) -> None:
        super().__post_init__()
        _not_negative(self.limit, "limit")

    @property
    def row_limit(self) -> int:
        return self.limit or TRACE_LIMIT


@dataclass(frozen=True, kw_only=True)
class SpanMetricsQuery(SpanFilters):
    service: str | None = None
    group_by: Sequence[str] = ()
    range: TimeRange = UNBOUNDED
    step_ns: int = MINUTE

    def __post_init__(self) -> None:
        super().__post_init__()
        object.__setattr__(self, "step_ns", max(self.step_ns, 1))


@dataclass(frozen=True, kw_only=True)
class LabelFilters:
    """Label selectors ``(key, operator, value)``; all must hold."""

    filters: Sequence[tuple[str, str, str]] = ()

    def __post_init__(self) -> None:
        for _, op, _ in self.filters:
            _member(op, LABEL_OPS, "label operator")


@dataclass(frozen=True, kw_only=True)
class MetricQuery(LabelFilters):
    metric: str
    table: str = schema.GAUGE
    aggregation: str | None = None
    group_by: Sequence[str] = ()
    range: TimeRange = UNBOUNDED
    step_ns: int = MINUTE
    rate: str = "off"

    def __post_init__(self) -> None:
        super().__post_init__()
        _member(self.table, (schema.GAUGE, schema.SUM), "metric table")
        _member(self.rate, RATE_MODES, "rate mode")
        if self.aggregation is None:
            default = "avg" if self.table == schema.GAUGE and self.rate == "off" else "sum"
            object.__setattr__(self, "aggregation", default)
        _member(self.aggregation, AGGREGATIONS, "aggregation")
        object.__setattr__(self, "step_ns", max(self.step_ns, 1))


@dataclass(frozen=True, kw_only=True)
class PointsQuery:
    kind: str
    metric: str | None = None
    attr_eq: Sequence[Pair] = ()
    range: TimeRange = UNBOUNDED
    limit: int = 0

    def __post_init__(self) -> None:
        _member(self.kind, tuple(POINT_KINDS), "point kind")
        _not_negative(self.limit, "limit")

    @property
    def row_limit(self) -> int:
        return self.limit or POINT_LIMIT


@dataclass(frozen=True, kw_only=True)
class HistogramQuery(LabelFilters):
    """Quantile of a histogram metric; without a step each point is taken by itself."""

    metric: str
    phi: float = 0.95
    group_by: Sequence[str] = field(default=())
    range: TimeRange = UNBOUNDED
    step_ns: int | None = None

    def __post_init__(self) -> None:
        super().__post_init__()
        if not 0.0 <= self.phi <= 1.0:
            raise ValueError(f"quantile must be in 0..1, got {self.phi}")
        if self.step_ns is not None:
            object.__setattr__(self, "step_ns", max(self.step_ns, 1))


class ExpHistogramQuery(HistogramQuery):
    """Quantile of an exponential-histogram metric; same parameters."""
