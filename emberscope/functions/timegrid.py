"""Nanosecond time arithmetic: buckets, step grids and conversions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND = 1_000_000_000
MINUTE = 60 * SECOND
HOUR = 60 * MINUTE
DAY = 24 * HOUR

def bucket(time: Column, step_ns: int) -> Column:
    """Start of the epoch-aligned bucket holding ``time`` (floor, also before 1970)."""
    return time - F.pmod(time, F.lit(max(int(step_ns), 1)))


def floor_div(a: Column, b: int) -> Column:
    """Integer division rounding down, exact on BIGINT."""
    return F.call_function("div", a - F.pmod(a, F.lit(b)), F.lit(b))


def day_of(time: Column) -> Column:
    """UTC calendar day of a nanosecond time."""
    return F.date_from_unix_date(floor_div(time, DAY).cast("int"))


def timestamp_of(time: Column) -> Column:
    """TIMESTAMP (microseconds) for windows and watermarks."""
    return F.timestamp_micros(floor_div(time, 1000))


@dataclass(frozen=True)
class Grid:
    """Evaluation times ``start, start+step, ...`` up to and including ``end``.

    ``most`` steps at most are accepted, if it is given.
    """

    start: int
    end: int
    step: int
    most: int | None = None

    def __post_init__(self) -> None:
        if self.end < self.start:
            raise ValueError(f"grid ends at {self.end}, before its start {self.start}")
        object.__setattr__(self, "step", max(int(self.step), 1))
        if self.most is not None and self.count > self.most:
            raise ValueError(f"{self.count} steps exceed the limit of {self.most}")

    @property
    def count(self) -> int:
        return (self.end - self.start) // self.step + 1

    @property
    def last(self) -> int:
        """Index of the last step."""
        return self.count - 1

    def index_at_or_after(self, time: Column) -> Column:
        """Index of the first step whose time is not before ``time``; may lie off the grid."""
        return floor_div(time - F.lit(self.start) + F.lit(self.step - 1), self.step)

    def index_before(self, time: Column) -> Column:
        """Index of the last step strictly before ``time``; may lie off the grid."""
        return self.index_at_or_after(time) - 1

    def time_at(self, index: Column) -> Column:
        return F.lit(self.start) + index * F.lit(self.step)

    def clip_low(self, index: Column) -> Column:
        return F.greatest(index, F.lit(0).cast("bigint"))

    def clip_high(self, index: Column) -> Column:
        return F.least(index, F.lit(self.last).cast("bigint"))
