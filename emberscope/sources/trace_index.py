"""When each trace begins and ends, kept beside the spans, so that looking for traces reads the days they touch and no others.

An entry says when the first and the last span start that one append brought of a trace; it is filed under the day of
the first. Appends add fresh entries, rewrites of the table (compaction, snapshots, retention) merge them to one a trace. Entries
are joined by least and largest, so one written twice changes nothing. They are written before the rows:
after an append that was lost for good, :func:`rebuild` makes them anew.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberscope import schema
from emberscope.functions.timegrid import day_of
from emberscope.plans.predicates import all_of, in_range
from emberscope.plans.specs import TimeRange
from emberscope.sources import files

LAYOUT = "trace_id STRING, first BIGINT, last BIGINT, day DATE"
_FRESH, _MERGED = "fresh", "merged"


def path_of(root: str, part: str | None = None) -> str:
    base = f"{root.rstrip('/')}/_traces"
    return base if part is None else f"{base}/part={part}"


def _joined(entries: DataFrame) -> DataFrame:
    """One entry a trace."""
    return entries.groupBy("trace_id").agg(F.min("first").alias("first"), F.max("last").alias("last"))


def entries(spans: DataFrame) -> DataFrame:
    """``trace_id, first, last`` of the traces in some rows; spans without a trace or a start have no entry."""
    start = F.col(schema.TIME_COLUMN[schema.SPANS])
    known = spans.where(F.col("trace_id").isNotNull() & start.isNotNull())
    return _joined(known.select("trace_id", start.alias("first"), start.alias("last")))


def _write(found: DataFrame, root: str, part: str, mode: str) -> None:
    """Days are brought together, large ones split; ids are sorted and have bloom filters for look-ups of single traces."""
    out = found.withColumn("day", day_of(F.col("first"))).hint("rebalance", "day").sortWithinPartitions("day", "trace_id")
    out = out.write.mode(mode).partitionBy("day").option("parquet.bloom.filter.enabled#trace_id", "true")
    out.parquet(path_of(root, part))


def add(spans: DataFrame, root: str, mode: str = "append") -> None:
    """Enter rows about to be appended; with mode overwrite theirs become the only entries."""
    found = entries(spans)
    _write(found, root, _FRESH, mode)
    if mode == "overwrite":
        _write(found.limit(0), root, _MERGED, mode)


def rebuild(spans: DataFrame, root: str) -> None:
    """Make the index anew from all rows of the table."""
    found = entries(spans)
    _write(found, root, _MERGED, "overwrite")
    _write(found.limit(0), root, _FRESH, "overwrite")


def carry(spark: SparkSession, root: str, out_root: str) -> None:
    """Write the merged entries beside a copy of the table that has all its rows."""
    index = read(spark, root)
    if index is not None:
        _write(index.merge(), out_root, _MERGED, "overwrite")


@dataclass(frozen=True)
class TraceIndex:
    """``merged`` has one entry a trace, ``fresh`` (if there is any) entries of later appends."""

    merged: DataFrame
    fresh: DataFrame | None

    def _all(self) -> DataFrame:
        return self.merged if self.fresh is None else self.merged.unionByName(self.fresh)

    def merge(self) -> DataFrame:
        """``trace_id, first, last`` of every trace."""
        return _joined(self._all())

    def beginning_in(self, within: TimeRange) -> DataFrame:
        """``trace_id, first, last`` of the traces whose first span starts in the range.

        Merged entries of the range's days say that by themselves. History is asked only for traces with fresh
        entries, and only in the index.
        """
        inside, before = (all_of(in_range("first", w, self.merged.columns)) for w in (within, TimeRange(None, within.start)))
        if self.fresh is None:
            return self.merged.where(inside).select("trace_id", "first", "last")
        onward = self._all().where(all_of(in_range("first", TimeRange(within.start, None), self.merged.columns)))
        begun = self._all().where(inside).select("trace_id").distinct()
        if within.start is not None:
            touched = self.fresh.where(inside).select("trace_id").distinct()
            earlier = self.merged.where(before).join(touched, "trace_id", "left_semi").unionByName(self.fresh.where(before))
            begun = begun.join(earlier.select("trace_id").distinct(), "trace_id", "left_anti")
        return _joined(onward.join(begun, "trace_id", "left_semi"))

    def of(self, ids: DataFrame) -> DataFrame:
        """``trace_id, first, last`` of the traces whose ``trace_id`` is among some rows."""
        return _joined(self._all().join(ids.select("trace_id").distinct(), "trace_id", "left_semi"))

    def one(self, trace_id: str) -> DataFrame:
        """The same of a single trace; sorted files and bloom filters leave little to read."""
        return _joined(self._all().where(F.col("trace_id") == trace_id))


def read(spark: SparkSession, root: str) -> TraceIndex | None:
    """The index of the spans under ``root``; none if they were written without one."""
    if not files.exists(spark, path_of(root)):
        return None

    def part(name: str) -> DataFrame | None:
        path = path_of(root, name)
        return None if files.blank(spark, path) else spark.read.schema(LAYOUT).parquet(path)

    merged = part(_MERGED)
    return TraceIndex(spark.createDataFrame([], LAYOUT) if merged is None else merged, part(_FRESH))


def on_days(spans: DataFrame, found: DataFrame) -> DataFrame:
    """Spans of the days that traces found in the index touch, for the scan to leave out all other files.

    The days, not the traces, come to the driver, so the index is read when this is called.
    """
    touched = F.explode(F.sequence(day_of(F.col("first")), day_of(F.col("last"))))
    days = [row.day for row in found.select(touched.alias("day")).distinct().sort("day").collect()]
    return spans.where(F.col("day").isin(days)) if days else spans.limit(0)
