"""Jobs on the table files: listing, statistics, retention, compaction, snapshot.

Jobs that rewrite data put it under a new root and leave the old one as it is,
so a lost job leaves nothing half-changed; the caller switches roots.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from emberscope import schema
from emberscope.session import configure
from emberscope.sources import catalog, tables, trace_index

TARGET_FILE_BYTES = 512 * 1024 * 1024

#: What one task puts in order when a table is rewritten: rows, and bytes of the files they come from (several times that in memory).
TASK_ROWS, TASK_BYTES = 1_000_000, 128 * 1024 * 1024


def _union(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _stored(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables that have files under ``root``."""
    return {
        name: tables.scan(spark, root, name)
        for name in schema.TABLE_NAMES
        if tables.exists(spark, tables.table_path(root, name))
    }


def _relative(path: Column, root: str) -> Column:
    """Path below the root, e.g. ``logs/day=2024-01-01/part-0.parquet``."""
    tail = root.rstrip("/").rsplit("/", 1)[-1]
    return F.substring_index(path, f"/{tail}/", -1)


def segments(spark: SparkSession, root: str) -> DataFrame:
    """Every data file: ``relative_path, min_time_unix_nano, max_time_unix_nano, rows``."""
    out = []
    for name, df in _stored(spark, root).items():
        time = schema.TIME_COLUMN[name]
        out.append(
            df.select(_relative(F.col("_metadata.file_path"), root).alias("relative_path"), time)
            .groupBy("relative_path")
            .agg(
                F.min(time).alias("min_time_unix_nano"),
                F.max(time).alias("max_time_unix_nano"),
                F.count(F.lit(1)).alias("rows"),
            )
        )
    return _union(out)


def _listed(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Data files of a stored table from the listing alone, their content is not opened: ``path, day, bytes``."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(tables.table_path(root, name))
    day = F.col("day") if "day" in found.columns else F.lit(None)
    return found.select(_relative(F.col("path"), root).alias("path"), day.cast("date").alias("day"), F.col("length").alias("bytes"))


def _stored_names(spark: SparkSession, root: str) -> list[str]:
    return [n for n in schema.TABLE_NAMES if tables.exists(spark, tables.table_path(root, n))]


def segment_files(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The files of one table: ``path``."""
    if name not in _stored_names(spark, root):
        return spark.createDataFrame([], "path STRING")
    return _listed(spark, root, name).select("path")


# Sources that are read the old way; Parquet is not among them, as only its new reader answers aggregates from footers.
_OLD_READERS = "avro,csv,json,kafka,orc,text"


def day_stats(spark: SparkSession, root: str) -> DataFrame:
    """``table, day, rows, min_time, max_time`` of all stored tables, read from the footers of their files.

    Counts and bounds by partition are pushed into the Parquet reader, so no data page is read. That takes
    settings of their own: the result belongs to a session beside ``spark``.
    """
    aside = configure(spark.newSession())
    aside.conf.set("spark.sql.sources.useV1SourceList", _OLD_READERS)
    aside.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    layout = "table STRING, day DATE, rows BIGINT, min_time BIGINT, max_time BIGINT"
    out = [aside.createDataFrame([], layout)]
    for name in _stored_names(spark, root):
        time, path = schema.TIME_COLUMN[name], tables.table_path(root, name)
        batched = tables.in_batches(spark, path)
        layout_of = tables.leading(name).add("day", "date")
        # The reader finds a column's statistics by its place in the file, and takes over a grouping by all partition columns only.
        rows = aside.read.schema(layout_of.add("batch", "string") if batched else layout_of).parquet(path)
        files = rows.groupBy(*(["batch"] if batched else []), "day").agg(F.count(F.lit(1)).alias("n"), F.min(time).alias("lo"), F.max(time).alias("hi"))
        days = files.groupBy("day").agg(F.sum("n").alias("rows"), F.min("lo").alias("min_time"), F.max("hi").alias("max_time"))
        out.append(days.select(F.lit(name).alias("table"), "day", "rows", "min_time", "max_time"))
    return _union(out)


def table_stats(spark: SparkSession, root: str) -> DataFrame:
    """``table, files, rows, min_time, max_time`` of all seven; null bounds when empty. Footers and listings are all that is read."""
    days = day_stats(spark, root)
    aside = days.sparkSession
    stored = _stored_names(spark, root)
    files = [_listed(aside, root, n).agg(F.count(F.lit(1)).alias("files")).select(F.lit(n).alias("table"), "files") for n in stored]
    names = aside.createDataFrame([(n,) for n in schema.TABLE_NAMES], "table STRING")
    counted = _union([aside.createDataFrame([], "table STRING, files BIGINT"), *files])
    totals = days.groupBy("table").agg(F.sum("rows").alias("rows"), F.min("min_time").alias("min_time"), F.max("max_time").alias("max_time"))
    none = {c: F.coalesce(c, F.lit(0)) for c in ("files", "rows")}
    return names.join(counted, "table", "left").join(totals, "table", "left").withColumns(none).select("table", "files", "rows", "min_time", "max_time")


def day_sizes(spark: SparkSession, root: str) -> DataFrame:
    """Files and bytes per day over all tables: ``day, files, bytes``."""
    files = [_listed(spark, root, name) for name in _stored_names(spark, root)]
    return (
        _union(files)
        .groupBy("day")
        .agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"))
    )


def kept_days(
    spark: SparkSession,
    root: str,
    retention_days: int | None = None,
    max_bytes: int | None = None,
    today: date | None = None,
) -> DataFrame:
    """Days to keep: not older than ``retention_days`` and, newest first, within ``max_bytes``."""
    days = day_sizes(spark, root)
    if retention_days is not None:
        now = F.lit(today) if today is not None else F.current_date()
        days = days.where(F.col("day") > F.date_sub(now, retention_days))
    if max_bytes is not None:
        # One row per day is left here, so a single ordered group is small.
        newest_first = Window.partitionBy(F.lit(0)).orderBy(F.col("day").desc())
        days = days.withColumn("_kept", F.sum("bytes").over(newest_first)).where(
            F.col("_kept") <= max_bytes
        )
    return days.select("day")


def retain(spark: SparkSession, root: str, out_root: str, **limits) -> None:
    """Write the kept days of all tables under ``out_root``."""
    first_kept = kept_days(spark, root, **limits).agg(F.min("day")).scalar()
    for name, df in _stored(spark, root).items():
        # Days are dropped oldest first, so one bound prunes the partitions.
        kept = tables.rewrite(df.where(F.col("day") >= first_kept), root, name, out_root)
        tables.writer(kept, name).parquet(tables.table_path(out_root, name))
        catalog.carry(spark, root, name, out_root, first_kept)
        if name == schema.SPANS:
            # A trace cut by the bound begins with the first span that is left.
            trace_index.rebuild(tables.scan(spark, out_root, name), out_root)


def compact(
    spark: SparkSession,
    root: str,
    name: str,
    out_root: str,
    target_bytes: int = TARGET_FILE_BYTES,
) -> dict[str, int]:
    """Rewrite a table into few large files, clustered by service and time.

    Ranges are cut on (day, service, time), so a service with much of the data
    is spread over as many files as it needs. A file is smaller than ``target_bytes`` where that many bytes are more
    than a task should sort (``TASK_ROWS``, ``TASK_BYTES``). Returns files before and after.
    """
    df = tables.scan(spark, root, name)
    before = _listed(spark, root, name).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("b")).first()
    # Rows are counted from the footers.
    parts = max(1, -(-before["b"] // min(target_bytes, TASK_BYTES)), -(-df.count() // TASK_ROWS))
    order = ["day", *tables.clustering(name)]
    rows = tables.rewrite(df, root, name, out_root).repartitionByRange(parts, *order)
    tables.writer(rows.sortWithinPartitions(*order), name).parquet(tables.table_path(out_root, name))
    catalog.carry(spark, root, name, out_root)
    if name == schema.SPANS:
        trace_index.carry(spark, root, out_root)
    created = segment_files(spark, out_root, name).count()
    return {"merged": before["n"], "created": created}


def snapshot(spark: SparkSession, root: str, directory: str) -> dict[str, int]:
    """Copy the committed data of all tables; returns the number of files written per table."""
    written = {}
    for name, df in _stored(spark, root).items():
        whole = tables.rewrite(df, root, name, directory)
        tables.writer(whole, name).parquet(tables.table_path(directory, name))
        catalog.carry(spark, root, name, directory)
        if name == schema.SPANS:
            trace_index.carry(spark, root, directory)
        written[name] = segment_files(spark, directory, name).count()
    return written
