"""The seven tables as day-partitioned Parquet: write, scan, export, SQL views."""

from __future__ import annotations

import uuid
from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from emberscope import schema
from emberscope.functions.attrs import promote, promoted_column
from emberscope.plans.predicates import all_of, in_range
from emberscope.plans.specs import UNBOUNDED, TimeRange
from emberscope.sources import catalog, trace_index
from emberscope.sources.files import blank, exists, mark

EXPORT_FORMATS = ("parquet", "orc", "json", "csv")

# Formats without nested types get their maps, arrays and structs as JSON text.
_FLAT_FORMATS = ("csv",)


def table_path(root: str, name: str) -> str:
    schema.table_ddl(name)
    return f"{root.rstrip('/')}/{name}"


def clustering(name: str) -> list[str]:
    """Columns rows are sorted by inside a file, so that row groups can be skipped."""
    by_metric = ["metric"] if name.startswith("metrics_") else []
    return [*by_metric, "service", schema.TIME_COLUMN[name]]


def leading(name: str) -> StructType:
    """A table's columns up to its time, none of them nested; every file begins with them, so footers can be asked by place."""
    layout = schema.table_schema(name)
    return StructType(layout.fields[: layout.names.index(schema.TIME_COLUMN[name]) + 1])


def writer(df: DataFrame, name: str) -> DataFrameWriter:
    """A day-partitioned writer; ids that look-ups ask for get bloom filters, as min and max say nothing of them."""
    first = leading(name)
    begin = [F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in first]
    df = df.select(*begin, *[c for c in df.columns if c not in first.names])
    out = df.write.partitionBy("day")
    if name in (schema.LOGS, schema.SPANS):
        out = out.option("parquet.bloom.filter.enabled#trace_id", "true")
    return out


def append(
    rows: DataFrame,
    root: str,
    name: str,
    promote_keys: Collection[str] = (),
    mode: str = "append",
    clustered: bool = False,
    batch: str | None = None,
) -> None:
    """Write rows under ``root``; promoted attribute keys become columns of their own.

    Without a shuffle every task writes what it holds, sorted: right for input
    that arrives in time order, with compaction later. ``clustered`` is for bulk
    loads whose tasks each hold many days: rows are first brought together by
    day, large days split and small ones joined to the advisory partition size,
    so that the number of files does not grow with tasks times days.

    Which keys a table has promoted is kept beside it, and later writes in any mode promote them,
    too. A key promoted only after rows were there is read from the maps until
    the table is rewritten. Entries of the rows go to the catalog first, and those of spans to the trace index, so ``rows`` is evaluated
    more than once: persist what is dear.

    A table begun with a ``batch`` consists of folders named by it. Writing a batch again replaces its rows, so
    repeats after a failure change nothing.
    """
    spark, path = rows.sparkSession, table_path(root, name)
    if from_stream(spark, path):
        raise ValueError(f"{path} is written by a stream; rows appended to it would not be read")
    batched = in_batches(spark, path)
    if batch is not None and not batched:
        if exists(spark, path):
            raise ValueError(f"{path} holds rows outside batches")
        mark(spark, f"{path}/{_BATCHED}")
    if batch is None and batched:
        if mode != "append":
            raise ValueError(f"{path} consists of batches; write it under another root")
        batch = uuid.uuid4().hex
    out = rows.drop(*[c for c in rows.columns if c.startswith("attr_")])
    known = promotions(spark, root, name)
    fresh = sorted(set(promote_keys) - set(known))
    whole = mode == "overwrite" or blank(spark, path)
    # Rows that are there already lack a column promoted only now.
    _record(spark, root, name, fresh, whole=whole)
    out = promote(out, [*known, *fresh])
    catalog.add(out, root, name, "append" if batch is not None else mode)
    # Spans written before there was an index would be missing from one begun now.
    if name == schema.SPANS and (whole or exists(spark, trace_index.path_of(root))):
        trace_index.add(out, root, "append" if batch is not None else mode)
    order = ["day", *clustering(name)]
    if clustered:
        out = out.hint("rebalance", "day")
    target = path if batch is None else f"{path}/{_BATCH}={batch}"
    writer(out.sortWithinPartitions(*order), name).mode(mode if batch is None else "overwrite").parquet(target)


_BATCH, _BATCHED = "batch", "_batched"


def in_batches(spark: SparkSession, path: str) -> bool:
    return exists(spark, f"{path}/{_BATCHED}")


def from_stream(spark: SparkSession, path: str) -> bool:
    """Whether a table's files are listed by a stream's commit log."""
    return exists(spark, f"{path}/_spark_metadata")


def _layout_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/_layout/{name}"


def promotions(spark: SparkSession, root: str, name: str) -> dict[str, bool]:
    """Promoted keys of a table, and whether all its rows have their column."""
    path = _layout_path(root, name)
    if not exists(spark, path):
        return {}
    rows = spark.read.schema("key STRING, whole BOOLEAN").json(path).collect()
    return {r["key"]: all(o["whole"] for o in rows if o["key"] == r["key"]) for r in rows}


def _record(spark: SparkSession, root: str, name: str, keys: Collection[str], whole: bool) -> None:
    if keys:
        rows = spark.createDataFrame([(k, whole) for k in keys], "key STRING, whole BOOLEAN")
        rows.coalesce(1).write.mode("append").json(_layout_path(root, name))


def rewrite(df: DataFrame, root: str, name: str, out_root: str) -> DataFrame:
    """A table's rows with the columns of all its promoted keys, recorded for ``out_root``, where they will be written."""
    spark = df.sparkSession
    keys = sorted(promotions(spark, root, name))
    _record(spark, out_root, name, keys, whole=True)
    return promote(df.drop(*map(promoted_column, keys)), keys)


def scan(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One table; a root without files for it gives no rows but the full schema.

    Promoted keys whose column every row has come as columns, which predicates then use.
    """
    layout = schema.table_schema(name)
    for key, whole in sorted(promotions(spark, root, name).items()):
        if whole:
            layout = layout.add(promoted_column(key), "string")
    path = table_path(root, name)
    if not exists(spark, path):
        return spark.createDataFrame([], layout)
    return spark.read.schema(layout).parquet(path).drop(_BATCH)


def scan_all(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {name: scan(spark, root, name) for name in schema.TABLE_NAMES}


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make the tables known to ``spark.sql`` under their own names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def sql(spark: SparkSession, tables: Mapping[str, DataFrame], text: str) -> DataFrame:
    """SQL over all tables; an unknown table or bad text raises Spark's AnalysisException."""
    register_views(tables)
    return spark.sql(text)


def select_range(df: DataFrame, name: str, within: TimeRange = UNBOUNDED) -> DataFrame:
    return df.where(all_of(in_range(schema.TIME_COLUMN[name], within, df.columns)))


def export(
    df: DataFrame, name: str, path: str, start: int = 0, end: int = 0, fmt: str = "parquet"
) -> None:
    """Write one table's rows of ``[start, end)``; 0/0 means all of them."""
    if fmt not in EXPORT_FORMATS:
        raise ValueError(f"export format {fmt!r} is not one of {', '.join(EXPORT_FORMATS)}")
    within = UNBOUNDED if start == 0 and end == 0 else TimeRange(start, end)
    rows = select_range(df, name, within)
    if fmt in _FLAT_FORMATS:
        rows = rows.select(
            *[
                F.to_json(c).alias(c) if t.startswith(("map", "array", "struct")) else F.col(c)
                for c, t in rows.dtypes
            ]
        )
        rows.write.option("header", True).csv(path)
    else:
        rows.write.format(fmt).save(path)


def scan_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table: ``table, rows``."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, df in tables.items()
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out
