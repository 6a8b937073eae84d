"""What the tables hold, per day: attribute keys, their values, and metrics.

Every append adds the distinct entries of its rows to files beside the tables, so that look-ups read these and
no table. Entries that several appends wrote are merged on read. Entries are written before the rows: a lost append
may leave names too many, never too few; :func:`rebuild` makes them anew.
"""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberscope import schema
from emberscope.functions.attrs import SERVICE_KEYS
from emberscope.sources import files

KEY, VALUE, METRIC = "key", "value", "metric"
_COLUMNS = ("day", "kind", "name", "value", "unit", "temporality")
LAYOUT = "day DATE, name STRING, value STRING, unit STRING, temporality STRING, table STRING, kind STRING"


def path_of(root: str, name: str | None = None) -> str:
    base = f"{root.rstrip('/')}/_catalog"
    return base if name is None else f"{base}/table={name}"


_PAIR, _SERVICE = "pair", "service"


def _entry(kind: str, name: Column, value: Column, unit: Column | None = None, temporality: Column | None = None) -> Column:
    rest = {"value": value, "unit": unit, "temporality": temporality}
    return F.struct(
        F.lit(kind).alias("kind"), name.alias("name"), *[(F.lit(None) if c is None else c).cast("string").alias(n) for n, c in rest.items()]
    )


def entries(rows: DataFrame, name: str) -> DataFrame:
    """Distinct entries of a table's rows; a value is listed for the key whose look-up finds it, see ``attrs.attr``.

    Rows give their pairs only; keys and values are told apart once the pairs are distinct, which are few.
    """
    none = F.create_map().cast("map<string,string>")
    own, resource = F.coalesce("attributes", none), F.coalesce("resource", none)
    hidden = F.map_filter(resource, lambda k, v: F.try_element_at(own, k).isNull())
    pairs = F.concat(F.map_entries(own), F.map_entries(hidden))
    listed = [
        F.transform(pairs, lambda e: _entry(_PAIR, e["key"], e["value"])),
        F.array(_entry(_SERVICE, F.lit("service"), F.col("service"))),
    ]
    if name in schema.METRIC_TABLES:
        listed.append(F.array(_entry(METRIC, F.col("metric"), F.lit(None), F.col("unit"), F.col("temporality"))))
    seen = rows.select("day", F.explode(F.concat(*listed)).alias("_e")).select("day", "_e.*").distinct()
    kind, known = F.col("kind"), F.col("value").isNotNull()
    kinds = F.filter(
        F.array(
            F.when(kind == _PAIR, F.lit(KEY)),
            F.when((kind == _SERVICE) & known | (kind == _PAIR) & known & ~F.col("name").isin(*SERVICE_KEYS), F.lit(VALUE)),
            F.when(kind == METRIC, F.lit(METRIC)),
        ),
        lambda k: k.isNotNull(),
    )
    told = seen.withColumn("kind", F.explode(kinds))
    return told.withColumn("value", F.when(F.col("kind") != KEY, F.col("value"))).select(*_COLUMNS).distinct()


def add(rows: DataFrame, root: str, name: str, mode: str = "append") -> None:
    """Write the entries of ``rows``; with mode overwrite they take the place of the table's."""
    out = entries(rows, name).sortWithinPartitions("kind", "name", "day", "value")
    out.write.mode(mode).partitionBy("kind").parquet(path_of(root, name))


def read(spark: SparkSession, root: str, first: date | None = None, last: date | None = None) -> DataFrame:
    """Merged entries of the days asked for: ``table, day, kind, name, value, unit, temporality``."""
    if not files.exists(spark, path_of(root)):
        return spark.createDataFrame([], LAYOUT).select("table", *_COLUMNS)
    rows = spark.read.schema(LAYOUT).option("basePath", path_of(root)).parquet(path_of(root))
    rows = rows.where(F.col("day") >= first) if first is not None else rows
    rows = rows.where(F.col("day") <= last) if last is not None else rows
    return rows.select("table", *_COLUMNS).distinct()


def carry(spark: SparkSession, root: str, name: str, out_root: str, first: date | None = None) -> None:
    """Write a table's merged entries, from a day on if one is given, beside the table's copy."""
    if files.exists(spark, path_of(root, name)):
        rows = read(spark, root, first).where(F.col("table") == name).drop("table")
        rows = rows.repartition("kind").sortWithinPartitions("kind", "name", "day", "value")
        rows.write.mode("overwrite").partitionBy("kind").parquet(path_of(out_root, name))


def rebuild(tables: dict[str, DataFrame], root: str) -> None:
    """Make the catalog anew from the tables as they are."""
    for name, rows in tables.items():
        add(rows, root, name, mode="overwrite")


def attr_names(catalog: DataFrame) -> DataFrame:
    return catalog.where(F.col("kind") == KEY).select("name").distinct()


def attr_values(catalog: DataFrame, key: str) -> DataFrame:
    name = "service" if key in SERVICE_KEYS else key
    return catalog.where((F.col("kind") == VALUE) & (F.col("name") == name)).select("value").distinct()


def metrics(catalog: DataFrame) -> DataFrame:
    """``metric, unit, temporality, kind, table`` of every stored metric."""
    kinds = [F.when(F.col("table") == t, F.lit(k)) for t, k in schema.METRIC_KIND.items()]
    found = catalog.where(F.col("kind") == METRIC)
    return found.select(F.col("name").alias("metric"), "unit", "temporality", reduce(lambda a, b: F.coalesce(a, b), kinds).alias("kind"), "table").distinct()
