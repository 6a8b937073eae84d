"""Catalog look-ups, over the seven tables or over the catalog kept beside them (``sources.catalog.read``)."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from emberscope import schema
from emberscope.functions.attrs import attr
from emberscope.sources import catalog

Tables = Mapping[str, DataFrame]


def _union(frames) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _metric_tables(tables: Tables, names=schema.METRIC_TABLES) -> dict[str, DataFrame]:
    return {name: tables[name] for name in names if name in tables}


def attr_names(tables: Tables | DataFrame) -> DataFrame:
    """Distinct attribute keys of all tables, resource keys included: ``name``."""
    if isinstance(tables, DataFrame):
        return catalog.attr_names(tables)
    keys = F.concat(
        F.coalesce(F.map_keys("attributes"), F.array().cast("array<string>")),
        F.coalesce(F.map_keys("resource"), F.array().cast("array<string>")),
    )
    # Tables repeat few distinct key sets, so those are made distinct first.
    sets = _union([t.select(keys.alias("_keys")).distinct() for t in tables.values()])
    return sets.select(F.explode("_keys").alias("name")).distinct()


def attr_values(tables: Tables | DataFrame, key: str) -> DataFrame:
    """Distinct values of one key over all tables: ``value``."""
    if isinstance(tables, DataFrame):
        return catalog.attr_values(tables, key)
    values = [t.select(attr(key, t.columns).alias("value")).distinct() for t in tables.values()]
    return _union(values).where(F.col("value").isNotNull()).distinct()


def metric_catalog(tables: Tables | DataFrame) -> DataFrame:
    """``metric, unit, temporality, kind`` of every stored metric."""
    return _catalogued(tables).drop("table")


def _catalogued(tables: Tables | DataFrame) -> DataFrame:
    if isinstance(tables, DataFrame):
        return catalog.metrics(tables)
    return _union(
        [
            t.select("metric", "unit", "temporality")
            .distinct()
            .withColumns({"kind": F.lit(schema.METRIC_KIND[name]), "table": F.lit(name)})
            for name, t in _metric_tables(tables).items()
        ]
    )


def metric_series(tables: Tables, metric: str) -> DataFrame:
    """Distinct label sets carrying a metric: ``labels``."""
    return _union(
        [t.where(F.col("metric") == metric).select("labels") for t in _metric_tables(tables).values()]
    ).distinct()


def metric_exemplars(tables: Tables, metric: str) -> DataFrame:
    """Exemplars of a metric: ``time, value, trace_id, span_id, attributes``."""
    carriers = [n for n in schema.METRIC_TABLES if n != schema.SUMMARY]
    return _union(
        [
            t.where(F.col("metric") == metric).select(F.inline("exemplars"))
            for t in _metric_tables(tables, carriers).values()
        ]
    )


def _named(tables: Tables | DataFrame) -> DataFrame:
    kind = (
        F.when(F.col("kind") == "sum", "cumulative_counter")
        .when(F.col("kind") == "histogram", "cumulative_histogram")
        .otherwise("gauge")
    )
    return _catalogued(tables).select(
        F.translate("metric", ".", "_").alias("query_name"), F.col("metric").alias("storage_name"), kind.alias("kind"), "table"
    )


def metric_names(tables: Tables | DataFrame) -> DataFrame:
    """How stored metrics are addressed in a query: ``query_name, storage_name, kind``.

    Dots become underscores; sums are counters and every kind other than sum and
    histogram is evaluated as a gauge.
    """
    return _named(tables).drop("table").distinct()


def _resolved(tables: Tables | DataFrame, query_name: str) -> Row:
    found = _named(tables).where(F.col("query_name") == query_name).distinct()
    rows = found.orderBy("storage_name", "table").limit(2).collect()
    if not rows:
        raise ValueError(f"metric {query_name!r} does not resolve to a stored metric")
    if len(rows) > 1:
        names = " and ".join(f"{r['storage_name']} ({r['kind']} in {r['table']})" for r in rows)
        raise ValueError(f"metric {query_name!r} could be {names}")
    return rows[0]


def resolve_metric(tables: Tables | DataFrame, query_name: str) -> tuple[str, str]:
    """Stored name and kind behind a query name; an unknown or ambiguous name is an error."""
    found = _resolved(tables, query_name)
    return found["storage_name"], found["kind"]


def points_of(tables: Tables, query_name: str, names: DataFrame | None = None) -> DataFrame:
    """Points of the metric behind a query name, from the table that holds it; ``names``: the catalog, to look it up there."""
    found = _resolved(tables if names is None else names, query_name)
    return tables[found["table"]].where(F.col("metric") == found["storage_name"])
