"""Small hand-made tables for the edge cases."""

from __future__ import annotations

from pyspark.sql import functions as F

from emberscope import schema
from emberscope.functions.attrs import canonical_json
from emberscope.functions.timegrid import day_of

S = 1_000_000_000


def table(spark, name: str, rows: list[dict]):
    """Rows with only the interesting columns given; the rest is null or empty."""
    layout = schema.table_schema(name)
    full = [tuple(row.get(f.name) for f in layout) for row in rows]
    df = spark.createDataFrame(full, layout)
    time = schema.TIME_COLUMN[name]
    empty = F.create_map().cast("map<string,string>")
    fills = {
        "day": day_of(F.col(time)),
        "attributes": F.coalesce("attributes", empty),
        "resource": F.coalesce("resource", empty),
    }
    if "labels" in df.columns:
        fills["labels"] = F.coalesce("labels", canonical_json(fills["attributes"]))
    return df.withColumns(fills)


def logs(spark, *rows):
    return table(spark, schema.LOGS, [{"service": "checkout", "severity_number": 9, **r} for r in rows])


def samples(spark, kind: str, *rows):
    return table(spark, kind, [{"service": "a", "metric": "m", "flags": 0, **r} for r in rows])


def spans(spark, *rows):
    return table(
        spark,
        schema.SPANS,
        [{"service": "a", "status": "UNSET", "kind": "SERVER", "name": "n", **r} for r in rows],
    )


def tuples(df, *columns):
    rows = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in rows.collect()), key=repr)
