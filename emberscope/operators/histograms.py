"""Quantiles of explicit-bounds and exponential histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberscope.functions.quantiles import (
    explicit_buckets,
    exponential_base,
    exponential_bucket,
    geometric_quantile,
    linear_quantile,
)
from emberscope.functions.timegrid import bucket
from emberscope.operators.metrics import group_columns, recorded, source
from emberscope.operators.ordered import HALO, chunk_window, with_previous_row
from emberscope.plans.predicates import series_predicate
from emberscope.plans.specs import ExpHistogramQuery, HistogramQuery


def _prepared(points: DataFrame, q: HistogramQuery) -> tuple[DataFrame, Column, list[Column]]:
    rows = recorded(points.where(series_predicate(q, points.columns)))
    time = F.col("time_unix_nano")
    at = time if q.step_ns is None else bucket(time, q.step_ns)
    return rows, at.alias("bucket"), group_columns(q.group_by, points.columns)


_PREVIOUS = "_previous"


def _with_previous(rows: DataFrame, counts: list[str], reset: Column) -> DataFrame:
    """Rows with the ``counts`` that a cumulative point adds to: those of its series' previous point.

    ``_previous`` is null where all of a point's own counts are new: it is a delta point, or its series was reset (a new
    start time, a smaller count, or ``reset``, an expression over ``_previous``). The first cumulative point of a series
    is left out, as nobody knows what it had counted before.
    """
    kept = ["time_unix_nano", "start_time_unix_nano", "count", *counts]
    layout = F.struct(*kept)
    if "temporality" not in rows.columns:
        return rows.withColumn(_PREVIOUS, F.when(F.lit(False), layout))
    cumulative = F.coalesce("temporality", F.lit("")) == "CUMULATIVE"
    keys, order = ["metric", "labels", *[c for c in ["_series"] if "resource" in rows.columns]], ["time_unix_nano", "count"]
    points = rows.where(cumulative)
    if "_series" in keys:
        points = points.withColumn("_series", source(rows)[0])
    before = F.col(_PREVIOUS)
    anew = ~before["start_time_unix_nano"].eqNullSafe(F.col("start_time_unix_nano")) | (F.col("count") < before["count"]) | reset
    points = (
        with_previous_row(points, keys, order)
        .withColumn(_PREVIOUS, F.lag(layout).over(chunk_window(keys, order)))
        .where(~F.col(HALO) & before.isNotNull())
        .withColumn(_PREVIOUS, F.when(~F.coalesce(anew, F.lit(True)), before))
        .select(*rows.columns, _PREVIOUS)
    )
    return rows.where(~cumulative).withColumn(_PREVIOUS, F.when(F.lit(False), layout)).unionByName(points)


def quantile(points: DataFrame, q: HistogramQuery) -> DataFrame:
    """``bucket, g0..gN, v``: one row per point, or per step with buckets merged.

    Only points with equal bounds are merged, so a group whose points disagree
    on their bounds yields one row per set of bounds. Per step a cumulative point counts
    by what its series has gained since its previous point; per point it stands for all since its start.
    """
    rows, at, groups = _prepared(points, q)
    if q.step_ns is None:
        value = linear_quantile(explicit_buckets(F.col("explicit_bounds"), F.col("bucket_counts")), q.phi)
        return rows.select(at, *groups, value.alias("v"))

    keys = ["bucket", *[f"g{i}" for i in range(len(groups))], "explicit_bounds"]
    before = F.col(_PREVIOUS)
    fell = F.exists(F.zip_with("bucket_counts", before["bucket_counts"], lambda n, p: n - p), lambda d: d.isNull() | (d < 0))
    moved = ~before["explicit_bounds"].eqNullSafe(F.col("explicit_bounds"))
    gained = F.zip_with("bucket_counts", before["bucket_counts"], lambda n, p: n - p)
    rows = _with_previous(rows, ["explicit_bounds", "bucket_counts"], moved | fell)
    rows = rows.withColumn("bucket_counts", F.when(before.isNull(), F.col("bucket_counts")).otherwise(gained))
    summed = (
        rows.select(at, *groups, "explicit_bounds", F.posexplode("bucket_counts").alias("_i", "_n"))
        .groupBy(*keys, "_i")
        .agg(F.sum("_n").alias("_n"))
    )
    merged = summed.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("_i", "_n"))).getField("_n").alias("_counts")
    )
    value = linear_quantile(explicit_buckets(F.col("explicit_bounds"), F.col("_counts")), q.phi)
    return merged.select(*keys[:-1], value.alias("v"))


def _one_side(point: Column | None, side: str, sign: int) -> Column:
    """Buckets of one side of a point as (sign, index, n)."""
    buckets = F.col(side) if point is None else point[side]
    offset = F.coalesce(buckets["offset"], F.lit(0))
    return F.transform(
        F.coalesce(buckets["bucket_counts"], F.array().cast("array<bigint>")),
        lambda n, i: F.struct(
            F.lit(sign).alias("sign"), (offset + i).alias("index"), n.alias("n")
        ),
    )


def _zero(point: Column | None) -> Column:
    n = F.col("zero_count") if point is None else point["zero_count"]
    return F.array(
        F.struct(
            F.lit(0).alias("sign"),
            F.lit(0).alias("index"),
            F.coalesce(n, F.lit(0).cast("bigint")).alias("n"),
        )
    )


def _cells(point: Column | None, times: int) -> Column:
    """All buckets of a point as (scale, sign, index, n), n being counted ``times``."""
    scale = F.col("scale") if point is None else point["scale"]
    every = F.concat(_one_side(point, "negative", -1), _zero(point), _one_side(point, "positive", 1))
    return F.transform(
        every, lambda b: F.struct(scale.alias("scale"), b["sign"].alias("sign"), b["index"].alias("index"), (b["n"] * times).alias("n"))
    )


def _walk(sign: Column, index: Column) -> Column:
    """Sort key that runs from the most negative bucket over zero to the largest."""
    return F.struct(sign, sign * index)


def exponential_quantile(points: DataFrame, q: ExpHistogramQuery) -> DataFrame:
    """``bucket, g0..gN, v``; with a step, points are brought to the group's lowest scale and widest zero bucket.

    Per step a cumulative point counts by what its series has gained since its previous point: the previous
    point's buckets are taken away at the lower scale of the two. Buckets that end within the largest zero
    threshold of the group are part of the zero bucket.
    """
    rows, at, groups = _prepared(points, q)
    if q.step_ns is None:
        walked = F.concat(F.reverse(_one_side(None, "negative", -1)), _zero(None), _one_side(None, "positive", 1))
        scale = F.col("scale")
        buckets = F.transform(
            walked, lambda b: exponential_bucket(b["sign"], b["index"], scale, b["n"])
        )
        return rows.select(at, *groups, geometric_quantile(buckets, q.phi).alias("v"))

    keys = ["bucket", *[f"g{i}" for i in range(len(groups))]]
    before = F.col(_PREVIOUS)
    rows = _with_previous(rows, ["scale", "zero_count", "zero_threshold", "positive", "negative"], F.lit(False))
    cells = F.when(before.isNull(), _cells(None, 1)).otherwise(F.concat(_cells(None, 1), _cells(before, -1)))
    threshold = F.greatest(F.coalesce("zero_threshold", F.lit(0.0)), F.coalesce(before["zero_threshold"], F.lit(0.0)))
    by_scale = (
        rows.select(at, *groups, threshold.alias("_threshold"), F.explode(cells).alias("_c"))
        .where(F.col("_c.n") != 0)
        .groupBy(*keys, F.col("_c.scale").alias("scale"), F.col("_c.sign").alias("sign"), F.col("_c.index").alias("index"))
        .agg(F.sum("_c.n").alias("n"), F.max("_threshold").alias("_threshold"))
    )
    # From here on a group has at most one row per (scale, bucket).
    group = Window.partitionBy(*keys)
    ends = F.pow(exponential_base(F.col("_scale")), F.col("_index").cast("double") + 1)
    zero = (F.col("sign") == 0) | (ends <= F.max("_threshold").over(group))
    aligned = (
        by_scale.withColumn("_scale", F.min("scale").over(group))
        .withColumn("_index", F.expr("shiftright(index, scale - _scale)"))
        .withColumn("_zero", zero)
        .withColumn("sign", F.when(F.col("_zero"), 0).otherwise(F.col("sign")))
        .withColumn("_index", F.when(F.col("_zero"), 0).otherwise(F.col("_index")))
        .groupBy(*keys, "_scale", "sign", "_index")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") > 0)
    )
    cell = F.struct(
        _walk(F.col("sign"), F.col("_index")).alias("walk"), "sign", F.col("_index").alias("index"), "n"
    )
    merged = aligned.groupBy(*keys, "_scale").agg(F.array_sort(F.collect_list(cell)).alias("_cells"))
    buckets = F.transform(
        "_cells", lambda b: exponential_bucket(b["sign"], b["index"], F.col("_scale"), b["n"])
    )
    return merged.select(*keys, geometric_quantile(buckets, q.phi).alias("v"))
