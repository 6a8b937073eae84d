"""Quantile of bucketed counts as a row expression over an array of buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _bucket(low: Column, high: Column, n: Column) -> Column:
    return F.struct(
        low.cast("double").alias("low"), high.cast("double").alias("high"), n.cast("bigint").alias("n")
    )


def explicit_buckets(bounds: Column, counts: Column) -> Column:
    """Buckets of an explicit-bounds histogram.

    The first bucket starts at 0 when its bound is positive; the overflow bucket
    is a point at the last bound.
    """
    first, last = F.get(bounds, F.lit(0)), F.get(bounds, F.size(bounds) - 1)
    return F.transform(
        counts,
        lambda n, i: _bucket(
            F.when(i == 0, F.least(first, F.lit(0.0))).otherwise(F.get(bounds, i - 1)),
            F.coalesce(F.get(bounds, i), last),
            n,
        ),
    )


def exponential_base(scale: Column) -> Column:
    return F.pow(F.lit(2.0), F.pow(F.lit(2.0), -scale.cast("double")))


def exponential_bucket(sign: Column, index: Column, scale: Column, n: Column) -> Column:
    """Bucket ``index`` of one side: (base^index, base^(index+1)], mirrored for sign -1."""
    base = exponential_base(scale)
    near, far = F.pow(base, index.cast("double")), F.pow(base, index.cast("double") + 1)
    return _bucket(
        F.when(sign > 0, near).when(sign < 0, -far).otherwise(0.0),
        F.when(sign > 0, far).when(sign < 0, -near).otherwise(0.0),
        n,
    )


def _rank_bucket(buckets: Column, phi: float) -> Column:
    """The bucket holding rank ``phi * total`` and how far into it the rank lies."""
    total = F.aggregate(buckets, F.lit(0).cast("bigint"), lambda acc, b: acc + b["n"])
    rank = F.lit(float(phi)) * total
    nothing = F.lit(None).cast("double")
    start = F.struct(
        F.lit(0).cast("bigint").alias("seen"),
        nothing.alias("low"),
        nothing.alias("high"),
        nothing.alias("share"),
    )

    def step(acc: Column, b: Column) -> Column:
        hit = acc["share"].isNull() & (b["n"] > 0) & (acc["seen"] + b["n"] >= rank)
        return F.struct(
            (acc["seen"] + b["n"]).alias("seen"),
            F.when(hit, b["low"]).otherwise(acc["low"]).alias("low"),
            F.when(hit, b["high"]).otherwise(acc["high"]).alias("high"),
            F.when(hit, (rank - acc["seen"]) / b["n"]).otherwise(acc["share"]).alias("share"),
        )

    return F.aggregate(buckets, start, step)


def linear_quantile(buckets: Column, phi: float) -> Column:
    """Linear interpolation inside the bucket; NULL without counts."""
    at = _rank_bucket(buckets, phi)
    return at["low"] + (at["high"] - at["low"]) * at["share"]


def geometric_quantile(buckets: Column, phi: float) -> Column:
    """Geometric interpolation inside the bucket; the zero bucket yields 0."""
    at = _rank_bucket(buckets, phi)
    low, high, share = at["low"], at["high"], at["share"]
    return F.when(low == high, low).otherwise(low * F.pow(high / low, share))
