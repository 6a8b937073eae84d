"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberscope.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """From links (a long, b long) to (id, component): the smallest id that each linked id reaches.

    Alternates two contractions until nothing changes: every id hands the smallest
    id it knows to its larger neighbours, then to its smaller ones. Both are one
    grouped minimum with map-side combine and a join on it, so that an id with very many
    neighbours is never gathered in one place. Each round is written to the shared
    folder. Empty input gives no rows; self links, repeats and nulls are ignored.
    """
    edges = links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).where("hi > lo").distinct()
    edges = stored(edges, "links")
    before = None
    while True:
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")).join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        large = large.where("hi > lo").distinct()
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low, "hi").select(F.explode(F.array(F.struct("hi", F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("e"))
        edges = stored(small.select("e.hi", "e.lo").where("hi > lo").distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if before == tuple(now):
            break
        before = tuple(now)
    found = edges.select(F.col("hi").alias("id"), F.col("lo").alias("component"))
    return found.union(edges.select("lo", "lo").distinct())
