"""Order-dependent steps over keyed rows, without putting a large key into one task.

A window over ``partitionBy(key)`` sorts all rows of a key in one task. That is
the best plan while keys are small, and fails for a key that holds a large share
of a large table. So keys are measured first. Those too large for a task, and only those, have
their ordering column cut into chunks of about ``ROWS_PER_TASK`` rows: a
``(key, chunk)`` group then fits a task however
keys and times are distributed; all other keys stay whole. What a chunk needs from before its start (its
*halo*) is computed from one summary row per ``(key, chunk)`` and added to the
chunk as extra rows. Either way the full data is shuffled once.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

CHUNK = "_chunk"
HALO = "_halo"

# Rows of one group that a single task may have to sort.
ROWS_PER_TASK = 10_000_000

_HOT = "_hot"


def hot_keys(df: DataFrame, keys: Sequence[str]) -> list[Row]:
    """Keys with more rows than a task may sort, each with its number of rows ``_n``.

    Runs one aggregation over the key columns. There is at most one such key per ``ROWS_PER_TASK`` rows.
    """
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > ROWS_PER_TASK).collect()


def chunks_needed(df: DataFrame, keys: Sequence[str]) -> int:
    """1 while every key fits a task, else enough chunks for the rows of those that don't."""
    return _chunks(hot_keys(df, keys))


def _chunks(hot: list[Row]) -> int:
    return max(1, -(-sum(r["_n"] for r in hot) // ROWS_PER_TASK))


def chunk_bounds(df: DataFrame, column: str, chunks: int) -> list:
    """Inner boundaries of about equal-count slices of a column, from one mergeable sketch.

    The sketch only balances the chunks, results do not depend on it. It is made once, so that all uses of the
    boundaries agree; equal values lie in one chunk.
    """
    if chunks <= 1:
        return []
    fractions = [i / chunks for i in range(1, chunks)]
    found = df.agg(F.percentile_approx(column, fractions, max(10_000, 20 * chunks))).first()[0]
    return sorted(set(found or []))


def with_chunk(df: DataFrame, column: str, bounds: list) -> DataFrame:
    """Add the chunk number of every row: how many boundaries are <= its value."""
    if not bounds:
        return df.withColumn(CHUNK, F.lit(0))
    kind = dict(df.dtypes)[column]
    table = F.split(F.lit(",".join(map(str, bounds))), ",").cast(f"array<{kind}>")
    jumps = [1 << i for i in reversed(range(len(bounds).bit_length()))]
    found = F.aggregate(
        F.array(*[F.lit(j) for j in jumps]),
        F.lit(0),
        lambda at, jump: F.when(F.get(table, at + jump - 1) <= F.col(column), at + jump).otherwise(at),
    )
    return df.withColumn(CHUNK, found)


def _chunked(df: DataFrame, keys: Sequence[str], column: str, chunks: int | None) -> tuple[DataFrame, bool]:
    """Rows with their chunk and whether their key is cut; ``chunks`` cuts all keys into so many."""
    whole = df.withColumns({CHUNK: F.lit(0), _HOT: F.lit(False)})
    if chunks is not None:
        bounds = chunk_bounds(df, column, chunks)
        return (with_chunk(df, column, bounds).withColumn(_HOT, F.lit(True)), True) if bounds else (whole, False)
    hot = hot_keys(df, keys)
    if not hot:
        return whole, False
    named = {k: f"_h{i}" for i, k in enumerate(keys)}
    layout = ", ".join(f"{named[k]} {dict(df.dtypes)[k]}" for k in keys)
    listed = df.sparkSession.createDataFrame([tuple(r[k] for k in keys) for r in hot], layout).withColumn(_HOT, F.lit(True))
    same = [F.col(k).eqNullSafe(F.col(h)) for k, h in named.items()]
    marked = df.join(F.broadcast(listed), same, "left").drop(*named.values())
    marked = marked.withColumn(_HOT, F.coalesce(_HOT, F.lit(False)))
    bounds = chunk_bounds(marked.where(_HOT), column, _chunks(hot))
    cut = with_chunk(marked, column, bounds)
    return cut.withColumn(CHUNK, F.when(F.col(_HOT), F.col(CHUNK)).otherwise(0)), bool(bounds)


def _tag(df: DataFrame, columns: Sequence[str], halo: bool) -> DataFrame:
    return df.select(*columns, CHUNK, F.lit(halo).alias(HALO))


def with_previous_row(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    carried: Column | None = None,
    chunks: int | None = None,
) -> DataFrame:
    """Chunked rows plus, per chunk, the key's latest row from before that chunk.

    ``order`` starts with the column that is cut into chunks and must order the
    rows of a key totally. ``carried`` restricts which rows can become halo rows.
    Halo rows have ``_halo`` set and are to be dropped after the window step.
    """
    columns = df.columns
    chunked, split = _chunked(df, keys, order[0], chunks)
    if not split:
        return _tag(chunked, columns, False)
    row, position = F.struct(*columns), F.struct(*order)
    if carried is not None:
        position = F.when(carried, position)
    last = chunked.where(_HOT).groupBy(*keys, CHUNK).agg(F.max_by(row, position).alias("_row"))
    before = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    halo = (
        last.select(CHUNK, F.last("_row", ignorenulls=True).over(before).alias("_row"))
        .where(F.col("_row").isNotNull())
        .select("_row.*", CHUNK)
    )
    return _tag(chunked, columns, False).unionByName(_tag(halo, columns, True))


def with_previous_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], k: int, chunks: int | None = None
) -> DataFrame:
    """Like :func:`with_previous_row`, with the ``k`` latest earlier rows per chunk."""
    columns = df.columns
    chunked, split = _chunked(df, keys, order[0], chunks)
    if not split:
        return _tag(chunked, columns, False)
    newest = Window.partitionBy(*keys, CHUNK).orderBy(*[F.col(c).desc() for c in order])
    position = F.struct(*order)
    tail = (
        chunked.where(_HOT)
        .withColumn("_rn", F.row_number().over(newest))
        .where(F.col("_rn") <= k)
        .groupBy(*keys, CHUNK)
        .agg(F.collect_list(F.struct(position.alias("p"), F.struct(*columns).alias("r"))).alias("_rows"))
    )
    # Every chunk listed holds a row of its key, so k earlier chunks always suffice.
    before = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(-k, -1)
    halo = (
        tail.select(CHUNK, F.flatten(F.collect_list("_rows").over(before)).alias("_rows"))
        .select(CHUNK, F.explode(F.slice(F.reverse(F.sort_array("_rows")), 1, k)).alias("_r"))
        .select("_r.r.*", CHUNK)
    )
    return _tag(chunked, columns, False).unionByName(_tag(halo, columns, True))


def chunk_window(keys: Sequence[str], order: Sequence[str]):
    """Window over one ``(key, chunk)`` group, halo rows included."""
    return Window.partitionBy(*keys, CHUNK).orderBy(*order)


def grouped_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    fractions: dict[str, float],
    totals: dict[str, Column] | None = None,
    chunks: int | None = None,
) -> DataFrame:
    """Exact, linearly interpolated percentiles per group, and further ``totals``.

    Rows are first reduced to one per group and value, with its count, so a value that dominates a group
    counts once. Running counts in order of the values then tell which of them hold the ranks asked for; the formula is the
    same at every size. Of a group with too many values for a task the running counts begin
    from the counts of its chunks, and no task sees all of it. The result has
    ``keys``, one column per total (an aggregate that adds up over parts of a
    group) and one DOUBLE column per fraction name, for groups with a value.
    """
    totals = totals or {}
    names = list(totals)
    weighted = df.groupBy(*keys, value).agg(F.count(value).alias("_n"), *[t.alias(name) for name, t in totals.items()])
    # Where no group has too many rows, none has too many values.
    split = chunks is not None or bool(hot_keys(df, keys))
    chunked, split = _chunked(weighted, keys, value, chunks) if split else (weighted, False)
    if split:
        placed = _placed(chunked, keys, names)
        same = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in [*keys, CHUNK]]
        rows = chunked.alias("l").join(placed.alias("r"), same)
        rows = rows.select(*[F.col(f"l.{c}") for c in [*keys, CHUNK, value, "_n"]], *[F.col(f"r.{c}") for c in ["_before", "_total", *names]])
        groups = [*keys, CHUNK]
    else:
        whole = Window.partitionBy(*keys)
        sums = [F.sum(c).over(whole).alias(name) for name, c in {"_total": "_n", **{n: n for n in names}}.items()]
        rows = chunked.select(*keys, value, "_n", F.lit(0).cast("bigint").alias("_before"), *sums)
        groups = list(keys)
    upto = F.col("_before") + F.sum("_n").over(Window.partitionBy(*groups).orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    ranked = rows.withColumn("_upto", upto)

    def holds(rank: Column) -> Column:
        return (rank >= F.col("_upto") - F.col("_n")) & (rank < F.col("_upto"))

    wanted = [holds(r) for p in fractions.values() for r in (_low(p), _high(p))]
    hits = ranked.where((F.col("_n") > 0) & reduce(or_, wanted))
    out = []
    for name, p in fractions.items():
        at_low = F.max(F.when(holds(_low(p)), F.col(value).cast("double")))
        at_high = F.max(F.when(holds(_high(p)), F.col(value).cast("double")))
        share = F.max(F.lit(p) * (F.col("_total") - 1) - _low(p))
        out.append((at_low + (at_high - at_low) * share).alias(name))
    return hits.groupBy(*keys).agg(*[F.max(name).alias(name) for name in names], *out)


def _placed(chunked: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Per chunk of a group the count before it, and the group's count and totals."""
    counts = chunked.groupBy(*keys, CHUNK).agg(*[F.sum(c).alias(c) for c in ["_n", *names]])
    whole = Window.partitionBy(*keys)
    before = whole.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(
        *keys,
        CHUNK,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(whole).alias("_total"),
        *[F.sum(name).over(whole).alias(name) for name in names],
    )


def _low(p: float) -> Column:
    return F.floor(F.lit(p) * (F.col("_total") - 1)).cast("bigint")


def _high(p: float) -> Column:
    return F.ceil(F.lit(p) * (F.col("_total") - 1)).cast("bigint")
