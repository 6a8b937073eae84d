"""Near-duplicate vectors: structured random filters, each a cap of the sphere, that similar vectors share."""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberscope.llm.common import mix, stored
from emberscope.llm.components import components


@dataclass(frozen=True)
class Settings:
    """``cosine`` and more links two vectors.

    A filter is one codeword a part of the (rotated) vector, its direction their concatenation. A
    vector passes all filters that come within a margin of its highest one. The margin is such that
    ``filters`` are passed in a code on average; codes, each with a rotation of its own, are added until a random pair
    at ``cosine`` shares no filter with a chance of ``miss``. ``spread`` filters a vector are laid
    out, so that filters, and with them codes, grow with the rows and chance meetings don't.
    Buckets of up to ``small`` meet in a join, larger ones in blocks of ``block``; the
    result is the same.
    """

    cosine: float = 0.9
    miss: float = 1e-4
    filters: int = 12
    spread: int = 4
    small: int = 32
    block: int = 512
    seed: int = 5


@dataclass(frozen=True)
class Code:
    """Random product code for vectors of ``dim`` numbers: ``words`` codewords in each of ``parts`` parts."""

    dim: int
    parts: int
    words: int
    seed: int

    @functools.cached_property
    def books(self) -> list[np.ndarray]:
        draw = np.random.default_rng([self.seed, self.dim, self.words])
        out = [draw.normal(size=(len(p), self.words)) for p in np.array_split(np.arange(self.dim), self.parts)]
        return [b / np.linalg.norm(b, axis=0) for b in out]

    @functools.cached_property
    def turn(self) -> np.ndarray:
        return np.linalg.qr(np.random.default_rng([self.seed, self.dim]).normal(size=(self.dim, self.dim)))[0]

    def decode(self, unit: np.ndarray, margin: float) -> tuple[np.ndarray, np.ndarray]:
        """All filters within ``margin`` of each vector's highest: row numbers, ascending, and filter numbers.

        Part by part, a list goes on as long as the best words of the parts to come could still lift it there.
        """
        turned = unit @ self.turn
        row, lost, code = np.arange(len(unit)), np.zeros(len(unit)), np.zeros(len(unit), np.uint64)
        at = 0
        for book in self.books:
            score = turned[:, at : at + len(book)] @ book
            at += len(book)
            below = lost[:, None] + (score.max(axis=1, keepdims=True) - score)[row]
            i, word = np.nonzero(below <= margin)
            row, lost, code = row[i], below[i, word], code[i] * np.uint64(self.words) + word.astype(np.uint64)
        return row, code

    def chunk(self) -> int:
        """Vectors to decode at once, so that lists stay small."""
        return max(4, (1 << 14) // self.words)


@functools.lru_cache(maxsize=64)
def _code(dim: int, parts: int, words: int, seed: int) -> Code:
    return Code(dim, parts, words, seed)


def shape(dim: int, n: int, s: Settings) -> tuple[int, int]:
    """Parts and words of the codes for ``n`` vectors of ``dim`` numbers; parts of under four numbers tell too little."""
    wanted = max(n, 1) * s.spread
    if dim >= 12:
        return 3, max(16, round(wanted ** (1 / 3)))
    return 1, max(4, min(wanted, 4096, 4**dim))


def pairs_at(cosine: float, dim: int, n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Random pairs of unit vectors with one cosine; in one dimension equal ones."""
    draw = np.random.default_rng([seed, dim])
    x = units(draw.normal(size=(n, dim)))
    if dim == 1:
        return x, x
    z = draw.normal(size=(n, dim))
    z = units(z - np.sum(z * x, axis=1, keepdims=True) * x)
    return x, cosine * x + np.sqrt(1 - cosine * cosine) * z


def meeting(code: Code, x: np.ndarray, y: np.ndarray, margin: float) -> np.ndarray:
    """Which pairs of rows share a filter."""
    out, step = np.zeros(len(x), bool), code.chunk()
    for at in range(0, len(x), step):
        (i, a), (j, b) = code.decode(x[at : at + step], margin), code.decode(y[at : at + step], margin)
        both = set(zip(i.tolist(), a.tolist(), strict=True)) & set(zip(j.tolist(), b.tolist(), strict=True))
        out[[at + row for row, _ in both]] = True
    return out


def plan(dim: int, n: int, s: Settings) -> tuple[float, int]:
    """Margin and number of codes for ``n`` vectors of ``dim`` numbers, found on random pairs, whatever the data.

    The margin is widened where a code would bring under a quarter of the pairs together.
    """
    code = _code(dim, *shape(dim, n, s), s.seed)
    x, y = pairs_at(s.cosine, dim, 400, s.seed)
    margin, step = 0.01, code.chunk()
    while sum(len(code.decode(x[at : at + step], margin)[0]) for at in range(0, len(x), step)) < min(s.filters, code.words**code.parts) * len(x):
        margin *= 1.1
    while (apart := 1 - meeting(code, x, y, margin).mean()) > 0.75:
        margin *= 1.1
    return margin, int(np.ceil(np.log(s.miss) / np.log(apart + 0.02)))


def usable(vector: str = "embedding") -> Column:
    """Whether a vector can be compared: there, finite, not zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0)


def matrix(column: pa.Array) -> np.ndarray:
    """A list column, all lists of one length, in double precision."""
    flat = np.asarray(column.flatten(), dtype=np.float64)
    return flat.reshape(len(column), -1)


def units(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=1, keepdims=True)  # so that squares neither vanish nor overflow
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def linked(a: np.ndarray, b: np.ndarray, cosine: float) -> np.ndarray:
    """Which rows of two blocks of unit vectors are near; those at the border are summed once more in a fixed order."""
    near = a @ b.T
    out = near >= cosine
    for i, j in np.argwhere(np.abs(near - cosine) < 1e-12):
        out[i, j] = np.sum(a[i] * b[j]) >= cosine
    return out


def _plans(rows: DataFrame, n: int, s: Settings) -> DataFrame:
    """dim, margin, codes for each length of vectors; one task decides for all."""

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(dim, *plan(dim, n, s)) for dim in batch.column("dim").to_pylist()]
            yield pa.RecordBatch.from_pylist([dict(zip(("dim", "margin", "codes"), f, strict=True)) for f in found], pa.schema({"dim": pa.int32(), "margin": pa.float64(), "codes": pa.int32()}))

    return rows.select(F.size("v").alias("dim")).distinct().mapInArrow(decide, "dim int, margin double, codes int")


def _filters(rows: DataFrame, n: int, s: Settings) -> DataFrame:
    """id and key for each filter that a vector passes; keys of other vector lengths differ."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ids = batch.column("dim").to_numpy(), batch.column("id").to_numpy()
            for dim in np.unique(sizes).tolist():
                which = np.flatnonzero(sizes == dim)
                margin, codes = (batch.column(c)[int(which[0])].as_py() for c in ("margin", "codes"))
                made = [_code(dim, *shape(dim, n, s), s.seed + k) for k in range(codes)]
                for at in range(0, len(which), made[0].chunk()):
                    some = which[at : at + made[0].chunk()]
                    unit = units(matrix(batch.column("v").take(pa.array(some))))
                    for k, code in enumerate(made):
                        row, found = code.decode(unit, margin)
                        keys = mix(found * np.uint64(0x9E3779B97F4A7C15) + np.uint64(dim * 1024 + k)).view(np.int64)
                        yield pa.RecordBatch.from_arrays([pa.array(ids[some[row]]), pa.array(keys)], ["id", "key"])

    plans = stored(_plans(rows, n, s), "plans")
    planned = rows.select("id", "v", F.size("v").alias("dim")).join(plans, "dim")
    return planned.mapInArrow(decode, "id long, key long")


def _small(keys: DataFrame, rows: DataFrame, s: Settings) -> DataFrame:
    """Links (a, b, w_a, w_b) found in small buckets and in no large one."""
    few = keys.where(F.col("m") <= s.small).select("key", "id")
    pairs = few.select("key", F.col("id").alias("a")).join(few.select("key", F.col("id").alias("b")), "key").where("a < b").select("a", "b").distinct()
    side = lambda x: rows.select(F.col("id").alias(x), F.col("v").alias(f"v_{x}"), F.col("w").alias(f"w_{x}"), F.col("large").alias(f"l_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").where("size(v_a) = size(v_b) AND NOT arrays_overlap(l_a, l_b)")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.asarray(batch.column("v_a").value_lengths())
            for dim in np.unique(sizes):
                some = batch.filter(pa.array(sizes == dim))
                near = np.sum(units(matrix(some.column("v_a"))) * units(matrix(some.column("v_b"))), axis=1)
                yield some.select(["a", "b", "w_a", "w_b"]).filter(pa.array(near >= s.cosine))

    return both.select("a", "b", "w_a", "w_b", "v_a", "v_b").mapInArrow(check, "a long, b long, w_a long, w_b long")


def _large(keys: DataFrame, rows: DataFrame, s: Settings) -> DataFrame:
    """From large buckets: (a, n, b), n being weights of vectors newly linked with a, and b the least id joined to it.

    Two blocks of a bucket meet in a task, which returns one row a member. A pair counts in the
    first large bucket that it shares.
    """
    big = keys.where(F.col("m") > s.small).select("key", "id", F.ceil(F.col("m") / s.block).cast("int").alias("k"))
    big = big.withColumn("x", F.pmod(F.xxhash64("id"), "k"))
    ranged = F.explode(F.transform(F.sequence(F.lit(0), F.col("k") - 1), lambda y: F.struct(F.least("x", y).alias("lo"), F.greatest("x", y).alias("hi"))))
    big = big.select("key", "id", "x", ranged.alias("p")).select("key", "id", "x", "p.lo", "p.hi").join(rows.where("size(large) > 0"), "id")

    def meet(frame: pd.DataFrame) -> pd.DataFrame:
        key, lo, hi = int(frame.key.iloc[0]), frame.lo.iloc[0], frame.hi.iloc[0]
        out = []
        for _, same in frame.groupby(frame.v.str.len()):
            left, right = same[same.x == lo], same[same.x == hi]
            if not (len(left) and len(right)):
                continue
            a, b = (units(np.stack(f.v.to_numpy()).astype(np.float64)) for f in (left, right))
            near = linked(a, b, s.cosine)
            i, j = left.id.to_numpy(), right.id.to_numpy()
            near &= i[:, None] != j[None, :]
            labels = [i.copy(), j.copy()]
            while True:
                u = np.minimum(labels[0], np.where(near, labels[1][None, :], np.iinfo(np.int64).max).min(axis=1))
                v = np.minimum(labels[1], np.where(near, u[:, None], np.iinfo(np.int64).max).min(axis=0))
                if (u == labels[0]).all() and (v == labels[1]).all():
                    break
                labels = [u, v]
            earlier = sorted({k for f in (left, right) for large in f.large for k in large if k < key})
            if earlier:
                place = {k: n for n, k in enumerate(earlier)}
                held = []
                for f in (left, right):
                    m = np.zeros((len(f), len(earlier)), np.float32)
                    for r, large in enumerate(f.large):
                        m[r, [place[k] for k in large if k < key]] = 1
                    held.append(m)
                new = near & (held[0] @ held[1].T == 0)
            else:
                new = near
            out.append(np.column_stack([i, new @ right.w.to_numpy(), labels[0]]))
            if lo != hi:
                out.append(np.column_stack([j, new.T @ left.w.to_numpy(), labels[1]]))
        return pd.DataFrame(np.concatenate(out) if out else np.empty((0, 3), np.int64), columns=["a", "n", "b"])

    return big.groupBy("key", "lo", "hi").applyInPandas(meet, "a long, n long, b long")


def near_vectors(vectors: DataFrame, s: Settings = Settings()) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding, any others): vec_id, n_links, component_id, kept.

    Vectors of equal length at a cosine of at least ``s.cosine`` are linked. Null, zero or non-finite vectors, and
    rows without an id, link with nothing. Equal vectors are one class whose weight counts, so
    that copies, however many, are never paired; rows repeating an id count as vectors of
    their own. A class is named by a 64-bit hash of its digest. n_links counts every link found once. Candidates come from shared filters only.
    """
    digest = [F.xxhash64("embedding").alias("d1"), F.xxhash64(F.lit(1), "embedding").alias("d2")]
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>").alias("embedding"))
    rows = rows.withColumn("ok", F.col("vec_id").isNotNull() & F.coalesce(usable(), F.lit(False)))
    good = rows.where("ok").select("vec_id", "embedding", *digest)
    classes = good.groupBy("d1", "d2").agg(F.min("vec_id").alias("least"), F.count("*").alias("w"))
    classes = stored(classes.withColumn("id", F.xxhash64("d1", "d2")), "classes")
    heads = good.join(classes, ["d1", "d2"]).where("vec_id = least").select("id", F.col("embedding").alias("v"), "w").dropDuplicates(["id"])
    heads = stored(heads, "heads")
    n = max(heads.count(), 1)
    keys = stored(_filters(heads, n, s), "filters")
    sizes = keys.groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
    keys = stored(keys.join(sizes, "key"), "buckets")
    large = keys.where(F.col("m") > s.small).groupBy("id").agg(F.array_sort(F.collect_list("key")).alias("large"))
    heads = stored(heads.join(large, "id", "left").withColumn("large", F.coalesce("large", F.array().cast("array<long>"))), "heads")
    few = stored(_small(keys, heads, s), "links")
    many = stored(_large(keys, heads, s), "links")
    counts = few.select(F.col("a").alias("id"), F.col("w_b").alias("n")).union(few.select("b", "w_a")).union(many.select("a", "n"))
    counts = counts.groupBy("id").agg(F.sum("n").alias("n"))
    known = components(few.select("a", "b").union(many.select("a", "b")))
    found = classes.join(counts, "id", "left").join(known, "id", "left").withColumn("component", F.coalesce("component", "id"))
    first = found.groupBy("component").agg(F.min("least").alias("component_id"))
    found = found.join(first, "component").select("d1", "d2", (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("n_links"), "component_id")
    out = rows.select("vec_id", F.when(F.col("ok"), digest[0]).alias("d1"), F.when(F.col("ok"), digest[1]).alias("d2")).join(found, ["d1", "d2"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))
