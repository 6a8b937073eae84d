"""Product-quantised codes of vectors by exact integer k-means; dot products are limb-split float64 BLAS calls."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberscope.llm.common import stored

#: Integers are held within these bounds, so that they and their sums fit their columns.
LIMIT = 1 << 62
LONGEST = (1 << 63) - 1


@dataclass(frozen=True)
class Settings:
    """``entries`` a codebook, one codebook for each of ``parts`` equal parts, ``rounds`` of assignment and update."""

    parts: int = 16
    entries: int = 64
    rounds: int = 2
    scale: int = 256


def integers(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of finite numbers, exactly; beyond 2^62 on either side, that bound."""
    with np.errstate(over="ignore"):
        scaled = np.floor(values.astype(np.float64) * scale)
    return np.where(np.abs(scaled) < LIMIT, np.clip(scaled, -LIMIT, LIMIT), np.sign(scaled) * LIMIT).astype(np.int64)


def dots(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """x @ c.T of int64 matrices whose products fit 63 bits, through float64 BLAS.

    Numbers are cut into limbs short enough for all sums of limb products to stay below 2^53,
    where float64 is exact; the products are put together again in int64.
    """
    bits = (53 - int(x.shape[1]).bit_length()) // 2
    out = np.zeros((len(x), len(c)), np.int64)
    for i, a in enumerate(_limbs(x, bits)):
        for j, b in enumerate(_limbs(c, bits)):
            out += (a @ b.T).astype(np.int64) << np.int64(bits * (i + j))
    return out


def _limbs(values: np.ndarray, bits: int) -> list[np.ndarray]:
    """Limbs of ``bits`` bits, the last of which carries the sign, least first."""
    out = []
    while True:
        if not len(values) or max(int(values.max()), -int(values.min()) - 1) < 1 << (bits - 1):
            return [*out, values.astype(np.float64)]
        out.append((values & ((1 << bits) - 1)).astype(np.float64))
        values = values >> bits


def nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of ``x`` the first nearest row of ``c`` and its squared distance (Python's integers if 63 bits are too few)."""
    largest = max((int(v) for m in (x, c) if m.size for v in (m.max(), -int(m.min()))), default=0)
    if 4 * x.shape[1] * largest * largest >= LIMIT:
        x, c = x.astype(object), c.astype(object)
        far = np.array([((r - c) ** 2).sum(axis=1) for r in x], object).reshape(len(x), len(c))
    else:
        far = (x * x).sum(axis=1)[:, None] - 2 * dots(x, c) + (c * c).sum(axis=1)
    best = np.argmin(far, axis=1)
    return best, far[np.arange(len(x)), best]


def _batches(batches: Iterator[pa.RecordBatch], s: Settings) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray]]:
    """Rows of one length at a time, at most 4096, with their integers (rows, parts, length of a part)."""
    for batch in batches:
        vectors = batch.column("embedding")
        sizes = np.asarray(pc.list_value_length(vectors))
        for d in np.unique(sizes):
            for rows in np.array_split(np.flatnonzero(sizes == d), len(sizes) // 4096 + 1):
                some = batch.take(pa.array(rows))
                flat = some.column("embedding").flatten().to_numpy(zero_copy_only=False)
                yield int(d), some, integers(flat, s.scale).reshape(len(rows), s.parts, -1)


def _pulled(batches: Iterator[pa.RecordBatch], books: dict[int, np.ndarray], s: Settings) -> Iterator[pa.RecordBatch]:
    """Of each length, part and entry: the number and the sums of the parts assigned, as far as this task sees them."""
    sums = {d: np.zeros(b.shape, object) for d, b in books.items()}
    counts = {d: np.zeros(b.shape[:2], np.int64) for d, b in books.items()}
    for d, _, x in _batches(batches, s):
        for part, book in enumerate(books[d]):
            best, _ = nearest(x[:, part], book)
            order = np.argsort(best, kind="stable")
            used, begin, n = np.unique(best[order], return_index=True, return_counts=True)
            moved = x[order, part]
            if np.abs(moved.astype(np.float64)).max() * len(moved) >= LIMIT:
                moved = moved.astype(object)
            sums[d][part, used] += np.add.reduceat(moved, begin, axis=0)
            counts[d][part, used] += n
    rows = [(d, p, e, int(n), [str(v) for v in sums[d][p, e]]) for d in books for (p, e), n in np.ndenumerate(counts[d]) if n]
    yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows) if rows else [()] * 5, _PULLED, strict=True)], ["d", "part", "entry", "n", "sums"])


_PULLED = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()))


def train(vectors: DataFrame, s: Settings = Settings()) -> dict[int, np.ndarray]:
    """The codebooks of each length of vector in ``vectors`` (see ``usable``): (parts, entries, length of a part), int64.

    They start as the vectors with the smallest vec_ids (nulls last, then by components) of that length. A round
    brings one row an entry to the driver; sums are added up in tasks first. An entry that nothing is assigned to stays.
    """
    lengths = [r["d"] for r in vectors.groupBy(F.size("embedding").alias("d")).count().orderBy("d").collect()]
    books = {}
    for d in lengths:
        start = vectors.where(F.size("embedding") == d).orderBy(F.col("vec_id").asc_nulls_last(), "embedding").select("embedding").limit(s.entries).collect()
        rows = integers(np.array([r["embedding"] for r in start], np.float64), s.scale)
        books[d] = np.ascontiguousarray(rows.reshape(len(rows), s.parts, -1).swapaxes(0, 1))
    for _ in range(s.rounds if books else 0):
        pulled = vectors.select("embedding").mapInArrow(lambda batches: _pulled(batches, books, s), "d long, part long, entry long, n long, sums array<string>")
        pulled = pulled.select("d", "part", "entry", "n", F.posexplode("sums").alias("i", "v")).groupBy("d", "part", "entry", "i")
        moved = {d: b.copy() for d, b in books.items()}
        for r in pulled.agg(F.sum("n").alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).toLocalIterator():
            moved[r["d"]][r["part"], r["entry"], r["i"]] = int(r["v"]) // r["n"]
        books = moved
    return books


def usable(embeddings: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Rows whose vector is there, all numbers in it being finite, and can be cut into ``parts`` equal parts."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return embeddings.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & (F.size("embedding") % s.parts == 0)).where(finite)


def fingerprint(books: dict[int, np.ndarray]) -> dict[int, str]:
    return {d: hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest() for d, book in books.items()}


def encode(vectors: DataFrame, books: dict[int, np.ndarray], s: Settings = Settings()) -> DataFrame:
    """Add ``codes`` (an index a part) and ``error`` (squared distances added up; beyond 63 bits the largest long) to every row."""
    vectors = vectors.drop("codes", "error")
    names = vectors.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in vectors.schema)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for d, rows, x in _batches(batches, s):
            found = [nearest(x[:, part], book) for part, book in enumerate(books[d])]
            codes = np.column_stack([best for best, _ in found]).astype(np.int32)
            far = np.column_stack([far for _, far in found])
            if far.dtype == object or far.astype(np.float64).sum(axis=1).max(initial=0) >= LIMIT:
                error = [min(sum(map(int, row)), LONGEST) for row in far]
            else:
                error = far.sum(axis=1)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(codes.ravel()), s.parts).cast(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*(rows.column(n) for n in names), lists, pa.array(error, pa.int64())], [*names, "codes", "error"])

    return vectors.mapInArrow(coded, f"{schema}, codes array<int>, error long")


def compress(embeddings: DataFrame, s: Settings = Settings()) -> DataFrame:
    """vec_id, code (two hex digits a part), error, label_error and codebooks_sha256 of every usable row.

    Null vectors, vectors with null or non-finite numbers, and such as cannot be cut into ``parts`` equal parts (empty
    ones among them) are dropped. Vectors of another length have codebooks, and a codebooks_sha256, of their own. With fewer
    vectors than entries, each starts one; equal vectors may start several, of which the first wins. Repeated rows, null ids and null
    labels (one label together) give a row each. label_error adds up over all lengths; beyond 63 bits it is the largest long.
    """
    rows = usable(embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", "label"), s)
    books = train(rows, s)
    out = stored(encode(rows, books, s).withColumn("d", F.size("embedding")).drop("embedding"), "vector-codes")
    whole = F.sum(F.col("error").cast("decimal(38,0)"))
    total = out.groupBy(F.col("label").alias("of")).agg(F.least(whole, F.lit(LONGEST).cast("decimal(38,0)")).cast("long").alias("label_error"))
    prints = fingerprint(books)
    sha = F.coalesce(*(F.when(F.col("d") == d, F.lit(v)) for d, v in prints.items()), F.lit("")) if prints else F.lit("")
    out = out.join(total, F.col("label").eqNullSafe(F.col("of")))
    code = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    return out.select("vec_id", code.alias("code"), "error", "label_error", sha.alias("codebooks_sha256"))
