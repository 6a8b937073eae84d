"""Near-duplicate documents: MinHash bands propose, odd sketches sift, full shingle sets confirm."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberscope.llm.common import lean, mix, shingles, steps, stored, utf8, word_hashes, word_spans
from emberscope.llm.components import components


#: Buckets of up to so many members meet in a join, larger ones in blocks; the result is the same.
SMALL = 32


@dataclass(frozen=True)
class Settings:
    """``numerator`` / 100 is the least similarity of a link.

    ``bands`` bands of ``rows`` samples propose pairs: at a similarity of 0.85 a pair is
    missed by all of 32 bands of 5 with a chance of 7e-9, at 0.8 of 3e-6. ``samples``
    MinHash samples are folded into a parity bitmap of ``bits`` bits.
    ``sigmas``: how many deviations below the expected similarity a sketch may lie before
    its pair is put aside. ``block``: rows of one bucket that one task compares.
    """

    width: int = 5
    numerator: int = 80
    samples: int = 256
    bands: int = 32
    rows: int = 5
    bits: int = 1024
    sigmas: float = 5.5
    block: int = 512

    def most_apart(self) -> int:
        """The largest number of unequal parity bits that a linked pair may be expected to have."""
        unlike = 1 - self.numerator / 100
        differ = self.samples * unlike + self.sigmas * np.sqrt(self.samples * unlike * (1 - unlike))
        expected = self.bits / 2 * (1 - np.exp(-4 * min(differ, self.samples) / self.bits))
        return int(np.ceil(expected + self.sigmas * np.sqrt(expected) / 2))


_RANDOM = np.random.default_rng(11).integers(1, 1 << 32, (2, 4096), dtype=np.uint64).astype(np.uint32)


def samples(shingle: np.ndarray, k: int) -> np.ndarray:
    """``k`` MinHash samples (unsigned 32-bit) of a set of 64-bit hashes that isn't empty."""
    low = (shingle >> np.uint64(32)).astype(np.uint32)
    out = np.full(k, np.uint32(0xFFFFFFFF))
    factor, shift = _RANDOM[0, :k, None] | np.uint32(1), _RANDOM[1, :k, None]
    for at in range(0, len(low), 1024):
        np.minimum(out, (low[None, at : at + 1024] * factor ^ shift).min(axis=1), out=out)
    return out


def odd_sketch(sample: np.ndarray, bits: int) -> bytes:
    """Parity bitmap: every (place, sample) flips one bit, so what two texts share cancels in their XOR."""
    where = mix(np.arange(len(sample), dtype=np.uint64) << np.uint64(32) | sample) % np.uint64(bits)
    return np.packbits(np.bincount(where.astype(np.int64), minlength=bits) & 1).tobytes()


def text_shingles(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    raw, bounds = utf8(texts)
    starts, rows = word_spans(raw, bounds)
    hashes = word_hashes(raw, starts)
    cuts = np.searchsorted(rows, np.arange(len(texts) + 1))
    for i in range(len(texts)):
        yield shingles(hashes[cuts[i] : cuts[i + 1]], width)


def signatures(docs: DataFrame, s: Settings) -> DataFrame:
    """doc_id, n_shingles, two 64-bit digests of the set, its band keys and its odd sketch (null if the set is empty)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, "text"):
                rows = []
                for found in text_shingles(part.column("text"), s.width):
                    if not len(found):
                        rows.append((0, None, None, None, None))
                        continue
                    sample = samples(found, s.samples)
                    banded = sample[: s.bands * s.rows].astype(np.uint64).reshape(s.bands, s.rows)
                    keys = np.arange(1, s.bands + 1, dtype=np.uint64)
                    for j in range(s.rows):
                        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + banded[:, j])
                    digest = found.sum(dtype=np.uint64), np.bitwise_xor.reduce(mix(found ^ np.uint64(0x5851F42D4C957F2D)))
                    rows.append((len(found), int(digest[0].astype(np.int64)), int(digest[1].astype(np.int64)), keys.view(np.int64), odd_sketch(sample, s.bits)))
                n, d1, d2, keys, sketch = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(sketch, pa.binary())],
                    ["doc_id", "n_shingles", "d1", "d2", "keys", "sketch"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lean(sign), "doc_id long, n_shingles long, d1 long, d2 long, keys array<long>, sketch binary")


def similar(a: np.ndarray, b: np.ndarray, numerator: int) -> bool:
    """Whether two sorted sets of hashes are as similar as a link asks."""
    same = len(np.intersect1d(a, b, assume_unique=True))
    return bool(same and 100 * same >= numerator * (len(a) + len(b) - same))


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


def _sketches(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint64).reshape(len(column), -1)


def sift(pairs: DataFrame, sets: DataFrame, s: Settings) -> DataFrame:
    """Of pairs (a, b), those whose sizes and sketches allow a link."""
    side = lambda x: sets.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    both = both.where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * s.numerator)
    limit = s.most_apart()

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                apart = _apart(*(_sketches(batch.column(c).to_pylist()) for c in ("s_a", "s_b")))
                yield batch.select(["a", "b"]).filter(pa.array(apart <= limit))

    return both.select("a", "b", "s_a", "s_b").mapInArrow(lean(near), "a long, b long")


def confirm(pairs: DataFrame, docs: DataFrame, s: Settings) -> DataFrame:
    """Of pairs (a, b), those whose full shingle sets are similar enough.

    Every pair carries both whole texts to one row of one task; sorting by ``a`` lets a task
    shingle a text that many pairs share once.
    """
    side = lambda x: docs.select(F.col("doc_id").alias(x), F.col("text").alias(f"t_{x}"))
    both = pairs.join(side("b"), "b").join(side("a"), "a")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None
        for batch in batches:
            for part in steps(batch, "t_b"):
                keep = []
                firsts = part.column("a").to_pylist()
                for i, other in enumerate(text_shingles(part.column("t_b"), s.width)):
                    if firsts[i] != last:
                        last = firsts[i]
                        held = next(text_shingles(part.column("t_a").slice(i, 1), s.width))
                    keep.append(similar(held, other, s.numerator))
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "t_a", "t_b").sortWithinPartitions("a").mapInArrow(lean(check), "a long, b long")


def residue(buckets: DataFrame, known: DataFrame) -> DataFrame:
    """Members of those buckets (key, id) that still hold several components, with bucket sizes.

    Adds c (the member's component), big (the bucket's largest), m and top (members of
    the bucket and of its largest component).
    """
    rows = buckets.join(known, "id", "left").select("key", "id", F.coalesce("component", "id").alias("c"))
    sizes = rows.groupBy("key", "c").agg(F.count("*").alias("m"))
    sizes = sizes.groupBy("key").agg(F.max(F.struct("m", "c")).alias("t"), F.sum("m").alias("m"), F.count("*").alias("k"))
    sizes = sizes.where("k > 1").select("key", "m", F.col("t.m").alias("top"), F.col("t.c").alias("big"))
    return rows.join(sizes, "key")


def few_pairs(rows: DataFrame) -> DataFrame:
    """Pairs of different components in small buckets."""
    few = rows.where(F.col("m") <= SMALL)
    other = few.select("key", F.col("id").alias("b"), F.col("c").alias("c_b"))
    return few.select("key", F.col("id").alias("a"), "c").join(other, "key").where("a < b AND c <> c_b").select("a", "b").distinct()


def many_links(rows: DataFrame, sets: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """Links between components in large buckets, confirmed on full sets.

    Members outside the bucket's largest component meet all members, in blocks of
    ``s.block`` by ``s.block``; a task holds two blocks. A pair is looked at in the first
    band that it shares, if its sketches are near, and only until its components are
    joined, so a task returns fewer links than it holds components.
    """
    rows = rows.where(F.col("m") > SMALL).withColumn("h", F.xxhash64("id"))
    rows = rows.withColumn("blocks", F.ceil(F.col("m") / s.block).cast("int")).withColumn("probes", F.ceil((F.col("m") - F.col("top")) / s.block).cast("int"))
    base = rows.select("*", F.pmod("h", "blocks").alias("x"), F.explode(F.sequence(F.lit(0), F.col("probes") - 1)).alias("y"), F.lit(False).alias("probe"))
    probe = rows.where("c <> big").select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("x"), F.pmod("h", "probes").alias("y"), F.lit(True).alias("probe"))
    both = base.union(probe).select("key", "x", "y", "probe", "id", "c", "big")
    both = both.join(sets, "id").join(texts.withColumnRenamed("doc_id", "id"), "id")
    limit = s.most_apart()

    def meet(frame: pd.DataFrame) -> pd.DataFrame:
        left, right = frame[frame.probe], frame[~frame.probe]
        found, held, joined = [], {}, {}

        def full(at: int) -> np.ndarray:
            if at not in held:
                held[at] = next(text_shingles(pa.array([frame.text[at]], pa.string()), s.width))
            return held[at]

        def root(c: int) -> int:
            while joined.get(c, c) != c:
                c = joined[c]
            return c

        if len(left) and len(right):
            sketches, keys = _sketches(right.sketch.tolist()), np.array(right["keys"].tolist())
            ids, comps, n, at = right.id.to_numpy(), right.c.to_numpy(), right.n.to_numpy(), right.index.to_numpy()
            outside = comps != right.big.iloc[0]
            here = frame.key.iloc[0]
            for i, c, m, sketch, key, mine in zip(left.id, left.c, left.n, _sketches(left.sketch.tolist()), left["keys"], left.index, strict=True):
                ok = (comps != c) & (~outside | (ids > i)) & (np.minimum(n, m) * 100 >= np.maximum(n, m) * s.numerator)
                ok[ok] = _apart(sketches[ok], sketch) <= limit
                where = np.flatnonzero(ok)
                where = where[key[np.argmax(keys[where] == np.asarray(key), axis=1)] == here] if len(where) else where
                for j in where:
                    if (u := root(c)) != (v := root(comps[j])) and similar(full(mine), full(at[j]), s.numerator):
                        joined[u] = v
                        found.append((min(i, ids[j]), max(i, ids[j])))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return both.groupBy("key", "x", "y").applyInPandas(meet, "a long, b long")


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, any others): doc_id, n_shingles, component_id, kept.

    component_id is the smallest doc_id reachable over links, kept marks it. Texts that
    are null or without words have n_shingles 0 and stand alone. Equal sets, however many, are one
    class. Rows that repeat a doc_id get a row each, and count as linked; rows whose doc_id is
    null stand alone with component_id null and kept true. No rows give no rows.

    Within a bucket of a band every class is compared with the smallest id there, which
    joins groups of copies in linear work; buckets that then still hold several components
    are compared in blocks. So a pair in any common bucket is either confirmed, refuted
    or already connected.
    """
    s = settings
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = stored(signatures(docs, s), "signatures")
    full = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = full.groupBy("d1", "d2", "n_shingles").agg(F.min("doc_id").alias("id"))
    members = full.select("doc_id", "d1", "d2", "n_shingles").join(classes, ["d1", "d2", "n_shingles"])
    members = stored(members.select("doc_id", "id").distinct(), "members")
    one = members.groupBy("doc_id").agg(F.min("id").alias("id"), F.max("id").alias("_other"))
    twice = members.join(one.where("id <> _other").select("doc_id", F.col("id").alias("a")), "doc_id").select("a", F.col("id").alias("b"))
    sets = full.select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "sketch", "keys", "d1", "d2")
    sets = sets.join(members.where("doc_id = id").select("id"), "id", "left_semi").dropDuplicates(["id", "d1", "d2"])
    keys = sets.select("id", F.explode("keys").alias("key"))
    shared = keys.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first <> last")
    banded = stored(keys.join(shared.select("key", "first"), "key"), "banded")
    texts = stored(docs.join(banded.select(F.col("id").alias("doc_id")).distinct(), "doc_id", "left_semi"), "texts")
    sets = sets.select("id", "n", "sketch", "keys")
    star = banded.where("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b")).distinct()
    links = stored(confirm(sift(star, sets.drop("keys"), s), texts, s), "links")
    known = stored(components(links), "components")
    left = stored(residue(banded.select("key", "id"), known), "residue")
    few = confirm(sift(few_pairs(left).join(star, ["a", "b"], "left_anti"), sets.drop("keys"), s), texts, s)
    more = stored(few.union(many_links(left, sets, texts, s)), "links")
    known = components(links.union(more).union(twice))
    own = one.select("doc_id", "id").join(known, "id", "left").select("doc_id", F.coalesce("component", "id").alias("component_id"))
    out = signed.select("doc_id", "n_shingles").join(own, "doc_id", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))
