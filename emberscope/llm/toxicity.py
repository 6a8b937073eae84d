"""Toxicity score of a text by a factorisation machine over hashed terms."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberscope.llm.common import crc_fold, mix, steps, stored, utf8, word_hashes, word_spans


@dataclass(frozen=True)
class Settings:
    """``sample`` labelled rows at most are learned from, their texts whole.

    Of the terms those are kept that ``least_rows`` of these rows hold and whose share differs between
    the labels by ``sigmas`` standard deviations; the rest would only add noise to long texts.
    """

    buckets: int = 1 << 20
    stems: tuple[int, ...] = (4, 5, 6)
    factors: int = 4
    sample: int = 12000
    least_rows: int = 3
    sigmas: float = 3.0
    rounds: int = 20
    batch: int = 256
    rate: float = 0.1
    decay: float = 1e-4
    seed: int = 5
    threshold: float = 0.3


# Terms are runs of ASCII letters, digits, apostrophes and bytes of other scripts; all else parts them.
_TERM = np.full(256, 0x20, np.uint8)
_TERM[128:] = np.arange(128, 256)
for _sign in b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789'":
    _TERM[_sign] = _sign
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)


def terms(texts: pa.Array, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all terms of the texts, in no order, and the row of each.

    A word gives itself and its first letters, as insults are inflected.
    """
    raw, bounds = utf8(texts)
    raw = _TERM[raw]
    starts, rows = word_spans(raw, bounds)
    hashes, of = [word_hashes(raw, starts)], [rows]
    stem, whole = np.zeros(len(starts), np.uint64), np.ones(len(starts), bool)
    for place in range(max(s.stems, default=0)):
        at = starts + place
        letter = raw[np.minimum(at, len(raw) - 1)]
        whole &= (letter != 0x20) & (at < len(raw))
        stem = mix(stem + _LOWER[letter] + np.uint64(1))
        if place + 1 in s.stems:
            hashes.append(stem[whole])
            of.append(rows[whole])
    return (np.concatenate(hashes) % np.uint64(s.buckets)).astype(np.int64), np.concatenate(of)


def _by_rows(bucket: np.ndarray, row: np.ndarray, n: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets row after row, and where each of the ``n`` rows begins."""
    cells = np.unique(row * width + bucket)
    return cells % width, np.searchsorted(cells, np.arange(n + 1) * width)


@dataclass
class Machine:
    """y = bias + sum of w + half the sum over factors of (sum of v)^2 - sum of v^2, over the known terms present.

    By that identity all pairs of terms are weighed in time linear in their number.
    """

    bias: float
    known: np.ndarray
    linear: np.ndarray
    factors: np.ndarray

    def logits(self, at: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of every row of places among the known terms: the logit and its sums of factors."""
        sums = _sums(np.column_stack([self.linear[at], self.factors[at], (self.factors**2).sum(axis=1)[at]]), bounds)
        crossed = sums[:, 1:-1]
        return self.bias + sums[:, 0] + 0.5 * ((crossed**2).sum(axis=1) - sums[:, -1]), crossed

    def places(self, bucket: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.known):
            return np.empty(0, np.int64), np.zeros(n + 1, np.int64)
        at = np.minimum(np.searchsorted(self.known, bucket), len(self.known) - 1)
        found = self.known[at] == bucket
        return _by_rows(at[found], row[found], n, len(self.known))

    def scores(self, texts: pa.Array, s: Settings) -> np.ndarray:
        return _sigmoid(self.logits(*self.places(*terms(texts, s), len(texts)))[0])


def _sigmoid(y: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(y, -30, 30)))


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of the rows of ``values`` between bounds; nothing between them sums to nought."""
    out = np.zeros((len(bounds) - 1, values.shape[1]))
    some = np.flatnonzero(bounds[:-1] < bounds[1:])
    if len(some):
        out[some] = np.add.reduceat(values, bounds[some], axis=0)
    return out


def fit(known: np.ndarray, rows: list[np.ndarray], y: np.ndarray, s: Settings) -> Machine:
    """Logistic loss by AdaGrad on small batches. Without rows, or with one class, the score is the share of label 1.

    ``rows``: of each text the places of its terms in ``known``; ``y``: labels, 0 to 1.
    """
    draw = np.random.default_rng(s.seed)
    share, size = (y.sum() + 1) / (len(y) + 2), len(known)
    m = Machine(float(np.log(share / (1 - share))), known, np.zeros(size), draw.normal(0, 0.02, (size, s.factors)))
    seen = [np.full(1, 1e-2), np.full(size, 1e-2), np.full((size, s.factors), 1e-2)]
    for _ in range(s.rounds if size else 0):
        order = draw.permutation(len(y))
        for first in range(0, len(y), s.batch):
            picked = order[first : first + s.batch]
            at, bounds = np.concatenate([rows[i] for i in picked]), np.cumsum([0, *(len(rows[i]) for i in picked)])
            logit, crossed = m.logits(at, bounds)
            error = (_sigmoid(logit) - y[picked]) / len(picked)
            each = np.repeat(error, np.diff(bounds))
            apart = np.repeat(crossed, np.diff(bounds), axis=0) - m.factors[at]
            pairs = [np.bincount(at, each * apart[:, k], size) for k in range(s.factors)]
            pulls = [np.array([error.sum()]), np.bincount(at, each, size) + s.decay * m.linear, np.array(pairs).reshape(s.factors, size).T + s.decay * m.factors]
            for total, pull in zip(seen, pulls, strict=True):
                total += pull**2
                pull *= s.rate / np.sqrt(total)
            m.bias -= float(pulls[0][0])
            m.linear -= pulls[1]
            m.factors -= pulls[2]
    return m


def learn(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> Machine:
    """Fit on a bounded sample, by hash, of rows of ``docs`` (doc_id, text) that ``labels`` (doc_id, toxic) marks 0 or 1.

    Held-out ids (crc32 remainder 2 by 4) are never read. Several labels of one document count by their
    mean, several texts of one id by the least. Terms are counted in tasks; the driver sees only the places of known ones.
    """
    marked = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(crc_fold() != 2).groupBy("doc_id").agg(F.avg("toxic").alias("y"))
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(s.sample)  # so many rows at most, hence the broadcast
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("y").alias("y"))
    sample = stored(rows.mapInArrow(lambda batches: _counted(batches, s), "doc_id long, y double, terms array<int>"), "toxic-terms")
    known = np.sort(_telling(sample, s).toArrow().column("term").to_numpy().astype(np.int64))
    found = sample.mapInArrow(lambda batches: _placed(batches, known), "doc_id long, y double, at array<int>").toArrow().sort_by("doc_id")
    places = [np.asarray(at, np.int64) for at in found.column("at").to_pylist()]
    return fit(known, places, found.column("y").to_numpy(), s)


def _telling(sample: DataFrame, s: Settings) -> DataFrame:
    """Terms that enough rows of the sample hold and whose share differs enough between the labels; none with one label."""
    total = sample.agg(F.sum("y").alias("bad"), F.sum(1 - F.col("y")).alias("good"))
    counts = sample.select("y", F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("held"), F.sum("y").alias("marked"))
    share = F.col("held") / (F.col("bad") + F.col("good"))
    spread = F.sqrt(share * (1 - share) * (1 / F.col("bad") + 1 / F.col("good")))
    apart = F.abs(F.col("marked") / F.col("bad") - (F.col("held") - F.col("marked")) / F.col("good"))
    return counts.join(F.broadcast(total.where("bad > 0 AND good > 0"))).where((F.col("held") >= s.least_rows) & (apart >= s.sigmas * spread)).select("term")


def _counted(batches: Iterator[pa.RecordBatch], s: Settings) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in steps(batch, "text"):
            found, bounds = _by_rows(*terms(part.column("text"), s), part.num_rows, s.buckets)
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(found, pa.int32()))
            yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), part.column("y"), lists], ["doc_id", "y", "terms"])


def _placed(batches: Iterator[pa.RecordBatch], known: np.ndarray) -> Iterator[pa.RecordBatch]:
    m = Machine(0.0, known, np.empty(0), np.empty((0, 0)))
    for batch in batches:
        held = batch.column("terms")
        row = np.repeat(np.arange(len(held)), np.asarray(pc.list_value_length(held)))
        at, bounds = m.places(np.asarray(held.flatten(), np.int64), row, len(held))
        lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(at, pa.int32()))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), lists], ["doc_id", "y", "at"])


def score(docs: DataFrame, machine: Machine, s: Settings = Settings()) -> DataFrame:
    """Add score (0 to 1) and predicted (1 if score >= threshold) to every row with a text; nulls are scored as empty texts.

    Only the text is looked at. All columns of ``docs`` stay; columns named score or predicted are replaced.
    """
    docs = docs.drop("score", "predicted")
    names = docs.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, "text"):
                y = machine.scores(part.column("text"), s)
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), pa.array(y), pa.array((y >= s.threshold).astype(np.int32))], [*names, "score", "predicted"])

    return docs.mapInArrow(rate, f"{schema}, score double, predicted int")


def rate_all(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Learn from labels outside the held-out quarter and score every document (doc_id, held_out, score, predicted).

    Every row of ``docs`` gives a row, repeated ids and null ids (never learned from) included; equal texts score
    alike. Null texts count as empty. Labels that are null or neither 0 nor 1 are ignored; without labels of both
    kinds all scores are the share of label 1, with a row of each kind added. Other columns of ``docs`` and ``labels`` are never read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    machine = learn(docs, labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic"), s)
    return score(docs.select("doc_id", (crc_fold() == 2).alias("held_out"), "text"), machine, s).drop("text")
