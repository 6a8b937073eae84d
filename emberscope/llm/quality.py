"""Quality score of a text by a factorisation machine over hashed words, structure and size."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberscope.llm.common import crc_fold, lean, steps, utf8, word_hashes, word_spans


@dataclass(frozen=True)
class Settings:
    """``sample`` labelled rows at most are learned from, their texts whole."""

    buckets: int = 2048
    factors: int = 8
    sample: int = 4000
    rounds: int = 15
    rate: float = 0.02
    decay: float = 1e-4
    seed: int = 3
    threshold: float = 0.7


#: Shares of bytes, means over words and the like; each is cut into as many levels as LEVELS says.
STATISTICS = (
    "upper", "digits", "punctuation", "symbols", "other bytes", "line breaks", "distinct words", "commonest word",
    "letters a word", "words ending in signs", "words a line", "distinct lines", "words", "bytes",
)
LEVELS = 12


def _kind(members: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members.encode())] = True
    return table


_UPPER = _kind("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_DIGIT = _kind("0123456789")
_PUNCT = _kind(".,;:!?'\"-()")
_SIGNS = _kind("#$%&*+/<=>@[\\]^_`{|}~")
_BREAK = _kind("\n")


def features(texts: pa.Array, s: Settings) -> np.ndarray:
    """Rows of hashed word weights (of unit length together) followed by one-hot levels of the statistics.

    The work is linear in the text; a text of any length gives one row of fixed width.
    """
    raw, bounds = utf8(texts)
    n = len(texts)
    size = np.maximum(np.diff(bounds), 1)
    starts, rows = word_spans(raw, bounds)
    hashes = word_hashes(raw, starts)
    words = np.bincount(rows, minlength=n)
    some = np.maximum(words, 1)
    counts = np.bincount(rows * s.buckets + (hashes % np.uint64(s.buckets)).astype(np.int64), minlength=n * s.buckets).reshape(n, s.buckets)

    def share(table: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(table[raw])])[bounds]) / size

    solid = np.diff(np.concatenate([[0], np.cumsum(raw > 0x20)])[bounds])
    breaks = share(_BREAK) * size
    ends = np.append(starts[1:], len(raw)) if len(starts) else starts
    last = np.maximum(ends - 2, starts)  # the sign before the space, in ordinary prose
    odd = np.bincount(rows, (_SIGNS | _kind("!"))[raw[last]] if len(starts) else None, minlength=n) / some
    pairs = np.unique(rows.astype(np.uint64) << np.uint64(40) | hashes >> np.uint64(24))
    distinct = np.bincount((pairs >> np.uint64(40)).astype(np.int64), minlength=n) / some
    table = np.column_stack([
        share(_UPPER), share(_DIGIT), share(_PUNCT), share(_SIGNS), share(np.arange(256) >= 128), np.minimum(share(_BREAK) * 20, 1),
        distinct, counts.max(axis=1) / some, np.minimum(solid / some / 16, 1), odd, np.minimum(some / (breaks + 1) / 200, 1),
        _distinct_lines(raw, bounds), np.log1p(words) / 16, np.log1p(size) / 20,
    ])
    level = np.minimum((np.sqrt(np.clip(table, 0, 1)) * LEVELS).astype(np.int64), LEVELS - 1)
    hot = np.zeros((n, len(STATISTICS) * LEVELS), np.float32)
    hot[np.arange(n)[:, None], np.arange(len(STATISTICS)) * LEVELS + level] = 0.5
    weight = np.log1p(counts, dtype=np.float32)
    weight /= np.maximum(np.sqrt(np.einsum("ij,ij->i", weight, weight))[:, None], 1e-6)
    return np.hstack([weight, hot])


def _distinct_lines(raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    out = np.ones(len(bounds) - 1)
    data = raw.tobytes()
    for i in range(len(out)):
        lines = data[bounds[i] : bounds[i + 1]].split(b"\n")
        out[i] = len(set(lines)) / len(lines)
    return out


@dataclass
class Machine:
    """y = bias + w.x + half the sum over factors of (v.x)^2 - (v^2).(x^2): all pairs in linear time."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def logits(self, x: np.ndarray) -> np.ndarray:
        crossed = x @ self.factors
        return self.bias + x @ self.linear + 0.5 * ((crossed**2).sum(axis=1) - (x**2) @ (self.factors**2).sum(axis=1))

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x).astype(np.float64), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, s: Settings) -> Machine:
    """Logistic loss by Adam on small batches. Without rows, or with one class, the score is the share of label 1."""
    draw = np.random.default_rng(s.seed)
    share = (y.sum() + 1) / (len(y) + 2)
    p = [np.array([np.log(share / (1 - share))]), np.zeros(x.shape[1]), draw.normal(0, 0.05, (x.shape[1], s.factors))]
    moments, step = [(np.zeros_like(a), np.zeros_like(a)) for a in p], 0
    for _ in range(s.rounds if 0 < y.sum() < len(y) else 0):
        order = draw.permutation(len(y))
        for at in range(0, len(y), 64):
            b, t = x[order[at : at + 64]].astype(np.float64), y[order[at : at + 64]]
            crossed = b @ p[2]
            error = (1 / (1 + np.exp(-np.clip(Machine(p[0][0], p[1], p[2]).logits(b), -30, 30))) - t) / len(t)
            pull = [np.array([error.sum()]), b.T @ error + s.decay * p[1], b.T @ (error[:, None] * crossed) - ((b**2).T @ error)[:, None] * p[2] + s.decay * p[2]]
            step += 1
            for a, g, (m, v) in zip(p, pull, moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                a -= s.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Machine(float(p[0][0]), p[1].astype(np.float32), p[2].astype(np.float32))


def learn(docs: DataFrame, labels: DataFrame, s: Settings) -> Machine:
    """Fit on a bounded sample, by hash, of rows of ``docs`` (doc_id, text) that ``labels`` (doc_id, quality) marks 0 or 1.

    Held-out ids (crc32 remainder 2 by 4) are never read. Several labels of one document count by their mean.
    """
    marked = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").where(crc_fold() != 2).groupBy("doc_id").agg(F.avg("quality").alias("y"))
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(s.sample).collect()
    by = {r["doc_id"]: r["y"] for r in chosen}
    rows = docs.where(F.col("doc_id").isin(list(by))) if by else docs.limit(0)
    # A repeated id counts once, so that the sample stays bounded.
    rows = rows.groupBy("doc_id").agg(F.min("text").alias("text"))
    found = sorted(rows.mapInArrow(lean(lambda batches: _sparse(batches, s)), "doc_id long, at binary, x binary").collect(), key=lambda r: r["doc_id"])
    x = np.zeros((len(found), s.buckets + len(STATISTICS) * LEVELS), np.float32)
    for row, r in zip(x, found, strict=True):
        row[np.frombuffer(r["at"], np.int32)] = np.frombuffer(r["x"], np.float32)
    return fit(x, np.array([by[r["doc_id"]] for r in found]), s)


def _sparse(batches: Iterator[pa.RecordBatch], s: Settings) -> Iterator[pa.RecordBatch]:
    """Features of whole texts: places and values of those that are not zero, so that the driver sees no text."""
    for batch in batches:
        for part in steps(batch, "text"):
            for at in range(0, part.num_rows, 512):
                some = part.slice(at, 512)
                x = features(some.column("text"), s)
                places = [np.flatnonzero(row).astype(np.int32) for row in x]
                values = [row[i].tobytes() for row, i in zip(x, places, strict=True)]
                yield pa.RecordBatch.from_arrays([some.column("doc_id").cast(pa.int64()), pa.array([i.tobytes() for i in places], pa.binary()), pa.array(values, pa.binary())], ["doc_id", "at", "x"])


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
                for at in range(0, part.num_rows, 512):
                    rows = part.slice(at, 512)
                    y = machine.scores(features(rows.column("text"), s))
                    yield pa.RecordBatch.from_arrays([*(rows.column(n) for n in names), pa.array(y), pa.array((y >= s.threshold).astype(np.int32))], [*names, "score", "predicted"])

    return docs.mapInArrow(lean(rate), f"{schema}, score double, predicted int")


def rate_all(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Learn from labels outside the held-out quarter and score every document (doc_id, held_out, score, predicted)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    machine = learn(docs, labels.withColumn("doc_id", F.col("doc_id").cast("long")), s)
    return score(docs.select("doc_id", (crc_fold() == 2).alias("held_out"), "text"), machine, s).drop("text")
