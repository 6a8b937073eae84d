"""Approximate nearest neighbours by learned partitions: a balanced cut of a neighbour graph, and a classifier that routes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emberscope.llm.caps import matrix, units, usable
from emberscope.llm.common import stored


@dataclass(frozen=True)
class Settings:
    """``sample`` vectors at most, chosen by hash, teach partitions and classifier; every vector is indexed.

    The routes a query takes are as few as give ``recall`` of the true neighbours, among all rows, of
    ``trials`` queries chosen by hash. Blocks of ``block`` candidates meet blocks of ``queries`` queries.
    """

    k: int = 5
    partitions: int = 16
    sample: int = 6000
    neighbours: int = 10
    recall: float = 0.95
    trials: int = 500
    hidden: int = 64
    rounds: int = 40
    block: int = 20_000
    queries: int = 2_000
    seed: int = 9


def _nearest(x: np.ndarray, k: int) -> np.ndarray:
    out = np.empty((len(x), k), np.int64)
    for at in range(0, len(x), 512):
        near = x[at : at + 512] @ x.T
        near[np.arange(len(near)), at + np.arange(len(near))] = -2
        out[at : at + 512] = np.argpartition(-near, k - 1, axis=1)[:, :k]
    return out


def cut_graph(neighbours: np.ndarray, x: np.ndarray, parts: int, rounds: int, seed: int) -> np.ndarray:
    """A partition number for each node, the parts being of equal size but for a twentieth.

    Starts from halves along random directions and then moves nodes to where most of their neighbours,
    in either direction, are, the largest gain first, as long as there is room.
    """
    n = len(x)
    draw = np.random.default_rng(seed)
    part = np.zeros(n, np.int64)
    groups = [np.arange(n)]
    while len(groups) < parts:
        groups.sort(key=len)
        whole = groups.pop()
        whole = whole[np.argsort(x[whole] @ draw.normal(size=x.shape[1]), kind="stable")]
        groups += [whole[: len(whole) // 2], whole[len(whole) // 2 :]]
    for p, g in enumerate(groups):
        part[g] = p
    a = np.concatenate([np.repeat(np.arange(n), neighbours.shape[1]), neighbours.ravel()])
    b = np.concatenate([neighbours.ravel(), np.repeat(np.arange(n), neighbours.shape[1])])
    most = int(np.ceil(n / parts * 1.05))
    for _ in range(rounds):
        votes = np.bincount(a * parts + part[b], minlength=n * parts).reshape(n, parts)
        to = votes.argmax(axis=1)
        gain = votes[np.arange(n), to] - votes[np.arange(n), part]
        wish = np.flatnonzero((gain > 0) & (draw.random(n) < 0.7))
        size = np.bincount(part, minlength=parts)
        for i in wish[np.argsort(-gain[wish], kind="stable")]:
            if size[to[i]] < most:
                size[part[i]] -= 1
                size[to[i]] += 1
                part[i] = to[i]
    return part


@dataclass
class Router:
    """A network with one hidden layer; ``chances`` are those of the partitions."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray

    def chances(self, x: np.ndarray) -> np.ndarray:
        y = np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2
        y = np.exp(y - y.max(axis=1, keepdims=True))
        return y / y.sum(axis=1, keepdims=True)


def train(x: np.ndarray, target: np.ndarray, s: Settings) -> Router:
    """Cross entropy towards the share of each node's neighbours that lie in each partition, by Adam."""
    draw = np.random.default_rng(s.seed)
    p = [draw.normal(0, x.shape[1] ** -0.5, (x.shape[1], s.hidden)) * 4, np.zeros(s.hidden), draw.normal(0, s.hidden**-0.5, (s.hidden, target.shape[1])), np.zeros(target.shape[1])]
    moments, step = [(np.zeros_like(a), np.zeros_like(a)) for a in p], 0
    for _ in range(s.rounds):
        order = draw.permutation(len(x))
        for at in range(0, len(x), 128):
            b, t = x[order[at : at + 128]], target[order[at : at + 128]]
            h = np.maximum(b @ p[0] + p[1], 0)
            d = (Router(*p).chances(b) - t) / len(b)
            dh = d @ p[2].T * (h > 0)
            step += 1
            for a, g, (m, v) in zip(p, (b.T @ dh, dh.sum(axis=0), h.T @ d, d.sum(axis=0)), moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                a -= 0.003 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Router(*p)


def learn(x: np.ndarray, s: Settings) -> Router:
    """Router from sample vectors (units)."""
    parts = max(1, min(s.partitions, len(x) // 20))
    if parts == 1:
        return Router(np.zeros((x.shape[1], 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1))
    k = min(s.neighbours, len(x) - 1)
    near = _nearest(x, k)
    part = cut_graph(near, x, parts, 20, s.seed)
    target = np.zeros((len(x), parts))
    np.add.at(target, (np.repeat(np.arange(len(x)), k), part[near].ravel()), 0.5 / k)
    target[np.arange(len(x)), part] += 0.5
    return train(x, target, s)


def routes_needed(index: DataFrame, every: int, s: Settings) -> int:
    """How many partitions a query must ask: trial queries are compared with every row, and where their nearest lie is counted.

    Vectors outside the sample, and queries unlike it, are routed worse than those that taught the router, so only the rows
    themselves can tell. A task gives back k rows a trial.
    """
    tried = index.where(F.col("id") % every == 0).orderBy(F.xxhash64(F.lit(s.seed + 1), "id"), "id").limit(s.trials).toPandas()
    if not len(tried):
        return 1
    qid, q, order = tried.id.to_numpy(), np.stack(tried.v.to_numpy()).astype(np.float64), np.stack(tried.routes.to_numpy())

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)]
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, home = batch.column("id").to_numpy(), batch.column("home").to_numpy()
            by_id = np.argsort(ids)
            a, b, score = best(qid, q, ids, matrix(batch.column("v")), s.k)
            found = (a, b, score, home[by_id[np.searchsorted(ids, b, sorter=by_id)]])
            held = [np.concatenate(both) for both in zip(held, found, strict=True)]
            by = np.lexsort((held[1], -held[2], held[0]))
            held = [x[by] for x in held]
            first = np.arange(len(by)) - np.searchsorted(held[0], held[0]) < s.k
            held = [x[first] for x in held]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], ["query_id", "vec_id", "score", "home"])

    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = index.select("id", "v", F.col("home").cast("long")).mapInArrow(compare, "query_id long, vec_id long, score double, home long")
    found = found.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= s.k).select("query_id", "home").toPandas()
    if not len(found):
        return 1
    row = pd.Series(np.arange(len(qid)), index=qid)[found.query_id].to_numpy()
    place = np.argsort(order, axis=1, kind="stable")[row, found.home.to_numpy()]
    reached = np.array([(place < r).mean() for r in range(1, order.shape[1] + 1)])
    return int(np.argmax(reached >= s.recall)) + 1


def _exact(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Cosines of pairs of rows, always summed in the same order, so that equal vectors tie exactly."""
    return np.sum(q * c, axis=1) / (np.sqrt(np.sum(q * q, axis=1)) * np.sqrt(np.sum(c * c, axis=1)))


def best(qid: np.ndarray, q: np.ndarray, cid: np.ndarray, c: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each query its k nearest of a block (query, candidate, score), ties to smaller ids, the query's own id left out."""
    uq, uc = units(q), units(c)
    out = []
    for at in range(0, len(q), 256):
        near = uq[at : at + 256] @ uc.T
        near[qid[at : at + 256, None] == cid[None, :]] = -2
        n = min(k, len(c))
        edge = -np.partition(-near, n - 1, axis=1)[:, n - 1]
        i, j = np.nonzero((near >= edge[:, None] - 1e-12) & (near > -2))
        score = _exact(q[at + i], c[j])
        order = np.lexsort((cid[j], -score, i))
        i, j, score = i[order], j[order], score[order]
        rank = np.arange(len(i)) - np.searchsorted(i, i)
        out.append((qid[at + i[rank < k]], cid[j[rank < k]], score[rank < k]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def search(vectors: DataFrame, every: int = 50, s: Settings = Settings()) -> DataFrame:
    """The k nearest found of each query: query_id, rank from 1, vec_id, score (cosine).

    Queries are the rows of ``vectors`` (vec_id, embedding, any others) whose id is divisible
    by ``every``; candidates are all rows. Null, zero or non-finite vectors, those without an id, and those of another
    length than most of the sample take no part. Rows that repeat an id count once, by their
    least vector. Fewer candidates than k give fewer rows; no vectors give none.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<float>").alias("v")).where("id IS NOT NULL").where(F.coalesce(usable("v"), F.lit(False)))
    rows = rows.groupBy("id").agg(F.min("v").alias("v"))
    drawn = stored(rows.orderBy(F.xxhash64(F.lit(s.seed), "id"), "id").limit(s.sample), "sample").toPandas()
    dim = int(drawn.v.str.len().mode().iloc[0]) if len(drawn) else 1
    drawn = drawn[drawn.v.str.len() == dim]
    router = learn(units(np.stack(drawn.v.to_numpy()).astype(np.float64)) if len(drawn) else np.zeros((0, 1)), s)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                order = np.argsort(-router.chances(units(matrix(batch.column("v")))), axis=1, kind="stable").astype(np.int32)
                ids = batch.column("id").to_numpy()
                lengths = np.where(ids % every == 0, order.shape[1], 0)
                offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
                routes = pa.ListArray.from_arrays(offsets, pa.array(order[ids % every == 0].ravel()))
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), pa.array(order[:, 0]), routes], ["id", "v", "home", "routes"])

    index = stored(rows.where(F.size("v") == dim).mapInArrow(route, "id long, v array<float>, home int, routes array<int>"), "index")
    asks = routes_needed(index, every, s)
    home = index.select(F.col("home").alias("part"), "id", "v")
    asked = index.where(F.col("id") % every == 0).select(F.explode(F.slice("routes", 1, asks)).alias("part"), "id", "v")
    sizes = home.groupBy("part").count().select("part", F.ceil(F.col("count") / s.block).cast("int").alias("cs"))
    sizes = sizes.join(asked.groupBy("part").count().select("part", F.ceil(F.col("count") / s.queries).cast("int").alias("qs")), "part")
    sizes = F.broadcast(sizes)  # a row a partition
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    hashed = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    # Keys of both sides have one type: an int and a long that are equal hash to different tasks.
    left = asked.join(sizes, "part").select("part", hashed("qs").alias("qb"), spread("cs").alias("cb"), "id", "v")
    right = home.join(sizes, "part").select("part", spread("qs").alias("qb"), hashed("cs").alias("cb"), "id", "v").toDF("part_", "qb_", "cb_", "id_", "v_")

    def meet(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if not (len(q) and len(c)):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        a, b = (np.stack(x.to_numpy()).astype(np.float64) for x in (q.v, c.v_))
        found = best(q.id.to_numpy(), a, c.id_.to_numpy(), b, s.k)
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), found, strict=True)))

    found = left.groupBy("part", "qb", "cb").cogroup(right.groupBy("part_", "qb_", "cb_")).applyInPandas(meet, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= s.k).select("query_id", "rank", "vec_id", "score")
