"""Packing token sequences into windows of fixed capacity by best-fit decreasing."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emberscope.llm.common import lean, partitions, steps, stored
from emberscope.llm.tokens import encoder

CAPACITY = 4096
END_ID = 2
PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary"


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Token ids of every text with an end id, cut into full windows and one rest.

    Returns doc_id, start, length, doc_tokens and ids (binary, little-endian unsigned
    32-bit). A null or empty text is the end id alone; repeated rows give repeated
    pieces; other columns are not read.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        for batch in batches:
            for part in steps(batch, "text"):
                doc, start, length, total, ids = [], [], [], [], []
                texts = [t or "" for t in part.column("text").to_pylist()]
                for key, found in zip(part.column("doc_id").to_pylist(), encode(texts), strict=True):
                    found = np.append(found, np.uint32(end_id)).astype("<u4")
                    for at in range(0, len(found), capacity):
                        piece = found[at : at + capacity]
                        doc.append(key), start.append(at), length.append(len(piece)), total.append(len(found)), ids.append(piece.tobytes())
                yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in (doc, start, length, total)), pa.array(ids, pa.binary())], ["doc_id", "start", "length", "doc_tokens", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lean(cut, holds=True), PIECES)


class Capacities:
    """A segment tree over remaining capacities; it finds the least one in use that is large enough."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.used = bytearray(2 * self.leaves)

    def mark(self, room: int, used: bool) -> None:
        at = room + self.leaves
        self.used[at] = used
        while at := at >> 1:
            self.used[at] = self.used[2 * at] | self.used[2 * at + 1]

    def tightest(self, need: int) -> int | None:
        at = need + self.leaves
        if self.used[at]:
            return need
        while at > 1 and (at & 1 or not self.used[at + 1]):
            at >>= 1
        if at == 1:
            return None
        at += 1
        while at < self.leaves:
            at = 2 * at if self.used[2 * at] else 2 * at + 1
        return at - self.leaves


def plan(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Best-fit decreasing over how many pieces there are of each length.

    Returns runs (length, first rank, how many, first window, offset): so many pieces
    of a length, counted from that rank, go one each into consecutive windows at that
    offset. Pieces of equal length are alike, so whole classes of windows with the
    same room move together, and the work depends on the capacity, not on the number
    of pieces. Equal to placing piece by piece: the window just used is the tightest
    for the next piece of that length until it no longer fits.
    """
    tree, rooms, runs, windows = Capacities(capacity), {}, [], 0

    def put(room: int, first: int, many: int) -> None:
        if room and many:
            rooms.setdefault(room, deque()).append((first, many))
            tree.mark(room, True)

    for length in sorted((n for n in counts if counts[n]), reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} tokens does not fit {capacity}")
        rank, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                room, first, many = capacity, windows, -(-left // (capacity // length))
                windows += many
            else:
                first, many = rooms[room].popleft()
                if not rooms[room]:
                    tree.mark(room, False)
            each = room // length
            full = min(many, left // each)
            for i in range(each if full else 0):
                runs.append((length, rank, full, first, capacity - room + i * length))
                rank += full
            left -= full * each
            put(room - each * length, first, full)
            if left and full < many:
                for i in range(left):
                    runs.append((length, rank, 1, first + full, capacity - room + i * length))
                    rank += 1
                put(room - left * length, first + full, 1)
                full, left = full + 1, 0
            put(room, first + full, many - full)
    return runs, windows


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to pieces (doc_id, start, length, any other columns).

    All rows take part in one packing. The driver sees only how many pieces each
    length has, at most ``capacity`` numbers. Ranks within a length are counted per slot,
    so that one length held by very many pieces is numbered in many tasks. The rows
    are read more than once: hand in a stored table. No rows give no rows.
    """
    slots = partitions(parts.sparkSession)
    parts = parts.drop("sequence_id", "offset").withColumn("_slot", F.pmod(F.xxhash64("doc_id", "start"), F.lit(slots)))
    sizes = parts.groupBy("length", "_slot").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("length", "_slot", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    runs, _ = plan(counts, capacity)
    table = np.array(sorted(runs), np.int64).reshape(-1, 5)
    order = Window.partitionBy("length", "_slot").orderBy(*[c for c in ("doc_id", "start", "ids_crc32", "doc_tokens") if c in parts.columns])
    ranked = parts.withColumn("_rank", F.row_number().over(order) - 1).join(base, ["length", "_slot"]).withColumn("_rank", F.col("_rank") + F.col("_base")).drop("_slot", "_base")
    names = [c for c in ranked.columns if c != "_rank"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema if f.name != "_rank") + ", sequence_id long, offset long"
    heads = table[:, 0] << 48 | table[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("_rank").to_numpy()
            run = table[np.searchsorted(heads, length << 48 | rank, side="right") - 1] if len(table) else table
            found = [run[:, 3] + rank - run[:, 1], run[:, 4]]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *map(pa.array, found)], [*names, "sequence_id", "offset"])

    return ranked.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID, ids: bool = True) -> DataFrame:
    """Documents to packed pieces with their token ids or, without ``ids``, their crc32 only."""
    cut = pieces(docs, vocabulary, capacity, end_id).withColumn("ids_crc32", F.crc32("ids"))
    return pack(stored(cut if ids else cut.drop("ids"), "pieces"), capacity)
