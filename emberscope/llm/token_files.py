"""Token-id files: frequency-ranked ids in whole bytes, their sizes kept apart as control bits.

A file holds a run of documents in ascending order of id. Layout, all little-endian:

    8 bytes   the mark b"RANKIDS1"
    3 x int64 shard number, documents, ids
    int64     doc_id of each document (the least int64 for null)
    int64     how many ids each document has
    control   two bits an id, four to a byte from the low end: bytes of its rank less one
    data      the ranks, each in 1 to 4 bytes

The ranks themselves lie beside the shards as one table, ``ranks.u32``: the mark, then the id of each rank.
"""

from __future__ import annotations

import functools
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from emberscope.llm.common import steps, stored
from emberscope.llm.tokens import encoder
from emberscope.session import scratch_dir

MARK = b"RANKIDS1"
NULL_ID = -(1 << 63)
END_ID = 2
#: About so many bytes of zipped ids are meant to go to one file.
SHARD_BYTES = 4 << 20

#: For each control byte the sizes of its four ranks.
SIZES = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1).astype(np.uint8)
#: For each size the bits of a rank that belong to it.
BITS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit ranks."""
    size = 1 + (ranks > 0xFF).view(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    control = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    control[: len(ranks)] = size - 1
    control = control[::4] | control[1::4] << 2 | control[2::4] << 4 | control[3::4] << 6
    data = ranks.astype("<u4").view(np.uint8).reshape(-1, 4)[np.arange(4, dtype=np.uint8) < size[:, None]]
    return control.tobytes(), data.tobytes()


def decode_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ranks again: one table lookup gives all sizes, running sums the places, and one gather takes four bytes each."""
    size = SIZES[np.frombuffer(control, np.uint8)].ravel()[:n]
    at = np.cumsum(size, dtype=np.int64) - size
    raw = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(4, np.uint8)])
    four = raw[:-3].astype(np.uint32)
    for k in range(1, 4):
        four |= raw[k : len(raw) - 3 + k].astype(np.uint32) << np.uint32(8 * k)
    return four[at] & BITS[size]


def shard_bytes(shard: int, doc_ids: list[int | None], ids: list[np.ndarray], rank_of: np.ndarray) -> bytes:
    flat = np.concatenate(ids) if ids else np.empty(0, np.uint32)
    keys = np.array([NULL_ID if d is None else d for d in doc_ids], "<i8")
    head = np.array([shard, len(keys), len(flat)], "<i8")
    control, data = encode_ranks(rank_of[flat])
    return b"".join([MARK, head.tobytes(), keys.tobytes(), np.array([len(i) for i in ids], "<i8").tobytes(), control, data])


def read_shard(raw: bytes, id_of: np.ndarray) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Shard number, doc_ids, ids of each document, and all ids one after the other."""
    if raw[:8] != MARK:
        raise ValueError("not a token file")
    shard, docs, n = np.frombuffer(raw, "<i8", 3, 8).tolist()
    at = 32 + 16 * docs
    keys, counts = np.frombuffer(raw, "<i8", docs, 32), np.frombuffer(raw, "<i8", docs, 32 + 8 * docs)
    control = -(-n // 4)
    return shard, keys, counts, id_of[decode_ranks(raw[at : at + control], raw[at + control :], n)]


def _place(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if re.match(r"\w+:/", uri) else f"file://{uri}")


def _put(folder: str, name: str, raw: bytes) -> None:
    """Write a file under another name first, so that a repeated task leaves whole files only."""
    fs, path = _place(folder)
    fs.create_dir(path, recursive=True)
    draft = f"{path}/.{name}.{uuid.uuid4().hex}"
    with fs.open_output_stream(draft) as out:
        out.write(raw)
    fs.move(draft, f"{path}/{name}")


def zipped_ids(docs: DataFrame, vocabulary: str, end_id: int = END_ID) -> DataFrame:
    """doc_id and the zstandard-compressed 32-bit ids of the whole text with its end id; a null text is the end id alone.

    Every task ends with a row of its own, which has no ids but ``counts``: how often the task met each id.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen = encoder(vocabulary), np.zeros(end_id + 1, np.int64)
        names = ["doc_id", "zipped", "counts"]
        for batch in batches:
            for part in steps(batch, "text"):
                found = [np.append(i, np.uint32(end_id)) for i in own.encode([t or "" for t in part.column("text").to_pylist()])]
                more = np.bincount(np.concatenate(found), minlength=len(seen))
                more[: len(seen)] += seen
                seen = more
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([_zip(i) for i in found], pa.binary()), pa.nulls(len(found), pa.binary())], names)
        counts = zstandard.ZstdCompressor(level=3).compress(seen.tobytes())
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([counts], pa.binary())], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(encode, "doc_id long, zipped binary, counts binary")


@functools.cache
def _codec() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    """Of this process; making them anew costs as much as compressing a short text."""
    return zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()


def _zip(ids: np.ndarray) -> bytes:
    """One byte that tells the width, then the ids in as few bytes each, compressed."""
    width = 2 if ids.max() < 1 << 16 else 4
    return bytes([width]) + _codec()[0].compress(ids.astype(f"<u{width}").tobytes())


def _unzip(raw: bytes) -> np.ndarray:
    return np.frombuffer(_codec()[1].decompress(raw[1:]), f"<u{raw[0]}")


def frequencies(zipped: DataFrame) -> DataFrame:
    """id and n over all documents, from what each task has counted; as many rows as ids occur."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column("counts").to_pylist():
                seen = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.int64)
                at = np.flatnonzero(seen)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], ["id", "n"])

    return zipped.where("counts IS NOT NULL").select("counts").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write(docs: DataFrame, folder: str, vocabulary: str, end_id: int = END_ID) -> None:
    """Encode every whole text and write shards in ascending order of doc_id, null ids first, to ``folder``.

    Texts are encoded once; the zipped ids are stored, counted and dealt out by range of id.
    What the driver sees is bounded by the vocabulary. Rows that repeat an id lie side by side.
    No rows give the rank table and perhaps an empty shard.
    """
    spark = docs.sparkSession
    zipped = stored(zipped_ids(docs, vocabulary, end_id), "zipped")
    counts = frequencies(zipped).orderBy(F.desc("n"), "id").collect()
    id_of = np.array([r["id"] for r in counts], np.uint32)
    rank_of = np.zeros(int(id_of.max()) + 1 if len(id_of) else 1, np.uint32)
    rank_of[id_of] = np.arange(len(id_of), dtype=np.uint32)
    _put(folder, "ranks.u32", MARK + id_of.astype("<u4").tobytes())
    zipped = zipped.where("counts IS NULL").drop("counts")
    total = zipped.agg(F.sum(F.octet_length("zipped"))).first()[0] or 0
    dealt = zipped.repartitionByRange(max(1, -(-total // SHARD_BYTES)), "doc_id").sortWithinPartitions("doc_id", F.xxhash64("zipped"))

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, keys, ids = TaskContext.get().partitionId(), [], []
        for batch in batches:
            keys += batch.column("doc_id").to_pylist()
            ids += map(_unzip, batch.column("zipped").to_pylist())
        _put(folder, f"shard-{shard:06d}.ids", shard_bytes(shard, keys, ids, rank_of))
        yield pa.RecordBatch.from_arrays([pa.array([len(keys)])], ["n"])

    dealt.mapInArrow(shards, "n long").agg(F.sum("n")).collect()


def read(spark: SparkSession, folder: str) -> DataFrame:
    """shard, doc_id, at (ids before it in its shard), n_tokens and ids (binary, 32-bit) of each document in ``folder``."""
    path = folder if re.match(r"\w+:/", folder) else f"file://{folder}"
    id_of = np.frombuffer(spark.read.format("binaryFile").load(f"{path}/ranks.u32").first()["content"][len(MARK) :], "<u4")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column("content").to_pylist():
                shard, keys, counts, flat = read_shard(raw, id_of)
                ends = np.cumsum(counts)
                for at in range(0, len(keys), 1024):
                    to = min(at + 1024, len(keys))
                    ids = [flat[e - n : e].astype("<u4").tobytes() for e, n in zip(ends[at:to], counts[at:to], strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([shard] * (to - at), pa.int64()), pa.array(keys[at:to], mask=keys[at:to] == NULL_ID), pa.array(ends[at:to] - counts[at:to]), pa.array(counts[at:to]), pa.array(ids, pa.binary())],
                        ["shard", "doc_id", "at", "n_tokens", "ids"],
                    )

    return _shards(spark, folder).select("content").mapInArrow(decode, "shard long, doc_id long, at long, n_tokens long, ids binary")


def _shards(spark: SparkSession, folder: str) -> DataFrame:
    path = folder if re.match(r"\w+:/", folder) else f"file://{folder}"
    return spark.read.format("binaryFile").option("pathGlobFilter", "shard-*.ids").load(path)


def with_starts(rows: DataFrame, folder: str) -> DataFrame:
    """Add start, the ids of all documents before, to rows of ``read``; drop columns that aren't needed first."""
    before = _before(_shards(rows.sparkSession, folder).select("path"))
    return rows.join(before, "shard").withColumn("start", F.col("at") + F.col("before")).drop("shard", "at", "before")


def _before(files: DataFrame) -> DataFrame:
    """How many ids the shards before each hold, from their headers; one small row a file."""

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([_head(path) for path in batch.column("path").to_pylist()], np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 2])], ["shard", "n"])

    rows = files.mapInArrow(heads, "shard long, n long")
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return rows.select("shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))


def _head(path: str) -> np.ndarray:
    """Shard number, documents and ids of a file, from its first bytes."""
    fs, place = _place(path)
    with fs.open_input_file(place) as file:
        return np.frombuffer(file.read(32), "<i8", 3, 8)


def digest(docs: DataFrame, vocabulary: str, end_id: int = END_ID) -> DataFrame:
    """Write the files to the shared folder, read them back and describe each document by what they hold."""
    folder = scratch_dir(docs.sparkSession, "token-files")
    write(docs, folder, vocabulary, end_id)
    rows = read(docs.sparkSession, folder).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return with_starts(rows, folder).select("doc_id", "start", "n_tokens", "ids_crc32")
