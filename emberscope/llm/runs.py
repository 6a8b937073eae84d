"""Periodic runs of words in texts, found by recompression, and texts with the repetitions taken out."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberscope.llm.common import _SPACE, steps, utf8, word_spans


@dataclass(frozen=True)
class Settings:
    """A run has at least ``least`` words and two periods. ``grid``: candidates that a task holds at a time."""

    least: int = 12
    grid: int = 1 << 20


@dataclass
class Level:
    """One level of a run-length grammar: its symbols, and how the next level's symbols divide them.

    ``child`` holds where each symbol of the next level begins, closed by the length; ``block`` says
    that these are runs of one symbol, else they are pairs and single symbols.
    """

    symbols: np.ndarray
    parent: np.ndarray
    child: np.ndarray
    block: bool

    def mirrored(self) -> Level:
        """The same level read from behind."""
        n, m = len(self.symbols), len(self.child) - 1
        return Level(self.symbols[::-1], m - 1 - self.parent[::-1], n - self.child[::-1], self.block)


def grammar(symbols: np.ndarray, seed: int = 1) -> list[Level]:
    """Compress a string that ends in a symbol found nowhere else, until one symbol is left.

    Turn by turn, maximal blocks of a symbol and pairs from a left to a right half of the alphabet become new
    symbols. What is replaced depends on the symbols alone, so equal stretches are replaced alike but for their
    borders, and equal symbols always stand for equal stretches.
    """
    draw, levels, block = np.random.default_rng(seed), [], False
    while len(symbols) > 1:
        block = not block
        first = np.append(True, symbols[1:] != symbols[:-1]) if block else _unpaired(symbols, draw)
        if first.all():
            continue
        child = np.flatnonzero(first)
        size = np.diff(child, append=len(symbols))
        if block:
            key = symbols[child] * (int(size.max()) + 1) + size
        else:
            second = symbols[np.minimum(child + 1, len(symbols) - 1)] + 1
            key = symbols[child] * (int(symbols.max()) + 2) + np.where(size == 2, second, 0)
        parent = (np.cumsum(first) - 1).astype(np.int32)
        levels.append(Level(symbols.astype(np.int32), parent, np.append(child, len(symbols)).astype(np.int32), block))
        symbols = pd.factorize(key)[0]
    levels.append(Level(symbols.astype(np.int32), np.zeros(1, np.int32), np.array([0, 1], np.int32), False))
    return levels


def _unpaired(symbols: np.ndarray, draw: np.random.Generator) -> np.ndarray:
    """False where a symbol of the right half follows one of the left; the better of some random halves."""
    best = np.zeros(0, bool)
    for _ in range(2):
        left = draw.random(int(symbols.max()) + 1) < 0.5
        side = left[symbols]
        for pairs in (side[:-1] & ~side[1:], ~side[:-1] & side[1:]):
            if not len(best) or np.count_nonzero(pairs) > np.count_nonzero(best):
                best = pairs
    return np.append(True, ~best)


def common(levels: list[Level], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many symbols from places ``x`` and ``y`` (never the same) on are equal, by climbing the grammar and descending.

    A step forward aligns both places with symbols of the next level, else they differ; going down, the
    first children of differing symbols are equal at most once. So a query takes at most two steps a level.
    """
    at_x, at_y = x.astype(np.int32), y.astype(np.int32)
    stop, going = np.zeros(len(x), np.int16), np.arange(len(x))
    for k, level in enumerate(levels):
        a, b = at_x[going], at_y[going]
        same = level.symbols[a] == level.symbols[b]
        stop[going[~same]] = k
        going, a, b = going[same], a[same], b[same]
        if not len(going):
            break
        up_a, up_b = level.parent[a], level.parent[b]
        inside = (level.child[up_a] != a) | (level.child[up_b] != b)
        step = np.minimum(level.child[up_a + 1] - a, level.child[up_b + 1] - b) * inside if level.block else inside
        a, b = a + step, b + step
        up_a, up_b = level.parent[a], level.parent[b]
        aligned = (level.child[up_a] == a) & (level.child[up_b] == b)
        at_x[going], at_y[going] = np.where(aligned, up_a, a), np.where(aligned, up_b, b)
        stop[going[~aligned]] = k
        going = going[aligned]
    for k in range(int(stop.max(initial=0)), 0, -1):
        some, below = np.flatnonzero(stop >= k), levels[k - 1]
        up_a, up_b = at_x[some], at_y[some]
        a, b = below.child[up_a], below.child[up_b]
        step = np.minimum(below.child[up_a + 1] - a, below.child[up_b + 1] - b) if below.block else 1
        step = step * (below.symbols[a] == below.symbols[b])
        at_x[some], at_y[some] = a + step, b + step
    return at_x - x


def find(words: np.ndarray, bounds: np.ndarray, s: Settings) -> np.ndarray:
    """All runs of texts given as word numbers row after row: columns row, start in the row, length, period.

    ``bounds``: where each row begins, and the end. Sorted by row, start and period.
    """
    n, first = np.diff(bounds), bounds[:-1] + np.arange(1, len(bounds))
    top = int(words.max(initial=-1)) + 1
    text = np.empty(len(words) + len(bounds), np.int64)
    row_of = np.repeat(np.arange(len(n)), n)
    text[np.arange(len(words)) + row_of + 1] = words
    text[np.append(0, first + n)] = top + np.arange(len(bounds))  # a mark of its own parts each row from the next
    levels = grammar(text)
    behind = [level.mirrored() for level in levels]
    runs = [np.empty((0, 4), np.int64)]
    for row, at, period in _candidates(text, first, n, s):
        after = common(levels, at, at + period)
        before = common(behind, len(text) - at, len(text) - at - period)
        good = after + before >= np.maximum(s.least - period, period)
        start = at - before - first[row]
        runs.append(np.column_stack([row, start, after + before + period, period])[good])
    found = np.unique(np.concatenate(runs), axis=0)
    # A multiple of a run's period gives the same stretch again.
    new = np.ones(len(found), bool)
    new[1:] = (found[1:, :3] != found[:-1, :3]).any(axis=1)
    found = found[new]
    return found[np.lexsort((found[:, 3], found[:, 1], found[:, 0]))]


def _candidates(text: np.ndarray, first: np.ndarray, n: np.ndarray, s: Settings) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places whose word recurs a period later, on a grid for each period that no run of the period can slip through.

    In a run of period p the words equal to those p later form a stretch of max(least - p, p) or more.
    The grids of a row have about n log n places together; ``grid`` of them are looked at at a time.
    """
    most = np.where(n >= s.least, n // 2, 0)
    row = np.repeat(np.arange(len(n)), most)
    period = np.arange(len(row)) - np.repeat(np.cumsum(most) - most, most) + 1
    stride = np.maximum(period, s.least - period)
    places = (n[row] - period - 1) // stride + 1
    ends = np.cumsum(places)
    at = 0
    while at < len(row):
        done = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, done + s.grid, side="right")))
        count = places[at:stop]
        turn = np.arange(int(count.sum())) - np.repeat(ends[at:stop] - done - count, count)
        x = np.repeat(first[row[at:stop]], count) + turn * np.repeat(stride[at:stop], count)
        y = x + np.repeat(period[at:stop], count)
        hit = np.flatnonzero(text[x] == text[y])
        x, y = x[hit], y[hit]
        some = (text[x + 1] == text[y + 1]) | (text[x - 1] == text[y - 1])
        which = np.repeat(np.arange(at, stop), count)[hit][some]
        yield row[which], x[some], period[which]
        at = stop


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Letters of all words in a line, where each word begins there (and the end), their numbers, and bounds of the rows."""
    raw, bounds = utf8(texts)
    starts, rows = word_spans(raw, bounds)
    solid = ~_SPACE[raw]
    offsets = np.append(0, np.cumsum(solid))[np.append(starts, len(raw))] if len(starts) else np.zeros(1, np.int64)
    letters = raw[solid]
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(letters)])
    numbers = np.asarray(words.dictionary_encode().indices, np.int64) if len(starts) else np.empty(0, np.int64)
    return letters, offsets, numbers, np.searchsorted(rows, np.arange(len(texts) + 1))


def _joined(letters: np.ndarray, offsets: np.ndarray, keep: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The kept words of each row, joined by one space."""
    kept = np.flatnonzero(keep)
    size = np.diff(offsets)[kept] + 1
    ends = np.cumsum(size)
    source = np.arange(int(size.sum())) + np.repeat(offsets[kept] - (ends - size), size)
    out = letters[np.minimum(source, len(letters) - 1)] if len(kept) else np.empty(0, np.uint8)
    out[ends - 1] = 0x20
    data = out.tobytes()
    cut = np.append(0, ends)[np.append(0, np.cumsum(keep))[bounds]]
    return pa.array([data[a : max(a, b - 1)].decode() for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.string())


def _spread(batches: Iterator[pa.RecordBatch], s: Settings, names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in steps(batch, "text"):
            letters, offsets, words, bounds = _words(part.column("text"))
            found = find(words, bounds, s)
            ends = np.zeros(len(words) + 1, np.int64)
            start = bounds[found[:, 0]] + found[:, 1]
            np.add.at(ends, start + found[:, 3], 1)
            np.add.at(ends, start + found[:, 2], -1)
            keep = np.cumsum(ends[:-1]) == 0
            rows = pa.array(np.searchsorted(found[:, 0], np.arange(part.num_rows + 1)), pa.int32())
            runs = pa.ListArray.from_arrays(rows, pa.StructArray.from_arrays([pa.array(found[:, i]) for i in (1, 2, 3)], ["start", "length", "period"]))
            yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), runs, _joined(letters, offsets, keep, bounds)], [*names, "runs", "collapsed"])


def runs_of(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Add ``runs`` and ``collapsed`` to every row with a ``text``.

    Words are runs of anything but ASCII white space, numbered from 0. ``runs``: start, length and smallest
    period of every stretch with that period that no neighbouring word extends and that has two periods and ``least`` words,
    sorted by start, then period. ``collapsed``: the words that lie in no run after its first period, joined by one space.
    Null, empty and blank texts have no runs and collapse to an empty text. Texts are whole, rows are independent:
    repeated rows and null ids give a row each. All columns stay; those named runs or collapsed are replaced.
    """
    docs = docs.drop("runs", "collapsed")
    names = docs.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(lambda batches: _spread(batches, s, names), f"{schema}, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def with_repeats(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text) whose text, for a tenth of the ids, becomes periodic from some word on.

    With h the crc32 of the decimal id (null: of nothing) and g a tenth of it: where h ends in 0, word i of n from
    a = g % n on becomes word a + (i - a) % p, with p = 1 + (n - a) / (3 + g % 8) cut to a whole number.
    """
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", h.alias("h"))
    rows = rows.withColumn("words", F.when(F.col("h") % 10 == 0, F.expr(r"filter(split(text, '[\\x20\\x09-\\x0D]+'), w -> w <> '')")))
    rows = rows.withColumn("a", F.expr("(h div 10) % nullif(size(words), 0)"))
    rows = rows.withColumn("p", F.expr("1 + (size(words) - a) div (3 + (h div 10) % 8)"))
    changed = F.expr("array_join(transform(words, (w, i) -> IF(i < a, w, words[CAST(a + (i - a) % p AS INT)])), ' ')")
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), changed).otherwise(F.col("text")).alias("text"))


def digest(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Per row its number of runs, the longest (ties: least start, then period), and digests of all runs and of the collapsed text."""
    out = runs_of(with_repeats(docs), s)
    out = out.withColumn("best", F.expr("array_max(transform(runs, r -> struct(r.length AS length, -r.start AS start, -r.period AS period)))"))
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.expr("(1000 * best.length) div -best.period").alias("exponent_milli"),
        F.sha2(F.expr(r"array_join(transform(runs, r -> concat(concat_ws(',', r.start, r.length, r.period), '\n')), '')").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
