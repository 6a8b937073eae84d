"""Language of a text by cross parsing: the language whose labelled text needs the fewest phrases to spell it."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emberscope.llm.common import crc_fold, held, lean, steps

UNDETERMINED = "und"
#: Symbols: 0 stands for anything without a letter, 1 for letters that no sample holds, then the letters.
OTHER, UNKNOWN = 0, 1


@dataclass(frozen=True)
class Settings:
    """``texts`` labelled texts a language at most, all of them whole, are learned: as many as hold ``sample`` characters together.

    Texts over ``longest`` characters are learned from only where a language has too few others.
    ``segment``: texts are parsed in stretches of so many symbols side by side.
    """

    texts: int = 256
    sample: int = 60_000
    longest: int = 8_192
    segment: int = 512


class Automaton:
    """Suffix automaton of a string of small integers; ``moves[state, symbol]`` is the next state or -1."""

    def __init__(self, symbols: np.ndarray, alphabet: int):
        link, length, moves, last = [-1], [0], [[-1] * alphabet], 0
        for c in symbols.tolist():
            new = len(moves)
            moves.append([-1] * alphabet), length.append(length[last] + 1), link.append(0)
            at = last
            while at >= 0 and moves[at][c] < 0:
                moves[at][c] = new
                at = link[at]
            if at >= 0:
                to = moves[at][c]
                if length[at] + 1 == length[to]:
                    link[new] = to
                else:
                    copy = len(moves)
                    moves.append(moves[to][:]), length.append(length[at] + 1), link.append(link[to])
                    while at >= 0 and moves[at][c] == to:
                        moves[at][c] = copy
                        at = link[at]
                    link[to] = link[new] = copy
            last = new
        self.moves = np.array(moves, np.int32)


class Parser:
    """Counts, for each language, the longest matches that spell a text one after the other."""

    def __init__(self, samples: dict[str, str], segment: int):
        self.languages, self.segment = sorted(samples), segment
        lowered = {k: points(samples[k]) for k in self.languages}
        letters = np.unique(np.concatenate([np.empty(0, np.uint32), *lowered.values()]))
        self.letters = letters[_is_letter(letters)]
        self.alphabet = len(self.letters) + 3  # and one that pads
        self.tables, self.bits = [], []
        for k in self.languages:
            symbols = self.symbols(lowered[k])[0]
            moves = Automaton(symbols, self.alphabet - 1).moves
            # A missing move ends the phrase and starts the next with the same symbol; a symbol
            # that the whole sample lacks is a phrase of its own. Two bits hold the phrases ended.
            begin = np.maximum(moves[0], 0)
            ended = np.where(moves >= 0, 0, np.where(moves[0] >= 0, 1, 2))
            ended[0, moves[0] < 0] = 1
            to = np.column_stack([np.where(moves >= 0, moves, begin), np.arange(len(moves))]).astype(np.int64)
            table = (to * self.alphabet << 2 | np.column_stack([ended, np.zeros(len(moves), np.int64)])).ravel()
            self.tables.append(table.astype(np.int32) if table.max() < 1 << 31 else table)
            self.bits.append(np.log2(len(symbols) + 2))

    def symbols(self, found: np.ndarray, rows: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Symbols of code points; runs without letters become one symbol."""
        place = np.searchsorted(self.letters, found)
        place[place == len(self.letters)] = 0
        known = self.letters[place] == found if len(self.letters) else np.zeros(len(found), bool)
        out = np.where(known, place + 2, np.where(_is_letter(found), UNKNOWN, OTHER))
        keep = np.ones(len(out), bool)
        keep[1:] = (out[1:] != OTHER) | (out[:-1] != OTHER)
        if rows is not None:
            keep[1:] |= rows[1:] != rows[:-1]
            rows = rows[keep]
        return out[keep], rows

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Bits a symbol by language (texts x languages), and which texts hold a letter."""
        parts = [points(t) for t in texts]
        rows = np.repeat(np.arange(len(texts)), [len(p) for p in parts])
        found, rows = self.symbols(np.concatenate([np.empty(0, np.uint32), *parts]), rows)
        sizes = np.bincount(rows, minlength=len(texts))
        lettered = np.bincount(rows, found != OTHER, minlength=len(texts)) > 0
        pieces = -(-sizes // self.segment)
        owner = np.repeat(np.arange(len(texts)), pieces)
        grid = np.full((len(owner), self.segment), self.alphabet - 1, np.int32)
        column = np.arange(len(found)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        grid[np.repeat(np.cumsum(pieces) - pieces, sizes) + column // self.segment, column % self.segment] = found
        grid = np.ascontiguousarray(grid.T)
        bits = np.empty((len(texts), len(self.languages)))
        for k, (table, cost) in enumerate(zip(self.tables, self.bits, strict=True)):
            at, count = np.zeros(len(owner), table.dtype), np.zeros(len(owner), np.int64)
            for line in grid:
                at = table[at + line]
                count += at & 3
                at >>= 2
            count += at > 0
            bits[:, k] = np.bincount(owner, count, minlength=len(texts)) * cost / np.maximum(sizes, 1)
        return bits, lettered

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        bits, lettered = self.phrases([t or "" for t in texts])
        best = bits.argmin(axis=1)
        ordered = np.sort(bits, axis=1)
        rest = ordered[:, 1] if len(self.languages) > 1 else np.full(len(texts), np.inf)
        score = np.where(lettered, 1 - ordered[:, 0] / np.maximum(rest, 1e-12), 0.0)
        return [self.languages[b] if ok else UNDETERMINED for b, ok in zip(best, lettered, strict=True)], score


_LETTER = np.array([chr(c).isalpha() for c in range(0x30000)])


def _is_letter(found: np.ndarray) -> np.ndarray:
    return _LETTER[np.minimum(found, len(_LETTER) - 1)]


def points(text: str) -> np.ndarray:
    """Code points of the text in lower case."""
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def learn(labelled: DataFrame, s: Settings) -> dict[str, str]:
    """Whole sample texts by language from rows (doc_id, text, lang), ``s.sample`` characters each or one text that is longer.

    The rows are dealt into ``s.texts`` slots a language by a hash. Each slot proposes its row of least
    hash, or its shortest if all are over ``s.longest``, found by a grouped minimum of longs; those of least hash
    that fit the sample together are learned. Repeated rows count once, texts without characters never.
    """
    rows = labelled.where("length(text) > 0 AND lang IS NOT NULL").withColumn("h", F.xxhash64("doc_id", "text"))
    rows = rows.withColumn("n", F.length("text").cast("long"))
    over = F.when(F.col("n") > s.longest, F.col("n")).otherwise(0).alias("over")
    slots = rows.groupBy("lang", F.pmod("h", F.lit(s.texts)).alias("slot")).agg(F.min(F.struct(over, "h", "n")).alias("c"))
    upto = Window.partitionBy("lang").orderBy("over", "h").rowsBetween(Window.unboundedPreceding, 0)
    chosen = slots.select("lang", "c.*").withColumn("upto", F.sum("n").over(upto)).where((F.col("upto") <= s.sample) | (F.col("upto") == F.col("n")))
    picked: dict[str, list[int]] = {}
    for row in chosen.select("lang", "h").collect():
        picked.setdefault(row["lang"], []).append(row["h"])
    wanted = F.col("h").isin([h for hs in picked.values() for h in hs])
    found = {(r["lang"], r["h"]): r["text"] for r in rows.where(wanted).select("lang", "h", "text").distinct().collect()}
    return {lang: "\n".join(found[lang, h] for h in sorted(hs)) for lang, hs in picked.items()}


def predict(docs: DataFrame, samples: dict[str, str], s: Settings = Settings()) -> DataFrame:
    """Add lang_pred and score to rows with a text; the whole text is parsed.

    score is how many fewer bits the winner needs than the second, as a share of the second's:
    0 for a tie (the alphabetically first wins), 1 if only one language is known. Texts that
    are null or without letters get ``und`` and 0, as all texts do if nothing was learned.
    All columns of ``docs`` stay; columns named lang_pred or score are replaced.
    """
    docs = docs.drop("lang_pred", "score")
    names = docs.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = held(("parser", s.segment, tuple(sorted(samples.items()))), lambda: Parser(samples, s.segment))
        for batch in batches:
            for part in steps(batch, "text"):
                lang, score = parser.predict(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), pa.array(lang, pa.string()), pa.array(score)], [*names, "lang_pred", "score"])

    return docs.mapInArrow(lean(label, holds=True), f"{schema}, lang_pred string, score double")


def identify(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Learn from the rows with a lang that aren't held out, then predict every row (doc_id, held_out, lang_pred, score).

    held_out marks rows whose crc32(doc_id as text) leaves remainder 2 by 4.
    """
    fold = docs.select(F.col("doc_id"), "text", "lang", (crc_fold() == 2).alias("held_out"))
    samples = learn(fold.where("NOT held_out"), s)
    return predict(fold.select("doc_id", "held_out", "text"), samples, s).drop("text")
