"""Token ids of whole texts by a vocabulary file, fast because repeated words are encoded once."""

from __future__ import annotations

import functools
import itertools
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from emberscope.llm.common import held

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Distinct words and their characters that one worker remembers; beyond either it starts afresh.
CACHED_WORDS = 800_000
CACHED_CHARS = 24_000_000

#: Words that any of the tokenizers handled here reads as one run of letters and perhaps one of signs.
_SIGNS = ".,!#$%&*"
_PLAIN = re.compile(f"([A-Za-zÀ-ÖØ-öø-ÿ]+)([{_SIGNS}]*)")
_LETTERS = "".join(c for c in map(chr, range(256)) if _PLAIN.fullmatch(c))


@functools.cache
def _as_bytes() -> dict[int, str]:
    """How byte-level vocabularies spell the bytes of each Latin-1 letter."""
    from tokenizers.pre_tokenizers import ByteLevel

    spell = ByteLevel(add_prefix_space=False, use_regex=False)
    return {c: spell.pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x100)}


class _Seen(dict):
    """Numbers words as they are first asked for and remembers which are new."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.fresh.append(word)
        return number


class _Words:
    """Ids of words that follow ``lead``, kept as one flat array with offsets."""

    def __init__(self, tokenizer, lead: str, strict: bool):
        self.tokenizer, self.lead, self.strict = tokenizer, lead, strict
        self.model = tokenizer.model
        self.mark = "Ġ" if lead else ""
        self.line = tokenizer.encode("a\na", add_special_tokens=False).ids[1:-1]
        self.lower = tokenizer.encode("A", add_special_tokens=False).ids == tokenizer.encode("a", add_special_tokens=False).ids
        self.clear()

    def clear(self) -> None:
        self.seen, self.chars, self.used = _Seen(), 0, 0
        self.signs: dict[str, list[int]] = {"": []}
        self.flat = np.empty(1 << 16, np.uint32)
        self.at = np.zeros(1, np.int64)
        self.safe = np.empty(0, bool)

    def plain(self, word: str) -> list[int] | None:
        """Ids of plain words, perhaps in lines, straight from the merge table; None if one isn't plain."""
        if "\n" not in word:
            return self.run(word, self.mark)
        found = []
        for i, part in enumerate(word.split("\n")):
            ids = self.run(part, "" if i else self.mark)
            if ids is None:
                return None
            found += self.line + ids if i else ids
        return found

    def run(self, word: str, mark: str) -> list[int] | None:
        if not (m := _PLAIN.fullmatch(word)):
            return None
        letters, signs = m.groups()
        if self.lower:
            letters = letters.lower()
        if not letters.isascii():
            letters = letters.translate(_as_bytes())
        return [t.id for t in self.model.tokenize(mark + letters)] + self.end(signs)

    def end(self, signs: str) -> list[int]:
        """Ids of signs behind a plain word; words share few runs of them, so these are looked up."""
        if (end := self.signs.get(signs)) is None:
            end = self.signs[signs] = [t.id for t in self.model.tokenize(signs)]
        return end

    def numbers(self, words) -> np.ndarray:
        return np.fromiter(map(self.seen.__getitem__, words), np.int64)

    def learn(self) -> None:
        """Encode the words that were new since the last call."""
        fresh, self.seen.fresh = self.seen.fresh, []
        if not fresh:
            return
        ids = list(map(self.plain, fresh))
        odd = [i for i, found in enumerate(ids) if found is None]
        for i, e in zip(odd, self.tokenizer.encode_batch([self.lead + fresh[i] for i in odd], add_special_tokens=False), strict=True):
            ids[i] = e.ids
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        need = self.used + int(sizes.sum())
        if need > len(self.flat):
            self.flat = np.concatenate([self.flat[: self.used], np.empty(max(need, len(self.flat)), np.uint32)])
        self.flat[self.used : need] = np.fromiter(itertools.chain.from_iterable(ids), np.uint32, need - self.used)
        self.at = np.concatenate([self.at, self.used + np.cumsum(sizes)])
        # Plain words begin and end with no white space.
        safe = np.ones(len(fresh), bool)
        if self.strict:
            safe[odd] = [bool(w) and not (w[0].isspace() or w[-1].isspace()) for w in map(fresh.__getitem__, odd)]
        self.safe = np.concatenate([self.safe, safe])
        self.used = need
        self.chars += sum(map(len, fresh))


class Encoder:
    """``encode(texts)`` equals ``Tokenizer.encode_batch(texts, add_special_tokens=False)``.

    Texts are cut at spaces. Where the tokenizer drops white space, any space is a
    boundary of its words. Where a space belongs to the word after it, the cut holds
    only between two characters that are no white space; a text with any other
    space is given to the tokenizer whole, as is one that holds an added token. A space-free text is one word.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        joined = not self.tokenizer.encode(" ", add_special_tokens=False).ids == []
        self.first = _Words(self.tokenizer, "", joined)
        self.rest = _Words(self.tokenizer, " " if joined else "", joined)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        for kept in (self.first, self.rest):
            if len(kept.seen) > CACHED_WORDS or kept.chars > CACHED_CHARS:
                kept.clear()
        out = [None if any(a in text for a in self.added) else np.empty(0, np.uint32) for text in texts]
        cut = [i for i, found in enumerate(out) if found is not None]
        if cut:
            for i, found in zip(cut, self._by_words([texts[i] for i in cut]), strict=True):
                out[i] = found
        for i, found in enumerate(out):
            if found is None:
                out[i] = np.asarray(self.tokenizer.encode(texts[i], add_special_tokens=False).ids, np.uint32)
        return out

    def _by_words(self, texts: list[str]) -> list[np.ndarray | None]:
        """Ids of texts without added tokens, None for those that only the tokenizer itself can cut.

        Words are told apart by Arrow, so that each is looked up once a call however often it occurs, and plain
        words are looked up without the signs behind them.
        """
        lists = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        bounds = lists.offsets.to_numpy().astype(np.int64)
        words = lists.values.dictionary_encode()
        place = words.indices.to_numpy().astype(np.int64)
        words, heads = words.dictionary, bounds[:-1]
        head = self.first.numbers(words.take(pa.array(place[heads])).to_pylist())
        # Those met as heads only are left out.
        tail = np.ones(len(place), bool)
        tail[heads] = False
        used = np.zeros(len(words), bool)
        used[place[tail]] = True
        place = np.cumsum(used)[place] - 1
        words = words.filter(pa.array(used))
        stems, signs = _cut(words)
        number = self.rest.numbers(stems.dictionary.to_numpy(zero_copy_only=False))[stems.indices.to_numpy()]
        self.first.learn()
        self.rest.learn()
        place[heads] = len(words) + np.arange(len(heads))
        safe = np.concatenate([self.rest.safe[number], self.first.safe[head]])
        odd = (np.diff(bounds) > 1) & ~np.logical_and.reduceat(safe[place], heads)
        # The ids of every word of this call one after the other, then those of the heads.
        ends = [self.rest.end(e) for e in signs.dictionary.to_pylist()]
        end_size = np.fromiter(map(len, ends), np.int64, len(ends))
        end_at = np.cumsum(end_size) - end_size
        ends = np.fromiter(itertools.chain.from_iterable(ends), np.uint32, int(end_size.sum()))
        sign = signs.indices.to_numpy()
        stem_size, end_size, lead_size = self.rest.at[number + 1] - self.rest.at[number], end_size[sign], self.first.at[head + 1] - self.first.at[head]
        size = np.concatenate([stem_size + end_size, lead_size])
        at = np.cumsum(size) - size
        flat = np.empty(int(size.sum()), np.uint32)
        flat[_ranges(at[: len(words)], stem_size)] = self.rest.flat[_ranges(self.rest.at[number], stem_size)]
        flat[_ranges(at[: len(words)] + stem_size, end_size)] = ends[_ranges(end_at[sign], end_size)]
        flat[_ranges(at[len(words) :], lead_size)] = self.first.flat[_ranges(self.first.at[head], lead_size)]
        size = size[place]
        ids = flat[_ranges(at[place], size)]
        stops = np.cumsum(size)[bounds[1:] - 1].tolist()
        return [None if o else ids[a:b] for o, a, b in zip(odd.tolist(), [0, *stops], stops, strict=False)]


def _cut(words: pa.Array) -> tuple[pa.DictionaryArray, pa.DictionaryArray]:
    """Plain words cut into their letters and the signs behind; others stay whole, with no signs."""
    stems, signs = pc.utf8_rtrim(words, _SIGNS), pc.utf8_ltrim(words, _LETTERS)
    letters = pc.binary_length(stems)
    plain = pc.and_(pc.greater(letters, 0), pc.equal(pc.add(letters, pc.binary_length(signs)), pc.binary_length(words)))
    return pc.if_else(plain, stems, words).dictionary_encode(), pc.if_else(plain, signs, pa.scalar("", words.type)).dictionary_encode()


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its size, one range after the other."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - ends + size, size)


def encoder(path: str) -> Encoder:
    """The encoder of this process for a vocabulary file."""
    return held(("encoder", path), lambda: Encoder(path))
