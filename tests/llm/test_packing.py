from __future__ import annotations

import bisect
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer

from emberscope.llm import packing, token_files
from emberscope.llm.tokens import Encoder

from .conftest import ODD


def one_by_one(lengths, capacity):
    rooms, windows = [], 0
    for n in sorted(lengths, reverse=True):
        at = bisect.bisect_left(rooms, n)
        room = rooms.pop(at) if at < len(rooms) else capacity
        windows += room == capacity
        if room > n:
            bisect.insort(rooms, room - n)
    return windows, rooms


@given(st.lists(st.integers(1, 50), max_size=120))
def test_plan_equals_placing_one_by_one(lengths):
    runs, windows = packing.plan(Counter(lengths), 50)
    spans = {}
    for length, _, many, first, offset in runs:
        for w in range(first, first + many):
            spans.setdefault(w, []).append((offset, length))
    for window in spans.values():
        end = 0
        for offset, length in sorted(window):
            assert offset == end
            end += length
    free = sorted(50 - sum(n for _, n in w) for w in spans.values())
    assert (windows, [f for f in free if f]) == one_by_one(lengths, 50)
    assert sorted(set(spans)) == list(range(windows))


def test_a_piece_that_does_not_fit_is_refused():
    with pytest.raises(ValueError):
        packing.plan({9: 1}, 8)


@pytest.mark.parametrize("name", ["word_bpe_49k", "byte_bpe_50k"])
def test_encoder_equals_the_library(vocabularies, name):
    texts = ["", " ", "  a", " a  b ", "a\n b", "x \n\ny\tz", "It's 'll É. é é́ ß, ÀÖ øÿ.", "ΑΣ ΑΣ. İx", "<|endoftext|> a<|endoftext|>", "hello <|endoftext|> world", "a<|startoftext|>b <|ENDOFTEXT|>", "日本 語", "one.\nTwo!! three.%%%\nÄb,\n\nc", "\na b\n", "x" * 5000, "a b", "ends. in, signs!"]
    library = Tokenizer.from_file(vocabularies[name])
    own = Encoder(vocabularies[name])

    def check(some):
        assert [x.tolist() for x in own.encode(some)] == [x.ids for x in library.encode_batch(some, add_special_tokens=False)]

    check(texts)

    @given(st.lists(st.text(st.sampled_from("aB éÀ.,'\n\t 9 ́ſ") | st.characters(codec="utf-8"), max_size=30), max_size=5))
    def anything(some):
        check(some)

    anything()


def ids_of(vocabulary, rows):
    library = Tokenizer.from_file(vocabulary)
    return [np.array(library.encode(t or "", add_special_tokens=False).ids + [2], "<u4") for _, t in rows]


def test_packed_pieces_hold_each_id_once(documents, vocabularies):
    rows = [*ODD[:8], *((100 + i, "some words " * (i % 700)) for i in range(300))]
    out = packing.pack_documents(documents(rows), vocabularies["word_bpe_49k"], capacity=512).collect()
    want = Counter((d, i.tobytes()) for (d, _), i in zip(rows, ids_of(vocabularies["word_bpe_49k"], rows), strict=True))
    whole = {d: b for d, b in want}
    assert sum(r.length for r in out) == sum(len(b) // 4 * n for (_, b), n in want.items())
    windows = {}
    for r in out:
        assert bytes(r.ids) == whole[r.doc_id][4 * r.start : 4 * (r.start + r.length)]
        assert r.ids_crc32 == zlib.crc32(bytes(r.ids)) and r.doc_tokens == len(whole[r.doc_id]) // 4
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in windows.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= 512
    assert len(windows) == one_by_one([r.length for r in out], 512)[0]


def test_nothing_to_pack(documents, vocabularies):
    assert packing.pack_documents(documents([]), vocabularies["word_bpe_49k"]).count() == 0


@given(st.lists(st.sampled_from([0, 1, 255, 256, 65535, 65536, 1 << 24, (1 << 32) - 1]), max_size=40))
def test_ranks_come_back(ranks):
    ranks = np.array(ranks, np.uint32)
    control, data = token_files.encode_ranks(ranks)
    assert len(control) == -(-len(ranks) // 4)
    assert token_files.decode_ranks(control, data, len(ranks)).tolist() == ranks.tolist()


def test_files_in_order_of_id(spark, documents, vocabularies, fresh, monkeypatch):
    monkeypatch.setattr(token_files, "SHARD_BYTES", 200)
    rows = [*ODD, *((100 - i, f"text number {i} " * (i % 9)) for i in range(60))]
    token_files.write(documents(rows).repartition(5), fresh, vocabularies["byte_bpe_50k"])
    out = token_files.with_starts(token_files.read(spark, fresh), fresh).orderBy("start").collect()
    keys = [-1 if r.doc_id is None else r.doc_id for r in out]
    assert keys == sorted(keys) and len(out) == len(rows)
    want = Counter(zip([d for d, _ in rows], [i.tobytes() for i in ids_of(vocabularies["byte_bpe_50k"], rows)], strict=True))
    assert Counter((r.doc_id, bytes(r.ids)) for r in out) == want
    at = 0
    for r in out:
        assert r.start == at and r.n_tokens * 4 == len(r.ids)
        at += r.n_tokens
    shards = spark.read.format("binaryFile").load(f"file://{fresh}/shard-*.ids").count()
    assert shards > 3


def test_no_documents_no_ids(spark, documents, vocabularies):
    assert token_files.digest(documents([]), vocabularies["byte_bpe_50k"]).count() == 0


def test_codecs_and_runs_of_signs_are_not_made_anew(vocabularies, monkeypatch):
    from emberscope.llm import tokens

    made, zstd = [], token_files.zstandard.ZstdCompressor
    monkeypatch.setattr(token_files.zstandard, "ZstdCompressor", lambda **k: made.append(1) or zstd(**k))
    for i in range(5):
        ids = np.arange(i + 1, dtype=np.uint32) * 40_000
        assert token_files._unzip(token_files._zip(ids)).tolist() == ids.tolist()
    assert len(made) <= 1
    own = tokens.Encoder(vocabularies["byte_bpe_50k"])
    texts = ["one, two, three!! Größe, $%", "four, !! five,\nsix.", ""]
    assert [i.tolist() for i in own.encode(texts)] == [e.ids for e in own.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert own.rest.signs[","] == own.tokenizer.encode(",", add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["word_bpe_49k", "byte_bpe_50k"])
def test_plain_words_are_kept_once_whatever_signs_follow(vocabularies, name):
    own = Encoder(vocabularies[name])
    texts = ["word word, word. Größe!! word*** Größe", "word, a.b, a.b!! 9, 9! \nso, so\n. ,, !! (x). it's, word", "  word,", "word,", "", "Größe, ", "é.", "x" * 300 + ". " + "y," * 99]
    for some in (texts, [], [""], texts[::-1], ["one"], ["<|endoftext|> word,"]):
        assert [i.tolist() for i in own.encode(some)] == [e.ids for e in own.tokenizer.encode_batch(some, add_special_tokens=False)]
    assert {"word", "Größe", "a.b,", "it's,"} <= set(own.rest.seen)
    assert not {"word,", "word.", "word***", "Größe!!"} & set(own.rest.seen)
