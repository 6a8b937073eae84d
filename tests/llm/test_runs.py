from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from emberscope.llm import runs

from .conftest import ODD


def brute_runs(w, least=12):
    """Stretches of words equal to those a period later, for each period; a stretch keeps its least period."""
    seen = {}
    for p in range(1, len(w) // 2 + 1):
        i = 0
        while i + p < len(w):
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            if j - i + p >= max(least, 2 * p):
                seen.setdefault((i, j + p), p)
            i = max(j, i + 1)
    return sorted((s, e - s, p) for (s, e), p in seen.items())


def periodic(draw, n, k):
    w = [draw.randint(0, k) for _ in range(n)]
    if n > 4 and draw.random() < 0.6:
        a = draw.randrange(n)
        p = 1 + (n - a) // draw.randint(2, 9)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    return w


def test_runs_equal_brute_force():
    draw = random.Random(3)
    for _ in range(150):
        texts = [periodic(draw, draw.choice([0, 1, 11, 12, 13, 40, 90, 200]), draw.choice([0, 1, 2, 4])) for _ in range(draw.randint(1, 6))]
        bounds = np.cumsum([0, *map(len, texts)])
        found = runs.find(np.array([x for t in texts for x in t], np.int64), bounds, runs.Settings(grid=draw.choice([1, 60, 1 << 20])))
        for i, t in enumerate(texts):
            assert [tuple(map(int, r[1:])) for r in found if r[0] == i] == brute_runs(t)


@pytest.mark.parametrize("symbols", [1, 2, 3, 30])
def test_extensions_of_the_grammar(symbols):
    draw = np.random.default_rng(symbols)
    text = draw.integers(0, symbols, 300)
    text[120:240] = text[:120]
    text = np.append(text, symbols)
    x, y = draw.integers(0, 300, (2, 4000))
    x, y = x[x != y], y[x != y]
    want = [next(k for k in range(301) if text[a + k] != text[b + k]) for a, b in zip(np.minimum(x, y), np.maximum(x, y), strict=True)]
    levels = runs.grammar(text)
    assert runs.common(levels, x, y).tolist() == want
    assert len(levels[-1].symbols) == 1


def expected(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(b"" if doc_id is None else str(doc_id).encode()), len(w)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute_runs(w)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    milli = best[1] * 1000 // best[2] if found else None
    return (doc_id, len(found), *best, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_digest_equals_brute_force(documents):
    draw = random.Random(8)
    words = ["ä", "Ab", "ab", "c,", " d", "e ", "日本", "f"]
    rows = [(i, "".join(words[x] + draw.choice(" \n\t\v ") for x in periodic(draw, draw.choice([0, 3, 12, 60, 150]), 7))) for i in range(250)]
    odd = [r for r in ODD if len(r[1] or "") < 1000]
    rows += [(900 + n, t) for n, (_, t) in enumerate(odd)] + odd + [(None, "a b c " * 9)] + rows[:3]
    assert sum(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows) > 10
    out = runs.digest(documents(rows))
    order = lambda r: tuple((v is not None, v) for v in r)
    assert sorted(map(tuple, out.collect()), key=order) == sorted((expected(*r) for r in rows), key=order)
    assert out.columns[:6] == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli"]


def test_runs_of_long_and_missing_texts(spark, documents):
    docs = documents([(1, "word " * 60_000), (2, None), (3, " \n "), (4, "x " + "a b " * 30_000 + "y"), (5, " ".join(map(str, range(50_000))))])
    docs = docs.selectExpr("doc_id", "text", "'mine' AS runs", "1 AS collapsed", "source AS start")
    out = {r.doc_id: r for r in runs.runs_of(docs).collect()}
    assert [tuple(r) for r in out[1].runs] == [(0, 60_000, 1)] and out[1].collapsed == "word"
    assert (out[2].runs, out[2].collapsed, out[3].runs, out[3].collapsed) == ([], "", [], "")
    assert [tuple(r) for r in out[4].runs] == [(1, 60_000, 2)] and out[4].collapsed == "x a b y"
    assert out[5].runs == [] and out[5].collapsed.endswith("49998 49999") and out[5].start == "s"
    assert runs.digest(documents([])).count() == 0
