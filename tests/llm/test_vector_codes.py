from __future__ import annotations

import hashlib
from collections import Counter
from fractions import Fraction
from math import floor, isfinite

import numpy as np
import pytest

from emberscope.llm import vector_codes
from emberscope.llm.vector_codes import LIMIT, Settings, dots, integers, nearest


def brute(rows, s=Settings()):
    """Plain Python integers; rows of (vec_id, vector, label) of one length."""
    rows = [r for r in rows if r[1] is not None and all(x is not None and isfinite(x) for x in r[1])]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    ints = [[floor(Fraction(x) * s.scale) for x in r[1]] for r in rows]
    cut = [[v[i : i + len(v) // s.parts] for i in range(0, len(v), len(v) // s.parts)] for v in ints]
    books = [[list(v[p]) for v in cut[: s.entries]] for p in range(s.parts)]

    def assign(v, p):
        return min((sum((a - b) ** 2 for a, b in zip(v[p], e, strict=True)), k) for k, e in enumerate(books[p]))

    for _ in range(s.rounds):
        new = [[list(e) for e in b] for b in books]
        for p in range(s.parts):
            of = [assign(v, p)[1] for v in cut]
            for k in set(of):
                mine = [v[p] for v, o in zip(cut, of, strict=True) if o == k]
                new[p][k] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
        books = new
    found = [[assign(v, p) for p in range(s.parts)] for v in cut]
    errors = [sum(d for d, _ in f) for f in found]
    total = Counter()
    for r, e in zip(rows, errors, strict=True):
        total[r[2]] += e
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [(r[0], "".join(f"{k:02x}" for _, k in f), e, total[r[2]], sha) for r, f, e in zip(rows, found, errors, strict=True)]


def order(r):
    return tuple((v is not None, v) for v in r)


SCHEMA = "vec_id long, embedding array<double>, label int, d long, error string, `of` int, codes int"


@pytest.fixture()
def vectors(spark):
    return lambda rows, schema=SCHEMA: spark.createDataFrame([(*r, 5, "e", 6, 7) for r in rows], schema)


def test_codes_equal_brute_force(vectors):
    draw = np.random.default_rng(2)
    rows = [(int(i), [float(x) for x in draw.normal(0, 0.4, 32)], [None, 1, 2, 3][i % 4]) for i in draw.permutation(160)]
    rows += [rows[0], rows[1], (None, rows[2][1], 1), (500, rows[3][1], None), (501, [0.0] * 32, 9), (502, [-0.001] * 32, 9)]
    bad = [(600, None, 1), (601, [1.0] * 31 + [None], 1), (602, [1.0] * 31 + [float("nan")], None), (603, [float("-inf")] * 32, 2), (604, [], 1), (605, [1.0] * 7, 1)]
    out = vector_codes.compress(vectors(rows + bad))
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, out.collect()), key=order) == sorted(brute(rows), key=order)


def test_few_and_equal_and_no_vectors(vectors):
    few = [(i, [i % 2 + 0.5] * 16, None) for i in range(5)]
    assert sorted(map(tuple, vector_codes.compress(vectors(few)).collect())) == brute(few)
    assert all(r[1] in ("00" * 16, "01" * 16) and r[2] == 0 for r in brute(few))
    assert vector_codes.compress(vectors([])).count() == 0
    assert vector_codes.compress(vectors([(1, None, 1)])).count() == 0


def test_lengths_apart_and_floats(vectors):
    draw = np.random.default_rng(4)
    short = [(i, [float(x) for x in draw.normal(size=16).astype(np.float32)], 1) for i in range(70)]
    long = [(100 + i, [float(x) for x in draw.normal(size=48).astype(np.float32)], 2) for i in range(70)]
    out = vector_codes.compress(vectors(short + long, SCHEMA.replace("double", "float")))
    assert sorted(map(tuple, out.collect())) == brute(short) + brute(long)


def test_large_numbers(vectors):
    draw = np.random.default_rng(6)
    rows = [(i, [float(x) for x in draw.normal(0, 10.0 ** (i % 7), 16)], i % 3) for i in range(90)]
    assert sorted(map(tuple, vector_codes.compress(vectors(rows)).collect())) == brute(rows)
    wild = vector_codes.compress(vectors([*rows, (99, [1e300] * 16, 0), (100, [-1.7e308] * 16, 0)])).collect()
    assert len(wild) == 92 and all(0 <= r.error <= vector_codes.LONGEST for r in wild)


def test_limbs_are_exact():
    draw = np.random.default_rng(1)
    for bits, width in ((3, 1), (20, 8), (27, 64), (29, 3), (24, 1000)):
        x, c = (draw.integers(-(1 << bits), 1 << bits, (n, width)) for n in (40, 9))
        x[0], c[0] = 1 << bits, -(1 << bits)
        assert (dots(x, c) == (x.astype(object) @ c.astype(object).T)).all()
        far = ((x.astype(object)[:, None] - c.astype(object)) ** 2).sum(axis=2)
        best, least = nearest(x, c)
        assert (least == far.min(axis=1)).all() and all(list(f).index(v) == b for f, v, b in zip(far, least, best, strict=True))
    huge = np.array([[LIMIT, -LIMIT], [LIMIT - 1, 5]])
    assert nearest(huge, huge)[0].tolist() == [0, 1]
    assert integers(np.array([0.999 / 256, -0.001, 1e30, -1e308, -0.0, 3.0]), 256).tolist() == [0, -1, LIMIT, -LIMIT, 0, 768]
