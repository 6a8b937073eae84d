from __future__ import annotations

import random
import re

import numpy as np
import pytest

from emberscope.llm import caps, minhash, partitions
from emberscope.llm.components import components

from .conftest import ODD

WORD = re.compile("[^\x20\x09-\x0d]+")


def groups(ids, links):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in root}


def test_components_of_chain_star_and_ring(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    frame = spark.createDataFrame([*links, (None, 3), (201, 200)], "a long, b long")
    got = {r.id: r.component for r in components(frame).collect()}
    want = groups({i for a, b in links for i in (a, b) if a != b}, [(a, b) for a, b in links if a != b])
    assert got == want
    assert components(frame.limit(0)).count() == 0


def near_copies(seed):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choices("abcdefg", k=5))
    rows, base = [], [word() for _ in range(60)]
    for i in range(150):  # one large group around the threshold, with exact copies
        text = base[:]
        for _ in range(draw.choice([0, 1, 2, 3, 5])):
            text[draw.randrange(60)] = word().upper()
        rows.append((2000 + i * 3, " ".join(text)))
    for i in range(60):
        rows.append((1000 + i, " ".join(word() for _ in range(draw.choice([1, 2, 3, 30])))))
    return rows


def brute(rows, width, numerator):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, t in rows:
        w = WORD.findall((t or "").translate(lower))
        sets[i] = {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()
    ids = sorted(sets)
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= numerator * len(sets[a] | sets[b])]
    return sets, groups(ids, links)


@pytest.mark.parametrize(("width", "numerator"), [(3, 85), (5, 80)])
def test_near_duplicates_equal_brute_force(documents, monkeypatch, width, numerator):
    monkeypatch.setattr(minhash, "SMALL", 4)
    rows = [*ODD[:7], *near_copies(width)]
    settings = minhash.Settings(width=width, numerator=numerator, block=16)
    out = minhash.near_duplicates(documents([*rows, *ODD[7:]]), settings).collect()
    sets, want = brute(rows, width, numerator)
    assert len(out) == len(rows) + 2
    for r in out:
        if r.doc_id is None:
            assert r.kept and r.component_id is None
            continue
        assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), want[r.doc_id], want[r.doc_id] == r.doc_id)
    assert len(set(want.values())) < len(rows) - 20


def test_one_id_with_two_texts_joins_their_groups(documents):
    a, b = ("one two three four five six seven", "ten nine eight seven six five four")
    out = minhash.near_duplicates(documents([(5, a), (5, b), (9, a), (4, b)])).collect()
    assert {(r.doc_id, r.component_id) for r in out} == {(5, 4), (9, 4), (4, 4)} and len(out) == 4


def test_no_documents_no_groups(documents):
    assert minhash.near_duplicates(documents([])).count() == 0


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, key string")


def cloud(seed, n):
    """Near copies in one dense group, pairs about the threshold, equal, scaled and unrelated vectors."""
    draw = np.random.default_rng(seed)
    base = draw.normal(size=64)
    out = [base + draw.normal(size=64) * 0.35 for _ in range(n)]
    for _ in range(n):
        x = draw.normal(size=64)
        x /= np.linalg.norm(x)
        z = draw.normal(size=64)
        z -= z @ x * x
        c = draw.choice([0.85, 0.91, 0.95, 0.999])
        out += [x, c * x + np.sqrt(1 - c * c) * z / np.linalg.norm(z)]
    out += [out[0], out[0], out[1] * 4]
    return [(7 * i + 3, np.asarray(v, np.float32).tolist()) for i, v in enumerate(out)]


def test_near_vectors_equal_brute_force(spark):
    rows = cloud(1, 120)
    odd = [(1, None), (2, []), (4, [0.0] * 64), (5, [float("nan")] + [1.0] * 63), (6, [None] + [1.0] * 63), (8, [float("inf")] * 64), (None, rows[0][1]), (9, [1.0, 2.0]), (11, [1.0, 2.1])]
    out = caps.near_vectors(vectors(spark, [*rows, *odd]), caps.Settings(block=32, small=8)).collect()
    assert len(out) == len(rows) + len(odd)
    ids = [i for i, _ in rows]
    u = np.array([v for _, v in rows], float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = (u @ u.T >= 0.9) & ~np.eye(len(u), dtype=bool)
    want = groups(ids, [(ids[a], ids[b]) for a, b in np.argwhere(near) if a < b])
    count = dict(zip(ids, near.sum(axis=1), strict=True))
    for r in out:
        if r.vec_id in count:
            assert (r.n_links, r.component_id, r.kept) == (count[r.vec_id], want[r.vec_id], want[r.vec_id] == r.vec_id)
        elif r.vec_id in (9, 11):
            assert (r.n_links, r.component_id) == (1, 9)
        else:
            assert (r.n_links, r.component_id, r.kept) == (0, r.vec_id, True)


def test_repeated_ids_and_empty_table(spark):
    v = [1.0, 2.0, 3.0]
    out = caps.near_vectors(vectors(spark, [(3, v), (3, v), (3, [-1.0, 0.0, 0.0])])).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in out) == [(3, 0, 3), (3, 1, 3), (3, 1, 3)]
    assert caps.near_vectors(vectors(spark, [])).count() == 0


@pytest.mark.parametrize("n", [1_000, 27_000, 10**6, 10**8])
def test_codes_find_pairs_at_the_threshold_at_every_size(n):
    s = caps.Settings()
    margin, codes = caps.plan(64, n, s)
    x, y = caps.pairs_at(s.cosine, 64, 4000, 99)
    assert np.allclose(np.sum(x * y, axis=1), s.cosine)
    met = np.zeros(len(x), bool)
    for k in range(codes):
        left = np.flatnonzero(~met)
        met[left] = caps.meeting(caps.Code(64, *caps.shape(64, n, s), s.seed + k), x[left], y[left], margin)
    assert met.mean() >= 0.999


@pytest.mark.parametrize("dim", [1, 2, 3, 5, 8, 12, 30])
def test_short_vectors_have_plans_that_find_their_pairs(dim):
    s = caps.Settings()
    margin, codes = caps.plan(dim, 50_000, s)
    x, y = caps.pairs_at(s.cosine, dim, 1000, 7)
    met = np.any([caps.meeting(caps.Code(dim, *caps.shape(dim, 50_000, s), s.seed + k), x, y, margin) for k in range(codes)], axis=0)
    assert met.mean() >= 0.998 and codes <= 40


def test_decoding_lists_all_filters_within_the_margin():
    code = caps.Code(24, 3, 9, 1)
    x = caps.units(np.random.default_rng(5).normal(size=(50, 24)))
    turned = x @ code.turn
    a, b, c = (turned[:, 8 * p : 8 * p + 8] @ code.books[p] for p in range(3))
    sums = (a[:, :, None, None] + b[:, None, :, None] + c[:, None, None, :]).reshape(50, -1)
    want = np.argwhere(sums >= sums.max(axis=1, keepdims=True) - 0.3)
    row, found = code.decode(x, 0.3)
    assert sorted(zip(row.tolist(), found.tolist())) == sorted(map(tuple, want.tolist()))


def test_search_recall_scores_and_ties(spark):
    rows = cloud(4, 300)
    rows += [(100_000 + i, rows[5][1]) for i in range(8)]  # equal vectors tie
    odd = [(50, None), (0, [0.0] * 64), (150, [float("nan")] * 64), (None, rows[0][1])]
    out = partitions.search(vectors(spark, [*rows, *odd]), every=50).collect()
    ids = np.array([i for i, _ in rows])
    u = np.array([v for _, v in rows], float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    asked = [i for i in ids if i % 50 == 0]
    got = {i: [r for r in sorted(out, key=lambda r: r["rank"]) if r.query_id == i] for i in asked}
    assert set(got) == {r.query_id for r in out}
    hits = 0
    for i in asked:
        near = u[ids == i][0] @ u.T
        order = sorted((j for j in range(len(ids)) if ids[j] != i), key=lambda j: (-round(near[j], 12), ids[j]))[:5]
        assert [r["rank"] for r in got[i]] == [1, 2, 3, 4, 5]
        assert all(abs(near[ids == r.vec_id][0] - r.score) < 1e-12 for r in got[i])
        assert [(-r.score, r.vec_id) for r in got[i]] == sorted((-r.score, r.vec_id) for r in got[i])
        hits += len({ids[j] for j in order} & {r.vec_id for r in got[i]})
    assert hits >= 0.9 * 5 * len(asked)


def test_search_with_few_or_no_candidates(spark):
    assert partitions.search(vectors(spark, [])).count() == 0
    out = partitions.search(vectors(spark, [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0])])).collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in out] == [(0, 1, 1)]


def test_partitions_are_balanced():
    draw = np.random.default_rng(3)
    x = caps.units(draw.normal(size=(800, 16)))
    part = partitions.cut_graph(partitions._nearest(x, 8), x, 8, 20, 1)
    assert np.bincount(part, minlength=8).max() <= 105


@pytest.mark.parametrize("kind", ["even", "queries unlike the rest"])
def test_search_finds_neighbours_whatever_the_tasks_and_queries(spark, kind):
    draw = np.random.default_rng(8)
    x = draw.normal(size=(3000, 24)) if kind == "even" else draw.normal(size=(3000, 3)) @ draw.normal(size=(3, 24)) + 0.1 * draw.normal(size=(3000, 24))
    asked = np.arange(0, 3000, 50)
    x[asked] = draw.normal(size=(len(asked), 24))
    x = x.astype(np.float32)
    was = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = partitions.search(vectors(spark, [(i, v.tolist()) for i, v in enumerate(x)])).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", was)
    u = caps.units(x.astype(float))
    near = u[asked] @ u.T
    near[np.arange(len(asked)), asked] = -2
    fifth = np.sort(near, axis=1)[:, -5]
    assert len(out) == 5 * len(asked)
    assert sum(r.score >= fifth[r.query_id // 50] - 1e-12 for r in out) >= 0.9 * len(out)
