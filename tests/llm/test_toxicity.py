from __future__ import annotations

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from emberscope.llm import toxicity

from .conftest import ODD
from .test_text import prose

LABELS = "doc_id long, quality int, toxic int"


def test_linear_time_identity():
    draw = np.random.default_rng(1)
    known = np.sort(draw.choice(1 << 20, 40, replace=False))
    m = toxicity.Machine(0.2, known, draw.normal(size=40), draw.normal(size=(40, 3)))
    rows = [np.sort(draw.choice(40, n, replace=False)) for n in (0, 1, 2, 9, 0, 30)]
    logit, _ = m.logits(np.concatenate(rows), np.cumsum([0, *map(len, rows)]))
    for r, got in zip(rows, logit, strict=True):
        pairs = sum(m.factors[i] @ m.factors[j] for i, j in itertools.combinations(r, 2))
        assert got == pytest.approx(0.2 + m.linear[r].sum() + pairs)


def test_terms_of_a_text():
    s = toxicity.Settings()
    texts = pa.array(["You, IDIOT! idiots", "you idiot", None, "", "?! ..", "idio", "a" * 70_000])
    bucket, row = toxicity.terms(texts, s)
    of = [set(bucket[row == i].tolist()) for i in range(7)]
    assert of[1] < of[0] and not of[2] | of[3] | of[4] and of[5] & of[1] and len(of[6]) == 4


def corpus(draw, n):
    """Toxic: an insult in any inflection, or a common word together with a group's name, either being harmless alone."""
    rows, labels = [], []
    for i in range(n):
        words = prose(draw, draw.choice(["aa", "bb"]), draw.choice([5, 40, 40, 400])).split()
        kind = draw.choice(["insult", "pair", "left", "right", "no", "no", "no", "no"])
        extra = {"insult": ["zornig" + draw.choice(["", "es", "em", "kram", "wust"])], "pair": ["grupp", "away"], "left": ["grupp"], "right": ["away"], "no": []}[kind]
        for e in extra:
            words.insert(draw.randint(0, len(words)), e + draw.choice(["", ",", "!"]))
        rows.append((i, " ".join(words)))
        labels.append((i, None, int(kind in ("insult", "pair"))))
    return rows, labels


def test_held_out_texts(spark, documents):
    rows, labels = corpus(random.Random(7), 3000)
    odd = [(10_000 + n, t) for n, (_, t) in enumerate(ODD)] + [(None, "zornig"), rows[0]]
    marks = spark.createDataFrame([*labels, labels[5], (7, 1, None), (8, 0, 4), (None, 1, 1)], LABELS)
    out = toxicity.rate_all(documents(rows + odd), marks)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    got = {r.doc_id: r for r in out.collect()}
    assert len(got) == 3000 + len(ODD) + 1 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    held = [(got[i].predicted, y) for i, _, y in labels if got[i].held_out]
    assert len(held) > 600
    assert np.mean([p for p, y in held if y]) > 0.95 and np.mean([p for p, y in held if not y]) < 0.05
    assert got[10_000].score == got[10_001].score == got[10_002].score and got[10_005].score == got[10_006].score
    assert got[None].predicted == 1


def test_pairs_beyond_additive_weights(spark, documents):
    """Either word alone makes a text toxic, both together don't: no sum of weights can say that."""
    draw = random.Random(11)
    rows, labels = [], []
    for i in range(2400):
        extra = draw.choice([["grupp"], ["away"], ["grupp", "away"], [], []])
        words = prose(draw, "aa", 40).split() + extra
        rows.append((i, " ".join(draw.sample(words, len(words)))))
        labels.append((i, None, int(len(extra) == 1)))
    docs, marks = documents(rows), spark.createDataFrame(labels, LABELS)
    right = {}
    for k in (0, 4):
        out = {r.doc_id: r for r in toxicity.rate_all(docs, marks, toxicity.Settings(factors=k, threshold=0.5)).where("held_out").collect()}
        right[k] = np.mean([out[i].predicted == y for i, _, y in labels if i in out])
    assert right[4] > 0.98 and right[0] < 0.85


def test_without_labels_or_rows(spark, documents):
    none = spark.createDataFrame([], LABELS)
    assert [r.score for r in toxicity.rate_all(documents([(1, "text"), (1, "text")]), none).collect()] == [0.5, 0.5]
    assert toxicity.rate_all(documents([]), none).count() == 0
    ones = spark.createDataFrame([(i, 0, 1) for i in range(40)], LABELS)
    out = toxicity.rate_all(documents([(i, f"text {i}") for i in range(40)]), ones).collect()
    assert len({r.score for r in out}) == 1 and out[0].predicted == 1
