from __future__ import annotations

import random

import numpy as np
import pytest

from emberscope.llm import mixing, quality, style_tree

from .test_text import prose


def test_targets_within_reach_are_met_beside_one_out_of_reach(spark, documents):
    draw = random.Random(9)
    words = {"clean": prose(draw, "aa", 40).split(), "poor": prose(draw, "bb", 40).split(), "toxic": prose(draw, "cc", 40).split()}
    both = words["clean"] + words["toxic"]
    kinds = ["poor"] * 2 + [draw.choice(["clean", "clean", "toxic"]) for _ in range(300)]
    # Clean and toxic texts share most words, so that their posteriors are soft.
    rows = [(i, " ".join(draw.choices(both if k != "poor" else words[k], k=30) + draw.choices(words[k], k=6))) for i, k in enumerate(kinds)]
    labels = spark.createDataFrame([(i, int(k != "poor"), int(k == "toxic")) for i, k in enumerate(kinds)], "doc_id long, quality int, toxic int")
    s = mixing.Settings(targets={"clean": 0.7, "poor": 0.1, "toxic": 0.2})
    out = mixing.mixture(documents(rows), labels, s).collect()
    n = np.array([r.n_tokens for r in out], float)
    p = np.array([[r.p_clean, r.p_poor, r.p_toxic] for r in out])
    # Plain steps in numpy, as many as it takes.
    goal, curve, own = np.array([0.7, 0.1, 0.2]) * n.sum(), n @ p, np.ones(len(out))
    for _ in range(20_000):
        own = np.clip(own - p @ (((own * n) @ p - goal) / curve), 0, s.most)
    best, got = (own * n) @ p / n.sum(), (np.array([r.rate for r in out]) * n) @ p / n.sum()
    assert best[1] < 0.05
    assert got == pytest.approx(best, abs=s.tolerance)


def test_quality_learns_from_whole_texts(spark, documents):
    draw = random.Random(10)
    rows, labels = [], []
    for i in range(240):
        good = i % 2
        tail = prose(draw, "bb", 900) if good else "### buy !!! " * 600
        rows.append((i, prose(draw, "aa", 2500)[:10_000].ljust(10_000, "a") + " " + tail))
        labels.append((i, good, 0))
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in quality.rate_all(documents(rows), marks).collect()}
    held = [(i, y) for i, y, _ in labels if out[i].held_out]
    assert len(held) > 30 and np.mean([out[i].predicted == y for i, y in held]) > 0.95


def test_main_text_survives_odd_attributes_and_raw_elements():
    for given in ('style="overflow:hidden"', 'title="a hidden place"', 'aria-hidden="false"', 'data-id="search-3"', "data-class=ad", "x='class=ad'"):
        assert style_tree.main_text(f"<article {given}><p>Own text</p></article>", set()) == "Own text"
        assert style_tree.main_text(f"<div {given}><p>Own text</p></div>", set()) == "Own text"
    for given in ("hidden", 'class="ad"', 'CLASS = "box ad"', "id=comments", 'role="navigation"'):
        assert style_tree.main_text(f"<article><p>Own</p><div {given}>other</div></article>", set()) == "Own"
    for name in ("post-header", "article-header", "banner", "related", "notice"):
        page = f'<article><div class="{name}">Headline</div><p>Own</p></article>'
        assert style_tree.main_text(page, set()) == "Headline Own"
        low = {b.paths[-1] for b in style_tree.parse(page)[0] if b.text == "Headline"}
        assert style_tree.main_text(page, low) == "Own"
    for raw in ('<svg viewBox="0 0 1 1"/>', "<svg/>", "<object data=x>", "<noscript>", "<svg><svg>in</svg>side</svg>", "<script>x</script>", "<object><p>in</object>"):
        assert style_tree.main_text(f"<article><p>Own {raw} text<p>more</article>", set()) == "Own text more"
    assert style_tree.main_text("<article>Own <object data=x> text <svg/> and <svg>no</svg> more <object>no</object></article>", set()) == "Own text and more"
    style_tree.parse("<object>" * 20_000)
