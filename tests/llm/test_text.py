from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from emberscope.llm import langid, licenses, mixing, quality, style_tree

from .conftest import ODD


def phrases(text, sample):
    """Longest matches one after the other; a symbol that the sample lacks is a phrase."""
    n, at = 0, 0
    while at < len(text):
        k = 0
        while at + k < len(text) and text[at : at + k + 1] in sample:
            k += 1
        n += 1
        at += max(k, 1)
    return n


def test_automaton_parses_like_substring_search():
    draw = random.Random(4)
    samples = {k: "".join(draw.choices(letters, k=400)) for k, letters in {"x": "abcd ", "y": "cdef "}.items()}
    samples = {k: " ".join(v.split()) for k, v in samples.items()}
    parser = langid.Parser(samples, 1 << 12)
    texts = [" ".join("".join(draw.choices("abcdefz ", k=n)).split()) for n in (1, 5, 50, 900)]
    bits, _ = parser.phrases(texts)
    for i, t in enumerate(texts):
        for k, lang in enumerate(parser.languages):
            cost = np.log2(len(samples[lang]) + 2)
            assert bits[i, k] * len(t) / cost == pytest.approx(phrases(t, samples[lang]))


LANGS = {"aa": ["ka", "lo", "mi", "ra"], "bb": ["sch", "ung", "ein", "er"], "cc": ["ción", "os", "ez", "ue"]}


def prose(draw, lang, n):
    return " ".join("".join(draw.choices(LANGS[lang], k=draw.randint(1, 4))) for _ in range(n))


def test_languages_of_held_out_texts(documents):
    draw = random.Random(5)
    rows = [(i, prose(draw, k := draw.choice(sorted(LANGS)), draw.randint(20, 60)), k) for i in range(400)]
    odd = [(1000 + n, t) for n, (_, t) in enumerate(ODD[:7])] + [(None, prose(draw, "bb", 30))]
    out = {r.doc_id: r for r in langid.identify(documents([*rows, *odd, rows[0]])).collect()}
    assert len(out) == 408
    for i, _, k in rows:
        assert out[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= out[i].score <= 1
        assert out[i].lang_pred == k
    assert [out[1000 + n].lang_pred for n in range(4)] == ["und"] * 4 and out[1004].lang_pred in LANGS
    assert out[None].lang_pred == "bb"


def test_labelled_texts_are_learned_whole(documents):
    short = [(i, prose(random.Random(i), "aa", 30), "aa") for i in range(40)]
    long = [(100 + i, prose(random.Random(i), "bb", 3000 + i), "bb") for i in range(3)] + [(200, "x" * 99_000, "aa"), (201, None, "aa"), (202, "", "cc"), (203, "y", None)]
    s = langid.Settings(sample=2_000, longest=1_000)
    out = langid.learn(documents([*short, *long, short[0]]), s)
    assert set(out) == {"aa", "bb"} and len(out["aa"]) <= 2_000 + len(short)
    whole = {t for _, t, k in short}
    parts = out["aa"].split("\n")
    assert len(parts) > 3 and set(parts) <= whole and len(set(parts)) == len(parts)
    assert out["bb"] in {t for _, t, _ in long}


def test_nothing_learned_or_no_rows(documents):
    assert {r.lang_pred for r in langid.identify(documents([(1, "words"), (2, None)])).collect()} == {"und"}
    assert langid.identify(documents([])).count() == 0


def test_sum_of_squares_equals_all_pairs():
    draw = np.random.default_rng(6)
    m = quality.Machine(0.3, draw.normal(size=12), draw.normal(size=(12, 4)))
    x = draw.normal(size=(5, 12))
    for row, y in zip(x, m.logits(x), strict=True):
        pairs = sum(row[i] * row[j] * (m.factors[i] @ m.factors[j]) for i in range(12) for j in range(i + 1, 12))
        assert y == pytest.approx(0.3 + row @ m.linear + pairs)


def test_features_are_linear_and_whole():
    texts = pa.array([None, "", "A b\nA b", "word " * 1000 + "END"], pa.string())
    x = quality.features(texts, quality.Settings())
    assert x.shape[0] == 4 and np.isfinite(x).all()
    assert (x[0] == x[1]).all()
    assert not np.array_equal(x[3], quality.features(pa.array(["word " * 1000]), quality.Settings())[0])


def test_quality_of_held_out_texts(spark, documents):
    draw = random.Random(7)
    rows, labels = [], []
    for i in range(600):
        good = draw.random() < 0.7
        text = prose(draw, "aa", draw.randint(20, 80))
        rows.append((i, text if good else draw.choice([text.upper().replace(" ", "!! "), text.replace(" ", "### "), (text.split()[0] + " ") * 50])))
        labels.append((i, int(good), 0))
    marks = spark.createDataFrame([*labels, (5, None, 0), (None, 1, 0), labels[3]], "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in quality.rate_all(documents([*rows, *((1000 + n, t) for n, (_, t) in enumerate(ODD[:5])), (None, "x")]), marks).collect()}
    held = [(i, y) for i, y, _ in labels if out[i].held_out]
    assert len(held) > 100 and np.mean([out[i].predicted == y for i, y in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in out.values()) and len(out) == 606


def test_quality_without_labels_or_rows(spark, documents):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.score for r in quality.rate_all(documents([(1, "text")]), none).collect()] == [pytest.approx(0.5, abs=0.2)]
    assert quality.rate_all(documents([]), none).count() == 0


def test_mixing_reaches_its_targets(spark, documents):
    draw = random.Random(8)
    vocabulary = {"clean": "aa", "poor": "bb", "toxic": "cc"}
    kinds = [draw.choices(sorted(vocabulary), [6, 3, 1])[0] for _ in range(400)]
    rows = [(i, prose(draw, vocabulary[k], draw.randint(5, 60))) for i, k in enumerate(kinds)]
    labels = spark.createDataFrame([(i, int(k != "poor"), int(k == "toxic")) for i, k in enumerate(kinds) if i % 2] + [(None, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    s = mixing.Settings(targets={"clean": 0.5, "poor": 0.2, "toxic": 0.3})
    docs = documents([*rows, (1000, None), (1001, ""), (None, "ka lo mi"), rows[0]])
    out = mixing.mixture(docs, labels, s).collect()
    assert len(out) == 404
    n = np.array([r.n_tokens for r in out])
    p = np.array([[r.p_clean, r.p_poor, r.p_toxic] for r in out])
    rate = np.array([r.rate for r in out])
    assert p.sum(axis=1) == pytest.approx(1) and (rate >= 0).all() and (rate <= 4).all()
    assert {r.doc_id: r.n_tokens for r in out}[1000] == 1
    assert (rate * n) @ p / n.sum() == pytest.approx([0.5, 0.2, 0.3], abs=0.01)
    # The same steps in numpy.
    goal, curve, own = np.array([0.5, 0.2, 0.3]) * n.sum(), n @ p, np.ones(len(out))
    before = np.inf
    for _ in range(s.steps):
        off = (own * n) @ p - goal
        if np.abs(off).max() <= s.tolerance * n.sum() or np.abs(off).max() > (1 - s.least_gain) * before:
            break
        before = np.abs(off).max()
        own = np.clip(own - p @ (off / curve), 0, s.most)
    assert rate == pytest.approx(own, abs=1e-9)
    assert all(r.copies in (int(r.rate), int(r.rate) + 1) for r in out)
    mixed = mixing.mix(docs, labels, s)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in out)
    plan = mixed._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_mixing_without_rows_or_labels(spark, documents):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert mixing.mixture(documents([]), none).count() == 0
    assert mixing.mixture(documents([(1, "a b"), (2, None)]), none).count() == 2
    with pytest.raises(ValueError):
        mixing.mixture(documents([(1, "a b")]), none, mixing.Settings(targets={"clean": 0.0}))


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<nav><ul><li>Home<li>About</ul></nav><div class="cookie-notice">We use cookies</div>
<article class="post"><header><h1>Big &amp; small</h1></header><p>One <b>bo</b>ld&nbsp;word<br>next
line<p>Two &lt;tags&gt;<script>var x = "</p>";</script><div class="comments">Reader: hi</div><form>Mail <input></form></article>
<aside>More</aside><footer>&copy; us</footer></body>"""


def test_article_without_its_surroundings():
    assert style_tree.main_text(PAGE, set()) == "Big & small One bold word next line Two <tags>"
    for page in ("", "<", "<p", "</div></p>", "<!-- open", "<script>never closed", "a < b & c &am"):
        style_tree.main_text(page, set())
    assert style_tree.main_text("a < b", set()) == "a < b"


NAMED = '<article><h1>Head</h1><p>The text of the article, long enough.</p><{0}>noise</{1}><p>Its end.</p></article>'


def test_longer_class_names_of_noise_inside_an_article():
    for name in ("comment-list", "comments-area", "user-comments", "ad-slot", "ad_banner", "cookie-banner", "share-buttons", "newsletter-signup", "related-posts", "sidebar"):
        for tag in (f'div class="x {name}"', f'section class="{name}"', f'div id="{name}"'):
            assert style_tree.main_text(NAMED.format(tag, tag.split()[0]), set()) == "Head The text of the article, long enough. Its end.", tag
    for tag in ('h2 class="comment-head"', 'section id="ad-hoc"', 'div class="no-comments"', 'p class="related-work"', 'div class="shared"'):
        assert "noise" in style_tree.main_text(NAMED.format(tag, tag.split()[0]), set()), tag
    most = '<article><p>Short.</p><div class="post-share-wrap"><p>All of the text lies in here.</p></div></article>'
    assert style_tree.main_text(most, set()) == "Short. All of the text lies in here."


def test_importance_equals_entropy_by_hand(spark):
    draw = random.Random(12)
    rows = [(page, page % 2, draw.randint(1, 4), draw.randint(1, 3), c) for page in range(12) for c in draw.sample([None, 7, 8, 9], 2)]
    found = spark.createDataFrame(rows, "key long, host long, path long, style long, content long")
    s = style_tree.Settings()
    out = {(r.host, r.path): r for r in style_tree.importance(found, s).collect()}
    assert set(out) == {(h, p) for _, h, p, _, _ in rows}
    for (h, p), r in out.items():
        here = [x for x in rows if x[1:3] == (h, p)]
        seen = {(k, style) for k, _, _, style, _ in here}
        m, styles = len(seen), [sum(b == style for _, b in seen) for style in {b for _, b in seen}]
        copies = [sum(x[4] == c for x in here) for c in {x[4] for x in here} - {None}]
        if m == 1:
            assert r.importance == 1
            continue
        shape = -sum(n / m * np.log(n / m) for n in styles) / np.log(m)
        text = 1 - (sum(k * np.log(k) for k in copies) / sum(copies) if copies else 0) / np.log(m)
        keep = s.damping ** len(styles)
        assert r.pages == m and r.importance == pytest.approx((1 - keep) * shape + keep * text)


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x") for i, u, h in rows], "page_id long, url string, html string, key string")


def test_repeated_branches_of_a_host_are_cut(spark):
    page = "<body><div><p>Daily news of the town</p></div><div class=x><p>Own text {0} of page {0}</p></div></body>"
    rows = [(i, f"http://a.example/{i}", page.format(i)) for i in range(30)] + [(50, "http://b.example/", page.format(50))]
    rows += [(60, None, None), (61, "", ""), (62, "http://[bad", "<p>x"), (7, "http://a.example/7", page.format(7)), (63, "http://c.example", PAGE), (None, None, "long " * 100_000)]
    out = style_tree.extract(pages(spark, rows)).collect()
    assert len(out) == len(rows)
    for r in out:
        assert r.n_chars == len(r.text)
        if r.page_id is not None and r.page_id < 30:
            assert r.text == f"Own text {r.page_id} of page {r.page_id}"
    by = {r.page_id: r.text for r in out}
    assert by[50] == "Daily news of the town Own text 50 of page 50"  # seen once, nothing is known of its host
    assert by[60] == by[61] == "" and by[62] == "x" and by[63].startswith("Big & small") and by[None] == " ".join(["long"] * 100_000)
    assert style_tree.extract(pages(spark, [])).count() == 0


def test_license_notices(documents):
    mit = licenses.TEMPLATES["MIT"][1]
    wrapped = "Copyright (c) 2020 Me\n\n" + mit.replace("copy of this", "copy\nof this").replace("including without", "including\nwithout") + "\n\nCode follows."
    rows = [
        (10, "Some prose here.\nLicensed under the Apache License, Version 2.0.\nMore prose."),
        (11, wrapped),
        (12, "Licensed under CC BY-NC 4.0."),
        (13, "I lost my driver's license in a public domain of words."),
        (14, "this work is licensed under the gnu general public license version 2"),
        (15, "x " * 50_000 + "\nReleased under the MIT License."),
    ]
    found = licenses.scan(documents([*rows, *ODD, rows[2]])).collect()
    got = sorted((r.doc_id, r.license) for r in found)
    assert got == [(10, "Apache-2.0"), (11, "MIT"), (12, "CC-BY-NC-4.0"), (12, "CC-BY-NC-4.0"), (14, "GPL-2.0"), (15, "MIT")]
    by = {r.doc_id: r for r in found}
    text = dict(rows)
    assert text[10][by[10].start : by[10].end] == "Licensed under the Apache License, Version 2.0"
    assert text[11][by[11].start :].startswith("Permission is hereby granted") and by[11].same == 1
    assert (by[14].missing, by[14].added) == ("", "")
    assert licenses.scan(documents([])).count() == 0


def test_every_notice_of_a_span_and_exact_variants(documents):
    apache, gnu = licenses.TEMPLATES["Apache-2.0"][0], licenses.TEMPLATES["GPL-3.0"][0]
    rows = [
        (1, f"Released under the MIT License. {apache}"),
        (2, f"Released under the MIT License. {apache} Licensed under CC BY 4.0."),
        (3, gnu.replace("3", "4")),
        (4, gnu.replace("General", "Lesser General")),
        (5, gnu.replace("General", "Affero General")),
        (6, "Released under the BSD 2-Clause License."),
        (7, licenses.TEMPLATES["GPL-2.0"][1]),
        (8, f"{apache} {apache}"),
        (9, licenses.TEMPLATES["CC-BY-4.0"][1].replace("Attribution", "Attribution NoDerivatives")),
    ]
    got = sorted((r.doc_id, r.license) for r in licenses.scan(documents(rows)).collect())
    assert got == [
        (1, "Apache-2.0"), (1, "MIT"), (2, "Apache-2.0"), (2, "CC-BY-4.0"), (2, "MIT"), (4, "LGPL-3.0"), (5, "AGPL-3.0"), (6, "BSD-2-Clause"), (7, "GPL-2.0"),
        (8, "Apache-2.0"), (8, "Apache-2.0"),
    ]
