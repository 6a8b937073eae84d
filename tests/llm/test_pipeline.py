from __future__ import annotations

import pickle
import random
import re
from pathlib import Path

import corpus_pipeline
import __spark_entry__ as contract
import numpy as np
import pyarrow as pa
import pytest
from emberscope.llm import common, langid, minhash, quality
from pyspark import cloudpickle

from .test_duplicates import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage gets and returns over a documents table with odd rows."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(10_001, None, None, None, None), (10_002, "", "en", "s", 0), (10_003, "12 34", "en", "s", 5)], docs.schema)
    docs = docs.union(odd)
    out = []
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SF).persist()
        out.append((name, docs, after))
        docs = after
    return out


def test_names_and_columns(stages):
    assert [n for n, _, _ in stages] == ["language", "quality", "near_duplicates", "mixing", "packing"]
    columns = stages[0][1].columns
    assert all(after.columns == columns for _, _, after in stages[:-1])


def test_language_rejects_texts_without_letters_only(stages):
    _, before, after = stages[0]
    want = {r.doc_id for r in before.collect() if r.text and any(c.isalpha() for c in r.text)}
    assert {r.doc_id for r in after.collect()} == want


def test_quality_keeps_what_scores(spark, stages):
    _, before, after = stages[1]
    s = quality.Settings()
    machine = quality.learn(before, spark.read.parquet(f"{SF}/labels.parquet"), s)
    scores = quality.score(before, machine, s).collect()
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in scores if r.score >= s.threshold}


def test_one_document_of_each_group_stays(stages):
    _, before, after = stages[2]
    _, groups = brute([(r.doc_id, r.text) for r in before.collect()], minhash.Settings().width, minhash.Settings().numerator)
    assert sorted(r.doc_id for r in after.collect()) == sorted(i for i, c in groups.items() if i == c)


def test_of_rows_with_one_id_the_same_stays_wherever_they_lie(spark, documents):
    long = " ".join(f"w{i}" for i in range(50_000))
    rows = [(7, "one two three four five six"), (7, "other words that are not alike at all"), (7, None), (8, long), (8, long), (9, ""), (None, "a"), (None, "a")]
    found = []
    for order in (rows, rows[::-1]):
        out = corpus_pipeline.distinct(spark, documents(order).repartition(5, "text"), SF)
        assert out.columns == list(corpus_pipeline.COLUMNS)
        found.append(sorted((tuple(r) for r in out.collect()), key=repr))
    assert found[0] == found[1]
    assert sorted((r[0] for r in found[0]), key=str) == [7, 8, 9, None, None]
    assert corpus_pipeline.distinct(spark, documents([]), SF).count() == 0


def test_mixing_repeats_whole_rows(stages):
    _, before, after = stages[3]
    assert {tuple(r) for r in after.collect()} <= {tuple(r) for r in before.collect()}
    assert after.count() > 0.8 * before.count()


def test_every_token_is_packed(stages):
    _, before, after = stages[4]
    rows = after.collect()
    ends = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 4096
    assert sum(r.start == 0 for r in rows) == before.count()
    assert sum(r.length for r in rows) == sum(r.doc_tokens for r in rows if r.start == 0)


def _own_mb():
    """Memory of this process without mapped files."""
    return int(re.search(r"Pss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) / 1024


def test_workers_keep_little_between_stages(spark, documents, monkeypatch):
    draw = random.Random(3)
    rows = [(i, " ".join("".join(draw.choices("abcdefghij", k=6)) for _ in range(300)), "en", "s", 9) for i in range(1500)]
    batch = pa.RecordBatch.from_pylist([dict(zip(corpus_pipeline.COLUMNS, r, strict=True)) for r in rows])
    docs = documents([]).select(*corpus_pipeline.COLUMNS)
    samples = {"en": " ".join(r[1] for r in rows[:30]), "de": " ".join(r[1] for r in rows[30:60])}
    s = quality.Settings()
    machine = quality.Machine(0.0, np.zeros(s.buckets + len(quality.STATISTICS) * quality.LEVELS, np.float32), np.zeros((s.buckets + len(quality.STATISTICS) * quality.LEVELS, s.factors), np.float32))
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, task, *a: task)
    tasks = {"language": langid.predict(docs, samples), "quality": quality.score(docs, machine, s), "signatures": minhash.signatures(docs, minhash.Settings())}
    tasks = {k: pickle.loads(cloudpickle.dumps(f)) for k, f in tasks.items()}
    sent = {"language": batch, "quality": batch, "signatures": batch.select(["doc_id", "text"])}
    run = lambda k: sum(b.num_rows for b in tasks[k](iter([sent[k]])))
    assert run("language") == run("language") == 1500
    assert [k[0] for k in common._HELD] == ["parser"]  # built once for all tasks of its stage
    for name in ("quality", "signatures"):
        assert run("language") == 1500
        common.give_back()
        with_parser = _own_mb()
        tables = sum(t.nbytes for t in next(iter(common._HELD.values())).tables) / 1e6
        assert run(name) == 1500
        assert not common._HELD
        assert _own_mb() < with_parser - tables / 2 + 20


def test_registered():
    assert {"pipeline", *(n for n in contract.queries() if n.startswith("op"))} == {"pipeline", *contract.QUERIES}
    assert sum(n.startswith("op") for n in contract.queries()) == 13
