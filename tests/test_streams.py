from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from emberscope import schema
from emberscope.operators import metrics
from emberscope.streaming import counter, windows

from tests.helpers import S, spans

OUT = "labels STRING, time_unix_nano BIGINT, previous_time BIGINT, increase DOUBLE"


class Counter:
    """Samples that arrive in waves, and the increases written after each of them."""

    def __init__(self, spark, fresh, delay, ttl=None):
        self.spark, self.fresh, self.delay, self.ttl = spark, fresh, delay, ttl

    def arrive(self, *rows):
        rows = [(k, None if t is None else t * S, None if v is None else float(v)) for k, t, v in rows]
        self.spark.createDataFrame(rows, counter.SAMPLE).coalesce(1).write.mode("append").parquet(f"{self.fresh}/in")
        stream = self.spark.readStream.schema(counter.SAMPLE).parquet(f"{self.fresh}/in")
        out = counter.increases(stream, self.delay * S, None if self.ttl is None else self.ttl * S)
        w = out.writeStream.format("parquet").option("path", f"{self.fresh}/out").option("checkpointLocation", f"{self.fresh}/cp")
        w.trigger(availableNow=True).start().awaitTermination()
        rows = self.spark.read.schema(OUT).parquet(f"{self.fresh}/out").collect()
        rows = [(r.labels, r.time_unix_nano // S, r.previous_time and r.previous_time // S, r.increase) for r in rows]
        return sorted(rows, key=lambda r: (r[0] or "", r[1]))

    def state_bytes(self):
        return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(f"{self.fresh}/cp/state") for f in files)


def test_late_samples_within_the_delay_count(spark, fresh):
    c = Counter(spark, fresh, delay=10)
    assert c.arrive(("a", 1, 5), ("a", 20, 9), ("b", 5, 1), ("a", 12, 2)) == [("a", 1, None, 0.0), ("b", 5, None, 0.0)]
    # 15 comes late but in time, 3 lies behind the watermark; 12 was a reset.
    got = c.arrive(("a", 15, 7), ("a", 3, 2), ("b", 40, 3), (None, 50, 1), ("a", None, 1), ("b", 41, None))
    assert got == [("a", 1, None, 0.0), ("a", 12, 1, 2.0), ("a", 15, 12, 5.0), ("a", 20, 15, 2.0), ("b", 5, None, 0.0)]
    got = c.arrive(("end", 1000, 0))
    assert got[0] == (None, 50, None, 0.0) and got[-2:] == [("b", 5, None, 0.0), ("b", 40, 5, 2.0)]


def test_series_that_fall_silent_are_forgotten(spark, fresh):
    c = Counter(spark, fresh, delay=0, ttl=100)
    c.arrive(("a", 1, 5), ("b", 1, 5), ("b", 90, 6))
    got = c.arrive(("a", 180, 9), ("b", 180, 9))
    got = c.arrive(("end", 500, 0))
    assert got == [("a", 1, None, 0.0), ("a", 180, None, 0.0), ("b", 1, None, 0.0), ("b", 90, 1, 1.0), ("b", 180, 90, 3.0)]


def test_state_holds_the_delay_not_the_history(spark, fresh):
    few, many = Counter(spark, f"{fresh}/few", delay=5), Counter(spark, f"{fresh}/many", delay=5)
    few.arrive(*[("s", t, t) for t in range(1, 21)])
    many.arrive(*[("s", t, t) for t in range(1, 6001)])
    few.arrive(("s", 7000, 1))
    rows = many.arrive(("s", 7000, 1))
    assert len(rows) == 6000 and sum(r[3] for r in rows) == 5999
    assert many.arrive(("s", 7010, 2))[-1] == ("s", 7000, 6000, 1.0)
    many_live = spark.read.format("statestore").option("stateVarName", "held").load(f"{fresh}/many/cp")
    assert many_live.count() <= 2
    assert many.state_bytes() < 40 * few.state_bytes()


def test_samples_are_held_in_runs_under_one_timer(spark, fresh):
    n, delay = 25_000, 10**6
    c = Counter(spark, fresh, delay=delay)
    state = spark.read.format("statestore")
    assert c.arrive(*[("s", 7919 * i % n + 2, 7919 * i % n) for i in range(n)]) == []
    assert state.option("stateVarName", "held").load(f"{fresh}/cp").count() <= 3
    assert c.arrive(("s", 1, 5)) == []
    # The watermark comes to stand at 12,502: what lies behind it leaves in order, the rest is held on.
    rows = c.arrive(("s", delay + 12_502, 9))
    assert rows == [("s", 1, None, 0.0), ("s", 2, 1, 0.0)] + [("s", t, t - 1, 1.0) for t in range(3, 12_502)]
    assert state.option("stateVarName", "held").load(f"{fresh}/cp").count() <= 3
    timers = spark.read.format("statestore").option("readRegisteredTimers", True).load(f"{fresh}/cp").collect()
    assert [t.expiration_timestamp_ms for t in timers] == [12_502_001]
    assert len(c.arrive(("s", 2 * delay, 9))) == n + 1


def test_increases_equal_the_batch_operator(spark, fresh):
    import random

    draw = random.Random(5)
    rows = [(draw.choice("xyz"), t, draw.randint(0, 9)) for t in range(1, 121)]
    late = [r for r in rows if draw.random() < 0.3]
    c = Counter(spark, fresh, delay=1000)
    c.arrive(*[r for r in rows if r not in late])
    c.arrive(*late)
    got = c.arrive(("end", 5000, 0))
    batch = metrics.increases(spark.createDataFrame([(k, t * S, float(v)) for k, t, v in rows], counter.SAMPLE))
    want = [(r.labels, r.time_unix_nano // S, r.previous_time and r.previous_time // S, r.increase) for r in batch.collect()]
    assert got == sorted(want)


def test_sketches_of_buckets_merge_to_coarser_ones(spark, fresh):
    rows = spans(spark, *[{"start_time_unix_nano": (i * 60) * S, "duration_ns": i, "status": "ERROR" if i % 4 == 0 else "OK"} for i in range(2000)])
    fine = windows.red_sketches(rows, 600 * S, delay_ns=S)
    out = windows.red(windows.coarser(fine, 2000 * 60 * S)).collect()
    assert len(out) == 1 and (out[0].bucket, out[0].calls, out[0].errors) == (0, 2000, 500)
    for p, name in ((0.5, "p50"), (0.95, "p95"), (0.99, "p99")):
        assert abs(out[0][name] - p * 2000) <= 0.03 * 2000
    small = windows.red(windows.coarser(windows.red_sketches(rows.where("duration_ns < 40"), 600 * S, S), 1200 * S)).collect()
    for r in small:
        own = sorted(i for i in range(40) if i * 60 // 1200 == r.bucket // (1200 * S))
        for p, name in ((0.5, "p50"), (0.95, "p95"), (0.99, "p99")):
            assert r[name] == own[max(-(-int(p * 100) * len(own) // 100) - 1, 0)]
    assert windows.red(windows.red_sketches(rows.where("false"), S, S)).count() == 0
    with pytest.raises(ValueError, match="multiple"):
        windows.coarser(fine, 900 * S, fine_ns=600 * S)


def test_percentiles_of_large_buckets_are_exact(spark, fresh):
    n = 5003
    rows = spans(spark, *[{"start_time_unix_nano": i * S // 2, "duration_ns": None if i < 3 else (i * 7919) % 4001, "status": "ERROR" if i % 4 == 0 else "OK"} for i in range(n)], {"start_time_unix_nano": 10**6 * S})
    rows.coalesce(2).write.parquet(f"{fresh}/in")
    stream = windows.red_counts(spark.readStream.schema(rows.schema).parquet(f"{fresh}/in"), 3600 * S, S)
    w = stream.writeStream.format("parquet").option("path", f"{fresh}/out").option("checkpointLocation", f"{fresh}/cp")
    w.trigger(availableNow=True).start().awaitTermination()
    (got,) = windows.exact_red(spark.read.schema(stream.schema).parquet(f"{fresh}/out")).collect()
    own = sorted((i * 7919) % 4001 for i in range(3, n))
    assert (got.bucket, got.calls, got.errors) == (0, n, -(-n // 4))
    assert [got.p50, got.p95, got.p99] == [own[-(-len(own) * p // 100) - 1] for p in (50, 95, 99)]
