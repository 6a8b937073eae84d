"""Increase of cumulative counters on a stream, each sample against the one before it in event time.

A series' samples are held in its state until the watermark has passed them: only then no earlier one can
come any more, so late and unordered samples get the increase that the batch operator gives them. What is
held per series is one sample and those of the watermark's delay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from emberscope.operators.metrics import identity
from emberscope.streaming.windows import with_event_time

SAMPLE = "labels STRING, time_unix_nano BIGINT, value DOUBLE"
_LAST = "time_unix_nano BIGINT, value DOUBLE"
_HELD = "times BINARY, vals BINARY"
_MS = 1_000_000
_RUN = 10_000  # samples packed together when those ahead of the watermark are stored again
_OUT_ROWS = 100_000  # rows of a frame handed to Spark


def use_state_store(spark: SparkSession) -> SparkSession:
    """Let streams of this session keep their state in RocksDB, which lists and timers need; put before the start."""
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    return spark


class _Increases(StatefulProcessor):
    """State of a series: the last sample behind the watermark, the samples ahead of it, and the earliest time among these.

    Samples are held in runs, each two packed arrays of 64-bit numbers. One timer stands just behind the earliest sample
    held. When it fires, all samples behind the watermark are final and leave in order of time. With a TTL another timer
    forgets a series that sent nothing for so long. Timers that find nothing to release leave the samples held unread.
    """

    def __init__(self, ttl_ns: int | None) -> None:
        self.ttl_ns = ttl_ns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", _HELD)
        self.last = handle.getValueState("last", _LAST)
        self.next = handle.getValueState("next", "time_unix_nano BIGINT")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        earliest = None
        for frame in rows:
            frame = frame.dropna(subset=["time_unix_nano", "value"])
            if len(frame):
                times = frame["time_unix_nano"].to_numpy(np.int64)
                self.held.appendValue(_packed(times, frame["value"].to_numpy(np.float64)))
                earliest = int(times.min()) if earliest is None else min(earliest, int(times.min()))
        if earliest is not None:
            held = self.next.get()[0] if self.next.exists() else None
            if held is None or earliest < held:
                if held is not None:
                    self.handle.deleteTimer(held // _MS + 1)
                self._expect(earliest)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * _MS
        before = self.last.get() if self.last.exists() else None
        earliest = self.next.get()[0] if self.next.exists() else None
        if earliest is None or earliest >= passed:
            if earliest is None and before is not None and self._forgotten(before[0], passed):
                self.last.clear()
            return
        times, values = self._release(passed)
        prior = np.concatenate([times[:1] if before is None else [before[0]], times[:-1]])
        start = np.concatenate([values[:1] if before is None else [before[1]], values[:-1]])
        known = np.ones(len(times), bool)
        known[0] = before is not None
        if self.ttl_ns is not None:
            known &= times - prior <= self.ttl_ns
        last = (int(times[-1]), float(values[-1]))
        if not self.next.exists() and self._forgotten(last[0], passed):
            self.last.clear()
        else:
            self.last.update(last)
            if self.ttl_ns is not None:
                self.handle.registerTimer((last[0] + self.ttl_ns) // _MS + 1)
        gain = np.where(known, np.where(values >= start, values - start, values), 0.0)
        for at in range(0, len(times), _OUT_ROWS):
            part = slice(at, at + _OUT_ROWS)
            frame = pd.DataFrame({f"k{i}": [k] * len(times[part]) for i, k in enumerate(key)})
            frame["time_unix_nano"] = times[part]
            frame["previous_time"] = pd.arrays.IntegerArray(prior[part], ~known[part])
            frame["increase"] = gain[part]
            yield frame

    def _release(self, passed: int) -> tuple[np.ndarray, np.ndarray]:
        """Times and values of the samples behind the watermark in order of both; the others stay held."""
        runs = list(self.held.get())
        times = np.concatenate([np.frombuffer(r[0], np.int64) for r in runs])
        values = np.concatenate([np.frombuffer(r[1], np.float64) for r in runs])
        ahead = times >= passed
        if ahead.any():
            later, held = times[ahead], values[ahead]
            self.held.put([_packed(later[i : i + _RUN], held[i : i + _RUN]) for i in range(0, len(later), _RUN)])
            self._expect(int(later.min()))
            times, values = times[~ahead], values[~ahead]
        else:
            self.held.clear()
            self.next.clear()
        order = np.lexsort((values, times))
        return times[order], values[order]

    def _expect(self, earliest: int) -> None:
        self.next.update((earliest,))
        self.handle.registerTimer(earliest // _MS + 1)

    def _forgotten(self, last: int, now: int) -> bool:
        return self.ttl_ns is not None and now - last > self.ttl_ns


def _packed(times: np.ndarray, values: np.ndarray) -> tuple[bytes, bytes]:
    return times.tobytes(), values.tobytes()


def increases(samples: DataFrame, delay_ns: int, ttl_ns: int | None = None) -> DataFrame:
    """A stream of ``labels, time_unix_nano, value`` with ``previous_time`` and ``increase`` in place of the value.

    Samples of different resources are different series, if the column that tells them apart is there (see
    ``operators.metrics.source``). Rows appear once the watermark, ``delay_ns`` behind the newest sample, has
    passed them; samples that come later than that are left out, as are those without time or value. A series
    silent for longer than ``ttl_ns`` starts anew, its next sample having no increase.
    """
    use_state_store(samples.sparkSession)
    keys = identity(samples)
    types = dict(samples.dtypes)
    timed = with_event_time(samples.select(*keys, "time_unix_nano", "value"), "time_unix_nano", delay_ns)
    layout = ", ".join(f"k{i} {types[k]}" for i, k in enumerate(keys))
    out = timed.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=_Increases(ttl_ns),
        outputStructType=f"{layout}, time_unix_nano BIGINT, previous_time BIGINT, increase DOUBLE",
        outputMode="append",
        timeMode="eventTime",
    )
    return out.withColumnsRenamed({f"k{i}": k for i, k in enumerate(keys)})
