"""The seven tables derived from the test tables, as Spark frames and as SQL text.

Every row of ``events`` becomes a log, a span and metric points; the SQL views
say the same for the comparison engine. Times and counters are functions of the
row alone, so deriving them needs no window.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberscope import schema
from emberscope.functions.attrs import label_set
from emberscope.functions.timegrid import DAY, SECOND

# Fixture constants.
FIRST_DAY_NS = 1_704_067_200 * SECOND  # 2024-01-01
LAST_NS = FIRST_DAY_NS + 30 * DAY  # end of the 30 days of events
COUNTER_PERIOD = 250  # the counter starts anew every so many events
HIST_BOUNDS = (1.0, 5.0, 25.0, 100.0, 250.0)
EXP_INDEXES = range(-7, 11)
SKEW_CENTER = 5.0
ZERO_THRESHOLD = 0.25  # of the cumulative points; a power of two and of four
SERVICES = ("checkout", "cart", "auth", "search")
SEVERITY = {"error": 17, "purchase": 13, "signup": 9, "click": 5, "view": 1}
SEVERITY_TEXT = {"error": "ERROR", "purchase": "WARN", "signup": "INFO", "click": "DEBUG", "view": "TRACE"}
KIND = {"click": "CLIENT", "view": "SERVER", "purchase": "PRODUCER", "signup": "CONSUMER", "error": "INTERNAL"}


def _pick(column: str, values: dict) -> Column:
    out = None
    for key, value in values.items():
        out = (out.when if out is not None else F.when)(F.col(column) == key, F.lit(value))
    return out


def _hex(number: Column, digits: int) -> Column:
    return F.lower(F.lpad(F.hex(number), digits, "0"))


def _strings(**values: Column) -> Column:
    """A string map out of ``key=column``; double underscores stand for dots."""
    parts = []
    for key, value in values.items():
        parts += [F.lit(key.replace("__", ".")), value.cast("string")]
    return F.create_map(*parts)


def _doubles(values) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


class Fixture:
    """Derived tables of one scale-factor directory. Everything is lazy."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def base(self) -> DataFrame:
        user = F.col("user_id") % 4
        service = F.when(user == 0, SERVICES[0]).when(user == 1, SERVICES[1])
        service = service.when(user == 2, SERVICES[2]).otherwise(SERVICES[3])
        return self.raw("events").select(
            "event_id",
            (F.unix_micros(F.col("ts").cast("timestamp")) * 1000).alias("t"),
            F.col("ts").cast("date").alias("day"),
            "user_id",
            "event_type",
            "value",
            F.get_json_object("props", "$.k").cast("bigint").alias("k"),
            service.alias("service"),
        )

    def _cast(self, df: DataFrame, name: str, *extra: str) -> DataFrame:
        fields = schema.table_schema(name).fields
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields], *extra)

    @staticmethod
    def _empty_map() -> Column:
        return F.create_map().cast("map<string,string>")

    @staticmethod
    def _ids() -> tuple[Column, Column]:
        event = F.col("event_id")
        return _hex(F.expr("event_id div 8 + 1"), 32), _hex(event + 1, 16)

    def _log_frame(self, *extra: str) -> DataFrame:
        trace_id, span_id = self._ids()
        traced = F.col("event_type").isin("error", "purchase")
        attributes = _strings(event__type=F.col("event_type"), k=F.col("k"), user__id=F.col("user_id"))
        amount = _strings(amount=F.floor("value"))
        rows = self.base.select(
            F.col("t").alias("time_unix_nano"),
            (F.col("t") + 1_000_000).alias("observed_time_unix_nano"),
            "service",
            _pick("event_type", SEVERITY).alias("severity_number"),
            _pick("event_type", SEVERITY_TEXT).alias("severity_text"),
            F.concat("event_type", F.lit(" by user "), "user_id", F.lit(" key "), "k").alias("body"),
            F.when(traced, trace_id).alias("trace_id"),
            F.when(traced, span_id).alias("span_id"),
            F.col("event_type").alias("event_name"),
            F.lit(0).alias("flags"),
            F.lit("events").alias("scope_name"),
            F.lit("1").alias("scope_version"),
            _strings(service__name=F.col("service")).alias("resource"),
            F.when(F.col("event_type") == "purchase", F.map_concat(attributes, amount))
            .otherwise(attributes)
            .alias("attributes"),
            "day",
            *extra,
        )
        return self._cast(rows, schema.LOGS, *extra)

    @cached_property
    def logs(self) -> DataFrame:
        return self._log_frame()

    def _span_frame(self, *extra: str) -> DataFrame:
        trace_id, span_id = self._ids()
        slot = F.col("event_id") % 8
        parent = _hex(F.expr("event_id - event_id % 8 + (event_id % 8 - 1) div 2 + 1"), 16)
        duration = F.round(F.col("value") * 1000).cast("bigint") * 1_000_000
        status = F.when(F.col("event_type") == "error", "ERROR").when(F.col("event_type") == "purchase", "OK")
        event = F.struct(
            (F.col("t") + 1000).alias("time"),
            F.lit("exception").alias("name"),
            _strings(exception__code=F.col("k")).alias("attributes"),
        )
        rows = self.base.select(
            trace_id.alias("trace_id"),
            span_id.alias("span_id"),
            F.when(slot != 0, parent).alias("parent_span_id"),
            "service",
            F.col("event_type").alias("name"),
            _pick("event_type", KIND).alias("kind"),
            F.col("t").alias("start_time_unix_nano"),
            (F.col("t") + duration).alias("end_time_unix_nano"),
            duration.alias("duration_ns"),
            status.otherwise("UNSET").alias("status"),
            F.lit(None).alias("status_message"),
            F.lit(None).alias("trace_state"),
            F.lit(1).alias("flags"),
            F.when(F.col("event_type") == "error", F.array(event)).otherwise(F.array()).alias("events"),
            F.array().alias("links"),
            F.lit("events").alias("scope_name"),
            F.lit("1").alias("scope_version"),
            _strings(service__name=F.col("service")).alias("resource"),
            _strings(k=F.col("k"), user__id=F.col("user_id")).alias("attributes"),
            "day",
            *extra,
        )
        return self._cast(rows, schema.SPANS, *extra)

    @cached_property
    def spans(self) -> DataFrame:
        return self._span_frame()

    def _point_columns(self, metric: str, unit: str, temporality: str | None, flags: Column) -> list[Column]:
        return [
            F.col("t").alias("time_unix_nano"),
            F.lit(FIRST_DAY_NS).alias("start_time_unix_nano"),
            F.col("service"),
            F.lit(metric).alias("metric"),
            F.lit(unit).alias("unit"),
            F.lit("derived from events").alias("description"),
            F.lit(temporality).alias("temporality"),
            flags.alias("flags"),
            label_set({"event.type": F.col("event_type"), "service": F.col("service")}).alias("labels"),
            _strings(event__type=F.col("event_type")).alias("attributes"),
            _strings(service__name=F.col("service")).alias("resource"),
            F.col("day"),
        ]

    def _exemplar(self) -> Column:
        trace_id, span_id = self._ids()
        return F.struct(
            F.col("t").alias("time"),
            F.col("value").alias("value"),
            trace_id.alias("trace_id"),
            span_id.alias("span_id"),
            label_set({"user.id": F.col("user_id").cast("string")}).alias("attributes"),
        )

    def _gauge_frame(self, *extra: str) -> DataFrame:
        stale = F.when(F.col("k") == 0, 1).otherwise(0)
        rows = self.base.select(
            *self._point_columns("event.value", "s", None, stale),
            F.when(F.col("event_type") == "error", F.array(self._exemplar())).otherwise(F.array()).alias("exemplars"),
            "value",
            *extra,
        )
        return self._cast(rows, schema.GAUGE, *extra)

    @cached_property
    def gauge(self) -> DataFrame:
        return self._gauge_frame()

    def _sum_frame(self, *extra: str) -> DataFrame:
        def one(metric: str, temporality: str, value: Column, monotonic: bool) -> DataFrame:
            rows = self.base.select(
                *self._point_columns(metric, "1", temporality, F.lit(0)),
                F.when(F.col("event_type") == "purchase", F.array(self._exemplar())).otherwise(F.array()).alias("exemplars"),
                value.cast("double").alias("value"),
                F.lit(monotonic).alias("is_monotonic"),
                *extra,
            )
            return self._cast(rows, schema.SUM, *extra)

        counter = one("event.count", "CUMULATIVE", F.col("event_id") % COUNTER_PERIOD, True)
        return counter.unionByName(one("event.delta", "DELTA", F.lit(1.0), True))

    @cached_property
    def sum(self) -> DataFrame:
        return self._sum_frame()

    def _per_day(self, metric: str, temporality: str | None, aggregates: list[Column], columns: list[Column],
                 source: DataFrame | None = None) -> DataFrame:
        """One point per (service, day), taken at the last second of the day."""
        start = F.unix_date("day").cast("bigint") * F.lit(DAY)
        rows = self.base if source is None else source
        return rows.groupBy("service", "day").agg(*aggregates).select(
            (start + F.lit(DAY - SECOND)).alias("time_unix_nano"),
            start.alias("start_time_unix_nano"),
            "service",
            F.lit(metric).alias("metric"),
            F.lit("s").alias("unit"),
            F.lit("derived from events").alias("description"),
            F.lit(temporality).alias("temporality"),
            F.lit(0).alias("flags"),
            label_set({"service": F.col("service")}).alias("labels"),
            self._empty_map().alias("attributes"),
            _strings(service__name=F.col("service")).alias("resource"),
            "day",
            F.array().alias("exemplars"),
            *columns,
        )

    @staticmethod
    def _totals(value: Column) -> list[Column]:
        # Summed in hundredths, so the order of summation cannot show.
        return [
            F.count(F.lit(1)).alias("count"),
            (F.sum(F.round(value * 100).cast("bigint")) / 100.0).cast("double").alias("sum"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
        ]

    @cached_property
    def histogram(self) -> DataFrame:
        value = F.col("value")
        edges = [None, *HIST_BOUNDS, None]
        counts = []
        for i, (low, high) in enumerate(zip(edges, edges[1:])):
            inside = F.lit(True)
            inside = inside & (value > low) if low is not None else inside
            inside = inside & (value <= high) if high is not None else inside
            counts.append(F.count_if(inside).alias(f"c{i}"))
        rows = self._per_day(
            "event.latency",
            "DELTA",
            self._totals(value) + counts,
            [
                *[F.col(c) for c in ("count", "sum", "min", "max")],
                F.array(*[F.lit(b) for b in HIST_BOUNDS]).alias("explicit_bounds"),
                F.array(*[F.col(f"c{i}") for i in range(len(counts))]).alias("bucket_counts"),
            ],
        )
        return self._cast(rows, schema.HISTOGRAM)

    @cached_property
    def exp_histogram(self) -> DataFrame:
        """Scale 0 on even days, -1 on odd ones; buckets counted by exact powers, no logarithm."""
        x = F.col("value") - SKEW_CENTER
        scale = F.when(F.unix_date("day") % 2 == 0, 0).otherwise(-1)
        edges = F.when(scale == 0, _doubles(2.0**i for i in EXP_INDEXES)).otherwise(
            _doubles(4.0**i for i in EXP_INDEXES)
        )
        # How many edges lie below |x|; 0 is the zero bucket.
        place = F.size(F.filter(F.col("_edges"), lambda e: e < F.abs("_x")))
        cells = (
            self.base.select("service", "day", x.alias("_x"), edges.alias("_edges"))
            .select("service", "day", "_x", place.alias("_place"))
            .groupBy("service", "day", F.when(F.col("_place") > 0, F.signum("_x")).alias("_sign"), "_place")
            .agg(
                F.count(F.lit(1)).alias("_n"),
                F.sum(F.round(F.col("_x") * 100).cast("bigint")).alias("_cents"),
                F.min("_x").alias("_min"),
                F.max("_x").alias("_max"),
            )
        )
        kept = F.collect_list(F.struct("_sign", "_place", "_n")).alias("_cells")

        def count_at(sign: float | None, at: Column) -> Column:
            same = F.filter(
                "_cells", lambda c: c["_sign"].eqNullSafe(F.lit(sign).cast("double")) & (c["_place"] == at)
            )
            return F.aggregate(same, F.lit(0).cast("bigint"), lambda acc, c: acc + c["_n"])

        def buckets(sign: float) -> Column:
            places = F.sequence(F.lit(1), F.lit(len(EXP_INDEXES)))
            return F.struct(
                F.lit(EXP_INDEXES[0]).alias("offset"),
                F.transform(places, lambda i: count_at(sign, i)).alias("bucket_counts"),
            )

        rows = self._per_day(
            "event.skew",
            "DELTA",
            [
                F.sum("_n").alias("count"),
                (F.sum("_cents") / 100.0).cast("double").alias("sum"),
                F.min("_min").alias("min"),
                F.max("_max").alias("max"),
                kept,
            ],
            [
                *[F.col(c) for c in ("count", "sum", "min", "max")],
                count_at(None, F.lit(0)).alias("zero_count"),
                scale.alias("scale"),
                F.lit(0.0).alias("zero_threshold"),
                buckets(1.0).alias("positive"),
                buckets(-1.0).alias("negative"),
            ],
            source=cells,
        )
        return self._cast(rows, schema.EXP_HISTOGRAM)

    def _cumulative(self, metric: str, place: Column, scales: tuple[int, ...], columns) -> DataFrame:
        """One cumulative point per (service, host, day): all events since its counter started, every ten days.

        ``place`` numbers an event's bucket at ``_scale``; the first of ``scales`` holds for the first five days of a start.
        ``columns`` builds the bucket columns of a point from an expression for the count at (sign, place).
        """
        day = F.unix_date("day") - F.lit(FIRST_DAY_NS // DAY)
        scale = F.when(day % 10 < 5, scales[0]).otherwise(scales[-1])
        events = self.base.select("service", "day", (F.expr("user_id div 4") % 2).alias("host"), F.floor(day / 10).alias("era"), "value")
        points = events.select("service", "host", "era", "day", scale.alias("_scale")).distinct()
        cells = (
            events.withColumn("_scale", F.explode(F.array(*[F.lit(v) for v in sorted(set(scales))])))
            .groupBy("service", "host", "era", "_scale", F.col("day").alias("_from"), F.signum(F.col("value") - SKEW_CENTER).alias("_sign"), place.alias("_place"))
            .agg(F.count(F.lit(1)).alias("_n"), F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("_cents"))
        )
        start = F.unix_date("day").cast("bigint") * F.lit(DAY)
        made = (
            points.join(cells, ["service", "host", "era", "_scale"])
            .where("_from <= day")
            .groupBy("service", "host", "era", "day", "_scale", "_sign", "_place")
            .agg(F.sum("_n").alias("_n"), F.sum("_cents").alias("_cents"))
            .groupBy("service", "host", "era", "day", "_scale")
            .agg(F.sum("_n").alias("count"), (F.sum("_cents") / 100.0).cast("double").alias("sum"), F.collect_list(F.struct("_sign", "_place", "_n")).alias("_cells"))
        )

        def count_at(sign: float | None, at: Column) -> Column:
            same = F.filter("_cells", lambda c: (F.lit(sign is None) | (c["_sign"] == F.lit(sign))) & (c["_place"] == at))
            return F.aggregate(same, F.lit(0).cast("bigint"), lambda acc, c: acc + c["_n"])

        return made.select(
            (start + F.lit(DAY - SECOND)).alias("time_unix_nano"),
            (F.lit(FIRST_DAY_NS) + F.col("era") * F.lit(10 * DAY)).cast("bigint").alias("start_time_unix_nano"),
            "service",
            F.lit(metric).alias("metric"),
            F.lit("s").alias("unit"),
            F.lit("derived from events").alias("description"),
            F.lit("CUMULATIVE").alias("temporality"),
            F.lit(0).alias("flags"),
            label_set({"service": F.col("service")}).alias("labels"),
            self._empty_map().alias("attributes"),
            _strings(service__name=F.col("service"), host__name=F.col("host")).alias("resource"),
            "day",
            F.array().alias("exemplars"),
            "count",
            "sum",
            F.lit(None).cast("double").alias("min"),
            F.lit(None).cast("double").alias("max"),
            *columns(count_at),
        )

    @cached_property
    def histogram_cumulative(self) -> DataFrame:
        """Two hosts of equal labels, each starting anew every ten days."""
        place = F.size(F.filter(_doubles(HIST_BOUNDS), lambda e: e < F.col("value")))
        rows = self._cumulative(
            "event.latency.total",
            place,
            (0,),
            lambda count_at: [
                _doubles(HIST_BOUNDS).alias("explicit_bounds"),
                F.array(*[count_at(None, F.lit(i)) for i in range(len(HIST_BOUNDS) + 1)]).alias("bucket_counts"),
            ],
        )
        return self._cast(rows, schema.HISTOGRAM)

    @cached_property
    def exp_histogram_cumulative(self) -> DataFrame:
        """Like the histogram; five days after a start the scale falls from 0 to -1. A quarter counts as zero."""
        x = F.abs(F.col("value") - SKEW_CENTER)
        edges = F.when(F.col("_scale") == 0, _doubles(2.0**i for i in EXP_INDEXES)).otherwise(_doubles(4.0**i for i in EXP_INDEXES))
        place = F.size(F.filter(edges, lambda e: e < x))

        def columns(count_at) -> list[Column]:
            def side(sign: float) -> Column:
                counts = F.transform(F.sequence(F.lit(1), F.lit(len(EXP_INDEXES))), lambda i: count_at(sign, i))
                return F.struct(F.lit(EXP_INDEXES[0]).alias("offset"), counts.alias("bucket_counts"))

            return [
                count_at(None, F.lit(0)).alias("zero_count"),
                F.col("_scale").alias("scale"),
                F.lit(ZERO_THRESHOLD).alias("zero_threshold"),
                side(1.0).alias("positive"),
                side(-1.0).alias("negative"),
            ]

        return self._cast(self._cumulative("event.skew.total", place, (0, -1), columns), schema.EXP_HISTOGRAM)

    @cached_property
    def summary(self) -> DataFrame:
        def quantile(q: float, value: str) -> Column:
            return F.struct(F.lit(q).alias("quantile"), F.col(value).alias("value"))

        rows = self._per_day(
            "event.spread",
            None,
            self._totals(F.col("value")),
            [
                F.col("count"),
                F.col("sum"),
                F.array(quantile(0.0, "min"), quantile(1.0, "max")).alias("quantile_values"),
            ],
        )
        return self._cast(rows, schema.SUMMARY)

    @cached_property
    def documents(self) -> DataFrame:
        """``documents`` with the text as log body, language and source as attributes."""
        return self.raw("documents").select(
            "doc_id",
            F.col("text").alias("body"),
            _strings(lang=F.col("lang"), source=F.col("source")).alias("attributes"),
            self._empty_map().alias("resource"),
        )

    @cached_property
    def tables(self) -> dict[str, DataFrame]:
        return {
            schema.LOGS: self.logs,
            schema.SPANS: self.spans,
            schema.GAUGE: self.gauge,
            schema.SUM: self.sum,
            schema.HISTOGRAM: self.histogram,
            schema.EXP_HISTOGRAM: self.exp_histogram,
            schema.SUMMARY: self.summary,
        }


# --- the same tables for the comparison engine ----------------------------------


def _case(column: str, values: dict) -> str:
    arms = " ".join(f"WHEN '{k}' THEN {v!r}" for k, v in values.items())
    return f"CASE {column} {arms} END"


_TRACE_ID = "lpad(lower(to_hex(event_id // 8 + 1)), 32, '0')"
_SPAN_ID = "lpad(lower(to_hex(event_id + 1)), 16, '0')"
_LABELS = """'{"event.type":"' || event_type || '","service":"' || service || '"}'"""
_DAY_LABELS = """'{"service":"' || service || '"}'"""
_DAY_NS = "epoch_us(day::timestamp) * 1000"

VIEWS = {
    "b": (
        (),
        """SELECT event_id, epoch_us(ts) * 1000 AS t, CAST(ts AS date) AS day, user_id, event_type, value,
          CAST(json_extract_string(props, '$.k') AS bigint) AS k,
          CASE user_id % 4 WHEN 0 THEN 'checkout' WHEN 1 THEN 'cart' WHEN 2 THEN 'auth' ELSE 'search' END AS service
        FROM events""",
    ),
    "f_logs": (
        ("b",),
        f"""SELECT t AS time_unix_nano, t + 1000000 AS observed_time_unix_nano, service,
          {_case("event_type", SEVERITY)} AS severity_number,
          {_case("event_type", SEVERITY_TEXT)} AS severity_text,
          event_type || ' by user ' || user_id || ' key ' || k AS body,
          CASE WHEN event_type IN ('error', 'purchase') THEN {_TRACE_ID} END AS trace_id,
          CASE WHEN event_type IN ('error', 'purchase') THEN {_SPAN_ID} END AS span_id,
          event_type, user_id, k,
          CASE WHEN event_type = 'purchase' THEN CAST(floor(value) AS bigint) END AS amount, day
        FROM b""",
    ),
    "f_spans": (
        ("b",),
        f"""SELECT {_TRACE_ID} AS trace_id, {_SPAN_ID} AS span_id,
          CASE WHEN event_id % 8 <> 0 THEN
            lpad(lower(to_hex(event_id - event_id % 8 + (event_id % 8 - 1) // 2 + 1)), 16, '0') END AS parent_span_id,
          service, event_type AS name, {_case("event_type", KIND)} AS kind, t AS start_time_unix_nano,
          t + CAST(round(value * 1000) AS bigint) * 1000000 AS end_time_unix_nano,
          CAST(round(value * 1000) AS bigint) * 1000000 AS duration_ns,
          CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'purchase' THEN 'OK' ELSE 'UNSET' END AS status,
          k, user_id, day
        FROM b""",
    ),
    "f_gauge": (
        ("b",),
        f"""SELECT t AS time_unix_nano, service, event_type, 'event.value' AS metric, {_LABELS} AS labels,
          CASE WHEN k = 0 THEN 1 ELSE 0 END AS flags, value, event_id, user_id, day,
          {_TRACE_ID} AS trace_id, {_SPAN_ID} AS span_id
        FROM b""",
    ),
    "f_sum": (
        ("b",),
        f"""SELECT t AS time_unix_nano, service, event_type, 'event.count' AS metric, {_LABELS} AS labels,
          CAST(event_id % {COUNTER_PERIOD} AS double) AS value, day
        FROM b""",
    ),
    "f_sum_delta": (
        ("b",),
        f"""SELECT t AS time_unix_nano, service, event_type, 'event.delta' AS metric, {_LABELS} AS labels,
          CAST(1 AS double) AS value, day
        FROM b""",
    ),
    "f_hist": (
        ("b",),
        f"""SELECT service, day, {_DAY_NS} + {DAY - SECOND} AS time_unix_nano, {_DAY_LABELS} AS labels,
          count(*) AS count, CAST(sum(CAST(round(value * 100) AS bigint)) AS bigint) / 100.0::double AS sum,
          min(value) AS min, max(value) AS max,
          [{", ".join(f"{b}::double" for b in HIST_BOUNDS)}] AS explicit_bounds,
          [count(*) FILTER (value <= 1), count(*) FILTER (value > 1 AND value <= 5),
           count(*) FILTER (value > 5 AND value <= 25), count(*) FILTER (value > 25 AND value <= 100),
           count(*) FILTER (value > 100 AND value <= 250), count(*) FILTER (value > 250)] AS bucket_counts
        FROM b GROUP BY service, day""",
    ),
    # One row per (point, bucket): sign, index at the point's own scale, count.
    "f_exp_cells": (
        ("b",),
        f"""SELECT service, day, scale, sign, idx, count(*) AS n FROM (
          SELECT service, day, scale, x, i.idx,
            CASE WHEN x > CASE scale WHEN 0 THEN pow(2.0, idx) ELSE pow(4.0, idx) END
                  AND x <= CASE scale WHEN 0 THEN pow(2.0, idx + 1) ELSE pow(4.0, idx + 1) END THEN 1
                 WHEN -x > CASE scale WHEN 0 THEN pow(2.0, idx) ELSE pow(4.0, idx) END
                  AND -x <= CASE scale WHEN 0 THEN pow(2.0, idx + 1) ELSE pow(4.0, idx + 1) END THEN -1
                 WHEN idx = {EXP_INDEXES[0]} AND abs(x) <= CASE scale WHEN 0 THEN pow(2.0, idx) ELSE pow(4.0, idx) END
                 THEN 0 END AS sign
          FROM (SELECT service, day, value - {SKEW_CENTER}::double AS x,
                  CASE WHEN (day - DATE '1970-01-01') % 2 = 0 THEN 0 ELSE -1 END AS scale FROM b) v,
               range({EXP_INDEXES[0]}, {EXP_INDEXES[-1] + 1}) i(idx))
        WHERE sign IS NOT NULL GROUP BY ALL""",
    ),
    "f_summary": (
        ("b",),
        f"""SELECT service, day, {_DAY_NS} + {DAY - SECOND} AS time_unix_nano, {_DAY_LABELS} AS labels,
          count(*) AS count, CAST(sum(CAST(round(value * 100) AS bigint)) AS bigint) / 100.0::double AS sum,
          min(value) AS min, max(value) AS max
        FROM b GROUP BY service, day""",
    ),
}

# What cumulative points have gained: the first day of each host is not known.
VIEWS["b_after_first"] = (
    ("b",),
    """SELECT * EXCLUDE (day0) FROM (SELECT *, min(day) OVER (PARTITION BY service, user_id // 4 % 2) AS day0 FROM b)
       WHERE day > day0""",
)
VIEWS["f_hist_gained"] = (("b_after_first",), VIEWS["f_hist"][1].replace("FROM b GROUP", "FROM b_after_first GROUP"))
VIEWS["f_exp_cells_gained"] = (
    ("b_after_first",),
    VIEWS["f_exp_cells"][1].replace("FROM b)", "FROM b_after_first)").replace(
        "(day - DATE '1970-01-01') % 2 = 0", "(day - DATE '2024-01-01') % 10 < 5"
    ),
)


def with_views(sql: str, *names: str) -> str:
    """``sql`` preceded by the views it uses, their own views first."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name not in order:
            for needed in VIEWS[name][0]:
                visit(needed)
            order.append(name)

    for name in names:
        visit(name)
    text = sql.strip()
    if not order:
        return text
    views = ",\n".join(f"{n} AS ({VIEWS[n][1]})" for n in order)
    if text[:5].upper() == "WITH ":
        return f"WITH {views},\n{text[5:]}"
    return f"WITH {views}\n{text}"
