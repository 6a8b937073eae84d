"""Column layouts: the seven tables and the OTLP/JSON envelopes."""

from __future__ import annotations

from pyspark.sql import types as T

LOGS = "logs"
SPANS = "spans"
GAUGE = "metrics_gauge"
SUM = "metrics_sum"
HISTOGRAM = "metrics_histogram"
EXP_HISTOGRAM = "metrics_exp_histogram"
SUMMARY = "metrics_summary"

METRIC_TABLES = (GAUGE, SUM, HISTOGRAM, EXP_HISTOGRAM, SUMMARY)
TABLE_NAMES = (LOGS, SPANS, *METRIC_TABLES)

# Metric kind as shown in the catalog, per table.
METRIC_KIND = {
    GAUGE: "gauge",
    SUM: "sum",
    HISTOGRAM: "histogram",
    EXP_HISTOGRAM: "exp_histogram",
    SUMMARY: "summary",
}

_MAP = "MAP<STRING,STRING>"
_EVENTS = f"ARRAY<STRUCT<time:BIGINT,name:STRING,attributes:{_MAP}>>"
_LINKS = f"ARRAY<STRUCT<trace_id:STRING,span_id:STRING,trace_state:STRING,attributes:{_MAP}>>"
_EXEMPLARS = (
    "ARRAY<STRUCT<time:BIGINT,value:DOUBLE,trace_id:STRING,span_id:STRING,attributes:STRING>>"
)
_BUCKETS = "STRUCT<offset:INT,bucket_counts:ARRAY<BIGINT>>"

_LOGS = f"""
  time_unix_nano BIGINT, observed_time_unix_nano BIGINT, service STRING,
  severity_number INT, severity_text STRING, body STRING, trace_id STRING,
  span_id STRING, event_name STRING, flags BIGINT, scope_name STRING,
  scope_version STRING, resource {_MAP}, attributes {_MAP}, day DATE"""

_SPANS = f"""
  trace_id STRING, span_id STRING, parent_span_id STRING, service STRING,
  name STRING, kind STRING, start_time_unix_nano BIGINT, end_time_unix_nano BIGINT,
  duration_ns BIGINT, status STRING, status_message STRING, trace_state STRING,
  flags BIGINT, events {_EVENTS}, links {_LINKS}, scope_name STRING,
  scope_version STRING, resource {_MAP}, attributes {_MAP}, day DATE"""

_POINT = f"""
  time_unix_nano BIGINT, start_time_unix_nano BIGINT, service STRING, metric STRING,
  unit STRING, description STRING, temporality STRING, flags BIGINT, labels STRING,
  attributes {_MAP}, resource {_MAP}, day DATE"""

_TABLE_DDL = {
    LOGS: _LOGS,
    SPANS: _SPANS,
    GAUGE: f"{_POINT}, exemplars {_EXEMPLARS}, value DOUBLE",
    SUM: f"{_POINT}, exemplars {_EXEMPLARS}, value DOUBLE, is_monotonic BOOLEAN",
    HISTOGRAM: f"""{_POINT}, exemplars {_EXEMPLARS}, count BIGINT, sum DOUBLE, min DOUBLE,
        max DOUBLE, explicit_bounds ARRAY<DOUBLE>, bucket_counts ARRAY<BIGINT>""",
    EXP_HISTOGRAM: f"""{_POINT}, exemplars {_EXEMPLARS}, count BIGINT, sum DOUBLE, min DOUBLE,
        max DOUBLE, scale INT, zero_count BIGINT, zero_threshold DOUBLE,
        positive {_BUCKETS}, negative {_BUCKETS}""",
    SUMMARY: f"""{_POINT}, count BIGINT, sum DOUBLE,
        quantile_values ARRAY<STRUCT<quantile:DOUBLE,value:DOUBLE>>""",
}

# The column holding a row's event time.
TIME_COLUMN = {name: "time_unix_nano" for name in TABLE_NAMES}
TIME_COLUMN[SPANS] = "start_time_unix_nano"


def table_ddl(name: str) -> str:
    if name not in _TABLE_DDL:
        raise ValueError(f"unknown table {name!r}, expected one of {', '.join(TABLE_NAMES)}")
    return _TABLE_DDL[name]


def table_schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(table_ddl(name))


# --- OTLP/JSON envelopes -------------------------------------------------------
#
# 64-bit integers are JSON strings in OTLP/JSON. Every AnyValue alternative is
# read as STRING: the JSON reader then hands over a scalar's text, or the raw
# JSON text of an array or key/value list.
_ANY = (
    "STRUCT<stringValue:STRING,boolValue:STRING,intValue:STRING,doubleValue:STRING,"
    "bytesValue:STRING,arrayValue:STRING,kvlistValue:STRING>"
)
_KVS = f"ARRAY<STRUCT<key:STRING,value:{_ANY}>>"
_RESOURCE = f"STRUCT<attributes:{_KVS}>"
_SCOPE = "STRUCT<name:STRING,version:STRING>"

OTLP_LOGS = f"""resourceLogs ARRAY<STRUCT<resource:{_RESOURCE},scopeLogs:ARRAY<STRUCT<scope:{_SCOPE},
  logRecords:ARRAY<STRUCT<timeUnixNano:STRING,observedTimeUnixNano:STRING,severityNumber:INT,
    severityText:STRING,body:{_ANY},attributes:{_KVS},flags:BIGINT,traceId:STRING,spanId:STRING,
    eventName:STRING>>>>>>"""

OTLP_TRACES = f"""resourceSpans ARRAY<STRUCT<resource:{_RESOURCE},scopeSpans:ARRAY<STRUCT<scope:{_SCOPE},
  spans:ARRAY<STRUCT<traceId:STRING,spanId:STRING,traceState:STRING,parentSpanId:STRING,flags:BIGINT,
    name:STRING,kind:STRING,startTimeUnixNano:STRING,endTimeUnixNano:STRING,attributes:{_KVS},
    events:ARRAY<STRUCT<timeUnixNano:STRING,name:STRING,attributes:{_KVS}>>,
    links:ARRAY<STRUCT<traceId:STRING,spanId:STRING,traceState:STRING,attributes:{_KVS}>>,
    status:STRUCT<message:STRING,code:STRING>>>>>>>"""

_EX = (
    f"exemplars:ARRAY<STRUCT<filteredAttributes:{_KVS},timeUnixNano:STRING,asDouble:DOUBLE,"
    "asInt:STRING,spanId:STRING,traceId:STRING>>"
)
_PT = f"attributes:{_KVS},startTimeUnixNano:STRING,timeUnixNano:STRING,flags:BIGINT"
_NUMBER = f"ARRAY<STRUCT<{_PT},asDouble:DOUBLE,asInt:STRING,{_EX}>>"
_COUNTS = "STRUCT<offset:INT,bucketCounts:ARRAY<STRING>>"

OTLP_METRICS = f"""resourceMetrics ARRAY<STRUCT<resource:{_RESOURCE},
  scopeMetrics:ARRAY<STRUCT<scope:{_SCOPE},
  metrics:ARRAY<STRUCT<name:STRING,description:STRING,unit:STRING,
    gauge:STRUCT<dataPoints:{_NUMBER}>,
    sum:STRUCT<dataPoints:{_NUMBER},aggregationTemporality:STRING,isMonotonic:BOOLEAN>,
    histogram:STRUCT<dataPoints:ARRAY<STRUCT<{_PT},count:STRING,sum:DOUBLE,min:DOUBLE,max:DOUBLE,
        bucketCounts:ARRAY<STRING>,explicitBounds:ARRAY<DOUBLE>,{_EX}>>,aggregationTemporality:STRING>,
    exponentialHistogram:STRUCT<dataPoints:ARRAY<STRUCT<{_PT},count:STRING,sum:DOUBLE,min:DOUBLE,
        max:DOUBLE,scale:INT,zeroCount:STRING,zeroThreshold:DOUBLE,positive:{_COUNTS},
        negative:{_COUNTS},{_EX}>>,aggregationTemporality:STRING>,
    summary:STRUCT<dataPoints:ARRAY<STRUCT<{_PT},count:STRING,sum:DOUBLE,
        quantileValues:ARRAY<STRUCT<quantile:DOUBLE,value:DOUBLE>>>>>
  >>>>>>"""

ENVELOPE_DDL = {"logs": OTLP_LOGS, "traces": OTLP_TRACES, "metrics": OTLP_METRICS}
