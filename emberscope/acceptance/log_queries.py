"""Filters on logs and the log operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberscope.acceptance.fixtures import FIRST_DAY_NS, Fixture
from emberscope.acceptance.registry import query
from emberscope.functions.text import matches
from emberscope.functions.timegrid import DAY, HOUR
from emberscope.operators import logs
from emberscope.plans.specs import LogQuery, TimeRange

_COLUMNS = ["time_unix_nano", "service", "severity_number", "body"]
_SELECT = f"SELECT {', '.join(_COLUMNS)} FROM f_logs"
_NEWEST = "ORDER BY " + ", ".join(f"{c} DESC" for c in _COLUMNS)
_OLDEST = "ORDER BY " + ", ".join(_COLUMNS)
_SPLIT = r"string_split_regex(lower({}), '[^\p{{L}}\p{{N}}]+')"

RANGE = TimeRange(FIRST_DAY_NS + 9 * DAY, FIRST_DAY_NS + 11 * DAY + 6 * HOUR)


def _tokens(column: str, *words: str) -> str:
    split = _SPLIT.format(column)
    return " AND ".join(f"list_contains({split}, '{w}')" for w in words)


def _filter(name: str, where: str, **conditions) -> None:
    """A query that returns every row a filter accepts."""

    @query(name, f"{_SELECT} WHERE {where}", ("f_logs",))
    def build(fx: Fixture) -> DataFrame:
        return logs.matching(fx.logs, LogQuery(**conditions)).select(_COLUMNS)


_filter("logs_by_service", "service = 'checkout'", service="checkout")
_filter("logs_min_severity", "severity_number >= 13", min_severity=13)
_filter("logs_text_match", _tokens("body", "error", "user", "7"), text="Error, user-7")
_filter(
    "logs_time_range",
    f"time_unix_nano >= {RANGE.start} AND time_unix_nano < {RANGE.end}",
    range=RANGE,
)
_filter("logs_attr_eq", "event_type = 'purchase'", attr_eq=[("event.type", "purchase")])
_filter("logs_attr_exists", "amount IS NOT NULL", attr_exists=["amount"])
_filter("logs_attr_matches", "event_type = 'purchase'", attr_matches=[("event.type", "PURCHASE")])
_filter(
    "logs_attr_regex",
    "regexp_matches(CAST(user_id AS varchar), '^1[0-4]')",
    attr_regex=[("user.id", "^1[0-4]")],
)
_filter("logs_attr_in", "k IN (1, 2, 3)", attr_in=[("k", ["1", "2", "3"])])
_filter(
    "logs_attr_not_in",
    "amount IS NULL OR amount NOT IN (1, 2, 3)",
    attr_not_in=[("amount", ["1", "2", "3"])],
)
_filter(
    "logs_attr_num",
    "amount > 20 AND k <= 50",
    attr_num=[("amount", ">", 20), ("k", "<=", 50)],
)


@query(
    "documents_text_match",
    f"SELECT doc_id, lang, source, n_chars FROM documents WHERE {_tokens('text', 'the', 'with')}",
)
def _documents(fx: Fixture) -> DataFrame:
    docs = fx.raw("documents")
    return docs.where(matches(F.col("text"), "the with")).select("doc_id", "lang", "source", "n_chars")


_ERRORS = LogQuery(service="checkout", min_severity=13)
_IS_ERROR = "service = 'checkout' AND severity_number >= 13"


@query("logs_query", f"{_SELECT} WHERE {_IS_ERROR} {_NEWEST} LIMIT 100", ("f_logs",))
def _query(fx: Fixture) -> DataFrame:
    return logs.query(fx.logs, _ERRORS).select(_COLUMNS)


@query("logs_forward", f"{_SELECT} WHERE {_IS_ERROR} {_OLDEST} LIMIT 30", ("f_logs",))
def _forward(fx: Fixture) -> DataFrame:
    q = LogQuery(service="checkout", min_severity=13, direction="forward", limit=30)
    return logs.query(fx.logs, q).select(_COLUMNS)


@query("logs_offset", f"{_SELECT} WHERE {_IS_ERROR} {_NEWEST} LIMIT 20 OFFSET 40", ("f_logs",))
def _offset(fx: Fixture) -> DataFrame:
    q = LogQuery(service="checkout", min_severity=13, offset=40, limit=20)
    return logs.query(fx.logs, q).select(_COLUMNS)


_PAGED = LogQuery(service="cart", text="error", limit=25)
_PAGE_SQL = f"{_SELECT} WHERE service = 'cart' AND {_tokens('body', 'error')} {_NEWEST} LIMIT 25"


@query("logs_page_1", _PAGE_SQL, ("f_logs",))
def _page_1(fx: Fixture) -> DataFrame:
    return logs.page(fx.logs, _PAGED).rows.select(_COLUMNS)


@query("logs_page_2", f"{_PAGE_SQL} OFFSET 25", ("f_logs",))
def _page_2(fx: Fixture) -> DataFrame:
    return logs.page(fx.logs, _PAGED, after=25).rows.select(_COLUMNS)


@query("logs_page_keyset", f"{_PAGE_SQL} OFFSET 25", ("f_logs",))
def _page_keyset(fx: Fixture) -> DataFrame:
    first = logs.page_after(fx.logs, _PAGED).collect()
    return logs.page_after(fx.logs, _PAGED, logs.next_cursor(first)).select(_COLUMNS)


_TIED = "service = 'cart' AND severity_number >= 17 AND " + _tokens("body", "error")


@query(
    "logs_page_keyset_ties",
    f"""WITH twice AS (SELECT * FROM f_logs UNION ALL SELECT * FROM f_logs),
        first AS (SELECT {", ".join(_COLUMNS)} FROM twice WHERE {_TIED} {_NEWEST} LIMIT 75)
        SELECT * FROM first""",
    ("f_logs",),
)
def _page_keyset_ties(fx: Fixture) -> DataFrame:
    """Three pages of 25 rows over logs that all occur twice: every page but the first begins after a cursor."""
    twice = fx.logs.unionByName(fx.logs)
    q = LogQuery(service="cart", text="error", min_severity=17, limit=25)
    pages, cursor = [], None
    for _ in range(3):
        page = logs.page_after(twice, q, cursor)
        rows = page.collect()
        pages.append(page.select(_COLUMNS))
        cursor = logs.next_cursor(rows, cursor)
    out = pages[0]
    for page in pages[1:]:
        out = out.unionByName(page)
    return out


@query(
    "logs_page_keyset_all",
    f"""SELECT {", ".join(_COLUMNS)} FROM (SELECT * FROM f_logs UNION ALL SELECT * FROM f_logs)
        WHERE severity_number >= 17 AND {_tokens('body', 'error')}""",
    ("f_logs",),
)
def _page_keyset_all(fx: Fixture) -> DataFrame:
    """All pages up to the first empty one, over logs that all occur twice."""
    twice = fx.logs.unionByName(fx.logs)
    q = LogQuery(text="error", min_severity=17, limit=max(100, logs.count(twice, LogQuery()).first()[0] // 12))
    out, cursor = None, None
    while True:
        page = logs.page_after(twice, q, cursor)
        behind = logs.cursor_behind(page, q, cursor)
        if behind == cursor:
            return out if out is not None else page.select(_COLUMNS)
        out = page.select(_COLUMNS) if out is None else out.unionByName(page.select(_COLUMNS))
        cursor = behind


@query(
    "logs_offset_half",
    f"""SELECT {", ".join(_COLUMNS)} FROM (SELECT *, row_number() OVER ({_NEWEST}) AS rn, count(*) OVER () AS n FROM f_logs)
        WHERE rn > n // 2 AND rn <= n // 2 + 100""",
    ("f_logs",),
)
def _offset_half(fx: Fixture) -> DataFrame:
    """The 100 rows in the middle of all logs, by their offset."""
    offset = logs.count(fx.logs, LogQuery()).first()[0] // 2
    return logs.query(fx.logs, LogQuery(offset=offset, limit=100)).select(_COLUMNS)


@query("logs_count", f"SELECT count(*) AS count FROM f_logs WHERE {_IS_ERROR}", ("f_logs",))
def _count(fx: Fixture) -> DataFrame:
    q = LogQuery(service="checkout", min_severity=13, limit=1, offset=5, direction="forward")
    return logs.count(fx.logs, q)


@query(
    "logs_volume",
    f"""SELECT time_unix_nano - time_unix_nano % {HOUR} AS bucket_time, '{{}}' AS labels, count(*) AS count
        FROM f_logs GROUP BY ALL""",
    ("f_logs",),
)
def _volume(fx: Fixture) -> DataFrame:
    return logs.volume(fx.logs, LogQuery(), HOUR)


@query(
    "logs_volume_by_service",
    f"""SELECT time_unix_nano - time_unix_nano % {HOUR} AS bucket_time,
          '{{"event.type":"' || event_type || '","service":"' || service || '"}}' AS labels, count(*) AS count
        FROM f_logs GROUP BY ALL""",
    ("f_logs",),
)
def _volume_by(fx: Fixture) -> DataFrame:
    return logs.volume(fx.logs, LogQuery(), HOUR, ["service", "event.type"])


@query(
    "logs_query_stats",
    f"""SELECT count(*) AS rows_scanned,
          least(count(*) FILTER ({_IS_ERROR}), 100) AS rows_returned FROM f_logs""",
    ("f_logs",),
)
def _stats(fx: Fixture) -> DataFrame:
    rows, stats = logs.query_with_stats(fx.logs, _ERRORS)
    rows.write.format("noop").mode("overwrite").save()
    return fx.spark.range(1).select(
        F.lit(stats.rows_scanned).cast("bigint").alias("rows_scanned"),
        F.lit(stats.rows_returned).cast("bigint").alias("rows_returned"),
    )


@query(
    "log_lines",
    f"{_SELECT} WHERE service IN ('cart', 'auth') AND contains(body, 'error by') "
    f"AND NOT contains(body, 'key 7') {_NEWEST} LIMIT 1000",
    ("f_logs",),
)
def _lines(fx: Fixture) -> DataFrame:
    found = logs.lines(
        fx.logs,
        FIRST_DAY_NS,
        FIRST_DAY_NS + 40 * DAY,
        service=[("=~", "cart|auth")],
        contains=["error by"],
        excludes=["key 7"],
    )
    return found.select(_COLUMNS)
