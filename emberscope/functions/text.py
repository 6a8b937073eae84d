"""Full-text match without an index: every token of the query must occur."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_TOKEN = re.compile(r"[^\W_]+")


def query_tokens(text: str) -> list[str]:
    """Lower-case letter/digit runs of the query text, each once."""
    return list(dict.fromkeys(_TOKEN.findall(text.lower())))


def matches(column: Column, text: str) -> Column:
    """True where ``column`` holds every token of ``text``, in any order.

    The cheap substring test runs first; only rows passing it are tried against
    the regular expression that requires the token to stand alone.
    """
    tokens = query_tokens(text)
    if not tokens:
        return F.lit(False)

    def all_in(lowered: Column) -> Column:
        tests = []
        for token in tokens:
            alone = rf"(?<![\p{{L}}\p{{N}}]){token}(?![\p{{L}}\p{{N}}])"
            tests += [F.contains(lowered, F.lit(token)), lowered.rlike(alone)]
        return reduce(lambda a, b: a & b, tests)

    # The lambda binds the lower-cased text, so that it is made once per row.
    return F.exists(F.array(F.lower(column)), all_in)
