"""Attribute and label lookup, and the canonical label JSON."""

from __future__ import annotations

import re
from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Keys that name the dedicated service column.
SERVICE_KEYS = ("service", "service.name")


def promoted_column(key: str) -> str:
    """Name of the physical column that holds a promoted attribute key.

    Everything but lower-case letters and digits is written as its code, so that
    no two keys share a column, whatever their case.
    """
    return "attr_" + re.sub(r"[^0-9a-z]", lambda m: f"_{ord(m[0]):x}_", key)


def attr(key: str, columns: Collection[str] = ()) -> Column:
    """Value of an attribute: the record's own, else its resource's.

    ``columns`` are the columns of the frame the expression is meant for; when
    the key was promoted to a column there, the column is read instead of the
    maps, so the predicate can reach the Parquet scan.
    """
    if key in SERVICE_KEYS:
        return F.col("service")
    if promoted_column(key) in columns:
        return F.col(promoted_column(key))
    return F.coalesce(
        F.try_element_at("attributes", F.lit(key)), F.try_element_at("resource", F.lit(key))
    )


def label(key: str, columns: Collection[str] = ()) -> Column:
    """A metric label; a missing label equals the empty string."""
    return F.coalesce(attr(key, columns), F.lit(""))


def canonical_json(mapping: Column | str) -> Column:
    """JSON object of a string map with its keys sorted, so equal sets are equal text."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(mapping))))


def label_set(labels: Mapping[str, Column]) -> Column:
    """Canonical JSON of a fixed set of keys; a missing value leaves its key out."""
    if not labels:
        return F.lit("{}")
    return F.to_json(F.struct(*[labels[k].alias(k) for k in sorted(labels)]))


def promote(df: DataFrame, keys: Collection[str]) -> DataFrame:
    """Add one column per attribute key, to be written next to the maps."""
    return df.withColumns({promoted_column(k): attr(k) for k in keys})
