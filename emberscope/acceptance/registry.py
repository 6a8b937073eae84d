"""Where acceptance queries are collected: a Spark callable and, if any, its SQL twin."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from emberscope.acceptance.fixtures import Fixture, with_views
from emberscope.session import configure

Build = Callable[[Fixture], DataFrame]


@lru_cache(maxsize=8)
def _fixture(spark: SparkSession, sf_dir: str) -> Fixture:
    """The lazy frames of a directory; only plans are kept, no data."""
    return Fixture(spark, sf_dir)


@dataclass(frozen=True)
class Acceptance:
    name: str
    build: Build
    sql: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(_fixture(configure(spark), sf_dir))


REGISTRY: dict[str, Acceptance] = {}


def query(name: str, sql: str | None = None, views: tuple[str, ...] = ()) -> Callable[[Build], Build]:
    """Register a query; ``views`` are the fixture views its SQL twin reads."""

    def add(build: Build) -> Build:
        if name in REGISTRY:
            raise ValueError(f"query {name!r} is registered twice")
        REGISTRY[name] = Acceptance(name, build, with_views(sql, *views) if sql else None)
        return build

    return add
