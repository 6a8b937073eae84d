"""Session settings the library relies on, and where job output may be put."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

# Event time is kept as BIGINT nanoseconds of the unix epoch, so zone-less
# timestamps must be read as UTC. The rest only affects physical plans.
_REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split skewed join partitions even when a later step then has to shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in _REQUIRED.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", app: str = "emberscope", **conf) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(let_workers_import(spark))


def let_workers_import(spark: SparkSession) -> SparkSession:
    """Put this package on the path of Python workers that share the driver's files.

    On clusters that do not, ship the package as usual (``--py-files``).
    """
    root = str(Path(__file__).resolve().parent.parent)
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
    return spark


_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within it, what a query shuffled leaves the disks as the query ends, not once the driver has collected garbage.

    For jobs that write one large frame after another; a frame run again shuffles anew.
    """
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_DROP_SHUFFLES)
        else:
            spark.conf.set(_DROP_SHUFFLES, before)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path for job output.

    On a cluster it lies in the shared folder named by ``spark.checkpoint.dir``;
    a machine-local folder is used only when that setting is absent and the session
    itself is local.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    name = f"{label}-{uuid.uuid4().hex}"
    if shared:
        return f"{shared.rstrip('/')}/emberscope/{name}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return os.path.join(tempfile.mkdtemp(prefix="run-", dir="/tmp"), name)
