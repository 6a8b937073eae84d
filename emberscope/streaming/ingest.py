"""Continuous ingest of OTLP/JSON files into the tables."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from emberscope import schema
from emberscope.session import shuffles_dropped
from emberscope.sources import otlp, tables


def writer(
    spark: SparkSession, table: str, source: str, root: str, checkpoint: str, **options
) -> DataStreamWriter:
    """Append accepted records arriving in ``source`` to a table.

    The checkpoint tells what has been taken durably; the file sink commits a
    batch's files together, so a repeated batch leaves no duplicates. Readers
    then go by the sink's commit log, so the table must be the stream's own.
    """
    path = tables.table_path(root, table)
    if tables.exists(spark, path) and not tables.from_stream(spark, path):
        raise ValueError(f"{path} holds rows no stream wrote; they would not be read any more")
    envelopes = otlp.stream_envelopes(spark, otlp.signal_of(table), source, **options)
    rows = otlp.accepted(otlp.rows_of(envelopes, table))
    return (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .partitionBy("day")
        .option("path", path)
        .option("checkpointLocation", f"{checkpoint.rstrip('/')}/{table}")
    )


# Bytes of files that one batch takes for each core. A batch is held on disk, so it must not grow with what waits in a folder.
BATCH_BYTES = 8 << 20
_BOUNDS = ("maxfilespertrigger", "maxbytespertrigger")


def _bounded(spark: SparkSession, options: Mapping[str, object]) -> dict[str, object]:
    """Reader options with a bound on batches, unless they have one."""
    if any(o.lower() in _BOUNDS for o in options):
        return dict(options)
    return {**options, "maxBytesPerTrigger": BATCH_BYTES * spark.sparkContext.defaultParallelism}


REJECTS = "signal STRING, table STRING, reject_reason STRING, record STRING"
RECEIPTS = "signal STRING, table STRING, reason STRING, count BIGINT"


def _below(root: str, kind: str, signal: str) -> str:
    return f"{root.rstrip('/')}/_{kind}/signal={signal}"


def take(envelopes: DataFrame, batch_id: int, signal: str, root: str, promote_keys: Mapping[str, Collection[str]] | None = None) -> None:
    """Put one batch of envelopes into the tables of its signal, what is refused into the rejects, and its counts into the receipts.

    The batch is read and parsed once. Everything goes to folders named by the batch and replaces what they hold,
    so a batch that comes again after a failure changes nothing.
    """
    spark = envelopes.sparkSession
    # On disk: in memory the batch would take what the tasks need, however large it is.
    held = envelopes.persist(StorageLevel.DISK_ONLY)
    try:
        with shuffles_dropped(spark):
            _fill(held, batch_id, signal, root, promote_keys or {})
    finally:
        held.unpersist()


def _fill(held: DataFrame, batch_id: int, signal: str, root: str, promote_keys: Mapping[str, Collection[str]]) -> None:
    names = [t for t in schema.TABLE_NAMES if otlp.signal_of(t) == signal]
    refused = otlp.malformed(held).select(F.lit(None).cast("string").alias("table"), otlp.REASON, F.col("line").alias("record"))
    counts = refused.groupBy("table", F.col(otlp.REASON).alias("reason")).count()
    for name in names:
        rows = otlp.rows_of(held, name)
        tables.append(otlp.accepted(rows), root, name, promote_keys.get(name, ()), batch=str(batch_id))
        refused = refused.unionByName(otlp.refusals(rows, name))
        reason = F.coalesce(otlp.REASON, F.lit("accepted")).alias("reason")
        counts = counts.unionByName(rows.groupBy(F.lit(name).alias("table"), reason).count())
    refused.write.mode("overwrite").parquet(f"{_below(root, 'rejects', signal)}/batch={batch_id}")
    counts.coalesce(1).write.mode("overwrite").parquet(f"{_below(root, 'receipts', signal)}/batch={batch_id}")


def start_all(
    spark: SparkSession,
    sources: dict[str, str],
    root: str,
    checkpoint: str,
    trigger: dict,
    promote_keys: Mapping[str, Collection[str]] | None = None,
    **options,
) -> list[StreamingQuery]:
    """One query per signal, each filling the tables of its signal; ``sources`` maps logs / traces / metrics to directories.

    ``promote_keys``: of a table, the attribute keys that become columns. Without ``maxBytesPerTrigger`` or ``maxFilesPerTrigger``
    among the options, a batch takes files of ``BATCH_BYTES`` a core, one at least.
    """
    options, running = _bounded(spark, options), []
    for signal, source in sources.items():
        envelopes = otlp.stream_envelopes(spark, signal, source, **options)

        def each(batch: DataFrame, batch_id: int, signal: str = signal) -> None:
            take(batch, batch_id, signal, root, promote_keys)

        started = envelopes.writeStream.foreachBatch(each).option("checkpointLocation", f"{checkpoint.rstrip('/')}/{signal}")
        running.append(started.trigger(**trigger).start())
    return running


def _kept(spark: SparkSession, root: str, kind: str, layout: str) -> DataFrame:
    base = f"{root.rstrip('/')}/_{kind}"
    if not tables.exists(spark, base):
        return spark.createDataFrame([], layout)
    return spark.read.schema(layout).parquet(base).drop("batch")


def rejects(spark: SparkSession, root: str) -> DataFrame:
    """Records and lines refused so far: ``signal, table, reject_reason, record``; a line that is no envelope has no table."""
    return _kept(spark, root, "rejects", REJECTS)


def receipts(spark: SparkSession, root: str) -> DataFrame:
    """Accepted and refused counts so far: ``signal, table, reason, count``."""
    rows = _kept(spark, root, "receipts", RECEIPTS)
    return rows.groupBy("signal", "table", "reason").agg(F.sum("count").alias("count"))
