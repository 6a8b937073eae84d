"""What a query read and gave back, from the metrics of the plan that ran."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from time import monotonic_ns

from pyspark.sql import DataFrame, Row


@dataclass(frozen=True)
class RunStats:
    """Sums over all scans of files: files and bytes listed after pruning, rows read; ``elapsed_ns`` ends with the run."""

    files: int
    bytes: int
    rows_scanned: int
    rows_returned: int
    elapsed_ns: int


def collect(df: DataFrame) -> tuple[list[Row], RunStats]:
    """Run a query whose result the driver may hold, such as one with a limit or a grouped one, and measure it.

    Works for every operator of this library. What an operator looked up before it returned its frame (the
    edge of a top-k, hot keys) ran earlier and is not part of it.
    """
    began = monotonic_ns()
    rows = df.collect()
    elapsed = monotonic_ns() - began
    scans = [_metrics(node) for node in _nodes(df._jdf.queryExecution().executedPlan()) if node.nodeName().startswith("Scan ")]
    sums = [sum(m.get(name, 0) for m in scans) for name in ("numFiles", "filesSize", "numOutputRows")]
    return rows, RunStats(*sums, len(rows), elapsed)


def _nodes(plan) -> Iterator:
    """All nodes of an executed plan; adaptive plans hide theirs behind their stages. A reused stage ran once."""
    name = plan.nodeName()
    if name == "AdaptiveSparkPlan":
        yield from _nodes(plan.executedPlan())
    elif name.endswith("QueryStage"):
        yield from _nodes(plan.plan())
    elif name != "ReusedExchange":
        yield plan
        children = plan.children()
        for i in range(children.size()):
            yield from _nodes(children.apply(i))


def _metrics(node) -> dict[str, int]:
    found = node.metrics()
    return {name: found.apply(name).value() for name in ("numFiles", "filesSize", "numOutputRows") if found.contains(name)}
