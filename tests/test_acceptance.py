"""Every registered query against its SQL twin, on the smallest data."""

from __future__ import annotations

import importlib.util
import os
from pathlib import Path

import pytest

import __spark_entry__ as contract
from emberscope.acceptance import REGISTRY

SF_DIR = os.environ.get("ACCEPTANCE_SF_DIR", "/root/testdata/sf0.001")

_spec = importlib.util.spec_from_file_location(
    "check", Path(__file__).resolve().parent.parent / "tools" / "check.py"
)
check = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(check)


@pytest.fixture(scope="module")
def duck():
    return check.connect(SF_DIR)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query_matches_its_twin(spark, duck, name):
    ok, note, _ = check.compare(name, spark, duck, SF_DIR)
    assert ok, note


def test_contract(spark):
    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
    # Only file listings have no twin: their names differ from run to run.
    own = set(contract.queries()) - set(contract.QUERIES)
    assert own - set(contract.oracle_sql()) == {"segments", "segment_files"}
