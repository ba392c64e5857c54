"""Every registered query against its SQL text, on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

import __spark_entry__ as contract  # noqa: E402
import compare  # noqa: E402

from matchlake.workloads import registry  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return compare.oracle(SF_DIR)


def test_every_query_has_a_check():
    assert set(registry.queries()) == set(registry.oracle_sql())
    assert set(registry.queries()) <= set(contract.queries())


@pytest.mark.parametrize("key", sorted(registry.queries()))
def test_query_equals_its_sql(spark, duck, key):
    columns, rows = compare.spark_rows(contract.queries()[key](spark, SF_DIR))
    wanted_columns, wanted = compare.duck_rows(duck, contract.oracle_sql()[key])
    assert columns == wanted_columns
    assert rows == wanted


def test_entry(spark):
    assert contract.entry(spark).count() > 0
