import re

import pytest

import __spark_entry__ as entry_module
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry_module.oracle_sql()))
def test_query(spark, con, name):
    compare(entry_module.queries()[name](spark, SF_DIR), con, entry_module.oracle_sql()[name])


def test_entry_has_rows(spark):
    assert entry_module.entry(spark).count() > 0


def test_every_query_has_an_oracle():
    """But for those of the training-data part that SQL can't express."""
    without = set(entry_module.queries()) - set(entry_module.oracle_sql())
    assert not {name for name in without if name != "pipeline" and not re.match(r"op\d+_", name)}
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
