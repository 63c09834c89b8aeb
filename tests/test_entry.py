import re
from pathlib import Path

import pytest

import __spark_entry__ as entry
from checks.compare import connect, differences

SF = "/root/testdata/sf0.001"
EMPTY_AT_THIS_SIZE = {"sweep_select_median_low", "sweep_select_target"}


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    found = differences(spark, duck, name, SF, entry.queries(), entry.oracle_sql())
    if name in EMPTY_AT_THIS_SIZE:
        found = [f for f in found if f != "both empty"]
    assert not found


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def test_every_statement_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_library_never_gathers_or_crosses():
    """No local checkpoints, cross joins or pattern of collecting documents in the library."""
    for path in Path(entry.__file__).parent.glob("corpuslens/**/*.py"):
        source = path.read_text()
        assert not re.search(r"localCheckpoint|crossJoin|\.toLocalIterator|\.rdd\.(map|flatMap|collect)", source), path
