import pytest

from harness.compare import compare
from harness.oracle import statements
from harness.plain import PLAIN
from harness.queries import registered

SMALL = "/root/testdata/sf0.001"

def test_every_query_has_sql():
    assert set(registered()) == set(statements())


@pytest.mark.parametrize("name", sorted(registered()))
def test_query_equals_its_sql(spark, name):
    assert compare(spark, SMALL, name, statements()[name]).startswith("ok")


@pytest.mark.parametrize("name", sorted(PLAIN))
def test_direct_form_gives_the_same_rows(spark, rows, name):
    ours = registered()[name](spark, SMALL)
    assert rows(ours, *sorted(ours.columns)) == rows(PLAIN[name](spark, SMALL), *sorted(ours.columns))


def test_entry_point(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns[0] == "msisdn"
    assert set(entry.oracle_sql()) <= set(entry.queries())
