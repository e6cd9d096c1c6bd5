import __spark_entry__ as entry
import pytest

from noctule.catalog.queries import QUERIES
from tests.compare import compare, connect
from tests.conftest import SF_DIR


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql())


def test_entry(spark):
    df = entry.entry(spark)
    assert set(df.columns) == {"version", "source", "generated", "tile", "pos", "id", "darkness", "bortle", "altitude", "changed"} and df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    same, note = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF_DIR)
    assert same and "types" not in note, note
