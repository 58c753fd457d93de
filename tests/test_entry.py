import pytest

import __spark_entry__ as e
import check_oracle

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check_oracle.connect(SF)


def test_every_query_has_its_sql():
    assert set(e._own_queries()) <= set(e.oracle_sql())


def test_entry_has_rows(spark):
    df = e.entry(spark)
    assert df.columns[:2] == ["trade_date", "exchange_code"] and df.count() > 0


@pytest.mark.parametrize("name", list(e._own_queries()))
def test_query_matches_sql(spark, con, name):
    ok, note = check_oracle.compare(spark, con, name, e.queries()[name], e.oracle_sql()[name], SF)
    assert ok, note
