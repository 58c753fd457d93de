import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from barworks.session import build_session

    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def bars(spark, tmp_path_factory):
    """The derived bars of the smallest scale, written once."""
    import market_fixtures as fx
    from barworks.session import write_and_reread

    path = str(tmp_path_factory.mktemp("data") / "bars")
    return write_and_reread(fx.plain(fx.lineitem_bars(spark, SF)), path)


@pytest.fixture
def rows():
    def collected(df, *columns):
        picked = df.select(*columns) if columns else df.select(*sorted(df.columns))
        return sorted(picked.collect(), key=str)
    return collected


@pytest.fixture
def plan():
    def text(df):
        return df._jdf.queryExecution().executedPlan().toString()
    return text
