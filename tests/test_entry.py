"""The driver contract."""
import __spark_entry__ as E

from conftest import SMOKE


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"customer_state", "seller_state", "n", "median_freight"} <= set(df.columns)


def test_every_oracle_has_a_query():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(o) >= 150


def test_fixture_views_run_on_smoke_data(spark):
    q = E.queries()
    for name in ("src1_items", "src1_orders", "agg07_monthly", "jon10_platform_load", "met02_average_precision"):
        assert q[name](spark, SMOKE).count() >= 0
