"""Every query against its SQL counterpart."""

import pytest
from compare import differences

import __spark_entry__ as entry
from stocktide.plans import catalog


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_equals_sql(spark, duck, sf_dir, name):
    assert differences(entry.queries()[name](spark, sf_dir), duck, entry.oracle_sql()[name]) is None


def test_every_query_has_sql():
    assert set(catalog.queries()) <= set(entry.oracle_sql())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["date", "store_id", "product_id", "total_quantity", "total_revenue", "order_count"]
    assert df.count() > 0
