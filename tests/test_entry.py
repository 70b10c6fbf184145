import __spark_entry__ as contract
from stockflow.queries import REGISTRY


def test_entry_gives_rows_with_a_stable_schema(spark):
    df = contract.entry(spark)
    assert df.columns == ["order_date", "location_code", "product_id", "sku", "total_qty_sold", "total_revenue_eur", "n_lines"]
    assert df.count() > 0


def test_every_query_has_a_twin():
    assert set(REGISTRY) <= set(contract.queries())
    assert set(REGISTRY) <= set(contract.oracle_sql()) <= set(contract.queries())
    assert len(REGISTRY) > 50
