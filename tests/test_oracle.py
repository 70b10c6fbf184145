import os

import pytest

from stockflow.queries import REGISTRY
from tests.compare import connect, differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in REGISTRY.items() if sql))
def test_same_rows_as_sql(name, spark, con):
    query, sql = REGISTRY[name]
    assert differences(query(spark, SF_DIR), con, sql) is None


def test_sales_view_is_whole_and_in_order(spark, con):
    query, sql = REGISTRY["sales_view"]
    keys = ["sale_date", "total_qty_sold", "location_name", "category", "product_name"]
    found = [tuple(r) for r in query(spark, SF_DIR).select(*keys).collect()]
    assert len(found) == REGISTRY["daily_sales"][0](spark, SF_DIR).count() > 100
    assert found == con.execute(f"SELECT {', '.join(keys)} FROM ({sql})").fetchall()
