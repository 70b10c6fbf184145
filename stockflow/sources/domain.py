"""The domain's tables over a star schema of parquet tables.

sale line = line item of an order; product = part; location = nation (of the customer for sales, of the supplier
for stock and purchases); purchase order = line item seen from its supplier, due thirty days after the order and
delivered on its ship date unless that lies before the order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow.functions.expressions import fulfilment_status, money
from stockflow.lake import path_bytes

# Fixed values of this mapping.
WAREHOUSE_REGIONS = ("ASIA", "MIDDLE EAST")
SEGMENT_TO_CUSTOMER_TYPE = {
    "AUTOMOBILE": "plumber",
    "BUILDING": "contractor",
    "FURNITURE": "architect",
    "MACHINERY": "retailer",
    "HOUSEHOLD": "individual",
}
PRIORITY_TO_SOURCE = {
    "1-URGENT": "phone",
    "2-HIGH": "online",
    "3-MEDIUM": "counter",
    "4-NOT SPECIFIED": "counter",
    "5-LOW": "erp_import",
}
STATUS_TO_PO_STATUS = {"O": "sent", "P": "confirmed", "F": "received"}
OPENING_TIME = "1994-12-31 07:00:00"
MIN_STOCK, REORDER_POINT, MAX_STOCK = 10, 30, 200
DUE_DAYS = 30
# End of fixed values.

# Source files of a dimension up to this size are broadcast; beyond it the planner shuffles and splits skew.
BROADCAST_BYTES = 8 * 1024 * 1024


def relabel(column: Column, labels: dict[str, str], default: str | None = None) -> Column:
    (first, *rest) = labels.items()
    mapped = F.when(column == first[0], first[1])
    for value, label in rest:
        mapped = mapped.when(column == value, label)
    return mapped if default is None else mapped.otherwise(default)


def sku_of(product_id: Column) -> Column:
    return F.format_string("SKU-%05d", product_id)


class Domain:
    """Lazy DataFrames of the domain; each method reads only the columns its consumers keep."""

    def __init__(self, spark: SparkSession, sf_dir: str, broadcast_bytes: int = BROADCAST_BYTES):
        self.spark, self.sf_dir, self.broadcast_bytes = spark, sf_dir, broadcast_bytes

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def dimension(self, df: DataFrame, *tables: str) -> DataFrame:
        """Broadcast a dimension joined from several tables, if the size of their files allows it.

        The planner's estimate for a join is the product of its sides, so it would shuffle the facts on the few
        keys of a tiny dimension. Dimensions over one table need no hint: their estimate is the file's size.
        """
        size = sum(path_bytes(self.spark, self.path(t)) for t in tables)
        return df.hint("broadcast") if size <= self.broadcast_bytes else df

    def products(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("product_id"),
            sku_of(F.col("p_partkey")).alias("sku"),
            F.col("p_name").alias("product_name"),
            F.col("p_brand").alias("category"),
            money(F.col("p_retailprice")).alias("unit_price_eur"),
            F.col("p_size").cast("bigint").alias("lead_time_days"),
        )

    def locations(self) -> DataFrame:
        nation, region = self.table("nation"), self.table("region")
        kind = F.when(F.col("r_name").isin(*WAREHOUSE_REGIONS), "regional_warehouse").otherwise("sanicenter")
        placed = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
            F.col("n_nationkey").cast("bigint").alias("location_id"),
            F.format_string("LOC-%02d", "n_nationkey").alias("location_code"),
            F.col("n_name").alias("location_name"),
            kind.alias("location_type"),
            F.col("r_name").alias("region"),
        )
        return self.dimension(placed, "nation", "region")

    def customers(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("customer_id"),
            F.format_string("C%08d", "c_custkey").alias("customer_code"),
            F.col("c_name").alias("customer_name"),
            relabel(F.col("c_mktsegment"), SEGMENT_TO_CUSTOMER_TYPE).alias("customer_type"),
            F.col("c_nationkey").cast("bigint").alias("location_id"),
            (F.col("c_acctbal") >= 0).alias("is_active"),
        )

    def suppliers(self) -> DataFrame:
        nation = self.table("nation").select("n_nationkey", F.col("n_name").alias("country"))
        placed = (
            self.table("supplier")
            .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("s_suppkey").alias("supplier_id"),
                F.col("s_name").alias("supplier_name"),
                "country",
                F.col("s_nationkey").cast("bigint").alias("location_id"),
                F.lit(float(DUE_DAYS)).alias("avg_lead_time_days"),
            )
        )
        return self.dimension(placed, "supplier", "nation")

    def order_lines(self) -> DataFrame:
        ordered = F.col("l_quantity")
        fulfilled = F.when(F.col("l_linestatus") == "F", ordered).otherwise(F.floor(ordered / 2))
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").cast("bigint").alias("line_no"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("supplier_id"),
            money(ordered).alias("qty_ordered"),
            money(fulfilled).alias("qty_fulfilled"),
            money(F.col("l_extendedprice")).alias("line_total_eur"),
            F.col("l_shipdate").cast("date").alias("ship_date"),
        )

    def orders(self) -> DataFrame:
        """Orders with the location of their customer. This join touches orders only, a fraction of the lines."""
        located = self.customers().select("customer_id", "location_id")
        return (
            self.table("orders")
            .select(
                F.col("o_orderkey").alias("order_id"),
                F.col("o_custkey").alias("customer_id"),
                F.col("o_orderdate").alias("order_ts"),
                F.col("o_orderdate").cast("date").alias("order_date"),
                relabel(F.col("o_orderpriority"), PRIORITY_TO_SOURCE).alias("source"),
                money(F.col("o_totalprice")).alias("order_total_eur"),
            )
            .join(located, "customer_id")
        )

    def sale_lines(self) -> DataFrame:
        """Order lines with order date and location: the lines are shuffled once, on the order."""
        return self.order_lines().join(self.orders(), "order_id")

    def traded_lines(self) -> DataFrame:
        """Order lines as sale and as purchase: with order, customer's and supplier's location and delivery, shuffled once, on the order.

        A location is NULL where the customer or the supplier is unknown.
        """
        customers = self.customers().select("customer_id", "location_id")
        suppliers = self.suppliers().select("supplier_id", F.col("location_id").alias("supplier_location_id"))
        orders = self.table("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("order_ts"),
            F.col("o_orderdate").cast("date").alias("order_date"),
        )
        delivered = F.when(F.col("ship_date") >= F.col("order_date"), F.col("ship_date"))
        lines = self.order_lines().join(orders.join(customers, "customer_id", "left"), "order_id").join(suppliers, "supplier_id", "left")
        return lines.withColumns({"actual_delivery": delivered, "expected_delivery": F.date_add("order_date", DUE_DAYS)})

    def order_sources(self) -> DataFrame:
        return self.table("orders").select(F.col("o_orderkey").alias("order_id"), relabel(F.col("o_orderpriority"), PRIORITY_TO_SOURCE).alias("source"))

    def inventory(self) -> DataFrame:
        """Stock per product and supplier location: lines shipped are on hand, lines still open are reserved."""
        located = self.suppliers().select("supplier_id", F.col("location_id"))
        finished = F.col("l_linestatus") == "F"
        lines = self.table("lineitem").select(
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("supplier_id"),
            F.when(finished, F.col("l_quantity")).otherwise(0).alias("on_hand"),
            F.when(finished, 0).otherwise(F.col("l_quantity")).alias("reserved"),
        )
        return (
            lines.join(located, "supplier_id")
            .groupBy("product_id", "location_id")
            .agg(
                F.sum(money(F.col("on_hand"))).alias("qty_on_hand"),
                F.sum(money(F.col("reserved"))).alias("qty_reserved"),
            )
            .withColumns(
                {
                    "min_stock_level": money(F.lit(MIN_STOCK)),
                    "reorder_point": money(F.lit(REORDER_POINT)),
                    "max_stock_level": money(F.lit(MAX_STOCK)),
                }
            )
        )

    def purchase_lines(self) -> DataFrame:
        """Purchase order lines with their order's dates, status and supplier; one line per order."""
        placed = self.table("orders").select(
            F.col("o_orderkey").alias("po_id"),
            F.col("o_orderdate").cast("date").alias("created_on"),
            relabel(F.col("o_orderstatus"), STATUS_TO_PO_STATUS).alias("status"),
        )
        lines = self.order_lines().withColumnsRenamed({"order_id": "po_id", "qty_fulfilled": "qty_received"})
        delivered = F.when(F.col("ship_date") >= F.col("created_on"), F.col("ship_date"))
        return lines.join(placed, "po_id").withColumns(
            {
                "expected_delivery": F.date_add("created_on", DUE_DAYS),
                "actual_delivery": delivered,
            }
        )

    def sales_feed(self) -> DataFrame:
        """The sales export: one flat row per order and product. Times are text, as an export writes them."""
        customers = self.customers().select("customer_id", "customer_code", "customer_name", "customer_type")
        locations = self.locations().select("location_id", "location_code")
        # A product that stands there n times gives n rows of each order.
        products = self.products().groupBy("product_id", "unit_price_eur").agg(F.count(F.lit(1)).alias("times"))
        orders = self.orders().join(customers, "customer_id").join(locations, "location_id")
        # The narrow lines are shuffled on the product, where products are too many to broadcast, and on the order; no row with its customer is shuffled.
        sums = [F.sum(c).alias(c) for c in ("qty_ordered", "qty_fulfilled", "line_total_eur")]
        of_product = ["product_id", "unit_price_eur", "times"]
        ordered = self.order_lines().select("order_id", "product_id", "qty_ordered", "qty_fulfilled", "line_total_eur").join(products, "product_id")
        summed = ordered.join(orders, "order_id").groupBy(*orders.columns, *of_product).agg(*sums)
        lines = summed.select("*", sku_of(F.col("product_id")).alias("sku"), F.explode(F.sequence(F.lit(1).cast("long"), "times")))
        stamp = "yyyy-MM-dd HH:mm:ss"
        return lines.select(
            F.col("order_id").cast("string").alias("order_id"),
            F.date_format("order_ts", stamp).alias("order_ts"),
            "order_date",
            fulfilment_status(F.col("qty_fulfilled"), F.col("qty_ordered")).alias("status"),
            "source",
            F.col("customer_id").cast("string").alias("customer_id"),
            "customer_code",
            "customer_name",
            "customer_type",
            F.col("location_id").cast("string").alias("location_id"),
            "location_code",
            F.col("product_id").cast("string").alias("product_id"),
            "sku",
            "qty_ordered",
            "qty_fulfilled",
            "unit_price_eur",
            "line_total_eur",
            "order_total_eur",
            F.date_format(F.col("order_ts") + F.expr("INTERVAL 18 HOURS"), stamp).alias("erp_export_ts"),
        )
