"""Data-quality operators. Faults are put into the tables by the meaning of their columns, over all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockflow.model import CUSTOMER_TYPES, ORDER_SOURCES, ORDER_STATUSES, SALES
from stockflow.operators import quality
from stockflow.plans import layers
from stockflow.queries import sql
from stockflow.queries.common import as_doubles, as_plain_time, grain_for
from stockflow.queries.loading import FIRST_RUN, _FILE, _YEARLY, export_sales
from stockflow.sources import oltp
from stockflow.sources.domain import PRIORITY_TO_SOURCE, Domain, relabel

KEYS = ["order_id", "order_date"]


def keyless_orders(d: Domain) -> DataFrame:
    """Orders whose id is lost for low priority, and whose date is lost while they are in progress."""
    return d.table("orders").select(
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderkey")).alias("order_id"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate").cast("date")).alias("order_date"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("total_eur"),
    )


def drop_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, _ = quality.drop_null_keys(keyless_orders(Domain(spark, sf_dir)), KEYS)
    return kept


def null_key_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, counts = quality.drop_null_keys(keyless_orders(Domain(spark, sf_dir)), KEYS)
    return counts


def faulty_feed(d: Domain) -> DataFrame:
    """The sales feed without the id of phone orders, and with text for the price of partial lines."""
    feed = d.sales_feed()
    return feed.withColumns(
        {
            "order_id": F.nullif(F.when(F.col("source") != "phone", F.col("order_id")), F.lit("")),
            "unit_price_eur": F.when(F.col("status") == "partial", "n/a").otherwise(F.col("unit_price_eur").cast("string")),
        }
    )


def faulty_lake(spark: SparkSession, sf_dir: str, label: str):
    d = Domain(spark, sf_dir)
    lake, landing_dir = export_sales(spark, sf_dir, label, faulty_feed(d))
    layers.load_bronze(lake, SALES, landing_dir, FIRST_RUN, grain=grain_for(d, "orders", "o_orderdate"))
    return lake


def ingest_monitoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_plain_time(faulty_lake(spark, sf_dir, "monitoring").read(layers.MONITORING_TABLE), "date")


def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = faulty_lake(spark, sf_dir, "rejected").read(layers.rejected_table(SALES))
    return rows.select("order_id", "product_id", "order_date", "unit_price_eur", "line_total_eur", "source_file", F.array_join("reasons", ",").alias("reasons"))


TEXT_LINES = T.StructType(
    [
        T.StructField("order_id", T.LongType()),
        T.StructField("line_no", T.LongType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("qty", T.DecimalType(12, 2)),
        T.StructField("shipped_on", T.DateType()),
    ]
)


def text_lines(d: Domain) -> DataFrame:
    """Lines as text, as an export holds them: returned lines lost their quantity's form, open ones their date."""
    text = {
        "order_id": F.col("l_orderkey").cast("string"),
        "line_no": F.col("l_linenumber").cast("string"),
        "product_id": F.col("l_partkey").cast("string"),
        "qty": F.concat(F.when(F.col("l_returnflag") == "R", "x").otherwise(""), F.col("l_quantity").cast("bigint").cast("string")),
        "shipped_on": F.when(F.col("l_linestatus") == "O", "soon").otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")),
    }
    return d.table("lineitem").select(*[c.alias(n) for n, c in text.items()], F.col("l_suppkey").alias("supplier_id"))


def schema_incompatible_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = text_lines(Domain(spark, sf_dir)).withColumn("reasons", quality.row_reasons(TEXT_LINES, []))
    return quality.rejected(lines).withColumn("reasons", F.array_join("reasons", ","))


def silver_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = quality.try_typed(text_lines(Domain(spark, sf_dir)), TEXT_LINES, ["supplier_id"])
    return as_doubles(typed, "qty")


def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(Domain(spark, sf_dir).table("lineitem"), ["l_orderkey", "l_linenumber"])


def domain_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order status, source and customer type against their allowed values."""
    d = Domain(spark, sf_dir)
    known = {p: s for p, s in PRIORITY_TO_SOURCE.items() if p != "2-HIGH"}
    orders = d.table("orders").select(
        F.col("o_orderkey").alias("order_id"),
        relabel(F.col("o_orderstatus"), {"F": "fulfilled", "P": "partial"}, "open").alias("status"),
        F.coalesce(relabel(F.col("o_orderpriority"), known), F.lower("o_orderpriority")).alias("source"),
        F.col("o_custkey").alias("customer_id"),
    )
    customers = d.table("customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.when(F.col("c_mktsegment") == "BUILDING", "contractor").when(F.col("c_mktsegment") == "MACHINERY", "mill").alias("customer_type"),
    )
    domains = {"status": ORDER_STATUSES, "source": ORDER_SOURCES, "customer_type": CUSTOMER_TYPES}
    checked = quality.with_violations(orders.join(customers, "customer_id"), domains)
    return quality.rejected(checked).withColumn("reasons", F.array_join("reasons", ","))


def range_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score between 0 and 1 (an unknown one passes), name no longer than its column allows."""
    suppliers = Domain(spark, sf_dir).table("supplier").select(
        F.col("s_suppkey").alias("supplier_id"),
        F.col("s_name").alias("supplier_name"),
        F.when(F.col("s_nationkey") != 0, F.col("s_acctbal") / 5000).alias("reliability_score"),
    )
    checked = quality.with_violations(suppliers, ranges={"reliability_score": (0, 1)}, max_lengths={"supplier_name": 100})
    return quality.rejected(checked).withColumn("reasons", F.array_join("reasons", ","))


def fk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of customers that are not among the active ones."""
    d = Domain(spark, sf_dir)
    orders = d.table("orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"))
    return quality.foreign_key_violations(orders, "customer_id", oltp.active_only(d.customers()), "customer_id")


def apply_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = Domain(spark, sf_dir).table("part").select(
        F.col("p_partkey").alias("product_id"),
        F.nullif(F.col("p_size"), F.lit(1)).alias("min_order_qty"),
        F.nullif(F.col("p_brand"), F.lit("Brand#2")).alias("brand"),
        F.when(F.col("p_type") != "ECONOMY", F.lit(False)).alias("is_active"),
        F.when(F.col("p_type") != "SMALL", F.lit("2024-10-01 00:00:00").cast("timestamp_ntz")).alias("created_at"),
    )
    opened = F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")
    return quality.apply_defaults(parts, {"min_order_qty": 0, "brand": "none", "is_active": True, "created_at": opened})


_FAULTY = (
    sql.with_(sql.SALES_FEED)
    + f""", faulty AS (
    SELECT CASE WHEN source <> 'phone' THEN order_id END AS order_id, product_id, order_date,
        CASE WHEN status = 'partial' THEN 'n/a' ELSE printf('%.2f', unit_price_eur) END AS unit_price_eur,
        line_total_eur, {_FILE} AS source_file, {_YEARLY} AS exported_at
    FROM sales_feed)
"""
)

QUERIES = {
    "drop_null_keys": (
        drop_null_keys,
        """SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date, o_custkey AS customer_id,
    o_totalprice AS total_eur
FROM orders WHERE o_orderpriority <> '5-LOW' AND o_orderstatus <> 'P'""",
    ),
    "null_key_counts": (
        null_key_counts,
        """SELECT COUNT(*) AS rows, 'order_id' AS merge_key,
    COUNT(*) FILTER (WHERE o_orderpriority = '5-LOW') AS nulls_dropped FROM orders
UNION ALL
SELECT COUNT(*), 'order_date', COUNT(*) FILTER (WHERE o_orderstatus = 'P') FROM orders""",
    ),
    "ingest_monitoring": (
        ingest_monitoring,
        _FAULTY
        + """, counted AS (
    SELECT exported_at, source_file, COUNT(*) AS n, COUNT(*) FILTER (WHERE order_id IS NULL) AS no_id,
        COUNT(*) FILTER (WHERE unit_price_eur = 'n/a') AS bad
    FROM faulty GROUP BY 1, 2)
SELECT exported_at AS date, source_file, n AS rows, k AS merge_key, CASE WHEN k = 'order_id' THEN no_id ELSE 0 END
    AS nulls_dropped, bad AS incompatible
FROM counted CROSS JOIN (VALUES ('order_id'), ('order_date'), ('product_id')) AS v(k)""",
    ),
    "rejected_rows": (
        rejected_rows,
        _FAULTY
        + """SELECT order_id, product_id, CAST(order_date AS VARCHAR) AS order_date, unit_price_eur,
    printf('%.2f', line_total_eur) AS line_total_eur, source_file,
    concat_ws(',', CASE WHEN order_id IS NULL THEN 'null_key:order_id' END,
        CASE WHEN unit_price_eur = 'n/a' THEN 'type:unit_price_eur' END) AS reasons
FROM faulty WHERE order_id IS NULL OR unit_price_eur = 'n/a'""",
    ),
    "schema_incompatible_rows": (
        schema_incompatible_rows,
        """WITH text_lines AS (
    SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS VARCHAR) AS line_no,
        CAST(l_partkey AS VARCHAR) AS product_id,
        CASE WHEN l_returnflag = 'R' THEN 'x' ELSE '' END || CAST(l_quantity AS BIGINT) AS qty,
        CASE WHEN l_linestatus = 'O' THEN 'soon' ELSE strftime(l_shipdate, '%Y-%m-%d') END AS shipped_on,
        l_suppkey AS supplier_id
    FROM lineitem)
SELECT *, concat_ws(',', CASE WHEN TRY_CAST(qty AS DECIMAL(12,2)) IS NULL THEN 'type:qty' END,
    CASE WHEN TRY_CAST(shipped_on AS DATE) IS NULL THEN 'type:shipped_on' END) AS reasons
FROM text_lines WHERE TRY_CAST(qty AS DECIMAL(12,2)) IS NULL OR TRY_CAST(shipped_on AS DATE) IS NULL""",
    ),
    "silver_typed": (
        silver_typed,
        """SELECT l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS line_no, l_partkey AS product_id,
    CASE WHEN l_returnflag <> 'R' THEN l_quantity END AS qty,
    CASE WHEN l_linestatus <> 'O' THEN CAST(l_shipdate AS DATE) END AS shipped_on, l_suppkey AS supplier_id
FROM lineitem""",
    ),
    "duplicate_keys": (
        duplicate_keys,
        "SELECT l_orderkey, l_linenumber, COUNT(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1",
    ),
    "domain_violations": (
        domain_violations,
        f"""WITH coded AS (
    SELECT o_orderkey AS order_id, o_custkey AS customer_id,
        CASE o_orderstatus WHEN 'F' THEN 'fulfilled' WHEN 'P' THEN 'partial' ELSE 'open' END AS status,
        CASE o_orderpriority WHEN '1-URGENT' THEN 'phone' WHEN '3-MEDIUM' THEN 'counter'
            WHEN '4-NOT SPECIFIED' THEN 'counter' WHEN '5-LOW' THEN 'erp_import' ELSE lower(o_orderpriority) END AS source,
        CASE c_mktsegment WHEN 'BUILDING' THEN 'contractor' WHEN 'MACHINERY' THEN 'mill' END AS customer_type
    FROM orders JOIN customer ON c_custkey = o_custkey),
judged AS (
    SELECT *, concat_ws(',',
        CASE WHEN status NOT IN {ORDER_STATUSES} THEN 'domain:status' END,
        CASE WHEN source NOT IN {ORDER_SOURCES} THEN 'domain:source' END,
        CASE WHEN customer_type NOT IN {CUSTOMER_TYPES}
            THEN 'domain:customer_type' END) AS reasons
    FROM coded)
SELECT * FROM judged WHERE reasons <> ''""",
    ),
    "range_violations": (
        range_violations,
        """SELECT s_suppkey AS supplier_id, s_name AS supplier_name, s_acctbal / 5000 AS reliability_score,
    'range:reliability_score' AS reasons
FROM supplier WHERE s_nationkey <> 0 AND NOT s_acctbal / 5000 BETWEEN 0 AND 1""",
    ),
    "fk_violations": (
        fk_violations,
        """SELECT o_orderkey AS order_id, o_custkey AS customer_id FROM orders
WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal >= 0)""",
    ),
    "apply_defaults": (
        apply_defaults,
        """SELECT p_partkey AS product_id, COALESCE(nullif(p_size, 1), 0) AS min_order_qty,
    COALESCE(nullif(p_brand, 'Brand#2'), 'none') AS brand, p_type = 'ECONOMY' AS is_active,
    CASE WHEN p_type <> 'SMALL' THEN TIMESTAMP '2024-10-01' ELSE TIMESTAMP '2025-01-01' END AS created_at
FROM part""",
    ),
}
