"""Common table expressions of the domain for the SQL twins, in step with ``sources.domain``."""

ORDER_LINES = """
order_lines AS (
    SELECT l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS line_no, l_partkey AS product_id,
        l_suppkey AS supplier_id, CAST(l_quantity AS DECIMAL(12,2)) AS qty_ordered,
        CAST(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE floor(l_quantity / 2) END AS DECIMAL(12,2))
            AS qty_fulfilled,
        CAST(l_extendedprice AS DECIMAL(12,2)) AS line_total_eur, CAST(l_shipdate AS DATE) AS ship_date
    FROM lineitem)"""

ORDERS = """
located_orders AS (
    SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_ts,
        CAST(o_orderdate AS DATE) AS order_date,
        CASE o_orderpriority WHEN '1-URGENT' THEN 'phone' WHEN '2-HIGH' THEN 'online' WHEN '3-MEDIUM' THEN 'counter'
            WHEN '4-NOT SPECIFIED' THEN 'counter' WHEN '5-LOW' THEN 'erp_import' END AS source,
        CAST(o_totalprice AS DECIMAL(12,2)) AS order_total_eur, CAST(c_nationkey AS BIGINT) AS location_id
    FROM orders JOIN customer ON c_custkey = o_custkey)"""

SALE_LINES = f"""{ORDER_LINES}, {ORDERS},
sale_lines AS (SELECT * FROM order_lines JOIN located_orders USING (order_id))"""

LOCATIONS = """
locations AS (
    SELECT CAST(n_nationkey AS BIGINT) AS location_id, printf('LOC-%02d', n_nationkey) AS location_code,
        n_name AS location_name, r_name AS region,
        CASE WHEN r_name IN ('ASIA', 'MIDDLE EAST') THEN 'regional_warehouse' ELSE 'sanicenter' END AS location_type
    FROM nation JOIN region ON n_regionkey = r_regionkey)"""

PRODUCTS = """
products AS (
    SELECT p_partkey AS product_id, printf('SKU-%05d', p_partkey) AS sku, p_name AS product_name, p_brand AS category,
        CAST(p_retailprice AS DECIMAL(12,2)) AS unit_price_eur, CAST(p_size AS BIGINT) AS lead_time_days
    FROM part)"""

CUSTOMERS = """
customers AS (
    SELECT c_custkey AS customer_id, printf('C%08d', c_custkey) AS customer_code, c_name AS customer_name,
        CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'plumber' WHEN 'BUILDING' THEN 'contractor'
            WHEN 'FURNITURE' THEN 'architect' WHEN 'MACHINERY' THEN 'retailer'
            WHEN 'HOUSEHOLD' THEN 'individual' END AS customer_type,
        c_acctbal >= 0 AS is_active
    FROM customer)"""

SUPPLIERS = """
suppliers AS (
    SELECT s_suppkey AS supplier_id, s_name AS supplier_name, n_name AS country,
        CAST(s_nationkey AS BIGINT) AS location_id
    FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""

INVENTORY = f"""{SUPPLIERS},
inventory AS (
    SELECT l_partkey AS product_id, location_id,
        SUM(CAST(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0 END AS DECIMAL(12,2))) AS qty_on_hand,
        SUM(CAST(CASE WHEN l_linestatus = 'F' THEN 0 ELSE l_quantity END AS DECIMAL(12,2))) AS qty_reserved,
        10 AS min_stock_level, 30 AS reorder_point, 200 AS max_stock_level
    FROM lineitem JOIN suppliers ON supplier_id = l_suppkey
    GROUP BY 1, 2)"""

# Needs ORDER_LINES.
PURCHASE_LINES = """
purchase_lines AS (
    SELECT l.order_id AS po_id, l.line_no, l.product_id, l.supplier_id, l.qty_ordered, l.qty_fulfilled AS qty_received,
        CAST(o_orderdate AS DATE) AS created_on,
        CASE o_orderstatus WHEN 'O' THEN 'sent' WHEN 'P' THEN 'confirmed' WHEN 'F' THEN 'received' END AS status,
        CAST(o_orderdate AS DATE) + 30 AS expected_delivery,
        CASE WHEN ship_date >= CAST(o_orderdate AS DATE) THEN ship_date END AS actual_delivery
    FROM order_lines l JOIN orders ON o_orderkey = l.order_id)"""

# Needs SALE_LINES, INVENTORY and PURCHASE_LINES.
LEDGER = """
ledger AS (
    SELECT concat_ws('-', 'open', product_id, location_id) AS movement_id, product_id, location_id,
        'initial_stock' AS movement_type, qty_on_hand AS qty_delta, CAST(NULL AS BIGINT) AS ref_order_id,
        CAST(NULL AS VARCHAR) AS ref_order_type, TIMESTAMP '1994-12-31 07:00:00' AS movement_ts,
        'Opening stock balance' AS notes
    FROM inventory
    UNION ALL
    SELECT concat_ws('-', 'sale', order_id, line_no, product_id, supplier_id), product_id, location_id, 'sale',
        -qty_fulfilled, order_id, 'sales_order', order_ts, 'Fulfilled from sales order ' || order_id
    FROM sale_lines WHERE qty_fulfilled > 0
    UNION ALL
    SELECT concat_ws('-', 'receipt', po_id, line_no, product_id, supplier_id), product_id, s.location_id, 'po_receipt',
        qty_received, po_id, 'purchase_order', CAST(actual_delivery AS TIMESTAMP) + INTERVAL 8 HOURS,
        'Received from PO ' || po_id || ' — supplier ' || supplier_id
    FROM purchase_lines JOIN suppliers s USING (supplier_id)
    WHERE qty_received > 0 AND actual_delivery IS NOT NULL)"""

# One row per order and product, straight from the lines.
SALES_FEED = f"""{SALE_LINES}, {LOCATIONS}, {PRODUCTS}, {CUSTOMERS},
sale_products AS (
    SELECT order_id, product_id, customer_id, location_id, order_ts, order_date, source, order_total_eur,
        SUM(qty_ordered) AS qty_ordered, SUM(qty_fulfilled) AS qty_fulfilled, SUM(line_total_eur) AS line_total_eur
    FROM sale_lines GROUP BY ALL),
sales_feed AS (
    SELECT CAST(s.order_id AS VARCHAR) AS order_id, s.order_ts, s.order_date,
        CASE WHEN qty_fulfilled >= qty_ordered THEN 'fulfilled' ELSE 'partial' END AS status, s.source,
        CAST(s.customer_id AS VARCHAR) AS customer_id, customer_code, customer_name, customer_type,
        CAST(s.location_id AS VARCHAR) AS location_id, location_code, CAST(s.product_id AS VARCHAR) AS product_id, sku,
        CAST(qty_ordered AS DOUBLE) AS qty_ordered, CAST(qty_fulfilled AS DOUBLE) AS qty_fulfilled,
        CAST(unit_price_eur AS DOUBLE) AS unit_price_eur, CAST(line_total_eur AS DOUBLE) AS line_total_eur,
        CAST(order_total_eur AS DOUBLE) AS order_total_eur, s.order_ts + INTERVAL 18 HOURS AS erp_export_ts
    FROM sale_products s
    JOIN customers c ON c.customer_id = s.customer_id
    JOIN locations l ON l.location_id = s.location_id
    JOIN products p ON p.product_id = s.product_id)"""

def with_(*parts: str) -> str:
    return "WITH " + ", ".join(part.strip() for part in parts) + "\n"
