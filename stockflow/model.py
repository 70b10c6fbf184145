"""Table specifications: schemas, merge keys and row rules.

A new feed is a new ``TableSpec``; the operators read everything they need from it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class TableSpec:
    """One feed or table.

    ``schema`` is the lakehouse schema; ``added`` names its columns that the load fills in and a landing
    file does not carry. ``latest_by`` orders versions of one key, newest first, and must decide every tie. Dates outside
    ``dates`` (both days included) are refused while landing, so a table has no more periods than that range. ``aliases`` are other names that
    exports give to columns. ``multiline`` says that quoted text may hold line breaks; files are then not split.
    """

    name: str
    schema: T.StructType
    keys: tuple[str, ...]
    date_key: str
    latest_by: tuple[str, ...] = ()
    added: tuple[str, ...] = ()
    money: tuple[str, ...] = ()
    dates: tuple[str, str] = ("1900-01-01", "2199-12-31")
    domains: dict[str, tuple[str, ...]] = field(default_factory=dict)
    ranges: dict[str, tuple[float, float]] = field(default_factory=dict)
    max_lengths: dict[str, int] = field(default_factory=dict)
    foreign_keys: tuple[ForeignKey, ...] = ()
    aliases: dict[str, str] = field(default_factory=dict)
    multiline: bool = False
    defaults: dict[str, object] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def landing_columns(self) -> list[str]:
        return [c for c in self.columns if c not in self.added]

    def landing_schema(self) -> T.StructType:
        return T.StructType([f for f in self.schema if f.name not in self.added])

    def silver_schema(self) -> T.StructType:
        """Quantities and money become exact decimals from Silver on."""
        return T.StructType(
            [
                T.StructField(f.name, T.DecimalType(12, 2) if f.name in self.money else f.dataType, f.nullable)
                for f in self.schema
            ]
        )


_TEXT, _TIME, _DATE, _NUMBER = T.StringType(), T.TimestampType(), T.DateType(), T.DoubleType()

# Column names, types, keys and allowed values of the data model.
MOVEMENT_SCHEMA = T.StructType(
    [
        T.StructField("movement_id", _TEXT, False),
        T.StructField("movement_ts", _TIME),
        T.StructField("movement_date", _DATE, False),
        T.StructField("movement_type", _TEXT),
        T.StructField("product_id", _TEXT),
        T.StructField("sku", _TEXT),
        T.StructField("location_id", _TEXT),
        T.StructField("location_code", _TEXT),
        T.StructField("qty_delta", _NUMBER),
        T.StructField("ref_order_id", _TEXT),
        T.StructField("ref_order_type", _TEXT),
        T.StructField("notes", _TEXT),
        T.StructField("erp_export_ts", _TIME),
        T.StructField("source_system", _TEXT),
        T.StructField("processed_date", _TIME),
    ]
)
SALES_SCHEMA = T.StructType(
    [
        T.StructField("order_id", _TEXT, False),
        T.StructField("order_ts", _TIME),
        T.StructField("order_date", _DATE, False),
        T.StructField("status", _TEXT),
        T.StructField("source", _TEXT),
        T.StructField("customer_id", _TEXT),
        T.StructField("customer_code", _TEXT),
        T.StructField("customer_name", _TEXT),
        T.StructField("customer_type", _TEXT),
        T.StructField("location_id", _TEXT),
        T.StructField("location_code", _TEXT),
        T.StructField("product_id", _TEXT),
        T.StructField("sku", _TEXT),
        T.StructField("qty_ordered", _NUMBER),
        T.StructField("qty_fulfilled", _NUMBER),
        T.StructField("unit_price_eur", _NUMBER),
        T.StructField("line_total_eur", _NUMBER),
        T.StructField("order_total_eur", _NUMBER),
        T.StructField("erp_export_ts", _TIME),
        T.StructField("source_system", _TEXT),
        T.StructField("processed_date", _TIME),
    ]
)
MONITORING = T.StructType(
    [
        T.StructField("date", _TIME),
        T.StructField("source_file", _TEXT),
        T.StructField("rows", T.LongType()),
        T.StructField("merge_key", _TEXT),
        T.StructField("nulls_dropped", T.LongType()),
        T.StructField("incompatible", T.LongType()),
    ]
)
ACCOUNTING = T.StructType(
    [
        T.StructField("date", _TIME),
        T.StructField("source_file", _TEXT),
        T.StructField("landed", T.LongType()),
        T.StructField("accepted", T.LongType()),
        T.StructField("rejected", T.LongType()),
        T.StructField("superseded", T.LongType()),
    ]
)
CHANGES = T.StructType([T.StructField("load_id", _TEXT), T.StructField("period", _DATE)])
LOCATION_TYPES = ("sanicenter", "regional_warehouse")
CUSTOMER_TYPES = ("plumber", "contractor", "architect", "retailer", "individual")
ORDER_STATUSES = ("pending", "fulfilled", "partial", "cancelled")
ORDER_SOURCES = ("counter", "phone", "online", "erp_import")
PO_STATUSES = ("draft", "sent", "confirmed", "received", "partial", "cancelled")
MOVEMENT_TYPES = ("sale", "po_receipt", "adjustment", "transfer", "initial_stock")
# End of fixed values.

# A landed line that does not split into the header's fields keeps its text in this column.
MALFORMED = "malformed_row"
# What is wrong with the export that a line comes from.
SCHEMA_FAULT = "schema_fault"

_ADDED = ("source_system", "processed_date")

MOVEMENTS = TableSpec(
    name="inventory_movements",
    schema=MOVEMENT_SCHEMA,
    keys=("movement_id", "movement_date"),
    date_key="movement_date",
    latest_by=("erp_export_ts", "movement_ts", "qty_delta"),
    added=_ADDED,
    money=("qty_delta",),
    multiline=True,
    domains={"movement_type": MOVEMENT_TYPES},
    max_lengths={"ref_order_type": 20},
    foreign_keys=(
        ForeignKey("product_id", "products", "product_id"),
        ForeignKey("location_id", "locations", "location_id"),
    ),
)

# One row per order line: the product belongs to the key, else lines of one order would overwrite each other.
SALES = TableSpec(
    name="sales",
    schema=SALES_SCHEMA,
    keys=("order_id", "order_date", "product_id"),
    date_key="order_date",
    latest_by=("erp_export_ts", "order_ts", "line_total_eur", "qty_ordered", "qty_fulfilled"),
    added=_ADDED,
    money=("qty_ordered", "qty_fulfilled", "unit_price_eur", "line_total_eur", "order_total_eur"),
    domains={"status": ORDER_STATUSES, "source": ORDER_SOURCES, "customer_type": CUSTOMER_TYPES},
    max_lengths={"customer_code": 10, "customer_name": 150, "sku": 20},
    foreign_keys=(
        ForeignKey("customer_id", "customers", "customer_id"),
        ForeignKey("location_id", "locations", "location_id"),
        ForeignKey("product_id", "products", "product_id"),
    ),
)

FEEDS = {spec.name: spec for spec in (SALES, MOVEMENTS)}
