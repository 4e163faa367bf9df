"""Logical tables, their schemas, column defaults and audit settings."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

PARTITION_COLS = ("year", "month", "day")

# ---------------------------------------------------------------------------
# Fixed values that must equal the source schema's column defaults.
# customer:     address 'somewhere', contact 'user@domain.com', credit_limit 44
# manufacturer: address 'somewhere---', contact 'info@company.com'
# order:        reference 'reference---'
# product:      color 'red'
# order_items:  quality 44, unit_price 444.444
# Every table:  year, month, day, created_at, updated_at default to "now";
#               order.purchase_date, product.manufacture_date, product.purchase_date
#               and order_items.warranty default to "now" as epoch seconds.
# varchar lengths: customer name 50, address 50, contact 20; manufacturer name,
#               address, contact 50; order reference 50; product color 50.
# Change-log action domain: 'I', 'D', 'U', 'T'.
# ---------------------------------------------------------------------------
LITERAL_DEFAULTS = {
    "customer": {"address": "somewhere", "contact": "user@domain.com", "credit_limit": 44.0},
    "manufacturer": {"address": "somewhere---", "contact": "info@company.com"},
    "order": {"reference": "reference---"},
    "product": {"color": "red"},
    "order_items": {"quality": 44, "unit_price": 444.444},
}
NOW_EPOCH_DEFAULTS = {
    "customer": ("created_at", "updated_at"),
    "manufacturer": ("created_at", "updated_at"),
    "order": ("purchase_date", "created_at", "updated_at"),
    "product": ("manufacture_date", "purchase_date", "created_at", "updated_at"),
    "order_items": ("warranty", "created_at", "updated_at"),
}
VARCHAR_LENGTHS = {
    "customer": {"name": 50, "address": 50, "contact": 20},
    "manufacturer": {"name": 50, "address": 50, "contact": 50},
    "order": {"reference": 50},
    "product": {"color": 50},
}
ACTIONS = ("I", "D", "U", "T")

_COMMON = [
    T.StructField("year", T.LongType()),
    T.StructField("month", T.LongType()),
    T.StructField("day", T.LongType()),
    T.StructField("created_at", T.LongType()),
    T.StructField("updated_at", T.LongType()),
]


def _schema(*fields: T.StructField) -> T.StructType:
    return T.StructType([T.StructField("id", T.LongType(), False), *fields, *_COMMON])


SCHEMAS = {
    "customer": _schema(
        T.StructField("name", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("contact", T.StringType()),
        T.StructField("credit_limit", T.DoubleType()),
    ),
    "manufacturer": _schema(
        T.StructField("name", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("contact", T.StringType()),
    ),
    "order": _schema(
        T.StructField("customer_id", T.LongType(), False),
        T.StructField("reference", T.StringType()),
        T.StructField("purchase_date", T.LongType()),
    ),
    "product": _schema(
        T.StructField("manufacture_id", T.LongType(), False),
        T.StructField("manufacture_date", T.LongType()),
        T.StructField("color", T.StringType()),
        T.StructField("purchase_date", T.LongType()),
    ),
    "order_items": _schema(
        T.StructField("order_id", T.LongType(), False),
        T.StructField("product_id", T.LongType(), False),
        T.StructField("quality", T.IntegerType()),
        T.StructField("warranty", T.LongType()),
        T.StructField("unit_price", T.FloatType()),
    ),
}

#: The change log as the refresh reads it (one row per audited row event).
CHANGELOG_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType(), False),
        T.StructField("schema_name", T.StringType(), False),
        T.StructField("table_name", T.StringType(), False),
        T.StructField("action", T.StringType(), False),
        T.StructField("action_tstamp_tx", T.LongType()),
        T.StructField("row_data", T.LongType()),
        T.StructField("changed_fields", T.LongType()),
        T.StructField("client_query", T.StringType()),
        T.StructField("statement_only", T.BooleanType(), False),
    ]
)

#: Foreign keys: (child table, child column, parent table).
FOREIGN_KEYS = (
    ("order", "customer_id", "customer"),
    ("product", "manufacture_id", "manufacturer"),
    ("order_items", "order_id", "order"),
    ("order_items", "product_id", "product"),
)


@dataclass(frozen=True)
class TableSpec:
    """One audited, lake-mirrored table.

    ``name`` is the logical name, as written in the change log's ``table_name``;
    ``source_name`` is how the source is addressed (quoted where the source needs it);
    ``path_segment`` is the lake folder. The audit flags carry the defaults of the
    source's audit registration: row events on, query text on, no ignored columns.
    """

    name: str
    source_name: str | None = None
    path_segment: str | None = None
    key: str = "id"
    date_col: str = "updated_at"
    audit_rows: bool = True
    audit_query_text: bool | None = True
    ignored_cols: tuple[str, ...] = field(default_factory=tuple)

    @property
    def source(self) -> str:
        return self.source_name or self.name

    @property
    def folder(self) -> str:
        return self.path_segment or self.name


TABLE_NAMES = ("customer", "manufacturer", "product", "order", "order_items")

DEFAULT_SPECS = (
    TableSpec("customer"),
    TableSpec("manufacturer"),
    TableSpec("product"),
    TableSpec("order", source_name='"order"', path_segment="order"),
    TableSpec("order_items"),
)


def spec_for(name: str, specs=DEFAULT_SPECS) -> TableSpec:
    for s in specs:
        if s.name == name:
            return s
    raise KeyError(name)
