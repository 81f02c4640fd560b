"""The five sales tables and the audit log: types, keys, limits and defaults."""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

# Wide enough for the order lines of a large store, which outnumber the 32-bit integers.
KEY = LongType()
MONEY = DecimalType(12, 2)
# A stamp without a zone, so that its year and day do not move with the session's zone.
STAMP = TimestampNTZType()


def now() -> Column:
    return F.localtimestamp()


@dataclass(frozen=True)
class ForeignKey:
    name: str
    column: str
    parent: str
    parent_column: str = "Id"


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: StructType
    key: str
    foreign_keys: tuple[ForeignKey, ...] = ()
    text_limits: dict[str, int] = field(default_factory=dict)
    defaults: dict[str, object] = field(default_factory=dict)

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]


def _col(name: str, kind: DataType, required: bool = False) -> StructField:
    return StructField(name, kind, nullable=not required)


# Names, types, limits and defaults of the tables as declared.
CUSTOMER = TableSpec(
    name="Customer",
    schema=StructType(
        [
            _col("Id", KEY, True),
            _col("FirstName", StringType(), True),
            _col("LastName", StringType(), True),
            _col("City", StringType()),
            _col("Country", StringType()),
            _col("Phone", StringType()),
        ]
    ),
    key="Id",
    text_limits={"FirstName": 40, "LastName": 40, "City": 40, "Country": 40, "Phone": 20},
)
SUPPLIER = TableSpec(
    name="Supplier",
    schema=StructType(
        [
            _col("Id", KEY, True),
            _col("CompanyName", StringType(), True),
            _col("ContactName", StringType()),
            _col("ContactTitle", StringType()),
            _col("City", StringType()),
            _col("Country", StringType()),
            _col("Phone", StringType()),
            _col("Fax", StringType()),
        ]
    ),
    key="Id",
    text_limits={
        "CompanyName": 40,
        "ContactName": 50,
        "ContactTitle": 40,
        "City": 40,
        "Country": 40,
        "Phone": 30,
        "Fax": 30,
    },
)
PRODUCT = TableSpec(
    name="Product",
    schema=StructType(
        [
            _col("Id", KEY, True),
            _col("ProductName", StringType(), True),
            _col("SupplierId", KEY, True),
            _col("UnitPrice", MONEY),
            _col("Package", StringType()),
            _col("IsDiscontinued", BooleanType(), True),
        ]
    ),
    key="Id",
    foreign_keys=(ForeignKey("FK_PRODUCT_REFERENCE_SUPPLIER", "SupplierId", "Supplier"),),
    text_limits={"ProductName": 50, "Package": 30},
    defaults={"UnitPrice": Decimal(0), "IsDiscontinued": False},
)
ORDER = TableSpec(
    name="Order",
    schema=StructType(
        [
            _col("Id", KEY, True),
            _col("OrderDate", STAMP, True),
            _col("OrderNumber", StringType()),
            _col("CustomerId", KEY, True),
            _col("TotalAmount", MONEY),
        ]
    ),
    key="Id",
    foreign_keys=(ForeignKey("FK_ORDER_REFERENCE_CUSTOMER", "CustomerId", "Customer"),),
    text_limits={"OrderNumber": 10},
    defaults={"OrderDate": now, "TotalAmount": Decimal(0)},
)
ORDER_ITEM = TableSpec(
    name="OrderItem",
    schema=StructType(
        [
            _col("Id", KEY, True),
            _col("OrderId", KEY, True),
            _col("ProductId", KEY, True),
            _col("UnitPrice", MONEY, True),
            _col("Quantity", IntegerType(), True),
        ]
    ),
    key="Id",
    foreign_keys=(
        ForeignKey("FK_ORDERITE_REFERENCE_ORDER", "OrderId", "Order"),
        ForeignKey("FK_ORDERITE_REFERENCE_PRODUCT", "ProductId", "Product"),
    ),
    defaults={"UnitPrice": Decimal(0), "Quantity": 1},
)
TABLES = {spec.name: spec for spec in (CUSTOMER, SUPPLIER, PRODUCT, ORDER, ORDER_ITEM)}

# The audit log allows NULL wherever the product table does, so every row can be logged.
AUDIT = TableSpec(
    name="product_audit",
    schema=StructType(
        [
            _col("id", KEY, True),
            _col("productid", KEY, True),
            _col("productname", StringType(), True),
            _col("SupplierId", KEY, True),
            _col("UnitPrice", MONEY),
            _col("package", StringType()),
            _col("IsDiscontinued", BooleanType(), True),
            _col("updatedat", STAMP, True),
            _col("operation", StringType(), True),
        ]
    ),
    key="id",
    text_limits={"productname": 50, "package": 30, "operation": 3},
)
INSERTED, DELETED = "INS", "DEL"


def schema_drift(df: DataFrame, schema: StructType) -> list[str]:
    """Differences in name or type. Files do not keep NOT NULL, so it is not compared."""
    found = {f.name: f.dataType for f in df.schema.fields}
    wanted = {f.name: f.dataType for f in schema.fields}
    drift = [f"{name}: missing" for name in wanted if name not in found]
    drift += [f"{name}: not declared" for name in found if name not in wanted]
    drift += [
        f"{name}: {found[name].simpleString()} instead of {kind.simpleString()}"
        for name, kind in wanted.items()
        if name in found and found[name] != kind
    ]
    return drift


def require_schema(df: DataFrame, schema: StructType) -> DataFrame:
    drift = schema_drift(df, schema)
    if drift:
        raise ValueError("schema drift: " + "; ".join(drift))
    return df.select(*schema.names)


def default_column(value: object) -> Column:
    """A default as a column; a callable default, such as the current stamp, is called."""
    return value() if callable(value) else F.lit(value)


def complete_rows(
    rows: DataFrame, schema: StructType, defaults: dict[str, object] | None = None
) -> DataFrame:
    """Rows under ``schema``: a column left out takes its default, or NULL.

    A NULL that is given stays NULL: a default stands only for a column left out.
    """
    unknown = [name for name in rows.columns if name not in schema.names]
    if unknown:
        raise ValueError(f"columns not in the table: {unknown}")
    defaults = defaults or {}

    def column(f: StructField) -> Column:
        if f.name in rows.columns:
            return F.col(f.name).cast(f.dataType).alias(f.name)
        return default_column(defaults.get(f.name)).cast(f.dataType).alias(f.name)

    return rows.select(*[column(f) for f in schema.fields])
