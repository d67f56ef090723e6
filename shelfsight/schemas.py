"""Declared schemas of the input tables, so that no reader has to infer one."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


TRANSACTIONS = _struct(
    posting_date=T.DateType(),
    description=T.StringType(),
    item_code=T.StringType(),
    distributor_item_code=T.StringType(),
    distributor=T.StringType(),
    sales_rep=T.StringType(),
    canonical_code=T.StringType(),
    base_card_code=T.StringType(),
    ship_to_code=T.StringType(),
    quantity=MONEY,
    revenue=MONEY,
    amount=MONEY,
    transaction_hash=T.StringType(),
)

LAUNCH_LIST = _struct(product_label=T.StringType(), upc_dashed=T.StringType())

INVOICE_LINES = _struct(
    doc_date=T.DateType(),
    item_code=T.StringType(),
    item_name=T.StringType(),
    quantity=MONEY,
    line_total=MONEY,
    cogs=MONEY,
)

CATALOG = _struct(
    part_number=T.StringType(),
    upc_code=T.StringType(),
    item_code=T.StringType(),
    line_no=T.LongType(),
)

FORECAST_VS_ACTUAL = _struct(
    item=T.StringType(),
    month=T.DateType(),
    description=T.StringType(),
    forecast_qty=T.DoubleType(),
    actual_qty=T.DoubleType(),
    variance=T.DoubleType(),
    variance_pct=T.DoubleType(),
    accuracy=T.DoubleType(),
)

INVENTORY_SNAPSHOT = _struct(
    month=T.DateType(),
    sku=T.StringType(),
    product_name=T.StringType(),
    qty_available=T.LongType(),
    velocity_monthly=T.DoubleType(),
    weeks_of_supply=T.DoubleType(),
    at_risk=T.BooleanType(),
    risk_label=T.StringType(),
)

# Field names inside the nested inventory document.
INVENTORY_PRODUCT = _struct(
    sku=T.StringType(),
    productName=T.StringType(),
    qtyAvailable=T.LongType(),
    velocityMonthly=T.DoubleType(),
    weeksOfSupply=T.DoubleType(),
    atRisk=T.BooleanType(),
    riskLabel=T.StringType(),
)

INVENTORY_DOCUMENT = T.StructType(
    [
        T.StructField(
            "months",
            T.MapType(
                T.StringType(),
                T.StructType([T.StructField("products", T.ArrayType(INVENTORY_PRODUCT))]),
            ),
        )
    ]
)
