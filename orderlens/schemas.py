"""Column lists and schemas of the order-line data."""

from __future__ import annotations

# The columns of a raw order line, before and after the names are normalised.
RAW_HEADER = [
    "Row ID", "Order ID", "Order Date", "Ship Date", "Ship Mode", "Customer ID", "Customer Name",
    "Segment", "Country", "City", "State", "Postal Code", "Region", "Product ID", "Category",
    "Sub-Category", "Product Name", "Sales", "Quantity", "Discount", "Profit",
]
LINE_COLUMNS = [
    "row_id", "order_id", "order_date", "ship_date", "ship_mode", "customer_id", "customer_name",
    "segment", "country", "city", "state", "postal_code", "region", "product_id", "category",
    "sub_category", "product_name", "sales", "quantity", "discount", "profit",
]
DATE_COLUMNS = ["order_date", "ship_date"]
MEASURES = ["sales", "quantity", "discount", "profit"]
NUMERIC_IDS = ["row_id", "postal_code"]  # numbers in the source, so cleaned as numbers
WHOLE_COLUMNS = ["row_id", "quantity"]

# The columns that enrichment adds.
FEATURE_COLUMNS = [
    "order_year", "order_month", "order_quarter", "order_week", "order_dow", "shipping_days",
    "profit_margin_pct", "discounted_revenue", "cogs", "customer_ltv", "customer_order_rank",
    "is_repeat_customer", "sales_growth_pct", "revenue_per_unit", "is_high_value_order", "is_loss_order",
]

# Schemas as DDL, for readers.
_CLEAN_TYPES = {
    **dict.fromkeys(DATE_COLUMNS, "date"), **dict.fromkeys(MEASURES, "double"), **dict.fromkeys(WHOLE_COLUMNS, "int")
}
CLEAN_SCHEMA = ", ".join(f"{name} {_CLEAN_TYPES.get(name, 'string')}" for name in LINE_COLUMNS)
_FEATURE_TYPES = {
    "order_dow": "string",
    "discounted_revenue": "decimal(12,2)",
    "cogs": "decimal(12,2)",
    "customer_ltv": "decimal(14,2)",
    "profit_margin_pct": "double",
    "sales_growth_pct": "double",
    "revenue_per_unit": "double",
}
ENRICHED_SCHEMA = ", ".join(
    [CLEAN_SCHEMA, *(f"{name} {_FEATURE_TYPES.get(name, 'int')}" for name in FEATURE_COLUMNS)]
)
FORECAST_SCHEMA = "forecast_month date, predicted_sales double, lower_bound double, upper_bound double"

CORRUPT = "_corrupt_record"  # the text of a row that cannot be read
