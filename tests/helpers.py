"""Hand-made order lines."""

from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

STAGING = (
    "row_id int, order_id string, order_date date, ship_date date, ship_mode string, customer_id string, "
    "customer_name string, segment string, country string, city string, state string, postal_code string, "
    "region string, product_id string, category string, sub_category string, product_name string, "
    "sales decimal(12,2), quantity int, discount decimal(5,4), profit decimal(12,2)"
)

DEFAULTS = {
    "row_id": 1, "order_id": "O1", "order_date": date(2020, 1, 15), "ship_date": date(2020, 1, 18),
    "ship_mode": "Second Class", "customer_id": "C1", "customer_name": "Ann", "segment": "Consumer",
    "country": "United States", "city": "X", "state": "Ohio", "postal_code": "1", "region": "East",
    "product_id": "P1", "category": "Furniture", "sub_category": "Chairs", "product_name": "chair",
    "sales": Decimal("100.00"), "quantity": 2, "discount": Decimal("0"), "profit": Decimal("10.00"),
}


def line(**changes):
    changes = {
        k: Decimal(str(v)) if k in ("sales", "discount", "profit") and v is not None else v for k, v in changes.items()
    }
    return {**DEFAULTS, **changes}


def staging(spark, *lines):
    names = [part.split()[0] for part in STAGING.split(", ")]
    return spark.createDataFrame([tuple(row[n] for n in names) for row in lines], STAGING)


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def fact(spark, *lines):
    """A fact table whose keys are the natural keys' hashes, with its dimensions."""
    from orderlens.functions.calendar import date_key, day_range, warehouse_calendar
    from orderlens.operators import warehouse as w
    from orderlens.sources.files import Star

    df = staging(spark, *lines)
    customers, products = w.dim_customers(df), w.dim_products(df)
    modes = w.dim_ship_mode(spark)
    table = w.lookup_keys(w.derive_fact(df), customers, products, modes)
    assert date_key and F
    return Star(table, customers, products, warehouse_calendar(day_range(spark)), modes)
