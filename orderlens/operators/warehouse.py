"""Star schema: dimensions, fact lines, monthly summary."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.calendar import calendar_columns, date_key
from ..functions.codes import join_value
from ..functions.membership import mark_possible
from ..functions.money import cents, halves_away, line_total, money, total
from ..session import finished, stored

# The ship modes with usual days and cost tier; the key is the position.
SHIP_MODES = [
    ("Standard Class", 5, "Low"),
    ("Second Class", 3, "Medium"),
    ("First Class", 2, "High"),
    ("Same Day", 0, "Express"),
]

CUSTOMER_ATTRIBUTES = ["customer_name", "segment", "city", "state", "postal_code", "country", "region"]
PRODUCT_ATTRIBUTES = ["product_name", "category", "sub_category"]
LINE_KEY = ["order_id", "row_id"]
# What lines are dealt out by in stored tables: order and customer, or product and share, as one struct.
ORDER, PART = "_order", "_part"
PART_SHARES = 8  # shares of a product's lines, so that those of a hot one do not meet in one task

# Lines may carry their money as whole cents and their discount in 1/10000 beside the DECIMALs.
SALES_CENTS, PROFIT_CENTS, DISCOUNT_UNITS = "sales_cents", "profit_cents", "discount_units"
LATEST = ["order_date", "order_id", "row_id"]

# Key buckets. A new key takes the next free slot of its natural key's bucket, so keys are unique
# at any size without a sort over all rows; (slot - 1) * KEY_BUCKETS + bucket + 1 is the key.
KEY_BUCKETS = 65_536


def dim_ship_mode(spark: SparkSession) -> DataFrame:
    """The four ship modes."""
    rows = [(i, *mode) for i, mode in enumerate(SHIP_MODES, 1)]
    return spark.createDataFrame(rows, "ship_mode_sk bigint, ship_mode_name string, avg_days int, cost_tier string")


def typed_staging(clean: DataFrame) -> DataFrame:
    """Cleaned lines at the types of the star schema; a row id that is no number is null, so the line counts as new."""
    types = {
        "row_id": "int",
        "quantity": "int",
        "sales": "decimal(12,2)",
        "discount": "decimal(5,4)",
        "profit": "decimal(12,2)",
    }
    exact = {name: F.round(F.col(name).cast("decimal(24,8)"), 4) for name in ("sales", "discount", "profit")}
    whole = {name: F.round(F.col(name).try_cast("double")) for name in ("row_id", "quantity")}
    return clean.withColumns({name: (exact | whole)[name].cast(to) for name, to in types.items()})


def by_order(staging: DataFrame) -> DataFrame:
    """``staging`` with the column ``ORDER``. In a table dealt out by it, customers are counted and looked up per order."""
    return staging.withColumn(ORDER, F.struct("order_id", "customer_id"))


def latest_attributes(staging: DataFrame, key: str, attributes: list[str]) -> DataFrame:
    """``attributes`` of the last line of every ``key``.

    Runs when called: the last day is found by hash aggregation and stored. Lines that a filter of fixed size rules out
    for that day stay where they are; of the others, those of the day are put in order.
    """
    known = staging.where(F.col(key).isNotNull())
    last = stored(known.groupBy(key).agg(F.max("order_date").alias("_last_day")), "last_days")
    possible = mark_possible(
        known.select(key, *LATEST, *attributes).withColumn("_hash", F.xxhash64(key, "order_date")),
        last.select(F.xxhash64(key, "_last_day").alias("_hash")),
    ).where("_maybe").drop("_maybe")
    newest = possible.join(last, key).where(F.col("order_date").eqNullSafe(F.col("_last_day")))
    latest = newest.groupBy(key).agg(F.max_by(F.struct(*attributes), F.struct(*LATEST)).alias("_attributes"))
    return latest.select(key, *[F.col(f"_attributes.{a}").alias(a) for a in attributes])


def customer_history(lines: DataFrame, key: str, sales: str) -> DataFrame:
    """Sales, and first and last order id, of every customer in ``lines``."""
    if ORDER in lines.columns and key == "customer_id":
        orders = lines.groupBy(ORDER).agg(line_total(sales).alias("_sales")).select(f"{ORDER}.*", "_sales")
    else:
        orders = lines.groupBy(key, "order_id").agg(line_total(sales).alias("_sales"))
    return orders.groupBy(key).agg(
        total("_sales").alias("customer_ltv"), F.min("order_id").alias("first_order"), F.max("order_id").alias("last_order")
    )


def dim_customers(staging: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """One row per customer: latest attributes, lifetime sales, whether more than one order.

    With ``existing``, known customers keep their key; those absent from staging keep their row.
    """
    known = staging.where("customer_id IS NOT NULL")
    history = customer_history(known, "customer_id", "sales").select(
        "customer_id", "customer_ltv", (F.col("first_order") != F.col("last_order")).alias("is_repeat")
    )
    current = latest_attributes(known, "customer_id", CUSTOMER_ATTRIBUTES).join(history, "customer_id")
    return with_keys(current, "customer_id", "customer_sk", existing)


def dim_products(staging: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """One row per product with its latest attributes; no brand is known, all are active."""
    current = latest_attributes(staging, "product_id", PRODUCT_ATTRIBUTES).select(
        "*", F.lit(None).cast("string").alias("brand"), F.lit(True).alias("is_active")
    )
    return with_keys(current, "product_id", "product_sk", existing)


def customer_keys(staging: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """The key of every customer, known or new."""
    return with_keys(
        staging.select("customer_id").where("customer_id IS NOT NULL").distinct(), "customer_id", "customer_sk", existing
    )


def merge_customers(keys: DataFrame, staging: DataFrame, added: DataFrame, before: DataFrame | None) -> DataFrame:
    """dim_customers after a load, with each customer's first order id.

    ``keys`` are all keys, ``added`` the fact lines that ``before``, the dimension so far, does not count yet. Only
    these are read: sales are added, and a customer repeats once an order id differs from the first.
    """
    attributes = CUSTOMER_ATTRIBUTES
    now = latest_attributes(staging, "customer_id", attributes).select(
        "customer_id", F.struct(*attributes).alias("_now"), F.lit(True).alias("_present")
    )
    new = customer_history(added, "customer_sk", "gross_sales").withColumnRenamed("customer_ltv", "_new")
    if before is None:
        nothing = {a: F.lit(None).cast("string") for a in [*attributes, "first_order"]}
        nothing |= {"customer_ltv": F.lit(None).cast("decimal(20,2)"), "is_repeat": F.lit(False)}
        before = keys.where("false").withColumns(nothing)
    old = before.select(
        "customer_sk", F.struct(*attributes).alias("_old"), F.col("customer_ltv").alias("_ltv"),
        F.col("is_repeat").alias("_repeat"), F.col("first_order").alias("_first"), F.col("updated_at").alias("_updated"),
    )
    rows = keys.select("customer_id", "customer_sk", "created_at").join(now, "customer_id", "left")
    rows = rows.join(old, "customer_sk", "left").join(new, "customer_sk", "left")
    first = F.coalesce("_first", "first_order")
    shown = F.when(F.col("_present"), F.col("_now")).otherwise(F.col("_old"))
    zero = F.lit(0).cast("decimal(20,2)")
    return rows.withColumn("_shown", shown).select(
        "customer_sk", "customer_id", *[F.col(f"_shown.{a}").alias(a) for a in attributes],
        (F.coalesce("_ltv", zero) + F.coalesce("_new", zero)).cast("decimal(20,2)").alias("customer_ltv"),
        (F.coalesce("_repeat", F.lit(False)) | F.coalesce((F.col("first_order") != first) | (F.col("last_order") != first), F.lit(False)))
        .alias("is_repeat"),
        first.alias("first_order"), "created_at",
        F.when(F.col("_present"), F.current_timestamp()).otherwise(F.col("_updated")).alias("updated_at"),
    )


def derive_measures(exact: bool = False) -> list[Column]:
    """Measures of a fact line from sales, quantity, discount and profit, at the table's scales.

    They are computed in whole cents and ten-thousandths. ``exact`` takes these from the columns ``SALES_CENTS``,
    ``PROFIT_CENTS`` and ``DISCOUNT_UNITS`` instead of from the DECIMALs.
    """
    sales = F.col(SALES_CENTS) if exact else cents("sales")
    profit = F.col(PROFIT_CENTS) if exact else cents("profit")
    discount = F.col(DISCOUNT_UNITS) if exact else F.rint(F.col("discount").cast("double") * 10_000).cast("bigint")
    quantity = F.col("quantity").cast("int")
    per_unit = money(F.when(quantity > 0, halves_away(sales, F.greatest(quantity.cast("bigint"), F.lit(1)))).otherwise(sales))
    # profit * 10^6 / sales; the sign of sales goes to the numerator
    margin = F.when(sales != 0, halves_away(profit * F.signum(sales).cast("bigint") * 1_000_000, F.abs(sales))).otherwise(0)
    return [
        quantity.alias("quantity"),
        per_unit.cast("decimal(10,2)").alias("unit_price"),
        F.col("discount").cast("decimal(5,4)").alias("discount_rate"),
        F.col("sales").cast("decimal(12,2)").alias("gross_sales"),
        money(halves_away(sales * (10_000 - discount), F.lit(10_000))).alias("net_sales"),
        money(sales - profit).alias("cogs"),
        F.col("profit").cast("decimal(12,2)").alias("profit"),
        (margin.cast("decimal(14,0)") * F.lit(Decimal("0.0001"))).cast("decimal(7,4)").alias("profit_margin_pct"),
        per_unit.cast("decimal(10,2)").alias("revenue_per_unit"),
    ]


def derive_fact(staging: DataFrame) -> DataFrame:
    """Fact lines still under their natural keys."""
    return staging.select(
        date_key("order_date").alias("order_date_sk"),
        date_key("ship_date").alias("ship_date_sk"),
        "customer_id",
        "product_id",
        "ship_mode",
        "order_id",
        "row_id",
        *derive_measures(),
        F.date_diff("ship_date", "order_date").alias("shipping_days"),
    )


def fact_source(staging: DataFrame) -> DataFrame:
    """The columns of staging that a fact line is made of."""
    return staging.select(
        *LINE_KEY, "order_date", "ship_date", "customer_id", "product_id", "ship_mode", "sales", "quantity", "discount", "profit",
        *[c for c in staging.columns if c == ORDER],
    )


def fact_lines(source: DataFrame, customers: DataFrame, products: DataFrame, ship_modes: DataFrame,
               by_month: bool = False) -> DataFrame:
    """``lookup_keys`` of ``derive_fact``, with the measures derived after the joins, so that these shuffle fewer columns.

    ``by_month`` rebalances the lines by order month before the measures are derived, for ``write_fact``.
    """
    keyed = lookup_keys(source, customers, products, ship_modes)
    if by_month:
        keyed = keyed.withColumn("_month", F.floor(date_key("order_date") / 100).cast("int")).hint("rebalance", F.col("_month"))
    return keyed.select(
        date_key("order_date").alias("order_date_sk"),
        date_key("ship_date").alias("ship_date_sk"),
        *LINE_KEY,
        *derive_measures(),
        F.date_diff("ship_date", "order_date").alias("shipping_days"),
        "ship_mode_sk",
        "customer_sk",
        "product_sk",
    )


def lookup_keys(derived: DataFrame, customers: DataFrame, products: DataFrame, ship_modes: DataFrame) -> DataFrame:
    """Replace natural keys by dimension keys; lines with an unknown member drop out.

    Lines with the column ``ORDER``, from a table dealt out by it, are not shuffled by customer or product, but the
    different orders and shares of products are. That runs when called: lines with their customer's key are stored.
    """
    by_mode = derived.join(_ship_mode_keys(ship_modes), "ship_mode")
    if ORDER in derived.columns:
        def keyed() -> DataFrame:
            share = F.pmod(F.xxhash64(*LINE_KEY), F.lit(PART_SHARES)).cast("int")
            lines = _keyed(by_mode, ORDER, customers.select("customer_id", "customer_sk")).drop("customer_id", "ship_mode", ORDER)
            return lines.withColumn(PART, F.struct("product_id", share.alias("_share")))

        lines = finished(derived.sparkSession, "keyed_lines", keyed, PART)
        return _keyed(lines, PART, products.select("product_id", "product_sk")).drop("product_id", PART)
    return (
        by_mode.join(customers.select("customer_id", "customer_sk"), "customer_id")
        .join(products.select("product_id", "product_sk"), "product_id")
        .drop("customer_id", "product_id", "ship_mode")
    )


def _keyed(lines: DataFrame, by: str, keys: DataFrame) -> DataFrame:
    """``lines`` with the key of the member in the struct ``by``, found once for each of its values."""
    member, key = keys.columns
    groups = lines.select(by).distinct()
    return lines.join(groups.join(keys, F.col(f"{by}.{member}") == F.col(member)).select(by, key), by)


def rejected_lines(
    staging: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    ship_modes: DataFrame,
    dates: DataFrame | None = None,
) -> DataFrame:
    """Lines that a load drops, once per missing member, in one pass over the lines.

    With ``dates``, the calendar of a load with a fixed range, also the days it lacks.
    """
    members = {
        "ship_mode": _ship_mode_keys(ship_modes).select("ship_mode"),
        "customer_id": customers.select("customer_id"),
        "product_id": products.select("product_id"),
    }
    if dates is not None:
        members |= {day: dates.select(F.col("full_date").alias(day)) for day in ("order_date", "ship_date")}
    lines = staging.select(*LINE_KEY, *members)
    for key, known in members.items():
        marked = known.withColumn(f"_has_{key}", F.lit(True))
        lines = lines.join(F.broadcast(marked) if key == "ship_mode" else marked, key, "left")
    lost = [
        F.when(F.col(f"_has_{key}").isNull(), F.struct(F.lit(key).alias("missing"), F.col(key).cast("string").alias("value")))
        for key in members
    ]
    return lines.select(*LINE_KEY, F.inline(F.filter(F.array(*lost), lambda x: x.isNotNull())))


def new_lines(batch: DataFrame, fact: DataFrame) -> DataFrame:
    """Lines of ``batch`` whose (order_id, row_id) the fact table lacks; a null row_id is always new."""
    loaded = fact.select(*LINE_KEY)
    return batch.join(loaded, LINE_KEY, "left_anti")


def monthly_sales(fact: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Orders, units, revenue, profit and mean margin per month, category and region.

    Sums are added up in BIGINT, as cents and as ten-thousandths of a percent. Categories and regions are looked up by
    ``join_value``, which runs when called.
    """
    margin_units = F.rint(F.col("profit_margin_pct").cast("double") * 10_000).cast("bigint")
    margins = F.sum(margin_units).cast("decimal(19,0)") * F.lit(Decimal("0.0001"))
    month = F.floor(F.col("order_date_sk") / 100).cast("int").alias("_month")
    lines = fact.select(
        month, "order_id", "product_sk", "customer_sk", "quantity", "gross_sales", "net_sales", "profit", "profit_margin_pct"
    )
    per_month = (
        lines.transform(join_value, products, "product_sk", "category")
        .transform(join_value, customers, "customer_sk", "region")
        .groupBy("_month", "category", "region")
        .agg(
            # Under a filter Spark adds up the sums apart from the orders, so that these are shuffled without them.
            F.expr("count(DISTINCT order_id) FILTER (WHERE order_id IS NOT NULL)").alias("total_orders"),
            F.sum("quantity").alias("total_quantity"),
            line_total("gross_sales").cast("decimal(14,2)").alias("gross_revenue"),
            line_total("net_sales").cast("decimal(14,2)").alias("net_revenue"),
            line_total("profit").cast("decimal(14,2)").alias("total_profit"),
            F.round(margins.cast("decimal(17,4)") / F.count("profit_margin_pct"), 4)
            .cast("decimal(7,4)")
            .alias("avg_profit_margin"),
        )
        .withColumn("_day", F.col("_month") * 100 + 1)
    )
    when = calendar_columns("_day", "year", "month_num", "month_name")
    return per_month.select(*when, *[c for c in per_month.columns if c not in ("_month", "_day")])


def _ship_mode_keys(ship_modes: DataFrame) -> DataFrame:
    # Four rows.
    return F.broadcast(ship_modes.select(F.col("ship_mode_name").alias("ship_mode"), "ship_mode_sk"))


def with_keys(current: DataFrame, natural_key: str, key: str, existing: DataFrame | None) -> DataFrame:
    """Add the dimension key and audit times; known members keep their key and time of creation."""
    bucket = F.pmod(F.xxhash64(natural_key), F.lit(KEY_BUCKETS)).cast("int")
    slot = F.row_number().over(Window.partitionBy("_bucket").orderBy(natural_key))
    number = (F.col("_slot") - 1) * F.lit(KEY_BUCKETS).cast("bigint") + F.col("_bucket") + 1
    columns = [key, *current.columns, "created_at", "updated_at"]
    now = F.current_timestamp()
    current = current.withColumn("updated_at", now)
    if existing is None:
        keyed = current.withColumn("_bucket", bucket).withColumn("_slot", slot)
        return keyed.withColumn(key, number).withColumn("created_at", now).select(*columns)

    known = existing.select(natural_key, key, "created_at")
    updated = current.join(known, natural_key)
    absent = existing.join(current.select(natural_key), natural_key, "left_anti")
    taken = (  # one row per bucket
        known.groupBy(((F.col(key) - 1) % KEY_BUCKETS).cast("int").alias("_bucket"))
        .agg((F.floor((F.max(key) - 1) / KEY_BUCKETS) + 1).alias("_taken"))
    )
    added = (
        current.join(known, natural_key, "left_anti")
        .withColumn("_bucket", bucket)
        .join(F.broadcast(taken), "_bucket", "left")
        .withColumn("_slot", slot + F.coalesce("_taken", F.lit(0)))
        .withColumn(key, number)
        .withColumn("created_at", now)
    )
    return (
        updated.select(*columns)
        .unionByName(absent.select(*columns))
        .unionByName(added.select(*columns))
    )
