"""Derived columns of cleaned order lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.money import amount, percent
from ..functions.ranking import CELL, exact_percentiles, grouped_row_number, with_cell
from ..schemas import FEATURE_COLUMNS

MONTH = ["order_year", "order_month"]


def _exact(name: str) -> Column:
    return F.col(name).cast("decimal(18,6)")


def date_parts(df: DataFrame) -> DataFrame:
    """Year, month, quarter, ISO week and English weekday of the order date."""
    day = F.col("order_date")
    return df.withColumns(
        {
            "order_year": F.year(day),
            "order_month": F.month(day),
            "order_quarter": F.quarter(day),
            "order_week": F.weekofyear(day),
            "order_dow": F.date_format(day, "EEEE"),
        }
    )


def shipping_days(df: DataFrame) -> DataFrame:
    """Days from order to shipment."""
    return df.withColumn("shipping_days", F.date_diff("ship_date", "order_date"))


def profit_margin_pct(df: DataFrame) -> DataFrame:
    """Profit in percent of sales, 0 without sales."""
    margin = percent(_exact("profit"), _exact("sales"))
    return df.withColumn("profit_margin_pct", F.when(_exact("sales") != 0, margin).otherwise(0.0))


def discounted_revenue(df: DataFrame) -> DataFrame:
    """Sales after discount."""
    net = F.round(_exact("sales") * (1 - F.col("discount").cast("decimal(10,6)")), 2)
    return df.withColumn("discounted_revenue", net.cast("decimal(12,2)"))


def cogs(df: DataFrame) -> DataFrame:
    """Implied cost of goods: sales less profit."""
    return df.withColumn("cogs", F.round(_exact("sales") - _exact("profit"), 2).cast("decimal(12,2)"))


def customer_ltv(df: DataFrame) -> DataFrame:
    """Total sales of the line's customer.

    An aggregate joined back, not a window: a customer with very many lines is summed before the
    shuffle, and the join may split it.
    """
    totals = (
        df.where("customer_id IS NOT NULL")
        .groupBy("customer_id")
        .agg(_ltv(F.sum(_exact("sales"))).alias("customer_ltv"))
    )
    return df.join(totals, "customer_id", "left").select(*df.columns, "customer_ltv")


def _ltv(sales: Column) -> Column:
    return F.round(sales, 2).cast("decimal(14,2)")


def by_customer_day(df: DataFrame) -> DataFrame:
    """``df`` with the column that ``customer_order_rank`` deals out lines by; ``enrich_sales`` drops it."""
    return with_cell(df, ["customer_id"], "order_date")


def customer_order_rank(df: DataFrame, with_ltv: bool = False) -> DataFrame:
    """Number of the line among its customer's, by order date, then order and row.

    A customer's lines are spread by day. ``with_ltv`` also adds ``customer_ltv``, by the same shuffle of the lines.
    """
    ranked = grouped_row_number(
        df, ["customer_id"], ["order_date", "order_id", "row_id"], "customer_order_rank", spread_by="order_date",
        totals={"_total": _exact("sales")} if with_ltv else None,
    )
    if not with_ltv:
        return ranked
    ltv = F.when(F.col("customer_id").isNotNull(), _ltv(F.col("_total")))
    return ranked.withColumn("customer_ltv", ltv).drop("_total")


def is_repeat_customer(df: DataFrame) -> DataFrame:
    """1 on every line after the customer's first."""
    return df.withColumn("is_repeat_customer", (F.col("customer_order_rank") > 1).cast("int"))


def monthly_sales_growth(df: DataFrame) -> DataFrame:
    """Sales per month and change on the previous month that has any; 0 for the first and after zero sales."""
    monthly = df.groupBy(*MONTH).agg(F.sum(_exact("sales")).cast("decimal(20,4)").alias("monthly_total"))
    previous = F.lag("monthly_total").over(Window.orderBy(*MONTH))
    change = percent(F.col("monthly_total") - F.col("_previous"), "_previous")
    return (
        monthly.withColumn("_previous", previous)
        .withColumn("sales_growth_pct", F.coalesce(change, F.lit(0.0)))
        .drop("_previous")
    )


def attach_monthly_growth(df: DataFrame) -> DataFrame:
    """The month's growth on every line."""
    growth = monthly_sales_growth(df).select(*MONTH, "sales_growth_pct")
    # One row per calendar month, so always small.
    return df.join(F.broadcast(growth), MONTH, "left").select(*df.columns, "sales_growth_pct")


def revenue_per_unit(df: DataFrame) -> DataFrame:
    """Sales per unit; no units count as one."""
    units = F.col("quantity").cast("decimal(12,2)")
    units = F.when(units == 0, F.lit(1).cast("decimal(12,2)")).otherwise(units)
    return df.withColumn("revenue_per_unit", amount(_exact("sales") / units))


def is_high_value_order(
    df: DataFrame, fraction: float = 0.75, approximate: bool = False, accuracy: int = 10_000
) -> DataFrame:
    """1 on lines with sales above the given percentile of all lines.

    The percentile is exact; ``approximate`` takes Spark's sketch of the given accuracy instead.
    """
    if approximate:
        found = df.agg(F.percentile_approx("sales", fraction, accuracy).cast("double").alias("threshold"))
    else:
        found = exact_percentiles(df, {"threshold": ("sales", fraction)})
    threshold = found.first()["threshold"]
    above = F.col("sales").cast("double") > F.lit(threshold).cast("double")
    return df.withColumn("is_high_value_order", above.cast("int"))


def is_loss_order(df: DataFrame) -> DataFrame:
    """1 on lines with negative profit."""
    return df.withColumn("is_loss_order", (F.col("profit") < 0).cast("int"))


def sorted_output(df: DataFrame) -> DataFrame:
    """Lines in order of customer and date; a customer with very many lines spans several partitions."""
    order = ["customer_id", "order_date", "order_id", "row_id"]
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def enrich_sales(df: DataFrame) -> DataFrame:
    """All derived columns. The months are summed up before the rank, so that these sums need no ranked lines."""
    return (
        df.transform(is_high_value_order)
        .transform(date_parts)
        .transform(attach_monthly_growth)
        .transform(lambda lines: customer_order_rank(lines, with_ltv=True))
        .transform(shipping_days)
        .transform(profit_margin_pct)
        .transform(discounted_revenue)
        .transform(cogs)
        .transform(is_repeat_customer)
        .transform(revenue_per_unit)
        .transform(is_loss_order)
        .select(*[c for c in df.columns if c != CELL], *FEATURE_COLUMNS)
    )
