"""Business questions over the star schema, on net sales.

Money is summed as DECIMAL and rounded once. Where two different distinct counts meet, lines are
first summed per customer and order, so that Spark expands orders and not lines.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import calendar_columns, date_of_key
from ..functions.labels import clv_tier, discount_band, rfm_segment
from ..functions.money import TOTAL, amount, growth, line_total, mean, percent, ratio, total
from ..functions.ranking import global_ntile
from ..sources.files import Star

PRODUCT = ["product_name", "category", "sub_category"]


def _with_dates(star: Star, *columns: str) -> DataFrame:
    return star.fact.select("*", *calendar_columns("order_date_sk", *columns))


def _with_products(star: Star, lines: DataFrame) -> DataFrame:
    return lines.join(star.products.select("product_sk", *PRODUCT), "product_sk")


def _order_totals(star: Star) -> DataFrame:
    """Revenue and profit per customer and order."""
    return star.fact.groupBy("customer_sk", "order_id").agg(
        line_total("net_sales").alias("net_sales"), line_total("profit").alias("profit")
    )


def _money() -> list[Column]:
    return [amount(line_total("net_sales")).alias("net_revenue"), amount(line_total("profit")).alias("total_profit")]


def monthly_trend(star: Star) -> DataFrame:
    """Orders, units, revenue, profit and mean line margin per calendar month."""
    return (
        _with_dates(star, "year", "month_num", "month_name")
        .groupBy("year", "month_num", "month_name")
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            F.sum("quantity").alias("units_sold"),
            *_money(),
            mean("profit_margin_pct").alias("avg_margin_pct"),
        )
        .orderBy("year", "month_num")
    )


def top_products(star: Star, n: int = 10) -> DataFrame:
    """The ``n`` product names with the highest revenue; equal revenue goes by name."""
    per_product = star.fact.groupBy("product_sk").agg(
        line_total("net_sales").alias("net_sales"),
        line_total("profit").alias("profit"),
        F.sum("profit_margin_pct").alias("margins"),
        F.count("profit_margin_pct").alias("lines"),
        F.sum("quantity").alias("quantity"),
    )
    return (
        _with_products(star, per_product)
        .groupBy(*PRODUCT)
        .agg(
            amount(total("net_sales")).alias("total_revenue"),
            amount(total("profit")).alias("total_profit"),
            ratio(F.sum("margins").cast("decimal(22,4)"), F.sum("lines")).alias("avg_margin_pct"),
            F.sum("quantity").alias("units_sold"),
        )
        .orderBy(F.desc("total_revenue"), *PRODUCT)
        .limit(n)
    )


def region_performance(star: Star) -> DataFrame:
    """Orders, customers, revenue, profit, blended margin and order value per region."""
    return (
        _order_totals(star)
        .join(star.customers.select("customer_sk", "region"), "customer_sk")
        .groupBy("region")
        .agg(
            F.count_distinct("order_id").alias("orders"),
            F.count_distinct("customer_sk").alias("unique_customers"),
            line_total("net_sales").alias("_net"),
            line_total("profit").alias("_profit"),
        )
        .select(
            "region",
            "orders",
            "unique_customers",
            amount("_net").alias("net_revenue"),
            amount("_profit").alias("total_profit"),
            percent("_profit", "_net").alias("profit_margin_pct"),
            ratio("_net", "orders").alias("avg_order_value"),
        )
        .orderBy(F.desc("net_revenue"), "region")
    )


def category_margin(star: Star) -> DataFrame:
    """Revenue, profit, cost, mean and blended margin, orders per category and sub-category."""
    return (
        _with_products(star, star.fact)
        .groupBy("category", "sub_category")
        .agg(
            *_money(),
            amount(line_total("cogs")).alias("total_cogs"),
            mean("profit_margin_pct").alias("avg_margin_pct"),
            percent(line_total("profit"), line_total("net_sales")).alias("blended_margin_pct"),
            F.count_distinct("order_id").alias("order_count"),
        )
        .orderBy("category", F.desc("blended_margin_pct"), "sub_category")
    )


def repeat_rate(star: Star) -> DataFrame:
    """Customers with more than one order, and those with one."""
    customers = star.fact.groupBy("customer_sk").agg(F.count_distinct("order_id").alias("order_count"))
    return (
        customers.groupBy(F.when(F.col("order_count") > 1, "Repeat").otherwise("One-Time").alias("customer_type"))
        .agg(
            F.count("*").alias("customer_count"),
            ratio(F.sum("order_count").cast("decimal(18,0)"), F.count("*")).alias("avg_orders_per_customer"),
        )
        .withColumn("_all", F.sum("customer_count").over(Window.partitionBy()))  # two rows
        .select(
            "customer_type",
            "customer_count",
            percent(F.col("customer_count").cast("decimal(18,0)"), "_all").alias("pct_of_total"),
            "avg_orders_per_customer",
        )
        .orderBy(F.desc("customer_count"), "customer_type")
    )


def yoy_growth(star: Star) -> DataFrame:
    """Revenue and profit per year with the change on the year before."""
    yearly = (
        _with_dates(star, "year").groupBy("year").agg(line_total("net_sales").alias("_net"), line_total("profit").alias("_profit"))
    )
    by_year = Window.orderBy("year")  # a handful of rows
    return (
        yearly.withColumn("_net_before", F.lag("_net").over(by_year))
        .withColumn("_profit_before", F.lag("_profit").over(by_year))
        .select(
            "year",
            amount("_net").alias("net_revenue"),
            amount("_profit").alias("total_profit"),
            amount("_net_before").alias("prev_year_revenue"),
            percent(F.col("_net") - F.col("_net_before"), "_net_before").alias("yoy_revenue_growth_pct"),
            growth("_profit", "_profit_before").alias("yoy_profit_growth_pct"),
        )
        .orderBy("year")
    )


def aov_segment_region(star: Star) -> DataFrame:
    """Orders, revenue and order value per segment and region."""
    return (
        _order_totals(star)
        .join(star.customers.select("customer_sk", "segment", "region"), "customer_sk")
        .groupBy("segment", "region")
        .agg(F.count_distinct("order_id").alias("total_orders"), total("net_sales").alias("_net"))
        .select(
            "segment",
            "region",
            "total_orders",
            amount("_net").alias("net_revenue"),
            ratio("_net", "total_orders").alias("avg_order_value"),
        )
        .orderBy("segment", F.desc("avg_order_value"), "region")
    )


def rfm_customers(star: Star, as_of: date, scoring: str = "as_written") -> DataFrame:
    """Recency, frequency and monetary score (1 to 5) and segment of every customer.

    ``as_written`` gives score 1 to the most recent, most frequent and highest-spending fifth, and
    the segment rules then read it as the lowest. ``standard`` gives that fifth score 5.
    Ties go by customer id.
    """
    if scoring not in ("as_written", "standard"):
        raise ValueError(f"unknown scoring: {scoring}")
    raw = (
        star.fact.groupBy("customer_sk")
        .agg(
            F.max("order_date_sk").alias("_last"),
            F.count_distinct("order_id").alias("frequency"),
            line_total("net_sales").alias("monetary"),
        )
        .join(star.customers, "customer_sk")
        .withColumn("last_order_date", date_of_key("_last"))
        .withColumn("recency_days", F.date_diff(F.lit(as_of), "last_order_date"))
        .select("customer_id", "customer_name", "segment", "region", "last_order_date", "recency_days",
                "frequency", "monetary")
    )
    best_first = scoring == "as_written"
    recent = F.asc if best_first else F.desc
    large = F.desc if best_first else F.asc
    key = F.asc("customer_id")
    scored = global_ntile(raw, 5, [recent("recency_days"), key], "r_score")
    scored = global_ntile(scored, 5, [large("frequency"), key], "f_score")
    scored = global_ntile(scored, 5, [large("monetary"), key], "m_score")
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    return scored.withColumn("rfm_total", r + f + m).withColumn("rfm_segment", rfm_segment(r, f, m))


def rfm_segments(star: Star, as_of: date, scoring: str = "as_written") -> DataFrame:
    """Customers, averages and revenue per RFM segment."""
    return (
        rfm_customers(star, as_of, scoring)
        .groupBy("rfm_segment")
        .agg(
            F.count("*").alias("customer_count"),
            ratio(F.sum("recency_days").cast("decimal(18,0)"), F.count("*"), 0).alias("avg_recency_days"),
            ratio(F.sum("frequency").cast("decimal(18,0)"), F.count("*"), 1).alias("avg_frequency"),
            ratio(total("monetary"), F.count("*")).alias("avg_monetary"),
            amount(total("monetary")).alias("total_segment_revenue"),
        )
        .orderBy(F.desc("total_segment_revenue"), "rfm_segment")
    )


def top_loss_products(star: Star, n: int = 10) -> DataFrame:
    """The ``n`` product names that lose most on their loss-making lines."""
    return (
        _with_products(star, star.fact.where("profit < 0"))
        .groupBy(*PRODUCT)
        .agg(
            F.count_distinct("order_id").alias("order_count"),
            *_money(),
            percent(F.sum("discount_rate"), F.count("discount_rate"), 1).alias("avg_discount_pct"),
        )
        .orderBy("total_profit", *PRODUCT)
        .limit(n)
    )


def discount_bands(star: Star, bands: str = "as_written") -> DataFrame:
    """Lines, revenue, profit, margin and losses per discount band, lowest discount first."""
    return (
        star.fact.groupBy(discount_band(F.col("discount_rate"), bands).alias("discount_band"))
        .agg(
            F.count("*").alias("order_lines"),
            *_money(),
            mean("profit_margin_pct").alias("avg_margin_pct"),
            F.count_if(F.col("profit") < 0).alias("loss_orders"),
            F.min("discount_rate").alias("_lowest"),
        )
        .orderBy("_lowest")
        .drop("_lowest")
    )


def ship_mode_performance(star: Star) -> DataFrame:
    """Orders, shipping days, revenue, profit and margin per ship mode."""
    return (
        star.fact.join(star.ship_modes.select("ship_mode_sk", "ship_mode_name"), "ship_mode_sk")
        .groupBy("ship_mode_name")
        .agg(
            F.count_distinct("order_id").alias("orders"),
            ratio(F.sum("shipping_days").cast("decimal(18,0)"), F.count("shipping_days"), 1).alias("avg_shipping_days"),
            *_money(),
            mean("profit_margin_pct").alias("avg_margin_pct"),
        )
        .orderBy(F.desc("net_revenue"), "ship_mode_name")
    )


def state_heatmap(star: Star) -> DataFrame:
    """Customers, orders, revenue, profit and margin per state."""
    return (
        _order_totals(star)
        .join(star.customers.select("customer_sk", "state", "region"), "customer_sk")
        .groupBy("state", "region")
        .agg(
            F.count_distinct("customer_sk").alias("customers"),
            F.count_distinct("order_id").alias("orders"),
            *_money(),
            percent(line_total("profit"), line_total("net_sales")).alias("margin_pct"),
        )
        .orderBy(F.desc("net_revenue"), "state")
    )


def clv_tiers(star: Star, **tiers) -> DataFrame:
    """Customers and lifetime value per tier and segment, highest tier first."""
    value = F.col("lifetime_value")
    return (
        star.fact.groupBy("customer_sk")
        .agg(line_total("net_sales").alias("lifetime_value"))
        .join(star.customers.select("customer_sk", "segment"), "customer_sk")
        .groupBy(clv_tier(value, **tiers).alias("clv_tier"), "segment")
        .agg(
            F.count("*").alias("customer_count"),
            mean(value).alias("avg_ltv"),
            amount(total(value)).alias("total_ltv"),
            F.min(value).alias("_lowest"),
        )
        .orderBy(F.desc("_lowest"), "segment")
        .drop("_lowest")
    )


def qoq_growth(star: Star) -> DataFrame:
    """Revenue per quarter and category with the change on the category's previous quarter that has any."""
    quarters = (
        _with_dates(star, "year", "quarter")
        .groupBy("year", "quarter", "product_sk")
        .agg(line_total("net_sales").alias("_net"))
        .join(star.products.select("product_sk", "category"), "product_sk")
        .groupBy("year", "quarter", "category")
        .agg(F.sum("_net").cast(TOTAL).alias("_net"))
    )
    previous = F.lag("_net").over(Window.partitionBy("category").orderBy("year", "quarter"))
    return (
        quarters.withColumn("_before", previous)
        .select(
            "year",
            "quarter",
            "category",
            amount("_net").alias("net_revenue"),
            amount("_before").alias("prev_qtr_revenue"),
            percent(F.col("_net") - F.col("_before"), "_before").alias("qoq_growth_pct"),
        )
        .orderBy("category", "year", "quarter")
    )


def rolling_daily(star: Star, days: int = 7, frame: str = "rows") -> DataFrame:
    """Revenue and profit per day, trailing mean revenue and month to date.

    The trailing frame counts days with sales (``rows``) or calendar days (``calendar``).
    """
    daily = _with_dates(star, "full_date").groupBy("full_date").agg(
        line_total("net_sales").alias("_net"), line_total("profit").alias("_profit")
    )
    if frame == "rows":  # one row per calendar day, so a few thousand at most
        trailing = Window.orderBy("full_date").rowsBetween(1 - days, 0)
    elif frame == "calendar":
        trailing = Window.orderBy(F.unix_date("full_date")).rangeBetween(1 - days, 0)
    else:
        raise ValueError(f"unknown frame: {frame}")
    month = Window.partitionBy(F.trunc("full_date", "month")).orderBy("full_date")
    return daily.select(
        "full_date",
        amount("_net").alias("daily_revenue"),
        amount("_profit").alias("daily_profit"),
        ratio(F.sum("_net").over(trailing).cast("decimal(20,2)"), F.count("_net").over(trailing)).alias(
            "rolling_7d_revenue"
        ),
        amount(F.sum("_net").over(month)).alias("mtd_revenue"),
    ).orderBy("full_date")


def kpi_snapshot(star: Star) -> DataFrame:
    """One row of headline figures."""
    orders = star.fact.groupBy("customer_sk", "order_id").agg(
        line_total("net_sales").alias("net_sales"), line_total("profit").alias("profit"), F.sum("quantity").alias("quantity")
    )
    return orders.agg(
        total("net_sales").alias("_net"),
        total("profit").alias("_profit"),
        F.count_distinct("order_id").alias("total_orders"),
        F.sum("quantity").alias("total_units_sold"),
        F.count_distinct("customer_sk").alias("total_customers"),
    ).select(
        amount("_net").alias("total_net_revenue"),
        amount("_profit").alias("total_profit"),
        percent("_profit", "_net").alias("overall_margin_pct"),
        "total_orders",
        "total_units_sold",
        ratio("_net", "total_orders").alias("avg_order_value"),
        "total_customers",
    )
