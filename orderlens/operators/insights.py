"""Headline findings: repeat buyers, losses under discount, season, best and worst."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.money import line_total, mean, percent, ratio, total
from ..sources.files import Star


def segment_repeat_ltv(df: DataFrame) -> DataFrame:
    """Customers, share of repeat customers and mean lifetime sales per segment."""
    customers = df.groupBy("segment", "customer_id").agg(
        F.count_distinct("order_id").alias("_orders"), line_total("sales").alias("_sales")
    )
    return customers.groupBy("segment").agg(
        F.count("*").alias("customers"),
        percent(F.count_if(F.col("_orders") > 1).cast("decimal(18,0)"), F.count("*")).alias("repeat_rate_pct"),
        mean("_sales").alias("avg_ltv"),
    )


def loss_rate_by_discount(star: Star, threshold: str = "0.30", by_order: bool = False) -> DataFrame:
    """Lines (or orders, by total profit) above a discount, and how many of them lose money."""
    above = star.fact.where(F.col("discount_rate") > F.lit(Decimal(threshold)))
    if by_order:
        above = above.groupBy("order_id").agg(line_total("profit").alias("profit"))
    return above.agg(
        F.count("*").alias("lines"),
        F.count_if(F.col("profit") < 0).alias("loss_lines"),
        percent(F.count_if(F.col("profit") < 0).cast("decimal(18,0)"), F.count("*")).alias("loss_rate_pct"),
    )


def discount_profit_corr(star: Star, places: int = 6) -> DataFrame:
    """Correlation of the discount with profit and with margin."""
    rate = F.col("discount_rate").cast("double")
    return star.fact.agg(
        F.round(F.corr(rate, F.col("profit").cast("double")), places).alias("corr_profit"),
        F.round(F.corr(rate, F.col("profit_margin_pct").cast("double")), places).alias("corr_margin"),
    )


def seasonal_multiple(df: DataFrame, months: tuple[int, ...] = (11, 12)) -> DataFrame:
    """Mean monthly revenue of ``months`` over that of all months."""
    monthly = df.groupBy(F.trunc("order_date", "month").alias("ds")).agg(line_total("sales").alias("_sales"))
    in_season = F.month("ds").isin(*months)
    figures = monthly.agg(
        total(F.when(in_season, F.col("_sales"))).alias("_season"),
        F.count_if(in_season).alias("_season_months"),
        total("_sales").alias("_all"),
        F.count("*").alias("_months"),
    )
    return figures.select(
        ratio("_season", "_season_months").alias("season_mean"),
        ratio("_all", "_months").alias("overall_mean"),
        # Ratio of the means, in one division.
        ratio(
            F.col("_season") * F.col("_months").cast("decimal(6,0)"),
            (F.col("_all") * F.col("_season_months").cast("decimal(6,0)")).cast("decimal(24,2)"),
            4,
        ).alias("seasonal_multiple"),
    )


def region_extremes(regions: DataFrame) -> DataFrame:
    """Region with the highest revenue and region with the lowest margin."""
    return regions.agg(
        F.max_by("region", F.struct("net_revenue", "region")).alias("top_revenue_region"),
        F.max("net_revenue").alias("top_revenue"),
        F.min_by("region", F.struct("profit_margin_pct", "region")).alias("lowest_margin_region"),
        F.min("profit_margin_pct").alias("lowest_margin_pct"),
    )


def category_extremes(star: Star) -> DataFrame:
    """Categories with the best and the worst blended margin."""
    per_product = star.fact.groupBy("product_sk").agg(
        line_total("net_sales").alias("_net"), line_total("profit").alias("_profit")
    )
    categories = (
        per_product.join(star.products.select("product_sk", "category"), "product_sk")
        .groupBy("category")
        .agg(percent(total("_profit"), total("_net")).alias("margin_pct"))
        .where("margin_pct IS NOT NULL")
    )
    return categories.agg(
        F.max_by("category", F.struct("margin_pct", "category")).alias("best_category"),
        F.max("margin_pct").alias("best_margin_pct"),
        F.min_by("category", F.struct("margin_pct", "category")).alias("worst_category"),
        F.min("margin_pct").alias("worst_margin_pct"),
    )
