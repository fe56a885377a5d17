"""The rows behind each dashboard visual, on gross sales."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import CALENDAR_END, CALENDAR_START
from ..functions.money import amount, line_total, percent, ratio, total
from ..session import stored
from .forecasting import HORIZON_MONTHS, forecast_horizon, monthly_series
from .measures import measure_table

# Fixed value: the discount from which pricing deserves a look.
REVIEW_DISCOUNT = 0.2


def kpi_cards(df: DataFrame, year: int | None = None, start: date | None = None,
              end: date | None = None) -> DataFrame:
    """One row: revenue, profit, margin, orders, and growth on the same dates a year earlier.

    The period is ``year``, or else everything from ``start`` to ``end``, by default the standard calendar widened to
    the years of the data; its dates a year earlier run between both ends a year back, to the month's last day if it ends
    with a month. Without ``year`` and a full range, the first and last order date are read when called.
    """
    if year:
        start, end = date(year, 1, 1), date(year, 12, 31)
        before = (date(year - 1, 1, 1), date(year - 1, 12, 31))
    else:
        if not (start and end):
            first, last = df.agg(F.min("order_date"), F.max("order_date")).first()
            start = start or min(CALENDAR_START, date(first.year, 1, 1) if first else CALENDAR_START)
            end = end or max(CALENDAR_END, date(last.year, 12, 31) if last else CALENDAR_END)
        before = (_year_earlier(start), _year_earlier(end, last=True))
    current = F.col("order_date").between(start, end)
    per_order = (
        df.withColumn("_current", current)
        .where(F.col("_current") | F.col("order_date").between(*before))
        .groupBy("order_id", "_current", F.col("order_date").between(*before).alias("_before"))
        .agg(line_total("sales").alias("_sales"), line_total("profit").alias("_profit"))
    )
    figures = per_order.agg(
        total(F.when(F.col("_current"), F.col("_sales"))).alias("_sales"),
        total(F.when(F.col("_current"), F.col("_profit"))).alias("_profit"),
        F.count_distinct(F.when(F.col("_current"), F.col("order_id"))).alias("total_orders"),
        total(F.when(F.col("_before"), F.col("_sales"))).alias("_ly"),
    )
    return figures.select(
        amount("_sales").alias("total_revenue"),
        amount("_profit").alias("total_profit"),
        F.coalesce(percent("_profit", "_sales"), F.lit(0.0)).alias("profit_margin"),
        "total_orders",
        percent(F.col("_sales") - F.col("_ly"), F.abs("_ly")).alias("yoy_growth_pct"),
    )


def _year_earlier(day: date, last: bool = False) -> date:
    """The same day of the year before, 28 February for a leap day; the ``last`` day of February stays the last."""
    if day.month == 2 and day.day >= 28:
        ends = last and (day + timedelta(days=1)).month == 3
        return date(day.year - 1, 3, 1) - timedelta(days=1) if ends else date(day.year - 1, 2, 28)
    return date(day.year - 1, day.month, day.day)


def trend_line(df: DataFrame) -> DataFrame:
    """Revenue and profit per month, with the average month's revenue."""
    monthly = df.groupBy(F.date_format("order_date", "yyyy-MM").alias("year_month")).agg(
        line_total("sales").alias("_sales"), line_total("profit").alias("_profit")
    )
    all_months = Window.partitionBy()  # one row per month
    return monthly.select(
        "year_month",
        amount("_sales").alias("total_revenue"),
        amount("_profit").alias("total_profit"),
        ratio(F.sum("_sales").over(all_months).cast("decimal(20,2)"), F.count("*").over(all_months)).alias(
            "avg_revenue"
        ),
    ).orderBy("year_month")


def revenue_by_category(df: DataFrame, small_multiples: Iterable[str] = ()) -> DataFrame:
    """Revenue per category (and region, if asked), highest first."""
    keys = ["category", *small_multiples]
    return measure_table(df, keys, ["total_revenue"]).orderBy(F.desc("total_revenue"), *keys)


def state_map(df: DataFrame) -> DataFrame:
    """Revenue, profit, margin and orders per state."""
    return measure_table(df, ["state"], ["total_revenue", "total_profit", "profit_margin", "total_orders"])


def region_columns(df: DataFrame) -> DataFrame:
    """Revenue and profit per region."""
    return measure_table(df, ["region"], ["total_revenue", "total_profit"])


def state_matrix(df: DataFrame) -> DataFrame:
    """``state_map`` with a grand total row (no state, level 1)."""
    return measure_table(
        df, ["state"], ["total_revenue", "total_profit", "profit_margin", "total_orders"], subtotals=True
    )


def state_scatter(df: DataFrame) -> DataFrame:
    """Revenue, profit and orders per state, and the side of the zero-profit line."""
    states = measure_table(df, ["state"], ["total_revenue", "total_profit", "total_orders"])
    return states.withColumn("side", F.when(F.col("total_profit") < 0, "loss").otherwise("profit"))


def top_n_products_bi(df: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` product names with the highest revenue and whether they earn money."""
    return (
        _per_product(df, ["product_name"])
        .select(
            "product_name",
            amount("_sales").alias("total_revenue"),
            amount("_profit").alias("total_profit"),
            (F.col("_profit") > 0).alias("profitable"),
        )
        .orderBy(F.desc("total_revenue"), "product_name")
        .limit(n)
    )


def subcategory_treemap(df: DataFrame) -> DataFrame:
    """Revenue and margin per category and sub-category."""
    return measure_table(df, ["category", "sub_category"], ["total_revenue", "profit_margin"])


def discount_profit_scatter(df: DataFrame, keys: Iterable[str] = ("sub_category",)) -> DataFrame:
    """Mean discount and total profit per sub-category, product, or other key."""
    keys = list(keys)
    return df.groupBy(*keys).agg(
        ratio(F.sum("discount"), F.count("discount"), 4).alias("avg_discount"),
        amount(line_total("profit")).alias("total_profit"),
    )


def pricing_review(df: DataFrame, keys: Iterable[str] = ("product_name",), discount: float = REVIEW_DISCOUNT,
                   profit: float = 0) -> DataFrame:
    """Products with a mean discount above and a total profit below the lines."""
    scatter = discount_profit_scatter(df, keys)
    return scatter.where((F.col("avg_discount") > discount) & (F.col("total_profit") < profit))


def category_share(df: DataFrame) -> DataFrame:
    """Revenue per category and its share of the total."""
    categories = df.groupBy("category").agg(line_total("sales").alias("_sales"))
    everything = df.agg(line_total("sales").alias("_all"))  # one row
    return categories.withColumn("_all", everything.scalar()).select(
        "category", amount("_sales").alias("total_revenue"), percent("_sales", "_all").alias("share_pct")
    )


def loss_makers(df: DataFrame) -> DataFrame:
    """Products whose total profit is negative, worst first."""
    keys = ["product_name", "category"]
    return (
        df.groupBy(*keys)
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            amount(line_total("sales")).alias("total_revenue"),
            amount(line_total("profit")).alias("total_profit"),
            ratio(F.sum("discount"), F.count("discount"), 4).alias("avg_discount"),
        )
        .where("total_profit < 0")
        .orderBy("total_profit", *keys)
    )


def seasonal_heatmap(df: DataFrame) -> DataFrame:
    """Revenue by year (rows) and month (columns m01 to m12)."""
    months = range(1, 13)
    cells = df.groupBy(F.year("order_date").alias("year")).pivot("month_num", list(months))
    return cells.agg(amount(line_total("sales"))).withColumnsRenamed({str(m): f"m{m:02d}" for m in months})


def profit_waterfall(df: DataFrame) -> DataFrame:
    """Profit per month name and category, years merged, and its change on the month before."""
    cells = df.groupBy(
        F.month("order_date").alias("month_num"), F.date_format("order_date", "MMM").alias("month_name"), "category"
    ).agg(line_total("profit").alias("_profit"))
    before = F.lag("_profit").over(Window.partitionBy("category").orderBy("month_num"))
    return cells.select(
        "month_num",
        "month_name",
        "category",
        amount("_profit").alias("total_profit"),
        amount(F.col("_profit") - before).alias("profit_change"),
    )


def area_trend(df: DataFrame, periods: int = HORIZON_MONTHS) -> DataFrame:
    """Monthly revenue, profit and straight trend, and the forecast of the next months."""
    forecast = forecast_horizon(monthly_series(df), periods=periods, carry=["profit"])
    ahead = F.col("ds") > F.col("last_month")
    return forecast.select(
        "ds",
        F.col("y").alias("total_revenue"),
        F.col("profit").alias("total_profit"),
        "trend",
        F.when(ahead, F.col("yhat")).alias("forecast"),
        F.when(ahead, F.col("yhat_lower")).alias("lower_bound"),
        F.when(ahead, F.col("yhat_upper")).alias("upper_bound"),
    )


def actuals_plus_forecast(series: DataFrame, table: DataFrame) -> DataFrame:
    """History and forecast as one long table, tagged by series."""
    actual = series.select(F.lit("actual").alias("series"), F.col("ds").alias("month"), F.col("y").alias("value"))
    ahead = table.select(
        F.lit("forecast").alias("series"),
        F.col("forecast_month").alias("month"),
        F.col("predicted_sales").alias("value"),
        "lower_bound",
        "upper_bound",
    )
    return ahead.unionByName(actual, allowMissingColumns=True)


def profit_decomposition(df: DataFrame, path: Iterable[str] = ("region", "segment", "category")) -> DataFrame:
    """Profit along a drill-down path with subtotals; ``level`` is 0 for the finest rows."""
    path = list(path)
    cells = df.groupBy(*path).agg(line_total("profit").alias("_profit"))
    return cells.rollup(*path).agg(amount(total("_profit")).alias("total_profit"), F.grouping_id().alias("level"))


def _per_product(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(line_total("sales").alias("_sales"), line_total("profit").alias("_profit"))


def loss_decomposition(df: DataFrame, dimensions: Iterable[str] = ("region", "segment", "category")) -> DataFrame:
    """A drill-down into losses that picks its own splits: one row per step, from the widest to the narrowest.

    A step takes, of all dimensions not used yet, the member whose loss (profits below zero) exceeds an even share of
    the node's loss by most, and goes on inside it; equal ones go by the order of dimensions, then by member. All steps
    read one stored CUBE, from which each brings one row to the driver.
    """
    dimensions = list(dimensions)
    below = line_total(F.least(F.col("profit"), F.lit(0))).alias("_loss")
    cells = df.groupBy(*dimensions).agg(below, line_total("profit").alias("_profit"))
    cube = stored(cells.cube(*dimensions).agg(
        (-total("_loss")).cast("double").alias("loss"), total("_profit").cast("double").alias("total_profit"),
        *[(F.grouping(d) == 0).alias(f"_by_{d}") for d in dimensions],
    ), "cube")
    steps, chosen = [], {}
    for step in range(1, len(dimensions) + 1):
        inside = cube
        for d, member in chosen.items():
            inside = inside.where(F.col(f"_by_{d}") & F.col(d).eqNullSafe(F.lit(member)))
        found = []
        for place, d in enumerate(dimensions):
            if d not in chosen:
                others = [~F.col(f"_by_{o}") for o in dimensions if o != d and o not in chosen]
                members = inside.where(reduce(Column.__and__, others, F.col(f"_by_{d}")))
                node = members.agg(F.struct(F.sum("loss").alias("loss"), F.count("*").alias("members"))).scalar()
                found.append(members.withColumn("_node", node).select(
                    F.lit(place).alias("place"), F.lit(d).alias("dimension"), F.col(d).cast("string").alias("member"), "loss",
                    "total_profit", (F.col("loss") - F.col("_node.loss") / F.col("_node.members")).alias("_excess"),
                    F.col("_node.loss").alias("_all"),
                ))
        best = reduce(DataFrame.unionByName, found).orderBy(F.desc("_excess"), "place", "member").first()
        if best is None:
            break
        chosen[best["dimension"]] = best["member"]
        share = best["loss"] / best["_all"] * 100 if best["_all"] else None
        steps.append((step, best["dimension"], best["member"], best["loss"], share, best["total_profit"]))
    return df.sparkSession.createDataFrame(
        steps, "step int, dimension string, member string, loss double, share_pct double, total_profit double"
    )
