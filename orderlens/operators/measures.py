"""BI measures on gross sales, under any grouping and filter."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.money import amount, line_total, total

# Fixed value: lines from this discount on count as highly discounted.
HIGH_DISCOUNT = 0.3


def _per(numerator: Column, denominator: Column) -> Column:
    """Division that gives 0 over zero."""
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0.0))


def _revenue() -> Column:
    return amount("_sales")


# Measure -> (sums over lines it needs, identifiers it counts, its expression over both).
_MEASURES = {
    "total_revenue": (["_sales"], [], _revenue),
    "total_profit": (["_profit"], [], lambda: amount("_profit")),
    "total_orders": ([], ["order_id"], lambda: F.col("_order_id")),
    "total_units": (["_units"], [], lambda: F.col("_units")),
    "avg_order_value": (["_sales"], ["order_id"], lambda: _per(_revenue(), F.col("_order_id"))),
    "profit_margin": (["_sales", "_profit"], [], lambda: _per(amount("_profit"), _revenue()) * 100),
    "total_customers": ([], ["customer_id"], lambda: F.col("_customer_id")),
    "avg_customer_ltv": (["_sales"], ["customer_id"], lambda: _per(_revenue(), F.col("_customer_id"))),
    "revenue_per_customer": (["_sales"], ["customer_id"], lambda: _per(_revenue(), F.col("_customer_id"))),
    "loss_lines": (["_losses"], [], lambda: F.col("_losses")),
    "high_discount_lines": (["_discounted"], [], lambda: F.col("_discounted")),
    "avg_shipping_days": (
        ["_days", "_shipped"], [], lambda: F.try_divide(F.col("_days").cast("double"), F.col("_shipped"))
    ),
}
MEASURES = list(_MEASURES)


def _line_sums() -> dict[str, Column]:
    return {
        "_sales": line_total("sales"),
        "_profit": line_total("profit"),
        "_units": F.sum("quantity"),
        "_losses": F.count_if(F.col("profit") < 0),
        "_discounted": F.count_if(F.col("discount") >= HIGH_DISCOUNT),
        "_days": F.sum("shipping_days"),
        "_shipped": F.count("shipping_days"),
    }


def measure_table(df: DataFrame, by: Iterable[str] = (), measures: Iterable[str] = MEASURES,
                  subtotals: bool = False) -> DataFrame:
    """The measures per group, in one aggregate; ``subtotals`` adds the rollup of ``by`` and its ``level``.

    With distinct counts among them, lines are first summed per order and customer. Averages and
    ratios are recomputed on every level, never added up.
    """
    by, measures = list(by), list(measures)
    sums = [s for s in _line_sums() if any(s in _MEASURES[m][0] for m in measures)]
    ids = [c for c in ("order_id", "customer_id") if any(c in _MEASURES[m][1] for m in measures)]
    lines = [_line_sums()[s].alias(s) for s in sums]
    again = [(total(s) if s in ("_sales", "_profit") else F.sum(s)).alias(s) for s in sums]
    counts = [F.count_distinct(c).alias(f"_{c}") for c in ids]
    if ids or subtotals:
        per_order = df.groupBy(*by, *ids).agg(*(lines or [F.count("*").alias("_lines")]))
        grouped = per_order.rollup(*by) if subtotals else per_order.groupBy(*by)
        level = [F.grouping_id().alias("level")] if subtotals else []
        result = grouped.agg(*again, *counts, *level)
    else:
        result = df.groupBy(*by).agg(*lines)
    return result.select(
        *by, *(["level"] if subtotals else []), *[_MEASURES[m][2]().alias(m) for m in measures]
    )


def repeat_customer_rate(df: DataFrame, by: Iterable[str] = ()) -> DataFrame:
    """Customers with more than one order, in percent of all customers."""
    by = list(by)
    customers = df.groupBy(*by, "customer_id").agg(F.count_distinct("order_id").alias("_orders"))
    rate = _per(F.count_if(F.col("_orders") > 1).cast("double"), F.count("*")) * 100
    return customers.groupBy(*by).agg(rate.alias("repeat_customer_rate"))


def apply_slicers(
    df: DataFrame,
    years: Iterable[int] = (),
    dates: tuple[date, date] | None = None,
    segments: Iterable[str] = (),
    regions: Iterable[str] = (),
    categories: Iterable[str] = (),
) -> DataFrame:
    """Keep the lines that every given slicer selects; an empty slicer selects all.

    Years become date ranges, which Parquet can skip row groups by.
    """
    spans = [F.col("order_date").between(date(y, 1, 1), date(y, 12, 31)) for y in years]
    if spans:
        df = df.where(reduce(Column.__or__, spans))
    if dates:
        df = df.where(F.col("order_date").between(*dates))
    for column, chosen in (("segment", segments), ("region", regions), ("category", categories)):
        if chosen:
            df = df.where(F.col(column).isin(*chosen))
    return df


def calendar_join(df: DataFrame, calendar: DataFrame) -> DataFrame:
    """Lines with the report calendar's columns of their order date."""
    return df.join(calendar, df["order_date"] == calendar["date"], "left").drop("date")


def revenue_ly(df: DataFrame, by: Iterable[str] = ()) -> DataFrame:
    """Revenue per month, that of the same month a year earlier, and the growth on it in percent."""
    by = list(by)
    year, month = F.year("order_date").alias("year"), F.month("order_date").alias("month_num")
    monthly = df.groupBy(*by, year, month).agg(line_total("sales").alias("_sales"))
    # A frame of exactly one year back: a missing year leaves null, whichever row precedes.
    year_ago = Window.partitionBy(*by, "month_num").orderBy("year").rangeBetween(-1, -1)
    return _with_growth(
        monthly.withColumn("_before", F.sum("_sales").over(year_ago)), [*by, "year", "month_num"]
    )


def _with_growth(df: DataFrame, keys: list[str]) -> DataFrame:
    revenue, before = _revenue(), amount("_before")
    return df.select(
        *keys,
        revenue.alias("total_revenue"),
        before.alias("revenue_ly"),
        (F.try_divide(revenue - before, F.abs(before)) * 100).alias("yoy_growth_pct"),
    )


def revenue_to_date(df: DataFrame) -> DataFrame:
    """Per day: revenue of the month, quarter and year so far, and profit of the year so far."""
    daily = df.groupBy("order_date").agg(line_total("sales").alias("_sales"), line_total("profit").alias("_profit"))

    def so_far(column: str, period: str) -> Column:
        window = Window.partitionBy(F.trunc("order_date", period)).orderBy("order_date")
        return amount(F.sum(column).over(window))

    return daily.select(
        "order_date",
        so_far("_sales", "month").alias("revenue_mtd"),
        so_far("_sales", "quarter").alias("revenue_qtd"),
        so_far("_sales", "year").alias("revenue_ytd"),
        so_far("_profit", "year").alias("profit_ytd"),
    )


def period_cards(df: DataFrame, as_of: date | None = None) -> DataFrame:
    """One row: month, quarter and year to date at ``as_of``, by default the last order date."""
    daily = df.groupBy("order_date").agg(line_total("sales").alias("_sales"), line_total("profit").alias("_profit"))
    last = F.max("order_date").over(Window.partitionBy())  # one row per day
    daily = daily.withColumn("as_of", F.lit(as_of) if as_of else last)

    def so_far(column: str, period: str) -> Column:
        inside = F.col("order_date").between(F.trunc("as_of", period), F.col("as_of"))
        return amount(F.coalesce(F.sum(F.when(inside, F.col(column))), F.lit(0).cast("decimal(20,2)")))

    return daily.agg(
        F.max("as_of").alias("as_of"),
        so_far("_sales", "month").alias("revenue_mtd"),
        so_far("_sales", "quarter").alias("revenue_qtd"),
        so_far("_sales", "year").alias("revenue_ytd"),
        so_far("_profit", "year").alias("profit_ytd"),
    )
