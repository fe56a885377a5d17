"""Time comparisons in a filter context: attribute slicers narrow the lines, date slicers choose a set of days.

The two are kept apart, so a measure can leave the chosen days and still obey the other slicers: last year's figure
shifts the day set through a day-level map, a to-date figure widens it back to the period's first day.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import days_covering
from ..functions.money import amount, line_total, total
from .measures import apply_slicers

BROADCAST_DAYS = 100_000  # days of a date slicer up to which its map is broadcast

#: Grain -> the columns that name its periods.
GRAINS = {
    "total": [], "year": ["year"], "quarter": ["year", "quarter"], "month": ["year", "month_num"], "day": ["order_date"],
}
PERIODS = {"mtd": "month", "qtd": "quarter", "ytd": "year"}


@dataclass(frozen=True)
class Slicers:
    """A report page's choices; an empty one selects everything."""

    years: tuple[int, ...] = ()
    dates: tuple[date, date] | None = None
    segments: tuple[str, ...] = ()
    regions: tuple[str, ...] = ()
    categories: tuple[str, ...] = ()

    def attributes(self, df: DataFrame) -> DataFrame:
        """The lines of the chosen segments, regions and categories, of all days."""
        return apply_slicers(df, segments=self.segments, regions=self.regions, categories=self.categories)

    def spans(self) -> list[tuple[date, date]] | None:
        """The chosen days as ranges, those of the years cut to the date range; None for every day."""
        if not self.years and not self.dates:
            return None
        first, last = self.dates or (date.min, date.max)
        years = [(date(y, 1, 1), date(y, 12, 31)) for y in sorted(set(self.years))] or [(first, last)]
        return [(max(a, first), min(b, last)) for a, b in years if max(a, first) <= min(b, last)]

    def days(self, df: DataFrame) -> DataFrame:
        """One row per chosen day (full_date); without a date slicer the days of all years that ``df`` touches."""
        spans = self.spans()
        if spans is None:
            return days_covering(df, "order_date")
        ranges = df.sparkSession.createDataFrame(spans, "first date, last date")
        return ranges.select(F.explode(F.sequence("first", "last")).alias("full_date"))

    def few_days(self) -> bool:
        """Whether the chosen days are known to be few."""
        spans = self.spans()
        return spans is not None and sum((b - a).days + 1 for a, b in spans) <= BROADCAST_DAYS


def year_ago(day: str) -> Column:
    """The days a year before: the same day, 28 February for a leap day; the last day of February stands for all days
    that end the month a year earlier, so whole months are compared with whole months."""
    same = F.add_months(day, -12)
    return F.array_distinct(F.array(same, F.when(F.last_day(day) == F.col(day), F.last_day(same)).otherwise(same)))


def _period(day: str, grain: str) -> list[Column]:
    made = {"year": F.year(day), "quarter": F.quarter(day), "month_num": F.month(day), "order_date": F.col(day)}
    return [made[name].alias(name) for name in GRAINS[grain]]


def _between(df: DataFrame, spans: list[tuple[date, date]] | None) -> DataFrame:
    """Lines within the hull of the spans, as a range that file statistics can prune by."""
    if not spans:
        return df if spans is None else df.where(F.lit(False))
    return df.where(F.col("order_date").between(min(a for a, _ in spans), max(b for _, b in spans)))


def _earlier(day: date) -> date:
    return date(max(day.year - 1, 1), day.month, min(day.day, 28) if day.month == 2 else day.day)


def sales_against_last_year(df: DataFrame, slicers: Slicers = Slicers(), by: Iterable[str] = (), grain: str = "month") -> DataFrame:
    """Revenue of each group and period within the chosen days, that of the same days a year earlier, and the growth.

    A day a year earlier counts once per period, whether it was chosen itself or not. Periods with either figure have a
    row; growth is null without last year's.
    """
    by, period = list(by), GRAINS[grain]
    lines, spans = slicers.attributes(df), slicers.spans()
    days = slicers.days(lines)
    chosen = days.select(F.col("full_date").alias("_day"), *_period("full_date", grain), F.lit(True).alias("_now"))
    shifted = days.select(F.explode(year_ago("full_date")).alias("_day"), *_period("full_date", grain)).distinct()
    day_map = chosen.unionByName(shifted.withColumn("_now", F.lit(False)))  # two rows a day at most
    if slicers.few_days():
        day_map = F.broadcast(day_map)
    reach = None if spans is None else [s for a, b in spans for s in ((a, b), (_earlier(a), b))]
    daily = _between(lines, reach).groupBy(*by, F.col("order_date").alias("_day")).agg(line_total("sales").alias("_sales"))
    figures = daily.join(day_map, "_day").groupBy(*by, *period).agg(
        total(F.when(F.col("_now"), F.col("_sales"))).alias("_sales"),
        total(F.when(~F.col("_now"), F.col("_sales"))).alias("_before"),
    )
    revenue, before = amount(F.coalesce("_sales", F.lit(0).cast("decimal(20,2)"))), amount("_before")
    return figures.where("_sales IS NOT NULL OR _before IS NOT NULL").select(
        *by, *period,
        amount("_sales").alias("total_revenue"),
        before.alias("revenue_ly"),
        (F.try_divide(revenue - before, F.abs(before)) * 100).alias("yoy_growth_pct"),
    )


def to_date(df: DataFrame, by: Iterable[str] = (), slicers: Slicers = Slicers(), until: date | None = None) -> DataFrame:
    """Per group and day: revenue of the month, quarter and year so far, and profit of the year so far.

    Every group has a row for each day from its first sale to ``until`` (by default the last sale of all, or the slicer's
    last day), days without sales included. With a date slicer, which chooses the days shown, lines are read from the first
    day of the year that it begins in, so figures are whole and first sales those since then. A year of a group is one window, so a task sorts 366 rows of it at most.
    """
    by, spans = list(by), slicers.spans()
    lines = slicers.attributes(df)
    if spans:
        first = min(a for a, _ in spans)
        lines = _between(lines, [(date(first.year, 1, 1), max(b for _, b in spans))])
    daily = lines.groupBy(*by, "order_date").agg(line_total("sales").alias("_sales"), line_total("profit").alias("_profit"))
    last = F.lit(until) if until else daily.agg(F.max("order_date")).scalar()
    if spans:
        last = F.greatest(last, F.lit(max(b for _, b in spans))) if not until else last
    groups = daily.groupBy(*by).agg(F.min("order_date").alias("_first"))
    nothing = F.lit(0).cast("decimal(20,2)")
    dense = groups.where(F.col("_first") <= last).select(
        *by, F.explode(F.sequence("_first", last)).alias("order_date"), nothing.alias("_sales"), nothing.alias("_profit")
    )
    grid = daily.unionByName(dense).groupBy(*by, "order_date").agg(total("_sales").alias("_sales"), total("_profit").alias("_profit"))
    year = F.trunc("order_date", "year")
    grid = grid.where(F.col("order_date") <= last).withColumn("_year", year).repartition(*by, "_year")  # the one exchange of all three windows

    def so_far(column: str, period: str) -> Column:
        parts = [*by, "_year"] if period == "year" else [*by, "_year", F.trunc("order_date", period)]
        return amount(F.sum(column).over(Window.partitionBy(*parts).orderBy("order_date")))

    figures = grid.select(
        *by, "order_date",
        *(so_far("_sales", period).alias(f"revenue_{name}") for name, period in PERIODS.items()),
        so_far("_profit", "year").alias("profit_ytd"),
    )
    if spans is None:
        return figures
    inside = F.lit(False)
    for a, b in spans:
        inside = inside | F.col("order_date").between(a, b)
    return figures.where(inside)
