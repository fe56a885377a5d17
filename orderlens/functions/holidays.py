"""A holiday calendar made by rules: fixed days, n-th weekdays of a month, and days counted from Easter Sunday."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LAST = -1


@dataclass(frozen=True)
class Holiday:
    """``day`` of ``month``; or the ``nth`` (``LAST``: last) ``weekday`` (1 Monday to 7 Sunday) of it; or ``easter`` days
    after Easter Sunday. ``since``: the first year that keeps it."""

    name: str
    month: int | None = None
    day: int | None = None
    weekday: int | None = None
    nth: int | None = None
    easter: int | None = None
    since: int = 1


#: The public holidays of the United States.
US_HOLIDAYS = (
    Holiday("New Year's Day", 1, 1),
    Holiday("Martin Luther King Jr. Day", 1, weekday=1, nth=3, since=1986),
    Holiday("Washington's Birthday", 2, weekday=1, nth=3),
    Holiday("Memorial Day", 5, weekday=1, nth=LAST),
    Holiday("Juneteenth", 6, 19, since=2021),
    Holiday("Independence Day", 7, 4),
    Holiday("Labor Day", 9, weekday=1, nth=1),
    Holiday("Columbus Day", 10, weekday=1, nth=2),
    Holiday("Veterans Day", 11, 11),
    Holiday("Thanksgiving", 11, weekday=4, nth=4),
    Holiday("Christmas Day", 12, 25),
)

EASTER_HOLIDAYS = (Holiday("Good Friday", easter=-2), Holiday("Easter Sunday", easter=0), Holiday("Easter Monday", easter=1))


def easter_sunday(year: Column) -> Column:
    """The DATE of Easter Sunday in the Gregorian calendar."""

    def div(a: Column, b: int) -> Column:
        return F.floor(a / b).cast("int")

    def once(value: Column, use: Callable[[Column], Column]) -> Column:
        return F.get(F.transform(F.array(value), use), 0)

    century, golden = div(year, 100), year % 19
    # the moon's age at the turn of the year, corrected for dropped leap days and the drift of the lunar cycle
    epact = (19 * golden + century - div(century, 4) - div(century - div(century + 8, 25) + 1, 3) + 15) % 30

    def from_epact(epact: Column) -> Column:
        # days from the full moon to the Sunday after
        to_sunday = (32 + 2 * (century % 4) + 2 * div(year % 100, 4) - epact - year % 100 % 4) % 7
        return once(to_sunday, lambda days: epact + days - 7 * div(golden + 11 * epact + 22 * days, 451))

    return F.date_add(F.make_date(year, F.lit(3), F.lit(22)), once(epact, from_epact).cast("int"))


def holiday_calendar(years: DataFrame, rules: Iterable[Holiday] = US_HOLIDAYS) -> DataFrame:
    """year, holiday, day and observed of every rule and year of ``years`` (year).

    ``observed`` is the Friday before a Saturday and the Monday after a Sunday, except for rules that name a weekday.
    """
    spark, rules = years.sparkSession, list(rules)
    table = spark.createDataFrame(
        [(h.name, h.month, h.day, h.weekday, h.nth, h.easter, h.since) for h in rules],
        "holiday string, month int, day int, weekday int, nth int, easter int, since int",
    )
    both = years.select(F.col("year").cast("int").alias("year")).distinct().join(F.broadcast(table), F.col("year") >= F.col("since"))
    first = F.make_date("year", "month", F.lit(1))
    to_weekday = F.pmod(F.col("weekday") - 1 - F.weekday(first), F.lit(7))
    end = F.last_day(first)
    from_end = F.pmod(F.weekday(end) - (F.col("weekday") - 1), F.lit(7))
    made = (
        F.when(F.col("nth") == LAST, F.date_sub(end, from_end))
        .when(F.col("weekday").isNotNull(), F.date_add(first, to_weekday + 7 * (F.col("nth") - 1)))
        .otherwise(F.make_date("year", "month", "day"))
    )
    if any(h.easter is not None for h in rules):
        made = F.when(F.col("easter").isNotNull(), F.date_add(easter_sunday(F.col("year")), F.col("easter"))).otherwise(made)
    weekday = F.weekday("_day")
    moved = F.when(weekday == 5, F.date_sub("_day", 1)).when(weekday == 6, F.date_add("_day", 1)).otherwise(F.col("_day"))
    fixed = F.col("weekday").isNull() & F.col("easter").isNull()
    return both.withColumn("_day", made).select(
        "year", "holiday", F.col("_day").alias("day"), F.when(fixed, moved).otherwise(F.col("_day")).alias("observed")
    )


def working_days(days: DataFrame, holidays: DataFrame) -> DataFrame:
    """Per month (ds) of ``days`` (full_date): Mondays to Fridays on which no holiday is observed."""
    observed = holidays.select(F.col("observed").alias("full_date")).distinct()
    work = days.where(F.weekday("full_date") < 5).join(observed, "full_date", "left_anti")
    return work.groupBy(F.trunc("full_date", "month").alias("ds")).agg(F.count("*").cast("int").alias("working_days"))
