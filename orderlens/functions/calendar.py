"""Date keys, date parts and the two calendars."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The default calendar span.
CALENDAR_START = date(2015, 1, 1)
CALENDAR_END = date(2025, 12, 31)


def date_key(day: str | Column) -> Column:
    """YYYYMMDD as INT."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def date_of_key(key: str | Column) -> Column:
    """The DATE of a YYYYMMDD key."""
    return F.to_date(F.col(key).cast("string") if isinstance(key, str) else key.cast("string"), "yyyyMMdd")


def calendar_columns(key: str, *names: str) -> list[Column]:
    """Columns of the warehouse calendar for a YYYYMMDD key, whether or not a calendar holds the day."""
    day, number = date_of_key(key), F.col(key)
    month = F.floor(number / 100).cast("int") % 100
    made = {
        "full_date": day,
        "year": F.floor(number / 10000).cast("int"),
        "quarter": F.ceil(month / 3).cast("int"),
        "month_num": month,
        "month_name": F.date_format(day, "MMMM"),
    }
    return [made[name].alias(name) for name in names]


def day_range(spark: SparkSession, start: date = CALENDAR_START, end: date = CALENDAR_END) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included."""
    days = (end - start).days + 1
    return spark.range(days).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("full_date"))


def days_covering(dates: DataFrame, column: str) -> DataFrame:
    """Every day of the years that ``column`` touches."""
    span = dates.agg(F.min(column).alias("first"), F.max(column).alias("last"))
    first_day = F.trunc("first", "year")
    last_day = F.date_sub(F.add_months(F.trunc("last", "year"), 12), 1)
    return span.where("first IS NOT NULL").select(F.explode(F.sequence(first_day, last_day)).alias("full_date"))


def widened(days: DataFrame, dates: DataFrame, *columns: str) -> DataFrame:
    """``days`` and every day of the years that the columns of ``dates`` touch."""
    found = dates.select(F.explode(F.array(*columns)).alias("full_date"))
    return days.unionByName(days_covering(found, "full_date")).distinct()


def warehouse_calendar(days: DataFrame) -> DataFrame:
    """dim_date: ISO weekday and week, unpadded names, fiscal year equal to the calendar year."""
    day = F.col("full_date")
    iso_weekday = F.weekday(day) + 1
    return days.select(
        date_key(day).alias("date_sk"),
        day,
        iso_weekday.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofyear(day).alias("day_of_year"),
        F.weekofyear(day).alias("week_of_year"),
        F.month(day).alias("month_num"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        (iso_weekday >= 6).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
        F.concat(F.lit("FY"), F.date_format(day, "yy"), F.lit("Q"), F.quarter(day)).alias("fiscal_quarter"),
        F.year(day).alias("fiscal_year"),
    )


def report_calendar(days: DataFrame) -> DataFrame:
    """The BI date table: short names, weeks that start on Sunday with 1 January in week 1."""
    day = F.col("full_date")
    days_before_year = F.dayofweek(F.trunc(day, "year")) - 1
    return days.select(
        day.alias("date"),
        F.year(day).alias("year"),
        F.month(day).alias("month_num"),
        F.date_format(day, "MMM").alias("month_name"),
        F.concat(F.lit("Q"), F.quarter(day)).alias("quarter"),
        F.ceil((F.dayofyear(day) + days_before_year) / 7).cast("int").alias("week"),
        F.date_format(day, "EEE").alias("weekday"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
    )
