"""Monthly forecasts of any number of series in one job.

A straight trend times a seasonal index per calendar month, both in closed form. A series is one row
that holds its months as an array (at most one entry per calendar month); everything after the
shuffle that gathers them is column expressions over that row.
"""

from __future__ import annotations

from collections.abc import Iterable
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.money import line_total

# Forecast length, interval levels, smallest series, back-test spacing.
HORIZON_MONTHS = 6
LEVEL = 0.95
GROUP_LEVEL = 0.90
MIN_MONTHS = 6
BACKTEST_MIN_MONTHS = 18
BACKTEST_INITIAL_SHARE = 0.6
BACKTEST_MONTH_DAYS = 30
BACKTEST_STEP_DAYS = 30
BACKTEST_HORIZON_DAYS = 90
TREND_FLOOR = 0.01  # share of the mean month below which a trend does not fall: sales are positive


def monthly_series(df: DataFrame, keys: Iterable[str] = (), drop_partial_last_month: bool = False) -> DataFrame:
    """Sales, profit, orders and units per series and month; months without sales are left out.

    ``drop_partial_last_month`` drops a series' last month unless it has orders on its last day.
    """
    keys = list(keys)
    monthly = df.groupBy(*keys, F.trunc("order_date", "month").alias("ds")).agg(
        line_total("sales").cast("double").alias("y"),
        line_total("profit").cast("double").alias("profit"),
        F.count_distinct("order_id").alias("orders"),
        F.sum("quantity").alias("units"),
        F.max("order_date").alias("_last_day"),
    )
    monthly = monthly.where("y > 0")
    if drop_partial_last_month:
        newest = F.max("ds").over(Window.partitionBy(*keys))
        monthly = monthly.withColumn("_newest", newest).where("ds < _newest OR _last_day = last_day(ds)")
        monthly = monthly.drop("_newest")
    return monthly.drop("_last_day")


def _month_number(day: str | Column) -> Column:
    return F.year(day) * 12 + F.month(day)


def _trend(t: Column) -> Column:
    return F.greatest(F.col("intercept") + F.col("slope") * t, F.col("_floor"))


def _mean(values: Column) -> Column:
    """Mean of an array's values that are not null, null without any."""
    return F.aggregate(
        F.filter(values, lambda v: v.isNotNull()), F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("n")),
        lambda s, v: F.struct((s["sum"] + v).alias("sum"), (s["n"] + 1).alias("n")),
        lambda s: F.try_divide(s["sum"], s["n"]),
    )


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, v: total + v)


def _gathered(series: DataFrame, keys: list[str], carry: Iterable[str] = ()) -> DataFrame:
    """One row per series with its months in order (at most one per calendar month)."""
    months = F.array_sort(F.collect_list(F.struct("ds", "y", *carry))).alias("_months")
    return series.groupBy(*keys).agg(months)


def _fit(df: DataFrame, training: Column) -> DataFrame:
    """Add the model of the ``training`` months (an array of ds and y) to rows that hold a series' months.

    ``_raw`` has the mean ratio to the trend of each calendar month, null if it was not seen, ``_level`` their mean.
    """
    df = df.withColumn("_first", _month_number(F.get("_months", 0)["ds"])).withColumn(
        "_train", F.transform(training, lambda m: F.struct(
            (_month_number(m["ds"]) - F.col("_first")).cast("double").alias("t"), F.month(m["ds"]).alias("month_num"),
            m["y"].cast("double").alias("y"),
        ))
    )
    df = df.withColumns({"_t": _mean(F.transform("_train", lambda m: m["t"])), "_y": _mean(F.transform("_train", lambda m: m["y"]))})
    across = _sum(F.transform("_train", lambda m: (m["t"] - F.col("_t")) * (m["y"] - F.col("_y"))))
    along = _sum(F.transform("_train", lambda m: (m["t"] - F.col("_t")) * (m["t"] - F.col("_t"))))
    df = df.withColumn("slope", F.try_divide(across, along)).withColumns(
        {"intercept": F.col("_y") - F.col("slope") * F.col("_t"), "_floor": F.col("_y") * TREND_FLOOR}
    )
    raw = F.transform(F.sequence(F.lit(1), F.lit(12)), lambda month: _mean(F.transform(
        F.filter("_train", lambda m: m["month_num"] == month), lambda m: F.try_divide(m["y"], _trend(m["t"]))
    )))
    df = df.withColumn("_raw", raw).withColumn("_level", _mean(F.col("_raw")))
    errors = F.transform("_train", lambda m: F.try_divide(m["y"], _trend(m["t"]) * _index(m["month_num"])) - 1)
    df = df.withColumn("_errors", F.filter(errors, lambda e: e.isNotNull())).withColumn("_error", _mean(F.col("_errors")))
    squares = _sum(F.transform("_errors", lambda e: (e - F.col("_error")) * (e - F.col("_error"))))
    spread = F.when(F.size("_errors") > 1, F.sqrt(squares / (F.size("_errors") - 1)))
    return df.withColumn("residual_sd", spread).drop("_train", "_t", "_y", "_errors", "_error")


def _index(month: Column) -> Column:
    """The seasonal index of a calendar month, 1 for months never seen."""
    return F.coalesce(F.get("_raw", month - 1) / F.col("_level"), F.lit(1.0))


def fit_trend_season(series: DataFrame, keys: Iterable[str] = ()) -> DataFrame:
    """Per series and observed calendar month: trend, seasonal index, residual spread and extent."""
    keys = list(keys)
    fitted = _fit(_gathered(series, keys), F.col("_months"))
    seen = F.array_distinct(F.transform("_months", lambda m: F.month(m["ds"])))
    return fitted.withColumn("month_num", F.explode(seen)).select(
        *keys, "month_num", "slope", "intercept", _index(F.col("month_num")).alias("seasonal_index"), "residual_sd",
        F.size("_months").cast("bigint").alias("months"), F.get("_months", 0)["ds"].alias("first_month"),
        F.element_at("_months", -1)["ds"].alias("last_month"),
    )


def forecast_horizon(
    series: DataFrame,
    keys: Iterable[str] = (),
    periods: int = HORIZON_MONTHS,
    level: float = LEVEL,
    min_months: int = 2,
    carry: Iterable[str] = (),
) -> DataFrame:
    """Fitted months of every series and ``periods`` months beyond, with bounds.

    ``carry`` names further columns to keep for the history. Series shorter than ``min_months`` are left out. Calendar
    months never seen get index 1. A trend that falls below ``TREND_FLOOR`` of the series' mean stays there.
    """
    keys, carry = list(keys), list(carry)
    z = NormalDist().inv_cdf(0.5 + level / 2)
    fitted = _fit(_gathered(series, keys, carry).where(F.size("_months") >= min_months), F.col("_months"))
    fitted = fitted.withColumn("last_month", F.element_at("_months", -1)["ds"])
    types = {c: series.schema[c].dataType for c in ["y", *carry]}
    ahead = F.transform(F.sequence(F.lit(1), F.lit(periods)), lambda i: F.struct(
        F.add_months("last_month", i).alias("ds"), *[F.lit(None).cast(kind).alias(c) for c, kind in types.items()]
    ))
    months = F.concat("_months", ahead) if periods > 0 else F.col("_months")
    month = fitted.withColumn("_m", F.explode(months)).withColumn("ds", F.col("_m.ds"))
    return (
        month.withColumn("trend", _trend((_month_number("ds") - F.col("_first")).cast("double")))
        .withColumn("seasonal_index", _index(F.month("ds")))
        .withColumn("yhat", F.col("trend") * F.col("seasonal_index"))
        .withColumn("yhat_lower", F.col("yhat") - z * F.col("residual_sd") * F.col("yhat"))
        .withColumn("yhat_upper", F.col("yhat") + z * F.col("residual_sd") * F.col("yhat"))
        .select(*keys, "ds", F.col("_m.y").alias("y"), "trend", "seasonal_index", "yhat", "yhat_lower", "yhat_upper", "last_month",
                *[F.col(f"_m.{c}").alias(c) for c in carry])
    )


def backtest_points(
    series: DataFrame,
    keys: Iterable[str] = (),
    initial_share: float = BACKTEST_INITIAL_SHARE,
    step_days: int = BACKTEST_STEP_DAYS,
    horizon_days: int = BACKTEST_HORIZON_DAYS,
    min_months: int = BACKTEST_MIN_MONTHS,
) -> DataFrame:
    """Rolling-origin forecasts: every month after a cutoff, by a model refitted up to the cutoff.

    Cutoffs run back from the last month less the horizon while the initial training span remains. Every series is
    repeated once per cutoff, as one row that holds its months, all series and cutoffs in one job.
    """
    keys = list(keys)
    rows = _gathered(series, keys).where(F.size("_months") >= min_months)
    initial = F.floor(F.size("_months") * initial_share * BACKTEST_MONTH_DAYS).cast("int")
    rows = rows.withColumns({
        "_newest": F.date_sub(F.element_at("_months", -1)["ds"], horizon_days),
        "_oldest": F.date_add(F.get("_months", 0)["ds"], initial),
    }).where("_newest >= _oldest")
    cutoffs = F.transform(
        F.sequence(F.lit(0), F.floor(F.date_diff("_newest", "_oldest") / step_days).cast("int")),
        lambda i: F.date_sub(F.col("_newest"), i * step_days),
    )
    rows = rows.withColumn("cutoff", F.explode(cutoffs))
    ahead = F.filter("_months", lambda m: (m["ds"] > F.col("cutoff")) & (m["ds"] <= F.date_add("cutoff", horizon_days)))
    fitted = _fit(rows.withColumn("_ahead", ahead), F.filter("_months", lambda m: m["ds"] <= F.col("cutoff")))
    month = F.col("_m.ds")
    return fitted.withColumn("_m", F.explode("_ahead")).select(
        *keys, "cutoff", month.alias("ds"), F.date_diff(month, "cutoff").alias("horizon_days"), F.col("_m.y").alias("y"),
        (_trend((_month_number(month) - F.col("_first")).cast("double")) * _index(F.month(month))).alias("yhat"),
    )


def backtest_metrics(points: DataFrame, by: Iterable[str] = ("horizon_days",)) -> DataFrame:
    """Errors of back-test points per group, by default per days ahead; ``unforecast`` points have no forecast."""
    error = F.col("y") - F.col("yhat")
    return points.groupBy(*by).agg(
        F.count_distinct("cutoff").alias("folds"),
        F.count("*").alias("points"),
        F.count_if(F.col("yhat").isNull()).alias("unforecast"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (F.avg(F.abs(error) / F.col("y")) * 100).alias("mape_pct"),
    )


def backtest(series: DataFrame, keys: Iterable[str] = (), **options) -> DataFrame:
    """Rolling-origin errors per series, over all points of ``backtest_points``."""
    keys = list(keys)
    return backtest_metrics(backtest_points(series, keys, **options), keys)


def grouped_forecast(df: DataFrame, keys: Iterable[str] = ("category",), periods: int = HORIZON_MONTHS) -> DataFrame:
    """Forecast of every group's monthly sales with a 90 % interval; groups under six months are left out."""
    return forecast_horizon(monthly_series(df, keys), keys, periods, GROUP_LEVEL, MIN_MONTHS)


def forecast_table(forecast: DataFrame, keys: Iterable[str] = ()) -> DataFrame:
    """The months after a series' history, with report names and two decimals."""
    return forecast.where("ds > last_month").select(
        *keys,
        F.col("ds").alias("forecast_month"),
        F.round("yhat", 2).alias("predicted_sales"),
        F.round("yhat_lower", 2).alias("lower_bound"),
        F.round("yhat_upper", 2).alias("upper_bound"),
    )


def forecast_total(table: DataFrame, keys: Iterable[str] = ()) -> DataFrame:
    """Sum of the predicted months."""
    return table.groupBy(*keys).agg(F.round(F.sum("predicted_sales"), 2).alias("total_forecast"))


def forecast_components(forecast: DataFrame, keys: Iterable[str] = ()) -> DataFrame:
    """Trend and seasonal index per month."""
    return forecast.select(*keys, "ds", "trend", "seasonal_index")


def actual_vs_forecast(forecast: DataFrame, keys: Iterable[str] = ()) -> DataFrame:
    """Actual and fitted values per month, whether the month lies ahead, and the interval's widths."""
    return forecast.select(
        *keys,
        "ds",
        "y",
        "yhat",
        (F.col("ds") > F.col("last_month")).alias("is_future"),
        (F.col("yhat") - F.col("yhat_lower")).alias("error_down"),
        (F.col("yhat_upper") - F.col("yhat")).alias("error_up"),
    )
