"""Forecasts with trend changes, holidays and intervals that widen with the horizon.

The logarithm of a series' sales per day of the month is a straight line with hinges at evenly spaced months, waves of a
year, and the month's working days, so seasons multiply. The weights solve ridge normal equations: hinges are held back, so the trend bends only
where the months say so. A series is one row that holds its months as an array (at most one entry per calendar month);
sums of products, the Cholesky factor and both substitutions are column expressions over it. Fitting, forecasting and
back-testing any number of series takes the one shuffle that gathers the months.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import days_covering
from ..functions.holidays import US_HOLIDAYS, Holiday, holiday_calendar, working_days
from .forecasting import (
    BACKTEST_HORIZON_DAYS, BACKTEST_INITIAL_SHARE, BACKTEST_MIN_MONTHS, BACKTEST_MONTH_DAYS, BACKTEST_STEP_DAYS, HORIZON_MONTHS, LEVEL,
    MIN_MONTHS,
)

CHANGEPOINTS = 8  # hinges, spread evenly over the first CHANGEPOINT_SHARE of the months
CHANGEPOINT_SHARE = 0.8
WAVES = 2
USUAL_WORKING_DAYS = 21
PENALTY = {"level": 1e-6, "slope": 1.0, "hinge": 0.1, "wave": 1.0, "work": 10.0}

PENALTIES = [
    PENALTY["level"], PENALTY["slope"], *[PENALTY["hinge"]] * CHANGEPOINTS, *[PENALTY["wave"]] * 2 * WAVES, PENALTY["work"],
]
SIZE = len(PENALTIES)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def _numbers(values: Iterable[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, v: total + v)


def _dot(a: Column, b: Column) -> Column:
    """Sum of products of two arrays of one length."""
    return _sum(F.zip_with(a, b, lambda x, y: x * y))


def _upto(n: Column) -> Column:
    """0 to n - 1."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _month_number(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day)


def features(month: Column, first: Column, months: Column, work: Column) -> Column:
    """The regressors of a month for a model fitted on ``months`` calendar months from ``first`` on."""
    t = (_month_number(month) - _month_number(first)).cast("double")
    hinges = [
        F.greatest(F.lit(0.0), t / months - CHANGEPOINT_SHARE * j / (CHANGEPOINTS + 1)) for j in range(1, CHANGEPOINTS + 1)
    ]
    angle = F.month(month) * (2 * math.pi / 12)
    waves = [wave(angle * k) for k in range(1, WAVES + 1) for wave in (F.sin, F.cos)]
    return F.array(F.lit(1.0), t / months, *hinges, *waves, (work - USUAL_WORKING_DAYS) / USUAL_WORKING_DAYS)


def cholesky(a: Column, size: int = SIZE) -> Column:
    """The lower triangle, as rows, of a positive definite matrix given row after row."""

    def row(rows: Column, i: Column) -> Column:
        def entry(done: Column, j: Column) -> Column:
            value = F.get(a, i * size + j)
            left = _dot(done, F.slice(F.get(rows, j), 1, F.size(done)))
            own = F.sqrt(value - _dot(done, done))
            return F.concat(done, F.array(F.when(j == i, own).otherwise((value - left) / F.get(F.get(rows, j), j))))

        return F.concat(rows, F.array(F.aggregate(F.sequence(F.lit(0), i), _numbers([]).cast("array<double>"), entry)))

    return F.aggregate(_upto(F.lit(size)), F.array().cast("array<array<double>>"), row)


def solve(a: Column, b: Column, size: int = SIZE) -> Column:
    """The solution of the normal equations ``a`` w = ``b``."""

    def both(lower: Column) -> Column:
        def forward(z: Column, i: Column) -> Column:
            return F.concat(z, F.array((F.get(b, i) - _dot(z, F.slice(F.get(lower, i), 1, i))) / F.get(F.get(lower, i), i)))

        def back(z: Column) -> Column:
            def step(w: Column, down: Column) -> Column:  # w holds the entries after i
                i = F.lit(size - 1) - down
                rest = _sum(F.transform(_upto(down), lambda k: F.get(F.get(lower, i + 1 + k), i) * F.get(w, k)))
                return F.concat(F.array((F.get(z, i) - rest) / F.get(F.get(lower, i), i)), w)

            return F.aggregate(_upto(F.lit(size)), F.array().cast("array<double>"), step)

        return _let(F.aggregate(_upto(F.lit(size)), F.array().cast("array<double>"), forward), back)

    return _let(cholesky(a, size), both)


def _weights(rows: Column) -> Column:
    """Ridge weights of ``rows`` (x: regressors, y)."""
    diagonal = _numbers(v for i in range(SIZE) for v in [PENALTIES[i] if i == j else 0.0 for j in range(SIZE)])

    def products(total: Column, row: Column) -> Column:
        outer = F.flatten(F.transform(row["x"], lambda p: F.transform(row["x"], lambda q: p * q)))
        return F.zip_with(total, outer, lambda s, v: s + v)

    a = F.aggregate(rows, diagonal, products)
    b = F.aggregate(rows, _numbers([0.0] * SIZE), lambda total, row: F.zip_with(total, row["x"], lambda s, v: s + v * row["y"]))
    return _let(b, lambda known: solve(a, known))


def _work_map(series: DataFrame, holidays: Iterable[Holiday], ahead: int) -> Column:
    """Month -> working days of all years that the series touch and ``ahead`` months more, as one map."""
    span = series.select("ds").unionByName(series.agg(F.add_months(F.max("ds"), ahead).alias("ds")))
    days = days_covering(span, "ds")
    calendar = holiday_calendar(days.select(F.year("full_date").alias("year")), holidays)
    months = working_days(days, calendar)
    return months.agg(F.map_from_entries(F.collect_list(F.struct("ds", "working_days"))).alias("work")).scalar()


def _gathered(series: DataFrame, keys: list[str], holidays: Iterable[Holiday], ahead: int) -> DataFrame:
    """One row per series: its months as an array of (ds, y) in order, and the working days of every month."""
    months = F.array_sort(F.collect_list(F.struct("ds", F.col("y").cast("double").alias("y"))))
    return series.where("y > 0").groupBy(*keys).agg(months.alias("_months")).withColumn("_work", _work_map(series, holidays, ahead))


def _x(month: Column, first: Column, months: Column) -> Column:
    work = F.coalesce(F.element_at("_work", month), F.lit(USUAL_WORKING_DAYS))
    return features(month, first, months, work)


def _days(month: Column) -> Column:
    return F.dayofmonth(F.last_day(month)).cast("double")


def _predicted(month: Column) -> Column:
    return F.exp(_dot(_x(month, F.col("_first"), F.col("_span")), F.col("weights"))) * _days(month)


def _fitted(df: DataFrame, training: Column) -> DataFrame:
    """Add first month, number of calendar months and weights of the model of the ``training`` months."""
    df = df.withColumn("_train", training)
    last = F.element_at("_train", -1)["ds"]
    df = df.withColumn("_first", F.get("_train", 0)["ds"]).withColumn(
        "_span", (_month_number(last) - _month_number(F.get("_train", 0)["ds"]) + 1).cast("double")
    )
    rows = F.transform("_train", lambda m: F.struct(
        _x(m["ds"], F.col("_first"), F.col("_span")).alias("x"), F.log(m["y"] / _days(m["ds"])).alias("y")
    ))
    return df.withColumn("_rows", rows).withColumn("weights", _weights(F.col("_rows"))).drop("_rows", "_train")


def fit(series: DataFrame, keys: Iterable[str] = (), holidays: Iterable[Holiday] = US_HOLIDAYS) -> DataFrame:
    """Per series: first month, calendar months and the weights (level, slope, hinges, waves, working days)."""
    keys = list(keys)
    fitted = _fitted(_gathered(series, keys, holidays, 0), F.col("_months"))
    return fitted.select(*keys, F.col("_first").alias("first_month"), F.col("_span").cast("int").alias("months"), "weights")


def forecast(
    series: DataFrame, keys: Iterable[str] = (), periods: int = HORIZON_MONTHS, min_months: int = MIN_MONTHS,
    holidays: Iterable[Holiday] = US_HOLIDAYS,
) -> DataFrame:
    """Fitted months of every series (keys, ds, y) and ``periods`` months beyond, whose ``step`` counts from 1.

    ``y`` is positive, one row per month; shorter series than ``min_months`` are left out.
    """
    keys = list(keys)
    rows = _gathered(series, keys, holidays, periods).where(F.size("_months") >= min_months)
    last = F.element_at("_months", -1)["ds"]
    ahead = F.transform(F.sequence(F.lit(1), F.lit(periods)), lambda i: F.struct(
        F.add_months(last, i).alias("ds"), F.lit(None).cast("double").alias("y")
    ))
    fitted = _fitted(rows, F.col("_months")).withColumn("last_month", last)
    month = F.col("_m")["ds"]
    return (
        fitted.withColumn("_m", F.explode(F.concat("_months", ahead)))
        .select(
            *keys, month.alias("ds"), F.col("_m")["y"].alias("y"),
            _predicted(month).alias("yhat"), "last_month",
            F.greatest(_month_number(month) - _month_number(F.col("last_month")), F.lit(0)).alias("step"),
        )
    )


def backtest_points(
    series: DataFrame, keys: Iterable[str] = (), initial_share: float = BACKTEST_INITIAL_SHARE, step_days: int = BACKTEST_STEP_DAYS,
    horizon_days: int = BACKTEST_HORIZON_DAYS, min_months: int = BACKTEST_MIN_MONTHS, holidays: Iterable[Holiday] = US_HOLIDAYS,
) -> DataFrame:
    """Rolling-origin forecasts: every month after a cutoff, by a model refitted up to the cutoff; ``step`` counts the
    calendar months from the last one known. Cutoffs are those of the straight trend's back-test."""
    keys = list(keys)
    rows = _gathered(series, keys, holidays, 0).where(F.size("_months") >= min_months)
    initial = F.floor(F.size("_months") * initial_share * BACKTEST_MONTH_DAYS).cast("int")
    newest = F.date_sub(F.element_at("_months", -1)["ds"], horizon_days)
    oldest = F.date_add(F.get("_months", 0)["ds"], initial)
    rows = rows.withColumn("_newest", newest).withColumn("_folds", F.floor(F.date_diff(newest, oldest) / step_days).cast("int"))
    rows = rows.where("_folds >= 0").withColumn(
        "cutoff", F.explode(F.transform(F.sequence(F.lit(0), F.col("_folds")), lambda i: F.date_sub(F.col("_newest"), i * step_days)))
    )
    known = F.filter("_months", lambda m: m["ds"] <= F.col("cutoff"))
    ahead = F.filter("_months", lambda m: (m["ds"] > F.col("cutoff")) & (m["ds"] <= F.date_add("cutoff", horizon_days)))
    rows = rows.withColumn("_ahead", ahead).withColumn("_last", F.element_at(known, -1)["ds"])
    fitted = _fitted(rows, known).withColumn("_m", F.explode("_ahead"))
    month = F.col("_m")["ds"]
    return fitted.select(
        *keys, "cutoff", month.alias("ds"), F.date_diff(month, "cutoff").alias("horizon_days"), F.col("_m")["y"].alias("y"),
        _predicted(month).alias("yhat"),
        (_month_number(month) - _month_number(F.col("_last"))).alias("step"),
    )


def error_quantiles(points: DataFrame, keys: Iterable[str] = (), level: float = LEVEL) -> DataFrame:
    """Per series and step ahead: the ratios of actual to forecast that ``level`` of the back-test's points lie between.

    A step has one point per cutoff, too few for a quantile of its own. So errors (logarithms of the ratio) are divided
    by their step's root mean square, the quantiles taken over all steps together, a little further out for the few
    points there are, and multiplied by the step's spread again. Bounds never narrow with the horizon: a step takes the
    widest spread of those up to it.
    """
    keys = list(keys)
    error = F.log(F.col("y") / F.col("yhat"))
    step = Window.partitionBy(*keys, "step")
    spread = points.withColumn("_error", error).withColumn("_spread", F.sqrt(F.avg(F.col("_error") ** 2).over(step)))
    scaled = F.coalesce(F.try_divide(F.col("_error"), F.col("_spread")), F.lit(0.0))
    steps = F.array_sort(F.collect_set(F.struct("step", "_spread")))
    tail = (1 - level) / 2
    series = spread.groupBy(*keys).agg(
        F.array_sort(F.collect_list(scaled)).alias("_scaled"), steps.alias("_steps"), F.count("*").alias("points")
    )  # some points per calendar month

    def quantile(share: Column) -> Column:
        place = share * (F.col("points") - 1)
        low, high = F.get("_scaled", F.floor(place).cast("int")), F.get("_scaled", F.ceil(place).cast("int"))
        return low + (high - low) * (place - F.floor(place))

    further = F.greatest(F.lit(0.0), tail - F.lit(1 - tail) / F.col("points"))
    widest = F.transform("_steps", lambda s, i: F.struct(
        s["step"].alias("step"), F.array_max(F.transform(F.slice("_steps", F.lit(1), i + 1), lambda t: t["_spread"])).alias("spread")
    ))
    return (
        series.withColumn("_low", F.least(quantile(further), F.lit(0.0))).withColumn("_high", F.greatest(quantile(1 - further), F.lit(0.0)))
        .withColumn("_step", F.explode(widest))
        .select(
            *keys, F.col("_step")["step"].alias("step"), F.exp(F.col("_low") * F.col("_step")["spread"]).alias("low"),
            F.exp(F.col("_high") * F.col("_step")["spread"]).alias("high"), "points",
        )
    )


def forecast_with_intervals(
    series: DataFrame, keys: Iterable[str] = (), periods: int = HORIZON_MONTHS, level: float = LEVEL,
    holidays: Iterable[Holiday] = US_HOLIDAYS,
) -> DataFrame:
    """The months ahead (keys, ds, step, yhat, yhat_lower, yhat_upper) with bounds from the back-test's errors at each step.

    Series too short to be back-tested have no bounds.
    """
    keys = list(keys)
    ahead = forecast(series, keys, periods, holidays=holidays).where("step > 0")
    points = backtest_points(series, keys, horizon_days=31 * periods, holidays=holidays)
    bounds = error_quantiles(points.where(F.col("step") <= periods), keys, level).withColumnsRenamed({c: f"_{c}" for c in keys})
    on = reduce(Column.__and__, [ahead[c].eqNullSafe(F.col(f"_{c}")) for c in keys], ahead["step"] == bounds["step"])
    return ahead.join(bounds, on, "left").select(
        *(ahead[c] for c in keys), ahead["ds"], ahead["step"], "yhat",
        (F.col("yhat") * F.col("low")).alias("yhat_lower"), (F.col("yhat") * F.col("high")).alias("yhat_upper"),
    )


def interval_coverage(points: DataFrame, keys: Iterable[str] = (), level: float = LEVEL, split: date | None = None) -> DataFrame:
    """Per series: the share of held-out points that lie within bounds learnt from earlier cutoffs alone.

    Each point after ``split`` (by default the middle cutoff of its series) is judged by the errors of all points up to it.
    """
    keys = list(keys)
    middle = F.lit(split) if split else F.percentile_approx(F.col("cutoff").cast("timestamp").cast("bigint"), 0.5).over(Window.partitionBy(*keys))
    day = F.lit(split) if split else F.timestamp_seconds(middle).cast("date")
    rows = points.withColumn("_split", day)
    bounds = error_quantiles(rows.where("cutoff <= _split"), keys, level).withColumnsRenamed({c: f"_{c}" for c in keys})
    held = rows.where("cutoff > _split")
    on = reduce(Column.__and__, [held[c].eqNullSafe(F.col(f"_{c}")) for c in keys], held["step"] == bounds["step"])
    inside = F.col("y").between(F.col("yhat") * F.col("low"), F.col("yhat") * F.col("high"))
    return held.join(bounds, on).groupBy(*(held[c] for c in keys)).agg(
        F.count("*").alias("points"), (F.count_if(inside) / F.count("*") * 100).alias("coverage_pct")
    ).withColumn("level_pct", F.lit(level * 100))
