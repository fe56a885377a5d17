"""Trend changes, holidays and intervals against numpy and written lists."""

import calendar
import math
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlens.functions.calendar import day_range
from orderlens.functions.holidays import EASTER_HOLIDAYS, US_HOLIDAYS, holiday_calendar, working_days
from orderlens.operators import forecasting as t
from orderlens.operators import piecewise as p
from orderlens.sources.tables import TradeTables

#: Thanksgiving, Memorial Day, Labor Day, Martin Luther King Jr. Day and Easter Sunday of ten years.
KNOWN = {
    2015: ("11-26", "05-25", "09-07", "01-19", "04-05"), 2016: ("11-24", "05-30", "09-05", "01-18", "03-27"),
    2017: ("11-23", "05-29", "09-04", "01-16", "04-16"), 2018: ("11-22", "05-28", "09-03", "01-15", "04-01"),
    2019: ("11-28", "05-27", "09-02", "01-21", "04-21"), 2020: ("11-26", "05-25", "09-07", "01-20", "04-12"),
    2021: ("11-25", "05-31", "09-06", "01-18", "04-04"), 2022: ("11-24", "05-30", "09-05", "01-17", "04-17"),
    2023: ("11-23", "05-29", "09-04", "01-16", "04-09"), 2024: ("11-28", "05-27", "09-02", "01-15", "03-31"),
}
NAMES = ("Thanksgiving", "Memorial Day", "Labor Day", "Martin Luther King Jr. Day", "Easter Sunday")


def test_holidays_of_ten_years(spark):
    years = spark.createDataFrame([(y,) for y in [*KNOWN, *KNOWN]], "year int")
    found = {(r.year, r.holiday): r for r in holiday_calendar(years, US_HOLIDAYS + EASTER_HOLIDAYS).collect()}
    for year, days in KNOWN.items():
        for name, day in zip(NAMES, days, strict=True):
            assert found[year, name].day == found[year, name].observed == date.fromisoformat(f"{year}-{day}")
        assert found[year, "Good Friday"].day == found[year, "Easter Sunday"].day - timedelta(days=2)
        assert found[year, "Christmas Day"].day == date(year, 12, 25)
        assert ((year, "Juneteenth") in found) == (year >= 2021)
    assert found[2021, "Independence Day"].observed == date(2021, 7, 5)
    assert found[2020, "Independence Day"].observed == date(2020, 7, 3)
    assert len(found) == len({(r.year, r.holiday) for r in found.values()}) == 10 * 13 + 4


def test_working_days(spark):
    days = day_range(spark, date(2021, 1, 1), date(2022, 12, 31))
    months = {r.ds: r.working_days for r in working_days(days, holiday_calendar(days.select(F.year("full_date").alias("year")))).collect()}
    assert len(months) == 24 and months[date(2021, 2, 1)] == 19 and months[date(2021, 3, 1)] == 23 and months[date(2021, 12, 1)] == 21


def days(d):
    return calendar.monthrange(d.year, d.month)[1]


def numpy_model(rows, work):
    """Ridge weights and a forecast function of (month, y) rows."""
    first = rows[0][0]
    number = lambda d: d.year * 12 + d.month
    span = number(rows[-1][0]) - number(first) + 1

    def x(d):
        at = (number(d) - number(first)) / span
        hinges = [max(0.0, at - p.CHANGEPOINT_SHARE * j / (p.CHANGEPOINTS + 1)) for j in range(1, p.CHANGEPOINTS + 1)]
        waves = [f(2 * math.pi * k * d.month / 12) for k in range(1, p.WAVES + 1) for f in (math.sin, math.cos)]
        return np.array([1.0, at, *hinges, *waves, (work[d] - p.USUAL_WORKING_DAYS) / p.USUAL_WORKING_DAYS])

    m = np.array([x(d) for d, _ in rows])
    w = np.linalg.solve(m.T @ m + np.diag(p.PENALTIES), m.T @ np.log([y / days(d) for d, y in rows]))
    return w, lambda d: math.exp(x(d) @ w) * days(d)


def months(n, start=2015):
    return [date(start + i // 12, i % 12 + 1, 1) for i in range(n)]


def series_of(spark, values, key="a"):
    return spark.createDataFrame([(key, d, float(y)) for d, y in zip(months(len(values)), values, strict=True)], "key string, ds date, y double")


def noisy(n, seed=1, broken=None):
    rng = np.random.default_rng(seed)
    level = [1000 * math.exp(0.003 * i + (0.02 * (i - broken) if broken and i > broken else 0)) for i in range(n)]
    return [v * days(d) * (1 + 0.2 * math.sin(i * math.pi / 6)) * math.exp(rng.normal(0, 0.03)) for i, (v, d) in enumerate(zip(level, months(n), strict=True))]


def test_equals_numpy(spark):
    a, b = noisy(50), noisy(9, 2)
    frame = series_of(spark, a).unionAll(series_of(spark, b, "b")).unionAll(series_of(spark, [0.0, -1.0], "none"))
    span = day_range(spark, date(2015, 1, 1), date(2020, 12, 31))
    work = {r.ds: r.working_days for r in working_days(span, holiday_calendar(span.select(F.year("full_date").alias("year")))).collect()}
    weights = {r.key: r.weights for r in p.fit(frame, ["key"]).collect()}
    ahead = {(r.key, r.ds): r.yhat for r in p.forecast(frame, ["key"]).collect()}
    assert set(weights) == {"a", "b"} and len(ahead) == 50 + 9 + 12
    for key, values in (("a", a), ("b", b)):
        w, forecast = numpy_model(list(zip(months(len(values)), values, strict=True)), work)
        assert weights[key] == pytest.approx(list(w), rel=1e-7, abs=1e-9)
        for d in months(len(values) + 6):
            assert ahead[key, d] == pytest.approx(forecast(d), rel=1e-9)


def test_a_break_in_the_trend_is_forecast_within_its_interval(spark):
    values = noisy(90, broken=30)
    known = series_of(spark, values[:84])
    ahead = {r.ds: r for r in p.forecast_with_intervals(known, ["key"]).collect()}
    straight = {r.ds: r.yhat for r in t.forecast_horizon(known, ["key"]).where("ds > last_month").collect()}
    assert len(ahead) == 6
    truth = dict(list(zip(months(90), values, strict=True))[84:])
    assert all(ahead[d].yhat_lower <= y <= ahead[d].yhat_upper for d, y in truth.items())
    assert sum(abs(ahead[d].yhat / y - 1) for d, y in truth.items()) < sum(abs(straight[d] / y - 1) for d, y in truth.items())
    widths = [ahead[d].yhat_upper / ahead[d].yhat - ahead[d].yhat_lower / ahead[d].yhat for d in sorted(ahead)]
    assert all(b >= a - 1e-9 for a, b in zip(widths, widths[1:], strict=False)) and [ahead[d].step for d in sorted(ahead)] == [1, 2, 3, 4, 5, 6]


def test_backtest_is_no_worse_than_the_straight_trend(spark):
    series = t.monthly_series(TradeTables(spark, "/root/testdata/sf0.01").sales_lines(orders=True), drop_partial_last_month=True)
    ours, theirs = p.backtest_points(series), t.backtest_points(series)
    assert {(r.cutoff, r.ds) for r in ours.collect()} == {(r.cutoff, r.ds) for r in theirs.collect()}
    a, b = (t.backtest_metrics(points, []).first() for points in (ours, theirs))
    assert a.mape_pct <= b.mape_pct and a.mae <= b.mae


def test_coverage_of_held_out_months(spark):
    frame = series_of(spark, noisy(96, 3)).unionAll(series_of(spark, noisy(90, 4), "b"))
    points = p.backtest_points(frame, ["key"], horizon_days=186)
    pooled = p.interval_coverage(points.withColumn("step", F.lit(1)), level=0.9).first()
    assert pooled.level_pct == 90 and abs(pooled.coverage_pct - 90) <= 10
    assert p.interval_coverage(points, ["key"]).count() == 2


def test_short_and_empty_series(spark):
    assert p.forecast(series_of(spark, noisy(5)), ["key"]).count() == 0
    empty = series_of(spark, [])
    assert p.forecast(empty, ["key"]).count() == p.backtest_points(empty, ["key"]).count() == p.forecast_with_intervals(empty).count() == 0
    short = p.forecast_with_intervals(series_of(spark, noisy(8)), ["key"]).collect()
    assert len(short) == 6 and all(r.yhat > 0 and r.yhat_lower is None for r in short)
