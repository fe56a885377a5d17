"""Forecasts of series whose answer is known."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from orderlens.operators import forecasting as t
from orderlens.plans.forecast import run_forecast
from orderlens.session import shared_path
from orderlens.sources.files import read_forecast
from helpers import line, staging

# Mean 1 over a year.
SEASON = [0.8, 0.9, 1.0, 1.1, 1.2, 1.0, 0.9, 0.8, 1.0, 1.1, 1.0, 1.2]


def series(spark, months, key="a", level=1000.0, slope=0.0):
    rows = [
        (key, date(2015 + i // 12, i % 12 + 1, 1), (level + slope * i) * SEASON[i % 12]) for i in range(months)
    ]
    return spark.createDataFrame(rows, "key string, ds date, y double")


def test_exact_season_is_continued(spark):
    forecast = t.forecast_horizon(series(spark, 48), ["key"])
    ahead = t.forecast_table(forecast, ["key"]).orderBy("forecast_month").collect()
    assert [x.forecast_month for x in ahead] == [date(2019, i, 1) for i in range(1, 7)]
    # The season leans on the fitted line a little, so the fit is close, not perfect.
    for row, index in zip(ahead, SEASON):
        assert row.predicted_sales == pytest.approx(1000 * index, rel=0.05)
        assert row.lower_bound <= row.predicted_sales <= row.upper_bound


def test_series_do_not_mix(spark):
    alone = t.forecast_horizon(series(spark, 30), ["key"])
    both = t.forecast_horizon(series(spark, 30).unionAll(series(spark, 20, "b", 50.0, 3.0)), ["key"])
    a = sorted(map(tuple, alone.collect()), key=str)
    assert sorted(map(tuple, both.where("key = 'a'").collect()), key=str) == a
    assert both.where("key = 'b'").count() == 26


def test_short_series_are_left_out(spark):
    assert t.forecast_horizon(series(spark, 5), ["key"], min_months=6).count() == 0
    assert t.backtest(series(spark, 17), ["key"]).count() == 0
    assert t.backtest(series(spark, 18), ["key"]).count() == 1


def test_months_never_seen_have_index_one(spark):
    ahead = t.forecast_horizon(series(spark, 6), ["key"]).where("ds > last_month").collect()
    assert [x.seasonal_index for x in ahead] == [1.0] * 6


def test_a_falling_series_keeps_a_small_forecast(spark):
    falling = series(spark, 24, level=1000.0, slope=-43.0)
    ahead = t.forecast_horizon(falling, ["key"]).where("ds > last_month").orderBy("ds").collect()
    assert len(ahead) == 6 and all(0 < x.trend and 0 < x.yhat for x in ahead)
    assert ahead[-1].trend == pytest.approx(0.01 * falling.agg(F.avg("y")).first()[0])
    assert t.forecast_total(t.forecast_table(t.forecast_horizon(falling, ["key"]))).first().total_forecast > 0


def test_backtest_counts_what_it_missed(spark):
    """A series that falls and then stays low: every month has a forecast and an error."""
    rows_ = [("a", date(2015 + i // 12, i % 12 + 1, 1), max(5.0, 200.0 - 8 * i)) for i in range(48)]
    points = t.backtest_points(spark.createDataFrame(rows_, "key string, ds date, y double"), ["key"])
    whole = t.backtest_metrics(points, ["key"]).first()
    assert whole.points == points.count() and whole.unforecast == 0 and whole.mae > 0
    ahead = t.backtest_metrics(points).collect()
    assert sum(x.points for x in ahead) == whole.points and all(x.mae >= 0 for x in ahead)


def test_backtest_cutoffs(spark):
    result = t.backtest(series(spark, 48, slope=2.0), ["key"]).first()
    # 2018-12-01 less 90 days, back by 30 days while 864 days of history remain.
    assert result.folds == 16
    assert result.mape_pct < 6 and result.mae <= result.rmse


def test_partial_last_month(spark):
    lines = staging(
        spark, line(order_date=date(2020, 1, 31)), line(order_date=date(2020, 2, 10)), line(order_date=date(2020, 3, 5), sales=0)
    )
    assert [x.ds.month for x in t.monthly_series(lines).orderBy("ds").collect()] == [1, 2]
    assert [x.ds.month for x in t.monthly_series(lines, drop_partial_last_month=True).collect()] == [1]


def test_run_forecast_writes_its_table(spark):
    lines = staging(spark, *[line(order_date=date(2015 + i // 12, i % 12 + 1, 5), order_id=f"O{i}", sales=100 + i,
                                  category="F" if i % 2 else "T") for i in range(36)])
    path = shared_path(spark, "forecast")
    run = run_forecast(lines, path)
    assert read_forecast(spark, path).count() == 6
    assert run.errors.count() == 1 and run.groups.select("category").distinct().count() == 2
    assert t.forecast_total(run.table).first().total_forecast > 600
