"""Order lines to forecasts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators.forecasting import backtest, forecast_horizon, forecast_table, grouped_forecast, monthly_series
from ..session import stored
from ..sources.files import write_forecast


@dataclass(frozen=True)
class ForecastRun:
    series: DataFrame
    forecast: DataFrame
    errors: DataFrame
    groups: DataFrame
    table: DataFrame


def run_forecast(lines: DataFrame, path: str | None = None, group: str = "category") -> ForecastRun:
    """Forecast total and grouped monthly sales, back-test, and write the table if ``path`` is given.

    The monthly series is stored once, when called; forecast, table and back-test read it from there.
    """
    series = stored(monthly_series(lines), "monthly_series")
    forecast = forecast_horizon(series)
    table = forecast_table(forecast)
    if path:
        write_forecast(table, path)
    return ForecastRun(series, forecast, backtest(series), grouped_forecast(lines, [group]), table)
