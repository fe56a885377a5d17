"""Every operator as a query over one folder of the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions.calendar import date_key, day_range, warehouse_calendar
from .functions.holidays import holiday_calendar
from .operators import business as q
from .operators import cleaning as c
from .operators import context as x
from .operators import dashboards as d
from .operators import features as f
from .operators import forecasting as t
from .operators import insights as r
from .operators import measures as m
from .operators import piecewise as pw
from .operators import quality as v
from .operators import warehouse as w
from .plans.etl import run_etl
from .plans.forecast import run_forecast
from .plans.load import load_star
from .schemas import FEATURE_COLUMNS, LINE_COLUMNS
from .session import finished, shared_path, stored, stored_at, tune, workspace
from .sources import files
from .sources.files import Star
from .sources.tables import TradeTables

AS_OF = date(2021, 12, 31)  # day that recency counts from
LOADED_UNTIL = 20191231  # key of the last order date that the incremental load already has
SLICED_YEAR = 2020
EARLY_YEARS, LATE_YEARS = 10, 40  # shifts of the source's dates that leave the standard calendar
LINE_ID = ["order_id", "row_id"]
AUDIT = ["created_at", "updated_at"]

Query = Callable[[TradeTables], DataFrame]


def plain(df: DataFrame) -> DataFrame:
    """DECIMAL columns as DOUBLE, for comparison with other engines."""
    return df.select(
        *[F.col(field.name).cast("double") if isinstance(field.dataType, T.DecimalType) else F.col(field.name) for field in df.schema]
    )


# -- shared inputs ------------------------------------------------------------------------


def _raw(src: TradeTables) -> DataFrame:
    return src.raw_lines().transform(c.normalize_columns)


def _dated(src: TradeTables) -> DataFrame:
    return _raw(src).transform(c.dedupe_rows).transform(c.parse_dates_drop_bad)


def _numbers(src: TradeTables) -> DataFrame:
    return _dated(src).transform(c.coerce_numeric)


def _clean_file(src: TradeTables) -> str:
    path = shared_path(src.spark, "clean_sales")
    with workspace(src.spark):
        files.write_clean_sales(c.clean_sales(src.raw_lines()), path, compression="gzip")
    return path


def _raw_file(src: TradeTables) -> str:
    path = shared_path(src.spark, "raw_sales")
    with workspace(src.spark):
        files.write_raw_sales(src.raw_lines(), path, compression="gzip")
    return path


def _line_feature(step: Callable[[DataFrame], DataFrame], *columns: str, store: bool = False) -> Query:
    """A feature of every line, under the line's id; ``store`` for steps that read the lines several times."""

    def query(src: TradeTables) -> DataFrame:
        lines = src.line_items()
        return step(stored(lines, "lines") if store else lines).select(*LINE_ID, *columns)

    return query


def _staged(src: TradeTables) -> DataFrame:
    return stored(src.staging(), "staging")


def _stored_star(src: TradeTables) -> Star:
    """The star schema of all lines, built from staging and stored; staging is removed."""
    path = shared_path(src.spark, "star")
    with workspace(src.spark):
        staging = finished(src.spark, "staging", lambda: w.by_order(src.staging()), w.ORDER)
        customers = stored_at(w.dim_customers(staging), f"{path}/dim_customers")
        products = stored_at(w.dim_products(staging), f"{path}/dim_products")
        dates, modes = warehouse_calendar(day_range(src.spark)), w.dim_ship_mode(src.spark)
        fact = w.fact_lines(w.fact_source(staging), customers, products, modes, by_month=True)
        files.write_fact(fact, f"{path}/fact_sales", grouped=True)
    fact = src.spark.read.parquet(f"{path}/fact_sales")
    monthly = w.monthly_sales(fact, customers, products)
    return Star(fact, customers, products, dates, modes, monthly)


# -- sources and sinks --------------------------------------------------------------------


def read_raw_sales(src: TradeTables) -> DataFrame:
    return files.read_raw_sales(src.spark, _raw_file(src)).transform(c.normalize_columns)


def read_clean_sales(src: TradeTables) -> DataFrame:
    return _rounded(files.read_clean_sales(src.spark, _clean_file(src)))


def write_clean_sales(src: TradeTables) -> DataFrame:
    return read_clean_sales(src).groupBy("ship_mode").agg(F.count("*").alias("lines"))


def load_staging(src: TradeTables) -> DataFrame:
    return files.load_staging(src.spark, _clean_file(src)).groupBy("region", "category").agg(
        F.count("*").alias("lines"), F.sum("quantity").cast("bigint").alias("units")
    )


def write_star(src: TradeTables) -> DataFrame:
    path = shared_path(src.spark, "star")
    files.write_star(_stored_star(src), path, grouped=True)
    fact = files.read_star(src.spark, path).fact
    return fact.groupBy("order_year", "order_month").agg(
        F.count("*").alias("lines"), F.sum("net_sales").alias("net_sales")
    )


def write_forecast(src: TradeTables) -> DataFrame:
    path = shared_path(src.spark, "forecast")
    files.write_forecast(_forecast_table(src), path)
    return files.read_forecast(src.spark, path)


# -- cleaning -----------------------------------------------------------------------------


def normalized_columns(src: TradeTables) -> DataFrame:
    return src.raw_lines().transform(c.normalize_columns)


def select_known_columns(src: TradeTables) -> DataFrame:
    renamed = {"order_id": "invoice", "sales": "amount"}
    foreign = _raw(src).withColumnsRenamed(renamed)
    return c.rename_known_columns(foreign, {new: old for old, new in renamed.items()}).select(*LINE_COLUMNS)


# -- warehouse ----------------------------------------------------------------------------


def dim_ship_mode(src: TradeTables) -> DataFrame:
    """The dimension with the orders that refer to each mode."""
    orders = src.order_headers().groupBy("ship_mode").agg(F.count("*").alias("orders"))
    modes = w.dim_ship_mode(src.spark)
    return modes.join(orders, F.col("ship_mode_name") == F.col("ship_mode"), "left").select(
        "ship_mode_name", "avg_days", "cost_tier", F.coalesce("orders", F.lit(0)).alias("orders")
    )


def fact_dim_lookup(src: TradeTables) -> DataFrame:
    """Lines of the fact table under the natural keys that their keys stand for."""
    star = _stored_star(src)
    return (
        star.fact.join(star.customers.select("customer_sk", "customer_id"), "customer_sk")
        .join(star.products.select("product_sk", "product_id"), "product_sk")
        .join(F.broadcast(star.ship_modes.select("ship_mode_sk", "ship_mode_name")), "ship_mode_sk")  # four rows
        .select(*LINE_ID, "customer_id", "product_id", "ship_mode_name", "net_sales")
    )


def fact_incremental(src: TradeTables) -> DataFrame:
    batch = w.derive_fact(stored(src.staging(), "staging"))
    loaded = batch.where(F.col("order_date_sk") <= F.lit(LOADED_UNTIL))
    return w.new_lines(batch, loaded).select(*LINE_ID, "order_date_sk", "net_sales")


def fact_rejects(src: TradeTables) -> DataFrame:
    """Lines that cleaning left without a known ship mode, so that the load drops them."""
    staging = w.typed_staging(c.clean_sales(src.raw_lines()))
    rejected = w.rejected_lines(
        staging, w.dim_customers(staging), w.dim_products(staging), w.dim_ship_mode(src.spark)
    )
    return rejected.groupBy("missing", "value").agg(F.count("*").alias("lines"))


def load_star_twice(src: TradeTables) -> DataFrame:
    """Every customer's history and lines after loading the older lines, then all lines."""
    staging, path = _staged(src), shared_path(src.spark, "star")
    load_star(src.spark, staging.where(date_key("order_date") <= LOADED_UNTIL), path)
    star = load_star(src.spark, staging, path)
    lines = star.fact.groupBy("customer_sk").agg(F.count("*").alias("lines"), F.sum("net_sales").alias("net_sales"))
    products = star.fact.join(star.products, "product_sk").groupBy("customer_sk").agg(
        F.count_distinct("product_id").alias("products")
    )
    return (
        star.customers.join(lines, "customer_sk", "left").join(products, "customer_sk", "left")
        .select("customer_id", "customer_name", "region", "customer_ltv", "is_repeat", "lines", "net_sales", "products")
    )


# -- BI -----------------------------------------------------------------------------------


def _lines(**parts: bool) -> Query:
    return lambda src: src.sales_lines(**parts).withColumn(
        "shipping_days", F.date_diff("ship_date", "order_date")
    ) if parts.get("orders") or parts.get("customers") else src.sales_lines(**parts)


_PRODUCT_LINES = _lines(products=True)
_ORDER_LINES = _lines(orders=True)
_CUSTOMER_LINES = _lines(customers=True)
_ALL_LINES = _lines(customers=True, products=True)


def _measure(name: str, *by: str) -> Query:
    lines = _PRODUCT_LINES if by == ("category",) and name not in ("total_customers",) else _CUSTOMER_LINES
    return lambda src: m.measure_table(lines(src), by, [name])


def apply_slicers(src: TradeTables) -> DataFrame:
    lines = m.apply_slicers(
        _ALL_LINES(src),
        years=[2018, 2019],
        dates=(date(2018, 3, 1), date(2019, 9, 30)),
        segments=["BUILDING", "MACHINERY"],
        regions=["ASIA", "EUROPE"],
        categories=["ECONOMY", "PROMO"],
    )
    return m.measure_table(lines, ["region", "segment", "category"], ["total_revenue", "total_orders", "total_units"])


#: A month in the middle of two, over a leap day; and a year of two regions.
LEAP_RANGE = x.Slicers(dates=(date(2020, 2, 10), date(2020, 3, 20)))
FEBRUARY = x.Slicers(years=(2021,), dates=(date(2020, 2, 1), date(2021, 2, 28)), regions=("ASIA", "EUROPE"))
TWO_REGIONS = x.Slicers(years=(SLICED_YEAR,), regions=("ASIA", "EUROPE"))

_EVERY_LINE = lambda src: src.sales_lines(customers=True, products=True)


# -- forecasts ----------------------------------------------------------------------------


def _series(src: TradeTables) -> DataFrame:
    return t.monthly_series(src.sales_lines(orders=True))


def _forecast_table(src: TradeTables) -> DataFrame:
    return t.forecast_table(t.forecast_horizon(_series(src)))


def _rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """DOUBLE columns rounded: floating-point sums differ in the last bits between engines."""
    return df.select(
        *[F.round(field.name, places).alias(field.name) if isinstance(field.dataType, T.DoubleType) else F.col(field.name)
          for field in df.schema]
    )


def _whole_months(src: TradeTables, *keys: str) -> DataFrame:
    lines = src.sales_lines(orders=True, products=True) if keys else src.sales_lines(orders=True)
    return stored(t.monthly_series(lines, keys, drop_partial_last_month=True), "months")


def holiday_sales(src: TradeTables) -> DataFrame:
    """Sales on every public holiday of the years with orders, by actual day."""
    lines = src.sales_lines(orders=True)
    days = holiday_calendar(lines.select(F.year("order_date").alias("year")))
    on_day = m.measure_table(lines, ["order_date"], ["total_revenue", "total_units"])
    return days.join(on_day, F.col("day") == F.col("order_date"), "left").select(
        "year", "holiday", "day", "observed", "total_revenue", F.coalesce("total_units", F.lit(0)).alias("total_units")
    )


def piecewise_backtest(src: TradeTables) -> DataFrame:
    """Errors per category of the piecewise model beside those of the straight trend, over the same cutoffs."""
    series = _whole_months(src, "category")
    names = ["points", "mae", "mape_pct"]
    ours, theirs = (t.backtest_metrics(model.backtest_points(series, ["category"]), ["category"]) for model in (pw, t))
    straight = theirs.select("category", *[F.col(c).alias(f"straight_{c}") for c in names])
    return _rounded(ours.select("category", *names).join(straight, "category"), 4)


def interval_coverage(src: TradeTables) -> DataFrame:
    """How many held-out points of the categories' back-tests lie within the bounds learnt before them."""
    series = _whole_months(src, "category")
    points = pw.backtest_points(series, ["category"], horizon_days=31 * t.HORIZON_MONTHS).where(F.col("step") <= t.HORIZON_MONTHS)
    each = pw.interval_coverage(points, ["category"])
    return _rounded(each.groupBy("level_pct").agg(
        F.sum("points").alias("points"), (F.sum(F.col("points") * F.col("coverage_pct")) / F.sum("points")).alias("coverage_pct")
    ), 4)


def run_forecast_query(src: TradeTables) -> DataFrame:
    path = shared_path(src.spark, "forecast")
    lines = src.sales_lines(orders=True, products=True)
    run = run_forecast(lines, path)
    groups = t.forecast_table(run.groups, ["category"])
    return groups.unionByName(
        files.read_forecast(src.spark, path).withColumn("category", F.lit("all categories"))
    )


def monthly_trend_any_year(src: TradeTables) -> DataFrame:
    """Orders in years before and after the standard calendar."""
    early, late = (TradeTables(src.spark, src.folder, years) for years in (EARLY_YEARS, LATE_YEARS))
    stars = [t_.star(orders=True) for t_ in (early, late)]
    fact = stars[0].fact.unionByName(stars[1].fact)
    return q.monthly_trend(Star(fact)).join(
        q.yoy_growth(Star(fact)).select("year", F.col("net_revenue").alias("year_revenue")), "year"
    )


QUERIES: dict[str, Query] = {
    # sources and sinks
    "read_raw_sales": read_raw_sales,
    "read_clean_sales": read_clean_sales,
    "write_clean_sales": write_clean_sales,
    "load_staging": load_staging,
    "write_star": write_star,
    "write_forecast": write_forecast,
    "read_forecast": lambda src: t.forecast_total(write_forecast(src)),
    # cleaning
    "dedupe_rows": lambda src: c.dedupe_rows(_raw(src)),
    "dedupe_report": lambda src: c.dedupe_report(_raw(src)),
    "normalize_columns": normalized_columns,
    "select_known_columns": select_known_columns,
    "parse_dates_drop_bad": _dated,
    "coerce_numeric": lambda src: _numbers(src).select(*LINE_ID, "sales", "quantity", "discount", "profit"),
    "impute_median": lambda src: _rounded(
        c.impute_median(_numbers(src)).select(*LINE_ID, "sales", "quantity", "discount", "profit")
    ),
    "fill_unknown": lambda src: c.fill_unknown(_dated(src)).select(
        *LINE_ID, "ship_mode", "region", "city", "postal_code"
    ),
    "rejected_input": lambda src: c.clean_with_rejects(src.raw_lines()).rejects().groupBy("reason", "field", "value").agg(
        F.count("*").alias("different_rows"), F.sum("copies").alias("copies")
    ),
    "cleaning_balance": lambda src: c.clean_with_rejects(src.raw_lines()).balance(),
    "clean_with_rejects": lambda src: _rounded(c.clean_with_rejects(src.raw_lines()).lines),
    "clean_sales": lambda src: _rounded(c.clean_sales(src.raw_lines())),
    # features
    "date_parts": _line_feature(
        f.date_parts, "order_year", "order_month", "order_quarter", "order_week", "order_dow"
    ),
    "shipping_days": _line_feature(f.shipping_days, "shipping_days"),
    "profit_margin_pct": _line_feature(f.profit_margin_pct, "profit_margin_pct"),
    "discounted_revenue": _line_feature(f.discounted_revenue, "discounted_revenue"),
    "cogs": _line_feature(f.cogs, "cogs"),
    "customer_ltv": _line_feature(f.customer_ltv, "customer_ltv", store=True),
    "customer_order_rank": _line_feature(f.customer_order_rank, "customer_order_rank", store=True),
    "is_repeat_customer": _line_feature(
        lambda df: df.transform(f.customer_order_rank).transform(f.is_repeat_customer),
        "is_repeat_customer",
        store=True,
    ),
    "sorted_output": lambda src: f.sorted_output(src.line_items()).select(*LINE_ID, "customer_id", "order_date"),
    "monthly_sales_growth": lambda src: f.monthly_sales_growth(f.date_parts(src.sales_lines(orders=True))),
    "attach_monthly_growth": _line_feature(
        lambda df: df.transform(f.date_parts).transform(f.attach_monthly_growth), "sales_growth_pct", store=True
    ),
    "revenue_per_unit": _line_feature(f.revenue_per_unit, "revenue_per_unit"),
    "is_high_value_order": _line_feature(f.is_high_value_order, "is_high_value_order", store=True),
    "is_loss_order": _line_feature(f.is_loss_order, "is_loss_order"),
    "enrich_sales": _line_feature(f.enrich_sales, *FEATURE_COLUMNS, store=True),
    # quality
    "validate_sales": lambda src: v.validate_sales(_ORDER_LINES(src)),
    "dq_nonneg_sales": lambda src: v.validate_sales(_ORDER_LINES(src), ["nonneg_sales"]),
    "dq_nonneg_quantity": lambda src: v.validate_sales(_ORDER_LINES(src), ["nonneg_quantity"]),
    "dq_order_date_present": lambda src: v.validate_sales(_ORDER_LINES(src), ["order_date_present"]),
    "dq_customer_id_present": lambda src: v.validate_sales(_ORDER_LINES(src), ["customer_id_present"]),
    "etl_summary": lambda src: v.etl_summary(
        stored(src.line_items(), "lines")
        .transform(f.profit_margin_pct)
        .transform(f.customer_order_rank)
        .transform(f.is_repeat_customer)
    ),
    "dq_constraints": lambda src: v.constraint_report(_stored_star(src)),
    "run_etl": lambda src: run_etl(
        src.spark, _raw_file(src), shared_path(src.spark, "etl"), compression="gzip"
    ),
    # warehouse
    "dim_date": lambda src: src.warehouse_calendar(),
    "dim_customers": lambda src: w.dim_customers(_staged(src)).drop("customer_sk", *AUDIT),
    "dim_products": lambda src: w.dim_products(_staged(src)).drop("product_sk", *AUDIT),
    "dim_ship_mode": dim_ship_mode,
    "fact_derive": lambda src: w.derive_fact(src.staging()),
    "fact_dim_lookup": fact_dim_lookup,
    "fact_incremental": fact_incremental,
    "fact_rejects": fact_rejects,
    "agg_monthly_sales": lambda src: (
        lambda star: w.monthly_sales(star.fact, star.customers, star.products)
    )(src.star(customers=True, products=True)),
    "load_star": load_star_twice,
    # business questions
    "monthly_trend_any_year": monthly_trend_any_year,
    "monthly_trend": lambda src: q.monthly_trend(src.star(orders=True)),
    "top_products": lambda src: q.top_products(src.star(products=True)),
    "region_performance": lambda src: q.region_performance(src.star(customers=True)),
    "category_margin": lambda src: q.category_margin(src.star(products=True)),
    "repeat_rate": lambda src: q.repeat_rate(src.star(orders=True)),
    "yoy_growth": lambda src: q.yoy_growth(src.star(orders=True)),
    "aov_segment_region": lambda src: q.aov_segment_region(src.star(customers=True)),
    "rfm_segments": lambda src: q.rfm_segments(src.star(customers=True), AS_OF),
    "rfm_customers": lambda src: q.rfm_customers(src.star(customers=True), AS_OF),
    "top_loss_products": lambda src: q.top_loss_products(src.star(products=True)),
    "discount_bands": lambda src: q.discount_bands(src.star()),
    "ship_mode_performance": lambda src: q.ship_mode_performance(src.star(orders=True)),
    "state_heatmap": lambda src: q.state_heatmap(src.star(customers=True)),
    "clv_tiers": lambda src: q.clv_tiers(src.star(customers=True)),
    "qoq_growth": lambda src: q.qoq_growth(src.star(orders=True, products=True)),
    "rolling_daily": lambda src: q.rolling_daily(src.star(orders=True)),
    "kpi_snapshot": lambda src: q.kpi_snapshot(src.star(orders=True)),
    # BI measures
    "bi_calendar": lambda src: src.report_calendar(),
    "calendar_join": lambda src: m.calendar_join(
        src.sales_lines(orders=True).select(
            F.col("order_id").cast("string").alias("order_id"), "product_sk", "order_date", "sales", "quantity"
        ),
        src.report_calendar(),
    ),
    "total_revenue": _measure("total_revenue", "segment"),
    "total_profit": _measure("total_profit", "segment"),
    "total_orders": _measure("total_orders", "category"),
    "total_units": _measure("total_units", "category"),
    "avg_order_value": _measure("avg_order_value", "region"),
    "profit_margin": _measure("profit_margin", "category"),
    "total_customers": _measure("total_customers", "region", "segment"),
    "avg_customer_ltv": _measure("avg_customer_ltv", "segment"),
    "revenue_per_customer": _measure("revenue_per_customer", "region"),
    "loss_lines": _measure("loss_lines", "category"),
    "high_discount_lines": _measure("high_discount_lines", "category"),
    "avg_shipping_days_measure": _measure("avg_shipping_days", "ship_mode"),
    "measure_table": lambda src: m.measure_table(_ALL_LINES(src), ["region", "category"]),
    "revenue_ly": lambda src: m.revenue_ly(src.sales_lines(orders=True)).drop("yoy_growth_pct"),
    "yoy_growth_measure": lambda src: m.revenue_ly(src.sales_lines(customers=True), ["region"]),
    "revenue_to_date": lambda src: m.revenue_to_date(src.sales_lines(orders=True)).drop("profit_ytd"),
    "profit_ytd": lambda src: m.revenue_to_date(src.sales_lines(orders=True)).select("order_date", "profit_ytd"),
    "period_cards": lambda src: m.period_cards(src.sales_lines(orders=True)),
    "repeat_customer_rate": lambda src: m.repeat_customer_rate(src.sales_lines(customers=True), ["region"]),
    "apply_slicers": apply_slicers,
    "revenue_ly_year_slicer": lambda src: x.sales_against_last_year(
        src.sales_lines(orders=True), x.Slicers(years=(SLICED_YEAR,))
    ).drop("yoy_growth_pct"),
    "yoy_growth_region_slicer": lambda src: x.sales_against_last_year(src.sales_lines(customers=True), TWO_REGIONS, ["region"], "quarter"),
    "yoy_growth_leap_range": lambda src: x.sales_against_last_year(src.sales_lines(customers=True), LEAP_RANGE, ["segment"]),
    "yoy_growth_february": lambda src: x.sales_against_last_year(_EVERY_LINE(src), FEBRUARY, ["category"], "total"),
    "yoy_growth_every_day": lambda src: x.sales_against_last_year(src.sales_lines(orders=True), grain="day"),
    "to_date_by_region": lambda src: x.to_date(src.sales_lines(customers=True), ["region"]),
    "to_date_by_category": lambda src: x.to_date(src.sales_lines(orders=True, products=True), ["category"]),
    "to_date_sliced": lambda src: x.to_date(_EVERY_LINE(src), ["segment"], LEAP_RANGE),
    # dashboards
    "kpi_cards": lambda src: d.kpi_cards(src.sales_lines(orders=True), SLICED_YEAR),
    "kpi_cards_range": lambda src: d.kpi_cards(src.sales_lines(orders=True), start=date(2020, 3, 5), end=date(2021, 2, 28)),
    "trend_line": lambda src: d.trend_line(src.sales_lines(orders=True)),
    "revenue_by_category": lambda src: d.revenue_by_category(_ALL_LINES(src), ["region"]),
    "state_map": lambda src: d.state_map(_CUSTOMER_LINES(src)),
    "region_columns": lambda src: d.region_columns(_CUSTOMER_LINES(src)),
    "state_matrix": lambda src: d.state_matrix(_CUSTOMER_LINES(src)),
    "state_scatter": lambda src: d.state_scatter(_CUSTOMER_LINES(src)),
    "top_n_products_bi": lambda src: d.top_n_products_bi(_PRODUCT_LINES(src)),
    "subcategory_treemap": lambda src: d.subcategory_treemap(_PRODUCT_LINES(src)),
    "discount_profit_scatter": lambda src: d.discount_profit_scatter(_PRODUCT_LINES(src)),
    "pricing_review": lambda src: d.pricing_review(_PRODUCT_LINES(src)),
    "category_share": lambda src: d.category_share(_PRODUCT_LINES(src)),
    "loss_makers": lambda src: d.loss_makers(_PRODUCT_LINES(src)),
    "seasonal_heatmap": lambda src: d.seasonal_heatmap(
        src.sales_lines(orders=True).withColumn("month_num", F.month("order_date"))
    ),
    "profit_waterfall": lambda src: d.profit_waterfall(src.sales_lines(orders=True, products=True)),
    "area_trend": lambda src: _rounded(d.area_trend(src.sales_lines(orders=True)), 2),
    "actuals_plus_forecast": lambda src: d.actuals_plus_forecast(_series(src), _forecast_table(src)),
    "profit_decomposition": lambda src: d.profit_decomposition(_ALL_LINES(src)),
    "loss_decomposition": lambda src: _rounded(d.loss_decomposition(_ALL_LINES(src))),
    # findings
    "segment_repeat_ltv": lambda src: r.segment_repeat_ltv(src.sales_lines(customers=True)),
    "loss_rate_by_discount": lambda src: r.loss_rate_by_discount(src.star()),
    "discount_profit_corr": lambda src: r.discount_profit_corr(src.star()),
    "seasonal_multiple": lambda src: r.seasonal_multiple(src.sales_lines(orders=True)),
    "region_extremes": lambda src: r.region_extremes(q.region_performance(src.star(customers=True))),
    "category_extremes": lambda src: r.category_extremes(src.star(products=True)),
    # forecasts
    "monthly_series": _series,
    "fit_trend_season": lambda src: _rounded(t.fit_trend_season(_series(src))),
    "forecast_horizon": lambda src: _rounded(t.forecast_horizon(_series(src)), 2).drop("last_month"),
    "backtest": lambda src: _rounded(t.backtest(_series(src)), 4),
    "backtest_points": lambda src: _rounded(t.backtest_points(_series(src)), 4),
    "backtest_metrics": lambda src: _rounded(t.backtest_metrics(t.backtest_points(_series(src))), 4),
    "grouped_forecast": lambda src: _rounded(
        t.grouped_forecast(src.sales_lines(orders=True, products=True)), 2
    ).drop("last_month"),
    "forecast_table": _forecast_table,
    "forecast_total": lambda src: t.forecast_total(_forecast_table(src)),
    "forecast_components": lambda src: _rounded(t.forecast_components(t.forecast_horizon(_series(src)))),
    "actual_vs_forecast": lambda src: _rounded(t.actual_vs_forecast(t.forecast_horizon(_series(src))), 2),
    "run_forecast": run_forecast_query,
    "holiday_sales": holiday_sales,
    "piecewise_forecast": lambda src: _rounded(pw.forecast_with_intervals(_whole_months(src, "category"), ["category"]), 4),
    "piecewise_backtest": piecewise_backtest,
    "interval_coverage": interval_coverage,
}

#: Queries that SQL does not express (a linear system per series); ``tests/test_piecewise.py`` compares them with numpy.
WITHOUT_SQL = {"piecewise_forecast", "piecewise_backtest", "interval_coverage"}


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    """One query over the tables in ``folder``."""
    return plain(QUERIES[name](TradeTables(tune(spark), folder)))
