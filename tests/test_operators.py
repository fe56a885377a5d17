"""Cases that the given tables do not contain."""

import os
from datetime import date
from decimal import Decimal

import duckdb
import pytest
from helpers import fact, line, rows, staging
from pyspark.sql import Window
from pyspark.sql import functions as F

from orderlens.functions.calendar import date_of_key, day_range, report_calendar, warehouse_calendar
from orderlens.functions.labels import clv_tier, discount_band, rfm_segment
from orderlens.operators import business as q
from orderlens.operators import cleaning as c
from orderlens.operators import dashboards as d
from orderlens.operators import features as f
from orderlens.operators import insights as r
from orderlens.operators import measures as m
from orderlens.operators import quality as v
from orderlens.operators import warehouse as w
from orderlens.plans.etl import run_etl
from orderlens.registry import run
from orderlens.schemas import ENRICHED_SCHEMA, RAW_HEADER
from orderlens.session import shared_dir, shared_path, workspace
from orderlens.sources import files
from orderlens.sources.files import Star


# -- labels -------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "rate, as_written, contiguous",
    [
        ("0", "0% — No Discount", "0% — No Discount"),
        ("0.005", "50%+", "1-10%"),
        ("0.1", "1-10%", "1-10%"),
        ("0.105", "50%+", "11-20%"),
        ("0.2", "11-20%", "11-20%"),
        ("0.5", "31-50%", "31-50%"),
        ("0.51", "50%+", "50%+"),
    ],
)
def test_discount_band_keeps_its_gaps(spark, rate, as_written, contiguous):
    df = spark.createDataFrame([(Decimal(rate),)], "rate decimal(5,4)")
    found = df.select(discount_band(F.col("rate")), discount_band(F.col("rate"), "contiguous")).first()
    assert tuple(found) == (as_written, contiguous)


def test_clv_tier_bounds(spark):
    df = spark.createDataFrame([(5000.0,), (4999.99,), (1000.0,), (500.0,), (499.99,)], "v double")
    found = [row[0].split()[0] for row in df.select(clv_tier(F.col("v"))).collect()]
    assert found == ["Platinum", "Gold", "Silver", "Bronze", "Standard"]


def test_rfm_segment_first_rule_wins(spark):
    cases = {
        (5, 5, 5): "Champions", (5, 5, 1): "Loyal Customers", (5, 1, 5): "Recent Customers",
        (1, 4, 4): "At Risk", (1, 1, 5): "Lost", (3, 2, 4): "Big Spenders", (3, 2, 1): "Potential Loyalists",
    }
    df = spark.createDataFrame(list(cases), "r int, f int, m int")
    found = {(x.r, x.f, x.m): x.s for x in df.withColumn("s", rfm_segment(F.col("r"), F.col("f"), F.col("m"))).collect()}
    assert found == cases


# -- calendars ----------------------------------------------------------------------------


def test_warehouse_calendar(spark):
    calendar = warehouse_calendar(day_range(spark))
    assert calendar.count() == 4018
    leap = calendar.where("date_sk = 20160229").first()
    assert (leap.day_name, leap.month_name, leap.day_of_year, leap.fiscal_quarter) == ("Monday", "February", 60, "FY16Q1")
    assert calendar.where("date_sk = 20210101").first().week_of_year == 53
    assert calendar.where("is_weekend AND day_of_week < 6").count() == 0
    assert calendar.where(F.col("full_date") != date_of_key("date_sk")).count() == 0


def test_report_calendar_weeks_start_on_sunday(spark):
    calendar = {x.date: x for x in report_calendar(day_range(spark, date(2017, 1, 1), date(2018, 12, 31))).collect()}
    assert calendar[date(2017, 1, 1)].week == 1 and calendar[date(2017, 1, 7)].week == 1
    assert calendar[date(2017, 1, 8)].week == 2 and calendar[date(2018, 1, 7)].week == 2
    assert calendar[date(2018, 1, 7)].weekday == "Sun" and calendar[date(2018, 1, 7)].quarter == "Q1"


# -- cleaning -----------------------------------------------------------------------------


def test_clean_sales(spark):
    raw = spark.createDataFrame(
        [
            ("1", "A", "1/2/2015", "2015-01-05", None, "10", "3"),
            ("1", "A", "1/2/2015", "2015-01-05", None, "10", "3"),
            ("2", "B", "2015-02-28", "2015-03-01", "First Class", "N/A", None),
            ("3", "C", "bad", "2015-03-01", "First Class", "99", "4"),
            ("4", "D", "2015-02-28", None, "First Class", "99", "4"),
            ("5", "E", " 2015-02-28 ", "2015-03-01", "First Class", "NaN", "8"),
            ("6", "F", "2015-02-28", "2015-03-01", "First Class", "20", "1"),
        ],
        ["Row ID", " Order-ID", "Order Date", "Ship Date", "Ship Mode", "Sales", "Quantity"],
    )
    report = c.dedupe_report(raw).first()
    assert (report.rows_before, report.rows_after, report.removed) == (7, 6, 1)
    cleaned = c.clean_sales(raw)
    assert cleaned.columns == ["row_id", "order_id", "order_date", "ship_date", "ship_mode", "sales", "quantity"]
    assert rows(cleaned.select("row_id", "order_date", "ship_mode", "sales", "quantity"), "row_id") == [
        (1, date(2015, 1, 2), "Unknown", 10.0, 3),
        (2, date(2015, 2, 28), "First Class", 15.0, 3),
        (5, date(2015, 2, 28), "First Class", 15.0, 8),
        (6, date(2015, 2, 28), "First Class", 20.0, 1),
    ]


def test_impute_median_options(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (None, 3.0), (9, 4.0)], "a int, b double")
    assert rows(c.impute_median(df), "b") == [(1.0, 1.0), (2.0, 3.0), (2.0, 3.0), (9.0, 4.0)]
    assert rows(c.impute_median(df, ["b"]).select("b"), "b") == [(1.0,), (3.0,), (3.0,), (4.0,)]
    assert c.impute_median(df, approximate=True).where("a IS NULL OR b IS NULL").count() == 0


# -- features -----------------------------------------------------------------------------


def test_features_of_odd_lines(spark):
    lines = staging(
        spark,
        line(row_id=1, sales=0, profit=-5, quantity=0),
        line(row_id=2, sales="10.00", profit="3.33", quantity=0, discount="0.15"),
        line(row_id=3, order_id="O2", order_date=date(2020, 3, 1), ship_date=date(2020, 3, 1), sales=30, quantity=4),
        line(row_id=4, order_id="O3", order_date=date(2020, 4, 1), sales=0, customer_id="C2"),
        line(row_id=5, order_id="O4", order_date=date(2020, 5, 1), sales=5, customer_id="C2"),
    )
    enriched = {x.row_id: x for x in f.enrich_sales(lines).collect()}
    assert [enriched[i].profit_margin_pct for i in (1, 2)] == [0.0, 33.3]
    assert [enriched[i].revenue_per_unit for i in (1, 2, 3)] == [0.0, 10.0, 7.5]
    assert enriched[2].discounted_revenue == Decimal("8.50") and enriched[2].cogs == Decimal("6.67")
    assert [enriched[i].customer_order_rank for i in range(1, 6)] == [1, 2, 3, 1, 2]
    assert [enriched[i].is_repeat_customer for i in range(1, 6)] == [0, 1, 1, 0, 1]
    assert enriched[1].customer_ltv == Decimal("40.00") and enriched[5].customer_ltv == Decimal("5.00")
    # First month, growth on January over a month without lines, to zero sales, and after zero sales.
    assert [enriched[i].sales_growth_pct for i in (1, 3, 4, 5)] == [0.0, 200.0, -100.0, 0.0]
    assert [enriched[i].is_high_value_order for i in range(1, 6)] == [0, 0, 1, 0, 0]
    assert [enriched[i].is_loss_order for i in range(1, 6)] == [1, 0, 0, 0, 0]
    approximate = f.is_high_value_order(lines, approximate=True)
    assert rows(approximate.where("is_high_value_order = 1").select("row_id")) == [(3,)]
    assert enriched[3].shipping_days == 0 and enriched[3].order_dow == "Sunday"


def test_rank_of_a_customer_with_very_many_lines(spark):
    lines = staging(spark, *[line(row_id=i, order_id=f"O{i % 7}", customer_id="C1" if i % 3 else f"D{i}") for i in range(60)])
    order = Window.partitionBy("customer_id").orderBy("order_date", "order_id", "row_id")
    plain = rows(lines.select("row_id", F.row_number().over(order)), "row_id")
    assert plain == rows(f.customer_order_rank(lines).select("row_id", "customer_order_rank"), "row_id")


# -- quality ------------------------------------------------------------------------------


def test_validate_sales(spark):
    broken = staging(spark, line(sales=-1, quantity=-2), line(order_date=None), line(customer_id=None, sales=None))
    assert rows(v.validate_sales(broken), "rule") == [
        ("customer_id_present", 1, False),
        ("nonneg_quantity", 1, False),
        ("nonneg_sales", 1, False),
        ("order_date_present", 1, False),
    ]
    with pytest.raises(ValueError, match="nonneg_sales: 1"):
        v.validate_sales(broken, strict=True)
    assert v.validate_sales(staging(spark, line()), strict=True).where("passed").count() == 4


def test_constraint_report_finds_violations(spark):
    star = fact(spark, line(), line(order_date=date(2030, 1, 1)), line(row_id=2, customer_id="C2"))
    lost = files.Star(star.fact, star.customers.where("customer_id = 'C1'"), star.products.unionAll(star.products),
                      star.dates, star.ship_modes)
    found = {x.rule: x.violations for x in v.constraint_report(lost).where("NOT passed").collect()}
    assert found == {
        "dim_products.product_sk unique": 1,
        "dim_products.product_id unique": 1,
        "fact_sales.order_id,row_id unique": 1,
        "fact_sales.order_date_sk resolves": 1,
        "fact_sales.customer_sk resolves": 1,
    }


# -- business questions -------------------------------------------------------------------


def test_top_products_ties_go_by_name(spark):
    star = fact(spark, *[line(row_id=i, product_id=f"P{i}", product_name=f"item {i:02d}") for i in range(20, 0, -1)])
    assert [x.product_name for x in q.top_products(star).collect()] == [f"item {i:02d}" for i in range(1, 11)]


def test_products_that_share_a_name_merge(spark):
    star = fact(spark, line(), line(row_id=2, product_id="P2"), line(row_id=3, product_id="P3", sub_category="Desks"))
    found = rows(q.top_products(star).select("sub_category", "total_revenue"), "sub_category")
    assert found == [("Chairs", 200.0), ("Desks", 100.0)]


def test_rfm_of_few_customers(spark):
    star = fact(spark, line(), line(row_id=2, order_id="O2", customer_id="C2", order_date=date(2020, 2, 1), sales=500))
    found = rows(q.rfm_customers(star, date(2020, 3, 1)).select("customer_id", "recency_days", "r_score", "f_score", "m_score"), "customer_id")
    assert found == [("C1", 46, 2, 1, 2), ("C2", 29, 1, 2, 1)]
    standard = rows(q.rfm_customers(star, date(2020, 3, 1), "standard").select("customer_id", "r_score", "m_score"), "customer_id")
    assert standard == [("C1", 1, 1), ("C2", 2, 2)]


def test_rolling_frames_over_a_gap(spark):
    days = [1, 2, 20]
    star = fact(spark, *[line(row_id=i, order_id=f"O{i}", order_date=date(2020, 1, i), sales=i) for i in days])
    by_rows = [x.rolling_7d_revenue for x in q.rolling_daily(star).collect()]
    by_days = [x.rolling_7d_revenue for x in q.rolling_daily(star, frame="calendar").collect()]
    assert by_rows == [1.0, 1.5, 7.67] and by_days == [1.0, 1.5, 20.0]


def test_ratios_over_zero_are_null(spark):
    star = fact(spark, line(sales=0, profit=0))
    region = q.region_performance(star).first()
    assert region.profit_margin_pct is None and region.avg_order_value == 0.0
    assert q.kpi_snapshot(star).first().overall_margin_pct is None


def test_growth_on_a_loss_uses_its_size(spark):
    star = fact(spark, line(profit=-10), line(row_id=2, order_id="O2", order_date=date(2021, 1, 1), profit=5))
    last = q.yoy_growth(star).collect()[-1]
    assert last.yoy_profit_growth_pct == 150.0 and last.yoy_revenue_growth_pct == 0.0


def test_loss_rate_by_order(spark):
    star = fact(spark, line(discount="0.4", profit=-10), line(row_id=2, discount="0.4", profit=30),
                line(row_id=3, discount="0.3", profit=-1))
    assert tuple(r.loss_rate_by_discount(star).first()) == (2, 1, 50.0)
    assert tuple(r.loss_rate_by_discount(star, by_order=True).first()) == (1, 0, 0.0)


# -- measures -----------------------------------------------------------------------------


def test_measures_of_nothing(spark):
    lines = f.shipping_days(staging(spark, line())).where("false")
    found = m.measure_table(lines).first().asDict()
    assert found["total_orders"] == 0 and found["avg_order_value"] == 0.0 and found["profit_margin"] == 0.0
    assert found["avg_shipping_days"] is None


def test_totals_recompute_distinct_orders(spark):
    lines = staging(spark, line(state="Ohio"), line(row_id=2, state="Iowa"), line(row_id=3, order_id="O2", state="Iowa"))
    found = rows(d.state_matrix(lines).select("state", "level", "total_orders", "total_revenue"), "level", "state")
    assert found == [("Iowa", 0, 2, 200.0), ("Ohio", 0, 1, 100.0), (None, 1, 2, 300.0)]


def test_year_ago_needs_that_very_month(spark):
    days = [date(2018, 1, 1), date(2019, 1, 1), date(2019, 2, 1), date(2021, 1, 1)]
    lines = staging(spark, *[line(row_id=i, order_id=f"O{i}", order_date=day, sales=10 * (i + 1)) for i, day in enumerate(days)])
    found = rows(m.revenue_ly(lines), "year", "month_num")
    assert found == [(2018, 1, 10.0, None, None), (2019, 1, 20.0, 10.0, 100.0), (2019, 2, 30.0, None, None), (2021, 1, 40.0, None, None)]


def test_period_cards_after_the_last_order(spark):
    lines = staging(spark, line(), line(row_id=2, order_date=date(2020, 2, 10)))
    assert tuple(m.period_cards(lines).first()) == (date(2020, 2, 10), 100.0, 200.0, 200.0, 20.0)
    assert tuple(m.period_cards(lines, date(2020, 4, 2)).first()) == (date(2020, 4, 2), 0.0, 0.0, 200.0, 20.0)


def test_slicers(spark):
    lines = staging(spark, line(), line(row_id=2, region="West"), line(row_id=3, order_date=date(2021, 5, 1)))
    assert rows(m.apply_slicers(lines, regions=["West"]).select("row_id")) == [(2,)]
    assert rows(m.apply_slicers(lines, years=[2021]).select("row_id")) == [(3,)]
    assert m.apply_slicers(lines).count() == 3
    assert m.apply_slicers(lines, dates=(date(2020, 1, 1), date(2020, 1, 15)), segments=["Consumer"]).count() == 2


def test_kpi_cards(spark):
    lines = staging(spark, line(), line(row_id=2, order_id="O2", order_date=date(2019, 6, 1), sales=50, profit=-5))
    assert tuple(d.kpi_cards(lines, 2020).first()) == (100.0, 10.0, 10.0, 1, 100.0)
    assert tuple(d.kpi_cards(lines).first()) == (150.0, 5.0, 3.33, 2, 0.0)
    assert d.kpi_cards(lines, 2019).first().yoy_growth_pct is None


def test_group_sums_equal_the_snapshot(spark):
    star = fact(spark, *[line(row_id=i, order_id=f"O{i % 5}", customer_id=f"C{i % 3}", region=f"R{i % 3}",
                             sales=i, discount="0.1", profit=i - 9) for i in range(1, 30)])
    snapshot = q.kpi_snapshot(star).first()
    regions = q.region_performance(star).collect()
    assert sum(x.net_revenue for x in regions) == pytest.approx(snapshot.total_net_revenue)
    assert sum(x.total_profit for x in regions) == pytest.approx(snapshot.total_profit)


# -- files and pipeline -------------------------------------------------------------------


def test_etl_reads_latin1_and_writes_typed_lines(spark, tmp_path):
    header = ("Row ID,Order ID,Order Date,Ship Date,Ship Mode,Customer ID,Customer Name,Segment,Country,City,State,"
              "Postal Code,Region,Product ID,Category,Sub-Category,Product Name,Sales,Quantity,Discount,Profit\n")
    body = "".join(
        f"{i},O{i},{i}/3/2016,2016-12-01,First Class,C{i % 2},José,Consumer,US,Köln,Ohio,1,East,P1,F,Chairs,"
        f"\"Chair, big\",{i}.5,2,0.2,{i}\n" for i in range(1, 6)
    )
    source = tmp_path / "raw.csv"
    source.write_bytes((header + body).encode("latin-1"))
    target = shared_path(spark, "etl")
    summary = run_etl(spark, str(source), target)
    assert tuple(summary.first()) == (date(2016, 1, 3), date(2016, 5, 3), 5, 2, 17.5, 15.0, 82.44, 60.0)
    lines = files.read_raw_sales(spark, target)
    assert lines.first().customer_name is not None and lines.count() == 5 and len(lines.columns) == 37
    assert files.read_raw_sales(spark, str(source)).first()["Customer Name"] == "José"


def test_etl_stops_on_broken_rules(spark, tmp_path):
    source = tmp_path / "raw.csv"
    source.write_text("Order ID,Customer ID,Order Date,Ship Date,Sales,Quantity,Discount,Profit\nA,B,1/1/2016,1/2/2016,-5,1,0,1\n")
    with pytest.raises(ValueError, match="nonneg_sales"):
        run_etl(spark, str(source), shared_path(spark, "etl"))


def test_unknown_ship_mode_is_rejected(spark):
    lines = staging(spark, line(), line(row_id=2, ship_mode="Unknown"))
    customers, products, modes = w.dim_customers(lines), w.dim_products(lines), w.dim_ship_mode(spark)
    assert w.lookup_keys(w.derive_fact(lines), customers, products, modes).count() == 1
    assert rows(w.rejected_lines(lines, customers, products, modes)) == [("O1", 2, "ship_mode", "Unknown")]


def test_fact_of_odd_lines(spark):
    derived = {x.row_id: x for x in w.derive_fact(staging(spark, line(row_id=1, sales=0, quantity=0), line(row_id=2, sales="10.00", quantity=3, discount="0.125"))).collect()}
    assert derived[1].profit_margin_pct == 0 and derived[1].unit_price == 0
    assert (derived[2].unit_price, derived[2].net_sales) == (Decimal("3.33"), Decimal("8.75"))


# -- years outside the standard calendar ----------------------------------------------------


def test_lines_of_any_year_count_everywhere(spark):
    early, late = date(2014, 12, 31), date(2030, 6, 1)
    star = fact(
        spark, line(order_date=early, ship_date=early), line(row_id=2, order_id="O2", order_date=late, ship_date=late, sales=50)
    )
    snapshot = q.kpi_snapshot(star).first()
    assert sum(x.total_orders for x in q.monthly_trend(star).collect()) == snapshot.total_orders == 2
    for found in (q.monthly_trend(star), q.yoy_growth(star), q.qoq_growth(star)):
        assert sum(x.net_revenue for x in found.collect()) == snapshot.total_net_revenue == 150
    assert sum(x.daily_revenue for x in q.rolling_daily(star).collect()) == 150
    monthly = w.monthly_sales(star.fact, star.customers, star.products)
    assert sum(x.net_revenue for x in monthly.collect()) == 150
    lines = staging(spark, line(order_date=early), line(row_id=2, order_id="O2", order_date=late, sales=50))
    assert d.kpi_cards(lines).first().total_revenue == 150


def test_kpi_cards_without_revenue_and_on_a_leap_day(spark):
    lines = staging(spark, line(order_date=date(2020, 2, 29)))
    assert d.kpi_cards(lines, 2019).first().profit_margin == 0
    cards = d.kpi_cards(lines, start=date(2020, 2, 1), end=date(2020, 2, 29)).first()
    assert cards.total_revenue == 100 and cards.yoy_growth_pct is None


# -- CSV ------------------------------------------------------------------------------------

QUOTED = 'Bookcase 71"" Wide, Black'


def test_csv_with_doubled_quotes(spark, tmp_path):
    """What others write is read whole, and others read what is written."""
    name = QUOTED.replace('""', '"')
    body = ",".join(RAW_HEADER) + "\n" + "".join(
        f'{i or ""},O{i},2016-0{i + 1}-03,2016-12-01,First Class,C1,Ann,Consumer,US,X,Ohio,{43210 if i else ""},East,P1,F,Chairs,'
        f'"{QUOTED}",{i}.5,2.5,0.2,1\n' for i in range(3)
    )
    source = tmp_path / "raw.csv"
    source.write_bytes(body.encode("latin-1"))
    raw = c.normalize_columns(files.read_raw_sales(spark, str(source)))
    assert {(x.product_name, x.quantity, x.profit) for x in raw.collect()} == {(name, "2.5", "1")}
    target = shared_path(spark, "etl")
    assert run_etl(spark, str(source), target).first().total_revenue == 4.5
    written = duckdb.connect().execute(
        f"SELECT row_id, product_name, sales, quantity, postal_code FROM read_csv('{target}/*.csv', header=true) ORDER BY sales"
    ).fetchall()
    # the missing row id and postal code take the median
    assert written == [(2, name, 0.5, 3, 43210), (1, name, 1.5, 3, 43210), (2, name, 2.5, 3, 43210)]
    back = files.load_staging(spark, target, ENRICHED_SCHEMA)
    assert {x.product_name for x in back.collect()} == {name}


def test_typed_staging_rounds_and_keeps_unknown_row_ids_null(spark):
    df = spark.createDataFrame([("7", 2.5, 1.0, 0.1, 0.5), ("Unknown", 1.0, 1.0, 0.1, 0.5)], "row_id string, quantity double, sales double, discount double, profit double")
    assert [(x.row_id, x.quantity) for x in w.typed_staging(df).collect()] == [(7, 3), (None, 1)]


# -- stored tables ----------------------------------------------------------------------------


def test_a_workspace_leaves_nothing(spark):
    folder = shared_dir(spark)
    before = sorted(os.listdir(folder))
    with workspace(spark) as path:
        run("rfm_segments", spark, "/root/testdata/sf0.001").collect()
        run("clean_sales", spark, "/root/testdata/sf0.001").collect()
        assert os.listdir(path)
    assert sorted(os.listdir(folder)) == before


def test_scans_are_few(spark):
    """The fact table is read once for its key and once for everything else, a dimension once per rule and reference."""
    star, path = fact(spark, line()), shared_path(spark, "star")
    monthly = w.monthly_sales(star.fact, star.customers, star.products)
    files.write_star(Star(star.fact, star.customers, star.products, star.dates, star.ship_modes, monthly), path)
    plan = v.constraint_report(files.read_star(spark, path))._jdf.queryExecution().optimizedPlan().toString()
    scans = [x for x in plan.splitlines() if "Relation [" in x]
    assert len(scans) == 17 and sum("gross_sales" in x for x in scans) == 2


def test_sorted_output_is_sorted(spark):
    lines = staging(spark, *[line(row_id=i, order_id=f"O{i % 5}", customer_id=f"C{i % 3}", order_date=date(2020, 1 + i % 4, 1)) for i in range(40)])
    found = [(x.customer_id, x.order_date, x.order_id, x.row_id) for x in f.sorted_output(lines).collect()]
    assert found == sorted(found)
