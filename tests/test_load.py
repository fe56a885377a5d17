"""Incremental loads of the star schema."""

from datetime import date

from helpers import line, rows, staging

from orderlens.operators import warehouse as w
from orderlens.plans.load import load_star, open_star
from orderlens.session import shared_path


def test_loads_are_incremental_and_repeatable(spark):
    path = shared_path(spark, "star")
    first = staging(spark, line(), line(row_id=2, product_id="P2", sales=50))
    later = staging(
        spark,
        line(),  # known
        line(row_id=9, customer_name="Ann B.", region="West", order_date=date(2020, 2, 1), sales=25),
        line(row_id=1, order_id="O2", customer_id="C2", order_date=date(2020, 2, 3), sales=10),
        line(row_id=2, order_id="O2", customer_id="C2", ship_mode="Unknown"),  # no such mode
    )
    star = load_star(spark, first, path, source_file="first.csv")
    keys = dict(rows(star.customers.select("customer_id", "customer_sk")))
    assert star.fact.count() == 2 and star.monthly.count() == 1

    star = load_star(spark, later, path)
    assert star.fact.count() == 4
    assert dict(rows(star.customers.select("customer_id", "customer_sk")))["C1"] == keys["C1"]
    found = rows(star.customers.select("customer_id", "customer_name", "region", "customer_ltv", "is_repeat"), "customer_id")
    assert [tuple(map(str, x)) for x in found] == [
        ("C1", "Ann B.", "West", "175.00", "False"), ("C2", "Ann", "East", "10.00", "False"),
    ]
    assert star.fact.select("sales_sk").distinct().count() == 4
    created = dict(rows(star.customers.select("customer_id", "created_at")))
    assert created["C1"] < created["C2"]
    times = ["etl_loaded_at", "updated_at"]
    before = {t: rows(getattr(star, t).drop(*times)) for t in ("fact", "customers", "products", "monthly")}

    again = load_star(spark, later, path, dates_never_change=True)
    for table, content in before.items():
        assert sorted(map(str, rows(getattr(again, table).drop(*times)))) == sorted(map(str, content))
    assert open_star(spark, path).fact.count() == 4


def test_lines_without_row_id_are_always_new(spark):
    batch = staging(spark, line(row_id=None), line(row_id=5), line(row_id=5))
    loaded = staging(spark, line(row_id=None), line(row_id=6))
    assert sorted(str(x[0]) for x in rows(w.new_lines(batch, loaded).select("row_id"))) == ["5", "5", "None"]


def test_keys_are_unique_and_stable(spark):
    old = staging(spark, *[line(customer_id=f"C{i}") for i in range(300)])
    both = staging(spark, *[line(customer_id=f"C{i}") for i in range(150, 700)])
    known = w.dim_customers(old)
    merged = w.dim_customers(both, known)
    assert merged.count() == 700 and merged.select("customer_sk").distinct().count() == 700
    assert merged.join(known, ["customer_id", "customer_sk"]).count() == 300


def test_keys_stay_unique_when_buckets_collide(spark, monkeypatch):
    monkeypatch.setattr(w, "KEY_BUCKETS", 3)
    known = w.dim_products(staging(spark, *[line(product_id=f"P{i}") for i in range(50)]))
    merged = w.dim_products(staging(spark, *[line(product_id=f"P{i}") for i in range(40, 120)]), known)
    assert merged.count() == 120 and merged.select("product_sk").distinct().count() == 120
    assert merged.join(known, ["product_id", "product_sk"]).count() == 50


def test_latest_attributes_win(spark):
    lines = staging(
        spark,
        line(row_id=1, order_date=date(2020, 5, 1), segment="New"),
        line(row_id=2, order_date=date(2019, 5, 1), segment="Old"),
    )
    assert w.dim_customers(lines).first().segment == "New"
