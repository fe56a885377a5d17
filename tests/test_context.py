"""Time comparisons under slicers, on hand-made lines."""

from datetime import date

import pytest

from helpers import line, rows, staging
from orderlens.operators import context as x
from orderlens.operators import dashboards as d

DAYS = [
    (date(2018, 2, 28), 10, "East"), (date(2019, 2, 28), 20, "East"), (date(2019, 3, 1), 1, "West"), (date(2020, 2, 28), 40, "East"),
    (date(2020, 2, 29), 80, "East"), (date(2020, 12, 31), 3, "West"), (date(2021, 2, 28), 160, "East"), (date(2021, 4, 1), 5, None),
]


@pytest.fixture
def lines(spark):
    return staging(spark, *(line(order_date=day, order_id=f"O{i}", sales=s, profit=-s, region=r) for i, (day, s, r) in enumerate(DAYS)))


def test_last_year_leaves_the_slicer_and_obeys_the_others(lines):
    one = x.sales_against_last_year(lines, x.Slicers(years=(2020,), regions=("East",)), grain="month")
    assert rows(one, "month_num") == [(2020, 2, 120.0, 20.0, 500.0)]
    assert rows(x.sales_against_last_year(lines, x.Slicers(years=(2019, 2020)), grain="year"), "year") == [
        (2019, 21.0, 10.0, pytest.approx(110.0)), (2020, 123.0, 21.0, pytest.approx(102 / 21 * 100)),
    ]


def test_the_end_of_february_stands_for_the_end_of_february(lines):
    def day(a, b):
        return rows(x.sales_against_last_year(lines, x.Slicers(dates=(a, b)), grain="total"))

    assert day(date(2021, 2, 28), date(2021, 2, 28)) == [(160.0, 120.0, pytest.approx(100 / 3))]
    assert day(date(2020, 2, 29), date(2020, 2, 29)) == [(80.0, 20.0, 300.0)]
    assert day(date(2020, 2, 28), date(2020, 2, 29)) == [(120.0, 20.0, 500.0)]  # both map to one day, which counts once
    assert day(date(2020, 3, 1), date(2020, 3, 1)) == [(None, 1.0, -100.0)]
    assert day(date(2015, 3, 1), date(2015, 3, 1)) == []


def test_spans_of_years_within_a_range():
    assert x.Slicers().spans() is None
    assert x.Slicers(years=(2020, 2018), dates=(date(2018, 5, 1), date(2020, 2, 1))).spans() == [
        (date(2018, 5, 1), date(2018, 12, 31)), (date(2020, 1, 1), date(2020, 2, 1)),
    ]
    assert x.Slicers(years=(2017,), dates=(date(2018, 5, 1), date(2020, 2, 1))).spans() == []


def test_no_days_chosen_and_empty_lines(spark, lines):
    nothing = x.Slicers(years=(2017,), dates=(date(2018, 5, 1), date(2020, 2, 1)))
    assert rows(x.sales_against_last_year(lines, nothing)) == [] and rows(x.to_date(lines, ["region"], nothing)) == []
    empty = staging(spark)
    assert rows(x.sales_against_last_year(empty)) == [] and rows(x.to_date(empty, ["region"])) == []


def test_to_date_has_every_day_from_a_groups_first_sale(lines):
    table = x.to_date(lines, ["region"])
    days = {r: [(t[1], *t[2:]) for t in rows(table.where(f"region <=> {r!r}" if r else "region IS NULL"), "order_date")] for r in ("East", "West", None)}
    assert days["East"][0] == (date(2018, 2, 28), 10.0, 10.0, 10.0, -10.0)
    assert len(days["East"]) == (date(2021, 4, 1) - date(2018, 2, 28)).days + 1
    assert len(days["West"]) == (date(2021, 4, 1) - date(2019, 3, 1)).days + 1 and days[None] == [(date(2021, 4, 1), 5.0, 5.0, 5.0, -5.0)]
    east = {day: figures for day, *figures in days["East"]}
    assert east[date(2020, 3, 31)] == [0.0, 120.0, 120.0, -120.0] and east[date(2021, 1, 1)] == [0.0, 0.0, 0.0, 0.0]
    assert rows(x.to_date(lines, until=date(2018, 3, 1)), "order_date") == [
        (date(2018, 2, 28), 10.0, 10.0, 10.0, -10.0), (date(2018, 3, 1), 0.0, 10.0, 10.0, -10.0),
    ]


def test_to_date_under_a_date_slicer_starts_with_the_period(lines):
    shown = x.to_date(lines, ["region"], x.Slicers(dates=(date(2020, 2, 29), date(2020, 3, 2)), regions=("East",)))
    assert rows(shown, "order_date") == [
        ("East", date(2020, 2, 29), 120.0, 120.0, 120.0, -120.0), ("East", date(2020, 3, 1), 0.0, 120.0, 120.0, -120.0),
        ("East", date(2020, 3, 2), 0.0, 120.0, 120.0, -120.0),
    ]


def test_cards_over_part_of_a_year_compare_with_the_same_part(lines):
    card = d.kpi_cards(lines, start=date(2020, 2, 1), end=date(2020, 2, 29)).first()
    assert (card.total_revenue, card.yoy_growth_pct) == (120.0, 500.0)
    card = d.kpi_cards(lines, start=date(2021, 2, 1), end=date(2021, 2, 28)).first()
    assert (card.total_revenue, card.yoy_growth_pct) == (160.0, 33.33)
