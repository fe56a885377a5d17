"""Raw rows that do not become lines, and drill-downs that pick their splits."""

from datetime import date
from itertools import product

from helpers import line, rows, staging
from orderlens.operators import cleaning as c
from orderlens.operators import dashboards as d
from orderlens.schemas import RAW_HEADER
from orderlens.session import shared_path
from orderlens.sources import files

GOOD = {"Order ID": "O1", "Row ID": "1", "Order Date": "2020-01-15", "Ship Date": "1/18/2020", "Sales": "10.5", "Quantity": "2"}


def raw(*changes):
    return [tuple({**GOOD, **change}.get(name, "x") for name in RAW_HEADER) for change in changes]


def test_every_row_is_accounted_for(spark):
    bad = [{"Order Date": "bad"}, {"Order Date": None}, {"Ship Date": " "}, {"Order Date": "?", "Ship Date": "?"}]
    df = spark.createDataFrame(raw({}, {}, {"Row ID": "2"}, *bad, bad[0]), ", ".join(f"`{n}` string" for n in RAW_HEADER))
    done = c.clean_with_rejects(df)
    assert rows(done.balance()) == [(8, 2, 4, 2, True)]
    found = rows(done.rejects().select("reason", "field", "value", "copies", "raw_order_id"), "reason", "field", "value")
    assert found == [
        ("missing date", "order_date", None, 1, "O1"), ("missing date", "ship_date", " ", 1, "O1"),
        ("unreadable date", "order_date", "?", 1, "O1"), ("unreadable date", "order_date", "bad", 2, "O1"),
    ]
    lines, plain = done.lines, c.clean_sales(df)
    assert lines.schema == plain.schema and sorted(map(str, lines.collect())) == sorted(map(str, plain.collect()))
    assert lines.first()["order_date"] == date(2020, 1, 15)


def test_corrupt_records_of_a_file(spark, tmp_path):
    path = shared_path(spark, "raw")
    text = ",".join(RAW_HEADER) + "\n" + "\n".join(",".join(row) for row in raw({}, {"Row ID": "2"})) + "\nonly,three,fields\n"
    spark.createDataFrame([(text.rstrip("\n"),)], "value string").coalesce(1).write.text(path)
    done = c.clean_with_rejects(files.read_raw_with_corrupt(spark, path))
    assert rows(done.balance()) == [(3, 2, 1, 0, True)]
    assert rows(done.rejects().select("reason", "value")) == [("corrupt record", "only,three,fields")]


def test_empty_input(spark):
    df = spark.createDataFrame([], ", ".join(f"`{n}` string" for n in RAW_HEADER))
    done = c.clean_with_rejects(df)
    assert rows(done.balance()) == [(0, 0, 0, 0, True)] and done.lines.count() == done.rejects().count() == 0


def test_loss_decomposition_equals_brute_force(spark):
    lines, data = [], []
    for i, (r, s, g) in enumerate(product("ABC", "XY", "KLMN")):
        profit = (i * 37 % 23) - 12
        lines.append(line(region=r, segment=s, category=g, profit=profit, order_id=f"O{i}"))
        data.append(({"region": r, "segment": s, "category": g}, profit))
    expected, chosen, names = [], {}, ["region", "segment", "category"]
    for step in range(1, 4):
        node = [(k, p) for k, p in data if all(k[d] == v for d, v in chosen.items())]
        whole, options = sum(-min(p, 0) for _, p in node), []
        for place, name in enumerate(n for n in names if n not in chosen):
            members = sorted({k[name] for k, _ in node})
            for member in members:
                loss = sum(-min(p, 0) for k, p in node if k[name] == member)
                options.append((-(loss - whole / len(members)), names.index(name), member, loss, sum(p for k, p in node if k[name] == member)))
        _, place, member, loss, total = min(options)
        chosen[names[place]] = member
        expected.append((step, names[place], member, float(loss), loss / whole * 100, float(total)))
    assert [tuple(r) for r in d.loss_decomposition(staging(spark, *lines)).orderBy("step").collect()] == expected
    assert d.loss_decomposition(staging(spark)).count() == 0
