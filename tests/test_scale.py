"""What is shuffled and stored stays narrow; figures do not change by it."""

import glob
import time
from datetime import date

from helpers import fact, line, staging
from pyspark.sql import functions as F

from orderlens import session
from orderlens.functions import codes, membership
from orderlens.functions.ranking import CELL, grouped_row_number
from orderlens.operators import cleaning as c
from orderlens.operators import features as f
from orderlens.operators import warehouse as w
from orderlens.plans.etl import run_etl
from orderlens.registry import run
from orderlens.schemas import RAW_HEADER
from orderlens.session import shared_path, workspace
from orderlens.sources.files import read_clean_sales, read_raw_sales, write_clean_sales, write_fact, write_raw_sales
from orderlens.sources.tables import TradeTables

DATA = "/root/testdata/sf0.001"


def exchanges(df):
    """The shuffles of the plan, each with the columns that it moves."""
    node, found = df._jdf.queryExecution().sparkPlan(), []
    planned = df._jdf.queryExecution().executedPlan()
    planned = planned.initialPlan() if hasattr(planned, "initialPlan") else planned

    def walk(plan):
        if plan.nodeName() == "Exchange":
            columns = plan.output()
            found.append([columns.apply(i).name() for i in range(columns.size())])
        children = plan.children()
        for i in range(children.size()):
            walk(children.apply(i))

    assert node is not None
    walk(planned)
    return found


def raw(spark, rows):
    names = ", ".join(f"`{name}` string" for name in RAW_HEADER)
    good = {"Order Date": "2020-01-15", "Ship Date": "1/18/2020", "Sales": "10.5", "Quantity": "2", "Discount": "0", "Profit": "1"}
    return spark.createDataFrame([tuple({**good, **row}.get(name, "x") for name in RAW_HEADER) for row in rows], names)


def test_copies_are_counted_whatever_the_filter_says(spark, monkeypatch):
    df = spark.createDataFrame(
        [(i % 40 if i % 3 else None, float(i % 2) if i % 5 else None, "a" if i % 7 else "") for i in range(300)], "a int, `b c` double, d string"
    )
    expected = sorted(map(str, df.groupBy("a", "`b c`", "d").agg(F.count("*").alias("copies")).collect()))
    assert sorted(map(str, c.count_copies(df).collect())) == expected
    monkeypatch.setattr(membership, "WORD", "0L")  # nearly every row is taken for a repeat
    assert sorted(map(str, c.count_copies(df).collect())) == expected
    assert sorted(map(str, c.dedupe_rows(df).collect())) == sorted(map(str, df.distinct().collect()))


def test_rows_that_occur_once_are_not_shuffled(spark):
    df = raw(spark, [{"Row ID": str(i)} for i in range(200)] + [{"Row ID": "7"}])
    found = c.dedupe_rows(df)
    assert found.count() == 200
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan  # rows that occur once pass by the comparison
    moved = [x for x in exchanges(found) if len(x) > len(RAW_HEADER) - 1]
    assert len(moved) == 1  # the possible repeats


def test_source_columns_are_shuffled_not_derived_ones(spark):
    for columns in exchanges(TradeTables(spark, DATA).staging()):
        assert not {"sales", "profit", "sales_cents", "customer_id", "ship_mode", "state", "region"} & set(columns), columns


def test_enrichment_shuffles_the_lines_once(spark):
    lines = session.stored(staging(spark, *[line(row_id=i, customer_id=f"C{i % 3}" if i % 4 else None) for i in range(20)]), "lines")
    wide = [x for x in exchanges(f.enrich_sales(lines)) if "product_name" in x]
    assert len(wide) == 1
    ltv = {(r.row_id, r.customer_ltv) for r in f.customer_ltv(lines).collect()}
    rank = {(r.row_id, r.customer_order_rank) for r in grouped_row_number(
        lines, ["customer_id"], ["order_date", "order_id", "row_id"], "customer_order_rank").collect()}
    both = f.enrich_sales(lines).collect()
    assert {(r.row_id, r.customer_ltv) for r in both} == ltv and {(r.row_id, r.customer_order_rank) for r in both} == rank


def test_compressed_csv_holds_the_same_rows(spark):
    df = raw(spark, [{"Row ID": str(i), "Product Name": 'a "b", c'} for i in range(5)])
    plain, packed = shared_path(spark, "raw"), shared_path(spark, "raw")
    write_raw_sales(df, plain)
    write_raw_sales(df, packed, compression="gzip")
    assert sorted(map(str, read_raw_sales(spark, packed).collect())) == sorted(map(str, read_raw_sales(spark, plain).collect()))
    path = shared_path(spark, "clean")
    write_clean_sales(c.clean_sales(df), path, compression="gzip")
    assert glob.glob(f"{path.removeprefix('file:')}/*.csv.gz") and not glob.glob(f"{path.removeprefix('file:')}/*.csv")
    assert {r.order_date for r in read_clean_sales(spark, path).collect()} == {date(2020, 1, 15)}


def test_etl_run_keeps_the_enriched_lines_only(spark):
    source, target = shared_path(spark, "raw"), shared_path(spark, "etl")
    write_raw_sales(raw(spark, [{"Row ID": str(i)} for i in range(5)]), source)
    with workspace(spark) as folder:
        assert run_etl(spark, source, target, compression="gzip").first().total_revenue == 52.5
        left = {path.split("/")[-1].split("-")[0] for path in glob.glob(f"{folder.removeprefix('file:')}/*")}
        assert left - {"checkpoints"} == {"enriched_lines"}
    assert glob.glob(f"{target.removeprefix('file:')}/*.csv.gz")


def test_shuffles_begin_finer_than_the_sessions_partitions(spark):
    before = spark.conf.get(session.INITIAL_PARTITIONS)
    assert int(before) == session.FINER_SHUFFLES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        spark.conf.set(session.INITIAL_PARTITIONS, "7")
        assert session.tune(spark).conf.get(session.INITIAL_PARTITIONS) == "7"
    finally:
        spark.conf.set(session.INITIAL_PARTITIONS, before)


def test_fact_lines_equal_the_lookup_of_derived_lines(spark):
    lines = session.stored(staging(
        spark, *[line(row_id=i, customer_id=f"C{i % 3}", product_id=f"P{i % 4}", sales=i + 20, quantity=i % 3) for i in range(12)],
        line(row_id=20, ship_mode="Unknown"), line(row_id=21, order_date=None),
    ), "lines")
    members = w.dim_customers(lines), w.dim_products(lines), w.dim_ship_mode(spark)
    made, old = w.fact_lines(w.fact_source(lines), *members), w.lookup_keys(w.derive_fact(lines), *members)
    assert sorted(map(str, made.select(*old.columns).collect())) == sorted(map(str, old.collect())) and made.count() == 13
    assert not [x for x in exchanges(made) if "cogs" in x or "net_sales" in x]  # measures are derived after the joins


def test_only_lines_of_the_last_day_are_shuffled_for_attributes(spark):
    lines = session.stored(staging(spark, *[
        line(row_id=i, order_id=f"O{i:03}", customer_id=f"C{i % 5}", segment=f"S{i}", order_date=date(2020, 1, 1 + i % 25) if i else None)
        for i in range(100)
    ]), "lines")
    found = w.latest_attributes(lines, "customer_id", ["segment", "region"])
    assert "_maybe" in found._jdf.queryExecution().analyzed().toString()
    best = {}
    for r in lines.where("order_date IS NOT NULL").collect():
        best[r.customer_id] = max(best.get(r.customer_id, (date.min,)), (r.order_date, r.order_id, r.segment))
    assert {r.customer_id: r.segment for r in found.collect()} == {k: v[2] for k, v in best.items()}


def test_lines_of_a_written_fact_table_are_not_shuffled_again(spark):
    star = fact(spark, line(), line(row_id=2, order_date=date(2020, 3, 1)), line(row_id=3, order_date=date(2021, 3, 1)))
    first, again = shared_path(spark, "fact"), shared_path(spark, "fact")
    write_fact(star.fact, first)
    write_fact(spark.read.parquet(first), again, "overwrite", grouped=True)
    for path in (first, again):
        written = spark.read.parquet(path)
        assert written.select("sales_sk").distinct().count() == 3
        assert sorted(map(str, written.drop("sales_sk").collect())) == sorted(map(str, spark.read.parquet(first).drop("sales_sk").collect()))


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {path for folder in folders for path in glob.glob(f"{folder}/*/shuffle_*.data")}


def test_shuffle_files_go_with_the_write(spark):
    before = shuffle_files(spark)
    session.stored(spark.range(1000).repartition(3, "id"), "rows")
    write_raw_sales(raw(spark, [{"Row ID": str(i)} for i in range(50)]).repartition(3, "`Row ID`"), shared_path(spark, "raw"))
    until = time.time() + 10  # they are removed beside what follows
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(session.SHUFFLE_CLEANUP, "false") == "false"  # other DataFrames keep theirs


def test_lines_dealt_out_by_customer_and_day_are_not_shuffled_to_be_enriched(spark, monkeypatch):
    monkeypatch.setattr(session, "BUCKET_BYTES", 2000)
    lines = session.stored(staging(spark, *[
        line(row_id=i, order_id=f"O{i % 9}", customer_id=f"C{i % 3}" if i % 4 else None, order_date=date(2020, 1 + i % 2, 1)) for i in range(40)
    ]), "lines")
    names = {table.name for table in spark.catalog.listTables()}
    with workspace(spark):
        dealt = session.finished(spark, "dealt", lambda: f.by_customer_day(lines), CELL)
        assert dealt.rdd.getNumPartitions() > 1
        found = f.enrich_sales(dealt)
        assert not [x for x in exchanges(found) if "row_id" in x or "product_name" in x]
        assert sorted(map(str, found.collect())) == sorted(map(str, f.enrich_sales(lines).collect()))
    assert {table.name for table in spark.catalog.listTables()} == names


def test_lines_are_numbered_before_their_part_is_looked_up(spark, tmp_path):
    """A line whose part is unknown counts in its order's numbers, one whose part is there twice appears twice."""
    for name in ("lineitem", "orders", "customer", "nation", "region"):
        spark.read.parquet(f"{DATA}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    parts = spark.read.parquet(f"{DATA}/part.parquet")
    parts.where("p_partkey % 3 != 0").union(parts.where("p_partkey % 5 = 1")).write.parquet(f"{tmp_path}/part.parquet")
    numbered = TradeTables(spark, str(tmp_path)).sales_lines(customers=True, numbered=True).select("order_id", "row_id", "product_sk")
    expected = numbered.join(parts.where("p_partkey % 3 != 0").union(parts.where("p_partkey % 5 = 1")), F.col("product_sk") == F.col("p_partkey"))
    found = TradeTables(spark, str(tmp_path)).staging().select(F.col("order_id").cast("bigint").alias("order_id"), "row_id", F.col("product_id").cast("bigint").alias("product_sk"))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.select("order_id", "row_id", "product_sk").collect()))


def test_lines_are_not_shuffled_for_the_keys_of_their_members(spark):
    lines = session.stored(staging(
        spark, *[line(row_id=i, order_id=f"O{i % 9}", customer_id=f"C{i % 3}", product_id=f"P{i % 4}") for i in range(40)],
        line(row_id=50, ship_mode="Unknown"), line(row_id=51, customer_id=None), line(row_id=52, product_id=None),
        line(row_id=53, customer_id="new"), line(row_id=None), line(row_id=None),
    ), "lines")
    known = lines.where("customer_id IS NULL OR customer_id != 'new'")
    members = w.dim_customers(known), w.dim_products(known), w.dim_ship_mode(spark)
    plain = w.fact_lines(w.fact_source(lines), *members)
    with workspace(spark):
        dealt = session.finished(spark, "dealt", lambda: w.by_order(lines), w.ORDER)
        assert sorted(map(str, w.dim_customers(dealt).drop("created_at", "updated_at").collect())) == sorted(
            map(str, w.dim_customers(lines).drop("created_at", "updated_at").collect()))
        found = w.fact_lines(w.fact_source(dealt), *members, by_month=True)
        wide = [x for x in exchanges(found) if "row_id" in x]
        assert all("_month" in x for x in wide)  # for the months of the fact table only
        assert sorted(map(str, found.select(*plain.columns).collect())) == sorted(map(str, plain.collect())) and plain.count() == 42


def test_a_members_value_is_joined_by_codes_or_as_it_is(spark, monkeypatch):
    lines = spark.createDataFrame([(i % 700 - 20 if i % 11 else None, i) for i in range(2000)], "k bigint, n int")
    members = {
        "neighbours": [(i, f"v{i % 5}" if i % 7 else None) for i in range(-10, 600)],
        "no values": [(i, None) for i in range(9)],
        "none": [],
        "twice": [(1, "a"), (1, "b"), (2, "a"), (None, "c")],
        "far apart": [(i * 2**40, f"v{i % 5}") for i in range(50)],
        "many values": [(i, f"v{i}") for i in range(400)],
    }
    monkeypatch.setattr(codes, "MOST_BLOCKS", 10)
    for name, pairs in members.items():
        table = spark.createDataFrame(pairs, "k bigint, v string")
        found = codes.join_value(lines, table, "k", "v")
        assert sorted(map(str, found.select("k", "n", "v").collect())) == sorted(map(str, lines.join(table, "k").select("k", "n", "v").collect())), name
        by_codes = "_codes" in found._jdf.queryExecution().analyzed().toString()
        assert by_codes == (name in ("neighbours", "no values", "none")), name


def test_the_four_ship_modes_do_not_deal_out_the_fact(spark):
    plan = run("fact_dim_lookup", spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(ship_mode_sk" not in plan


def test_the_monthly_summary_shuffles_no_lines_for_category_and_region(spark):
    star = fact(spark, *[
        line(row_id=i, order_id=f"O{i % 3}", customer_id=f"C{i}", region=f"R{i % 2}", product_id=f"P{i}", category=f"K{i % 4}") for i in range(8)
    ])
    found = w.monthly_sales(session.stored(star.fact, "fact"), star.customers, star.products)
    assert not [x for x in exchanges(found) if "net_sales" in x]
    assert sorted((r.category, r.region, r.total_orders, r.total_quantity) for r in found.collect()) == [
        ("K0", "R0", 2, 4), ("K1", "R1", 2, 4), ("K2", "R0", 2, 4), ("K3", "R1", 2, 4)]
