"""Order lines, staging rows and a star schema over the given trade tables.

The mapping is deterministic. Sales are 0.2 % of the extended price, discounts eight times the
source's (0 to 0.8), dates twenty years later; profit follows from sales, part and discount.
Every view is built from only the tables its columns need.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import date_key, day_range, days_covering, report_calendar, warehouse_calendar
from ..functions.money import cents, halves_away, money
from ..functions.ranking import grouped_row_number
from ..operators.warehouse import DISCOUNT_UNITS, PROFIT_CENTS, SALES_CENTS, derive_measures, dim_ship_mode
from ..schemas import LINE_COLUMNS, RAW_HEADER
from ..session import finished
from .files import Star

YEARS_LATER = 20
# Order priority -> ship mode, key of the ship mode, days to ship.
SHIP_MODE = {
    "1-URGENT": ("Same Day", 4, 0),
    "2-HIGH": ("First Class", 3, 2),
    "3-MEDIUM": ("Second Class", 2, 3),
}
OTHER_SHIP_MODE = ("Standard Class", 1, 5)
PART_ATTRIBUTES = ["product_name", "category", "sub_category"]
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount"]


class TradeTables:
    """Views over one folder of tables."""

    def __init__(self, spark: SparkSession, folder: str, years_later: int = YEARS_LATER):
        self.spark = spark
        self.folder = folder
        self.years_later = years_later

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # -- pieces ---------------------------------------------------------------------------

    def order_headers(self) -> DataFrame:
        """Orders with date and ship mode."""
        return self._headers().select(
            "o_orderkey", "o_custkey", "order_date", _of_mode(0).alias("ship_mode"), "ship_mode_sk",
            _of_mode(2).alias("_ship_days"),
        )

    def _headers(self) -> DataFrame:
        """Orders with date and the key of the ship mode, from which its name and days follow."""
        return self.table("orders").select(
            "o_orderkey",
            "o_custkey",
            F.add_months(F.col("o_orderdate").cast("date"), 12 * self.years_later).alias("order_date"),
            _mode_key().alias("ship_mode_sk"),
        )

    def _nations(self) -> DataFrame:
        """The states, which are nations, with their region."""
        nations = self.table("nation").join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        return nations.select("n_nationkey", F.col("n_name").alias("state"), F.col("r_name").alias("region"))

    def customers(self) -> DataFrame:
        """Customers with state (nation) and region."""
        return self.table("customer").join(self._nations(), F.col("c_nationkey") == F.col("n_nationkey")).select(
            F.col("c_custkey").alias("customer_sk"),
            F.col("c_custkey").cast("string").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.col("c_mktsegment").alias("segment"),
            "state",
            "region",
        )

    def products(self) -> DataFrame:
        """Parts; ten names per part name, so several products still share one."""
        return self.table("part").select(
            F.col("p_partkey").alias("product_sk"),
            F.col("p_partkey").cast("string").alias("product_id"),
            F.concat("p_name", F.lit(" "), F.col("p_partkey") % 10).alias("product_name"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("sub_category"),
        )

    # -- views ----------------------------------------------------------------------------

    def sales_lines(
        self, orders: bool = False, customers: bool = False, products: bool = False, numbered: bool = False
    ) -> DataFrame:
        """Typed order lines: line columns, and those of the tables asked for.

        Parts join first, then lines are brought together by order, last, so that an order's lines are neighbours in what
        is stored or counted next. Customers join the orders, not the lines. What follows from other columns (money,
        names of ship modes, ids as text) is computed after the joins, and nations join last, so that a line is shuffled
        in the source's narrow columns. ``numbered`` adds ``row_id``, the number of the line within its order, also
        counting lines whose part is not known; with ``products`` it runs when called, and lines with their part are
        stored dealt out by order, not shuffled.
        """
        lines = self.table("lineitem").select("l_orderkey", *LINE_ORDER)
        if products:
            parts = self.products().drop("product_id").withColumnRenamed("product_sk", "_part")
            if numbered:  # a line stays one row until it is numbered
                parts = parts.groupBy("_part").agg(F.collect_list(F.struct(*PART_ATTRIBUTES)).alias("_parts"))
                known = lines.join(parts, F.col("l_partkey") == F.col("_part"), "left").drop("_part")
                lines = finished(self.spark, "lines_by_order", lambda: known, "l_orderkey")
            else:
                lines = lines.join(parts, F.col("l_partkey") == F.col("_part"))
        if numbered:
            lines = grouped_row_number(lines, ["l_orderkey"], LINE_ORDER, "row_id")
        columns = [
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_sk"),
            "sales", "quantity", "discount", "profit", SALES_CENTS, DISCOUNT_UNITS, PROFIT_CENTS,
            *(["row_id"] if numbered else []),
        ]
        if orders or customers:
            headers = self._headers()
            columns += [
                F.col("o_custkey").alias("customer_sk"), F.col("o_custkey").cast("string").alias("customer_id"),
                "order_date", _ship_date().alias("ship_date"), _of_mode(0).alias("ship_mode"), "ship_mode_sk",
            ]
            if customers:
                members = self.table("customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
                headers = headers.join(members, F.col("o_custkey") == F.col("c_custkey"))
                columns += [F.col("c_name").alias("customer_name"), F.col("c_mktsegment").alias("segment"), "state", "region"]
            lines = lines.join(headers, F.col("l_orderkey") == F.col("o_orderkey"))
        if products:
            if numbered:
                lines = lines.select("*", F.inline("_parts"))
            columns += [F.col("l_partkey").cast("string").alias("product_id"), *PART_ATTRIBUTES]
        if customers:
            # One row per nation.
            lines = lines.join(F.broadcast(self._nations()), F.col("c_nationkey") == F.col("n_nationkey"))
        return priced(lines).select(*columns)

    def staging(self) -> DataFrame:
        """All 21 columns of a cleaned order line."""
        return (
            self.sales_lines(customers=True, products=True, numbered=True)
            .withColumn("order_id", F.col("order_id").cast("string"))
            .withColumn("country", F.lit("United States"))
            .withColumn("city", F.lit(None).cast("string"))
            .withColumn("postal_code", F.lit(None).cast("string"))
            .select(*LINE_COLUMNS)
        )

    def line_items(self) -> DataFrame:
        """The staging columns that need no customer or product table."""
        lines = self.sales_lines(orders=True, numbered=True)
        return lines.select(
            F.col("order_id").cast("string").alias("order_id"), "row_id", "customer_id", "order_date", "ship_date",
            "ship_mode", "sales", "quantity", "discount", "profit",
        )

    def raw_lines(self) -> DataFrame:
        """Staging rows as text under raw headers, with defects chosen by key.

        Repeated rows, two date formats, unreadable dates and sales, missing row ids, quantities,
        regions and ship modes.
        """
        order, part, customer = (F.col(c).cast("bigint") for c in ("order_id", "product_id", "customer_id"))
        rows = self.staging()
        defects = {
            "order_date": F.when(order % 101 == 0, "bad")
            .when(order % 2 == 1, F.date_format("order_date", "M/d/yyyy"))
            .otherwise(F.date_format("order_date", "yyyy-MM-dd")),
            "sales": F.when(part % 97 == 0, "N/A").otherwise(F.col("sales").cast("string")),
            "quantity": F.when(part % 89 != 0, F.col("quantity").cast("string")),
            "region": F.when(customer % 83 != 0, F.col("region")),
            "row_id": F.when(part % 79 != 0, F.col("row_id")),
            "ship_mode": F.when(order % 103 != 0, F.col("ship_mode")),
        }
        rows = rows.withColumns(defects)
        rows = rows.select(*[F.col(c).cast("string").alias(c) for c in LINE_COLUMNS])
        # A line of an order divisible by 50 appears twice.
        copies = F.when(F.col("order_id").cast("bigint") % 50 == 0, 2).otherwise(1)
        return (
            rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies)))
            .drop("_copy")
            .toDF(*[" Sub-Category " if h == "Sub-Category" else h for h in RAW_HEADER])
        )

    def star(self, orders: bool = False, customers: bool = False, products: bool = False) -> Star:
        """A star schema whose keys are the source's own; only the asked-for parts are joined."""
        lines = self.sales_lines(orders=orders or customers)
        columns = ["order_id", "product_sk", *derive_measures(exact=True)]
        if orders or customers:
            columns += [
                "customer_sk",
                "ship_mode_sk",
                date_key("order_date").alias("order_date_sk"),
                F.date_diff("ship_date", "order_date").alias("shipping_days"),
            ]
        return Star(
            fact=lines.select(*columns),
            customers=self.customers() if customers else None,
            products=self.products() if products else None,
            dates=warehouse_calendar(day_range(self.spark)),
            ship_modes=dim_ship_mode(self.spark),
        )

    def order_days(self) -> DataFrame:
        """Every day of the years in which orders were placed."""
        return days_covering(self.order_headers(), "order_date")

    def warehouse_calendar(self) -> DataFrame:
        return warehouse_calendar(self.order_days())

    def report_calendar(self) -> DataFrame:
        return report_calendar(self.order_days())


def priced(lines: DataFrame) -> DataFrame:
    """Line items with sales, discount, profit and quantity."""
    price = cents("l_extendedprice")
    sales, discount = F.col(SALES_CENTS), F.col(DISCOUNT_UNITS)
    # A fifth of sales, two points more per last digit of the part, less 0.6 of the discount.
    share = 20_000 + F.col("l_partkey") % 10 * 2_000 - discount * 6
    return (
        lines.withColumn(SALES_CENTS, halves_away(price * 2, F.lit(1000)))
        .withColumn(DISCOUNT_UNITS, F.rint(F.col("l_discount") * 10_000).cast("bigint") * 8)
        .withColumn(PROFIT_CENTS, halves_away(sales * share, F.lit(100_000)))
        .withColumn("sales", money(sales))
        .withColumn("discount", (discount.cast("decimal(8,0)") * F.lit(Decimal("0.0001"))).cast("decimal(5,4)"))
        .withColumn("profit", money(F.col(PROFIT_CENTS)))
        .withColumn("quantity", F.col("l_quantity").cast("int"))
    )


def _mode_key() -> Column:
    chosen = reduce(
        lambda case, item: case.when(F.col("o_orderpriority") == item[0], item[1][1]),
        list(SHIP_MODE.items())[1:],
        F.when(F.col("o_orderpriority") == "1-URGENT", SHIP_MODE["1-URGENT"][1]),
    )
    return chosen.otherwise(OTHER_SHIP_MODE[1])


def _of_mode(i: int) -> Column:
    """The name (0) or the days to ship (2) of ``ship_mode_sk``."""
    modes = sorted([*SHIP_MODE.values(), OTHER_SHIP_MODE], key=lambda mode: mode[1])
    return reduce(lambda case, mode: case.when(F.col("ship_mode_sk") == mode[1], mode[i]), modes[1:],
                  F.when(F.col("ship_mode_sk") == modes[0][1], modes[0][i]))


def _ship_date() -> Column:
    return F.date_add("order_date", _of_mode(2) + F.col("l_linenumber") % 3)
