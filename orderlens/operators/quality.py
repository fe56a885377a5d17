"""Data-quality rules and the run summary."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.money import amount, ratio
from ..sources.files import Star


def line_rules() -> dict[str, Column]:
    """Rule -> condition of a line that breaks it."""
    return {
        "nonneg_sales": F.col("sales") < 0,
        "nonneg_quantity": F.col("quantity") < 0,
        "order_date_present": F.col("order_date").isNull(),
        "customer_id_present": F.col("customer_id").isNull(),
    }


def validate_sales(df: DataFrame, rules: list[str] | None = None, strict: bool = False) -> DataFrame:
    """(rule, violations, passed), all rules in one pass. ``strict`` raises if any is broken."""
    broken = {name: rule for name, rule in line_rules().items() if rules is None or name in rules}
    counts = df.agg(*[F.count_if(rule).alias(name) for name, rule in broken.items()])
    rows = F.array(*[F.struct(F.lit(name).alias("rule"), F.col(name).alias("violations")) for name in broken])
    report = counts.select(F.inline(rows)).withColumn("passed", F.col("violations") == 0)
    if strict:
        failed = [f"{row.rule}: {row.violations}" for row in report.where("NOT passed").collect()]
        if failed:
            raise ValueError("order lines break rules: " + ", ".join(failed))
    return report


def etl_summary(df: DataFrame) -> DataFrame:
    """One row: date range, orders, customers, revenue, profit, mean line margin, share of repeat lines."""
    exact = [F.sum(F.col(c).cast("decimal(18,6)")).alias(c) for c in ("sales", "profit")]
    # Sums meet in one row; of orders and customers only the ids are shuffled.
    return df.agg(
        F.min("order_date").alias("first_date"),
        F.max("order_date").alias("last_date"),
        F.count_distinct("order_id").alias("total_orders"),
        F.count_distinct("customer_id").alias("unique_customers"),
        *exact,
        F.sum(F.col("profit_margin_pct").cast("decimal(16,2)")).alias("margins"),
        F.sum("is_repeat_customer").alias("repeat_lines"),
        F.count("*").alias("lines"),
    ).select(
        "first_date",
        "last_date",
        "total_orders",
        "unique_customers",
        amount("sales").alias("total_revenue"),
        amount("profit").alias("total_profit"),
        ratio(F.col("margins").cast("decimal(20,2)"), "lines").alias("avg_margin_pct"),
        ratio(F.col("repeat_lines") * 100, F.col("lines").cast("decimal(18,0)")).alias("repeat_line_pct"),
    )


def constraint_report(star: Star) -> DataFrame:
    """(rule, violations, passed) for the declared keys, references and mandatory columns of a star schema."""
    checks = [
        _unique(star.customers, "dim_customers", "customer_sk"),
        _unique(star.customers, "dim_customers", "customer_id"),
        _present(star.customers, "dim_customers", ["customer_id", "customer_name", "segment"]),
        _unique(star.products, "dim_products", "product_sk"),
        _unique(star.products, "dim_products", "product_id"),
        _present(star.products, "dim_products", ["product_id", "product_name", "category", "sub_category"]),
        _unique(star.dates, "dim_date", "date_sk"),
        _unique(star.dates, "dim_date", "full_date"),
        _unique(star.ship_modes, "dim_ship_mode", "ship_mode_name"),
        _unique(star.fact, "fact_sales", "order_id", "row_id"),
        _fact_rows(star),
    ]
    if star.monthly is not None:
        checks.append(_unique(star.monthly, "agg_monthly_sales", "year", "month_num", "category", "region"))
    return reduce(DataFrame.unionByName, checks).withColumn("passed", F.col("violations") == 0)


def _check(counted: DataFrame, rule: str) -> DataFrame:
    return counted.select(F.lit(rule).alias("rule"), "violations")


def _unique(df: DataFrame, table: str, *key: str) -> DataFrame:
    """Key values that occur more than once."""
    repeated = df.dropna(subset=list(key)).groupBy(*key).count().where("count > 1")
    return _check(repeated.agg(F.count("*").alias("violations")), f"{table}.{','.join(key)} unique")


def _present(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Rows with a null in a mandatory column."""
    missing = reduce(Column.__or__, [F.col(c).isNull() for c in columns])
    return _check(df.agg(F.count_if(missing).alias("violations")), f"{table} mandatory columns")


_FACT_MANDATORY = ["order_id", "order_date_sk", "customer_sk", "product_sk", "quantity", "unit_price", "discount_rate",
                   "gross_sales", "net_sales", "cogs", "profit"]


def _fact_rows(star: Star) -> DataFrame:
    """Mandatory columns and references of the fact lines, in one pass over them."""
    references = {
        "order_date_sk": (star.dates, "date_sk"),
        "ship_date_sk": (star.dates, "date_sk"),
        "customer_sk": (star.customers, "customer_sk"),
        "product_sk": (star.products, "product_sk"),
        "ship_mode_sk": (star.ship_modes, "ship_mode_sk"),
    }
    lines = star.fact.select(*dict.fromkeys([*_FACT_MANDATORY, *references]))
    for key, (dimension, member) in references.items():
        members = dimension.select(F.col(member).alias(key)).distinct().withColumn(f"_has_{key}", F.lit(True))
        # One row per day, or four.
        small = dimension is star.dates or dimension is star.ship_modes
        lines = lines.join(F.broadcast(members) if small else members, key, "left")
    missing = reduce(Column.__or__, [F.col(c).isNull() for c in _FACT_MANDATORY])
    counts = {"fact_sales mandatory columns": F.count_if(missing)} | {
        f"fact_sales.{key} resolves": F.count_if(F.col(key).isNotNull() & F.col(f"_has_{key}").isNull())
        for key in references
    }
    found = lines.agg(*[n.alias(f"_{i}") for i, n in enumerate(counts.values())])
    rows = [F.struct(F.lit(rule).alias("rule"), F.col(f"_{i}").alias("violations")) for i, rule in enumerate(counts)]
    return found.select(F.inline(F.array(*rows)))
