"""Reading and writing order lines, the star schema and forecasts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..schemas import CLEAN_SCHEMA, CORRUPT, FORECAST_SCHEMA
from ..session import shuffles_removed

RAW_ENCODING = "ISO-8859-1"
QUOTING = {"quote": '"', "escape": '"'}  # a quote inside a quoted field is doubled, as other tools read and write it


@dataclass(frozen=True)
class Star:
    """The star schema. ``fact`` may lack keys of dimensions that a query does not use."""

    fact: DataFrame
    customers: DataFrame | None = None
    products: DataFrame | None = None
    dates: DataFrame | None = None
    ship_modes: DataFrame | None = None
    monthly: DataFrame | None = None


def read_raw_sales(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Headered latin-1 CSV of order lines, every column as text under its own name.

    ``multi_line`` is for files with line breaks inside quotes; each file is then read by one task.
    """
    return spark.read.csv(
        path, header=True, inferSchema=False, encoding=RAW_ENCODING, multiLine=multi_line, **QUOTING
    )


def read_raw_with_corrupt(spark: SparkSession, path: str) -> DataFrame:
    """As ``read_raw_sales``, with the text of rows of the wrong number of fields in a column ``_corrupt_record``."""
    names = read_raw_sales(spark, path).columns
    fields = [StructField(name, StringType()) for name in [*names, CORRUPT]]
    return spark.read.schema(StructType(fields)).csv(
        path, header=True, encoding=RAW_ENCODING, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, enforceSchema=True, **QUOTING
    )


def write_raw_sales(df: DataFrame, path: str, compression: str | None = None) -> None:
    """Order lines as headered latin-1 CSV files; ``compression`` as for ``write_clean_sales``."""
    with shuffles_removed(df.sparkSession):
        df.write.csv(path, header=True, encoding=RAW_ENCODING, mode="overwrite", compression=compression, **QUOTING)


def write_clean_sales(df: DataFrame, path: str, fmt: str = "csv", compression: str | None = None) -> None:
    """Cleaned lines as a folder of headered CSV files, or as Parquet, the working format.

    ``compression`` names a codec of the format. CSV under ``gzip`` takes about a fifth of the space; readers open it by
    its name, each file by one task, so there should be many of them.
    """
    _write(df, path, fmt, compression)


def read_clean_sales(
    spark: SparkSession, path: str, schema: str = CLEAN_SCHEMA, fmt: str = "csv"
) -> DataFrame:
    """Cleaned lines with dates and numbers typed by ``schema``."""
    return _read(spark, path, schema, fmt)


def load_staging(spark: SparkSession, path: str, schema: str = CLEAN_SCHEMA, fmt: str = "csv",
                 view: str = "staging_sales") -> DataFrame:
    """Expose cleaned lines as the staging view."""
    read_clean_sales(spark, path, schema, fmt).createOrReplaceTempView(view)
    return spark.table(view)


def write_fact(fact: DataFrame, path: str, mode: str = "append", first_key: int = 1, grouped: bool = False) -> None:
    """Fact lines by order year and month, so that date filters prune whole folders.

    The rebalance lets AQE give small months one task and split large ones over several. The line
    key is numbered after it, in the task that writes the line, so that a retry cannot give two
    lines the same key. ``grouped`` says that a task has the lines of few months already, since they were rebalanced so
    (``fact_lines``) or read from a table written by this function; they are then written as they lie.
    """
    lines = fact.withColumn("order_year", F.floor(F.col("order_date_sk") / 10000).cast("int")).withColumn(
        "order_month", F.floor(F.col("order_date_sk") / 100 % 100).cast("int")
    )
    if not grouped:
        lines = lines.hint("rebalance", F.col("order_year"), F.col("order_month"))
    numbered = lines.withColumn("sales_sk", F.monotonically_increasing_id() + F.lit(first_key))
    with shuffles_removed(fact.sparkSession):
        numbered.write.option("compression", "zstd").partitionBy("order_year", "order_month").mode(mode).parquet(path)


def write_star(star: Star, path: str, grouped: bool = False) -> None:
    """All tables of a star schema as Parquet below ``path``; ``grouped`` as for ``write_fact``."""
    write_fact(star.fact, f"{path}/fact_sales", "overwrite", grouped=grouped)
    for name, table in _tables(star).items():
        with shuffles_removed(table.sparkSession):
            table.write.mode("overwrite").parquet(f"{path}/{name}")


def read_star(spark: SparkSession, path: str) -> Star:
    """A star schema written by ``write_star``."""
    return Star(
        fact=spark.read.parquet(f"{path}/fact_sales"),
        customers=spark.read.parquet(f"{path}/dim_customers"),
        products=spark.read.parquet(f"{path}/dim_products"),
        dates=spark.read.parquet(f"{path}/dim_date"),
        ship_modes=spark.read.parquet(f"{path}/dim_ship_mode"),
        monthly=spark.read.parquet(f"{path}/agg_monthly_sales"),
    )


def write_forecast(forecast: DataFrame, path: str) -> None:
    """A forecast table as headered CSV."""
    _write(forecast, path, "csv")


def read_forecast(spark: SparkSession, path: str, schema: str = FORECAST_SCHEMA) -> DataFrame:
    """A forecast table written by ``write_forecast``."""
    return _read(spark, path, schema, "csv")


def _tables(star: Star) -> dict[str, DataFrame]:
    return {
        "dim_customers": star.customers,
        "dim_products": star.products,
        "dim_date": star.dates,
        "dim_ship_mode": star.ship_modes,
        "agg_monthly_sales": star.monthly,
    }


def _write(df: DataFrame, path: str, fmt: str, compression: str | None = None) -> None:
    options = QUOTING | ({"compression": compression} if compression else {})
    with shuffles_removed(df.sparkSession):
        df.write.format(fmt).options(header=True, **options).mode("overwrite").save(path)


def _read(spark: SparkSession, path: str, schema: str, fmt: str) -> DataFrame:
    # CSV columns are matched by position; without enforceSchema a header that disagrees is an error.
    return spark.read.schema(schema).format(fmt).options(header=True, enforceSchema=False, **QUOTING).load(path)
