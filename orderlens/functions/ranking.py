"""Row numbers, NTILE and percentiles that never sort or hold a large group in one task.

Each starts from a range partitioning, whose splits follow the data, so a hot value or key is
spread over many tasks. The ranged rows are checkpointed: both the per-partition sizes and the
rows themselves are then read from the same files, also after an executor is lost.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_dir

CELL = "_cell"  # a key and the value that spreads its rows, as one struct
_ROW_BITS = 33  # monotonically_increasing_id keeps the partition above, the row below this bit


def global_row_number(df: DataFrame, order_by: list[Column], out: str = "rn", total: str | None = None) -> DataFrame:
    """``row_number()`` over all rows. ``order_by`` must end in a unique key.

    ``total``, if given, names a column that receives the number of rows.
    """
    shared_dir(df.sparkSession)
    ranged = (
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_position", F.monotonically_increasing_id())
        .checkpoint()
        .withColumn("_part", F.shiftright("_position", _ROW_BITS))
        .withColumn("_row", F.col("_position").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + 1)
        .drop("_position")
    )
    sizes = ranged.groupBy("_part").agg(F.max("_row").alias("_rows"))  # one row per partition
    by_part = Window.orderBy("_part")
    offsets = sizes.select(
        "_part",
        (F.sum("_rows").over(by_part) - F.col("_rows")).alias("_before"),
        F.sum("_rows").over(by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_total"),
    )
    numbered = ranged.join(F.broadcast(offsets), "_part").withColumn(out, F.col("_before") + F.col("_row"))
    if total:
        numbered = numbered.withColumn(total, F.col("_total"))
    return numbered.drop("_part", "_row", "_before", "_total")


def global_ntile(df: DataFrame, tiles: int, order_by: list[Column], out: str) -> DataFrame:
    """``ntile(tiles)`` over all rows. ``order_by`` must end in a unique key."""
    numbered = global_row_number(df, order_by, "_rn", "_n")
    small = F.floor(F.col("_n") / tiles)
    extra = F.col("_n") % tiles
    in_large = extra * (small + 1)
    tile = F.when(
        F.col("_rn") <= in_large, F.ceil(F.col("_rn") / (small + 1))
    ).otherwise(extra + F.ceil(F.try_divide(F.col("_rn") - in_large, small)))
    return numbered.withColumn(out, tile.cast("int")).drop("_rn", "_n")


def with_cell(df: DataFrame, keys: list[str], spread_by: str) -> DataFrame:
    """``df`` with the column by which ``grouped_row_number`` deals out rows, for tables stored by it."""
    return df.withColumn(CELL, F.struct(*keys, spread_by))


def grouped_row_number(
    df: DataFrame, keys: list[str], order_by: list[str], out: str, spread_by: str | None = None,
    totals: dict[str, Column] | None = None,
) -> DataFrame:
    """``row_number()`` per key.

    Without ``spread_by`` each key is a window of one task: for keys of few rows. ``spread_by``, the first column of
    ``order_by``, splits a key's rows by its values: rows are counted per key and value before they are shuffled, the
    counts summed up in order, and rows numbered within their value. A key then needs as many rows in one task as
    share one value, whatever the number of its rows. Counts and rows meet by key and value as one struct, in which
    nulls are equal, so that join and numbering share one shuffle of the rows, or none if they carry the struct
    (``with_cell``) and lie in a table dealt out by it. ``totals`` adds the sum over the key's rows of each
    ``{name: column}`` by the same join.
    """
    totals = totals or {}
    if spread_by is None:
        if totals:
            raise ValueError("totals need spread_by")
        return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by)))
    if order_by[0] != spread_by:
        raise ValueError("spread_by must be the first column of order_by")
    cells = df if CELL in df.columns else with_cell(df, keys, spread_by)
    whole = Window.partitionBy(*[f"{CELL}.{k}" for k in keys])
    earlier = whole.orderBy(f"{CELL}.{spread_by}").rowsBetween(Window.unboundedPreceding, -1)
    sizes = (
        cells.groupBy(CELL)
        .agg(F.count("*").alias("_n"), *[F.sum(value).alias(f"_sum_{name}") for name, value in totals.items()])
        .select(
            CELL, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
            *[F.sum(f"_sum_{name}").over(whole).alias(f"_sum_{name}") for name in totals],
        )
    )
    within = F.row_number().over(Window.partitionBy(CELL).orderBy(*order_by))
    number = (F.col("_before") + within).cast("int")
    return cells.join(sizes, CELL).select(
        *df.columns, number.alias(out), *[F.col(f"_sum_{name}").alias(name) for name in totals]
    )


def exact_percentiles(df: DataFrame, wanted: dict[str, tuple[str, float]]) -> DataFrame:
    """One row with the exact, linearly interpolated percentile of each ``{name: (column, fraction)}``.

    Equal values are counted before anything is sorted; only the one or two range partitions that
    hold the wanted position are then read value by value.
    """
    shared_dir(df.sparkSession)
    columns = sorted({column for column, _ in wanted.values()})
    values = df.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("_column"), F.col(c).cast("double").alias("_value")) for c in columns]))
    )
    counted = values.where("_value IS NOT NULL").groupBy("_column", "_value").agg(F.count("*").alias("_n"))
    ranged = (
        counted.repartitionByRange("_column", "_value")
        .withColumn("_part", F.spark_partition_id())
        .checkpoint()
    )
    by_part = Window.partitionBy("_column").orderBy("_part")
    parts = (
        ranged.groupBy("_column", "_part")
        .agg(F.sum("_n").alias("_rows"))
        .withColumn("_before", F.sum("_rows").over(by_part) - F.col("_rows"))
        .withColumn("_total", F.sum("_rows").over(Window.partitionBy("_column")))
    )
    asked = F.array(
        *[F.struct(F.lit(name).alias("_name"), F.lit(c).alias("_asked"), F.lit(float(p)).alias("_p"))
          for name, (c, p) in wanted.items()]
    )
    position = (F.col("_total") - 1) * F.col("_p")
    needed = (
        parts.select("*", F.inline(asked))
        .where("_asked = _column")
        .withColumn("_low", F.floor(position))
        .withColumn("_high", F.ceil(position))
        .withColumn("_fraction", position - F.floor(position))
        .where("_before <= _high AND _before + _rows > _low")  # at most two partitions per name
        .drop("_asked", "_p", "_rows", "_total")
    )
    upto = F.sum("_n").over(Window.partitionBy("_name", "_part").orderBy("_value"))
    inside = (
        ranged.join(F.broadcast(needed), ["_column", "_part"])
        .withColumn("_end", F.col("_before") + upto)
        .withColumn("_start", F.col("_end") - F.col("_n"))
    )
    low = F.max(F.when(F.col("_low").between(F.col("_start"), F.col("_end") - 1), F.col("_value")))
    high = F.max(F.when(F.col("_high").between(F.col("_start"), F.col("_end") - 1), F.col("_value")))
    between = low * (1 - F.first("_fraction")) + high * F.first("_fraction")
    found = inside.groupBy("_name").agg(F.when(low == high, low).otherwise(between).alias("_answer"))
    return found.agg(*[F.max(F.when(F.col("_name") == name, F.col("_answer"))).alias(name) for name in wanted])
