"""Cleaning of raw order lines."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.membership import mark_possible
from ..functions.ranking import exact_percentiles
from ..schemas import CORRUPT, DATE_COLUMNS, LINE_COLUMNS, MEASURES, NUMERIC_IDS, WHOLE_COLUMNS
from ..session import stored

DATE_FORMATS = ["yyyy-MM-dd", "M/d/yyyy"]
UNKNOWN = "Unknown"


@dataclass(frozen=True)
class Cleaned:
    """Clean lines, and every raw row that did not become one, over one stored pass."""

    lines: DataFrame
    sorted_out: DataFrame

    def rejects(self) -> DataFrame:
        """The reason, the field and its text, how many equal rows there are, and the row as it was read."""
        kept = [c for c in self.sorted_out.columns if c.startswith("raw_")]
        return self.sorted_out.where("reason IS NOT NULL").select("reason", "field", "value", "copies", *kept)

    def balance(self) -> DataFrame:
        """One row: rows read, clean lines, rejected rows (repeats not counted again) and repeats."""
        figures = self.sorted_out.agg(
            F.coalesce(F.sum("copies"), F.lit(0)).alias("rows_in"), F.count_if(F.col("reason").isNull()).alias("rows_out"),
            F.count("reason").alias("rejected"), F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("repeats"),
        )
        return figures.withColumn("balanced", F.col("rows_in") == F.col("rows_out") + F.col("rejected") + F.col("repeats"))


def count_copies(df: DataFrame, out: str = "copies") -> DataFrame:
    """The different rows, each once, and how often each occurs.

    Runs when called: the rows are stored once. Of each, a 64-bit hash is counted; hashes that occur more than once set
    bits of a filter of fixed size. A row whose bit is not set occurs once and stays where it is. Only the others are
    shuffled and compared in every column, so neither a hash nor the filter decides that rows are equal.
    """
    names = [f"_c{i}" for i in range(len(df.columns))]
    rows = stored(df.toDF(*names), "rows").withColumn("_hash", F.xxhash64(*names))
    repeated = rows.groupBy("_hash").agg(F.count("*").alias("_n")).where("_n > 1")
    marked = mark_possible(rows, repeated)
    once = marked.where("NOT _maybe").select(*names, F.lit(1).cast("bigint").alias("_n"))
    more = marked.where("_maybe").groupBy(*names).agg(F.count("*").alias("_n"))
    return once.unionByName(more).toDF(*df.columns, out)


def dedupe_rows(df: DataFrame) -> DataFrame:
    """Drop rows that equal another in every column. Runs when called, as ``count_copies`` does."""
    return count_copies(df, "_copies").drop("_copies")


def dedupe_report(df: DataFrame) -> DataFrame:
    """Rows before and after ``dedupe_rows``, and how many it removes."""
    return count_copies(df.toDF(*[f"_c{i}" for i in range(len(df.columns))])).agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows_before"),
        F.count("*").alias("rows_after"),
    ).withColumn("removed", F.col("rows_before") - F.col("rows_after"))


def normalize_columns(df: DataFrame) -> DataFrame:
    """Column names in lower case, trimmed, with ``_`` for blanks and hyphens."""
    return df.toDF(*[name.strip().lower().replace(" ", "_").replace("-", "_") for name in df.columns])


def rename_known_columns(df: DataFrame, aliases: dict[str, str] | None = None) -> DataFrame:
    """Map source names to line columns; names without an entry, and other columns, stay as they are."""
    names = {**{c: c for c in LINE_COLUMNS}, **(aliases or {})}
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in df.columns and old != new})


def _date(column: str, formats: list[str] = DATE_FORMATS) -> Column:
    return F.coalesce(*[F.try_to_timestamp(F.trim(column), F.lit(fmt)) for fmt in formats]).cast("date")


def parse_dates_drop_bad(
    df: DataFrame, columns: list[str] = DATE_COLUMNS, formats: list[str] = DATE_FORMATS
) -> DataFrame:
    """Text to DATE by the first format that fits; rows without a readable date are dropped."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: _date(c, formats) for c in present}).dropna(subset=present)


def coerce_numeric(df: DataFrame, columns: list[str] = [*MEASURES, *NUMERIC_IDS]) -> DataFrame:
    """Text to DOUBLE; what is no number becomes null."""
    numbers = {c: F.col(c).try_cast("double") for c in columns if c in df.columns}
    return df.withColumns({c: F.when(~F.isnan(value), value) for c, value in numbers.items()})


def impute_median(
    df: DataFrame, columns: list[str] | None = None, approximate: bool = False, accuracy: int = 10_000
) -> DataFrame:
    """Fill nulls of numeric columns (all by default) with the column's median, as DOUBLE.

    The median is exact; ``approximate`` takes Spark's sketch of the given accuracy instead.
    """
    columns = columns or [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    if not columns:
        return df
    if approximate:
        medians = df.agg(*[F.percentile_approx(c, 0.5, accuracy).cast("double").alias(c) for c in columns])
    else:
        medians = exact_percentiles(df, {c: (c, 0.5) for c in columns})
    found = {c: v for c, v in medians.first().asDict().items() if v is not None}
    numbers = df.withColumns({c: F.col(c).cast("double") for c in columns})
    return numbers.fillna(found) if found else numbers


def fill_unknown(df: DataFrame) -> DataFrame:
    """Nulls of text columns become 'Unknown'."""
    return df.fillna(UNKNOWN, subset=[f.name for f in df.schema if isinstance(f.dataType, T.StringType)])


def whole_numbers(df: DataFrame) -> DataFrame:
    """Row ids and quantities as whole numbers, halves up; postal codes as text again."""
    whole = {c: F.round(c).cast("int") for c in WHOLE_COLUMNS if c in df.columns}
    if "postal_code" in df.columns:
        whole["postal_code"] = F.round("postal_code").cast("bigint").cast("string")
    return df.withColumns(whole)


def typed_lines(df: DataFrame) -> DataFrame:
    """The steps before imputation: deduplicated, named, with dates and numbers."""
    return (
        df.transform(dedupe_rows)
        .transform(normalize_columns)
        .transform(rename_known_columns)
        .transform(parse_dates_drop_bad)
        .transform(coerce_numeric)
    )


def clean_sales(df: DataFrame) -> DataFrame:
    """Raw lines to clean lines.

    Runs when called: the raw rows are stored once for the comparison, then the typed lines. The medians read the numeric
    columns of these, and the result is a projection, so that text is parsed and rows are compared a single time.
    """
    lines = stored(typed_lines(df), "typed_lines")
    return lines.transform(impute_median).transform(whole_numbers).transform(fill_unknown)


def clean_with_rejects(df: DataFrame) -> Cleaned:
    """``clean_sales`` that keeps account of every raw row; a column ``_corrupt_record`` tells of unreadable ones.

    Runs when called: rows are compared, typed and judged once, and stored with the reason for which a row is no line:
    it is corrupt, or a date is missing or unreadable, the first such column counting. Repeats of a row are counted on it.
    """
    raw = df.transform(normalize_columns).transform(rename_known_columns)
    columns = raw.columns
    rows = count_copies(raw)
    faults = []
    if CORRUPT in columns:
        faults.append((F.col(CORRUPT).isNotNull(), "corrupt record", CORRUPT))
    for c in (c for c in DATE_COLUMNS if c in columns):
        missing = F.coalesce(F.trim(c), F.lit("")) == ""
        faults += [(missing, "missing date", c), (_date(c).isNull(), "unreadable date", c)]
    fault = F.coalesce(*[
        F.when(bad, F.struct(F.lit(why).alias("reason"), F.lit(c).alias("field"), F.col(c).alias("value"))) for bad, why, c in faults
    ]) if faults else F.lit(None).cast("struct<reason:string,field:string,value:string>")
    judged = rows.withColumn("_fault", fault).select(
        "copies", "_fault.reason", "_fault.field", "_fault.value",
        *[F.when(F.col("_fault").isNotNull(), F.col(f"`{c}`")).alias(f"raw_{c}") for c in columns if c != CORRUPT],
        *[F.col(f"`{c}`") for c in columns if c != CORRUPT],
    )
    typed = judged.withColumns({c: _date(c) for c in DATE_COLUMNS if c in columns}).transform(coerce_numeric)
    table = stored(typed, "sorted_out")
    lines = table.where("reason IS NULL").select(*[c for c in columns if c != CORRUPT])
    return Cleaned(lines.transform(impute_median).transform(whole_numbers).transform(fill_unknown), table)
