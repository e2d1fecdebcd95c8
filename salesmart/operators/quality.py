"""Reusable data-quality checks.

Each check is one aggregate over the input (never one job per column) and
returns a small DataFrame, so it can be written, asserted on or shown.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``column_name, null_count`` for every column, from one pass."""
    columns = columns or df.columns
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return wide.unpivot([], columns, "column_name", "null_count")


def null_profile_by(df: DataFrame, by: str, columns: list[str] | None = None) -> DataFrame:
    """``by, column_name, null_count`` — the null profile of each group
    (for example each landing file), still one pass."""
    columns = [c for c in (columns or df.columns) if c != by]
    wide = df.groupBy(by).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return wide.unpivot([by], columns, "column_name", "null_count")


def duplicate_keys(df: DataFrame, key: str, table: str = "") -> DataFrame:
    """Key values that occur more than once: ``table_name, key_column, key_value,
    row_count``. A NULL key is never reported (``count(key)`` is 0 for it)."""
    return (df.groupBy(key).agg(F.count(key).alias("row_count"))
            .where(F.col("row_count") > 1)
            .select(F.lit(table).alias("table_name"), F.lit(key).alias("key_column"),
                    F.col(key).cast("string").alias("key_value"), "row_count"))


def date_range(df: DataFrame, column: str = "trans_dt") -> DataFrame:
    """First and last date, rows and rows without a date."""
    return df.agg(F.min(column).alias("min_date"), F.max(column).alias("max_date"),
                  F.count(F.lit(1)).alias("row_count"),
                  F.count_if(F.col(column).isNull()).alias("rows_without_date"))


def daily_counts(df: DataFrame, column: str = "trans_dt") -> DataFrame:
    """Rows per date (sort by date when writing)."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))


def group_counts(df: DataFrame, key: str, counted: str | None = None) -> DataFrame:
    """Rows per group and non-NULL values of ``counted`` (default: the key,
    which reports 0 for the NULL group)."""
    counted = counted or key
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("row_count"),
                               F.count(counted).alias("value_count"))


def key_lookup(df: DataFrame, key: str, value: str) -> DataFrame:
    """Rows with ``key == value``; on a parquet table the equality is pushed
    into the scan (row-group statistics skip what cannot match)."""
    return df.where(F.col(key) == F.lit(value))
