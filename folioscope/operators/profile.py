"""Checks on a table's content."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_profile(df: DataFrame) -> DataFrame:
    """``(column_name, null_count)`` for every column, from one pass over the table."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], list(df.columns), "column_name", "null_count")


def null_date_count(df: DataFrame, column: str = "article_date") -> DataFrame:
    return df.agg(F.count_if(F.col(column).isNull()).alias("null_count"))


def row_count(df: DataFrame) -> DataFrame:
    """The number of rows, as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias("rows"))
