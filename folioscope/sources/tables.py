"""Stored tables: Parquet by default, any installed table format by name."""

from pyspark.sql import DataFrame, SparkSession

from folioscope.session import path_exists

#: What a finished write leaves in its folder: the committer's mark, or a table format's own log.
MARKS = ("_SUCCESS", "_delta_log")


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    fmt: str = "parquet",
    max_records_per_file: int | None = None,
) -> None:
    """Write a table; an existing one is an error unless ``mode`` says otherwise."""
    writer = df.write.format(fmt).mode(mode)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.save(path)


def is_complete(spark: SparkSession, path: str) -> bool:
    return any(path_exists(spark, f"{path}/{mark}") for mark in MARKS)


def write_if_absent(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write a table once; where it is, nothing is computed and old data stays.

    A folder without the mark of a finished write was left by a job that died, and is written again.
    """
    if not is_complete(df.sparkSession, path):
        write_table(df, path, mode="overwrite", fmt=fmt)


def write_partitioned(
    df: DataFrame,
    path: str,
    column: str = "main_category",
    mode: str = "errorifexists",
    fmt: str = "parquet",
) -> None:
    """Write one folder per value of ``column``.

    The rebalance hint gathers each value's rows into well-sized files, and
    lets adaptive execution split a value that holds a large share of them.
    """
    balanced = df.hint("rebalance", column)
    balanced.write.format(fmt).mode(mode).partitionBy(column).save(path)
