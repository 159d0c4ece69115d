"""Physical layout: partition counts, caching, and sizes that decide a broadcast."""

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.session import fresh_path
from folioscope.sources.tables import read_table, write_table

#: Largest table, in bytes of row text, that is sent whole to every executor.
BROADCAST_BYTES = 32 * 1024 * 1024


def repartition_n(df: DataFrame, n: int = 0) -> DataFrame:
    """Redistribute into ``n`` partitions; zero or less leaves the frame alone."""
    return df.repartition(n) if n > 0 else df


def input_partitions(spark: SparkSession) -> int:
    """The setting ``spark.folioscope.inputPartitions``: into how many parts a job deals texts that it read. 0 (off) by default.

    Files of one row group are read by one task, whatever their size; dealing
    the rows out costs one shuffle of the texts and lets every core tokenise.
    """
    return int(spark.conf.get("spark.folioscope.inputPartitions", "0"))


def spread(df: DataFrame) -> DataFrame:
    """At least one partition for each core, for rows that are read again and again."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, partition_count(df)))


def partition_count(df: DataFrame) -> int:
    """Partitions of a frame; for one read straight from files, no job is run."""
    return df.rdd.getNumPartitions()


@contextmanager
def cache_materialised(df: DataFrame) -> Iterator[tuple[DataFrame, int]]:
    """Hold a frame, on disk where memory is short, and give it with its row count."""
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield held, held.count()
    finally:
        held.unpersist()


def stored(df: DataFrame, name: str) -> DataFrame:
    """A frame written once to the run folder, or else the shared one, and read back.

    Inside ``session.run_folder`` the table is deleted with the run; outside,
    whoever set the shared folder deletes it. Later steps re-read files instead of recomputing, whatever executors are
    lost, and Catalyst knows the size of what it joins.
    """
    path = fresh_path(df.sparkSession, name)
    write_table(df, path)
    return read_table(df.sparkSession, path)


def row_bytes(df: DataFrame) -> int:
    """Bytes of all values of a frame written as text; one aggregation, no shuffle of rows."""
    text = F.concat_ws("", *[F.col(f"`{c}`").cast("string") for c in df.columns])
    # eight bytes for each value stand for its place in the row
    total = F.sum(F.octet_length(text) + F.lit(8 * len(df.columns)))
    return df.agg(F.coalesce(total, F.lit(0)).alias("bytes")).first()["bytes"]


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return row_bytes(df) <= limit
