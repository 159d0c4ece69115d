"""Keyed upsert of one table into another."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.operators.layout import BROADCAST_BYTES, row_bytes, stored
from folioscope.sources.tables import read_table, write_table

SET_COLUMNS = ("label", "prediction")


class DuplicateKeyError(ValueError):
    """The updates name a key more than once, so the outcome would be arbitrary."""


def check_unique_key(updates: DataFrame, key: str = "id") -> None:
    per_key = updates.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    repeated = per_key.agg(F.count_if(F.col("n") > 1).alias("repeated")).first()["repeated"]
    if repeated:
        raise DuplicateKeyError(f"{repeated} values of {key!r} occur more than once in the updates")


def upsert(
    target: DataFrame,
    updates: DataFrame,
    key: str = "id",
    set_columns: Sequence[str] = SET_COLUMNS,
    insert_columns: Sequence[str] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The target with ``set_columns`` of matched rows updated and unmatched updates inserted.

    Matched rows keep all other columns. Inserted rows take ``insert_columns``
    (all columns of the updates unless given); what they lack is NULL. NULL
    keys match nothing. ``updates`` is read several times: pass a stored frame.

    Matching is a left join of the target and inserting an anti join of the
    updates, rather than one full outer join. Updates of a checked small size
    are broadcast, and then the target is not shuffled at all; otherwise both
    sides shuffle by key and AQE may split a key the target repeats, which a
    full outer join rules out. The target is read twice: whole, and once more
    for its keys alone. Rows with NULL keys join nothing; a number of their own
    in the join key spreads them over all tasks.
    """
    check_unique_key(updates, key)
    small = row_bytes(updates.select(key, *set_columns)) <= broadcast_bytes
    keyed_updates = updates.where(F.col(key).isNotNull())
    own = F.struct(F.col(key), F.when(F.col(key).isNull(), F.xxhash64(*target.columns)).otherwise(F.lit(0)).alias("n"))

    changes = keyed_updates.select(
        F.struct(F.col(key), F.lit(0).cast("long").alias("n")).alias("_key"),
        F.lit(True).alias("_matched"),
        *[F.col(c).alias(f"_new_{c}") for c in set_columns],
    )
    if small:
        changes = F.broadcast(changes)
    updated = target.withColumn("_own", own).join(changes, F.col("_own") == F.col("_key"), "left").select(
        *[
            F.when(F.col("_matched"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
            if c in set_columns
            else F.col(c)
            for c in target.columns
        ]
    )

    present = target.where(F.col(key).isNotNull()).select(key)
    if small:
        # matched keys are some of the updates' keys, so the same size check covers them
        present = F.broadcast(present.join(F.broadcast(keyed_updates.select(key)), key, "left_semi").distinct())
    inserted = _inserted(keyed_updates.join(present, key, "left_anti"), target, insert_columns)
    unkeyed_updates = _inserted(updates.where(F.col(key).isNull()), target, insert_columns)
    return updated.unionByName(inserted).unionByName(unkeyed_updates)


def _inserted(
    rows: DataFrame, target: DataFrame, insert_columns: Sequence[str] | None
) -> DataFrame:
    taken = rows.columns if insert_columns is None else insert_columns
    return rows.select(
        *[
            (F.col(f.name) if f.name in taken else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.schema.fields
        ]
    )


def upsert_snapshot(
    spark: SparkSession,
    current: str | None,
    updates: DataFrame,
    destination: str,
    key: str = "id",
    set_columns: Sequence[str] = SET_COLUMNS,
    insert_columns: Sequence[str] | None = None,
) -> DataFrame:
    """Upsert into the table at ``current`` and write the outcome to ``destination``.

    The table being read is never the one being written, so a job that dies
    half-way leaves ``current`` whole. Without a ``current`` table the updates
    become the first snapshot.
    """
    if current is None:
        check_unique_key(updates, key)
        result = updates
    else:
        target = read_table(spark, current)
        result = upsert(target, updates, key, set_columns, insert_columns)
    write_table(result, destination)
    return read_table(spark, destination)


#: Key-hash folders of a table, unless told otherwise.
FOLDERS = 64

_FOLDER = "folder_of_"


def folder_of(key: str, folders: int) -> Column:
    """The folder of a row: by the key's hash, and one more for rows without a key."""
    return F.when(F.col(key).isNull(), F.lit(folders)).otherwise(F.pmod(F.xxhash64(key), F.lit(folders)).cast("int"))


def write_folders(df: DataFrame, path: str, key: str = "id", folders: int = FOLDERS, mode: str = "errorifexists") -> None:
    """Write a table as one folder per key hash; the folder column's name says how many there are.

    The rebalance hint gathers each folder's rows and lets adaptive execution
    split one that a hot key fills.
    """
    column = f"{_FOLDER}{folders}"
    spread = df.withColumn(column, folder_of(key, folders)).hint("rebalance", column)
    writer = spread.write.mode(mode).partitionBy(column)
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def read_folders(spark: SparkSession, path: str) -> DataFrame:
    """A table written by write_folders, without its folder column."""
    table = spark.read.parquet(path)
    return table.drop(_folder_column(table))


def _folder_column(table: DataFrame) -> str:
    found = [c for c in table.columns if c.startswith(_FOLDER)]
    if not found:
        raise ValueError("the table is not laid out in key-hash folders")
    return found[-1]


def upsert_folders(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    key: str = "id",
    set_columns: Sequence[str] = SET_COLUMNS,
    insert_columns: Sequence[str] | None = None,
) -> DataFrame:
    """Upsert into a table of key-hash folders, rewriting only those that hold a key of the updates.

    The others are neither read nor written. The new rows of the touched
    folders are stored completely before any folder is replaced. A job that
    dies while folders are replaced leaves some of them old; running the same
    upsert again finishes it, as matching and inserting by key come to the same
    twice (updates without a key would be inserted again). ``updates`` is read
    several times: pass a stored frame.
    """
    table = spark.read.parquet(path)
    column = _folder_column(table)
    folders = int(column.removeprefix(_FOLDER))
    touched = [r[0] for r in updates.select(folder_of(key, folders).alias("f")).distinct().collect()]  # one per folder
    target = table.where(F.col(column).isin(touched)).drop(column)
    merged = stored(upsert(target, updates, key, set_columns, insert_columns), "merged-folders")
    write_folders(merged, path, key, folders, mode="overwrite")
    return read_folders(spark, path)


def upsert_delta(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    key: str = "id",
    set_columns: Sequence[str] = SET_COLUMNS,
    insert_columns: Sequence[str] | None = None,
) -> None:
    """The same upsert in place on a Delta table, where that package is installed."""
    try:
        from delta.tables import DeltaTable
    except ImportError as missing:
        raise RuntimeError("the delta-spark package is not installed") from missing

    check_unique_key(updates, key)
    if not DeltaTable.isDeltaTable(spark, path):
        write_table(updates, path, fmt="delta")
        return
    merge = DeltaTable.forPath(spark, path).alias("t").merge(updates.alias("u"), f"t.{key} = u.{key}")
    merge = merge.whenMatchedUpdate(set={c: f"u.{c}" for c in set_columns})
    if insert_columns is None:
        merge = merge.whenNotMatchedInsertAll()
    else:
        merge = merge.whenNotMatchedInsert(values={c: f"u.{c}" for c in insert_columns})
    merge.execute()
