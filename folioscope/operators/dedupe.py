"""One row per key."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DataType, DateType, IntegerType, LongType, ShortType, StringType

from folioscope.operators.layout import BROADCAST_BYTES, fits_broadcast, stored


def one_row_per_key(df: DataFrame, keys: Sequence[str], prefer: Sequence[str] = ()) -> DataFrame:
    """Keep, for each key, the row that sorts first (NULLs first).

    Rows compare by the ``prefer`` columns, then by all others in order, so the
    survivor never depends on partitioning. It is an aggregate rather than a
    window: each task reduces its own copies before the shuffle, and a key
    holding a large share of all rows reaches its reducer as one row per task.
    """
    rest = [c for c in df.columns if c not in keys]
    ordered = [*prefer, *[c for c in rest if c not in prefer]]
    if not ordered:
        return df.select(*keys).distinct()
    kept = df.groupBy(*keys).agg(F.min(F.struct(*ordered)).alias("_kept"))
    columns = [c if c in keys else F.col(f"_kept.{c}").alias(c) for c in df.columns]
    return kept.select(*columns)


def order_number(column: str, kind: DataType) -> Column:
    """A long that never falls where the column rises, NULL lowest: equal numbers leave the order open.

    Of a text it holds the first seven bytes.
    """
    if isinstance(kind, StringType):
        head = F.rpad(F.hex(F.substring(F.col(column).cast("binary"), 1, 7)), 14, "0")
        number = F.conv(head, 16, 10).cast("long")
    elif isinstance(kind, DateType):
        number = F.unix_date(column).cast("long") + (1 << 40)
    elif isinstance(kind, ByteType | ShortType | IntegerType | LongType):
        # without a bit of its own below the smallest long, NULL shares that number
        return F.coalesce(F.col(column).cast("long"), F.lit(-(1 << 63)))
    else:
        number = F.lit(0).cast("long")
    return F.coalesce(number, F.lit(-1).cast("long"))


def elected_row_per_key(
    df: DataFrame, key: str, prefer: Sequence[str] = (), broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """The same rows as one_row_per_key for a key of which most values stand once, moving only rows of the others.

    A first pass over the key and the first preferred column elects, by a hash
    aggregate of fixed width, the smallest order number of every key that
    repeats. The second reads the rows: those whose key stands once go through
    as they are, those above their key's number are dropped where they were
    read, and what still ties is decided exactly, by a row limit that works
    within each task before it shuffles. The elected keys are broadcast if they
    are of checked size; beyond that they are joined by shuffle. NULL keys
    count as one key. ``df`` is read three times: pass a stored frame, or a scan.
    """
    rest = [c for c in df.columns if c != key]
    ordered = [*prefer, *[c for c in rest if c not in prefer]]
    if not ordered:
        return df.select(key).distinct()
    number = order_number(ordered[0], df.schema[ordered[0]].dataType)
    counted = df.select(key, number.alias("_number")).groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.min("_number").alias("_least"))
    elected = stored(counted.where("_n > 1").select(F.col(key).alias("_elected"), "_least"), "elected")
    if fits_broadcast(elected, broadcast_bytes):
        elected = F.broadcast(elected)
    same = F.col(key).eqNullSafe(F.col("_elected"))
    marked = df.withColumn("_number", number).join(elected, same, "left")
    once = marked.where("_least is null").select(*df.columns)
    tied = marked.where("_number = _least").select(*df.columns)
    order = Window.partitionBy(key).orderBy(*[F.asc_nulls_first(c) for c in ordered])
    winners = tied.withColumn("_place", F.row_number().over(order)).where("_place = 1").select(*df.columns)
    return once.unionByName(winners)


def dedupe_by_id(articles: DataFrame, prefer: Sequence[str] = ("update_date",), broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    return elected_row_per_key(articles, "id", [c for c in prefer if c in articles.columns], broadcast_bytes)
