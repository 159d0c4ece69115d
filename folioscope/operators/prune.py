"""Leaving out rows that cannot match, before a join shuffles them: a bitmap of the other side's keys."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.operators.layout import stored

#: Bits that bitmap_construct_agg holds in one row (4 KB).
ROW_BITS = 32_768

#: Rows of a bitmap at most: 16 MB, which every task can hold. More keys only make it less selective.
MAX_ROWS = 4096

#: Bits for each key.
BITS_PER_KEY = 16


def _bit(key: Column, rows: int) -> Column:
    """The bit of a key, from 0; NULL for a NULL key, which equals nothing."""
    return F.when(key.isNotNull(), F.pmod(F.xxhash64(key), F.lit(rows * ROW_BITS)))


def key_bitmap(keys: DataFrame, key: str, size: int | None = None) -> tuple[DataFrame, int]:
    """``(_row, _bits)`` of a bitmap of hashed keys, and the number of its rows.

    Each task sets the bits of its own keys and the partial bitmaps are merged,
    so what is shuffled depends on the bitmap's size alone. ``size`` is the
    number of keys, counted if not given. The frame reads a stored table.
    """
    size = keys.count() if size is None else size
    rows = 1
    while rows < MAX_ROWS and rows * ROW_BITS < size * BITS_PER_KEY:
        rows *= 2
    bit = _bit(F.col(key), rows)
    placed = keys.where(F.col(key).isNotNull()).select(F.call_function("div", bit, F.lit(ROW_BITS)).alias("_row"), (bit % ROW_BITS).alias("_place"))
    return stored(placed.groupBy("_row").agg(F.bitmap_construct_agg("_place").alias("_bits")), "key-bitmap"), rows


def may_match(df: DataFrame, key: str, bitmap: DataFrame, rows: int, negate: bool = False) -> DataFrame:
    """Rows whose key's bit is set: all that match, and a few more. ``negate`` gives the others, which surely match nothing.

    The bitmap is broadcast; its size is bounded.
    """
    bit = _bit(F.col(key), rows)
    place = bit % ROW_BITS
    byte = F.conv(F.hex(F.substring("_bits", (F.call_function("div", place, F.lit(8)) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    mask = F.call_function("shiftleft", F.lit(1), (place % 8).cast("int"))
    is_set = F.coalesce(byte.bitwiseAND(mask) != 0, F.lit(False))
    looked_up = df.withColumn("_bit_row", F.call_function("div", bit, F.lit(ROW_BITS)))
    joined = looked_up.join(F.broadcast(bitmap), F.col("_bit_row") == F.col("_row"), "left")
    return joined.where(~is_set if negate else is_set).select(*df.columns)


def pruned_join(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Inner join on ``key``, the target's rows cut down by a bitmap of the updates' keys before they are shuffled.

    ``updates`` is read three times: pass a stored frame.
    """
    bitmap, rows = key_bitmap(updates.select(key), key)
    return may_match(target, key, bitmap, rows).join(updates, key)


def pruned_anti_join(df: DataFrame, listed: DataFrame, key: str, listed_key: str) -> DataFrame:
    """Rows whose key is not listed; only those that the bitmap does not rule out are joined at all.

    ``df`` is read twice, ``listed`` three times.
    """
    keys = listed.select(F.col(listed_key).alias(key))
    bitmap, rows = key_bitmap(keys, key)
    surely = may_match(df, key, bitmap, rows, negate=True)
    return surely.unionByName(may_match(df, key, bitmap, rows).join(keys, key, "left_anti").select(*df.columns))
