"""Global positions of rows in an order, without bringing the rows to one task."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.operators.layout import stored

#: monotonically_increasing_id holds the partition above these bits and the place within it below.
_PLACE_BITS = 33


def with_positions(df: DataFrame, *order: Column | str, name: str = "position", start: int = 0) -> DataFrame:
    """The rows with their place in an order, counted from ``start``, as a long column.

    The rows are dealt out by ranges of the order and sorted within each, so a
    row's place in its range is known there; what is left is how many rows the
    ranges before hold, one number for each range. The numbered rows are stored
    before these are counted, as a second run of the range exchange may cut
    elsewhere. ``order`` should tell all rows apart: rows that tie get their
    places in an order that is not fixed.
    """
    at = F.monotonically_increasing_id()
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", at)
    numbered = stored(ranged, "numbered")
    part = F.shiftright("_at", _PLACE_BITS)
    sizes = numbered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("rows")).orderBy("_part").collect()
    before, offsets = start, []
    for row in sizes:  # one row for each range
        offsets.append((row["_part"], before))
        before += row["rows"]
    known = df.sparkSession.createDataFrame(offsets, "_part long, _before long")
    within = F.col("_at").bitwiseAND((1 << _PLACE_BITS) - 1)
    placed = numbered.withColumn("_part", part).join(F.broadcast(known), "_part")
    return placed.select(*df.columns, (F.col("_before") + within).alias(name))
