"""Labels numbered by frequency, for any number of distinct labels."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.operators.layout import BROADCAST_BYTES, fits_broadcast
from folioscope.operators.positions import with_positions

#: Parts a label's rows are dealt into when its table is joined by shuffle.
SALTS = 16


def label_table(df: DataFrame, column: str = "main_category") -> DataFrame:
    """``(column, label)``: each label's rank by falling frequency, ties alphabetical, from 0.0.

    A dense rank over all labels: counted with partial sums, ordered by ranges,
    numbered by the sizes of the ranges before. A fitted model holds its labels
    on the driver and so has a limit; this table has none. NULL is no label.
    The frame reads a stored table.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    ranked = with_positions(counts, F.desc("n"), column, name="label")
    return ranked.select(column, F.col("label").cast("double").alias("label"))


def with_label(
    df: DataFrame,
    table: DataFrame,
    column: str = "main_category",
    handle_invalid: str = "error",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Rows with their label's number, as a fitted index gives it.

    A NULL or unlisted label is an ``error`` unless ``skip`` drops its row or
    ``keep`` numbers it after all others. A table of checked size is broadcast.
    A larger one is joined by shuffle on (label, salt), its rows copied once
    per salt, so that a label of a third of all rows goes to many tasks; the
    salt hashes the row, so it is the same when a task runs again.
    """
    if handle_invalid not in ("error", "skip", "keep"):
        raise ValueError(f"unknown way to handle invalid labels: {handle_invalid!r}")
    if fits_broadcast(table, broadcast_bytes):
        joined = df.join(F.broadcast(table), column, "left")
    else:
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)).cast("int"))
        copies = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = salted.join(copies.hint("merge"), [column, "_salt"], "left")
    if handle_invalid == "skip":
        found = F.col("label")
        joined = joined.where("label is not null")
    elif handle_invalid == "keep":
        found = F.coalesce("label", F.lit(float(table.count())))
    else:
        message = F.concat(F.lit(f"{column} has no label for "), F.coalesce(F.col(column).cast("string"), F.lit("NULL")))
        found = F.coalesce("label", F.raise_error(message).cast("double"))
    return joined.select(*df.columns, found.alias("label"))
