"""Delimited text."""

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from folioscope.schema import ARTICLE_SCHEMA
from folioscope.sources.raw_json import DELIMITER


def read_records(
    spark: SparkSession,
    path: str,
    schema: StructType = ARTICLE_SCHEMA,
    delimiter: str = DELIMITER,
    quote: str = "",
) -> DataFrame:
    """Headerless records from a file, folder or glob such as ``.../part*``.

    Quoting is off by default: a title that opens with a quotation mark would
    otherwise take the rest of its record with it. Pass ``quote='"'`` for
    Spark's usual reading.
    """
    return (
        spark.read.schema(schema)
        .option("sep", delimiter)
        .option("header", False)
        .option("quote", quote)
        .csv(path)
    )


def read_header_csv(
    spark: SparkSession, path: str, schema: StructType | None = None, delimiter: str = ",", multi_line: bool = False
) -> DataFrame:
    """CSV with a header line. Without a schema, types are inferred by an extra pass.

    With ``multi_line`` quoted values may hold line breaks. A file is then read by one task, so write many files.
    """
    reader = spark.read.option("sep", delimiter).option("header", True).option("escape", '"').option("multiLine", multi_line)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def rename_positional(df: DataFrame, names=tuple(ARTICLE_SCHEMA.fieldNames())) -> DataFrame:
    """Name the leading columns by position and drop the rest."""
    return df.select(*[df[old].alias(new) for old, new in zip(df.columns, names, strict=False)])


def read_broken_records(
    spark: SparkSession, path: str, schema: StructType = ARTICLE_SCHEMA, delimiter: str = DELIMITER
) -> DataFrame:
    """Headerless records whose fields may hold line breaks: a record ends only where its last field has begun.

    A line with all delimiters of a record is a record. The other lines are
    pieces. Between two whole lines the pieces are put together in file order
    until they hold the delimiters of a record; a piece without any goes to the
    record before it. A line break within the last field of an otherwise
    whole line cannot be told from a stray line, which gives a record of its first field alone.
    Empty fields are NULL, surplus fields are dropped.

    Whole lines go straight through. Of them only the place is shuffled, of the
    pieces also the text. Places are counted within each split of a file, and
    the counts of the splits before are added, so no task reads a whole file.
    The files are read twice.
    """
    last = len(schema) - 1
    lines = spark.read.option("lineSep", "\n").text(path)
    held = F.octet_length("value") - F.octet_length(F.replace(F.col("value"), F.lit(delimiter), F.lit("")))
    held = F.call_function("div", held, F.lit(len(delimiter.encode())))
    whole = lines.where(held >= last).select("value")

    placed = lines.select(
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"),
        held.alias("held"),
        F.when(held < last, F.col("value")).alias("piece"),
    )
    passed = F.count_if(F.col("piece").isNull())
    along = Window.partitionBy("file", "split").orderBy("at")
    counted = placed.withColumn("passed", passed.over(along)).where("piece is not null")
    splits = placed.groupBy("file", "split").agg(passed.alias("whole"))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    before = splits.select("file", "split", F.coalesce(F.sum("whole").over(earlier), F.lit(0)).alias("before"))
    pieces = counted.join(before, ["file", "split"]).withColumn("gap", F.col("before") + F.col("passed"))

    # within a gap between whole lines: the delimiters so far say which record a piece belongs to
    so_far = Window.partitionBy("file", "gap").orderBy("split", "at").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.sum("held").over(so_far), F.lit(0))
    belongs = F.greatest(reached - (F.col("held") == 0).cast("int"), F.lit(0))
    numbered = pieces.withColumn("record", F.call_function("div", belongs, F.lit(last)))
    in_order = F.array_sort(F.collect_list(F.struct("split", "at", "piece")))
    repaired = numbered.groupBy("file", "gap", "record").agg(F.array_join(in_order["piece"], "\n").alias("value"))
    fields = F.split("value", re.escape(delimiter))
    columns = [F.nullif(F.get(fields, F.lit(i)), F.lit("")).cast(f.dataType).alias(f.name) for i, f in enumerate(schema)]
    return whole.unionByName(repaired.select("value")).select(*columns)
