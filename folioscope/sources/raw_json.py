"""Raw metadata dumps: one JSON object per line."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.functions.columns import ColumnLike, as_column
from folioscope.functions.jsonscan import line_body, scan_field
from folioscope.schema import ARTICLE_SCHEMA, RAW_JSON_SCHEMA

# Output field -> (key looked for, characters skipped after the key).
SCANNED_FIELDS = {
    "id": ("id", 2),
    "authors": ("authors", 2),
    "title": ("title", 2),
    "abstract": ("abstract", 3),
    "journal_ref": ("journal_ref", 3),
    "category": ("categories", 2),
    "update_date": ("update_date", 2),
}

#: Fixed value: what separates the fields of a flat record.
DELIMITER = "::"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of a file, folder or glob, as one string column ``value``."""
    return spark.read.text(path)


def scan_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """Article fields cut out of each line by position (see ``scan_field``)."""
    fields = [
        scan_field(F.col("_body"), key, skip).alias(name)
        for name, (key, skip) in SCANNED_FIELDS.items()
    ]
    return lines.withColumn("_body", line_body(line)).select(
        *[c for c in lines.columns if c != line], *fields
    )


def parse_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """Article fields from properly parsed JSON; absent and null keys are NULL."""
    record = F.from_json(F.col(line), RAW_JSON_SCHEMA)
    parsed = lines.withColumn("_record", record)
    return parsed.select(
        *[c for c in lines.columns if c != line],
        F.col("_record.id").alias("id"),
        F.col("_record.authors").alias("authors"),
        F.col("_record.title").alias("title"),
        F.col("_record.abstract").alias("abstract"),
        F.coalesce(F.col("_record.journal-ref"), F.col("_record.journal_ref")).alias("journal_ref"),
        F.col("_record.categories").alias("category"),
        F.col("_record.update_date").alias("update_date"),
    )


def one_line(field: ColumnLike, delimiter: str = DELIMITER) -> Column:
    """A field that fits into a flat record: line breaks become a blank, and the delimiter is broken up by blanks."""
    unbroken = F.regexp_replace(as_column(field), r"[\r\n]+", " ")
    return F.replace(unbroken, F.lit(delimiter), F.lit(" ".join(delimiter)))


def flat_record(*fields: ColumnLike, delimiter: str = DELIMITER, clean: bool = False) -> Column:
    """Fields joined into one line. NULL becomes an empty field, so none shifts.

    ``clean`` also takes line breaks and delimiters out of the fields; parsed
    JSON holds such, fields cut by position hold no line break.
    """
    columns = [as_column(f) for f in fields or tuple(ARTICLE_SCHEMA.fieldNames())]
    if clean:
        columns = [one_line(c, delimiter) for c in columns]
    return F.concat_ws(delimiter, *[F.coalesce(c, F.lit("")) for c in columns])


def flatten_records(articles: DataFrame, delimiter: str = DELIMITER, clean: bool = False) -> DataFrame:
    return articles.select(flat_record(delimiter=delimiter, clean=clean).alias("value"))


def write_lines(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write a single string column as text files, one value per line."""
    lines.write.mode(mode).text(path)
