"""Ingest jobs: raw lines to records, pages to taxonomy, records to training tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.functions import category_shorten
from folioscope.operators.enrich import enrich_articles
from folioscope.operators.joins import unmatched_articles
from folioscope.operators.splits import TEST_SHARES, testing_part, training_part
from folioscope.sources import raw_json
from folioscope.sources.delimited import read_records
from folioscope.sources.tables import read_table, write_if_absent, write_table
from folioscope.sources.taxonomy_pages import taxonomy_table


def convert(spark: SparkSession, source: str, destination: str, exact: bool = True) -> None:
    """JSON lines to delimited records; ``exact`` cuts fields by position, else parses and keeps each record on one line."""
    lines = raw_json.read_lines(spark, source)
    articles = raw_json.scan_lines(lines) if exact else raw_json.parse_lines(lines)
    raw_json.write_lines(raw_json.flatten_records(articles, clean=not exact), destination)


def build_taxonomy(
    pages: DataFrame, destination: str, html: str = "html", fmt: str = "parquet", overwrite: bool = False
) -> None:
    """Taxonomy pages to the taxonomy table, with main categories under their short names."""
    rows = taxonomy_table(pages, html)
    shortened = rows.withColumn("main_category", category_shorten("main_category"))
    _write(shortened, destination, overwrite, fmt)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Saved pages, one whole file per row."""
    return spark.read.text(path, wholetext=True).select(F.col("value").alias("html"))


def read_articles(spark: SparkSession, path: str, source: str = "records", quote: str = "") -> DataFrame:
    """Article fields from delimited ``records`` or directly from ``json`` lines.

    The direct way keeps titles that hold the record delimiter whole.
    """
    if source == "json":
        return raw_json.parse_lines(raw_json.read_lines(spark, path))
    return read_records(spark, path, quote=quote)


def preprocess(
    spark: SparkSession,
    articles: DataFrame,
    taxonomy: DataFrame,
    destination: str,
    fmt: str = "parquet",
    missing_authors: int | None = None,
    disjoint: bool = False,
    overwrite: bool = False,
) -> None:
    """Write the enriched table, then the training part and the three test parts from it.

    What the taxonomy join leaves out goes to a table of its own (``unmatched``). Articles are read and joined once; all parts are cut from the stored
    table. Tables that already exist stay as they are unless ``overwrite``.
    """
    whole = f"{destination}/preprocessing"
    _write(enrich_articles(articles, taxonomy, missing_authors), whole, overwrite, fmt)
    _write(unmatched_articles(articles.select("id", "category"), taxonomy), f"{destination}/unmatched", overwrite, fmt)
    enriched = read_table(spark, whole, fmt)
    _write(training_part(enriched), f"{destination}/training", overwrite, fmt)
    for part in TEST_SHARES:
        sample = testing_part(enriched, part, disjoint=disjoint)
        _write(sample, f"{destination}/testing/{part}", overwrite, fmt)


def _write(df: DataFrame, path: str, overwrite: bool, fmt: str) -> None:
    if overwrite:
        write_table(df, path, mode="overwrite", fmt=fmt)
    else:
        write_if_absent(df, path, fmt)
