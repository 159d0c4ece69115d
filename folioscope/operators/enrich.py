"""Turning flat article records into the table analysis and training use."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.functions import article_date, author_count, clean_update_date, text_concat
from folioscope.operators.joins import taxonomy_join_broadcast
from folioscope.schema import ENRICHED_SCHEMA


def enrich_articles(
    articles: DataFrame, taxonomy: DataFrame, missing_authors: int | None = None
) -> DataFrame:
    """Join the taxonomy, date each article, count its authors, build its text."""
    joined = taxonomy_join_broadcast(articles, taxonomy)
    return joined.withColumns(
        {
            "article_date": article_date("id"),
            "update_date": clean_update_date("update_date"),
            "authers_num": author_count("authors", missing=missing_authors),
            "text": text_concat("title", "abstract"),
        }
    ).select(*ENRICHED_SCHEMA.fieldNames())


def labelled_articles(articles: DataFrame, label) -> DataFrame:
    """``(id, title, abstract, main_category, text)`` with a category expression as label."""
    return articles.select(
        "id",
        "title",
        "abstract",
        label.alias("main_category"),
        text_concat("title", "abstract").alias("text"),
    )


def drop_helpers(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def filter_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())
