"""The analysis job: every profile and trend of an enriched table, from two passes over it."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.functions import article_year
from folioscope.operators.dedupe import dedupe_by_id
from folioscope.operators.layout import stored
from folioscope.operators.profile import null_profile


def summarise(articles: DataFrame) -> DataFrame:
    """Counts and author totals per category, topic and year.

    Everything the reports show can be rolled up from this small frame:
    sums add up, extremes combine, and an average is a sum over a count.
    """
    return articles.groupBy(
        "main_category", "main_topic", article_year("article_date").alias("year")
    ).agg(
        F.count(F.lit(1)).alias("articles"),
        F.count("authers_num").alias("counted"),
        F.sum("authers_num").alias("authors"),
        F.min("authers_num").alias("min_authors"),
        F.max("authers_num").alias("max_authors"),
    )


def rolled_up_counts(summary: DataFrame, *keys: str) -> DataFrame:
    return summary.groupBy(*keys).agg(F.sum("articles").alias("count"))


def rolled_up_authors(summary: DataFrame, *keys: str | Column) -> DataFrame:
    average = F.round(F.try_divide(F.sum("authors"), F.sum("counted")), 0)
    return summary.groupBy(*keys).agg(
        average.alias("avg_authors"),
        F.min("min_authors").alias("min_authors"),
        F.max("max_authors").alias("max_authors"),
    )


def analyse(enriched: DataFrame, top: int = 10) -> dict[str, DataFrame]:
    """Reports by name. Duplicate ids count once; texts are never read past the null profile."""
    narrow = enriched.select("id", "authers_num", "article_date", "main_category", "main_topic")
    summary = stored(summarise(dedupe_by_id(narrow)), "summary")
    by_topic = rolled_up_counts(summary, "main_topic")
    by_category = rolled_up_counts(summary, "main_category")
    by_year = rolled_up_counts(summary, "year", "main_category")
    authors_by_year = rolled_up_authors(
        summary, "main_category", F.col("year").alias("article_year")
    )
    authors_by_category = rolled_up_authors(summary, "main_category")
    return {
        "null_profile": null_profile(enriched),
        "topics": by_topic.orderBy(F.desc("count"), "main_topic").limit(top),
        "categories": by_category.orderBy(F.desc("count"), "main_category"),
        "years": by_year.orderBy(F.asc("year"), F.desc("count"), "main_category"),
        "authors_by_year": authors_by_year.orderBy("main_category", "article_year", "avg_authors"),
        "authors_by_category": authors_by_category.orderBy(F.desc("max_authors"), "main_category"),
    }
