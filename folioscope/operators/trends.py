"""Counts and author statistics by category, topic and year."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.functions import article_year


def count_by(df: DataFrame, *keys: str | Column) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def count_by_category(df: DataFrame, category: str = "main_category") -> DataFrame:
    """Articles per category, most frequent first."""
    return count_by(df, category).orderBy(F.desc("count"), category)


def topic_counts(df: DataFrame, topic: str = "main_topic") -> DataFrame:
    """Articles per topic, most frequent first."""
    return count_by(df, topic).orderBy(F.desc("count"), topic)


def count_by_year_category(
    df: DataFrame, date: str = "article_date", category: str = "main_category"
) -> DataFrame:
    """Articles per year and category; years ascending, counts descending.

    Articles without a date form a NULL year of their own.
    """
    counts = count_by(df, article_year(date).alias("year"), category)
    return counts.orderBy(F.asc("year"), F.desc("count"), category)


def category_series(
    df: DataFrame, date: str = "article_date", category: str = "main_category"
) -> DataFrame:
    """One yearly series per category, the largest category first.

    All series come from one grouped frame. The window runs over that frame,
    which has one row per category and year, not over articles.
    """
    counts = count_by(df, category, article_year(date).alias("year"))
    total = F.sum("count").over(Window.partitionBy(category))
    return (
        counts.withColumn("category_total", total)
        .orderBy(F.desc("category_total"), category, "year")
        .select(category, "category_total", "year", "count")
    )


def author_stats(
    df: DataFrame, *keys: str | Column, authors: str = "authers_num", with_min: bool = False
) -> DataFrame:
    """Rounded average, largest and, if asked for, smallest author count per group."""
    aggregates = [F.round(F.avg(authors), 0).alias("avg_authors")]
    if with_min:
        aggregates.append(F.min(authors).alias("min_authors"))
    aggregates.append(F.max(authors).alias("max_authors"))
    return df.groupBy(*keys).agg(*aggregates)


def author_stats_by_year(
    df: DataFrame, date: str = "article_date", category: str = "main_category", with_min: bool = False
) -> DataFrame:
    stats = author_stats(df, category, article_year(date).alias("article_year"), with_min=with_min)
    return stats.orderBy(category, "article_year", "avg_authors")


def author_stats_by_category(df: DataFrame, category: str = "main_category") -> DataFrame:
    """Author statistics per category, largest maximum first."""
    return author_stats(df, category).orderBy(F.desc("max_authors"), category)


def max_of_max(stats: DataFrame, category: str = "main_category") -> DataFrame:
    """Largest yearly maximum of each category."""
    return stats.groupBy(category).agg(F.max("max_authors").alias("max_authors"))


def top_k(df: DataFrame, order: list[str | Column], k: int = 10) -> DataFrame:
    """The first ``k`` rows of an ordering, without sorting the whole frame."""
    return df.orderBy(*order).limit(k)
