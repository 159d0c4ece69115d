"""Joining articles to the category taxonomy."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.functions import primary_category
from folioscope.operators.dedupe import one_row_per_key
from folioscope.operators.layout import BROADCAST_BYTES, fits_broadcast
from folioscope.operators.prune import pruned_anti_join

#: Parts a taxonomy row is copied into when both sides of the join are shuffled.
SALTS = 32


def _article_columns(articles: DataFrame) -> list[str]:
    return [c for c in articles.columns if c not in ("journal_ref", "main_category", "main_topic")]


def taxonomy_join(articles: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Inner join on the article's first category code; unknown codes drop out.

    Adds ``main_category`` and ``main_topic`` (the sub-category's description).
    A code listed twice in the taxonomy counts once. Catalyst sends the
    taxonomy to the executors when its size allows, and AQE splits a category
    that dominates a shuffled join.
    """
    codes = one_row_per_key(taxonomy, ["sub_category"])
    keyed = articles.select(
        *_article_columns(articles), primary_category("category").alias("_code")
    )
    return keyed.join(codes, keyed["_code"] == codes["sub_category"], "inner").select(
        *_article_columns(articles), "main_category", F.col("description").alias("main_topic")
    )


def taxonomy_join_broadcast(
    articles: DataFrame, taxonomy: DataFrame, limit: int | None = None
) -> DataFrame:
    """The same join with the physical strategy picked here, from the taxonomy's size.

    A taxonomy of at most ``limit`` bytes is broadcast. A larger one joins by
    shuffle on (code, salt): its rows are copied once per salt, so that the
    articles of a hot category spread over that many tasks. The salt hashes
    the short columns, so it is the same in a retried task and spreads the
    versions of one identifier too; AQE splits what is left.
    """
    codes = one_row_per_key(taxonomy, ["sub_category"])
    small = fits_broadcast(taxonomy, BROADCAST_BYTES if limit is None else limit)
    keyed = articles.select(
        *_article_columns(articles), primary_category("category").alias("_code")
    )
    if small:
        joined = keyed.join(F.broadcast(codes), keyed["_code"] == codes["sub_category"], "inner")
    else:
        short = [c for c in _article_columns(articles) if c not in ("abstract", "title", "text")]
        salt = F.pmod(F.xxhash64(*short), F.lit(SALTS)).cast("int")
        salted = keyed.withColumn("_salt", salt)
        copies = codes.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        same = (salted["_code"] == copies["sub_category"]) & (salted["_salt"] == copies["_copy"])
        joined = salted.join(copies.hint("merge"), same, "inner")
    return joined.select(
        *_article_columns(articles), "main_category", F.col("description").alias("main_topic")
    )


def unmatched_articles(articles: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Articles whose first code the taxonomy does not list: what the inner join leaves out.

    Codes that a bitmap of the taxonomy's rules out need no join.
    """
    keyed = articles.withColumn("_code", primary_category("category"))
    return pruned_anti_join(keyed, taxonomy, "_code", "sub_category").drop("_code")
