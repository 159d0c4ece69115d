"""Dates held in, or next to, an article identifier."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioscope.functions.columns import ColumnLike, as_column

#: Fixed value: two-digit years from here on belong to the 1900s (old-style identifiers only).
CENTURY_PIVOT = "90"


def article_date(identifier: ColumnLike = "id") -> Column:
    """First day of the month an identifier was issued in, or NULL if it names none.

    ``archive/YYMMnnn`` identifiers pivot at :data:`CENTURY_PIVOT`;
    ``YYMM.nnnn`` identifiers are always from the 2000s. Malformed identifiers
    give NULL under ANSI mode too, where a plain cast would fail the job.
    """
    identifier = as_column(identifier)
    old_style = identifier.contains("/")
    numbered = F.when(old_style, F.get(F.split(identifier, "/"), F.lit(1))).otherwise(identifier)
    year_month = F.substring(numbered, 1, 4)
    nineties = old_style & (year_month >= CENTURY_PIVOT)
    century = F.when(nineties, F.lit("19")).otherwise(F.lit("20"))
    return F.try_to_date(F.concat(century, year_month), "yyyyMM")


def article_year(date: ColumnLike = "article_date") -> Column:
    return F.year(as_column(date))


def clean_update_date(update_date: ColumnLike = "update_date") -> Column:
    """The update date without the tabs that text output leaves on the last field."""
    return F.replace(as_column(update_date), F.lit("\t"), F.lit(""))
