"""Category codes and the main categories they belong to."""

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioscope.functions.columns import ColumnLike, as_column

# Archive prefix -> main category, and the one name that has a short form.
MAIN_CATEGORIES = {
    "cs": "Computer Science",
    "econ": "Economics",
    "eess": "Electrical Engineering and Systems Science",
    "math": "Mathematics",
    "q-bio": "Quantitative Biology",
    "q-fin": "Quantitative Finance",
    "stat": "Statistics",
}
DEFAULT_MAIN_CATEGORY = "Physics"
SHORT_NAMES = {"Electrical Engineering and Systems Science": "Electrical Engineering"}


def primary_category(category: ColumnLike = "category") -> Column:
    """The first code of a blank-separated category list."""
    return F.substring_index(as_column(category), " ", 1)


def _lookup(key: Column, names: Mapping[str, str], default: Column) -> Column:
    entries = [F.lit(text) for item in names.items() for text in item]
    return F.coalesce(F.try_element_at(F.create_map(*entries), key), default)


def main_category_of(code: ColumnLike) -> Column:
    """Main category of one code, by the part before its first dot."""
    prefix = F.substring_index(as_column(code), ".", 1)
    return _lookup(prefix, MAIN_CATEGORIES, F.lit(DEFAULT_MAIN_CATEGORY))


def category_case(category: ColumnLike = "category", short: bool = True) -> Column:
    """Lower-case main category of a whole category field, taxonomy-free.

    The prefix ends at the first dot of the *field*, so a dotless leading code
    such as ``math-ph`` falls to the default. ``short`` picks the short form of
    the one long name.
    """
    name = main_category_of(category)
    return F.lower(category_shorten(name) if short else name)


def category_shorten(main_category: ColumnLike = "main_category") -> Column:
    main_category = as_column(main_category)
    return _lookup(main_category, SHORT_NAMES, main_category)
