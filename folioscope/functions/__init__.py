"""Column expressions. Each takes column names or Columns and returns a Column."""

from folioscope.functions.categories import (
    category_case,
    category_shorten,
    main_category_of,
    primary_category,
)
from folioscope.functions.dates import article_date, article_year, clean_update_date
from folioscope.functions.jsonscan import scan_field
from folioscope.functions.text import (
    author_count,
    english_stop_words,
    stop_words_removed,
    strip_parens,
    term_frequencies,
    text_concat,
    tokens,
)

__all__ = [
    "article_date",
    "article_year",
    "author_count",
    "category_case",
    "category_shorten",
    "clean_update_date",
    "english_stop_words",
    "main_category_of",
    "primary_category",
    "scan_field",
    "stop_words_removed",
    "strip_parens",
    "term_frequencies",
    "text_concat",
    "tokens",
]
