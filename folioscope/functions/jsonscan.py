"""Reading a field from a JSON line by text position instead of parsing."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioscope.functions.columns import ColumnLike, as_column

#: Fixed value: what a field that is not in the line reads as.
ABSENT = "None"


def line_body(line: ColumnLike) -> Column:
    """A JSON line without surrounding white space and its outer braces."""
    trimmed = F.btrim(as_column(line), F.lit(" \t\n\r\v\f"))
    return F.substring(trimmed, F.lit(2), F.length(trimmed) - 2)


def scan_field(body: ColumnLike, key: str, skip: int = 3) -> Column:
    """Text between the first ``"key"`` plus ``skip`` characters and the next quote.

    This keeps escapes as they are written and stops at an escaped quote.
    Without a closing quote the last character is lost. An absent key gives
    the word ``None``.
    """
    body = as_column(body)
    marker = f'"{key}"'
    upto_quote, all_but_last = r'[^"]*+(?=")', r'[^"]*(?=.\z)'
    value = rf"(?s){re.escape(marker)}.{{0,{skip}}}({upto_quote}|{all_but_last}|)"
    absent = ~F.contains(body, F.lit(marker))
    return F.when(absent, F.lit(ABSENT)).otherwise(F.regexp_extract(body, value, 1))
