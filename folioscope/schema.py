"""Table layouts shared by readers, operators and jobs.

Fixed values: the column names and types are those of the tables to be matched.
"""

from pyspark.sql.types import DateType, DoubleType, IntegerType, StringType, StructField, StructType


def _strings(*names: str) -> StructType:
    return StructType([StructField(name, StringType(), True) for name in names])


#: A flat article record, as read from delimited text.
ARTICLE_SCHEMA = _strings(
    "id", "authors", "title", "abstract", "journal_ref", "category", "update_date"
)

#: The keys read from one raw JSON metadata line. The public dump spells the
#: journal key with a hyphen; the underscore form is accepted as a fallback.
RAW_JSON_SCHEMA = _strings(
    "id", "authors", "title", "abstract", "journal-ref", "journal_ref", "categories", "update_date"
)

TAXONOMY_SCHEMA = _strings("main_category", "sub_category", "description")

#: What preprocessing hands to analysis and training ("authers_num" is the
#: spelling existing consumers of this table rely on).
ENRICHED_SCHEMA = StructType(
    [
        StructField("id", StringType(), True),
        StructField("text", StringType(), True),
        StructField("title", StringType(), True),
        StructField("abstract", StringType(), True),
        StructField("authers_num", IntegerType(), True),
        StructField("article_date", DateType(), True),
        StructField("main_category", StringType(), True),
        StructField("main_topic", StringType(), True),
    ]
)

PREDICTION_SCHEMA = StructType(
    [
        StructField("id", StringType(), True),
        StructField("main_category", StringType(), True),
        StructField("label", DoubleType(), True),
        StructField("prediction", DoubleType(), True),
    ]
)
