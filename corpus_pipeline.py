"""From raw documents to token identifiers, one stage after another.

Every stage takes (spark, docs, sf_dir) and works on all rows it gets. All but the last return the columns of documents. What each does
with nulls, empty and repeated rows is stated with its operator in folioscope/llm; here that means: documents without a
letter in their text go in the first stage, documents without an identifier are never copies of others, and of rows that repeat an
identifier with the same text one stays. Different texts under one identifier are documents of their own (texts are told apart by a 64-bit hash).
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioscope.llm import bpe, jaccard_join, langid, leaks, private
from folioscope.llm.common import open_docs, store
from folioscope.llm.queries import PRIVATE_KEY, RANKS
from folioscope.operators.positions import with_positions
from folioscope.session import fresh_path, remove_path

BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Whole texts pass between Spark and Python; in batches of the default 10,000 rows they take hundreds of megabytes of an executor.

    A size that the session has set itself stays.
    """
    if spark.conf.get(BATCH_ROWS) == "10000":
        spark.conf.set(BATCH_ROWS, "1000")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is near enough to a language; learned from those with a label."""
    small_batches(spark)
    model = langid.fit(docs.select(F.col("doc_id").alias("key"), "text", "lang"))
    found = langid.predict(docs, model)
    return found.where("not rejected").select(*docs.columns)


def numbered(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents, of rows equal in identifier and text one, with a number ``_node`` for each identifier and text.

    It is the identifier for the first text under it; further texts come behind all identifiers. Only rows whose identifier repeats are
    shuffled (and, if the repeated identifiers are too many to be broadcast, the rest to be told from them).
    """
    digest = F.xxhash64("text")
    named = docs.where("doc_id is not null")
    again = named.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    again = store(again, "repeated")
    # the row limit works within each task first
    order = Window.partitionBy("doc_id", "_digest").orderBy(F.xxhash64(*[c for c in docs.columns if c != "text"]))
    several = named.join(again, "doc_id", "left_semi").withColumn("_digest", digest)
    several = several.withColumn("_place", F.row_number().over(order)).where("_place = 1").drop("_place")
    texts = named.select("doc_id", digest.alias("_digest")).join(again, "doc_id", "left_semi").distinct()
    least = texts.groupBy("doc_id").agg(F.min("_digest").alias("_digest"))
    further = texts.join(least, ["doc_id", "_digest"], "left_anti")
    last = named.agg(F.coalesce(F.max("doc_id"), F.lit(0)).cast("long")).first()[0]
    further = store(with_positions(further, "doc_id", "_digest", name="_number", start=last + 1), "further")
    several = several.join(further, ["doc_id", "_digest"], "left").withColumn("_node", F.coalesce("_number", F.col("doc_id").cast("long")))
    single = docs.join(again, "doc_id", "left_anti").withColumn("_node", F.col("doc_id").cast("long"))
    return single.select(*docs.columns, "_node").union(several.select(*docs.columns, "_node"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles (similarity 0.8) the one with the smallest identifier."""
    small_batches(spark)
    nodes = numbered(spark, docs)
    groups = jaccard_join.join(nodes.where("_node is not null").select(F.col("_node").alias("doc_id"), "text"), words=5, share=80)
    copies = store(groups.where("doc_id <> component_id").select(F.col("doc_id").alias("_node")), "copies")
    return nodes.join(copies, "_node", "left_anti").select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    small_batches(spark)
    found = leaks.find(docs, open_docs(spark, sf_dir, "benchmark"), out="_leaks")
    return found.where(F.size("_leaks") == 0).select(*docs.columns)


def without_private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by pseudonyms; n_chars follows the text."""
    found = private.pseudonymise(docs, PRIVATE_KEY)
    if "n_chars" in docs.columns:
        length = F.when(F.col("n_private") > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType))
        found = found.withColumn("n_chars", length.otherwise(F.col("n_chars")))
    return found.select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their token identifiers (four bytes each); text is what these decode to."""
    small_batches(spark)
    coded = bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    decoded = bpe.decode(coded.drop("text"), RANKS, public_tokenizers.PATTERN, out="text", as_text=True)
    n_tokens = F.call_function("div", F.octet_length("token_ids"), F.lit(4)).cast("long").alias("n_tokens")
    return decoded.select(*docs.columns, "token_ids", n_tokens)


STAGES = [
    ("language ID", known_language),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("PII", without_private_data),
    ("byte-level BPE", tokens),
]

#: Sketches, permutations and tokens are beyond SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; a stage's table is deleted when the next one's is written, and the last one's stays."""
    docs, before = open_docs(spark, sf_dir), None
    for _, stage in STAGES:
        found, path = stage(spark, docs, sf_dir), fresh_path(spark, "stage")
        found.write.parquet(path)
        docs = spark.read.schema(found.schema).parquet(path)
        if before:
            remove_path(spark, before)
        before = path
    return docs
