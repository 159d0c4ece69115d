"""One query per operator, each over whole tables of a data folder."""

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.functions import (
    article_date,
    article_year,
    author_count,
    category_case,
    category_shorten,
    clean_update_date,
    main_category_of,
    primary_category,
    strip_parens,
    text_concat,
)
from folioscope.functions.categories import DEFAULT_MAIN_CATEGORY, MAIN_CATEGORIES
from folioscope.operators import dedupe, evaluate, joins, labels, layout, learn, positions, profile, prune, splits, terms, trends
from folioscope.operators import upsert as merging
from folioscope.operators.enrich import drop_helpers, enrich_articles, filter_null
from folioscope.plans.views import open_table, open_view
from folioscope.schema import ARTICLE_SCHEMA, PREDICTION_SCHEMA
from folioscope.session import fresh_path
from folioscope.sources import delimited, raw_json, tables, taxonomy_pages

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: Author count of an article without authors, as in the averages being matched.
NO_AUTHORS = -1

#: Repartitioning target of the layout queries.
LAYOUT_PARTITIONS = 12

#: Slots of the hashed-counts query.
HASH_SLOTS = 20


def query(key: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[key] = function
        return function

    return register


def _articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return open_view(spark, sf_dir, "articles")


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    taxonomy = open_view(spark, sf_dir, "taxonomy")
    return enrich_articles(_articles(spark, sf_dir), taxonomy, NO_AUTHORS)


def _scanned(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = open_view(spark, sf_dir, "raw_lines").select("value")
    return raw_json.scan_lines(lines)


def _written_records(spark: SparkSession, sf_dir: str) -> str:
    path = fresh_path(spark, "records")
    raw_json.write_lines(raw_json.flatten_records(_scanned(spark, sf_dir)), path)
    return path


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts under their language."""
    return open_view(spark, sf_dir, "article_texts").select("id", F.col("lang").alias("main_category"), "text")


def _categorised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts under the main category of their code."""
    texts = open_view(spark, sf_dir, "article_texts")
    joined = joins.taxonomy_join_broadcast(texts, open_view(spark, sf_dir, "taxonomy"))
    return joined.select("id", "main_category", "text")


def _placed(df: DataFrame, *order: Column | str) -> DataFrame:
    """Rows with their place in an order, from 1."""
    return positions.with_positions(df, *order, start=1).withColumn("position", F.col("position").cast("int"))


# --- sources and sinks ---------------------------------------------------------------------


@query("json_line_extract")
def json_line_extract(spark, sf_dir):
    """Fields cut out of each line by position."""
    return _scanned(spark, sf_dir)


@query("json_line_parse")
def json_line_parse(spark, sf_dir):
    """The same fields from parsed JSON."""
    lines = open_view(spark, sf_dir, "raw_lines").select("value")
    return raw_json.parse_lines(lines)


@query("record_flatten")
def record_flatten(spark, sf_dir):
    return raw_json.flatten_records(_scanned(spark, sf_dir))


@query("convert_parsed")
def convert_parsed(spark, sf_dir):
    """Parsed JSON to delimited records and back, with line breaks and delimiters in the titles."""
    articles = open_view(spark, sf_dir, "broken_titles")
    renamed = articles.withColumnsRenamed({"journal_ref": "journal-ref", "category": "categories"})
    lines = renamed.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in renamed.columns])).alias("value"))
    path = fresh_path(spark, "parsed-records")
    raw_json.write_lines(raw_json.flatten_records(raw_json.parse_lines(lines), clean=True), path)
    return delimited.read_records(spark, path)


@query("text_sink")
def text_sink(spark, sf_dir):
    return raw_json.read_lines(spark, _written_records(spark, sf_dir))


@query("delimited_scan")
def delimited_scan(spark, sf_dir):
    return delimited.read_records(spark, _written_records(spark, sf_dir))


@query("delimited_scan_broken")
def delimited_scan_broken(spark, sf_dir):
    """Records written with the line breaks that titles and abstracts hold, read back whole."""
    path = fresh_path(spark, "broken-records")
    raw_json.write_lines(raw_json.flatten_records(_articles(spark, sf_dir)), path)
    return delimited.read_broken_records(spark, path)


@query("glob_scan")
def glob_scan(spark, sf_dir):
    records = delimited.read_records(spark, _written_records(spark, sf_dir) + "/part*")
    return trends.count_by(records, "category")


@query("header_csv_scan")
def header_csv_scan(spark, sf_dir):
    path = fresh_path(spark, "with-header")
    articles = _articles(spark, sf_dir).select("doc_id", "id", "authors", "category", "lang")
    articles.write.option("header", True).option("escape", '"').csv(path)
    return delimited.read_header_csv(spark, path)


@query("header_csv_long_text")
def header_csv_long_text(spark, sf_dir):
    path = fresh_path(spark, "long-text")
    articles = _articles(spark, sf_dir).select("doc_id", F.concat_ws('\n"a, b"\n', "title", "abstract").alias("abstract"))
    writer = articles.repartition(spark.sparkContext.defaultParallelism).write.option("header", True).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    schema = articles.schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")
    return delimited.read_header_csv(spark, path, schema, multi_line=True)


@query("html_taxonomy_extract")
def html_taxonomy_extract(spark, sf_dir):
    pages = open_view(spark, sf_dir, "taxonomy_pages")
    return taxonomy_pages.taxonomy_entries(pages, keep=("page_id",))


@query("taxonomy_bucket")
def taxonomy_bucket(spark, sf_dir):
    return taxonomy_pages.taxonomy_table(open_view(spark, sf_dir, "taxonomy_pages"))


@query("main_category_rows")
def main_category_rows(spark, sf_dir):
    pages = open_view(spark, sf_dir, "taxonomy_pages")
    return taxonomy_pages.main_category_rows(pages, keep=("page_id",))


@query("page_links")
def page_links(spark, sf_dir):
    return taxonomy_pages.page_links(open_table(spark, sf_dir, "pages"), keep=("page_id",))


@query("page_headings")
def page_headings(spark, sf_dir):
    return taxonomy_pages.page_headings(open_table(spark, sf_dir, "pages"), keep=("page_id",))


@query("local_rows_source")
def local_rows_source(spark, sf_dir):
    """Main categories from seven literal rows, joined to every article's code."""
    names = spark.createDataFrame(list(MAIN_CATEGORIES.items()), ["prefix", "name"])
    coded = open_view(spark, sf_dir, "coded_articles").select(
        "id", F.get(F.split("category", r"\."), F.lit(0)).alias("prefix")
    )
    main = F.coalesce("name", F.lit(DEFAULT_MAIN_CATEGORY)).alias("main_category")
    return coded.join(F.broadcast(names), "prefix", "left").select("id", main)


@query("table_write")
def table_write(spark, sf_dir):
    path = fresh_path(spark, "preprocessing")
    tables.write_table(_enriched(spark, sf_dir), path)
    return tables.read_table(spark, path)


@query("table_scan")
def table_scan(spark, sf_dir):
    """A stored table read back; only the two asked-for columns leave the files."""
    path = fresh_path(spark, "scanned")
    tables.write_table(_enriched(spark, sf_dir), path)
    return tables.read_table(spark, path).select("id", "main_topic")


@query("write_if_absent")
def write_if_absent(spark, sf_dir):
    """The second write finds the table there and leaves it alone."""
    path = fresh_path(spark, "write-once")
    articles = _articles(spark, sf_dir).select("id", "category")
    tables.write_if_absent(articles, path)
    tables.write_if_absent(articles.withColumn("category", F.lit("overwritten")), path)
    return tables.read_table(spark, path)


@query("partitioned_write")
def partitioned_write(spark, sf_dir):
    path = fresh_path(spark, "by-category")
    enriched = _enriched(spark, sf_dir).select("id", "authers_num", "main_topic", "main_category")
    tables.write_partitioned(enriched, path)
    return tables.read_table(spark, path)


def _upsert(spark, sf_dir, insert_columns):
    current, destination = fresh_path(spark, "predictions"), fresh_path(spark, "predictions")
    tables.write_table(open_view(spark, sf_dir, "stored_predictions"), current)
    updates = layout.stored(open_view(spark, sf_dir, "new_predictions"), "updates")
    return merging.upsert_snapshot(
        spark, current, updates, destination, insert_columns=insert_columns
    )


@query("upsert")
def upsert(spark, sf_dir):
    return _upsert(spark, sf_dir, PREDICTION_SCHEMA.fieldNames())


@query("upsert_insert_all")
def upsert_insert_all(spark, sf_dir):
    return _upsert(spark, sf_dir, None)


@query("upsert_folders")
def upsert_folders(spark, sf_dir):
    """The same upsert on a table of key-hash folders, in place."""
    path = fresh_path(spark, "prediction-folders")
    merging.write_folders(open_view(spark, sf_dir, "stored_predictions"), path)
    updates = layout.stored(open_view(spark, sf_dir, "new_predictions"), "updates")
    return merging.upsert_folders(spark, path, updates, insert_columns=PREDICTION_SCHEMA.fieldNames())


# --- projections and filters ---------------------------------------------------------------


@query("rename_positional")
def rename_positional(spark, sf_dir):
    """Columns by position, as a reader without a schema names them."""
    articles = _articles(spark, sf_dir).select(*ARTICLE_SCHEMA.fieldNames())
    unnamed = articles.toDF(*[f"_c{i}" for i in range(len(articles.columns))])
    return delimited.rename_positional(unnamed)


@query("project")
def project(spark, sf_dir):
    taxonomy = open_view(spark, sf_dir, "taxonomy")
    joined = joins.taxonomy_join(_articles(spark, sf_dir), taxonomy)
    return joined.select("id", "category", "main_category", "main_topic")


@query("derive_column")
def derive_column(spark, sf_dir):
    derived = _articles(spark, sf_dir).withColumns(
        {"category1": primary_category("category"), "update_date": clean_update_date("update_date")}
    )
    return derived.select("id", "category1", "update_date")


@query("drop_column")
def drop_column(spark, sf_dir):
    helped = _articles(spark, sf_dir).withColumn("_helper", F.length("abstract"))
    return drop_helpers(helped, "_helper", "abstract", "title")


@query("filter_eq")
def filter_eq(spark, sf_dir):
    stats = trends.author_stats_by_year(_enriched(spark, sf_dir))
    return stats.where(F.col("main_category") == "ASIA")


@query("filter_is_null")
def filter_is_null(spark, sf_dir):
    return filter_null(_articles(spark, sf_dir).select("id", "title", "authors"), "title")


@query("predicate_contains")
def predicate_contains(spark, sf_dir):
    return _articles(spark, sf_dir).where(F.col("id").contains("/")).select("id", "category")


@query("predicate_compare")
def predicate_compare(spark, sf_dir):
    """Old-style identifiers of the nineties."""
    year = F.substring(F.get(F.split("id", "/"), F.lit(1)), 1, 2)
    nineties = F.col("id").contains("/") & (year >= "90")
    return _articles(spark, sf_dir).where(nineties).select("id", year.alias("yy"))


# --- joins ---------------------------------------------------------------------------------


@query("taxonomy_join")
def taxonomy_join(spark, sf_dir):
    return joins.taxonomy_join(_articles(spark, sf_dir), open_view(spark, sf_dir, "taxonomy"))


@query("taxonomy_join_broadcast")
def taxonomy_join_broadcast(spark, sf_dir):
    return joins.taxonomy_join_broadcast(
        _articles(spark, sf_dir), open_view(spark, sf_dir, "taxonomy")
    )


@query("taxonomy_join_salted")
def taxonomy_join_salted(spark, sf_dir):
    """The join as it runs when the taxonomy is too large to broadcast."""
    return joins.taxonomy_join_broadcast(
        _articles(spark, sf_dir), open_view(spark, sf_dir, "taxonomy"), limit=0
    )


@query("taxonomy_unmatched")
def taxonomy_unmatched(spark, sf_dir):
    """What the inner join leaves out."""
    articles = _articles(spark, sf_dir).select("id", "category")
    return joins.unmatched_articles(articles, open_view(spark, sf_dir, "taxonomy"))


@query("merge_match")
def merge_match(spark, sf_dir):
    """Rows of the stored table that updates match, with old and new prediction."""
    target = open_view(spark, sf_dir, "stored_predictions").select("id", "prediction")
    updates = open_view(spark, sf_dir, "new_predictions")
    renamed = layout.stored(updates.select("id", F.col("prediction").alias("new_prediction")), "updates")
    return prune.pruned_join(target, renamed, "id").select("id", "prediction", "new_prediction")


# --- aggregations, sorts -------------------------------------------------------------------


@query("count_by_category")
def count_by_category(spark, sf_dir):
    return trends.count_by_category(_enriched(spark, sf_dir))


@query("topic_counts")
def topic_counts(spark, sf_dir):
    return trends.topic_counts(_enriched(spark, sf_dir))


@query("count_by_year_category")
def count_by_year_category(spark, sf_dir):
    return trends.count_by_year_category(_enriched(spark, sf_dir))


@query("author_stats_by_year")
def author_stats_by_year(spark, sf_dir):
    return trends.author_stats_by_year(_enriched(spark, sf_dir))


@query("author_stats_by_year_min")
def author_stats_by_year_min(spark, sf_dir):
    return trends.author_stats_by_year(_enriched(spark, sf_dir), with_min=True)


@query("author_stats_by_category")
def author_stats_by_category(spark, sf_dir):
    return trends.author_stats_by_category(_enriched(spark, sf_dir))


@query("max_of_max")
def max_of_max(spark, sf_dir):
    return trends.max_of_max(trends.author_stats_by_year(_enriched(spark, sf_dir)))


@query("row_count")
def row_count(spark, sf_dir):
    return profile.row_count(open_table(spark, sf_dir, "events"))


@query("null_profile")
def null_profile(spark, sf_dir):
    return profile.null_profile(_articles(spark, sf_dir))


@query("null_date_count")
def null_date_count(spark, sf_dir):
    dated = _articles(spark, sf_dir).select(article_date("id").alias("article_date"))
    return profile.null_date_count(dated)


@query("dedupe_by_id")
def dedupe_by_id(spark, sf_dir):
    return dedupe.dedupe_by_id(open_view(spark, sf_dir, "revisions"))


@query("dedupe_by_id_shuffled")
def dedupe_by_id_shuffled(spark, sf_dir):
    """As it runs when too many identifiers repeat for a broadcast."""
    return dedupe.dedupe_by_id(open_view(spark, sf_dir, "revisions"), broadcast_bytes=0)


@query("sort_mixed")
def sort_mixed(spark, sf_dir):
    counts = trends.count_by(_articles(spark, sf_dir), "lang", primary_category().alias("code"))
    order = [F.asc("lang"), F.desc("count"), F.asc("code")]
    return _placed(counts, *order).orderBy(*order)


@query("sort_multi")
def sort_multi(spark, sf_dir):
    enriched = _enriched(spark, sf_dir)
    stats = trends.author_stats(enriched, "main_category", "main_topic")
    order = ["main_category", "main_topic", "avg_authors"]
    return _placed(stats, *order).orderBy(*order)


@query("sort_desc_pandas")
def sort_desc_pandas(spark, sf_dir):
    """Categories by falling maximum; the sort stays in Spark."""
    stats = trends.author_stats(_enriched(spark, sf_dir), "main_category")
    order = [F.desc("max_authors"), F.desc("avg_authors"), "main_category"]
    return _placed(stats, *order).orderBy(*order)


@query("top_k")
def top_k(spark, sf_dir):
    counts = trends.count_by(_enriched(spark, sf_dir), "main_topic")
    order = [F.desc("count"), "main_topic"]
    return _placed(trends.top_k(counts, order, 10), *order)


@query("category_series")
def category_series(spark, sf_dir):
    return trends.category_series(_enriched(spark, sf_dir))


# --- scalar functions ----------------------------------------------------------------------


@query("primary_category")
def primary_category_of(spark, sf_dir):
    coded = open_view(spark, sf_dir, "coded_articles")
    return coded.select("id", primary_category("category").alias("category1"))


@query("category_case")
def category_case_of(spark, sf_dir):
    """Both name variants, side by side."""
    coded = open_view(spark, sf_dir, "coded_articles")
    return coded.select(
        "id",
        category_case("category", short=True).alias("short_name"),
        category_case("category", short=False).alias("long_name"),
    )


@query("category_shorten")
def category_shorten_of(spark, sf_dir):
    main = open_view(spark, sf_dir, "coded_articles").select(
        "id", main_category_of("category").alias("main_category")
    )
    return main.select("id", category_shorten("main_category").alias("main_category"))


@query("article_date")
def article_date_of(spark, sf_dir):
    return _articles(spark, sf_dir).select("id", article_date("id").alias("article_date"))


@query("article_year")
def article_year_of(spark, sf_dir):
    dated = _articles(spark, sf_dir).select("id", article_date("id").alias("article_date"))
    return dated.select("id", article_year("article_date").alias("year"))


@query("update_date_clean")
def update_date_clean(spark, sf_dir):
    articles = _articles(spark, sf_dir)
    return articles.select("id", clean_update_date("update_date").alias("update_date"))


@query("author_count")
def author_count_of(spark, sf_dir):
    """The three ways to count: NULL kept, NULL as -1, Oxford commas understood."""
    return _articles(spark, sf_dir).select(
        "id",
        author_count("authors").alias("authers_num"),
        author_count("authors", missing=NO_AUTHORS).alias("authers_num_filled"),
        author_count("authors", clean=True).alias("authers_num_clean"),
    )


@query("text_concat")
def text_concat_of(spark, sf_dir):
    return _articles(spark, sf_dir).select("id", text_concat("title", "abstract").alias("text"))


@query("round_avg")
def round_avg(spark, sf_dir):
    counted = _articles(spark, sf_dir).select(
        "lang", author_count("authors", missing=NO_AUTHORS).alias("authers_num")
    )
    return counted.groupBy("lang").agg(F.round(F.avg("authers_num"), 0).alias("avg_authors"))


@query("strip_parens")
def strip_parens_of(spark, sf_dir):
    wrapped = F.concat(F.lit("(("), "title", F.lit(" (x))"))
    return _articles(spark, sf_dir).select("id", strip_parens(wrapped).alias("stripped"))


# --- splits --------------------------------------------------------------------------------


@query("split_train")
def split_train(spark, sf_dir):
    return splits.training_part(_articles(spark, sf_dir).select("id", "category"))


@query("split_tests")
def split_tests(spark, sf_dir):
    """All three test parts, told apart by a column."""
    return splits.testing_parts(_articles(spark, sf_dir).select("id", "category"))


@query("split_tests_disjoint")
def split_tests_disjoint(spark, sf_dir):
    """The test parts cut from the articles held out of training."""
    return splits.testing_parts(_articles(spark, sf_dir).select("id", "category"), disjoint=True)


@query("split_ratio")
def split_ratio(spark, sf_dir):
    return splits.ratio_parts(_articles(spark, sf_dir).select("id", "category"), 0.3)


@query("random_split")
def random_split(spark, sf_dir):
    """Spark's sampled split, which varies with partitioning: rows in total, in both parts, in neither."""
    articles = _articles(spark, sf_dir).select("doc_id")
    parts = splits.random_split(articles, [0.8, 0.2])
    drawn = parts[0].withColumn("part", F.lit(0)).unionByName(parts[1].withColumn("part", F.lit(1)))
    per_row = articles.join(drawn, "doc_id", "left").groupBy("doc_id").agg(F.count("part").alias("times"))
    return per_row.agg(
        F.sum("times").alias("rows_total"), F.count_if(F.col("times") > 1).alias("rows_in_both"), F.count_if(F.col("times") == 0).alias("rows_in_neither")
    )


# --- features ------------------------------------------------------------------------------


@query("label_index")
def label_index(spark, sf_dir):
    enriched = _enriched(spark, sf_dir).select("id", "main_category")
    return labels.with_label(enriched, labels.label_table(enriched))


@query("label_index_topics")
def label_index_topics(spark, sf_dir):
    """Labels of which there may be any number, joined by shuffle: codes and update dates together."""
    articles = _articles(spark, sf_dir).select("id", F.concat_ws(" ", "category", "update_date").alias("main_category"))
    return labels.with_label(articles, labels.label_table(articles), broadcast_bytes=0)


def _documents(spark: SparkSession, sf_dir: str) -> int:
    return open_table(spark, sf_dir, "documents").count()


def _words(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = open_view(spark, sf_dir, "article_texts").select("id", "text")
    return terms.document_words(layout.repartition_n(texts, layout.input_partitions(spark)))


@query("tokenise")
def tokenise(spark, sf_dir):
    texts = open_view(spark, sf_dir, "article_texts").select("id", "text")
    return terms.document_tokens(texts).select("id", F.array_join("tokens", " ").alias("tokens"))


@query("stop_words")
def stop_words(spark, sf_dir):
    return _words(spark, sf_dir).select("id", F.array_join("words", " ").alias("words"))


@query("term_counts")
def term_counts(spark, sf_dir):
    """Counts of all words, per document."""
    return terms.document_terms(_words(spark, sf_dir))


@query("vocabulary")
def vocabulary(spark, sf_dir):
    """Corpus count, document frequency and idf of every term."""
    document_terms = terms.document_terms(_words(spark, sf_dir), keep=())
    statistics = terms.weighted_statistics(document_terms, _documents(spark, sf_dir))
    return statistics.withColumn("idf", F.round("idf", 9))


def _weights(spark: SparkSession, sf_dir: str, broadcast_bytes: int = layout.BROADCAST_BYTES) -> DataFrame:
    document_terms = terms.stored_terms(terms.document_terms(_words(spark, sf_dir)))
    documents = _documents(spark, sf_dir)
    dictionary = terms.term_dictionary(terms.weighted_statistics(document_terms, documents))
    encoded = terms.encoded_terms(document_terms, dictionary, documents, broadcast_bytes=broadcast_bytes)
    return encoded.select("id", "term", F.round(F.col("tf") * F.col("idf"), 9).alias("weight"))


@query("idf_weight")
def idf_weight(spark, sf_dir):
    """tf-idf weight of every term of every document."""
    return _weights(spark, sf_dir)


@query("idf_weight_two_part")
def idf_weight_two_part(spark, sf_dir):
    """The same as it runs beyond the broadcast size: heavy terms sent to the tasks, the tail shuffled."""
    return _weights(spark, sf_dir, broadcast_bytes=0)


@query("term_dictionary")
def term_dictionary(spark, sf_dir):
    """Every term with its number by falling count."""
    counted = terms.term_statistics(terms.document_terms(_words(spark, sf_dir), keep=()))
    return terms.term_dictionary(counted).select("term_id", "term", "count", "df")


@query("hashed_counts")
def hashed_counts(spark, sf_dir):
    """Words counted per document and hash slot."""
    hashing = learn.HashingTF(numFeatures=HASH_SLOTS, inputCol="words", outputCol="counts")
    counted = hashing.transform(_words(spark, sf_dir)).select("id", F.posexplode(vector_to_array("counts")).alias("slot", "n"))
    return counted.where("n > 0").select("id", "slot", F.col("n").cast("long").alias("n"))


# --- learning ------------------------------------------------------------------------------


def _held_out_predictions(labelled: DataFrame, kind: str, **params):
    training, testing = splits.ratio_split(labelled, 0.2)
    model = learn.fit_classifier(training, kind, **params)
    return model, learn.predict(model, testing)


@query("classify_nb")
def classify_nb(spark, sf_dir):
    return _held_out_predictions(_labelled(spark, sf_dir), "NB")[1]


@query("classify_nb_category")
def classify_nb_category(spark, sf_dir):
    """By main category, which these texts hardly show: rows differ in their predictions."""
    return _held_out_predictions(_categorised(spark, sf_dir), "NB")[1]


@query("classify_lr")
def classify_lr(spark, sf_dir):
    return _held_out_predictions(_labelled(spark, sf_dir), "LR")[1]


@query("classify_rf")
def classify_rf(spark, sf_dir):
    return _held_out_predictions(_labelled(spark, sf_dir), "RF")[1]


@query("classify_gbt")
def classify_gbt(spark, sf_dir):
    """One boosted model of 100 rounds for each class, four at a time."""
    return _held_out_predictions(_labelled(spark, sf_dir), "GBT", parallelism=4)[1]


@query("model_save")
def model_save(spark, sf_dir):
    """Predictions of a model that was also saved."""
    model, predictions = _held_out_predictions(_labelled(spark, sf_dir), "NB")
    learn.save_model(model, fresh_path(spark, "model"))
    return predictions


@query("model_load")
def model_load(spark, sf_dir):
    """Predictions of a model read back from its folder."""
    path = fresh_path(spark, "model")
    training, testing = splits.ratio_split(_labelled(spark, sf_dir), 0.2)
    learn.save_model(learn.fit_classifier(training, "NB"), path)
    return learn.predict(learn.load_model(path), testing)


@query("metric_accuracy")
def metric_accuracy(spark, sf_dir):
    return evaluate.accuracy(open_view(spark, sf_dir, "scored_labels"))


@query("metric_f1")
def metric_f1(spark, sf_dir):
    scored = evaluate.weighted_f1(open_view(spark, sf_dir, "scored_labels"))
    return scored.withColumn("f1", F.round("f1", 9))


# --- layout --------------------------------------------------------------------------------


@query("repartition_n")
def repartition_n(spark, sf_dir):
    articles = _articles(spark, sf_dir).select("id", "category")
    return layout.repartition_n(articles, LAYOUT_PARTITIONS)


@query("partition_count")
def partition_count(spark, sf_dir):
    """Partitions in use after a repartition, counted by the rows' own partition."""
    spread = layout.repartition_n(_articles(spark, sf_dir).select("id"), LAYOUT_PARTITIONS)
    used = spread.select(F.spark_partition_id().alias("partition")).distinct()
    return used.agg(F.count(F.lit(1)).alias("partitions"))


@query("cache_materialise")
def cache_materialise(spark, sf_dir):
    """Two results from one held frame: its size and its counts by language."""
    languages = _articles(spark, sf_dir).select("lang")
    with layout.cache_materialised(languages) as (held, rows):
        counted = trends.count_by(held, "lang").withColumn("total", F.lit(rows).cast("long"))
        return layout.stored(counted, "language-counts")
