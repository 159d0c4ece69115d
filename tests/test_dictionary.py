"""Positions, the term dictionary and its two-part join, label tables, vectors from runs."""

from collections import Counter
from math import log

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioscope.operators import labels, learn, positions, terms
from folioscope.operators.layout import stored


@pytest.mark.parametrize("parts", [1, 9])
def test_positions_are_global(spark, parts):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("a"), (F.col("id") % 3).alias("b")).repartition(parts)
    placed = positions.with_positions(rows, F.desc("b"), "a", start=1)
    found = [(r["b"], r["a"]) for r in placed.orderBy("position").collect()]
    assert found == sorted(found, key=lambda r: (-r[0], r[1]))
    assert sorted(r["position"] for r in placed.collect()) == list(range(1, 5001))


def test_positions_use_no_single_task(spark, plan_of):
    plan = plan_of(positions.with_positions(spark.range(1000), "id"))
    assert "SinglePartition" not in plan and "Window" not in plan


def test_positions_of_nothing(spark):
    assert positions.with_positions(spark.range(0), "id").collect() == []


@pytest.fixture(scope="module")
def found(spark):
    """Terms of 2,000 documents, one of them in every document."""
    docs = spark.range(2000).select(
        "id", F.array_sort(F.array(F.lit("common"), F.concat(F.lit("w"), F.col("id") % 50), F.concat(F.lit("rare"), "id"))).alias("words")
    )
    return stored(terms.document_terms(docs), "found")


@pytest.fixture(scope="module")
def dictionary(found):
    return terms.term_dictionary(terms.weighted_statistics(found, 2000))


def test_dictionary_numbers_terms_by_count(dictionary, found):
    counts = Counter(r["term"] for r in found.select("term").collect())
    ranked = sorted(counts, key=lambda t: (-counts[t], t))
    assert [r["term"] for r in dictionary.orderBy("term_id").collect()] == ranked
    assert [r["term_id"] for r in dictionary.orderBy("term_id").collect()] == list(range(len(ranked)))


def test_heavy_terms_are_verified(found, dictionary):
    heavy = {r["term"]: r["df"] for r in terms.heavy_terms(found, dictionary, 2000, share=0.5).collect()}
    assert heavy == {"common": 2000}
    assert terms.heavy_terms(found, dictionary, 2000, share=0.01).count() == 51


@pytest.mark.parametrize("limit", [0, 1 << 25])
def test_encoded_terms(found, dictionary, limit):
    encoded = terms.encoded_terms(found, dictionary, 2000, broadcast_bytes=limit)
    number = {r["term"]: r["term_id"] for r in dictionary.collect()}
    got = sorted((r["id"], r["term"], r["term_id"], r["tf"]) for r in encoded.collect())
    assert got == sorted((r["id"], r["term"], number[r["term"]], r["tf"]) for r in found.collect())


def test_a_term_of_every_document_is_not_shuffled(found, dictionary, plan_of):
    """Of the rows that the tail's join deals out, no task gets many more than the median."""
    near = terms.heavy_terms(found, dictionary, 2000, share=0.5)
    tail = found.join(F.broadcast(near.select("term")), "term", "left_anti").select(F.xxhash64("term").alias("term_key"))
    dealt = tail.repartition(16, "term_key").groupBy(F.spark_partition_id().alias("p")).count().collect()
    sizes = sorted(r["count"] for r in dealt)
    assert sum(sizes) == 4000 and sizes[-1] < 2.5 * sizes[len(sizes) // 2]


def test_terms_that_share_a_key_stay_apart(spark, found, dictionary, monkeypatch):
    """With a key of few values nearly all terms collide and are joined by name."""
    narrow = F.xxhash64
    monkeypatch.setattr(terms.F, "xxhash64", lambda *c: narrow(*c) % 40)
    coarse = stored(dictionary.withColumn("term_key", F.xxhash64("term")), "coarse")
    encoded = terms.encoded_terms(found, coarse, 2000, broadcast_bytes=0)
    assert encoded.count() == found.count()
    assert encoded.where((F.col("term") == "common")).count() == 2000
    weights = {r["term"]: r["idf"] for r in encoded.collect()}
    assert weights["common"] == pytest.approx(log(2001 / 2001)) and weights["rare7"] == pytest.approx(log(2001 / 2))


@pytest.mark.parametrize("limit", [0, 1 << 25])
def test_label_table(frame, limit):
    df = frame([("b", 1), ("a", 2), ("c", 3), ("c", 4), (None, 5)], "main_category string, n int")
    table = labels.label_table(df)
    assert {r[0]: r[1] for r in table.collect()} == {"c": 0.0, "a": 1.0, "b": 2.0}
    known = labels.with_label(df.where("main_category is not null"), table, broadcast_bytes=limit)
    stock = learn.label_index(df).transform(df.where("main_category is not null"))
    assert sorted(map(tuple, known.collect())) == sorted(map(tuple, stock.collect()))
    assert labels.with_label(df, table, handle_invalid="skip", broadcast_bytes=limit).count() == 4
    assert labels.with_label(df, table, handle_invalid="keep", broadcast_bytes=limit).where("n = 5").first()["label"] == 3.0
    with pytest.raises(Exception, match="no label for NULL"):
        labels.with_label(df, table, broadcast_bytes=limit).collect()
    with pytest.raises(ValueError):
        labels.with_label(df, table, handle_invalid="ignore")


def test_labels_beyond_the_limit_of_a_model(spark):
    df = spark.range(learn.MAX_CLASSES + 500).select(F.concat(F.lit("l"), "id").alias("main_category"))
    with pytest.raises(learn.TooManyClassesError):
        learn.class_counts(df, "main_category")
    assert labels.with_label(df, labels.label_table(df)).agg(F.countDistinct("label")).first()[0] == learn.MAX_CLASSES + 500


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.floats(0.5, 9)), unique_by=lambda c: c[0], max_size=20))
def test_dense_values(spark, cells):
    df = spark.createDataFrame([(sorted(cells),)], "cells array<struct<slot:int,value:double>>")
    got = df.select(learn.dense_values("cells", 31, F.lit(2.0)).alias("v")).first()["v"]
    assert got == [dict(cells).get(i, 0.0) / 2.0 for i in range(31)]


def test_bayes_shuffles_no_grid(spark):
    """A class without any term of the vocabulary still has its row, of zeros."""
    rows = [("a", "one two one"), ("a", "two"), ("b", "three"), ("c", "")]
    training = spark.createDataFrame(rows, "main_category string, text string")
    model = learn.fit_classifier(training, "NB").stages[-1]
    theta = model.theta.toArray()
    assert theta.shape == (3, 3) and theta[2].tolist() == pytest.approx([log(1 / 3)] * 3)
