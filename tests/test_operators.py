import re
import random
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from folioscope.operators import dedupe, evaluate, joins, layout, profile, splits, terms, trends
from folioscope.operators.upsert import DuplicateKeyError, upsert, upsert_snapshot
from folioscope.sources.tables import write_table

few = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
ARTICLE = "id string, title string, category string, update_date string"
TAXONOMY = "main_category string, sub_category string, description string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- joins ---------------------------------------------------------------------------------


def hot_articles(spark, n=3000):
    """A third of all articles in one category, and a third of all rows under one id."""
    code = F.when(F.col("id") % 3 == 0, "cs.AI").otherwise(F.concat(F.lit("c"), F.col("id") % 50))
    ident = F.when(F.col("id") % 3 == 1, "same").otherwise(F.col("id").cast("string"))
    return spark.range(n).select(
        ident.alias("id"), F.lit("t").alias("title"), F.concat(code, F.lit(" x.Y")).alias("category"),
        F.lit("d").alias("update_date"),
    )


def test_join_strategies_agree_on_a_hot_category(spark, frame):
    taxonomy = frame([("CS", "cs.AI", "AI")] + [("M", f"c{i}", f"d{i}") for i in range(40)], TAXONOMY)
    articles = hot_articles(spark)
    expected = rows(joins.taxonomy_join(articles, taxonomy))
    assert rows(joins.taxonomy_join_broadcast(articles, taxonomy)) == expected
    assert rows(joins.taxonomy_join_broadcast(articles, taxonomy, limit=0)) == expected
    left_out = joins.unmatched_articles(articles, taxonomy).count()
    assert left_out + len(expected) == 3000


def test_broadcast_only_below_the_limit(spark, frame, plan_of):
    taxonomy = frame([("CS", "cs.AI", "AI")], TAXONOMY)
    articles = hot_articles(spark)
    assert "BroadcastHashJoin" in plan_of(joins.taxonomy_join_broadcast(articles, taxonomy))
    salted = plan_of(joins.taxonomy_join_broadcast(articles, taxonomy, limit=0))
    assert "BroadcastHashJoin" not in salted and "SortMergeJoin" in salted and "_salt" in salted


def test_code_listed_twice_does_not_multiply_articles(frame):
    taxonomy = frame([("B", "cs.AI", "two"), ("A", "cs.AI", "one")], TAXONOMY)
    articles = frame([("1", "t", "cs.AI math.CO", "d"), ("2", "t", None, "d"), ("3", "t", "", "d")], ARTICLE)
    joined = joins.taxonomy_join(articles, taxonomy).select("id", "main_category", "main_topic")
    assert rows(joined) == [("1", "A", "one")]


# --- dedupe, profile -----------------------------------------------------------------------


@few
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from(["x", "y", None]), st.integers(0, 3)), max_size=40))
def test_dedupe_keeps_the_first_row_whatever_the_partitioning(spark, data):
    df = spark.createDataFrame(data, "id string, update_date string, n int")
    first = {}
    for row in sorted(data, key=lambda r: (r[1] is not None, r[1] or "", r[2])):
        first.setdefault(row[0], row)
    expected = sorted(first.values(), key=repr)
    assert rows(dedupe.dedupe_by_id(df)) == expected
    assert rows(dedupe.dedupe_by_id(df.repartition(3))) == expected


@few
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from(["2020-01-01", "2020-01-02", "é", "", None]), st.integers(0, 3)), max_size=40))
def test_election_equals_the_plain_aggregate(spark, data):
    df = spark.createDataFrame(data, "id string, update_date string, n int").repartition(3)
    expected = rows(dedupe.one_row_per_key(df, ["id"], ["update_date"]))
    assert rows(dedupe.dedupe_by_id(df)) == expected
    assert rows(dedupe.dedupe_by_id(df, broadcast_bytes=0)) == expected
    by_number = rows(dedupe.one_row_per_key(df, ["id"], ["n"]))
    assert rows(dedupe.elected_row_per_key(df, "id", ["n"])) == by_number


def test_order_numbers_never_fall(spark):
    values = ["", "\x00", "a", "a\x00", "ab", "abcdefg", "abcdefgh", "abcdefgz", "b", "é", "中", None]
    df = spark.createDataFrame([(v,) for v in values], "s string")
    found = df.select("s", dedupe.order_number("s", df.schema["s"].dataType).alias("n")).orderBy(F.asc_nulls_first("s")).collect()
    numbers = [r["n"] for r in found]
    assert numbers == sorted(numbers) and numbers[0] == -1 and len(set(numbers)) == 8


def test_dedupe_moves_only_rows_of_repeated_keys(spark, tmp_path, plan_of):
    path = str(tmp_path / "rows")
    hot_articles(spark).write.parquet(path)
    plan = plan_of(dedupe.dedupe_by_id(spark.read.parquet(path)))
    assert "SortAggregate" not in plan and "WindowGroupLimit" in plan
    assert plan.count(") Exchange") == 1


def test_dedupe_of_a_hot_key(spark):
    df = spark.range(30_000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE string(id) END AS id", "string(id % 100) AS update_date", "id AS n")
    kept = dedupe.dedupe_by_id(df)
    assert kept.count() == 20_001 and kept.where("id = 'hot'").first()["n"] == 0


def test_null_profile_is_one_pass(spark, frame, plan_of):
    df = frame([(1, None), (2, "a"), (None, None)], "n int, s string")
    assert rows(profile.null_profile(df)) == [("n", 1), ("s", 2)]
    assert plan_of(profile.null_profile(df)).count("Exchange") <= 3  # one exchange, named thrice
    assert profile.row_count(df).first()["rows"] == 3


# --- trends --------------------------------------------------------------------------------


def test_trends_keep_undated_articles(spark, frame):
    df = frame(
        [("A", "2001-05-01", 1), ("A", "2001-06-01", 2), ("A", None, 9), ("B", "2000-01-01", 4)],
        "main_category string, d string, authers_num int",
    ).withColumn("article_date", F.to_date("d"))
    counts = [tuple(r) for r in trends.count_by_year_category(df).collect()]
    assert counts == [(None, "A", 1), (2000, "B", 1), (2001, "A", 2)]
    stats = [tuple(r) for r in trends.author_stats_by_year(df, with_min=True).collect()]
    assert stats == [("A", None, 9.0, 9, 9), ("A", 2001, 2.0, 1, 2), ("B", 2000, 4.0, 4, 4)]
    series = [tuple(r) for r in trends.category_series(df).collect()]
    assert series == [("A", 3, None, 1), ("A", 3, 2001, 2), ("B", 1, 2000, 1)]


# --- splits --------------------------------------------------------------------------------


@few
@given(st.lists(st.one_of(st.none(), st.text(max_size=8)), min_size=1, max_size=80), st.integers(0, 100))
def test_split_parts_are_disjoint_and_cover(spark, ids, percent):
    df = spark.createDataFrame([(i, n) for n, i in enumerate(ids)], "id string, n int")
    training, testing = splits.ratio_split(df, percent / 100)
    parts = [{r["n"] for r in part.collect()} for part in (training, testing)]
    assert not parts[0] & parts[1] and parts[0] | parts[1] == set(range(len(ids)))


def test_test_parts(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("id"))
    train = {r["id"] for r in splits.training_part(df).collect()}
    assert abs(len(train) - 4000) < 150
    for part, share in splits.TEST_SHARES.items():
        whole = {r["id"] for r in splits.testing_part(df, part).collect()}
        assert abs(len(whole) - 50 * share) < 150 and whole & train
        held_out = {r["id"] for r in splits.testing_part(df, part, disjoint=True).collect()}
        assert held_out and not held_out & train
    moved = {r["id"] for r in splits.training_part(df.repartition(7)).collect()}
    assert moved == train
    assert sum(p.count() for p in splits.random_split(df, [0.8, 0.2])) == 5000


def test_parts_come_from_one_scan(spark, tmp_path, plan_of):
    write_table(spark.range(500).selectExpr("cast(id as string) as id"), str(tmp_path / "ids"))
    df = spark.read.parquet(f"{tmp_path}/ids")
    for disjoint in (False, True):
        parts = splits.testing_parts(df, disjoint=disjoint)
        assert plan_of(parts).count("Scan parquet") == 2  # one in the tree, one in the details
        for part in splits.TEST_SHARES:
            alone = {r["id"] for r in splits.testing_part(df, part, disjoint=disjoint).collect()}
            assert {r["id"] for r in parts.where(f"part = '{part}'").collect()} == alone
    both = splits.ratio_parts(df, 0.3)
    assert plan_of(both).count("Scan parquet") == 2
    assert rows(both.where("part = 'train'").select("id")) == rows(splits.ratio_split(df, 0.3)[0])


# --- upsert --------------------------------------------------------------------------------

PREDICTIONS = "id string, main_category string, label double, prediction double"
TARGET = [("a", "x", 0.0, 0.0), ("b", "x", 0.0, 0.0), (None, "x", 0.0, 0.0)]
UPDATES = [("b", "y", 1.0, 2.0), ("c", "y", 1.0, 2.0), (None, "y", 1.0, 2.0)]
MERGED = [
    ("a", "x", 0.0, 0.0), ("b", "x", 1.0, 2.0), ("c", "y", 1.0, 2.0),
    (None, "x", 0.0, 0.0), (None, "y", 1.0, 2.0),
]


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_upsert(frame, limit):
    target, updates = frame(TARGET, PREDICTIONS), frame(UPDATES, PREDICTIONS)
    assert rows(upsert(target, updates, broadcast_bytes=limit)) == sorted(MERGED, key=repr)


@few
@given(
    st.lists(st.tuples(st.sampled_from(["a", "b", "c", "d", None]), st.integers(0, 9)), max_size=30),
    st.dictionaries(st.sampled_from(["a", "b", "x", "y"]), st.integers(10, 19), max_size=4),
    st.booleans(),
)
def test_upsert_matches_a_plain_merge_and_is_idempotent(spark, old, new, small):
    """Also with a key that the target repeats many times."""
    limit = (1 << 20) if small else 0
    target = spark.createDataFrame([(k, "t", float(v), float(v)) for k, v in old], PREDICTIONS)
    updates = spark.createDataFrame([(k, "u", float(v), float(v)) for k, v in new.items()], PREDICTIONS)
    expected = [(k, "t", float(new.get(k, v)), float(new.get(k, v))) for k, v in old]
    held = {k for k, _ in old}
    expected += [(k, "u", float(v), float(v)) for k, v in new.items() if k not in held]
    once = upsert(target, updates, broadcast_bytes=limit)
    assert rows(once) == sorted(expected, key=repr)
    assert rows(upsert(once, updates, broadcast_bytes=limit)) == sorted(expected, key=repr)


def test_upsert_columns(frame):
    wide = "id string, title string, main_category string, label double, prediction double"
    target = frame([("a", "t", "x", 0.0, 0.0)], wide)
    updates = frame([("c", "u", "y", 1.0, 2.0)], wide)
    some = upsert(target, updates, insert_columns=["id", "main_category", "label", "prediction"])
    assert rows(some)[1] == ("c", None, "y", 1.0, 2.0)
    assert rows(upsert(target, updates))[1] == ("c", "u", "y", 1.0, 2.0)


def test_small_updates_leave_the_target_where_it_is(spark, frame, tmp_path, plan_of):
    path = str(tmp_path / "t")
    write_table(frame(TARGET, PREDICTIONS), path)
    updated = upsert(spark.read.parquet(path), frame(UPDATES, PREDICTIONS))
    plan = plan_of(updated)
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_large_updates_read_the_target_twice(spark, frame, tmp_path, plan_of):
    """Once whole, once for its keys; two shuffled joins and no aggregation."""
    for name, held in (("t", TARGET), ("u", UPDATES)):
        write_table(frame(held, PREDICTIONS), str(tmp_path / name))
    merged = upsert(spark.read.parquet(f"{tmp_path}/t"), spark.read.parquet(f"{tmp_path}/u"), broadcast_bytes=0)
    nodes = re.findall(r"^\(\d+\) (\S+)", plan_of(merged.hint("merge")), re.M)
    locations = re.findall(r"Location: \S+ \[file:\S*/(\w+)\]", plan_of(merged))
    assert locations.count("t") == 2 and not any("Aggregate" in n for n in nodes)


def test_repeated_update_key_is_refused(frame):
    with pytest.raises(DuplicateKeyError):
        upsert(frame(TARGET, PREDICTIONS), frame(UPDATES + UPDATES[:1], PREDICTIONS))


def test_snapshots(spark, frame, tmp_path):
    first, second = str(tmp_path / "1"), str(tmp_path / "2")
    upsert_snapshot(spark, None, frame(TARGET, PREDICTIONS), first)
    merged = upsert_snapshot(spark, first, frame(UPDATES, PREDICTIONS), second)
    assert rows(merged) == sorted(MERGED, key=repr)
    assert spark.read.parquet(first).count() == 3


# --- metrics -------------------------------------------------------------------------------


@few
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 4)), min_size=1, max_size=60))
def test_metrics_equal_the_library_evaluator(spark, pairs):
    df = spark.createDataFrame([(float(a), float(b)) for a, b in pairs], "label double, prediction double")
    for name, value in [
        ("accuracy", evaluate.accuracy(df).first()["accuracy"]),
        ("f1", evaluate.weighted_f1(df).first()["f1"]),
    ]:
        assert value == pytest.approx(MulticlassClassificationEvaluator(metricName=name).evaluate(df), abs=1e-9)


# --- terms ---------------------------------------------------------------------------------


@pytest.mark.parametrize("size", [1, 7, 50, 299, 300, 1000])
def test_vocabulary_is_the_exact_top(spark, size):
    rng = random.Random(size)
    counts = {f"t{i:03d}": min(4000 // (i + 1), 10 ** rng.randint(0, 4)) + 1 for i in range(300)}
    stats = spark.createDataFrame([(t, c, 1) for t, c in counts.items()], "term string, count long, df long")
    best = sorted(counts, key=lambda t: (-counts[t], t))[:size]
    assert sorted(r["term"] for r in terms.vocabulary(stats, size).collect()) == sorted(best)


def test_statistics_have_no_cap(spark):
    """Every term of a corpus with more of them than a fitted model would hold."""
    found = spark.range(300_000).selectExpr("cast(id % 7 as string) as id", "concat('t', id) as term", "1 as tf")
    statistics = terms.weighted_statistics(found, 7)
    assert statistics.count() == 300_000
    assert terms.weighted_terms(found, statistics).count() == 300_000


def test_vocabulary_of_nothing(spark):
    stats = spark.createDataFrame([], "term string, count long, df long")
    assert terms.vocabulary(stats, 5).count() == 0


def test_terms_of_a_document_need_no_shuffle(spark, frame, plan_of):
    df = frame([("1", "The cat, the CAT and a dog"), ("2", "dog dog"), ("3", ""), ("4", "the")], "id string, text string")
    found = terms.document_terms(terms.document_words(df))
    assert rows(found) == [("1", "cat", 2), ("1", "dog", 1), ("2", "dog", 2)]
    assert "Exchange" not in plan_of(found)
    assert rows(terms.term_statistics(found)) == [("cat", 2, 1), ("dog", 3, 2)]
    known = terms.weighted_statistics(found, 4).where("term = 'dog'")
    weights = {r["id"]: r["weight"] for r in terms.weighted_terms(found, known).collect()}
    assert weights["2"] == pytest.approx(2 * weights["1"])


def murmur(data: bytes, seed: int = 42) -> int:
    """MurmurHash3, 32 bits, over bytes."""
    h, mask = seed, 0xFFFFFFFF

    def mixed(k):
        k = (k * 0xCC9E2D51) & mask
        k = ((k << 15) | (k >> 17)) & mask
        return (k * 0x1B873593) & mask

    whole = len(data) // 4 * 4
    for i in range(0, whole, 4):
        h ^= mixed(int.from_bytes(data[i : i + 4], "little"))
        h = ((h << 13) | (h >> 19)) & mask
        h = (h * 5 + 0xE6546B64) & mask
    if data[whole:]:
        h ^= mixed(int.from_bytes(data[whole:], "little"))
    h ^= len(data)
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 1)):
        h ^= h >> shift
        h = (h * factor) & mask
    return h - (1 << 32) if h >> 31 else h


def test_hashed_counts_against_brute_force(spark):
    from folioscope.operators.learn import HashingTF
    from pyspark.ml.functions import vector_to_array

    words = ["cat", "dog", "cat", "zebra", "x", "longer words here", "été"]
    df = spark.createDataFrame([(words,)], "words array<string>")
    hashed = HashingTF(numFeatures=20, inputCol="words", outputCol="c").transform(df)
    got = hashed.select(vector_to_array("c").alias("c")).first()["c"]
    expected = Counter(murmur(w.encode()) % 20 for w in words)
    assert {i: int(v) for i, v in enumerate(got) if v} == dict(expected)


# --- layout --------------------------------------------------------------------------------


def test_layout(spark, tmp_path):
    df = spark.range(100)
    assert layout.partition_count(layout.repartition_n(df, 7)) == 7
    assert layout.repartition_n(df, 0) is df
    with layout.cache_materialised(df) as (held, n):
        assert n == 100 and held.storageLevel.useMemory
    assert not held.storageLevel.useMemory
    assert layout.row_bytes(df.select(F.lit("abcd").alias("s"), F.lit(None).cast("string").alias("t"))) == 100 * 20
    stored = layout.stored(df, "x")
    assert stored.count() == 100 and "/x-" in stored.inputFiles()[0]
