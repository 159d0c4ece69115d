"""Bitmaps of keys that cut a join's input down, and upserts of single folders."""

import os
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioscope.operators import prune, upsert

keys = st.lists(st.sampled_from([None, "", "a", "b", "c", "é", "long key"]), max_size=20)


@settings(max_examples=15, deadline=None)
@given(keys, keys)
def test_pruned_joins_equal_the_plain_ones(spark, left, right):
    target = spark.createDataFrame(list(enumerate(left)), "n int, id string")
    updates = spark.createDataFrame([(k, i) for i, k in enumerate(right)], "id string, m int")
    got = prune.pruned_join(target, updates, "id").select("n", "id", "m").collect()
    want = target.join(updates, "id").select("n", "id", "m").collect()
    assert sorted(map(str, got)) == sorted(map(str, want))
    rest = prune.pruned_anti_join(target, updates, "id", "id").collect()
    assert sorted(map(str, rest)) == sorted(map(str, target.join(updates, "id", "left_anti").select("n", "id").collect()))


@pytest.mark.parametrize("size", [None, 1])
def test_bitmap_has_every_key_and_few_others(spark, size):
    listed = spark.range(0, 20_000, 4).select(F.concat(F.lit("k"), "id").alias("id"))
    bitmap, rows = prune.key_bitmap(listed, "id", size)
    everything = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("id"))
    kept = prune.may_match(everything, "id", bitmap, rows)
    assert kept.join(listed, "id", "left_semi").count() == 5000
    assert rows == (1 if size else 4) and kept.count() < (7200 if size else 6200)
    others = prune.may_match(everything, "id", bitmap, rows, negate=True)
    assert kept.count() + others.count() == 20_000 and others.join(listed, "id", "left_semi").isEmpty()


def test_only_rows_that_may_match_are_shuffled(spark, tmp_path, plan_of):
    spark.range(100_000).select("id", (F.col("id") * 2).alias("v")).write.parquet(str(tmp_path / "t"))
    spark.range(0, 100_000, 1000).select("id", (F.col("id") * 3).alias("w")).write.parquet(str(tmp_path / "u"))
    target, updates = spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(str(tmp_path / "u"))
    bitmap, rows = prune.key_bitmap(updates, "id")
    assert prune.may_match(target, "id", bitmap, rows).count() < 10_000
    plan = plan_of(prune.pruned_join(target, updates, "id"))
    assert "bitmap" in plan or "_bits" in plan
    assert prune.pruned_join(target, updates, "id").count() == 100


SCHEMA = "id string, title string, label double, prediction double"


def files_of(path):
    return {f: os.stat(f).st_mtime_ns for f in Path(path).rglob("*.parquet")}


def test_untouched_folders_keep_their_files(spark, tmp_path):
    rows = [(f"k{i}", f"t{i}", 0.0, 1.0) for i in range(200)] + [(None, "none", 0.0, 0.0)]
    path = str(tmp_path / "t")
    upsert.write_folders(spark.createDataFrame(rows, SCHEMA), path, folders=16)
    before = files_of(path)
    updates = spark.createDataFrame([("k3", "new", 5.0, 6.0), ("fresh", "new", 7.0, 8.0)], SCHEMA)
    after_table = upsert.upsert_folders(spark, path, updates)
    after = files_of(path)
    kept = set(before) & set(after)
    assert all(before[f] == after[f] for f in kept)
    assert len({f.parent for f in set(before) - kept}) <= 2 and len({f.parent for f in kept}) >= 14
    want = [r for r in rows if r[0] != "k3"] + [("k3", "t3", 5.0, 6.0), ("fresh", "new", 7.0, 8.0)]
    assert sorted(map(str, map(tuple, after_table.collect()))) == sorted(map(str, want))
    again = upsert.upsert_folders(spark, path, updates)
    assert sorted(map(str, map(tuple, again.collect()))) == sorted(map(str, want))


@settings(max_examples=8, deadline=None)
@given(
    st.lists(st.tuples(st.sampled_from([None, "a", "b", "c", "d"]), st.integers(0, 9)), max_size=12),
    st.lists(st.tuples(st.sampled_from([None, "a", "c", "e"]), st.integers(0, 9)), max_size=6, unique_by=lambda r: r[0]),
)
def test_folders_equal_the_plain_upsert(spark, tmp_path_factory, old, new):
    path = str(tmp_path_factory.mktemp("folders") / "t")
    target = spark.createDataFrame([(k, f"t{n}", float(n), 0.0) for k, n in [*old, ("z", 1)]], SCHEMA)
    updates = spark.createDataFrame([(k, f"u{n}", float(n), 1.0) for k, n in new], SCHEMA)
    upsert.write_folders(target, path, folders=3)
    want = upsert.upsert(target, updates).collect()
    assert sorted(map(str, upsert.upsert_folders(spark, path, updates).collect())) == sorted(map(str, want))


def test_a_plain_table_is_refused(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    with pytest.raises(ValueError):
        upsert.read_folders(spark, str(tmp_path / "t"))
