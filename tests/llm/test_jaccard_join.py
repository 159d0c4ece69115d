"""The Jaccard join against all pairs compared one by one."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from folioscope.llm import jaccard_join, shingles
from folioscope.llm.queries import QUERIES

ASCII = str.maketrans({i: i + 32 for i in range(65, 91)})


def plain_set(text, words):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII))
    if len(found) < words:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + words]) for i in range(len(found) - words + 1)}


def plain_join(rows, words, share):
    """rows: (doc_id, text); component and set size of each row."""
    sets = [plain_set(t, words) for _, t in rows]
    up = {d: d for d, _ in rows}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    where = {}
    for i, s in enumerate(sets):
        for gram in s:
            where.setdefault(gram, []).append(i)
    for i, s in enumerate(sets):
        near = {}
        for gram in s:
            for j in where[gram]:
                if j < i:
                    near[j] = near.get(j, 0) + 1
        for j, both in near.items():
            if 100 * both >= share * (len(s) + len(sets[j]) - both):
                a, b = sorted((root(rows[i][0]), root(rows[j][0])))
                up[b] = a
    return sorted((d, len(s), root(d)) for (d, _), s in zip(rows, sets, strict=True))


def run(spark, rows, words, share):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(tuple(r) for r in jaccard_join.join(docs, words, share).collect())


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("words, share", [(3, 90), (5, 80), (1, 50)])
def test_groups_of_near_copies(spark, words, share, monkeypatch):
    """Groups whose members differ around the threshold, so that many are linked by way of others only."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 7)
    monkeypatch.setattr(jaccard_join, "FREQUENT_SHARE", 0.05)
    rng = random.Random(words)
    rows = []
    for group in range(12):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([4, 12, 40, 150, 400]))]
        for _ in range(rng.choice([1, 3, 25])):
            base = edited(rng, base, rng.choice([0, 0, 1])).split()  # drifts away from the first
            rows.append((len(rows) * 7 + group, edited(rng, base, rng.choice([0, 0, 1, 2, 5]))))
    passage = " ".join(f"p{i}" for i in range(30))
    rows += [(5000 + i, f"{passage} {edited(rng, ['x'] * 12, 12)}") for i in range(30)]
    rng.shuffle(rows)
    want = plain_join(rows, words, share)
    assert run(spark, rows, words, share) == want
    assert 1 < len({c for _, _, c in want}) < len(want)


def test_edge_rows(spark):
    rows = [(9, "a b c d"), (3, "A  b\tc D"), (4, None), (5, ""), (6, " \n"), (7, "one two"), (8, "ONE two"), (10, "two one"), (9, "a b c d")]
    got = run(spark, rows, 3, 90)
    assert got == [(3, 2, 3), (4, 0, 4), (5, 0, 5), (6, 0, 6), (7, 1, 7), (8, 1, 7), (9, 2, 3), (9, 2, 3), (10, 1, 10)]
    twice = [(1, "a b c d"), (1, "x y z"), (2, "x y z"), (3, "a b c d")]  # one document of two texts
    assert {r[2] for r in run(spark, twice, 3, 90)} == {1}
    docs = spark.createDataFrame([(None, "a b c")], "doc_id long, text string").selectExpr("*", "1 AS component_id", "2 AS n")
    assert [(r.doc_id, r.component_id) for r in jaccard_join.join(docs).collect()] == [(None, None)]
    docs = spark.createDataFrame([(None, "a b c d d"), (None, None), (None, "x")], "doc_id long, text string")
    assert sorted((r.n_shingles, r.component_id) for r in jaccard_join.join(docs, 3, 90).collect()) == [(0, None), (1, None), (3, None)]
    assert jaccard_join.join(docs.limit(0)).collect() == []


def test_very_long_text(spark):
    rng = random.Random(5)
    long = [f"w{rng.randrange(50_000)}" for _ in range(60_000)]
    rows = [(1, " ".join(long)), (2, edited(rng, long, 300)), (3, edited(rng, long, 3000))]
    assert run(spark, rows, 3, 90) == plain_join(rows, 3, 90)


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 5000), st.sampled_from([50, 80, 90, 95]))
def test_enough_fragments(size, share):
    """Two linked sets share a level with more fragments than they can differ in."""
    for other in {size, size * 100 // share, (size + size * 100 // share) // 2}:
        differ = max((size + other - 2 * i for i in range(size + 1) if 100 * i >= share * (size + other - i)), default=None)
        if differ is not None:
            common = set(shingles.levels(size, share)) & set(shingles.levels(other, share))
            assert any(2**bits > differ for bits in common)


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 300), st.sampled_from([50, 80, 90]), st.floats(0, 1), st.floats(0, 1))
def test_linked_sets_share_a_key(seed, size, share, edits, common):
    """Also where most shingles, or all, are frequent, and fragments are empty."""
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 2**64, size, np.uint64)
    frequent = np.unique(a[: int(common * size)])
    # drop and add as many as a link allows
    differ = int(edits * shingles.most_apart(size, share))
    b = np.concatenate([a[differ // 2 :], rng.integers(0, 2**64, differ - differ // 2, np.uint64)])
    a, b = np.unique(a), np.unique(b)
    both = len(np.intersect1d(a, b))
    if 100 * both >= share * (len(a) + len(b) - both) and len(a) and len(b):
        assert set(shingles.fragment_keys(a, share, frequent).tolist()) & set(shingles.fragment_keys(b, share, frequent).tolist())


@settings(max_examples=100, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=80), st.sets(st.integers(0, 2**64 - 1), max_size=20))
def test_sketch_never_exceeds_the_difference(a, b):
    x, y = (np.array(sorted(s), np.uint64) for s in (a, a ^ b))
    differ = np.bitwise_count((shingles.parity_sketch(x, 4) ^ shingles.parity_sketch(y, 4)).view(np.uint64)).sum()
    assert differ <= len(b)


def test_query(spark, data, documents):
    rows = sorted(tuple(r) for r in QUERIES["op10_jaccard_join"](spark, data).collect())
    assert rows == plain_join([(d["doc_id"], d["text"]) for d in documents], 3, 90)


def test_sql(spark, data):
    from check_oracle import connect

    from folioscope.llm.queries import ORACLE

    want = sorted(connect(data).sql(ORACLE["op10_jaccard_join"]).fetchall())
    assert sorted(tuple(r) for r in QUERIES["op10_jaccard_join"](spark, data).collect()) == want


@pytest.mark.parametrize("gathered", [10, 10**6])
@pytest.mark.parametrize("texts", [[], [None], ["a"], ["a b"], ["a b", "a b c", "a c d", None, "", "d a", "a b", "b e"] + [f"w{i} a" for i in range(300)]])
def test_often_counts_each_set_once(texts, gathered, monkeypatch):
    """Words in three different sets or more, and in how many; sets that repeat count once, in parts of at least 255 sets."""
    monkeypatch.setattr(jaccard_join, "GATHERED", gathered)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])
    found = [r for b in jaccard_join._often(1)([batch]) for r in b.to_pylist()]
    sets = list(dict.fromkeys(frozenset(s) for s in (plain_set(t, 1) for t in texts)))
    parts = [sets[:255], sets[255:]] if gathered == 10 else [sets]
    wanted = []
    for part in parts:
        words = {w for s in part for w in s}
        wanted += [n for n in (sum(w in s for s in part) for w in words) if n >= 3]
    assert sorted(r["n"] for r in found) == sorted(wanted)


def test_key_rows_leave_in_small_batches(monkeypatch):
    """Smallest document of each key and pairs with it, however the rows are cut into batches."""
    monkeypatch.setattr(jaccard_join, "SENT_ROWS", 7)
    keys = np.array([5, 9, 5, 7, 9, 9, *range(100, 130)], np.uint64)
    docs = np.array([3, 8, 1, 4, 2, 8, *range(130, 100, -1)], np.int64)
    held = [keys[:20], keys[20:]], [docs[:20], docs[20:]]
    batches = list(jaccard_join._joined(*held))
    assert held == ([], [])
    assert len(batches) > 5 and all(b.num_rows <= 7 for b in batches)
    rows = [r for b in batches for r in b.to_pylist()]
    least = {}
    for key, doc in zip(keys.tolist(), docs.tolist(), strict=True):
        least[key] = min(doc, least.get(key, doc))
    assert sorted((r["key"], r["a"]) for r in rows if r["a"] == r["b"]) == sorted(least.items())
    assert sorted((r["a"], r["b"]) for r in rows if r["a"] != r["b"]) == [(1, 3), (2, 8)]


def test_only_keys_of_several_classes_are_shared(spark, monkeypatch):
    """Sets 1, 2 and 3 are one class and 4 another; keys 10 and 30 are within one."""
    keys = spark.createDataFrame([(b"a", 1, [10, 20]), (b"b", 2, [10, 30]), (b"c", 3, [30]), (b"d", 4, [20, 40])], "digest binary, doc long, keys array<long>")
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "node long, label long")
    for limit in (0, 10):
        monkeypatch.setattr(jaccard_join, "BROADCAST_IDS", limit)
        with jaccard_join.Scratch(spark, "keys") as scratch:
            found = jaccard_join._shared_keys(scratch, keys, labels)
            assert sorted((r["key"], bytes(r["digest"])) for r in found.collect()) == [(20, b"a"), (20, b"d")]


def test_keys_tell_their_sets():
    """How many sets of a task have a key, so that keys of two, whose only pair is a candidate already, are not looked at again."""
    keys, docs = np.array([5, 9, 5, 7, 9, 9], np.uint64), np.array([3, 8, 1, 4, 2, 8], np.int64)
    rows = [r for b in jaccard_join._joined([keys], [docs]) for r in b.to_pylist()]
    assert sorted((r["key"], r["n"]) for r in rows if r["a"] == r["b"]) == [(5, 2), (7, 1), (9, 3)]


def test_keys_that_sets_meet_under(spark, monkeypatch):
    """All rows of keys of three sets or more, and of others those of documents with another centre; one part of the keys at a time is shuffled."""
    rows = [(1, 7, 1), (2, 8, 1), (2, 9, 1), (3, 4, 2), (-4, 6, 3), (5, 2, 1), (5, 1, 1), (5, 3, 1)]
    stored = []
    with jaccard_join.Scratch(spark, "met") as scratch:
        monkeypatch.setattr(scratch, "store", lambda df, name, f=scratch.store: stored.append(name) or f(df, name))
        met = jaccard_join._met(scratch, spark.createDataFrame(rows, "key long, a long, n int"))
        want = [(-4, 6, 6, 3), (2, 9, 8, 2), (5, 1, 1, 3), (5, 2, 1, 3), (5, 3, 1, 3)]
        assert sorted(tuple(r) for r in met.select("key", "to", "centre", "sets").collect()) == want
        assert len(stored) == jaccard_join.KEY_TURNS > 1
        marks = jaccard_join._bitmap(met.where("sets > 2").select("key"))
    keys = np.array([-4, 1, 2, 5, 32768 + 6], np.int64).view(np.uint64)
    assert jaccard_join._marked(keys, marks).tolist() == [True, False, False, True, False]


@pytest.mark.parametrize("size, other", [(40, 40), (300, 3000), (3000, 300), (70_000, 300)])
def test_wide_sketches_fold_to_the_narrower(spark, size, other):
    rng = np.random.default_rng(size)
    a, b = (np.unique(rng.integers(0, 2**64, n, np.uint64)) for n in (size, other))
    wide = [jaccard_join._width(n) for n in (size, other)]
    row = [(shingles.parity_sketch(a, wide[0]).tolist(), shingles.parity_sketch(b, wide[1]).tolist())]
    df = spark.createDataFrame(row, "a array<long>, b array<long>")
    got = df.select(jaccard_join._folded(df.a, df.b).alias("x"), jaccard_join._folded(df.b, df.a).alias("y")).first()
    assert [got.x, got.y] == [shingles.parity_sketch(s, min(wide)).tolist() for s in (a, b)]
    # enough bits to tell sets apart that share nothing
    assert 64 * wide[0] >= 4 * shingles.most_apart(size, 80)


def test_a_hub_is_sent_once_for_a_block(spark, monkeypatch):
    """Of a pair one set goes to the other; before, both went through two joins for each pair."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 4)
    pairs = [(b"h", bytes([i])) if i % 2 else (bytes([i]), b"h") for i in range(10)] + [(b"x", b"y")]
    roles = jaccard_join._roles(spark.createDataFrame(pairs, "a binary, b binary"))
    by = {bytes(r["digest"]): [(bytes(x["hub"]), x["block"], x["is_hub"]) for x in r["roles"]] for r in roles.collect()}
    assert all(len(by[bytes([i])]) == 1 and by[bytes([i])][0][0] == b"h" and not by[bytes([i])][0][2] for i in range(10))
    assert sorted(by[b"h"]) == sorted({(b"h", by[bytes([i])][0][1], True) for i in range(10)}) and len(by[b"h"]) <= 3
    assert sorted([by[b"x"], by[b"y"]]) == [[(b"x", 0, False)], [(b"x", 0, True)]]


def test_pairs_are_counted_once(spark, monkeypatch):
    texts = ["a b c d e f g h i j", "a b c d e f g h i k", "a b c d e z y x w v", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    digests = [shingles.set_digest(s) for s in shingles.shingle_sets([(t or "").encode() for t in texts], 1)]
    wanted = spark.createDataFrame(list(enumerate(digests)), "doc_id long, wanted binary")
    details = docs.join(wanted, "doc_id").mapInArrow(jaccard_join._details(1), jaccard_join._DETAILS).cache()
    assert "parts" not in details.columns
    pairs = spark.createDataFrame([tuple(sorted((digests[x], digests[y]))) for x, y in [(0, 1), (0, 2), (1, 2)]], "a binary, b binary")
    with jaccard_join.Scratch(spark, "pairs") as scratch:
        counted = []
        linked = jaccard_join._links(scratch, "first", pairs, details, (docs, 1), 80, counted)
        assert [sorted(map(bytes, r)) for r in linked.collect()] == [sorted(digests[:2])]
        monkeypatch.setattr(jaccard_join, "_parts", None)  # nothing is left to count
        assert jaccard_join._links(scratch, "again", pairs, details, (docs, 1), 80, counted).count() == 0


def test_executors_collect_their_garbage(spark):
    from folioscope.llm.common import CLEANUP, release_heaps

    def collections():  # in local mode the executor is this JVM, too
        beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
        return sum(b.getCollectionCount() for b in beans if "Young" not in b.getName())

    before = collections()
    release_heaps(spark)
    assert collections() > before
    assert spark.conf.get(CLEANUP, "false") == "false"
