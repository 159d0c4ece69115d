"""Packing: every identifier once, full sequences, the same identifiers as the tokenizers library."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from folioscope.llm import packing
from folioscope.llm.common import open_docs

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def plain_ids():
    tokenizer = Tokenizer.from_file(VOCABULARY)
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def plain_first_fit(lengths, size):
    free, bins = [], []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        at = next((b for b, room in enumerate(free) if room >= lengths[i]), len(free))
        if at == len(free):
            free.append(size)
            bins.append([])
        free[at] -= lengths[i]
        bins[at].append(i)
    return bins


@settings(deadline=None, max_examples=200)
@given(st.lists(st.integers(1, 64), max_size=120))
def test_tree_is_first_fit(lengths):
    bins = packing.first_fit_decreasing(lengths, 64)
    assert bins == plain_first_fit(lengths, 64)
    cut = packing.topped_up([[(i, 0, lengths[i]) for i in b] for b in bins], 64)
    covered = defaultdict(list)
    for sequence in cut:
        total = sum(length for _, _, length in sequence)
        assert total == 64 or total & (total - 1) == 0
        for item, start, length in sequence:
            assert length > 0
            covered[item] += range(start, start + length)
    assert {i: sorted(c) for i, c in covered.items()} == {i: list(range(n)) for i, n in enumerate(lengths)}
    assert sum(sum(p[2] for p in s) != 64 for s in cut) <= 6


def check(pieces, texts, plain_ids, size=1024):
    """Every document's identifiers lie in its pieces once; sequences have no gaps and need no padding."""
    left = defaultdict(list)
    for doc_id, text in texts:
        left[doc_id].append(plain_ids(text))
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_sequence[p["sequence_id"]].append(p)
        by_doc[p["doc_id"]].append(p)
    for sequence in by_sequence.values():
        at = 0
        for p in sorted(sequence, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at == size or at & (at - 1) == 0 and at < size
    assert set(by_doc) == set(left)
    for doc_id, own in by_doc.items():
        wanted = sorted((p, ids[p]) for ids in left[doc_id] for p in range(len(ids)))
        got = sorted(
            (p["start"] + k, i) for p in own for k, i in enumerate(np.frombuffer(bytes(p["token_ids"]), "<u4").tolist())
        )
        assert got == wanted
        assert {p["doc_tokens"] for p in own} == {len(ids) for ids in left[doc_id]}
        assert all(len(p["token_ids"]) == 4 * p["length"] for p in own)


def test_cases(frame, plain_ids):
    texts = [
        (1, "one two three"), (2, None), (3, ""), (None, "no name"), (4, "same row"), (4, "same row"), (5, "é中🙂 <|endoftext|> it's"),
        (6, "word " * 5000), (7, " " * 300_000 + "end"), (8, "a" * 100_000), (9, "x " * 1023), (10, "\n" * 10),
    ]
    docs = frame([(*t, 1, b"x") for t in texts], "doc_id long, text string, place int, token_ids binary")
    check(packing.pack(docs, VOCABULARY, PATTERN).collect(), texts, plain_ids)
    check(packing.pack(docs.repartition(5), VOCABULARY, PATTERN, size=64, group=3).collect(), texts, plain_ids, 64)


def test_empty_table(frame):
    assert packing.pack(frame([], "doc_id long, text string"), VOCABULARY, PATTERN).count() == 0


def test_length_must_be_a_power_of_two(frame):
    with pytest.raises(ValueError):
        packing.pack(frame([], "doc_id long, text string"), VOCABULARY, PATTERN, size=1000)


def test_whole_table_and_digests(spark, data, plain_ids):
    docs = open_docs(spark, data)
    pieces = packing.pack(docs, VOCABULARY, PATTERN)
    rows = pieces.collect()
    check(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], plain_ids)
    short = {s for s, n in _loads(rows).items() if n < 1024}
    assert len(short) <= 10  # one group here
    digests = {(r["sequence_id"], r["offset"]): r["ids_crc32"] for r in packing.piece_digests(pieces).collect()}
    assert digests == {(r["sequence_id"], r["offset"]): zlib.crc32(bytes(r["token_ids"])) for r in rows}


def _loads(rows):
    loads = defaultdict(int)
    for r in rows:
        loads[r["sequence_id"]] += r["length"]
    return loads


def test_same_result_for_any_order_of_rows(frame):
    rows = [(i % 7, f"text {i % 5} " * (i % 11)) for i in range(200)]
    schema = "doc_id long, text string"
    one = packing.pack(frame(rows, schema).coalesce(1), VOCABULARY, PATTERN, size=64, group=50).collect()
    two = packing.pack(frame(rows[::-1], schema).coalesce(1), VOCABULARY, PATTERN, size=64, group=50).collect()
    assert sorted(map(str, one)) == sorted(map(str, two))
