"""Licence scan against plain searches of whole texts."""

import re

import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from folioscope.llm import licences
from folioscope.llm.queries import QUERIES

FINDER = licences.Finder(licences.NOTICES, licences.CHARS_PER_EDIT)
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ASCII = str.maketrans({i: i + 32 for i in range(65, 91)})


def plain_base(text):
    words = WORDS.findall((text or "").translate(ASCII))
    out = []
    for phrase, label in licences.PHRASES.items():
        parts = phrase.split()
        out += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    return len(words), out


def check(text, row):
    n, base = plain_base(text)
    starts = [i for i, _ in base]
    assert (row["n_words"], row["n_base"]) == (n, len(base))
    assert (row["first_word"], row["last_word"]) == (min(starts, default=None), max(starts, default=None))
    assert row["base_labels"] == ",".join(sorted({label for _, label in base}))
    assert {label for _, label in base} <= set(row["labels"].split(",")) and 0 <= row["score"] <= 1


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["MIT", "mit", "License", "apache", "general", "public", "\n", ".", "é", "x1", "A-B"]), max_size=30))
def test_exact_phrases(parts):
    text = " ".join(parts)
    check(text, licences.report(licences.words_only(text.encode()), FINDER))


@settings(max_examples=150, deadline=None)
@given(st.sampled_from(licences.NOTICES), st.data())
def test_every_match_within_the_bound_is_found(notice, data):
    text = list(f"thonre {notice[0]} éblea")
    for _ in range(data.draw(st.integers(0, 4))):
        at = data.draw(st.integers(7, len(text) - 7))
        text[at : at + data.draw(st.integers(0, 1))] = data.draw(st.sampled_from(["", "x", "é"]))
    words = licences.words_only("".join(text).encode())
    got = {n for n, *_ in FINDER.find(words)}
    for n, (pattern, _, edits, fuzzy) in enumerate(FINDER.notices):
        assert (n in got) == bool(fuzzy.search(words)), (words, pattern, edits)


def test_spans_and_edits():
    row = licences.report(licences.words_only(b"Text. Relaesed under the MIT  License\nend"), FINDER)
    assert row["labels"] == "mit" and row["n_base"] == 1 and row["first_word"] == 4
    assert [(s["first_word"], s["last_word"], s["edits"]) for s in row["spans"]] == [(1, 5, 2)]
    assert licences.report(licences.words_only(b"licensed under teh apache licence version 2.0"), FINDER)["labels"] == "apache"


def test_a_long_text_of_notices():
    """Word numbers come from one array of offsets; counting from the text's start for each find took hours here."""
    notice = "é. Released under the MIT license! "
    row = licences.report(licences.words_only((notice * 60_000).encode()), FINDER)
    assert (row["n_words"], row["n_base"], row["first_word"], row["last_word"]) == (360_000, 60_000, 4, 359_998)
    assert [(s["first_word"], s["last_word"], s["edits"]) for s in row["spans"][-2:]] == [(359_989, 359_993, 0), (359_995, 359_999, 0)]


def test_edge_rows(spark):
    long = "word " * 50_000 + "released under the mit license"
    rows = [(1, None), (2, ""), (3, "..."), (4, long), (4, long)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'old' AS labels")
    got = sorted(licences.scan(docs).collect(), key=lambda r: r.doc_id)
    assert [(r.n_words, r.n_base, r.first_word, r.labels, r.score) for r in got[:3]] == [(0, 0, None, "", 0.0)] * 3
    assert [(r.n_words, r.first_word, r.labels) for r in got[3:]] == [(50_005, 50_003, "mit")] * 2
    assert licences.scan(docs.limit(0)).collect() == []


def test_query(spark, data, documents):
    rows = {r.doc_id: r.asDict() for r in QUERIES["op6_licence_scan"](spark, data).collect()}
    assert len(rows) == len(documents)
    for doc in documents:
        check(doc["text"], rows[doc["doc_id"]])
        words = licences.words_only((doc["text"] or "").encode())
        found = {label for pattern, label, edits, _ in FINDER.notices if regex.search(f"(?:{regex.escape(pattern)}){{e<={edits}}}", words)}
        assert found | set(filter(None, rows[doc["doc_id"]]["base_labels"].split(","))) == set(filter(None, rows[doc["doc_id"]]["labels"].split(",")))
