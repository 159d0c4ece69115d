"""Repeated passages against a plain search over all spans."""

import random
import re

from pyspark.sql import functions as F

from folioscope.llm import repeats
from folioscope.llm.common import word_hashes
from folioscope.llm.queries import QUERIES

ASCII = str.maketrans({i: i + 32 for i in range(65, 91)})


def plain_sentences(text):
    """(words, offset of the first) of each sentence; long ones cut by the words' own hashes."""
    natural, words = [], []
    for match in re.finditer(r"[^\x20\x09-\x0D]+([\x20\x09-\x0D]*)", text):
        words.append((match[0].rstrip(" \t\n\x0b\x0c\r").translate(ASCII), match.start()))
        if words[-1][0][-1] in ".!?" or "\n" in match[1] or match.end() == len(text):
            natural.append(words)
            words = []
    out = []
    for words in natural:
        begin = 0
        for i, (word, _) in enumerate(words):
            here = len(words) > repeats.LONG and int(word_hashes([word.encode()])[0][0]) % repeats.CUT == 0
            if here or i + 1 == len(words):
                out.append(([w for w, _ in words[begin : i + 1]], words[begin][1]))
                begin = i + 1
    return out


def plain_spans(cut):
    """Of all runs of sentences that are long enough, those that are too short without their last or without their first."""
    enough = lambda a, b: b - a >= repeats.SPAN and sum(len(w) for w, _ in cut[a:b]) >= repeats.SPAN_WORDS
    for a in range(len(cut)):
        for b in range(a + repeats.SPAN, min(len(cut), a + max(repeats.SPAN, repeats.SPAN_WORDS)) + 1):
            if enough(a, b) and not (enough(a, b - 1) and enough(a + 1, b)):
                yield a, b


def plain(rows, least):
    """rows: (doc_id, tag, text), as a set; the texts that remain."""
    rows = sorted(set(rows))
    first = {}
    found = {}
    for doc, tag, text in rows:
        cut = plain_sentences(text)
        for at, end in plain_spans(cut):
            span = tuple(tuple(w) for w, _ in cut[at:end])
            if first.setdefault(span, (doc, tag, at)) != (doc, tag, at):
                found.setdefault((doc, tag), set()).update(range(at, end))
    out = {}
    for doc, tag, text in rows:
        cut, marked = plain_sentences(text), found.get((doc, tag), set())
        kept, at, i = "", 0, 0
        while i < len(cut):
            j = i
            while j in marked:
                j += 1
            if j > i and sum(len(w) for w, _ in cut[i:j]) >= least:
                kept += text[at : cut[i][1]]
                at = cut[j][1] if j < len(cut) else len(text)
            i = max(j, i + 1)
        out[doc, tag] = kept + text[at:]
    return out


def check(spark, docs, got):
    tagged = docs.select("doc_id", F.xxhash64("text").alias("tag"), "text").collect()
    want = plain([(r.doc_id, r.tag, r.text) for r in tagged if r.text and r.doc_id is not None], repeats.LEAST_WORDS)
    pairs = sorted((r.doc_id, want[r.doc_id, r.tag]) for r in tagged if r.text and r.doc_id is not None)
    assert sorted((r.doc_id, r.text) for r in got if r.doc_id is not None and (r.text or r.n_removed)) == pairs


def prose(rng, n):
    return [" ".join(f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(3, 15))) + rng.choice([".", "!", ". ", ".\n"]) for _ in range(n)]


def test_planted_passages(spark, monkeypatch):
    monkeypatch.setattr(repeats, "GATHERED", 50)
    rng = random.Random(1)
    passages = [" ".join(prose(rng, 7)) for _ in range(5)]
    line = "A short line that many share. And one more."
    rows = []
    for i in range(60):
        parts = prose(rng, rng.randrange(1, 12))
        for _ in range(rng.randrange(3)):
            parts.insert(rng.randrange(len(parts) + 1), rng.choice([*passages, line]) + "\n")
        rows.append((rng.randrange(10**6), " ".join(parts)))
    rows += [rows[3], (rows[4][0], "other text. of the same. document."), (7, rows[5][1]), (8, f"{passages[0]} {passages[0]}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = repeats.remove_repeats(docs).collect()
    check(spark, docs, got)
    assert sum(r.n_removed > 0 for r in got) > 10
    assert sum(passages[1][:60] in r.text for r in got) == 1


def test_a_shared_passage_without_punctuation_is_cut_alike():
    rng = random.Random(2)
    passage = " ".join(f"p{i}" for i in range(120))
    a, b = (" ".join(f"{x}{rng.randrange(99)}" for _ in range(n)) + " " + passage + " " + " ".join(f"{x}z{rng.randrange(99)}" for _ in range(60)) for x, n in (("a", 50), ("b", 83)))
    spans = [set(repeats.spans(repeats.sentences([t.encode()]), 2)[0].tolist()) for t in (a, b)]
    assert len(spans[0] & spans[1]) >= 5


def test_passages_go_whole_and_short_common_lines_stay(spark):
    """The last sentence of a passage goes too, though the shortest run from it ends beyond; two short sentences are no passage."""
    passage = "one two three four five six. seven eight nine ten eleven twelve. and three more."
    line = "All rights reserved. Read on."
    texts = [f"x{i} y{i} z{i} starts here with words. {passage} a{i} b{i} c{i} goes on. {line} d{i} e{i} f{i} g{i} ends it now." for i in range(2)]
    got = {r.doc_id: r for r in repeats.remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got[0].text == texts[0] and got[1].text == texts[1].replace(f"{passage} ", "") and got[1].n_removed == 3


def test_edge_rows(spark):
    long = " ".join(f"word{i}." for i in range(20_000))
    rows = [(None, long), (1, None), (2, ""), (3, " \n "), (4, long), (4, long), (5, long), (6, "one. two. three.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS n_removed", "3 AS tag")
    found = repeats.remove_repeats(docs)
    assert found.columns == ["doc_id", "text", "tag", "n_removed"]
    got = sorted(((r.doc_id or 0), r.text, r.n_removed) for r in found.collect() if r.doc_id != 1)
    assert got == [(0, long, 0), (2, "", 0), (3, " \n ", 0), (4, long, 0), (4, long, 0), (5, "", 20_000), (6, "one. two. three.", 0)]
    assert found.where("doc_id = 1").first().text is None
    assert repeats.remove_repeats(docs.limit(0)).collect() == []


def test_query(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    got = QUERIES["op5_repeats"](spark, data).collect()
    check(spark, docs, got)
    assert any(r.n_removed for r in got)


def test_a_passage_that_starts_and_ends_inside_sentences(spark):
    """Its whole sentences go, though they have fewer than 30 words."""
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(10**6)}"
    inner = " ".join(" ".join(word() for _ in range(n)) + "." for n in (13, 12))
    head, tail = (" ".join(word() for _ in range(16)) for _ in range(2))
    rows = [(i, f"{word()} {word()} {head}. {inner} {tail} {word()}. {word()}.") for i in (1, 2)]
    rows = [(i, t.replace(head, f"{head} {word()}")) for i, t in rows]
    got = {r.doc_id: r for r in repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].text == rows[0][1] and got[1].n_removed == 0
    assert got[2].text == rows[1][1].replace(f"{inner} ", "") and got[2].n_removed == 2
