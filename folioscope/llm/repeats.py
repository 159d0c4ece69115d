"""Substring deduplication by sliding spans of sentences.

Method: a span is a run of consecutive sentences, SPAN at least, that holds SPAN_WORDS words: from each sentence the shortest run that begins
there, and the shortest that ends there. So a shared passage has equal spans wherever it stands, and they cover all of its whole sentences; two
short sentences that many texts share are no passage. Every span is hashed. Of all places with the same hash in the corpus the first, by identifier and
position, stays; sentences covered by any later place are marked and removed, however short. A caller may ask for ``least_words``:
then marked sentences that follow each other stay if together they have fewer words. Of a passage that starts or ends inside a sentence
only the whole sentences count, so a copy whose whole sentences are fewer than SPAN, or have fewer words than SPAN_WORDS, stays.

Sentences end at . ! or ? before white space, at a line end, and at the end of the text. A longer run than LONG words (lists, text
without punctuation) is also cut after each word whose hash is a multiple of CUT, which depends on the words alone, so that a
shared passage is cut alike wherever it stands. Words are lower-cased (A-Z) for comparison; texts are otherwise kept byte by byte.

Tasks first join their own rows: of equal spans one place goes on, as a later one in the same task is not the first in any case. So
a span that a third of all documents share reaches the shuffle once for each task.

Null and empty texts stay as they are. Rows without an identifier are left alone and make no other row a later place. Rows that share
identifier and text are one document; with different texts, their texts come in the order of the texts' hashes. Whole texts are
read. Extra columns pass through; one with the name of an output is replaced.
"""

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from folioscope.llm.common import appended, chunks, mix, slices, text_bytes, with_columns, word_hashes

#: Least sentences and least words of a span.
SPAN, SPAN_WORDS = 2, 12

#: A place is the number of its first sentence above these bits and the number of its sentences in them.
PLACE_BITS = 16

#: Words that marked sentences must have together to be removed; none: all are.
LEAST_WORDS = 0

#: Words from which a sentence is cut after words whose hash is a multiple of CUT.
LONG, CUT = 40, 8

#: Spans that a task gathers before it joins them and sends them on.
GATHERED = 2_000_000

#: An odd number and its inverse modulo 2^64.
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)

_ENDS = np.isin(np.arange(256), list(b".!?"))


@dataclass
class Sentences:
    """Of each sentence of some texts: hash, text, number of words, offset of its first word in the joined texts."""

    hashes: np.ndarray
    owner: np.ndarray
    words: np.ndarray
    starts: np.ndarray


def sentences(texts: list[bytes]) -> Sentences:
    hashes, owner, starts = word_hashes(texts)
    if not hashes.size:
        none = np.zeros(0, np.int64)
        return Sentences(hashes, none, none, none)
    raw = np.frombuffer(b" ".join(texts), np.uint8)
    lines = np.cumsum(raw == 10)
    following = np.append(starts[1:], raw.size)
    # a word's last byte: the last that is not white space before the next word
    inside = np.where((raw != 32) & ((raw < 9) | (raw > 13)), np.arange(raw.size), 0)
    last = np.maximum.accumulate(inside)[following - 1]
    end = _ENDS[raw[last]] | (lines[following - 1] > lines[last]) | np.append(owner[1:] != owner[:-1], True)
    number = np.concatenate([[0], np.cumsum(end)[:-1]])
    long = np.bincount(number)[number] > LONG
    end |= long & (hashes % np.uint64(CUT) == 0)
    first = np.flatnonzero(np.concatenate([[True], end[:-1]]))
    count = np.diff(np.append(first, hashes.size))
    place = np.arange(hashes.size) - np.repeat(first, count)
    turn = mix(place.astype(np.uint64) + np.uint64(1)) | np.uint64(1)
    return Sentences(mix(np.add.reduceat(hashes * turn, first)), owner[first], count, starts[first])


def spans(found: Sentences, size: int, least: int = SPAN_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each span of ``size`` sentences and ``least`` words, as short as its begin or its end allows: its hash, its text, its place there."""
    if max(size, least) >= 1 << PLACE_BITS:
        raise ValueError("spans are too long")
    n = len(found.hashes)
    at = np.arange(n)
    before = np.concatenate([[0], np.cumsum(found.words)])
    first, last = (np.searchsorted(found.owner, found.owner, side=s) for s in ("left", "right"))
    ends = np.maximum(np.searchsorted(before, before[:n] + least), at + size)
    begins = np.minimum(np.searchsorted(before, before[1:] - least, side="right") - 1, at + 1 - size)
    forward, backward = ends <= last, begins >= first
    backward[backward] = ends[begins[backward]] != at[backward] + 1  # else the same span
    begin = np.concatenate([at[forward], begins[backward]])
    end = np.concatenate([ends[forward], at[backward] + 1])
    # a polynomial over the sentences' hashes, shifted to the span's begin
    power, back = (np.cumprod(np.full(n + 1, base, np.uint64), dtype=np.uint64) for base in (_BASE, _INVERSE))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(found.hashes * power[:n], dtype=np.uint64)])
    value = (total[end] - total[begin]) * back[begin]
    return mix(value + (end - begin).astype(np.uint64)), found.owner[begin], (begin - first[begin] << PLACE_BITS) | (end - begin)


_PLACES = "span long, doc_id long, tag long, at long"


def _first_places(size: int, least: int):
    """Of (doc_id, tag, text): the first place of each span in the task, and with a null span all later ones."""

    def joined(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        span, doc, tag, at = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((at, tag, doc, span))
        span, doc, tag, at = span[order], doc[order], tag[order], at[order]
        fresh = np.concatenate([[True], span[1:] != span[:-1]])
        begin = np.repeat(np.flatnonzero(fresh), np.diff(np.append(np.flatnonzero(fresh), span.size)))
        later = (doc != doc[begin]) | (tag != tag[begin]) | (at != at[begin])
        kept = fresh | later
        return pa.RecordBatch.from_arrays(
            [pa.array(span.view(np.int64)[kept], mask=later[kept]), pa.array(doc[kept]), pa.array(tag[kept]), pa.array(at[kept])],
            names=["span", "doc_id", "tag", "at"],
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in slices(batches, 2048):
            docs, tags = (batch.column(c).to_numpy() for c in ("doc_id", "tag"))
            texts = text_bytes(batch.column("text"))
            for begin, end in chunks(texts):
                span, owner, at = spans(sentences(texts[begin:end]), size, least)
                held.append((span, docs[begin:end][owner], tags[begin:end][owner], at))
                n += span.size
                if n > GATHERED:
                    yield joined(held)
                    held, n = [], 0
        if n:
            yield joined(held)

    return run


def cut(text: bytes, marked: list[int], least_words: int) -> tuple[bytes, int]:
    """The text without its marked spans, as far as they are long enough together, and the number of sentences removed."""
    found = sentences([text])
    places = np.array(marked, np.int64)
    change = np.zeros(len(found.hashes) + 1, np.int64)
    np.add.at(change, places >> PLACE_BITS, 1)
    np.add.at(change, (places >> PLACE_BITS) + (places & (1 << PLACE_BITS) - 1), -1)
    covered = np.cumsum(change)[:-1] > 0
    edge = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
    out, at, removed = [], 0, 0
    for begin, end in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
        if found.words[begin:end].sum() >= least_words:
            out.append(text[at : found.starts[begin]])
            at = int(found.starts[end]) if end < len(found.starts) else len(text)
            removed += end - begin
    return b"".join([*out, text[at:]]), removed


def remove_repeats(docs: DataFrame, size: int = SPAN, span_words: int = SPAN_WORDS, least_words: int = LEAST_WORDS) -> DataFrame:
    """The documents with later places of repeated passages cut out of text; adds n_removed (sentences)."""
    tagged = docs.withColumn("_tag", F.xxhash64("text"))
    known = tagged.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("_tag").alias("tag"), "text")
    places = known.mapInArrow(_first_places(size, span_words), _PLACES)
    first = F.min(F.struct("doc_id", "tag", "at")).over(Window.partitionBy("span"))
    # spans of one task are distinct, so a window holds one row for each task at most; later places go by themselves
    spread = F.coalesce("span", F.xxhash64("doc_id", "tag", "at"))
    places = places.withColumn("later", F.col("span").isNull()).withColumn("span", spread)
    places = places.withColumn("first", first).where(F.col("later") | (F.col("first") != F.struct("doc_id", "tag", "at")))
    marked = places.groupBy("doc_id", "tag").agg(F.collect_list("at").alias("_marked"))
    marked = marked.withColumnsRenamed({"doc_id": "_doc", "tag": "_hash"})
    same = (F.col("doc_id") == F.col("_doc")) & (F.col("_tag") == F.col("_hash"))
    joined = tagged.join(marked, same, "left").select(*[F.col(f"`{c}`") for c in docs.columns], "_marked")
    schema = with_columns(docs.schema, n_removed=LongType())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts, counts = [], []
            for text, places in zip(batch.column("text").to_pylist(), batch.column("_marked").to_pylist(), strict=True):
                n = 0
                if places:
                    clean, n = cut(text.encode(), places, least_words)
                    text = clean.decode()
                texts.append(text)
                counts.append(n)
            plain = batch.drop_columns(["_marked"])
            at = plain.schema.get_field_index("text")
            plain = plain.set_column(at, "text", pa.array(texts, pa.string()))
            yield appended(plain, schema, n_removed=pa.array(counts, pa.int64()))

    return joined.mapInArrow(run, schema)
