"""Benchmark decontamination: a BM25 inverted index of the test items, queried with every passage of every document.

Method: items are cut into chunks of at most CHUNK words. The index holds, for each term, the chunks with that term and their BM25
weights, as shares of the chunk's weight of all its terms; so a passage's score is the share of a chunk's BM25 mass
that the passage holds. Postings lie in blocks that know their highest weight. Passages are all windows of 2 * CHUNK words
that begin at multiples of CHUNK, so each run of CHUNK words lies wholly in one. An upper bound is taken for all passages of a batch
at once: frequent terms, as far as they make up at most half the threshold of any chunk, count as if all were there, and only
the others' postings are added up. A passage that no chunk's bound lets reach the threshold is passed over; any other runs
through block-max WAND, which skips blocks that cannot lift a chunk to the threshold and gives every chunk at or above it, none
left out. An item so found is verified around the passage: the question's and the
answer's share of word pairs that stand there must reach VERIFIED each. The answer is what follows "answer:", else the last line
or sentence, else the last third of the words.

Words are runs of letters, digits and characters outside ASCII, A-Z lower-cased. Document frequencies cover all items. The index is broadcast in
shards of at most SHARD_BYTES of item text, one after another, each against all documents. Null and empty texts and items
have no leaks. Repeated documents are searched each by itself. Items are told apart by identifier and text: those that share an identifier
are indexed, and reported, each by itself, those without one too (their leaks have a null item_id); rows equal in both are one item. Whole texts are read. Extra columns
pass through; one with the name of the output is replaced.
"""

import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructType

from folioscope.llm.common import LOWER_SQL, UPPER_SQL, WORDS_ONLY, appended, chunks, gather, slices, store, text_bytes, with_columns

#: Words of an item's chunk at most; passages have twice as many and begin at multiples of it.
CHUNK = 48

#: Share of a chunk's BM25 mass that a passage must hold.
THRESHOLD = 0.6

#: Share of the question's and of the answer's word pairs that must stand in the document.
VERIFIED = 0.5

#: BM25's usual parameters.
K1, B = 1.2, 0.75

#: Postings of a block.
BLOCK = 32

#: Bytes of item text whose index is broadcast at once.
SHARD_BYTES = 4 << 20

LEAK = (
    StructType().add("item_id", LongType()).add("score", DoubleType()).add("question_overlap", DoubleType()).add("answer_overlap", DoubleType())
)
_LEAK_ARROW = pa.list_(
    pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("question_overlap", pa.float64()), ("answer_overlap", pa.float64())])
)

_ANSWER = re.compile(r"\banswer\s*:", re.I)
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORDS_ONLY).split()


def question_and_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    """The words of an item's two parts."""
    marked = _ANSWER.search(text)
    if marked:
        return words_of(text[: marked.start()].encode()), words_of(text[marked.end() :].encode())
    parts = [words_of(p.encode()) for p in _SENTENCE.split(text.strip())]
    parts = [p for p in parts if p]
    if len(parts) > 1:
        return [w for p in parts[:-1] for w in p], parts[-1]
    words = words_of(text.encode())
    cut = len(words) - len(words) // 3
    return words[:cut], words[cut:]


def pairs_of(words: list[bytes]) -> set[tuple[bytes, ...]]:
    return set(zip(words, words[1:], strict=False)) if len(words) > 1 else {(w,) for w in words}


def overlap(part: list[bytes], region: list[bytes]) -> float:
    wanted = pairs_of(part)
    if not wanted:
        return 1.0
    there = set(zip(region, region[1:], strict=False)) if len(part) > 1 else {(w,) for w in region}
    return len(wanted & there) / len(wanted)


@dataclass
class Postings:
    chunks: list[int]
    weights: list[float]
    block_max: list[float]
    most: float


class Index:
    """rows: (item, chunk, term, number of times, chunks with the term); size: words of all chunks together, and their number.

    ids: the identifier of each item, as far as it is not the item's number.
    """

    def __init__(self, rows: list[tuple], items: list[tuple], n_chunks: int, n_words: int, ids: dict[int, int | None] | None = None):
        self.ids = ids or {}
        names = sorted({(item, chunk) for item, chunk, *_ in rows})
        place = {name: i for i, name in enumerate(names)}
        length = np.zeros(len(names))
        for item, chunk, _, times, _ in rows:
            length[place[item, chunk]] += times
        held: dict[bytes, list[tuple[int, float]]] = {}
        whole = np.zeros(len(names))
        for item, chunk, term, times, df in rows:
            at = place[item, chunk]
            idf = np.log(1 + (n_chunks - df + 0.5) / (df + 0.5))
            weight = idf * times * (K1 + 1) / (times + K1 * (1 - B + B * length[at] * n_chunks / n_words))
            held.setdefault(term, []).append((at, weight))
            whole[at] += weight
        self.item_of = [item for item, _ in names]
        self.terms = {term: i for i, term in enumerate(sorted(held))}
        self.postings = []
        for term in self.terms:
            found = sorted(held[term])
            at = [c for c, _ in found]
            share = [float(w / whole[c]) for c, w in found]
            blocks = [max(share[i : i + BLOCK]) for i in range(0, len(share), BLOCK)]
            self.postings.append(Postings(at, share, blocks, max(blocks)))
        # frequent terms are taken for granted while every chunk keeps half the threshold for the others
        granted, frequent = np.zeros(len(names)), np.zeros(len(self.postings), bool)
        for t in sorted(range(len(self.postings)), key=lambda t: -len(self.postings[t].chunks)):
            own = self.postings[t]
            if (granted[own.chunks] + np.array(own.weights) <= THRESHOLD / 2).all():
                granted[own.chunks] += own.weights
                frequent[t] = True
        self.needed = THRESHOLD - granted
        counts = np.array([0 if frequent[t] else len(p.chunks) for t, p in enumerate(self.postings)], np.int64)
        self.count, self.first = counts, np.cumsum(counts) - counts
        rest = [p for t, p in enumerate(self.postings) if not frequent[t]]
        self.rest_chunks = np.array([c for p in rest for c in p.chunks], np.int64)
        self.rest_weights = np.array([w for p in rest for w in p.weights], np.float64)
        self.parts = {item: question_and_answer(text) for item, text in items}

    def search(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """Block-max WAND: every chunk whose weights for these terms add up to the threshold, and the sum."""
        lists = [self.postings[t] for t in terms]
        cursor = [0] * len(lists)
        head = [p.chunks[0] for p in lists]  # the chunk at each list's cursor
        out = []
        threshold -= 1e-12
        live = list(range(len(lists)))

        def forward(i: int, to: int) -> bool:
            """Move a list to the first chunk from ``to`` on; false at its end."""
            chunks = lists[i].chunks
            cursor[i] = bisect_left(chunks, to, cursor[i])
            if cursor[i] < len(chunks):
                head[i] = chunks[cursor[i]]
                return True
            return False

        while live:
            live.sort(key=head.__getitem__)
            bound, pivot = 0.0, -1
            for k, i in enumerate(live):
                bound += lists[i].most
                if bound >= threshold:
                    pivot = k
                    break
            if pivot < 0:
                return out
            target = head[live[pivot]]
            while pivot + 1 < len(live) and head[live[pivot + 1]] == target:
                pivot += 1
            before, after = live[: pivot + 1], live[pivot + 1 :]
            before = [i for i in before if head[i] == target or forward(i, target)]
            # what the blocks that hold the target can give
            if sum(lists[i].block_max[cursor[i] // BLOCK] for i in before) >= threshold:
                score = sum(lists[i].weights[cursor[i]] for i in before if head[i] == target)
                if score >= threshold:
                    out.append((target, score))
                beyond = target + 1
            else:
                # nothing up to the nearest end of these blocks, or the next list's chunk, can reach the threshold
                ends = [lists[i].chunks[min(len(lists[i].chunks), (cursor[i] // BLOCK + 1) * BLOCK) - 1] + 1 for i in before]
                ends += [head[after[0]]] if after else []
                beyond = max(target + 1, min(ends, default=target + 1))
            live = [i for i in before if head[i] >= beyond or forward(i, beyond)] + after
        return out

    def candidates(self, bucket: np.ndarray, term: np.ndarray, follows: np.ndarray) -> np.ndarray:
        """Windows (named by their first bucket) in which some chunk's upper bound reaches the threshold."""
        count = self.count[term]
        at = np.repeat(self.first[term] - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
        owner, chunk, weight = np.repeat(bucket, count), self.rest_chunks[at], self.rest_weights[at]
        # a bucket counts for its own window, and for that of the bucket before it in the same text
        earlier = (owner > 0) & follows[owner - 1]
        name = np.concatenate([owner, owner[earlier] - 1]) * len(self.needed) + np.concatenate([chunk, chunk[earlier]])
        name, inverse = np.unique(name, return_inverse=True)
        bound = np.bincount(inverse, np.concatenate([weight, weight[earlier]]), minlength=len(name))
        window, chunk = np.divmod(name, len(self.needed))
        return np.unique(window[bound >= self.needed[chunk] - 1e-9])

    def leaks(self, texts: list[bytes]) -> list[list[dict]]:
        words, sizes = [], []
        for text in texts:
            own = words_of(text)
            words += own
            sizes.append(len(own))
        found: list[dict[int, tuple]] = [{} for _ in texts]
        if not words or not self.terms:
            return [[] for _ in texts]
        get = self.terms.get
        index = np.fromiter(map(get, words, repeat(-1)), np.int64, len(words))
        sizes = np.array(sizes)
        starts = np.cumsum(sizes) - sizes
        buckets = -(-sizes // CHUNK)
        first = np.cumsum(buckets) - buckets
        where = np.flatnonzero(index >= 0)
        owner = np.searchsorted(starts + sizes, where, side="right")
        bucket = first[owner] + (where - starts[owner]) // CHUNK
        codes = np.unique(bucket * len(self.terms) + index[where])
        bucket, term = np.divmod(codes, len(self.terms))
        n = int(buckets.sum())
        text_of = np.repeat(np.arange(len(texts)), buckets)
        follows = np.append(text_of[1:] == text_of[:-1], False)
        edges = np.searchsorted(bucket, np.arange(n + 2))
        for b in self.candidates(bucket, term, follows).tolist():
            terms = np.unique(term[edges[b] : edges[b + 2 if follows[b] else b + 1]])
            doc = int(text_of[b])
            for chunk, score in self.search(terms.tolist(), THRESHOLD):
                item = self.item_of[chunk]
                question, answer = self.parts[item]
                reach = len(question) + len(answer)
                at = int(starts[doc]) + (b - int(first[doc])) * CHUNK
                region = words[max(int(starts[doc]), at - reach) : min(int(starts[doc] + sizes[doc]), at + 2 * CHUNK + reach)]
                both = overlap(question, region), overlap(answer, region)
                if min(both) >= VERIFIED:
                    found[doc][item] = max(found[doc].get(item, (0.0,)), (score, *both))
        return [
            [{"item_id": self.ids.get(i, i), "score": s, "question_overlap": q, "answer_overlap": a} for i, (s, q, a) in sorted(own.items())] for own in found
        ]


def indexes(benchmark: DataFrame) -> Iterator[Index]:
    """The index in shards; document frequencies and lengths are those of all items."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null").distinct()
    # an item's number is fixed by writing it
    items = store(items.withColumn("item", F.monotonically_increasing_id()), "items")
    plain = F.regexp_replace(F.translate("text", UPPER_SQL, LOWER_SQL), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")
    words = items.withColumn("words", F.filter(F.split(plain, " "), lambda w: w != "")).where(F.size("words") > 0)
    parts = F.ceil(F.size("words") / F.lit(CHUNK)).cast("int")
    size = F.ceil(F.size("words") / parts).cast("int")
    cut = F.transform(F.sequence(F.lit(0), parts - 1), lambda i: F.slice("words", i * size + 1, size))
    terms = (
        words.select("item", F.posexplode(cut).alias("chunk", "part"))
        .select("item", "chunk", F.explode("part").alias("term"))
        .groupBy("item", "chunk", "term")
        .agg(F.count("*").alias("times"))
    )
    frequency = terms.groupBy("term").agg(F.count("*").alias("df"))
    rows = terms.join(frequency, "term").select("item", "chunk", F.encode("term", "utf-8").alias("term"), "times", "df")
    n_words, n_bytes = gather(words.agg(F.coalesce(F.sum(F.size("words")), F.lit(0)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))))[0]
    n_chunks = terms.select("item", "chunk").distinct().count()
    shards = -(-n_bytes // SHARD_BYTES)
    for shard in range(shards):
        own = F.pmod(F.xxhash64("item"), F.lit(shards)) == shard
        held = [(i, c, bytes(t), n, df) for i, c, t, n, df in gather(rows.where(own))]
        texts = gather(items.where(own).select("item", "text", "item_id"))
        yield Index(held, [(item, text) for item, text, _ in texts], n_chunks, n_words, {item: name for item, _, name in texts})


def find(docs: DataFrame, benchmark: DataFrame, out: str = "leaks") -> DataFrame:
    """Adds ``out`` to each row: an array of (item_id, score, question_overlap, answer_overlap), one for each item; empty if clean."""
    schema = with_columns(docs.schema, **{out: ArrayType(LEAK)})
    found = docs.withColumn(out, F.array().cast(ArrayType(LEAK))).select(*[F.col(f"`{f.name}`") for f in schema])
    for index in indexes(benchmark):
        shipped = docs.sparkSession.sparkContext.broadcast(index)  # of SHARD_BYTES of text

        def run(batches: Iterable[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                texts = text_bytes(batch.column("text"))
                leaks = [x for begin, end in chunks(texts) for x in shipped.value.leaks(texts[begin:end])]
                before = batch.column(out).to_pylist()
                yield appended(batch, schema, **{out: pa.array([b + x for b, x in zip(before, leaks, strict=True)], _LEAK_ARROW)})

        found = found.mapInArrow(run, schema)
    return found


def pairs(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and item leaked into it."""
    return find(docs.select("doc_id", "text"), benchmark).select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")
