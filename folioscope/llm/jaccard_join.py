"""Exact n-gram Jaccard join by vertical partitioning, reported as classes of linked documents.

Method: the shingles of all documents have one global order, that of their 64-bit hashes. The order is cut into fragments.

1. Candidates. Sets of n shingles that overlap by the share asked for differ in at most D shingles (shingles.most_apart). So if the order is
   cut into more than D fragments, two such sets agree wholly in one fragment at least. Each set sends one key for each of its
   fragments, at the one or two cuts that its size calls for. Shingles of at least FREQUENT_SHARE of all documents, as lines that
   many share have them, are left out of the keys where the others are enough (shingles.fragment_keys); which ones count as
   frequent decides the work, never the result. Tasks first join their own rows: of documents with equal
   keys one goes on, and its links to the others are candidates themselves. So a key that many documents share reaches the
   shuffle once for each task. Documents with equal keys form a star around the smallest.
2. Partial overlaps. For each candidate pair the overlap is counted in each of PARTS fragments by itself, and summed. A parity sketch,
   whose distance never exceeds the sets' difference, spares pairs that cannot be linked. The fragments are made from the texts of the sets
   that have such a pair, and of a pair only one set is sent to the other, the one of more pairs, which is sent once for a block of them.
3. Rest. A star may miss links between its outer members; one of two members has none. Keys of three sets or more whose documents are not yet
   in one class are looked at again: first with other centres, then all pairs of documents of different classes, in blocks of bounded
   size, by their sketches; what may be linked, and was not counted before, is counted as in 2. After that no link between different
   classes is left, so the classes are exact.

Equal sets are linked without comparison. Documents without words or text are linked with nothing; sizes and classes come back for each input
row. Rows without an identifier take no part and have no class; their sets' sizes come back like the others'. Rows that share an identifier are one document, whose links are those of all
its texts. Extra columns are not read. Two different shingles share a hash with a chance of 2 ** -64.
"""

from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.llm.common import Scratch, chunks, components, gather, mix, release, release_heaps, slices, store, text_bytes
from folioscope.llm.shingles import fragment_keys, levels, parity_sketch, set_digest, shingle_sets

#: Fragments in which the overlap of a candidate pair is counted.
PARTS = 4

#: 64-bit words of the parity sketch that sets under one key are compared by.
SKETCH = 16

#: Shingles for each 64-bit word of a set's own, wider sketch: one of fixed width says nothing of sets that may differ in more shingles than it has bits.
SHINGLES_PER_WORD = 16

#: Documents that are compared with each other in one block, or with one.
BLOCK = 1000

#: Parts of the keys that are joined one after another, so that the shuffle files of one only stand beside the stored keys.
KEY_TURNS = 4

#: Bits of a bitmap of keys: for each key, in a row of it (4 KB), and at most (16 MB). More keys only make it less selective.
BITS_PER_KEY, ROW_BITS, MOST_BITS = 16, 1 << 15, 1 << 27

#: Shingles that a task counts together, and keys that it gathers before it joins them and sends them on.
GATHERED, GATHERED_KEYS = 2_000_000, 1_000_000

#: Key rows in a batch that a task sends on.
SENT_ROWS = 1 << 15

#: Bytes of sets' fragments in a batch that a task sends on, about.
SENT_BYTES = 4 << 20

#: Bytes of text made into sets at a time; numpy takes about fifty times as much meanwhile.
SET_BYTES = 1 << 18

#: Share of all documents from which a shingle counts as frequent; so these number at most the mean size of a set / FREQUENT_SHARE.
FREQUENT_SHARE = 1e-3

#: Identifiers that are broadcast to find their texts (8 MB); more are found by a shuffled join.
BROADCAST_IDS = 1_000_000

#: Rounds with other centres before all pairs of different classes are looked at.
STARS = 1


def _sets(batches: Iterable[pa.RecordBatch], words: int) -> Iterator[tuple[int, np.ndarray]]:
    for batch in slices(batches, 2048):
        ids, texts = batch.column("doc_id").to_pylist(), text_bytes(batch.column("text"))
        for begin, end in chunks(texts, SET_BYTES):
            yield from zip(ids[begin:end], shingle_sets(texts[begin:end], words), strict=True)


def _sizes(words: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The size of each document's set."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [len(shingles) for _, shingles in _sets([batch], words)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int32())], names=["doc_id", "n"])

    return run


_KEY_ROWS = "key long, a long, b long, n int, digest binary"


def _rows(keys: np.ndarray, a: np.ndarray, b: np.ndarray, n: np.ndarray | None = None) -> pa.RecordBatch:
    rows = len(keys)
    sets = pa.nulls(rows, pa.int32()) if n is None else pa.array(n.astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [pa.array(keys.view(np.int64)), pa.array(a), pa.array(b), sets, pa.nulls(rows, pa.binary())], names=["key", "a", "b", "n", "digest"]
    )


def _joined(keys: list[np.ndarray], ids: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """One row for each key with its smallest document and its number of sets, and rows of their own for pairs of that and each other document.

    The lists are emptied, and the rows sent in small batches: whole ones would stand in the worker and once more in its executor.
    """
    key, doc = np.concatenate(keys), np.concatenate(ids)
    keys.clear()
    ids.clear()
    order = np.argsort(key)
    key, doc = key[order], doc[order]
    del order
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    least = np.minimum.reduceat(doc, first)
    sets = np.diff(np.append(first, len(key)))
    centre = np.repeat(least, sets)
    other = centre != doc
    pairs = np.unique(np.stack([centre[other], doc[other]], axis=1), axis=0)
    order = np.argsort(least, kind="stable")  # a document's keys together take less room
    key, least, sets = key[first][order], least[order], sets[order]
    del doc, centre, other, first, order
    for begin in range(0, len(key), SENT_ROWS):
        to = slice(begin, begin + SENT_ROWS)
        yield _rows(key[to], least[to], least[to], sets[to])
    for begin in range(0, len(pairs), SENT_ROWS):
        a, b = pairs[begin : begin + SENT_ROWS].T
        own = mix(mix(a.view(np.uint64)) + b.view(np.uint64))  # spreads the pairs; a key they share with others does no harm
        yield _rows(own, a, b)


def _often(words: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Shingles that stand in three documents or more of those read together, and in how many."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        seen: set[bytes] = set()

        def counted() -> pa.RecordBatch:
            shingles = np.concatenate(held)
            held.clear()
            shingles.sort()
            often = np.zeros(shingles.size, bool)  # first of three equal ones or more
            often[:-2] = shingles[2:] == shingles[:-2]
            often[1:] &= shingles[1:] != shingles[:-1]
            first = np.flatnonzero(often)
            n = np.searchsorted(shingles, shingles[first], side="right") - first
            return pa.RecordBatch.from_arrays([pa.array(shingles[first].view(np.int64)), pa.array(n.astype(np.int64))], names=["shingle", "n"])

        for _, shingles in _sets(batches, words):
            digest = set_digest(shingles)
            if digest not in seen:
                seen.add(digest)
                held.append(shingles)
            if len(held) % 256 == 255 and sum(map(len, held)) > GATHERED:
                yield counted()
                seen.clear()
        if held:
            yield counted()
        release()

    return run


def _frequent(docs: DataFrame, words: int) -> np.ndarray:
    """Hashes of the frequent shingles, sorted."""
    least = F.lit(max(20.0, FREQUENT_SHARE * docs.count()))
    found = docs.mapInArrow(_often(words), "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return np.sort(found.select("shingle").toArrow()["shingle"].to_numpy().view(np.uint64))


def _scan(words: int, share: int, shipped) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of each document its size and digest (key null), and its fragments' keys, joined within the task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        info: list[tuple[int, int, bytes]] = []
        held, seen = 0, set()

        def documents() -> pa.RecordBatch:
            empty = pa.nulls(len(info), pa.int64())
            columns = [empty, pa.array([i for i, _, _ in info], pa.int64()), empty, pa.array([s for _, s, _ in info], pa.int32())]
            return pa.RecordBatch.from_arrays([*columns, pa.array([d for _, _, d in info], pa.binary())], names=["key", "a", "b", "n", "digest"])

        for doc_id, shingles in _sets(batches, words):
            digest = set_digest(shingles) if len(shingles) else None
            info.append((doc_id, len(shingles), digest))
            if digest and digest not in seen and levels(len(shingles), share) != [0]:
                seen.add(digest)
                made = fragment_keys(shingles, share, shipped.value)
                keys.append(made)
                ids.append(np.full(len(made), doc_id, np.int64))
                held += len(made)
            if held > GATHERED_KEYS:
                yield from _joined(keys, ids)
                held = 0
                seen.clear()
            if len(info) >= 10_000:
                yield documents()
                info = []
        if keys:
            yield from _joined(keys, ids)
        if info:
            yield documents()
        keys, ids, info = [], [], []
        release()

    return run


def _width(size: int) -> int:
    """Words of a set's wide sketch: a power of two, as sketches of such widths can be folded to the same."""
    return max(SKETCH, 1 << (size // SHINGLES_PER_WORD).bit_length())


def _folded(sketch: Column, other: Column) -> Column:
    """The sketch as it is at the other's width, if that is smaller; its parts are powers of two."""
    size, parts = F.size(other), F.call_function("div", F.size(sketch), F.size(other)).cast("int")
    whole = F.aggregate(
        F.sequence(F.lit(1), parts - 1),
        F.slice(sketch, F.lit(1), size),
        lambda t, i: F.zip_with(t, F.slice(sketch, i * size + 1, size), lambda x, y: x.bitwiseXOR(y)),
    )
    return F.when(F.size(sketch) <= size, sketch).otherwise(whole)


def _details(words: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of (doc_id, text, wanted): one row for each set whose digest is wanted; a task sends each once."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        sent: set[bytes] = set()
        held = 0

        def made() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            kinds = [pa.binary(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=["digest", "doc", "n", "sketch", "wide"])

        for batch in batches:
            wanted = batch.column("wanted").to_pylist()
            for want, (doc_id, shingles) in zip(wanted, _sets([batch], words), strict=True):
                digest = set_digest(shingles)
                if digest != want or digest in sent:
                    continue
                sent.add(digest)
                rows.append((digest, doc_id, len(shingles), parity_sketch(shingles, SKETCH), parity_sketch(shingles, _width(len(shingles)))))
                held += len(rows[-1][-1])
                if len(rows) >= 1000 or 8 * held > SENT_BYTES:
                    yield made()
                    rows, held = [], 0
        if rows:
            yield made()
        rows = []
        release()

    return run


_DETAILS = "digest binary, doc long, n int, sketch array<long>, wide array<long>"


def _parts(words: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of (doc_id, text, wanted, roles): the set's fragments for each of its roles (hub, block, whether it is the hub), if its digest is wanted."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            wanted, roles = batch.column("wanted").to_pylist(), batch.column("roles").to_pylist()
            rows: list[tuple] = []
            held = 0
            for want, own, (_, shingles) in zip(wanted, roles, _sets([batch], words), strict=True):
                if set_digest(shingles) != want:
                    continue
                cuts = np.searchsorted(shingles, np.arange(1, PARTS, dtype=np.uint64) << np.uint64(65 - PARTS.bit_length()))
                parts = [p.tobytes() for p in np.split(shingles, cuts)]
                for role in own:
                    spoke = None if role["is_hub"] else want
                    rows += [(role["hub"], role["block"], part, spoke, len(shingles), x) for part, x in enumerate(parts)]
                    held += 8 * len(shingles)
                    if held > SENT_BYTES:
                        yield _part_rows(rows)
                        rows, held = [], 0
            if rows:
                yield _part_rows(rows)
        release()

    return run


_PART_ROWS = "hub binary, block int, part int, spoke binary, n int, x binary"


def _part_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.binary(), pa.int32(), pa.int32(), pa.binary(), pa.int32(), pa.binary()]
    arrays = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=["hub", "block", "part", "spoke", "n", "x"])


def _bitmap(keys: DataFrame) -> np.ndarray:
    """Bytes of a bitmap of the keys, by their lowest bits; tasks' own bitmaps are merged, so its size alone is shuffled and sent."""
    size, wished = ROW_BITS, min(MOST_BITS, keys.count() * BITS_PER_KEY)
    while size < wished:
        size *= 2
    bit = F.col("key").bitwiseAND(F.lit(size - 1))
    placed = keys.select(F.call_function("div", bit, F.lit(ROW_BITS)).alias("row"), (bit % ROW_BITS).alias("place"))
    out = np.zeros((size // ROW_BITS, ROW_BITS // 8), np.uint8)
    for row, bits in gather(placed.groupBy("row").agg(F.bitmap_construct_agg("place").alias("bits"))):
        out[row] = np.frombuffer(bits, np.uint8)
    return out.ravel()


def _marked(keys: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Whether each key's bit is set."""
    at = (keys & np.uint64(8 * bits.size - 1)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _set_keys(words: int, share: int, shipped, marks) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of (doc_id, text, wanted): those keys of each set whose digest is wanted that the bitmap ``marks`` holds; a task sends each set once."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[bytes] = set()
        for batch in batches:
            wanted = batch.column("wanted").to_pylist()
            rows: list[tuple] = []
            for want, (doc_id, shingles) in zip(wanted, _sets([batch], words), strict=True):
                if want not in sent and set_digest(shingles) == want:
                    sent.add(want)
                    keys = fragment_keys(shingles, share, shipped.value)
                    keys = keys[_marked(keys, marks.value)]
                    if keys.size:
                        rows.append((want, doc_id, keys.view(np.int64)))
                if len(rows) >= 200:
                    yield _key_lists(rows)
                    rows = []
            if rows:
                yield _key_lists(rows)
        release()

    return run


def _key_lists(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.binary(), pa.int64(), pa.list_(pa.int64())]
    arrays = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=["digest", "doc", "keys"])


def _overlaps(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size of the overlap of each spoke's fragment with the hub's, of rows sorted by (hub, block, part), the hub's own first."""
    group, x = None, np.zeros(0, np.uint64)
    size = 0
    for batch in slices(batches, 512):
        found = []
        columns = [batch.column(c).to_pylist() for c in ("hub", "block", "part", "spoke", "n", "x")]
        for hub, block, part, spoke, n, raw in zip(*columns, strict=True):
            fragment = np.frombuffer(raw, np.uint64)
            if spoke is None:
                group, x, size = (hub, block, part), fragment, n
            elif group != (hub, block, part):
                raise ValueError("a set to compare with is missing")
            else:
                found.append((hub, spoke, size, n, part, len(np.intersect1d(x, fragment, assume_unique=True))))
        if found:
            kinds = [pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]
            arrays = [pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["a", "b", "na", "nb", "part", "overlap"])


def _known(ids: DataFrame, limit: int | None = None) -> DataFrame:
    """Identifiers to look up: broadcast if they are few enough, else left to a shuffled join."""
    return F.broadcast(ids) if ids.count() <= (BROADCAST_IDS if limit is None else limit) else ids


def _roles(near: DataFrame) -> DataFrame:
    """Rows (digest, roles) for the sets of pairs (a, b): each pair has a hub, the set of more pairs, to which the other's fragments go.

    A hub's pairs are cut into blocks of bounded size. A role is (hub, block, whether the set is the hub itself).
    """
    degree = near.select("a").union(near.select("b")).toDF("digest").groupBy("digest").agg(F.count("*").alias("pairs"))
    both = near.select("a", "b").join(degree.toDF("a", "pa"), "a").join(degree.toDF("b", "pb"), "b")
    first = F.col("pa") >= F.col("pb")
    both = both.select(
        F.when(first, F.col("a")).otherwise(F.col("b")).alias("hub"),
        F.when(first, F.col("b")).otherwise(F.col("a")).alias("digest"),
        F.ceil(F.greatest("pa", "pb") / F.lit(BLOCK)).cast("int").alias("blocks"),
    ).withColumn("block", F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int"))
    hubs = both.select(F.col("hub").alias("digest"), "hub", "block", F.lit(True).alias("is_hub")).distinct()
    rows = both.select("digest", "hub", "block", F.lit(False).alias("is_hub")).union(hubs)
    return rows.groupBy("digest").agg(F.collect_list(F.struct("hub", "block", "is_hub")).alias("roles"))


def _links(scratch: Scratch, name: str, pairs: DataFrame, details: DataFrame, sets: tuple[DataFrame, int], share: int, counted: list[DataFrame]) -> DataFrame:
    """The pairs (a, b) of digests that are linked: sketches first, then overlaps counted part by part and summed.

    ``sets`` are all documents and the words of a shingle. Pairs already ``counted`` are left out; those counted here join them.
    """
    short = details.select("digest", "n", "wide")
    near = (
        pairs.join(short.toDF("a", "na", "sa"), "a")
        .join(short.toDF("b", "nb", "sb"), "b")
        .where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * share)
    )
    sa, sb = _folded(F.col("sa"), F.col("sb")), _folded(F.col("sb"), F.col("sa"))
    apart = F.aggregate(F.zip_with(sa, sb, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)
    # linked sets differ in at most this many shingles
    near = near.where(apart * (100 + share) <= (F.col("na") + F.col("nb")) * (100 - share)).select("a", "b").distinct()
    for before in counted:
        near = near.join(before, ["a", "b"], "left_anti")
    near = scratch.store(near, f"{name}-near")
    counted.append(near)
    docs, words = sets
    roles = scratch.store(_roles(near).join(details.select("digest", "doc").distinct(), "digest"), f"{name}-roles")
    if roles.isEmpty():
        return scratch.store(near, name)
    few = roles.agg(F.sum(F.size("roles"))).first()[0] <= BROADCAST_IDS // 4
    wanted = roles.select(F.col("doc").alias("doc_id"), F.col("digest").alias("wanted"), "roles")
    texts = docs.join(F.broadcast(wanted) if few else wanted, "doc_id").select("doc_id", "text", "wanted", "roles")
    rows = texts.mapInArrow(_parts(words), _PART_ROWS)
    order = ["hub", "block", "part"]
    dealt = rows.repartition(*order).sortWithinPartitions(*order, F.asc_nulls_first("spoke"))
    found = dealt.mapInArrow(_overlaps, "a binary, b binary, na int, nb int, part int, overlap long")
    # a document may come several times; its parts are the same, so the largest is each of them
    found = found.groupBy("a", "b", "na", "nb", "part").agg(F.max("overlap").alias("overlap"))
    found = found.groupBy("a", "b", "na", "nb").agg(F.sum("overlap").alias("i"))
    linked = found.where(F.col("i") * 100 >= (F.col("na") + F.col("nb") - F.col("i")) * share).select("a", "b")
    return scratch.store(linked, name)


def _block_pairs(share: int, turn: int | None) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of sorted rows (key, i, j, side, digest, label, n, sketch): pairs of different classes in a block that their sketches allow.

    With a ``turn`` only pairs with one centre, which the turn picks.
    """

    def of_block(rows: pa.RecordBatch) -> tuple[list, list]:
        digests = rows.column("digest").to_pylist()
        label, n, side = (rows.column(c).to_numpy() for c in ("label", "n", "side"))
        sketch = rows.column("sketch").flatten().to_numpy().reshape(len(digests), SKETCH).view(np.uint64)
        diagonal = (rows.column("i")[0].as_py() == rows.column("j")[0].as_py())
        left = np.arange(len(digests)) if diagonal else np.flatnonzero(side == 0)
        right = left if diagonal else np.flatnonzero(side == 1)
        if turn is not None:
            first = np.frombuffer(b"".join(digests), np.uint64)[::2]
            left = np.array([int(mix(first ^ np.uint64(turn)).argmin())])
        a, b = [], []
        for x in left.tolist():
            to = right[right > x] if diagonal and turn is None else right[right != x]
            to = to[label[to] != label[x]]
            to = to[np.minimum(n[to], n[x]) * 100 >= np.maximum(n[to], n[x]) * share]
            apart = np.bitwise_count(sketch[to] ^ sketch[x]).sum(axis=1, dtype=np.int64)
            for y in to[apart * (100 + share) <= (n[to] + n[x]) * (100 - share)].tolist():
                a.append(min(digests[x], digests[y]))
                b.append(max(digests[x], digests[y]))
        return a, b

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.RecordBatch | None = None
        for batch in batches:
            if rest is not None and rest.num_rows:
                batch = pa.concat_batches([rest, batch])
            name = np.stack([batch.column(c).to_numpy() for c in ("key", "i", "j")], axis=1)
            cuts = [0, *(np.flatnonzero((name[1:] != name[:-1]).any(axis=1)) + 1).tolist()]
            yield pairs_of([batch.slice(x, y - x) for x, y in zip(cuts, cuts[1:], strict=False)])
            rest = batch.slice(cuts[-1])
        if rest is not None and rest.num_rows:
            yield pairs_of([rest])

    def pairs_of(blocks: list[pa.RecordBatch]) -> pa.RecordBatch:
        found = [of_block(block) for block in blocks if block.num_rows > 1]
        columns = [pa.array([x for pair in found for x in pair[side]], pa.binary()) for side in (0, 1)]
        return pa.RecordBatch.from_arrays(columns, names=["a", "b"])

    return run


def _met(scratch: Scratch, rows: DataFrame) -> DataFrame:
    """Of rows (key, a, n): (key, to, centre, sets) of documents with another centre, and of all under keys of more than two sets; stored."""
    same, parts = Window.partitionBy("key"), []
    for turn in range(KEY_TURNS):
        some = rows.where(F.pmod("key", F.lit(KEY_TURNS)) == turn)
        some = some.select("key", F.col("a").alias("to"), F.min("a").over(same).alias("centre"), F.sum("n").over(same).alias("sets"))
        parts.append(scratch.store(some.where("centre <> to or sets > 2"), f"met/{turn}"))
    return reduce(DataFrame.union, parts)


def _shared_keys(scratch: Scratch, keys: DataFrame, labels: DataFrame) -> DataFrame:
    """Stored rows (key, digest) of the keys that sets of different classes have, from stored rows (digest, doc, keys).

    Classes only grow together, so a key that is left out here stays explained. Its class, a number, stands for a set while keys are
    counted; digests are read again only for the keys that remain.
    """
    classes = keys.select("doc", "keys").join(_known(labels.toDF("doc", "label")), "doc", "left")
    rows = classes.select(F.explode("keys").alias("key"), F.coalesce("label", "doc").alias("label"))
    mixed = rows.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    mixed = scratch.store(mixed.select("key"), "mixed-keys")
    rows = keys.select(F.explode("keys").alias("key"), "digest")
    return scratch.store(rows.join(_known(mixed), "key", "left_semi"), "shared")


def _remaining(shared: DataFrame, details: DataFrame, labels: DataFrame, share: int, turn: int | None) -> DataFrame:
    """Pairs of digests of different classes under one key that may be linked."""
    sets = details.select("digest", "n", "sketch", F.col("doc").alias("node")).dropDuplicates(["digest"]).join(labels, "node", "left")
    sets = sets.select("digest", "n", "sketch", F.coalesce("label", "node").alias("label"))
    rows = shared.join(sets.select("digest", "label"), "digest")
    mixed = rows.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("size"))
    mixed = mixed.where("low <> high").select("key", F.ceil(F.col("size") / F.lit(BLOCK)).cast("int").alias("blocks"))
    members = shared.join(mixed, "key").withColumn("own", F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int"))
    if turn is None:
        other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    else:
        other = F.col("own")
    members = members.withColumn("other", other).select(
        "key",
        F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"),
        (F.col("own") > F.col("other")).cast("int").alias("side"),
        "digest",
    )
    ordered = members.join(sets, "digest").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return ordered.mapInArrow(_block_pairs(share, turn), "a binary, b binary").distinct()


def join(docs: DataFrame, words: int = 5, share: int = 80) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id) for the documents' (doc_id, text); linked: overlap * 100 >= union * share."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    with Scratch(docs.sparkSession, "jaccard") as scratch:
        sizes, labels = _classes(scratch, docs, words, share)
    sizes = sizes.union(docs.where("doc_id is null").mapInArrow(_sizes(words), "doc_id long, n int"))
    return sizes.join(labels.toDF("doc_id", "label"), "doc_id", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("label", "doc_id").alias("component_id")
    )


def _classes(scratch: Scratch, docs: DataFrame, words: int, share: int) -> tuple[DataFrame, DataFrame]:
    """Stored rows (doc_id, n) of all documents with an identifier, and (node, label) of those that are linked."""
    known = docs.where("doc_id is not null")
    release_heaps(docs.sparkSession)
    frequent = docs.sparkSession.sparkContext.broadcast(_frequent(known, words))
    scanned = scratch.store(known.mapInArrow(_scan(words, share, frequent), _KEY_ROWS), "fragments")
    info = scratch.store(scanned.where("key is null").select(F.col("a").alias("doc_id"), "n", "digest"), "info")
    sets = info.where("n > 0")
    firsts = scratch.store(sets.groupBy("digest").agg(F.min("doc_id").alias("doc")), "equal-sets")

    keyed = scanned.where("key is not null")
    met = _met(scratch, keyed.where("a = b").select("key", "a", "n"))
    stars = met.where("centre <> to").select("centre", "to").union(keyed.where("a <> b").select("a", "b")).distinct()
    by_doc = sets.select("doc_id", "digest").distinct()
    pairs = (
        stars.join(by_doc.toDF("centre", "x"), "centre")
        .join(by_doc.toDF("to", "y"), "to")
        .where("x <> y")
        .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        .distinct()
    )
    pairs = scratch.store(pairs, "star-pairs")
    scratch.remove("fragments")
    several = docs.sparkSession.sparkContext.broadcast(_bitmap(met.where("sets > 2").select("key")))
    scratch.remove("met")
    release_heaps(docs.sparkSession)
    wanted = pairs.select("a").union(pairs.select("b")).toDF("digest").distinct().join(firsts, "digest")
    wanted = scratch.store(wanted.select("doc", "digest"), "wanted")
    texts = docs.join(_known(wanted.toDF("doc_id", "wanted")), "doc_id")
    details = scratch.store(texts.mapInArrow(_details(words), _DETAILS), "details")

    def as_documents(links: DataFrame) -> DataFrame:
        named = links.join(wanted.toDF("da", "a"), "a").join(wanted.toDF("db", "b"), "b")
        return named.select(F.col("da").alias("a"), F.col("db").alias("b"))

    copies = sets.join(firsts, "digest").where("doc_id <> doc").select(F.col("doc_id").alias("a"), F.col("doc").alias("b"))
    counted: list[DataFrame] = []
    linked = _links(scratch, "linked-0", pairs, details, (known, words), share, counted)
    edges = scratch.store(copies.union(as_documents(linked)), "edges")
    labels = components(edges, "classes")
    keys = texts.mapInArrow(_set_keys(words, share, frequent, several), "digest binary, doc long, keys array<long>")
    keys = scratch.store(keys, "keys")
    shared = _shared_keys(scratch, keys, labels)
    scratch.remove("keys")
    for turn in range(1, STARS + 2):
        rest = scratch.store(_remaining(shared, details, labels, share, turn if turn <= STARS else None), f"rest-{turn}")
        if rest.isEmpty():
            continue
        more = _links(scratch, f"linked-{turn}", rest, details, (known, words), share, counted)
        if not more.isEmpty():
            edges = edges.union(as_documents(more))
            labels = components(edges, "classes")
    sizes = store(info.select("doc_id", "n"), "sizes")
    release_heaps(docs.sparkSession)
    return sizes, labels
