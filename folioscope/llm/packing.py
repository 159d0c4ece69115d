"""Packing tokenised documents into training sequences of one length.

Method: documents are dealt at random into groups (a round-robin exchange, whose tasks are cut to groups of a few thousand
documents in the order of a hash), and every group is packed by itself. A document's identifiers, with an end identifier after them, are
cut into whole sequences; what remains is placed by first-fit decreasing: the longest remainder first, each into the first
bin that still holds it. The bins' free places are the leaves of a tournament tree whose inner nodes keep the larger of their two
children, so the first bin that holds a piece is found by going down from the root. At the end of a group the fullest open bins are topped up
with pieces cut from the emptiest, and the one bin that stays open is cut into sequences whose lengths are powers of two,
which need no padding. So nothing is padded; only the ends of a group make short sequences.

Null and empty texts are the end identifier alone. Texts are tokenised and packed whole, however long. Repeated rows are
packed each by itself, also under one identifier; a null identifier stays null. An empty table gives no pieces. Extra columns are not read. Ties of length are
placed in the order of the hash, then of identifiers. Special tokens' strings in a text become these tokens, as the tokenizers library does unless told otherwise.

Groups are dealt evenly, so no key can be hot. A task holds one group's remainders, a few megabytes, and the identifiers of one document.
Rows are sorted by hash before they are cut to groups, so that a task run again packs the same.
"""

import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from folioscope.llm.bpe import read_file
from folioscope.llm.common import slices

#: Documents packed together. More fill bins better before the last ones are cut; a group's remainders are held in memory.
GROUP = 2048

#: Pieces in one Arrow batch.
_ROWS = 512

SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, token_ids binary"

Piece = tuple[int, int, int]  # item, start, length


class FirstFit:
    """Bins of equal size; finds the first that still holds a piece."""

    def __init__(self, bins: int, size: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.free = [size] * (2 * self.leaves)

    def place(self, length: int) -> int:
        """The number of the first bin with so much room, which is then taken."""
        free, node = self.free, 1
        while node < self.leaves:
            node *= 2
            if free[node] < length:
                node += 1
        bin_number = node - self.leaves
        free[node] -= length
        while node > 1:
            node //= 2
            larger = max(free[2 * node], free[2 * node + 1])
            if free[node] == larger:
                break
            free[node] = larger
        return bin_number


def first_fit_decreasing(lengths: list[int], size: int) -> list[list[int]]:
    """Bins of item numbers; the longest items first, ties in the given order, each in the first bin with room."""
    tree, bins = FirstFit(len(lengths), size), []
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        at = tree.place(lengths[item])
        if at == len(bins):
            bins.append([])
        bins[at].append(item)
    return bins


def topped_up(bins: list[list[Piece]], size: int) -> list[list[Piece]]:
    """Full bins, made by cutting pieces of the emptiest bins, and sequences of powers of two for the rest."""
    load = [sum(p[2] for p in b) for b in bins]
    out = [b for b, n in zip(bins, load, strict=True) if n == size]
    opened = sorted((i for i in range(len(bins)) if load[i] < size), key=lambda i: -load[i])
    first, last = 0, len(opened) - 1
    while first < last:
        into, out_of = bins[opened[first]], bins[opened[last]]
        room = size - load[opened[first]]
        while room and out_of:
            item, start, length = out_of.pop()
            taken = min(room, length)
            if taken < length:
                out_of.append((item, start, length - taken))
            into.append((item, start + length - taken, taken))
            room -= taken
            load[opened[first]] += taken
            load[opened[last]] -= taken
        if not room:
            out.append(into)
            first += 1
        if not out_of:
            last -= 1
    if first == last and bins[opened[first]]:
        out += _in_powers(bins[opened[first]])
    return out


def _in_powers(pieces: list[Piece]) -> list[list[Piece]]:
    """The pieces cut into sequences whose lengths are the powers of two in their sum, largest first."""
    total = sum(p[2] for p in pieces)
    rest, out = pieces[::-1], []
    for bit in reversed(range(total.bit_length())):
        if not total >> bit & 1:
            continue
        sequence, room = [], 1 << bit
        while room:
            item, start, length = rest.pop()
            taken = min(room, length)
            sequence.append((item, start, taken))
            if taken < length:
                rest.append((item, start + taken, length - taken))
            room -= taken
        out.append(sequence)
    return out


class Ids:
    """Identifiers of texts by a vocabulary file of the tokenizers library (byte-level BPE).

    The same vocabulary is used through tiktoken, which is several times faster; texts beyond its pattern matching (very long white
    space) go to the tokenizers library.
    """

    def __init__(self, content: bytes, pattern: str):
        parsed = json.loads(content)
        special = {t["content"]: t["id"] for t in parsed["added_tokens"]}
        # how byte-level vocabularies write bytes: printable ones of Latin-1 as themselves, the others from code point 256 on
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        written = {chr(b): b for b in printable}
        written |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in printable)}
        ranks = {bytes(map(written.__getitem__, t)): i for t, i in parsed["model"]["vocab"].items() if t not in special}
        self.content = content
        self.fast = tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
        self.slow: Tokenizer | None = None

    def of(self, text: str) -> np.ndarray:
        try:
            return self.fast.encode_to_numpy(text, allowed_special="all")
        except ValueError:
            self.slow = self.slow or Tokenizer.from_buffer(self.content)
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)


_IDS: dict[tuple[bytes, str], Ids] = {}


def _ids_of(content: bytes, pattern: str) -> Ids:
    """One vocabulary in a worker process."""
    key = (content, pattern)
    if key not in _IDS:
        _IDS.clear()
        _IDS[key] = Ids(content, pattern)
    return _IDS[key]


class _Group:
    """The remainders of some documents, waiting to be packed."""

    def __init__(self, size: int):
        self.size, self.items = size, []

    def add(self, doc_id: int | None, ids: np.ndarray) -> list[list[tuple]]:
        """Whole sequences of the document; what remains waits."""
        whole = len(ids) // self.size * self.size
        if whole < len(ids):
            self.items.append((doc_id, whole, len(ids), ids[whole:].copy()))
        return [[(doc_id, at, len(ids), ids[at : at + self.size])] for at in range(0, whole, self.size)]

    def pack(self) -> list[list[tuple]]:
        bins = first_fit_decreasing([len(i[3]) for i in self.items], self.size)
        bins = topped_up([[(i, 0, len(self.items[i][3])) for i in b] for b in bins], self.size)
        items, self.items = self.items, []
        return [
            [(items[i][0], items[i][1] + start, items[i][2], items[i][3][start : start + length]) for i, start, length in b]
            for b in bins
        ]


def pack(
    docs: DataFrame, vocabulary_path: str, pattern: str, end_id: int = 0, size: int = 1024, group: int = GROUP
) -> DataFrame:
    """Pieces of documents (doc_id, text) in sequences of ``size`` identifiers or of a smaller power of two.

    Columns: doc_id, start (identifiers of the document before the piece), length, doc_tokens (of the whole document, with the end
    identifier), sequence_id, offset (of the piece in its sequence), token_ids (little-endian unsigned 32-bit integers).
    The vocabulary file, of fixed size, is read on the driver and broadcast.
    """
    if size < 1 or size & (size - 1):
        raise ValueError("the sequence length must be a power of two")
    shipped = docs.sparkSession.sparkContext.broadcast(read_file(vocabulary_path))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = _ids_of(shipped.value, pattern)
        waiting, made = _Group(size), _Pieces()
        for batch in slices(batches, 64):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.append(ids_of.of(text or ""), np.uint32(end_id))
                for sequence in waiting.add(doc_id, ids):
                    yield from made.add(sequence)
                if len(waiting.items) == group:
                    for sequence in waiting.pack():
                        yield from made.add(sequence)
        for sequence in waiting.pack():
            yield from made.add(sequence)
        yield from made.rest()

    order = F.xxhash64("doc_id", "text")
    dealt = docs.select("doc_id", "text", order.alias("place")).hint("rebalance")
    sorted_docs = dealt.sortWithinPartitions("place", "doc_id").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return sorted_docs.mapInArrow(run, SCHEMA)


class _Pieces:
    """Rows of finished sequences, given out in batches; numbers the sequences within a task."""

    def __init__(self):
        context = TaskContext.get()
        self.number = (context.partitionId() if context else 0) << 33
        self.rows: list[tuple] = []

    def add(self, sequence: list[tuple]) -> Iterator[pa.RecordBatch]:
        offset = 0
        for doc_id, start, doc_tokens, ids in sequence:
            self.rows.append((doc_id, start, len(ids), doc_tokens, self.number, offset, ids.astype("<u4").tobytes()))
            offset += len(ids)
        self.number += 1
        if len(self.rows) >= _ROWS:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if not self.rows:
            return
        columns = list(zip(*self.rows, strict=True))
        self.rows = []
        names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "token_ids"]
        kinds = [pa.int64()] * 6 + [pa.binary()]
        arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names=names)


def piece_digests(pieces: DataFrame) -> DataFrame:
    """The pieces with the CRC-32 of their identifiers in place of these."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("token_ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
