"""Byte-level BPE encoding and decoding as a reduction up a tree.

Method: token lists form a monoid. A piece of text that is itself a token is a leaf; any other is cut in halves, each half
is encoded by itself, and the two lists are joined. A join re-encodes a window around the seam, a few tokens
from either side, and widens it until the tokens outside are provably stable. The proof is by pairs: a list of
tokens is the encoding of its bytes exactly if each two neighbours, encoded together, give these two again. So it is
enough that the window's first and last tokens agree with the neighbours outside. Decoding is a homomorphism:
bytes of halves are concatenated up the tree.

Null and empty texts have no tokens and decode to the empty string. All whole texts are encoded; a text is never cut, as a
very long match only makes the tree deeper. Repeated rows are encoded each by itself. Extra columns pass through; a
column that has the name of an output is replaced.
"""

import base64
import hashlib
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, StringType

from folioscope.llm.common import appended, release, slices, with_columns

#: Entries that each of a worker's memo tables may hold (about 10 MB); a full one is emptied, which costs only time.
MEMO = 80_000

#: Pieces that a worker may remember from task to task where encoding is all that it does (about 80 MB).
PIECE_MEMO = 400_000

#: Identifiers that one leaf of the decoding tree takes.
DECODE_LEAF = 4096


def read_file(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def parse_ranks(content: bytes) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank a line."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines())}


class Coder(dict):
    """Encodes pieces and decodes identifiers; as a dict it maps a piece (str) to its identifiers' bytes."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, memo: int = MEMO):
        super().__init__()
        self.memo = memo
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks single bytes: {missing[:5]}")
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.find = regex.compile(pattern).findall
        self.halves: dict[bytes, tuple[int, ...]] = {}
        self.windows: dict[bytes, tuple[int, ...]] = {}
        self.stable: dict[tuple[int, int], bool] = {}

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= self.memo:
            self.clear()
        tokens = self.encode_bytes(piece.encode())
        ids = struct.pack(f"<{len(tokens)}I", *tokens)
        if len(piece) < 64:
            self[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Identifiers of a text, as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.__getitem__, self.find(text)))

    def encode_bytes(self, piece: bytes) -> tuple[int, ...]:
        rank = self.ranks.get(piece)
        if rank is not None:
            return (rank,)
        known = self.halves.get(piece)
        if known is None:
            if not piece:
                return ()
            half = len(piece) // 2
            known = self.join(self.encode_bytes(piece[:half]), self.encode_bytes(piece[half:]))
            if len(piece) <= 12:  # syllables and word stems come again and again
                if len(self.halves) >= MEMO:
                    self.halves.clear()
                self.halves[piece] = known
        return known

    def join(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        if self.agree(left[-1], right[0]):  # a window of no tokens: nothing changes at this seam
            return left + right
        width = 1
        while True:
            begin, end = max(0, len(left) - width), min(len(right), width)
            inner = self.window(b"".join(map(self.bytes_of.__getitem__, left[begin:] + right[:end])))
            if (begin == 0 or self.agree(left[begin - 1], inner[0])) and (
                end == len(right) or self.agree(inner[-1], right[end])
            ):
                return left[:begin] + inner + right[end:]
            width *= 2

    def agree(self, first: int, second: int) -> bool:
        pair = (first, second)
        known = self.stable.get(pair)
        if known is None:
            if len(self.stable) >= MEMO:
                self.stable.clear()
            known = self.window(self.bytes_of[first] + self.bytes_of[second]) == pair
            self.stable[pair] = known
        return known

    def window(self, piece: bytes) -> tuple[int, ...]:
        """The encoding of a short piece: the lowest-ranked neighbours are merged until none can be."""
        found = self.windows.get(piece)
        if found is None:
            if len(self.windows) >= MEMO:
                self.windows.clear()
            found = merge_all(piece, self.ranks)
            if len(piece) < 64:
                self.windows[piece] = found
        return found

    def decode(self, ids: np.ndarray) -> bytes:
        if len(ids) <= DECODE_LEAF:
            return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


def merge_all(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """Plain BPE; the leftmost of equally ranked pairs is merged first. Long windows go through a queue."""
    if len(piece) > 256:
        return _merge_queue(piece, ranks)
    parts = [piece[i : i + 1] for i in range(len(piece))]
    scores = [ranks.get(a + b) for a, b in zip(parts, parts[1:], strict=False)]
    while True:
        best, at = None, -1
        for i, score in enumerate(scores):
            if score is not None and (best is None or score < best):
                best, at = score, i
        if best is None:
            return tuple(ranks[p] for p in parts)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        del scores[at]
        if at < len(scores):
            scores[at] = ranks.get(parts[at] + parts[at + 1])
        if at:
            scores[at - 1] = ranks.get(parts[at - 1] + parts[at])


def _merge_queue(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    import heapq

    n = len(piece)
    end = list(range(1, n + 1))  # of the part that begins at i; 0: merged into an earlier one
    before = list(range(-1, n - 1))
    queue: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        if i >= 0 and end[i] < n:
            stop = end[end[i]]
            rank = ranks.get(piece[i:stop])
            if rank is not None:
                heapq.heappush(queue, (rank, i, stop))

    for i in range(n - 1):
        offer(i)
    while queue:
        _, i, stop = heapq.heappop(queue)
        middle = end[i]
        if not middle or middle >= n or end[middle] != stop:
            continue
        end[i], end[middle] = stop, 0
        if stop < n:
            before[stop] = i
        offer(before[i])
        offer(i)
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return tuple(out)


_CODERS: dict[tuple[bytes, str, int], Coder] = {}


def _coder(content: bytes, pattern: str, memo: int = MEMO) -> Coder:
    """One coder for a vocabulary in a worker process."""
    key = (content, pattern, memo)
    if key not in _CODERS:
        _CODERS.clear()
        _CODERS[key] = Coder(parse_ranks(content), pattern, memo)
    return _CODERS[key]


def _forget_all() -> None:
    """At the end of a task of several in a job: an idle worker holds neither vocabulary nor memo."""
    _CODERS.clear()
    release()


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", out: str = "token_ids") -> DataFrame:
    """Adds ``out``: the token identifiers as little-endian unsigned 32-bit integers (binary, four bytes each).

    The vocabulary (of fixed size, about a megabyte) is read on the driver and broadcast.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(read_file(ranks_path))
    schema = with_columns(docs.schema, **{out: BinaryType()})

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shipped.value, pattern)
        for batch in slices(batches):
            ids = [coder.encode(t) if t else b"" for t in batch.column(text).to_pylist()]
            yield appended(batch, schema, **{out: pa.array(ids, pa.binary())})
        _forget_all()

    return docs.mapInArrow(run, schema)


def decode(
    docs: DataFrame, ranks_path: str, pattern: str, ids: str = "token_ids", out: str = "decoded", as_text: bool = False
) -> DataFrame:
    """Adds ``out``: the bytes (or, with ``as_text``, the UTF-8 text) of the identifiers; null identifiers give none."""
    shipped = docs.sparkSession.sparkContext.broadcast(read_file(ranks_path))
    schema = with_columns(docs.schema, **{out: StringType() if as_text else BinaryType()})

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shipped.value, pattern)
        for batch in slices(batches):
            texts = [coder.decode(np.frombuffer(b or b"", "<u4")) for b in batch.column(ids).to_pylist()]
            made = pa.array([t.decode("utf-8", "replace") for t in texts]) if as_text else pa.array(texts, pa.binary())
            yield appended(batch, schema, **{out: made})
        _forget_all()

    return docs.mapInArrow(run, schema)


def digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Per document: number of tokens, digest of the identifiers, digest of what they decode to.

    Encoded, decoded and hashed in one pass over the texts; a worker keeps what it has learned of pieces for its next task.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(read_file(ranks_path))
    narrow = docs.select("doc_id", "text")
    kind = narrow.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shipped.value, pattern, PIECE_MEMO)
        for batch in slices(batches):
            rows = []
            for text in batch.column("text").to_pylist():
                ids = coder.encode(text) if text else b""
                decoded = coder.decode(np.frombuffer(ids, "<u4"))
                rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()))
            counted = zip(zip(*rows, strict=True), (pa.int64(), pa.string(), pa.string()), strict=True)
            made = [pa.array(column, arrow) for column, arrow in counted]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *made], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return narrow.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
