"""Word shingles as sorted 64-bit hashes: their global order is the order of the hashes."""

import numpy as np

from folioscope.llm.common import mix, word_hashes

_PLACE = mix(np.arange(1, 65, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)) | np.uint64(1)


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """Of each lower-cased text its distinct shingles of ``words`` words, sorted; with fewer words the whole sequence is one."""
    hashes, owner, _ = word_hashes(texts)
    n = np.bincount(owner, minlength=len(texts)) if hashes.size else np.zeros(len(texts), np.int64)
    ends = np.cumsum(n)
    runs = max(0, hashes.size - words + 1)
    joined = np.zeros(runs, np.uint64)
    for i in range(words):
        joined += hashes[i : i + runs] * _PLACE[i]
    joined = mix(joined)
    out = []
    for count, end in zip(n.tolist(), ends.tolist(), strict=True):
        if count >= words:
            out.append(np.unique(joined[end - count : end - words + 1]))
        elif count:
            whole = (hashes[end - count : end] * _PLACE[:count]).sum(dtype=np.uint64) + np.uint64(words - count)
            out.append(mix(np.array([whole], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_digest(shingles: np.ndarray) -> bytes:
    """16 bytes that stand for a whole set."""
    a = mix(shingles + np.uint64(0x51)).sum(dtype=np.uint64)
    b = mix(shingles ^ np.uint64(0x2545F4914F6CDD1D)).sum(dtype=np.uint64)
    return np.array([a, b], np.uint64).tobytes()


def most_apart(size: int, share: int) -> int:
    """Largest symmetric difference of a set of ``size`` and any set no smaller that overlaps by ``share`` percent of the union."""
    largest = size * 100 // share
    return (100 - share) * (size + largest) // (100 + share)


def level(size: int, share: int) -> int:
    """Bits of the order that cut it into more fragments, by a quarter, than linked sets can differ in."""
    return (most_apart(size, share) * 5 // 4).bit_length()


def levels(size: int, share: int) -> list[int]:
    """The levels at which a set must be cut: its own and that of the smallest set it can be linked to."""
    return sorted({level(-(-size * share // 100), share), level(size, share)})


def fragment_keys(shingles: np.ndarray, share: int, frequent: np.ndarray = np.zeros(0, np.uint64)) -> np.ndarray:  # noqa: B008
    """Keys of fragments of the order at each level: linked sets have one in common at least.

    Two sets that differ in D shingles agree in all but D fragments. If more than D of a set's fragments hold shingles that are
    not ``frequent`` (sorted), one of these agrees, so the keys of such fragments are enough for all its links. A set of which fewer
    do also sends the keys of all its shingles' fragments, and where not even more than D of them hold anything, those of the empty ones. Of two
    linked sets either one's first keys are enough, or both send the others too.
    """
    at = np.minimum(np.searchsorted(frequent, shingles), max(0, frequent.size - 1))
    rare = shingles[frequent[at] != shingles] if frequent.size else shingles
    out = []
    for bits in levels(len(shingles), share):
        apart = min(most_apart(len(shingles), share), (4 * (1 << bits) - 1) // 5)  # of any two sets that meet at this level
        for kind, part in enumerate([rare, shingles]):
            keys, filled = _keys(part, bits, kind)
            out.append(keys[filled])
            if np.count_nonzero(filled) > apart:
                break
        else:
            out.append(keys[~filled])
    return np.concatenate(out)


def _keys(shingles: np.ndarray, bits: int, kind: int) -> tuple[np.ndarray, np.ndarray]:
    """A key for each fragment at a level, and which fragments hold shingles."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(shingles), dtype=np.uint64)])
    cuts = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(0, np.uint64)
    at = np.concatenate([[0], np.searchsorted(shingles, cuts), [len(shingles)]])
    held = sums[at[1:]] - sums[at[:-1]]
    name = np.arange(len(held), dtype=np.uint64) + np.uint64((2 * bits + kind) << 40)
    return mix(held + mix(name)), at[1:] > at[:-1]


def parity_sketch(shingles: np.ndarray, words: int) -> np.ndarray:
    """Bits (in ``words`` 64-bit words) that each shingle toggles one of; two sketches differ in no more bits than the sets do in shingles."""
    place = (mix(shingles ^ np.uint64(0x9E3779B9)) >> np.uint64(32)) % np.uint64(64 * words)
    odd = np.bincount(place.astype(np.int64), minlength=64 * words) % 2
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)
