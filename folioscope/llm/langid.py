"""Language identification by nearest centroid.

Method: a text is a vector of byte n-grams (one to three bytes of its lower-cased letters, hashed to FEATURES places), weighted by
TF-IDF and normalised. The labelled texts of each language are clustered into several centroids by spherical
k-means. A text gets the language of the centroid with the highest cosine. It is rejected if its cosine is below the floor of that
language for texts of its length. Floors come from the language's own texts, each scored by centroids of texts that it is
not among (five folds, one for each text if there are fewer): the cosine that all but REJECT_QUANTILE of the texts of at least this length reach,
drawn towards REJECT_FACTOR of itself where few texts are as long or as short (weight PRIOR against their number), never lower than the
floor of a shorter length. MARGIN stays below every floor, so that the last bits of a cosine, which depend on the processor, decide nothing. A
language with one text has no floor.

Document frequencies come from all labelled texts. Only the clustering uses a bounded sample: ``sample`` texts of each language, those
with the smallest hash of the identifier (of the text, where there is none). Whole texts are read, in slices of bounded size. More than
MAX_LANGUAGES labels are refused, as every task holds their centroids.

Null texts and texts without a letter: ``und``, score 0, rejected. Without any labelled text everything is ``und``. Ties go to the
alphabetically first language. Repeated rows are predicted each by itself. Extra columns pass through; one with the name of an
output is replaced.
"""

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType

from folioscope.llm.common import appended, chunks, gather, release, slices, text_bytes, with_columns

#: Places that n-grams are hashed to.
FEATURES = 1 << 13

#: Labelled texts of a language that its clustering reads at most.
SAMPLE = 1000

#: Centroids of a language.
CLUSTERS = 4

#: The share of a language's texts that may lie below its floor, and what the floor falls to where nothing is known of a length.
REJECT_QUANTILE, REJECT_FACTOR = 0.001, 0.5

#: Texts that weigh as much as the prior; a text that is no longer than others counts for so many of those that are longer.
PRIOR, SHORT_WEIGHT = 20, 20

#: What a cosine may fall short of a floor.
MARGIN = 1e-4

#: Labels at most: four centroids of 32 KB for each are sent to every task.
MAX_LANGUAGES = 500

#: Rows and bytes of text that one numpy step takes; its tables hold FEATURES numbers for each row.
STEP_ROWS, STEP_BYTES = 64, 1 << 17

#: Lengths, as powers of two, that have floors of their own.
LENGTHS = 24

_LETTERS = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_SALT = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)
_SHIFT = np.uint32(32 - FEATURES.bit_length() + 1)


def _normal(text: bytes) -> bytes:
    return b" %s " % b" ".join(text.translate(_LETTERS).split())


def counts(texts: list[bytes]) -> np.ndarray:
    """N-gram counts, one row for each lower-cased text; long texts are read in slices."""
    out = np.zeros((len(texts), FEATURES), np.float32)
    pieces = []
    for row, text in enumerate(texts):
        clean = _normal(text)
        pieces += [(row, clean[i : i + STEP_BYTES + 2]) for i in range(0, len(clean), STEP_BYTES)]
    for begin, end in chunks([p for _, p in pieces], STEP_BYTES):
        part = pieces[begin:end]
        raw = np.frombuffer(b"".join(p for _, p in part), np.uint8).astype(np.uint32)
        sizes = np.array([len(p) for _, p in part])
        owner = np.repeat(np.arange(len(part)), sizes)
        left = np.repeat(np.cumsum(sizes), sizes) - np.arange(raw.size)  # bytes to the end of the piece
        own = np.repeat(sizes, sizes) - left < STEP_BYTES  # a slice's last two bytes begin no gram of its own
        first = part[0][0]
        rows = np.array([r for r, _ in part]) - first
        total = np.zeros((int(rows[-1]) + 1) * FEATURES, np.int64)
        code = np.zeros(raw.size, np.uint32)
        for n in (1, 2, 3):
            code = code[: raw.size - n + 1] << np.uint32(8) | raw[n - 1 :]
            good = (left[: code.size] >= n) & own[: code.size]
            place = (code[good] + np.uint32(n)) * np.uint32(_SALT[n - 1]) >> _SHIFT
            total += np.bincount(rows[owner[: code.size][good]] * FEATURES + place, minlength=total.size)
        out[first : first + int(rows[-1]) + 1] += total.reshape(-1, FEATURES)
    return out


def steps(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of bounded number and, but for a single long text, of bounded size."""
    for begin, end in chunks(texts, STEP_BYTES):
        for b in range(begin, end, STEP_ROWS):
            yield b, min(end, b + STEP_ROWS)


def vectors(texts: list[bytes], idf: np.ndarray) -> np.ndarray:
    """Normalised TF-IDF vectors, in double precision."""
    return unit(counts(texts).astype(np.float64) * idf)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-12)


@dataclass
class Model:
    languages: list[str]  # of each centroid
    centroids: np.ndarray
    floors: np.ndarray  # of each centroid and length: lowest cosine that is not rejected
    idf: np.ndarray

    def nearest(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Of each text the best centroid and its cosine."""
        best, score = np.zeros(len(texts), np.int64), np.zeros(len(texts))
        for begin, end in steps(texts):
            cosine = vectors(texts[begin:end], self.idf) @ self.centroids.T
            best[begin:end] = cosine.argmax(axis=1)
            score[begin:end] = cosine.max(axis=1)
        return best, np.clip(score, 0.0, 1.0)


def _blocks(x: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """Rows of single precision in double precision, a few at a time."""
    for begin in range(0, len(x), STEP_ROWS):
        rows = slice(begin, begin + STEP_ROWS)
        yield rows, x[rows].astype(np.float64)


def cosines(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    out = np.zeros((len(x), len(centres)))
    for rows, block in _blocks(x):
        out[rows] = block @ centres.T
    return out


def _group_sums(x: np.ndarray, own: np.ndarray, k: int) -> np.ndarray:
    """Sums of the rows of each group from 0 to below ``k``; rows of other groups are left out."""
    out = np.zeros((k, x.shape[1]))
    for rows, block in _blocks(x):
        out += (own[rows] == np.arange(k)[:, None]).astype(np.float64) @ block
    return out


def spherical_kmeans(x: np.ndarray, k: int, used: np.ndarray | None = None, rounds: int = 10) -> tuple[np.ndarray, np.ndarray]:
    """Centroids of those unit vectors that are ``used``, and every vector's centroid.

    Starts from the farthest vectors, so it is repeatable. The vectors may be of single precision and are not copied.
    """
    used = np.ones(len(x), bool) if used is None else used
    centres = unit(_group_sums(x, np.where(used, 0, -1), 1))
    while len(centres) < min(k, int(used.sum())):
        near = np.where(used, cosines(x, centres).max(axis=1), np.inf)
        centres = np.vstack([centres, unit(x[int(near.argmin())].astype(np.float64))])
    own = cosines(x, centres).argmax(axis=1)
    for _ in range(rounds):
        sums = _group_sums(x, np.where(used, own, -1), len(centres))
        filled = np.linalg.norm(sums, axis=1) > 0
        centres = np.where(filled[:, None], unit(sums), centres)
        own = cosines(x, centres).argmax(axis=1)
    return centres, own


def length_class(texts: list[bytes]) -> np.ndarray:
    """Binary logarithm of each text's length in letters and single blanks, rounded down."""
    return np.array([min(LENGTHS, len(_normal(t)).bit_length()) - 1 for t in texts], np.int64)


def held_out_cosines(x: np.ndarray, clusters: int, mixed: np.ndarray, folds: int = 5) -> np.ndarray:
    """Of each unit vector the highest cosine with centroids of the other folds; 0 for a single vector."""
    out = np.zeros(len(x))
    folds = min(folds, len(x))
    fold = mixed % max(1, folds)
    for f in range(folds if folds > 1 else 0):
        out[fold == f] = cosines(x, spherical_kmeans(x, clusters, fold != f)[0]).max(axis=1)[fold == f]
    return out


def length_floors(cosine: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The floor of each length, from held-out cosines of texts and their lengths."""
    out = np.zeros(LENGTHS)
    for n in range(LENGTHS):
        longer = cosine[lengths >= n]
        known = min(longer.size, SHORT_WEIGHT * int((lengths <= n).sum()))
        reached = float(np.quantile(longer, REJECT_QUANTILE, method="lower")) if longer.size else 0.0
        out[n] = reached * (known + PRIOR * REJECT_FACTOR) / (known + PRIOR)
    return np.maximum.accumulate(out)


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def fit(labelled: DataFrame, sample: int = SAMPLE, clusters: int = CLUSTERS) -> Model:
    """Learn from rows of (key, text, lang); rows without a language or a letter are left out."""
    train = labelled.select("key", F.lower("text").alias("text"), "lang").where(
        F.col("lang").isNotNull() & has_letter(F.col("text"))
    )

    def frequencies(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(FEATURES, np.int64), 0
        for batch in batches:
            texts = text_bytes(batch.column("text"))
            for begin, end in steps(texts):
                total += (counts(texts[begin:end]) > 0).sum(axis=0)
            n += len(texts)
        if n:
            features = [*np.flatnonzero(total).tolist(), -1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(features, pa.int32()), pa.array([*total[total > 0].tolist(), n], pa.int64())], names=["feature", "n"]
            )
        release()

    seen = train.select("text").mapInArrow(frequencies, "feature int, n long").groupBy("feature").agg(F.sum("n"))
    found = dict(gather(seen))  # at most one row for each feature
    texts = found.pop(-1, 0)
    frequency = np.zeros(FEATURES)
    frequency[list(found)] = list(found.values())
    idf = np.log((1 + texts) / (1 + frequency)) + 1

    sizes = train.groupBy("lang").count()
    if sizes.limit(MAX_LANGUAGES + 1).count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    spot = F.xxhash64(F.coalesce(F.col("key").cast("string"), F.col("text")))
    share = F.least(F.lit(1.0), F.lit(2.0 * sample + 100) / F.col("count"))
    order = Window.partitionBy("lang").orderBy("spot", "text")
    some = (
        train.join(F.broadcast(sizes), "lang")  # one row for each language
        .withColumn("spot", spot)
        .where(F.pmod("spot", F.lit(1 << 30)) < share * F.lit(1 << 30))
        .withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= sample)
        .select("lang", "place", "text")
    )

    def vectorise(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices([batch], STEP_ROWS):
                texts = text_bytes(part.column("text"))
                rows = [counts([t])[0].tobytes() for t in texts]
                kept = part.drop_columns(["text"])
                yield pa.RecordBatch.from_arrays(
                    [*kept.columns, pa.array(length_class(texts), pa.int32()), pa.array(rows, pa.binary())],
                    names=["lang", "place", "length", "grams"],
                )

    def cluster(rows: pd.DataFrame) -> pd.DataFrame:
        order = np.argsort(rows["place"].to_numpy())
        x = np.zeros((len(rows), FEATURES), np.float32)
        for at, row in enumerate(order):
            x[at] = unit(np.frombuffer(rows["grams"].iloc[row], np.float32) * idf)
        centres, own = spherical_kmeans(x, clusters)
        mixed = np.random.default_rng(0).permutation(len(x))  # folds that do not follow the order of the texts
        floors = length_floors(held_out_cosines(x, clusters, mixed), rows["length"].to_numpy()[order])
        kept = [c.tobytes() for j, c in enumerate(centres) if (own == j).any()]
        lang = rows["lang"].iloc[0]
        del rows, x
        release()
        return pd.DataFrame({"lang": lang, "centroid": kept, "floors": [floors] * len(kept)})

    # a group holds counts of fixed size, however long its texts are
    grams = some.mapInArrow(vectorise, "lang string, place int, length int, grams binary")
    rows = gather(grams.groupBy("lang").applyInPandas(cluster, "lang string, centroid binary, floors array<double>"))
    rows.sort(key=lambda r: (r[0], bytes(r[1])))
    centroids = np.array([np.frombuffer(c) for _, c, _ in rows]).reshape(-1, FEATURES)
    return Model([r[0] for r in rows], centroids, np.array([r[2] for r in rows]).reshape(-1, LENGTHS), idf)


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds lang_pred, score (the cosine, 0 to 1) and rejected to each row."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # a few vectors for each language
    schema = with_columns(docs.schema, lang_pred=StringType(), score=DoubleType(), rejected=BooleanType())
    readable = with_columns(docs.schema, _lower=StringType(), **{})
    columns = [f.name for f in readable]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shipped.value
        for batch in slices(batches):
            lower = batch.column("_lower")
            texts = text_bytes(lower)
            known = np.array([len(own.languages) > 0 and t is not None for t in lower.to_pylist()], bool)
            best, score = own.nearest(texts) if known.any() else (np.zeros(len(texts), np.int64), np.zeros(len(texts)))
            names = [own.languages[b] if k else "und" for b, k in zip(best, known, strict=True)]
            sizes = length_class(texts)
            out = [s < own.floors[b, n] - MARGIN if k else True for b, n, s, k in zip(best, sizes, score, known, strict=True)]
            plain = batch.drop_columns(["_lower"])
            yield appended(
                plain,
                schema,
                lang_pred=pa.array(names, pa.string()),
                score=pa.array(np.where(known, score, 0.0)),
                rejected=pa.array([bool(x) for x in out], pa.bool_()),
            )
        release()

    lower = F.when(has_letter(F.col(text)), F.lower(text))
    return docs.withColumn("_lower", lower).select(*[F.col(f"`{c}`") for c in columns]).mapInArrow(run, schema)
