"""What several operators of this subpackage share: stored steps, batches, word hashes, components."""

import ctypes
import gc
import sys
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from folioscope.session import fresh_path

#: Bytes of text that one numpy step takes at a time; a longer text is a step of its own.
CHUNK_BYTES = 1 << 20

_UPPER = bytes(range(65, 91))
#: For bytes.translate: A-Z to lower case, everything else unchanged.
LOWER = bytes.maketrans(_UPPER, _UPPER.lower())

_WORD = [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]

#: For bytes.translate: A-Z to lower case, and all but letters, digits and bytes of characters outside ASCII to spaces.
WORDS_ONLY = LOWER.translate(bytes(b if b in _WORD else 0x20 for b in range(256)))

#: For each byte, whether it is white space of the word contracts (space, tab to carriage return).
SPACE = np.isin(np.arange(256), [32, *range(9, 14)])

#: What A-Z are in SQL's translate().
UPPER_SQL, LOWER_SQL = _UPPER.decode(), _UPPER.lower().decode()


def open_docs(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Spark's own setting: whether a query's shuffle files are deleted when it ends, and not only when the driver's JVM notices that no plan refers to them.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def cleanup(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of queries that run in the block, which nothing reads after that, go when each ends."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def write(df: DataFrame, path: str) -> DataFrame:
    """Write a step and read it back. Its shuffle files go when it is written."""
    with cleanup(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fetch(df: DataFrame) -> pa.Table:
    """All rows of a frame that the caller has bounded, as a table; the shuffle files go."""
    with cleanup(df.sparkSession):
        return df.select("*").toArrow()  # a query takes the setting when its frame is made


def store(df: DataFrame, name: str) -> DataFrame:
    """Write a step to the folder all executors share and read it back, so that a lost executor costs no recomputation."""
    return write(df, fresh_path(df.sparkSession, name))


class Scratch:
    """A folder of stored steps that goes, with all in it, when the block ends; only eager results may come out of it."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, fresh_path(spark, name)

    def __enter__(self) -> "Scratch":
        return self

    def store(self, df: DataFrame, name: str) -> DataFrame:
        return write(df, f"{self.root}/{name}")

    def remove(self, name: str = "") -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}".rstrip("/"))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def __exit__(self, *_) -> None:
        self.remove()


def with_columns(schema: StructType, **types) -> StructType:
    """The schema with columns added at its end; one of the same name is replaced."""
    out = StructType([f for f in schema if f.name not in types])
    for name, kind in types.items():
        out = out.add(name, kind)
    return out


def appended(batch: pa.RecordBatch, schema: StructType, **values) -> pa.RecordBatch:
    """The batch with columns added as in with_columns."""
    kept = [i for i, n in enumerate(batch.schema.names) if n not in values]
    return pa.RecordBatch.from_arrays(
        [batch.column(i) for i in kept] + list(values.values()),
        names=[batch.schema.names[i] for i in kept] + list(values),
    )


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in parts of a few rows, so that a task never holds Python copies of a whole batch."""
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            yield batch.slice(begin, rows)


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; a null is an empty text."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def chunks(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes together; no text is cut."""
    begin, size = 0, 0
    for i, text in enumerate(texts):
        if i > begin and size + len(text) > limit:
            yield begin, i
            begin, size = i, 0
        size += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = np.uint64(0xD1342543DE82EF95)


def word_hashes(texts: list[bytes], space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each word of lower-cased texts: a 64-bit hash, its text's index, its first byte's offset in the joined texts.

    The texts are joined by one separator each; words are the runs of bytes that are not ``space``.
    """
    raw = np.frombuffer(b" ".join(texts).translate(LOWER), np.uint8)
    none = np.zeros(0, np.int64)
    if not raw.size:
        return none.astype(np.uint64), none, none
    inside = ~space[raw]
    edge = np.diff(inside.astype(np.int8), prepend=np.int8(0))
    starts = np.flatnonzero(edge == 1)
    if not starts.size:
        return none.astype(np.uint64), none, none
    at = np.flatnonzero(inside)
    word = np.cumsum(edge == 1)[at] - 1
    place = at - starts[word]
    power = np.cumprod(np.full(int(place.max()) + 1, _BASE), dtype=np.uint64)
    first = np.flatnonzero(place == 0)
    hashes = mix(np.add.reduceat(_BYTE[raw[at]] * power[place], first))
    ends = np.cumsum([len(t) + 1 for t in texts])
    return hashes, np.searchsorted(ends, starts, side="right"), starts


def release() -> None:
    """Give back what this worker no longer uses: workers outlive their tasks and share the machine with those of other stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        getattr(ctypes.CDLL(None), "malloc_trim", int)(0)


def release_heaps(spark: SparkSession) -> None:
    """Executors collect their garbage once, and so give heap that earlier steps have grown back to the Python workers beside them.

    A JVM shrinks its heap only when it has collected all of it, which short-lived rows alone never make it do.
    """
    tasks = spark.sparkContext.defaultParallelism
    with cleanup(spark):
        spark.range(0, tasks, 1, tasks).select(F.call_function("java_method", F.lit("java.lang.System"), F.lit("gc")).alias("done")).collect()


def gather(df: DataFrame) -> list[tuple]:
    """All rows of a frame that the caller has bounded."""
    return [tuple(r) for r in df.collect()]


def components(edges: DataFrame, name: str = "components", limit: int = 60) -> DataFrame:
    """Connected components of links (a, b): node and the smallest node it reaches.

    Each round gives every node the smallest label among its neighbours and then the label of that label (pointer
    jumping), so the rounds grow with the logarithm of the longest chain. Hot nodes are pre-aggregated by the
    partial min. Every round is written to the shared folder. Null ends and self-links are ignored.
    """
    clean = edges.select("a", "b").where("a <> b")
    with Scratch(edges.sparkSession, name) as scratch:
        both = scratch.store(clean.union(clean.select("b", "a")).toDF("node", "other").distinct(), "links")
        labels = both.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("label"))
        labels = scratch.store(labels, "0")
        for step in range(1, limit + 1):
            near = both.join(labels.toDF("other", "theirs"), "other").groupBy("node").agg(F.min("theirs").alias("theirs"))
            lower = labels.join(near, "node").select("node", "label", F.least("label", "theirs").alias("new"))
            # hook: a root takes the smallest label that any of its nodes has met; then every node follows its label
            roots = lower.groupBy("label").agg(F.min("new").alias("hook"))
            hooked = lower.join(roots, "label").select("node", "label", F.least("new", "hook").alias("new"))
            parents = hooked.select(F.col("node").alias("new"), F.col("new").alias("up"))
            followed = hooked.join(parents, "new", "left").select(
                "node", "label", F.least("new", F.coalesce("up", "new")).alias("new")
            )
            followed = scratch.store(followed, str(step))
            labels = followed.select("node", F.col("new").alias("label"))
            if followed.where("label <> new").isEmpty():
                return store(labels, name)
            scratch.remove(str(step - 1))
    raise RuntimeError(f"components did not settle in {limit} rounds")


def is_held_out(doc_id: Column, parts: int) -> Column:
    """Whether crc32 of the identifier, as text, is a multiple of ``parts``; false for a null identifier."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == 0, F.lit(False))
