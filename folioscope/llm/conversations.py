"""A trie of conversation prefixes: how many conversations share each beginning, and what storing it once saves.

Method: identical conversations collapse into one weighted sequence with the list of those that end there. Sequences that are proper prefixes
of others are dropped by an anti-join; those left are the leaves. Every sequence then gives its weight to each of its prefixes, and
prefixes are aggregated. A prefix is known by its length and a 128-bit fingerprint, the exclusive or of a hash of every (place, turn)
up to it, so it is a running aggregate over a conversation's turns and neither texts nor whole conversations are ever
collected. What a subtree saves is summed without listing each node's ancestors: a node's own figure is put on the sequence that names
the node, summed along that sequence from its end, and a node then adds these sums over the sequences through it.

Defined cases: turns are ordered by turn (null first), those of equal turn by the MD5 digest of role and text. A null role or text is
empty. Repeated rows are turns like others. Rows without conv_id belong to no conversation and are left out. An
empty table has no nodes, not even the root. Extra columns are not read. Texts of any length are hashed whole, at the scan; two different ones
count as one with a chance of about 2^-64 times the square of their number over 2^64.

Hot groups: copies are reduced within each task before they are shuffled, a common turn's prefixes likewise. The list of those that
end at a node is hashed as a stream, in pieces of 4,096 identifiers at most, and never held.
"""

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.llm.common import slices, store

#: Identifiers whose upper bits agree share a piece of an end list: 2^12 at most.
_PIECE_BITS = 12

_KEY = ("depth", "x1", "x2")

#: The digest of the empty list.
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``(conv_id, place, body, n_bytes)``: each turn's place from 0, the digest of role and text, the bytes of its text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    # the length of the role first, so that role and text cannot run into each other
    body = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", body.alias("body"), F.octet_length(text).cast("long").alias("n_bytes")
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "body")
    return turns.select("conv_id", (F.row_number().over(order) - 1).cast("long").alias("place"), "body", "n_bytes")


def rebuilt(turns: DataFrame, family: int = 5, heads: int = 9) -> DataFrame:
    """Conversations that begin with turns of another, in the columns of ordered_turns, which is read several times.

    Conversation c takes the first h turns of c - c % ``family`` (all if it has fewer, none if it is absent) and then its own
    after the first h, where h is the unsigned CRC-32 of c, written in decimal, modulo ``heads``.
    """
    lengths = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_turns"))
    head = F.crc32(F.col("conv_id").cast("string")) % heads
    members = lengths.select("conv_id", head.alias("h"), (F.col("conv_id") - F.col("conv_id") % family).alias("base"))
    sizes = lengths.select(F.col("conv_id").alias("base"), "n_turns")
    members = members.join(sizes, "base", "left").select(
        "conv_id", "base", "h", F.least("h", F.coalesce("n_turns", F.lit(0))).alias("taken")
    )
    first = turns.where(F.col("place") < heads - 1).withColumnRenamed("conv_id", "base")
    begun = members.join(first, "base").where("place < h").select("conv_id", "place", "body", "n_bytes")
    own = turns.withColumn("h", head).where("place >= h").drop("h").join(members.select("conv_id", "h", "taken"), "conv_id")
    own = own.select("conv_id", (F.col("place") - F.col("h") + F.col("taken")).alias("place"), "body", "n_bytes")
    return begun.union(own)


def _hash(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), "place", "body")


def trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations, one row per node (see prefix_trie)."""
    turns = store(ordered_turns(conversations), "turns")
    return prefix_trie(store(rebuilt(turns), "rebuilt"), turns.select("conv_id").distinct())


def prefix_trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per distinct prefix of the sequences in ``turns``, the empty one (the root) included.

    ``turns`` holds conv_id, place (from 0, without gaps), body and n_bytes; ``conversations`` every conv_id once, also those without
    turns. Both are read several times, so pass stored frames. Columns, all long but the last: conv_id (smallest member), depth, parent_conv_id
    (null at the root), n_convs, n_children, n_leaves, saved_tokens (bytes of the last text for each member but one, summed
    over the subtree), ends_sha256 (digest of the members that end here, ascending, comma-joined).
    """
    hashed = turns.select("conv_id", (F.col("place") + 1).alias("depth"), _hash(1).alias("h1"), _hash(2).alias("h2"), "n_bytes")
    zero = F.lit(0).cast("long")
    nothing = [zero.alias("depth"), zero.alias("h1"), zero.alias("h2"), zero.alias("n_bytes")]

    # whole sequences: a conversation's fingerprint is that of its longest prefix
    ends = hashed.union(conversations.select("conv_id", *nothing)).groupBy("conv_id").agg(
        F.max("depth").alias("depth"), F.bit_xor("h1").alias("x1"), F.bit_xor("h2").alias("x2")
    )
    ends = store(ends, "ends")
    sequences = ends.groupBy(*_KEY).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("weight"))
    sequences = store(sequences, "sequences")

    # their prefixes, the empty one included
    chosen = hashed.join(sequences.select("conv_id"), "conv_id", "left_semi").union(sequences.select("conv_id", *nothing))
    along = Window.partitionBy("conv_id").orderBy("depth")
    prefixes = chosen.withColumns({"x1": F.bit_xor("h1").over(along), "x2": F.bit_xor("h2").over(along)})
    longer = Window.partitionBy("conv_id")
    prefixes = prefixes.withColumns(
        {
            "p1": F.col("x1").bitwiseXOR(F.col("h1")),
            "p2": F.col("x2").bitwiseXOR(F.col("h2")),
            "whole": F.max("depth").over(longer) == F.col("depth"),
        }
    )
    prefixes = store(prefixes.drop("h1", "h2"), "prefixes")

    proper = prefixes.where("not whole").select(*_KEY).distinct()
    leaves = sequences.join(proper, list(_KEY), "left_anti").select("conv_id", F.lit(1).cast("long").alias("leaf"))
    weighted = prefixes.join(sequences.select("conv_id", "weight"), "conv_id").join(leaves, "conv_id", "left")
    nodes = weighted.groupBy(*_KEY).agg(
        F.min("conv_id").alias("conv_id"),
        F.sum("weight").alias("n_convs"),
        F.sum(F.coalesce("leaf", zero)).alias("n_leaves"),
        F.first("n_bytes").alias("n_bytes"),
        F.first("p1").alias("p1"),
        F.first("p2").alias("p2"),
    )
    nodes = store(nodes, "nodes")

    named = nodes.select("conv_id", "depth", ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("own"))
    back = Window.partitionBy("conv_id").orderBy(F.desc("depth"))
    suffixes = prefixes.select("conv_id", *_KEY).join(named, ["conv_id", "depth"], "left").select(
        *_KEY, F.sum(F.coalesce("own", zero)).over(back).alias("suffix")
    )
    saved = suffixes.groupBy(*_KEY).agg(F.sum("suffix").alias("saved_tokens"))

    above = [(F.col("depth") - 1).alias("depth"), F.col("p1").alias("x1"), F.col("p2").alias("x2")]
    children = nodes.where("depth > 0").groupBy(*above).agg(F.count(F.lit(1)).alias("n_children"))
    found = nodes.join(children, list(_KEY), "left").join(saved, list(_KEY)).join(end_digests(ends), list(_KEY), "left")

    # the root's name is one number, so that its many children need no join; deeper ones look their parent up
    root = nodes.where("depth = 0").agg(F.min("conv_id").alias("root")).first()["root"]
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("x1").alias("p1"), F.col("x2").alias("p2"), F.col("conv_id").alias("up"))
    top = found.where("depth < 2").withColumn("up", F.when(F.col("depth") == 1, F.lit(root).cast("long")))
    deep = found.where("depth >= 2").join(parents, ["depth", "p1", "p2"])
    return top.unionByName(deep).select(
        "conv_id", "depth", F.col("up").alias("parent_conv_id"), "n_convs", F.coalesce("n_children", zero).alias("n_children"),
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(_NO_ENDS)).alias("ends_sha256"),
    )


def end_digests(ends: DataFrame) -> DataFrame:
    """``(depth, x1, x2, ends_sha256)`` of every sequence, from one row (conv_id, depth, x1, x2) per conversation."""
    piece = F.shiftright("conv_id", _PIECE_BITS)
    identifiers = F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string"))
    pieces = ends.groupBy(*_KEY, piece.alias("piece")).agg(F.array_join(identifiers, ",").alias("ids"))
    in_order = pieces.repartition(*_KEY).sortWithinPartitions(*_KEY, "piece")
    schema = "depth long, x1 long, x2 long, ends_sha256 string"
    return in_order.select(*_KEY, "ids").mapInArrow(_streamed_digests, schema)


def _streamed_digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per run of rows with the same key; a list is fed piece by piece."""
    key, digest, done = None, None, []
    for batch in slices(batches, 256):
        for *this, ids in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if this != key:
                if key is not None:
                    done.append((*key, digest.hexdigest()))
                key, digest = this, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
        if done:
            yield _digest_rows(done)
            done = []
    if key is not None:
        yield _digest_rows([(*key, digest.hexdigest())])


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 3 + [pa.string()]
    arrays = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=["depth", "x1", "x2", "ends_sha256"])
