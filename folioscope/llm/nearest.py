"""Approximate nearest neighbours with balanced posting lists.

Method: a bounded sample is cut into clusters of equal size by repeated splits at the median, and the clusters' means are the centroids of the
posting lists. Every vector is stored in the list of its nearest centroid; one near a boundary also in those of other
centroids that are hardly farther. Centroids are searched by a neighbour graph held in memory, with a best-first walk. A query
reads the lists whose centroid is within a ratio of the distance of the nearest ones; distances to their vectors are computed in
double precision on the original values. Queries that find fewer than k vectors there, though there are more, read all lists.

Equal vectors are one entry with their k + 1 smallest identifiers, which is all that any answer can need; so a vector that a third of all rows
share is no hot group. Lists longer than LIST_ROWS, and the queries of a list, are dealt to several tasks.

Vectors that are null, zero, or hold null or non-finite components take no part, nor do rows without an identifier or of another
length than most (of equally frequent lengths the shorter is kept). Of rows that share an identifier the nearest counts. Ties go to the smaller
identifier. Extra columns are not read. Without vectors the result is empty.

Recall against brute force is in the README. The sample, the number of centroids and the widths are parameters (Plan).
"""

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioscope.llm.common import gather, store


@dataclass(frozen=True)
class Plan:
    sample: int = 32_768  #: vectors that the centroids are fitted on at most
    cluster: int = 64  #: vectors of the sample in a cluster
    degree: int = 16  #: links of a centroid in the graph
    width: int = 384  #: candidates that a query's walk keeps
    copies: int = 4  #: lists that a vector is stored in at most
    boundary: float = 0.05  #: a boundary vector's other centroids are at most this much farther than its nearest
    steady: int = 4  #: the ratio is taken from the distance of the centroid at this place, as the nearest may be the vector itself
    reach: float = 0.1  #: the lists a query reads are at most this much farther than that


#: Vectors, and queries, of a list that one task compares.
LIST_ROWS, QUERY_ROWS = 4096, 1024


class Graph:
    """Centroids, each linked to its nearest ones; a walk from a few entries finds the nearest to a vector."""

    def __init__(self, centroids: np.ndarray, degree: int):
        self.centroids = centroids.astype(np.float64)
        n = len(centroids)
        k = min(degree, n - 1)
        links = np.argsort(squared(self.centroids, self.centroids) + np.diag(np.full(n, np.inf)), axis=1)[:, :k]
        # a ring through all, in a fixed order, keeps the graph in one piece
        order = np.random.default_rng(0).permutation(n)
        ring = np.empty((n, 2), np.int64)
        ring[order, 0], ring[order, 1] = np.roll(order, 1), np.roll(order, -1)
        self.links = np.concatenate([links, ring], axis=1)
        self.entries = order[: max(1, min(n, 16))]

    def search(self, vectors: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """For each vector up to ``width`` near centroids, nearest first, and their distances; -1 and inf fill the rest."""
        rows, n = np.arange(len(vectors)), len(self.centroids)
        width = min(width, n)
        best = np.full((len(vectors), width), -1, np.int64)
        far = np.full((len(vectors), width), np.inf)
        seen = np.zeros((len(vectors), n + 1), bool)  # the last column stands for -1
        done = np.zeros((len(vectors), n + 1), bool)
        done[:, n] = seen[:, n] = True
        fresh = np.broadcast_to(self.entries, (len(vectors), len(self.entries)))
        active = rows
        while active.size:
            known = np.take_along_axis(seen[active], fresh, axis=1)
            seen[active[:, None], fresh] = True
            apart = ((self.centroids[fresh] - vectors[active][:, None, :]) ** 2).sum(axis=2)
            apart[known] = np.inf
            ids = np.concatenate([best[active], np.where(known, -1, fresh)], axis=1)
            dist = np.concatenate([far[active], apart], axis=1)
            keep = np.argsort(dist, axis=1, kind="stable")[:, :width]
            best[active], far[active] = np.take_along_axis(ids, keep, axis=1), np.take_along_axis(dist, keep, axis=1)
            best[active] = np.where(np.isinf(far[active]), -1, best[active])
            # of each vector that has candidates left, the nearest unvisited one goes next
            todo = ~np.take_along_axis(done[active], best[active], axis=1)
            at = todo.argmax(axis=1)
            active = active[todo.any(axis=1)]
            at = at[todo.any(axis=1)]
            nexts = best[active, at]
            done[active, nexts] = True
            fresh = self.links[nexts]
        return best, np.sqrt(far)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * a @ b.T, 0.0)


def balanced_centroids(x: np.ndarray, size: int) -> np.ndarray:
    """Means of clusters of at most ``size`` vectors, from splits in halves along the line between two centres."""
    out, todo = [], [np.arange(len(x))]
    while todo:
        own = todo.pop()
        if len(own) <= size:
            out.append(x[own].mean(axis=0))
            continue
        part = x[own]
        a = part[int(((part - part.mean(axis=0)) ** 2).sum(axis=1).argmax())]
        b = part[int(((part - a) ** 2).sum(axis=1).argmax())]
        for _ in range(4):
            near = ((part - a) ** 2).sum(axis=1) <= ((part - b) ** 2).sum(axis=1)
            if near.all() or not near.any():
                break
            a, b = part[near].mean(axis=0), part[~near].mean(axis=0)
        order = np.argsort(part @ (b - a), kind="stable")
        todo += [own[order[: len(own) // 2]], own[order[len(own) // 2 :]]]
    return np.array(out)


def lists_of(vectors: np.ndarray, graph: Graph, plan: Plan) -> list[list[int]]:
    """The lists that each vector is stored in."""
    ids, dist = graph.search(vectors, 4 * plan.copies)
    within = (ids >= 0) & (dist <= (1 + plan.boundary) * dist[:, :1])
    return [own[w][: plan.copies].tolist() for own, w in zip(ids, within, strict=True)]


def lists_read(vectors: np.ndarray, graph: Graph, plan: Plan) -> list[list[int]]:
    """The lists that each query reads."""
    ids, dist = graph.search(vectors, plan.width)
    at = min(plan.steady, ids.shape[1]) - 1
    within = (ids >= 0) & (dist <= (1 + plan.reach) * dist[:, at : at + 1])
    return [own[w].tolist() for own, w in zip(ids, within, strict=True)]


def matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), np.float64)


def _dealt(graph, plan: Plan, choose):
    """Adds the lists chosen for each row's embedding, one row for each."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 1024):
                part = batch.slice(begin, 1024)
                chosen = choose(matrix(part.column("embedding")), graph.value, plan)
                again = part.take(pa.array(np.repeat(np.arange(part.num_rows), [len(c) for c in chosen])))
                lists = pa.array([c for own in chosen for c in own], pa.int32())
                yield pa.RecordBatch.from_arrays([*again.columns, lists], names=[*again.schema.names, "list"])

    return run


def valid(vectors: DataFrame) -> DataFrame:
    """Rows (vec_id, embedding) that take part."""
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    some = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(
        F.col("vec_id").isNotNull() & F.coalesce(whole, F.lit(False)) & F.exists("embedding", lambda x: x != 0)
    )
    sizes = some.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").limit(1)
    found = gather(sizes)
    return some.where(F.size("embedding") == (found[0][0] if found else -1))


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, plan: Plan = Plan()) -> DataFrame:  # noqa: B008
    """Rows (query_id, rank, vec_id, score): each query's k nearest of the vectors but itself; both frames hold (vec_id, embedding)."""
    spark = vectors.sparkSession
    everything = valid(vectors)
    # the smallest identifiers of each distinct vector; the row limit works within each task first
    place = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    few = everything.distinct().withColumn("place", place).where(F.col("place") <= k + 1)
    entries = few.groupBy("embedding").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    entries = store(entries.select(F.col("ids")[0].alias("id"), "ids", "embedding"), "entries")
    total = entries.count()
    empty = "query_id long, rank int, vec_id long, score double"
    if not total:
        return spark.createDataFrame([], empty)

    share = min(1.0, (1.1 * plan.sample + 100) / total)
    spot = F.xxhash64("id")
    some = entries.where(F.pmod(spot, F.lit(1 << 30)) < F.lit(int(share * (1 << 30)) + 1)).orderBy(spot).limit(plan.sample)

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        x = np.array(rows.sort_values("id")["embedding"].tolist(), np.float64)
        return pd.DataFrame({"centroid": list(balanced_centroids(x, plan.cluster))})

    fitted = some.select("id", "embedding").groupBy().applyInPandas(fit, "centroid array<double>")
    graph = spark.sparkContext.broadcast(Graph(np.array([c for (c,) in gather(fitted)]), plan.degree))  # at most 2 * sample / cluster

    kind = entries.schema["embedding"].dataType.simpleString()
    stored = entries.mapInArrow(_dealt(graph, plan, lists_of), f"id long, ids array<long>, embedding {kind}, list int")
    stored = store(stored, "postings")
    asked = valid(queries).select(F.col("vec_id").alias("query_id"), "embedding").where(F.size("embedding") == len(graph.value.centroids[0]))
    asked = store(asked.distinct().mapInArrow(_dealt(graph, plan, lists_read), f"query_id long, embedding {kind}, list int"), "asked")

    def compare(have: pd.DataFrame, want: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, float]] = []
        if len(have) and len(want):
            x = np.array(have["embedding"].tolist(), np.float64)
            ids = have["ids"].tolist()
            for query, vector in zip(want["query_id"].tolist(), want["embedding"], strict=True):
                apart = np.sqrt(((x - np.asarray(vector, np.float64)) ** 2).sum(axis=1))
                cut = np.partition(apart, k)[k] if len(apart) > k + 1 else np.inf
                near = [(apart[r], i) for r in np.flatnonzero(apart <= cut).tolist() for i in ids[r] if i != query]
                out += [(query, i, float(d)) for d, i in sorted(near)[:k]]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    def matches(asked: DataFrame) -> DataFrame:
        # a list's vectors, and its queries, go to as many tasks as their numbers call for
        parts = lambda n, most: F.ceil(F.count("*") / F.lit(most)).cast("int").alias(n)
        p = stored.groupBy("list").agg(parts("p", LIST_ROWS))  # one row for each centroid
        q = asked.groupBy("list").agg(parts("q", QUERY_ROWS))
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        own = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
        numbers = p.join(q, "list")
        left = stored.join(F.broadcast(numbers), "list").withColumn("i", own("id", "p")).withColumn("j", every("q"))
        right = asked.join(F.broadcast(numbers), "list").withColumn("j", own("query_id", "q")).withColumn("i", every("p"))
        names = ["list", "i", "j"]
        have = left.select(*names, "ids", "embedding").groupBy(*names)
        want = right.select(*names, "query_id", "embedding").groupBy(*names)
        found = have.cogroup(want).applyInPandas(compare, "query_id long, vec_id long, score double")
        return found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))

    nearest = store(matches(asked), "found")
    # lists of few vectors may leave a query short; such queries are compared with all
    there = everything.select("vec_id").distinct().limit(k + 1).count() - 1
    counts = nearest.groupBy("query_id").count()
    short = asked.select("query_id", "embedding").distinct().join(counts, "query_id", "left")
    short = store(short.where(F.coalesce("count", F.lit(0)) < there).drop("count"), "short")
    if not short.isEmpty():
        lists = len(graph.value.centroids)
        whole = short.withColumn("list", F.explode(F.sequence(F.lit(0), F.lit(lists - 1))))
        more = matches(whole).union(nearest).groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
        nearest = store(more, "found")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return nearest.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
