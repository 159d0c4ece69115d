"""How five quality filters interact, for every order in which they can run.

Method: a text's failures are a mask of five bits. All that an order of the filters does to a document follows from its mask,
so documents are first counted by mask. The 120 orders are numbered by Lehmer rank, which is their lexicographic place. An order
removes a mask at step k if its first k - 1 filters are not in the mask and its k-th is; all orders that share these first k
filters are (5 - k)! neighbours in rank. So the orders in which a mask goes at step k are a few whole intervals of
ranks, and a count is added at the begin of each and taken off at its end. A running sum over the ranks gives the
totals of every order at once.

Filters (a null text is empty; words are maximal runs of other than space and tab to carriage return; letters keep their case):
A, under 200 words; B, distinct words below half of the words; C, capitals A-Z above two in a hundred code points; D, holds one
of #$%&*|; E, identical to the text of a document of smaller identifier anywhere in the table, whether that one stays or not. An empty
text fails A alone (and E if another is empty).

A document without identifier is compared by no one: it neither fails E nor makes others fail, and it has no label. Repeated
rows count each, and none is smaller than its like. A source of null and one of the empty string are one part. A document is good
(toxic) if any of its labels says so. Very long texts are read whole. An empty table has no parts, so no rows. Extra columns are
not read.

Only short rows are shuffled, a text's digest (SHA-256) in place of the text. Copies of a text are counted by source and label within
each task first, and then come to one row for each of these.
"""

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FILTERS = "ABCDE"

#: White space of the word contract, as a Java class.
_SPACE = r"[\x20\x09-\x0D]+"

#: What is counted for each mask.
COUNTS = ("n", "good", "toxic")


def failed_alone(text: Column) -> Column:
    """The mask of filters A to D (bit 0 to 3), which need the text alone."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, _SPACE), lambda w: w != "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.char_length(text) - F.char_length(F.regexp_replace(text, "[A-Z]+", ""))
    tests = [
        n < 200,
        100 * distinct.cast("long") < 50 * n.cast("long"),
        100 * capitals.cast("long") > 2 * F.char_length(text).cast("long"),
        text.rlike(r"[#$%&*|]"),
    ]
    return sum((F.when(test, 1 << i).otherwise(0) for i, test in enumerate(tests)), F.lit(0))


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(part, mask, n, good, toxic)``: documents by source and failed filters."""
    text = F.coalesce("text", F.lit(""))
    short = docs.select(
        "doc_id",
        F.unhex(F.sha2(text, 256)).alias("digest"),
        F.coalesce("source", F.lit("")).alias("part"),
        failed_alone(F.col("text")).alias("alone"),
    )
    # rows without identifier meet no label: a number of their own keeps them from one task
    short = short.withColumn("spread", F.when(F.col("doc_id").isNull(), F.xxhash64("digest", "part")).otherwise(F.lit(0)))
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    known = known.withColumn("spread", F.lit(0).cast("long"))
    marked = short.join(known, ["doc_id", "spread"], "left").fillna(False, ["good", "toxic"])

    kind = ["digest", "part", "alone", "good", "toxic"]
    each = marked.groupBy("doc_id", "spread", *kind).agg(F.count(F.lit(1)).alias("n"))
    least = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n")))
    alike = each.groupBy(*kind).agg(
        F.sum("n").alias("n"),
        least.alias("least"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("unnamed"),
    )
    first = F.min("least.doc_id").over(Window.partitionBy("digest"))
    own = F.when(F.col("least.doc_id") == F.col("first"), F.col("least.n")).otherwise(0)
    passed = alike.withColumn("first", first).withColumn("passed", own + F.col("unnamed"))
    sides = F.array(
        F.struct(F.col("alone").alias("mask"), F.col("passed").alias("rows")),
        F.struct((F.col("alone") + 16).alias("mask"), (F.col("n") - F.col("passed")).alias("rows")),
    )
    split = passed.select("part", "good", "toxic", F.inline(sides)).where("rows > 0")
    return split.groupBy("part", "mask").agg(
        F.sum("rows").alias("n"),
        F.sum(F.when(F.col("good"), F.col("rows")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("rows")).otherwise(0)).alias("toxic"),
    )


def lehmer_rank(order: tuple[int, ...], size: int) -> int:
    """The lexicographic place, among all orders of ``size`` things, of the first order that begins so."""
    left, rank = list(range(size)), 0
    for step, item in enumerate(order):
        rank += left.index(item) * factorial(size - 1 - step)
        left.remove(item)
    return rank


def intervals(size: int = len(FILTERS)) -> list[tuple[int, int, int, int]]:
    """``(mask, step, begin, end)``: the ranks from begin to before end remove the mask at this step (from 1)."""
    found = []
    for mask in range(1, 1 << size):
        inside = [i for i in range(size) if mask >> i & 1]
        outside = [i for i in range(size) if not mask >> i & 1]
        for step in range(1, len(outside) + 2):
            for before in permutations(outside, step - 1):
                for item in inside:
                    begin = lehmer_rank((*before, item), size)
                    found.append((mask, step, begin, begin + factorial(size - step)))
    return found


def audit(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """From documents by part and mask, one row per part, order and step; ``counts`` is read twice, so pass a stored frame.

    Columns: part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley. All that is
    sent to the tasks is the table of intervals and that of orders, whose size is fixed by the number of filters.
    """
    spark, size = counts.sparkSession, len(filters)
    ends = spark.createDataFrame(intervals(size), "mask int, step int, begin int, stop int")
    orders = spark.createDataFrame(
        [
            (rank, "".join(filters[i] for i in order), step + 1, order[step])
            for rank, order in enumerate(permutations(range(size)))
            for step in range(size)
        ],
        "rank int, filter_order string, step int, item int",
    )
    # one grid row for each part, rank and step, so that the running sums pass every rank
    totals = counts.groupBy("part").agg(
        F.sum("n").alias("total"),
        *[F.sum(F.when(F.col("mask").bitwiseAND(1 << i) != 0, F.col("n")).otherwise(0)).alias(f"fails{i}") for i in range(size)],
        *[F.sum(F.when(F.col("mask") == 1 << i, F.col("n")).otherwise(0)).alias(f"only{i}") for i in range(size)],
    )
    changes = counts.join(F.broadcast(ends), "mask")
    sides = F.array(
        F.struct(F.col("begin").alias("rank"), *[F.col(c).alias(c) for c in COUNTS]),
        F.struct(F.col("stop").alias("rank"), *[(-F.col(c)).alias(c) for c in COUNTS]),
    )
    steps = changes.select("part", "step", F.inline(sides)).groupBy("part", "step", "rank").agg(*[F.sum(c).alias(c) for c in COUNTS])
    places = totals.withColumn("rank", F.explode(F.sequence(F.lit(0), F.lit(factorial(size) - 1))))
    grid = places.join(F.broadcast(orders), "rank")
    along = Window.partitionBy("part", "step").orderBy("rank")
    summed = grid.join(steps, ["part", "step", "rank"], "left").withColumns(
        {c: F.sum(F.coalesce(c, F.lit(0))).over(along) for c in COUNTS}
    )

    def of_item(prefix: str) -> Column:
        return F.element_at(F.array(*[F.col(f"{prefix}{i}") for i in range(size)]), F.col("item") + 1)

    down = Window.partitionBy("part", "rank").orderBy("step")
    shares = Window.partitionBy("part", "item")
    out = summed.withColumns(
        {
            "kept": F.col("total") - F.sum("n").over(down),
            "redundant": of_item("fails") - F.col("n"),
            "unique_fails": of_item("only"),
            "shapley": F.sum("n").over(shares),
        }
    )
    return out.select(
        "part", "filter_order", "step", "kept", F.col("n").alias("removed"), "redundant", "unique_fails",
        F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"), "shapley",
    )
