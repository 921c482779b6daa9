"""Filling containers of fixed capacity with items of varying length.

Two ways, both from the global histogram of lengths, which has at most as many
entries as the capacity and is all that reaches the driver:

``length_batches``
    Optimal length buckets: dynamic programming over the histogram chooses the
    bucket boundaries that minimise padding; batches of a token budget form
    inside each bucket.
``pack``
    Containers filled across lengths: best fit by decreasing length, worked out
    on the histogram as patterns (so many containers holding these lengths)
    instead of on items.  Buckets alone can't fill a container well - what is
    longer than half of it is never joined by something short - so this is what
    gives as few containers as can be.

An item's place follows from its rank among the items of its length.  Ranks are
counted in salted parts of bounded size, so a length that a third of all items
share is still spread.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hustings.session import materialise

CAPACITY = 2_048
BUCKETS = 16
#: Items of one length are ranked in parts of about this many.
RANKED_TOGETHER = 200_000
#: Largest capacity whose histogram the driver takes.
MOST_LENGTHS = 1 << 16


def bucket_boundaries(histogram: dict[int, int], buckets: int) -> list[int]:
    """Upper boundaries of at most ``buckets`` buckets that minimise the padding of all items to their boundary."""
    lengths = sorted(n for n in histogram if n > 0)
    m = len(lengths)
    total = [0]
    for n in lengths:
        total.append(total[-1] + histogram[n])
    # Padding differs from the slots taken by a constant: lengths i..j-1, each padded to lengths[j-1], take (total[j] - total[i]) * lengths[j-1].
    # best[j] = min over i of (best[i] - total[i] * x) + total[j] * x at x = lengths[j-1]: the lower hull of lines whose slopes fall and whose
    # queries rise, so each is added and left once.  Memory and time grow with the number of lengths, times the buckets; integers are exact.
    best: list[int | None] = [0] + [None] * m
    came: list[list[int]] = []
    for _ in range(min(buckets, m)):
        reached: list[int | None] = [None] * (m + 1)
        back, hull, at = [0] * (m + 1), [], 0
        for j in range(1, m + 1):
            i = j - 1
            if best[i] is not None:
                while len(hull) - at >= 2:
                    p, q = hull[-2], hull[-1]
                    # q is nowhere lowest if the new line crosses p no later than q does.
                    if (best[i] - best[p]) * (total[q] - total[p]) <= (best[q] - best[p]) * (total[i] - total[p]):
                        hull.pop()
                    else:
                        break
                hull.append(i)
            if len(hull) == at:
                continue
            x = lengths[j - 1]
            while at + 1 < len(hull) and best[hull[at + 1]] - total[hull[at + 1]] * x <= best[hull[at]] - total[hull[at]] * x:
                at += 1
            back[j], reached[j] = hull[at], best[hull[at]] + (total[j] - total[hull[at]]) * x
        came.append(back)
        best = reached
    boundaries, j = [], m
    for back in reversed(came):
        if j == 0:
            break
        boundaries.append(lengths[j - 1])
        j = back[j]
    return sorted(boundaries)


def packing_patterns(histogram: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(number of containers, {length: items in each}) that hold the histogram: best fit by decreasing length.

    The work depends on the number of different lengths, not on the number of items.
    """
    open_at: dict[int, list[tuple[int, dict[int, int]]]] = {}
    gaps = np.zeros(capacity + 1, bool)
    done: list[tuple[int, dict[int, int]]] = []

    def put(times: int, held: dict[int, int], gap: int) -> None:
        if gap == 0:
            done.append((times, held))
        else:
            open_at.setdefault(gap, []).append((times, held))
            gaps[gap] = True

    for length in sorted((n for n in histogram if n > 0), reverse=True):
        left = histogram[length]
        while left:
            fitting = np.flatnonzero(gaps[length:])
            if not len(fitting):
                each = capacity // length
                if left >= each:
                    put(left // each, {length: each}, capacity - each * length)
                if left % each:
                    put(1, {length: left % each}, capacity - (left % each) * length)
                break
            gap = length + int(fitting[0])
            times, held = open_at[gap].pop()
            if not open_at[gap]:
                gaps[gap] = False
            # As many of this length as fit, in as many containers as they last for.
            each = min(gap // length, left)
            used = min(times, left // each)
            if times > used:
                put(times - used, held, gap)
            put(used, held | {length: held.get(length, 0) + each}, gap - each * length)
            left -= used * each
    return done + [x for some in open_at.values() for x in some]


def _pieces(df: DataFrame, capacity: int) -> DataFrame:
    """(doc_id, part, n): items as they are, longer ones in parts of the capacity and a rest."""
    parts = F.when(F.col("n_tokens") > capacity, F.sequence(F.lit(0), F.ceil(F.col("n_tokens") / capacity).cast("int") - 1)).otherwise(F.array(F.lit(0)))
    cut = df.select("doc_id", F.col("n_tokens"), F.explode(parts).alias("part"))
    return cut.select("doc_id", "part", F.least(F.lit(capacity), F.col("n_tokens") - F.col("part").cast("bigint") * capacity).cast("int").alias("n"))


def _histogram(items: DataFrame) -> dict[int, int]:
    return {int(r["n"]): int(r["count"]) for r in items.groupBy("n").count().collect()}


def _ranked(items: DataFrame, histogram: dict[int, int], ranked_together: int) -> DataFrame:
    """Items with their rank from 0 among those of their length, in an order that depends on the items alone."""
    spark = items.sparkSession
    parts = spark.createDataFrame([(n, max(1, -(-c // ranked_together))) for n, c in histogram.items()], "n int, parts int")
    salted = items.join(F.broadcast(parts), "n").withColumn("salt", F.pmod(F.xxhash64("doc_id", "part"), F.col("parts").cast("bigint")).cast("int"))
    sizes = salted.groupBy("n", "salt").count()
    before = Window.partitionBy("n").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("n", "salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    own = F.row_number().over(Window.partitionBy("n", "salt").orderBy("doc_id", "part")) - 1
    return salted.withColumn("own", own).join(offsets, ["n", "salt"]).select("doc_id", "part", "n", (F.col("offset") + F.col("own")).alias("rank"))


def _checked(capacity: int) -> None:
    if not 1 <= capacity <= MOST_LENGTHS:
        raise ValueError(f"capacity must be 1 to {MOST_LENGTHS}")


def pack(lengths: DataFrame, capacity: int = CAPACITY, ranked_together: int = RANKED_TOGETHER) -> DataFrame:
    """(doc_id, part, n_tokens, container): every item, or part of an item longer than a container, in its container.

    ``lengths``: (doc_id, n_tokens).  Null lengths count as 0.  Items of length 0 take no room and are spread over the containers,
    into container 0 if there is no other item.  Rows repeated in ``lengths`` are items of their own.
    """
    _checked(capacity)
    lengths = lengths.select("doc_id", F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"))
    items = materialise(_pieces(lengths, capacity))
    histogram = _histogram(items)
    patterns = packing_patterns({n: c for n, c in histogram.items() if n > 0}, capacity)
    containers = sum(times for times, _ in patterns)
    # Of each length the ranges of ranks that the patterns take: where a range starts, its first container and the items in each.
    ranges: dict[int, list[tuple[int, int, int]]] = {}
    seen: dict[int, int] = {}
    first = 0
    for times, held in patterns:
        for n, each in held.items():
            ranges.setdefault(n, []).append((seen.get(n, 0), first, each))
            seen[n] = seen.get(n, 0) + times * each
        first += times
    table = {n: tuple(np.array(x, np.int64) for x in zip(*r)) for n, r in ranges.items()}

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            container = np.zeros(len(pdf), np.int64)
            n, rank = pdf["n"].to_numpy(), pdf["rank"].to_numpy()
            order = np.argsort(n, kind="stable")
            each_length, begins = np.unique(n[order], return_index=True)
            for length, at in zip(each_length, np.split(order, begins[1:])):
                if length == 0:
                    container[at] = rank[at] % max(1, containers)
                    continue
                starts, firsts, each = table[int(length)]
                k = np.searchsorted(starts, rank[at], side="right") - 1
                container[at] = firsts[k] + (rank[at] - starts[k]) // each[k]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "part": pdf["part"], "n_tokens": n, "container": container})

    kind = items.schema["doc_id"].dataType.simpleString()
    return _ranked(items, histogram, ranked_together).mapInPandas(place, f"doc_id {kind}, part int, n_tokens int, container bigint")


def length_batches(lengths: DataFrame, capacity: int = CAPACITY, buckets: int = BUCKETS, ranked_together: int = RANKED_TOGETHER) -> DataFrame:
    """(doc_id, part, n_tokens, padded_to, batch): batches of at most ``capacity`` padded tokens within optimal length buckets.

    ``batch`` counts from 0 within the bucket named by ``padded_to``.  Items of length 0 form the bucket 0.
    """
    _checked(capacity)
    lengths = lengths.select("doc_id", F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"))
    items = materialise(_pieces(lengths, capacity))
    histogram = _histogram(items)
    boundaries = [0, *bucket_boundaries(histogram, buckets)]
    # The items of a bucket are ranked together: shorter lengths first.
    spark, rows = items.sparkSession, []
    for low, high in zip(boundaries, boundaries[1:]):
        before = 0
        for n in sorted(n for n in histogram if low < n <= high):
            rows.append((n, high, before))
            before += histogram[n]
    rows.append((0, 0, 0))
    table = F.broadcast(spark.createDataFrame(rows, "n int, padded_to int, before bigint"))
    each = F.greatest(F.lit(1), F.floor(F.lit(capacity) / F.greatest(F.col("padded_to"), F.lit(1))))
    ranked = _ranked(items, histogram, ranked_together).join(table, "n")
    return ranked.select("doc_id", "part", F.col("n").alias("n_tokens"), "padded_to", F.floor((F.col("before") + F.col("rank")) / each).alias("batch"))
