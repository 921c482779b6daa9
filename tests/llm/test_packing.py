import bisect
import itertools
import random
import tracemalloc
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from hustings.llm.packing import bucket_boundaries, length_batches, pack, packing_patterns


def test_boundaries_are_optimal():
    rng = random.Random(1)
    for _ in range(150):
        histogram = {rng.randint(1, 30): rng.randint(1, 9) for _ in range(rng.randint(1, 8))}
        buckets, lengths = rng.randint(1, 4), sorted(histogram)
        cost = lambda b: sum(c * min(x for x in b if x >= n) for n, c in histogram.items())  # noqa: B023, E731
        best = min(cost([*some, lengths[-1]]) for k in range(buckets) for some in itertools.combinations(lengths[:-1], min(k, len(lengths) - 1)))
        got = bucket_boundaries(histogram, buckets)
        assert len(got) <= buckets and cost(got) == best


def test_boundaries_of_many_lengths_take_little_memory():
    rng = random.Random(4)
    histogram = {n: rng.randint(1, 10**9) for n in range(1, 20_001)}
    tracemalloc.start()
    got = bucket_boundaries(histogram, 16)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(got) == 16 and got[-1] == 20_000 and peak < 100 << 20


def test_patterns_hold_everything_and_are_few():
    rng = random.Random(2)
    for _ in range(100):
        capacity = rng.randint(1, 60)
        histogram = {rng.randint(1, capacity): rng.randint(1, 200) for _ in range(rng.randint(1, 20))}
        patterns = packing_patterns(histogram, capacity)
        held = Counter()
        for times, pattern in patterns:
            assert times > 0 and sum(n * c for n, c in pattern.items()) <= capacity
            for n, c in pattern.items():
                held[n] += times * c
        assert held == histogram
        # As many containers as best fit by decreasing length takes item by item.
        gaps = []
        for n in sorted(histogram, reverse=True):
            for _ in range(histogram[n]):
                k = bisect.bisect_left(gaps, n)
                bisect.insort(gaps, (gaps.pop(k) if k < len(gaps) else capacity) - n)
        assert sum(t for t, _ in patterns) <= len(gaps) * 1.01 + 1


@pytest.mark.parametrize("together", [3, 1_000])
def test_every_item_is_in_one_container(spark, together):
    rng = random.Random(3)
    rows = [(i, rng.choice([0, 1, 5, 5, 5, 5, 7, 12, 30, 64, 65, 64 * 5, 64 * 5 + 9, None])) for i in range(300)] + [(7, 5), (7, 5)]
    df = spark.createDataFrame(rows, "doc_id bigint, n_tokens bigint").withColumn("n", F.lit(1)).withColumn("rank", F.lit(1))
    got = pack(df, capacity=64, ranked_together=together).collect()
    fill, parts = Counter(), defaultdict(list)
    for r in got:
        fill[r["container"]] += r["n_tokens"]
        parts[r["doc_id"]].append((r["part"], r["n_tokens"]))
    assert max(fill.values()) <= 64
    total = sum(n or 0 for _, n in rows)
    assert max(fill) + 1 == len(fill) <= -(-total // 64) + 1
    assert Counter(r["doc_id"] for r in got if r["part"] == 0) == Counter(i for i, _ in rows)
    for i, n in rows:
        if i == 7:  # three rows
            continue
        if n and n > 64:
            assert sorted(parts[i]) == [(k, min(64, n - 64 * k)) for k in range(-(-n // 64))]
        else:
            assert parts[i] == [(0, n or 0)]


def test_batches(spark):
    rows = [(i, n) for i, n in enumerate([0, 1, 1, 2, 9, 9, 10, 10, 10, 33, 40, 200])]
    got = length_batches(spark.createDataFrame(rows, "doc_id bigint, n_tokens bigint"), capacity=40, buckets=3, ranked_together=2).collect()
    room = Counter((r["padded_to"], r["batch"]) for r in got if r["padded_to"])
    assert all(to * n <= 40 for (to, _), n in room.items())
    assert all(r["n_tokens"] <= r["padded_to"] for r in got)
    assert sum(r["n_tokens"] for r in got) == sum(n for _, n in rows)
    assert len({r["padded_to"] for r in got}) <= 4


def test_nothing_and_only_empty(spark):
    df = spark.createDataFrame([(1, 0), (2, None)], "doc_id bigint, n_tokens bigint")
    assert {tuple(r) for r in pack(df).collect()} == {(1, 0, 0, 0), (2, 0, 0, 0)}
    assert pack(df.limit(0)).collect() == [] and length_batches(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        pack(df, capacity=0)
