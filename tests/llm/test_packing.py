import itertools

import numpy as np
from pyspark.sql import functions as F

from apronflow.llm import packing


def containers(patterns):
    return sum(times for _, times in patterns)


def brute(items, capacity):
    """Least containers by trying every assignment."""
    best = [len(items)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(items):
            best[0] = len(rooms)
            return
        for k, room in enumerate(rooms):
            if room >= items[i] and room not in rooms[:k]:
                go(i + 1, [*rooms[:k], room - items[i], *rooms[k + 1 :]])
        go(i + 1, [*rooms, capacity - items[i]])

    go(0, [])
    return best[0]


def test_optimal_on_small_cases():
    rng = np.random.default_rng(3)
    for _ in range(150):
        items = sorted(rng.integers(1, 21, rng.integers(1, 11)).tolist(), reverse=True)
        counts = np.bincount(items, minlength=21)
        got, proven = packing.solve(counts, 20)
        assert sorted(itertools.chain.from_iterable(list(p) * n for p, n in got)) == sorted(items)
        assert all(sum(p) <= 20 for p, _ in got)
        assert proven and containers(got) == brute(items, 20) >= packing.lower_bound(counts, 20)


def test_the_complete_stage_alone_is_optimal():
    rng = np.random.default_rng(8)
    for _ in range(80):
        items = sorted(rng.integers(3, 12, rng.integers(4, 10)).tolist(), reverse=True)
        counts = np.bincount(items, minlength=21)
        worst = [((s,), int(n)) for s, n in enumerate(counts) if n]
        got, proven = packing.exhaust(counts, 20, worst, 0, 10**6)
        assert proven and containers(got) == brute(items, 20)
        assert sorted(itertools.chain.from_iterable(list(p) * n for p, n in got)) == items[::-1]


def test_a_budget_that_ends_leaves_a_whole_solution():
    counts = np.bincount(np.random.default_rng(5).integers(200, 900, 400), minlength=2049)
    got, proven = packing.solve(counts, 2048, packing.Search(nodes=5, exact=50))
    assert sum(len(p) * n for p, n in got) == 400 and (proven or containers(got) > packing.lower_bound(counts, 2048))


def test_maximal_fillings_are_all_of_them():
    counts = np.bincount([2, 2, 3, 5, 5, 7, 11], minlength=21)
    every = set()
    sizes = [s for s in range(1, 13) for _ in range(counts[s])]
    for k in range(len(sizes) + 1):
        for f in itertools.combinations(sizes, k):
            rest = list(sizes)
            for x in f:
                rest.remove(x)
            if sum(f) <= 12 and all(sum(f) + x > 12 for x in rest):
                every.add(tuple(sorted(f, reverse=True)))
    got = list(packing.maximal(counts, 12))
    assert len(got) == len(set(got)) and set(got) == every


def test_many_items_reach_the_bound():
    sizes = np.clip(np.random.default_rng(1).lognormal(6.2, 1.0, 20_000).astype(int), 1, 2048)
    counts = np.bincount(sizes, minlength=2049)
    assert containers(packing.complete(counts, 2048)) <= packing.lower_bound(counts, 2048) * 1.001 + 1


def test_empty_histogram():
    assert packing.complete(np.zeros(11, int), 10) == []


def test_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(int(i), int(n)) for i, n in enumerate(rng.integers(0, 900, 3000))] + [(5000 + i, 7) for i in range(2000)] + [(9000, 2048), (9001, 4096), (9002, 5000), (9003, None), (None, 30), (9004, 4096)]
    df = spark.createDataFrame(rows, "doc_id long, n int").withColumn("container", F.lit("clash"))
    got = packing.packed(df).toPandas()
    assert (got.groupby("container").tokens.sum() <= 2048).all()
    want = {k: n for k, n in rows if n}
    told = got.groupby(got.doc_id.fillna(-1)).tokens.sum().to_dict()
    assert told == {-1 if k is None else k: n for k, n in want.items()}
    split = got.groupby("doc_id").size()
    assert set(split[split > 1].index) == {9001, 9002, 9004}
    for _, own in got[got.doc_id.isin([9001, 9002, 9004])].sort_values("piece").groupby("doc_id"):
        assert own["first"].tolist() == np.r_[0, np.cumsum(own.tokens)[:-1]].tolist()
    assert got.container.nunique() <= -(-sum(want.values()) // 2048) + 1
    assert packing.packed(df.limit(0)).count() == 0
