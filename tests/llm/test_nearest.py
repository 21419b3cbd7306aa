import random

import numpy as np

from apronflow.llm import nearest


def test_index_is_exact_on_any_keys():
    rng = np.random.default_rng(4)
    for trial in range(80):
        n = int(rng.integers(0, 3000))
        keys = np.unique(np.concatenate([rng.integers(0, 10**6, n), rng.integers(0, 200, n // 3), 10**9 + rng.integers(0, 50, 5)]))
        wanted = np.concatenate([rng.integers(-100, 10**6 + 100, 200), keys[:50], [10**9 + 60]])
        index = nearest.LinearIndex(keys, error=int(rng.choice([0, 1, 4, 16])))
        assert (index.position(wanted) == np.searchsorted(keys, wanted)).all(), trial


def test_shards_of_one_array():
    rng = np.random.default_rng(5)
    parts = [np.unique(rng.integers(0, 10**k, 300)) + (i << 40) for i, k in enumerate((3, 5, 7, 9))]
    keys, begins = np.concatenate(parts), np.cumsum([0, *map(len, parts)])[:-1]
    index = nearest.LinearIndex(keys, error=2, begins=begins)
    wanted = np.concatenate([keys + d for d in (-3, -1, 0, 1, 7)])
    assert (index.position(wanted) == np.searchsorted(keys, wanted)).all() and set(begins) <= set(index.first)


def test_rows_equal_brute_force(spark):
    r = random.Random(1)
    left = [(i, r.choice("ab"), r.randrange(0, 80_000)) for i in range(400)] + [(900, None, 5), (901, "a", None), (902, "z", 5), (0, "a", 100), (0, "a", 100)]
    right = [(r.choice("ab"), r.randrange(0, 80_000)) for _ in range(300)] + [(None, 5), ("a", None), ("a", 50), ("a", 150), ("a", 150)]
    lf, rf = spark.createDataFrame(left, "id long, entity string, wanted_s long"), spark.createDataFrame([(*x, 1) for x in right], "entity string, time_s long, id long")
    got = sorted(tuple(x) for x in nearest.nearest_times(lf, rf, 120, shard_s=3600).select("id", "wanted_s", "match_s").collect())
    want = []
    for i, e, t in left:
        near = [(abs(s - t), s) for k, s in right if k == e and k is not None and s is not None and t is not None and abs(s - t) <= 120]
        if near:
            want.append((i, t, min(near)[1]))
    assert got == sorted(want)
    assert nearest.nearest_times(lf.limit(0), rf, 120).count() == 0
    assert nearest.nearest_times(lf, rf.limit(0), 120).count() == 0


def test_the_line_leaves_few_positions_to_the_search():
    rng = np.random.default_rng(6)
    keys = np.unique(np.cumsum(rng.choice([1800, 3600, 3600, 7200, 300], 700)) + rng.integers(0, 240, 700))
    index = nearest.LinearIndex(keys)
    wanted = rng.integers(keys[0], keys[-1], 2000)
    assert (index.position(wanted) == np.searchsorted(keys, wanted)).all()
    assert len(keys) > 500 and len(index.first) < len(keys) / 10 and index.width < 8
