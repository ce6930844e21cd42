import itertools

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.llm import packing as P


def fewest(sizes, capacity):
    """Exact, for a handful of items."""
    items = sorted((s for s in sizes if s), reverse=True)
    best = [len(items)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(items):
            best[0] = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= items[i]:
                go(i + 1, [*rooms[:k], rooms[k] - items[i], *rooms[k + 1 :]])
        go(i + 1, [*rooms, capacity - items[i]])

    go(0, [])
    return best[0]


@settings(max_examples=200, deadline=None)
@given(st.integers(4, 30).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), min_size=1, max_size=9))))
def test_bound_never_exceeds_the_optimum(case):
    capacity, sizes = case
    bound = P.lower_bound(np.bincount(sizes, minlength=capacity + 1), capacity)
    place, free = P.best_fit_decreasing(np.array(sizes), capacity)
    best = fewest(sizes, capacity)
    assert -(-sum(sizes) // capacity) <= bound <= best <= len(free)
    assert all(sum(s for s, p in zip(sizes, place) if p == box) == capacity - free[box] for box in range(len(free)))


def test_bound_beats_the_volume():
    assert P.lower_bound(np.bincount([6] * 10, minlength=11), 10) == 10
    assert P.lower_bound(np.bincount([4] * 9, minlength=12), 11) == 5


def test_best_fit_takes_the_tightest_box():
    place, free = P.best_fit_decreasing(np.array([7, 6, 3, 4]), 10)
    assert place.tolist() == [0, 1, 0, 1] and free.tolist() == [0, 0]


def check(placed, sizes, capacity):
    rows = placed.collect()
    fill, parts = {}, {}
    for r in rows:
        fill[r.container_id] = fill.get(r.container_id, 0) + r.size
        parts.setdefault(r.key, []).append((r.part, r.start_token, r.size))
    assert max(fill.values(), default=0) <= capacity
    for key, size in sizes.items():
        pieces = sorted(parts[key])
        assert sum(s for _, _, s in pieces) == size
        assert len(pieces) == max(1, -(-size // capacity))
        assert list(itertools.accumulate((s for _, _, s in pieces), initial=0))[:-1] == [a for _, a, _ in pieces]
    return fill


def test_operator(spark, monkeypatch):
    monkeypatch.setattr(P, "PART_ITEMS", 60)  # many partitions, so that pools form
    rng = np.random.default_rng(3)
    sizes = {i: int(x) for i, x in enumerate(np.r_[rng.integers(1, 100, 500), rng.integers(30, 60, 300), [0, 100, 101, 1000]])}
    df = spark.createDataFrame([(k, v, "x") for k, v in sizes.items()], "key long, tokens long, part string")
    result = P.fill_containers(df, 100)
    fill = check(result.placed, sizes, 100)
    assert len(fill) == result.containers
    first = P._pack(P._grouped(P.pieces(df, 100), len(sizes) + 9, 0), 100, "0").select("grp", "box").distinct().count()
    assert result.bound <= result.containers < first  # the exchange saves containers
    assert result.tokens == sum(sizes.values())
    assert sorted(r.key for r in result.split_keys().collect()) == [802, 803]
    together = P.Packing(result.placed.withColumn("container_id", F.lit("x")), 1, 1, 1)
    assert together.split_keys().count() == 0  # what is split follows from where the parts lie


def test_one_partition_is_near_its_bound(spark):
    rng = np.random.default_rng(4)
    sizes = {i: int(x) for i, x in enumerate(rng.integers(0, 100, 2000))}
    result = P.fill_containers(spark.createDataFrame(list(sizes.items()), "key long, tokens long"), 100)
    check(result.placed, sizes, 100)
    assert result.bound <= result.containers <= 1.01 * result.bound


def test_edges(spark):
    empty = spark.createDataFrame([], "key long, tokens long")
    assert P.fill_containers(empty, 10).containers == 0
    zero = P.fill_containers(spark.createDataFrame([(1, 0), (2, 0), (2, 0)], "key long, tokens long"), 10)
    assert (zero.containers, zero.placed.count()) == (1, 3)
    with pytest.raises(ValueError):
        P.fill_containers(empty, 0)
