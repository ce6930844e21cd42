import numpy as np
import pytest

from corpusloom.llm import classes
from corpusloom.llm import knn as K
from corpusloom.llm import windows as W

RULE = K.KnnRule(k=3, min_similarity=0.85, dim=16, tables=12)


def data(seed=0, families=40, dim=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(families, dim))
    rows = []
    for f, c in enumerate(centres):
        for v in range(rng.integers(1, 9)):
            rows.append((f"{f:03}-{v}", (c + rng.normal(size=dim) * rng.choice([0.05, 0.2, 0.3])) * rng.choice([0.1, 1, 7])))
    return [(i, [float(np.float32(x)) for x in v]) for i, v in rows]


def brute(rows, rule):
    ids = [i for i, _ in rows]
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    s = x @ x.T
    out = set()
    for a in range(len(ids)):
        order = sorted((b for b in range(len(ids)) if b != a), key=lambda b: (-round(s[a, b], 9), ids[b]))
        out |= {(ids[a], ids[b]) for b in order[: rule.k] if s[a, b] >= rule.min_similarity}
    return out


def found(df, rule=RULE):
    return [(r.id, r.neighbour) for r in K.most_similar(df, "id", "embedding", rule).collect()]


def test_recall_against_brute_force(spark):
    rows = data(1, 120)
    want = brute(rows, RULE)
    got = found(spark.createDataFrame(rows, "id string, embedding array<float>"))
    assert len(got) == len(set(got))
    assert len(want & set(got)) >= 0.97 * len(want) and len(set(got) - want) <= 0.03 * len(want)


def test_hot_cells_are_split(spark, monkeypatch):
    rows = data(2, 60)
    df = spark.createDataFrame(rows, "id string, embedding array<float>")
    before = set(found(df))
    monkeypatch.setattr(K, "HOT", 8)
    after = set(found(df))
    assert len(before ^ after) <= 0.02 * len(before)


def test_windows_count_collisions():
    rng = np.random.default_rng(5)
    grid = W.on_grid(rng.normal(size=(24, 300)))
    queries = W.on_grid(rng.normal(size=(24, 700)) * 2)
    arrays = W.SortedArrays(grid)
    inside = (np.abs(queries[:, :, None] - grid[:, None, :]) <= 50).sum(axis=0)
    for least in (1, 9, 24, 25, 40):
        q, p = arrays.collided(queries, 50, least)
        want = np.zeros_like(inside, bool)
        want[q, p] = True
        assert len(q) == want.sum() and (want == (inside >= least)).all()


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    one, two = [1.0] + [0.0] * 15, [1.0, 0.2] + [0.0] * 14
    rows = [(f"same{i}", one, 0) for i in range(9)] + [("near", two, 0), ("double", [2 * x for x in one], 0), ("tiny", [1e-38 * x for x in two], 0), ("huge", [1e38 * x for x in two], 0)]
    rows += [("null", None, 0), ("empty", [], 0), ("zero", [0.0] * 16, 0), ("short", [1.0], 0), ("nan", [nan] * 16, 0), ("inf", [inf] + [0.0] * 15, 0), ("hole", [None] + [1.0] * 15, 0), (None, one, 0), ("same0", one, 0)]
    df = spark.createDataFrame(rows, "id string, embedding array<float>, c1 int")
    got = found(df)
    assert len(got) == len(set(got))
    assert {i for pair in got for i in pair} <= {*(f"same{i}" for i in range(9)), "near", "double", "tiny", "huge"}
    assert {b for a, b in got if a == "same8"} == {"double", "same0", "same1"}  # equal similarities: the smaller id first
    assert {a for a, b in got} >= {"near", "tiny", "huge"}
    assert found(df.where("false")) == []
    assert found(df.where("id = 'near'")) == []


@pytest.mark.parametrize(("n", "coordinates"), [(10, 1), (100_000, 1), (4_000_000, 1), (10_000_000, 2), (10**9, 3)])
def test_routing_grows_without_leaps(n, coordinates):
    rule = K.KnnRule()
    routing = rule.routing(n)
    assert len(routing.dims) == coordinates and n / routing.cells <= K.ROUTED_ROWS
    assert routing.tables <= rule.routing(2 * n).tables <= 1.25 * routing.tables + 1


@pytest.mark.parametrize(("routed", "cell"), [(2, 1024), (1 << 15, 8), (1, 4)])
def test_small_cells_still_find_neighbours(spark, monkeypatch, routed, cell):
    monkeypatch.setattr(K, "ROUTED_ROWS", routed)
    monkeypatch.setattr(K, "CELL_ROWS", cell)
    rows = data(4, 80)
    want = brute(rows, RULE)
    assert len(want & set(found(spark.createDataFrame(rows, "id string, embedding array<float>")))) >= 0.95 * len(want)


def test_a_class_of_many_equal_vectors_is_cut(spark, monkeypatch):
    rows = [(f"{i:03}", [1.0] + [0.0] * 15) for i in range(60)] + [(f"x{i}", [1.0, 0.1 * i] + [0.0] * 14) for i in range(4)]
    df = spark.createDataFrame(rows, "id string, embedding array<float>")
    before = set(found(df))
    monkeypatch.setattr(classes, "COPIES", 7)
    assert set(found(df)) == before == brute(rows, RULE)


def tight(seed, spread, size=150, dim=16):
    """Clusters of near-copies: the gaps between their similarities are below the rounding to one byte."""
    rng = np.random.default_rng(seed)
    rows = []
    for f, c in enumerate(rng.normal(size=(4, dim))):
        rows += [(f"{f}-{v:03}", [float(np.float32(x)) for x in c + rng.normal(size=dim) * spread]) for v in rng.permutation(size)]
    return rows


@pytest.mark.parametrize("spread", [0.003, 1e-7])
def test_dense_clusters_against_brute_force(spark, spread):
    rows = tight(6, spread)
    want = brute(rows, RULE)
    got = found(spark.createDataFrame(rows, "id string, embedding array<float>"))
    assert len(got) == len(set(got)) == len(want)
    assert len(want & set(got)) >= 0.999 * len(want)


def test_dense_cells_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(K, "HOT", 64)
    rows = tight(7, 0.01)
    want = brute(rows, RULE)
    assert len(want & set(found(spark.createDataFrame(rows, "id string, embedding array<float>")))) >= 0.999 * len(want)


def test_bounds_hold_for_rounded_vectors():
    """One large value makes the others round to few steps."""
    rng = np.random.default_rng(8)
    a, b = rng.normal(size=(2, 2000, 16))
    a[:500, 0], b[:500, 0] = 60, 50
    a[500:1000] = np.r_[1.0, [0.0039] * 15]  # rounds to one value
    b[500:1000, 0] = 3
    b[1000:] = a[1000:] + b[1000:] * rng.choice([1e-6, 1e-3, 0.1], (1000, 1))
    q8 = [np.rint(x / np.abs(x).max(axis=1, keepdims=True) * 127).astype(np.int8) for x in (a, b)]
    low, high = K._bounds(np.einsum("ij,ij->i", *map(K._unit, q8)), K._slack(q8[0]) + K._slack(q8[1]))
    exact = np.einsum("ij,ij->i", K._scaled(a), K._scaled(b))
    assert (low <= exact).all() and (exact <= high).all()


@pytest.mark.parametrize("n", [1000, 10**5, 10**6, 3 * 10**7, 10**9])
def test_miss_rate_is_the_same_at_every_size(n):
    rule = K.KnnRule()
    assert 0.36 < rule.agreement() < 0.39
    routing = rule.routing(n)
    inner, times = rule.inner_cuts(n / routing.cells)
    met = np.prod([rule.agreement(d) for d in routing.dims]) * (1 - (1 - rule.agreement(inner)) ** times if inner else 1)
    assert (1 - met) ** routing.tables <= (1 - rule.agreement()) ** rule.tables * 1.0001


def test_pairs_at_the_limit_collide_in_some_table():
    """With the same directions in all tables about one in a hundred never would."""
    rule = K.KnnRule()
    rng = np.random.default_rng(9)
    x, z = rng.normal(size=(2, 4000, rule.dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= np.einsum("ij,ij->i", x, z)[:, None] * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    gap = rule.min_similarity * x + np.sqrt(1 - rule.min_similarity**2) * z - x
    met = [(np.abs(gap @ K._directions(rule.dim, rule.projections, t)) <= rule.schedule[-1]).sum(axis=1) >= rule.collisions for t in range(rule.tables)]
    assert np.any(met, axis=0).all() and not np.all(met, axis=0).all()
