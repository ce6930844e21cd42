"""The most similar vectors for every vector, by collision-counting hashing.

1. Vectors are scaled to unit length; equal vectors form one class that goes on as one row.
2. *Routing*: in each of a number of random rotations (tables) a class goes to the cell of its most extreme coordinate, so that only vectors near one another
   in direction meet in a task. Where the collection has more than about ``ROUTED_ROWS`` classes for each such cell, a second coordinate, the most extreme of the first
   few of another rotation, cuts the cells further; how many coordinates count grows with the collection.
3. A cell of more than ``CELL_ROWS`` classes is cut inside its task, several times in different ways (*inner cells*): this costs no shuffle.
4. *Collision counting* inside an inner cell: the vectors are projected on ``projections`` single directions, each a sorted array.
   Around every query a window opens in each array and widens with the search radius (virtual rehashing, see ``windows``); a vector that
   falls into the windows of at least ``collisions`` directions is verified by its similarity. A query stops once k verified
   vectors lie within the radius that its windows stand for.
5. The survivors are verified again on the full-precision vectors and cut to the k best.

The number of tables makes up for what further coordinates and inner cells miss, so that a pair at the limit is missed as rarely at every size.
The routed rows carry one byte a dimension. A cell of more than ``HOT`` classes is cut into blocks whose pairs are separate
tasks: nothing is dropped and no task holds an unbounded cell. Rounding moves a vector by an angle that its bytes bound, so a
query keeps every partner that may still be among its k + 2 best in the inner cell. Where these are more than ``WIDE`` (near-copies),
its task is ranked once more on the full-precision vectors of these classes, and k + 2 partners of each query are left.

Defined results: NULL, empty and all-zero vectors, vectors of another length and vectors with a NULL or non-finite value take no part, nor do rows
with a NULL id; among similarities equal to ``DIGITS`` decimals the smaller id comes first; a repeated id counts once; extra columns are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.batches import whole_groups
from corpusloom.llm.classes import every_part, large_classes, own_part, with_parts
from corpusloom.llm.shingles import mix64
from corpusloom.llm.windows import POINTS, QUERIES, STEP, SortedArrays, on_grid
from corpusloom.session import materialize, release, tasks_for

HOT = 1 << 16  # classes of a cell in one task
ROUTED_ROWS = 1 << 15  # aim for routed cells of at most about this many classes
CELL_ROWS = 1024  # aim for inner cells of about this many classes
INNER_MISS = 0.2  # of pairs at the limit, by the inner cells of one table
BROADCAST_CELLS = 500_000
TASK_ROWS = 25_000  # routed rows a task
NOISE = 1e-5  # of similarity, above what float32 sums can be off
WIDE = 32  # partners that the bytes may leave open before a query is ranked on full-precision vectors
EXACT_ROWS = 8192  # rows of dense cells a task
DIGITS = 9  # decimals of similarity that count for the rank
SEED = 20240517


@dataclass(frozen=True)
class KnnRule:
    k: int = 5
    min_similarity: float = 0.85
    dim: int = 64
    tables: int = 12
    projections: int = 40
    collisions: int = 21
    half_width: float = 1.0  # of a window, in units of the radius
    radii: tuple[float, ...] = (0.3,)  # below the largest, which min_similarity sets

    @property
    def schedule(self) -> tuple[float, ...]:
        last = math.sqrt(2 - 2 * self.min_similarity)
        return (*[r for r in self.radii if r < last], last)

    def agreement(self, dims: int | None = None) -> float:
        """The share of rotations that send two vectors at the limit to the same extreme one of ``dims`` coordinates."""
        return _agreement(dims or self.dim, self.min_similarity)

    def inner_cuts(self, rows: float) -> tuple[int, int]:
        """Into how many coordinates' cells a cell of ``rows`` classes is cut, and how often; (0, 1) where it stays whole."""
        if rows <= 2 * CELL_ROWS:
            return 0, 1
        dims = min(self.dim, math.ceil(rows / (2 * CELL_ROWS)))
        return dims, math.ceil(math.log(INNER_MISS) / math.log1p(-self.agreement(dims)))

    def routing(self, classes: int) -> Routing:
        """How a collection of ``classes`` is routed, so that a pair at the limit is missed as rarely as by ``tables`` tables of one coordinate."""
        dims, found = [self.dim], self.agreement()
        rest = classes / (2 * self.dim * ROUTED_ROWS)
        while rest > 1:
            dims.append(min(self.dim, math.ceil(rest / 2)))
            found *= self.agreement(dims[-1])
            rest /= 2 * dims[-1]
        inner, times = self.inner_cuts(classes / math.prod(2 * d for d in dims))
        if inner:
            found *= 1 - (1 - self.agreement(inner)) ** times
        return Routing(tuple(dims), math.ceil(self.tables * math.log1p(-self.agreement()) / math.log1p(-found) - 1e-9))


@dataclass(frozen=True)
class Routing:
    """For each coordinate that names a cell, among how many it is the most extreme; and the number of tables."""

    dims: tuple[int, ...]
    tables: int

    @property
    def cells(self) -> int:
        """Of one table."""
        return math.prod(2 * d for d in self.dims)


@lru_cache
def _agreement(dim: int, similarity: float, draws: int = 1 << 16) -> float:
    """The share of rotations that send two vectors of this similarity to the same extreme coordinate, by simulation."""
    rng = np.random.default_rng(SEED + 2)
    same = 0
    for _ in range(0, draws, 1 << 12):
        x, z = rng.normal(size=(2, 1 << 12, dim))
        y = similarity * x + math.sqrt(1 - similarity**2) * z
        a, b = np.abs(x).argmax(axis=1), np.abs(y).argmax(axis=1)
        at = np.arange(1 << 12)
        same += int(((a == b) & ((x[at, a] > 0) == (y[at, b] > 0))).sum())
    return same / draws


@lru_cache(maxsize=4096)
def _rotation(dim: int, *place: int) -> np.ndarray:
    """A random rotation of its own for each place (table, then coordinate or inner cut)."""
    return np.linalg.qr(np.random.default_rng([SEED, *place]).normal(size=(dim, dim)))[0].astype(np.float32)


def _extreme(y: np.ndarray) -> np.ndarray:
    """2 x the most extreme coordinate of each row, plus its sign."""
    top = np.abs(y).argmax(axis=1)
    return 2 * top + (y[np.arange(len(y)), top] > 0)


@lru_cache
def _directions(dim: int, count: int, table: int = 0) -> np.ndarray:
    return np.random.default_rng([SEED + 1, table]).normal(size=(dim, count)).astype(np.float32)


def _slack(q8: np.ndarray) -> np.ndarray:
    """The angle by which rounding may have moved each vector: every value by half a step at most."""
    x = q8.astype(np.float64)
    reach = math.sqrt(x.shape[1]) / 2 + 1e-6
    return np.arcsin(np.minimum(1, reach / np.sqrt(np.einsum("ij,ij->i", x, x))))


def _bounds(s: np.ndarray, slack: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and the greatest similarity of the full-precision vectors whose rounded ones have similarity ``s``."""
    wide = np.arccos(np.clip(s.astype(np.float64) - NOISE, -1, 1)) + slack
    near = np.arccos(np.clip(s.astype(np.float64) + NOISE, -1, 1)) - slack
    return np.cos(np.minimum(wide, math.pi)), np.cos(np.maximum(near, 0))


def _ranks(q: np.ndarray) -> np.ndarray:
    """Position of each element within its run of equal values; ``q`` is sorted."""
    head = np.r_[True, q[1:] != q[:-1]]
    return np.arange(len(q)) - np.maximum.accumulate(np.where(head, np.arange(len(q)), 0))


def _similarities(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    out = np.empty(len(i), np.float32)
    for at in range(0, len(i), 1 << 13):  # the gathered rows stay in the cache
        some = slice(at, at + (1 << 13))
        np.einsum("ij,ij->i", a[i[some]], b[j[some]], out=out[some])
    return out


def collision_search(queries: np.ndarray, points: np.ndarray, rule: KnnRule, same: bool, slack: tuple[np.ndarray, np.ndarray], table: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(query, point, open queries, open points): pairs that may have the rule's similarity and be among the k + 2 best of the query.

    ``slack`` holds the angles by which the queries and the points may be off. A query with more than ``WIDE`` such points
    is marked open, as are its points, and has no pairs.
    """
    directions = _directions(rule.dim, rule.projections, table)  # of each table its own: a pair that fails in one may pass in another
    grid = on_grid((points @ directions).T)
    n = len(points)
    blocks = [(at, SortedArrays(grid[:, at : at + POINTS])) for at in range(0, n, POINTS)]
    asked = grid if same else on_grid((queries @ directions).T)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    open_queries, open_points = np.zeros(len(queries), bool), np.zeros(n, bool)
    step = max(QUERIES, min(len(queries), (1 << 22) // max(n, 1)))
    widest = slack[0].max() + slack[1].max()
    floor = math.cos(min(math.acos(rule.min_similarity) + widest, math.pi)) - NOISE
    for at in range(0, len(queries), step):
        block = queries[at : at + step]
        active = np.arange(len(block))
        kept: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        for radius in rule.schedule:
            windows = asked[:, at + active]
            half = math.ceil(rule.half_width * radius / STEP)
            met = [(q, p + start) for start, arrays in blocks for q, p in (arrays.collided(windows, half, rule.collisions),)]
            q, p = (np.concatenate(z) for z in zip(*met))
            q = active[q]
            live = np.zeros(len(block), bool)
            live[active] = True
            if same:
                q, p = q[q + at != p], p[q + at != p]
            s = _similarities(block, points, q, p)
            good = s >= floor
            q, p, s = q[good], p[good], s[good]
            low, high = _bounds(s, slack[0][q + at] + slack[1][p])
            good = high >= rule.min_similarity
            q, p, low, high = q[good], p[good], low[good], high[good]
            near = np.bincount(q[low >= 1 - radius * radius / 2], minlength=len(block))
            done = live & ((near >= rule.k) | (radius == rule.schedule[-1]))
            out = done[q]
            if out.any():
                kept.append((q[out], p[out], low[out], high[out]))
            stay = ~done[active]
            if not stay.any():
                break
            active = active[stay]
        if not kept:
            continue
        q, p, low, high = (np.concatenate(x) for x in zip(*kept))
        order = np.lexsort((-low, q))
        q, p, low, high = q[order], p[order], low[order], high[order]
        last = np.full(len(block), -1.0)
        at_last = _ranks(q) == rule.k + 1
        last[q[at_last]] = low[at_last]
        good = high >= last[q] - 10.0**-DIGITS
        q, p = q[good], p[good]
        wide = np.bincount(q, minlength=len(block)) > WIDE
        open_queries[at : at + len(block)] = wide
        open_points[p[wide[q]]] = True
        found.append((q[~wide[q]] + at, p[~wide[q]]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), open_queries, open_points
    q, p = (np.concatenate(x) for x in zip(*found))
    return q, p, open_queries, open_points


def best_of(queries: np.ndarray, points: np.ndarray, query_class: np.ndarray, point_class: np.ndarray, ids: np.ndarray, rule: KnnRule) -> tuple[np.ndarray, np.ndarray]:
    """(query, point) of the k + 2 best points of each query by full-precision unit vectors, the smaller of ``ids`` first among equals."""
    by_id = np.argsort(ids, kind="stable")
    points, point_class = points[by_id], point_class[by_id]
    n, keep = len(points), rule.k + 2
    found = []
    step = max(1, (1 << 20) // n)
    for at in range(0, len(queries), step):
        s = np.round(queries[at : at + step] @ points.T, DIGITS)
        s[(query_class[at : at + step, None, :] == point_class[None]).all(axis=2)] = -2
        last = np.partition(s, n - keep, axis=1)[:, n - keep] if n > keep else np.full(len(s), -2.0)
        q, p = np.nonzero((s >= last[:, None]) & (s >= rule.min_similarity - 10.0**-DIGITS))
        order = np.lexsort((p, -s[q, p], q))
        q, p = q[order], p[order]
        if len(q):
            top = _ranks(q) < keep
            found.append((q[top] + at, by_id[p[top]]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    q, p = (np.concatenate(x) for x in zip(*found))
    return q, p


def _hash_rows(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each row of float32 values (-0 is 0)."""
    bits = np.ascontiguousarray(x + np.float32(0)).view(np.uint32).astype(np.uint64)
    out = []
    for salt in (0xA4093822299F31D0, 0x082EFA98EC4E6C89):
        place = mix64(np.arange(x.shape[1], dtype=np.uint64) + np.uint64(salt))
        out.append(mix64(mix64(bits ^ place).sum(axis=1, dtype=np.uint64)))
    return out[0], out[1]


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.flatten() if isinstance(column, pa.ListArray) else column.combine_chunks().flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float32, copy=False).reshape(-1, dim)


def _bytes(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int8).reshape(-1, dim)


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def good_vectors(rows: DataFrame, key: str, vector: str, dim: int) -> DataFrame:
    """(id, vec) of the rows whose vector takes part."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col(key).isNotNull() & (F.size(v) == dim) & finite & F.exists(v, lambda x: x != 0)
    return rows.where(usable).select(F.col(key).cast("string").alias("id"), v.cast("array<float>").alias("vec"))


def _classes(vectors: DataFrame, dim: int) -> DataFrame:
    """(id, c1, c2, q8, vec): class of equal vectors, one byte a dimension, and the vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1), dim)
            c1, c2 = _hash_rows(x)
            wide = x.astype(np.float64)
            peak = np.abs(wide).max(axis=1, keepdims=True)
            q8 = np.rint(wide / peak * 127).astype(np.int8)
            yield pa.RecordBatch.from_arrays([batch.column(0), _long(c1), _long(c2), pa.array([r.tobytes() for r in q8], pa.binary()), batch.column(1)], names=["id", "c1", "c2", "q8", "vec"])

    return vectors.mapInArrow(run, "id string, c1 long, c2 long, q8 binary, vec array<float>")


def _unit(q8: np.ndarray) -> np.ndarray:
    x = q8.astype(np.float32)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def route(classes: DataFrame, rule: KnnRule, routing: Routing) -> DataFrame:
    """(cell, c1, c2, q8): every class once for each table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _unit(_bytes(batch.column(2), rule.dim))
            for t in range(routing.tables):
                cell = np.full(len(x), t, np.int64)
                for level, dims in enumerate(routing.dims):
                    cell = cell * (2 * dims) + _extreme(x @ _rotation(rule.dim, t, level)[:, :dims])
                yield pa.RecordBatch.from_arrays([pa.array(cell), *batch.columns], names=["cell", "c1", "c2", "q8"])

    return classes.mapInArrow(run, "cell long, c1 long, c2 long, q8 binary")


def _spread(routed: DataFrame) -> DataFrame:
    """(cell, i, j, block, ...): the task of each row; cells of more than HOT classes are cut into pairs of blocks."""
    hot = materialize(routed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT), "hot-cells")
    n = hot.count()
    if not n:
        return routed.select("cell", F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("block"), "c1", "c2", "q8")
    known = routed.join(F.broadcast(hot) if n <= BROADCAST_CELLS else hot, "cell", "left")
    blocks = F.coalesce(F.ceil(F.col("n") / (HOT // 2)).cast("int"), F.lit(1))
    known = known.withColumn("blocks", blocks).withColumn("block", F.expr("cast(pmod(c2, blocks) as int)"))
    wide = known.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    return wide.select("cell", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "c1", "c2", "q8")


_FOUND = "a1 long, a2 long, b1 long, b2 long, cell long, i int, j int, role int"
_QUERY, _POINT, _RIGHT = 1, 2, 4  # roles of a class in a task that is ranked again


def _found(classes: np.ndarray, task: tuple[np.ndarray, np.ndarray, np.ndarray], role: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(np.ascontiguousarray(c)) for c in classes.T]
    columns += [pa.array(x.astype(t)) for x, t in zip((*task, role), (np.int64, np.int32, np.int32, np.int32))]
    return pa.RecordBatch.from_arrays(columns, names=["a1", "a2", "b1", "b2", "cell", "i", "j", "role"])


def _inner_cells(x: np.ndarray, rule: KnnRule, table: int) -> Iterator[np.ndarray]:
    """Rows of a routed cell that are compared with one another."""
    dims, times = rule.inner_cuts(len(x))
    if not dims:
        yield np.arange(len(x))
        return
    for k in range(times):
        cell = _extreme(x @ _rotation(rule.dim, table, 1000 + k)[:, :dims])
        order = np.argsort(cell, kind="stable")
        yield from np.split(order, np.flatnonzero(np.diff(cell[order])) + 1)


def cell_neighbours(tasks: DataFrame, rule: KnnRule, parts: int, routing: Routing) -> DataFrame:
    """Distinct pairs (a1, a2, b1, b2) with role 0: b may be among the best of a in some cell; other roles: class a takes part in task (cell, i, j) of ``dense_neighbours``."""
    placed = tasks.repartition(parts, "cell", "i", "j").sortWithinPartitions("cell", "i", "j")

    def group(table: pa.Table) -> Iterator[pa.RecordBatch]:
        cell, i, j, block = (table.column(k).to_numpy() for k in range(4))
        c1, c2 = table.column(4).to_numpy(), table.column(5).to_numpy()
        q8 = _bytes(table.column(6), rule.dim)
        x, slack = _unit(q8), _slack(q8)
        head = np.flatnonzero(np.r_[True, (cell[1:] != cell[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])])
        role = np.zeros(len(cell), np.int32)
        none = np.zeros(0, np.int32)
        for a, b in zip(head.tolist(), np.r_[head[1:], len(cell)].tolist()):
            pairs = [(none, none)]
            table_no = int(cell[a]) // routing.cells
            for inner in _inner_cells(x[a:b], rule, table_no):
                rows = a + inner
                if i[a] == j[a]:
                    sides = [(rows, rows, True)]
                else:
                    left, right = rows[block[rows] == i[a]], rows[block[rows] == j[a]]
                    sides = [(left, right, False), (right, left, False)]
                for q_rows, p_rows, same in sides:
                    if len(q_rows) > same and len(p_rows):
                        q, p, open_q, open_p = collision_search(x[q_rows], x[p_rows], rule, same, (slack[q_rows], slack[p_rows]), table_no)
                        pairs.append((q_rows[q], p_rows[p]))
                        role[q_rows[open_q]] |= _QUERY
                        role[p_rows[open_p]] |= _POINT
            q, p = (np.concatenate(z) for z in zip(*pairs))
            if len(q):
                distinct = np.unique(np.column_stack([c1[q], c2[q], c1[p], c2[p]]), axis=0)
                zero = np.zeros(len(distinct), np.int32)
                yield _found(distinct, (zero, zero, zero), zero)
        again = np.flatnonzero(role)
        if len(again):
            right = (i[again] != j[again]) & (block[again] == j[again])
            zero = np.zeros(len(again), np.int64)
            yield _found(np.column_stack([c1[again], c2[again], zero, zero]), (cell[again], i[again], j[again]), role[again] | np.where(right, _RIGHT, 0))

    return placed.mapInArrow(lambda batches: whole_groups(batches, 3, 8192, group), _FOUND).distinct()


def _scaled(x: np.ndarray) -> np.ndarray:
    """Unit vectors; scaled by the largest value first, so that no square overflows or vanishes."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def dense_neighbours(again: DataFrame, base: DataFrame, rule: KnnRule, parts: int) -> DataFrame:
    """(a1, a2, b1, b2): the k + 2 best of each open query among the open points of its task, on full-precision vectors."""
    classes = base.groupBy(F.col("c1").alias("a1"), F.col("c2").alias("a2")).agg(F.min("id").alias("id"), F.first("vec").alias("vec"))
    rows = again.join(classes, ["a1", "a2"]).select("cell", "i", "j", "role", "a1", "a2", "id", "vec")
    placed = rows.repartition(parts, "cell", "i", "j").sortWithinPartitions("cell", "i", "j")

    def group(table: pa.Table) -> Iterator[pa.RecordBatch]:
        cell, i, j, role = (table.column(k).to_numpy() for k in range(4))
        classes = np.column_stack([table.column(4).to_numpy(), table.column(5).to_numpy()])
        ids = np.array(table.column(6).to_pylist(), object)
        x = _scaled(_matrix(table.column(7), rule.dim))
        head = np.flatnonzero(np.r_[True, (cell[1:] != cell[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])])
        pairs = []
        for a, b in zip(head.tolist(), np.r_[head[1:], len(cell)].tolist()):
            rows, r = np.arange(a, b), role[a:b]
            right = (r & _RIGHT) > 0
            for side in (False, True):
                q_rows = rows[((r & _QUERY) > 0) & (right == side)]
                p_rows = rows[((r & _POINT) > 0) & ((right != side) if i[a] != j[a] else ~right)]
                if len(q_rows) and len(p_rows):
                    q, p = best_of(x[q_rows], x[p_rows], classes[q_rows], classes[p_rows], ids[p_rows], rule)
                    pairs.append(np.column_stack([classes[q_rows[q]], classes[p_rows[p]]]))
        if pairs:
            distinct = np.unique(np.concatenate(pairs), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in distinct.T], names=["a1", "a2", "b1", "b2"])

    return placed.mapInArrow(lambda batches: whole_groups(batches, 3, EXACT_ROWS, group), "a1 long, a2 long, b1 long, b2 long")


def _verified(pairs: DataFrame, classes: DataFrame, rule: KnnRule) -> DataFrame:
    """(a1, a2, b1, b2, similarity) on the full-precision vectors."""
    vec = classes.select("c1", "c2", "vec")
    a = vec.select(F.col("c1").alias("a1"), F.col("c2").alias("a2"), F.col("vec").alias("va"))
    b = vec.select(F.col("c1").alias("b1"), F.col("c2").alias("b2"), F.col("vec").alias("vb"))
    joined = pairs.join(a, ["a1", "a2"]).join(b, ["b1", "b2"]).select("a1", "a2", "b1", "b2", "va", "vb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            s = np.einsum("ij,ij->i", *(_scaled(_matrix(batch.column(k), rule.dim)) for k in (4, 5)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(s)], names=["a1", "a2", "b1", "b2", "similarity"])

    return joined.mapInArrow(run, "a1 long, a2 long, b1 long, b2 long, similarity double").where(F.col("similarity") >= rule.min_similarity)


def most_similar(rows: DataFrame, key: str = "id", vector: str = "embedding", rule: KnnRule = KnnRule()) -> DataFrame:
    """(id, neighbour, rank, similarity): for each row with a good vector the up to k most similar other rows of at least the rule's similarity."""
    base = materialize(_classes(good_vectors(rows, key, vector, rule.dim), rule.dim), "vectors")
    members = base.select("id", "c1", "c2").distinct()
    classes = base.groupBy("c1", "c2").agg(F.first("q8").alias("q8"), F.first("vec").alias("vec"))
    count = base.select("c1", "c2").distinct().count()
    routing = rule.routing(count)
    routed = route(classes.select("c1", "c2", "q8"), rule, routing)
    parts = tasks_for(rows.sparkSession, count * routing.tables, TASK_ROWS)
    found = materialize(cell_neighbours(_spread(routed), rule, parts, routing), "vector-pairs")
    pairs, again = found.where("role = 0").select("a1", "a2", "b1", "b2"), found.where("role > 0")
    dense = again.count()
    if dense:
        best = dense_neighbours(again.select("a1", "a2", "cell", "i", "j", "role"), base, rule, tasks_for(rows.sparkSession, dense, EXACT_ROWS))
        pairs = pairs.unionByName(best).distinct()
    links = materialize(_verified(pairs, classes, rule), "vector-links")
    release(found)

    # the first ids of each class stand for it: no row needs more than k + 1 of them
    w = Window.partitionBy("c1", "c2").orderBy("id")
    firsts = members.withColumn("n", F.row_number().over(w)).where(F.col("n") <= rule.k + 1).select("c1", "c2", F.col("id").alias("other"))
    to = firsts.select(F.col("c1").alias("b1"), F.col("c2").alias("b2"), "other")
    closeness = F.round("similarity", DIGITS).desc()
    by_class = Window.partitionBy("a1", "a2").orderBy(closeness, "other")
    outside = links.join(to, ["b1", "b2"]).withColumn("place", F.row_number().over(by_class)).where(F.col("place") <= rule.k)
    outside = outside.select(F.col("a1").alias("c1"), F.col("a2").alias("c2"), "other", "similarity")
    inside = firsts.withColumn("similarity", F.lit(1.0))
    options = inside.unionByName(outside)
    best = Window.partitionBy("id").orderBy(closeness, "other")
    large = large_classes(members)
    options = with_parts(options, large, "c1", "c2").withColumn("part", every_part()).drop("parts")
    rows = with_parts(members, large, "c1", "c2").withColumn("part", own_part()).drop("parts")
    found = rows.join(options, ["c1", "c2", "part"]).where(F.col("id") != F.col("other")).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= rule.k)
    return found.select("id", F.col("other").alias("neighbour"), "rank", "similarity")


def similar_pairs(neighbours: DataFrame) -> DataFrame:
    """Distinct unordered pairs of which one is a neighbour of the other."""
    return neighbours.select(F.least("id", "neighbour").alias("chunk_id_a"), F.greatest("id", "neighbour").alias("chunk_id_b")).distinct()
