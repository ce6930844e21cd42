"""Filling containers of fixed capacity, with certified bounds and repacking.

Items are spread over partitions by hash; each is packed by best-fit decreasing, and a lower bound from dual feasible functions certifies how few
containers that partition could take. Partitions whose count is above their bound put the items of their under-filled containers into a
common pool, which is spread anew over fewer partitions and packed again; a round that does not save a container is dropped.
Only a text larger than the capacity is split: into full containers and one rest.

Scale: a partition holds about ``PART_ITEMS`` items whatever the table's size; only (key, part, size) is moved; the driver sees
sums and one histogram of at most ``capacity`` + 1 sizes.

Defined results: NULL and empty texts have size 0 and lie in some container without using room; a repeated row is an item of its own;
a capacity below 1 is refused; an empty table gives no containers; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import materialize, release

PART_ITEMS = 20_000
ROUNDS = 3
POOLED_FILL = 0.99  # containers filled less than this are opened when their partition has a gap


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(container of each item, free room of each container). Sizes are integers of 0 to ``capacity``."""
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set where a container with room r is open
    free: list[int] = []
    place = np.empty(len(sizes), np.int64)
    order = np.argsort(-sizes, kind="stable")
    for item, size in zip(order.tolist(), sizes[order].tolist()):
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            stack = by_room[room]
            box = stack.pop()
            if not stack:
                rooms ^= 1 << room
        else:
            room, box = capacity, len(free)
            free.append(capacity)
        room -= size
        free[box] = room
        if not by_room[room]:
            rooms |= 1 << room
        by_room[room].append(box)
        place[item] = box
    return place, np.asarray(free, np.int64)


def lower_bound(histogram: np.ndarray, capacity: int) -> int:
    """Containers that any packing needs; ``histogram[s]`` items have size s.

    The largest of three families of dual feasible functions, scaled to integers: identity with small items left out and large ones
    rounded up, stretched rounding by k, and rounding of the complement by a step.
    """
    n = np.asarray(histogram, np.int64)
    if not n[1:].sum():
        return int(n.sum() > 0)
    x = np.arange(capacity + 1)
    volume = n * x
    upto = np.cumsum(volume)
    count = np.cumsum(n)
    eps = np.arange(0, capacity // 2 + 1)
    # sizes above capacity - eps count as whole, those below eps as nothing
    large = count[-1] - count[capacity - eps]
    middle = upto[capacity - eps] - np.where(eps > 0, upto[np.maximum(eps - 1, 0)], 0)
    best = int((large * capacity + middle + capacity - 1).max() // capacity)
    for k in range(1, 25):
        whole = (k + 1) * x % capacity == 0
        # times k * capacity: x * k where it divides, else floor((k + 1) x / C) * C
        value = np.where(whole, k * x, (k + 1) * x // capacity * capacity)
        best = max(best, -(-int((value * n).sum()) // (k * capacity)))
    present = np.flatnonzero(n[1 : capacity // 2 + 1]) + 1
    for step in present[np.unique(np.linspace(0, len(present) - 1, 64).astype(int))].tolist() if len(present) else []:
        full = capacity // step
        half = 2 * x == capacity
        value = np.where(2 * x > capacity, 2 * (full - (capacity - x) // step), np.where(half, full, 2 * (x // step)))
        best = max(best, -(-int((value * n).sum()) // (2 * full)))
    return best


def _pack(items: DataFrame, capacity: int, label: str) -> DataFrame:
    """Adds box, fill, boxes, bound to (key, part, size, grp); one task a group."""
    schema = items.selectExpr("key", "part", "size", "grp", "cast(0 as long) box", "cast(0 as long) fill", "cast(0 as long) boxes", "cast(0 as long) bound").schema

    def run(table: pa.Table) -> pa.Table:
        size = table.column("size").to_numpy()
        place, free = best_fit_decreasing(size, capacity)
        bound = lower_bound(np.bincount(size, minlength=capacity + 1), capacity)
        n = len(size)
        extra = {"box": place, "fill": (capacity - free)[place], "boxes": np.full(n, len(free)), "bound": np.full(n, bound)}
        return pa.table({**{c: table.column(c) for c in ("key", "part", "size", "grp")}, **{k: pa.array(v, pa.int64()) for k, v in extra.items()}})

    return items.groupBy("grp").applyInArrow(run, schema).withColumn("round", F.lit(label))


def _grouped(items: DataFrame, count: int, salt: int) -> DataFrame:
    groups = max(1, -(-count // PART_ITEMS))
    return items.select("key", "part", "size", F.expr(f"pmod(xxhash64(key, part, {salt}), {groups})").alias("grp"))


@dataclass
class Packing:
    """``placed`` (key, part, size, start_token, container_id) and totals."""

    placed: DataFrame
    containers: int
    bound: int
    tokens: int

    def split_keys(self) -> DataFrame:
        """(key) of the items of which different parts lie in different containers."""
        ends = [f(c).alias(f"{f.__name__}_{c}") for c in ("start_token", "container_id") for f in (F.min, F.max)]
        return self.placed.groupBy("key").agg(*ends).where("min_start_token < max_start_token AND min_container_id < max_container_id").select("key")


def pieces(sizes: DataFrame, capacity: int) -> DataFrame:
    """(key, part, parts, size, start_token): items within the capacity as they are, larger ones cut into full parts and a rest."""
    parts = F.greatest(F.lit(1), F.ceil(F.col("tokens") / F.lit(capacity))).cast("int")
    cut = sizes.select("key", "tokens", parts.alias("parts")).withColumn("part", F.explode(F.expr("sequence(0, parts - 1)")))
    start = F.col("part").cast("long") * capacity
    return cut.select("key", "part", "parts", F.least(F.lit(capacity).cast("long"), F.col("tokens") - start).alias("size"), start.alias("start_token"))


def fill_containers(sizes: DataFrame, capacity: int) -> Packing:
    """Pack (key, tokens) into containers of ``capacity``."""
    if capacity < 1:
        raise ValueError("the capacity must be at least 1")
    items = materialize(pieces(sizes, capacity), "pieces")
    count = items.count()
    packed = materialize(_pack(_grouped(items, count, 0), capacity, "0"), "packed-0")
    for k in range(1, ROUNDS + 1):
        gap = F.col("boxes") > F.col("bound")
        pooled = gap & (F.col("fill") < POOLED_FILL * capacity)
        before = packed.agg(F.count_if(gap), F.count_if(pooled), F.countDistinct(F.when(pooled, F.struct("round", "grp", "box")))).first()
        if not before[0] or before[2] < 2:
            break
        pool = packed.where(pooled).select("key", "part", "size")
        again = materialize(_pack(_grouped(pool, before[1], k), capacity, str(k)), f"packed-{k}")
        if again.select("round", "grp", "box").distinct().count() >= before[2]:
            release(again)
            break
        merged = materialize(packed.where(~pooled).unionByName(again), f"merged-{k}")
        release(packed, again)
        packed = merged
    histogram = np.zeros(capacity + 1, np.int64)
    for row in items.groupBy("size").count().collect():  # at most capacity + 1 rows
        histogram[row[0]] = row[1]
    boxes = packed.select("round", "grp", "box").distinct().count()
    placed = packed.select(
        "key",
        "part",
        "size",
        (F.col("part").cast("long") * capacity).alias("start_token"),
        F.concat_ws("-", "round", "grp", "box").alias("container_id"),
    )
    return Packing(placed, boxes, lower_bound(histogram, capacity) if count else 0, int((histogram * np.arange(capacity + 1)).sum()))
