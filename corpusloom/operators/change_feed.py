"""Processing only new or changed records of an append-only feed.

The feed is a table of deliveries with a unique sequence number; runs of a collector see the deliveries that
had arrived by the run's cutoff. What a store has processed is kept as *disjoint intervals of sequence numbers*.
A pass takes the pending runs in order of cutoff, subtracts the processed intervals from the ranges that are available
at the cutoffs, processes exactly the gaps (so a late commit with an old sequence number is still taken,
and nothing is taken twice), and commits the merged intervals in the same atomic step as the output.

*Order of runs.* A run is compared with the run before it by (cutoff, run id), whatever the order in which they were committed. A run that
succeeds after one with a later cutoff is set in its place: what it sees is derived from the deliveries of its own range
and the history of versions, and rows of later runs that thereby cease to be changes are *withdrawn*. ``ChangeFeedStore.changes`` is the net
result and equals that of one pass over the whole log. A late commit counts from the run that takes it.

Scale: a pass reads the rows that its gaps may hold (the widest processed intervals and the last cutoff are filters on the scan), and only claimed
bodies are parsed, before any shuffle, to a 16-byte digest. Deliveries are folded to one row per record and run
with map-side combining before the per-record window, so a record that holds a third of all deliveries sends one row per
run and map task. State is written as deltas: a pass adds rows for changed records only; after ``COMPACT_AFTER`` deltas the state, not the output, is
merged. In a pass without inserted runs one row a record is read of the state, and no body. Intervals inside a block of ``BLOCK`` numbers are
merged per block, runs of whole blocks per ``BLOCK`` blocks: the intervals grow with the gaps, not with the feed. At most ``RUNS_PER_PASS`` runs
are taken by one commit; further ones follow in the next commit of the same call.

Defined results for odd input: a delivery with NULL sequence number or arrival time is not available yet; one
with a NULL id or whose body is no complete JSON object is processed (its number is consumed) but
creates no version; repeated rows of one sequence number count once; equal clocks are decided by the greater sequence
number; a run listed with several cutoffs counts with the earliest; without a pending run nothing is read and nothing committed;
an empty feed commits an empty pass; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from bisect import bisect_right
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.operators.manifests import ManifestFolder
from corpusloom.session import materialize, release

BLOCK = 1 << 16
RUNS_PER_PASS = 50_000
WIDEST = 64  # processed intervals that become filters on the scan
BROADCAST_CLAIMS = 200_000  # claimed intervals sent to every task at most (4 MB); beyond, rows and claims meet by block
COMPACT_AFTER = 8


# ---------------------------------------------------------------- interval arithmetic


def from_points(points: np.ndarray) -> np.ndarray:
    """Sorted disjoint closed intervals ``[[lo, hi], ...]`` covering exactly ``points``."""
    p = np.unique(points)
    if not len(p):
        return np.empty((0, 2), np.int64)
    cut = np.flatnonzero(np.diff(p) > 1)
    return np.column_stack([p[np.r_[0, cut + 1]], p[np.r_[cut, len(p) - 1]]])


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Union of two interval sets; touching intervals are joined."""
    x = np.concatenate([a, b])
    if not len(x):
        return x
    x = x[np.argsort(x[:, 0], kind="stable")]
    reach = np.maximum.accumulate(x[:, 1])
    start = np.r_[True, x[1:, 0] > reach[:-1] + 1]
    return np.column_stack([x[start, 0], reach[np.r_[np.flatnonzero(start)[1:] - 1, len(x) - 1]]])


def subtract(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The parts of ``a`` outside ``b``; both sorted and disjoint."""
    if not len(a) or not len(b):
        return a
    out = []
    first = np.searchsorted(b[:, 1], a[:, 0])
    last = np.searchsorted(b[:, 0], a[:, 1], side="right")
    whole = first >= last
    if whole.any():
        out.append(a[whole])
    for (lo, hi), i, j in zip(a[~whole], first[~whole], last[~whole]):
        left = np.r_[lo, b[i:j, 1] + 1]
        right = np.r_[b[i:j, 0] - 1, hi]
        keep = left <= right
        out.append(np.column_stack([left[keep], right[keep]]))
    x = np.concatenate(out)
    return x[np.argsort(x[:, 0], kind="stable")]


def find(intervals: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Index of the interval that holds each point, -1 where none does."""
    if not len(intervals):
        return np.full(len(points), -1)
    i = np.searchsorted(intervals[:, 0], points, side="right") - 1
    return np.where((i >= 0) & (points <= intervals[np.maximum(i, 0), 1]), i, -1)


# ---------------------------------------------------------------- JSON digests


def _number(text: str) -> object:
    x = float(text)
    return int(x) if x.is_integer() and abs(x) < 2**53 else x


def _no_constant(text: str) -> object:
    raise ValueError(text)


def json_object_digest(text: str | None) -> bytes | None:
    """Digest of the JSON value of an object; None for what is not a complete JSON object.

    Spacing, escapes, key order and the spelling of equal numbers do not matter; array order does.
    """
    if text is None:
        return None
    try:
        value = json.loads(text, parse_float=_number, parse_constant=_no_constant)
    except (ValueError, RecursionError):
        return None
    if not isinstance(value, dict):
        return None
    canonical = json.dumps(value, sort_keys=True, ensure_ascii=False, separators=(",", ":"))
    return hashlib.blake2b(canonical.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def digest_bodies(texts: pa.Array) -> pa.Array:
    """Digests of a column of bodies; equal texts are parsed once."""
    coded = texts.dictionary_encode()
    known = pa.array([json_object_digest(t) for t in coded.dictionary.to_pylist()], pa.binary())
    return known.take(coded.indices)


# ---------------------------------------------------------------- the pass

_EMPTY = np.empty((0, 2), np.int64)
_FIRST = -(1 << 63)  # of a run's cutoff: before every run
_CLAIMS = "block long, ord int, lo long, hi long"
_INTERVALS = "lo long, hi long, whole boolean"
_RUNS = "run_id int, cut long"
_VERSIONS = "id string, run_id int, cut long, clock long, seq long, digest binary, live boolean, changed boolean, was_changed boolean, pass long, head boolean"


def _block_of(c: Column) -> Column:
    return F.floor(c / F.lit(BLOCK)).cast("long")


def _aligned(intervals: DataFrame) -> DataFrame:
    """Intervals cut at block borders, with their block."""
    spread = intervals.withColumn("block", F.explode(F.sequence(_block_of(F.col("lo")), _block_of(F.col("hi")))))
    low = F.col("block") * BLOCK
    return spread.select("block", F.greatest("lo", low).alias("lo"), F.least("hi", low + (BLOCK - 1)).alias("hi"))


@dataclass(frozen=True)
class Pending:
    """The runs of a pass in order. ``since`` is the cutoff of the run before each, committed or not; ``inserted`` says that a committed run comes after it."""

    run_ids: np.ndarray
    cuts: np.ndarray
    since: np.ndarray
    inserted: np.ndarray

    def takes(self, seq: np.ndarray, at: np.ndarray, claims: np.ndarray, ords: np.ndarray) -> np.ndarray:
        """Position of the run that looks at each delivery, -1 for none: the run that claims it, or an inserted run in whose range it arrived."""
        where = find(claims, seq)
        out = np.where(where >= 0, ords[np.maximum(where, 0)], -1) if len(ords) else np.full(len(seq), -1)
        k = np.searchsorted(self.cuts, at)
        near = np.minimum(k, len(self.cuts) - 1)
        again = (k < len(self.cuts)) & self.inserted[near] & (at > self.since[near])
        return np.where((out < 0) & again, near, out)


def claim_gaps(numbers: DataFrame, processed: DataFrame, cutoffs: np.ndarray) -> DataFrame:
    """For each run (by position in ``cutoffs``, ascending) the gaps of sequence numbers that it must process.

    ``numbers`` (seq, at: arrival in microseconds), ``processed`` (lo, hi). Returns (block, ord, lo, hi); no number
    is in two intervals, and none in a processed one. A number goes to the first run that can see it.
    """
    limits = np.asarray(cutoffs, np.int64)

    def sweep(seen: pd.DataFrame, done: pd.DataFrame) -> pd.DataFrame:
        seq, order = seen["seq"].to_numpy(np.int64), np.searchsorted(limits, seen["at"].to_numpy(np.int64))
        rank = np.lexsort((order, seq))
        seq, order = seq[rank], order[rank]
        single = np.r_[True, seq[1:] != seq[:-1]][: len(seq)] & (order < len(limits))
        seq, order = seq[single], order[single]
        gaps = subtract(from_points(seq), merge(_EMPTY, done[["lo", "hi"]].to_numpy(np.int64)))
        inside = find(gaps, seq) >= 0
        seq, order = seq[inside], order[inside]
        cut = np.flatnonzero((np.diff(seq) > 1) | (np.diff(order) != 0))
        first, last = np.r_[0, cut + 1][: len(seq)], np.r_[cut, len(seq) - 1][: len(seq)]
        return pd.DataFrame({"block": seq[first] // BLOCK, "ord": order[first].astype(np.int32), "lo": seq[first], "hi": seq[last]})

    left = numbers.select("seq", "at", _block_of(F.col("seq")).alias("block"))
    done = _aligned(processed).join(left.select("block").distinct(), "block", "left_semi")
    return left.groupBy("block").cogroup(done.groupBy("block")).applyInPandas(sweep, _CLAIMS)


def merged_intervals(processed: DataFrame, claims: DataFrame) -> DataFrame:
    """Disjoint intervals (lo, hi, whole) of all that is processed once ``claims`` are done: inside blocks, and runs of whole blocks."""

    def inside(pdf: pd.DataFrame) -> pd.DataFrame:
        x = merge(_EMPTY, pdf[["lo", "hi"]].to_numpy(np.int64))
        return pd.DataFrame({"lo": x[:, 0], "hi": x[:, 1], "whole": x[:, 1] - x[:, 0] == BLOCK - 1})

    def runs(pdf: pd.DataFrame) -> pd.DataFrame:
        x = merge(_EMPTY, pdf[["lo", "hi"]].to_numpy(np.int64))
        return pd.DataFrame({"lo": x[:, 0], "hi": x[:, 1], "whole": True})

    partial = processed.where(~F.col("whole")).select(_block_of(F.col("lo")).alias("block"), "lo", "hi")
    by_block = partial.unionByName(claims.select("block", "lo", "hi")).groupBy("block").applyInPandas(inside, _INTERVALS)
    both = by_block.unionByName(processed.where("whole")).withColumn("group", F.when(F.col("whole"), _block_of(_block_of(F.col("lo")))))
    joined = both.where("whole").groupBy("group").applyInPandas(runs, _INTERVALS)
    return joined.unionByName(both.where(~F.col("whole")).drop("group"))


def looked_at(rows: DataFrame, claims: DataFrame, pending: Pending, bodies=None) -> DataFrame:
    """(id, seq, clock, digest, ord) of the deliveries that the pending runs look at. ``rows`` (seq, at, id, clock, body).

    Only their bodies are parsed. ``bodies`` is an accumulator of how many.
    """
    few = claims.select("lo", "hi", "ord").limit(BROADCAST_CLAIMS + 1).collect()
    if len(few) <= BROADCAST_CLAIMS:
        known = np.array(sorted((r.lo, r.hi, r.ord) for r in few), np.int64).reshape(-1, 3)
        intervals, ords = np.ascontiguousarray(known[:, :2]), known[:, 2]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                seq, at = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1))
                order = pending.takes(seq, at, intervals, ords)
                keep = pa.array(np.flatnonzero(order >= 0))
                digest = digest_bodies(batch.column(4).take(keep))
                if bodies is not None:
                    bodies.add(len(keep))
                columns = [batch.column(2).take(keep), batch.column(0).take(keep), batch.column(3).take(keep), digest, pa.array(order[order >= 0].astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "seq", "clock", "digest", "ord"])

        return rows.select("seq", "at", "id", "clock", "body").mapInArrow(run, "id string, seq long, clock long, digest binary, ord int")

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if bodies is not None:
                bodies.add(batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], digest_bodies(batch.column(4))], names=["seq", "at", "id", "clock", "digest"])

    def attach(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        right = right.sort_values("lo")
        order = pending.takes(left["seq"].to_numpy(np.int64), left["at"].to_numpy(np.int64), right[["lo", "hi"]].to_numpy(np.int64), right["ord"].to_numpy(np.int64))
        out = left.loc[order >= 0, ["id", "seq", "clock", "digest"]].copy()
        out["ord"] = order[order >= 0].astype(np.int32)
        return out

    digests = rows.select("seq", "at", "id", "clock", "body").mapInArrow(reduce, "seq long, at long, id string, clock long, digest binary").withColumn("block", _block_of(F.col("seq")))
    return digests.groupBy("block").cogroup(claims.groupBy("block")).applyInPandas(attach, "id string, seq long, clock long, digest binary, ord int")


def best_versions(seen: DataFrame) -> DataFrame:
    """(id, ord, version): of each record the greatest version that each run looks at. ``seen`` (id, seq, clock, digest, ord)."""
    fresh = seen.where(F.col("digest").isNotNull() & F.col("id").isNotNull()).select("id", "ord", F.struct("clock", "seq", "digest").alias("version"))
    return fresh.groupBy("id", "ord").agg(F.max("version").alias("version"))


def fold_versions(fresh: DataFrame, state: DataFrame, runs: DataFrame, number: int) -> DataFrame:
    """The rows of the version history that a pass adds or alters, as ``_VERSIONS``.

    ``fresh`` (id, ord, version) is read twice; ``runs`` (ord, run_id, cut); ``state`` (id, run_id, cut, version, changed) holds what was in force at
    each committed run, or its last version with a cutoff of ``_FIRST``, which comes before every run and is not given out.
    A row is ``live`` where its version is in force at its run and was not before, and ``changed`` where the body differs too.
    """
    best = fresh.join(F.broadcast(runs), "ord")
    best = best.select("id", "run_id", "cut", "version", F.lit(False).alias("was_live"), F.lit(False).alias("was_changed"))
    old = state.join(best.select("id").distinct(), "id", "left_semi").select("id", "run_id", "cut", "version", F.lit(True).alias("was_live"), F.col("changed").alias("was_changed"))
    by_id = Window.partitionBy("id").orderBy("cut", "run_id")
    rows = best.unionByName(old).withColumn("top", F.max("version").over(by_id.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    rows = rows.withColumn("before", F.max("version").over(by_id.rowsBetween(Window.unboundedPreceding, -1)))
    live = F.col("before").isNull() | (F.col("version") > F.col("before"))
    changed = F.col("before").isNull() | (live & (F.col("before")["digest"] != F.col("version")["digest"]))
    rows = rows.withColumns({"live": live, "changed": changed, "head": F.col("version")["seq"] == F.col("top")["seq"]})
    altered = (F.col("live") != F.col("was_live")) | (F.col("changed") != F.col("was_changed"))
    given = rows.where((F.col("cut") > _FIRST) & altered)
    return given.select("id", "run_id", "cut", "version.*", "live", "changed", "was_changed", F.lit(number).cast("long").alias("pass"), (F.col("head") & F.col("live")).alias("head"))


class FailedBeforeCommit(RuntimeError):
    """Raised in place of a commit by a store that is told to fail."""


@dataclass
class Pass:
    """What a call committed: ``changes`` and ``withdrawn`` (run_id, id), ``claims`` (run_id, lo, hi)."""

    version: int
    changes: DataFrame
    withdrawn: DataFrame
    claims: DataFrame


@dataclass
class ChangeFeedStore:
    """Durable state of one consumer of a feed in a shared folder.

    A commit is one manifest file, put in place by a rename after everything that it names has been written. A pass that fails
    before leaves only files that no manifest names; the next pass starts from the last manifest, so
    nothing is skipped or repeated. One writer at a time; a second one loses the rename and fails. The folder of a pass holds its output and is kept;
    merged state that the last two manifests do not name is deleted.
    """

    spark: SparkSession
    path: str
    fail_before_commit: bool = field(default=False, repr=False)
    count_bodies: bool = field(default=False, repr=False)
    bodies: object = field(default=None, repr=False)

    def __post_init__(self) -> None:
        if self.count_bodies:
            self.bodies = self.spark.sparkContext.accumulator(0)

    @property
    def log(self) -> ManifestFolder:
        return ManifestFolder(self.spark, f"{self.path}/commits")

    def manifest(self) -> dict:
        return self.log.last() or {"version": 0, "base": None, "deltas": [], "intervals": None, "withdraws": False}

    def _read(self, schema: str, names: list[str]) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*names)

    def _state_folders(self, m: dict, part: str) -> list[str]:
        return [f"{self.path}/{p}/{part}" for p in ([m["base"]] if m["base"] else []) + m["deltas"]]

    def _versions(self, m: dict) -> DataFrame:
        tables = [self.spark.read.schema(_VERSIONS).parquet(f) for f in self._state_folders(m, "versions")]
        out = self.spark.createDataFrame([], _VERSIONS) if not tables else tables[0]
        for t in tables[1:]:
            out = out.unionByName(t)
        return out

    def heads(self, m: dict) -> DataFrame:
        """(id, version) in force at the last run: the greatest of the heads that passes left."""
        rows = self._versions(m).where("head").select("id", F.struct("clock", "seq", "digest").alias("version"))
        return rows.groupBy("id").agg(F.max("version").alias("version"))

    def history(self, m: dict) -> DataFrame:
        """(id, run_id, cut, version, changed) of every run at which a record's version was replaced."""
        row = F.struct("pass", "live", "changed", F.struct("clock", "seq", "digest").alias("version")).alias("row")
        last = self._versions(m).groupBy("id", "run_id", "cut").agg(F.max_by(row, F.col("pass")).alias("row"))
        return last.where("row.live").select("id", "run_id", "cut", "row.version", "row.changed")

    def intervals(self, m: dict | None = None) -> DataFrame:
        m = m or self.manifest()
        return self._read(_INTERVALS, [f"{self.path}/{m['intervals']}"] if m["intervals"] else [])

    def committed_runs(self, m: dict | None = None) -> DataFrame:
        return self._read(_RUNS, self._state_folders(m or self.manifest(), "runs"))

    def pending(self, runs: DataFrame, m: dict) -> Pending | None:
        """The first ``RUNS_PER_PASS`` succeeded runs that are not committed, by cutoff and run id."""
        good = runs.where((F.col("status") == "succeeded") & F.col("cutoff_at").isNotNull() & F.col("run_id").isNotNull())
        good = good.groupBy("run_id").agg(F.min(F.unix_micros("cutoff_at")).alias("cut"))
        rows = good.join(self.committed_runs(m), "run_id", "left_anti").orderBy("cut", "run_id").limit(RUNS_PER_PASS).collect()
        if not rows:
            return None
        keys = [(r.cut, r.run_id) for r in rows]
        cuts = np.array([c for c, _ in keys], np.int64)
        floor, after = np.full(len(keys) + 1, _FIRST, np.int64), (_FIRST, 0)
        if m["version"]:

            def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    ids, cut = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                    slots = [bisect_right(keys, k) for k in zip(cut, ids)]
                    yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int32()), *batch.columns], names=["slot", "run_id", "cut"])

            placed = self.committed_runs(m).mapInArrow(place, "slot int, run_id int, cut long")
            for r in placed.groupBy("slot").agg(F.max(F.struct("cut", "run_id")).alias("top")).collect():  # one row a pending run at most
                floor[r.slot], after = r.top.cut, max(after, (r.top.cut, r.top.run_id))
        since = np.maximum(np.maximum.accumulate(floor[:-1]), np.r_[_FIRST, cuts[:-1]])
        return Pending(np.array([r for _, r in keys], np.int64), cuts, since, np.array([k < after for k in keys]))

    def process(self, feed: DataFrame, runs: DataFrame) -> Pass:
        """Process all pending succeeded runs and commit. Where there is none, nothing is read or written."""
        began = self.manifest()["version"]
        while True:
            m = self.manifest()
            pending = self.pending(runs, m)
            if pending is not None:
                self._pass(feed, pending, m)
            if pending is None or len(pending.cuts) < RUNS_PER_PASS:
                return self.read(began)

    def _scan(self, feed: DataFrame, pending: Pending, m: dict) -> DataFrame:
        """(seq, at, id, clock, body) of the rows that the pass may need; what is left out is processed or not yet available."""
        seq, at = F.col("feed_seq"), F.col("loaded_at")
        moment = lambda micros: F.timestamp_micros(F.lit(int(micros)))
        rows = feed.where(seq.isNotNull() & at.isNotNull() & (at <= moment(pending.cuts[-1])))
        wanted = F.lit(True)
        widest = self.intervals(m).orderBy(F.desc(F.col("hi") - F.col("lo"))).limit(WIDEST).collect() if m["intervals"] else []
        for r in widest:
            wanted = wanted & ((seq < r.lo) | (seq > r.hi))
        if pending.inserted.any():
            low, high = pending.since[pending.inserted].min(), pending.cuts[pending.inserted].max()
            wanted = wanted | ((at <= moment(high)) if low == _FIRST else (at > moment(low)) & (at <= moment(high)))
        clock = F.unix_micros(F.coalesce("updated_at", "loaded_at"))
        return rows.where(wanted).select(seq.alias("seq"), F.unix_micros("loaded_at").alias("at"), "id", clock.alias("clock"), F.col("raw_json").alias("body"))

    def _pass(self, feed: DataFrame, pending: Pending, m: dict) -> None:
        number = m["version"] + 1
        name = f"passes/{number:012d}-{uuid.uuid4().hex}"
        data = f"{self.path}/{name}"
        rows = self._scan(feed, pending, m)
        processed = self.intervals(m)
        claim_gaps(rows, processed, pending.cuts).write.parquet(f"{data}/claims")
        claims = self.spark.read.schema(_CLAIMS).parquet(f"{data}/claims")
        inserted = bool(pending.inserted.any())
        state = self.history(m) if inserted else self.heads(m).select("id", F.lit(None).cast("int").alias("run_id"), F.lit(_FIRST).alias("cut"), "version", F.lit(True).alias("changed"))
        listed = pa.table({"ord": pa.array(range(len(pending.cuts)), pa.int32()), "run_id": pa.array(pending.run_ids, pa.int32()), "cut": pa.array(pending.cuts)})
        runs = self.spark.createDataFrame(listed)
        fresh = materialize(best_versions(looked_at(rows, claims, pending, self.bodies)), "fresh-versions")
        versions = fold_versions(fresh, state, runs, number)
        tables = {"versions": versions.write.partitionBy("head"), "runs": runs.coalesce(1).write, "intervals": merged_intervals(processed, claims).write}
        with ThreadPoolExecutor(len(tables)) as pool:  # none needs another
            list(pool.map(lambda x: x[1].parquet(f"{data}/{x[0]}"), tables.items()))
        release(fresh)
        after = {"version": number, "base": m["base"], "deltas": [*m["deltas"], name], "intervals": f"{name}/intervals", "pass": name, "withdraws": m["withdraws"] or inserted}
        if len(after["deltas"]) > COMPACT_AFTER:
            after |= {"base": self._compact(after, number), "deltas": []}
        if self.fail_before_commit:
            raise FailedBeforeCommit
        self.log.commit(after)
        self._clean({m["base"], after["base"]})

    def _compact(self, m: dict, number: int) -> str:
        """The state of a base and its deltas as one base."""
        name = f"bases/{number:012d}-{uuid.uuid4().hex}"
        by_id = Window.partitionBy("id")
        rows = self.history(m).withColumn("top", F.max("version").over(by_id))
        rows = rows.select("id", "run_id", "cut", "version.*", F.lit(True).alias("live"), "changed", F.col("changed").alias("was_changed"), F.lit(number).cast("long").alias("pass"), (F.col("top.seq") == F.col("version.seq")).alias("head"))
        rows.write.partitionBy("head").parquet(f"{self.path}/{name}/versions")
        self.committed_runs(m).coalesce(1).write.parquet(f"{self.path}/{name}/runs")
        return name

    def _clean(self, named: set[str | None]) -> None:
        for base in self.log.names(f"{self.path}/bases"):
            if f"bases/{base}" not in named:
                self.log.delete(f"{self.path}/bases/{base}")

    def changes(self) -> DataFrame:
        """(run_id, id) of every change that stands."""
        return self.read(0).changes

    def read(self, since: int = 0) -> Pass:
        """What the passes after version ``since`` gave out, net of what later ones of them withdrew."""
        passes = self.log.since(since)
        folders = [f"{self.path}/{m['pass']}" for m in passes]
        tables = [self.spark.read.schema(_VERSIONS).parquet(f"{f}/versions") for f in folders]
        rows = self.spark.createDataFrame([], _VERSIONS) if not tables else tables[0]
        for t in tables[1:]:
            rows = rows.unionByName(t)
        rows = rows.where(F.col("changed") != F.col("was_changed"))
        if len(passes) > 1 and passes[-1]["withdraws"]:
            # the first row tells what stood before, the last one what stands
            edge = rows.groupBy("run_id", "id").agg(F.min_by("was_changed", "pass").alias("was_changed"), F.max_by("changed", "pass").alias("changed"))
            rows = edge.where(F.col("changed") != F.col("was_changed"))
        claims = self._read("run_id int, lo long, hi long", [])
        for f in folders:
            order = self.spark.read.schema("ord int, run_id int, cut long").parquet(f"{f}/runs")
            claims = claims.unionByName(self.spark.read.schema(_CLAIMS).parquet(f"{f}/claims").join(F.broadcast(order), "ord").select("run_id", "lo", "hi"))
        return Pass(self.manifest()["version"], rows.where("changed").select("run_id", "id"), rows.where("was_changed").select("run_id", "id"), claims)
