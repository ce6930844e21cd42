import datetime as dt
import json

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from corpusloom.operators import change_feed as C

FEED = "feed_seq long, id string, raw_json string, updated_at timestamp, loaded_at timestamp, collect_count int, lo int, block string, ord int"
RUNS = "run_id int, cutoff_at timestamp, status string"
T0 = dt.datetime(2026, 3, 1, tzinfo=dt.UTC)


def at(hours):
    return None if hours is None else T0 + dt.timedelta(hours=hours)


def expand(x):
    return {p for lo, hi in x.tolist() for p in range(lo, hi + 1)}


@given(st.sets(st.integers(0, 60)), st.sets(st.integers(0, 60)))
def test_interval_arithmetic(a, b):
    x, y = (C.from_points(np.array(sorted(s), np.int64)) for s in (a, b))
    assert expand(x) == a
    assert expand(C.merge(x, y)) == a | b
    assert expand(C.subtract(x, y)) == a - b
    joined = C.merge(x, y)
    assert all(joined[i, 1] + 1 < joined[i + 1, 0] for i in range(len(joined) - 1))
    points = np.arange(61)
    assert {int(p) for p in points[C.find(x, points) >= 0]} == a


@pytest.mark.parametrize(
    ("a", "b", "same"),
    [
        ('{"a":1,"b":[1,2]}', '{ "b" : [1, 2], "a": 1.0 }', True),
        ('{"a":"é"}', '{"a":"\\u00e9"}', True),
        ('{"a":[1,2]}', '{"a":[2,1]}', False),
        ('{"a":null}', "{}", False),
        ('{"a":true}', '{"a":1}', False),
    ],
)
def test_digest_follows_the_value(a, b, same):
    assert (C.json_object_digest(a) == C.json_object_digest(b)) is same


@pytest.mark.parametrize("text", [None, "", "  ", "null", "[]", '"{}"', '{"a":', '{"a":NaN}', "{} x", "[" * 100_000])
def test_digest_of_what_is_no_object(text):
    assert C.json_object_digest(text) is None


def brute(feed, runs):
    rows = [r for r in feed if r["feed_seq"] is not None and r["loaded_at"] is not None and r["id"] is not None and C.json_object_digest(r["raw_json"])]
    out, before = set(), {}
    for cut, run in sorted((r["cutoff_at"], r["run_id"]) for r in runs if r["status"] == "succeeded"):
        now = {}
        for r in rows:
            if r["loaded_at"] <= cut:
                key = (r["updated_at"] or r["loaded_at"], r["feed_seq"])
                if r["id"] not in now or key > now[r["id"]][0]:
                    now[r["id"]] = (key, json.loads(r["raw_json"]))
        out |= {(run, k) for k, v in now.items() if k not in before or before[k][1] != v[1]}
        before = now
    return out


def row(seq, id_, body, updated, loaded):
    return {"feed_seq": seq, "id": id_, "raw_json": body, "updated_at": at(updated), "loaded_at": at(loaded), "collect_count": 1, "lo": 7, "block": "x", "ord": 3}


def run(run_id, cutoff, status="succeeded"):
    return {"run_id": run_id, "cutoff_at": at(cutoff), "status": status}


FEED_ROWS = [
    row(1, "a", '{"x":1}', 1, 1), row(2, "a", '{ "x": 1 }', 2, 2), row(3, "a", '{"x":2}', 0, 3), row(4, "b", "{", 1, 1), row(5, "b", '{"y":[1]}', None, 4),
    row(6, "a", '{"x":3}', 9, 9), row(7, None, '{"z":1}', 1, 1), row(None, "c", '{"z":1}', 1, 1), row(8, "c", None, 1, 2), row(9, "c", '{"z":1}', 5, None),
    row(10, "d", '{"q":1}', 2, 2), row(10, "d", '{"q":1}', 2, 2), row(11, "e", '{"k":1}', 3, 6), row(12, "e", '{"k":2}', 3, 6), row(C.BLOCK + 5, "f", '{"k":2}', 3, 6), row(C.BLOCK * 3 - 1, "f", '{"k":3}', 4, 7),
]
RUN_ROWS = [run(1, 2), run(2, 3, "failed"), run(3, 5), run(4, 5), run(5, 6, "aborted"), run(6, 8), run(7, 10), run(8, 11, "running")]


def found(result):
    return {(r.run_id, r.id) for r in result.changes.collect()}


def net(store):
    return {(r.run_id, r.id) for r in store.changes().collect()}


def test_whole_log_in_one_pass_equals_brute_force(spark, tmp_path):
    store = C.ChangeFeedStore(spark, f"file://{tmp_path}/s")
    got = store.process(spark.createDataFrame(FEED_ROWS, FEED), spark.createDataFrame(RUN_ROWS, RUNS))
    assert found(got) == brute(FEED_ROWS, RUN_ROWS)


def test_run_by_run_with_failures_and_late_commits(spark, tmp_path):
    """The same cases come out when every run is its own pass, some passes fail before their commit, and a late row has an old number."""
    store = C.ChangeFeedStore(spark, f"file://{tmp_path}/s")
    seen, taken = set(), []
    for k in range(1, len(RUN_ROWS) + 1):
        log = spark.createDataFrame(RUN_ROWS[:k], RUNS)
        feed = spark.createDataFrame(FEED_ROWS, FEED)
        if k in (1, 4, 6):
            store.fail_before_commit = True
            with pytest.raises(C.FailedBeforeCommit):
                store.process(feed, log)
            store.fail_before_commit = False
        result = store.process(feed, log)
        seen |= found(result)
        taken += [n for r in result.claims.collect() for n in range(r.lo, r.hi + 1)]
    assert seen == brute(FEED_ROWS, RUN_ROWS)
    assert len(taken) == len(set(taken))  # nothing is processed twice
    late = [*FEED_ROWS, row(0, "late", '{"l":1}', 1, 1)]
    result = store.process(spark.createDataFrame(late, FEED), spark.createDataFrame([*RUN_ROWS, run(9, 12)], RUNS))
    assert found(result) == {(9, "late")}
    assert [(r.lo, r.hi) for r in result.claims.collect()] == [(0, 0)]
    assert net(store) == brute(FEED_ROWS, RUN_ROWS) | {(9, "late")}


def test_empty_feed_and_no_runs(spark, tmp_path):
    store = C.ChangeFeedStore(spark, f"file://{tmp_path}/s")
    assert found(store.process(spark.createDataFrame([], FEED), spark.createDataFrame(RUN_ROWS, RUNS))) == set()
    assert found(store.process(spark.createDataFrame(FEED_ROWS, FEED), spark.createDataFrame([], RUNS))) == set()


def test_hot_record(spark, tmp_path):
    rows = [row(i, "hot" if i % 3 else f"p{i}", json.dumps({"v": i // 50}), i / 1000, i / 1000) for i in range(1200)]
    runs = [run(1, 0.4), run(2, 0.8), run(3, 1.2)]
    store = C.ChangeFeedStore(spark, f"file://{tmp_path}/s")
    assert found(store.process(spark.createDataFrame(rows, FEED), spark.createDataFrame(runs, RUNS))) == brute(rows, runs)


def test_run_that_succeeds_after_a_later_one(spark, tmp_path):
    rows = [row(1, "a", '{"x":1}', 1, 1), row(2, "b", '{"x":1}', 1, 1), row(3, "a", '{"x":2}', 3, 3)]
    store = C.ChangeFeedStore(spark, f"file://{tmp_path}/s")
    feed = spark.createDataFrame(rows, FEED)
    first = store.process(feed, spark.createDataFrame([run(2, 4)], RUNS))
    assert found(first) == {(2, "a"), (2, "b")}
    second = store.process(feed, spark.createDataFrame([run(2, 4), run(1, 2)], RUNS))
    assert found(second) == {(1, "a"), (1, "b")}
    assert {(r.run_id, r.id) for r in second.withdrawn.collect()} == {(2, "b")}
    assert second.claims.count() == 0  # the later run has taken the numbers
    assert net(store) == {(1, "a"), (1, "b"), (2, "a")}


@pytest.mark.parametrize(("seed", "broadcast", "compact", "per_pass"), [(1, 200_000, 8, 50_000), (2, 0, 1, 50_000), (3, 200_000, 0, 2)])
def test_any_order_of_runs_gives_the_changes_of_one_pass(spark, tmp_path, monkeypatch, seed, broadcast, compact, per_pass):
    monkeypatch.setattr(C, "BROADCAST_CLAIMS", broadcast)
    monkeypatch.setattr(C, "COMPACT_AFTER", compact)
    monkeypatch.setattr(C, "RUNS_PER_PASS", per_pass)
    rng = np.random.default_rng(seed)
    rows = [row(int(i), f"p{rng.integers(8)}" if i % 3 else "hot", json.dumps({"v": int(rng.integers(3))}), int(rng.integers(20)) if i % 5 else None, int(rng.integers(20))) for i in range(150)]
    runs = [run(int(k), int(rng.integers(22)), "succeeded" if k % 4 else "failed") for k in range(1, 12)]
    feed = spark.createDataFrame(rows, FEED)
    store = C.ChangeFeedStore(spark, f"file://{tmp_path}/s")
    for some in np.split(rng.permutation(len(runs)), [3, 7]):
        known = [*locals().get("known", []), *(runs[k] for k in some)]
        store.process(feed, spark.createDataFrame(known, RUNS))
    assert net(store) == brute(rows, runs)
    last = max(r["cutoff_at"] for r in runs if r["status"] == "succeeded")
    want = sorted(r["feed_seq"] for r in rows if r["loaded_at"] <= last)
    got = [n for r in store.read().claims.collect() for n in range(r.lo, r.hi + 1)]
    assert sorted(got) == want
    assert sorted(n for r in store.intervals().collect() for n in range(r.lo, r.hi + 1)) == want


def test_a_pass_parses_only_what_it_claims(spark, tmp_path):
    rows = [row(i, f"p{i % 7}", json.dumps({"v": i}), i, i) for i in range(100)]
    store = C.ChangeFeedStore(spark, f"file://{tmp_path}/s", count_bodies=True)
    feed = spark.createDataFrame(rows, FEED)
    store.process(feed, spark.createDataFrame([run(1, 80)], RUNS))
    assert store.bodies.value == 81
    version = store.manifest()["version"]
    nothing = store.process(feed, spark.createDataFrame([run(1, 80)], RUNS))  # no pending run: no commit
    assert (nothing.version, store.bodies.value, found(nothing)) == (version, 81, set())
    store.process(feed, spark.createDataFrame([run(1, 80), run(2, 80)], RUNS))  # nothing new
    assert store.bodies.value == 81
    store.process(feed, spark.createDataFrame([run(1, 80), run(2, 80), run(3, 90)], RUNS))
    assert store.bodies.value == 91


def test_intervals_are_joined_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(C, "BLOCK", 4)
    done = spark.createDataFrame([], C._INTERVALS)
    for numbers in (range(0, 30), range(35, 64), range(30, 35)):
        claims = spark.createDataFrame([(n // 4, 0, n, n) for n in numbers], C._CLAIMS)
        done = spark.createDataFrame(C.merged_intervals(done, claims).collect(), C._INTERVALS)
    assert sorted((r.lo, r.hi) for r in done.collect()) == [(0, 15), (16, 31), (32, 47), (48, 63)]  # one a group of 4 blocks


def test_a_stream_of_files_is_followed(spark, tmp_path):
    from corpusloom.streaming.feed_stream import follow

    runs = [run(1, 2), run(2, 5)]
    schema = "feed_seq long, id string, url string, raw_json string, collect_count int, updated_at timestamp, loaded_at timestamp"
    store = C.ChangeFeedStore(spark, f"file://{tmp_path}/s")
    rows = [(1, "a", "u", '{"x":1}', 1, at(1), at(1)), (2, "a", "u", '{"x":2}', 1, at(3), at(3)), (3, "b", "u", '{"x":1}', 1, at(9), at(9))]
    for known in (1, 2):
        spark.createDataFrame(rows[known - 1 : known + 1], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/feed")
        log = spark.createDataFrame(runs[:known], RUNS)
        for _ in range(2):  # the second time there is no new file
            follow(spark, f"{tmp_path}/feed", store, lambda log=log: log, f"{tmp_path}/checkpoint").awaitTermination()
    assert net(store) == {(1, "a"), (2, "a")}
