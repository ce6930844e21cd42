import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm.mixing import balance, clean_source, mix_sources

TARGETS = "source string, target_share double, max_repeats int, note string"


def test_sources_are_cleaned(spark):
    df = spark.createDataFrame([(s,) for s in (" Release-Notes ", "release notes", "\tRELEASE_NOTES ", None)], "s string")
    assert [r[0] for r in df.select(clean_source(F.col("s"))).collect()] == ["release_notes"] * 3 + [None]


def test_shares_are_met(spark):
    rng = np.random.default_rng(0)
    rows = [(i, ["a", "A ", "b", "c", "small", "other", None][k], int(t)) for i, (k, t) in enumerate(zip(rng.choice(7, 6000, p=[0.3, 0.1, 0.2, 0.2, 0.01, 0.15, 0.04]), rng.lognormal(5, 1, 6000)))]
    df = spark.createDataFrame([(*r, "x") for r in rows], "key long, source string, tokens long, rate string")
    targets = spark.createDataFrame([("a", 0.3, 2, ""), ("b", 0.4, 5, ""), ("c", 0.1, 1, ""), ("small", 0.15, 3, ""), ("absent", 0.05, 4, "")], TARGETS)
    mix = mix_sources(df, targets)
    report = {r.source: r for r in mix.report.collect()}
    assert {s for s, r in report.items() if r.falls_short} == {"small", "absent"}
    for s in "abc":
        assert report[s].used_tokens == pytest.approx(report[s].target_tokens, rel=0.01)
    assert report["absent"].actual_share == 0 and sum(r.actual_share for r in report.values()) == pytest.approx(1)
    copies = mix.copies.collect()
    caps = {"a": 2, "b": 5, "c": 1, "small": 3}
    assert all(0 <= r.copies <= caps[r.source] for r in copies)
    assert all(r.copies == 3 for r in copies if r.source == "small")
    # rates are exponential in the tokens below the cap
    b = [(r.tokens, np.log(r.rate)) for r in copies if r.source == "b" and 0 < r.rate < 4.999]
    slope = np.array([y / x for x, y in b if x])
    assert np.ptp(slope) < 1e-6 * abs(slope).max() + 1e-12


def test_edges(spark):
    targets = spark.createDataFrame([("a", 0.5, 1, ""), ("b", 0.5, 0, ""), ("z", 0.0, 2, ""), (None, 0.1, 1, "")], TARGETS)
    empty = spark.createDataFrame([], "key long, source string, tokens long")
    report = {r.source: r for r in mix_sources(empty, targets).report.collect()}
    assert set(report) == {"a", "b", "z"} and all(r.actual_share == 0 for r in report.values())
    rows = [(1, "a", 10), (1, "a", 10), (2, "b", 30), (3, "z", 7), (4, "a", 0)]
    mix = mix_sources(spark.createDataFrame(rows, "key long, source string, tokens long"), targets)
    report = {r.source: r for r in mix.report.collect()}
    assert report["a"].falls_short and report["b"].falls_short and report["b"].used_tokens == 0
    assert report["z"].used_tokens == 0 and not report["z"].falls_short
    assert mix_sources(spark.createDataFrame(rows, "key long, source string, tokens long"), targets.where("false")).report.count() == 0


def test_short_sources_are_those_whose_dual_has_no_solution(spark):
    counts = spark.createDataFrame([("a", 10, 5), ("a", 0, 3), ("b", 10, 5), ("c", 7, 1), ("d", 0, 4)], "source string, tokens long, n long")
    lam, short = balance(counts, {"a": 99.0, "b": 101.0, "c": 14.0, "d": 1.0, "none": 1.0, "idle": 0.0}, dict.fromkeys("abcd", 2.0) | {"none": 1.0, "idle": 1.0}, 8.0)
    assert short == {"b", "d", "none"}  # 2 x 50 tokens are less than 101, but not than 99; c needs all it may give
    assert 5 * 10 * min(2, np.exp(lam["a"] * 10 / 8)) == pytest.approx(99)


def test_large_target_tables_are_joined_without_broadcast(spark, monkeypatch):
    rows = spark.createDataFrame([(i, f"s{i % 4}", 10 + i % 7) for i in range(400)], "key long, source string, tokens long")
    targets = spark.createDataFrame([(f"s{k}", s, 3, "") for k, s in enumerate((0.1, 0.2, 0.3, 0.4))], TARGETS)
    want = {r.source: r.used_tokens for r in mix_sources(rows, targets).report.collect()}
    monkeypatch.setattr("corpusloom.llm.mixing.BROADCAST_ROWS", 0)
    assert {r.source: r.used_tokens for r in mix_sources(rows, targets).report.collect()} == want
