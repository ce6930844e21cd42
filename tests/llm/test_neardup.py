import random
import re

import numpy as np
import pytest

from corpusloom.llm import classes
from corpusloom.llm import neardup as N
from corpusloom.llm.hamming_trie import trie_self_join
from corpusloom.llm.shingles import hash_words, sequence_hash, shingle

RULE = N.NearDupRule(words=3, threshold=0.7)


@pytest.mark.parametrize("budget", [0, 3, 20, 35])
def test_trie_equals_brute_force(budget):
    rng = np.random.default_rng(budget)
    base = rng.integers(0, 2, (20, 128))
    bits = np.array([b ^ (rng.random(128) < rng.choice([0, 0.02, 0.1, 0.2])) for b in base for _ in range(12)], np.uint8)
    codes = np.packbits(bits, axis=1).view(">u8").astype(np.uint64)
    order = np.lexsort((codes[:, 1], codes[:, 0]))
    high, low, bits = codes[order, 0].copy(), codes[order, 1].copy(), bits[order]
    whole = np.array([[0, len(bits)]])
    got = [(int(a), int(b)) for i, j in trie_self_join(high, low, whole, whole, budget) for a, b in zip(i, j)]
    far = (bits[:, None, :] != bits[None]).sum(axis=2)
    want = {(i, j) for i in range(len(bits)) for j in range(i + 1, len(bits)) if far[i, j] <= budget}
    assert len(got) == len(set(got)) and {tuple(sorted(p)) for p in got} == want


def test_words_and_sequences():
    texts = ["Hello, WORLD 42!", None, "", "  ", "éa-b\nc", "hello world 42", "Kelvin K", "x" * 5000]
    words = hash_words(texts)
    real = [re.findall("[a-z0-9]+", (t or "").lower()) for t in texts]
    assert np.diff(words.offsets).tolist() == [len(r) for r in real]
    assert len(np.unique(words.hashes)) == len({w for r in real for w in r})
    first, _ = sequence_hash(words)
    assert first[0] == first[5] and first[0] != first[4] and first[1] == first[2]
    assert np.diff(shingle(words, 3).offsets).tolist() == [max(0, len(r) - 2) for r in real]


def test_long_texts_are_hashed_in_blocks(monkeypatch):
    texts = ["ab cd-ef " * 40, "x" * 300, None, "é1 " * 90]
    whole = hash_words(texts)
    monkeypatch.setattr("corpusloom.llm.shingles.BLOCK", 16)
    cut = hash_words(texts)
    assert (whole.hashes == cut.hashes).all() and (whole.offsets == cut.offsets).all()


def brute(rows, rule):
    sets = {}
    for kind, key, text in rows:
        words = re.findall("[a-z0-9]+", (text or "").lower())
        if key is not None and len(words) >= rule.min_words:
            sets.setdefault((kind, key), {tuple(words[i : i + rule.words]) for i in range(len(words) - rule.words + 1)})
    keys = sorted(sets)
    return {(a[0], a[1], b[1]) for i, a in enumerate(keys) for b in keys[i + 1 :] if a[0] == b[0] and len(sets[a] & sets[b]) >= rule.threshold * len(sets[a] | sets[b])}


def corpus(seed=0, families=25):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows = []
    for f in range(families):
        words = rng.choices(vocabulary, k=rng.choice([21, 60, 300]))
        for v in range(rng.choice([1, 2, 5])):
            edited = list(words)
            for _ in range(rng.randrange(0, 1 + len(words) // 14)):
                edited[rng.randrange(len(edited))] = rng.choice(vocabulary)
            rows.append((rng.choice(["page", "chunk"]), f"{f:03}-{v}", " ".join(edited)))
    rows += [("page", f"copy{i}", rows[0][2].upper() + "!") for i in range(6)]
    rows += [("page", "null", None), ("page", "empty", ""), ("page", "short", "a b c"), ("page", None, rows[1][2]), rows[2], ("page", "repeat", "la " * 50), ("page", "repeat2", "la " * 90)]
    return rows


def test_pairs_equal_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "record_kind string, id string, text string, keys int, c1 string, s1 int")
    dups = N.near_duplicates(df, RULE)
    got = [tuple(r) for r in dups.pairs().collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows, RULE)
    groups = {(r.record_kind, r.id): r for r in dups.groups().collect()}
    assert groups[("page", "copy0")].copies >= 6 and groups[("page", "copy0")].class_id == groups[("page", "copy5")].class_id


def test_hot_tries_and_classes_are_split(spark, monkeypatch):
    """With tiny limits every trie is spread over tasks; the pairs stay the same."""
    rows = corpus(3, 12)
    monkeypatch.setattr(N, "HOT", 2)
    monkeypatch.setattr(N, "JOIN_ROWS", 64)
    df = spark.createDataFrame(rows, "record_kind string, id string, text string")
    assert {tuple(r) for r in N.near_duplicates(df, RULE).pairs().collect()} == brute(rows, RULE)
    whole = {tuple(r) for r in N.near_duplicates(df, RULE).groups().collect()}
    monkeypatch.setattr(classes, "COPIES", 2)
    for broadcast in (0, 100):
        monkeypatch.setattr(N, "BROADCAST_ROWS", broadcast)
        monkeypatch.setattr(classes, "BROADCAST_ROWS", broadcast)
        dups = N.near_duplicates(df, RULE)
        assert {tuple(r) for r in dups.pairs().collect()} == brute(rows, RULE)
        assert {tuple(r) for r in dups.groups().collect()} == whole


def test_empty(spark):
    df = spark.createDataFrame([], "record_kind string, id string, text string")
    dups = N.near_duplicates(df, RULE)
    assert dups.pairs().count() == 0 and dups.groups().count() == 0


def test_recall_at_the_threshold():
    """Pairs just above the threshold meet in some band and stay within the budget."""
    rng = np.random.default_rng(1)
    met = 0
    for k in range(200):
        shared = rng.integers(0, 2**63, 142, dtype=np.uint64)
        sets = [np.concatenate([shared, rng.integers(0, 2**63, 30, dtype=np.uint64)]) for _ in range(2)]
        m = N.min_hashes(np.concatenate(sets), np.array([0, 172, 344]))
        bands = any((m[0, b * 3 : b * 3 + 3] == m[1, b * 3 : b * 3 + 3]).all() for b in range(RULE.bands))
        near = int(((N._fmix32(m[0]) ^ N._fmix32(m[1])) & 1).sum()) <= RULE.budget
        met += bands and near
    assert met >= 198


def test_a_trie_of_equal_codes_is_split(spark, monkeypatch):
    monkeypatch.setattr(N, "HOT", 64)
    rng = np.random.default_rng(4)
    hashes = rng.integers(-(2**62), 2**62, (1000, 2)).tolist()
    rows = spark.createDataFrame([(7, a, b, 5, 9) for a, b in hashes], "key long, c1 long, c2 long, s1 long, s2 long")
    largest = N._spread_hot(rows).groupBy("key", "p", "q").count().agg({"count": "max"}).first()[0]
    assert largest <= 2 * 64
    pairs = N.candidate_pairs(spark.createDataFrame([(a, b, [7], 5, 9) for a, b in hashes[:200]], "c1 long, c2 long, keys array<long>, s1 long, s2 long"), 0)
    assert pairs.count() == 200 * 199 // 2


def test_kinds_are_told_by_their_whole_names(spark):
    text = " ".join(f"w{i}" for i in range(40))
    kinds = ["documents_a", "documents_b", None, "", "\0"]
    df = spark.createDataFrame([(kind, f"{i}{side}", text) for i, kind in enumerate(kinds) for side in "ab"], "record_kind string, id string, text string")
    pairs = N.near_duplicates(df, RULE).pairs().collect()
    assert {(r.record_kind, r.id_a, r.id_b) for r in pairs} == {(kind, f"{i}a", f"{i}b") for i, kind in enumerate(kinds)}


def test_a_family_of_near_copies_is_spread(spark):
    """50,000 classes with one code, as in a family of near-copies: no task gets more than two blocks of it."""
    rows = spark.range(50_000).selectExpr("7L key", "xxhash64(id) c1", "xxhash64(id, 1) c2", "5L s1", "9L s2")
    tasks = N._spread_hot(rows).groupBy("key", "p", "q").count().selectExpr("max(count) most", "count(*) tasks").first()
    assert tasks.most <= 1.2 * N.HOT and tasks.tasks == 49 * 50 // 2


def test_no_text_is_shuffled(spark, tmp_path):
    """Texts are reduced to shingle sets in the tasks that scan them, whatever the number of candidates."""
    spark.createDataFrame(corpus(), "record_kind string, id string, text string").write.parquet(f"{tmp_path}/t")
    records = spark.read.parquet(f"{tmp_path}/t")
    sets = N.shingle_sets(records, records.select("record_kind", "id").limit(3), RULE)
    plan = sets._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Exchange" not in plan and "Join" not in plan


def test_filter_misses_no_key(spark, monkeypatch):
    keys = np.random.default_rng(0).integers(-(2**63), 2**63 - 1, 4000)
    some = spark.createDataFrame([(int(k),) for k in keys[:1000]], "key long")
    known = N.key_filter(some)
    assert known.may_hold(keys[:1000]).all() and known.may_hold(keys[1000:]).mean() < 0.01
    monkeypatch.setattr(N, "FILTER_BITS", 1 << 10)  # too few bits: more pass, none is missed
    assert N.key_filter(some).may_hold(keys[:1000]).all()
    assert not N.key_filter(some.limit(0)).may_hold(keys).any()


def test_low_thresholds_have_min_hashes_for_every_band():
    rule = N.NearDupRule(words=3, threshold=0.4)
    texts = [" ".join(f"w{i}" for i in range(a, a + 60)) for a in (0, 20)]
    _, _, _, keys, _, _ = N.sketch(texts, 1, rule)
    assert rule.bands > 42 and keys.shape == (2, rule.bands) and len(np.unique(keys[0])) == rule.bands
