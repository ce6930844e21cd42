"""Near-duplicate texts: binary sketches joined by a trie within a Hamming error budget, then verified exactly.

1. Each text is reduced in one scan to a 128-bit sketch (one bit of each of 128 min-hashes of its word shingles): two texts of
   similarity J differ in (1 - J) / 2 of the bits on average. Texts with the same sequence of words form a *class* that goes on as one.
2. A class is routed to ``bands`` tries, each keyed by three of its min-hashes; the trie self-join walks node pairs inside each.
   A trie of more than ``HOT`` classes is cut into blocks by a hash, whose pairs are tasks: no task holds an unbounded trie, however alike its codes.
3. Candidate pairs are verified on the full shingle sets; nothing depends on the sketch but which pairs are looked at.

The shuffles carry 40 bytes a class and band, and shingle sets of candidate classes, never texts: the second scan keeps the representatives of candidate
classes by a Bloom filter of at most ``FILTER_BITS`` bits (32 MB) and reduces them to their sets in place. What the filter lets through beside them
falls out of the join with the pairs.
No partner or bucket cap drops a pair. The routing and the error budget are probabilistic: at the threshold a pair is missed with
probability of about ``miss`` for the routing and 1e-4 for the budget, and far less above it.

Defined results: NULL and short texts (fewer than ``min_words`` words) take no part; texts of equal words are similarity 1; NULL ids
take no part; a repeated row with the same id makes no pair with itself; extra columns are ignored; an empty table gives no pairs.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.classes import BROADCAST_ROWS, every_part, large_classes, own_part, with_parts
from corpusloom.llm.hamming_trie import BITS, trie_self_join
from corpusloom.llm.shingles import hash_words, mix64, sequence_hash, shingle
from corpusloom.session import materialize, release

HOT = 2048  # classes in one trie task
SCAN_CHARS = 1 << 20
JOIN_ROWS = 1 << 17
FILTER_BITS = 1 << 28
KEY_BITS = 16  # of the filter for each key, while FILTER_BITS allow
BAND_ROWS = 3


@dataclass(frozen=True)
class NearDupRule:
    words: int = 5
    threshold: float = 0.8
    min_words: int = 20
    miss: float = 2e-4

    @property
    def bands(self) -> int:
        return math.ceil(math.log(self.miss) / math.log(1 - self.threshold**BAND_ROWS))

    @property
    def budget(self) -> int:
        p = (1 - self.threshold) / 2
        return math.ceil(BITS * p + 3.8 * math.sqrt(BITS * p * (1 - p)))


@lru_cache
def _hash_functions(count: int) -> tuple[np.ndarray, np.ndarray]:
    xor = np.random.default_rng(20240229).integers(0, 1 << 32, count, dtype=np.uint32)
    return xor, np.random.default_rng(20240301).integers(0, 1 << 31, count, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def _fmix32(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    x = (x ^ (x >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return x ^ (x >> np.uint32(16))


def min_hashes(hashes: np.ndarray, offsets: np.ndarray, count: int = BITS) -> np.ndarray:
    """(texts x count) minima over each text's shingles; no text may be empty."""
    xor, multiply = _hash_functions(count)
    out = np.empty((count, len(offsets) - 1), np.uint32)
    step = 1 << 14
    at = 0
    while at < len(offsets) - 1:  # runs of texts small enough for the cache
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + step, side="right")) - 1)
        x = (hashes[offsets[at] : offsets[end]] >> np.uint64(32)).astype(np.uint32)
        heads = (offsets[at:end] - offsets[at]).astype(np.int64)
        for k in range(count):
            out[k, at:end] = np.minimum.reduceat((x ^ xor[k]) * multiply[k], heads)
        at = end
    return np.ascontiguousarray(out.T)


def sketch(texts: list[str | None], salt: int, rule: NearDupRule) -> tuple[np.ndarray, ...]:
    """(index, class 1, class 2, band keys, code high, code low) of the texts that take part."""
    words = hash_words(texts)
    first, second = sequence_hash(words)
    grams = shingle(words, rule.words)
    count = np.diff(grams.offsets)
    part = np.flatnonzero((np.diff(words.offsets) >= max(rule.min_words, rule.words)) & (count > 0))
    if len(part) < len(count):
        keep = np.repeat(np.isin(np.arange(len(count)), part), count)
        hashes, offsets = grams.hashes[keep], np.r_[0, np.cumsum(count[part])]
    else:
        hashes, offsets = grams.hashes, grams.offsets
    m = min_hashes(hashes, offsets, max(BITS, rule.bands * BAND_ROWS))  # every band has min-hashes of its own
    bit = (_fmix32(m[:, :BITS]) & np.uint32(1)).astype(np.uint8)
    code = np.packbits(bit, axis=1).view(">u8").astype(np.uint64) if len(part) else np.empty((0, 2), np.uint64)
    keys = np.empty((len(part), rule.bands), np.uint64)
    for b in range(rule.bands):
        x = np.full(len(part), (salt * 1_000_003 + b) & (2**64 - 1), np.uint64)
        for r in range(BAND_ROWS):
            x = mix64(x ^ m[:, b * BAND_ROWS + r].astype(np.uint64))
        keys[:, b] = x
    return part, *_class_keys(first[part], second[part], salt), keys, code[:, 0], code[:, 1]


def _salt(kind: str | None) -> int:
    """Of all of a kind's name; NULL is a kind of its own."""
    return int.from_bytes(hashlib.blake2b(b"" if kind is None else b"=" + kind.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big")


def _class_keys(first: np.ndarray, second: np.ndarray, salt: int) -> tuple[np.ndarray, np.ndarray]:
    return mix64(first ^ np.uint64(salt)), mix64(second + np.uint64(salt))


def _runs(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    at, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= SCAN_CHARS:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


_SKETCH = "record_kind string, id string, c1 long, c2 long, keys array<long>, s1 long, s2 long"


def sketches(records: DataFrame, rule: NearDupRule) -> DataFrame:
    """One row for each text that takes part. ``records`` (record_kind, id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, ids, texts = (c.to_pylist() for c in batch.columns)
            for kind in dict.fromkeys(kinds):
                rows = [i for i, k in enumerate(kinds) if k == kind]
                salt = _salt(kind)
                for a, b in _runs([texts[i] for i in rows]):
                    some = rows[a:b]
                    part, c1, c2, keys, s1, s2 = sketch([texts[i] for i in some], salt, rule)
                    if not len(part):
                        continue
                    offsets = pa.array(np.arange(0, keys.size + 1, keys.shape[1]), pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([kind] * len(part)), pa.array([ids[some[i]] for i in part.tolist()], pa.string()), _long(c1), _long(c2), pa.ListArray.from_arrays(offsets, _long(keys.ravel())), _long(s1), _long(s2)],
                        names=["record_kind", "id", "c1", "c2", "keys", "s1", "s2"],
                    )

    source = records.select("record_kind", "id", "text").where(F.col("text").isNotNull() & F.col("id").isNotNull())
    return source.mapInArrow(run, _SKETCH)


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _spread_hot(rows: DataFrame) -> DataFrame:
    """Adds the task of each row, (key, p, q), and its block. A trie of more than HOT classes is cut into blocks, whose pairs are the tasks."""
    hot = materialize(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT), "hot-tries")
    plain = rows.withColumns({"p": F.lit(0), "q": F.lit(0), "block": F.lit(0)})
    n = hot.count()
    if not n:
        return plain
    known = rows.join(F.broadcast(hot) if n <= BROADCAST_ROWS else hot, "key", "left")
    blocks = F.coalesce(F.ceil(F.col("n") / math.ceil(HOT / 2)).cast("int"), F.lit(1))
    known = known.withColumn("blocks", blocks).withColumn("block", F.expr("cast(pmod(c2, blocks) as int)"))
    wide = known.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    return wide.select("key", "c1", "c2", "s1", "s2", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"), "block")


def _join_tries(rows: tuple[np.ndarray, ...], budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of row positions in the tasks of ``rows`` (key, p, q, block, s1, s2), each of them whole."""
    key, p, q, block, s1, s2 = rows
    order = np.lexsort((s2, s1, block, q, p, key))
    key, p, q, block, s1, s2 = (x[order] for x in (key, p, q, block, s1, s2))
    head = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (p[1:] != p[:-1]) | (q[1:] != q[:-1])])
    tail = np.r_[head[1:], len(key)]
    more = tail - head > 1
    head, tail = head[more], tail[more]
    if not len(head):
        return
    left = np.column_stack([head, tail])
    right = left.copy()
    for k in np.flatnonzero(p[head] != q[head]):  # two blocks: pairs across only
        a, b = head[k], tail[k]
        cut = a + int(np.searchsorted(block[a:b], q[a]))
        left[k], right[k] = (a, cut), (cut, b)
    filled = (left[:, 0] < left[:, 1]) & (right[:, 0] < right[:, 1])
    for i, j in trie_self_join(s1, s2, left[filled], right[filled], budget):
        yield order[i], order[j]


def candidate_pairs(classes: DataFrame, budget: int) -> DataFrame:
    """Distinct (a1, a2, b1, b2) of classes within the error budget in some trie. ``classes`` (c1, c2, keys, s1, s2)."""
    rows = classes.select(F.explode("keys").alias("key"), "c1", "c2", "s1", "s2")
    tasks = _spread_hot(rows).select("key", "p", "q", "block", "c1", "c2", "s1", "s2")
    placed = tasks.repartition("key", "p", "q").sortWithinPartitions("key", "p", "q")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush(block: np.ndarray) -> Iterator[pa.RecordBatch]:
            key, p, q, side, c1, c2, s1, s2 = block
            unsigned = (key, p, q, side, s1.view(np.uint64), s2.view(np.uint64))
            for i, j in _join_tries(unsigned, budget):
                swap = (c1[i] > c1[j]) | ((c1[i] == c1[j]) & (c2[i] > c2[j]))
                a, b = np.where(swap, j, i), np.where(swap, i, j)
                pairs = np.unique(np.column_stack([c1[a], c2[a], c1[b], c2[b]]), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in pairs.T], names=["a1", "a2", "b1", "b2"])

        size = 0
        for batch in batches:
            held.append(np.stack([np.asarray(c, dtype=np.int64) for c in batch.columns]))
            size += batch.num_rows
            if size < JOIN_ROWS:
                continue
            block = np.concatenate(held, axis=1)
            change = np.flatnonzero((block[:3, 1:] != block[:3, :-1]).any(axis=0))
            if not len(change):
                held = [block]
                continue
            cut = change[-1] + 1
            yield from flush(np.ascontiguousarray(block[:, :cut]))
            held, size = [block[:, cut:]], block.shape[1] - cut
        if held:
            yield from flush(np.ascontiguousarray(np.concatenate(held, axis=1)))

    return placed.mapInArrow(run, "a1 long, a2 long, b1 long, b2 long").distinct()


def _places(key: np.ndarray, bits: int, count: int) -> list[np.ndarray]:
    """The places of keys in a filter of ``bits`` (a power of two)."""
    x, step = mix64(key.view(np.uint64)), mix64(key.view(np.uint64) ^ np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    return [((x + np.uint64(k) * step) & np.uint64(bits - 1)).astype(np.int64) for k in range(count)]


@dataclass(frozen=True)
class KeyFilter:
    """A Bloom filter of 64-bit keys: no key is missed, others may pass."""

    words: np.ndarray
    count: int

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), bool)
        for place in _places(keys, len(self.words) * 64, self.count):
            out &= (self.words[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) == 1
        return out


def key_filter(keys: DataFrame) -> KeyFilter:
    """Of the column ``key`` (64-bit). Its words are put together where the keys are; the driver gets at most FILTER_BITS / 64 of them."""
    n = keys.count()
    bits = 1 << min(FILTER_BITS.bit_length() - 1, max(10, (n * KEY_BITS).bit_length()))
    count = min(4, max(1, round(0.69 * bits / max(n, 1))))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = np.concatenate(_places(np.asarray(batch.column(0), dtype=np.int64), bits, count))
            bit = np.uint64(1) << (place & 63).astype(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(place >> 6), _long(bit)], names=["word", "bit"])

    rows = keys.select("key").mapInArrow(spread, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    words = np.zeros(bits // 64, np.uint64)
    words[rows.column(0).to_numpy()] = rows.column(1).to_numpy().view(np.uint64)
    return KeyFilter(words, count)


def _row_key() -> Column:
    return F.xxhash64("record_kind", "id")


def shingle_sets(records: DataFrame, wanted: DataFrame, rule: NearDupRule) -> DataFrame:
    """(c1, c2, grams) of the classes of the rows in ``wanted`` (record_kind, id), and of some other rows."""
    known = records.sparkSession.sparkContext.broadcast(key_filter(wanted.select(_row_key().alias("key"))))
    source = records.select(_row_key().alias("key"), "record_kind", "text").where(F.col("text").isNotNull() & F.col("id").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.take(pa.array(np.flatnonzero(known.value.may_hold(np.asarray(batch.column(0), dtype=np.int64)))))
            kinds, texts = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for kind in dict.fromkeys(kinds):
                mine = [t for t, k in zip(texts, kinds) if k == kind]
                for a, b in _runs(mine):
                    words = hash_words(mine[a:b])
                    c1, c2 = _class_keys(*sequence_hash(words), _salt(kind))
                    grams = shingle(words, rule.words)
                    sets = [np.unique(grams.hashes[i:j]) for i, j in zip(grams.offsets, grams.offsets[1:])]
                    offsets = pa.array(np.r_[0, np.cumsum([len(s) for s in sets])], pa.int32())
                    yield pa.RecordBatch.from_arrays([_long(c1), _long(c2), pa.ListArray.from_arrays(offsets, _long(np.concatenate(sets)))], names=["c1", "c2", "grams"])

    return source.mapInArrow(run, "c1 long, c2 long, grams array<long>")


@dataclass
class NearDups:
    """``members`` (record_kind, id, c1, c2): the class of each text; ``links`` (a1, a2, b1, b2, similarity) between classes."""

    members: DataFrame
    links: DataFrame

    def pairs(self) -> DataFrame:
        """Every pair of rows: across linked classes, and within each class."""
        large = large_classes(self.members)
        m = with_parts(self.members, large, "c1", "c2").withColumn("part", own_part())
        a = m.select("record_kind", F.col("id").alias("ia"), F.col("c1").alias("a1"), F.col("c2").alias("a2"), "part")
        b = m.select(F.col("id").alias("ib"), F.col("c1").alias("b1"), F.col("c2").alias("b2"), "part")
        links = with_parts(self.links.select("a1", "a2", "b1", "b2"), large, "a1", "a2").withColumn("part", every_part()).drop("parts")
        left = links.join(a, ["a1", "a2", "part"]).select("b1", "b2", "record_kind", "ia")
        right = with_parts(left, large, "b1", "b2").withColumn("part", every_part()).drop("parts")
        across = right.join(b, ["b1", "b2", "part"]).where("ia <> ib").select("record_kind", "ia", "ib")
        return across.unionByName(_copies(m)).select("record_kind", F.least("ia", "ib").alias("id_a"), F.greatest("ia", "ib").alias("id_b")).distinct()

    def groups(self) -> DataFrame:
        """One row per text: its class and the number of other classes that it is linked with."""
        large = large_classes(self.members)
        degree = self.links.select(_both_ends()).groupBy("c.c1", "c.c2").agg(F.count(F.lit(1)).alias("links"))
        named = self.members.groupBy("c1", "c2").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("copies")).join(degree, ["c1", "c2"], "left")
        named = with_parts(named, large, "c1", "c2").withColumn("part", every_part()).drop("parts")
        rows = with_parts(self.members, large, "c1", "c2").withColumn("part", own_part()).drop("parts")
        return rows.join(named, ["c1", "c2", "part"]).select("record_kind", "id", "class_id", "copies", F.coalesce("links", F.lit(0)).cast("bigint").alias("links"))


def _both_ends() -> Column:
    """One row ``c`` (c1, c2) for each end of a pair of classes."""
    return F.explode(F.array(F.struct(F.col("a1").alias("c1"), F.col("a2").alias("c2")), F.struct(F.col("b1").alias("c1"), F.col("b2").alias("c2")))).alias("c")


def _copies(members: DataFrame) -> DataFrame:
    """Pairs within classes. ``members`` with parts and part."""
    left = members.select("record_kind", "c1", "c2", F.col("id").alias("ia"), "part")
    right = members.select("c1", "c2", F.col("id").alias("ib"), F.explode(F.expr("sequence(0, parts - 1)")).alias("part"))
    return left.join(right, ["c1", "c2", "part"]).where("ia < ib").select("record_kind", "ia", "ib")


def near_duplicates(records: DataFrame, rule: NearDupRule = NearDupRule()) -> NearDups:
    """Classes and links of all texts in ``records`` (record_kind, id, text) whose shingle sets share ``threshold`` of their union."""
    records = records.select("record_kind", "id", "text")
    base = materialize(sketches(records, rule), "sketches")
    members = base.select("record_kind", "id", "c1", "c2").distinct()
    classes = base.groupBy("c1", "c2").agg(F.first("keys").alias("keys"), F.first("s1").alias("s1"), F.first("s2").alias("s2"))
    pairs = materialize(candidate_pairs(classes, rule.budget), "candidates")
    touched = pairs.select(_both_ends()).select("c.*").distinct()
    stands = members.groupBy("c1", "c2").agg(F.min(F.struct("record_kind", "id")).alias("r"))
    wanted = materialize(stands.join(touched, ["c1", "c2"], "left_semi").select("r.*"), "representatives")
    sets = materialize(shingle_sets(records, wanted, rule).join(touched, ["c1", "c2"], "left_semi").dropDuplicates(["c1", "c2"]), "shingle-sets")  # repeated ids would repeat a set
    a = sets.select(F.col("c1").alias("a1"), F.col("c2").alias("a2"), F.col("grams").alias("ga"))
    b = sets.select(F.col("c1").alias("b1"), F.col("c2").alias("b2"), F.col("grams").alias("gb"))
    common = F.size(F.array_intersect("ga", "gb"))
    similarity = common / (F.size("ga") + F.size("gb") - common)
    checked = pairs.join(a, ["a1", "a2"]).join(b, ["b1", "b2"]).select("a1", "a2", "b1", "b2", similarity.alias("similarity"))
    links = materialize(checked.where(F.col("similarity") >= rule.threshold), "links")
    release(pairs, wanted, sets)
    return NearDups(members, links)
