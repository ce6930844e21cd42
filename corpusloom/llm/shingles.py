"""Vectorised words and word shingles of many texts at once.

The texts of a batch are laid end to end as UTF-8; words are runs of ``a-z0-9`` in the lower-cased text. Word hashes come from one
prefix sum of a polynomial over the whole buffer, shingle hashes from the word hashes, so no Python runs per word.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np

_WORD = np.zeros(256, bool)
_WORD[list(b"abcdefghijklmnopqrstuvwxyz0123456789")] = True
_GAP = re.compile(rb"[^a-z0-9]")
BLOCK = 1 << 20
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        tables = []
        for base in (_BASE, _INVERSE):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            tables.append(np.cumprod(steps, dtype=np.uint64))
        _powers = (tables[0], tables[1])
    return _powers


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of 64-bit values (two rounds of xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    hashes: np.ndarray  # uint64, one per word, texts one after another
    offsets: np.ndarray  # of each text's first word, and the end


def _blocks(part: bytes) -> list[bytes]:
    """A long text cut between words into blocks of about BLOCK bytes."""
    if len(part) <= BLOCK:
        return [part]
    out, at = [], 0
    while at < len(part):
        gap = _GAP.search(part, at + BLOCK)
        end = gap.start() if gap else len(part)
        out.append(part[at:end])
        at = end
    return out


def hash_words(texts: list[str | None]) -> Words:
    """Hashes of the words of each text; a NULL text has none."""
    hashes, counts = [], np.zeros(len(texts), np.int64)
    held: list[tuple[int, bytes]] = []
    size = 0
    for i, t in enumerate(texts):
        for block in _blocks((t or "").lower().encode("utf-8", "surrogatepass")):
            held.append((i, block))
            size += len(block)
            if size >= BLOCK:
                hashes.append(_hash_blocks(held, counts))
                held, size = [], 0
    if held:
        hashes.append(_hash_blocks(held, counts))
    return Words(np.concatenate(hashes) if hashes else np.empty(0, np.uint64), np.r_[0, np.cumsum(counts)])


def _hash_blocks(blocks: list[tuple[int, bytes]], counts: np.ndarray) -> np.ndarray:
    """Hashes of all words of the blocks, in order; adds each text's number of words to ``counts``."""
    b = np.frombuffer(b" ".join(x for _, x in blocks) + b" ", np.uint8)
    size = np.fromiter((len(x) for _, x in blocks), np.int64, len(blocks))
    start = np.r_[0, np.cumsum(size + 1)]
    word = _WORD[b]
    edge = np.flatnonzero(np.diff(word, prepend=False, append=False))
    first, last = edge[0::2], edge[1::2]
    power, inverse = power_tables(len(b))
    prefix = np.empty(len(b) + 1, np.uint64)
    prefix[0] = 0
    np.cumsum((b + np.uint64(1)) * power[: len(b)], dtype=np.uint64, out=prefix[1:])
    hashes = mix64((prefix[last] - prefix[first]) * inverse[first] + (last - first).astype(np.uint64))
    np.add.at(counts, [i for i, _ in blocks], np.diff(np.searchsorted(first, start)))
    return hashes


@dataclass
class Shingles:
    hashes: np.ndarray  # uint64, in order of the text, repeats included
    offsets: np.ndarray


def shingle(words: Words, k: int) -> Shingles:
    """Hashes of runs of ``k`` words within each text."""
    h, off = words.hashes, words.offsets
    count = np.maximum(np.diff(off) - (k - 1), 0)
    offsets = np.r_[0, np.cumsum(count)]
    total = int(offsets[-1])
    if not total:
        return Shingles(np.empty(0, np.uint64), offsets)
    at = np.arange(total) + np.repeat(off[:-1] - offsets[:-1], count)
    x = h[at]
    for j in range(1, k):
        x = mix64(x * np.uint64(0xD6E8FEB86659FD93) + h[at + j])
    return Shingles(mix64(x), offsets)


def sequence_hash(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of each text's sequence of words; equal sequences have equal hashes."""
    n = len(words.offsets) - 1
    count = np.diff(words.offsets)
    place = np.arange(len(words.hashes)) - np.repeat(words.offsets[:-1], count)
    power, _ = power_tables(int(count.max(initial=0)) + 1)
    out = []
    for salt in (0x243F6A8885A308D3, 0x13198A2E03707344):
        term = mix64(words.hashes ^ np.uint64(salt)) * power[place]
        total = np.zeros(n, np.uint64)
        has = count > 0
        if has.any():
            total[has] = np.add.reduceat(term, words.offsets[:-1][has])
        out.append(mix64(total ^ count.astype(np.uint64)))
    return out[0], out[1]
