"""Statistics of whole texts that tell natural prose from lists, tables and junk, for many texts at once.

The texts of a block are laid end to end as code points. Kinds of characters come from a table; separators, words, segments, lines and cells
are runs found in the whole block; a prefix sum of a polynomial gives the hash of any run. Python runs once a text for its compressed size only.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

from corpusloom.llm.shingles import mix64, power_tables

FEATURES = (
    "log_words",
    "mean_word_length",
    "symbol_ratio",
    "digit_ratio",
    "punctuated_lines",
    "common_words",
    "running_share",
    "sentence_ends",
    "vowel_share",
    "capital_share",
    "single_letters",
    "compression",
    "repeated_segments",
    "log_line_length",
    "item_lines",
    "long_lines",
)

BLOCK_CHARS = 1 << 19

_SEPARATORS = "\n\t|;,•*>(){}[]=<\"#_/~—–:"
_STOPS = ".!?。！？…、"  # separate where white space, the end or a character beyond ASCII follows
_ENDS = ".!?。！？"
_AFTER_END = "\"'”’)»"
_LINE_ENDS = ".!?。！？:;\"”’)"
_BULLETS = "-*•+>"
_CELL_ENDS = "\n\t|"
_FIELD_MARKS = "|=:"
_VOWELS = frozenset("aeiouyäöüáàâéèêëíìîïóòôúùûœæ")
_PLAIN = frozenset(" \t\r\n.,;:!?'\"’“”()-。、！？「」…")

_KINDS = ("alpha", "digit", "space", "upper", "symbol", "hiragana", "unspaced", "latin", "vowel")
_SETS = {"separator": _SEPARATORS, "stop": _STOPS, "end": _ENDS, "after_end": _AFTER_END, "line_end": _LINE_ENDS, "bullet": _BULLETS, "cell_end": _CELL_ENDS, "mark": _FIELD_MARKS}


@dataclass(frozen=True)
class _Tables:
    """By character below U+10000: the number of its combination of kinds, its lower case, and sets as bits of one number."""

    combination: np.ndarray
    kinds: np.ndarray  # combinations x kinds
    lower: np.ndarray
    bits: np.ndarray


_BIT = {name: np.uint16(1 << k) for k, name in enumerate([*_SETS, "space", "word", "alpha", "hiragana"])}


@lru_cache
def _tables() -> _Tables:
    combinations: dict[tuple[bool, ...], int] = {}
    table, lower, bits = np.zeros(1 << 16, np.uint8), np.arange(1 << 16, dtype=np.uint32), np.zeros(1 << 16, np.uint16)
    for code in range(1 << 16):
        c = chr(code)
        alpha, space, small = c.isalpha(), c.isspace(), c.lower()
        hiragana = "ぁ" <= c <= "ゟ"
        key = (
            alpha,
            c.isdigit(),
            space,
            c.isupper(),
            not c.isalnum() and not space and c not in _PLAIN,
            hiragana,
            "぀" <= c <= "ヿ" or "一" <= c <= "鿿",
            alpha and code < 0x250,
            small in _VOWELS,
        )
        table[code] = combinations.setdefault(key, len(combinations))
        if len(small) == 1:
            lower[code] = ord(small)
        bits[code] = space * _BIT["space"] | (c.isalnum() or c == "_") * _BIT["word"] | alpha * _BIT["alpha"] | hiragana * _BIT["hiragana"]
    for name, characters in _SETS.items():
        for c in characters:
            bits[ord(c)] |= _BIT[name]
    return _Tables(table, np.array(list(combinations), dtype=np.int64), lower, bits)


class CommonWords:
    """Frequent words of each language, as hashes."""

    def __init__(self, languages: tuple[frozenset[str], ...]):
        self.languages = len(languages)
        words = sorted(set().union(*languages)) if languages else []
        points = [np.array([ord(c) for c in w], np.uint32) for w in words]
        hashes = np.array([int(_run_hashes(_prefix(p), np.array([0]), np.array([len(p)]))[0]) for p in points], np.uint64)
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        self.holds = np.array([[w in one for one in languages] for w in words], bool).reshape(len(words), len(languages))[order]

    def lookup(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions of the words that are common in some language, their rows in ``holds``)."""
        if not len(self.hashes):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        known = np.flatnonzero(self.hashes[at] == hashes)
        return known, at[known]


def _prefix(points: np.ndarray) -> np.ndarray:
    power, _ = power_tables(len(points) + 1)
    out = np.zeros(len(points) + 1, np.uint64)
    np.cumsum((points + np.uint64(1)) * power[: len(points)], dtype=np.uint64, out=out[1:])
    return out


def _run_hashes(prefix: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    _, inverse = power_tables(len(prefix))
    return mix64((prefix[last] - prefix[first]) * inverse[first] + (last - first).astype(np.uint64))


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of true values."""
    edge = np.flatnonzero(mask[1:] != mask[:-1]) + 1
    if mask[0]:
        edge = np.r_[0, edge]
    if mask[-1]:
        edge = np.r_[edge, len(mask)]
    return edge[0::2], edge[1::2]


def _fill(mask: np.ndarray, first: np.ndarray, last: np.ndarray) -> None:
    """Set the (disjoint) runs in ``mask``."""
    size = last - first
    mask[np.repeat(first - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())] = True


def _blocks(texts: list[str]) -> Iterator[tuple[int, int]]:
    at, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= BLOCK_CHARS:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def batch_statistics(texts: list[str], common: CommonWords) -> np.ndarray:
    """The figures named in FEATURES, one row a text; a blank text has zeros. The language of best fit counts.

    Languages written without spaces have no list: there the share of hiragana stands for the common words.
    """
    out = np.zeros((len(texts), len(FEATURES)))
    for a, b in _blocks(texts):
        rows = [i for i in range(a, b) if texts[i].strip()]
        if rows:
            out[rows] = _block_statistics([texts[i] for i in rows], common)
    return out


def _block_statistics(texts: list[str], common: CommonWords) -> np.ndarray:
    tables, n = _tables(), len(texts)
    size = np.fromiter(map(len, texts), np.int64, n)
    u = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)  # every text has a line feed behind it
    start = np.r_[0, np.cumsum(size + 1)[:-1]]
    doc = np.repeat(np.arange(n, dtype=np.int32), size + 1)
    low16 = np.minimum(u, 0xFFFF)  # what lies beyond counts as U+FFFF does, as a symbol
    bits = tables.bits[low16]
    is_ = lambda name, x=bits: (x & _BIT[name]) != 0
    per_doc = lambda where, weights=None: np.bincount(where, weights, minlength=n)

    kinds = np.bincount(doc * len(tables.kinds) + tables.combination[low16], minlength=n * len(tables.kinds)).reshape(n, -1) @ tables.kinds
    letters, digits, spaces, upper, symbols, hiragana, unspaced, latin, vowels = (kinds[:, _KINDS.index(k)] for k in _KINDS)
    visible = np.maximum(size - (spaces - 1), 1)
    eastern = unspaced > 0.3 * visible

    # separators, then the segments between them and their words
    space, separator = is_("space"), is_("separator")
    after = np.r_[bits[1:], bits[-1:]]
    beyond = np.r_[u[1:] > 127, False]
    first, last = _runs(is_("stop"))
    cut = ((bits[last] & _BIT["space"]) != 0) | (u[last] > 127)
    _fill(separator, first[cut], last[cut])
    blank = u == 32
    wide_first, wide_last = _runs(blank)
    gap = wide_last - wide_first >= 3
    _fill(separator, wide_first[gap], wide_last[gap])
    dash = 1 + np.flatnonzero((u[1:-1] == 45) | (u[1:-1] == 43))
    dash = dash[blank[dash - 1] & blank[dash + 1] & ~separator[dash - 1]]
    place = np.arange(len(dash))
    alone = np.r_[True, np.diff(dash) != 2][: len(dash)]
    dash = dash[(place - np.maximum.accumulate(np.where(alone, place, 0))) % 2 == 0] - 1  # one blank does not stand on both sides
    for k in range(3):
        separator[dash + k] = True
    word_first, word_last = _runs(~(separator | space))
    lower = np.where(u < 1 << 16, tables.lower[low16], u)
    prefix = _prefix(lower)
    hashes = _run_hashes(prefix, word_first, word_last)
    word_doc = doc[word_first]
    words = per_doc(word_doc)
    count = np.maximum(words, 1)
    length = word_last - word_first
    known, row = common.lookup(hashes)
    hits = np.zeros((n, max(common.languages, 1)), np.int64)
    for k in range(common.languages):
        hits[:, k] = per_doc(word_doc[known[common.holds[row, k]]])
    best = hits.argmax(axis=1)
    frequent = np.zeros(len(word_first), bool)
    if len(known):
        frequent[known] = common.holds[row, best[word_doc[known]]]
    unhir = hiragana / np.maximum(unspaced, 1)
    share = np.where(eastern, np.minimum(1.0, 1.2 * hiragana / visible), hits.max(axis=1) / count)
    word_count = np.where(eastern, np.maximum(words, unspaced // 2), words)
    mean_length = np.where(eastern, np.minimum(2.0 + 3 * (1 - unhir), 8.0), np.minimum(per_doc(word_doc, length) / count, 40.0))
    single = per_doc(word_doc[(length == 1) & is_("alpha", bits[word_first])]) / count

    # segments of several words with enough common ones run on as language does
    running, repeated = np.zeros(n), np.zeros(n)
    total = np.zeros(n)
    if len(word_first):
        number = np.cumsum(separator, dtype=np.int32)[word_first]
        head = np.flatnonzero(np.r_[True, number[1:] != number[:-1]])
        many = np.diff(np.r_[head, len(number)])
        seg_first, seg_last = word_first[head], word_last[head + many - 1]
        seg_doc, seg_size = word_doc[head], seg_last - seg_first
        seg_hits = np.add.reduceat(frequent, head, dtype=np.int64)
        upto = np.r_[0, np.cumsum(is_("hiragana"), dtype=np.int64)]
        runs_on = np.where(eastern[seg_doc], (seg_size >= 6) & (upto[seg_last] - upto[seg_first] >= 0.2 * seg_size), (many >= 4) & (seg_hits >= 0.2 * many))
        seg_hash = _run_hashes(prefix, seg_first, seg_last)
        order = np.lexsort((seg_hash, seg_doc))
        again = np.zeros(len(order), bool)
        again[order[1:]] = (seg_hash[order[1:]] == seg_hash[order[:-1]]) & (seg_doc[order[1:]] == seg_doc[order[:-1]])
        total = per_doc(seg_doc, seg_size)
        running, repeated = per_doc(seg_doc[runs_on], seg_size[runs_on]), per_doc(seg_doc[again], seg_size[again])

    # lines, without the white space around them
    ink_first, ink_last = _runs(~space)
    feeds = np.flatnonzero(u == 10)
    stop = np.searchsorted(ink_first, feeds)
    begin = np.r_[0, stop[:-1]]
    filled = begin < stop
    line_first, line_last = ink_first[begin[filled]], ink_last[stop[filled] - 1] - 1
    line_doc, line_size = doc[line_first], line_last - line_first + 1
    lines = per_doc(line_doc)
    weight = np.maximum(per_doc(line_doc, line_size), 1)
    closed = is_("line_end", bits[line_last])
    items = _item_lines(u, bits, line_first, line_last)

    # cells: between line feeds, tabs, bars and wide gaps, from the first to the last visible character of a text
    cell_end = is_("cell_end")
    _fill(cell_end, wide_first[gap], wide_last[gap])
    doc_first = ink_first[np.searchsorted(ink_first, start)]
    doc_last = ink_last[np.searchsorted(ink_first, start + size) - 1] - 1
    edges = np.zeros(len(u) + 1, np.int8)
    edges[doc_first] += 1
    edges[doc_last + 1] -= 1
    cell_first, cell_last = _runs(~cell_end & (np.cumsum(edges[:-1]) > 0))
    cell_doc, cell_size = doc[cell_first], cell_last - cell_first
    blanks = np.r_[0, np.cumsum(blank, dtype=np.int64)]
    broad = np.where(eastern[cell_doc], cell_size >= 24, blanks[cell_last] - blanks[cell_first] >= 9)

    ends = is_("end") & (is_("space", after) | is_("after_end", after) | beyond)
    sentences = per_doc(doc[ends])
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    packed = np.fromiter((len(zlib.compress(r, 1)) / max(len(r), 40) for r in raw), float, n)
    return np.column_stack(
        [
            np.log1p(word_count),
            mean_length,
            symbols / visible,
            digits / visible,
            per_doc(line_doc[closed], line_size[closed]) / weight,
            share,
            running / np.maximum(total, 1),
            np.minimum(sentences / np.maximum(word_count, 1) * 10, 3.0),
            np.where(latin > 0.3 * visible, vowels / np.maximum(latin, 1), 0.38),
            np.where((letters > 0.3 * visible) & ~eastern, upper / np.maximum(letters, 1), 0.05),
            np.where(eastern, 0.05, single),
            np.minimum(packed, 1.2),
            repeated / np.maximum(total, 1),
            np.log1p(size / np.maximum(lines, 1)),
            per_doc(line_doc[items], line_size[items]) / weight,
            per_doc(cell_doc[broad], cell_size[broad]) / np.maximum(per_doc(cell_doc, cell_size), 1),
        ]
    )


def _item_lines(u: np.ndarray, bits: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Which lines open with a bullet, a number or letter with a stop or bracket, or a name with a mark behind it."""
    at = lambda p: np.minimum(p, len(u) - 1)
    has = lambda p, name: (p <= last) & ((bits[at(p)] & _BIT[name]) != 0)
    code = lambda p: np.where(p <= last, u[at(p)], 0)
    out = has(first, "bullet") & has(first + 1, "space")
    head = first + (code(first) == ord("("))
    fits = np.ones(len(first), bool)
    for k in range(3):
        c = code(head + k)
        fits &= ((c >= 48) & (c <= 57)) | ((c >= 97) & (c <= 122))
        c = code(head + k + 1)
        out |= fits & ((c == ord(".")) | (c == ord(")"))) & has(head + k + 2, "space")
    other = np.flatnonzero(((bits & _BIT["word"]) == 0) & (u != 32))  # the first character that is no part of a name
    mark = np.r_[other, len(u)][np.searchsorted(other, first)]
    before = at(np.maximum(mark - 1, 0))
    return out | (has(mark, "mark") & (mark - 1 > first) & (u[before] == 32) & has(mark + 1, "space"))
