"""Deeply nested JSON records as flat, linked tables, by vectorised structural indexing.

Many records are laid end to end in one byte buffer. Bitmaps of escapes, quotes, brackets and delimiters are built for the
whole buffer at once; a prefix sum of quotes tells strings from structure, a prefix sum of brackets gives every token's depth, and
sorting tokens by depth pairs brackets and links each token to the container it stands in. The grammar of JSON is
checked on the same token arrays, so a record counts only if it is one complete JSON object.

The work is one narrow stage: no shuffle, memory bounded by ``CHUNK_BYTES`` plus the largest record, any depth
(no recursion). Output rows carry the record's key, their own path and the path of the object above.

Defined results: NULL, blank, cut-off text and anything that is not an object give no rows; a JSON string is replaced by its text as
often as needed; NULL keys are kept as they are; repeated rows give repeated output rows; a field name that is repeated within one
object gives one row for each distinct path; further columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 1 << 22

_OTHER, _SPACE, _OPEN, _CLOSE, _COLON, _COMMA, _QUOTE = range(7)
_CLASS = np.zeros(256, np.uint8)
_CLASS[[9, 10, 13, 32]] = _SPACE
_CLASS[[ord("{"), ord("[")]] = _OPEN
_CLASS[[ord("}"), ord("]")]] = _CLOSE
_CLASS[ord(":")] = _COLON
_CLASS[ord(",")] = _COMMA
_CLASS[ord('"')] = _QUOTE
_ESCAPABLE = np.zeros(256, bool)
_ESCAPABLE[list(b'"\\/bfnrtu')] = True
_HEX = np.zeros(256, bool)
_HEX[list(b"0123456789abcdefABCDEF")] = True
_SCALAR = re.compile(rb"true|false|null|-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?")


def unwrap(text: str) -> str | None:
    """The text below any wrapping JSON strings; None if a wrapping string is damaged."""
    while text.lstrip(" \t\r\n")[:1] == '"':
        try:
            text = json.loads(text)
        except ValueError:
            return None
    return text


class StructuralIndex:
    """Token arrays of the records in ``texts``, one after another in a single buffer.

    ``valid`` says which records are one complete JSON object. Tokens of other records are dropped before linking.
    """

    def __init__(self, texts: list[bytes]):
        self.raw = b"\n".join(texts) + b"\n"
        b = np.frombuffer(self.raw, np.uint8)
        size = np.fromiter((len(t) for t in texts), np.int64, len(texts))
        start = np.r_[0, np.cumsum(size + 1)[:-1]] if len(texts) else np.empty(0, np.int64)
        self.valid = np.ones(len(texts), bool)
        self._start = start

        cls = _CLASS[b]
        escaped = self._escapes(b)
        quote = cls == _QUOTE
        quote[escaped] = False
        # an odd number of quotes leaves a string open: close it at the separator so that the next record is unharmed
        odd = np.add.reduceat(quote, start) % 2 == 1 if len(start) else np.empty(0, bool)
        self.valid[odd] = False
        quote[(start + size)[odd]] = True
        inside = (np.cumsum(quote, dtype=np.int32) & 1).astype(bool)
        outside = ~(inside | quote)
        self._check_strings(b, inside, escaped)

        scalar = outside & (cls == _OTHER)
        first = scalar.copy()
        first[1:] &= ~scalar[:-1]
        token = outside & (cls >= _OPEN) | (quote & inside) | first
        pos = np.flatnonzero(token)
        row = np.searchsorted(start, pos, side="right") - 1
        kind = cls[pos]
        ch = b[pos]
        step = (kind == _OPEN).astype(np.int32) - (kind == _CLOSE)
        level = np.cumsum(step, dtype=np.int64)
        has = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else np.empty(0, np.int64)
        self.valid[np.setdiff1d(np.arange(len(texts)), row[has])] = False
        if len(has):
            base = level[has] - step[has]
            level -= np.repeat(base, np.diff(np.r_[has, len(row)]))
            last = np.r_[has[1:], len(row)] - 1
            bad = (np.minimum.reduceat(level, has) < 0) | (level[last] != 0) | (ch[has] != ord("{"))
            self.valid[row[has][bad]] = False
        keep = self.valid[row]
        pos, row, kind, ch, level, step = (x[keep] for x in (pos, row, kind, ch, level, step))
        depth = level - (kind == _OPEN)  # of the container that a token stands in
        parent = self._link(pos, row, kind, ch, depth)
        ok = self._grammar(row, kind, ch, parent)
        self._check_scalars(b, pos[kind == _OTHER], row[kind == _OTHER], scalar)
        np.logical_and.at(self.valid, row, ok)
        self.pos, self.row, self.kind, self.ch, self.parent, self.depth = pos, row, kind, ch, parent, depth
        self._quotes = np.flatnonzero(quote)

    @staticmethod
    def _escapes(b: np.ndarray) -> np.ndarray:
        """Positions of characters that a backslash escapes."""
        at = np.flatnonzero(b == 92)
        if not len(at):
            return at
        head = np.r_[True, np.diff(at) > 1]
        nth = np.arange(len(at)) - np.maximum.accumulate(np.where(head, np.arange(len(at)), 0))
        return at[nth % 2 == 0] + 1  # every odd backslash of a run escapes what follows it

    def _fail(self, positions: np.ndarray) -> None:
        self.valid[np.searchsorted(self._start, positions, side="right") - 1] = False

    def _check_strings(self, b: np.ndarray, inside: np.ndarray, escaped: np.ndarray) -> None:
        self._fail(np.flatnonzero(inside & (b < 32)))
        esc = escaped[escaped < len(b)]
        self._fail(esc[~inside[esc - 1] | ~_ESCAPABLE[b[esc]]])
        u = esc[b[esc] == ord("u")]
        digits = np.minimum(u[:, None] + np.arange(1, 5), len(b) - 1)
        self._fail(u[~_HEX[b[digits]].all(axis=1)])

    def _check_scalars(self, b: np.ndarray, pos: np.ndarray, row: np.ndarray, scalar: np.ndarray) -> None:
        ends = np.flatnonzero(scalar[:-1] & ~scalar[1:]) + 1
        stop = ends[np.searchsorted(ends, pos, side="right")]
        known: dict[bytes, bool] = {}
        for p, e, r in zip(pos.tolist(), stop.tolist(), row.tolist()):
            text = self.raw[p:e]
            good = known.get(text)
            if good is None:
                good = known[text] = _SCALAR.fullmatch(text) is not None
            if not good:
                self.valid[r] = False

    def _link(self, pos: np.ndarray, row: np.ndarray, kind: np.ndarray, ch: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Index of the open bracket around each token, -1 at the root; records with crossed brackets fail."""
        n = len(pos)
        if not n:
            return np.empty(0, np.int64)
        bracket = np.flatnonzero((kind == _OPEN) | (kind == _CLOSE))
        levels = int(depth.max()) + 2
        order = bracket[np.argsort(row[bracket] * levels + depth[bracket], kind="stable")]
        opens, closes = order[0::2], order[1::2]
        self.valid[row[opens][ch[closes] - ch[opens] != 2]] = False  # '{}' and '[]' both lie two apart
        span = n + 1
        opened = np.flatnonzero(kind == _OPEN)
        key = (row[opened] * levels + depth[opened]) * span + opened
        rank = np.argsort(key, kind="stable")
        key, opened = key[rank], opened[rank]
        wanted = (row * levels + depth - 1) * span + np.arange(n)
        where = np.searchsorted(key, wanted) - 1
        return np.where(depth > 0, opened[np.maximum(where, 0)], -1)

    def _grammar(self, row: np.ndarray, kind: np.ndarray, ch: np.ndarray, parent: np.ndarray) -> np.ndarray:
        """Whether each token may follow the one before it."""
        n = len(row)
        if not n:
            return np.empty(0, bool)
        prev = np.r_[_OTHER, kind[:-1]]
        prev_ch = np.r_[0, ch[:-1]].astype(np.uint8)
        start = np.r_[True, row[1:] != row[:-1]]
        in_object = (parent >= 0) & (ch[np.maximum(parent, 0)] == ord("{"))
        begins = (kind == _OPEN) | (kind == _QUOTE) | (kind == _OTHER)
        prev_ends = ~start & ((prev == _CLOSE) | (prev == _QUOTE) | (prev == _OTHER))
        key = (kind == _QUOTE) & in_object & ~start & ((prev_ch == ord("{")) | (prev == _COMMA))
        prev_key = np.r_[False, key[:-1]] & ~start
        ok = np.where(
            start,
            kind == _OPEN,
            np.where(
                prev_key,
                kind == _COLON,
                np.where(
                    prev_ends,
                    (kind == _COMMA) | (kind == _CLOSE),
                    np.where(
                        prev == _COLON,
                        begins,
                        np.where(prev == _COMMA, np.where(in_object, key, begins), np.where(prev_ch == ord("{"), key | (ch == ord("}")), begins | (ch == ord("]")))),
                    ),
                ),
            ),
        )
        self.key = key
        return ok & (start | (parent >= 0) | (kind == _CLOSE))

    def string(self, token: int) -> str:
        """The text of a string token."""
        p = int(self.pos[token])
        end = int(self._quotes[np.searchsorted(self._quotes, p, side="right")])
        body = self.raw[p + 1 : end]
        return json.loads(self.raw[p : end + 1]) if b"\\" in body else body.decode("utf-8", "surrogatepass")

    def containers(self) -> tuple[np.ndarray, list[str | None], list[str | None]]:
        """(token, path, path of the nearest object above) for each container of a valid record, in order of position.

        A root has path None; the object path of what lies directly below it is ''.
        """
        opened = np.flatnonzero((self.kind == _OPEN) & self.valid[self.row])
        parent = self.parent[opened]
        element = np.flatnonzero((self.kind != _CLOSE) & (self.kind != _COMMA) & (self.kind != _COLON) & (self.parent >= 0) & (self.ch[np.maximum(self.parent, 0)] == ord("[")))
        by_parent = element[np.argsort(self.parent[element], kind="stable")]
        group = self.parent[by_parent]
        head = np.r_[True, group[1:] != group[:-1]] if len(group) else np.empty(0, bool)
        place = np.zeros(len(self.kind), np.int64)
        count = np.arange(len(group))
        place[by_parent] = count - np.maximum.accumulate(np.where(head, count, 0)) if len(group) else 0

        # spans of all key strings at once
        keys = np.maximum(opened - 2, 0)
        begin = self.pos[keys] + 1 if len(opened) else np.empty(0, np.int64)
        end = self._quotes[np.minimum(np.searchsorted(self._quotes, begin - 1, side="right"), max(len(self._quotes) - 1, 0))] if len(self._quotes) else begin
        in_list = (parent >= 0) & (self.ch[np.maximum(parent, 0)] == ord("["))
        is_object = self.ch[opened] == ord("{")
        path: dict[int, str | None] = {}
        above: dict[int, str] = {}  # of a container: the path of the nearest object, itself included
        paths, owners = [], []
        raw = self.raw
        for token, up, listed, obj, at, p, e in zip(opened.tolist(), parent.tolist(), in_list.tolist(), is_object.tolist(), place[opened].tolist(), begin.tolist(), end.tolist()):
            if up < 0:
                path[token], above[token] = None, ""
                paths.append(None)
                owners.append(None)
                continue
            if listed:
                label = str(at)
            else:
                body = raw[p:e]
                label = json.loads(raw[p - 1 : e + 1]) if b"\\" in body else body.decode("utf-8", "surrogatepass")
            over = path[up]
            own = label if over is None else f"{over}/{label}"
            path[token] = own
            above[token] = own if obj else above[up]
            paths.append(own)
            owners.append(above[up])
        return opened, paths, owners


def _chunks(keys: list, texts: list[str | None]) -> Iterator[tuple[list, list[bytes]]]:
    ks, bs, size = [], [], 0
    for k, t in zip(keys, texts):
        if t is None or (t := unwrap(t)) is None:
            continue
        raw = t.encode("utf-8", "surrogatepass")
        ks.append(k)
        bs.append(raw)
        size += len(raw)
        if size >= CHUNK_BYTES:
            yield ks, bs
            ks, bs, size = [], [], 0
    if ks:
        yield ks, bs


def _printable(text: str) -> str:
    """Lone surrogates have no UTF-8 form; they become U+FFFD."""
    return text.encode("utf-8", "replace").decode() if not text.isascii() and any("\ud800" <= c <= "\udfff" for c in text) else text


def flatten_records(records: DataFrame, key: str = "id", text: str | Column = "raw_json") -> DataFrame:
    """One row (page_id, node_path, parent_path, node_kind, depth) for each object or array below the root of each record."""
    source = records.select(F.col(key).cast("string").alias("k"), (F.col(text) if isinstance(text, str) else text).alias("t"))
    source = source.where(F.col("t").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, texts in _chunks(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                index = StructuralIndex(texts)
                token, paths, owners = index.containers()
                row, depth, obj = index.row[token].tolist(), index.depth[token].tolist(), (index.ch[token] == ord("{")).tolist()
                seen: set[tuple[int, str, bool]] = set()
                out: list[tuple] = []
                for r, p, o, d, is_obj in zip(row, paths, owners, depth, obj):
                    if p is None or (r, p, is_obj) in seen:
                        continue
                    seen.add((r, p, is_obj))
                    out.append((keys[r], _printable(p), _printable(o), is_obj, d))
                if out:
                    ids, ps, os_, kinds, ds = zip(*out)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids, pa.string()), pa.array(ps, pa.string()), pa.array(os_, pa.string()), pa.array(["object" if x else "array" for x in kinds], pa.string()), pa.array(ds, pa.int32())],
                        names=["page_id", "node_path", "parent_path", "node_kind", "depth"],
                    )

    return source.mapInArrow(run, "page_id string, node_path string, parent_path string, node_kind string, depth int")


def object_nodes(records: DataFrame, key: str = "id", text: str = "raw_json") -> DataFrame:
    """(page_id, node_path, parent_path) of every JSON object below the root."""
    return flatten_records(records, key, text).where("node_kind = 'object'").select("page_id", "node_path", "parent_path")


