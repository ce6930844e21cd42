"""What the pipeline takes from outside: fetchers, embedders and notifiers, all replaceable."""

from __future__ import annotations

import hashlib
import json
import logging
import re
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import shorten_message

FETCHED = "url string, status int, reason string, body string"


class Fetcher(Protocol):
    def fetch(self, requests: DataFrame) -> DataFrame:
        """(url, request_url) to (url, status, reason, body); every address once."""


@dataclass
class TableFetcher:
    """Answers from a table (url, status, reason, body), for offline runs and tests. An address it lacks has no answer."""

    answers: DataFrame

    def fetch(self, requests: DataFrame) -> DataFrame:
        return requests.select("url").join(self.answers.select("url", "status", "reason", "body"), "url")


@dataclass
class HttpFetcher:
    """GET requests from the executors, ``threads`` at a time a task. The result must be written before it is used twice."""

    headers: dict[str, str] = field(default_factory=dict)
    timeout: float = 30.0
    threads: int = 16

    def fetch(self, requests: DataFrame) -> DataFrame:
        headers, timeout, threads = self.headers, self.timeout, self.threads

        def get(url: str) -> tuple[int | None, str | None, str | None]:
            try:
                with urllib.request.urlopen(urllib.request.Request(url, headers=headers), timeout=timeout) as r:  # noqa: S310
                    return r.status, r.reason, r.read().decode("utf-8", "replace")
            except urllib.error.HTTPError as e:
                return e.code, e.reason, None
            except (OSError, ValueError) as e:
                return None, str(e), None

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            with ThreadPoolExecutor(threads) as pool:
                for batch in batches:
                    answers = list(pool.map(get, batch.column(1).to_pylist()))
                    status, reason, body = zip(*answers) if answers else ((), (), ())
                    yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(status, pa.int32()), pa.array(reason, pa.string()), pa.array(body, pa.string())], names=["url", "status", "reason", "body"])

        return requests.select("url", "request_url").mapInArrow(run, FETCHED)


class Embedder(Protocol):
    dim: int

    def encode(self, texts: list[str]) -> np.ndarray:
        """One row of ``dim`` values a text."""


@dataclass
class HashingEmbedder:
    """A deterministic stand-in for a model: signed counts of hashed words (the first bytes of their MD5 name the place and the sign)."""

    dim: int = 64

    def encode(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dim))
        for row, text in enumerate(texts):
            for word in re.findall(r"\w+", text.lower()):
                h = hashlib.md5(word.encode("utf-8", "surrogatepass"), usedforsecurity=False).digest()
                out[row, int.from_bytes(h[1:4], "big") % self.dim] += 1 if h[0] & 128 else -1
        return out


@dataclass
class RemoteEmbedder:
    """A model behind HTTP: POST ``{"input": [...]}``, answer ``{"data": [{"embedding": [...]}, ...]}``.

    A request holds at most ``batch`` texts and is tried ``attempts`` times, each for at most ``timeout`` seconds in all; the last failure is logged and raised.
    """

    address: str
    key: str
    dim: int
    timeout: float = 30.0
    attempts: int = 3
    batch: int = 64

    def encode(self, texts: list[str]) -> np.ndarray:
        parts = [self._encode(texts[at : at + self.batch]) for at in range(0, len(texts), self.batch)]
        return np.concatenate(parts) if parts else np.zeros((0, self.dim))

    def _read(self, response, deadline: float) -> bytes:
        out = bytearray()
        while block := response.read1(1 << 16):
            out += block
            if time.monotonic() > deadline:
                raise TimeoutError(f"no whole answer within {self.timeout} s")
        return bytes(out)

    def _encode(self, texts: list[str]) -> np.ndarray:
        request = urllib.request.Request(self.address, json.dumps({"input": texts}).encode(), {"Content-Type": "application/json", "Authorization": f"Bearer {self.key}"})  # noqa: S310
        for left in reversed(range(self.attempts)):
            deadline = time.monotonic() + self.timeout
            try:
                with urllib.request.urlopen(request, timeout=self.timeout) as r:  # noqa: S310
                    rows = [x["embedding"] for x in json.loads(self._read(r, deadline))["data"]]
                if len(rows) != len(texts):
                    raise ValueError(f"{len(rows)} vectors for {len(texts)} texts")
                return np.asarray(rows, float)
            except (OSError, ValueError, KeyError) as e:
                if not left:
                    logging.getLogger("corpusloom").error("embedding failed after %d attempts (%d texts): %s", self.attempts, len(texts), e)
                    raise
        raise AssertionError


def normalize_rows(x: np.ndarray) -> np.ndarray:
    """Unit length; zero rows stay."""
    length = np.linalg.norm(x, axis=1, keepdims=True)
    return np.where(length == 0, x, x / np.where(length == 0, 1, length))


def embed(df: DataFrame, text: str, embedder: Embedder) -> DataFrame:
    """Adds ``embedding``: each row's own normalised vector, so nothing is aligned by position across rows."""
    schema = df.withColumn("embedding", F.array(F.lit(0.0).cast("float"))).schema
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = normalize_rows(embedder.encode([t or "" for t in batch.column(at).to_pylist()])) if batch.num_rows else np.zeros((0, 1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(vectors.astype(np.float32)), pa.list_(pa.float32()))], names=[*batch.schema.names, "embedding"])

    return df.mapInArrow(run, schema)


class Notifier(Protocol):
    def stats(self, message: str) -> None: ...

    def alert(self, message: str) -> None: ...


@dataclass
class MemoryNotifier:
    """Keeps messages; also the log sink."""

    sent: list[tuple[str, str]] = field(default_factory=list)

    def stats(self, message: str) -> None:
        logging.getLogger("corpusloom").info(message)
        self.sent.append(("stats", message))

    def alert(self, message: str) -> None:
        logging.getLogger("corpusloom").warning(message)
        self.sent.append(("alert", message))


@dataclass
class HttpNotifier:
    """POST ``{"text": ...}``; no address means no message, and a failure is swallowed."""

    stats_address: str | None = None
    alert_address: str | None = None
    prefix: str = "[COLLECTOR] "
    timeout: float = 5.0
    shorten: Callable[[str], str] = staticmethod(shorten_message)

    def _send(self, address: str | None, message: str) -> None:
        if not address:
            return
        body = json.dumps({"text": self.shorten(self.prefix + message)}).encode()
        try:
            urllib.request.urlopen(urllib.request.Request(address, body, {"Content-Type": "application/json"}), timeout=self.timeout).close()  # noqa: S310
        except OSError:
            pass

    def stats(self, message: str) -> None:
        self._send(self.stats_address, message)

    def alert(self, message: str) -> None:
        self._send(self.alert_address, message)
