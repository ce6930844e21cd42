"""Versions of a store as manifests: one small JSON file each, put in place by a rename once all that it names has been written."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class ManifestFolder:
    """A folder of manifests numbered by version. A version can be committed once: of two writers the second one fails."""

    spark: SparkSession
    path: str

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def names(self, folder: str) -> list[str]:
        p, fs = self._fs(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def delete(self, path: str) -> None:
        p, fs = self._fs(path)
        fs.delete(p, True)

    def _committed(self) -> list[str]:
        return [n for n in self.names(self.path) if n.endswith(".json") and not n.startswith(("_", "."))]

    def _load(self, name: str) -> dict:
        p, fs = self._fs(f"{self.path}/{name}")
        stream = fs.open(p)
        try:
            return json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()

    def last(self) -> dict | None:
        names = self._committed()
        return self._load(names[-1]) if names else None

    def since(self, version: int) -> list[dict]:
        """The manifests after a version, in order."""
        return [self._load(n) for n in self._committed() if int(n[:-5]) > version]

    def commit(self, manifest: dict) -> None:
        tmp, fs = self._fs(f"{self.path}/_{uuid.uuid4().hex}")
        out = fs.create(tmp, True)
        try:
            out.write(bytearray(json.dumps(manifest).encode()))
        finally:
            out.close()
        target, _ = self._fs(f"{self.path}/{manifest['version']:012d}.json")
        if fs.exists(target) or not fs.rename(tmp, target):
            raise RuntimeError(f"version {manifest['version']} was committed by another writer")
