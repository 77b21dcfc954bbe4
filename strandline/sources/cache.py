"""Results kept by what they were made from: a stored table is found again by the digest of its parameters and inputs."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators.audit import canonical_json


class ResultCache:
    """Tables under `path`, a folder for each key.

    A key is a document of everything that can change the result: parameters, hashes of inputs, versions.  It is compared whole, as canonical JSON.  Names in `optional`, such as
    the digest of a model store that isn't at hand, are left out of the comparison when the caller has no value for them (None): then a table made with any value serves.
    A table counts once its key document is written, which is last; a build that was cut off is built anew.
    """

    def __init__(self, spark: SparkSession, path: str, optional: tuple[str, ...] = ()):
        self.spark, self.path, self.optional = spark, path.rstrip("/"), optional

    def _fs(self, name: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def _common(self, key: dict) -> str:
        return hashlib.sha256(canonical_json({k: v for k, v in key.items() if k not in self.optional}).encode()).hexdigest()

    def _whole(self, key: dict) -> str:
        return hashlib.sha256(canonical_json(key).encode()).hexdigest()

    def _key(self, folder: str) -> dict | None:
        fs, where = self._fs(f"{folder}/key.json")
        if not fs.exists(where):
            return None
        file = fs.open(where)
        try:
            return json.loads(bytes(file.readAllBytes()).decode())
        finally:
            file.close()

    def find(self, key: dict) -> str | None:
        """The folder of a table for this key."""
        asked = {k: v for k, v in key.items() if not (k in self.optional and v is None)}
        folder = f"{self._common(key)}/{self._whole(key)}"
        if self._key(folder) == key:
            return folder
        if len(asked) == len(key):
            return None
        fs, where = self._fs(self._common(key))
        names = sorted(f.getPath().getName() for f in fs.listStatus(where)) if fs.exists(where) else []
        for name in names:
            stored = self._key(f"{self._common(key)}/{name}")
            if stored is not None and all(k in stored and stored[k] == v for k, v in asked.items()):
                return f"{self._common(key)}/{name}"
        return None

    def get(self, key: dict, build: Callable[[], DataFrame]) -> DataFrame:
        """The table for this key, built and kept if there is none."""
        folder = self.find(key)
        if folder is None:
            folder = f"{self._common(key)}/{self._whole(key)}"
            build().write.mode("overwrite").parquet(f"{self.path}/{folder}/table")
            fs, where = self._fs(f"{folder}/key.json")
            out = fs.create(where, True)
            out.write(canonical_json(key).encode())
            out.close()
        return self.spark.read.parquet(f"{self.path}/{folder}/table")
