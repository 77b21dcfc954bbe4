"""An append-only, hash-chained log that a stream writes: batch by batch, replays without effect, one writer at a time.

A folder has entries/batch=N (linked entries), heads/batch=N (per session the next seq and the hash to link it to, after batch N) and
commits/N, an empty file that is created last.  A batch that has its commit is done: written again, it changes nothing.  One that was cut off before its commit is
written anew over what it left.  Readers and the next batch go by commits alone, so the chain has no gap and no fork.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.audit import linked


class LeaseHeld(RuntimeError):
    """Another run writes this log."""


class LogSink:
    """Give `write` to foreachBatch.  Batches have keys (of a session), file_index, start_ms, operation and payload (canonical JSON).

    In a batch entries are linked in the order of file_index, start_ms, operation and payload hash; sessions in parallel.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], run_id: str, lease_ms: int = 600_000):
        self.spark, self.path, self.keys, self.run_id, self.lease_ms = spark, path.rstrip("/"), keys, run_id, lease_ms

    def _at(self, name: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def _create(self, name: str, text: str = "") -> bool:
        """Create a file that isn't there; False: it is."""
        fs, where = self._at(name)
        try:
            out = fs.create(where, False)
        except Exception:
            if fs.exists(where):
                return False
            raise
        out.write(text.encode())
        out.close()
        return True

    def _owner(self) -> str:
        fs, where = self._at("lease")
        file = fs.open(where)
        try:
            return bytes(file.readAllBytes()).decode()
        finally:
            file.close()

    def lease(self) -> None:
        """Take or renew the right to write; another run's lease that is younger than lease_ms raises LeaseHeld."""
        fs, where = self._at("lease")
        if not self._create("lease", self.run_id):
            owner, age = self._owner(), time.time() * 1000 - fs.getFileStatus(where).getModificationTime()
            if owner != self.run_id and age < self.lease_ms:
                raise LeaseHeld(f"{owner} writes {self.path} since {age / 1000:.0f} s")
            if owner == self.run_id and age < self.lease_ms / 2:
                return
            fs.delete(where, False)
            if not self._create("lease", self.run_id):  # of two runs that find it old, one gets it
                raise LeaseHeld(f"{self._owner()} has taken {self.path}")

    def release(self) -> None:
        fs, where = self._at("lease")
        if fs.exists(where) and self._owner() == self.run_id:
            fs.delete(where, False)

    def committed(self) -> list[int]:
        fs, where = self._at("commits")
        return sorted(int(f.getPath().getName()) for f in fs.listStatus(where)) if fs.exists(where) else []

    def heads(self) -> DataFrame | None:
        """Per session next_seq, prev_sha256 and the batch that wrote them; None before the first batch."""
        done = self.committed()
        return self.spark.read.parquet(f"{self.path}/heads/batch={done[-1]}").withColumn("batch", F.lit(done[-1])) if done else None

    def entries(self) -> DataFrame:
        """All entries of committed batches, with the batch."""
        done = self.committed()
        if not done:
            raise ValueError(f"{self.path} has no committed batch")
        return self.spark.read.option("basePath", f"{self.path}/entries").parquet(*(f"{self.path}/entries/batch={b}" for b in done))

    def write(self, batch: DataFrame, batch_id: int) -> None:
        self.lease()
        done = self.committed()
        if batch_id in done:
            return
        if done and batch_id < done[-1]:
            raise ValueError(f"batch {batch_id} comes after batch {done[-1]}")
        before = self.heads()
        rows = linked(batch.withColumn("payload_sha256", F.sha2("payload", 256)), self.keys, ["file_index", "start_ms", "operation", "payload_sha256"], before, ["file_index", "start_ms", "payload"])
        at = f"{self.path}/entries/batch={batch_id}"
        rows.write.mode("overwrite").parquet(at)
        written = self.spark.read.schema(rows.schema).parquet(at)
        last = written.groupBy(*self.keys).agg((F.max("seq") + 1).alias("next_seq"), F.max_by("entry_sha256", "seq").alias("prev_sha256"))
        if before is not None:
            last = last.unionByName(before.drop("batch").join(last.select(*self.keys), self.keys, "left_anti"))
        last.write.mode("overwrite").parquet(f"{self.path}/heads/batch={batch_id}")
        self._create(f"commits/{batch_id}")


def write_worker_log(records: DataFrame, path: str, run_id: str) -> None:
    """Records (file_index, operation, payload, start_ms) of parallel workers as JSON lines, a folder a run and file; a run writes once, and its entries aren't chained."""
    records.write.option("ignoreNullFields", "false").partitionBy("file_index").json(f"{path.rstrip('/')}/run={run_id}")


def worker_digests(records: DataFrame) -> DataFrame:
    """Per file_index the number of records and a hash of them, the same in whatever order workers wrote: it goes into the log when records are merged."""
    line = F.to_json(F.struct("operation", "payload", "start_ms"), {"ignoreNullFields": "false"})
    lines = records.select("file_index", F.sha2(line, 256).alias("h"))
    return lines.groupBy("file_index").agg(F.count("*").alias("records"), F.sha2(F.array_join(F.array_sort(F.collect_list("h")), "\n"), 256).alias("records_sha256"))
