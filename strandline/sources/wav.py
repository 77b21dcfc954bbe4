"""WAV files as a Spark data source, read by ranges and written with commit and abort.

    spark.dataSource.register(WavSource)
    spark.read.format("wav").option("rate", 16000).load(folder)
    df.write.format("wav").mode("append").save(folder)          # df: name, pcm, record

With option "folders" true a writer puts its files into folders of about `bytes`, which the driver moves and lists in place of the files; with option
"records" true a reader has a column record too.

A folder may lie in any file system that Arrow knows.
"""

from __future__ import annotations

import hashlib
import posixpath
import re
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from .media import wav_bytes

HEAD = 4096
#: A folder that a writer filled, with the bytes in it.
PART = re.compile(r"part-[0-9a-f]+-(\d+)")
MOST_FILES = 10_000


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def data_range(file, size: int, rate: int, path: str) -> tuple[int, int]:
    """Where the samples of a mono 16-bit file begin, in bytes, and how many there are; any other file fails."""
    head = file.read(12)
    if head[:4] != b"RIFF" or head[8:12] != b"WAVE":
        raise ValueError(f"{path}: not a WAV file")
    at, form = 12, None
    while at + 8 <= size:
        file.seek(at)
        name, length = struct.unpack("<4sI", file.read(8))
        if name == b"fmt ":
            form = struct.unpack("<HHIIHH", file.read(16))
        if name == b"data":
            if form is None or (form[0], form[1], form[5], form[2]) != (1, 1, 16, rate):
                raise ValueError(f"{path}: not mono 16-bit PCM at {rate} Hz")
            if at + 8 + length > size:
                raise ValueError(f"{path}: cut off")
            return at + 8, length // 2
        at += 8 + length + length % 2
    raise ValueError(f"{path}: no data chunk")


@dataclass
class Shares(InputPartition):
    """What one task reads: (path, size, k, of), the k-th of `of` equal shares of a file's samples; and folders of which it reads all files."""

    shares: list[tuple[str, int, int, int]]
    folders: list[str]


class WavReader(DataSourceReader):
    """A task reads about `bytes`: many small files, or a share of a large one; samples come in rows of at most `samples`."""

    def __init__(self, options: dict):
        self.path, self.rate = options["path"], int(options.get("rate", 16_000))
        self.bytes, self.samples = int(options.get("bytes", 32 << 20)), int(options.get("samples", 1 << 20))
        self.records = options.get("records", "false").lower() == "true"

    def _listed(self, fs, found, root: str) -> list[tuple[str, int]]:
        return sorted((f.path, f.size) for f in found if f.type == pafs.FileType.File and f.path.endswith(".wav") and "/_" not in f.path[len(root) :])

    def partitions(self) -> list[Shares]:
        fs, path = file_system(self.path)
        top = fs.get_file_info(pafs.FileSelector(path)) if fs.get_file_info(path).type == pafs.FileType.Directory else [fs.get_file_info(path)]
        found, whole = [], []
        for f in top:
            if f.type != pafs.FileType.Directory:
                found.append(f)
            elif (part := PART.fullmatch(f.base_name)) and int(part[1]) <= 2 * self.bytes:
                whole.append((f.path, int(part[1])))
            elif not f.base_name.startswith("_"):
                found += fs.get_file_info(pafs.FileSelector(f.path, recursive=True))
        files = self._listed(fs, found, path)
        out, held = [Shares([], [])], 0
        for p, size in sorted(whole):
            if held + size > self.bytes and out[-1].folders:
                out.append(Shares([], []))
                held = 0
            out[-1].folders.append(p)
            held += size + 1
        for p, size in files:
            n = max(1, -(-size // self.bytes))
            for k in range(n):
                if held + size // n > self.bytes and (out[-1].shares or out[-1].folders):
                    out.append(Shares([], []))
                    held = 0
                out[-1].shares.append((p, size, k, n))
                held += size // n + 1
        return out

    def read(self, part: Shares) -> Iterator[pa.RecordBatch]:
        fs, _ = file_system(self.path)
        own = [(path, size, 0, 1) for folder in part.folders for path, size in self._listed(fs, fs.get_file_info(pafs.FileSelector(folder)), folder)]
        for path, size, k, of in part.shares + own:
            with fs.open_input_file(path) as file:
                start, n = data_range(file, size, self.rate, path)
                lo, hi = n * k // of, n * (k + 1) // of
                record = None
                if self.records and k == 0:
                    with fs.open_input_file(path.removesuffix(".wav") + ".json") as side:
                        record = side.read().decode().rstrip("\n")
                for at in range(lo, hi, self.samples) or ([0] if record is not None else ()):
                    count = min(self.samples, hi - at)
                    file.seek(start + 2 * at)
                    columns = [pa.array([path]), pa.array([at], pa.int64()), pa.array([count], pa.int64()), pa.array([file.read(2 * count)], pa.binary())]
                    more = [pa.array([record if at == 0 else None], pa.string())] if self.records else []
                    yield pa.RecordBatch.from_arrays(columns + more, names=["path", "first_sample", "n_samples", "pcm"] + ["record"] * self.records)


@dataclass
class Written(WriterCommitMessage):
    """Files, or folders, that a task has staged."""

    names: list[str]


class WavWriter(DataSourceWriter):
    """Rows (name, pcm, record) become <name>.wav and <name>.json, record being its JSON document.

    A task writes under _staging-<job>; commit moves all files into place, abort removes the staging folder, so a failed job leaves nothing.  A
    task that fails and runs again writes the same names over.  The driver moves two files a row, as Spark's own file committer does, and
    fails for two rows of one name.  With the option folders it moves one folder of about `bytes` instead; then only rows of one
    task are held against each other, so rows have to be dealt by name for a name to be told as one.
    """

    def __init__(self, options: dict, schema: StructType):
        self.path, self.rate, self.at = options["path"], int(options.get("rate", 16_000)), {c: i for i, c in enumerate(schema.fieldNames())}
        if missing := {"name", "pcm", "record"} - self.at.keys():
            raise ValueError(f"columns {sorted(missing)} are missing")
        self.staging = f"_staging-{uuid.uuid4().hex}"
        self.folders, self.bytes = options.get("folders", "false").lower() == "true", int(options.get("bytes", 32 << 20))

    def write(self, rows) -> Written:
        if self.folders:
            return self._write_folders(rows)
        fs, root = file_system(self.path)
        fs.create_dir(posixpath.join(root, self.staging), recursive=True)
        names = []
        for row in rows:
            for name, data in self._files(row):
                with fs.open_output_stream(posixpath.join(root, self.staging, name)) as file:
                    file.write(data)
                names.append(name)
        return Written(names)

    def _files(self, row) -> list[tuple[str, bytes]]:
        name = row[self.at["name"]]
        if not name or "/" in name:
            raise ValueError(f"not a file name: {name!r}")
        return [(name + ".wav", wav_bytes(bytes(row[self.at["pcm"]] or b""), self.rate)), (name + ".json", (row[self.at["record"]] + "\n").encode())]

    def _write_folders(self, rows) -> Written:
        fs, root = file_system(self.path)
        at, done, seen, now, held, n = posixpath.join(root, self.staging), [], set(), None, 0, 0

        def close():
            done.append(f"{now}-{held}")
            fs.move(posixpath.join(at, now), posixpath.join(at, done[-1]))

        for row in rows:
            (wav, pcm), (side, record) = self._files(row)
            if wav in seen:
                raise ValueError("two rows have one name")
            seen.add(wav)
            if now and (held + len(pcm) > self.bytes or n >= MOST_FILES):
                close()
                now = None
            if not now:
                now, held, n = f"part-{uuid.uuid4().hex}", 0, 0
                fs.create_dir(posixpath.join(at, now), recursive=True)
            for name, data in ((wav, pcm), (side, record)):
                with fs.open_output_stream(posixpath.join(at, now, name)) as file:
                    file.write(data)
            held, n = held + len(pcm), n + 1
        if now:
            close()
        return Written(done)

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = file_system(self.path)
        names = [n for m in messages if m for n in m.names]
        if len(names) != len(set(names)):
            self.abort(messages)
            raise ValueError("two rows have one name")
        for n in names:
            fs.move(posixpath.join(root, self.staging, n), posixpath.join(root, n))
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        fs, root = file_system(self.path)
        if fs.get_file_info(posixpath.join(root, self.staging)).type == pafs.FileType.Directory:
            fs.delete_dir(posixpath.join(root, self.staging))


class WavSource(DataSource):
    """Format "wav"."""

    @classmethod
    def name(cls) -> str:
        return "wav"

    def schema(self) -> str:
        return "path string, first_sample bigint, n_samples bigint, pcm binary" + (", record string" if self.options.get("records", "false").lower() == "true" else "")

    def reader(self, schema: StructType) -> WavReader:
        return WavReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> WavWriter:
        if overwrite:
            raise ValueError("segments are only added: use mode append")
        return WavWriter(self.options, schema)


#: Fixed value: what a written segment promises.
POLICY = "original_signal_only_no_reconstruction"


def segment_sha256(pcm: bytes, rate: int = 16_000) -> str:
    """The hash of the file that a segment's samples become."""
    return hashlib.sha256(wav_bytes(pcm, rate)).hexdigest()
