"""Files of text lines whose writers count and hash what they write, and hand that on when they commit.

A task streams its rows into one file at a time and starts the next one when the folder of its rows changes
or a file is full, so neither a file nor a folder is ever held in memory, and many small folders cost no
commit of their own. What a task has written is its commit message; the driver keeps the files of the
messages, removes what failed attempts left, and may save the messages as a manifest. Nothing is read again.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

FORMAT = "lumenloom_lines"
MOST_RECORDS, MOST_BYTES = 1_000_000, 128 << 20


def place_of(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, and the path in it."""
    scheme, colon, rest = path.partition(":")
    if colon and scheme in ("s3a", "s3n"):
        path = f"s3:{rest}"
    elif colon and scheme == "file":
        path = "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(path)


def qualified(spark: SparkSession, path: str) -> str:
    """A path without a scheme, as Spark reads it: on the default file system of the session."""
    if ":" in path.split("/", 1)[0]:
        return path
    return f"{spark.conf.get('spark.hadoop.fs.defaultFS', 'file://').rstrip('/')}{path}"


class _Hashed:
    """A stream that counts and hashes the bytes that pass."""

    def __init__(self, stream) -> None:
        self.stream, self.md5, self.bytes = stream, hashlib.md5(), 0

    def write(self, data: bytes) -> int:
        self.md5.update(data)
        self.bytes += len(data)
        self.stream.write(data)
        return len(data)

    def flush(self) -> None:
        self.stream.flush()


class _File:
    """One open file, plain or gzip; a given content gives the same bytes every time."""

    def __init__(self, system: fs.FileSystem, path: str, zipped: bool) -> None:
        self.sink = system.open_output_stream(path, compression=None)
        self.stored = _Hashed(self.sink)
        self.zip = gzip.GzipFile(filename="", mode="wb", fileobj=self.stored, mtime=0) if zipped else None
        self.raw, self.items = _Hashed(self.zip or self.stored), 0

    def add(self, lines: list[bytes]) -> None:
        self.raw.write(b"\n".join(lines) + b"\n")
        self.items += len(lines)

    def close(self) -> dict:
        if self.zip:
            self.zip.close()
        self.sink.close()
        return {"bytes": self.stored.bytes, "md5": self.stored.md5.hexdigest(), "items": self.items, "raw_bytes": self.raw.bytes, "raw_md5": self.raw.md5.hexdigest()}


@dataclass
class _Written(WriterCommitMessage):
    files: list[dict] = field(default_factory=list)


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool) -> None:
        self.path, self.overwrite, self.run = options["path"], overwrite, uuid.uuid4().hex
        self.suffix, self.zipped = options.get("suffix", ".txt"), options.get("gzip", "false") == "true"
        self.most_records = int(options.get("mostrecords", MOST_RECORDS))
        self.most_bytes = int(options.get("mostbytes", MOST_BYTES))
        self.manifest = options.get("manifest")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        system, root = place_of(self.path)
        part, out = TaskContext.get().partitionId(), _Written()
        current, file, name = None, None, None

        def close() -> None:
            if file:
                out.files.append({"file": name, **file.close()})

        for batch in iterator:
            folders, values = batch.column("folder"), batch.column("value").cast(pa.large_binary()).fill_null(b"")
            for a, b in _stretches(folders):
                folder, lines = folders[a].as_py() or "", values.slice(a, b - a).to_pylist()
                while lines:
                    if file is None or folder != current or file.items >= self.most_records or file.raw.bytes >= self.most_bytes:
                        close()
                        current = folder
                        name = f"{folder}/" if folder else ""
                        name += f"part-{part:05d}-{len(out.files):05d}-{self.run}{uuid.uuid4().hex[:8]}{self.suffix}"
                        system.create_dir(f"{root}/{folder}", recursive=True)
                        file = _File(system, f"{root}/{name}", self.zipped)
                    # as many lines as the file still takes
                    room, size = self.most_bytes - file.raw.bytes, 0
                    for n, line in enumerate(lines[: self.most_records - file.items], 1):
                        size += len(line) + 1
                        if size >= room:
                            break
                    file.add(lines[:n])
                    lines = lines[n:]
        close()
        return out

    def commit(self, messages: list[_Written | None]) -> None:
        system, root = place_of(self.path)
        files = sorted((f for m in messages if m for f in m.files), key=lambda f: f["file"])
        self._remove(system, root, {f["file"] for f in files})
        if self.manifest:
            target, place = place_of(self.manifest)
            target.create_dir(place, recursive=True)
            with target.open_output_stream(f"{place}/manifest.json") as out:
                for f in files:
                    out.write(json.dumps(f).encode() + b"\n")

    def abort(self, messages: list[_Written | None]) -> None:
        system, root = place_of(self.path)
        self.overwrite = False
        self._remove(system, root, set())

    def _remove(self, system: fs.FileSystem, root: str, kept: set[str]) -> None:
        """What failed attempts of this run have left and, where it overwrites, all there was before."""
        for info in system.get_file_info(fs.FileSelector(root, allow_not_found=True, recursive=True)):
            name = info.path[len(root.rstrip("/")) + 1 :]
            if info.type == fs.FileType.File and name not in kept and (self.overwrite or self.run in name):
                system.delete_file(info.path)


def _stretches(folders: pa.Array) -> Iterator[tuple[int, int]]:
    """Start and end of rows with the same folder."""
    values, a = folders.to_pylist(), 0
    for b in range(1, len(values) + 1):
        if b == len(values) or values[b] != values[a]:
            yield a, b
            a = b


class LineFiles(DataSource):
    """Rows (folder, value) as lines of files below path/folder."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(dict(self.options), overwrite)


def write_lines(
    rows: DataFrame,
    path: str,
    suffix: str = ".txt",
    zipped: bool = False,
    most_records: int = MOST_RECORDS,
    most_bytes: int = MOST_BYTES,
    manifest: str | None = None,
) -> None:
    """Replace what is below ``path`` by the lines of ``rows`` (folder, value), in the tasks the rows are in.

    Rows of a folder should stand together in their task. A file takes ``most_records`` lines and about
    ``most_bytes`` before compression. ``manifest`` is a folder for one JSON line per file: file, bytes, md5,
    items, raw_bytes and raw_md5 (before compression).
    """
    rows.sparkSession.dataSource.register(LineFiles)
    spark = rows.sparkSession
    writer = rows.select("folder", "value").write.format(FORMAT).mode("overwrite").option("path", qualified(spark, path))
    writer = writer.option("suffix", suffix).option("gzip", str(zipped).lower())
    writer = writer.option("mostRecords", most_records).option("mostBytes", most_bytes)
    (writer.option("manifest", qualified(spark, manifest)) if manifest else writer).save()
