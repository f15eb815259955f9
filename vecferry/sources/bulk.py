"""Bulk-import files as a Spark data source: rows go out to a store that loads files of bounded size.

    spark.dataSource.register(BulkFiles)
    rows.write.format("bulk_files").mode("append").option("path", where).option("max_rows", 100_000).save()

A write has two phases. Every task writes files of its own below ``rows/<write>`` and returns their names, rows, bytes and
checksums. When all tasks are done, one manifest that lists them is put in place; it alone makes the files visible. What
attempts that failed have left is named by no manifest and is deleted with the commit; a write that fails as a whole
deletes all of its files. ``overwrite`` puts the new manifest in place first and then drops the ones before it, so a reader
sees the old rows or the new ones.

Files are JSON lines (``json``: a row per line, packed vectors as lists of byte values) or ``parquet``. They are written
while rows stream by; a task holds one file's rows at most. Any file system that pyarrow knows may hold them; it has to be
one that all executors and the driver see.
"""

from __future__ import annotations

import json
import posixpath
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema

MAX_ROWS = 100_000
MAX_BYTES = 256 << 20
FORMATS = ("json", "parquet")


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if "://" in path or path.startswith("file:/"):
        return fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
    return fs.LocalFileSystem(), path


def _is_binary(kind: pa.DataType) -> bool:
    return pa.types.is_binary(kind) or pa.types.is_large_binary(kind)


def _to_plain(kind: pa.DataType) -> Callable | None:
    """How a value of the type becomes one that JSON has; None where it is one already."""
    if _is_binary(kind):
        return list
    if pa.types.is_list(kind):
        inner = _to_plain(kind.value_type)
        return inner and (lambda v: [None if x is None else inner(x) for x in v])
    if pa.types.is_struct(kind):
        inner = {f.name: _to_plain(f.type) for f in kind}
        return lambda v: {k: x if x is None or inner[k] is None else inner[k](x) for k, x in v.items()}
    if pa.types.is_temporal(kind):
        return lambda v: v.isoformat()
    if pa.types.is_decimal(kind):
        return str
    return None


def _from_plain(kind: pa.DataType) -> Callable | None:
    """The way back."""
    if _is_binary(kind):
        return bytes
    if pa.types.is_list(kind):
        inner = _from_plain(kind.value_type)
        return inner and (lambda v: [None if x is None else inner(x) for x in v])
    if pa.types.is_struct(kind):
        inner = {f.name: _from_plain(f.type) for f in kind}
        return lambda v: {k: x if x is None or inner[k] is None else inner[k](x) for k, x in v.items()}
    if pa.types.is_timestamp(kind) or pa.types.is_date(kind):
        import datetime

        read = datetime.date.fromisoformat if pa.types.is_date(kind) else datetime.datetime.fromisoformat
        return read
    if pa.types.is_decimal(kind):
        import decimal

        return decimal.Decimal
    return None


@dataclass
class WrittenFiles(WriterCommitMessage):
    """What one task has written: (name, rows, bytes, crc32) of each file."""

    files: list


class _Files:
    """The files of one task: a new one whenever the next row would not fit the last."""

    def __init__(self, folder: str, prefix: str, kind: str, max_rows: int, max_bytes: int) -> None:
        self.system, self.folder = _opened(folder)
        self.prefix, self.kind, self.max_rows, self.max_bytes = prefix, kind, max_rows, max_bytes
        self.done: list[tuple[str, int, int, int]] = []
        self.out, self.name, self.rows, self.size, self.crc = None, "", 0, 0, 0

    def _open(self) -> None:
        self.name = f"{self.prefix}-{len(self.done):05d}.{self.kind}"
        self.rows, self.size, self.crc = 0, 0, 0
        self.out = self.system.open_output_stream(posixpath.join(self.folder, self.name))

    def add(self, body: bytes, rows: int) -> None:
        """Appends to the open file, in which there is room."""
        if self.out is None:
            self._open()
        self.out.write(body)
        self.rows, self.size, self.crc = self.rows + rows, self.size + len(body), zlib.crc32(body, self.crc)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((self.name, self.rows, self.size, self.crc))
            self.out = None

    def add_line(self, line: bytes) -> None:
        if len(line) > self.max_bytes:
            raise ValueError(f"a row of {len(line)} bytes does not fit a file of {self.max_bytes}")
        if self.out is not None and (self.rows == self.max_rows or self.size + len(line) > self.max_bytes):
            self.close()
        self.add(line, 1)

    def add_table(self, table: pa.Table) -> None:
        """One Parquet file; halves of the rows where it comes out too large."""
        sink = pa.BufferOutputStream()
        pq.write_table(table, sink, compression="zstd")
        body = sink.getvalue()
        if body.size > self.max_bytes:
            if table.num_rows == 1:
                raise ValueError(f"a row of {body.size} bytes does not fit a file of {self.max_bytes}")
            half = table.num_rows // 2
            self.add_table(table.slice(0, half))
            self.add_table(table.slice(half))
        else:
            self.add(body.to_pybytes(), table.num_rows)
            self.close()


class _Writer(DataSourceArrowWriter):
    def __init__(self, schema: T.StructType, overwrite: bool, options: dict) -> None:
        self.path, self.schema, self.overwrite = options["path"].rstrip("/"), schema, overwrite
        self.kind = options.get("file_format", "json")
        if self.kind not in FORMATS:
            raise ValueError(f"file_format is one of {FORMATS}")
        self.max_rows, self.max_bytes = int(options.get("max_rows", MAX_ROWS)), int(options.get("max_bytes", MAX_BYTES))
        if self.max_rows < 1 or self.max_bytes < 1:
            raise ValueError("max_rows and max_bytes are at least 1")
        self.write_id = uuid.uuid4().hex

    @property
    def folder(self) -> str:
        return f"{self.path}/rows/{self.write_id}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        from pyspark import TaskContext

        task = TaskContext.get()
        system, folder = _opened(self.folder)
        system.create_dir(folder)
        files = _Files(self.folder, f"part-{task.partitionId():06d}-{task.taskAttemptId()}", self.kind, self.max_rows, self.max_bytes)
        if self.kind == "json":
            for batch in iterator:
                names, columns = batch.schema.names, []
                for field, column in zip(batch.schema, batch.columns, strict=True):
                    plain, values = _to_plain(field.type), column.to_pylist()
                    columns.append(values if plain is None else [None if v is None else plain(v) for v in values])
                for row in zip(*columns, strict=True):
                    files.add_line((json.dumps(dict(zip(names, row, strict=True)), ensure_ascii=False, separators=(",", ":")) + "\n").encode())
            files.close()
        else:
            held, rows = [], 0
            for batch in iterator:
                while batch.num_rows:
                    part = batch.slice(0, self.max_rows - rows)
                    batch, rows = batch.slice(part.num_rows), rows + part.num_rows
                    held.append(part)
                    if rows == self.max_rows or sum(b.nbytes for b in held) >= self.max_bytes:
                        files.add_table(pa.Table.from_batches(held))
                        held, rows = [], 0
            if held:
                files.add_table(pa.Table.from_batches(held))
        return WrittenFiles(files.done)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        system, root = _opened(self.path)
        listed = [f for m in messages if m is not None for f in m.files]
        before = _manifests(self.path)
        number = 1 + max((int(posixpath.basename(m).split("-")[0]) for m in before), default=0)
        folder = posixpath.join(root, "manifests")
        system.create_dir(folder)
        body = json.dumps({
            "write": self.write_id, "number": number, "replaces": self.overwrite, "format": self.kind, "schema": self.schema.jsonValue(),
            "rows": sum(f[1] for f in listed), "files": [dict(zip(("name", "rows", "bytes", "crc32"), f, strict=True)) for f in listed]})
        hidden = posixpath.join(folder, f".{self.write_id}")
        with system.open_output_stream(hidden) as out:
            out.write(body.encode())
        system.move(hidden, posixpath.join(folder, f"{number:010d}-{self.write_id}.json"))
        if self.overwrite:
            for name in before:
                old = posixpath.basename(name).removesuffix(".json").split("-", 1)[1]
                system.delete_file(name)
                self._drop(f"{self.path}/rows/{old}", set())
        self._drop(self.folder, {f[0] for f in listed})

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._drop(self.folder, set())

    @staticmethod
    def _drop(folder: str, keep: set[str]) -> None:
        """Deletes the files of a write but those to keep."""
        system, at = _opened(folder)
        if system.get_file_info(at).type == fs.FileType.NotFound:
            return
        if not keep:
            system.delete_dir(at)
            return
        for found in system.get_file_info(fs.FileSelector(at)):
            if found.base_name not in keep:
                system.delete_file(found.path)


def _manifests(path: str) -> list[str]:
    """Manifests in the order of their writes."""
    system, root = _opened(path)
    folder = posixpath.join(root, "manifests")
    found = system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    return sorted(f.path for f in found if not f.base_name.startswith("."))


def manifests(path: str) -> list[dict]:
    """What is visible at the path: the manifests since the last that replaces all before it."""
    system, _ = _opened(path)
    read = []
    for name in _manifests(path.rstrip("/")):
        with system.open_input_stream(name) as source:
            found = json.loads(source.read())
        read = [found] if found["replaces"] else [*read, found]
    return read


class _File(InputPartition):
    def __init__(self, path: str, kind: str, crc: int) -> None:
        super().__init__(path)
        self.path, self.kind, self.crc = path, kind, crc


class _Reader(DataSourceReader):
    def __init__(self, schema: T.StructType, path: str) -> None:
        self.schema, self.path = schema, path

    def partitions(self) -> list[InputPartition]:
        return [
            _File(f"{self.path}/rows/{m['write']}/{f['name']}", m["format"], f["crc32"]) for m in manifests(self.path) for f in m["files"]]

    def read(self, partition: _File | None) -> Iterator[pa.RecordBatch]:
        """A file, checked against its checksum; a row is a value per column of the schema, null where the file has none."""
        if partition is None:  # Spark asks once where there are no partitions
            return
        system, name = _opened(partition.path)
        with system.open_input_stream(name) as source:
            body = source.read()
        if zlib.crc32(body) != partition.crc:
            raise ValueError(f"{partition.path} is not what was written")
        kinds = to_arrow_schema(self.schema)
        if partition.kind == "parquet":
            yield from pq.read_table(pa.BufferReader(body)).select(kinds.names).cast(kinds).to_batches()
            return
        rows = [json.loads(line) for line in body.split(b"\n") if line]
        columns = []
        for field in kinds:
            back, values = _from_plain(field.type), [row.get(field.name) for row in rows]
            columns.append(pa.array(values if back is None else [None if v is None else back(v) for v in values], field.type))
        yield pa.RecordBatch.from_arrays(columns, schema=kinds)


class BulkFiles(DataSource):
    """Options: ``path``; for writing also ``file_format``, ``max_rows`` and ``max_bytes`` of a file."""

    @classmethod
    def name(cls) -> str:
        return "bulk_files"

    def schema(self) -> T.StructType:
        found = manifests(self.options["path"])
        if not found:
            raise ValueError(f"no rows have been written to {self.options['path']}")
        return T.StructType.fromJson(found[-1]["schema"])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(schema, self.options["path"].rstrip("/"))

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(schema, overwrite, dict(self.options))


def export(
    rows: DataFrame, path: str, mode: str = "append", file_format: str = "json", max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES
) -> None:
    """Writes the rows as bulk-import files; ``append`` adds to what is there, ``overwrite`` replaces it."""
    rows.sparkSession.dataSource.register(BulkFiles)
    rows.write.format("bulk_files").mode(mode).option("path", path).options(
        file_format=file_format, max_rows=max_rows, max_bytes=max_bytes).save()


def read(spark: SparkSession, path: str) -> DataFrame:
    """All rows that manifests name."""
    spark.dataSource.register(BulkFiles)
    return spark.read.format("bulk_files").option("path", path).load()
