"""IDX files as a Spark data source (S3): unsigned-byte tensors of any rank.

``read_idx`` plans byte ranges of the files, so a large file is read by many tasks and no task holds
more than a batch of items; ``write_idx`` turns rows into one file per writing task and renames the
files into place only when the job commits. Files are reached through ``pyarrow.fs``: plain paths,
``file://`` and the stores it knows (``s3://``, ``gs://``, ``hdfs://``).
"""

from __future__ import annotations

import os
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

#: Fixed values of the format: two zero bytes, the code of unsigned bytes, the rank; then big-endian 32-bit sizes.
UNSIGNED_BYTE = 0x08
SUFFIX = ".idx"
#: Most bytes of items that a reading task covers, fewest that are worth one, and bytes that a batch holds.
RANGE_BYTES = 32 << 20
LEAST_RANGE_BYTES = 16 << 10
BATCH_BYTES = 4 << 20
SCHEMA = "file string, row_id bigint, dims array<int>, items binary"


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), os.path.abspath(path.removeprefix("file:")))


def data_files(system: pafs.FileSystem, path: str) -> list[str]:
    """The file itself, or all IDX files below a folder in the order of their names."""
    found = system.get_file_info(path)
    if found.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    if found.type == pafs.FileType.File:
        return [path]
    inside = system.get_file_info(pafs.FileSelector(path, recursive=True))
    hidden = lambda f: any(part.startswith(("_", ".")) for part in f[len(path):].split("/"))
    return sorted(f.path for f in inside if f.type == pafs.FileType.File and not hidden(f.path))


def header(sizes: list[int]) -> bytes:
    return struct.pack(">HBB", 0, UNSIGNED_BYTE, len(sizes)) + struct.pack(f">{len(sizes)}I", *sizes)


def read_header(system: pafs.FileSystem, path: str) -> list[int]:
    """Sizes of the tensor in ``path``; raises if it is not an IDX file of unsigned bytes, or too short."""
    with system.open_input_file(path) as f:
        start = f.read_at(4, 0)
        if len(start) < 4:
            raise ValueError(f"{path}: no IDX header")
        zero, kind, rank = struct.unpack(">HBB", start)
        if zero or kind != UNSIGNED_BYTE or not rank:
            raise ValueError(f"{path}: not an IDX file of unsigned bytes")
        raw = f.read_at(4 * rank, 4)
        if len(raw) < 4 * rank:
            raise ValueError(f"{path}: header ends early")
        sizes = list(struct.unpack(f">{rank}I", raw))
        want = 4 + 4 * rank + item_bytes(sizes) * sizes[0]
        if f.size() != want:
            raise ValueError(f"{path}: {f.size()} bytes, its header asks for {want}")
    return sizes


def item_bytes(sizes: list[int]) -> int:
    out = 1
    for s in sizes[1:]:
        out *= s
    return out


@dataclass
class ByteRange(InputPartition):
    """Items ``first`` to ``last`` (exclusive) of one file."""

    path: str
    sizes: list[int]
    first: int
    last: int


class IdxReader(DataSourceReader):
    def __init__(self, path: str, range_bytes: int, tasks: int):
        self.path, self.range_bytes, self.tasks = path, range_bytes, tasks

    def partitions(self) -> list[ByteRange]:
        system, path = file_system(self.path)
        files = [(name, read_header(system, name)) for name in data_files(system, path)]
        total = sum(sizes[0] * item_bytes(sizes) for _, sizes in files)
        span = min(self.range_bytes, max(LEAST_RANGE_BYTES, total // max(1, self.tasks)))
        out = []
        for name, sizes in files:
            step = max(1, span // max(1, item_bytes(sizes)))
            out += [ByteRange(name, sizes, lo, min(lo + step, sizes[0])) for lo in range(0, sizes[0], step)]
        return out or [ByteRange("", [0], 0, 0)]

    def read(self, part: ByteRange) -> Iterator[pa.RecordBatch]:
        size = item_bytes(part.sizes)
        step = max(1, BATCH_BYTES // max(1, size))
        if part.first >= part.last:
            return
        system, _ = file_system(self.path)
        with system.open_input_file(part.path) as f:
            start = 4 + 4 * len(part.sizes)
            for lo in range(part.first, part.last, step):
                n = min(step, part.last - lo)
                raw = f.read_at(n * size, start + lo * size)
                if len(raw) != n * size:
                    raise OSError(f"{part.path}: ends within item {lo + len(raw) // max(1, size)}")
                yield pa.RecordBatch.from_pydict({
                    "file": pa.array([part.path] * n, pa.string()), "row_id": pa.array(range(lo, lo + n), pa.int64()),
                    "dims": pa.array([part.sizes[1:]] * n, pa.list_(pa.int32())), "items": pa.array([raw[i * size:(i + 1) * size] for i in range(n)], pa.binary())})


@dataclass
class Written(WriterCommitMessage):
    name: str
    rows: int


class IdxWriter(DataSourceArrowWriter):
    """A task writes its rows below ``_temporary``; the header's count is known at the end, so items are written behind
    room for it. Files get their names when the job commits and are removed when it aborts, so a task that
    is tried again leaves nothing behind."""

    def __init__(self, path: str, dims: list[int], overwrite: bool):
        self.path, self.dims, self.overwrite, self.job = path, dims, overwrite, uuid.uuid4().hex

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        system, path = file_system(self.path)
        place = TaskContext.get()
        size = item_bytes([0, *self.dims])
        name = f"part-{place.partitionId():05d}-{self.job}-{place.attemptNumber()}"
        folder = f"{path}/_temporary/{self.job}"
        system.create_dir(folder, recursive=True)
        rows = 0
        with system.open_output_stream(f"{folder}/{name}.items") as out:
            for batch in batches:
                for item in batch.column(0):
                    raw = item.as_py()
                    if raw is None or len(raw) != size:
                        raise ValueError(f"an item has {'no' if raw is None else len(raw)} bytes, {size} are wanted")
                    out.write(raw)
                rows += batch.num_rows
        with system.open_output_stream(f"{folder}/{name}{SUFFIX}") as out:
            out.write(header([rows, *self.dims]))
            with system.open_input_stream(f"{folder}/{name}.items") as items:
                while piece := items.read(BATCH_BYTES):
                    out.write(piece)
        system.delete_file(f"{folder}/{name}.items")
        return Written(f"{name}{SUFFIX}", rows)

    def commit(self, messages: list[Written | None]) -> None:
        system, path = file_system(self.path)
        old = data_files(system, path) if self.overwrite else []
        for m in messages:
            if m is not None and m.rows:
                system.move(f"{path}/_temporary/{self.job}/{m.name}", f"{path}/{m.name}")
        for f in old:
            system.delete_file(f)
        self._clean(system, path)

    def abort(self, messages: list[Written | None]) -> None:
        system, path = file_system(self.path)
        self._clean(system, path)

    def _clean(self, system: pafs.FileSystem, path: str) -> None:
        if system.get_file_info(f"{path}/_temporary/{self.job}").type == pafs.FileType.Directory:
            system.delete_dir(f"{path}/_temporary/{self.job}")
        rest = f"{path}/_temporary"
        if system.get_file_info(rest).type == pafs.FileType.Directory and not system.get_file_info(pafs.FileSelector(rest)):
            system.delete_dir(rest)


class IdxSource(DataSource):
    """``spark.read.format("idx")`` with options ``path``, ``range_bytes`` and ``tasks`` (tasks that a small table should
    still be shared out to); ``df.write.format("idx")`` of one binary
    column, with options ``path`` and ``dims`` (sizes of an item, joined by commas; empty for single bytes)."""

    @classmethod
    def name(cls) -> str:
        return "idx"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> IdxReader:
        return IdxReader(self.options["path"], int(self.options.get("range_bytes", RANGE_BYTES)), int(self.options.get("tasks", 1)))

    def writer(self, schema: StructType, overwrite: bool) -> IdxWriter:
        dims = [int(d) for d in self.options.get("dims", "").split(",") if d]
        return IdxWriter(self.options["path"], dims, overwrite)


def read_idx(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``file, row_id, dims, items``: one row per item of every IDX file at ``path`` (a file or a folder), its number in
    the file, the sizes of an item and its raw bytes. A wrong or cut header raises when the read is planned."""
    spark.dataSource.register(IdxSource)
    return spark.read.format("idx").option("path", path).option("range_bytes", range_bytes).option("tasks", spark.sparkContext.defaultParallelism).load()


def byte_array(items: str = "items") -> Column:
    """The bytes of a binary column as an array of numbers from 0 to 255 (ISO 8859-1 maps each byte to one character)."""
    return F.transform(F.split(F.decode(F.col(items), "ISO-8859-1"), ""), F.ascii)


def write_idx(rows: DataFrame, items: str, path: str, dims: list[int], mode: str = "overwrite") -> None:
    """Write a binary column, every value ``dims`` bytes long, as IDX files: one per task that has rows."""
    rows.sparkSession.dataSource.register(IdxSource)
    rows.select(F.col(items).alias("items")).write.format("idx").mode(mode).option("path", path).option("dims", ",".join(map(str, dims))).save()


def to_bytes(values: str | Column) -> Column:
    """An array of numbers from 0 to 255 as a binary value."""
    return F.unhex(F.array_join(F.transform(values, lambda v: F.lpad(F.hex(v.cast("long")), 2, "0")), ""))
