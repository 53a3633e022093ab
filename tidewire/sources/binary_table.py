"""Spark data source ``tidewire``: serialized table files, plain or in LZ4 blocks; one partition a file.

Options: temporal (micros or nanos), nestedInfNull; for writes block (log2 of LZ4 block bytes) and rows (most rows of a
file, 4,000,000 unless set). A schema given to the reader may name fewer columns: the others are passed over. The path may be a file, a folder or a glob of any file system that pyarrow opens. A file
whose columns differ from the schema fails.

Tasks write hidden files, which readers pass over; the driver shows those of the attempts that count once all tasks have
ended, so a task that is run again adds no rows twice. Overwriting removes the old files after that. Files are shown one
by one: if the driver is lost meanwhile, some of the new ones are there, beside the old ones where these were to go.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from ..errors import ConnectionFailed
from ..operators.tables import MICROS, as_batch, empty_batch, spark_schema, wire_schema, with_kinds
from ..shipping import ship
from ..wire import read_table_bytes, zip_table

#: Most rows of a file, which a writing task holds at a time.
ROWS = 4_000_000


def file_system(uri: str):
    """(pyarrow file system, path) of a URI or a local path."""
    from pyarrow import fs

    if "://" in uri and not uri.startswith("file:"):
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri.removeprefix("file://").removeprefix("file:")


def _files(path: str) -> list[str]:
    from fnmatch import fnmatch

    from pyarrow import fs

    where, base = file_system(path)
    prefix = path[: len(path) - len(base)] if path.endswith(base) else ""
    if any(c in base for c in "*?["):
        top = base[: min(base.find(c) for c in "*?[" if c in base)].rsplit("/", 1)[0]
        found = where.get_file_info(fs.FileSelector(top, recursive=True))
        names = [f.path for f in found if f.type == fs.FileType.File and fnmatch(f.path, base)]
    else:
        info = where.get_file_info(base)
        if info.type == fs.FileType.NotFound:
            raise ConnectionFailed(f"{path}: no such file or folder")
        names = [base] if info.type == fs.FileType.File else [f.path for f in where.get_file_info(fs.FileSelector(base, recursive=True)) if f.type == fs.FileType.File]
    return [prefix + n for n in sorted(names) if not n.rsplit("/", 1)[-1].startswith(("_", "."))]


def read_file(path: str, nested_inf_null: bool = False, columns: frozenset[str] | None = None) -> pa.Table:
    """The table of one file, or only those columns of it, on the driver or in a task."""
    where, base = file_system(path)
    try:
        with where.open_input_file(base) as f:
            return read_table_bytes(f.read(), nested_inf_null, columns)
    except OSError as e:
        raise ConnectionFailed(str(e)) from e


@dataclass
class _File(InputPartition):
    path: str

    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.schema, self.options = schema, dict(options)

    def partitions(self) -> list[InputPartition]:
        return [_File(p) for p in _files(self.options["path"])]

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        table = read_file(partition.path, self.options.get("nestedinfnull", "false") == "true", frozenset(self.schema.names))
        batch = as_batch(table, self.schema)
        for lo in range(0, max(1, batch.num_rows), 65536):
            yield batch.slice(lo, 65536)


@dataclass
class _Written(WriterCommitMessage):
    names: list[str]


class _Writer(DataSourceArrowWriter):
    def __init__(self, schema: T.StructType, options: dict, overwrite: bool):
        import uuid

        self.schema, self.kinds, self.options, self.overwrite, self.job = schema, wire_schema(schema), dict(options), overwrite, uuid.uuid4().hex

    def _put(self, batches: list[pa.RecordBatch]) -> str:
        """Writes a hidden file; returns the name it is to have."""
        import uuid

        block = self.options.get("block")
        where, base = file_system(self.options["path"])
        where.create_dir(base, recursive=True)
        name = f"part-{self.job}-{uuid.uuid4().hex}"
        with where.open_output_stream(f"{base}/.{name}", compression=None) as f:
            f.write(zip_table(pa.Table.from_batches([with_kinds(b, self.kinds) for b in batches]), int(block) if block else None))
        return name

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        most = int(self.options.get("rows", ROWS))
        names, held, n = [], [], 0
        for b in iterator:
            lo = 0
            while lo < b.num_rows:
                piece = b.slice(lo, most - n)
                held.append(piece)
                lo, n = lo + piece.num_rows, n + piece.num_rows
                if n == most:
                    names.append(self._put(held))
                    held, n = [], 0
        if held:
            names.append(self._put(held))
        return _Written(names)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        path = self.options["path"]
        where, base = file_system(path)
        old = _files(path) if self.overwrite and where.get_file_info(base).type.name != "NotFound" else []
        names = [n for m in messages if m is not None for n in m.names]
        # Without rows the schema still needs a file.
        for n in names or [self._put([empty_batch(self.schema)])]:
            where.move(f"{base}/.{n}", f"{base}/{n}")
        for o in old:
            where.delete_file(file_system(o)[1])
        self._clean()

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._clean()

    def _clean(self) -> None:
        """Removes hidden files of attempts that don't count; one of a task that is still running may come after it."""
        from pyarrow import fs

        where, base = file_system(self.options["path"])
        for f in where.get_file_info(fs.FileSelector(base, allow_not_found=True)):
            if f.base_name.startswith(f".part-{self.job}-"):
                where.delete_file(f.path)


class BinaryTableSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tidewire"

    def schema(self) -> T.StructType:
        files = _files(self.options["path"])
        if not files:
            raise ConnectionFailed(f"{self.options['path']}: no files")
        return spark_schema(read_file(files[0]), self.options.get("temporal", MICROS))

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(schema, self.options)

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(schema, self.options, overwrite)


def register(spark: SparkSession) -> None:
    """Makes the formats ``tidewire``, ``tidewire-remote`` and ``tidewire-updates`` known, and TIME columns usable."""
    from .remote_table import RemoteTableSource
    from .remote_updates import RemoteUpdatesSource

    ship(spark)
    for source in (BinaryTableSource, RemoteTableSource, RemoteUpdatesSource):
        spark.dataSource.register(source)
    spark.conf.set("spark.sql.timeType.enabled", "true")
