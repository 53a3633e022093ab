"""Helpers shared by the operators: the shared folder, whole-text word arrays, stable hashes."""

from __future__ import annotations

import os
import tempfile
import uuid
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship

#: Bytes of text that a Python worker turns into arrays at a time; a longer document is taken alone.
CHUNK_BYTES = 1 << 20
#: Rows in an Arrow batch: documents may hold 100 KB or more, so a batch stays small.
ARROW_ROWS = 512

_U = np.uint64


# -- shared storage ---------------------------------------------------------------------------


def shared_dir(spark: SparkSession) -> str:
    """URI of the folder all executors see: spark.checkpoint.dir; if that is unset, in local mode alone, a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"spark.checkpoint.dir isn't set, and {master} has executors that don't see the driver's folders")
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="tidewire-"))
        found = spark.sparkContext.getCheckpointDir()
    return found if "://" in found or found.startswith("file:") else "file://" + os.path.abspath(found)


def new_dir(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/tidewire/{name}-{uuid.uuid4().hex}"


def write_table(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Cut lineage: write to the shared folder and read back. Lost executors cost no more than a reread."""
    path = new_dir(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written = path
    return out


def drop_table(df: DataFrame) -> None:
    """Delete what write_table wrote, once all that was made of it has been written too."""
    jvm = df.sparkSession.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(df._written)
    path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def small_batches(spark: SparkSession) -> None:
    """Before any Python stage: bounds the rows in the batches that workers get, and sees that they find this package."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def open_fs(uri: str):
    """(pyarrow file system, path) of a URI, on executors and the driver alike."""
    from pyarrow import fs

    parsed = urlparse(uri)
    if parsed.scheme in ("", "file"):
        return fs.LocalFileSystem(), unquote(parsed.path or uri)
    return fs.FileSystem.from_uri(uri)


# -- schema -----------------------------------------------------------------------------------


def free_name(df: DataFrame, base: str) -> str:
    """A column name that clashes with none of df's, upper or lower case."""
    taken = {c.lower() for c in df.columns}
    name = f"__{base}"
    while name.lower() in taken:
        name += "_"
    return name


def text_key(column: str = "text"):
    """128-bit content key of a text, null as empty."""
    return F.unhex(F.md5(F.encode(F.coalesce(F.col(column), F.lit("")), "UTF-8")))


# -- texts as arrays --------------------------------------------------------------------------


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column, null as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_string()
    if column.null_count:
        column = pc.fill_null(column, b"" if kind == pa.large_binary() else "")
    column = column.cast(kind)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = column.buffers()[2] if len(column) else None
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES):
    """Yields (first row, end row, bytes, offsets) pieces of about limit bytes; documents stay whole."""
    data, offsets = utf8(column)
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, end) of each maximal run of bytes other than 0x20 and 0x09-0x0D."""
    inside = ~_SPACE[data]
    before, after = np.empty_like(inside), np.empty_like(inside)
    before[:1], before[1:] = False, inside[:-1]
    after[-1:], after[:-1] = False, inside[1:]
    cut = offsets[(offsets > 0) & (offsets < len(data))]
    before[cut], after[cut - 1] = False, False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return np.searchsorted(offsets, starts, "right") - 1, starts, ends


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_ROOT = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, 1 << 16)
        tables = []
        for root in (_ROOT, pow(_ROOT, -1, 1 << 64)):
            t = np.full(size, root, _U)
            t[0] = 1
            tables.append(np.multiply.accumulate(t))
        _powers[:] = tables
    return _powers


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums of a polynomial hash modulo 2**64; see span_hash."""
    up = _power_tables(len(data) + 1)[0]
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum((data.astype(_U) + _U(1)) * up[: len(data)], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each data[start:end]; equal bytes have equal hashes wherever they stand."""
    down = _power_tables(len(sums))[1]
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U) * _U(0xD6E8FEB86659FD93))


def word_hashes(data: np.ndarray, offsets: np.ndarray):
    """(document, start, end, hash) of all words."""
    doc, starts, ends = words(data, offsets)
    return doc, starts, ends, span_hash(prefix_hash(data), starts, ends)


def shingles(doc: np.ndarray, hashes: np.ndarray, k: int, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of all k-word shingles; a document of 1 to k-1 words has one, of all its words."""
    n = len(hashes)
    out_doc, out = np.zeros(0, np.int64), np.zeros(0, _U)
    if n >= k:
        acc = np.zeros(n - k + 1, _U)
        for j in range(k):
            acc = acc * _U(0xC2B2AE3D27D4EB4F) + hashes[j : n - k + 1 + j]
        same = doc[: n - k + 1] == doc[k - 1 :]
        out_doc, out = doc[: n - k + 1][same], mix(acc[same])
    counts = np.bincount(doc, minlength=n_docs) if n else np.zeros(n_docs, np.int64)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        first = np.searchsorted(doc, short)
        acc = np.zeros(len(short), _U)
        for j in range(k - 1):
            live = counts[short] > j
            acc[live] = acc[live] * _U(0xC2B2AE3D27D4EB4F) + hashes[first[live] + j]
        out_doc, out = np.concatenate([out_doc, short]), np.concatenate([out, mix(acc + counts[short].astype(_U))])
        order = np.argsort(out_doc, kind="stable")
        out_doc, out = out_doc[order], out[order]
    return out_doc, out
