"""WARC archives: written, read back, and indexed by an external k-way merge.

Each writer task makes one archive per ARCHIVE_BYTES of records, each record its own gzip member. A payload that
occurs more than once is stored once, by the row with the largest page_id; the others are revisit records that name
it. Readers parse whole archives record by record and check lengths and digests. Each archive gives a run of captures
sorted by URL key and timestamp. The index is merged from these runs: sampled keys cut the key space into ranges, and
a task merges one range of all runs with a loser tree, FAN_IN runs at a time, and writes it as one file of the index.
The files in order of their parts are all captures in global order; a capture's rank is its place in them.

Defined cases: a null html is an empty payload, and equal payloads of length 0 are revisits too; a null URL is written
as an empty one; rows with equal page_id and payload are all responses if they hold the largest page_id of the payload;
a null page_id comes before all others. An empty table gives no archive and no rows. A payload of any length is one
record; other columns than page_id, url and html are never read, whatever their names. Captures that are equal in URL
key, time and page_id are ranked by their place in the archives.
"""

from __future__ import annotations

import base64
import datetime
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

ARCHIVE_BYTES, FAN_IN, LEVEL = 64 << 20, 64, 1
#: Capture times are made from page_id: seconds after this moment.
EPOCH = datetime.datetime(2024, 1, 1)
VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def url_key(url: str) -> str:
    """Sort key of a URL: host labels reversed, then port and path; scheme, case of the host, a leading www and fragment don't count."""
    rest = url.split("://", 1)[-1].split("#", 1)[0]
    cut = min((i for i in (rest.find(c) for c in "/?") if i >= 0), default=len(rest))
    host, tail = rest[:cut].lower().rsplit("@", 1)[-1], rest[cut:] or "/"
    host, _, port = host.partition(":")
    host = host.removeprefix("www.")
    return ",".join(reversed(host.split("."))) + (f":{port}" if port else "") + ")" + tail


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def date(page_id: int | None) -> str:
    return (EPOCH + datetime.timedelta(seconds=(page_id or 0) % 10**10)).strftime("%Y-%m-%dT%H:%M:%SZ")


def _one_line(value: str) -> str:
    return "".join(f"%{b:02X}" if b < 33 or b == 127 else chr(b) for b in value.encode("utf-8")).encode("latin-1").decode("utf-8")


def make_record(page_id, url: str, payload: bytes, digest: str, target) -> bytes:
    """One gzip member. target: (page_id,) of the response that a revisit refers to, or None."""
    kind = "response" if target is None else "revisit"
    head = [("WARC-Type", kind), ("WARC-Record-ID", record_id(page_id)), ("WARC-Date", date(page_id)), ("WARC-Target-URI", _one_line(url)), ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", str(len(payload)))]
    if target is not None:
        head += [("WARC-Refers-To", record_id(target[0])), ("WARC-Profile", PROFILE)]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http + (payload if target is None else b"")
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    raw = VERSION + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def parse_record(raw: bytes) -> dict:
    """Header fields and payload of one record; raises if lengths or the digest don't hold."""
    if not raw.startswith(VERSION):
        raise ValueError("not a WARC record")
    end = raw.index(b"\r\n\r\n")
    head = dict(line.split(": ", 1) for line in raw[len(VERSION) : end].decode().split("\r\n"))
    size = int(head["Content-Length"])
    block = raw[end + 4 : end + 4 + size]
    if len(block) != size or raw[end + 4 + size :] != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    payload = block[block.index(b"\r\n\r\n") + 4 :]
    if head["WARC-Type"] == "response":
        if len(payload) != int(head["X-Payload-Length"]) or base64.b32encode(hashlib.sha1(payload).digest()).decode() != head["WARC-Payload-Digest"][5:]:
            raise ValueError("a record's payload is damaged")
    head["payload"] = payload
    return head


def read_archive(uri: str) -> Iterator[tuple[int, dict]]:
    """(offset, record) of each gzip member of an archive, read as a stream."""
    fs, path = C.open_fs(uri)
    with fs.open_input_stream(path, compression=None) as f:
        data, at = b"", 0
        while True:
            if not data and not (data := f.read(1 << 20)):
                return
            z, out, used = zlib.decompressobj(31), [], 0
            while not z.eof:
                if not data and not (data := f.read(1 << 20)):
                    raise ValueError(f"{uri}: the archive ends within a record")
                out.append(z.decompress(data))
                used += len(data) - len(z.unused_data)
                data = z.unused_data
            yield at, parse_record(b"".join(out))
            at += used


class LoserTree:
    """Least item of k sorted iterators, with one comparison a level for each item taken."""

    def __init__(self, runs: list[Iterator]):
        self.runs, self.k = runs, len(runs)
        self.head = [next(r, None) for r in runs]
        self.tree = [-1] * max(1, self.k)
        for i in range(self.k):
            self._play(i)

    def _less(self, a: int, b: int) -> bool:
        """Whether run a goes before run b; an ended run goes last, and equal items by run."""
        x, y = self.head[a], self.head[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return (x, a) < (y, b)

    def _play(self, winner: int) -> None:
        node = (winner + self.k) // 2
        while node:
            if self.tree[node] == -1:  # the first to come waits for its opponent
                self.tree[node] = winner
                return
            if self._less(self.tree[node], winner):
                self.tree[node], winner = winner, self.tree[node]
            node //= 2
        self.tree[0] = winner

    def __iter__(self):
        if not self.k:
            return
        while (item := self.head[w := self.tree[0]]) is not None:
            yield item
            self.head[w] = next(self.runs[w], None)
            self._play(w)


# -- runs: sorted captures on the shared folder -----------------------------------------------

INDEX_EVERY = 256


def pack(capture: tuple) -> bytes:
    """(url key, time, page_id, file, offset, kind, digest, bytes, refers_to) as one length-prefixed entry."""
    fields = ["" if x is None else str(x) for x in capture]
    body = "\x1f".join(f.replace("\x1f", "%1F") for f in fields).encode()
    return struct.pack("<I", len(body)) + body


def unpack(body: bytes) -> tuple:
    f = body.decode().split("\x1f")
    number = lambda x: int(x) if x else None
    return f[0], f[1], number(f[2]), f[3], int(f[4]), f[5], f[6], int(f[7]), number(f[8])


def order(c: tuple) -> tuple:
    """URL key, time, then page_id (null first) and place: a total order."""
    return c[0], c[1], c[2] is not None, c[2] or 0, c[3], c[4]


def write_run(uri: str, captures: Iterable[tuple]) -> None:
    """A sorted run with a sparse index of every INDEX_EVERY-th key at its end."""
    marks, at = [], 0
    fs, path = C.open_fs(uri)
    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with fs.open_output_stream(path) as f:
        for i, c in enumerate(captures):
            entry = pack(c)
            if i % INDEX_EVERY == 0:
                key = json.dumps(order(c)[:4]).encode()
                marks.append(struct.pack("<QI", at, len(key)) + key)
            f.write(entry)
            at += len(entry)
        index = b"".join(marks)
        f.write(index + struct.pack("<QI", at, len(marks)))


def read_run(uri: str, lo: tuple | None, hi: tuple | None) -> Iterator[tuple]:
    """Captures of a run with lo <= order < hi, reading from the mark before lo."""
    fs, path = C.open_fs(uri)
    with fs.open_input_file(path) as f:
        f.seek(f.size() - 12)
        end, n = struct.unpack("<QI", f.read(12))
        f.seek(end)
        index, pos, start = f.read(f.size() - 12 - end), 0, 0
        for _ in range(n):
            at, size = struct.unpack_from("<QI", index, pos)
            key = tuple(json.loads(index[pos + 12 : pos + 12 + size]))
            pos += 12 + size
            if lo is None or key >= lo:
                break
            start = at
        f.seek(start)
        left, data = end - start, b""
        while left or data:
            while len(data) < 4 or len(data) < 4 + struct.unpack_from("<I", data)[0]:
                more = f.read(min(left, 1 << 16))
                left -= len(more)
                data += more
            at = 0
            while len(data) - at >= 4 and len(data) - at >= 4 + (size := struct.unpack_from("<I", data, at)[0]):
                c = unpack(data[at + 4 : at + 4 + size])
                at += 4 + size
                key = order(c)[:4]
                if hi is not None and key >= hi:
                    return
                if lo is None or key >= lo:
                    yield c
            data = data[at:]


def merged(uris: list[str], lo: tuple | None, hi: tuple | None) -> Iterator[tuple]:
    """One key range of some runs, in order."""
    for _, c in LoserTree([((order(c), c) for c in read_run(u, lo, hi)) for u in uris]):
        yield c


# -- distributed ------------------------------------------------------------------------------

CAPTURE = "url_key string, time string, page_id long, file string, offset long, record_type string, payload_digest string, payload_bytes long, refers_to long"


def write_archives(pages: DataFrame, out: str) -> DataFrame:
    """Writes all rows to archives under ``out``; returns their names, (part, file, records)."""
    spark = pages.sparkSession
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("body"))
    keyed = rows.withColumn("sha", F.unhex(F.sha1("body")))
    # Digests that occur once need no join: only the others' winners are kept, by digest, with their largest page_id.
    winners = keyed.groupBy("sha").agg(F.max("page_id").alias("best"), F.count("*").alias("n")).filter("n > 1").select(F.col("sha").alias("w_sha"), "best")
    winners = C.write_table(winners, "winners")  # so that a hot digest's rows can be split in the join
    joined = keyed.join(winners, F.col("sha") == F.col("w_sha"), "left").select("page_id", "url", "body", "sha", F.col("w_sha").isNotNull().alias("shared"), "best")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f, uri, size, n = None, None, 0, 0
        done = []
        for b in batches:
            for page, url, body, sha, shared, best in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "body", "sha", "shared", "best"))):
                if f is None:
                    # Another name for each attempt: a retried task never meets its own parts.
                    uri = f"{out}/{uuid.uuid4().hex}.warc.gz"
                    fs, path = C.open_fs(uri)
                    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
                    f, size, n = fs.open_output_stream(path, compression=None), 0, 0
                target = (best,) if shared and page != best else None
                raw = make_record(page, url, body, base64.b32encode(sha).decode(), target)
                f.write(raw)
                size, n = size + len(raw), n + 1
                if size >= ARCHIVE_BYTES:
                    f.close()
                    done.append((uri, n))
                    f = None
        if f is not None:
            f.close()
            done.append((uri, n))
        yield pa.RecordBatch.from_arrays([pa.array([u for u, _ in done], pa.string()), pa.array([k for _, k in done], pa.int64())], names=["file", "records"])

    C.small_batches(spark)
    return C.write_table(joined.mapInArrow(run, "file string, records long"), "archives")


def read_archives(archives: DataFrame, out: str) -> DataFrame:
    """Reads whole archives back; writes each one's sorted run and returns (run, captures, keys): a sample of its keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        page = lambda x: None if x == "<urn:page:none>" else int(x[10:-1])
        for b in batches:
            for uri, n in zip(b.column("file").to_pylist(), b.column("records").to_pylist()):
                got = []
                for at, r in read_archive(uri):
                    refers = page(r["WARC-Refers-To"]) if "WARC-Refers-To" in r else None
                    got.append((url_key(r["WARC-Target-URI"]), r["WARC-Date"], page(r["WARC-Record-ID"]), uri.rsplit("/", 1)[-1], at, r["WARC-Type"], r["WARC-Payload-Digest"][5:], int(r["X-Payload-Length"]), refers))
                if len(got) != n:
                    raise ValueError(f"{uri}: {len(got)} records, {n} written")
                got.sort(key=order)
                to = f"{out}/{uri.rsplit('/', 1)[-1]}.run"
                write_run(to, got)
                step = max(1, len(got) // 64)
                yield pa.RecordBatch.from_arrays([pa.array([to]), pa.array([len(got)], pa.int64()), pa.array([[json.dumps(order(c)[:4]) for c in got[step // 2 :: step]]], pa.list_(pa.string()))], names=["run", "captures", "keys"])

    spark = archives.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return C.write_table(archives.repartition(n).mapInArrow(run, "run string, captures long, keys array<string>"), "runs")


def merge_index(runs: DataFrame, out: str, ranges: int | None = None) -> DataFrame:
    """Writes the merged index of all captures of the runs, a file for each part; returns (part, file, captures).

    The key space is cut at sampled captures, not just URL keys, so one URL's many captures can be in several parts.
    A task merges one range of at most FAN_IN runs; while there are more, their merged slices are runs of the next level.
    """
    spark = runs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = ranges or n
    sample = runs.select(F.explode("keys").alias("k")).orderBy(F.xxhash64("k"), "k").limit(ranges * 200).collect()
    keys = sorted({tuple(json.loads(r["k"])) for r in sample})
    bounds = sorted({keys[i * len(keys) // ranges] for i in range(1, ranges)}) if keys else []
    ends = [json.dumps(b) for b in bounds]
    cut = F.array(*[F.struct(F.lit(i).alias("part"), F.lit(lo).cast("string").alias("lo"), F.lit(hi).cast("string").alias("hi")) for i, (lo, hi) in enumerate(zip([None, *ends], [*ends, None]))])

    def in_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            files = b.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([files[i : i + FAN_IN] for i in range(0, len(files), FAN_IN)], pa.list_(pa.string()))], names=["files"])

    count = runs.count()
    groups = runs.select("run").coalesce(max(1, count // (16 * FAN_IN))).mapInArrow(in_groups, "files array<string>")
    work = groups.select("files", F.explode(cut).alias("r")).select("r.part", "r.lo", "r.hi", "files")
    bound = lambda x: None if x is None else tuple(json.loads(x))

    def to_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, lo, hi, files in zip(*(b.column(c).to_pylist() for c in ("part", "lo", "hi", "files"))):
                to = f"{out}/{uuid.uuid4().hex}.run"
                write_run(to, merged(files, bound(lo), bound(hi)))
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([lo], pa.string()), pa.array([hi], pa.string()), pa.array([to])], names=["part", "lo", "hi", "run"])

    lists = groups.count()
    while lists > 1:
        slices = C.write_table(work.repartition(n).mapInArrow(to_runs, "part int, lo string, hi string, run string"), "slices")
        per = slices.groupBy("part", "lo", "hi").agg(F.collect_list("run").alias("all"))
        starts = F.sequence(F.lit(1), F.size("all"), F.lit(FAN_IN))
        work = per.select("part", "lo", "hi", F.explode(F.transform(starts, lambda i: F.slice("all", i, FAN_IN))).alias("files"))
        lists = -(-lists // FAN_IN)

    def to_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, lo, hi, files in zip(*(b.column(c).to_pylist() for c in ("part", "lo", "hi", "files"))):
                # Another name for each attempt: the table says which file counts.
                to, n = f"{out}/index-{part:06d}-{uuid.uuid4().hex}.run", 0

                def counted() -> Iterator[tuple]:
                    nonlocal n
                    for c in merged(files, bound(lo), bound(hi)):  # noqa: B023
                        n += 1
                        yield c

                write_run(to, counted())
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([to]), pa.array([n], pa.int64())], names=["part", "file", "captures"])

    return C.write_table(work.repartition(ranges).mapInArrow(to_files, "part int, file string, captures long"), "index")


def read_index(index: DataFrame) -> DataFrame:
    """All captures of an index, as columns of CAPTURE, ``part`` and ``rank``, the place in the global order from 0."""
    spark = index.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
        cols = ["url_key", "time", "page_id", "file", "offset", "record_type", "payload_digest", "payload_bytes", "refers_to", "part", "rank"]
        for b in batches:
            for part, file, n, rank in zip(*(b.column(c).to_pylist() for c in ("part", "file", "captures", "base"))):
                it, end = read_run(file, None, None), rank + n
                while held := list(islice(it, 4096)):
                    yield pa.RecordBatch.from_arrays([*(pa.array(c, k) for c, k in zip(zip(*held), kinds)), pa.array([part] * len(held), pa.int32()), pa.array(range(rank, rank + len(held)), pa.int64())], names=cols)
                    rank += len(held)
                if rank != end:
                    raise ValueError(f"{file}: its captures aren't those written")

    # A row for each part, of which there are as many as shuffle partitions.
    base, at = [], 0
    for r in index.orderBy("part").collect():
        base.append((r["part"], at))
        at += r["captures"]
    parts = index.join(spark.createDataFrame(base or [(-1, 0)], "part int, base long"), "part")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return parts.repartition(n).mapInArrow(run, CAPTURE + ", part int, rank long")


def archive_pages(pages: DataFrame) -> DataFrame:
    """Writes the pages to archives in the shared folder, reads them back, merges and reads the capture index."""
    out = C.new_dir(pages.sparkSession, "warc")
    return read_index(merge_index(read_archives(write_archives(pages, out), out), out))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = archive_pages(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", F.col("rank").alias("index_rank"))

