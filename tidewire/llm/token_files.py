"""Token-ID output: whole texts to ids, ids to files of interleaved range-ANS blocks, and back.

File format (little endian), one file a shard, shards in ascending document order:

    magic "TWR1" | u32 version | blocks ... | footer | u64 footer length | magic "TWR1"

The frequency table is shared: one file ``table.bin`` holds a u32 frequency per id, summing to 2**SCALE_BITS.
A block codes up to LANES * STEPS ids in LANES interleaved coders of 64-bit state: id t of a block belongs to lane
t % LANES. Within a block a checkpoint every CHECK_STEPS steps holds the position in the word stream and all states;
blocks are independent. What lies between two checkpoints is a segment, which can be read and decoded alone. The footer
(zlib JSON) has the lanes, the segments (offset and bytes of their states and of their words, first id, ids, a CRC-32 of
both and one of the ids) and, per document, doc_id and length.

Files are read in ranges of READ_IDS ids, each a task's unit: it decodes from the last checkpoint before its first
document's start up to its last document's end. A file's name is its attempt's own; the manifest says which files count.

Defined cases: null or empty text gives the end id alone; null doc_id sorts first; repeated doc_ids are ordered by
their ids' bytes, equal rows follow each other; an empty table gives a table file and no shard; a text of any length is
one document of one shard, and its words get a table of their own if they are more than the common one holds; other
columns than doc_id and text are never read, whatever their names.
"""

from __future__ import annotations

import json
import math
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

MAGIC = b"TWR1"
SCALE_BITS, LANES, STEPS, CHECK_STEPS = 20, 2048, 512, 256
#: Ids a shard holds at most, unless one document is longer; bounds what a reader keeps in memory.
SHARD_IDS = 4 << 20
#: Ids of a unit of reading.
READ_IDS = LANES * CHECK_STEPS
#: Size of a worker's word table; at 60 % it starts anew.
TABLE_BITS = 21
#: Keeps words apart in one call, and how many a call takes.
MARK, PER_CALL = "\x02", 200
_U = np.uint64
_LOW = _U(1) << _U(31)


# -- tokenizer --------------------------------------------------------------------------------


class Growing:
    """An array that grows at its end."""

    def __init__(self, kind):
        self.flat, self.used = np.zeros(1 << 16, kind), 0

    def extend(self, values: np.ndarray) -> None:
        while self.used + len(values) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used : self.used + len(values)] = values
        self.used += len(values)


def spread(first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The places first[i] .. first[i] + length[i] - 1 of all i, one after another."""
    return np.repeat(first - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))


class WordTable:
    """Words with their bytes and ids, found by 64-bit hash many at a time: open addressing in arrays."""

    def __init__(self, bits: int, code: str):
        self.bits, self.mask, self.room = bits, (1 << bits) - 1, (1 << bits) * 6 // 10
        self.keys, self.entry, self.keyed = np.zeros(1 << bits, _U), np.zeros(1 << bits, np.int32), 0
        self.ids, self.raw = Growing(code), Growing(np.uint8)
        self.id_at, self.id_n, self.raw_at, self.raw_n = (Growing(np.int64) for _ in range(4))

    def find(self, h: np.ndarray) -> np.ndarray:
        """The entry of each hash, or -1."""
        out = np.full(len(h), -1, np.int64)
        todo, at = np.arange(len(h)), (h >> _U(64 - self.bits)).astype(np.int64)
        while len(todo):
            k = self.keys[at]
            hit = k == h[todo]
            out[todo[hit]] = self.entry[at[hit]]
            on = ~hit & (k != 0)
            todo, at = todo[on], (at[on] + 1) & self.mask
        return out

    def same(self, entry: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Whether data[start:end] are the bytes of each entry."""
        length = ends - starts
        out = self.raw_n.flat[entry] == length
        at = np.flatnonzero(out)
        differ = data[spread(starts[at], length[at])] != self.raw.flat[spread(self.raw_at.flat[entry[at]], length[at])]
        if differ.any():
            out[np.repeat(at, length[at])[differ]] = False
        return out

    def append(self, words: list[bytes], ids: list[np.ndarray]) -> np.ndarray:
        """New entries; without a key they can be used but not found."""
        first = self.id_at.used
        for values, at, n in ((ids, self.id_at, self.id_n), (words, self.raw_at, self.raw_n)):
            sizes = np.array([len(v) for v in values], np.int64)
            at.extend((self.ids if values is ids else self.raw).used + np.cumsum(sizes) - sizes)
            n.extend(sizes)
            if values is ids:
                self.ids.extend(np.concatenate(ids))
            else:
                self.raw.extend(np.frombuffer(b"".join(words), np.uint8))
        return np.arange(first, self.id_at.used)

    def add(self, h: np.ndarray, words: list[bytes], ids: list[np.ndarray]) -> None:
        """New entries for different hashes that aren't in the table; there must be room."""
        if self.keyed + len(h) > self.room:
            raise ValueError("the word table is full")
        entry = self.append(words, ids)
        todo, at = np.arange(len(h)), (h >> _U(64 - self.bits)).astype(np.int64)
        while len(todo):
            free = self.keys[at] == 0
            self.keys[at[free]] = h[todo[free]]
            mine = free & (self.keys[at] == h[todo])
            self.entry[at[mine]] = entry[todo[mine]]
            todo, at = todo[~mine], at[~mine]
            step = self.keys[at] != 0
            at = np.where(step, (at + 1) & self.mask, at)
        self.keyed += len(h)


class WordEncoder:
    """Ids of whole texts, the same as the tokenizer gives for them; each distinct word is encoded once.

    Words are runs between spaces and newlines, which this kind of tokenizer always drops, so the ids of a text are
    those of its words in order. It lower-cases, so A-Z are lower-cased first unless a special token may stand there;
    and a last comma or full stop after a letter a-z is a piece of its own, so it is taken as a word of its own.
    ``separable`` checks the tokenizer for all that; if it fails, texts are encoded whole.
    """

    def __init__(self, path: str, end_id: int):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.vocab = max(self.tok.get_vocab_size(with_added_tokens=True), end_id + 1)
        self.code, self.kind = ("<u2", "H") if self.vocab <= 1 << 16 else ("<u4", "I")
        self.end_id = end_id
        self.by_word = self.separable()
        mark = self.tok.encode(MARK, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None
        self.table = WordTable(TABLE_BITS, self.code)

    def separable(self) -> bool:
        d = json.loads(self.tok.to_str())
        kinds = json.dumps(d.get("normalizer")) + json.dumps(d.get("pre_tokenizer"))
        drops = '"behavior": "Removed", "invert": true' in kinds and "|[\\\\p{L}]+|[\\\\p{N}]|[^\\\\s\\\\p{L}\\\\p{N}]+" in kinds and '"Lowercase"' in kinds
        return drops and not any(t.get("lstrip") or t.get("rstrip") for t in d.get("added_tokens", []))

    def _of_words(self, new: list[str]) -> list[np.ndarray]:
        """Ids of words, PER_CALL encoded in one string: a mark that is one id, and in no word, keeps them apart."""
        out: list = [None] * len(new)
        alone = [i for i, w in enumerate(new) if self.mark is None or MARK in w]
        for i, e in zip(alone, self.tok.encode_batch_fast([new[i] for i in alone], add_special_tokens=False) if alone else []):
            out[i] = np.array(e.ids, self.code)
        rest = [i for i, w in enumerate(new) if not (self.mark is None or MARK in w)]
        parts = [rest[i : i + PER_CALL] for i in range(0, len(rest), PER_CALL)]
        texts = [f" {MARK} ".join([new[i] for i in p]) + f" {MARK}" for p in parts]
        for part, e in zip(parts, self.tok.encode_batch_fast(texts, add_special_tokens=False) if parts else []):
            ids = np.array(e.ids, self.code)
            lo = 0
            for i, hi in zip(part, np.flatnonzero(ids == self.mark).tolist(), strict=True):
                out[i] = ids[lo:hi]
                lo = hi + 1
        return out

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all documents, each followed by the end id; ids per document)."""
        n = len(offsets) - 1
        if not self.by_word:
            raw = data.tobytes()
            texts = [raw[offsets[i] : offsets[i + 1]].decode() for i in range(n)]
            got = [np.array([*e.ids, self.end_id], self.code) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
            return (np.concatenate(got) if got else np.zeros(0, self.code)), np.array([len(g) for g in got], np.int64)
        if b"<|" not in data.tobytes():
            data = _LOWER[data]
        doc, starts, ends = self._words(data, offsets)
        h = C.span_hash(C.prefix_hash(data), starts, ends)
        h[h == 0] = 1
        table = self.table
        entry = table.find(h)
        if (entry < 0).any():
            new = np.unique(h[entry < 0])
            if table.keyed + len(new) > table.room:
                # A new table; a text with more words than a common one holds has a larger one to itself.
                new = np.unique(h)
                need = math.ceil(math.log2(max(1, len(new)) / 0.6 + 1))
                table = WordTable(max(TABLE_BITS, need), self.code)
                entry[:] = -1
                if need <= TABLE_BITS:
                    self.table = table
            todo = np.flatnonzero(entry < 0)
            new, first = np.unique(h[todo], return_index=True)
            table.add(new, *self._encoded(data, starts[todo[first]], ends[todo[first]]))
            entry[todo] = table.find(h[todo])
        # Words of one hash may differ: those that aren't what their entry holds are encoded each.
        other = np.flatnonzero(~table.same(entry, data, starts, ends))
        if len(other):
            entry[other] = table.append(*self._encoded(data, starts[other], ends[other]))
        length = table.id_n.flat[entry]
        total = int(length.sum())
        out = np.full(total + n, self.end_id, self.code)
        out[np.arange(total) + np.repeat(doc, length)] = table.ids.flat[spread(table.id_at.flat[entry], length)]
        return out, (np.bincount(doc, length, n) if len(doc) else np.zeros(n)).astype(np.int64) + 1

    def _encoded(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[list[bytes], list[np.ndarray]]:
        words = [data[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist())]
        return words, self._of_words([w.decode() for w in words])

    @staticmethod
    def _words(data: np.ndarray, offsets: np.ndarray):
        inside = (data != 0x20) & (data != 0x0A)
        before, after = np.empty_like(inside), np.empty_like(inside)
        before[:1], before[1:] = False, inside[:-1]
        after[-1:], after[:-1] = False, inside[1:]
        cut = offsets[(offsets > 0) & (offsets < len(data))]
        before[cut], after[cut - 1] = False, False
        first, last = inside & ~before, inside & ~after
        tail = np.flatnonzero(last & ~first & ((data == 0x2C) | (data == 0x2E)))
        tail = tail[(data[tail - 1] >= 97) & (data[tail - 1] <= 122)]
        first[tail], last[tail - 1] = True, True
        starts = np.flatnonzero(first)
        return np.searchsorted(offsets, starts, "right") - 1, starts, np.flatnonzero(last) + 1


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_encoders: dict[tuple[str, int], WordEncoder] = {}


def encoder(path: str, end_id: int) -> WordEncoder:
    """One encoder a worker process, so its words outlive a task."""
    if (path, end_id) not in _encoders:
        _encoders[path, end_id] = WordEncoder(path, end_id)
    return _encoders[path, end_id]


def encode_texts(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """doc_id, n_tokens, ids (packed little-endian, 2 or 4 bytes each) of every whole text, end id included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path, end_id)
        width = np.dtype(enc.code).itemsize
        for b in batches:
            for lo, hi, data, offsets in C.chunks(b.column(1)):
                ids, counts = enc.encode(data, offsets)
                ends = np.concatenate([[0], np.cumsum(counts)]) * width
                packed = pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer(ends.astype("<i4").tobytes()), pa.py_buffer(ids.tobytes())])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(counts), packed], names=["doc_id", "n_tokens", "ids"])

    C.small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, n_tokens long, ids binary")


# -- range ANS --------------------------------------------------------------------------------


def scaled(counts: np.ndarray) -> np.ndarray:
    """Frequencies that sum to 2**SCALE_BITS, at least 1 for every id that occurs and 0 for others."""
    total, seen = 1 << SCALE_BITS, np.flatnonzero(counts)
    freq = np.zeros(len(counts), np.int64)
    if not len(seen):
        freq[0] = total
        return freq.astype(np.uint32)
    if len(seen) > total // 2:
        raise ValueError(f"{len(seen)} ids don't fit a table of 2**{SCALE_BITS}")
    share = counts[seen] * ((total - len(seen)) / counts.sum())
    freq[seen] = 1 + np.floor(share).astype(np.int64)
    freq[seen[int(np.argmax(share))]] += total - int(freq.sum())
    return freq.astype(np.uint32)


class Coder:
    """Codes blocks of ids under one static table, in ``lanes`` coders with a checkpoint every ``check`` steps."""

    def __init__(self, freq: np.ndarray, lanes: int = LANES, check: int = CHECK_STEPS):
        self.lanes, self.check = lanes, check
        self.freq = freq.astype(_U)
        self.start = np.concatenate([[0], np.cumsum(freq.astype(np.int64))[:-1]]).astype(_U)
        self.limit = self.freq << _U(31 - SCALE_BITS + 32)
        self._symbols = None

    @property
    def symbols(self) -> np.ndarray:
        if self._symbols is None:
            kind = np.uint16 if len(self.freq) <= 1 << 16 else np.uint32
            self._symbols = np.repeat(np.arange(len(self.freq), dtype=kind), self.freq.astype(np.int64))
        return self._symbols

    def encode(self, ids: np.ndarray) -> list[tuple[bytes, bytes, int]]:
        """Segments of a block, in order: the states at their checkpoint, their words, and how many ids they hold."""
        n, lanes = len(ids), self.lanes
        steps = -(-n // lanes)
        grid = np.zeros(steps * lanes, np.int64)
        grid[:n] = ids
        grid = grid.reshape(steps, lanes)
        live = n - (steps - 1) * lanes
        x, out, found = np.full(lanes, _LOW, _U), [], []
        bits, low = _U(SCALE_BITS), _U(0xFFFFFFFF)
        for t in range(steps - 1, -1, -1):
            s = grid[t] if t < steps - 1 else grid[t, :live]
            v = x if t < steps - 1 else x[:live]
            f = self.freq[s]
            over = v >= self.limit[s]
            if over.any():
                out.append((v[over] & low).astype("<u4").tobytes())
                v = np.where(over, v >> _U(32), v)
            q = v // f
            v = (q << bits) + (v - q * f) + self.start[s]
            x[: len(v)] = v
            if t % self.check == 0:
                found.append((x.astype("<u8").tobytes(), b"".join(reversed(out)), min(n, (t + self.check) * lanes) - t * lanes))
                out = []
        return found[::-1]

    def decode(self, states: bytes, words: bytes, n: int) -> np.ndarray:
        """The ids of a segment."""
        x, stream = np.frombuffer(states, "<u8").astype(_U), np.frombuffer(words, "<u4")
        steps = -(-n // self.lanes)
        live, out = n - (steps - 1) * self.lanes, np.empty((steps, self.lanes), np.uint32)
        bits, mask, at = _U(SCALE_BITS), _U((1 << SCALE_BITS) - 1), 0
        for t in range(steps):
            v = x if t < steps - 1 else x[:live]
            slot = v & mask
            s = self.symbols[slot]
            out[t, : len(s)] = s
            v = self.freq[s] * (v >> bits) + slot - self.start[s]
            need = np.flatnonzero(v < _LOW)
            if len(need):
                v[need] = (v[need] << _U(32)) | stream[at : at + len(need)].astype(_U)
                at += len(need)
            x[: len(v)] = v
        return out.reshape(-1)[:n]


def write_shard(uri: str, coder: Coder, docs: list, lengths: list[int], ids: np.ndarray, steps: int = STEPS) -> None:
    """One file; without its footer it isn't one, and no manifest names it before it is whole."""
    segments, parts, at, first = [], [MAGIC + struct.pack("<I", 1)], 8, 0
    for lo in range(0, len(ids), coder.lanes * steps):
        for states, words, n in coder.encode(ids[lo : lo + coder.lanes * steps]):
            segments.append([at, len(states), len(words), first, n, zlib.crc32(words, zlib.crc32(states)), zlib.crc32(ids[first : first + n].astype("<u4").tobytes())])
            parts += [states, words]
            at += len(states) + len(words)
            first += n
    footer = zlib.compress(json.dumps({"lanes": coder.lanes, "segments": segments, "docs": docs, "lengths": lengths}).encode(), 6)
    parts += [footer, struct.pack("<Q", len(footer)) + MAGIC]
    fs, path = C.open_fs(uri)
    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with fs.open_output_stream(path) as f:
        for p in parts:
            f.write(p)


def read_shard(uri: str, freq: np.ndarray, lo: int = 0, hi: int | None = None) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(doc_id, start, ids) of each document of a shard that starts at its ids lo to hi - 1, in order, decoding no more
    segments than these documents touch; raises on a failed checksum."""
    fs, path = C.open_fs(uri)
    with fs.open_input_file(path) as f:
        f.seek(f.size() - 12)
        tail = f.read(12)
        if tail[8:] != MAGIC:
            raise ValueError(f"{uri}: not a complete token file")
        (size,) = struct.unpack("<Q", tail[:8])
        f.seek(f.size() - 12 - size)
        foot = json.loads(zlib.decompress(f.read(size)))
        coder = Coder(freq, foot["lanes"])
        ends = np.cumsum(foot["lengths"])
        starts = ends - foot["lengths"]
        mine = range(*np.searchsorted(starts, [lo, starts[-1] + 1 if hi is None else hi]).tolist()) if len(ends) else range(0)
        firsts = np.array([s[3] for s in foot["segments"]])
        held, base, nth = np.zeros(0, np.uint32), None, 0
        for k in mine:
            if base is None:
                nth = int(np.searchsorted(firsts, starts[k], "right")) - 1
                base = int(firsts[nth])
            parts, have = [held], base + len(held)
            while have < ends[k]:
                at, n_states, n_words, _, n, crc, ids_crc = foot["segments"][nth]
                f.seek(at)
                states, words = f.read(n_states), f.read(n_words)
                if zlib.crc32(words, zlib.crc32(states)) != crc:
                    raise ValueError(f"{uri}: the segment at {at} is damaged")
                ids = coder.decode(states, words, n)
                if zlib.crc32(ids.astype("<u4").tobytes()) != ids_crc:
                    raise ValueError(f"{uri}: ids of the segment at {at} are damaged")
                parts.append(ids)
                have, nth = have + n, nth + 1
            if len(parts) > 1:
                held = np.concatenate(parts)
            yield foot["docs"][k], int(starts[k]), held[starts[k] - base : ends[k] - base]
            # What later documents don't need goes with the next segment.
            if len(parts) > 1:
                held, base = held[ends[k] - base :], int(ends[k])


def read_table(uri: str) -> np.ndarray:
    fs, path = C.open_fs(uri)
    with fs.open_input_file(path) as f:
        return np.frombuffer(f.read(), "<u4")


# -- distributed writer and reader ------------------------------------------------------------


def write_token_files(docs: DataFrame, out: str, tokenizer_path: str, end_id: int = 2, lanes: int = LANES, steps: int = STEPS, check: int = CHECK_STEPS) -> DataFrame:
    """Encodes every text, writes shards under ``out`` in ascending doc_id order.

    Returns the manifest (part, shard, file, first_id, n_ids, n_docs), ordered by part and shard. One pass tokenizes; ids go to a table in the
    shared folder, from which the id counts (one row per id) and the range bounds come. The frequency table is the
    only thing broadcast: it has a row per id of the vocabulary, whatever the input.
    """
    spark = docs.sparkSession
    ids = C.write_table(encode_texts(docs, tokenizer_path, end_id), "token-ids")
    probe = encoder(tokenizer_path, end_id)
    vocab, code = probe.vocab, probe.code

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocab, np.int64)
        for b in batches:
            data, _ = C.utf8(b.column(0))
            total += np.bincount(np.frombuffer(data.tobytes(), code), minlength=vocab)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())], names=["id", "n"])

    C.small_batches(spark)
    rows = ids.select("ids").mapInArrow(count, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(vocab, np.int64)
    for r in rows:
        counts[r["id"]] = r["n"]
    freq = scaled(counts)
    fs, path = C.open_fs(f"{out}/table.bin")
    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with fs.open_output_stream(path) as f:
        f.write(freq.astype("<u4").tobytes())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(freq, lanes, check)
        part, shard, held, names, sizes, total = None, 0, [], [], [], 0

        def flush():
            nonlocal shard, held, names, sizes, total
            uri = f"{out}/part-{part:06d}-{shard:06d}-{uuid.uuid4().hex}.twr"
            write_shard(uri, coder, names, sizes, np.concatenate(held), steps)
            row = pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([uri]), pa.array([total], pa.int64()), pa.array([len(names)], pa.int64())], names=["part", "shard", "file", "n_ids", "n_docs"])
            shard, held, names, sizes, total = shard + 1, [], [], [], 0
            return row

        for b in batches:
            data, offsets = C.utf8(b.column("ids"))
            flat, width = np.frombuffer(data.tobytes(), code), np.dtype(code).itemsize
            for i, doc in enumerate(b.column("doc_id").to_pylist()):
                part = b.column("part")[i].as_py() if part is None else part
                one = flat[offsets[i] // width : offsets[i + 1] // width]
                if held and total + len(one) > SHARD_IDS:
                    yield flush()
                held.append(one)
                names.append(doc)
                sizes.append(len(one))
                total += len(one)
        if held:
            yield flush()

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The last key parts equal rows, so that no doc_id is bound to one task; it is stable for a written table.
    keyed = ids.withColumn("row", F.monotonically_increasing_id())
    ranged = keyed.repartitionByRange(n, F.col("doc_id").asc_nulls_first(), F.xxhash64("ids"), "row")
    ranged = ranged.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("ids"), "row")
    files = ranged.select("doc_id", "ids", F.spark_partition_id().alias("part")).mapInArrow(write, "part int, shard int, file string, n_ids long, n_docs long")
    files = C.write_table(files, "token-manifest")
    # First ids: a sum over parts (a row for each shuffle partition), then within a part.
    from pyspark.sql import Window

    per_part = files.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    first, at = {}, 0
    for r in per_part:
        first[r["part"]] = at
        at += r["n"]
    base = spark.createDataFrame(list(first.items()) or [(-1, 0)], "part int, base long")
    within = F.coalesce(F.sum("n_ids").over(Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return files.join(base, "part").withColumn("first_id", F.col("base") + within).select("part", "shard", "file", "first_id", "n_ids", "n_docs")


def read_token_files(manifest: DataFrame, table_uri: str, read_ids: int = READ_IDS) -> DataFrame:
    """Per document: doc_id, start, n_tokens, ids_crc32, read from the files in ranges of read_ids ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        freq = read_table(table_uri)
        for b in batches:
            for uri, first, lo in zip(*(b.column(c).to_pylist() for c in ("file", "first_id", "lo"))):
                rows = [(doc, first + at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())) for doc, at, ids in read_shard(uri, freq, lo, lo + read_ids)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    units = manifest.select("file", "first_id", F.explode(F.sequence(F.lit(0), F.col("n_ids") - 1, F.lit(read_ids))).alias("lo"))
    return units.repartition(n).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_digest(docs: DataFrame, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    """Writes the token files of ``docs`` to the shared folder and returns per document what they hold."""
    out = C.new_dir(docs.sparkSession, "tokens")
    return read_token_files(write_token_files(docs, out, tokenizer_path, end_id), f"{out}/table.bin")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1(spark: SparkSession, sf_dir: str, tokenizer_path: str | None = None) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return token_digest(docs, tokenizer_path or default_tokenizer(), 2)

