"""Removal of repeated substrings: every byte covered by a LENGTH-byte string that also starts anywhere else.

Equal LENGTH-byte strings have the same anchor at the same place: the leftmost K-byte string of least hash within.
A run of windows with one anchor is a context; contexts are grouped by their anchor's hash, and equal contexts fall
together with a count before any bytes move. What is left, different contexts of one anchor, is a collection of short
documents aligned at the anchor. Its suffixes are sorted column by column from the right: each round reads the next
column of an external file, puts one symbol before every document's suffix, and updates the order of the suffixes and
the common prefixes of neighbours; the symbols read in that order are the column's part of the collection's
Burrows-Wheeler transform. A window repeats if its suffix shares LENGTH bytes with a neighbour in its column.

Only suffixes of one column need to be compared, as equal strings are aligned, so a round costs as much as there are
documents, not as there are symbols so far. An anchor with more than CAP different contexts is split: its windows are
halved by place, and each half's contexts are grouped anew by the bytes that all windows of the half share, until
groups are small or hold one window, where equal contexts are the answer. Nothing is capped or sampled.

The same construction runs over words, a symbol each, for a further column: passages of more than 50 words that stand
in another document too, many of which are shorter than 400 bytes. They are counted, not removed.

Defined cases: null text is empty; texts shorter than LENGTH bytes lose nothing; equal texts of LENGTH bytes or more
lose everything; rows are told apart by their text's two 64-bit hashes, so equal rows are occurrences of each other;
a null doc_id is kept; what is gathered of a text in one row, its repeated anchors and spans, is about as large as the
text at most; an empty table gives an empty one; a very long text is read a PIECE at a time; other columns
than doc_id and text are never read, whatever their names.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

CAP, BATCH = 4096, 4096
PIECE = 1 << 20
#: Columns that are turned to rows of the external file at a time.
SLAB = 64
_U = np.uint64
_LOW = _U((1 << 24) - 1)


class Unit(NamedTuple):
    """What a symbol is: bytes or words. Windows have ``length`` symbols, anchors ``k``."""

    code: int
    length: int
    k: int
    kind: str
    #: Whether only what stands in several documents counts.
    across: bool

    @property
    def places(self) -> int:
        """Places of an anchor in a window."""
        return self.length - self.k + 1

    def symbols(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.kind == "u1":
            return data, offsets
        doc, _, _, h = C.word_hashes(data, offsets)
        return h, np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(offsets) - 1))])


BYTES, WORDS = Unit(0, 400, 128, "u1", False), Unit(1, 51, 10, "<u8", True)
UNITS = (BYTES, WORDS)
LENGTH = BYTES.length


# -- anchors ----------------------------------------------------------------------------------


def _sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    n = len(v)
    pad = -n % w
    blocks = np.concatenate([v, np.full(pad, 0xFFFFFFFFFFFFFFFF, _U)]).reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[: n - w + 1], ahead[w - 1 : n])


def anchors(data: np.ndarray, offsets: np.ndarray, unit: Unit = BYTES):
    """(document, anchor, first window, last window, key, context hash) of all contexts; positions are in the document."""
    size = np.diff(offsets)
    long = np.flatnonzero(size >= unit.length)
    cols: list[list[np.ndarray]] = [[] for _ in range(6)]
    if not len(long):
        return [np.zeros(0, np.int64)] * 4 + [np.zeros(0, _U)] * 2
    edge = np.zeros(len(data) + 1, np.int32)
    np.add.at(edge, offsets[long], 1)
    np.add.at(edge, offsets[long + 1] - unit.length + 1, -1)
    valid = np.cumsum(edge[:-1]) > 0
    for at in range(0, len(data), PIECE):
        part = data[at : at + PIECE + unit.length - 1]
        if len(part) < unit.length:
            break
        sums = C.prefix_hash(part)
        n = len(part) - unit.k + 1
        h = C.span_hash(sums, np.arange(n), np.arange(unit.k, len(part) + 1)) ^ _U(unit.code)
        m = _sliding_min((h & ~_LOW) | np.arange(n, dtype=_U), unit.places)
        p = np.flatnonzero(valid[at : at + len(m)])
        if not len(p):
            continue
        a = (m[p] & _LOW).astype(np.int64)
        new = np.ones(len(p), bool)
        new[1:] = (a[1:] != a[:-1]) | (p[1:] != p[:-1] + 1)
        first = np.flatnonzero(new)
        last = np.concatenate([first[1:], [len(p)]]) - 1
        lo, hi, a = p[first], p[last], a[first]
        ctx = C.mix(C.span_hash(sums, lo, hi + unit.length) + (a - lo).astype(_U) * _U(0x9E3779B97F4A7C15))
        doc = np.searchsorted(offsets, lo + at, "right") - 1
        shift = at - offsets[doc]
        for c, x in zip(cols, (doc, a + shift, lo + shift, hi + shift, h[a], ctx)):
            c.append(x)
    return [np.concatenate(c) if c else np.zeros(0, _U if i > 3 else np.int64) for i, c in enumerate(cols)]


# -- column-wise construction -----------------------------------------------------------------


def repeated_windows(group: np.ndarray, left: np.ndarray, texts: list[bytes], unit: Unit = BYTES, rows: tuple[np.ndarray, np.ndarray] | None = None) -> list[list[tuple[int, int]]]:
    """For each document, ranges of window starts, from the anchor, whose symbols another document of its group
    has at the same place. Documents are sorted by group; left is the anchor's place in each; rows are the least and
    the greatest row of the table that has each, if windows of one row alone don't count."""
    m = len(texts)
    flat, kind = np.frombuffer(b"".join(texts), unit.kind), np.dtype(unit.kind)
    size = np.array([len(t) // kind.itemsize for t in texts])
    base = np.cumsum(size) - size + left
    right = size - left
    out: list[list[tuple[int, int]]] = [[] for _ in range(m)]
    low, high = -int(left.max()), int(right.max())
    flags = np.zeros((1 - low, m), bool)
    with tempfile.TemporaryFile() as columns:
        # One column of symbols after another, from the right; a document has symbols in columns -left .. right - 1.
        for top in range(high - 1, low - 1, -SLAB):
            at = np.arange(top, max(top - SLAB, low - 1), -1)[:, None]
            columns.write(np.where((at >= -left) & (at < right), flat[np.clip(base + at, 0, len(flat) - 1)], 0).astype(kind).tobytes())
        columns.seek(0)
        order, lcp = np.zeros(0, np.int64), np.zeros(0, np.int32)
        by_right = np.argsort(-right, kind="stable")
        by_left = np.argsort(left, kind="stable")
        come = go = 0
        for c in range(high - 1, low - 1, -1):
            symbols = np.frombuffer(columns.read(m * kind.itemsize), kind)
            # Documents that end here come in with empty suffixes, the least of their group.
            upto = come
            while upto < m and right[by_right[upto]] == c + 1:
                upto += 1
            if upto > come:
                both = np.concatenate([np.sort(by_right[come:upto]), order])
                where = np.argsort(group[both], kind="stable")
                order, lcp = both[where], np.concatenate([np.zeros(upto - come, np.int32), lcp])[where]
                come = upto
            # Documents without a symbol here leave; common prefixes across them are the least of both.
            upto = go
            while upto < m and -left[by_left[upto]] > c:
                upto += 1
            if upto > go:
                gone = np.zeros(m, bool)
                gone[by_left[go:upto]] = True
                kept = np.flatnonzero(~gone[order])
                if len(kept):
                    lcp = np.minimum.reduceat(lcp[: kept[-1] + 1], np.concatenate([[0], kept[:-1] + 1]))
                    lcp[0] = 0
                else:
                    lcp = lcp[:0]
                order, go = order[kept], upto
            if not len(order):
                continue
            # Insert the column's symbols: the new order is stable by group and symbol.
            s, g = symbols[order], group[order]
            to = np.argsort(g.astype(np.int64) * 256 + s, kind="stable") if kind.itemsize == 1 else np.lexsort((s, g))
            same = (g[to][1:] == g[to][:-1]) & (s[to][1:] == s[to][:-1])
            now = np.zeros(len(order), np.int32)
            if same.any():
                a, b = to[:-1][same], to[1:][same]
                ends = np.stack([a + 1, b + 1], axis=1).reshape(-1)
                now[1:][same] = 1 + np.minimum.reduceat(np.append(lcp, 0), ends)[::2]
            order, lcp = order[to], now
            if c <= 0:
                # Neighbours that share a window make a class.
                first = np.flatnonzero(lcp < unit.length)
                many = np.diff(np.append(first, len(order)))
                hit = many > 1
                if rows is not None and hit.any():
                    hit &= np.minimum.reduceat(rows[0][order], first) < np.maximum.reduceat(rows[1][order], first)
                if hit.any():
                    flags[c - low, order[np.repeat(hit, many)]] = True
    # A window must lie in its document's own range.
    start = np.arange(low, 1)[:, None]
    flags &= (start >= -left) & (start + unit.length <= right)
    edge = np.diff(np.concatenate([np.zeros((1, m), np.int8), flags.astype(np.int8), np.zeros((1, m), np.int8)]), axis=0)
    b_at, b_doc = np.nonzero(edge.T == 1)[1], np.nonzero(edge.T == 1)[0]
    e_at = np.nonzero(edge.T == -1)[1]
    for d, x, y in zip(b_doc.tolist(), b_at.tolist(), e_at.tolist()):
        out[d].append((x + low, y - 1 + low))
    return out


_RANGES = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
RANGES = "array<struct<a:int,b:int>>"


#: A context on its way to construction: its anchor's key, its hash, the anchor's place, its symbols, its unit, and the
#: least and greatest row that has it.
CONTEXT = ("key", "ctx", "at", "body", "unit", "r1", "r2")


def _construct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts sorted by unit and key: their repeated windows, (key, ctx, ranges)."""

    def one(held: list) -> pa.RecordBatch:
        unit = UNITS[held[0][4]]
        keys, ctx, at, body, _, r1, r2 = zip(*held)
        _, group = np.unique(np.array(keys), return_inverse=True)
        got = repeated_windows(group, np.array(at), list(body), unit, (np.array(r1), np.array(r2)) if unit.across else None)
        on = [i for i, x in enumerate(got) if x]
        return pa.RecordBatch.from_arrays([pa.array([keys[i] for i in on], pa.int64()), pa.array([ctx[i] for i in on], pa.int64()), pa.array([[{"a": a, "b": b} for a, b in got[i]] for i in on], _RANGES)], names=["key", "ctx", "ranges"])

    held, group, key = [], {}, None
    for b in batches:
        for r in zip(*(b.column(i).to_pylist() for i in range(len(CONTEXT)))):
            if (r[4], r[0]) != key:
                if len(group) > 1:
                    held += group.values()
                if held and (len(held) >= BATCH or held[0][4] != r[4]):
                    yield one(held)
                    held = []
                group, key = {}, (r[4], r[0])
            group[r[1]] = r
    if len(group) > 1:
        held += group.values()
    if held:
        yield one(held)


def _halve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts of large groups as two each, for the windows of either half of the places from ``a`` to ``b``."""
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    for batch in batches:
        out: list[tuple] = []
        for key, ctx, at, body, u, r1, r2, a, b in zip(*(batch.column(i).to_pylist() for i in range(len(CONTEXT) + 2))):
            mid, unit = (a + b) // 2, UNITS[u]
            wide = np.dtype(unit.kind).itemsize
            for x, y in ((a, mid), (mid + 1, b)):
                lo, hi = max(x, -at), min(y, len(body) // wide - at - unit.length)
                if lo > hi:
                    continue
                part, core = body[(lo + at) * wide : (hi + at + unit.length) * wide], body[(y + at) * wide : (x + at + unit.length) * wide]
                sub = signed(xxhash.xxh3_64_intdigest(core, key & (1 << 64) - 1) ^ (x & 0xFFFF) << 1)
                out.append((key, ctx, sub, signed(xxhash.xxh3_64_intdigest(part, (lo - x) & 0xFFFF)), -lo, part, u, r1, r2, x, y))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)] if out else [pa.array([], k) for k in kinds], names=["key0", "ctx0", *CONTEXT, "a", "b"])


#: Whether rows count as repeats, by how many there are and, across documents, which.
REPEATED = "n > 1 AND (unit = 0 OR r1 < r2)"


def resolve(contexts: DataFrame) -> DataFrame:
    """(key, ctx, ranges) of repeated windows among different contexts (CONTEXT, a, b) of each key."""
    spark = contexts.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = C.write_table(contexts.groupBy("key").agg(F.count("*").alias("d")).filter(F.col("d") > CAP), "hot-anchors")
    built = lambda df: C.write_table(df.select(*CONTEXT).repartition(n, "key").sortWithinPartitions("unit", "key").mapInArrow(_construct, f"key long, ctx long, ranges {RANGES}"), "repeats")
    if hot.isEmpty():
        return built(contexts)
    cold = built(contexts.join(hot, "key", "left_anti"))
    split = contexts.join(hot, "key", "left_semi").select(*CONTEXT, "a", "b").mapInArrow(_halve, "key0 long, ctx0 long, key long, ctx long, at int, body binary, unit int, r1 long, r2 long, a int, b int")
    split = C.write_table(split, "halves")
    # Equal contexts fall together; a key with one row of one context is no repeat.
    once = split.groupBy("key", "ctx").agg(F.count("*").alias("n"), *(F.first(c).alias(c) for c in ("at", "body", "unit", "a", "b")), F.min("r1").alias("r1"), F.max("r2").alias("r2"))
    once = C.write_table(once, "contexts")
    mixed = once.groupBy("key").agg(F.count("*").alias("d")).filter("d > 1").select("key")
    found = resolve(C.write_table(once.join(mixed, "key", "left_semi").select(*CONTEXT, "a", "b"), "contexts"))
    wide, length = (F.when(F.col("unit") == 1, x).otherwise(y) for x, y in ((8, 1), (WORDS.length, BYTES.length)))
    last = F.length("body") / wide - F.col("at") - length
    whole = once.filter(REPEATED).select("key", "ctx", F.array(F.struct((-F.col("at")).cast("int").alias("a"), last.cast("int").alias("b"))).cast(RANGES).alias("ranges"))
    back = split.select("key0", "ctx0", "key", "ctx").join(found.unionByName(whole), ["key", "ctx"]).select(F.col("key0").alias("key"), F.col("ctx0").alias("ctx"), "ranges")
    return cold.unionByName(C.write_table(back, "repeats"))


# -- distributed ------------------------------------------------------------------------------


def _with_key(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(F.lit(1), text).alias("t1"), F.xxhash64(F.lit(2), text).alias("t2"))


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo, hi, data, offsets in C.chunks(b.column("text")):
            part = b.slice(lo, hi - lo)
            for unit in UNITS:
                doc, a, first, last, key, ctx = anchors(*unit.symbols(data, offsets), unit)
                take = pa.array(doc)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(doc), unit.code, np.int32)), pa.array(key.view(np.int64)), pa.array(ctx.view(np.int64)), *(part.column(c).take(take) for c in ("t1", "t2", "doc_id", "r")), *(pa.array(x.astype(np.int32)) for x in (a, first, last))], names=["unit", "key", "ctx", "t1", "t2", "doc_id", "r", "at", "lo", "hi"])


_KEEP = "doc_id long, t1 long, t2 long, text string, rep boolean, items array<struct<unit:int,key:bigint,ctx:bigint,at:int,lo:int,hi:int,mixed:boolean>>, n_bytes long, kept_sha256 string"


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents without repeated anchors get their digest here and lose their text."""
    for b in batches:
        for lo, hi, data, offsets in C.chunks(b.column("text")):
            part = b.slice(lo, hi - lo)
            done = part.column("items").is_null().to_pylist()
            sha = [hashlib.sha256(data[offsets[i] : offsets[i + 1]]).hexdigest() if d else None for i, d in enumerate(done)]
            text = pa.array([None if d else part.column("text")[i].as_py() for i, d in enumerate(done)], pa.string())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("t1"), part.column("t2"), text, part.column("rep"), part.column("items"), pa.array(np.diff(offsets)), pa.array(sha, pa.string())], names=["doc_id", "t1", "t2", "text", "rep", "items", "n_bytes", "kept_sha256"])


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for lo, hi, data, offsets in C.chunks(b.column("text")):
            of = [unit.symbols(data, offsets) for unit in UNITS]
            for i, items in enumerate(b.column("items").slice(lo, hi - lo).to_pylist()):
                for x in items:
                    if x["mixed"]:
                        symbols, first = of[x["unit"]]
                        body = symbols[first[i] + x["lo"] : first[i] + x["hi"] + UNITS[x["unit"]].length].tobytes()
                        out.append((x["key"], x["ctx"], x["at"] - x["lo"], body, x["unit"]))
        for lo in range(0, len(out), 4096):
            keys, ctx, at, body, unit = zip(*out[lo : lo + 4096])
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(ctx, pa.int64()), pa.array(at, pa.int32()), pa.array(body, pa.binary()), pa.array(unit, pa.int32())], names=list(CONTEXT[:5]))


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_passage_words long"


def _merged(spans: Iterator[tuple[int, int]]) -> list[list[int]]:
    cut: list[list[int]] = []
    for s in sorted(spans):
        if cut and s[0] <= cut[-1][1]:
            cut[-1][1] = max(cut[-1][1], s[1])
        else:
            cut.append([*s])
    return cut


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for doc, text, spans in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "spans"))):
            raw = text.encode()
            cut, passages = (_merged((x["s"], x["e"] + unit.length) for x in spans or () if x["unit"] == unit.code) for unit in UNITS)
            h, at = hashlib.sha256(), 0
            for x, y in cut:
                h.update(raw[at:x])
                at = y
            h.update(raw[at:])
            rows.append((doc, len(raw), sum(y - x for x, y in cut), len(cut), h.hexdigest(), sum(y - x for x, y in passages)))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_passage_words"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and n_passage_words, the words in passages of
    more than 50 words that another document has too (rows with equal texts are two documents)."""
    C.small_batches(docs.sparkSession)
    keyed = _with_key(docs)
    found = C.write_table(keyed.withColumn("r", F.monotonically_increasing_id()).mapInArrow(_find, "unit int, key long, ctx long, t1 long, t2 long, doc_id long, r long, at int, lo int, hi int"), "anchors")
    # Tables written before a join leave both its sides to plain exchanges, which adaptive execution can split.
    twice = found.groupBy("key").agg(F.count("*").alias("n"), F.min("ctx").alias("c1"), F.max("ctx").alias("c2")).filter("n > 1").select("key", (F.col("c1") != F.col("c2")).alias("mixed"))
    twice = C.write_table(twice, "repeated-keys")
    every, found = found, C.write_table(found.join(twice, "key"), "repeated-anchors")
    C.drop_table(every)
    C.drop_table(twice)
    seen = (F.count("*").alias("n"), F.first("unit").alias("unit"), F.min("r").alias("r1"), F.max("r").alias("r2"))
    counted = C.write_table(found.groupBy("key", "ctx").agg(*seen), "contexts")
    item = F.struct("unit", "key", "ctx", "at", "lo", "hi", "mixed")
    of_text = found.groupBy("t1", "t2").agg(F.collect_set(item).alias("items"), F.min("doc_id").alias("rep_id"))
    of_text = C.write_table(of_text, "text-anchors")
    settled = keyed.join(of_text, ["t1", "t2"], "left").select("doc_id", "t1", "t2", "text", F.col("doc_id").eqNullSafe(F.col("rep_id")).alias("rep"), "items").mapInArrow(_settle, _KEEP)
    settled = C.write_table(settled, "settled")
    open_ = settled.filter("items IS NOT NULL")
    bodies = open_.filter("rep").select("text", "items").mapInArrow(_contexts, "key long, ctx long, at int, body binary, unit int").withColumns({"a": F.lit(0) - F.when(F.col("unit") == 1, WORDS.places - 1).otherwise(BYTES.places - 1), "b": F.lit(0)})
    # A text with several anchors of one context gives it more than once.
    bodies = bodies.dropDuplicates(["key", "ctx"]).join(counted.select("key", "ctx", "r1", "r2"), ["key", "ctx"])
    repeats = resolve(C.write_table(bodies.select(*CONTEXT, "a", "b"), "contexts"))
    whole = counted.filter(REPEATED).select("key", "ctx")
    spans = found.join(whole, ["key", "ctx"]).select("t1", "t2", F.struct("unit", F.col("lo").alias("s"), F.col("hi").alias("e")).alias("x"))
    parts = found.join(repeats, ["key", "ctx"]).select("t1", "t2", "unit", "at", F.explode("ranges").alias("r")).select("t1", "t2", F.struct("unit", (F.col("at") + F.col("r.a")).alias("s"), (F.col("at") + F.col("r.b")).alias("e")).alias("x"))
    spans = spans.unionByName(parts).groupBy("t1", "t2").agg(F.collect_set("x").alias("spans"))
    spans = C.write_table(spans, "spans")
    cut = open_.select("doc_id", "t1", "t2", "text").join(spans, ["t1", "t2"], "left").select("doc_id", "text", "spans").mapInArrow(_remove, RESULT)
    none = F.lit(0).cast("long")
    same = settled.filter("items IS NULL").select("doc_id", "n_bytes", none.alias("n_removed"), none.alias("n_spans"), "kept_sha256", none.alias("n_passage_words"))
    return cut.unionByName(same)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
