"""Benchmark decontamination: windows of documents that lie within a small edit distance of a benchmark item.

Edit distance is counted in words (runs of letters, digits and bytes above 0x7F; A-Z lower-cased). An item is found if
the least edit distance between it and any run of words of the document is at most MAX_DISTANCE times the item's words,
whatever its size: items of 1 or 2 words occur whole, of 3 to 5 with one edit, of 6 to 8 with two.

Method: a window of the item's own size starts at every word of a document. The CGK walk embeds items and windows: at
each of 1.5 times the item's words steps it emits the word it stands on, and a random bit of that word and step says
whether it moves on, so strings a few edits apart emit mostly equal words at equal steps. Bit-sampling LSH compares
SAMPLES random steps at a time, in repetitions each with a walk of its own; windows that agree with an item in any
table are verified by exact edit distance, so a hit is always one. Recall falls with the share of edits and the item's
size, so repetitions grow with the size (``tables``). Measured at the limit of 0.35, the worse of substitutions alone and
of all three edits: 1.00 of 8 words, 0.99 of 20, 1.00 of 64 and 130, 0.98 of 300. The target is 0.9; the tests hold every
share of edits against it.

Before a window is embedded, it is counted: k edits touch at most k words and 2 k pairs of neighbouring words, so of a
window's words and pairs at least size - k and size - 1 - 2 k are an item's. Windows with fewer can't be hits of any
item of that size, whatever the other items or how they are dealt to blocks; no other window is left out.

Items are broadcast in blocks of at most BLOCK_WORDS words; a larger benchmark takes several passes over the documents.
Defined cases: null or empty texts are clean; items without words match nothing; equal items are separate items, each
listed; of several runs as near, the distance is that of any; repeated documents are judged each by itself; a null
item_id counts as an item but isn't listed; an empty table gives an empty one, an empty benchmark leaves every document
clean. Very long texts are whole: windows are embedded SLAB at a time, and neighbouring candidates of an item are
compared by cells of its size, so memory doesn't grow with them. Added columns take names that no column of docs has.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

MAX_DISTANCE = 0.35
BLOCK_WORDS = 1 << 20
#: Steps compared in each repetition.
SAMPLES = 2
#: Sizes of one class are counted together, with the least bounds of them, then each with its own.
CLASS = 1.2
#: Bounds on memory: windows embedded at a time, pairs of an item and a place at a time, words compared at a time.
SLAB, PAIRS, CELLS = 4096, 1 << 18, 1 << 16
_U = np.uint64
_PAD = _U(0x2545F4914F6CDD1D)
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of every word."""
    data = _LOWER[data]
    inside = _WORD[data]
    before, after = np.empty_like(inside), np.empty_like(inside)
    before[:1], before[1:] = False, inside[:-1]
    after[-1:], after[:-1] = False, inside[1:]
    cut = offsets[(offsets > 0) & (offsets < len(data))]
    before[cut], after[cut - 1] = False, False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return np.searchsorted(offsets, starts, "right") - 1, C.span_hash(C.prefix_hash(data), starts, ends)


def _among(x: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(x), bool)
    i = np.searchsorted(ordered, x)
    return ordered[np.minimum(i, len(ordered) - 1)] == x


def tables(size: int) -> int:
    """Repetitions for items of ``size`` words."""
    return 32 + size // 4


class Walk:
    """The walks of all repetitions over strings of ``size`` words, and the steps that each compares."""

    def __init__(self, size: int):
        rng = np.random.default_rng(size)
        self.size, self.steps, self.tables = size, size + size // 2, tables(size)
        # Tables by their last step, so that those that still walk come first.
        picked = rng.integers(0, self.steps, (SAMPLES, self.tables))
        picked = picked[:, np.argsort(-picked.max(axis=0), kind="stable")]
        self.walking = [int((picked.max(axis=0) >= step).sum()) for step in range(self.steps)]
        self.compared = [np.unique(np.nonzero(picked == step)[1]) for step in range(self.steps)]
        self.odd = rng.integers(0, 1 << 63, (self.steps, self.tables, 1), np.int64).astype(_U) * _U(2) + _U(1)

    def keys(self, h: np.ndarray, start: np.ndarray, room: np.ndarray) -> np.ndarray:
        """(tables, n) keys of the strings h[start : start + room], room at most size."""
        # Each string with as many blanks after it as a walk can reach. The top bit of an odd multiple is the coin.
        width = self.steps + 1
        at = np.arange(width)
        text = np.where(at < room[:, None], h[np.minimum(start[:, None] + at, len(h) - 1)], _PAD).reshape(-1)
        text ^= text >> _U(31)
        place = np.repeat((np.arange(len(start)) * width)[None, :], self.tables, axis=0)
        key = np.repeat(np.arange(1, self.tables + 1, dtype=_U)[:, None], len(start), axis=1)
        for step, (n, here) in enumerate(zip(self.walking, self.compared)):
            if not n:
                break
            word = text[place[:n]]
            if len(here):
                key[here] = C.mix(key[here] * _U(3) + word[here])
            word *= self.odd[step, :n]
            word >>= _U(63)
            place[:n] += word.view(np.int64)
        return key


class Known:
    """A sorted set of hashes, and for each size of items which of them its items hold."""

    def __init__(self, h: np.ndarray, size: np.ndarray):
        self.h, which = np.unique(h, return_inverse=True)
        order = np.argsort(size, kind="stable")
        cut = np.flatnonzero(np.diff(size[order])) + 1
        self.by_size = {int(size[part[0]]): np.unique(which[part]) for part in np.split(order, cut) if len(part)}
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.h >> _U(44)).astype(np.int64)] = True

    def place(self, h: np.ndarray) -> np.ndarray:
        """For each hash its place in the set, or the place past the end, which no size holds."""
        out = np.full(len(h), len(self.h), np.int64)
        at = np.flatnonzero(self.maybe[(h >> _U(44)).astype(np.int64)])
        if len(at):
            i = np.minimum(np.searchsorted(self.h, h[at]), len(self.h) - 1)
            out[at] = np.where(self.h[i] == h[at], i, len(self.h))
        return out

    def held(self, sizes: list[int]) -> np.ndarray:
        """For each place whether items of one of the sizes hold it."""
        out = np.zeros(len(self.h) + 1, bool)
        for size in sizes:
            out[self.by_size.get(size, [])] = True
        return out


class Items:
    """The tables of one block of items."""

    def __init__(self, ids: list, texts: list[str]):
        self.ids = ids
        data, offsets = C.utf8(pa.array([t or "" for t in texts], pa.large_string()))
        doc, h = symbols(data, offsets)
        n = np.bincount(doc, minlength=len(ids)) if len(doc) else np.zeros(len(ids), np.int64)
        self.first = np.concatenate([[0], np.cumsum(n)])
        self.size, self.h, self.doc = n, h, doc
        self.limit = np.floor(MAX_DISTANCE * n).astype(np.int64)
        #: Classes of sizes, each a list of its sizes; by size the walk, its sorted keys and their items.
        self.classes: list[list[int]] = []
        self.walks: dict[int, tuple[Walk, np.ndarray, np.ndarray]] = {}
        for size in np.unique(n[n > 0]).tolist():
            if not self.classes or size > CLASS * self.classes[-1][0]:
                self.classes.append([])
            self.classes[-1].append(size)
            own = np.flatnonzero(n == size)
            walk = Walk(size)
            keys = np.concatenate([walk.keys(h, self.first[part], np.full(len(part), size)) for part in np.array_split(own, -(-len(own) // SLAB))], axis=1)
            order = np.argsort(keys.reshape(-1), kind="stable")
            self.walks[size] = walk, keys.reshape(-1)[order], np.tile(own, walk.tables)[order]
        self.words = Known(h, n[doc])
        pair = doc[1:] == doc[:-1]
        self.pairs = Known(_pair(h[:-1], h[1:])[pair], n[doc[1:]][pair])


def least(size: int) -> tuple[int, int, int]:
    """Of a hit of an item of ``size`` words: its most words, and the least of its words and pairs that are the item's."""
    k = math.floor(MAX_DISTANCE * size)
    return size + k, size - k, size - 1 - 2 * k


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return C.mix(a * _U(3) + b)


def _expand(keys: np.ndarray, ordered: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(index in keys, index in ordered) of all equal pairs, about PAIRS at a time."""
    found = np.flatnonzero(_among(keys, ordered))
    if not len(found):
        return
    lo, hi = np.searchsorted(ordered, keys[found], "left"), np.searchsorted(ordered, keys[found], "right")
    for part in np.split(np.arange(len(found)), np.flatnonzero(np.diff(np.cumsum(hi - lo) // PAIRS)) + 1):
        n = (hi - lo)[part]
        yield np.repeat(found[part], n), np.repeat(lo[part] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


def edit_distances(items: Items, item: np.ndarray, h: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Least word edit distance between each item and any run of words within h[lo:hi]."""
    out = np.zeros(len(item), np.int64)
    by_size = np.argsort(items.size[item], kind="stable")
    for part in np.split(by_size, np.flatnonzero(np.diff(np.cumsum((hi - lo)[by_size]) // CELLS)) + 1):
        if not len(part):
            continue
        it, a, b = item[part], lo[part], hi[part]
        n, m = items.size[it], b - a
        width = int(m.max())
        cols = np.arange(width)
        inside = cols < m[:, None]
        text = np.where(inside, h[np.minimum(a[:, None] + cols, len(h) - 1)], _PAD)
        row = np.zeros((len(part), width + 1), np.int32)  # a run may start anywhere
        ramp = np.arange(width + 1, dtype=np.int32)
        done = np.zeros(len(part), np.int64)
        for i in range(int(n.max())):
            w = items.h[np.minimum(items.first[it] + i, len(items.h) - 1)]
            new = row + 1
            np.minimum(new[:, 1:], row[:, :-1] + (text != w[:, None]), out=new[:, 1:])
            row = np.minimum.accumulate(new - ramp, axis=1) + ramp
            if (last := n == i + 1).any():
                sub = np.where(np.arange(width + 1) <= m[last, None], row[last], 1 << 20)
                done[last] = sub.min(axis=1)
        out[part] = done
    return out


def windows(items: Items, doc: np.ndarray, h: np.ndarray, end: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(size, starts) of the windows that begin with a word of items of that size, and hold as many words and pairs of
    them as a hit must. A run's first words that aren't the item's can go without making it farther from the item."""
    place = items.words.place(h)
    pair = np.full(len(h), len(items.pairs.h), np.int64)
    both = np.flatnonzero((place[1:] < len(items.words.h)) & (place[:-1] < len(items.words.h)) & (doc[1:] == doc[:-1]))
    if len(both):
        pair[both] = items.pairs.place(_pair(h[both], h[both + 1]))
    for sizes in items.classes:
        bounds = np.array([least(size) for size in sizes])
        at = _enough(items, sizes, place, pair, np.arange(len(h)), end, int(bounds[:, 0].max()), int(bounds[:, 1].min()), int(bounds[:, 2].min()))
        if not len(at):
            continue
        # The words that these windows cover, side by side.
        span = np.minimum(at + int(bounds[:, 0].max()), end[at])
        cover = np.cumsum(np.bincount(at, minlength=len(h) + 1) - np.bincount(span, minlength=len(h) + 1))[:-1] > 0
        on, rank = np.flatnonzero(cover), np.cumsum(cover) - 1
        stop = rank[end[on] - 1] + 1
        stop[~cover[end[on] - 1]] = len(on)
        for size, bound in zip(sizes, bounds.tolist()):
            got = _enough(items, [size], place[on], pair[on], rank[at], stop, *bound)
            if len(got):
                yield size, on[got]


def _enough(items: Items, sizes: list[int], place: np.ndarray, pair: np.ndarray, at: np.ndarray, end: np.ndarray, span: int, words: int, pairs: int) -> np.ndarray:
    """Those of at whose next span places, up to end, hold enough words and pairs of items of these sizes."""
    sums = np.zeros(len(place) + 1, np.int32)
    held = items.words.held(sizes)[place]
    at = at[held[at]]
    # A pair that starts on a window's last word isn't the window's, but counting it loses nothing.
    for need, flags in ((pairs, items.pairs.held(sizes)[pair]), (words, held)):
        if need > 0 and len(at):
            np.cumsum(flags, out=sums[1:])
            at = at[sums[np.minimum(at + span, end[at])] - sums[at] >= need]
    return at


def proposed(items: Items, size: int, start: np.ndarray, h: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(item, start) of windows that agree with an item in some table, once each."""
    walk, keys, owner = items.walks[size]
    for part in np.array_split(start, -(-len(start) // SLAB)):
        got = walk.keys(h, part, np.minimum(size, end[part] - part)).reshape(-1)
        for i, j in _expand(got, keys):
            both = np.unique(np.stack([owner[j], part[i % len(part)]]), axis=1)
            yield both[0], both[1]


def search(items: Items, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, item, distance) of all items within reach of a document of the chunk, once a pair."""
    none = np.zeros(0, np.int64)
    doc, h = symbols(data, offsets)
    if not len(h):
        return none, none, none
    counts = np.bincount(doc, minlength=len(offsets) - 1)
    base = np.cumsum(counts) - counts
    end = (base + counts)[doc]
    d_all, i_all, e_all = [], [], []
    for size, starts in windows(items, doc, h, end):
        for item, begin in proposed(items, size, starts, h, end):
            # Places of an item that are less than its size apart are compared at once.
            d, cell = doc[begin], begin // size
            order = np.lexsort((begin, cell, d, item))
            item, d, begin, cell = item[order], d[order], begin[order], cell[order]
            new = np.ones(len(item), bool)
            new[1:] = (item[1:] != item[:-1]) | (d[1:] != d[:-1]) | (cell[1:] != cell[:-1])
            first = np.flatnonzero(new)
            last = np.concatenate([first[1:], [len(item)]]) - 1
            item, d = item[first], d[first]
            limit = items.limit[item]
            a, b = np.maximum(begin[first] - limit, base[d]), np.minimum(begin[last] + size + limit, base[d] + counts[d])
            e = edit_distances(items, item, h, a, b)
            hit = e <= limit
            d_all.append(d[hit])
            i_all.append(item[hit])
            e_all.append(e[hit])
    if not d_all:
        return none, none, none
    d, i, e = np.concatenate(d_all), np.concatenate(i_all), np.concatenate(e_all)
    order = np.lexsort((e, i, d))
    d, i, e = d[order], i[order], e[order]
    keep = np.ones(len(d), bool)
    keep[1:] = (d[1:] != d[:-1]) | (i[1:] != i[:-1])
    return d[keep], i[keep], e[keep]


def mark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The columns of docs, and two more whatever their names: hits, an array of (item_id, distance) by item, then n_items."""
    spark = docs.sparkSession
    C.small_batches(spark)
    sized = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    total = sized.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / 2 / BLOCK_WORDS))  # a word and its blank are two characters at least
    inner = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias("row"), F.array().cast("array<struct<item_id:bigint,distance:int>>").alias("hits"), F.lit(0).alias("n"))
    for block in range(blocks):
        rows = sized.filter(F.pmod(F.xxhash64("text", "item_id"), F.lit(blocks)) == block).orderBy("item_id", "text").collect()
        items = spark.sparkContext.broadcast(([r["item_id"] for r in rows], [r["text"] for r in rows]))
        inner = inner.mapInArrow(_marker(items), inner.schema)
    names = docs.columns
    out = inner.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(names)], F.col("hits").alias(C.free_name(docs, "hits")), F.col("n").alias(C.free_name(docs, "n_items")))
    return out


_made: dict[str, Items] = {}


def _items(key: str, ids: list, texts: list[str]) -> Items:
    """One block's tables a worker process, so they outlive a task."""
    if key not in _made:
        _made.clear()
        _made[key] = Items(ids, texts)
    return _made[key]


def _marker(broadcast):
    key = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = _items(key, *broadcast.value)
        for b in batches:
            for lo, hi, data, offsets in C.chunks(b.column("text")):
                d, i, e = search(items, data, offsets)
                part = b.slice(lo, hi - lo)
                if len(d):
                    hits, n = part.column("hits").to_pylist(), part.column("n").to_pylist()
                    for x, y, z in zip(d.tolist(), i.tolist(), e.tolist()):
                        n[x] += 1
                        if items.ids[y] is not None:
                            hits[x] = [*hits[x], {"item_id": items.ids[y], "distance": z}]
                    part = pa.RecordBatch.from_arrays([part.column("text"), part.column("row"), pa.array(hits, part.schema.field("hits").type), pa.array(n, pa.int32())], schema=part.schema)
                yield part

    return run


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item, with their own columns."""
    out = mark(docs, benchmark)
    return out.filter(F.col(f"`{out.columns[-1]}`") == 0).select(*[F.col(f"`{c}`") for c in docs.columns])


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = mark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    hits, n = out.columns[-2:]
    return out.select("doc_id", (F.col(n) > 0).alias("contaminated"), F.sort_array(F.transform(hits, lambda x: x["item_id"])).alias("item_ids"), F.array_min(F.transform(hits, lambda x: x["distance"])).alias("least_distance"))


