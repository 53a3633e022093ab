"""N-gram Jaccard join: all pairs of texts whose sets of 5-word shingles have a Jaccard similarity of at least 0.8.

Exact copies fall together by content key. MinHash bands (BANDS of ROWS values) tie texts that may be similar; the
bucket graph's components are small sets outside of which no candidate exists. Inside a component, pairs are compared
on MinHash values a few at a time; after each step a pair goes as soon as the posterior probability (uniform prior,
Beta posterior) that its similarity reaches the threshold falls below TOLERANCE. What is left is verified exactly on
whole shingle sets. A component of more than BLOCK texts or BLOCK_BYTES bytes is cut into blocks: each is written once to
the shared folder, and tasks that compare two blocks read their signatures first (a SIGNED values a text), then the
texts of surviving pairs. So what is shuffled grows with the texts, not with their square. Results are link counts
and a spanning forest per task, never pairs. With 0.8 and BANDS x ROWS = 25 x 5 a pair at the
threshold is missed with probability (1 - 0.8**5)**25 < 5e-5, one at 0.9 with less than 1e-9.

Words are runs of characters other than ASCII white space, case kept. Texts of 1 to 4 words have one shingle, the
whole. Defined cases: null, empty and white-space texts match nothing, not even each other; equal rows are copies of
each other; a null doc_id is a document like others and never gives a class its id unless all its ids are null; of ties
the least doc_id, then the least content key, stands for a class; an empty table gives an empty one; a very long text
is read whole, alone in its chunk; added columns take names that no other column has.
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
from .components import components

K_WORDS, THRESHOLD = 5, (4, 5)
BANDS, ROWS = 25, 5
TOLERANCE = 1e-7
STEPS = (8, 16, 32)
BLOCK, BLOCK_BYTES = 1024, 16 << 20
SIGNED = STEPS[-1]
_U = np.uint64

_rng = np.random.Generator(np.random.PCG64(20240229))
MULTIPLIERS = _rng.integers(1, 1 << 63, BANDS * ROWS, dtype=np.int64).astype(_U) * _U(2) + _U(1)
ADDENDS = _rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.int64).astype(_U)


def minhash(doc: np.ndarray, sh: np.ndarray, n: int) -> np.ndarray:
    """[n, BANDS * ROWS] 32-bit MinHash values; documents without shingles get the largest value."""
    out = np.full((n, BANDS * ROWS), 0xFFFFFFFF, np.uint32)
    if not len(sh):
        return out
    starts = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    have, ends = doc[starts], np.concatenate([starts[1:], [len(sh)]])
    lo = 0
    while lo < len(have):  # pieces that stay in the cache
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + 32768, "right")))
        x, at = sh[starts[lo] : ends[hi - 1]], starts[lo:hi] - starts[lo]
        for k in range(BANDS * ROWS):
            out[have[lo:hi], k] = np.minimum.reduceat(x * MULTIPLIERS[k] + ADDENDS[k], at) >> _U(32)
        lo = hi
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    keys = np.tile(np.arange(BANDS, dtype=_U) * _U(0x9E3779B97F4A7C15), (len(sig), 1))
    parts = sig.reshape(len(sig), BANDS, ROWS).astype(_U)
    for r in range(ROWS):
        keys = C.mix(keys ^ parts[:, :, r]) + _U(r + 1)
    return keys


def min_matches(n: int, threshold: float, tolerance: float) -> int:
    """Fewest of n equal MinHash values with which a pair still reaches the threshold with probability >= tolerance."""
    for m in range(n + 1):
        # 1 - I_t(m + 1, n - m + 1) as a binomial sum
        tail = sum(math.comb(n + 1, j) * threshold**j * (1 - threshold) ** (n + 1 - j) for j in range(m + 1))
        if tail >= tolerance:
            return m
    return n + 1


def survivors(sig: np.ndarray, cross: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (a < b) that no step drops; with ``cross`` only pairs of a row below it and one from it on."""
    n = len(sig)
    t = THRESHOLD[0] / THRESHOLD[1]
    need = [min_matches(s, t, TOLERANCE) for s in STEPS]
    left, right = [], []
    top = n if cross is None else cross
    cols = np.ascontiguousarray(sig.T)
    for lo in range(0, top, 256):
        hi = min(top, lo + 256)
        base = lo + 1 if cross is None else cross
        if base >= n:
            break
        got = np.zeros((hi - lo, n - base), np.uint8)
        for k in range(STEPS[0]):
            got += cols[k, lo:hi, None] == cols[k, None, base:]
        a, b = np.nonzero(got >= need[0])
        m = got[a, b]
        a, b = a + lo, b + base
        keep = a < b
        a, b, m = a[keep], b[keep], m[keep]
        for s in range(1, len(STEPS)):
            for k in range(STEPS[s - 1], STEPS[s]):
                m = m + (cols[k, a] == cols[k, b])
            keep = m >= need[s]
            a, b, m = a[keep], b[keep], m[keep]
        left.append(a)
        right.append(b)
    z = np.zeros(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (z, z)


def verified(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs have an exact Jaccard similarity of at least the threshold."""
    if not len(a):
        return np.zeros(0, bool)
    size = np.array([len(s) for s in sets], np.int64)
    num, den = THRESHOLD
    common = np.zeros(len(a), np.int64)
    flat, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
    if len(a) > 8 * len(sets):
        # Dense sets: count common shingles with matrix products over shingles that two texts share.
        _, col, df = np.unique(flat, return_inverse=True, return_counts=True)
        shared = df[col] > 1
        ids = np.cumsum(df > 1) - 1
        r, c = row[shared], ids[col[shared]]
        order = np.argsort(c, kind="stable")
        r, c = r[order], c[order]
        total = np.zeros((len(sets), len(sets)), np.float32)
        for lo in range(0, int(ids[-1]) + 1, 2048):
            x, y = np.searchsorted(c, [lo, lo + 2048])
            part = np.zeros((len(sets), 2048), np.float32)
            part[r[x:y], c[x:y] - lo] = 1
            live = np.flatnonzero(part.any(axis=1))
            if len(live) < len(sets) // 2:
                sub = part[live]
                total[np.ix_(live, live)] += sub @ sub.T
            else:
                total += part @ part.T
        common = np.rint(total[a, b]).astype(np.int64)
    else:
        at = np.concatenate([[0], np.cumsum(size)])
        for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
            small, large = (sets[x], sets[y]) if size[x] < size[y] else (sets[y], sets[x])
            if not len(small) or den * len(small) < num * len(large):
                continue
            pos = np.searchsorted(large, small)
            common[i] = int((large[np.minimum(pos, len(large) - 1)] == small).sum())
        del at
    return (den * common >= num * (size[a] + size[b] - common)) & (common > 0)


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least index of each node's component, by hooking and pointer jumping."""
    root = np.arange(n)
    while True:
        before = root.copy()
        np.minimum.at(root, a, before[b])
        np.minimum.at(root, b, before[a])
        root = root[root]
        np.minimum.at(root, before, root)
        root = root[root]
        if (root == before).all():
            return root


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, th (content key), has_words, bytes, bands of every document, as a written table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, offsets in C.chunks(b.column("text")):
                doc, _, _, h = C.word_hashes(data, offsets)
                d, s = C.shingles(doc, h, K_WORDS, hi - lo)
                keys = band_keys(minhash(d, s, hi - lo))
                some = np.bincount(doc, minlength=hi - lo) > 0
                keys = pa.ListArray.from_arrays(pa.array(np.arange(hi - lo + 1) * BANDS, pa.int32()), pa.array(keys.reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(lo, hi - lo), b.column("th").slice(lo, hi - lo), pa.array(some), pa.array(np.diff(offsets)), keys], names=["doc_id", "th", "has_words", "bytes", "bands"])

    C.small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), C.text_key("text").alias("th"), F.col("text").cast("string").alias("text"))
    return C.write_table(rows.mapInArrow(run, "doc_id long, th binary, has_words boolean, bytes long, bands array<long>"), "signatures")


def _short(th):
    """The first 64 bits of a content key; enough for candidates, which are compared by the whole key later."""
    return F.conv(F.hex(F.substring(th, 1, 7)), 16, 10).cast("long")


#: What is found of a text in a group: its class there, linked documents and texts, and whether it has other groups.
LINKS = "th binary, root binary, links long, text_links long, many boolean"


def _sets(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """(shingle sets, signatures) of whole texts."""
    sets, sigs = [], [np.zeros((0, BANDS * ROWS), np.uint32)]
    for _, _, data, offsets in C.chunks(pa.array(texts, pa.large_string())):
        doc, _, _, h = C.word_hashes(data, offsets)
        d, s = C.shingles(doc, h, K_WORDS, len(offsets) - 1)
        sigs.append(minhash(d, s, len(offsets) - 1))
        cut = np.searchsorted(d, np.arange(len(offsets)))
        sets += [np.unique(s[cut[i] : cut[i + 1]]) for i in range(len(offsets) - 1)]
    return sets, np.concatenate(sigs)


def _linked(th: list[bytes], copies: np.ndarray, a: np.ndarray, b: np.ndarray, many: bool) -> pa.RecordBatch:
    """Counts and forest of verified links."""
    n = len(th)
    links = np.bincount(a, copies[b], n) + np.bincount(b, copies[a], n)
    texts = np.bincount(a, minlength=n) + np.bincount(b, minlength=n)
    root, on = _roots(n, a, b), np.flatnonzero(texts)
    columns = [pa.array([th[i] for i in on], pa.binary()), pa.array([th[root[i]] for i in on], pa.binary()), pa.array(np.rint(links[on]).astype(np.int64)), pa.array(texts[on].astype(np.int64)), pa.array(np.full(len(on), many))]
    return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in LINKS.split(", ")])


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows of each group, sorted by it, without their first column, once by content key and in its order."""
    held: dict[bytes, tuple] = {}
    group = None
    for b in batches:
        for r in zip(*(b.column(i).to_pylist() for i in range(b.num_columns))):
            if r[0] != group and held:
                yield sorted(held.values())
                held = {}
            group = r[0]
            held.setdefault(r[1], r[1:])
    if held:
        yield sorted(held.values())


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (g, th, copies, text), sorted by g, whole components: their LINKS."""
    for rows in _groups(batches):
        sets, sig = _sets([r[2] or "" for r in rows])
        a, b = survivors(sig)
        ok = verified(sets, a, b)
        if ok.any():
            yield _linked([r[0] for r in rows], np.array([r[1] for r in rows], np.int64), a[ok], b[ok], False)


def _write_blocks(out: str):
    """Rows (g, th, copies, text, c, block), sorted by g, a block each: writes its signatures and its texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches):
            th, copies, texts, (c, *_), (block, *_) = zip(*rows)
            name = f"{out}/{uuid.uuid4().hex}"  # another for each attempt: the table says which counts
            fs, path = C.open_fs(name)
            fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
            sig = np.ascontiguousarray(_sets([t or "" for t in texts])[1][:, :SIGNED])
            tables = {"sig": pa.table({"th": pa.array(th, pa.binary()), "copies": pa.array(copies, pa.int64()), "sig": pa.array([s.tobytes() for s in sig], pa.binary())}), "text": pa.table({"text": pa.array([t or "" for t in texts], pa.large_string())})}
            for kind, table in tables.items():
                with fs.open_output_stream(f"{path}.{kind}", compression=None) as f, pa.ipc.new_stream(f, table.schema) as w:
                    w.write_table(table, 64)
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.int64()), pa.array([block], pa.int32()), pa.array([name])], names=["c", "block", "file"])

    return run


def _read(name: str, kind: str) -> Iterator[pa.RecordBatch]:
    fs, path = C.open_fs(name)
    with fs.open_input_stream(f"{path}.{kind}", compression=None) as f, pa.ipc.open_stream(f) as r:
        yield from r


def _compare_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (left, right), files of two blocks or of one twice: LINKS of the pairs of a text of either."""
    for batch in batches:
        for files in zip(*(batch.column(i).to_pylist() for i in range(2))):
            files = files[: 1 + (files[0] != files[1])]
            heads = [pa.Table.from_batches(_read(f, "sig")) for f in files]
            th, copies, sig = (sum((h.column(c).to_pylist() for h in heads), []) for c in ("th", "copies", "sig"))
            sig = np.frombuffer(b"".join(sig), np.uint32).reshape(len(th), SIGNED)
            a, b = survivors(sig, heads[0].num_rows if len(files) > 1 else None)
            if not len(a):
                continue
            # Only texts of surviving pairs are turned to sets.
            wanted, sets, base = np.zeros(len(th), bool), [np.zeros(0, _U)] * len(th), 0
            wanted[a] = wanted[b] = True
            for f in files:
                for part in _read(f, "text"):
                    here = np.flatnonzero(wanted[base : base + part.num_rows])
                    for k, own in zip(here.tolist(), _sets(part.column("text").take(pa.array(here)).to_pylist())[0] if len(here) else ()):
                        sets[base + k] = own
                    base += part.num_rows
            ok = verified(sets, a, b)
            if ok.any():
                yield _linked(th, np.array(copies, np.int64), a[ok], b[ok], True)


def near_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents, texts): documents has doc_id, th, has_words; texts a row per different text with words: th, rep (least
    doc_id), copies, root (th of its class), links (documents of other texts linked to it), text_links."""
    spark = docs.sparkSession
    sig = signatures(docs)
    texts = C.write_table(sig.filter("has_words").groupBy("th").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("bytes").alias("bytes")), "texts")
    keys = sig.filter("has_words").select(_short("th").alias("v"), F.explode("bands").alias("b"))
    roots = keys.groupBy("b").agg(F.min("v").alias("u"), F.max("v").alias("w")).filter("u < w").select("b", "u")
    roots = C.write_table(roots, "buckets")  # written tables leave the joins to exchanges that can be split
    comp = C.write_table(components(keys.join(roots, "b").select("v", "u")), "candidates")
    spread = C.write_table(texts.withColumn("v", _short("th")).join(comp, "v").select("th", "rep", "copies", "bytes", "c"), "members")
    sizes = spread.groupBy("c").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    sizes = C.write_table(sizes.select("c", F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("bytes") / BLOCK_BYTES)).cast("int").alias("k")), "sizes")
    wanted = spread.join(sizes, "c").select(F.col("th").alias("w_th"), "rep", "copies", "c", "k", F.pmod(F.xxhash64("th"), F.col("k")).cast("int").alias("block"))
    body = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("d_th", C.text_key("text"))
    body = body.join(wanted, (F.col("d_th") == F.col("w_th")) & F.col("doc_id").eqNullSafe(F.col("rep"))).select("c", "k", "block", F.col("w_th").alias("th"), "copies", "text")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    C.small_batches(spark)
    # Whole components and blocks of larger ones go to their tasks at once.
    body = body.withColumn("g", F.when(F.col("k") == 1, F.col("c")).otherwise(F.xxhash64("c", "block")))
    if sizes.filter("k > 1").isEmpty():
        found = body.repartition(n, "g").sortWithinPartitions("g").select("g", "th", "copies", "text").mapInArrow(_compare, LINKS)
    else:
        body = C.write_table(body, "candidate-texts")
        found = body.filter("k = 1").repartition(n, "g").sortWithinPartitions("g").select("g", "th", "copies", "text").mapInArrow(_compare, LINKS)
        out = C.new_dir(spark, "blocks")
        blocks = body.filter("k > 1").repartition(n, "c", "block").sortWithinPartitions("g").select("g", "th", "copies", "text", "c", "block").mapInArrow(_write_blocks(out), "c long, block int, file string")
        blocks = C.write_table(blocks, "blocks")
        # Each pair of blocks of a component is a row of two names; what they hold isn't moved.
        pairs = blocks.alias("x").join(blocks.alias("y"), (F.col("x.c") == F.col("y.c")) & (F.col("x.block") <= F.col("y.block")))
        pairs = C.write_table(pairs.select(F.col("x.file").alias("left"), F.col("y.file").alias("right")), "block-pairs")
        found = found.unionByName(pairs.repartition(n).mapInArrow(_compare_blocks, LINKS))
    found = C.write_table(found, "links")
    counts = found.groupBy("th").agg(F.sum("links").alias("links"), F.sum("text_links").alias("text_links"), F.min("root").alias("one_root"), F.max("many").alias("many"))
    split = found.filter("many").select(F.col("th").alias("v"), F.col("root").alias("u"))
    if split.isEmpty():
        counts = counts.withColumn("root", F.col("one_root"))
    else:
        merged = components(split)
        counts = counts.join(merged.withColumnRenamed("v", "th"), "th", "left").withColumn("root", F.when(F.col("many"), F.coalesce("c", "th")).otherwise(F.col("one_root")))
    out = texts.join(counts.select("th", "root", "links", "text_links"), "th", "left")
    out = out.select("th", "rep", "copies", F.coalesce("root", "th").alias("root"), F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("text_links", F.lit(0)).alias("text_links"))
    return sig.select("doc_id", "th", "has_words"), C.write_table(out, "classes")


def join_near(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, class_id (least doc_id of its class), n_links (other documents at the threshold or above,
    copies of its own text included), n_texts (other texts among them), n_copies (copies of its own text)."""
    rows, texts = near_classes(docs)
    ids = C.write_table(texts.groupBy("root").agg(F.min("rep").alias("class_id")), "class-ids")
    texts = texts.join(ids, "root").select("th", "class_id", "copies", "links", "text_links")
    out = rows.join(texts, "th", "left")
    return out.select("doc_id", F.when(F.col("has_words"), F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"), F.when(F.col("has_words"), F.col("links") + F.col("copies") - 1).otherwise(0).cast("long").alias("n_links"), F.when(F.col("has_words"), F.col("text_links")).otherwise(0).cast("long").alias("n_texts"), F.when(F.col("has_words"), F.col("copies") - 1).otherwise(0).cast("long").alias("n_copies"))


def drop_near(docs: DataFrame) -> DataFrame:
    """One document of each class stays, the one with the least doc_id (null ids last), once; documents without words stay."""
    _, texts = near_classes(docs)
    best = texts.groupBy("root").agg(F.min(F.struct(F.col("rep").isNull().alias("z"), "rep", "th")).alias("b"))
    th, k_th, k_rep = (C.free_name(docs, n) for n in ("th", "k_th", "k_rep"))
    keep = C.write_table(best.select(F.col("b.th").alias(k_th), F.col("b.rep").alias(k_rep)), "kept")
    names = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.withColumn(th, C.text_key("text"))
    worded = F.coalesce(F.col("text").cast("string"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    same = (F.col(th) == F.col(k_th)) & F.col("doc_id").cast("long").eqNullSafe(F.col(k_rep))
    found = keyed.join(keep, same).select(*names, th)
    # Equal rows only if a kept text has them: then one of each stays.
    again = keyed.join(keep, same, "left_semi").groupBy(th).count().filter("count > 1")
    found = found.dropDuplicates([th]) if not again.isEmpty() else found
    return found.select(*names).unionByName(docs.filter(~worded))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_near(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
