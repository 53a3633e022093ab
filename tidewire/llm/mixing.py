"""Mixing sources to target weights with exact block quotas.

Each source's documents fall into blocks by a hash of doc_id; a source is read ``full`` times whole and once in part:
some blocks whole, and of some more, that hold EDGE documents together, those documents, in the order of their hash,
that still fit, so that its words come to within CLOSE of the target. A document that doesn't fit is left out and the
next is tried, up to SKIPS of them; at the end these and the last taken change sides, one or two at a time, while the
words come nearer for it. The blocks so taken are the source's quota. A splitting tree deals the quotas to output
shards: at each node a multivariate-hypergeometric draw splits the node's quota vector between its two halves, down to
one vector per shard; every block is thus used exactly once and no shard needs to see another's draw. Shards then get
disjoint runs of each source's permuted blocks, and rows are shuffled within their shard.

The plan (blocks, quotas, shards) has at most MAX_BLOCKS blocks plus one per source, whatever the input, and is made on
the driver. Documents meet it by joins, in which tables of the plan are broadcast up to BROADCAST_ROWS rows; with more
sources than that they are shuffled.

Defined cases: null text has size 0; a null source is a source of its own, last in order; a source without words has
target 0 and none of its documents are taken; rows with equal doc_id and source share their fate, and so do those
without a doc_id; of equally near choices at an edge the first by hash is taken; an empty table gives no rows; a text
of any length is one document, which is taken whole or not; added columns take other names where docs has theirs. Every
decision hashes doc_id, source and the seed, so reruns agree however rows are dealt.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C

WEIGHTS = (1.0, 2.0, 3.0)
MAX_REPEATS = 3
#: Words a block should hold, the most blocks of a plan, and words a shard should hold; a shard holds a block at least.
BLOCK_WORDS, MAX_BLOCKS, SHARD_WORDS = 1 << 16, 1 << 18, 1 << 20
BROADCAST_ROWS = 1 << 19
#: Documents that a source's blocks taken in part hold; share of the target that may be missed; documents that are left
#: out as too long.
EDGE, CLOSE, SKIPS = 64, 0.001, 64
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: list[int], weights: list[float], cap: float = MAX_REPEATS) -> list[float]:
    """Shares the sum of sizes by weight; none above cap times its size, the excess reshared by weight."""
    out, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    rest = float(sum(sizes))
    while open_:
        total = sum(weights[i] for i in open_)
        share = {i: rest * weights[i] / total for i in open_}
        over = [i for i in open_ if share[i] > cap * sizes[i]]
        if not over:
            for i in open_:
                out[i] = share[i]
            break
        for i in over:
            out[i] = float(cap * sizes[i])
            rest -= out[i]
            open_.discard(i)
    return out


def split_tree(quotas: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """Quotas of each shard: [shards, sources], columns summing to ``quotas``.

    Node k draws from a generator seeded by (seed, k) alone, so any subtree can be made again on its own.
    """
    out = np.zeros((shards, len(quotas)), np.int64)

    def go(node: int, lo: int, hi: int, q: np.ndarray) -> None:
        if hi - lo == 1:
            out[lo] = q
            return
        mid = (lo + hi) // 2
        total = int(q.sum())
        left = total * (mid - lo) // (hi - lo)
        draw = np.random.Generator(np.random.PCG64(np.random.SeedSequence([seed, node]))).multivariate_hypergeometric(q, left, method="marginals") if total else q
        go(2 * node, lo, mid, draw)
        go(2 * node + 1, mid, hi, q - draw)

    go(1, 0, shards, quotas.astype(np.int64))
    return out


def _joined(spark, rows: list, schema) -> DataFrame:
    """A table of the plan, to be broadcast if it is small."""
    df = spark.createDataFrame(rows, schema)
    return F.broadcast(df) if len(rows) <= BROADCAST_ROWS else df


def _rank(seed: int, *cols: Column) -> Column:
    return F.xxhash64(F.lit(seed), *cols)


def plan_mix(slim: DataFrame, source: str, size: str, doc_id: str, seed: int):
    """(source rows, block plan, shards) from a table of sources, sizes and ids.

    Source rows: (source, index, n_blocks, size, target, cut, left out); plan rows: (index, block, shards).
    """
    by_source = slim.groupBy(source).agg(F.sum(size).alias("n")).collect()
    by_source.sort(key=lambda r: (r[0] is None, (r[0] or "").encode("utf-32-be", "surrogatepass")))
    sizes = [int(r["n"] or 0) for r in by_source]
    goal = targets(sizes, [WEIGHTS[i % len(WEIGHTS)] for i in range(len(sizes))])
    block_words = max(BLOCK_WORDS, math.ceil(sum(sizes) / MAX_BLOCKS))
    blocks = [max(1, math.ceil(s / block_words)) for s in sizes]
    spark = slim.sparkSession
    index = _joined(spark, [(r[0], i, blocks[i]) for i, r in enumerate(by_source)], T.StructType([T.StructField("source", T.StringType()), T.StructField("ix", T.IntegerType()), T.StructField("n_blocks", T.IntegerType())]))
    placed = slim.join(index, slim[source].eqNullSafe(index["source"])).select(F.col("ix"), F.col(size).alias("size"), F.col(doc_id).alias("id"), _rank(seed, F.col(doc_id)).alias("h"), "n_blocks")
    placed = placed.withColumn("block", F.pmod(F.shiftright("h", 20), F.col("n_blocks")).cast("int"))
    held, docs = {}, {}
    for r in placed.filter("size > 0").groupBy("ix", "block").agg(F.sum("size").alias("n"), F.count("*").alias("docs")).collect():
        held[r["ix"], r["block"]], docs[r["ix"], r["block"]] = int(r["n"]), r["docs"]
    full, order, whole, edge, want = [], [], [], [], []
    for i, s in enumerate(sizes):
        times = min(MAX_REPEATS, int(goal[i] // s)) if s else 0
        rest = goal[i] - times * s
        perm = np.random.Generator(np.random.PCG64(np.random.SeedSequence([seed, 7, i]))).permutation(blocks[i])
        k = 0
        while k < len(perm) and rest > 0 and held.get((i, int(perm[k])), 0) <= rest:
            rest -= held.get((i, int(perm[k])), 0)
            k += 1
        # Blocks at the edge: those after the whole ones, and of these the last too if there are too few.
        stop, some, left = k, 0, rest > 0 and s > 0
        while left and some < EDGE and stop < len(perm):
            some += docs.get((i, int(perm[stop])), 0)
            stop += 1
        while left and some < EDGE and k:
            k -= 1
            some += docs.get((i, int(perm[k])), 0)
            rest += held.get((i, int(perm[k])), 0)
        full.append(times)
        order.append(perm)
        whole.append(k)
        edge.append(perm[k:stop].tolist() if left else [])
        want.append(rest)
    # Blocks at the edge are taken up to the document where the words come nearest to what is still wanted.
    edges = _joined(spark, [(i, e, float(want[i]), CLOSE * goal[i]) for i, own in enumerate(edge) for e in own] or [(-1, -1, 0.0, 0.0)], "ix int, block int, want double, close double")
    near = placed.join(edges, ["ix", "block"]).filter("size > 0").groupBy("ix", "h", "want", "close").agg(F.sum("size").alias("size"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = {r["ix"]: (r["cut"], r["skipped"]) for r in near.repartition(n, "ix").sortWithinPartitions("ix", "h").mapInArrow(_fill, "ix int, cut long, skipped array<long>").collect()}
    quotas = np.array([full[i] * blocks[i] + whole[i] + len(edge[i]) if sizes[i] else 0 for i in range(len(sizes))], np.int64)
    shards = max(1, min(int(quotas.sum()), math.ceil(sum(goal) / SHARD_WORDS)))
    shares = split_tree(quotas, shards, seed) if len(quotas) else np.zeros((1, 0), np.int64)
    plan: dict[tuple[int, int], list[int]] = {}
    for i in range(len(sizes)):
        deal = np.random.Generator(np.random.PCG64(np.random.SeedSequence([seed, 11, i])))
        uses = np.concatenate([np.tile(np.arange(blocks[i]), full[i]), order[i][: whole[i] + len(edge[i])]])[: quotas[i]]
        last = len(uses) - len(edge[i])
        to = np.repeat(np.arange(shards), shares[:, i])
        for slot, k in enumerate(deal.permutation(len(uses))):
            # The partial use of a block at the edge is marked by a negative shard.
            plan.setdefault((i, int(uses[k])), []).append(-int(to[slot]) - 1 if k >= last else int(to[slot]))
    rows = [(r[0], i, blocks[i], sizes[i], goal[i], *cuts.get(i, (None, []))) for i, r in enumerate(by_source)]
    return rows, [(i, b, s) for (i, b), s in plan.items()], shards


class _Edge:
    """The documents of one source's blocks at the edge, as they come by hash: which of them the mix takes."""

    def __init__(self, ix: int, want: float, close: float):
        self.ix, self.rest, self.close, self.cut = ix, want, close, None
        # Sizes by hash of those left out and of the last ones taken, SKIPS of each at most.
        self.out: dict[int, int] = {}
        self.took: dict[int, int] = {}

    def see(self, h: int, size: int) -> None:
        if self.rest <= self.close or len(self.out) >= SKIPS:
            return
        self.cut = h
        if size <= self.rest:
            self.rest -= size
            self.took[h] = size
            if len(self.took) > SKIPS:
                self.took.pop(next(iter(self.took)))
        else:
            self.out[h] = size

    def end(self) -> tuple[int, int | None, list[int]]:
        """While the words come nearer for it, one or two documents of those kept change sides: come in or go out."""
        h = [*self.took, *self.out]
        gain = np.array([-n for n in self.took.values()] + [*self.out.values()], np.float64)
        out = np.array([False] * len(self.took) + [True] * len(self.out))
        while len(h):
            gains = np.concatenate([gain[None, :], gain[:, None] + gain[None, :]])
            np.fill_diagonal(gains[1:], 0)
            miss = np.abs(self.rest - gains)
            i, j = np.unravel_index(int(miss.argmin()), miss.shape)
            if miss[i, j] >= abs(self.rest):
                break
            self.rest -= gains[i, j]
            for k in (j, i - 1) if i else (j,):
                gain[k], out[k] = -gain[k], not out[k]
        return self.ix, self.cut, sorted(x for x, y in zip(h, out) if y)


def _fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each source's rows in order (ix, h, want, close, size): the last hash considered and those left out."""
    out, edge = [], None
    for b in batches:
        for ix, h, want, close, size in zip(*(b.column(c).to_pylist() for c in ("ix", "h", "want", "close", "size"))):
            if edge is None or edge.ix != ix:
                out += [edge.end()] if edge else []
                edge = _Edge(ix, want, close)
            edge.see(h, size)
    out += [edge.end()] if edge else []
    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int32()), pa.array([r[1] for r in out], pa.int64()), pa.array([r[2] for r in out], pa.list_(pa.int64()))], names=["ix", "cut", "skipped"])


def mix_sources(docs: DataFrame, seed: int = 17, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """``docs`` with three more columns: mix_size, mix_source (struct size, target) and mix_shards.

    mix_shards has an entry per time the mix takes the row: the output shard that holds that copy.
    """
    out, _ = _mix(docs, seed, doc_id, source, text)
    extra = [n if n not in {c.lower() for c in docs.columns} else C.free_name(docs, n) for n in ("mix_size", "mix_source", "mix_shards")]
    return out.select("row.*", *[F.col(n).alias(x) for n, x in zip(("mix_size", "mix_source", "mix_shards"), extra)])


def _mix(docs: DataFrame, seed: int, doc_id: str, source: str, text: str) -> tuple[DataFrame, int]:
    spark = docs.sparkSession
    slim = C.write_table(docs.select(F.col(doc_id).alias("id"), F.col(source).cast("string").alias("s"), n_words(F.col(text)).alias("n")), "mix-sizes")
    rows, plan, n_shards = plan_mix(slim, "s", "n", "id", seed)
    kind = T.StructType([T.StructField("k_source", T.StringType()), T.StructField("k_ix", T.IntegerType()), T.StructField("k_blocks", T.IntegerType()), T.StructField("k_size", T.LongType()), T.StructField("k_target", T.DoubleType()), T.StructField("k_cut", T.LongType()), T.StructField("k_skipped", T.ArrayType(T.LongType()))])
    by_source = _joined(spark, rows, kind)
    by_block = _joined(spark, plan, "k_ix int, k_block int, k_shards array<int>")
    me = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")
    base = docs.select(me, docs[f"`{source}`"].cast("string").alias("k_src"), _rank(seed, docs[f"`{doc_id}`"]).alias("h"), n_words(docs[f"`{text}`"]).alias("n"))
    out = base.join(by_source, F.col("k_src").eqNullSafe(F.col("k_source")))
    out = _with_block(out, by_block)
    taken = F.filter(F.coalesce("k_shards", F.array().cast("array<int>")), lambda s: (s >= 0) | F.coalesce((F.col("h") <= F.col("k_cut")) & ~F.array_contains("k_skipped", F.col("h")), F.lit(False)))
    shards = F.transform(taken, lambda s: F.when(s < 0, -s - 1).otherwise(s))
    return out.select("row", F.col("n").alias("mix_size"), F.struct(F.col("k_size").alias("size"), F.col("k_target").alias("target")).alias("mix_source"), shards.alias("mix_shards")), n_shards


def _with_block(out: DataFrame, by_block: DataFrame) -> DataFrame:
    out = out.withColumn("k_b", F.pmod(F.shiftright("h", 20), F.col("k_blocks")).cast("int"))
    plan = by_block.withColumnRenamed("k_ix", "p_ix")
    return out.join(plan, (F.col("k_ix") == F.col("p_ix")) & (F.col("k_b") == F.col("k_block")), "left")


def _copies(docs: DataFrame, seed: int) -> tuple[DataFrame, int]:
    """(row, shard, key) of each time a document is taken, sorted by key within its shard; and the number of shards."""
    mixed, shards = _mix(docs, seed, "doc_id", "source", "text")
    out = mixed.select("row", F.posexplode("mix_shards").alias("nth", "shard"))
    out = out.withColumn("key", F.xxhash64(F.lit(seed + 1), "shard", "row.doc_id", "nth"))
    n = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(shards, 1 << 16))
    return out.repartition(n, "shard").sortWithinPartitions("shard", "key"), shards


def mixed_documents(docs: DataFrame, seed: int = 17) -> DataFrame:
    """The mix itself: the columns of docs, a row each time a document is taken, dealt to shards and shuffled there."""
    return _copies(docs, seed)[0].select("row.*")


def write_shards(docs: DataFrame, out: str, seed: int = 17) -> int:
    """Writes the mix as Parquet, a folder ``__shard=k`` for each shard with its rows in shuffled order; the number of shards."""
    copies, shards = _copies(docs, seed)
    copies.select("row.*", F.col("shard").alias(C.free_name(docs, "shard"))).write.partitionBy(C.free_name(docs, "shard")).parquet(out)
    return shards


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source"))
    taken = (F.size("mix_shards") * F.col("mix_size")).cast("long")
    return mixed.select("doc_id", F.col("mix_size").alias("size"), F.col("mix_source.size").alias("source_size"), F.col("mix_source.target").alias("target"), taken.alias("taken"), F.sort_array("mix_shards").alias("shards"))
