"""Quality classifier: hashed word n-gram logistic regression, trained by FTRL, scored as sparse dot products.

Tokens are runs of letters and digits (any byte above 0x7F counts as a letter) and runs of other marks; a token that
equals the one before it is written as one fixed token. Features are hashed tokens and token pairs, valued by their
share of the document's features. Learning uses a bounded sample of labelled rows, those with the least hash of
doc_id, at most ``max_rows``; counts or scores need no statistics of the corpus. Only texts and labels are inputs.

Defined cases: null and empty texts are scored by the bias alone; without labels every score is 0.5; a doc_id with
several labels takes the least, one with several texts the least of these; a null doc_id is not held out and has no
label; repeated rows are scored alike; an empty table gives an empty one; a very long text is read and scored whole,
alone in its chunk, and the driver holds a few examples at a time; an added column takes a name that no other has.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C
from .ftrl import Examples, Ftrl, counted, link

BITS, SCALE = 18, 16.0
MAX_ROWS, EPOCHS = 6000, 3
THRESHOLD = 0.7
_U = np.uint64
_KIND = np.full(256, 2, np.uint8)
_KIND[[0x20, *range(0x09, 0x0E)]] = 0
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_SAME = _U(0x5851F42D4C957F2D)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of every token and token pair, sorted by document."""
    kind = _KIND[data]
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = kind[1:] != kind[:-1]
    edge[offsets] = True
    cuts = np.flatnonzero(edge)
    starts, ends = cuts[:-1], cuts[1:]
    live = kind[starts] > 0 if len(starts) else np.zeros(0, bool)
    starts, ends = starts[live], ends[live]
    doc = np.searchsorted(offsets, starts, "right") - 1
    h = C.span_hash(C.prefix_hash(data), starts, ends)
    if not len(h):
        return doc, np.zeros(0, np.int64)
    # A word repeated with the same mark after it ("the, the,") is a repeat too.
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    same[2:] |= (h[2:] == h[:-2]) & (doc[2:] == doc[:-2]) & (kind[starts[2:]] == 1)
    t = np.where(same, _SAME, h)
    pair = C.mix(t[:-1] * _U(0x9E3779B97F4A7C15) + t[1:])
    ok = doc[1:] == doc[:-1]
    d = np.concatenate([doc, doc[1:][ok]])
    b = (np.concatenate([t, pair[ok]]) >> _U(64 - BITS)).astype(np.int64)
    order = np.argsort(d, kind="stable")
    return d[order], b[order]


def held_out(of: int = 4, rest: int = 2):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % of == rest, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, epochs: int = EPOCHS) -> np.ndarray:
    """Weights [2**BITS + 1]; the last is the bias."""
    model = Ftrl((1 << BITS) + 1, 1, alpha=0.5, beta=1.0, l1=0.02, l2=0.1)
    usable = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).withColumn("doc_id", F.col("doc_id").cast("long")).filter(~held_out())
    pick = usable.groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality")).orderBy(F.xxhash64(F.lit(5), "doc_id"), "doc_id").limit(max_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, offsets in C.chunks(b.column("text")):
                d, f = features(data, offsets)
                cut = np.searchsorted(d, np.arange(hi - lo + 1))
                idx, val = [], []
                for i in range(hi - lo):
                    u, v = counted(f[cut[i] : cut[i + 1]])
                    idx.append(u.astype("<i4").tobytes())
                    val.append(v.astype("<f4").tobytes())
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(lo, hi - lo), b.column("quality").slice(lo, hi - lo), pa.array(idx, pa.binary()), pa.array(val, pa.binary())], names=["key", "label", "idx", "val"])

    C.small_batches(docs.sparkSession)
    # The sample has at most max_rows ids, so it can be broadcast.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(pick), "doc_id")
    rows = rows.groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    got = Examples(rows.mapInArrow(run, "key long, label int, idx binary, val binary"), max_rows)
    for _ in range(epochs):
        for idx, val, y in got:
            model.step(np.append(idx, 1 << BITS), np.append(val * SCALE, 1.0), np.array([float(y > 0)]))
    return model.weights()[:, 0]


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """docs' columns and one more, ``score``, whatever the names; documents are scored whole."""
    on = np.flatnonzero(weights)
    spark = docs.sparkSession
    sparse = spark.sparkContext.broadcast((on, weights[on].astype(np.float64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = np.zeros((1 << BITS) + 1)
        w[sparse.value[0]] = sparse.value[1]
        for b in batches:
            for lo, hi, data, offsets in C.chunks(b.column(0)):
                d, f = features(data, offsets)
                total = np.bincount(d, w[f], hi - lo) if len(d) else np.zeros(hi - lo)
                n = np.bincount(d, minlength=hi - lo) if len(d) else np.zeros(hi - lo)
                s = link((w[-1] + SCALE * total / np.maximum(n, 1))[:, None])[:, 0]
                yield pa.RecordBatch.from_arrays([b.column(1).slice(lo, hi - lo), pa.array(s)], names=["row", "score"])

    C.small_batches(spark)
    inner = docs.select(F.col("text").cast("string").alias("text"), F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias("row"))
    from pyspark.sql import types as T

    out = inner.mapInArrow(run, T.StructType([T.StructField("row", inner.schema["row"].dataType), T.StructField("score", T.DoubleType())]))
    name = "score" if "score" not in {c.lower() for c in docs.columns} else C.free_name(docs, "score")
    return out.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)], F.col("score").alias(name))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the model accepts, with their own columns."""
    scored = score(docs, train(docs, labels))
    return scored.filter(F.col(f"`{scored.columns[-1]}`") >= threshold).select(*[F.col(f"`{c}`") for c in docs.columns])


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    weights = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, weights).select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
