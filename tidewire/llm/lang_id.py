"""Language ID: sparse multinomial logistic regression on TF-IDF of character n-grams.

Texts are lower-cased code points, every run of non-letters one blank; features are hashed n-grams of 1 to 3
characters. Document frequencies count every training document. Weights come from FTRL with elastic-net penalties on
a bounded sample of training documents: ``max_rows`` of them, or one a language if these are more; those with the least
hash of doc_id, first an equal share of each language, then what is next of any. A temperature fitted on a fifth of
the sample that training didn't see calibrates the scores.

Defined cases: null texts and texts without a letter (category L; marks alone aren't) are ``und`` with score 0; without
training rows every text is ``und``; documents with a null lang or a null doc_id aren't learned from; of rows with one
doc_id the least text is learned, in its least language; ties go to the language first by code point; repeated rows are
judged alike; an empty table gives an empty one; a very long text is read and scored whole, alone in its chunk, and the
driver holds a few examples at a time; other columns than doc_id, text and lang are never read, whatever their names.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C
from .ftrl import Examples, Ftrl, counted, link

BITS, SCALE = 16, 8.0
MAX_ROWS, EPOCHS = 4000, 2
#: Languages scored at a time.
AT_ONCE = 8
#: Parts of a language while its documents with the least hashes are sought.
SALTS = 64
_U = np.uint64
_tables: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    """For each code point below 0x10000: its lower case if that is one letter, itself if another letter or a mark, else
    blank; and which are marks."""
    if not _tables:
        t, marks = np.full(0x10000, 0x20, np.uint32), np.zeros(0x110000, bool)
        for cp in (*range(0x20000), *range(0xE0000, 0xE1000)):  # other planes have no marks
            ch = chr(cp)
            kind = unicodedata.category(ch)[0]
            marks[cp] = kind == "M"
            if cp < 0x10000 and kind in "LM":
                low = ch.lower()
                t[cp] = ord(low) if len(low) == 1 else cp
        _tables.extend((t, marks))
    return _tables[0]


def _letters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(folded code points, offsets in code points) of a chunk of documents; runs of blanks become one."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le", "surrogatepass"), "<u4")
    lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    if lead[-1] != len(points):  # damaged UTF-8: document by document
        parts = [np.frombuffer(data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace").encode("utf-32-le"), "<u4") for i in range(len(offsets) - 1)]
        points, at = np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    else:
        at = lead[offsets]
    table = _letter_table()
    high = points >= 0x10000
    folded = table[np.where(high, 0x20, points)]
    if high.any():
        which = np.flatnonzero(high)
        folded[which] = [int(p) if chr(p).isalpha() else 0x20 for p in points[which]]
    keep = np.ones(len(folded), bool)
    keep[1:] = (folded[1:] != 0x20) | (folded[:-1] != 0x20)
    keep[at[:-1][at[:-1] < len(folded)]] = True
    index = np.concatenate([[0], np.cumsum(keep)])
    return folded[keep], index[at]


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(buckets [3, n], document of each character, letters per document, features per document); bucket -1: none."""
    c, at = _letters(data, offsets)
    n_docs = len(offsets) - 1
    doc = np.repeat(np.arange(n_docs), np.diff(at))
    out = np.full((3, len(c)), -1, np.int32)
    h = c.astype(_U) * _U(0x9E3779B97F4A7C15)
    out[0] = (h >> _U(64 - BITS)).astype(np.int32)
    out[0][c == 0x20] = -1
    acc = h
    for k in (1, 2):
        if len(c) <= k:
            break
        acc = C.mix(acc[:-1] * _U(0xC2B2AE3D27D4EB4F) + h[k:])
        same = doc[k:] == doc[:-k]
        out[k, : len(c) - k][same] = (acc[same] >> _U(64 - BITS)).astype(np.int32)
    letters = np.bincount(doc[(c != 0x20) & ~_tables[1][c]], minlength=n_docs) if len(c) else np.zeros(n_docs, np.int64)
    count = sum(np.bincount(doc[o >= 0], minlength=n_docs) for o in out) if len(c) else np.zeros(n_docs, np.int64)
    return out, doc, letters, count


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


class Model:
    def __init__(self, langs: list[str], weights: np.ndarray, bias: np.ndarray, temperature: float):
        self.langs, self.weights, self.bias, self.temperature = langs, weights, bias, temperature


def _each_document(data: np.ndarray, offsets: np.ndarray):
    """The buckets of each document in turn."""
    out, doc, _, _ = features(data, offsets)
    cut = np.searchsorted(doc, np.arange(len(offsets)))
    for i in range(len(offsets) - 1):
        b = out[:, cut[i] : cut[i + 1]].reshape(-1)
        yield b[b >= 0]


def train(docs: DataFrame, max_rows: int = MAX_ROWS, epochs: int = EPOCHS) -> Model:
    spark = docs.sparkSession
    C.small_batches(spark)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    usable = base.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n, seen = np.zeros((1 << BITS) + 1, np.int64), 0, np.zeros(1 << BITS, bool)
        for b in batches:
            for _, _, data, offsets in C.chunks(b.column("text")):
                for buckets in _each_document(data, offsets):
                    seen[:] = False
                    seen[buckets] = True
                    df[:-1] += seen
                    df[-1] += 1
        on = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(on, pa.int32()), pa.array(df[on])], names=["b", "n"])

    df = np.zeros((1 << BITS) + 1)
    for r in usable.select("text").mapInArrow(frequencies, "b int, n long").groupBy("b").agg(F.sum("n").alias("n")).collect():
        df[r["b"]] = r["n"]
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 1

    langs = sorted((r["lang"] for r in usable.select("lang").distinct().collect()), key=lambda x: x.encode("utf-32-be"))
    if not langs:
        return Model([], np.zeros((1 << BITS, 1)), np.zeros(1), 1.0)
    most, share = max(max_rows, len(langs)), max(1, max_rows // len(langs))
    # One pass for all languages. Each is dealt to SALTS parts first, so that none is sorted in one task.
    first = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy("h", "doc_id"))
    ids = usable.groupBy("doc_id").agg(F.min("lang").alias("lang")).withColumn("h", F.xxhash64(F.lit(9), "doc_id"))
    ids = ids.withColumn("salt", F.pmod("h", F.lit(SALTS))).withColumn("n", first("lang", "salt")).filter(F.col("n") <= most)
    ids = ids.withColumn("n", first("lang")).filter(F.col("n") <= most)
    pick = ids.orderBy(F.col("n") > share, "h", "doc_id").limit(most).select("doc_id", "lang")

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, offsets in C.chunks(b.column("text")):
                pairs = [counted(x) for x in _each_document(data, offsets)]
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(lo, hi - lo), b.column("lang").slice(lo, hi - lo), pa.array([i.astype("<i4").tobytes() for i, _ in pairs], pa.binary()), pa.array([v.astype("<f4").tobytes() for _, v in pairs], pa.binary())], names=["key", "label", "idx", "val"])

    # The sample has at most ``most`` ids, so it can be broadcast.
    rows = usable.join(F.broadcast(pick), ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    got = Examples(rows.mapInArrow(grams, "key long, label string, idx binary, val binary"), most)
    number = {x: k for k, x in enumerate(langs)}

    def examples(tune: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        n = 0
        for idx, val, lang in got:
            if len(idx):
                if (n % 5 == 0) == tune:
                    y = np.zeros(len(langs))
                    y[number[lang]] = 1
                    yield np.append(idx, 1 << BITS), np.append(val * idf[idx] * SCALE, 1.0), y
                n += 1

    model = Ftrl((1 << BITS) + 1, len(langs), alpha=0.5, beta=1.0, l1=0.01, l2=0.05)
    for _ in range(epochs):
        for idx, val, y in examples(False):
            model.step(idx, val, y)
    w = model.weights()
    tuned = [(val @ w[idx], y) for idx, val, y in examples(True)]
    raw, target = (np.array([t[k] for t in tuned]).reshape(len(tuned), len(langs)) for k in (0, 1))
    temperature = calibrate(raw, target)
    return Model(langs, w[:-1] * idf[:, None] * SCALE, w[-1], temperature)


def calibrate(raw: np.ndarray, target: np.ndarray) -> float:
    """The temperature between 1/8 and 8 with the least log loss, by golden section on its logarithm."""
    if not len(raw) or raw.shape[1] < 2:
        return 1.0

    def loss(log_t: float) -> float:
        return float(-np.log(np.maximum((link(raw / np.exp(log_t)) * target).sum(axis=1), 1e-12)).mean())

    lo, hi, g = -np.log(8.0), np.log(8.0), (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        if loss(a) <= loss(b):
            hi = b
        else:
            lo = a
    return float(np.exp((lo + hi) / 2))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """Per document: doc_id, lang_pred, score."""
    on = np.flatnonzero(np.abs(model.weights).any(axis=1))
    sparse = docs.sparkSession.sparkContext.broadcast((model.langs, on, model.weights[on], model.bias, model.temperature))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, on, rows, bias, temperature = sparse.value
        # For AT_ONCE languages at a time a row a bucket; bucket -1 is the last, which is 0.
        slabs = []
        for lo in range(0, len(bias), AT_ONCE):
            slabs.append(np.zeros(((1 << BITS) + 1, len(bias[lo : lo + AT_ONCE]))))
            slabs[-1][on] = rows[:, lo : lo + AT_ONCE]
        for b in batches:
            for lo, hi, data, offsets in C.chunks(b.column("text")):
                out, doc, letters, count = features(data, offsets)
                n = hi - lo
                total, first = np.zeros((n, len(bias))), np.flatnonzero(np.diff(doc, prepend=-1))
                for k, w in enumerate(slabs if len(doc) else ()):
                    per_char = w[out[0]]
                    per_char += w[out[1]]
                    per_char += w[out[2]]
                    total[doc[first], k * AT_ONCE : k * AT_ONCE + w.shape[1]] = np.add.reduceat(per_char, first, axis=0)
                p = link((total / np.maximum(count, 1)[:, None] + bias) / temperature) if len(langs) != 1 else np.ones((n, 1))
                best = p.argmax(axis=1)
                none = (letters == 0) | (not langs)
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(lo, n), pa.array(["und" if z else langs[i] for z, i in zip(none, best)], pa.string()), pa.array(np.where(none, 0.0, p[np.arange(n), best]))], names=["doc_id", "lang_pred", "score"])

    C.small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    return predict(docs, train(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
