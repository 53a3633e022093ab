"""Line-first quality rules: failing lines go, then documents that lose too much text.

A line with words fails if one of these holds:

- punctuation: it has at least MIN_WORDS words and no sentence end (. ! ? or a closing mark) after any word, or symbols
  ``#*$%&|<>`` make up more than MAX_SYMBOLS of its word characters, or it has "!!" after more than half of its words;
- navigation: at least two words are a bare separator (| or >) and these are over a sixth of its words, or words
  that equal the word before them are over half of its words, at least MIN_WORDS;
- boilerplate: it holds one of PHRASES, or it equals an earlier line of the document.

Failing lines are removed: the cleaned text is the other lines, those without words too, joined by newlines. A
document that fails no base rule is kept if the characters of words in failing lines are at most MAX_LOST of all.
Base rules: fewer than 50 words, or over half of the words in 3-word windows that occur twice or more.

Defined cases: null and empty texts have 0 everywhere and an empty cleaned text, fail the base rules and are not kept;
repeated rows are judged each by itself; an empty table gives an empty one; a very long text is judged whole, alone in
its chunk; added columns take names that no other column has. A word or line is a 64-bit hash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C

MIN_WORDS, MAX_SYMBOLS, MAX_LOST = 4, (1, 10), 0.5
MIN_DOC_WORDS, MAX_REPEATED = 50, 0.5
#: Lower-case phrases of licence lines, navigation and notices.
PHRASES = ("all rights reserved", "licensed under", "cookie policy", "terms of use", "terms of service", "privacy policy", "javascript is disabled", "lorem ipsum", "click here", "sign up for", "subscribe to our")
_PHRASE = re.compile("|".join(map(re.escape, PHRASES)).encode())
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_END = np.zeros(256, bool)
_END[list(b".!?\"')]:;")] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_U = np.uint64
SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, lost_chars long, kept boolean"


def judge(data: np.ndarray, offsets: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The columns of SCHEMA of a chunk of documents; and for each byte whether the cleaned texts keep it."""
    n = len(offsets) - 1
    doc, starts, ends, h = C.word_hashes(data, offsets)
    lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    chars = lead[ends] - lead[starts]
    count = lambda idx, weights=None, size=n: np.bincount(idx, weights, size).astype(np.int64)[:size] if len(idx) else np.zeros(size, np.int64)
    n_words, word_chars = count(doc), count(doc, chars)
    symbol_at = np.flatnonzero(_SYMBOL[data])
    n_symbols = count(np.searchsorted(offsets, symbol_at, "right") - 1)

    repeated = np.zeros(len(doc), bool)
    if len(doc) >= 3:
        same = np.flatnonzero(doc[:-2] == doc[2:])
        w = C.mix(h[same] * _U(0x9E3779B97F4A7C15) + C.mix(h[same + 1] * _U(0xC2B2AE3D27D4EB4F) + h[same + 2]))
        w = C.mix(w + doc[same].astype(_U))
        _, inverse, times = np.unique(w, return_inverse=True, return_counts=True)
        at = same[times[inverse] > 1]
        for j in range(3):
            repeated[at + j] = True
    n_repeat = count(doc[repeated])

    # Lines: cut at each newline and at document bounds.
    cuts = np.unique(np.concatenate([offsets[:-1], np.flatnonzero(data == 0x0A) + 1]))
    line = np.searchsorted(cuts, starts, "right") - 1
    has, first = np.unique(line, return_index=True)
    m = len(has)
    row = np.searchsorted(has, line)
    of = doc[first]
    begin = cuts[has]
    # The line ends before its newline or with its document.
    stop = np.minimum(np.concatenate([cuts, [len(data)]])[has + 1], offsets[of + 1]) if m else np.zeros(0, np.int64)
    if m:
        stop = np.where((stop > begin) & (data[np.maximum(stop - 1, 0)] == 0x0A), stop - 1, stop)
    key = C.mix(C.span_hash(C.prefix_hash(data), begin, stop) + of.astype(_U) * _U(0xD6E8FEB86659FD93)) if m else np.zeros(0, _U)
    _, earliest = np.unique(key, return_index=True)
    again = np.ones(m, bool)
    again[earliest] = False
    n_dup = count(of[again])

    words, line_chars = count(row, None, m), count(row, chars, m)
    last = data[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    closed = count(row[_END[last]], None, m)
    loud = count(row[(last == 0x21) & (data[np.maximum(ends - 2, 0)] == 0x21) & (ends - starts > 1)], None, m) if len(ends) else np.zeros(m, np.int64)
    alone = (ends - starts == 1) & ((last == 0x7C) | (last == 0x3E))
    bars = count(row[alone], None, m)
    symbols = count(np.searchsorted(has, np.searchsorted(cuts, symbol_at, "right") - 1), None, m)
    echo = np.zeros(len(h), bool)
    echo[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    echoes = count(row[echo], None, m)
    phrase = np.zeros(m, bool)
    found = [x.start() for x in _PHRASE.finditer(_LOWER[data].tobytes())]
    if found:
        phrase[np.searchsorted(has, np.searchsorted(cuts, np.array(found), "right") - 1)] = True
    failed = phrase | again
    failed |= (words >= MIN_WORDS) & ((closed == 0) | (2 * echoes > words))
    failed |= (MAX_SYMBOLS[1] * symbols > MAX_SYMBOLS[0] * line_chars) | (2 * loud > words)
    failed |= (bars >= 2) & (6 * bars > words)
    lost = count(of[failed], line_chars[failed])
    base = (n_words < MIN_DOC_WORDS) | (100 * n_repeat > 100 * MAX_REPEATED * n_words)
    stay = np.ones(len(data), bool)
    if failed.any():
        # A failing line goes with its newline; if it is its document's last, so does the newline of the last that stays.
        a, b, own = begin[failed], stop[failed], of[failed]
        end = offsets[own + 1]
        change = np.bincount(a, minlength=len(data) + 1) - np.bincount(np.minimum(b + 1, end), minlength=len(data) + 1)
        stay = np.cumsum(change)[:-1] == 0
        for k in np.flatnonzero(b == end).tolist():
            while k and own[k - 1] == own[k] and b[k - 1] + 1 == a[k]:
                k -= 1
            if a[k] > offsets[own[k]]:
                stay[a[k] - 1] = False
    return {"n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup, "n_repeat_words": n_repeat, "base_failed": base, "lost_chars": lost, "kept": ~base & (lost <= MAX_LOST * word_chars)}, stay


def clean(docs: DataFrame) -> DataFrame:
    """The columns of docs, the columns of SCHEMA, and ``clean``, the text without its failing lines."""
    extra = [*(x.split()[0] for x in SCHEMA.split(", ")), "clean"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, offsets in C.chunks(b.column(0)):
                got, stay = judge(data, offsets)
                ends = np.concatenate([[0], np.cumsum(stay)])[offsets].astype("<i4")
                text = pa.Array.from_buffers(pa.string(), hi - lo, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data[stay].tobytes())])
                yield pa.RecordBatch.from_arrays([b.column(1).slice(lo, hi - lo), *map(pa.array, got.values()), text], names=["row", *extra])

    C.small_batches(docs.sparkSession)
    inner = docs.select(F.col("text").cast("string").alias("text"), F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias("row"))
    kinds = T.StructType([T.StructField("row", inner.schema["row"].dataType), *T.StructType.fromDDL(SCHEMA), T.StructField("clean", T.StringType())])
    taken = {c.lower() for c in docs.columns}
    names = [n if n not in taken else C.free_name(docs, n) for n in extra]
    return inner.mapInArrow(run, kinds).select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)], *[F.col(n).alias(x) for n, x in zip(extra, names)])


def cleaned_documents(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with their own columns, ``text`` without its failing lines."""
    out = clean(docs)
    kept, text = out.columns[-2:]
    return out.filter(F.col(f"`{kept}`")).select(*[F.col(f"`{text}`").alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns])


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = clean(spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return out.withColumn("clean_sha256", F.sha2(F.encode("clean", "UTF-8"), 256)).drop("text", "clean")
