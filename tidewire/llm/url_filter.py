"""URL filters: path rules by host, else a naive Bayes verdict on segmented host and path tokens.

Host words are run together in names, so a unigram Viterbi search splits each into its likeliest words. The unigrams
are the words of the pages' visible texts, counted over the whole table, and those of the labelled names below: no name
is a word because it is a name. A word that isn't known costs as much as one of its length seen 10 times in 10**length.

A multinomial naive Bayes model over the tokens of host and path scores the verdict. What is labelled is a fixed sample
of names (LABELLED), none of the table's. From it the model learns what it can say of every URL of the table at first,
and then, by one step of expectation maximisation, the odds of all the table's tokens: each URL counts for either side
by its first probability. A token counts once a URL, so none is outvoted by a long one. So words that only occur beside
labelled ones count too, and listed ones can be outweighed.

All words and tokens keep their counts, in written tables. Each block of URLs is joined to the rows of its distinct
names and tokens, so a word of every URL costs one row a block. Only words of at most SHORT_WORD letters (18,278 in
all) and those of the labelled names are broadcast.

Defined cases: a null URL, or one without "://", has empty host and path, no rule and is allowed; an empty host matches
no rule; the longest rule that fits wins; repeated rows are judged alike; of equally likely cuts any is taken, always
the same; a null text adds no words; an empty table gives no rows; names of any length are cut whole, in time that
grows with MAX_WORD; other columns than page_id, url and html are never read, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

#: The rules of the query, as (verdict, host, start of the path).
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
#: Labelled names, cut into words. The sample that the first model learns from.
LABELLED = {
    "block": (
        "casino bonus", "online casino", "best poker casino", "slots jackpot win", "sport betting", "live bets", "bet win", "free slots", "lottery win", "gambling club", "roulette",
        "cheap viagra", "buy pills", "pharma pills online", "weight loss pills", "cheap loan", "payday loans", "fast cash loan", "replica watches", "cheap tickets deal",
        "adult video", "adult chat", "xxx tube", "free porn", "sex cam", "nude pics", "escort girls", "hot dating",
        "ads server", "ad track", "click tracker", "popup ads", "pixel track", "banner ads", "clickbait",
        "spam mail", "link farm", "content farm", "seo spam", "warez", "crack keygen", "torrent free", "malware download", "phish login", "free prize win",
    ),
    "allow": (
        "daily news", "world news", "city library", "public library", "school district", "state university", "health service", "science journal", "weather report", "sport club",
        "music archive", "art museum", "history museum", "open wiki", "help forum", "support docs", "developer docs", "travel guide", "recipe book", "photo album",
        "book shop", "home garden", "free software", "mail server", "web mail", "media server", "static media", "img cdn", "research institute", "court records",
        "town council", "parish church", "bank", "hospital", "theatre", "radio station", "train times", "job board", "farm produce", "family farm", "video lectures", "chat support",
    ),
}
#: Letters of a known word at most: a label of a host has no more.
MAX_WORD = 63
#: Letters of the words that are broadcast; of longer ones none is a part of most names.
SHORT_WORD = 3
#: A block has 2**BLOCK_BITS URLs at most.
BLOCK_BITS = 12
#: Rows that a Python stage emits at a time.
EMIT = 1 << 15
#: Added to each token's count on either side; the share of URLs to block that is assumed at first; parts of a URL.
SMOOTHING, BLOCKED, PARTS = 0.1, 0.1, 1024


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL as the rules read it."""
    rest = F.coalesce(F.regexp_extract(url, r"^(?s)(?:.*?)://(.*)$", 1), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def rule_columns(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, or nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def segment(name: str, cost: Mapping[str, float], first: float, each: float) -> list[str]:
    """The likeliest words of a name; a word that isn't known costs ``first`` and ``each`` for its characters."""
    n = len(name)
    best, back = [0.0] + [math.inf] * n, [0] * (n + 1)
    # The cheapest unknown word that ends here, and where it starts.
    open_, start = math.inf, 0
    for j in range(1, n + 1):
        if best[j - 1] + first <= open_:
            open_, start = best[j - 1] + first, j - 1
        open_ += each
        best[j], back[j] = open_, start
        for i in range(max(0, j - MAX_WORD), j):
            c = cost.get(name[i:j])
            if c is not None and best[i] + c < best[j]:
                best[j], back[j] = best[i] + c, i
    out, j = [], n
    while j:
        out.append(name[back[j] : j])
        j = back[j]
    return out[::-1]


def names(host: str, path: str) -> list[str]:
    """Runs of letters of host and path, and of digits of the host."""
    return re.findall(r"[a-z]+|[0-9]+", host) + re.findall(r"[a-z]+", path.lower())


def tokens(host: str, path: str, known: Mapping[str, list[str]]) -> list[str]:
    """Words of host and path, by the words of each name; digits are one token."""
    out = []
    for name in names(host, path):
        if name.isdigit():
            out.append("#")
        else:
            out += known[name]
    return out


class Segmenter:
    """Costs of the words whose counts are given; ``total`` is the sum of the counts of all words, if there are more."""

    def __init__(self, counts: Mapping[str, int], total: int | None = None):
        total = sum(counts.values()) if total is None else total
        # A labelled word counts as one in a thousand more than it has: few texts name what few sites are.
        listed = 1 + total // 1000
        counts = Counter(counts)
        for w in _LISTED:
            counts[w] += listed
        self.total = total + listed * len(_LISTED)
        self.cost = {w: math.log(self.total / n) for w, n in counts.items()}
        self.first, self.each = math.log(self.total / 10), math.log(10)

    def words(self, name: str, parts: list[tuple[str, int]]) -> list[str]:
        """The likeliest words of a name, given the counts of its parts that aren't broadcast."""
        cost = {w: math.log(self.total / n) for w, n in parts} | self.cost if parts else self.cost
        return segment(name, cost, self.first, self.each)


#: How often each word stands in labelled names, to allow and to block, and how many words these have.
_LABELS = {kind: Counter(w for name in LABELLED[kind] for w in name.split()) for kind in ("allow", "block")}
_LISTED = sorted({*_LABELS["allow"], *_LABELS["block"]})


class UrlModel:
    """Multinomial naive Bayes: log odds of block for a token's counts, in parts of a URL, and of the prior."""

    def __init__(self, tokens: int = 0, sums: tuple[int, int] = (0, 0), urls: tuple[int, int] = (0, 0)):
        """tokens: different ones besides the labelled words; sums of their counts, and parts of URLs, of either side."""
        self.sums = [n + PARTS * (_LABELS[k].total() + SMOOTHING * (tokens + len(_LISTED) + 1)) for n, k in zip(sums, ("allow", "block"))]
        assumed = [PARTS * (1 - BLOCKED), PARTS * BLOCKED]
        self.prior = math.log((urls[1] + assumed[1]) / (urls[0] + assumed[0]))

    def odds(self, token: str, allowed: int = 0, blocked: int = 0) -> float:
        a, b = (n + PARTS * (_LABELS[k][token] + SMOOTHING) for n, k in ((allowed, "allow"), (blocked, "block")))
        return math.log(b / self.sums[1]) - math.log(a / self.sums[0])


def first_parts(tokens: list[str], model: UrlModel | None = None) -> int:
    """Of PARTS, how many of a URL of these tokens are to block by the labelled names alone."""
    model = model or _FIRST
    # Words that no labelled name has say nothing yet.
    s = model.prior + sum(model.odds(t) for t in dict.fromkeys(tokens) if t in _LABELS["allow"] or t in _LABELS["block"])
    return round(PARTS / (1 + math.exp(-s)))


_FIRST = UrlModel()


def by_block(rows: DataFrame, count: Callable[[dict], Iterator[tuple[str, int, int]]], columns: list[str]) -> DataFrame:
    """(block, w, a, b) of the distinct words of each block; ``count`` yields (word, parts to a, parts to b) of a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, str], list[int]] = {}

        def out():
            cut = pa.RecordBatch.from_arrays([pa.array([k for k, _ in total], pa.int64()), pa.array([w for _, w in total], pa.string()), pa.array([n[0] for n in total.values()], pa.int64()), pa.array([n[1] for n in total.values()], pa.int64())], names=["block", "w", "a", "b"])
            total.clear()
            return cut

        last = None
        for batch in batches:
            for row in batch.to_pylist():
                if row["block"] != last and len(total) > EMIT:
                    yield out()
                last = row["block"]
                for w, a, b in count(row):
                    n = total.setdefault((last, w), [0, 0])
                    n[0] += a
                    n[1] += b
        yield out()

    return rows.select("block", *columns).mapInArrow(run, "block long, w string, a long, b long")


def word_counts(texts: DataFrame) -> DataFrame:
    """(w, n) of all words a-z of the visible texts of an only column of HTML, lower-cased, up to MAX_WORD letters."""
    seen = F.regexp_replace(F.lower(F.col(f"`{texts.columns[0]}`").cast("string")), r"(?s)<(script|style)\b.*?</\1\s*>|<[^>]*>|&[a-z0-9#]+;", " ")
    words = texts.select(F.explode(F.split(seen, r"[^\p{L}\p{M}]+")).alias("w"))
    return words.filter(F.col("w").rlike(f"^[a-z]{{1,{MAX_WORD}}}$")).groupBy("w").agg(F.count("*").alias("n"))


def segmented(words: DataFrame, lexicon: DataFrame) -> DataFrame:
    """(w, words) of all distinct names ``w``, by the words and counts (w, n) of a lexicon."""
    spark = words.sparkSession
    words = C.write_table(words.withColumn("id", F.monotonically_increasing_id()), "url-words")
    lexicon = C.write_table(lexicon, "url-lexicon")
    total = lexicon.agg(F.sum("n")).first()[0] or 0
    near = {r["w"]: r["n"] for r in lexicon.filter((F.length("w") <= SHORT_WORD) | F.col("w").isin(*_LISTED)).collect()}
    cut = spark.sparkContext.broadcast(Segmenter(near, total))

    def substrings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts = [], []

        def out():
            rows = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(parts, pa.string())], names=["id", "w"])
            ids.clear()
            parts.clear()
            return rows

        for b in batches:
            for i, name in zip(b.column("id").to_pylist(), b.column("w").to_pylist()):
                for at in range(len(name) - SHORT_WORD):
                    ends = range(at + SHORT_WORD + 1, min(at + MAX_WORD, len(name)) + 1)
                    parts.extend(name[at:end] for end in ends)
                    ids.extend([i] * len(ends))
                    if len(ids) > EMIT:
                        yield out()
        yield out()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [cut.value.words(name, [(p["w"], p["n"]) for p in parts or []]) for name, parts in zip(b.column("w").to_pylist(), b.column("parts").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("w"), pa.array(found, pa.list_(pa.string()))], names=["w", "words"])

    parts = words.select("id", "w").mapInArrow(substrings, "id long, w string").join(lexicon.select("w", "n"), "w")
    held = parts.groupBy("id").agg(F.collect_set(F.struct("w", "n")).alias("parts"))
    return words.join(held, "id", "left").select("w", "parts").mapInArrow(run, "w string, words array<string>")


def verdicts(pages: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, block_score (log odds, null where a rule decides), words.

    texts: one column of HTML whose words names are cut into; without it only words of labelled names are known.
    """
    spark = pages.sparkSession
    texts = spark.createDataFrame([], "html string") if texts is None else texts
    C.small_batches(spark)
    host, path = parts(F.col("url").cast("string"))
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_columns(F.col("host"), F.col("path"))
    base = base.withColumns({"rule": rule, "rule_verdict": verdict, "block": F.shiftright(F.monotonically_increasing_id(), BLOCK_BITS)})
    base = C.write_table(base, "urls")

    found = C.write_table(by_block(base, lambda r: ((name, 1, 0) for name in names(r["host"], r["path"]) if not name.isdigit()), ["host", "path"]), "url-names")
    cuts = segmented(found.select("w").distinct(), word_counts(texts))

    def cut(rows: pa.Table, cuts: pa.Table) -> pa.Table:
        known = dict(zip(cuts.column("w").to_pylist(), cuts.column("words").to_pylist())) if cuts.num_rows else {}
        hosts, paths = rows.column("host").to_pylist(), rows.column("path").to_pylist()
        words = [tokens(h, p, known) for h, p in zip(hosts, paths)]
        return rows.append_column("words", pa.array([" ".join(w) for w in words], pa.string())).append_column("first", pa.array([first_parts(w) for w in words], pa.int32()))

    kinds = "page_id long, host string, path string, rule string, rule_verdict string, block long, words string, first int"
    cut_rows = base.groupBy("block").cogroup(found.select("block", "w").join(cuts, "w").groupBy("block")).applyInArrow(cut, kinds)
    cut_rows = C.write_table(cut_rows, "url-tokens")

    scored = cut_rows.filter(F.col("host") != "")
    counted = C.write_table(by_block(scored, lambda r: ((w, PARTS - r["first"], r["first"]) for w in dict.fromkeys(r["words"].split())), ["words", "first"]), "url-counts")
    totals = counted.groupBy("w").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    n, a, b = totals.agg(F.count(F.when(~F.col("w").isin(*_LISTED), 1)), F.sum("a"), F.sum("b")).first()
    urls, blocked = scored.agg(F.count("first"), F.sum("first")).first()
    model = UrlModel(n, (a or 0, b or 0), (PARTS * urls - (blocked or 0), blocked or 0))

    def judge(rows: pa.Table, counts: pa.Table) -> pa.Table:
        odds = {w: model.odds(w, x, y) for w, x, y in zip(*(counts.column(c).to_pylist() for c in ("w", "a", "b")))} if counts.num_rows else {}
        score, final = [], []
        for h, w, v in zip(*(rows.column(c).to_pylist() for c in ("host", "words", "rule_verdict"))):
            s = model.prior + sum(odds[t] for t in dict.fromkeys(w.split())) if h else -math.inf
            score.append(None if v or not h else s)
            final.append(v or ("block" if s > 0 else "allow"))
        return pa.table([rows.column("page_id"), rows.column("host"), rows.column("path"), rows.column("rule"), pa.array(final, pa.string()), pa.array(score, pa.float64()), rows.column("words")], names=["page_id", "host", "path", "rule", "verdict", "block_score", "words"])

    known = counted.select("block", "w").join(totals, "w")
    return cut_rows.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(judge, "page_id long, host string, path string, rule string, verdict string, block_score double, words string")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return verdicts(pages.select("page_id", "url"), pages.select("html"))
