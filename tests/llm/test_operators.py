"""Each operator against brute force, and the defined cases: nulls, empty and long texts, ties, repeated rows, empty
tables, extra columns with clashing names."""

import base64
import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from tidewire.llm import common as C
from tidewire.llm import components, decontaminate, ftrl, jaccard_join, lang_id, line_rules, mixing, quality_model, suffix_dedup, token_files, url_filter, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, row int, hits string, part int, mix_size int, k_th int, h long"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def edge_rows():
    rng = random.Random(3)
    pick = lambda n: " ".join(rng.choice(["alpha", "beta,", "gamma", "Delta.", "the", "of", "épsilon"]) + str(rng.randrange(60)) for _ in range(n))
    base = pick(80)
    long = pick(30000)
    extra = ("x", 1, "y", 2, 3, 4, 5)
    rows = [
        (1, None, "en", "a", None), (2, "", None, "a", 0), (3, " \n\t ", "en", None, 3), (4, base, "en", "a", None), (5, base, "de", "b", None), (5, base, "de", "b", None), (6, base + " one more", None, "b", 7),
        (None, base, "en", None, None), (None, pick(60), "en", "c", None), (7, long, "de", "c", None), (8, long[: len(long) // 2] + " x " + long[len(long) // 2 :], "de", "a", 1), (9, "two words", "en", "a", 9), (10, "two words", "en", "a", 9), (11, pick(120), "fr", "\U0001f600", 1), (12, "x" * 900, "fr", "b", 1), (13, "\n".join([pick(12)] * 5), "fr", "b", 1),
    ]
    return [(*r, *extra) for r in rows]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(edge_rows(), DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def clashes(spark, stage, edge, none):
    """A stage returns the columns of its input, whatever their names, and takes an empty table."""
    out = stage(edge)
    assert out.columns == edge.columns
    rows = [tuple(r) for r in out.collect()]
    assert set(rows) <= {tuple(r) for r in edge.collect()}
    empty = stage(none)
    assert empty.columns == none.columns and empty.count() == 0
    return rows


def test_a_cluster_needs_a_shared_folder():
    class Session:
        conf = type("Conf", (), {"get": staticmethod(lambda *_: None)})
        sparkContext = type("Context", (), {"master": "spark://host:7077", "getCheckpointDir": staticmethod(lambda: None)})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        C.shared_dir(Session)


# -- 1 ----------------------------------------------------------------------------------------


def whole(texts):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(token_files.default_tokenizer())
    return [np.array([*e.ids, 2], "<u4") for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_word_encoder_equals_whole_texts():
    odd = ["The,. a,. B., 'S it's, <|endoftext|>. <|STARTOFTEXT|> x", "ΑΣ. Σ, É, é. 12, 3.4 a,b", "", "\n\n ,", "İ. K, ﬁ,", "a, b.", "\x02 q\x02,", ".", "a.,", "x\ty\rz", "é, É."]
    data, offsets = C.utf8(pa.array(odd, pa.large_string()))
    enc = token_files.WordEncoder(token_files.default_tokenizer(), 2)
    assert enc.by_word
    ids, counts = enc.encode(data, offsets)
    assert [p.tolist() for p in np.split(ids, np.cumsum(counts)[:-1])] == [w.tolist() for w in whole(odd)]


def test_text_with_more_words_than_the_table_has_slots(monkeypatch):
    monkeypatch.setattr(token_files, "TABLE_BITS", 6)
    enc = token_files.WordEncoder(token_files.default_tokenizer(), 2)
    texts = ["a b c", " ".join(f"w{n}x" for n in range(3000)), "c b d", " ".join(f"v{n}" for n in range(60)), "a d"]
    for part in ([t] for t in texts):
        data, offsets = C.utf8(pa.array(part, pa.large_string()))
        assert enc.encode(data, offsets)[0].tolist() == whole(part)[0].tolist()
    assert enc.table.bits == 6
    with pytest.raises(ValueError, match="full"):
        enc.table.add(np.arange(1, 100, dtype=np.uint64), [b"x"] * 99, [np.zeros(1, "<u2")] * 99)


def test_words_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(C, "span_hash", lambda sums, starts, ends: (ends - starts).astype(np.uint64))
    enc = token_files.WordEncoder(token_files.default_tokenizer(), 2)
    texts = ["some words here have equal sizes", "more text that says some other thing", "here here same"]
    data, offsets = C.utf8(pa.array(texts, pa.large_string()))
    for _ in range(2):
        assert enc.encode(data, offsets)[0].tolist() == np.concatenate(whole(texts)).tolist()


@pytest.mark.parametrize("n", [1, 7, 2048, 2049, 2048 * 300 + 5])
def test_coder_round_trip_by_segments(n):
    ids = np.minimum(np.random.default_rng(1).zipf(1.3, n), 49407)
    coder = token_files.Coder(token_files.scaled(np.bincount(ids, minlength=49408)))
    segments = coder.encode(ids)
    assert len(segments) == -(-n // token_files.READ_IDS) and sum(k for *_, k in segments) == n
    at = n
    for states, words, k in reversed(segments):  # each alone, in any order
        assert (coder.decode(states, words, k) == ids[at - k : at]).all()
        at -= k


def check_tokens(spark, df):
    rows = sorted(((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    want, at = collections.Counter(), 0
    got = token_files.token_digest(df, token_files.default_tokenizer()).collect()
    for (d, _), ids in zip(rows, whole([t for _, t in rows])):
        want[d, len(ids), zlib.crc32(ids.tobytes())] += 1
        at += len(ids)
    assert collections.Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == want
    place = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == place
        place += r["n_tokens"]
    order = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in sorted(got, key=lambda r: r["start"])]
    assert order == sorted(order) and place == at


def test_token_files(spark, edge, none, small):
    check_tokens(spark, edge)
    check_tokens(spark, small)
    assert token_files.token_digest(none, token_files.default_tokenizer()).count() == 0


def test_shard_is_read_in_ranges(tmp_path):
    rng = np.random.default_rng(2)
    freq = token_files.scaled(np.ones(50, np.int64))
    lengths = [1, 5, 700, 1, 64, 0, 3, 2000, 16, 9]
    ids = rng.integers(0, 50, sum(lengths))
    uri = f"file://{tmp_path}/b.twr"
    token_files.write_shard(uri, token_files.Coder(freq, 16, 4), list(range(10)), lengths, ids, 12)
    ends = np.cumsum(lengths)
    want = [(k, int(e) - n, ids[e - n : e].tolist()) for k, (e, n) in enumerate(zip(ends, lengths))]
    for step in (1, 64, 100, 5000):
        assert [(d, a, i.tolist()) for lo in range(0, int(ends[-1]), step) for d, a, i in token_files.read_shard(uri, freq, lo, lo + step)] == want, step


def test_files_are_decoded_by_several_tasks_and_attempts_keep_apart(spark, small, tmp_path):
    path, out = token_files.default_tokenizer(), f"file://{tmp_path}/t"
    manifest = C.write_table(token_files.write_token_files(small, out, path, lanes=64, steps=64, check=16), "manifest")
    again = C.write_table(token_files.write_token_files(small, out, path, lanes=64, steps=64, check=16), "manifest")
    files = [{r["file"] for r in m.collect()} for m in (manifest, again)]
    assert not files[0] & files[1]
    whole_rows = token_files.token_digest(small, path)
    for m, step in ((manifest, 64 * 16), (again, 5000)):
        parts = token_files.read_token_files(m, f"{out}/table.bin", step)
        assert sorted(map(tuple, parts.collect())) == sorted(map(tuple, whole_rows.collect()))
        assert m.agg(F.max("n_ids")).first()[0] > 4 * step  # each file several units


def test_damaged_shard_is_found(tmp_path):
    freq = token_files.scaled(np.ones(10, np.int64))
    uri = f"file://{tmp_path}/a.twr"
    token_files.write_shard(uri, token_files.Coder(freq), [1, 2], [3, 2], np.array([1, 2, 3, 4, 5]))
    assert [(d, a, i.tolist()) for d, a, i in token_files.read_shard(uri, freq)] == [(1, 0, [1, 2, 3]), (2, 3, [4, 5])]
    raw = bytearray((tmp_path / "a.twr").read_bytes())
    raw[40] ^= 1
    (tmp_path / "a.twr").write_bytes(raw)
    with pytest.raises(ValueError, match="damaged"):
        list(token_files.read_shard(uri, freq))


# -- 2 ----------------------------------------------------------------------------------------


def test_targets():
    assert mixing.targets([100, 100, 100], [1, 2, 3]) == [50.0, 100.0, 150.0]
    got = mixing.targets([1, 1000, 10], [1, 2, 3])
    assert got[0] == 3 and got[2] == 30 and abs(sum(got) - 1011) < 1e-6
    assert mixing.targets([0, 0], [1, 2]) == [0.0, 0.0] and mixing.targets([], []) == []


def test_targets_are_the_only_ones_that_fit():
    rng = random.Random(9)
    for _ in range(200):
        sizes = [rng.choice([0, 1, 5, 100, rng.randrange(1, 10**6)]) for _ in range(rng.randrange(1, 12))]
        weights = [1.0 + i % 3 for i in range(len(sizes))]
        got = mixing.targets(sizes, weights)
        # The level at which min(weight x level, 3 x size) sums to all sizes, by halving.
        lo, hi = 0.0, 10.0 * (sum(sizes) + 1)
        for _ in range(200):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if sum(min(w * mid, 3 * n) for w, n in zip(weights, sizes)) < sum(sizes) else (lo, mid)
        assert np.allclose(got, [min(w * hi, 3 * n) for w, n in zip(weights, sizes)], atol=1e-3), (sizes, got)


def test_split_tree_is_exact_and_repeatable():
    q = np.array([7, 0, 100, 1])
    a, b = mixing.split_tree(q, 6, 5), mixing.split_tree(q, 6, 5)
    assert (a == b).all() and (a.sum(axis=0) == q).all() and a.sum(axis=1).max() - a.sum(axis=1).min() <= 1


@pytest.mark.parametrize("block_words", [1 << 16, 500])
def test_mix(spark, edge, none, small, monkeypatch, block_words):
    monkeypatch.setattr(mixing, "BLOCK_WORDS", block_words)
    monkeypatch.setattr(mixing, "SHARD_WORDS", 4000)
    for df in (small, edge):
        cols = df.select("doc_id", "source", "text")
        rows = mixing.mix_sources(cols).collect()
        assert len(rows) == df.count()
        sizes = collections.defaultdict(int)
        for r in rows:
            assert r["mix_size"] == len(words_of(r["text"]))
            sizes[r["source"]] += r["mix_size"]
        order = sorted(sizes, key=lambda s: (s is None, [ord(c) for c in s or ""]))
        goal = dict(zip(order, mixing.targets([sizes[s] for s in order], [1.0 + i % 3 for i in range(len(order))])))
        taken, ids = collections.Counter(), collections.Counter()
        for r in rows:
            assert len(r["mix_shards"]) <= 3 and r["mix_source"]["size"] == sizes[r["source"]] and abs(r["mix_source"]["target"] - goal[r["source"]]) < 1e-6
            taken[r["source"]] += len(r["mix_shards"]) * r["mix_size"]
            ids[r["source"], r["doc_id"]] += r["mix_size"]  # rows with one id share their fate
        for s in order:  # ten documents a source and less: no sums of them may come near
            own = sorted(n for (k, _), n in ids.items() if k == s and n)
            sums = {min(3, int(goal[s] // sizes[s])) * sizes[s] if sizes[s] else 0}
            for n in own:
                sums |= {x + n for x in sums}
            nearest = min(abs(x - goal[s]) for x in sums)
            assert abs(taken[s] - goal[s]) <= max(0.01 * goal[s], nearest + sum(own[:3])), (s, taken[s], goal[s])
        again = mixing.mix_sources(cols.repartition(5)).collect()
        key = lambda r: (str(r["doc_id"]), str(r["source"]), str(r["text"]), r["mix_shards"])
        assert sorted(map(key, rows)) == sorted(map(key, again))
    assert mixing.mix_sources(none).count() == 0
    copies = collections.Counter(clashes(spark, mixing.mixed_documents, edge, none))
    assert max(copies.values()) <= 6


def test_mix_comes_near_its_targets_past_long_documents(spark):
    rows = mixing.op2(spark, SMALL.replace("sf0.001", "sf0.01")).collect()
    taken, goal = collections.Counter(), {}
    for r in rows:
        assert r["taken"] == len(r["shards"]) * r["size"] <= 3 * r["size"]
        taken[r["source_size"], r["target"]] += r["taken"]
    assert len(taken) == 20 and all(abs(n - t) <= 0.01 * t for (_, t), n in taken.items())


def test_mix_is_written_in_shuffled_shards(spark, small, edge, none, monkeypatch, tmp_path):
    monkeypatch.setattr(mixing, "BLOCK_WORDS", 500)
    monkeypatch.setattr(mixing, "SHARD_WORDS", 20000)
    shards = mixing.write_shards(small, f"file://{tmp_path}/mix")
    got = spark.read.parquet(f"file://{tmp_path}/mix")
    want = collections.Counter((r["doc_id"], k) for r in mixing.mix_sources(small).collect() for k in r["mix_shards"])
    rows = [(r["doc_id"], r["__shard"]) for r in got.select("doc_id", "__shard").collect()]
    assert collections.Counter(rows) == want and shards > 2 and {k for _, k in rows} <= set(range(shards))
    held = collections.defaultdict(list)
    for d, k in rows:
        held[k].append(d)
    ordered = sum(a < b for ids in held.values() for a, b in zip(ids, ids[1:]))
    assert 0.3 < ordered / sum(len(ids) - 1 for ids in held.values()) < 0.7  # neither order of doc_id
    for n, df in enumerate((edge, none)):
        mixing.write_shards(df, f"file://{tmp_path}/mix{n}")


# -- 3 ----------------------------------------------------------------------------------------


def shingle_sets(rows):
    out = []
    for d, t in rows:
        w = words_of(t)
        out.append((d, frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])))
    return out


def brute_classes(rows):
    sets = shingle_sets(rows)
    root, links = list(range(len(sets))), [0] * len(sets)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            a, b = sets[i][1], sets[j][1]
            if a and b and 5 * len(a & b) >= 4 * len(a | b):
                links[i] += 1
                links[j] += 1
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (d, s) in enumerate(sets):
        if s and d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return collections.Counter((d, least.get(find(i)) if s else d, links[i]) for i, (d, s) in enumerate(sets))


@pytest.mark.parametrize("block", [1024, 3])
def test_jaccard_join(spark, edge, none, small, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    near = []
    for group in range(6):
        base = [rng.choice(words) for _ in range(100)]
        for i in range(9):
            t = list(base)
            for _ in range(rng.randrange(5)):
                t[rng.randrange(100)] = rng.choice(words)
            near.append((group * 100 + i, " ".join(t)))
    for df in (edge.select("doc_id", "text"), small.select("doc_id", "text"), spark.createDataFrame(near, "doc_id long, text string")):
        got = collections.Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in jaccard_join.join_near(df).collect())
        assert got == brute_classes([tuple(r) for r in df.collect()])
    assert jaccard_join.join_near(none).count() == 0


def test_large_components_are_cut_by_bytes(spark, edge, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_BYTES", 3000)
    got = collections.Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in jaccard_join.join_near(edge).collect())
    assert got == brute_classes([(r["doc_id"], r["text"]) for r in edge.collect()])


def test_shuffle_is_linear_in_one_large_component(spark, monkeypatch, tmp_path):
    """Blocks of one component hold each text once, however many blocks it is compared with."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 20)
    rng, moved = random.Random(6), []
    base = [f"w{rng.randrange(500)}" for _ in range(100)]
    write = C.write_table

    def spy(df, name, *a):
        out = write(df, name, *a)
        if name in ("candidate-texts", "blocks", "block-pairs"):
            moved.append((name, out.count(), out.agg(F.sum(F.length("text"))).first()[0] if "text" in out.columns else 0))
        return out

    monkeypatch.setattr(C, "write_table", spy)
    for n in (100, 200):
        rows = [(i, " ".join([*base[:k], f"x{i}", *base[k + 1 :]])) for i, k in enumerate(rng.choices(range(100), k=n))]
        got = collections.Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in jaccard_join.join_near(spark.createDataFrame(rows, "doc_id long, text string")).collect())
        assert got == brute_classes(rows)
    texts = [x for x in moved if x[0] == "candidate-texts"]
    assert [x[1] for x in texts] == [100, 200] and texts[1][2] < 2.1 * texts[0][2]


def test_verified_is_exact_for_few_and_for_many_pairs():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 60, 200).astype(np.uint64)
    sets = [np.unique(np.where(rng.random(200) < rng.random() * 0.2, rng.integers(0, 1 << 60, 200), base).astype(np.uint64)[: rng.integers(0, 200)]) for _ in range(60)]
    a, b = np.triu_indices(60, 1)
    want = np.array([len(c := np.intersect1d(sets[i], sets[j])) * 5 >= 4 * len(np.union1d(sets[i], sets[j])) and len(c) > 0 for i, j in zip(a, b)])
    assert len(a) > 8 * len(sets) and (jaccard_join.verified(sets, a, b) == want).all() and want.any()
    for part in np.array_split(np.arange(len(a)), 20):
        assert (jaccard_join.verified(sets, a[part], b[part]) == want[part]).all()


def test_drop_near(spark, edge, none, small):
    rows = clashes(spark, jaccard_join.drop_near, edge, none)
    assert sorted(r[0] for r in rows if r[0] is not None) == [1, 2, 3, 4, 7, 9, 11, 12, 13]
    keep = [r["doc_id"] for r in jaccard_join.drop_near(small).collect()]
    want = {c for _, c, _ in brute_classes([(r["doc_id"], r["text"]) for r in small.collect()])}
    assert sorted(keep) == sorted(want)


def test_pruning_bounds():
    assert [jaccard_join.min_matches(n, 0.8, 1e-7) for n in (8, 16, 32)] == sorted(jaccard_join.min_matches(n, 0.8, 1e-7) for n in (8, 16, 32))
    assert jaccard_join.min_matches(32, 0.8, 1e-7) < 0.8 * 32


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 200)] + [(1000 + rng.randrange(300), 1000 + rng.randrange(300)) for _ in range(200)] + [(5000, 5000 + i) for i in range(1, 50)]
    got = {r["v"]: r["c"] for r in components.components(spark.createDataFrame(edges, "v long, u long")).collect()}
    root = {v: v for e in edges for v in e}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    assert all(got.get(v, v) == find(v) for v in root)


# -- 4 ----------------------------------------------------------------------------------------


def brute_removal(texts, length):
    seen = collections.Counter()
    raws = [(t or "").encode() for t in texts]
    for raw in raws:
        seen.update(raw[i : i + length] for i in range(len(raw) - length + 1))
    out = []
    for raw in raws:
        covered = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - length + 1):
            if seen[raw[i : i + length]] > 1:
                covered[i : i + length] = True
        kept = bytes(b for b, c in zip(raw, covered) if not c)
        spans = int((covered[1:] & ~covered[:-1]).sum() + covered[0])
        out.append((len(raw), int(covered.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def brute_passages(texts, length=51):
    """Words of each text in runs of length words that another text has too."""
    words = [words_of(t) for t in texts]
    where = collections.defaultdict(set)
    for n, w in enumerate(words):
        for i in range(len(w) - length + 1):
            where[tuple(w[i : i + length])].add(n)
    return [len({i + k for i in range(len(w) - length + 1) if len(where[tuple(w[i : i + length])]) > 1 for k in range(length)}) for w in words]


@pytest.mark.parametrize("cap", [4096, 2])
def test_suffix_dedup(spark, edge, none, monkeypatch, cap):
    monkeypatch.setattr(suffix_dedup, "CAP", cap)
    rng = random.Random(8)
    fill = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    passage = fill(700)
    rows = [(i, fill(rng.randrange(300)) + passage[rng.randrange(200) : 500 + rng.randrange(200)] + fill(rng.randrange(300))) for i in range(12)]
    rows += [(20, "ab" * 600), (21, passage), (22, passage), (23, passage[:399]), (24, passage[:400]), (25, None), (26, ""), (None, fill(50) + passage)]
    words = [f"{rng.choice('abcdef')}{n % 83}" for n in range(70)]
    rows += [(30 + n, " ".join([f"x{n}y{k}" for k in range(n * 7)] + words[n : n + 49 + n] + [f"z{n}"])) for n in range(6)]
    rows += [(40, " ".join(["one", "two", *[f"q{n}" for n in range(60)], "three"] * 2)), (41, "it is " * 200)]
    # Whole texts of 30,000 words too, in few columns to keep the fixture small.
    edges = [(r["doc_id"], r["text"]) for r in edge.collect()]
    for part in (rows, edges):
        got = collections.Counter(tuple(r) for r in suffix_dedup.remove_repeats(spark.createDataFrame(part, "doc_id long, text string").repartition(3)).collect())
        want = collections.Counter((d, *x, n) for (d, _), x, n in zip(part, brute_removal([t for _, t in part], 400), brute_passages([t for _, t in part])))
        assert got == want
    assert sum(n > 0 for n in brute_passages([t for _, t in rows])) >= 8
    clashing = edge.withColumnsRenamed({"score": "key", "row": "ctx", "hits": "items", "part": "r", "k_th": "unit"})
    clashing = clashing.filter("doc_id < 7")
    assert sorted(map(tuple, suffix_dedup.remove_repeats(clashing).collect())) == sorted(map(tuple, suffix_dedup.remove_repeats(clashing.select("text", "doc_id")).collect()))
    assert suffix_dedup.remove_repeats(none).count() == 0


def test_anchors_cover_all_windows():
    data = np.frombuffer(random.Random(1).randbytes(5000) + b"z" * 1500, np.uint8)
    offsets = np.array([0, 300, 2300, 2700, 6500])
    doc, at, lo, hi, *_ = suffix_dedup.anchors(data, offsets)
    got = sorted((d, p) for d, a, b in zip(doc.tolist(), lo.tolist(), hi.tolist()) for p in range(a, b + 1))
    assert got == [(d, p) for d in range(4) for p in range(max(0, offsets[d + 1] - offsets[d] - 399))]
    assert (at >= lo).all() and (at - hi <= 400 - suffix_dedup.BYTES.k).all()


# -- 5 ----------------------------------------------------------------------------------------


def brute_base(text):
    text = text or ""
    w = words_of(text)
    c, hit = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2)), set()
    for i in range(len(w) - 2):
        if c[tuple(w[i : i + 3])] > 1:
            hit |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words_of(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit), len(w) < 50 or 100 * len(hit) > 50 * len(w)


def test_line_rules(spark, edge, none, small):
    for df in (edge, small):
        want = collections.Counter((r["doc_id"], *brute_base(r["text"])) for r in df.collect())
        got = line_rules.clean(df).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
        assert collections.Counter(tuple(r) for r in got.collect()) == want
    assert line_rules.clean(none).count() == 0
    good = "\n".join(f"Line{i} has{i * 3} own{i} words{i * 7} and{i} more{i * 5} of{i} them{i * 13}, up{i} to{i} here{i}." for i in range(12))
    texts = {1: good, 2: good + "\nhome | about | help | more |", 3: "\n".join(f"home{i} | about{i} | help{i} | more{i} |" for i in range(20)), 4: "\n".join(f"SHOUT{i}!! MORE{i}!! AND{i}!! AGAIN{i}!!" for i in range(20)), 5: "\n".join(f"no end of line {i} in this text {i * 3} at all" for i in range(20)), 6: "All rights reserved.\n" + good}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r for r in line_rules.clean(docs).collect()}
    assert {d: (r["kept"], r["lost_chars"] > 0) for d, r in got.items()} == {1: (True, False), 2: (True, True), 3: (False, True), 4: (False, True), 5: (False, True), 6: (True, True)}
    assert {d: r["clean"] for d, r in got.items()} == {1: good, 2: good, 3: "", 4: "", 5: "", 6: good}
    assert collections.Counter(map(tuple, line_rules.cleaned_documents(docs).collect())) == {(d, good): 1 for d in (1, 2, 6)}
    clashing = edge.withColumnsRenamed({"score": "clean", "row": "kept", "hits": "N_words"})
    out = line_rules.cleaned_documents(clashing)
    assert out.columns == clashing.columns and out.count() <= clashing.count()
    assert collections.Counter(tuple(r)[: len(edge.columns)] for r in line_rules.clean(clashing).collect()) == collections.Counter(map(tuple, edge.collect()))


def test_failing_lines_are_cut_out():
    """Whatever lines fail, the cleaned text is the others joined by newlines."""
    rng = random.Random(4)
    bad, fine = "home | about | help | more |", ["", " ", "Fine words stand here.", "Others, too.", "\t"]
    texts = ["\n".join(rng.choice([bad, *fine]) for _ in range(rng.randrange(1, 9))) for _ in range(300)] + ["", "\n", bad, bad + "\n", "\n" + bad, "\n\n" + bad + "\n" + bad]
    data, offsets = C.utf8(pa.array(texts, pa.large_string()))
    _, stay = line_rules.judge(data, offsets)
    at = np.concatenate([[0], np.cumsum(stay)])[offsets]
    raw = data[stay].tobytes().decode()
    for k, text in enumerate(texts):
        seen, want = set(), []
        for line in text.split("\n"):
            if line != bad and not (line.strip() and line in seen):
                want.append(line)
            seen.add(line)
        assert raw[at[k] : at[k + 1]] == "\n".join(want), repr(text)


# -- 6 ----------------------------------------------------------------------------------------


def test_quality_model(spark, edge, none):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    weights = quality_model.train(docs, labels)
    scored = quality_model.score(docs.select("doc_id", "text"), weights).join(labels, "doc_id").filter(quality_model.held_out())
    rows = scored.collect()
    right = sum((r["score"] >= 0.7) == (r["quality"] == 1) for r in rows)
    assert right / len(rows) >= 0.93
    assert quality_model.score(edge, weights).columns == [*edge.columns, "__score"]
    out = {r["doc_id"]: r["__score"] for r in quality_model.score(edge, weights).collect()}
    assert out[1] == out[2] == out[3] and all(0 <= v <= 1 for v in out.values())
    clashes(spark, lambda d: quality_model.keep_good(d, labels), edge, none)
    assert set(np.unique(quality_model.train(docs, labels.limit(0)))) == {0.0}
    odd = labels.unionByName(spark.createDataFrame([(None, 1, 0), (1, None, 0), (1, 0, 0)], labels.schema))
    assert quality_model.train(docs, odd).any()


def plain_hash(raw):
    data = np.frombuffer(raw, np.uint8)
    return C.span_hash(C.prefix_hash(data), np.array([0]), np.array([len(data)]))[0]


def test_quality_scores_equal_plain_dot_products(spark, edge):
    weights = np.random.default_rng(2).normal(size=(1 << quality_model.BITS) + 1)
    for r in quality_model.score(edge.select("doc_id", "text").filter("doc_id < 7 OR doc_id > 8"), weights).collect():
        tokens, feats = re.findall(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff \t-\r]+", (r["text"] or "").encode()), []
        word = [bool(re.match(rb"[0-9A-Za-z\x80-\xff]", x)) for x in tokens]
        hashes = [int(plain_hash(x)) for x in tokens]
        for i, h in enumerate(hashes):
            if i and tokens[i] == tokens[i - 1] or i > 1 and word[i] and tokens[i] == tokens[i - 2]:
                hashes[i] = None
        hashes = [int(quality_model._SAME) if h is None else h for h in hashes]
        pairs = [int(C.mix(np.array([(a * 0x9E3779B97F4A7C15 + b) % 2**64], np.uint64))[0]) for a, b in zip(hashes, hashes[1:])]
        feats = [h >> (64 - quality_model.BITS) for h in [*hashes, *pairs]]
        want = 1 / (1 + np.exp(-weights[-1] - quality_model.SCALE * (sum(weights[f] for f in feats) / max(1, len(feats)))))
        assert abs(r["score"] - want) < 1e-9, r["doc_id"]


def test_ftrl_equals_its_formula():
    rng = np.random.default_rng(5)
    m = ftrl.Ftrl(6, 1, 0.5, 1.0, 0.05, 0.1)
    z, n = [0.0] * 6, [0.0] * 6
    weight = lambda i: 0.0 if abs(z[i]) <= 0.05 else -(z[i] - np.sign(z[i]) * 0.05) / ((1.0 + n[i] ** 0.5) / 0.5 + 0.1)
    for _ in range(50):
        idx, val, y = rng.permutation(6)[:3], rng.normal(size=3), float(rng.integers(2))
        m.step(idx, val, np.array([y]))
        w = {int(i): weight(i) for i in idx}
        p = 1 / (1 + np.exp(-sum(w[int(i)] * v for i, v in zip(idx, val))))
        for i, v in zip(idx, val):
            g = (p - y) * v
            z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / 0.5 * w[int(i)]
            n[i] += g * g
    assert np.allclose(m.weights()[:, 0], [weight(i) for i in range(6)])


def test_held_out_rows_teach_nothing(spark):
    docs = spark.createDataFrame([(i, f"word{i} and others") for i in range(40)], "doc_id long, text string")
    held = [i for i in range(40) if zlib.crc32(str(i).encode()) % 4 == 2]
    labels = spark.createDataFrame([(i, 1, 0) for i in held], "doc_id long, quality int, toxic int")
    assert not quality_model.train(docs, labels).any()
    assert {r["doc_id"] for r in docs.filter(quality_model.held_out()).collect()} == set(held)


def test_ftrl_learns_and_stays_sparse():
    m, rng = ftrl.Ftrl(50, 1, 0.5, 1.0, 4.0, 0.1), np.random.default_rng(0)
    for i in range(400):
        x = np.append(rng.choice(np.arange(4, 50), 5, replace=False), 3 if i % 2 else 2)
        m.step(x, np.ones(6), np.array([float(i % 2)]))
    w = m.weights()[:, 0]
    assert w.argmax() == 3 and (w == 0).sum() > 5


# -- 7 ----------------------------------------------------------------------------------------


def brute_rule(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    if not m:
        return "", "", None, None
    host, path = "".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2]
    fit = [(len(h + p), h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fit)[1:] if fit else (None, None)))


URLS = [None, "", "no scheme", "http://", "https://Example.ORG/es/x?q=1#z", "http://a.example.org/en/1", "http://a.example.org/en/2", "http://notexample.org/es/", "http://x.com/de/1", "http://com/fr/", "http://x.com/deutsch", "ftp://host.net?u=http://y.org/", "http://a.com/fr", "http://www.casino-win.net/en/1", "http://casinobets.net/", "http://quiet-library.net/en/", "http://é.org/Path#f"]


def test_url_filter(spark):
    rows = [(i, u, "extra", "y", 1, 2) for i, u in enumerate(URLS)] + [(None, "http://a.com/de/", "e", "y", 1, 2), (5, URLS[5], "e", "y", 1, 2)]
    rows.append((90, "http://" + "casino" * 20000 + ".net/" + "zq" * 20000, "e", "y", 1, 2))
    got = url_filter.verdicts(spark.createDataFrame(rows, "page_id long, url string, host string, words string, block int, `first` int")).collect()
    assert collections.Counter((r["page_id"], r["host"], r["path"], r["rule"]) for r in got) == collections.Counter((r[0], *brute_rule(r[1])[:3]) for r in rows)
    verdict = {r["page_id"]: r["verdict"] for r in got}
    assert all(verdict[i] == brute_rule(u)[3] for i, u in enumerate(URLS) if brute_rule(u)[3])
    assert verdict[0] == verdict[2] == verdict[15] == "allow" and verdict[13] == verdict[14] == verdict[90] == "block"
    assert url_filter.verdicts(spark.createDataFrame([], "page_id long, url string")).count() == 0


def brute_urls(rows, texts=()):
    """{page: (words, score)} of URLs without a rule, with all counts in memory; and how many tokens there are."""
    seen = [re.sub(r"(?s)<(script|style)\b.*?</\1\s*>|<[^>]*>|&[a-z0-9#]+;", " ", (t or "").lower()) for t in texts]
    lexicon = collections.Counter(w for t in seen for w in re.findall(r"[^\W\d_]+", t) if re.fullmatch("[a-z]{1,63}", w))
    split = {i: brute_rule(u)[:2] for i, u in rows}
    cut = url_filter.Segmenter(lexicon)
    known = {n: cut.words(n, []) for h, p in split.values() for n in url_filter.names(h, p)}
    words = {i: url_filter.tokens(h, p, known) for i, (h, p) in split.items()}
    labels = [collections.Counter(w for name in url_filter.LABELLED[k] for w in name.split()) for k in ("allow", "block")]
    both = set(labels[0] | labels[1])

    def bayes(counts, urls):
        size = len(set(counts[0] | counts[1]) | both) + 1
        total = [labels[k].total() + counts[k].total() + 0.1 * size for k in (0, 1)]
        odds = lambda w: np.log((labels[1][w] + counts[1][w] + 0.1) / total[1]) - np.log((labels[0][w] + counts[0][w] + 0.1) / total[0])
        return np.log((urls[1] + 0.1) / (urls[0] + 0.9)), odds

    counts, urls = (collections.Counter(), collections.Counter()), [0, 0]
    prior, odds = bayes((collections.Counter(), collections.Counter()), urls)
    for i, (h, _) in split.items():
        if h:
            b = round(1024 / (1 + np.exp(-prior - sum(odds(w) for w in dict.fromkeys(words[i]) if w in both)))) / 1024
            for k, share in ((0, 1 - b), (1, b)):
                urls[k] += share
                for w in set(words[i]):
                    counts[k][w] += share
    prior, odds = bayes(counts, urls)
    return {i: (" ".join(words[i]), prior + sum(map(odds, dict.fromkeys(words[i])))) for i, u in rows if split[i][0] and not brute_rule(u)[2]}, len(counts[0])


def test_url_verdicts_equal_brute_force(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "url", "html")
    rows = pages.collect()
    names = ["spamfarm", "winfarm.win", "cheapwin", "farmwin", "libraryspamhelp", "newsads", "openforum", "thethan"]
    extra = [(10**6 + i, f"http://{n}.net/{'spam' if i == 4 else 'x'}", None) for i, n in enumerate(names)]
    pages = pages.unionByName(spark.createDataFrame(extra, pages.schema)).repartition(3)
    rows += extra
    want, _ = brute_urls([(r[0], r[1]) for r in rows], [r[2] for r in rows])
    got = {r["page_id"]: r for r in url_filter.verdicts(pages.select("page_id", "url"), pages.select("html")).collect()}
    assert len(got) == len(rows) and len(want) > 20
    for i, (words, score) in want.items():
        assert got[i]["words"] == words and abs(got[i]["block_score"] - score) < 1e-6 and got[i]["verdict"] == ("block" if score > 0 else "allow"), i
    # The verdict isn't a word list: names with a word of a blocked name are allowed for the others they hold.
    blocked = {w for name in url_filter.LABELLED["block"] for w in name.split()}
    listed = {i for i in want if blocked & set(want[i][0].split())}
    assert any(got[i]["verdict"] == "allow" for i in listed) and any(got[i]["verdict"] == "block" for i in listed)


def test_words_beside_labelled_ones_are_learned(spark):
    rows = [(n, f"http://casinozeborg{n}.net/") for n in range(30)] + [(100, "http://zeborg.net/"), (101, "http://quavor.net/")] + [(200 + n, f"http://librarymuseumquavor{n}.net/") for n in range(30)]
    texts = spark.createDataFrame([("<p>zeborg quavor</p><script>var casinozeborg = 1</script>",)], "html string")
    got = {r["page_id"]: r for r in url_filter.verdicts(spark.createDataFrame(rows, "page_id long, url string"), texts).collect()}
    assert got[3]["words"] == "casino zeborg # net" and got[203]["words"] == "library museum quavor # net"
    assert got[100]["verdict"] == "block" and got[101]["verdict"] == "allow"  # neither word is in any labelled name


def test_rare_words_of_a_large_url_table_keep_their_odds(spark):
    rng = random.Random(8)
    made = iter(sorted({"".join(rng.choices("bcdfghjkpqruvxyz", k=8)) for _ in range(56000)}))
    rows = [(n, f"http://host.net/{'/'.join([next(made) for _ in range(50)] * 4)}") for n in range(1100)] + [(1100, "http://escort-escort/escort"), (1101, "http://7.a-b.net/qzqzqzqzqzqzqzqzqzqzqzqzqzqzqzqzqz")]
    want, size = brute_urls(rows)
    assert size > 50000
    got = {r["page_id"]: r for r in url_filter.verdicts(spark.createDataFrame(rows, "page_id long, url string").repartition(3)).collect()}
    assert got[1100]["verdict"] == "block" and len(got) == len(want) == len(rows)
    for i, (words, score) in want.items():
        assert got[i]["words"] == words and abs(got[i]["block_score"] - score) < 1e-6, i


def test_segmenter():
    s = url_filter.Segmenter({})
    assert s.words("casinowinfreebets", []) == ["casino", "win", "free", "bets"]
    assert s.words("zzqqkkxxvv" * 9, []) == ["zzqqkkxxvv" * 9]
    assert url_filter.Segmenter({"over": 5, "flow": 5, "overflow": 40}).words("overflowoverflowing", []) == ["overflow", "overflow", "ing"]
    # Against the costs of all ways to cut a name.
    rng = random.Random(3)
    for _ in range(60):
        s = url_filter.Segmenter({"".join(rng.choices("ab", k=rng.randrange(1, 5))): rng.randrange(1, 60) for _ in range(8)})
        name = "".join(rng.choices("abc", k=rng.randrange(1, 11)))
        cost = lambda words: sum(s.cost.get(w, s.first + s.each * len(w)) for w in words)  # noqa: B023, E731
        ways = [[name[a:b] for a, b in zip([0, *cut], [*cut, len(name)])] for k in range(len(name)) for cut in itertools.combinations(range(1, len(name)), k)]
        assert abs(cost(s.words(name, [])) - min(map(cost, ways))) < 1e-9


# -- 8 ----------------------------------------------------------------------------------------


@pytest.mark.parametrize("limits", [(64 << 20, 64), (2000, 2)])
def test_warc(spark, monkeypatch, limits):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", limits[0])
    monkeypatch.setattr(warc, "FAN_IN", limits[1])
    rows = [(i, f"http://{'www.' if i % 2 else ''}h{i % 5}.example.org/p{i % 7}", f"<p>{i % 20}é</p>" * (i % 9)) for i in range(90)] + [(200, None, None), (201, "x y\nz", ""), (202, "http://a/", "x" * 300000), (203, "http://a/", "x" * 300000), (None, "http://n/", "only null"), (4, "http://again/", "again")]
    got = warc.archive_pages(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(6)).collect()
    best = {}
    for p, _, h in rows:
        k = (h or "").encode()
        best[k] = max((x for x in (best.get(k), p) if x is not None), default=None)
    want = collections.Counter()
    for p, _, h in rows:
        k = (h or "").encode()
        want[p, len(k), base64.b32encode(hashlib.sha1(k).digest()).decode(), "response" if best[k] == p else "revisit", None if best[k] == p else best[k]] += 1
    assert collections.Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got) == want
    got.sort(key=lambda r: r["rank"])
    assert [r["rank"] for r in got] == list(range(len(rows)))
    assert [r["part"] for r in got] == sorted(r["part"] for r in got)
    keys = [(r["url_key"], r["time"], r["page_id"] is not None, r["page_id"] or 0) for r in got]
    assert keys == sorted(keys) and sorted(k[0] for k in keys) == sorted(warc.url_key(warc._one_line(u or "")) for _, u, _ in rows)
    clashing = spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], "page_id long, url string, html string, body string, rank int, file string, sha int").repartition(6)
    cols = ["page_id", "payload_bytes", "record_type", "refers_to", "url_key", "rank"]
    assert sorted(map(str, warc.archive_pages(clashing).select(cols).collect())) == sorted(str(r) for r in spark.createDataFrame(got).select(cols).collect())
    assert warc.archive_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_loser_tree():
    rng = random.Random(4)
    for k in (0, 1, 2, 5, 8, 13):
        runs = [sorted(rng.randrange(50) for _ in range(rng.randrange(20))) for _ in range(k)]
        assert list(warc.LoserTree([iter(r) for r in runs])) == sorted(x for r in runs for x in r)


def test_url_key():
    assert warc.url_key("https://User@WWW.Example.com:80/A?b#c") == "com,example:80)/A?b"
    assert warc.url_key("http://example.com") == "com,example)/"


# -- 9 ----------------------------------------------------------------------------------------


def test_language_id(spark, edge, none):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = lang_id.train(docs)
    got = lang_id.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").filter(lang_id.held_out()).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) / len(got) >= 0.95
    out = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in lang_id.predict(edge, model).collect()}
    assert out[1] == out[2] == out[3] == ("und", 0.0) and all(0 <= s <= 1 for _, s in out.values())
    marks = spark.createDataFrame([(1, "123 !? 456"), (2, "\U0001f600"), (3, "\U00010400 x"), (4, "\u0301 \u0301"), (5, "e\u0301"), (6, "\U000e0100")], "doc_id long, text string")
    assert {r["doc_id"]: r["lang_pred"] == "und" for r in lang_id.predict(marks, model).collect()} == {1: True, 2: True, 3: False, 4: True, 5: False, 6: True}
    blank = lang_id.train(none)
    assert {r["lang_pred"] for r in lang_id.predict(edge, blank).collect()} == {"und"}
    one = lang_id.train(docs.filter("lang = 'de'"))
    assert {r["lang_pred"] for r in lang_id.predict(docs, one).collect()} <= {"de", "und"}
    lang_id.train(edge)
    clashing = edge.withColumnsRenamed({"score": "h", "row": "n", "hits": "salt", "part": "idx"})
    assert (lang_id.train(clashing).weights == lang_id.train(edge.repartition(5)).weights).all()


def test_language_scores_equal_plain_dot_products(spark, edge):
    rng = np.random.default_rng(7)
    names = [f"l{n:02d}" for n in range(lang_id.AT_ONCE + 3)]
    model = lang_id.Model(names, rng.normal(size=(1 << lang_id.BITS, len(names))), rng.normal(size=len(names)), 1.7)
    docs = edge.select("doc_id", "text").filter("doc_id NOT IN (7, 8)")
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in lang_id.predict(docs, model).collect():
        plain = re.sub(r"[^\w]|[\d_]", " ", (text[r["doc_id"]] or "").lower())
        chars = [ord(c) for c in re.sub(" +", " ", plain)]
        feats = []
        for k in (1, 2, 3):
            for i in range(len(chars) - k + 1):
                h = chars[i] * 0x9E3779B97F4A7C15 % 2**64
                for c in chars[i + 1 : i + k]:
                    h = int(C.mix(np.array([(h * 0xC2B2AE3D27D4EB4F + c * 0x9E3779B97F4A7C15) % 2**64], np.uint64))[0])
                if k > 1 or chars[i] != 0x20:
                    feats.append(h >> (64 - lang_id.BITS))
        if not any(c != 0x20 for c in chars):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        p = ftrl.link((model.weights[feats].sum(axis=0) / len(feats) + model.bias) / 1.7)
        assert r["lang_pred"] == model.langs[int(p.argmax())] and abs(r["score"] - p.max()) < 1e-9


def test_every_language_is_sampled(spark, monkeypatch):
    rows = [(n, f"lang {n % 90} word{n % 90} text", f"l{n % 90:02d}") for n in range(900)] + [(5000 + n, "most of all documents", "big") for n in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen, real = [], lang_id.Examples
    monkeypatch.setattr(lang_id, "Examples", lambda rows, most: seen.append(collections.Counter(r["label"] for r in rows.collect())) or real(rows, most))
    for most in (50, 600):  # fewer rows than languages, and more
        assert len(lang_id.train(docs, max_rows=most, epochs=1).langs) == 91
    assert seen[0] == {x: 1 for x in seen[0]} and len(seen[0]) == 91
    # Six of each, and the rest go to what is next: there are enough documents of one language alone.
    usable = collections.Counter(x for d, _, x in rows if zlib.crc32(str(d).encode()) % 5)
    assert seen[1].total() == 600 and all(seen[1][x] >= min(6, n) for x, n in usable.items())


def test_one_id_of_many_rows_is_one_example(spark):
    docs = spark.createDataFrame([(1, f"text number {n}", "en") for n in range(500)] + [(n, f"other {n}", "de") for n in range(2, 40)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(n, n % 2, 0) for n in range(40)], "doc_id long, quality int, toxic int")
    seen = []
    for module in (quality_model, lang_id):
        real = module.Examples

        def spy(rows, most, real=real):
            out = real(rows, most)
            seen.append(sum(1 for _ in out))
            return out

        module.Examples = spy
        try:
            quality_model.train(docs, labels) if module is quality_model else lang_id.train(docs)
        finally:
            module.Examples = real
    held = [sum(zlib.crc32(str(n).encode()) % of != rest for n in range(1, 40)) for of, rest in ((4, 2), (5, 0))]
    assert seen == held


def test_calibration_finds_the_temperature():
    rng = np.random.default_rng(0)
    raw = rng.normal(size=(4000, 3)) * 2
    p = ftrl.link(raw)
    y = np.array([rng.multinomial(1, q) for q in p])
    assert abs(lang_id.calibrate(raw * 3, y) - 3) < 0.4


# -- 10 ---------------------------------------------------------------------------------------


def test_decontaminate(spark, edge, none, small, monkeypatch):
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    items = [(r["item_id"], r["text"]) for r in bench.collect()]
    rng = random.Random(6)
    rows, want = [], {}
    filler = [w for r in small.limit(40).collect() for w in (r["text"] or "").split()]
    for n, (i, t) in enumerate(items * 3):
        w = t.split()
        for _ in range(len(w) // 8):
            k, at = rng.randrange(3), rng.randrange(len(w))
            w[at : at + (k != 1)] = [] if k == 0 and len(w) > 9 else [rng.choice(filler)]
        rows.append((n, " ".join(rng.choices(filler, k=rng.randrange(300)) + w + rng.choices(filler, k=rng.randrange(300)))))
        want[n] = i
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: {h["item_id"] for h in r["__hits"]} for r in decontaminate.mark(docs, bench).collect()}
    assert sum(want[n] in found[n] for n in want) >= len(want) - 1
    clean = spark.createDataFrame([(n, " ".join(rng.choices(filler, k=400))) for n in range(60)], "doc_id long, text string")
    assert decontaminate.drop_contaminated(clean, bench).count() == 60
    whole_items = spark.createDataFrame([(i, "before it " + t + " and after") for i, t in items], "doc_id long, text string")
    assert decontaminate.drop_contaminated(whole_items, bench).count() == 0
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 400)  # several passes
    assert decontaminate.drop_contaminated(whole_items, bench).count() == 0


def test_decontaminate_edges(spark, edge, none):
    odd = spark.createDataFrame([(None, "two words"), (1, None), (2, ""), (3, "never seen here before in any of these texts at all"), (4, "two words")], "item_id long, text string")
    out = decontaminate.mark(edge, odd).collect()
    hit = {r["doc_id"] for r in out if r[-1]}
    assert hit == {9, 10} and all(sorted(h["item_id"] for h in r[-2]) == [4] for r in out if r[-1])
    rows = clashes(spark, lambda d: decontaminate.drop_contaminated(d, odd), edge, none)
    assert 9 not in {r[0] for r in rows} and len(rows) == edge.count() - 2
    assert decontaminate.drop_contaminated(edge, odd.limit(0)).count() == edge.count()


def found_items(items, texts):
    """The items that the search finds in each text, with their distances."""
    got = [{} for _ in texts]
    for d, i, e in zip(*decontaminate.search(decontaminate.Items(list(range(len(items))), items), *C.utf8(pa.array(texts, pa.large_string())))):
        got[d][int(i)] = int(e)
    return got


def test_template_items_are_found_verbatim():
    forms = ["Which of the following is the capital of {}", "Which of the following towns in the far north is the capital of {} today", "In what year did the people of {} first vote"]
    for form in forms:
        items = [form.format(f"land{n}") for n in range(40)]
        texts = [f"some words before {t} and some words after it that fill the text" for t in items]
        assert all(got.get(n) == 0 for n, got in enumerate(found_items(items, texts))), form


def brute_distance(item, text):
    """Least word edit distance between item and any run of words of text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item):
        new = [i + 1]
        for j, b in enumerate(text):
            new.append(min(row[j] + (a != b), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def edited(rng, item, edits, word):
    out = list(item)
    for _ in range(edits):
        kind, at = rng.randrange(3), rng.randrange(len(out))
        out[at : at + (kind != 1)] = [] if kind == 0 else [word()]
    return out


def check_hits(items, texts):
    """Every hit has its exact distance, and 0.9 of all pairs' hits at least are found; returns how many there are."""
    want = [{i: e for i, item in enumerate(items) if item and (e := brute_distance(item, text)) <= int(0.35 * len(item))} for text in texts]
    got = found_items([" ".join(i) for i in items], [" ".join(t) for t in texts])
    assert all(g.items() <= w.items() for g, w in zip(got, want))
    n, all_ = sum(map(len, got)), sum(map(len, want))
    assert n >= 0.9 * all_, (n, all_)
    return n


@pytest.mark.parametrize("kinds", ["substitutions", "all edits"])
@pytest.mark.parametrize("share", [0.1, 0.2, 0.25, 0.3, 0.35])
@pytest.mark.parametrize("words", [2000, 40])
def test_items_are_found_up_to_the_limit(words, share, kinds):
    rng = random.Random(words)
    word = lambda: f"w{int(rng.random() ** 2 * words)}"
    items = [[word() for _ in range(n)] for n in [*range(8, 21)] * 2 + [30, 65, 130]]
    texts = []
    for item in items:
        if kinds == "all edits":
            held = edited(rng, item, int(share * len(item)), word)
        else:
            held = list(item)
            for at in rng.sample(range(len(item)), int(share * len(item))):
                held[at] = word()
        texts.append([word() for _ in range(rng.randrange(30))] + held + [word() for _ in range(rng.randrange(30))])
    assert check_hits(items, texts) >= len(items)


def test_hits_do_not_depend_on_the_other_items():
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(300)}"
    items = [" ".join(word() for _ in range(rng.randrange(1, 40))) for _ in range(40)]
    texts = [" ".join([word() for _ in range(10)] + edited(rng, i.split(), len(i.split()) // 4, word) + [word() for _ in range(10)]) for i in items]
    for got in zip(found_items(items, texts), *[found_items([i if n % 4 == part else "" for n, i in enumerate(items)], texts) for part in range(4)]):
        assert got[0] == {k: v for part in got[1:] for k, v in part.items()}


def test_long_text_of_one_repeated_passage():
    item = [f"w{n % 7}" for n in range(12)]
    assert found_items([" ".join(item)], [" ".join(item * 3000), "a " * 30000]) == [{0: 0}, {}]


def test_short_items_have_the_same_limit():
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(60)}"
    items = [[word() for _ in range(n)] for n in [*range(1, 8)] * 4]
    texts = [[word() for _ in range(20)] + edited(rng, item, int(0.35 * len(item)), word) + [word() for _ in range(20)] for item in items]
    want = [{i: e for i, item in enumerate(items) if (e := brute_distance(item, text)) <= int(0.35 * len(item))} for text in texts]
    assert found_items([" ".join(i) for i in items], [" ".join(t) for t in texts]) == want
    assert found_items(["one two three four five six seven"], ["so one two three x five six seven it is"]) == [{0: 1}]


def test_walk_keeps_hamming_distance_small():
    """Equal strings agree at every step wherever they stand; an edit leaves most of the tables' samples equal."""
    rng = np.random.default_rng(3)
    walk = decontaminate.Walk(24)
    item = rng.integers(1, 1 << 62, 24).astype(np.uint64)
    text = np.concatenate([rng.integers(1, 1 << 62, 5).astype(np.uint64), item, rng.integers(1, 1 << 62, 40).astype(np.uint64)])
    a = walk.keys(item, np.array([0]), np.array([24]))
    assert (a == walk.keys(text, np.array([5]), np.array([24]))).all()
    text[9] ^= np.uint64(1)
    assert 0.3 < (a == walk.keys(text, np.array([5]), np.array([24]))).mean() < 1
    assert (a == walk.keys(text, np.array([40]), np.array([24]))).mean() < 0.1


def test_edit_distance_is_exact():
    rng = random.Random(9)
    for _ in range(20):
        item = [f"a{rng.randrange(6)}" for _ in range(rng.randrange(8, 20))]
        text = [f"a{rng.randrange(6)}" for _ in range(rng.randrange(1, 40))]
        items = decontaminate.Items([0], [" ".join(item)])
        data, offsets = C.utf8(pa.array([" ".join(text)], pa.large_string()))
        _, h = decontaminate.symbols(data, offsets)
        got = decontaminate.edit_distances(items, np.array([0]), h, np.array([0]), np.array([len(h)]))[0]
        row = [0] * (len(text) + 1)
        for i, a in enumerate(item):
            new = [i + 1]
            for j, b in enumerate(text):
                new.append(min(row[j] + (a != b), row[j + 1] + 1, new[j] + 1))
            row = new
        assert got == min(row)


# -- pipeline ---------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def planted(spark, small, tmp_path_factory):
    """The folder of a small input, some of whose documents hold edited or whole items, long and short."""
    folder, rng = str(tmp_path_factory.mktemp("planted")), random.Random(12)
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet").orderBy("item_id").limit(20)
    items = [tuple(r) for r in bench.collect()] + [(9001, "vrax Olmidon teshu quorl"), (9002, "nine eight seven, zub six five four three")]
    rows = [r.asDict() for r in small.orderBy("doc_id").collect()]
    for n, r in enumerate(rows):
        if n % 5 == 0:
            item = items[n // 5 % len(items)][1].split()
            w = (r["text"] or "").split(" ")
            at = rng.randrange(len(w) + 1)
            r["text"] = " ".join(w[:at] + edited(rng, item, rng.randrange(int(0.3 * len(item)) + 1), lambda: "zzyzx") + w[at:])
    spark.createDataFrame([tuple(r.values()) for r in rows], small.schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, bench.schema).write.parquet(f"{folder}/benchmark.parquet")
    spark.read.parquet(f"{SMALL}/labels.parquet").write.parquet(f"{folder}/labels.parquet")
    return folder


def brute_hits(texts, items):
    """{item: least distance} of each text, over all pairs, for items within 0.35 of their words."""
    split = lambda t: [w.lower() for w in re.findall(rb"[0-9A-Za-z\x80-\xff]+", (t or "").encode())]
    out, parts = [], [(i, split(t)) for i, t in items]
    ids = {w: k for k, w in enumerate({w for _, p in parts for w in p})}
    for text in texts:
        words, found = np.array([ids.get(w, -1) for w in split(text)], np.int64), {}
        ramp = np.arange(len(words) + 1)
        for i, item in parts:
            row = np.zeros(len(words) + 1, np.int64)
            for w in item:
                new = row + 1
                new[1:] = np.minimum(new[1:], row[:-1] + (words != ids[w]))
                row = np.minimum.accumulate(new - ramp) + ramp
            if item and row.min() <= int(0.35 * len(item)):
                found[i] = int(row.min())
        out.append(found)
    return out


def test_decontaminate_query_equals_all_pairs(spark, planted):
    docs = spark.read.parquet(f"{planted}/documents.parquet").select("doc_id", "text").collect()
    hits = brute_hits([t for _, t in docs], [tuple(r) for r in spark.read.parquet(f"{planted}/benchmark.parquet").select("item_id", "text").collect()])
    want = collections.Counter((d, bool(h), tuple(sorted(h)), min(h.values(), default=None)) for (d, _), h in zip(docs, hits))
    got = collections.Counter((r["doc_id"], r["contaminated"], tuple(r["item_ids"]), r["least_distance"]) for r in decontaminate.op10(spark, planted).collect())
    assert got == want and sum(map(bool, hits)) >= len(docs) // 5


def test_pipeline_equals_brute_force(spark, planted, monkeypatch):
    import corpus_pipeline

    tables, write = {}, C.write_table
    monkeypatch.setattr(C, "write_table", lambda df, name, *a: tables.setdefault(name, write(df, name, *a)))
    last = corpus_pipeline.run(spark, planted).collect()
    docs = spark.read.parquet(f"{planted}/documents.parquet")
    stages = [[tuple(r) for r in docs.collect()], *([tuple(r) for r in tables[n.replace(" ", "-")].collect()] for n, _ in corpus_pipeline.STAGES[:-1])]
    at = {c: k for k, c in enumerate(docs.columns)}
    ids = [collections.Counter(r[at["doc_id"]] for r in rows) for rows in stages]
    text = {r[at["doc_id"]]: r[at["text"]] for r in stages[0]}
    assert all(set(b) <= set(a) for a, b in zip(stages, stages[1:])) and len(text) == len(stages[0])  # whole rows
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{planted}/labels.parquet").collect()}
    judged = [(d in ids[1]) == (labels[d] == 1) for d in labels if d in text]
    assert sum(judged) >= 0.9 * len(judged) > 0
    assert ids[2] == collections.Counter({c for _, c, _ in brute_classes([(d, text[d]) for d in ids[1]])}) and len(ids[2]) < len(ids[1])
    hits = brute_hits([text[d] for d in ids[2]], [tuple(r) for r in spark.read.parquet(f"{planted}/benchmark.parquet").select("item_id", "text").collect()])
    assert ids[3] == collections.Counter(d for d, h in zip(ids[2], hits) if not h) and len(ids[3]) < len(ids[2])
    size, taken, biggest = collections.Counter(), collections.Counter(), collections.Counter()
    for r in stages[3]:
        n = len(words_of(r[at["text"]]))
        size[r[at["source"]]] += n
        taken[r[at["source"]]] += n * ids[4][r[at["doc_id"]]]
        biggest[r[at["source"]]] = max(biggest[r[at["source"]]], n)
    order = sorted(size)
    for s, goal in zip(order, mixing.targets([size[s] for s in order], [1.0 + k % 3 for k in range(len(order))])):
        assert abs(taken[s] - goal) <= biggest[s], s
    assert max(ids[4].values()) <= 3
    mixed = sorted(ids[4].elements())
    want = collections.Counter((d, len(i), zlib.crc32(i.tobytes())) for d, i in zip(mixed, whole([text[d] for d in mixed])))
    assert collections.Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in last) == want
    last.sort(key=lambda r: r["start"])
    assert [r["start"] for r in last] == [0, *np.cumsum([r["n_tokens"] for r in last])[:-1]] and [r["doc_id"] for r in last] == mixed


def test_pipeline(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.01"
    docs, columns = spark.read.parquet(f"{sf}/documents.parquet"), None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = C.write_table(stage(spark, docs, sf), "stage")
        columns = columns or docs.columns
        assert out.columns == columns, name
        docs = out
    last = corpus_pipeline.tokens(spark, docs, sf).count()
    assert 0 < last == docs.count() == corpus_pipeline.run(spark, sf).count()


def test_queries_run(spark):
    from tidewire.llm.queries import oracle_sql, queries

    assert [n.split("_")[0] for n in queries()] == [f"op{i}" for i in range(1, 11)]
    assert set(oracle_sql()) <= set(queries())
    for name, f in queries().items():
        table = "pages" if name.split("_")[0] in ("op7", "op8") else "documents"
        assert f(spark, SMALL).count() == spark.read.parquet(f"{SMALL}/{table}.parquet").count(), name
