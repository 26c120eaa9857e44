"""Operators for training data against brute force, round trips and awkward tables."""

import base64
import hashlib
import json
import math
import random
import re
import sys
from collections import Counter
from fractions import Fraction
from pathlib import Path
from zlib import crc32

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from trafficloom.llm import (  # noqa: E402
    ann, chat, mixing, near_dedup, packing, pii, quality, queries, secret_scan, tokens, topk,
)

SF = "/root/testdata/sf0.001"
EXTRA = "doc_id long, text string, source string, node long, label int, size string, bands int, row int, mix int"


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    return pq.read_table(f"{SF}/documents.parquet").to_pandas()


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls in every column, empty and blank texts, a very long one, repeated rows, own ids."""
    rng = random.Random(5)
    long_text = words(rng, 30_000)
    rows = [
        (1, "one two three", "a"), (2, None, "a"), (3, "", "b"), (4, " \t\n ", None), (5, long_text, "b"),
        (6, long_text + " tail", None), (7, "One TWO three", "c"), (7, "One TWO three", "c"), (None, "one two three", "a"),
        (None, None, None), (8, "x" * 50_000, "a"), (9, "É é ſ K password=abcdef", "z"),
    ]
    return spark.createDataFrame([(*r, 0, 1, "s", 2, 3, 4) for r in rows], EXTRA)


def empty(df):
    return df.filter("1 = 0")


# -- near duplicates

def brute_components(rows, percent):
    def shingles(t):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    ids = [i for i, _ in rows]
    sets = [shingles(t) for _, t in rows]
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((find(ids[a]), find(ids[b])))
                root[q] = p
    return {i: (len(s), find(i)) for i, s in zip(ids, sets)}


def near_rows():
    rng = random.Random(1)
    rows, i = [], 0
    passage = words(rng, 60)
    for _ in range(12):
        first = words(rng, rng.randint(3, 200)).split()
        for k in range(rng.randint(1, 12)):
            own = list(first)
            for _ in range(k % 4):
                own[rng.randrange(len(own))] = words(rng, 1)
            rows.append((i, " ".join(own)))
            i += 1
    # A chain: neighbours are linked, its ends are not.
    chain = words(rng, 150).split()
    for _ in range(25):
        chain = chain[3:] + words(rng, 3).split()
        rows.append((i, " ".join(chain)))
        i += 1
    for n in (20, 30, 90):
        rows.append((i, passage + " " + words(rng, n)))
        i += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("percent", [85, 80, 60])
@pytest.mark.parametrize("block", [2_000_000, 400])
def test_near_duplicates(spark, monkeypatch, percent, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rows = near_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(df, percent=percent).collect()}
    assert got == brute_components(rows, percent)


def test_near_duplicates_on_awkward_rows(spark, awkward):
    got = near_dedup.near_duplicates(awkward)
    assert got.count() == awkward.count()
    by_id = {r.doc_id: r for r in got.collect()}
    assert [by_id[i].n_shingles for i in (1, 2, 3, 4, 8)] == [1, 0, 0, 0, 1]
    assert by_id[7].component_id == 1 and by_id[6].component_id == 5 and by_id[2].kept
    assert by_id[None].component_id is None and by_id[None].kept
    assert near_dedup.near_duplicates(empty(awkward)).count() == 0


def test_block_forest_spans_what_pairs_would():
    rng = random.Random(3)
    first = words(rng, 80).split()
    sets = []
    for k in range(40):
        own = list(first)
        own[rng.randrange(80)] = words(rng, 1)
        sets.append(near_dedup.shingle_set(" ".join(own)))
    found = near_dedup.forest(list(range(40)), list(range(40)), sets, 85)
    assert len(found) == 39


# -- vectors

def vector_table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, v int, dim int")


@pytest.fixture(scope="module")
def awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [-1.0, 0.5]), (4, [0.0, 0.0]), (5, None), (6, []),
        (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [None, 1.0]), (None, [1.0, 1.0]), (10, [3.0, 3.0]), (10, [3.0, 3.0]),
        (100, [1.0, 2.0]), (11, [1.0, 2.0, 3.0]), (200, [1.0, 2.0, 4.0]),
    ]
    return vector_table(spark, [(*r, 1, 2) for r in rows])


def test_neighbours_have_recall_and_exact_scores(spark):
    table = pq.read_table("/root/testdata/sf0.1/embeddings.parquet").to_pandas()
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    x = np.stack(table["embedding"]).astype(float)
    got = ann.nearest_neighbours(df, F.col("id") % 20 == 0, k=20, shard_size=700).toPandas()
    hits = 0
    for q, own in got.groupby("query_id"):
        scores = x @ x[q]
        scores[q] = -np.inf
        best = set(np.argsort(-scores, kind="stable")[:20])
        hits += len(best & set(own["vec_id"]))
        assert np.allclose(own["score"], scores[own["vec_id"]], rtol=1e-12, atol=0)
        assert own.sort_values("rank")["rank"].tolist() == list(range(1, 21))
    assert hits >= 0.95 * 20 * got["query_id"].nunique()


def graph_recall(v, ef, k=20):
    """Of every twentieth vector's k nearest others in the shard."""
    graph = ann.Graph.build(ann.equal_length(v))
    asked = v[::20]
    length = np.linalg.norm(asked, axis=1, keepdims=True)
    found, _ = graph.search(np.hstack([asked / length, 0 * length]).astype(np.float32), ef)
    scores = asked @ v.T
    scores[np.arange(len(asked)), np.arange(0, len(v), 20)] = -np.inf
    hits = 0
    for row, entries in zip(scores, found):
        entries = entries[entries >= 0]
        hits += len({*entries[np.argsort(-row[entries])][:k]} & {*np.argsort(-row)[:k]})
    return hits / (k * len(asked))


def test_recall_in_a_full_shard():
    """Vectors without any structure are the hardest: given ones, and clusters, have more recall."""
    rng = np.random.default_rng(0)
    recall = graph_recall(rng.standard_normal((ann.SHARD, 64)), ann.EF_SEARCH)
    print("recall", recall)
    assert recall > 0.9
    given = np.stack(pq.read_table("/root/testdata/sf0.1/embeddings.parquet")["embedding"].to_numpy()).astype(float)
    given = given[: ann.SHARD // 2]
    # The rest of the shard: the given ones moved a little, so it has their clusters, only denser.
    more = given[rng.integers(0, len(given), ann.SHARD - len(given))]
    more = more + 0.3 * np.abs(given).mean() * rng.standard_normal(more.shape)
    of_given = graph_recall(np.vstack([given, more]), ann.EF_SEARCH)
    print("given", of_given)
    assert of_given > 0.95


def test_neighbours_among_lengths_of_all_magnitudes(spark):
    """A few vectors thousands of times longer, shorter ones, and some whose squares overflow."""
    rng = np.random.default_rng(4)
    v = rng.standard_normal((1500, 12))
    v[:3] *= 5000.0
    v[3:6] *= 1e200
    v[6:9] *= 1e-200
    v[700:1000] *= 1e-3
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    got = ann.nearest_neighbours(df, F.col("id") % 20 == 10, k=20).toPandas()
    hits = asked = 0
    for q in range(10, 1500, 20):
        scores = v @ v[q]
        scores[q] = -np.inf
        hits += len({*got[got["query_id"] == q]["vec_id"]} & {*np.argsort(-scores, kind="stable")[:20].tolist()})
        asked += 20
    print("recall", hits / asked)
    assert hits / asked > 0.95


def test_neighbours_on_awkward_rows(spark, awkward_vectors):
    got = ann.nearest_neighbours(awkward_vectors, F.col("id") % 100 == 0, k=3).collect()
    by = {q: [r.vec_id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q] for q in (0, 100, 200)}
    assert by == {0: [10, 1, 2], 100: [10, 0, 1], 200: [11]}
    assert ann.nearest_neighbours(empty(awkward_vectors), F.col("id") == 0).count() == 0
    assert ann.nearest_neighbours(awkward_vectors, F.col("id") == 12345).count() == 0


def test_exact_top_against_brute_force(spark):
    table = pq.read_table("/root/testdata/sf0.1/embeddings.parquet").to_pandas()
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    x = np.floor(1024 * np.stack(table["embedding"]).astype(float)).astype(np.int64)
    got = topk.top_inner_products(df, F.col("id") % 100 == 0, k=10, shard_size=700).toPandas()
    assert got["query_id"].nunique() == 20
    for q, own in got.groupby("query_id"):
        scores = x @ x[q]
        order = [i for i in sorted(range(len(x)), key=lambda i: (-scores[i], i)) if i != q][:10]
        own = own.sort_values("rank")
        assert own["vec_id"].tolist() == order and own["score"].tolist() == scores[order].tolist()


def test_exact_top_on_awkward_rows(spark, awkward_vectors):
    got = topk.top_inner_products(awkward_vectors, F.col("id") % 100 == 0, k=4).collect()
    by = {q: [r.vec_id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q] for q in (0, 100, 200)}
    assert by == {0: [10, 1, 2, 100], 100: [10, 0, 1, 2], 200: [11]}
    assert topk.top_inner_products(empty(awkward_vectors), F.col("id") == 0).count() == 0


@pytest.mark.parametrize("outlier", [3e3, 1e7, 1e13, 1e200, 1.7e308])
def test_exact_top_with_large_components(spark, outlier):
    """Outlier dimensions, products that no long holds, and scores that differ in their last units."""
    rng = random.Random(3)

    def vector():
        v = [rng.gauss(0, 1) for _ in range(6)]
        v[rng.randrange(3)] = rng.choice((1.0, -1.0, 0.5)) * outlier * rng.choice((1.0, 1.0, 1 - rng.random()))
        return v

    rows = [(i, vector()) for i in range(500)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_inner_products(df, F.col("id") % 20 == 0, k=10, shard_size=120).collect()
    whole = {i: [math.floor(1024 * Fraction(x)) for x in v] for i, v in rows}
    want = set()
    for q in range(0, 500, 20):
        scores = {i: sum(a * b for a, b in zip(v, whole[q])) for i, v in whole.items() if i != q}
        best = sorted(scores, key=lambda i: (-scores[i], i))[:10]
        want |= {(q, r, i, min(max(scores[i], -(2**63)), 2**63 - 1)) for r, i in enumerate(best, 1)}
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_exact_top_orders_what_is_beyond_a_long():
    scores = [-(2**200), -(2**80) - 1, -(2**80), -(2**63) - 1, -(2**63), -1, 0, 2**63 - 1, 2**63, 2**80, 2**200]
    shown = [(min(max(s, -(2**63)), 2**63 - 1), topk.beyond(s)) for s in scores]
    assert shown == sorted(shown) and len(set(shown)) == len(scores)


def test_reading_stops_early_where_it_can():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 5, (4000, 3))
    values[:20] += 1000
    columns = np.ascontiguousarray(values.T)
    lists = np.argsort(columns, axis=1, kind="stable")
    (left, other), depth = topk.candidates(columns, lists, np.array([[3, 2, 1], [-1, -1, -1]]), 10)
    assert depth[0] < 4000 and set(left) <= set(range(20))
    assert set(np.flatnonzero(values.sum(axis=1) == 0)) <= set(other)


def test_strong_lists_and_known_scores_spare_reading():
    """No structure at all, so every list matters; still not every list is read to its end."""
    rng = np.random.default_rng(2)
    values = rng.standard_normal((3000, 64)).round(2)
    columns = np.ascontiguousarray(values.T)
    lists = np.argsort(columns, axis=1, kind="stable")
    queries = rng.standard_normal((40, 64)).round(2)
    scores = queries @ columns
    kth = np.sort(scores, axis=1)[:, -10]
    slack = 1e-9
    alone, by_itself = topk.candidates(columns, lists, queries, 10, slack)
    known, with_score = topk.candidates(columns, lists, queries, 10, slack, kth)
    for row, at, a, b in zip(scores, kth, alone, known):
        best = set(np.flatnonzero(row >= at))
        assert best <= set(a) and best <= set(b)
    print("depth", by_itself.mean() / 3000, with_score.mean() / 3000)
    assert by_itself.mean() < 0.95 * 3000 and with_score.mean() < 0.85 * 3000
    none, depth = topk.candidates(columns, lists, queries, 10, slack, 1e9)
    assert not any(len(x) for x in none) and depth.max() <= topk.FIRST_STRETCH


# -- tokens and packing

def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.vocabulary_path(tokens.VOCABULARY))


ODD = [
    "", "a  b\n\n c", "  x", "we're 'll 're 'd", "foo<|endoftext|>bar <|endoftext|> <|endof", " \t\x1c !\x1c! a", "日本語 é 　x  \n",
    "'", "''ll", "a \n b   ", "!'s !'re", "x" * 300, "=== " * 5 + "=" * 200, "ab<|endoftext|>", "a\x00b \x01c", " \n \n\n x", "\r\n\r\n a",
    "a <|endoftext|><|endoftext|> c", "x\n \ny", "a   b    c ", " a   b", "1234 5a6 7", "é \U0001F600\U0001F600",
]


def test_ids_are_those_of_the_library(texts):
    made, lib = tokens.Ids(tokens.vocabulary_path(tokens.VOCABULARY)), library()
    for text in ODD + texts["text"].dropna().tolist():
        assert np.frombuffer(made.encode(text), "<u4").tolist() == lib.encode(text, add_special_tokens=False).ids, text


def test_prefix_counts_are_those_of_the_library(texts):
    made, lib = tokens.Prefixes(tokens.vocabulary_path(tokens.VOCABULARY)), library()
    for text in ODD + [t[:300] for t in texts["text"].dropna().tolist()[:60]]:
        got = tokens.counts_of(made.encode(text)).tolist()
        prefixes = [text[:i] for i in range(len(text) + 1)]
        assert got == [len(e.ids) for e in lib.encode_batch(prefixes, add_special_tokens=False)], text


def test_token_counts(spark, texts, awkward):
    got = tokens.prefix_counts(spark.read.parquet(f"{SF}/documents.parquet"), 100).collect()
    lib = library()
    own = dict(zip(texts["doc_id"], texts["text"]))
    for r in got:
        text = own[r.doc_id] or ""
        ids = lib.encode(text, add_special_tokens=False).ids
        assert (r.n_tokens, r.n_bytes) == (len(ids), len(text.encode()))
        assert tokens.longest_prefix(r.steps, 100) == r.fits_chars
        assert tokens.tokens_in_prefix(r.steps, r.fits_chars) <= 100
    got = tokens.prefix_counts(awkward)
    assert got.count() == awkward.count() and got.filter("n_tokens = 0").count() == 3
    assert tokens.prefix_counts(empty(awkward)).count() == 0


def check_packed(rows, want, capacity):
    """Every id in one piece, sequences without gap; returns the share of padding."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
        assert r.ids_crc32 == crc32(r.ids) and r.length == len(r.ids) // 4 > 0
    for (doc, n), own in by_doc.items():
        copies = sum(r.start == 0 for r in own)
        assert sum(r.length for r in own) == copies * n
        if copies == 1 and doc is not None:
            assert b"".join(r.ids for r in sorted(own, key=lambda r: r.start)) == want[doc]
    used = 0
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
        used += at
    return 1 - used / (capacity * len(by_sequence))


def test_packing_keeps_large_ids_beside_null_ids(spark):
    large = 2**60 + 1
    docs = spark.createDataFrame([(large, "a b"), (None, "c"), (None, None), (large + 2, "")], "doc_id long, text string")
    got = packing.pack(docs, 256).collect()
    assert sorted(r.doc_id or 0 for r in got) == [0, 0, large, large + 2]
    ends: dict = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length


def test_packing(spark, texts, awkward):
    lib = library()

    def ids(t):
        return np.array([*lib.encode(t or "", add_special_tokens=False).ids, 0], "<u4").tobytes()

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = packing.pack(docs, 1024, with_ids=True).collect()
    assert check_packed(got, {i: ids(t) for i, t in zip(texts["doc_id"], texts["text"])}, 1024) < 0.02
    assert {r.doc_id for r in got} == set(texts["doc_id"])
    slim = packing.pack(docs, 1024).collect()
    key = lambda r: (r.doc_id, r.start, r.length == 1024 or r.sequence_id, r.offset)
    assert sorted(map(key, got)) == sorted(map(key, slim))
    got = packing.pack(awkward, 256, with_ids=True).collect()
    check_packed(got, {r.doc_id: ids(r.text) for r in awkward.collect()}, 256)
    assert sum(r.start == 0 for r in got) == awkward.count()
    assert packing.pack(empty(awkward)).count() == 0



def test_packing_shares_equal_rows_out(spark):
    docs = spark.createDataFrame([(7, "one two three")] * 6000 + [(8, "four")] * 40, "doc_id long, text string")
    got = packing.pack(docs.repartition(5), 64, pool=500).collect()
    assert len(got) == 6040 and len({(r.sequence_id, r.offset) for r in got}) == 6040
    per_pool = Counter(r.sequence_id >> 32 for r in got if r.doc_id == 7)
    assert max(per_pool.values()) <= 8 * packing.EQUAL and len(per_pool) >= 6
    ends: dict = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 64
    again = packing.pack(docs.repartition(3), 64, pool=500).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))


def test_windows_are_filled():
    rng = random.Random(2)
    lengths = [rng.randint(1, 1023) for _ in range(3000)]
    windows = packing.pack_lengths(lengths, 1024)
    assert sorted(i for w in windows for i in w) == list(range(3000))
    fills = [sum(lengths[i] for i in w) for w in windows]
    assert max(fills) <= 1024 and sum(fills) > 0.98 * 1024 * len(fills)


@pytest.mark.parametrize("seed", range(20))
def test_best_fill_is_the_best(seed):
    rng = random.Random(seed)
    counts = {rng.randint(1, 30): rng.randint(1, 3) for _ in range(4)}
    room = rng.randint(1, 60)
    chosen = packing.best_fill(counts, sorted(counts, reverse=True), room)
    assert all(n <= counts[length] for length, n in chosen)
    sums = {0}
    for length, n in counts.items():
        sums = {s + k * length for s in sums for k in range(n + 1)}
    assert sum(length * n for length, n in chosen) == max(s for s in sums if s <= room)


# -- quality

def test_quality_tells_labelled_documents_apart(spark):
    """Fitted on one half of the labels, ranked on the other."""
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    half = F.xxhash64("doc_id") % 2 == 0
    made = quality.resample(docs, labels.filter(half), queries.is_target()).select("doc_id", "quality.*")
    held = made.join(labels.filter(~half), "doc_id").toPandas()
    good, bad = held[held["quality"] == 1], held[held["quality"] == 0]
    auc = np.mean([np.mean((good["key"] > b) + 0.5 * (good["key"] == b)) for b in bad["key"]])
    assert auc > 0.97
    assert good["kept"].mean() > 0.985 and bad["kept"].mean() < 0.2


def test_quality_rejects_toxic_documents(spark):
    """Fitted and calibrated on one half of the labels, judged on the other."""
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    half = F.xxhash64("doc_id") % 2 == 0
    made = quality.resample(docs, labels.filter(half), queries.is_target(), unwanted=queries.is_toxic())
    held = made.select("doc_id", "quality.kept").join(labels.filter(~half), "doc_id").toPandas()
    good = held[held["quality"] == 1]
    toxic, clean = (good[good["toxic"] == t]["kept"] for t in (1, 0))
    print("toxic rejected", 1 - toxic.mean(), "of", len(toxic), "clean kept", clean.mean(), "of", len(clean))
    assert toxic.mean() < 0.15 and clean.mean() > 0.98


def test_toxic_needs_labels_of_both_sorts(spark):
    docs = spark.createDataFrame([(i, f"word{i} some text") for i in range(20)], "doc_id long, text string")
    for toxic in (0, 1, None):
        labels = spark.createDataFrame([(i, 1, toxic) for i in range(9)], "doc_id long, quality int, toxic int")
        got = quality.resample(docs, labels, F.lit(False), unwanted=queries.is_toxic())
        assert got.filter("quality.kept").count() == 20


def test_quality_on_awkward_rows(spark, awkward):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 0), (7, None, None)], "doc_id long, quality int, toxic int")
    got = quality.resample(awkward, labels, queries.is_target())
    assert got.count() == awkward.count()
    assert got.filter("quality.log_weight = 0 and doc_id in (2, 3, 4)").count() == 3
    none = quality.resample(awkward, labels.filter("1 = 0"), queries.is_target())
    assert none.filter("quality.kept").count() == awkward.count()
    assert quality.resample(empty(awkward), labels, queries.is_target()).count() == 0


def test_kth_largest(spark):
    values = [random.Random(i).choice([1.5, 2.5, -7.0, random.Random(i).gauss(0, 50)]) for i in range(700)]
    df = spark.createDataFrame([(v,) for v in values], "key double")
    for k in (1, 5, 350, 699, 700):
        assert quality.kth_largest(df, k, min(values), max(values)) == sorted(values, reverse=True)[k - 1]


# -- personal data

def plain_feistel(value, left, right, key, tweak):
    """The permutation, step by step."""
    l, r = divmod(value, right)
    for i in range(pii.ROUNDS):
        other = r if i % 2 == 0 else l
        drawn = int(hashlib.sha256(f"{key}:{tweak}:{i}:{other}".encode()).hexdigest()[:15], 16)
        if i % 2 == 0:
            l = (l + drawn) % left
        else:
            r = (r + drawn) % right
    return l * right + r


def plain_digits(digits, key, tweak):
    n, half = len(digits), len(digits) // 2
    made = plain_feistel(int(digits), 10 ** (n - half), 10**half, key, f"{tweak}{n}")
    return str(made).zfill(n)


def luhn_ok(digits):
    figures = [int(c) for c in reversed(digits)]
    return (sum(figures[::2]) + sum(sum(divmod(2 * d, 10)) for d in figures[1::2])) % 10 == 0


def with_luhn(body):
    return next(body + c for c in "0123456789" if luhn_ok(body + c))


def iban_ok(text):
    compact = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in compact[4:] + compact[:4])) % 97 == 1


def with_iban_check(country, account):
    return next(f"{country}{c:02d}{account}" for c in range(2, 99) if iban_ok(f"{country}{c:02d}{account}"))


def figures(rng, n):
    return "".join(rng.choice("0123456789") for _ in range(n))


def test_pseudonyms_against_plain_permutations(spark):
    """3,000 values of each kind: valid ones stay valid, no two meet, and they are those of the plain code."""
    rng = random.Random(6)
    n = 3000
    made = {
        "ssn": [f"{a:03d}-{rng.randrange(1, 100):02d}-{rng.randrange(1, 10000):04d}" for a in
                rng.choices([x for x in range(1, 900) if x != 666], k=n)],
        "phone": [f"+{rng.choice(['1', '49', '353', '7'])}{rng.randrange(10**9, 10**10)}" for _ in range(n)],
        "card": [with_luhn(b + figures(rng, m - len(b) - 1)) for b, m in rng.choices(
            [("37", 15), ("34", 15), ("36", 14), ("305", 14), ("4", 13), ("4", 16), ("4", 19), ("62", 18), ("55", 16)], k=n)],
        "iban": [with_iban_check(c, b + figures(rng, m)) for c, b, m in rng.choices(
            [("DE", "", 18), ("GB", "NWBK", 14), ("NL", "ABNA", 10), ("MT", "MALT", 23), ("NO", "", 11)], k=n)],
    }
    rows = [(i, f"a {x} b") for kind in made for i, x in enumerate(made[kind])]
    found = pii.pseudonymise(spark.createDataFrame(rows, "doc_id long, text string").repartition(8), "k").select(
        "doc_id", "text", F.explode("found").alias("f")).select("doc_id", "text", "f.*").collect()
    got = {kind: {r.value: r.pseudonym for r in found if r.kind == kind} for kind in made}
    assert all(r.text == f"a {r.pseudonym} b" for r in found)
    for kind, values in made.items():
        assert set(got[kind]) == set(values), kind
        assert len(set(got[kind].values())) == len(got[kind])
    for value, p in got["ssn"].items():
        area, group, serial = (int(x) for x in value.split("-"))
        rank = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
        upper, low = divmod(plain_feistel(rank, 898 * 99, 9999, "k", "ssn"), 9999)
        area = upper // 99 + 1
        assert p == f"{area + (area >= 666):03d}-{upper % 99 + 1:02d}-{low + 1:04d}"
        assert not re.search(r"^(?:000|666|9)|-00-|-0000$", p)
    for value, p in got["phone"].items():
        code = next(c for c in ("+1", "+49", "+353", "+7") if value.startswith(c))
        assert p == code + plain_digits(value[len(code):], "k", "phone" + code)
    for value, p in got["card"].items():
        kept = "" if len(value) == 16 else value[:3]
        assert luhn_ok(p) and p[:-1] == kept + plain_digits(value[len(kept):-1], "k", "card" + kept)
    for value, p in got["iban"].items():
        account = value[4:]
        digits = re.sub(r"\D", "", account)
        frame, half = "iban" + value[:2] + re.sub(r"\d", ".", account), len(digits) // 2
        first = plain_digits(digits[:half], "k", frame + digits[half:])
        rest = iter(first + plain_digits(digits[half:], "k", frame + first))
        assert p == with_iban_check(value[:2], re.sub(r"\d", lambda _: next(rest), account))


def test_one_value_in_many_spellings_has_one_pseudonym(spark):
    spellings = [
        ["+15045552652", "+1 504 555 2652", "+1 (504) 555-2652", "+1-504-555-2652", "(504) 555-2652"],
        ["+493012345678", "+49 30 1234 5678", "+49 (30) 1234-5678"],
        ["378282246310005", "3782 822463 10005", "3782-822463-10005"],
        ["4111111111111111", "4111 1111 1111 1111"],
        ["DE89370400440532013000", "DE89 3704 0044 0532 0130 00"],
        ["GB29NWBK60161331926819", "GB29 NWBK 6016 1331 9268 19"],
    ]
    rows = [(i, f"{x}, {x}") for i, group in enumerate(spellings) for x in group]
    left = ["378282246310006", "DE89370400440532013001", "1234567890123", "AB12CDEFGHIJKLMNOP"]
    rows += [(-1, x) for x in left]
    rows += [(100, "x" * 200_000 + " +1 504 555 2652 " + "9" * 50_000), (100, "+15045552652"), (100, "+15045552652")]
    got = pii.pseudonymise(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()
    assert len(got) == len(rows)
    for i, group in enumerate(spellings):
        mine = [r for r in got if r.doc_id == i]
        plain = [re.sub(r"[ ()-]", "", f.pseudonym) for r in mine for f in r.found]
        assert len(plain) == 2 * len(group) and len({p.removeprefix("+1") for p in plain}) == 1, plain
        assert not any(x in r.text for r in mine for x in group)
    assert all(not r.found for r in got if r.doc_id == -1) and {r.text for r in got if r.doc_id == -1} == set(left)
    many = [f.pseudonym for r in got if r.doc_id == 100 for f in r.found]
    assert len(many) == 3 and len({re.sub(" ", "", p) for p in many}) == 1


def test_pseudonyms_keep_formats_and_links(spark):
    rows = [
        (1, "Card 4111 1111 1111 1111, again 4111111111111111; bad 4111 1111 1111 1112."),
        (2, "call +1 (504) 555-2652 or (504) 555-2652! ip 196.3.67.149 not 300.1.1.1, v 1.2.3.4.5"),
        (3, "born 1984-02-29, 31.12.1999 and 2/3/2004; not 31.04.1999 or 2023-13-01. ssn 123-45-6789 000-12-3456"),
        (4, "und.34@mail7.example.com, ly.39@mail1.example.com&&& @ é.ü@x.de 9@"),
        (5, "same card 4111111111111111 and +1 (504) 555-2652"),
        (6, None), (7, ""), (None, "x 1984-02-29"),
    ]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, found int, matches int")
    got = {r.doc_id: r for r in pii.pseudonymise(df, "key").collect()}
    kinds = {i: [f.kind for f in r.found] for i, r in got.items()}
    assert kinds == {
        1: ["card", "card"], 2: ["phone", "phone", "ip"], 3: ["date"] * 3 + ["ssn"], 4: ["email"] * 3,
        5: ["card", "phone"], 6: [], 7: [], None: ["date"],
    }
    card = got[1].found[1].pseudonym
    assert card == got[5].found[0].pseudonym and card == got[1].found[0].pseudonym.replace(" ", "") and len(card) == 16
    total = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(card)))
    assert total % 10 == 0 and card != "4111111111111111"
    assert got[2].found[0].pseudonym == got[5].found[1].pseudonym
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", got[2].found[0].pseudonym)
    assert got[3].found[0].pseudonym == got[None].found[0].pseudonym
    assert re.fullmatch(r"\d\d\.\d\d\.19\d\d", got[3].found[1].pseudonym) and re.fullmatch(r"\d\d/\d\d/20\d\d", got[3].found[2].pseudonym)
    for r in got.values():
        for f in r.found:
            assert f.value not in r.text and f.pseudonym in r.text
    assert "4111 1111 1111 1112" in got[1].text and "31.04.1999" in got[3].text and "300.1.1.1" in got[2].text
    assert got[6].text is None and got[7].text == ""
    assert pii.pseudonymise(empty(df), "key").count() == 0


def test_feistel_is_a_permutation(spark):
    for left, right in ((92, 397), (75, 487), (10, 10)):
        n = left * right
        made = spark.range(n).select(
            pii.feistel(F.col("id"), F.lit(left).cast("long"), F.lit(right).cast("long"), "k", F.lit("t")).alias("p")
        )
        assert made.agg(F.countDistinct("p"), F.min("p"), F.max("p")).first()[:] == (n, 0, n - 1)


# -- mixing

def test_targets_share_what_is_above():
    got = mixing.targets({"b": 100, "a": 10, None: 50}, (5, 2, 1), Fraction(3, 2), 2)
    assert got == {"a": 20, "b": Fraction(440, 3), None: Fraction(220, 3)}
    assert sum(got.values()) == 240 and mixing.targets({}, (1,), Fraction(3, 2), 2) == {}


def test_mixing(spark, texts):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = mixing.mix(docs).select("doc_id", "mix.*").toPandas()
    frame = docs.toPandas().merge(got, on="doc_id")
    assert len(frame) == docs.count()
    assert (frame["size"] == frame["text"].fillna("").map(lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t)))).all()
    assert (frame["taken"] <= 2 * frame["size"]).all() and (frame["taken"] == frame["copies"] * frame["size"]).all()
    for _, own in frame.groupby("source", dropna=False):
        assert own["source_size"].iloc[0] == own["size"].sum()
        assert abs(own["taken"].sum() - own["target"].iloc[0]) <= 0.002 * own["target"].iloc[0]
    total = frame.groupby("source", dropna=False)["target"].first().sum()
    assert math.isclose(total, 1.5 * frame["size"].sum(), rel_tol=1e-9)
    again = mixing.mix(docs.repartition(7)).select("doc_id", "mix.*").toPandas()
    assert again.sort_values("doc_id").reset_index(drop=True).equals(got.sort_values("doc_id").reset_index(drop=True))


def test_mixing_cuts_large_sources(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET", 16)
    rows = [(i, "w " * (1 + i % 40), "ab"[i % 3 == 0]) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs, carry=("doc_id", "source", "text")).select("source", "mix.*").toPandas()
    for _, own in got.groupby("source"):
        assert abs(own["taken"].sum() - own["target"].iloc[0]) <= 3


def test_mixing_on_awkward_rows(spark, awkward):
    got = mixing.mix(awkward, carry=("doc_id", "size", "bands")).collect()
    assert len(got) == awkward.count() and {r.size for r in got if hasattr(r, "size")}
    assert all(r.mix.taken == 0 for r in got if r.doc_id in (2, 3, 4))
    assert mixing.mix(empty(awkward)).count() == 0


def brute_mix(frame, aims):
    """Copies by id: expected copies, ranks and the head of the order in plain Python."""
    out = {}
    for source, own in frame.groupby("source", dropna=False):
        target = aims[None if source is None or source != source else source]
        words = own.groupby("odds")["size"].sum().to_dict()
        low, high = 0.0, 2.0
        for _ in range(200):  # copies per odds by bisection
            unit = (low + high) / 2
            total = sum(min(2.0, unit * o) * n for o, n in words.items())
            low, high = (unit, high) if total < float(target) else (low, unit)
        times = np.minimum(2.0, high * own["odds"])
        times = np.where(np.abs(times - np.round(times)) < 1e-9, np.round(times), times)
        whole = np.floor(times)
        p, u = times - whole, own["u"].to_numpy()
        with np.errstate(divide="ignore", invalid="ignore"):
            rank = np.where(p > 0, u / (1 - u) / (p / (1 - p)), np.inf)
        room = float(target) - (whole * own["size"]).sum()
        for i in np.argsort(rank, kind="stable"):
            out[own["doc_id"].iloc[i]] = (int(whole[i]), rank[i], own["size"].iloc[i], room)
            if rank[i] < np.inf:
                room -= own["size"].iloc[i]
    return out


def test_mixing_takes_the_head_of_the_order(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r for r in mixing.mix(docs).select("doc_id", "mix.*").collect()}
    key = F.xxhash64(F.col("doc_id").cast("string"), F.xxhash64("text"), F.xxhash64(F.struct("doc_id")), F.lit(0))
    u = (F.shiftrightunsigned(key, 11).cast("double") + 0.5) / 2.0**53
    frame = docs.select("doc_id", "source", u.alias("u")).toPandas()
    frame["size"] = [got[i].size for i in frame["doc_id"]]
    frame["odds"] = [int(n).bit_length() for n in frame["size"]]
    sizes = {None if s != s else s: int(n) for s, n in frame.groupby("source", dropna=False)["size"].sum().items()}
    want = brute_mix(frame, mixing.targets(sizes, mixing.WEIGHTS, Fraction(3, 2), 2))
    drawn = other = 0
    for i, (whole, rank, size, room) in want.items():
        if rank == np.inf:
            assert got[i].copies == whole
        else:
            assert got[i].copies - whole in (0, 1)
            drawn += got[i].copies - whole
            other += (got[i].copies > whole) != (room >= size)  # beside the rows that close a gap
    assert drawn > 20 and other <= 8 * len(sizes)


def test_expected_copies():
    got = mixing.expected_copies({0: 0, 1: 100, 2: 100, 8: 10}, Fraction(200), 2)
    assert got == {0: 0, 1: Fraction(3, 5), 2: Fraction(6, 5), 8: 2}
    assert mixing.expected_copies({3: 5}, Fraction(10), 2) == {3: 2} and mixing.expected_copies({}, Fraction(0), 2) == {}


def test_mixing_spreads_equal_rows(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET", 64)
    rows = [(1, "one two three", "a")] * 5000 + [(i, "four five", "a") for i in range(2, 500)]
    rows += [(9000, "six", "b")] * 3000 + [(None, None, None)] * 10
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    ask = lambda df: mixing.mix(df, carry=("doc_id", "source")).groupBy("source", "doc_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("mix.taken").alias("taken"), F.first("mix.target").alias("target"))
    got = {(r.source, r.doc_id): r for r in ask(docs).collect()}
    assert got["a", 1].n == 5000 and got["b", 9000].n == 3000 and got[None, None].taken == 0
    for s in "ab":
        own = [r for k, r in got.items() if k[0] == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 3
    again = {(r.source, r.doc_id): r for r in ask(docs.repartition(3)).collect()}
    assert again == got


# -- conversations

def brute_chats(rows):
    convs = {}
    for c, t, r, x in rows:
        if c is not None:
            convs.setdefault(c, []).append((t, r, x))
    last = lambda v: (v is None, v if v is not None else 0)
    text = lambda v: (v is None, v or "")
    turns = {c: [(r, x) for _, r, x in sorted(v, key=lambda v: (last(v[0]), text(v[1]), text(v[2])))] for c, v in convs.items()}
    out = {}
    for c, v in turns.items():
        longer = any(len(o) > len(v) and o[: len(v)] == v for o in turns.values())
        if not longer and not any(o == v and d < c for d, o in turns.items()):
            out[c] = "".join(f"<|im_start|>{r or ''}\n{x or ''}<|im_end|>\n" for r, x in v)
    return out


@pytest.mark.parametrize("block", [1024, 2])
def test_conversations(spark, monkeypatch, block):
    monkeypatch.setattr(chat, "BLOCK", block)
    rng = random.Random(4)
    rows = []
    for c in range(60):
        base = rng.randrange(8)
        for t in range(rng.randint(1, 9)):
            rows.append((c, 3 * t + base % 2, "user" if t % 2 == 0 else "bot", f"turn {t} of {base}"))
    rows += [(None, 0, "user", "x"), (70, None, None, None), (71, 0, None, ""), (72, 0, "user", None), (72, 0, "user", None),
             (73, 0, "user", ""), (74, 0, "user", "y" * 100_000), (75, 0, "user", "turn 0 of 0"), (75, 0, "user", "turn 0 of 0")]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id long, turn long, role string, text string, n int, place int")
    got = {r.conv_id: r.text for r in chat.collapse_and_render(df).collect()}
    assert got == brute_chats(rows)
    assert chat.collapse_and_render(empty(df)).count() == 0


# -- secrets

def der(tag, content):
    n = len(content)
    size = bytes([n]) if n < 128 else bytes([0x80 | (n.bit_length() + 7) // 8]) + n.to_bytes((n.bit_length() + 7) // 8, "big")
    return bytes([tag]) + size + content


def number(n):
    return der(2, n.to_bytes(n.bit_length() // 8 + 1, "big"))


RSA = der(0x30, b"".join([number(0), *(number((1 << b) + 12345) for b in (1023, 17, 1020, 511, 512, 509, 508, 500))]))
EC = der(0x30, number(1) + der(4, bytes(range(32))) + der(0xA0, der(6, b"\x2a\x86\x48\xce\x3d\x03\x01\x07")))
PKCS8 = der(0x30, number(0) + der(0x30, der(6, b"\x2a\x86\x48\x86\xf7\x0d\x01\x01\x01") + der(5, b"")) + der(4, RSA))


def field(b):
    return len(b).to_bytes(4, "big") + b


SSH = b"openssh-key-v1\0" + field(b"none") + field(b"none") + field(b"") + (1).to_bytes(4, "big") + field(b"p" * 51) + field(b"s" * 136)


def b64(data, url=False):
    return (base64.urlsafe_b64encode if url else base64.b64encode)(data).decode()


def test_structures_are_confirmed():
    jwt = b64(json.dumps({"alg": "HS256", "typ": "JWT"}).encode(), True).rstrip("=") + "." + b64(b'{"sub": "1"}', True).rstrip("=") + ".abc-_1"
    pem = "-----BEGIN RSA PRIVATE KEY-----\n" + "\n".join(re.findall(".{1,64}", b64(RSA))) + "\n-----END RSA PRIVATE KEY-----"
    for text, kind in ((jwt, "jwt"), (pem, "pem"), (b64(EC), "key"), (b64(PKCS8), "key"), (b64(SSH), "ssh"), (RSA.hex(), "key")):
        found = secret_scan.spans(f"é before {text} after")
        assert (9, 9 + len(text), kind) in found
        assert text not in secret_scan.redact(f"é before {text} after", found)
    for text in (b64(RSA[:-1]), b64(RSA + b"\0"), b64(bytes(range(200))), b64(SSH[:-3]), jwt.replace("eyJhbGci", "eyJhbGcj"), EC.hex()[:-2]):
        assert not secret_scan.structural_spans(text)


def test_structures_in_other_forms():
    def wrap(t, n=64):
        return "\n".join(re.findall(f".{{1,{n}}}", t))

    def token(header, payload):
        return ".".join(b64(x, True).rstrip("=") for x in (header, payload)) + ".abc-_1"

    large = der(0x30, number(0) + der(0x30, der(6, b"\x2a\x86\x48\x86\xf7\x0d\x01\x01\x01") + der(5, b"")) + der(4, bytes(90_000)))
    pem = "-----BEGIN PRIVATE KEY-----\n{}\n-----END PRIVATE KEY-----"
    framed = pem.format(wrap(b64(PKCS8)))
    cases = [
        (pem.format(wrap(b64(large))), "pem"), (framed, "pem"),
        (token(b' {"alg": "HS256"}', b'{"sub": "1"}'), "jwt"), (token(b'{\n"alg": "HS256"}', b"any bytes"), "jwt"),
        (wrap(b64(EC)), "key"), (wrap(b64(PKCS8)), "key"), (wrap(b64(SSH), 70), "ssh"),
        (b64(framed.encode()), "pem"), (wrap(b64(framed.encode()), 76), "pem"),
    ]
    for text, kind in cases:
        for before, after in (("é see ", " after"), ("-----BEGIN PRIVATE KEY-----?\n", "\nwords follow"), ("long-enough-prefix.", "\n")):
            found = secret_scan.structural_spans(before + text + after)
            want = (len(before), len(before) + len(text), kind)
            assert want in found, (kind, text[:40], before, found)
    assert not secret_scan.structural_spans(wrap(b64(RSA[:-1])) + "\n" + wrap(b64(bytes(range(200)))))


def test_keys_that_start_anywhere():
    def wrap(text, n, end="\n"):
        return end.join(re.findall(f".{{1,{n}}}", text))

    pem = "-----BEGIN RSA PRIVATE KEY-----\\n{}\\n-----END RSA PRIVATE KEY-----\\n"
    run = "Q" * 40
    for key, kind in ((RSA, "key"), (EC, "key"), (PKCS8, "key"), (SSH, "ssh")):
        text = b64(key)
        forms = [("path/", text), ("PRIVATE_KEY_", text), (run + "\n", wrap(text, 64)), (run + "\n", wrap(text, 20)),
                 ("x ", wrap(text, 16, "\r\n  ")), ('{"key": "', wrap(text, 64, "\\n")), ("k=", wrap(text, 30, "\\r\\n"))]
        for before, form in forms:
            for after in ("", "\nwords follow", " words", '"}'):
                whole = "é " + before + form + after
                found = secret_scan.structural_spans(whole)
                assert any(e == 2 + len(before) + len(form) and k == kind and s <= 2 + len(before) + 4 for s, e, k in found), (
                    kind, before, form[:30], after, found)
                left = secret_scan.redact(whole, secret_scan.spans(whole))
                assert form[-30:] not in left and form[:30] not in left and not secret_scan.structural_spans(left)
        assert not secret_scan.structural_spans("path/" + b64(key[:-4])) and not secret_scan.structural_spans("path/" + b64(key + b"abc"))
        if kind == "key":
            plain = key.hex()
            for form in (plain, "a" + plain, plain.upper(), ":".join(re.findall("..", plain)), wrap(plain, 32),
                         wrap(":".join(re.findall("..", plain)), 45, "\n    "), " ".join(re.findall("..", plain))):
                found = secret_scan.structural_spans("see " + form + "\nwords")
                start = 4 + form.lower().index("30")
                assert (start, 4 + len(form), "key") in found, (form[:40], found)
            assert not secret_scan.structural_spans(":".join(re.findall("..", plain[:-2])) + "\nno")
    json_pem = pem.format(wrap(b64(RSA), 64, "\\n"))
    assert [k for *_, k in secret_scan.structural_spans('{"private_key": "' + json_pem + '"}')] == ["pem"]


def test_long_texts_full_of_starts_are_scanned():
    """Starts that claim what is not there, many of them, and one key at the end."""
    text = "MIIE" * 20_000 + " " + "MHcCAQEEIA" * 5_000 + " 30820102020100" * 3_000 + " x/" + b64(EC)
    assert secret_scan.structural_spans(text)[-1] == (len(text) - len(b64(EC)), len(text), "key")


def plain_base(text):
    """The three patterns without a look at what comes before."""
    found = [(m.start(), m.end(), "assign") for m in re.finditer(
        r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text, re.I | re.A) if len(m[2]) >= 6]
    found += [(m.start(), m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def test_base_spans_of_a_whole_table_are_those_of_the_patterns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    drawn = "concat(text, ' api_key=', md5(text), '; AKIA', upper(md5(text)), ' ', reverse(text), 'Secret:', left(text, 9))"
    docs = docs.withColumn("text", F.expr(f"case when doc_id % 5 = 0 then text else {drawn} end"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    some = 0
    for r in secret_scan.find_secrets(docs).collect():
        base = sorted((s.start, s.end, s.kind) for s in r.spans if s.kind in ("assign", "access", "hex"))
        assert base == plain_base(texts[r.doc_id] or "")
        some += len(base)
    assert some and len(texts) == docs.count()


def test_base_spans_drop_what_fails():
    cases = {
        "password: token = abcdefgh": [],  # the first match takes the second word with it
        "API_KEY='abcdef' apikey=abcde": [(0, 15, "assign")],
        "AKIA" + "A" * 15 + " AKIA" + "B" * 16: [(20, 40, "access")],
        "x" + "0af" * 8 + "g " + "a" * 23: [(1, 25, "hex")],
        "ſecret=abcdefg toKen=abcdefg": [(15, 28, "assign")],
        "Secret = \"a.b/c+d=\"": [(0, 18, "assign")],
    }
    for text, want in cases.items():
        assert secret_scan.base_spans(text) == want, text


def test_secret_scan_on_awkward_rows(spark, awkward):
    got = secret_scan.find_secrets(awkward)
    assert got.count() == awkward.count()
    assert [len(r.spans) for r in got.filter("doc_id in (2, 3, 4, 9)").orderBy("doc_id").collect()] == [0, 0, 0, 1]
    assert secret_scan.find_secrets(empty(awkward)).count() == 0
    clean = secret_scan.without_secrets(awkward)
    assert clean.columns == awkward.columns and clean.filter("text like '%[SECRET]%'").count() == 1


# -- pipeline

def test_pipeline(spark, tmp_path):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(100_000, None, None, None, None), (100_001, "", "en", None, 0), (None, "a b", "en", "s", 3)], docs.schema)
    docs.unionByName(extra).unionByName(docs.limit(3)).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    folder, kept = str(tmp_path), spark.read.parquet(str(tmp_path / "documents.parquet"))
    sizes = [kept.count()]
    for i, (_, stage) in enumerate(pipeline.STAGES[:-1]):
        stage(spark, kept, folder).write.parquet(str(tmp_path / f"stage{i}"))
        kept = spark.read.parquet(str(tmp_path / f"stage{i}"))
        assert sorted(kept.columns) == sorted(pipeline.COLUMNS)
        sizes.append(kept.count())
        if i == 1:
            left = [(r.doc_id, r.text) for r in kept.filter("doc_id is not null").collect()]
            assert len({i for i, _ in left}) == len(left)
            own = brute_components(left, pipeline.PERCENT)
            assert all(c == i for i, (n, c) in own.items() if n)
        if i == 2:
            assert all(not secret_scan.spans(r.text) for r in kept.collect())
    assert sizes[0] > sizes[1] > sizes[2] == sizes[3]
    packed = pipeline.run(spark, folder).collect()
    assert sum(r.start == 0 for r in packed) == sizes[4]
    nothing = tmp_path / "none"
    empty(docs).write.parquet(str(nothing / "documents.parquet"))
    empty(spark.read.parquet(f"{SF}/labels.parquet")).write.parquet(str(nothing / "labels.parquet"))
    assert pipeline.run(spark, str(nothing)).count() == 0


@pytest.mark.parametrize("name", [*queries.QUERIES])
def test_query_against_its_sql(spark, name):
    sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))
    import check

    result, _, rows = check.compare(spark, check.connect(SF), SF, name, queries.QUERIES[name], queries.SQL.get(name))
    assert (result == "ok" or result.startswith("rows only")) and rows > 0
