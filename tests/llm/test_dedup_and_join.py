import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from batchgate.llm import ngram_join
from batchgate.llm.common import connected, word_hashes
from batchgate.llm.exact_dedup import drop_copies, mark_copies
from batchgate.llm.signature_tree import Components, link, signature


def spaced(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def expected_copies(rows):
    groups = {}
    for i, text in rows:
        groups.setdefault(spaced(text), []).append(i)
    return {t: (min((i for i in g if i is not None), default=None), len(g)) for t, g in groups.items()}


@pytest.mark.parametrize("key", [F.md5, lambda t: F.md5(F.substring(t, 1, 1))], ids=["md5", "colliding"])
def test_copies(odd, key):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    want = expected_copies(rows)
    got = mark_copies(odd, content_key=key).collect()
    by_sha = {}
    for r in got:
        by_sha.setdefault(r["text_sha256"], []).append(r)
    assert len(got) == len(rows) and len(by_sha) == len(want)
    assert all(sum(r["kept"] for r in g) == 1 for g in by_sha.values())
    assert sorted((str(g[0]["keep_id"]), g[0]["group_size"]) for g in by_sha.values()) == sorted(
        (str(k), n) for k, n in want.values()
    )


def test_drop_copies(odd, nothing):
    kept = drop_copies(odd)
    assert kept.columns == odd.columns
    assert kept.count() == len(expected_copies([(r["doc_id"], r["text"]) for r in odd.collect()]))
    assert drop_copies(nothing).count() == 0 and mark_copies(nothing).count() == 0


def test_word_hashes_do_not_depend_on_place():
    texts = [b"one two  three", b"", b" two\tONE ", b"x" * 5000 + b" two"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    bounds = np.cumsum([0, *map(len, texts)])
    whole, at = word_hashes(data, bounds)
    words = [w for t in texts for w in t.lower().split()]
    assert at.tolist() == [0, 3, 3, 5, 7]
    assert len(set(whole.tolist())) == len(set(words))
    assert [words.index(w) for w in words] == [whole.tolist().index(h) for h in whole.tolist()]
    parts, again = word_hashes(data, bounds, step=16)
    assert (parts == whole).all() and (again == at).all()


def test_connected(spark):
    rnd = random.Random(3)
    edges = [(rnd.randrange(400), rnd.randrange(400)) for _ in range(220)] + [(i, i + 1) for i in range(500, 560)]
    known = Components(np.arange(600))
    for a, b in edges:
        known.union(a, b)
    want = {n: known.find(n) for e in edges if e[0] != e[1] for n in e}
    got = connected(spark.createDataFrame(edges, "a long, b long")).df.collect()
    assert {r["node"]: r["root"] for r in got} == want
    assert connected(spark.createDataFrame([], "a long, b long")).df.count() == 0


def test_signature_tree_finds_all_links():
    rng = np.random.default_rng(5)
    base = [np.unique(rng.integers(0, 1 << 62, n, np.uint64)) for n in (5, 60, 60, 700)]
    sets = []
    for b in base:
        for _ in range(60):
            keep = b[rng.random(len(b)) > rng.choice([0, 0.02, 0.1])]
            sets.append(np.unique(np.r_[keep, rng.integers(0, 1 << 62, rng.integers(0, 4), np.uint64)]))
    sizes = np.array([len(s) for s in sets])
    every = np.flatnonzero(sizes)

    def linked(p, q):
        both = len(np.intersect1d(sets[p], sets[q], assume_unique=True))
        return 10 * both >= 9 * (sizes[p] + sizes[q] - both)

    got, want = Components(np.arange(len(sets))), Components(np.arange(len(sets)))
    link([signature(s) for s in sets], sizes, every, every, 9, 10, got, linked)
    for p, q in itertools.combinations(every.tolist(), 2):
        if linked(p, q):
            want.union(p, q)
    assert [got.find(i) == got.find(j) for i, j in itertools.combinations(range(len(sets)), 2)] == [
        want.find(i) == want.find(j) for i, j in itertools.combinations(range(len(sets)), 2)
    ]


def brute(rows, size, part, whole):
    sets = {}
    for i, text in rows:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "")) if x]
        w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in w]
        sets[i] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} or ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and whole * both >= part * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("size, part, whole", [(3, 90, 100), (5, 4, 5), (1, 1, 2)])
def test_join_equals_brute_force(spark, size, part, whole, monkeypatch):
    # Small limits, so that large groups, chunks, hubs and the second round all occur.
    monkeypatch.setattr(ngram_join, "LARGE_GROUP", 12)
    monkeypatch.setattr(ngram_join, "CHUNK", 8)
    monkeypatch.setattr(ngram_join, "HUBS", 2)
    rnd = random.Random(size)
    vocabulary = [f"w{i}" for i in range(300)]
    rows, bases = [], [[rnd.choice(vocabulary) for _ in range(n)] for n in (4, 12, 60, 60, 150)]
    for i in range(160):
        words = list(rnd.choice(bases))
        for _ in range(rnd.choice([0, 0, 1, 2, 3, 6])):
            words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
        rows.append((i, " ".join(words)))
    rows += [(500 + i, t) for i, t in enumerate([None, "", " ", "one", "One", "one two", "one two"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = ngram_join.components(docs, size, part, whole).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute(rows, size, part, whole)
    kept = ngram_join.drop_near_copies(docs, size, part, whole).collect()
    want = {i for i, (n, c) in brute(rows, size, part, whole).items() if i == c}
    assert {r["doc_id"] for r in kept} == want and len(kept) == len(want)


def test_join_odd(odd, nothing):
    got = ngram_join.components(odd, 3, 90, 100).collect()
    assert len(got) == odd.count()
    named = {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None}
    assert named[4] == named[5] == named[6] == named[7] == 4 and named[0] == 0 and named[1] == 1
    kept = ngram_join.drop_near_copies(odd, 3, 90, 100)
    assert kept.columns == odd.columns
    # Without words all stay: ids 0, 1, 2 and the null row.
    assert sum(r["doc_id"] in (0, 1, 2) or r["text"] is None for r in kept.collect()) == 4
    assert ngram_join.components(nothing, 3, 90, 100).count() == 0


@pytest.mark.parametrize("part, whole", [(9, 10), (4, 5), (1, 2)])
def test_sketches_bound_the_difference_and_are_short(part, whole):
    rng = np.random.default_rng(part)
    known, few = ngram_join._possible(part, whole), 0
    for n in (1, 5, 40, 300, 2_000):
        base = rng.integers(0, 1 << 63, 2 * n, np.uint64)
        pairs = [(np.unique(base[:n]), np.unique(base[k : n + k])) for k in range(0, n, max(n // 40, 1))]
        for a, b in pairs:
            rows = [{"key": 0, "row": i, "n": len(s), "sketch": ngram_join.sketch(s, part, whole)} for i, s in ((1, a), (2, b))]
            found = next(known(iter([pa.RecordBatch.from_pylist(rows)]))).num_rows
            both = len(np.intersect1d(a, b))
            linked = whole * both >= part * (len(a) + len(b) - both)
            assert found or not linked
            few += not found
            # Signatures, which were moved before, took 2 to 4 bits a token.
            assert len(rows[0]["sketch"]) <= max(8, len(signature(a)) / 2) or part == 1
    assert few


def test_a_task_brings_the_shingles_of_copies_once(spark):
    words = [" ".join(f"w{i}x{k}" for k in range(50)) for i in range(3)]
    docs = spark.createDataFrame([(i, words[i % 3]) for i in range(60)], "id long, text string").coalesce(1)
    rows = ngram_join._described(docs.selectExpr("id", "text", "0L AS row"), 3, 90, 100).collect()
    assert len(rows) == 60 and len({r["node"] for r in rows}) == 3
    assert sum(len(r["rarest"]) > 0 for r in rows) == 3


def test_groups_are_cut_where_sizes_are_too_far_apart_and_whole_over_batches():
    key = np.repeat([3, 7, 9], [6, 1, 400])
    n = np.r_[100, 100, 105, 200, 205, 205, 50, np.full(400, 80)]
    node = np.r_[11, 11, 12, 13, 14, 15, 16, 1_000 + np.arange(400) // 2]
    batch = pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in (key, n, node)], names=["key", "n", "node"])
    for step in (1, 5, 64, 1_000):
        pieces = [batch.slice(at, step) for at in range(0, len(batch), step)]
        rows = [r for b in ngram_join._meeting(9, 10)(iter(pieces)) for r in b.to_pylist()]
        assert sorted(r["nodes"] for r in rows if r["a"] is None) == [[11, 12], [13, 14, 15]]
        assert {(r["a"], *r["nodes"]) for r in rows if r["a"] is not None} == {(1_000, 1_000 + i) for i in range(200)}
