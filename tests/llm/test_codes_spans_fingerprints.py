"""Vector codes, spans of two tokenizers, and fingerprints against plain versions."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
import xxhash

from batchgate.llm import hadamard_codes, simhash, span_alignment
from batchgate.llm.hadamard_codes import hadamard, nearest, sequency
from batchgate.llm.queries import tokenizer_file

from .conftest import SF

SPACE = r"[\x20\x09-\x0D]+"


# --- vector codes ---------------------------------------------------------------


def test_transform():
    for n in (1, 2, 4, 8, 16):
        h = hadamard(np.eye(n, dtype=np.int64))
        assert (h.T @ h == n * np.eye(n)).all()
        assert [(np.diff(c) != 0).sum() for c in h.T] == list(range(n))
        assert sorted(sequency(n)) == list(range(n))


@pytest.mark.parametrize("width", [1, 3, 4, 7])
@pytest.mark.parametrize("kind", [np.int64, object])
def test_nearest_is_exact(width, kind):
    rng = np.random.default_rng(width)
    x, e = rng.integers(-9, 9, (700, width)).astype(kind), rng.integers(-9, 9, (30, width)).astype(kind)
    d = ((x[:, None] - e[None]) ** 2).sum(2)
    index, distance = nearest(x, e)
    assert (index == d.argmin(1)).all() and (distance == d.min(1)).all()


def plain_codes(rows, parts=16, entries=64, rounds=2):
    """rows: (id, vector, label)."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    width = parts * -(-max((len(r[1]) for r in kept), default=0) // parts)
    ints = [[math.floor(Fraction(x) * 256) for x in r[1]] + [0] * (width - len(r[1])) for r in kept]
    step = width // parts
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0], kept[i][1]))[:entries]
    books = [[ints[i][p * step : (p + 1) * step] for i in order] for p in range(parts)]

    def assign(v):
        found = []
        for p, book in enumerate(books):
            own = v[p * step : (p + 1) * step]
            found.append(min((sum((a - b) ** 2 for a, b in zip(own, e)), k) for k, e in enumerate(book)))
        return found

    for _ in range(rounds):
        members = {}
        for v in ints:
            for p, (_, k) in enumerate(assign(v)):
                members.setdefault((p, k), []).append(v[p * step : (p + 1) * step])
        for (p, k), some in members.items():
            books[p][k] = [sum(c) // len(some) for c in zip(*some)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    coded = [("".join(f"{k:02x}" for _, k in a), sum(d for d, _ in a)) for a in map(assign, ints)]
    labels = Counter()
    for r, (_, error) in zip(kept, coded):
        labels[r[2]] += error
    return sorted(
        ((r[0], c, e, labels[r[2]], digest) for r, (c, e) in zip(kept, coded)),
        key=lambda r: (r[0] is None, r),
    )


def got_codes(frame, **options):
    columns = "vec_id", "code", "error", "label_error", "codebooks_sha256"
    rows = [tuple(r[c] for c in columns) for r in hadamard_codes.encode(frame, **options).collect()]
    return sorted(rows, key=lambda r: (r[0] is None, r))


VECTORS = "vec_id long, embedding array<double>, label int, code string, error int, total int, own int"


def test_codes_equal_plain(spark):
    rnd = random.Random(4)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(20)], rnd.choice([0, 1, None])) for i in range(150)]
    # Repeats, ties, other lengths, and rows that are dropped.
    rows += [(7, rows[3][1], 1), (7, rows[7][1], 1), (None, rows[5][1], None), (200, [0.5] * 20, 0)]
    rows += [(201, [], 2), (202, [1.0] * 33, 2), (203, None, 2), (204, [1.0, None], 2)]
    rows += [(205, [math.nan], 2), (206, [math.inf] * 20, 2), (207, [-math.inf] * 20, 2)]
    frame = spark.createDataFrame([(*r, "c", 1, 2, 3) for r in rows], VECTORS).repartition(5)
    assert got_codes(frame) == plain_codes(rows)
    assert got_codes(frame, parts=3, entries=5, rounds=1) == plain_codes(rows, 3, 5, 1)
    assert got_codes(frame.where("false")) == []
    assert got_codes(frame.where("vec_id = 201")) == plain_codes([rows[-7]])


def test_codes_of_huge_components(spark):
    """Beyond 64 bits arithmetic stays exact; an error that no long holds is null."""
    rnd = random.Random(5)
    rows = [(i, [rnd.uniform(-1, 1) * 10.0 ** rnd.choice([0, 6, 30, 300]) for _ in range(8)], i % 2) for i in range(40)]
    want = plain_codes(rows, 4, 6, 2)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    got = got_codes(frame, parts=4, entries=6)
    fits = lambda x: x if x < 1 << 63 else None
    assert got == [(i, c, fits(e), fits(s), h) for i, c, e, s, h in want]
    assert any(r[2] is None for r in got)


# --- spans ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def paths():
    return tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")


def plain_spans(texts, paths):
    """Whole texts at once, byte ends from the decoded tokens alone."""
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(paths[0]), sentencepiece.SentencePieceProcessor(model_file=paths[1])
    a.encode_special_tokens = True
    byte_of = span_alignment.byte_level()

    def piece(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    found = []
    for text in texts:
        raw = (" " + (text or "")).encode()
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        bytes_a = [bytes(byte_of[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [piece(i) for i in ids_b]
        if b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
            found.append(([], [], [], []))
            continue
        ends_a = list(itertools.accumulate(map(len, bytes_a)))
        ends_b = list(itertools.accumulate(map(len, bytes_b)))
        links = [(ids_a[i], ids_b[j]) for j, e in enumerate(ends_b) for i in [ends_a.index(e) if e in ends_a else -1] if i >= 0]
        groups, x, y = [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            p, q = ends_a.index(end) + 1, ends_b.index(end) + 1
            groups.append(",".join(map(str, ids_a[x:p])) + "|" + ",".join(map(str, ids_b[y:q])))
            x, y = p, q
        found.append((ids_a, ids_b, links, groups))
    counts = Counter(link for f in found for link in f[2])
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(best.get(y, 0), n)
    return [
        (
            len(ids_a), len(ids_b), len(groups), len(links),
            sum(counts[k] == best[k[1]] for k in links), sum(counts[k] for k in links),
            hashlib.sha256(";".join(groups).encode()).hexdigest() if ids_a else "",
        )
        for ids_a, ids_b, links, groups in found
    ]


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
TRICKY = [
    "it's we'll", "a  b", " lead", "trail ", "trail\n ", "x  y", "x\n  y", "a   b", "日本語 テキスト",
    "a 日本 b", "\U0001F600\U0001F601 \U0001F600", "ﬁ é é", "▁", "a▁b", "a \u0000 b", "<|endoftext|> <s> <0x41>",
    "\t\n word", "tab\tword", "1234 5678", "...!!! ???", "x" * 300, "日" * 100, " ", "\n", "a \x1f b", "a \x85 b", "﻿a",
]


def random_texts(n, seed):
    rnd = random.Random(seed)
    alphabet = "ab cdE  \n\t'.,1 é日  \U0001F600▁\x00́ſ" + " " * 4
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("frequent", [1 << 20, 40, 0])
def test_spans_equal_plain(spark, paths, odd, frequent):
    texts = [r["text"] for r in odd.collect()] + TRICKY + random_texts(300, 1)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in span_alignment.align(docs, *paths, frequent).collect()}
    want = plain_spans(texts, paths)
    assert {i: got[i] for i in got} == dict(enumerate(want))


def test_units_are_independent(paths):
    """Units put together give what whole texts give, on many strings and documents."""
    texts = [t for t in random_texts(4000, 2) if t]
    own = span_alignment.Aligner(*paths, remembered=500)
    counts, links, digests = [], [], []
    for at in range(0, len(texts), 250):
        c, k, d = own.align([t.encode() for t in texts[at : at + 250]])
        counts += c.tolist()
        links += k.tolist()
        digests += d
    want = plain_spans(texts, paths)
    assert [tuple(c) for c in counts] == [w[:3] for w in want] and digests == [w[6] for w in want]
    assert len(links) == sum(w[3] for w in want)


def test_spans_of_documents(spark, paths, documents):
    rows = documents.collect()
    want = dict(zip([r["doc_id"] for r in rows], plain_spans([r["text"] for r in rows], paths)))
    got = span_alignment.align(documents, *paths).collect()
    assert {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in got} == want


def test_spans_odd(paths, odd, nothing):
    got = span_alignment.align(odd, *paths).collect()
    assert len(got) == odd.count()
    by_id = {r["doc_id"]: r for r in got}
    assert tuple(by_id[0][c] for c in COLUMNS) == (0, 0, 0, 0, 0, 0, "") == tuple(by_id[1][c] for c in COLUMNS)
    assert by_id[10]["n_a"] == 0  # holds U+2581
    assert span_alignment.align(nothing, *paths).count() == 0


# --- fingerprints ---------------------------------------------------------------


def plain_fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = [x for x in re.split(SPACE, lowered) if x]
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_links(fps, radius=2):
    return {(a, b) for a, b in itertools.combinations(sorted(fps), 2) if (a ^ b).bit_count() <= radius}


def plain_components(rows):
    """rows: (id, fingerprint)."""
    root = {f: f for _, f in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in plain_links(root):
        root[find(a)] = find(b)
    least = {}
    for i, f in rows:
        if i is not None:
            least[find(f)] = min(least.get(find(f), i), i)
    return [(i, f"{f:016x}", least.get(find(f))) for i, f in rows]


@pytest.mark.parametrize("step", [1 << 20, 64, 8])
def test_fingerprint(step):
    rnd = random.Random(step)
    texts = ["", " ", "One", "one  TWO", "a b c", "É à b c d", "x" * 200, "a\x00b c d e f g"]
    texts += [" ".join(rnd.choice("ab cd efg H  i".split(" ")) for _ in range(rnd.randrange(300))) for _ in range(30)]
    for t in texts:
        assert simhash.fingerprint(t.encode(), step=step) == plain_fingerprint(t)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def crowd(rnd, n):
    """Fingerprints of which a third share most bits, with many pairs at distances 0 to 4."""
    base = rnd.getrandbits(64)
    fps = {rnd.getrandbits(64) for _ in range(n // 3)}
    while len(fps) < n:
        f = rnd.choice([base, rnd.choice(sorted(fps)[:40])])
        low = rnd.random() < 0.7
        for _ in range(rnd.randrange(7)):
            f ^= 1 << rnd.randrange(12 if low else 64)
        fps.add(f)
    return sorted(fps)


@pytest.mark.parametrize("listed", [simhash.LISTED, 3, 0])
@pytest.mark.parametrize("radius, parts", [(2, 3), (2, 2), (1, 2), (3, 4)])
def test_all_links_are_found(spark, monkeypatch, listed, radius, parts):
    monkeypatch.setattr(simhash, "_parts_for", lambda n, radius: parts)
    fps = crowd(random.Random(parts), 500)
    frame = spark.createDataFrame([(signed(f),) for f in fps], "fp long").repartition(3)
    got = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in simhash.links(frame, len(fps), radius, listed).collect()]
    assert len(got) == len(set(got))
    assert {tuple(sorted(p)) for p in got} == plain_links(fps, radius)


def test_thresholds_follow_the_counts():
    parts = [list(range(0, 22)), list(range(22, 43)), list(range(43, 64))]
    plan = simhash.Plan(parts, [np.array([5], np.uint64), *[np.zeros(0, np.uint64)] * 2], [np.array([900]), *[np.zeros(0, np.int64)] * 2], [1.0] * 3, 2080)
    taken = plan.allocate(np.array([5, 6], np.uint64))
    assert taken[1].tolist() == [0, 0, 0]
    assert taken[0, 0] == -1 and sorted(taken[0, 1:].tolist()) == [0, 1]
    crowded = simhash.Plan(parts, [np.array([0], np.uint64)] * 3, [np.array([10**6])] * 3, [1.0] * 3, 2080)
    assert (crowded.allocate(np.array([0], np.uint64)) == -2).all()


def test_correlated_bits_are_grouped():
    rng = np.random.default_rng(1)
    bits = rng.random((4000, 64)) < 0.5
    bits[:, 40:60] = bits[:, :20]
    groups = simhash.correlated_parts(bits.T.astype(np.int64) @ bits, len(bits), 3)
    assert sorted(b for g in groups for b in g) == list(range(64)) and {len(g) for g in groups} == {21, 22}
    where = {b: k for k, g in enumerate(groups) for b in g}
    assert sum(where[b] == where[b + 40] for b in range(20)) >= 18


def test_components_equal_plain(spark, odd, nothing):
    rnd = random.Random(9)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for base in ([rnd.choice(words) for _ in range(n)] for n in (3, 400, 800, 800)):
        for _ in range(60):
            own = list(base)
            for _ in range(rnd.choice([0, 0, 1, 2])):
                own[rnd.randrange(len(own))] = rnd.choice(words)
            rows.append(" ".join(own))
    rows = list(enumerate(rows)) + [(900 + i, t) for i, t in enumerate([None, "", " ", "one", "ONE"])] + [(None, "one"), (None, "alone here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = [(r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.components(docs).collect()]
    want = plain_components([(i, plain_fingerprint(t)) for i, t in rows])
    order = lambda r: (r[0] is None, r[0], r[1])
    assert sorted(got, key=order) == sorted(want, key=order)
    assert len({r[2] for r in got}) < len({r[1] for r in got})
    odd_rows = [(r["doc_id"], plain_fingerprint(r["text"])) for r in odd.collect()]
    got = [(r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.components(odd).collect()]
    assert sorted(got, key=order) == sorted(plain_components(odd_rows), key=order)
    assert simhash.components(nothing).count() == 0


def test_components_of_documents(spark, documents):
    rows = [(r["doc_id"], plain_fingerprint(r["text"])) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = [(r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.components(documents).collect()]
    assert sorted(got) == sorted(plain_components(rows))
