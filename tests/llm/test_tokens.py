import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from batchgate.llm import packing, prefix_table, token_store
from batchgate.llm.perfect_hash import PerfectHash, fingerprints
from batchgate.llm.word_bpe import WordEncoder

from .conftest import ODD_TEXTS

TRICKY = ["ΑΣ ΑΣΑ", "x<|endoftext|>y A<|ENDOFTEXT|>", "a,́ b", "\x1c a\x85b\xa0c", "don't 're. x's.", "1., 1, ,"]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def reference(path, texts):
    encode = Tokenizer.from_file(path).encode
    return [[*encode(t or "", add_special_tokens=False).ids, 1] for t in texts]


@pytest.mark.parametrize("remembered", [3, 1000])
def test_encoder_equals_library(word_bpe, documents, remembered):
    texts = [t or "" for t in ODD_TEXTS] + TRICKY + [r["text"] for r in documents.limit(40).collect()]
    own = WordEncoder(word_bpe, remembered)
    for at in range(0, len(texts), 5):
        ids, bounds = own.encode([t.encode() for t in texts[at : at + 5]])
        got = [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)]
        assert got == reference(word_bpe, texts[at : at + 5])


# Capitals that only their lower case composes with the mark.
COMPOSED_LOWER = ["J\u030c", "H\u0331", "T\u0308", "W\u030a", "Y\u030a"]


def test_decomposed_capitals_equal_library(word_bpe):
    texts = [*COMPOSED_LOWER, " ".join(COMPOSED_LOWER), "THE J\u030cAR, J\u030c. The \u030c x", "j\u030c J\u030c"]
    ids, bounds = WordEncoder(word_bpe).encode([t.encode() for t in texts])
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)] == reference(word_bpe, texts)


def test_perfect_hash():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 20_000, np.uint64))
    mph = PerfectHash.build(keys)
    assert sorted(mph.slots(keys).tolist()) == list(range(len(keys)))
    other = keys + np.uint64(1)
    slot, marks = mph.slots(other), np.empty(len(keys), "<u4")
    marks[mph.slots(keys)] = fingerprints(keys)
    assert (marks[slot[slot >= 0]] == fingerprints(other[slot >= 0])).sum() <= 2
    assert PerfectHash.build(keys[:0]).slots(keys[:3]).tolist() == [-1, -1, -1]


def test_store_round_trip(spark, word_bpe, documents, odd, nothing):
    rows = sorted((r["doc_id"], r["text"]) for r in documents.collect())
    store = token_store.write_store(documents, word_bpe)
    got = sorted(tuple(r) for r in token_store.read_store(spark, store).collect())
    start, want = 0, []
    for (key, _), ids in zip(rows, reference(word_bpe, [t for _, t in rows]), strict=True):
        want.append((key, start, len(ids), crc(ids), 0))
        start += len(ids)
    assert got == want
    wanted = spark.createDataFrame([(3,), (150,), (None,), (10**9,)], "doc_id long")
    found = {r["doc_id"]: r["ids"] for r in token_store.lookup(store, wanted).collect()}
    texts = dict(rows)
    assert found == {k: reference(word_bpe, [texts[k]])[0] for k in (3, 150)}
    strange = token_store.read_store(spark, token_store.write_store(odd, word_bpe)).collect()
    assert len(strange) == odd.count() and sum(r["_key"] is None for r in strange) == 2
    assert token_store.write_store(nothing, word_bpe).rows == 0


def best_fit(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fit = min((r for r in rooms if r >= n), default=None)
        if fit is None:
            rooms.append(capacity - n)
        else:
            rooms[rooms.index(fit)] -= n
    return len(rooms)


@pytest.mark.parametrize("seed", range(20))
def test_plan_is_best_fit(seed):
    rnd = random.Random(seed)
    capacity = rnd.choice([7, 16, 64])
    lengths = [rnd.randint(1, capacity) for _ in range(rnd.randint(0, 200))] + [rnd.randint(1, 3)] * 40
    p = packing.plan(Counter(lengths), capacity)
    slots = set()
    for i in range(len(p["length"])):
        n, last = p["length"][i], i + 1 == len(p["length"]) or p["length"][i + 1] != p["length"][i]
        count = (Counter(lengths)[n] if last else p["rank"][i + 1]) - p["rank"][i]
        for j in range(count):
            slots.add((p["sequence"][i] + j // p["each"][i], p["offset"][i] + j % p["each"][i] * n, n))
    ends = {}
    for sequence, offset, n in sorted(slots):
        assert ends.get(sequence, 0) == offset
        ends[sequence] = offset + n
    assert len(slots) == len(lengths) and max(ends.values()) <= capacity
    assert len(ends) == best_fit(lengths, capacity)


@pytest.mark.parametrize("capacity", [16, 4096])
def test_pack(odd, nothing, word_bpe, capacity):
    got = packing.pack(odd, word_bpe, capacity).collect()
    texts = [r["text"] for r in odd.collect()]
    pieces = [x[k : k + capacity] for x in reference(word_bpe, texts) for k in range(0, len(x), capacity)]
    assert Counter((r["length"], r["ids_crc32"]) for r in got) == Counter((len(x), crc(x)) for x in pieces)
    sequences = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert sequences.get(r["sequence_id"], 0) == r["offset"]
        sequences[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(sequences.values()) <= capacity
    assert len(sequences) == best_fit([len(x) for x in pieces], capacity)
    assert packing.pack(nothing, word_bpe).count() == 0


def test_prefix_table_equals_library(piece_bpe):
    own, library = prefix_table.PrefixEncoder(piece_bpe, 50), sentencepiece.SentencePieceProcessor(model_file=piece_bpe)
    rnd = random.Random(2)
    texts = [t or "" for t in ODD_TEXTS] + TRICKY
    texts += ["".join(rnd.choice("ab \n▁tho ine\x00é한") for _ in range(rnd.randint(0, 60))) for _ in range(400)]
    for t in texts:
        ids, said = own.encode(t.encode())
        assert ids == library.encode(t, add_eos=True), t
        assert said.decode() == " ".join(map(str, ids))


@pytest.mark.parametrize("places", [5, 21])
def test_runs_of_segments_equal_library(piece_bpe, monkeypatch, places):
    """Segments of a run are taken together; with 2^5 places pairs are forgotten all the time."""
    monkeypatch.setattr(prefix_table, "PLACES", places)
    monkeypatch.setattr(prefix_table, "TOGETHER", 40)
    own, library = prefix_table.PrefixEncoder(piece_bpe, 50), sentencepiece.SentencePieceProcessor(model_file=piece_bpe)
    rnd = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz'-.,\n  ▁éßñžия中한🙂\x00\tTHE09"
    texts = ["".join(rnd.choices(letters, k=rnd.choice([0, 1, 5, 30, 90]))) for _ in range(500)]
    texts += [t or "" for t in ODD_TEXTS] + TRICKY + ["internationalization " * 3, " ", "\n", "▁", "x" * 64, "y" * 65]
    rnd.shuffle(texts)
    for at in range(0, len(texts), 60):
        run = texts[at : at + 60]
        ids, ends, said, said_ends = own.encode_run([t.encode() for t in run])
        want = [library.encode(t) for t in run]
        assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False)] == want
        got = [bytes(said[a:b]).decode() for a, b in zip(said_ends, said_ends[1:], strict=False)]
        assert got == ["".join(f"{i} " for i in ids) for ids in want]
        assert max(map(len, own.words), default=0) <= prefix_table.LONGEST and len(own.words) <= 50


def test_only_long_segments_are_taken_singly(piece_bpe, monkeypatch):
    own, singly = prefix_table.PrefixEncoder(piece_bpe), []
    tokens = own.tokens
    monkeypatch.setattr(own, "tokens", lambda segment: singly.append(segment) or tokens(segment))
    own.encode(("some Words of\na text, né. 한\t" * 3 + "a\x00b " + "z" * 100).encode())
    assert singly == ["▁" + "z" * 100]


def test_round_trip(odd, nothing, piece_bpe):
    library = sentencepiece.SentencePieceProcessor(model_file=piece_bpe)

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    want = Counter()
    for r in odd.collect():
        ids = library.encode(r["text"] or "", add_eos=True)
        want[(r["doc_id"], len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids)))] += 1
    assert Counter(tuple(r) for r in prefix_table.round_trip(odd, piece_bpe).collect()) == want
    assert prefix_table.round_trip(nothing, piece_bpe).count() == 0


PARTS = [
    "a", "B", "é", "É", "ß", "÷", "×", "7", "½", "J̌", "T̈", "ẖ", "̸", "́", "'", "'s",
    "'ll", "<|endoftext|>", "<|", "|>", " ", " ", "　", "\x00", "\x1c", "\x0b", "\x85", "İ", "K",
    "ǆ", "🙂", "中文", "ﬁ", "=", "<", ">", ",", ".", "!", "--", "...", "~", " ", " ", "  ", "\n", "\t", "x" * 70,
    "the", "Heit", "ª", "µ", "ÿ", "Ÿ", "Þ", "€",
]


def test_random_strings_have_the_ids_of_the_library(word_bpe):
    encoder = WordEncoder(word_bpe, remembered=3_000)
    draw = random.Random(11)
    for _ in range(20):
        texts = ["".join(draw.choices(PARTS, k=draw.randrange(15))) for _ in range(1_000)]
        ids, bounds = encoder.encode([t.encode() for t in texts])
        expected = encoder.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        for k, e in enumerate(expected):
            assert ids[bounds[k] : bounds[k + 1]].tolist() == [*e.ids, 1], texts[k]


def test_runs_take_only_their_texts(word_bpe, monkeypatch):
    """A large batch is encoded run by run, and each run's memory is given back."""
    import pyarrow as pa
    from batchgate.llm import word_bpe as module

    texts = [None, "", "a b", "x" * 50, None, "some words of a text", "é" * 30, "", None]
    given = []
    monkeypatch.setattr(module, "give_back", lambda: given.append(1))
    for column in (pa.array(texts), pa.array(texts, pa.large_string()), pa.array(["skip", *texts]).slice(1)):
        whole = next(iter(module.encoded(column, word_bpe)))
        for most in (1, 10, 40, 1 << 20):
            given.clear()
            runs = list(module.encoded(column, word_bpe, most))
            assert [r[0] for r in runs] == [0, *[r[1] for r in runs[:-1]]] and runs[-1][1] == len(texts)
            assert [i for r in runs for i in r[2].tolist()] == whole[2].tolist()
            assert len(given) == len(runs)
            assert all(sum(len((t or "").encode()) for t in texts[r[0] : r[1] - 1]) < most for r in runs)
    assert list(module.encoded(pa.array([], pa.string()), word_bpe)) == []
