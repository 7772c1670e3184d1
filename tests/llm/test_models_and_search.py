import gzip
import io
import math
import zipfile
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from batchgate.llm import hnsw, language_mixture, lm_scoring, warc
from batchgate.llm import queries as own

from .conftest import SF


def test_cross_entropy_equals_plain_counts(spark):
    rows = [(1, "a b a b"), (2, "A b c"), (3, "c c d"), (4, None), (5, " "), (None, "a d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    target = spark.createDataFrame([(1,), (2,), (2,), (None,), (77,)], "doc_id long")
    got = {r["doc_id"]: r for r in lm_scoring.score(docs, target, words=3, strength=2.0).collect()}
    top = ["a", "b", "c"]  # d is unknown
    texts = {i: [w if w in top else "?" for w in (t or "").lower().split()] for i, t in rows}

    def model(ids):
        pairs, single = Counter(), Counter()
        for i in ids:
            for h, w in zip(["<s>", *texts[i]], texts[i], strict=False):
                pairs[h, w] += 1
                single[w] += 1
        total = sum(single.values()) + len(top) + 1
        after = Counter()
        for (h, _), n in pairs.items():
            after[h] += n
        return lambda h, w: -math.log2((pairs[h, w] + 2 * (single[w] + 1) / total) / (after[h] + 2))

    models = model([1, 2]), model(texts)
    for i, words in texts.items():
        if not words:
            assert got[i]["n_tokens"] == 0 and got[i]["score"] is None
            continue
        losses = [np.mean([m(h, w) for h, w in zip(["<s>", *words], words, strict=False)]) for m in models]
        assert got[i]["target_loss"] == pytest.approx(losses[0], abs=1e-5)
        assert got[i]["score"] == pytest.approx(losses[0] - losses[1], abs=1e-5)


@pytest.mark.parametrize("share", [1.0, 0.1, 0.0])
def test_all_words_are_scored(spark, monkeypatch, share):
    monkeypatch.setattr(lm_scoring, "HOT_SHARE", share)
    monkeypatch.setattr(lm_scoring, "BLOCK_TOKENS", 500)
    rnd = np.random.default_rng(3)
    # Some 2,500 words, most of them once or twice; texts 0 and 1 differ in one rare word.
    draw = [[f"w{int(x)}" for x in rnd.zipf(1.3, n) % 100_000] for n in rnd.integers(0, 60, 200)]
    texts = dict(enumerate([["the", "zebra"], ["the", "quark"], ["zebra", "zebra", "the"], *draw]))
    texts |= {1000 + i: [f"r{i}", f"r{i + 1}"] for i in range(2500)}
    targets = [i for i in texts if i % 2 == 0]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")
    ids = spark.createDataFrame([(i,) for i in targets], "doc_id long")
    got = {r["doc_id"]: r for r in lm_scoring.score(docs.repartition(3), ids, strength=2.0).collect()}
    kinds = len({w for t in texts.values() for w in t}) + 1
    assert kinds > 2500 and len(got) == len(texts)

    def model(ids):
        pairs, single, after = Counter(), Counter(), Counter()
        for i in ids:
            for h, w in zip(["<s>", *texts[i]], texts[i], strict=False):
                pairs[h, w] += 1
                single[w] += 1
                after[h] += 1
        total = sum(single.values()) + kinds
        return lambda h, w: -math.log2((pairs[h, w] + 2 * (single[w] + 1) / total) / (after[h] + 2))

    models = model(targets), model(texts)
    for i, words in texts.items():
        if not words:
            assert got[i]["n_tokens"] == 0 and got[i]["score"] is None
            continue
        losses = [np.mean([m(h, w) for h, w in zip(["<s>", *words], words, strict=False)]) for m in models]
        assert got[i]["target_loss"] == pytest.approx(losses[0], abs=1e-5)
        assert got[i]["score"] == pytest.approx(losses[0] - losses[1], abs=1e-5)
    assert got[0]["score"] != got[1]["score"]


def test_scoring_odd(spark, odd, nothing):
    target = spark.createDataFrame([(4,)], "doc_id long")
    assert lm_scoring.score(odd, target).count() == odd.count()
    assert lm_scoring.score(nothing, target).count() == 0
    assert lm_scoring.score(odd, target.where("false")).count() == odd.count()


def test_language_of_held_out_texts(spark):
    found = own.op6_language_mixture(spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    right = found.join(truth, "doc_id").where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.98


def test_language_mixture(spark, odd, nothing):
    en, de = "the cat and the dog of this house", "der hund und die katze von dem haus"
    rows = [(i, (en, de)[i % 2], ("en", "de")[i % 2]) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_mixture.train(docs, "text", "lang")
    mixed = spark.createDataFrame([(0, f"{en} {en} {en} {de}"), (1, en), (2, None), (3, "12 !")], "doc_id long, text string")
    got = {r["kept"]["doc_id"]: r for r in language_mixture.predict(mixed, model).collect()}
    assert got[0]["lang_pred"] == "en" and 0.6 < got[0]["score"] < 0.9 and "de:" in got[0]["languages"]
    assert (got[1]["lang_pred"], got[1]["score"]) == ("en", 1.0)
    assert [got[i]["lang_pred"] for i in (2, 3)] == ["und", "und"]
    all_rows = language_mixture.identify(odd).collect()
    assert len(all_rows) == odd.count()
    assert {r["lang_pred"] for r in all_rows if r["doc_id"] in (0, 1, 2, 3)} == {"und"}
    assert language_mixture.identify(nothing).count() == 0
    kept = language_mixture.drop_unidentified(odd)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 5


@pytest.mark.parametrize("zip64", [False, True])
def test_package_is_a_zip_and_reads_by_range(tmp_path, zip64):
    path = f"file://{tmp_path}/p.zip"
    package = warc.Package(path, zip64)
    records = [warc.record([("WARC-Type", "response"), ("K", str(i))], b"\r\n\r\n" * i) for i in range(200)]
    for i, r in enumerate(records):
        package.add(str(i), gzip.compress(r))
    package.close()
    raw = (tmp_path / "p.zip").read_bytes()
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        assert z.testzip() is None and z.namelist() == [warc.ARCHIVE, warc.INDEX]
        assert gzip.decompress(z.read(warc.ARCHIVE)) == b"".join(records)
    for step in (100, 1 << 20):
        got = list(warc.read_records(path, step))
        assert [(f["k"], len(p)) for f, p in got] == [(str(i), 4 * i) for i in range(200)]
    other = tmp_path / "other.zip"
    with zipfile.ZipFile(other, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a", "a" * 100)
    with warc.open_input(f"file://{other}") as f, pytest.raises(ValueError):
        warc.begins(f, warc.directory(f)["a"])


def test_pages(spark):
    rows = [(1, "u", "same"), (2, "u\nv", "same"), (3, None, None), (4, "u", ""), (5, "u", "é"), (2, "u", "same"), (None, "u", "same")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("best", F.lit(1))
    got = warc.read_packages(spark, warc.write_packages(pages)).collect()
    assert sorted((str(r["page_id"]), r["record_type"], r["refers_to"], r["payload_bytes"]) for r in got) == sorted(
        [("1", "revisit", 2, 4), ("2", "response", None, 4), ("2", "response", None, 4), ("None", "revisit", 2, 4),
         ("3", "revisit", 4, 0), ("4", "response", None, 0), ("5", "response", None, 2)]
    )
    assert {r["payload_digest"] for r in got if r["page_id"] == 5} == {warc.base32_sha1("é".encode())}
    least = warc.read_packages(spark, warc.write_packages(pages, least=1, package_bytes=1)).collect()
    assert {r["record_type"] for r in least if r["payload_bytes"] == 0} == {"response"}
    assert warc.write_packages(pages.where("false")).rows == 0


def test_search_recall(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ids = np.array([r["vec_id"] for r in rows])
    x = np.array([r["embedding"] for r in rows], np.float64)
    found = {}
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    for r in hnsw.nearest(vectors, vectors.where("vec_id % 20 = 0"), 20, shard_rows=200).collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    hits = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        score = x @ x[q]
        order = [i for i in np.lexsort((ids, -score)) if i != q][:20]
        got = found[ids[q]]
        assert sorted(got) == list(range(1, 21))
        hits += len({v for v, _ in got.values()} & set(ids[order].tolist()))
        total += 20
        assert all(abs(s - score[ids.tolist().index(v)]) < 1e-9 for v, s in got.values())
    assert hits / total >= 0.95


def test_search_odd(spark):
    good = [(i, [1.0, float(i % 3)]) for i in range(12)]
    bad = [(50, None), (51, [0.0, 0.0]), (52, [1.0, None]), (53, [float("nan"), 1.0]), (54, [float("inf"), 1.0]), (None, [1.0, 1.0]), (55, [1.0])]
    vectors = spark.createDataFrame(good + bad, "vec_id long, embedding array<double>")
    got = hnsw.nearest(vectors, vectors, 4, shard_rows=2).collect()
    for q, (_, v) in enumerate(good):
        want = sorted((-float(np.dot(v, w)), i) for i, w in good if i != q)[:4]
        assert [(r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] == [
            (i, -s) for s, i in want
        ]
    assert len(got) == 48
    few = hnsw.nearest(vectors.where("vec_id < 3"), vectors.where("vec_id < 3"), 20)
    assert few.count() == 6
    assert hnsw.nearest(vectors.where("false"), vectors.where("false"), 20).count() == 0
