import re
import zlib
from collections import Counter

import corpus_pipeline
import pytest
from batchgate.llm import exact_dedup, language_mixture, ngram_join
from batchgate.session import kept_tables

from .conftest import SF
from .plain import PlainMixture, lettered, roots, shingles
from .test_tokens import best_fit, crc, reference


def test_stages_keep_columns(spark, odd, nothing):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd, SF).columns == odd.columns
        assert stage(spark, nothing, SF).count() == 0


def test_run_packs_what_the_stages_keep(spark, documents):
    packed = corpus_pipeline.run(spark, SF)
    kept = {r["doc_id"] for r in packed.select("doc_id").distinct().collect()}
    sound = language_mixture.identify(documents).where("lang_pred <> 'und'").select("doc_id")
    docs = documents.join(sound, "doc_id", "left_semi")
    first = exact_dedup.mark_copies(docs).where("kept").select("doc_id")
    docs = docs.join(first, "doc_id", "left_semi")
    groups = ngram_join.components(docs, 5, 4, 5).collect()
    assert kept == {r["doc_id"] for r in groups if r["doc_id"] == r["component_id"]}
    assert max(Counter(r["sequence_id"] for r in packed.collect()).values()) >= 1


@pytest.fixture(scope="module")
def plain():
    """Documents as (id, text, lang), and the plain model of those that are not held out."""
    import pyarrow.parquet as pq

    read = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text", "lang"]).to_pylist()
    rows = [(r["doc_id"], r["text"] or "", r["lang"]) for r in read]
    learned = [(t, g) for i, t, g in rows if g and zlib.crc32(str(i).encode()) % 3 != 1]
    return rows, PlainMixture(learned)


def test_language_equals_plain_mixture(documents, plain):
    rows, model = plain
    got = {r["doc_id"]: r for r in language_mixture.identify(documents).collect()}
    assert len(got) == len(rows)
    for i, text, _ in rows[::4]:
        share = model.shares(text) if lettered(text) else {}
        best = max(share, key=lambda k: (share[k], k), default="und")
        assert got[i]["lang_pred"] == best
        assert got[i]["score"] == pytest.approx(share.get(best, 0.0), abs=1e-3)


def test_run_equals_plain_stages(spark, plain, word_bpe):
    rows, model = plain
    kept = {}
    for i, text, _ in rows:
        if lettered(text):
            share = model.shares(text)
            if not share or max(share.values()) >= language_mixture.LEAST_SHARE:
                kept[i] = text
    first = {}
    for i in sorted(kept):
        first.setdefault(re.sub("[ \t-\r]+", " ", kept[i]), i)
    kept = {i: kept[i] for i in first.values()}
    root = roots({i: shingles(t, 5) for i, t in kept.items()}, 4, 5)
    kept = {i: t for i, t in kept.items() if root[i] == i}

    pieces = {}
    for i, ids in zip(kept, reference(word_bpe, kept.values()), strict=True):
        for k in range(0, len(ids), 4096):
            pieces[i, k // 4096] = (k, len(ids[k : k + 4096]), crc(ids[k : k + 4096]))
    got = corpus_pipeline.run(spark, SF).collect()
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in got} == pieces
    assert len(got) == len(pieces)
    ends = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert ends.get(r["sequence_id"], 0) == r["offset"]
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 4096
    assert len(ends) == best_fit([n for _, n, _ in pieces.values()], 4096)


def test_documents_without_any_language_stay(spark, documents):
    from pyspark.sql import functions as F

    docs = documents.withColumn("lang", F.lit(None).cast("string"))
    kept = corpus_pipeline.language(spark, docs, SF)
    assert kept.count() == docs.where(F.col("text").rlike(r"\p{L}")).count() > 0


def test_a_stage_deletes_what_the_one_before_left(spark, documents, odd, tmp_path):
    docs, held = documents, []
    for name, stage in corpus_pipeline.STAGES:
        before = set(kept_tables())
        result = stage(spark, docs, SF)
        # Nothing that the stage before held is left; what this result reads is still there.
        assert not set(held) & set(kept_tables())
        held = [p for p in kept_tables() if p not in before]
        result.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    assert docs.count() > 0
    # A result that has not been written keeps its tables.
    first = corpus_pipeline.exact(spark, odd, SF)
    assert corpus_pipeline.near(spark, first, SF).count() <= first.count()


def test_language_tasks_give_memory_back(spark, documents, monkeypatch):
    wrapped, settled = [], language_mixture.settled
    monkeypatch.setattr(language_mixture, "settled", lambda run: wrapped.append(run.__name__) or settled(run))
    language_mixture.identify(documents)
    language_mixture.drop_unidentified(documents)
    assert wrapped == ["count", "label", "count", "stay"]
