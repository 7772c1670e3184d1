"""What the near-copy join leaves on disk and moves, beside its results."""

import random
import time
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from batchgate.llm import ngram_join
from batchgate.session import materialise, release


@pytest.fixture
def written(monkeypatch):
    """Rows and bytes of the join's scratch tables, by name."""
    seen = {}

    def noted(df, name, *args, **kwargs):
        table = materialise(df, name, *args, **kwargs)
        folder = Path(table.path.removeprefix("file:").replace("//", "/"))
        seen.setdefault(name, (table.rows, sum(p.stat().st_size for p in folder.glob("*.parquet"))))
        return table

    monkeypatch.setattr(ngram_join, "materialise", noted)
    return seen


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [found.apply(i).getName() for i in range(found.size())]
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def test_shuffle_files_go_when_their_table_is_written(spark):
    before = shuffle_files(spark)
    table = materialise(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    until = time.time() + 10
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert table.df.count() == 7 and {r["count"] for r in table.df.collect()} == {142, 143}
    release(spark, table.path)


def test_sets_of_near_copies_take_less_than_their_hashes(spark, written):
    rnd = random.Random(4)
    vocabulary = ["".join(rnd.choice(["th", "er", "on", "an", "re"]) for _ in range(rnd.randrange(1, 4))) for _ in range(900)]
    rows = []
    for i in range(40):
        base = [rnd.choice(vocabulary) for _ in range(700)]
        for k in range(5):
            words = [*base[: 100 * k], f"changed{k}", *base[100 * k + 1 :]]
            rows.append((5 * i + k, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2, "doc_id")
    got = ngram_join.components(docs, 5, 4, 5).collect()
    assert all(r["component_id"] == r["doc_id"] // 5 * 5 for r in got) and len(got) == 200
    assert written["sets"][0] == 200
    assert written["sets"][1] < 4 * sum(r["n_shingles"] for r in got)


def test_texts_that_only_share_a_phrase_are_not_moved(spark, written, monkeypatch):
    # As if the phrase had not been counted, which is so for phrases rare in a larger corpus.
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    monkeypatch.setattr(ngram_join, "_frequent", lambda docs, size: none)
    phrase = [f"p{k}" for k in range(12)]
    rows = [(i, " ".join([*phrase, *(f"w{i}x{k}" for k in range(50))])) for i in range(300)]
    # Two that link, but share the phrase with all others.
    rows.append((300, rows[7][1].replace("w7x49", "other")))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2, "doc_id")
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.components(docs, 3, 1, 2).collect()}
    assert got == {i: 7 if i == 300 else i for i in range(301)}
    assert 2 <= written["wanted"][0] < 40


@pytest.mark.parametrize("part, whole", [(9, 10), (4, 5), (1, 2)])
def test_large_lists_are_screened_like_small_ones(part, whole, monkeypatch):
    rng = np.random.default_rng(part)
    rows = []
    for c, n in enumerate((6, 40, 90, 300)):
        base = rng.integers(0, 1 << 63, n, np.uint64)
        for k in range(30):
            own = np.unique(np.r_[base[rng.random(n) > rng.choice([0, 0.02, 0.1])], rng.integers(0, 1 << 63, k % 3, np.uint64)])
            rows.append({"key": 0, "row": 100 * c + k, "n": len(own), "sketch": ngram_join.sketch(own, part, whole), "label": 100 * c + k % 29})
    rng.shuffle(rows)
    batch = ngram_join.pa.RecordBatch.from_pylist(rows)

    def found():
        known = {r["row"]: r["label"] for r in rows}

        def find(x):
            while known[x] != x:
                x = known[x]
            return x

        for b in ngram_join._possible(part, whole)(iter([batch])):
            for e in b.to_pylist():
                x, y = sorted((find(e["a"]), find(e["b"])))
                known[y] = x
        return {r["row"]: find(r["row"]) for r in rows}

    many = found()
    monkeypatch.setattr(ngram_join, "FEW", 1000)
    assert many == found() and 4 <= len(set(many.values())) < 100
