"""A corpus in four stages: language, exact copies, near copies, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs. All but the last return the
columns of ``documents``. A null text counts as empty and has no language, so
it goes in the first stage; other columns may be null and are passed on. Repeated
rows are copies, of which one stays. Texts of any length are read whole. An empty
table gives no sequence. Further columns, whatever their names, are passed on
until packing. As docs has been written by then, a stage first deletes the scratch tables
that the stage before it left, unless docs reads them or is not read from files.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from batchgate.llm import exact_dedup, language_mixture, ngram_join, packing
from batchgate.llm.common import kept_tables, new_folder, release, table
from batchgate.llm.queries import tokenizer_file

SHINGLE_WORDS = 5
SIMILAR = (4, 5)  # 0.8 and more

# Scratch tables that results of stages read, by the number of the stage.
_left: dict[int, list[str]] = {}


def _stage(number: int) -> Callable:
    """Makes a function the stage of that number, which follows up on the one before."""

    def of(run: Callable) -> Callable:
        @wraps(run)
        def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            earlier = _left.pop(number - 1, [])
            files = docs.inputFiles() if earlier else []
            read = {p for p in earlier if not files or any(p.rpartition("/")[2] in f for f in files)}
            release(spark, *[p for p in earlier if p not in read])
            before = set(kept_tables())
            result = run(spark, docs, sf_dir)
            _left[number] = [p for p in kept_tables() if p not in before]
            return result

        return stage

    return of


@_stage(0)
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go whose language cannot be determined: those without a letter, and medleys.

    A medley's foremost language has less than ``language_mixture.LEAST_SHARE`` of its
    words. If no document has a language to learn from, all with a letter stay.
    """
    return language_mixture.drop_unidentified(docs)


@_stage(1)
def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents equal but for white space the one with the smallest id stays."""
    return exact_dedup.drop_copies(docs)


@_stage(2)
def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by shared five-word shingles the one with the smallest id stays."""
    return ngram_join.drop_near_copies(docs, SHINGLE_WORDS, *SIMILAR)


@_stage(3)
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents that stay, with sequence and offset."""
    return packing.pack(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [("language", language), ("exact", exact), ("near", near), ("packed", packed)]
# No stage but the second can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), new_folder(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
