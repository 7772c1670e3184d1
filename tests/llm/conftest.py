import pytest

from batchgate.llm.queries import tokenizer_file

SF = "/root/testdata/sf0.001"
# Null, empty and blank texts, no letter, ties, repeats, a long word, NUL, other scripts.
ODD_TEXTS = [
    None, "", "  \t\n", "12 34 !", "same text here now", "same text here now", "same  text\there now",
    "Same TEXT here now", "x" * 30_000, "a\x00b c\x00", "Ünïcode ﬁ 한국어 текст ▁ a", "one", "one two",
    "word " * 4_000, "MIT License. The MIT license; mit\nlicense", "GNU General Public License, version 3",
]


@pytest.fixture
def odd(spark):
    """Odd rows: a null id, a repeated row, columns whose names clash with the operators' own."""
    rows = [(i, t, ["en", "de", None][i % 3]) for i, t in enumerate(ODD_TEXTS)]
    rows += [(None, "same text here now", "en"), (4, "same text here now", "en"), (None, None, None)]
    ddl = "doc_id long, text string, lang string"
    extra = "row string, n int, count int, _key int, kept boolean, score string, block int, label int"
    frame = spark.createDataFrame([(*r, "r", 1, 2, 3, False, "s", 4, 5) for r in rows], f"{ddl}, {extra}")
    return frame.repartition(3)


@pytest.fixture
def nothing(odd):
    return odd.where("false")


@pytest.fixture
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def word_bpe():
    return tokenizer_file("word_bpe_49k.json")


@pytest.fixture(scope="session")
def piece_bpe():
    return tokenizer_file("piece_bpe_32k.model")
