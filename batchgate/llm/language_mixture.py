"""Language identification as a mixture: which languages, in which proportions.

Every language has a distribution of byte n-grams, counted over all training
texts. A text is a mixture of languages by word: expectation-maximisation finds
the proportions, and a set of languages is kept if its likelihood, penalised
for every further language, is the best.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchgate.llm.common import settled, text_runs

UNDETERMINED = "und"
GRAM_BITS = 17
SMOOTHING = 0.5
ROUNDS = 12
# Each further language has to gain this many times half the logarithm of the words.
PENALTY = 2.0
# A text belongs to a language that has this share of its words at least.
LEAST_SHARE = 0.3
# Bytes of texts that are inferred at a time.
RUN = 1 << 18

# ASCII letters in lower case and all bytes of other characters; 0 ends a word.
_LETTERS = np.zeros(256, np.uint32)
_LETTERS[0x41:0x5B] = np.arange(0x61, 0x7B)
_LETTERS[0x61:0x7B] = np.arange(0x61, 0x7B)
_LETTERS[0x80:] = np.arange(0x80, 0x100)
_WEIGHTS = [np.uint32(w) for w in (2654435761, 2246822519, 3266489917, 668265263)]


def word_grams(data: np.ndarray, bounds: np.ndarray):
    """Hashed n-grams of one byte before and up to three of a word from each of its bytes on.

    Returns the n-grams of all words end to end, where each word begins among
    them, and how many words lie before each text.
    """
    code = np.zeros(len(data) + len(bounds) + 3, np.uint32)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    code[np.arange(len(data)) + text + 1] = _LETTERS[data]
    at = np.flatnonzero(code)
    second = code[at + 1]
    a, b, c, d = _WEIGHTS
    mixed = code[at - 1] * a + code[at] * b + second * c
    mixed += np.where(second != 0, code[np.minimum(at + 2, len(code) - 1)], 0).astype(np.uint32) * d
    mixed ^= mixed >> np.uint32(15)
    grams = (mixed * b) >> np.uint32(32 - GRAM_BITS)
    starts = np.flatnonzero(code[at - 1] == 0)
    return grams, starts, np.searchsorted(at[starts], bounds + np.arange(len(bounds)))


@dataclass(frozen=True)
class Model:
    languages: list[str]
    log_p: np.ndarray  # n-gram x language


def train(docs: DataFrame, text: str, lang: str) -> Model:
    """Counts over all rows with a language; languages x 2^17 counts reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for first, last, data, bounds in text_runs(batch.column(0), RUN):
                grams, starts, words = word_grams(data, bounds)
                cut = np.r_[starts, len(grams)][words]
                own = np.repeat(np.arange(last - first), np.diff(cut))
                names = sorted(set(langs[first:last]))
                which = np.array([names.index(x) for x in langs[first:last]])
                for k, name in enumerate(names):
                    found = np.bincount(grams[which[own] == k], minlength=1 << GRAM_BITS)
                    totals[name] = totals.get(name, 0) + found
        for name, found in totals.items():
            gram = np.flatnonzero(found)
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([name] * len(gram), pa.string()),
                    "gram": pa.array(gram.astype(np.int32)),
                    "n": pa.array(found[gram].astype(np.int64)),
                }
            )

    counts = (
        docs.where(F.col(lang).isNotNull())
        .select(F.col(text).cast("string"), F.col(lang).cast("string"))
        .mapInArrow(settled(count), "lang string, gram int, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
        .toArrow()
    )
    names = counts["lang"].to_pylist()
    languages = sorted(set(names))
    table = np.full((1 << GRAM_BITS, len(languages)), SMOOTHING)
    at = {name: k for k, name in enumerate(languages)}
    table[counts["gram"].to_numpy(), [at[x] for x in names]] += counts["n"].to_numpy()
    return Model(languages, np.log(table / table.sum(0)).astype(np.float32))


def _fit(ratio: np.ndarray, owner: np.ndarray, first: np.ndarray, many: np.ndarray, allowed):
    """Proportions per text and the log-likelihood above the words' best, by EM.

    ``ratio`` is each word's likelihood per language over its best one.
    """
    share = allowed / allowed.sum(1, keepdims=True)
    for _ in range(ROUNDS):
        joint = ratio * share[owner]
        joint /= joint.sum(1, keepdims=True)
        share = np.add.reduceat(joint, first, axis=0) / many[:, None]
    total = (ratio * share[owner]).sum(1)
    return share, np.add.reduceat(np.log(total), first)


def infer(model: Model, data: np.ndarray, bounds: np.ndarray, penalty: float = PENALTY):
    """Proportions of the chosen languages, one row per text; zeros without words."""
    kinds = len(model.languages)
    result = np.zeros((len(bounds) - 1, kinds))
    grams, starts, words = word_grams(data, bounds)
    texts = np.flatnonzero(np.diff(words))
    if not len(texts) or not kinds:
        return result
    score = np.add.reduceat(model.log_p[grams], starts, axis=0).astype(np.float64)
    score -= score.max(1, keepdims=True)
    # A floor keeps every word possible in every language.
    ratio = np.exp(np.maximum(score, -300.0))
    many = np.diff(words)[texts]
    first = words[texts]
    owner = np.repeat(np.arange(len(texts)), many)
    single = np.add.reduceat(np.maximum(score, -300.0), first, axis=0)
    chosen = np.eye(kinds)[single.argmax(1)]
    best = single.max(1)
    if kinds > 1:
        price = penalty * np.log(many + 1) / 2
        share, full = _fit(ratio, owner, first, many, np.ones((len(texts), kinds)))
        # No smaller set is likelier than all languages, so most texts are settled.
        order = np.argsort(-share, axis=1, kind="stable")
        open_ = np.flatnonzero(full - price > best)
        for size in range(2, kinds + 1):
            if not len(open_):
                break
            own = np.isin(owner, open_)
            position = np.searchsorted(open_, owner[own])
            n = many[open_]
            allowed = np.zeros((len(open_), kinds))
            np.put_along_axis(allowed, order[open_, :size], 1.0, axis=1)
            some, fit = _fit(ratio[own], position, np.cumsum(n) - n, n, allowed)
            value = fit - price[open_] * (size - 1)
            better = value > best[open_]
            chosen[open_[better]] = some[better]
            best[open_[better]] = value[better]
            open_ = open_[full[open_] - price[open_] * size > best[open_]]
    result[texts] = chosen
    return result


def remainder(key: Column) -> Column:
    return F.crc32(key.cast("string").cast("binary")) % 3


def predict(
    docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """A struct ``kept`` of the ``keep`` columns (all), with lang_pred, score, languages.

    ``score`` is the proportion of the foremost language among those chosen;
    ``languages`` lists them, foremost first, as ``en:0.83,fr:0.17``. Text that is
    null or has no letter is ``und`` with score 0, as is any without a model.
    Ties go to the language that sorts first.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = docs.columns if keep is None else keep

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            lettered = batch.column(2).to_numpy(zero_copy_only=False)
            for first, last, data, bounds in text_runs(batch.column(1), RUN):
                share = infer(model, data, bounds)
                share[~lettered[first:last].astype(bool)] = 0
                order = np.argsort(-share, axis=1, kind="stable")
                names, scores, lists = [], [], []
                for row, rank in zip(share, order, strict=True):
                    some = [k for k in rank if row[k] > 0]
                    names.append(model.languages[some[0]] if some else UNDETERMINED)
                    scores.append(min(1.0, float(row[some[0]])) if some else 0.0)
                    lists.append(",".join(f"{model.languages[k]}:{row[k]:.2f}" for k in some if row[k] >= 0.005))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        pa.array(names, pa.string()),
                        pa.array(scores, pa.float64()),
                        pa.array(lists, pa.string()),
                    ],
                    names=["kept", "lang_pred", "score", "languages"],
                )

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    packed = docs.select(
        F.struct(*[F.col(c) for c in keep]).alias("kept"),
        text.alias("text"),
        text.rlike(r"\p{L}").alias("lettered"),
    )
    kept = packed.schema["kept"].dataType.simpleString()
    return packed.mapInArrow(
        settled(label), f"kept {kept}, lang_pred string, score double, languages string"
    )


def identify(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """Learn from rows that are not held out, predict the language of every row.

    Held out are rows whose crc32(id) mod 3 is 1; a row without id is neither.
    Rows without a language are not learned from. Returns id, held_out,
    lang_pred, score, languages; repeated rows each get theirs.
    """
    model = train(docs.where(remainder(F.col(id_col)) != 1), text_col, lang_col)
    found = predict(docs, model, text_col, keep=[id_col])
    return found.select(
        F.col("kept")[id_col].alias(id_col),
        F.coalesce(remainder(F.col("kept")[id_col]) == 1, F.lit(False)).alias("held_out"),
        "lang_pred", "score", "languages",
    )


def drop_unidentified(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    least_share: float = LEAST_SHARE,
) -> DataFrame:
    """The rows of ``docs`` whose language is determined, columns unchanged.

    Rows go whose text is null or has no letter, and those whose foremost language
    has less than ``least_share`` of the words: a medley of all languages. Where no row
    has a language to learn from, every row with a letter stays. Repeated rows
    each get the same verdict; an empty table gives no row. Texts of any length are
    read whole, and extra columns may have any names. Rows go through Python once.
    """
    model = train(docs.where(remainder(F.col(id_col)) != 1), text_col, lang_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = docs.columns.index(text_col)

    def stay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            if not model.languages:
                yield batch
                continue
            for first, last, data, bounds in text_runs(batch.column(at).cast(pa.large_string()), RUN):
                share = infer(model, data, bounds).max(1)
                # Letters that no word has (superscripts, say) are no ground to go.
                yield batch.slice(first, last - first).filter(pa.array((share >= least_share) | (share == 0)))

    lettered = docs.toDF(*names).where(
        F.coalesce(F.col(names[at]).cast("string"), F.lit("")).rlike(r"\p{L}")
    )
    return lettered.mapInArrow(settled(stay), lettered.schema).toDF(*docs.columns)
