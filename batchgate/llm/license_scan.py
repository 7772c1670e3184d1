"""Licence scan by a positional index of rare words, in DataFrame functions only.

Every template is a short licence notice with a mandatory key phrase. The index
holds, for each template, its words of the highest inverse document frequency
with their positions. A file's indexed words are looked up; a hit at position p of
the file and q of a template says the template would begin at p - q. Hits that agree
on a beginning add up, and a beginning counts where the words around it hold the
key phrase in its place.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Rarest words that a template is indexed by, besides the rarest of its key phrase.
RARE_WORDS = 3
# Share of a template's indexed weight that has to agree for its label.
AGREEMENT = 0.5


@dataclass(frozen=True)
class Template:
    label: str
    words: str
    key: str
    base: bool = False


# Phrases and labels of the contract, then notices of common licences.
TEMPLATES = (
    Template("gpl", "gnu general public license", "gnu general public license", True),
    Template("apache", "apache license", "apache license", True),
    Template("cc-by", "cc by", "cc by", True),
    Template("mit", "mit license", "mit license", True),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    Template("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    Template("cc-by-4.0", "licensed under cc by 4 0", "cc by 4 0"),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa 4 0"),
    Template("lgpl", "gnu lesser general public license", "lesser general public license"),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose", "permission to use copy modify and or distribute this software"),
    Template("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted free of charge"),
    Template("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
)


def words_of(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def index(spark: SparkSession, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """A row per indexed word: word, template, at, weight, and what the template needs.

    One word of each is ``needed``: the rarest of its key phrase. Words without two
    letters in a row are not indexed.

    As large as the list of templates, whatever the input. Weights are millionths of the
    natural logarithm of (1 + templates / templates with the word).
    """
    listed = spark.createDataFrame(
        [(i, t.label, t.words.split(), t.key.split(), t.base) for i, t in enumerate(templates)],
        "template int, label string, words array<string>, key array<string>, base boolean",
    )
    words = listed.select("*", F.posexplode("words").alias("at", "word")).where("word RLIKE '[a-z]{2}'")
    found = words.groupBy("word").agg(F.countDistinct("template").alias("df"))
    rarity = F.round(F.log(1 + F.lit(len(templates)) / F.col("df")) * 1_000_000).cast("long")
    in_key = F.array_contains("key", F.col("word"))
    rarest = Window.partitionBy("template").orderBy(F.desc("weight"), F.desc(F.length("word")), "at")
    of_key = Window.partitionBy("template", in_key).orderBy(F.desc("weight"), F.desc(F.length("word")), "at")
    chosen = (
        words.join(found, "word").withColumn("weight", rarity)
        .withColumn("rank", F.row_number().over(rarest))
        .withColumn("key_rank", F.when(in_key, F.row_number().over(of_key)))
        .where((F.col("rank") <= RARE_WORDS) | (F.col("key_rank") == 1))
    )
    begins = F.array_position(
        F.transform(
            F.sequence(F.lit(1), F.size("words") - F.size("key") + 1),
            lambda i: F.slice("words", i, F.size("key")) == F.col("key"),
        ),
        True,
    )
    return chosen.select(
        "word", "template", "label", "base", "at", "weight", "key",
        (F.col("key_rank") == 1).alias("needed"),
        (begins - 1).cast("int").alias("key_at"),
        F.sum("weight").over(Window.partitionBy("template")).alias("whole"),
    )


def scan(
    docs: DataFrame,
    templates: tuple[Template, ...] = TEMPLATES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``n_base`` counts all places of base phrases, ``first_word`` and ``last_word`` are
    their smallest and largest beginnings, words counted from 0, or null. Labels
    are distinct, sorted and comma-joined; ``labels`` has those of the method, too.
    ``score`` is the largest share of a template's indexed weight that agrees at one
    beginning with its key phrase in place, 0 without any. Null and empty texts have
    no word; null ids and repeated rows are rows like others.
    """
    postings = index(docs.sparkSession, templates)
    reach = max(len(t.words.split()) for t in templates)
    # The indexed words themselves, a bounded number; texts without a needed one are left out.
    listed = postings.select("word", "needed").distinct().collect()
    known = sorted({r["word"] for r in listed})
    needed = F.array(*[F.lit(r["word"]) for r in listed if r["needed"]])
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        words_of(F.col(text_col)).alias("words"),
    )
    numbered = F.transform("words", lambda w, i: F.when(w.isin(known), i))
    hits = F.transform(
        F.filter(numbered, lambda i: i.isNotNull()),
        lambda i: F.struct(
            i.alias("pos"),
            F.greatest(i - reach, F.lit(0)).alias("from"),
            F.slice("words", F.greatest(i - reach, F.lit(0)) + 1, F.lit(2 * reach + 1)).alias("near"),
        ),
    )
    hit = rows.select(
        "row", "id", F.size("words").cast("long").alias("n_words"),
        F.explode_outer(F.when(F.arrays_overlap("words", needed), hits)).alias("hit"),
    )
    hit = hit.withColumn("word", F.element_at("hit.near", F.col("hit.pos") - F.col("hit.from") + 1))
    start = F.col("hit.pos") - F.col("at")
    # Where the key phrase would begin among the words kept around the hit.
    place = start + F.col("key_at") - F.col("hit.from")
    in_place = (place >= 0) & (
        F.slice("hit.near", F.greatest(place, F.lit(0)) + 1, F.size("key")) == F.col("key")
    )
    agreed = (
        hit.join(F.broadcast(postings), "word", "left")
        .select("row", "id", "n_words", "template", "label", "base", "whole", "weight", start.alias("start"), in_place.alias("ok"))
        .groupBy("row", "id", "n_words", "template", "label", "base", "whole", "start")
        .agg(F.sum("weight").alias("weight"), F.max("ok").alias("ok"))
        .withColumn("share", F.when(F.col("ok"), F.col("weight") / F.col("whole")))
    )
    place = F.when(F.col("ok") & F.col("base"), F.col("start"))
    named = F.when(F.col("ok") & (F.col("base") | (F.col("share") >= AGREEMENT)), F.col("label"))

    def joined(label: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(label)), ",")

    return (
        agreed.groupBy("row", "id", "n_words")
        .agg(
            F.count(place).alias("n_base"),
            F.min(place).cast("long").alias("first_word"),
            F.max(place).cast("long").alias("last_word"),
            joined(F.when(F.col("base"), named)).alias("base_labels"),
            joined(named).alias("labels"),
            F.coalesce(F.max("share"), F.lit(0.0)).alias("score"),
        )
        .drop("row")
        .withColumnRenamed("id", id_col)
    )


def listed_postings(templates: tuple[Template, ...] = TEMPLATES) -> list[dict]:
    """What ``index`` holds, reckoned without Spark, for the SQL."""
    words = [t.words.split() for t in templates]
    result = []
    for i, t in enumerate(templates):
        found = []
        for at, word in enumerate(words[i]):
            if re.search("[a-z]{2}", word):
                df = sum(word in w for w in words)
                found.append((-round(math.log(1 + len(templates) / df) * 1_000_000), -len(word), at, word))
        found.sort()
        of_key = next(f for f in found if f[3] in t.key.split())
        for f in found:
            if f in found[:RARE_WORDS] or f is of_key:
                result.append({"template": i, "word": f[3], "at": f[2], "weight": -f[0]})
    return result


def scan_sql(templates: tuple[Template, ...], postings: list[dict]) -> str:
    """The same by looking at every place of every key phrase; ``postings`` as ``index`` has them."""
    texts = []
    for i, t in enumerate(templates):
        own = [p for p in postings if p["template"] == i]
        words, key = t.words.split(), t.key.split()
        at = next(k for k in range(len(words)) if words[k : k + len(key)] == key)
        found = " + ".join(
            f"CASE WHEN k - {at} + {p['at']} >= 0 AND ws[k - {at} + {p['at']} + 1] = '{p['word']}' THEN {p['weight']} ELSE 0 END"
            for p in own
        )
        texts.append(
            f"SELECT doc_id, '{t.label}' AS label, {str(t.base).upper()} AS base, k - {at} AS start, "
            f"({found}) / {sum(p['weight'] for p in own)} AS share "
            f"FROM places WHERE ws[k + 1 : k + {len(key)}] = {key!r}"
        )
    return f"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS ws
  FROM documents
),
places AS (SELECT doc_id, ws, unnest(range(len(ws))) AS k FROM words),
found AS ({" UNION ALL ".join(texts)}),
named AS (
  SELECT doc_id,
         count(*) FILTER (WHERE base) AS n_base,
         min(start) FILTER (WHERE base) AS first_word,
         max(start) FILTER (WHERE base) AS last_word,
         array_to_string(list_sort(list(DISTINCT label) FILTER (WHERE base)), ',') AS base_labels,
         array_to_string(list_sort(list(DISTINCT label) FILTER (WHERE base OR share >= {AGREEMENT})), ',') AS labels,
         max(share) AS score
  FROM found GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(w.ws) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM words w LEFT JOIN named n ON w.doc_id = n.doc_id
"""
