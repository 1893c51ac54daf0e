"""License scan by a positional rare-token index over license notices.

Every notice is a sequence of words with a mandatory key phrase (consecutive
words inside it). For all words of the notices the document frequency over
the whole corpus is counted; the word of a key phrase with the highest IDF is
the one looked up. A file's occurrences of such words meet the postings
(word, notice, place in the notice); each gives the place where the notice
would begin, the key phrase is verified at its relative position, and the
share of the notice's words standing at their relative positions is the
place's score. A notice cannot stand in a file without its rarest word, so no
place is missed.

Built-in functions and joins only. Words are lower-cased (A-Z) runs of
``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``. Null or empty texts have no words.
Repeated rows are scanned and returned each by itself; extra columns are
ignored. A key phrase repeated in a file counts at every place.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import land

WORD_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Notice:
    label: str
    words: str        # the notice, as words
    key: str          # its mandatory phrase, as it stands in ``words``
    base: bool = False


# The base phrases and their labels.
BASE_NOTICES = (
    Notice("cc-by", "cc by", "cc by", True),
    Notice("gpl", "general public license", "general public license", True),
    Notice("reserved", "all rights reserved", "all rights reserved", True),
)

# Well-known notices and the phrase each cannot do without.
NOTICES = (
    Notice("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    Notice("mit", "released under the mit license", "mit license"),
    Notice("mit-text", "permission is hereby granted free of charge to any person obtaining a copy",
           "granted free of charge to any person"),
    Notice("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
           "redistribution and use in source and binary forms"),
    Notice("gpl-2.0", "gnu general public license version 2", "general public license version 2"),
    Notice("gpl-3.0", "licensed under the gnu general public license version 3",
           "general public license version 3"),
    Notice("lgpl", "gnu lesser general public license", "lesser general public license"),
    Notice("agpl", "gnu affero general public license", "affero general public license"),
    Notice("mpl-2.0", "subject to the terms of the mozilla public license version 2 0",
           "mozilla public license version 2 0"),
    Notice("epl-2.0", "eclipse public license version 2 0", "eclipse public license"),
    Notice("isc", "permission to use copy modify and or distribute this software for any purpose",
           "copy modify and or distribute this software"),
    Notice("unlicense", "this is free and unencumbered software released into the public domain",
           "unencumbered software released into the public domain"),
    Notice("cc0-1.0", "cc0 1 0 universal", "cc0 1 0"),
    Notice("cc-by-4.0", "licensed under cc by 4 0", "cc by 4 0"),
    Notice("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa 4 0"),
    Notice("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    Notice("cc-by-nd-4.0", "licensed under cc by nd 4 0", "cc by nd 4 0"),
)


def words_of(text: Column) -> Column:
    """Words of a text, A-Z lower-cased. The Kelvin sign would also lower to an
    ASCII letter, so it is moved to another non-ASCII sign first."""
    safe = F.replace(text, F.lit("K"), F.lit("Ⓚ"))
    return F.array_remove(F.split(F.lower(safe), WORD_BREAK), "")


def _place(phrase: list[str], words: list[str]) -> int:
    return next(i for i in range(len(words)) if words[i:i + len(phrase)] == phrase)


def rarest_words(texts: DataFrame, notices) -> dict[int, tuple[str, int, int]]:
    """For each notice its looked-up word, that word's place in the notice, and
    the word's document frequency in ``texts`` (column ``text``)."""
    vocabulary = sorted({w for n in notices for w in n.key.split()})
    found = F.array_intersect(words_of(F.col("text")), F.array(*[F.lit(w) for w in vocabulary]))
    df = {r["w"]: r["n"] for r in texts.select(F.explode(found).alias("w")).groupBy("w")
          .agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a vocabulary word at most
    out = {}
    for i, n in enumerate(notices):
        words, key = n.words.split(), n.key.split()
        at = _place(key, words)
        rare = min(range(len(key)), key=lambda j: (df.get(key[j], 0), j))
        out[i] = (key[rare], at + rare, df.get(key[rare], 0))
    return out


def license_places(docs: DataFrame, notices=BASE_NOTICES + NOTICES, id_col: str = "doc_id",
                   text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(landed rows ``uid, doc_id, n_words``; places ``uid, notice, label, base,
    start, score``): ``start`` is the word at which the notice's key phrase
    begins for base notices, the notice itself for others."""
    src = docs.select(F.col(f"`{id_col}`").alias("doc_id"),
                      F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    rare = rarest_words(src, notices)
    reach = max(len(n.words.split()) for n in notices)
    anchors = F.array(*[F.lit(w) for w in sorted({w for w, _, _ in rare.values()})])
    words = F.col("words")
    hits = F.transform(
        F.filter(F.transform(words, lambda w, i: F.struct(i.alias("pos"), w.alias("word"))),
                 lambda h: F.array_contains(anchors, h["word"])),
        lambda h: F.struct(h["pos"].alias("pos"), h["word"].alias("word"),
                           F.greatest(h["pos"] - reach, F.lit(0)).alias("from"),
                           F.slice(words, F.greatest(h["pos"] - reach, F.lit(0)) + 1, 2 * reach + 1).alias("near")))
    rows = land(src.select("doc_id", words_of(F.col("text")).alias("words"))
                   .select(F.monotonically_increasing_id().alias("uid"), "doc_id",
                           F.size("words").cast("long").alias("n_words"),
                           F.when(F.arrays_overlap(words, anchors), hits).alias("hits")), "license-hits")
    postings = docs.sparkSession.createDataFrame(
        [(w, i, notices[i].label, notices[i].base, at, notices[i].words.split(), notices[i].key.split(),
          _place(notices[i].key.split(), notices[i].words.split())) for i, (w, at, _) in rare.items()],
        "word string, notice int, label string, base boolean, at int, words array<string>, "
        "key array<string>, key_at int")
    hit = rows.where("hits is not null").select("uid", F.explode("hits").alias("h")).select("uid", "h.*")
    # the notices are a fixed list, so bounded
    met = hit.join(F.broadcast(postings), "word").withColumn("begin", F.col("pos") - F.col("at"))
    key_from = F.col("begin") + F.col("key_at") - F.col("from")
    key_there = F.when(F.col("begin") + F.col("key_at") >= 0,
                       F.slice("near", F.greatest(key_from, F.lit(0)) + 1, F.size("key")) == F.col("key"))
    same = F.size(F.filter(F.transform("words", lambda w, i: F.get(F.col("near"), F.col("begin") - F.col("from") + i)
                                       .eqNullSafe(w)), lambda x: x))
    places = (met.where(key_there)
                 .select("uid", "notice", "label", "base", F.col("begin").alias("start"),
                         (same / F.size("words")).alias("score")))
    return rows.select("uid", "doc_id", "n_words"), places


def scan_licenses(docs: DataFrame, notices=BASE_NOTICES + NOTICES) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score`` of every document; the score is the best place's, 0 without any."""
    rows, places = license_places(docs, notices)
    based = lambda c: F.when(F.col("base"), c)
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    found = places.groupBy("uid").agg(
        F.count_if("base").alias("n_base"),
        F.min(based(F.col("start"))).cast("long").alias("first_word"),
        F.max(based(F.col("start"))).cast("long").alias("last_word"),
        joined(based(F.col("label"))).alias("base_labels"), joined(F.col("label")).alias("labels"),
        F.max("score").alias("score"))
    return (rows.join(found, "uid", "left")
                .select("doc_id", "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"),
                        "first_word", "last_word", F.coalesce("base_labels", F.lit("")).alias("base_labels"),
                        F.coalesce("labels", F.lit("")).alias("labels"),
                        F.coalesce("score", F.lit(0.0)).alias("score")))
