"""Phrase collocation mining over a prefix-free parse of the corpus.

Texts are lower-cased (A-Z), split at ``.,;:!?`` and line ends into pieces and
those at blanks into words. Per language (null: ``und``) a phrase's count is
all its contiguous occurrences inside pieces, overlaps included.

* **Parse.** A piece is cut into chunks at content triggers: a chunk ends where
  the hash of its last ``max_words - 1`` words is 0 modulo ``period``, and the
  next one begins with those same words. Equal content is cut at equal places,
  so copies and shared passages give equal chunks.
* **Dictionary.** Distinct chunks with their parse frequency: a group-by with
  map-side combine, so a chunk of any frequency is one row per task.
* **Counts.** Phrases are counted inside distinct chunks, weighted by the
  frequency. The overlap belongs to the chunk that it begins: a chunk counts
  the phrases that start before its last ``max_words - 1`` words, the last chunk
  of a piece all of its phrases.
* **Rare phrases** never reach the exact count. First 32 bits of each phrase's
  hash beside its bucket are summed, packed into one binary row per block and
  bucket; phrases whose sum reaches ``min_count`` set a bit in a sieve of
  ``2 ** sieve_bits`` bits. Whatever hits a set bit is then counted by its text.
  The sieve has that one size for any corpus; colliding phrases are counted too
  and fall to the exact threshold, so it never changes the result.
* **Scores.** Every part of a candidate is at least as frequent as it, so the
  parts come from the same table. Products are decimals of 38 digits, exact for
  counts under 10 ** 16.

Null texts are empty. Repeated rows count as often as they stand; ids and other
columns are not read. An empty table has no phrases.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import (
    _LOWER, Words, byte_table, cut_strings, gathered, land, mix, signed, text_slices,
)


@dataclass(frozen=True)
class Params:
    max_words: int = 3         # of a candidate; at least 2
    min_count: int = 10
    contained: int = 50        # drop a phrase when a longer one has this share of its count, in percent
    top: int = 2000            # phrases returned per language
    period: int = 16           # words between content triggers, on average
    sieve_bits: int = 27
    block: int = 8 << 20       # bytes of chunks counted at once
    bucket: int = 1 << 25      # bytes of dictionary per bucket of hashes
    parts: int = 64            # shares in which a language's phrases are ranked first


# Bytes that end a piece, and blanks between words.
PIECE_END = byte_table([*b".,;:!?", *range(0x0A, 0x0E)])
BLANK = byte_table([0x20, 0x09])
WORD = ~(PIECE_END | BLANK)
_EVERY = byte_table(b for b in range(256) if b != 0x20)
_STEP = np.uint64(0x9E3779B97F4A7C15)  # any odd value would do


def _combine(hashes: list[np.ndarray]) -> np.ndarray:
    g = np.zeros(len(hashes[0]), np.uint64)
    with np.errstate(over="ignore"):
        for h in hashes:
            g = mix(g * _STEP + h)
    return g


def _parse(p: Params):
    """Rows (lang, last, chunk) of rows (lang, text)."""
    over = p.max_words - 1

    def run(batches):
        for batch in batches:
            lang = batch.column(0)
            for i, _, data, offs in text_slices(batch.column(1)):
                w = Words(data, offs, WORD)
                n = len(w.start)
                if not n:
                    continue
                ends_before = np.zeros(len(data) + 1, np.int64)
                np.cumsum(PIECE_END[data], out=ends_before[1:])
                begins = np.zeros(n + 1, bool)  # a piece begins with this word
                begins[w.first] = True
                begins[0] = begins[n] = True
                begins[1:n] |= ends_before[w.start[1:]] != ends_before[w.end[:-1]]
                piece = np.flatnonzero(begins)
                first = np.repeat(piece[:-1], np.diff(piece))
                at = np.arange(n)
                window = _combine([np.r_[np.zeros(over - 1 - k, np.uint64), w.hash[:n - (over - 1 - k)]]
                                   for k in range(over)])
                cut = np.flatnonzero((at - first >= over) & ~begins[1:] & (window % np.uint64(p.period) == 0))
                start = np.sort(np.r_[piece[:-1], cut - over + 1])
                end = np.sort(np.r_[piece[1:] - 1, cut])
                # words with one blank after each
                size = w.end - w.start
                to = np.r_[0, np.cumsum(size + 1)]
                text = np.full(int(to[-1]), 0x20, np.uint8)
                kept = _LOWER[data[WORD[data]]]
                text[np.arange(len(kept)) + np.repeat(at, size)] = kept
                doc = np.searchsorted(w.first, start, "right") - 1
                yield pa.record_batch([lang.take(pa.array(doc + i)), pa.array(begins[end + 1]),
                                       cut_strings(text, to[start], to[end + 1] - 1).cast(pa.string())],
                                      ["lang", "last", "chunk"])
    return run


class _Counted:
    """Distinct phrases of the chunks of one language in a block, exactly:
    words are told apart by their bytes, phrases by the numbers of their words.

    ``found[n]`` are places (word numbers) where one occurrence of each phrase
    of ``n`` words starts, and ``count[n]`` their weighted occurrences."""

    def __init__(self, lang: str, last: np.ndarray, freq: np.ndarray, chunks: pa.Array, max_words: int):
        (_, _, self.data, offs), = text_slices(chunks, 1 << 62)
        blank = self.data == 0x20
        before = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum(blank, out=before[1:])
        words = before[offs[1:]] - before[offs[:-1]] + 1  # of each chunk
        past = np.cumsum(words)
        n = int(past[-1])
        # every chunk but the first starts where the one before ends, without a blank
        self.start = np.sort(np.r_[offs[:-1], np.flatnonzero(blank) + 1])
        self.end = np.sort(np.r_[offs[1:], np.flatnonzero(blank)])
        bytes_ = self.data[~blank]
        to = np.zeros(n + 1, np.int64)
        np.cumsum(self.end - self.start, out=to[1:])
        texts = pa.LargeStringArray.from_buffers(n, pa.py_buffer(to), pa.py_buffer(bytes_.tobytes()))
        coded = texts.dictionary_encode()
        self.ids = np.asarray(coded.indices).astype(np.int64)
        known = coded.dictionary
        _, _, data, offs = next(text_slices(known, 1 << 62))
        self.hash = Words(data, offs, _EVERY).hash
        self.salt = np.uint64(zlib.crc32(lang.encode()))
        self.lang = lang
        left = np.repeat(past, words) - np.arange(n)  # words from here to the chunk's end
        weight = np.repeat(freq, words)
        at = np.flatnonzero((left >= max_words) | np.repeat(last, words))
        self.total = int(weight[at].sum())
        self.found, self.count = {}, {}
        key = self.ids[at]
        for k in range(1, max_words + 1):
            if k > 1:
                more = left[at] >= k
                at = at[more]
                key = (name[more] << 32) | self.ids[at + k - 1]
            if not len(at):
                break
            order = np.argsort(key, kind="stable")
            new = np.r_[True, key[order][1:] != key[order][:-1]]
            name = np.empty(len(key), np.int64)
            name[order] = np.cumsum(new) - 1
            cut = np.flatnonzero(new)
            self.found[k] = at[order[cut]]
            self.count[k] = np.add.reduceat(weight[at[order]], cut)

    def hashes(self, k: int) -> np.ndarray:
        at = self.found[k]
        return _combine([np.full(len(at), self.salt + np.uint64(k << 32)),
                         *[self.hash[self.ids[at + j]] for j in range(k)]])


def _by_language(batches: Iterator[pa.RecordBatch], p: Params) -> Iterator[_Counted]:
    for block in gathered(batches, p.block, lambda b: b.nbytes):
        lang, last, chunk, freq = (block.column(i) for i in range(4))
        coded = lang.dictionary_encode()
        which = np.asarray(coded.indices)
        for code, name in enumerate(coded.dictionary.to_pylist()):
            rows = pa.array(np.flatnonzero(which == code))
            yield _Counted(name, np.asarray(last.take(rows)), np.asarray(freq.take(rows)),
                           chunk.cast(pa.large_string()).take(rows), p.max_words)


def _told(p: Params, bits: int):
    """Rows (bucket, hashes, counts): 32 bits of each distinct phrase's hash and
    its count, cut off at ``min_count``, packed by bucket."""
    kind = np.uint8 if p.min_count < 256 else np.uint32

    def run(batches):
        for block in _by_language(batches, p):
            h = np.concatenate([block.hashes(k) for k in block.found])
            c = np.concatenate([np.minimum(block.count[k], p.min_count) for k in block.found])
            order = np.argsort(h)
            h, c = h[order], c[order].astype(kind)
            cuts = np.searchsorted(h >> np.uint64(64 - bits), np.arange((1 << bits) + 1))
            rest = (h >> np.uint64(32 - bits)).astype(np.uint32)
            own = np.flatnonzero(np.diff(cuts))
            yield pa.record_batch(
                [pa.array(own, pa.int32()), pa.array([rest[cuts[b]:cuts[b + 1]].tobytes() for b in own], pa.binary()),
                 pa.array([c[cuts[b]:cuts[b + 1]].tobytes() for b in own], pa.binary())], ["bucket", "h", "c"])
    return run


def _sieved(p: Params, bits: int):
    """The bucket's part of the sieve: set bits of hashes that reach the count."""
    kind = np.uint8 if p.min_count < 256 else np.uint32

    def run(table: pa.Table) -> pa.Table:
        h = np.concatenate([np.frombuffer(x.as_buffer(), np.uint32) for x in table.column("h")])
        c = np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in table.column("c")])
        order = np.argsort(h, kind="stable")
        h, c = h[order], c[order]
        cut = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
        enough = np.add.reduceat(c.astype(np.int64), cut) >= p.min_count
        part = np.zeros(max(8, 1 << (p.sieve_bits - bits)), np.uint8)
        part[h[cut[enough]] >> np.uint32(32 - (p.sieve_bits - bits))] = 1
        return pa.table({"bucket": table.column("bucket").slice(0, 1),
                         "part": pa.array([zlib.compress(np.packbits(part).tobytes(), 1)], pa.binary())})
    return run


def _frequent(p: Params, sieve):
    """Rows (lang, n, gram, f) of phrases whose bit is set, and the number of
    words of each language (n = 0)."""
    def run(batches):
        bits = np.frombuffer(sieve.value, np.uint8)
        for block in _by_language(batches, p):
            cols = [[0], [""], [block.total]]
            yield pa.record_batch([pa.array([block.lang]), *(pa.array(c, t) for c, t in zip(
                cols, (pa.int32(), pa.string(), pa.int64())))], ["lang", "n", "gram", "f"])
            for k, at in block.found.items():
                bit = (block.hashes(k) >> np.uint64(64 - p.sieve_bits)).astype(np.int64)
                hit = np.flatnonzero((bits[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8)) & 1)
                for s in range(0, len(hit), 1 << 17):
                    own = hit[s:s + (1 << 17)]
                    gram = cut_strings(block.data, block.start[at[own]], block.end[at[own] + k - 1])
                    yield pa.record_batch(
                        [pa.array([block.lang] * len(own), pa.string()), pa.array(np.full(len(own), k, np.int32)),
                         gram.cast(pa.string()), pa.array(block.count[k][own])], ["lang", "n", "gram", "f"])
    return run


def parse(docs: DataFrame, params: Params = Params(), text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The dictionary of the prefix-free parse: ``lang, last, chunk, freq``, where
    ``last`` tells chunks that end a piece."""
    if params.max_words < 2:
        raise ValueError("max_words must be at least 2")
    src = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
                      F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    return (src.mapInArrow(_parse(params), "lang string, last boolean, chunk string")
               .groupBy("lang", "last", "chunk").agg(F.count(F.lit(1)).alias("freq")))


def frequent_phrases(docs: DataFrame, params: Params = Params(), text_col: str = "text",
                     lang_col: str = "lang") -> DataFrame:
    """``lang, n, gram, f``: every phrase of up to ``max_words`` words that
    occurs ``min_count`` times or more, and with ``n`` 0 the words of a language."""
    p = params
    spark = docs.sparkSession
    chunks = land(parse(docs, p, text_col, lang_col), "parse").select("lang", "last", "chunk", "freq")
    size = chunks.agg(F.sum(F.length("chunk"))).first()[0] or 0
    bits = min(p.sieve_bits - 3, max(6, (size // p.bucket).bit_length()))
    parts = (chunks.mapInArrow(_told(p, bits), "bucket int, h binary, c binary")
                   .groupBy("bucket").applyInArrow(_sieved(p, bits), "bucket int, part binary"))
    sieve = np.zeros(1 << (p.sieve_bits - 3), np.uint8)
    step = 1 << (p.sieve_bits - 3 - bits)
    for row in parts.toLocalIterator():  # 2 ** sieve_bits bits in all, whatever the corpus
        sieve[row["bucket"] * step:(row["bucket"] + 1) * step] = np.frombuffer(zlib.decompress(row["part"]), np.uint8)
    known = spark.sparkContext.broadcast(sieve.tobytes())
    return (chunks.mapInArrow(_frequent(p, known), "lang string, n int, gram string, f long")
                  .groupBy("lang", "n", "gram").agg(F.sum("f").alias("f"))
                  .where((F.col("n") == 0) | (F.col("f") >= p.min_count)))


def mine_collocations(docs: DataFrame, params: Params = Params(), text_col: str = "text",
                      lang_col: str = "lang") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best phrases of 2 to
    ``max_words`` words of each language.

    A phrase of count ``a`` cut into parts of counts ``l`` and ``r`` scores
    ``floor(1000000 * a * a / (l * r))``; its lowest-scoring cut counts, the
    earliest of equal ones. A phrase that lies in a longer candidate of at least
    ``contained`` percent of its count is dropped. Order: score and count
    descending, then the phrase's UTF-8 bytes.
    """
    p = params
    grams = land(frequent_phrases(docs, p, text_col, lang_col), "phrases")
    words = grams.where("n = 0").select("lang", F.col("f").alias("total"))
    part = grams.where("n > 0").select("lang", F.col("gram").alias("part"), "f")
    cand = (grams.where("n > 1").withColumnsRenamed({"f": "a", "n": "size"})
                 .withColumn("w", F.split("gram", " ")))
    cuts = cand.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "gram", "size", "a", "k", F.concat_ws(" ", F.slice("w", 1, F.col("k"))).alias("head"),
                       F.concat_ws(" ", F.slice("w", F.col("k") + 1, F.col("size") - F.col("k"))).alias("tail"))
    cuts = (cuts.join(part.select("lang", F.col("part").alias("head"), F.col("f").alias("l")), ["lang", "head"])
                .join(part.select("lang", F.col("part").alias("tail"), F.col("f").alias("r")), ["lang", "tail"]))
    whole = {c: F.col(c).cast("decimal(19,0)") for c in "alr"}
    cuts = (cuts.withColumn("num", (whole["a"] * whole["a"]).cast("decimal(32,0)") * F.lit(1000000).cast("decimal(7,0)"))
                .withColumn("den", whole["l"] * whole["r"])
                .withColumn("score", F.expr("cast(num div den as long)")))
    best = (cuts.groupBy("lang", "gram", "size", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")))
    inside = (cand.where("size > 2")
                  .select("lang", "a", "size", "w", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("m"))
                  .select("*", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1)).alias("i"))
                  .select("lang", F.concat_ws(" ", F.slice("w", F.col("i"), F.col("m"))).alias("gram"), "a")
                  .groupBy("lang", "gram").agg(F.max("a").alias("longer")))
    kept = (best.join(inside, ["lang", "gram"], "left")
                .where(F.col("longer").isNull() | (100 * F.col("longer") < p.contained * F.col("a"))))
    # the best of each of ``parts`` shares of a language first, so that the last
    # ranking of a language takes a bounded number of rows
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    share = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(p.parts))).orderBy(*order)
    ranked = (kept.select("lang", F.col("gram").alias("phrase"), "a", "cut.l", "cut.r", "cut.score")
                  .withColumn("rank", F.row_number().over(share)).where(F.col("rank") <= p.top)
                  .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
                  .where(F.col("rank") <= p.top))
    return (ranked.join(words, "lang")
                  .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
                          F.col("total").alias("n"), "score"))
