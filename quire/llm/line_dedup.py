"""Line deduplication: exact and near repeats by a segment-partition edit join.

Lines are split at line feeds. A line is dropped when the same line stood
earlier (smaller document id, then smaller line number), or when a line within
``edits`` edits of it has an earlier first place. Lines under ``min_chars``
characters have no near lines; exact repeats of them are dropped from
``exact_chars`` characters on (``None``: as ``min_chars``). Shorter and blank
lines always stay.

Near lines: each distinct line is cut into ``edits + 1`` segments; two lines
within ``edits`` edits share one of the shorter one's segments exactly, at a
place that the lengths and the segment's number leave few choices for. Segments
are indexed by (class of lengths, number, text) and the longer line probes the
classes it may match at those places only, see :func:`segment_rows`; what meets
and agrees in length and in a character signature is checked with a banded edit
distance (the built-in one, which is not bit-parallel). Whether a line has an
earlier near line is found without pairing up whole groups, see
:func:`later_lines`. Lines are told apart by 96 bits of hashes where their texts
do not travel.

Built-in functions only. Null texts have no lines; rows without an id come
last in the order; rows that repeat id and text are one document (their lines
are alike, so all of them lose the same lines).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import Scratch, fresh_names, land, once

NO_ID = (1 << 63) - 1


@dataclass(frozen=True)
class Params:
    edits: int = 2
    min_chars: int = 20           # of lines that may have near lines
    few: int = 8                  # indexed lines under a key that all probes meet
    exact_chars: int | None = None


def _class(n: Column) -> Column:
    """The least length of the class of lengths that ``n`` characters are in."""
    return F.when(n < 16, n).when(n < 64, n - n % 4).when(n < 256, n - n % 8).otherwise(n - n % 16)


def segment_rows(lines: DataFrame, p: Params) -> DataFrame:
    """``key, no, len, own``: the segment keys of each line (``no, line, len``) in
    its own class of lengths and in those of lines up to ``edits`` shorter.
    ``own`` marks the keys a line is indexed under, all are probed.

    The segments' size follows from the class. All but the last begin at a
    multiple of it, the last is the end of the line. Of two lines within ``edits``
    edits the shorter one has a segment ``i`` that no edit touches, with ``i`` edits
    before it and ``edits - i`` at most behind it, which bounds its places in the
    longer one."""
    e = p.edits
    cls, size = F.col("cls"), F.col("size")
    classes = F.array_distinct(F.array(*[_class(F.col("len") - less) for less in range(e + 1)]))
    rows = (lines.select("no", "line", "len", F.explode(classes).alias("cls")).where(cls >= _class(F.lit(p.min_chars)))
                 .withColumn("size", F.floor(cls / (e + 1)).cast("int")))
    # texts are cut once a segment, then the few places of one in that piece
    places = [(-min(i, e - i), i) for i in range(e)]
    pieces = [F.substring("line", size * i + (1 + low), size + (high - low)).alias(f"p{i}")
              for i, (low, high) in enumerate(places)]
    end = F.substring(F.col("line"), F.col("len") - size + 1, size).alias("end")
    rows = once(rows, "x", F.struct(*pieces, end))
    key = lambda i, piece: F.xxhash64(cls, F.lit(i), piece).alias("key")
    keys = [F.struct(key(e, F.col("x.end")), F.lit(True).alias("even"))]
    for i, (low, high) in enumerate(places):
        keys += [F.struct(key(i, F.substring(F.col(f"x.p{i}"), F.lit(shift - low + 1), size)), F.lit(shift == 0).alias("even"))
                 for shift in range(low, high + 1)]
    return (rows.select("no", "len", (cls == _class(F.col("len"))).alias("own"), F.explode(F.array(*keys)).alias("k"))
                .select("k.key", "no", "len", (F.col("own") & F.col("k.even")).alias("own")))


# each a bit of a line's signature
COUNTED = "abcdefghijklmnopqrstuvwxyz0123456789 .,-ETASéèêàâäöüßñóíáçú"


def parities(line: Column) -> Column:
    """The parity of how often each of the counted characters stands in a line. An
    edit changes the counts of two characters at most, so lines within ``e`` edits
    differ in at most ``2 * e`` bits; other lines mostly in more."""
    size, out = F.octet_length(line), F.lit(0).cast("long")
    for i, c in enumerate(COUNTED):
        n = size - F.octet_length(F.replace(line, F.lit(c), F.lit("")))
        odd = F.floor(n / len(c.encode())).cast("long").bitwiseAND(F.lit(1))
        out = out.bitwiseXOR(F.shiftleft(odd, i))
    return out


LEAST_BITS, MOST_BITS = 16, 26


def _texts(need: DataFrame, lines: DataFrame) -> DataFrame:
    """``no, line, first`` of the lines whose ``no`` is in ``need`` (distinct). Most
    texts stay where they are: a bit set of ``2 ** MOST_BITS`` bits (8 MB) at most,
    16 bits a needed line below that, goes to them as a filter."""
    bits = min(max((16 * need.count()).bit_length(), LEAST_BITS), MOST_BITS)
    at = (F.shiftrightunsigned(F.xxhash64("no"), 64 - bits) + 1).alias("at")  # buckets of 32768 bits begin at 1
    bucket, place = F.bitmap_bucket_number("at").alias("bucket"), F.bitmap_bit_position("at")
    held = (need.select(at).select(bucket, place.alias("place")).groupBy("bucket")
                .agg(F.bitmap_construct_agg("place").alias("bits")))
    byte = F.substring(F.col("bits"), F.floor(F.col("place") / 8).cast("int") + 1, F.lit(1))
    is_set = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), F.pmod(F.col("place"), F.lit(8)).cast("int")) == 1
    some = (lines.select("no", "line", "first", at).select("no", "line", "first", bucket, place.alias("place"))
                 .join(F.broadcast(held), "bucket").where(is_set))
    # no semi join: that would be pushed below the filter
    return some.select("no", "line", "first").join(need, "no")


def _near(pairs: DataFrame, texts: DataFrame, p: Params) -> DataFrame:
    """``later`` of the pairs ``later, earlier`` within ``p.edits`` edits."""
    return (pairs.distinct().join(texts.select(F.col("no").alias("later"), F.col("line").alias("x")), "later")
                 .join(texts.select(F.col("no").alias("earlier"), F.col("line").alias("y")), "earlier")
                 .where(F.levenshtein("x", "y", p.edits) >= 0).select("later").distinct())


def later_lines(lines: DataFrame, p: Params, land) -> DataFrame:
    """``no`` of the lines (``no, line, len, first``, distinct) that have a near
    line of an earlier first place.

    Only lines that share a key with another go on, with their texts. Under a
    key of few indexed lines every probe meets all of them. Under the others
    lines first meet the earliest one on either side, which settles groups of
    near copies in one check a line; only lines that are then still open meet
    all the rest."""
    # one exchange of the keys, read for the counts and for what shares one
    rows = segment_rows(lines, p).repartition("key")
    shared = (rows.groupBy("key").agg(F.count_if("own").alias("n"), F.min("no").alias("lo"), F.max("no").alias("hi"),
                                      F.min(F.when(F.col("own"), F.col("len"))).alias("least"), F.max("len").alias("most"))
                  .where("lo < hi and least <= most").select("key", (F.col("n") > p.few).alias("heavy")))
    met = land(rows.join(shared.hint("shuffle_hash"), "key").distinct(), "line-met")
    need = met.select("no").distinct()
    texts = land(_texts(need, lines).withColumn("w", parities(F.col("line"))), "line-texts")
    met = land(met.join(texts.select("no", "w", "first"), "no"), "line-probing")

    def side(rows: DataFrame, x: str) -> DataFrame:
        return rows.select("key", F.col("no").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("len", "own", "w", "first")])

    def alike(x, y):
        return F.bit_count(F.col(x).bitwiseXOR(F.col(y))) <= 2 * p.edits

    def pair(later, earlier):
        return [F.col(later).alias("later"), F.col(earlier).alias("earlier")]

    # an indexed line a, a line b that probes
    longer = F.col("len_b") - F.col("len_a")
    fits = ((longer >= 0) | F.col("own_b")) & (F.abs(longer) <= p.edits) & alike("w_a", "w_b")
    light, heavy = met.where("not heavy"), met.where("heavy")
    few = (side(light.where("own"), "a").join(side(light, "b"), "key")
           .where(fits & (~F.col("own_b") | (F.col("a") < F.col("b"))) & (F.col("first_a") != F.col("first_b")))
           .select(F.when(F.col("first_a") < F.col("first_b"), F.struct(*pair("b", "a")))
                    .otherwise(F.struct(*pair("a", "b"))).alias("x")).select("x.later", "x.earlier"))
    if heavy.isEmpty():
        return _near(few, texts, p).select(F.col("later").alias("no"))
    lead = lambda rows: rows.groupBy("key").agg(F.min(F.struct("first", "no", "w")).alias("lead"))
    led = lambda rows, leads: (
        rows.join(leads, "key").where((F.col("lead.first") < F.col("first")) & alike("lead.w", "w"))
            .select(F.col("no").alias("later"), F.col("lead.no").alias("earlier")))
    indexed = heavy.where("own")
    done = land(_near(few.union(led(heavy, lead(indexed))).union(led(indexed, lead(heavy))), texts, p), "line-done")
    still = lambda rows: rows.join(done.select(F.col("later").alias("no")), "no", "left_anti")
    rest = (side(indexed, "a").join(side(still(heavy), "b"), "key").where((F.col("first_a") < F.col("first_b")) & fits)
                              .select(*pair("b", "a"))
            .union(side(still(indexed), "a").join(side(heavy, "b"), "key")
                   .where((F.col("first_b") < F.col("first_a")) & fits).select(*pair("a", "b"))))
    return done.union(_near(rest, texts, p)).distinct().select(F.col("later").alias("no"))


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    order = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID))
    return (docs.select(order.alias("doc"), F.xxhash64(F.col(f"`{id_col}`").cast("long"), text).alias("key"),
                        F.posexplode(F.split(text, "\n")).alias("pos", "line")))


def repeated_lines(docs: DataFrame, params: Params = Params(), id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``key, doc, dropped, near``: for each document with lines to drop, their
    numbers (from 0, sorted), and how many of them only a near line precedes.
    ``key`` is the hash of id and text, ``doc`` the id."""
    p = params
    scratch = Scratch()
    size, least = F.length("line"), p.min_chars if p.exact_chars is None else p.exact_chars
    long = _lines(docs, id_col, text_col).where(
        (size >= p.min_chars) | ((size >= least) & F.col("line").rlike(r"\S")))
    # (doc, pos) as one number: its minimum stays in a hash aggregate
    place = F.col("doc").cast("decimal(19,0)") * F.lit(1 << 31).cast("decimal(10,0)") + F.col("pos")
    lines = scratch.land(long.groupBy("line").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
                             .select(F.monotonically_increasing_id().alias("no"), "line", F.length("line").alias("len"),
                                     "first", "n"), "lines", {"compression": "zstd"})
    near = later_lines(lines.where(F.col("len") >= p.min_chars), p, scratch.land)
    lid = [F.xxhash64("line").alias("lid"), F.hash("line").alias("lid2")]
    affected = land(lines.select("no", *lid, "first", "n").join(near.withColumn("near", F.lit(True)), "no", "left")
                         .select("lid", "lid2", "first", "n", F.coalesce("near", F.lit(False)).alias("near"))
                         .where("near or n > 1").drop("n"), "line-repeats")
    scratch.clear()
    seen = long.select("key", "doc", "pos", place.alias("at"), *lid)
    # a set: rows that repeat id and text bring every place as often as they stand
    return (seen.join(affected, ["lid", "lid2"]).where(F.col("near") | (F.col("at") != F.col("first")))
                .groupBy("key", "doc").agg(F.array_sort(F.collect_set("pos")).alias("dropped"),
                                           F.count_distinct(F.when(F.col("at") == F.col("first"), F.col("pos"))).alias("near")))


def line_report(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """``doc_id, n_lines, n_dropped, n_near, dropped`` of every document:
    dropped line numbers, and how many first places only a near line precedes."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.xxhash64(F.col("doc_id").cast("long"), text).alias("key"),
                       F.when(F.length(text) > 0, F.size(F.split(text, "\n"))).otherwise(0).cast("long").alias("n_lines"))
    found = repeated_lines(docs, params).drop("doc")
    return (rows.join(found, "key", "left")
                .select("doc_id", "n_lines", F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
                        F.coalesce("near", F.lit(0).cast("long")).alias("n_near"),
                        F.coalesce("dropped", F.expr("cast(array() as array<int>)")).alias("dropped")))


def dedup_lines(docs: DataFrame, params: Params = Params(), id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """The documents (all columns) with the repeated lines cut from the text.
    A null text stays null; a text that loses all lines is empty."""
    key, lost, lines = fresh_names(docs, "key", "dropped", "lines")
    found = repeated_lines(docs, params, id_col, text_col).select(F.col("key").alias(key), F.col("dropped").alias(lost))
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    joined = docs.withColumn(key, F.xxhash64(F.col(f"`{id_col}`").cast("long"), text)).join(found, key, "left")
    split = once(joined, lines, F.split(text, "\n"))
    kept = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains(F.col(lost), i)), "\n")
    cut = F.when(F.col(lost).isNull(), F.col(f"`{text_col}`")).otherwise(kept).alias(text_col)
    return split.select(*[cut if c == text_col else F.col(f"`{c}`") for c in docs.columns])
