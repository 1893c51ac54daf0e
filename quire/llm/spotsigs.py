"""SpotSigs document fingerprints.

A signature is the chain of the next few content words that follow a
common-word anchor (articles, prepositions, auxiliaries): such spots are dense
in running prose and rare in navigation, tables and boilerplate. A document's
fingerprint is the sorted set of its signatures' 32-bit hashes; a text without
a chain has one signature, its whole word sequence; a text without words has
none. Likeness is the Jaccard similarity of two fingerprints (1 for two empty
ones).

:func:`near_documents` finds the documents whose fingerprints are alike
(Jaccard of ``num / den`` or more):

1. Equal fingerprints are one class; all that follows is between classes.
2. Classes are partitioned by set length so that like sets lie in one
   partition or in neighbours. Each class posts the rarest signatures of its
   set, as many as two like sets cannot both miss, in its own partition and as
   a visitor in the next.
3. In each list every member is compared with one of them; candidates must
   pass the bounds on set lengths and on positions, then the exact Jaccard.
4. In lists whose members now lie in several components, each member meets the
   next few of an order drawn by hash, twice, which joins most of what is alike.
5. Lists still in several components are compared again, all members of
   different components, dealt over salts; what the parity sketches of two sets
   rule out is not paired. So no link between components is lost, and a large
   group's pairs are not all formed.

Built-in functions only. Null texts are empty. Equal texts have equal
fingerprints. Rows are identified by id and text, so null ids work, and rows
that repeat id and text are each returned, all alike. Documents without words
are like no other.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import Scratch, connected_components, freed_shuffles, land, number_rows, once
from quire.llm.licenses import WORD_BREAK

# Common words of English, German, French and Spanish.
ANCHORS = (
    "the", "a", "an", "of", "in", "to", "and", "is", "was", "are", "be", "been", "for", "that", "with", "on", "at",
    "it", "as", "by", "from", "this", "which", "or",
    "der", "die", "das", "und", "ist", "war", "ein", "eine", "den", "von", "mit", "zu", "auf", "im", "des",
    "le", "la", "les", "un", "une", "du", "et", "est", "de", "que", "qui", "dans", "pour", "pas",
    "el", "los", "las", "una", "y", "es", "en", "por", "con", "del",
)


@dataclass(frozen=True)
class Params:
    num: int = 80                 # like: num / den of the joint signatures
    den: int = 100
    bins: int = 1 << 16           # counters of signatures' frequencies (by hash)
    deal: int = 256               # components (members in a first look) of a list that one salt compares
    tries: int = 8                # next members of a list that one meets in a first look
    run: int = 64                 # members of a component that meet others together


CHAIN = 3     # content words of a signature
REACH = 3     # stretches between anchors a chain may run over
SKETCH = 4    # longs of a set's sketch (a power of two)


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` plus ``out``, the sorted distinct signature hashes (array of int)
    of the string column ``text`` (not null)."""
    spaced = F.concat(F.lit(" "), F.regexp_replace(F.lower(F.col(text)), WORD_BREAK, " "), F.lit(" "))
    # an anchor becomes a mark; what lies between two marks are content words,
    # null where there are none
    marked = F.regexp_replace(spaced, " (?:" + "|".join(ANCHORS) + ")(?= )", "\x01")
    df = once(df, "_s", F.transform(F.split(marked, "\x01"), lambda x: F.nullif(F.btrim(x), F.lit(""))))
    after = lambda k: F.slice("_s", k, F.greatest(F.size("_s") - k + 1, F.lit(0)))
    runs = after(2)
    for k in range(3, 2 + REACH):
        runs = F.zip_with(runs, after(k), lambda x, y: F.concat_ws(" ", x, y))
    chains = F.filter(F.transform(runs, lambda c: F.substring_index(c, " ", CHAIN)), lambda c: c != "")
    hashed = F.array_sort(F.array_distinct(F.transform(chains, lambda c: F.hash(c))))
    whole = F.array_join("_s", " ")
    df = once(df, "_h", hashed)
    prints = (F.when(F.size("_h") > 0, F.col("_h")).when(whole != "", F.array(F.hash(whole)))
               .otherwise(F.expr("cast(array() as array<int>)")))
    return df.withColumn(out, prints).drop("_s", "_h")


def written(prints: Column) -> Column:
    """A fingerprint as text: eight hex digits a signature."""
    return F.array_join(F.transform(prints, lambda x: F.lpad(F.lower(F.hex(x.bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two fingerprints, 0 to 1."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)) \
            .otherwise(both / F.greatest(F.size(a) + F.size(b) - both, F.lit(1)))


# -- documents with like fingerprints ----------------------------------------------

def _set_key() -> list[Column]:
    """128 bits that name a fingerprint."""
    return [F.xxhash64("prints").alias("s1"), F.xxhash64(F.lit(1), "prints").alias("s2")]


def _edges(p: Params) -> list[int]:
    """Least set lengths of the partitions: a set is at most one partition away
    from any it may be like."""
    out = [1]
    while out[-1] < 1 << 31:
        out.append(out[-1] * p.den // p.num + 1)
    return out


def _frequencies(classes: DataFrame, p: Params) -> Column:
    """Array of ``bins`` counts: how many signatures fall into each bin. It only
    orders signatures (rare ones first), so its size need not grow with them."""
    got = (classes.select(F.explode("prints").alias("s")).groupBy(F.pmod("s", F.lit(p.bins)).alias("b"))
                  .agg(F.count(F.lit(1)).alias("n")).collect())  # at most `bins` rows
    counts = [0] * p.bins
    for r in got:
        counts[r["b"]] = r["n"]
    return F.split(F.lit(",".join(map(str, counts))), ",").cast("array<long>")


def _postings(classes: DataFrame, p: Params) -> DataFrame:
    """``part, sig, home, cls, n, pos``: the prefix of every class, in the
    partition of its length and, if that can hold sets like it, as a visitor in
    the next. There it is the shorter set, for which a shorter prefix does."""
    often = _frequencies(classes, p)
    ranked = F.array_sort(F.transform("prints", lambda s: F.struct(
        F.element_at(often, F.pmod(s, F.lit(p.bins)) + 1).alias("often"), s.alias("sig"))))
    edges = F.lit(_edges(p))
    df = classes.select("cls", F.size("prints").alias("n"), ranked.alias("ranked"))
    least = F.floor((F.col("n").cast("long") * p.num + (p.den - 1)) / F.lit(p.den)).cast("int")
    df = once(df.select("cls", "n", F.slice("ranked", F.lit(1), F.col("n") - least + 1).alias("ranked")),
              "part", F.size(F.filter(edges, lambda e: e <= F.col("n"))))
    visits = F.col("n").cast("long") * p.den >= F.element_at(edges, F.col("part") + 1) * F.lit(p.num)
    df = df.select("cls", "n", "part", visits.alias("visits"), F.posexplode("ranked").alias("pos", "x"))
    # all from here on, against a set at least as long
    enough = (F.col("n") - F.col("pos")).cast("long") * (p.num + p.den) >= F.col("n").cast("long") * (2 * p.num)
    home = F.struct(F.col("part"), F.lit(True).alias("home"))
    away = F.struct((F.col("part") + 1).alias("part"), F.lit(False).alias("home"))
    df = df.withColumn("at", F.when(F.col("visits") & enough, F.array(home, away)).otherwise(F.array(home)))
    return df.select(F.explode("at").alias("at"), "cls", "n", "pos", F.col("x.sig").alias("sig")) \
             .select("at.part", "sig", "at.home", "cls", "n", "pos")


def _fits(n1: Column, left1: Column, n2: Column, left2: Column, p: Params) -> Column:
    """Whether sets of these lengths may be alike if a signature is the first
    they share, with so many left from it on: lengths and rests allow it. Like
    sets pass in the list of their first, so that no pair is lost."""
    a, b = n1.cast("long"), n2.cast("long")
    return ((F.least(a, b) * p.den >= F.greatest(a, b) * p.num)
            & (F.least(left1, left2).cast("long") * (p.num + p.den) >= (a + b) * p.num))


def _alike(pairs: DataFrame, classes: DataFrame, p: Params) -> DataFrame:
    """The pairs ``u, v`` whose fingerprints are alike."""
    a = classes.select(F.col("cls").alias("u"), F.col("prints").alias("a"))
    b = classes.select(F.col("cls").alias("v"), F.col("prints").alias("b"))
    both = F.size(F.array_intersect("a", "b"))
    return (pairs.distinct().join(a, "u").join(b, "v")
                 .where(both * (p.num + p.den) >= (F.size("a") + F.size("b")) * p.num).select("u", "v"))


def _neighbours(posts: DataFrame, comps: DataFrame, p: Params, turn: int) -> DataFrame:
    """Candidate pairs for a first look across components: each member of a list
    with the next few of an order drawn by hash (another at each turn), where
    those lie in other components. Their number grows with the members."""
    key = ["part", "sig"]
    rows = (posts.join(comps.withColumnRenamed("node", "cls"), "cls", "left")
                 .select(*key, "home", "cls", "n", (F.col("n") - F.col("pos")).alias("left"),
                         F.coalesce("component", "cls").alias("comp")))
    lists = (rows.groupBy(*key).agg(F.count(F.lit(1)).alias("m"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
                 .where("lo < hi").select(*key, F.ceil(F.col("m") / p.deal).cast("int").alias("salts")))
    drawn = F.xxhash64(F.lit(turn), "sig", "cls")
    dealt = rows.join(lists, key).select("*", drawn.alias("draw"), F.pmod(F.xxhash64("cls", F.lit(turn)), "salts").alias("salt"))
    order = Window.partitionBy(*key, "salt").orderBy("draw").rowsBetween(1, p.tries)
    met = dealt.withColumn("next", F.collect_list(F.struct("comp", "cls", "n", "left", "home")).over(order))
    return (met.select("comp", "cls", "n", "left", "home", F.explode("next").alias("y"))
               .where((F.col("comp") != F.col("y.comp")) & (F.col("home") | F.col("y.home"))
                      & _fits(F.col("n"), F.col("left"), F.col("y.n"), F.col("y.left"), p))
               .select(F.least("cls", "y.cls").alias("u"), F.greatest("cls", "y.cls").alias("v")))


def _sketch(prints: Column) -> Column:
    """``SKETCH`` longs whose bits hold the parity of how many signatures fall on
    them: two sets differ in as many signatures as bits, at least."""
    word = lambda i: F.aggregate(
        F.filter(prints, lambda x: F.shiftright(x, 6).bitwiseAND(F.lit(SKETCH - 1)) == i), F.lit(0).cast("long"),
        lambda out, x: out.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), x.bitwiseAND(F.lit(63)))))
    return F.struct(*[word(i).alias(f"s{i}") for i in range(SKETCH)])


def _across(posts: DataFrame, comps: DataFrame, classes: DataFrame, p: Params) -> DataFrame:
    """Candidate pairs of classes in one list but in different components. Members
    of a component meet the others in runs of about ``p.run``, and only runs with a
    pair that passes the bounds and whose sketches do not rule it out come out."""
    key = ["part", "sig"]
    rows = (posts.join(comps.withColumnRenamed("node", "cls"), "cls", "left")
                 .select(*key, "home", "cls", "n", (F.col("n") - F.col("pos")).alias("left"),
                         F.coalesce("component", "cls").alias("comp")))
    lists = (rows.groupBy(*key).agg(F.count(F.lit(1)).alias("m"), F.min("comp").alias("low"), F.max("comp").alias("high"))
                 .where("low < high").select(*key, F.ceil(F.col("m") / p.run).cast("int").alias("runs")))
    member = F.struct("cls", "home", "n", "left", "sketch")
    groups = (rows.join(lists, key).join(classes.select("cls", _sketch(F.col("prints")).alias("sketch")), "cls")
                  .groupBy(*key, "comp", F.pmod(F.xxhash64(F.lit(0), "cls"), "runs").alias("run"))
                  .agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.max("left").alias("left"), F.max("home").alias("home"),
                       F.collect_list(member).alias("run_of")).drop("run"))
    salts = groups.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / p.deal).cast("int").alias("salts"))
    groups = groups.join(salts, key)
    part = lambda x, salt: groups.select(*key, *[F.col(c).alias(f"{c}{x}") for c in ("comp", "lo", "hi", "left", "home", "run_of")],
                                         salt.alias("salt"))
    one = part(1, F.pmod(F.xxhash64("comp", "run_of"), F.col("salts")).cast("int"))
    two = part(2, F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    # the bounds of the members, as far as the run tells
    near = ((F.col("hi1").cast("long") * p.den >= F.col("lo2").cast("long") * p.num)
            & (F.col("hi2").cast("long") * p.den >= F.col("lo1").cast("long") * p.num)
            & (F.least("left1", "left2").cast("long") * (p.num + p.den) >= (F.col("lo1") + F.col("lo2")).cast("long") * p.num))

    def may(x, y):
        apart = sum((F.bit_count(x["sketch"][f"s{i}"].bitwiseXOR(y["sketch"][f"s{i}"])) for i in range(1, SKETCH)),
                    F.bit_count(x["sketch"]["s0"].bitwiseXOR(y["sketch"]["s0"])))
        return ((x["home"] | y["home"]) & _fits(x["n"], x["left"], y["n"], y["left"], p)
                & (apart.cast("long") * (p.num + p.den) <= (x["n"] + y["n"]).cast("long") * (p.den - p.num)))

    some = F.exists("run_of1", lambda x: F.exists("run_of2", lambda y: may(x, y)))
    met = one.join(two, [*key, "salt"]).where((F.col("comp1") < F.col("comp2")) & (F.col("home1") | F.col("home2")) & near & some)
    pairs = F.flatten(F.transform("run_of1", lambda x: F.transform(
        F.filter("run_of2", lambda y: may(x, y)),
        lambda y: F.struct(F.least(x["cls"], y["cls"]).alias("u"), F.greatest(x["cls"], y["cls"]).alias("v")))))
    return met.select(F.explode(pairs).alias("x")).select("x.u", "x.v")


def _near_classes(prints: DataFrame, p: Params) -> DataFrame:
    """``s1, s2, near_class`` (landed) of every fingerprint that is not empty,
    from ``doc_id, prints``: the smallest id of its component."""
    scratch = Scratch()
    classes = scratch.land(prints.where(F.size("prints") > 0).groupBy("prints").agg(F.min("doc_id").alias("least"))
                                 .withColumn("cls", F.monotonically_increasing_id()), "spot-classes")
    posts = scratch.land(_postings(classes, p), "spot-postings")
    first = F.min(F.when(F.col("home"), F.struct(F.col("cls").alias("u"), F.col("n").alias("nu"),
                                                 (F.col("n") - F.col("pos")).alias("left_u"))))
    lists = (posts.groupBy("part", "sig").agg(F.count(F.lit(1)).alias("m"), first.alias("x"))
                  .where("m > 1 and x is not null").select("part", "sig", "x.*"))
    # one leader a class
    stars = (posts.join(lists, ["part", "sig"])
                  .where((F.col("cls") != F.col("u")) & _fits(F.col("n"), F.col("n") - F.col("pos"), F.col("nu"), F.col("left_u"), p))
                  .select(F.least("cls", "u").alias("u"), F.greatest("cls", "u").alias("v"))
                  .groupBy("v").agg(F.min("u").alias("u")).select("u", "v"))
    comps = connected_components(scratch.land(_alike(stars, classes, p), "spot-links"), scratch)
    for pairs in (lambda: _neighbours(posts, comps, p, 1), lambda: _neighbours(posts, comps, p, 2),
                  lambda: _across(posts, comps, classes, p)):
        more = scratch.land(_alike(pairs(), classes, p), "spot-links")
        if not more.isEmpty():
            comps = connected_components(
                more.union(comps.select(F.col("node").alias("u"), F.col("component").alias("v"))), scratch)
    named = (classes.select("cls", "least", *_set_key())
                    .join(comps.withColumnRenamed("node", "cls"), "cls", "left")
                    .withColumn("component", F.coalesce("component", "cls")))
    least = named.groupBy("component").agg(F.min("least").alias("near_class"))
    out = land(named.join(least, "component").select("s1", "s2", "near_class"), "spot-near")
    scratch.clear()
    return out


def _sources(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"))


def near_documents(docs: DataFrame, params: Params = Params(), id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``doc_id, n_signatures, near_class`` of every document: the smallest id
    reachable over like fingerprints (its own id if it has no words; null if
    none of the component has an id)."""
    prints = with_fingerprint(_sources(docs, id_col, text_col), "text", "prints").select("doc_id", "prints")
    with freed_shuffles(docs.sparkSession):
        near = _near_classes(prints, params)
    return (prints.select("doc_id", F.size("prints").alias("n_signatures"), *_set_key())
                  .join(near.withColumn("known", F.lit(True)), ["s1", "s2"], "left")
                  .select("doc_id", "n_signatures",
                          F.when(F.col("known"), F.col("near_class")).otherwise(F.col("doc_id")).alias("near_class")))


def fingerprint_edits(docs: DataFrame, params: Params = Params(), id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, near_class`` of every document; the edited text has
    the last half of its characters replaced by the first as many of the next
    document (descending id; after the last the first); ``near_class`` as
    :func:`near_documents` gives it."""
    src = _sources(docs, id_col, text_col)
    key = [F.coalesce("doc_id", F.lit(-(1 << 63))).alias("k"), F.xxhash64("doc_id", "text").alias("h")]
    scratch = Scratch()
    with freed_shuffles(docs.sparkSession):
        prints = scratch.land(with_fingerprint(src.select("*", *key), "text", "prints")
                              .select("doc_id", "k", "h", F.length("text").cast("long").alias("n_chars"), "prints"),
                              "spot-prints")
        near = _near_classes(prints, params)
        named = scratch.land(prints.select("doc_id", "k", "h", "n_chars", *_set_key())
                             .join(near.withColumn("known", F.lit(True)), ["s1", "s2"], "left")
                             .select("doc_id", "k", "h", "n_chars", F.when(F.col("known"), F.col("near_class"))
                                     .otherwise(F.col("doc_id")).alias("near_class")), "spot-named")
        order = [F.col("doc_id").desc_nulls_last(), F.col("h")]
        rows = land(number_rows(named, order), "spot-rows")
        scratch.clear()
    n = rows.count()
    ahead = rows.select(F.pmod(F.col("row_no") - 1, F.lit(max(n, 1))).alias("row_no"),
                        F.col("k").alias("nk"), F.col("h").alias("nh"))
    pairs = rows.join(ahead, "row_no").select("row_no", "doc_id", "k", "h", "n_chars", "near_class", "nk", "nh")

    # one row an id and text; both joins read the same exchange of it
    texts = (with_fingerprint(src.select(*key, "text"), "text", "prints")
                .groupBy("k", "h").agg(F.first("text").alias("text"), F.first("prints").alias("prints")))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    after = texts.select(F.col("k").alias("nk"), F.col("h").alias("nh"), F.col("text").alias("next_text"),
                         F.col("prints").alias("next_prints"))
    given = (pairs.join(after, ["nk", "nh"])
                  .select("doc_id", "k", "h", "n_chars", "near_class", F.substring(F.col("next_text"), F.lit(1), half).alias("tail"),
                          "next_prints"))
    edited = F.concat(F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - half).cast("int")), "tail")
    both = once(given.join(texts, ["k", "h"]), "edited", edited).drop("text", "tail")
    out = with_fingerprint(both, "edited", "edited_prints")
    return out.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                      written(F.col("prints")).alias("fingerprint"),
                      written(F.col("edited_prints")).alias("edited_fingerprint"),
                      likeness(F.col("prints"), F.col("edited_prints")).alias("near_edited"),
                      likeness(F.col("prints"), F.col("next_prints")).alias("near_next"), "near_class")
