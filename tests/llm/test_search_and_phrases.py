"""Operators 11 to 13 against plain Python on small tables with odd rows."""

import math
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from quire.llm import collocations, lexical_search, topk_search
from quire.llm.queries import ORACLE_SQL

LOWER = str.maketrans({c: chr(c + 32) for c in range(65, 91)})


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, x) for x in r))


# -- exact top-k search ---------------------------------------------------------

def plain_topk(vectors, k):
    own = [(i, v, [math.floor(Fraction(x) * 256) for x in e]) for i, (v, e) in enumerate(vectors)
           if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for i, qid, q in own:
        if qid is None or qid % 50:
            continue
        scored = [(sum(a * b for a, b in zip(q, v)), vid, j) for j, vid, v in own if j != i]
        scored = [(max(min(s, 2 ** 63 - 1), -2 ** 63), vid, j) for s, vid, j in scored]
        scored.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0, x[2]))
        out += [(qid, rank + 1, vid, s) for rank, (s, vid, _) in enumerate(scored[:k])]
    return sorted(out, key=lambda r: tuple((x is None, x) for x in r))


def vector_table(spark, vectors, kind="float"):
    return spark.createDataFrame([(v, e, 7, "x") for v, e in vectors],
                                 f"vec_id long, embedding array<{kind}>, row long, _n string")


def odd_vectors(seed, n=400, dim=6):
    r = np.random.default_rng(seed)
    base = r.normal(size=(8, dim))
    vec = (base[r.integers(0, 8, n)] + r.normal(scale=0.2, size=(n, dim))).astype(np.float32)
    out = [(int(i), [float(x) for x in v]) for i, v in enumerate(vec)]
    same = [float(x) for x in vec[3]]
    out += [(1000 + i, same) for i in range(150)]          # one very common vector
    out += [(50, out[50][1]), (50, out[50][1]), (100, [0.0] * dim), (None, out[0][1]), (None, same)]
    out += [(150, None), (200, [1.0, None] + [0.0] * (dim - 2)), (250, [float("nan")] * dim),
            (300, [float("inf")] + [0.0] * (dim - 1)), (350, []), (400, [0.5, 0.5]), (-50, out[7][1])]
    return out


@pytest.mark.parametrize("params", [
    topk_search.Params(), topk_search.Params(k=3, pivots=4, sample=16, block=32, group=4, first_step=2),
    topk_search.Params(k=40, pivots=1, block=16, group=2, first_step=1)])
def test_topk_equals_brute_force(spark, params):
    vectors = odd_vectors(1)
    got = rows(topk_search.search(vector_table(spark, vectors), params))
    assert got == plain_topk(vectors, params.k)


def test_topk_of_huge_components_is_exact(spark):
    r = np.random.default_rng(5)
    vectors = [(i, [float(x) for x in r.normal(size=3) * 10.0 ** r.integers(0, 12)]) for i in range(120)]
    got = rows(topk_search.search(vector_table(spark, vectors, "double")))
    assert got == plain_topk(vectors, 5)


def test_topk_of_few_or_no_vectors(spark):
    assert rows(topk_search.search(vector_table(spark, []))) == []
    assert rows(topk_search.search(vector_table(spark, [(0, [1.0])]))) == []
    assert rows(topk_search.search(vector_table(spark, [(0, [1.0]), (1, [0.5])]))) == [(0, 1, 1, 256 * 128)]


# -- collocations -----------------------------------------------------------------

def plain_phrases(docs, max_words, min_count, contained, top):
    f, total = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for n in range(1, max_words + 1):
                for i in range(len(w) - n + 1):
                    f[lang, tuple(w[i:i + n])] += 1
    cand = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= min_count}
    by_lang = {}
    for (lang, w), a in cand.items():
        if any(100 * b >= contained * a and len(x) > len(w) and any(x[i:i + len(w)] == w for i in range(len(x)))
               for (xl, x), b in cand.items() if xl == lang):
            continue
        score, k = min((10 ** 6 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w)))
        by_lang.setdefault(lang, []).append((score, a, " ".join(w), f[lang, w[:k]], f[lang, w[k:]]))
    out = []
    for lang, found in by_lang.items():
        found.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, i + 1, p, a, left, r, total[lang], s) for i, (s, a, p, left, r) in enumerate(found[:top])]
    return sorted(out)


def phrase_docs():
    r = np.random.default_rng(2)
    words = ["the", "The", "of", "new", "york", "city", "Ünder", "x-y", "a", "b", "é"]
    docs = []
    for i in range(300):
        n = int(r.integers(0, 60))
        sep = r.choice([" ", "  ", "\t", ", ", ".", "\n", "!? "], size=n, p=[.8, .05, .03, .05, .03, .02, .02])
        text = "".join(words[j] + s for j, s in zip(r.zipf(1.4, n) % len(words), sep))
        docs.append((["en", "de", None][i % 3], text))
    docs += [("en", None), ("en", ""), ("en", " \t .,;"), (None, None), ("", "new york city " * 30)]
    docs += [("en", "new york city hall, near the new york city park. ")] * 40
    docs += [("en", "a " * 4000), ("fr", "word" * 2000), ("fr", "a b c d e f g h " * 3000 + "end")]
    docs += [("es", "non break a\x0bb\x0cc \x01 " * 15)]
    return docs


@pytest.mark.parametrize("params", [
    collocations.Params(), collocations.Params(min_count=3, period=2, sieve_bits=12, block=1 << 12, bucket=1 << 10, top=50),
    collocations.Params(max_words=4, min_count=300, contained=90, period=4, sieve_bits=9),
    collocations.Params(max_words=2, min_count=2, period=1)])
def test_collocations_equal_brute_force(spark, params):
    docs = phrase_docs()
    df = spark.createDataFrame([(x, t, "n", 1) for x, t in docs], "lang string, text string, gram string, freq int")
    got = sorted(tuple(r) for r in collocations.mine_collocations(df, params).collect())
    assert got == plain_phrases(docs, params.max_words, params.min_count, params.contained, params.top)


def test_parse_counts_every_copy_once(spark):
    docs = spark.createDataFrame([("en", "one two three four five six, seven")] * 50, "lang string, text string")
    found = collocations.parse(docs, collocations.Params(period=2)).collect()
    assert {r["freq"] for r in found} == {50}


def test_collocations_of_an_empty_table(spark):
    assert collocations.mine_collocations(spark.createDataFrame([], "lang string, text string")).collect() == []


# -- lexical search -----------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_ranks(docs, items, k):
    tf = [Counter(TERM.findall((t or "").translate(LOWER))) for _, t in docs]
    n = [sum(c.values()) for c in tf]
    big_n, big_l = sum(x > 0 for x in n), sum(n)
    df = Counter(t for c in tf for t in c)
    out = []
    for item, text in items:
        scored = []
        for (doc, _), c, own in zip(docs, tf, n):
            if not own:
                continue
            m = 100 - 25 + 25 * own * big_n // big_l
            s = sum(math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1)))
                    * (10 ** 9 * c[t] // (1000 * c[t] + 12 * m))
                    for t in TERM.findall((text or "").translate(LOWER)) if c[t])
            if s > 0:
                scored.append((-s, doc is None, doc or 0))
        scored.sort()
        out += [(item, i + 1, None if none else d, -s) for i, (s, none, d) in enumerate(scored[:k])]
    return sorted(out, key=lambda r: tuple((x is None, x) for x in r))


def search_docs():
    r = np.random.default_rng(3)
    vocab = [f"w{i}" for i in range(60)] + ["Straße", "ÉTÉ", "naïve", "it", "s"]
    docs = []
    for i in range(400):
        size = int(r.integers(0, 80))
        docs.append((int(i), " ".join(vocab[j] for j in r.zipf(1.3, size) % len(vocab))))
    docs += [(5000 + i, "w1 w2 it's naïve") for i in range(90)]          # ties
    docs += [(7, docs[7][1]), (None, "w1 w2 w3"), (None, "w1 w2 w3"), (None, None), (9000, None), (9001, ""),
             (9002, "-- !!"), (9003, "w3 " * 20000 + "w4"), (9004, "W5-w5_w5")]
    return docs


ITEMS = [(1, "W1 w2 w2, w9"), (2, "it's naïve Straße straße ÉTÉ été"), (3, None), (4, ""), (5, "unknown words only"),
         (6, "w3"), (7, " ".join(f"w{i}" for i in range(60))), (1, "W1 w2 w2, w9"), (None, "w4 w5")]


@pytest.mark.parametrize("params", [
    lexical_search.Params(), lexical_search.Params(k=3, block=200, block_docs=20, item_block=2, met=1, first_step=1),
    lexical_search.Params(k=500, block=1, sieve_bits=4, first_step=2)])
def test_search_equals_brute_force(spark, params):
    docs = search_docs()
    d = spark.createDataFrame([(i, t, "x", 3) for i, t in docs], "doc_id long, text string, item string, rank int")
    items = spark.createDataFrame([(i, t, 0.5) for i, t in ITEMS], "item_id long, text string, term double")
    assert rows(lexical_search.search(d, items, params)) == plain_ranks(docs, ITEMS, params.k)


def test_search_of_empty_tables(spark):
    d, items = "doc_id long, text string", "item_id long, text string"
    none, one = spark.createDataFrame([], d), spark.createDataFrame([(1, "a b")], d)
    asked = spark.createDataFrame([(1, "a")], items)
    assert lexical_search.search(none, asked).collect() == []
    assert lexical_search.search(one, spark.createDataFrame([], items)).collect() == []
    assert lexical_search.search(spark.createDataFrame([(1, None)], d), asked).collect() == []


def test_nra_reads_no_further_than_needed():
    reads = []

    class Told(np.ndarray):
        def __getitem__(self, at):
            if isinstance(at, slice):
                reads.append(at.stop)
            return np.asarray(super().__getitem__(at))
    doc, value = np.arange(1000).view(Told), np.arange(1000, 0, -1) ** 2
    got = lexical_search.nra([(doc, value)], 1000, 3, 4)
    assert sorted(got[0].tolist())[:3] == [0, 1, 2] and max(reads) < 50


def test_new_queries_have_sql():
    assert {"op11_topk_search", "op12_collocations", "op13_lexical_search"} <= set(ORACLE_SQL)
