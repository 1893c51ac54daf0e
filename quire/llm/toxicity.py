"""Counterfactual-regularised toxicity classifier.

A logistic model over word and word-beginning features, fitted on labelled
rows. For every labelled text that names an identity group, a twin is made
with each identity term swapped for another of its set, and the loss adds
``fairness * (logit(text) - logit(twin))**2``: what a mention alone
contributes is pushed to nothing, so neutral mentions do not raise scores.

Steps: a bounded sample of labelled rows (``max_rows`` a class, documented
below) is picked from the labels alone; Spark counts the features of the
sample by class; the significant ones (at most ``max_features``) are kept;
the sample, reduced to those, is fitted with numpy; the weights (bounded)
go to every task, which scores its whole texts.

Sample bound: ``max_rows`` rows a class, those with the smallest id hashes,
weighted back to the class sizes among all labelled rows. Everything else
(scoring, decisions) covers every row and every character.

Null or empty texts score as texts without any feature. Rows with a null id,
a null label or a label other than 0 and 1 are not learned from. Repeated
label rows count as often as they stand. With one class only, every score is
0 or 1, that class; with no labels 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import ALNUM, Words, fresh_names, land, signed, text_slices

# Identity terms by set; a term is swapped within its set.
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("gay", "straight", "lesbian", "bisexual"), ("transgender", "cisgender"),
    ("black", "white", "asian", "latino"), ("immigrants", "locals"),
    ("disabled", "blind", "deaf"), ("old", "young"),
)

PREFIXES = (3, 4, 5, 6)


@dataclass(frozen=True)
class Params:
    max_rows: int = 8000          # sample bound, rows a class
    max_features: int = 8192
    min_z: float = 4.5            # significance a feature needs
    l2: float = 0.02
    fairness: float = 1.0
    steps: int = 300


@dataclass
class Model:
    bias: float
    features: np.ndarray  # sorted uint64
    weights: np.ndarray

    def logits(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        doc, feat = present(data, offs, self.features)
        return self.bias + np.bincount(doc, self.weights[feat], minlength=len(offs) - 1)


def swap_table(terms=IDENTITY_TERMS) -> dict[str, str]:
    """Each term to the next one of its set."""
    return {w: s[(i + 1) % len(s)] for s in terms for i, w in enumerate(s)}


def feature_hashes(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature hash): words and their first 3 to 6 bytes."""
    w = Words(data, offs, ALNUM, PREFIXES)
    doc = np.repeat(np.arange(len(offs) - 1), np.diff(w.first))
    docs, feats = [doc], [w.hash]
    for h in w.prefix.values():
        has = h != 0
        docs.append(doc[has])
        feats.append(h[has])
    return np.concatenate(docs), np.concatenate(feats)


def present(data: np.ndarray, offs: np.ndarray, features: np.ndarray):
    """Distinct (text number, index of feature) pairs of the known features."""
    doc, h = feature_hashes(data, offs)
    if not len(features) or not len(h):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    bits = 22
    sieve = np.zeros(1 << bits, bool)
    sieve[features >> np.uint64(64 - bits)] = True
    near = np.flatnonzero(sieve[h >> np.uint64(64 - bits)])
    doc, h = doc[near], h[near]
    at = np.searchsorted(features, h)
    at[at == len(features)] = 0
    hit = features[at] == h
    pair = np.unique(doc[hit] * len(features) + at[hit])
    return pair // len(features), pair % len(features)


def lowered(col: pa.Array) -> pa.Array:
    """Lower-cased texts (all scripts), null as empty."""
    import pyarrow.compute as pc
    return pc.utf8_lower(col.fill_null(""))


def swapped(text: str, table: dict[str, str]) -> str | None:
    """The lower-cased text with its identity terms swapped, None without any."""
    import re
    hit = False

    def sub(m):
        nonlocal hit
        other = table.get(m[0])
        hit = hit or other is not None
        return other or m[0]

    out = re.sub(r"[a-z]+", sub, text)
    return out if hit else None


def _sample(docs: DataFrame, labels: DataFrame, p: Params, training) -> tuple[DataFrame, dict]:
    known = (labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("_y"))
                   .where("_id is not null and _y in (0, 1)").where(training(F.col("_id"))))
    sizes = {r["_y"]: r["n"] for r in known.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = [F.xxhash64("_id"), F.col("_id")]
    picked = None
    for y in (0, 1):
        part = known.where(F.col("_y") == y).orderBy(*order).limit(p.max_rows)
        picked = part if picked is None else picked.union(part)
    # at most two classes of max_rows ids: bounded, so broadcast
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("_id"))
    return land(rows.select(F.col("_id").alias("id"), F.col("_y").alias("y"), "text"), "toxic-sample"), sizes


def _count(batches):
    for batch in batches:
        low, y = lowered(batch.column("text")), np.array(batch.column("y"))
        for i, j, data, offs in text_slices(low):
            doc, h = feature_hashes(data, offs)
            if not len(h):
                continue
            order = np.lexsort((doc, h))
            doc, h = doc[order], h[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
            doc, h = doc[new], h[new]
            f, at = np.unique(h, return_index=True)
            pos = np.add.reduceat(y[i:j][doc], at)
            total = np.diff(np.append(at, len(h)))
            yield pa.record_batch([pa.array(signed(f)), pa.array(pos.astype(np.int64)),
                                   pa.array((total - pos).astype(np.int64))], ["f", "pos", "neg"])


def _select(sample: DataFrame, p: Params) -> tuple[np.ndarray, dict]:
    """The significant features: a two-class difference of shares of at least
    ``min_z`` standard deviations, the strongest ``max_features`` of them."""
    n = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    if not n1 or not n0:
        return np.zeros(0, np.uint64), n
    counts = (sample.select("text", "y").mapInArrow(_count, "f long, pos long, neg long")
                    .groupBy("f").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))
    share = (F.col("pos") + F.col("neg")) / F.lit(n1 + n0)
    z = (F.col("pos") / n1 - F.col("neg") / n0) / F.sqrt(
        share * (1 - share) * (1 / n1 + 1 / n0) + F.lit(1e-12))
    best = (counts.where("pos + neg >= 3").withColumn("z", F.abs(z)).where(F.col("z") >= p.min_z)
                  .orderBy(F.col("z").desc(), "f").limit(p.max_features).select("f"))
    f = np.array([r["f"] for r in best.collect()], np.int64).view(np.uint64)  # at most max_features
    return np.sort(f), n


def _reduce(features: np.ndarray, table: dict[str, str]):
    def run(batches):
        for batch in batches:
            low, y = lowered(batch.column("text")), batch.column("y").to_pylist()
            out = []
            for i, j, data, offs in text_slices(low):
                doc, feat = present(data, offs, features)
                twins = [swapped(t, table) for t in low.slice(i, j - i).to_pylist()]
                has = [k for k, t in enumerate(twins) if t is not None]
                tw = {}
                if has:
                    for a, b, d2, o2 in text_slices(pa.array([twins[k] for k in has])):
                        d, f = present(d2, o2, features)
                        for k in range(a, b):
                            tw[has[k]] = f[d == k - a].tolist()
                cut = np.searchsorted(doc, np.arange(j - i + 1))
                for k in range(j - i):
                    out.append((y[i + k], feat[cut[k]:cut[k + 1]].tolist(), tw.get(k)))
            ys, fs, ts = zip(*out) if out else ((), (), ())
            yield pa.record_batch([pa.array(ys, pa.int32()), pa.array(fs, pa.list_(pa.int32())),
                                   pa.array(ts, pa.list_(pa.int32()))], ["y", "f", "t"])
    return run


def _fit(rows, n_features: int, sizes: dict, n: dict, p: Params) -> tuple[float, np.ndarray]:
    """Weighted logistic regression with L2 and the counterfactual penalty,
    by gradient descent with momentum and a diagonal scale."""
    y = np.array([r["y"] for r in rows], float)
    lens = [len(r["f"]) for r in rows]
    doc = np.repeat(np.arange(len(rows)), lens)
    feat = np.array([i for r in rows for i in r["f"]], np.int64)
    # a text minus its twin: +1 and -1 entries
    pdoc = np.array([k for k, r in enumerate(rows) if r["t"] is not None
                     for _ in range(len(r["f"]) + len(r["t"]))], np.int64)
    pfeat = np.array([i for r in rows if r["t"] is not None for i in [*r["f"], *r["t"]]], np.int64)
    psign = np.array([s for r in rows if r["t"] is not None
                      for s in [1.0] * len(r["f"]) + [-1.0] * len(r["t"])])
    weight = np.where(y == 1, sizes[1] / n[1], sizes[0] / n[0])
    weight = weight / weight.sum()
    pairs = max(1, sum(r["t"] is not None for r in rows))
    w, b = np.zeros(n_features), float(np.log((sizes[1] + .5) / (sizes[0] + .5)))
    m, v, mb, vb = np.zeros(n_features), np.zeros(n_features), 0.0, 0.0
    scale = p.l2 / max(1, n_features)
    for t in range(1, p.steps + 1):
        z = b + np.bincount(doc, w[feat], minlength=len(rows))
        r = weight * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y)
        g = np.bincount(feat, r[doc], minlength=n_features) + scale * w
        if len(pdoc):
            d = np.bincount(pdoc, psign * w[pfeat], minlength=len(rows)) * (2 * p.fairness / pairs)
            g += np.bincount(pfeat, psign * d[pdoc], minlength=n_features)
        gb = r.sum()
        m, mb = .9 * m + .1 * g, .9 * mb + .1 * gb
        v, vb = .99 * v + .01 * g * g, .99 * vb + .01 * gb * gb
        rate = .2 * (1 - t / (p.steps + 1))
        w -= rate * (m / (1 - .9 ** t)) / (np.sqrt(v / (1 - .99 ** t)) + 1e-9)
        b -= rate * (mb / (1 - .9 ** t)) / (np.sqrt(vb / (1 - .99 ** t)) + 1e-9)
    return b, w


def train(docs: DataFrame, labels: DataFrame, params: Params = Params(),
          training=lambda i: F.lit(True), terms=IDENTITY_TERMS) -> Model:
    """Fit on the labelled rows whose id satisfies ``training``."""
    sample, sizes = _sample(docs, labels, params, training)
    features, n = _select(sample, params)
    if not n.get(0) or not n.get(1):
        return Model(40.0 if n.get(1) else -40.0, np.zeros(0, np.uint64), np.zeros(0))
    rows = (sample.select("text", "y")
                  .mapInArrow(_reduce(features, swap_table(terms)), "y int, f array<int>, t array<int>")
                  .collect())  # the bounded sample, reduced to its significant features
    bias, weights = _fit(rows, len(features), sizes, n, params)
    return Model(bias, features, weights)


def score(df: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None,
          out: str = "score") -> DataFrame:
    """The ``keep`` columns (default all) and the score ``out``, 0 to 1."""
    keep = df.columns if keep is None else keep
    # the closure carries the model: at most max_features numbers
    own, = fresh_names(df, "text")
    src = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").alias(own))

    def run(batches):
        for batch in batches:
            low = lowered(batch.column(len(keep)))
            z = np.full(len(low), model.bias)
            for i, j, data, offs in text_slices(low):
                z[i:j] = model.logits(data, offs)
            p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
            yield pa.record_batch([*batch.columns[:len(keep)], pa.array(p)], names=[*keep, out])

    from pyspark.sql.types import DoubleType, StructType
    schema = StructType([src.schema[i] for i in range(len(keep))]).add(out, DoubleType())
    return src.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """The rows never learned from: CRC-32 of the id's text divisible by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def score_documents(docs: DataFrame, labels: DataFrame, params: Params = Params()) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    model = train(docs, labels, params, lambda i: ~held_out(i))
    scored = score(docs, model, keep=["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
