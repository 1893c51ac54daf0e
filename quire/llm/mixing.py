"""Mixing documents to target domain weights by soft membership.

1. **Features.** A few figures of every whole text (built-in string functions)
   are put into fixed bins.
2. **Posteriors.** A labelled table (id, domain) gives, by one grouped count,
   a naive Bayes model over the bins; every document gets its probability of
   each domain, not a hard label.
3. **Rates.** Document ``i`` with ``n_i`` tokens gets a rate ``r_i >= 0`` so
   that the expected domain totals ``sum r_i n_i p_id`` are the targets; of all
   such rates those nearest to 1. They are ``max(0, 1 + sum_d m_d p_id)`` with a
   multiplier ``m_d`` for each total, found by damped Newton steps; a step
   needs sums over pairs of the few domains only, which Spark sums over all
   documents. The damping (``pull``) goes to zero, so it leaves no gap; the steps
   end when the totals meet the targets. Targets that no rates can meet leave
   the best step's gap, which ``Mix.reached`` tells.
4. **Copies.** A rate is realised as its whole part plus one more copy with
   the probability of its fraction, drawn from a hash of the document.

Only built-in functions run on the executors. Null or empty texts have no
tokens and rate 1 has no effect on totals; they keep the rate their (empty)
features give. Labels of unknown documents or null domains are ignored; with
no usable label there is one domain ``all``. Domains without a target get
target 0. Repeated rows are rated alike (and drawn alike).
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import land, once


@dataclass(frozen=True)
class Params:
    pull: float = 0.1             # weight of staying at the last rates, at first
    steps: int = 24
    tolerance: float = 5e-3       # largest residual, as a part of the target, that ends the steps
    seed: int = 11


def _times(text: Column, chars: str) -> Column:
    """How often any of ``chars`` stands in ``text``."""
    rest = text
    for c in chars:
        rest = F.replace(rest, F.lit(c), F.lit(""))
    return F.length(text) - F.length(rest)


# Upper edges of the share bins, and of the sizes.
_SHARES = (0.0, 0.002, 0.005, 0.01, 0.02, 0.04, 0.08, 0.16, 0.32)
_EDGES: dict[str, tuple[float, ...]] = {
    "length": (0, 16, 64, 128, 256, 512, 1024, 2048, 4096, 8192, 16384, 65536),
    "word_length": (1, 2, 3, 4, 4.5, 5, 5.5, 6, 7, 8, 12),
    "distinct_words": (0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.97),
    "lines": _SHARES, "marks": _SHARES, "bars": _SHARES, "french": _SHARES, "german": _SHARES,
    "spanish": _SHARES,
}


def _figures(text: Column) -> dict[str, Column]:
    n = F.greatest(F.length(text), F.lit(1))
    words = F.split(text, "[ \n]+")
    count = F.greatest(F.size(words), F.lit(1))
    return {
        "length": F.length(text), "word_length": F.length(text) / count,
        "distinct_words": F.size(F.array_distinct(words)) / count,
        "lines": _times(text, "\n") / n, "marks": _times(text, "*#$%&") / n, "bars": _times(text, "|") / n,
        "french": _times(text, "éèêç") / n, "german": _times(text, "äöüß") / n,
        "spanish": _times(text, "ñóí") / n,
    }


def with_bins(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``_tokens`` (words split at blanks and line ends) and
    ``_bins``, an array with the bin of each feature."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    fig = F.struct(*[v.cast("double").alias(k) for k, v in _figures(text).items()])
    out = once(docs, "_fig", fig)

    def bin_of(name: str) -> Column:
        v, found = F.col("_fig")[name], F.lit(len(_EDGES[name]))
        for i, edge in reversed(list(enumerate(_EDGES[name]))):
            found = F.when(v <= edge, F.lit(i)).otherwise(found)
        return found

    words = F.col("_fig")["length"] / F.greatest(F.col("_fig")["word_length"], F.lit(1e-9))
    tokens = F.when(F.length(text) == 0, F.lit(0)).otherwise(F.round(words)).cast("long")
    return once(out.withColumn("_tokens", tokens), "_bins",
                F.array(*[bin_of(k) for k in _EDGES])).drop("_fig")


@dataclass
class Posterior:
    """Naive Bayes over the bins: ``log_prior[d]`` and ``log_share[d][f][bin]``."""
    domains: list[str]
    log_prior: list[float] = field(default_factory=list)
    log_share: list[list[list[float]]] = field(default_factory=list)

    def added(self, df: DataFrame) -> DataFrame:
        """``df`` (with ``_bins``) plus ``_p``: the domains' probabilities, in
        the order of ``domains``."""
        if len(self.domains) == 1:
            return df.withColumn("_p", F.array(F.lit(1.0)))
        logs = []
        for prior, shares in zip(self.log_prior, self.log_share):
            total = F.lit(prior)
            for f, row in enumerate(shares):
                total = total + F.element_at(F.lit(row), F.col("_bins")[f] + 1)
            logs.append(total)
        df = once(df, "_l", F.array(*logs))
        df = once(df, "_top", F.array_max("_l"))
        df = once(df, "_odds", F.transform("_l", lambda x: F.exp(x - F.col("_top"))))
        df = once(df, "_sum", F.aggregate("_odds", F.lit(0.0), lambda a, x: a + x))
        return once(df, "_p", F.transform("_odds", lambda x: x / F.col("_sum"))).drop("_l", "_top", "_odds", "_sum")


def fit_posterior(binned: DataFrame, labelled: DataFrame) -> Posterior:
    """Count the labelled documents' bins; ``labelled`` has ``doc_id, domain``
    (few domains), ``binned`` has ``doc_id`` and ``_bins``."""
    known = (binned.select("doc_id", "_bins")
                   .join(labelled.where("domain is not null").select("doc_id", "domain"), "doc_id")
                   .select("domain", F.posexplode("_bins").alias("f", "b"))
                   .groupBy("domain", "f", "b").agg(F.count(F.lit(1)).alias("n")))
    counts: dict[str, dict] = {}
    for r in known.collect():  # domains x features x bins
        counts.setdefault(r["domain"], {})[r["f"], r["b"]] = r["n"]
    if not counts:
        return Posterior(["all"])
    names = sorted(counts)
    size = {d: sum(n for (f, _), n in counts[d].items() if f == 0) for d in names}
    out = Posterior(names)
    for d in names:
        out.log_prior.append(math.log(size[d] / sum(size.values())))
        out.log_share.append([[math.log((counts[d].get((f, b), 0) + 0.5) / (size[d] + 0.5 * (len(e) + 1)))
                               for b in range(len(e) + 1)] for f, e in enumerate(_EDGES.values())])
    return out


@dataclass
class Mix:
    """What the rates follow from: the domains and their multipliers; and the
    domain shares the rates reach."""
    posterior: Posterior
    natural: list[float]
    targets: list[float]
    multipliers: list[float]
    reached: list[float]

    def rate(self, p: list[Column]) -> Column:
        """Rate of a document with posteriors ``p``."""
        r = F.lit(1.0)
        for m, x in zip(self.multipliers, p):
            r = r + F.lit(float(m)) * x
        return F.greatest(F.lit(0.0), r)


def solve(members: DataFrame, posterior: Posterior, targets: dict[str, float], params: Params) -> Mix:
    """Multipliers of the totals for ``members`` (``_tokens``, ``_p``)."""
    dims = range(len(posterior.domains))
    flat = land(members.select(F.col("_tokens").cast("double").alias("w"),
                               *[F.col("_p")[d].alias(f"p{d}") for d in dims]), "mix")
    ps = [F.col(f"p{d}") for d in dims]
    total = flat.agg(F.sum("w")).first()[0] or 0.0
    if not total:
        return Mix(posterior, [0.0] * len(dims), [0.0] * len(dims), [0.0] * len(dims), [0.0] * len(dims))
    row = flat.agg(*[F.sum(F.col("w") * p).alias(f"s{d}") for d, p in enumerate(ps)]).first()
    natural = [x / total for x in row]
    wanted = [targets.get(d, 0.0) for d in posterior.domains]
    if posterior.domains == ["all"] or not sum(wanted):
        wanted = natural
    wanted = [x / sum(wanted) for x in wanted]
    pairs = [(a, b) for a in dims for b in dims if a <= b]

    def measure(m):
        """Mix, the dual's value (convex; its slope is reached less target) and its curvature."""
        mix = Mix(posterior, natural, wanted, m, natural)
        moved = once(flat, "r", mix.rate(ps))
        got = moved.agg(F.sum(F.col("w") * F.col("r") * F.col("r")),
                        *[F.sum(F.col("w") * F.col("r") * p) for p in ps],
                        *[F.sum(F.when(F.col("r") > 0, F.col("w") * ps[a] * ps[b]).otherwise(0.0)) for a, b in pairs]).first()
        mix.reached = [x / total for x in got[1:1 + len(ps)]]
        curve = np.zeros((len(ps), len(ps)))
        for (a, b), x in zip(pairs, got[1 + len(ps):]):
            curve[a, b] = curve[b, a] = x / total
        return mix, got[0] / total / 2 - sum(x * t for x, t in zip(m, wanted)), curve

    def gap(mix):
        return max(abs(x - t) / max(t, 1e-3) for x, t in zip(mix.reached, wanted))

    mix, value, curve = measure([0.0] * len(dims))
    best, pull = mix, params.pull
    for _ in range(params.steps):
        if gap(best) <= params.tolerance:
            break
        slope = np.array(mix.reached) - np.array(wanted)
        damp = np.diag(pull * np.maximum(natural, 1e-9))
        step = np.linalg.lstsq(curve + damp, -slope, rcond=1e-14)[0]
        new, at, bend = measure([float(x) for x in np.array(mix.multipliers) + step])
        if gap(new) < gap(best):
            best = new
        if at <= value + 1e-12 * max(1.0, abs(value)):
            mix, value, curve, pull = new, at, bend, pull / 10
        else:  # too far: more damping from the same place
            pull = max(pull, 1e-9) * 30
    return best


def copies(rate: Column, key: list[Column], seed: int) -> Column:
    """Whole part of the rate, and one more with its fraction as probability."""
    draw = F.pmod(F.xxhash64(*key, F.lit(seed)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return F.floor(rate + draw).cast("int")


def domain_mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float],
               params: Params = Params(), id_col: str = "doc_id", text_col: str = "text"):
    """(narrow landed table of the documents: ``doc_id, _h, _tokens, _bins, _p``;
    the :class:`Mix`)."""
    binned = land(with_bins(docs.select(F.col(f"`{id_col}`").alias("doc_id"),
                                        F.col(f"`{text_col}`").alias("text")))
                  .select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("_h"), "_tokens", "_bins"), "mix-bins")
    model = fit_posterior(binned, labelled)
    members = land(model.added(binned), "mix-posteriors")
    return members, solve(members, model, targets, params)


def document_rates(docs: DataFrame, labelled: DataFrame, targets: dict[str, float],
                   params: Params = Params()) -> DataFrame:
    """``doc_id, n_tokens, domain`` (the likeliest), ``posterior, rate, copies,
    target_share, reached_share`` of every document; the last two are the shares
    of its domain in the expected tokens, aimed at and reached."""
    members, mix = domain_mix(docs, labelled, targets, params)
    names = F.array(*[F.lit(d) for d in mix.posterior.domains])
    top = F.element_at(names, F.array_position("_p", F.array_max("_p")).cast("int"))
    p = [F.col("_p")[d] for d in range(len(mix.posterior.domains))]
    at = F.array_position("_p", F.array_max("_p")).cast("int")
    share = lambda xs: F.element_at(F.array(*[F.lit(float(x)) for x in xs]), at)
    return (once(members, "rate", mix.rate(p))
                   .select("doc_id", F.col("_tokens").alias("n_tokens"), top.alias("domain"),
                           F.col("_p").alias("posterior"), "rate",
                           copies(F.col("rate"), [F.col("doc_id"), F.col("_h")], params.seed).alias("copies"),
                           share(mix.targets).alias("target_share"), share(mix.reached).alias("reached_share")))


def mixed_documents(docs: DataFrame, labelled: DataFrame, targets: dict[str, float],
                    params: Params = Params(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents (all columns as they are), each as often as its copies.
    Rates are a function of a row's own text, so rows pass through in place."""
    _, mix = domain_mix(docs, labelled, targets, params, id_col, text_col)
    # the row itself stands aside as one column, so its names meet none of these
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{id_col}`").alias("doc_id"),
                      F.col(f"`{text_col}`").alias("text"))
    p = [F.col("_p")[d] for d in range(len(mix.posterior.domains))]
    rated = once(mix.posterior.added(with_bins(row)), "_r", mix.rate(p))
    n = copies(F.col("_r"), [F.col("doc_id"), F.xxhash64(F.coalesce("text", F.lit("")))], params.seed)
    return (once(rated, "_n", n).where("_n > 0")
                 .select("row", F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_copy")).select("row.*"))
