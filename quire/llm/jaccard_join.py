"""N-gram Jaccard join: a size-aware heavy-light set similarity join.

A document's set holds its distinct ``k``-word shingles (lower-cased A-Z,
words split at ASCII white space; with fewer words the whole sequence is one
shingle; without words it is empty and linked with nothing). Documents with
sets ``A`` and ``B`` link when ``den * |A & B| >= num * |A | B|``.

* **Sets.** Equal sets are one class (64-bit fingerprint and size); the join
  works on classes, so copies cost nothing further.
* **Small sets** (up to the boundary) are matched by subsets: a pair of sizes
  ``(a, b)`` links exactly when the sets share a subset of the overlap that
  these sizes need, so every set enumerates its subsets of that size and
  classes meeting at one are linked, without any check.
* **Large sets** scan inverted lists: each enters its rarest shingles
  (``size - least overlap + 1`` of them, which cannot all be missed by a
  partner) and list members that pass the size and position bounds are
  candidates, verified on the full sets.
* **Boundary.** The size histogram gives the cost of both ways, subsets
  enumerated against list entries and verifications; the boundary is the size
  with the least total.
* **Order.** Shingles are ordered by frequency, estimated over all documents:
  every block of documents reports the shingles it holds more than once; the
  ``max_hot`` most frequent sums (a bound on what is broadcast) come last in
  the order, all others first by hash. Any order gives the same links; this
  one keeps shared passages out of the lists.
* **Long lists** are never expanded into all pairs. First every member is
  compared with one of a few leaders and its neighbour, streaming, in a few
  shuffled orders. Members that the
  resulting links leave in different components are then paired with each
  other, list by list, so no link between components is lost; pairs inside a
  component would not change the components.
* **Links.** Every link lies inside a component. To count them all, each
  component is dealt into blocks, every two blocks of it meet once, and the
  shared shingles of all their pairs are counted exactly; only sums per class
  leave a pair of blocks.

Null texts are empty; null ids are allowed (a component without any id gets a
null ``component_id``); repeated rows are members of the same class.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import (
    NOT_SPACE, Scratch, Words, connected_components, fresh_names, land, mix, sieve, sieved, signed, text_slices,
    word_grams,
)


RANGES = 64


@dataclass(frozen=True)
class Params:
    k: int = 5
    num: int = 4                  # link at a Jaccard similarity of num / den
    den: int = 5
    hot: int = 16                 # reported count that makes a shingle frequent
    max_hot: int = 1 << 17
    short_list: int = 8           # lists up to this length are paired in full
    leaders: int = 3              # of a longer list, and the times it is shuffled
    turns: int = 4
    list_cost: float = 8.0        # a list entry with its share of checks, in subsets
    max_small: int = 64           # histogram range in which the boundary is sought
    block: int = 64               # classes of a component that are met at once, at least
    part: int = 1 << 14           # members of a list that are starred in one task, about
    sieve_bits: int = 24          # of the filter of texts whose sets are wanted

    def overlap(self, a: int, b: int) -> int:
        """Shared shingles that sizes ``a`` and ``b`` need to link."""
        return -(-self.num * (a + b) // (self.num + self.den))

    def partners(self, n: int) -> range:
        """Sizes that can link with size ``n``."""
        return range(-(-self.num * n // self.den), self.den * n // self.num + 1)

    def prefix(self, n: int) -> int:
        return n - -(-self.num * n // self.den) + 1


def shingle_sets(data: np.ndarray, offs: np.ndarray, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    w = Words(data, offs, NOT_SPACE)
    g, _ = w.grams(k)
    out = []
    for d in range(len(offs) - 1):
        a, b = int(w.first[d]), int(w.first[d + 1])
        if b - a >= k:
            out.append(np.unique(g[a:b - k + 1]))
        elif b > a:
            whole, _ = word_grams(w.hash[a:b], np.array([0, b - a]), b - a)
            out.append(mix(whole + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def fingerprint(s: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        return int(mix(np.array([np.add.reduce(s) + np.uint64(len(s) * 2 + 1)], np.uint64)).view(np.int64)[0])


def fine_counts(s: np.ndarray) -> bytes:
    """Shingles in each of a power of two of ranges, about four in a range: sets
    that have little in common differ in most of them, whatever their size.
    Empty, which bounds nothing, if a count does not fit a byte."""
    bits = min(16, max(6, int(len(s) / 4).bit_length()))
    counts = np.bincount((s >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return counts.astype(np.uint8).tobytes() if counts.max(initial=0) < 256 else b""


def _fits(p: Params):
    """The pairs (rows u, v, n_u, n_v, fine_u, fine_v) that may link: at most the
    smaller count of each range is shared."""
    def run(batches):
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            n = (np.asarray(batch.column(2)).astype(np.int64) + np.asarray(batch.column(3)))
            for i, (x, y) in enumerate(zip(batch.column(4), batch.column(5))):
                x, y = (np.frombuffer(c.as_buffer(), np.uint8) for c in (x, y))
                if len(x) and len(y):
                    least = min(len(x), len(y))
                    x, y = (c.reshape(least, -1).sum(axis=1) for c in (x, y))
                    keep[i] = (p.num + p.den) * int(np.minimum(x, y).sum()) >= p.num * n[i]
            keep = pa.array(keep)
            yield pa.record_batch([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["u", "v"])
    return run


def _survey(k: int):
    """Rows (kind, a, b, n, counts, fine): kind 0 a document (key, fingerprint,
    size, and how many shingles lie in each of equal ranges of the hash space,
    twice, see :func:`fine_counts`), kind 1 a shingle held more than once in a
    block of documents (hash, count)."""
    def run(batches):
        for batch in batches:
            keys = np.array(batch.column(0))
            for i, j, data, offs in text_slices(batch.column(1)):
                sets = shingle_sets(data, offs, k)
                prints = np.array([fingerprint(s) if len(s) else 0 for s in sets], np.int64)
                sizes = np.array([len(s) for s in sets], np.int32)
                t, c = np.unique(np.concatenate(sets), return_counts=True)
                t, c = t[c > 1], c[c > 1]
                owner = np.repeat(np.arange(len(sets)), sizes)
                place = (np.concatenate(sets) >> np.uint64(58)).astype(np.int64)
                counts = np.bincount(owner * RANGES + place, minlength=len(sets) * RANGES).astype(np.int32)
                to = np.r_[np.arange(len(sets) + 1) * RANGES, np.full(len(t), len(counts))]
                yield pa.record_batch(
                    [pa.array(np.r_[np.zeros(len(sets), np.int8), np.ones(len(t), np.int8)]),
                     pa.array(np.r_[keys[i:j], signed(t)]), pa.array(np.r_[prints, c]),
                     pa.array(np.r_[sizes, np.zeros(len(t), np.int32)]),
                     pa.ListArray.from_arrays(pa.array(to.astype(np.int32)), pa.array(counts)),
                     pa.array([fine_counts(s) for s in sets] + [b""] * len(t), pa.binary())],
                    ["kind", "a", "b", "n", "counts", "fine"])
    return run


def boundary(histogram: dict[int, int], p: Params) -> int:
    """The size up to which sets enumerate subsets: the least total cost."""
    top = max([0, *(n for n in histogram if n <= p.max_small)])
    best, at, subsets = None, 0, 0.0
    lists = {n: c * p.list_cost * p.prefix(n) for n, c in histogram.items() if n <= top}
    rest = sum(lists.values())
    for x in range(0, top + 1):
        if x:
            # every partner size may lie below the boundary
            subsets += histogram.get(x, 0) * sum(
                float(comb(x, p.overlap(x, b))) for b in p.partners(x))
            rest -= lists.get(x, 0.0)
        cost = subsets + rest
        if best is None or cost < best:
            best, at = cost, x
    return at


def subset_keys(s: np.ndarray, x: int, p: Params):
    """(key, smaller size) of the subsets by which a small set links with sets
    up to size ``x``."""
    n = len(s)
    tokens = [int(t) for t in s]
    for m in p.partners(n):
        if m < 1 or m > x:
            continue
        a, b = min(n, m), max(n, m)
        salt = (a << 32) + b
        for sub in combinations(tokens, p.overlap(a, b)):
            h = salt
            for t in sub:
                h = (h * 0x9E3779B97F4A7C15 + t) & 0xFFFFFFFFFFFFFFFF
                h ^= h >> 29
            yield h, a


def _entries(hot: np.ndarray, rank: np.ndarray, x: int, p: Params):
    """Rows (key, kind, n, pos, fp): kind 0 a subset of a small set (pos: the
    smaller size of its pair of sizes), kind 1 an entry of an inverted list
    (pos: the shingle's place in the set's order)."""
    bits = 22
    sieve = np.zeros(1 << bits, bool)
    sieve[hot >> np.uint64(64 - bits)] = True

    def run(batches):
        for batch in batches:
            for _, _, data, offs in text_slices(batch.column(0)):
                sets, seen, small = [], set(), []
                for s in shingle_sets(data, offs, p.k):
                    fp = fingerprint(s) if len(s) else 0
                    if not len(s) or fp in seen:
                        continue
                    seen.add(fp)
                    if len(s) <= x:
                        small += [(h, a, len(s), fp) for h, a in subset_keys(s, x, p)]
                    if p.partners(len(s))[-1] > x:
                        sets.append((s, fp))
                cols = [[], [], [], [], []]
                if small:
                    h, a, n, fp = zip(*small)
                    cols = [[np.array(h, np.uint64)], [np.zeros(len(h), np.int8)], [np.array(n, np.int32)],
                            [np.array(a, np.int32)], [np.array(fp, np.int64)]]
                if sets:
                    every = np.concatenate([s for s, _ in sets])
                    order = np.zeros(len(every), np.int32)
                    near = np.flatnonzero(sieve[every >> np.uint64(64 - bits)])
                    if len(near) and len(hot):
                        at = np.searchsorted(hot, every[near])
                        at[at == len(hot)] = 0
                        order[near] = np.where(hot[at] == every[near], rank[at], 0)
                    begin = 0
                    for s, fp in sets:
                        n = len(s)
                        own, begin = order[begin:begin + n], begin + n
                        m = p.prefix(n)
                        pick = s[:m] if not own[:m].any() else s[np.argsort(own, kind="stable")[:m]]
                        cols[0].append(pick)
                        cols[1].append(np.ones(m, np.int8))
                        cols[2].append(np.full(m, n, np.int32))
                        cols[3].append(np.arange(m, dtype=np.int32))
                        cols[4].append(np.full(m, fp, np.int64))
                if cols[0]:
                    key, kind, n, pos, fp = (np.concatenate(c) for c in cols)
                    yield pa.record_batch([pa.array(signed(key)), pa.array(kind), pa.array(n), pa.array(pos),
                                           pa.array(fp)], ["key", "kind", "n", "pos", "fp"])
    return run


ENTRY = "key long, kind byte, n int, pos int, fp long"


def _may_link(n1, i1, n2, i2, p: Params):
    """Size and position bounds: what is left of both sets must suffice."""
    left = np.minimum(n1 - i1, n2 - i2).astype(np.int64)
    fits = p.den * np.minimum(n1, n2).astype(np.int64) >= p.num * np.maximum(n1, n2).astype(np.int64)
    return fits & ((p.num + p.den) * left >= p.num * (n1.astype(np.int64) + n2))


class _Pairs:
    """Meets the members of each run of equal keys (rows sorted by key and kind;
    subsets then by size, lists by fingerprint), with a bounded number of rows
    kept between batches.

    Rows out: kind 0 a link, kind 1 a candidate pair, kind 2 an entry of a
    long list (key in ``a``, fingerprint in ``b``, size and position)."""

    def __init__(self, p: Params):
        self.p = p
        self.out: list[tuple] = []
        self.carry = None      # rows of the run that is still open
        self.long = False      # it is a long list, of which the last row is kept

    def emit(self, kind, a, b, n=None, pos=None):
        z = np.zeros(len(a), np.int32)
        self.out.append((np.full(len(a), kind, np.int8), a, b, z if n is None else n, z if pos is None else pos))

    def run(self, batches):
        for batch in batches:
            rows = [np.asarray(batch.column(c)) for c in range(5)]
            if self.carry is not None:
                rows = [np.concatenate((x, y)) for x, y in zip(self.carry, rows)]
            yield from self.take(rows, False)
        if self.carry is not None:
            yield from self.take(self.carry, True)

    def take(self, rows, final):
        key, kind, n, pos, fp = rows
        same_run = (key[1:] == key[:-1]) & (kind[1:] == kind[:-1])
        fresh = np.r_[True, ~(same_run & (fp[1:] == fp[:-1]) & (n[1:] == n[:-1]))]
        key, kind, n, pos, fp = (x[fresh] for x in (key, kind, n, pos, fp))
        cut = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (kind[1:] != kind[:-1])])
        end = np.r_[cut[1:], len(key)]
        alone = end - cut == 1
        self.carry = None
        for r in np.flatnonzero(~alone | (np.arange(len(cut)) == len(cut) - 1) | (cut == 0)).tolist():
            a, b = int(cut[r]), int(end[r])
            open_end = r == len(cut) - 1 and not final
            if kind[a] == 1 and (self.long or b - a > self.p.short_list):
                first = a + self.long  # the carried row was told before
                self.emit(2, key[first:b], fp[first:b], n[first:b], pos[first:b])
                self.long = open_end
                if open_end:
                    self.carry = [x[b - 1:b] for x in (key, kind, n, pos, fp)]
            elif kind[a] == 0:
                # sets meeting at a subset link when the smaller size of the pair
                # of sizes is among them
                if n[a] == pos[a] and b - a > 1:
                    self.emit(0, np.full(b - a - 1, fp[a]), fp[a + 1:b])
                if open_end:
                    self.carry = [x[a:a + 1] for x in (key, kind, n, pos, fp)]
            elif open_end:
                self.carry = [x[a:b] for x in (key, kind, n, pos, fp)]
            elif b - a > 1:
                i, j = np.triu_indices(b - a, 1)
                i, j = i + a, j + a
                ok = _may_link(n[i], pos[i], n[j], pos[j], self.p)
                self.emit(1, fp[i[ok]], fp[j[ok]])
        if self.out:
            cols = [np.concatenate(c) for c in zip(*self.out)]
            self.out = []
            keep = (cols[0] == 2) | (cols[1] != cols[2])
            if keep.any():
                yield pa.record_batch([pa.array(c[keep]) for c in cols], ["kind", "a", "b", "n", "pos"])


def _stars(p: Params):
    """Candidate pairs of long lists (rows key, turn, fp, n, pos, sorted by key,
    turn and part, and a shuffle of the fingerprints that depends on the turn): a member
    meets the first of a few leaders that it may link with, else becomes a
    leader while there are few; and it meets its neighbour. The shuffle is the
    same in every list, so lists of one group tend to give the same pairs."""
    def run(batches):
        key = turn = last = None
        leaders: list[tuple] = []
        for batch in batches:
            keys, turns, fp, n, pos = (np.asarray(batch.column(c)) for c in range(5))
            out = []
            cut = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (turns[1:] != turns[:-1])])
            for a, b in zip(cut.tolist(), np.r_[cut[1:], len(keys)].tolist()):
                if (keys[a], turns[a]) != (key, turn):
                    key, turn, last, leaders = keys[a], turns[a], None, []
                free = np.arange(a, b)
                for i in range(p.leaders):
                    if not len(free):
                        break
                    if i == len(leaders):
                        leaders.append((n[free[0]], pos[free[0]], fp[free[0]]))
                        free = free[1:]
                    ln, lp, lf = leaders[i]
                    ok = _may_link(np.full(len(free), ln), np.full(len(free), lp), n[free], pos[free], p)
                    out.append((np.full(int(ok.sum()), lf), fp[free[ok]]))
                    free = free[~ok]
                first = last or (n[a], pos[a], fp[a])
                before = [np.r_[[x], y[a:b - 1]] for x, y in zip(first, (n, pos, fp))]
                ok = _may_link(before[0], before[1], n[a:b], pos[a:b], p)
                out.append((before[2][ok], fp[a:b][ok]))
                last = (n[b - 1], pos[b - 1], fp[b - 1])
            u, v = (np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 2
            pair = np.unique(np.stack([np.minimum(u, v), np.maximum(u, v)])[:, u != v], axis=1)
            yield pa.record_batch([pa.array(pair[0]), pa.array(pair[1])], ["u", "v"])
    return run


def _paired(p: Params):
    def run(batches):
        yield from _Pairs(p).run(batches)
    return run


def _carriers(k: int, known, bits: int):
    """(th, fp, s): a set's shingles as bytes, of the texts (rows th, text) that
    may be among the wanted ones."""
    def run(batches):
        for batch in batches:
            keep = pa.array(sieved(known.value, np.array(batch.column(0)), bits))
            some = batch.filter(keep)
            th = np.array(some.column(0))
            for i, _, data, offs in text_slices(some.column(1)):
                sets = shingle_sets(data, offs, k)
                yield pa.record_batch([pa.array(th[i:i + len(sets)]),
                                       pa.array([fingerprint(s) for s in sets], pa.int64()),
                                       pa.array([s.tobytes() for s in sets], pa.binary())], ["th", "fp", "s"])
    return run


def _verified(p: Params):
    def run(batches):
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                n = len(x) + len(y)
                both = n - len(np.unique(np.concatenate((x, y))))
                keep[i] = (p.num + p.den) * both >= p.num * n
            keep = pa.array(keep)
            yield pa.record_batch([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["u", "v"])
    return run


def _alike(n1, n2, shared, p: Params):
    """Whether sizes and a bound of the shared shingles allow a link."""
    return F.lit(p.num + p.den) * shared >= F.lit(p.num) * (n1 + n2)


def _counted(x, y):
    """At most so many shingles are shared: the smaller count in each range."""
    return F.aggregate(F.zip_with(x, y, lambda a, b: F.least(a, b)), F.lit(0), lambda t, c: t + c)


def _verify(near: DataFrame, sets: DataFrame, p: Params) -> DataFrame:
    """The pairs ``(u, v)`` of ``near`` that link by their full sets."""
    return (near.join(sets.select(F.col("fp").alias("u"), F.col("s").alias("x")), "u")
                .join(sets.select(F.col("fp").alias("v"), F.col("s").alias("y")), "v")
                .select("u", "v", "x", "y").mapInArrow(_verified(p), "u long, v long"))


COLUMNS = 1 << 12


def _shared(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Shared shingles of each set of ``x`` with each of ``y``, by products of
    0/1 matrices of a bounded number of shingles."""
    known = np.intersect1d(np.concatenate(x), np.concatenate(y))

    def places(sets):
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        every = np.concatenate(sets)
        at = np.minimum(np.searchsorted(known, every), max(0, len(known) - 1))
        hit = known[at] == every if len(known) else np.zeros(len(every), bool)
        return row[hit], at[hit]

    (xr, xc), (yr, yc) = places(x), places(y)
    total = np.zeros((len(x), len(y)), np.int64)
    for c in range(0, len(known), COLUMNS):
        parts = []
        for rows, r, col in ((len(x), xr, xc), (len(y), yr, yc)):
            own = (col >= c) & (col < c + COLUMNS)
            part = np.zeros((rows, min(COLUMNS, len(known) - c)), np.float32)
            part[r[own], col[own] - c] = 1
            parts.append(part)
        total += (parts[0] @ parts[1].T).astype(np.int64)
    return total


def _met_blocks(p: Params):
    """(fp, n): the rows of other classes that a class links with in a pair of
    blocks (rows c, i, j, second, fp, rows, s). A block that meets itself has
    first rows only."""
    def run(table: pa.Table) -> pa.Table:
        second = np.array(table.column("second"))
        fp, weight = np.array(table.column("fp")), np.array(table.column("rows"))
        sets = [np.frombuffer(v.as_buffer(), np.uint64) for v in table.column("s")]
        one, two = np.flatnonzero(~second), np.flatnonzero(second)
        same = table.column("i")[0] == table.column("j")[0]
        if same:
            two = one
        if not len(one) or not len(two):
            return pa.table({"fp": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
        both = _shared([sets[r] for r in one], [sets[r] for r in two])
        size = np.array([len(x) for x in sets], np.int64)
        link = (p.num + p.den) * both >= p.num * (size[one][:, None] + size[two][None, :])
        if same:
            np.fill_diagonal(link, False)
        n = [link @ weight[two]] + ([] if same else [link.T @ weight[one]])
        fps = [fp[one]] + ([] if same else [fp[two]])
        n, fps = np.concatenate(n), np.concatenate(fps)
        return pa.table({"fp": fps[n > 0], "n": n[n > 0].astype(np.int64)})
    return run


def _count_links(found: DataFrame, classes: DataFrame, sets: DataFrame, p: Params, land) -> DataFrame:
    """``fp, links``: the rows of other classes that each class links with."""
    member = found.select(F.col("node").alias("fp"), F.col("component").alias("c")).distinct()
    member = land(member.join(classes.select("fp", "rows"), "fp").join(sets.select("fp", "s"), "fp"),
                  "jaccard-members")
    # larger components only; a block grows with the root of the component, so
    # that both the copies of a set and the sets of a task stay bounded by it
    dealt = (member.groupBy("c").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > p.block)
                   .select("c", F.ceil(F.col("m") / F.greatest(F.lit(float(p.block)), 2 * F.sqrt("m")))
                           .cast("int").alias("blocks")))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    met = (member.join(land(dealt, "jaccard-blocks"), "c", "left")
                 .select("c", "fp", "rows", "s", F.coalesce("blocks", F.lit(1)).alias("blocks"))
                 .withColumn("own", own)
                 .select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
                 .select("c", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                         (F.col("own") > F.col("other")).alias("second"), "fp", "rows", "s"))
    return (met.groupBy("c", "i", "j").applyInArrow(_met_blocks(p), "fp long, n long")
               .groupBy("fp").agg(F.sum("n").alias("links")))


def _labelled(src: DataFrame, p: Params, links: bool, scratch: Scratch) -> DataFrame:
    """``doc_id, th, n_shingles, c`` (and ``n_links``) of the rows ``doc_id, text`` of
    ``src``: the text's hash, its set's size and the component's class."""
    land = scratch.land
    spark = src.sparkSession
    # the key of a row is its text's hash, so repeated and null ids do not matter
    survey = land(src.select(F.xxhash64("text").alias("th"), "text")
                     .mapInArrow(_survey(p.k), "kind byte, a long, b long, n int, counts array<int>, fine binary")
                     .groupBy("kind", "a", "b", "n", "counts", "fine").agg(F.count(F.lit(1)).alias("c")), "jaccard-survey")
    classes = land(survey.where("kind = 0 and n > 0").groupBy(F.col("b").alias("fp"), "n", "counts", "fine")
                         .agg(F.min("a").alias("th"), F.sum("c").alias("rows")), "jaccard-classes")
    hist = {r["n"]: r["count"] for r in classes.where(F.col("n") <= p.max_small).groupBy("n").count().collect()}
    x = boundary(hist, p)
    top = (survey.where("kind = 1").groupBy("a").agg(F.sum(F.col("b") * F.col("c")).alias("c"))
                 .where(F.col("c") >= p.hot).orderBy(F.col("c").desc(), "a").limit(p.max_hot)
                 .select("a", "c").toPandas())  # at most max_hot rows
    hot = top["a"].to_numpy(np.int64).view(np.uint64)
    by = np.argsort(hot)
    rank = (len(hot) - np.arange(len(hot))).astype(np.int32)[by]  # the most frequent comes last
    known = spark.sparkContext.broadcast((hot[by], rank))

    def entries(batches):
        yield from _entries(*known.value, x, p)(batches)

    rows = src.select("text").mapInArrow(entries, ENTRY)
    met = land(rows.repartition("key")
                   .sortWithinPartitions("key", "kind", F.when(F.col("kind") == 0, F.col("n")), "fp")
                   .mapInArrow(_paired(p), "kind byte, a long, b long, n int, pos int"), "jaccard-pairs")
    sure = met.where("kind = 0").select(F.col("a").alias("u"), F.col("b").alias("v"))
    entry = met.where("kind = 2").select(F.col("a").alias("key"), F.col("b").alias("fp"), "n", "pos")
    # a list of any length is starred in parts, dealt anew in every turn
    parts = (entry.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / p.part).cast("int").alias("parts"))
                  .where("parts > 1"))
    turns = F.explode(F.array(*[F.lit(t) for t in range(p.turns)]))
    stars = (entry.join(parts, "key", "left").withColumn("turn", turns)
                  .withColumn("turn", F.col("turn") + p.turns * F.pmod(
                      F.xxhash64("fp", "turn"), F.coalesce("parts", F.lit(1))).cast("int"))
                  .repartition("key", "turn")
                  .sortWithinPartitions("key", "turn", F.when(F.col("turn") % p.turns == 0, F.col("pos")),
                                        F.xxhash64("fp", F.col("turn") % p.turns))
                  .select("key", "turn", "fp", "n", "pos").mapInArrow(_stars(p), "u long, v long"))
    short = met.where("kind = 1").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v"))
    pairs = land(short.union(stars).distinct(), "jaccard-candidates")

    def fit(some: DataFrame, name: str) -> DataFrame:
        """The pairs that may link by sizes and range counts, which came with the survey."""
        counts = classes.select("fp", "fine", F.col("n").alias("size"))
        u, v = (counts.select(*[F.col(c).alias(f"{c}_{t}") for c in counts.columns]) for t in "uv")
        return land(some.join(u, F.col("u") == F.col("fp_u")).join(v, F.col("v") == F.col("fp_v"))
                        .select("u", "v", "size_u", "size_v", "fine_u", "fine_v")
                        .mapInArrow(_fits(p), "u long, v long"), name)

    near = fit(pairs, "jaccard-near")

    def fetch(fps: DataFrame) -> DataFrame:
        """``fp, s`` of classes: full sets, made from one text each. Of the texts
        only those move whose hash may be wanted."""
        wanted = land(classes.join(fps.distinct(), "fp", "left_semi").select("th"), "jaccard-need")
        held = spark.sparkContext.broadcast(sieve(wanted, p.sieve_bits))
        return land(src.select(F.xxhash64("text").alias("th"), "text")
                       .mapInArrow(_carriers(p.k, held, p.sieve_bits), "th long, fp long, s binary")
                       .join(wanted, "th", "left_semi").groupBy("fp").agg(F.first("s").alias("s")), "jaccard-sets")

    either = F.explode(F.array("u", "v")).alias("fp")
    sets = fetch(near.select(either).union(sure.select(either)) if links else near.select(either))
    linked = land(sure.union(_verify(near, sets, p)), "jaccard-links")

    # members of long lists that are still in different components
    found = connected_components(linked, scratch)
    member = land(entry.join(found, F.col("fp") == F.col("node"), "left")
                       .select("key", "fp", "n", "pos", F.coalesce("component", "fp").alias("c")), "jaccard-long")
    split = member.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo != hi")
    member = land(member.join(split.select("key"), "key").join(classes.select("fp", "counts"), "fp"), "jaccard-split")
    one, two = (member.select("key", *[F.col(c).alias(f"{c}{t}") for c in ("fp", "n", "pos", "c", "counts")])
                for t in (1, 2))
    left = F.least(F.expr("n1 - pos1"), F.expr("n2 - pos2"))
    across = (one.join(two, (one["key"] == two["key"]) & (F.col("c1") < F.col("c2"))
                       & (F.lit(p.den) * F.least("n1", "n2") >= F.lit(p.num) * F.greatest("n1", "n2"))
                       & _alike(F.col("n1"), F.col("n2"), left, p)
                       & _alike(F.col("n1"), F.col("n2"), _counted(F.col("counts1"), F.col("counts2")), p))
                 .select(F.least("fp1", "fp2").alias("u"), F.greatest("fp1", "fp2").alias("v")).distinct())
    across = fit(land(across.join(pairs, ["u", "v"], "left_anti"), "jaccard-across"), "jaccard-across-near")
    if not across.isEmpty():
        more = fetch(across.select(either))
        new = land(_verify(across, more, p), "jaccard-across-links")
        if not new.isEmpty():
            found = connected_components(found.select(F.col("node").alias("u"), F.col("component").alias("v")).union(new),
                                         scratch)
            if links:
                sets = sets.union(more.join(sets.select("fp"), "fp", "left_anti"))

    text_set = survey.where("kind = 0").select(F.col("a").alias("th"), F.col("b").alias("fp"),
                                               F.col("n").cast("long").alias("n_shingles"))
    label = (text_set.join(found, F.col("fp") == F.col("node"), "left")
                     .select("th", "fp", "n_shingles", F.coalesce("component", "fp").alias("c")))
    extra = []
    if links:
        extra = ["n_links"]
        others = land(_count_links(found, classes, sets, p, land), "jaccard-counts")
        label = (label.join(classes.select("fp", "rows"), "fp", "left").join(others, "fp", "left")
                      .withColumn("n_links", F.coalesce(F.col("rows") - 1, F.lit(0)) + F.coalesce("links", F.lit(0))))
    return (src.select("doc_id", F.xxhash64("text").alias("th")).join(label, "th")
               .select("doc_id", "th", "n_shingles", "c", *extra))


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))


def link_components(docs: DataFrame, params: Params = Params(), id_col: str = "doc_id",
                    text_col: str = "text", links: bool = False) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs``: its set's
    size and the smallest id reachable by links (its own for an empty set).
    With ``links`` also ``n_links``, the number of other rows it links with."""
    scratch = Scratch()
    rows = land(_labelled(_source(docs, id_col, text_col), params, links, scratch).drop("th"), "jaccard-rows")
    scratch.clear()
    extra = ["n_links"] if links else []
    least = rows.where("n_shingles > 0").groupBy("c").agg(F.min("doc_id").alias("component_id"))
    linked = rows.where("n_shingles > 0").join(least, "c").select("doc_id", "n_shingles", "component_id", *extra)
    alone = rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), *extra)
    return linked.union(alone)


def one_per_group(docs: DataFrame, params: Params = Params(), id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row of every component, all columns as they are: the one with the
    smallest id (null ids last, then the text's hash). Rows that repeat both id
    and text are one document and leave one row, the first by its other columns'
    hash. Rows without words link with nothing; of those only such repeats go."""
    scratch = Scratch()
    rows = _labelled(_source(docs, id_col, text_col), params, False, scratch)
    # an empty set is a component of its own for every id and text
    none = F.col("n_shingles") == 0
    own = F.struct(F.when(~none, F.col("c")).alias("c"), F.when(none, F.col("doc_id")).alias("id"),
                   F.when(none, F.col("th")).alias("th"))
    first = (rows.groupBy(own.alias("own"), "doc_id", "th").agg(F.count(F.lit(1)).alias("n"))
                 .groupBy("own").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th", "n")).alias("k")))
    keep = land(first.select(F.col("k.doc_id").alias("id"), F.col("k.th").alias("th"), F.col("k.n").alias("n")), "jaccard-keep")
    scratch.clear()
    fid, fth, fn, order = fresh_names(docs, "id", "th", "n", "order")
    keep = keep.toDF(fid, fth, fn)
    text_hash = F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    kept = docs.join(keep, F.col(f"`{id_col}`").eqNullSafe(F.col(fid)) & (text_hash == F.col(fth)))
    single = kept.where(F.col(fn) == 1).select(*[F.col(f"`{c}`") for c in docs.columns])
    others = [F.col(f"`{c}`") for c in docs.columns if c not in (id_col, text_col)]
    seen = Window.partitionBy(fid, fth).orderBy(F.xxhash64(*others) if others else F.lit(0))
    repeated = (kept.where(F.col(fn) > 1).withColumn(order, F.row_number().over(seen)).where(F.col(order) == 1)
                    .select(*[F.col(f"`{c}`") for c in docs.columns]))
    return single.union(repeated)
