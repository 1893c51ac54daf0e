"""Removal of repeated byte strings across documents, by sampled suffixes.

Every byte covered by a ``length``-byte string that also starts in a document
with a smaller id is removed. Full suffix sorting compares suffixes to any
depth; here ``length`` bytes decide, so the difference-cover scheme is used to
that depth:

1. **Sample.** Of all positions only a cover is sorted: positions chosen so
   that two equal strings always hold a sampled position at the same offset.
   A cover by residues (a difference cover) does that; one chosen by content,
   the position with the smallest hash of its ``seed`` bytes in each string,
   does it with a third as many positions.
2. **Name and sort.** A sampled position is named by its seed and by its
   context, all bytes of the strings that hold it. Spark sorts by name and
   document; equal contexts are adjacent, and all but the ones of the smallest
   document are repeats together with every string around them.
3. **Merge the rest.** Where one seed has several contexts, the strings around
   it are named themselves, by all their ``length`` bytes, and sorted; adjacent
   equal names of different documents are repeats.
4. The covered bytes of each document are united and cut out.

Nothing is gathered by name: sorted runs are streamed and only the smallest
document and its positions are kept, and copies are combined inside every
block of documents before they are sorted, so a text that makes a third of all
rows costs a run of one entry a block.

Texts are their UTF-8 bytes (null: none); documents shorter than ``length``
lose nothing. Rows with equal ids never remove each other; rows without an id
come after all others. Rows that repeat id and text are all returned, alike.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import _BASE, _power_tables, land, mix, signed, text_slices


@dataclass(frozen=True)
class Params:
    length: int = 50
    seed: int = 26


NO_ID = (1 << 63) - 1


class Sums:
    """Hashes of any byte range of a block in constant time."""

    def __init__(self, data: np.ndarray):
        self.n = len(data)
        up, self.down = _power_tables(self.n + 1)
        self.total = np.zeros(self.n + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=self.total[1:])

    def hashes(self, start: np.ndarray, end: np.ndarray, salt=0) -> np.ndarray:
        with np.errstate(over="ignore"):
            h = (self.total[end] - self.total[start]) * self.down[start]
            return mix(h + np.asarray(salt, np.uint64) * np.uint64(_BASE))


def sampled(sums: Sums, offs: np.ndarray, p: Params) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the sample and their seed hashes. In every string of
    ``length`` bytes the first seed with the smallest hash is sampled."""
    k, w = p.seed, p.length - p.seed + 1
    n = sums.n - p.length + 1          # strings in the block, over text ends too
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.arange(sums.n - k + 1)
    h = sums.hashes(at, at + k)
    least = (h & np.uint64(~((1 << 31) - 1) & ((1 << 64) - 1))) | at.astype(np.uint64)
    span = 1
    while span * 2 <= w:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < w:
        least = np.minimum(least[:len(least) - (w - span)], least[w - span:])
    least = least[:n]
    inside = np.zeros(n + 1, np.int64)  # strings that lie in one text
    lens = np.diff(offs)
    long = lens >= p.length
    np.add.at(inside, offs[:-1][long], 1)
    np.add.at(inside, offs[1:][long] - p.length + 1, -1)
    least = least[np.cumsum(inside[:n]) > 0]
    if not len(least):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    new = np.r_[True, least[1:] != least[:-1]]
    pos = np.unique((least[new] & np.uint64((1 << 31) - 1)).astype(np.int64))
    return pos, h[pos]


def _sample(p: Params):
    """(seed, context, pos, doc, key) of the sample of the texts; contexts met
    again in a larger document of the block come as (null, null, pos, doc, key).
    Seeds are named by 48 bits: two seeds of one name have several contexts, so
    their strings are compared. What repeats along a document comes last, where
    it compresses to nothing."""
    reach = p.length - p.seed

    def run(batches):
        for batch in batches:
            doc, key = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            parts = []
            for i, _, data, offs in text_slices(batch.column(2), 1 << 20):
                sums = Sums(data)
                pos, h = sampled(sums, offs, p)
                if not len(pos):
                    continue
                own = np.searchsorted(offs, pos, "right") - 1
                begin, end = offs[own], offs[own + 1]
                left, right = np.maximum(begin, pos - reach), np.minimum(end, pos + p.seed + reach)
                ctx = sums.hashes(left, right, (pos - left) * 4096 + (right - pos))
                parts.append((signed(h >> np.uint64(16)), signed(ctx), doc[i + own], key[i + own], pos - begin))
            if not parts:
                continue
            h, ctx, d, k, pos = (np.concatenate(x) for x in zip(*parts))
            order = np.lexsort((d, ctx, h))
            first = np.r_[True, (h[order][1:] != h[order][:-1]) | (ctx[order][1:] != ctx[order][:-1])]
            least = np.empty_like(d)
            least[order] = d[order][np.flatnonzero(first)][np.cumsum(first) - 1]
            again = d > least  # rows stay in document order, in which ids compress well
            yield pa.record_batch([pa.array(h, mask=again), pa.array(ctx, mask=again), pa.array(pos.astype(np.int32)),
                                   pa.array(d), pa.array(k)], ["h", "ctx", "pos", "doc", "key"])
    return run


def _repeats(batches):
    """Rows (key, at) from rows sorted by seed, context and document: ``at`` is
    twice the position, plus 1 where the context is not a repeat but its seed
    has other contexts, so that its strings have to be compared."""
    run = group = None          # open run's seed, open group's (context, least document)
    several = False             # the open run has several contexts
    held: list = []             # its first entries, while it has one context
    for batch in batches:
        h, ctx, pos, doc, key = (np.asarray(batch.column(c)) for c in range(5))
        n = len(h)
        if not n:
            continue
        new_run = np.r_[run is None or h[0] != run, h[1:] != h[:-1]]
        new_group = new_run | np.r_[group is None or ctx[0] != group[0], ctx[1:] != ctx[:-1]]
        starts = np.flatnonzero(new_group)
        number = np.cumsum(new_group)
        least = np.r_[np.int64(0) if group is None else np.int64(group[1]), doc[starts]][number]
        repeat = doc > least
        runs = np.cumsum(new_run)                       # 0: the run open before
        groups = np.bincount(runs, weights=new_group, minlength=int(runs[-1]) + 1)
        multi = groups >= 2
        multi[0] = several or groups[0] >= 1            # any further context
        out_key, out_at = [key[repeat]], [pos[repeat].astype(np.int64) * 2]
        if held and (multi[0] and run is not None):
            out_key.append(np.concatenate([x[0] for x in held]))
            out_at.append(np.concatenate([x[1] for x in held]) * 2 + 1)
            held = []
        if runs[-1] > 0:
            held = []
        ask = ~repeat & multi[runs]
        out_key.append(key[ask])
        out_at.append(pos[ask].astype(np.int64) * 2 + 1)
        last = int(runs[-1])
        if not multi[last]:
            wait = ~repeat & (runs == last)
            held.append((key[wait], pos[wait].astype(np.int64)))
        run, several, group = h[-1], bool(multi[last]), (ctx[-1], least[-1])
        yield pa.record_batch([pa.array(np.concatenate(out_key)), pa.array(np.concatenate(out_at))], ["key", "at"])


def _spans(cover: list[tuple[np.ndarray, np.ndarray]], n: int) -> np.ndarray:
    """Maximal covered runs of ``0 .. n`` as rows (start, end)."""
    mark = np.zeros(n + 1, np.int64)
    for s, e in cover:
        np.add.at(mark, np.clip(s, 0, n), 1)
        np.add.at(mark, np.clip(e, 0, n), -1)
    on = np.r_[False, np.cumsum(mark[:n]) > 0, False].astype(np.int8)
    edge = np.diff(on)
    return np.stack([np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)], axis=1)


def _kept(raw: bytes, spans: np.ndarray) -> bytes:
    out, at = [], 0
    for s, e in spans.tolist():
        out.append(raw[at:s])
        at = e
    out.append(raw[at:])
    return b"".join(out)


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _result(doc, raw: bytes, spans: np.ndarray):
    kept = _kept(raw, spans)
    return (doc, len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept)


def _strings(p: Params):
    """(name, start, doc, key) of every string around the positions to compare."""
    reach = p.length - p.seed

    def rows(parts):
        names, docs, keys, starts = zip(*parts)
        sizes = [len(x) for x in starts]
        return pa.record_batch([pa.array(signed(np.concatenate(names))),
                                pa.array(np.concatenate(starts).astype(np.int32)),
                                pa.array(np.repeat(docs, sizes)), pa.array(np.repeat(keys, sizes))],
                               ["name", "start", "doc", "key"])

    def run(batches):
        for batch in batches:
            parts, held = [], 0
            for doc, key, text, ask in zip(np.asarray(batch.column(0)), np.asarray(batch.column(1)),
                                           batch.column(2), batch.column(3)):
                data = np.frombuffer(text.as_buffer(), np.uint8)
                ask = np.asarray(ask.values)
                n = len(data) - p.length + 1
                mark = np.zeros(n + 1, np.int64)
                np.add.at(mark, np.clip(ask - reach, 0, n), 1)
                np.add.at(mark, np.clip(ask + 1, 0, n), -1)
                start = np.flatnonzero(np.cumsum(mark[:n]) > 0)
                parts.append((Sums(data).hashes(start, start + p.length), doc, key, start))
                held += len(start)
                if held > 1 << 17:
                    yield rows(parts)
                    parts, held = [], 0
            if parts:
                yield rows(parts)
    return run


def _again(batches):
    """(key, start) of strings that a smaller document has (sorted by name, document)."""
    name = least = None
    for batch in batches:
        h, start, doc, key = (np.asarray(batch.column(c)) for c in range(4))
        if not len(h):
            continue
        new = np.r_[name is None or h[0] != name, h[1:] != h[:-1]]
        low = np.r_[np.int64(0) if least is None else np.int64(least), doc[np.flatnonzero(new)]][np.cumsum(new)]
        rep = doc > low
        name, least = h[-1], low[-1]
        yield pa.record_batch([pa.array(key[rep]), pa.array(start[rep])], ["key", "start"])


def _cut(p: Params, with_text: bool):
    """Texts without their covered bytes: an even mark is twice a position all
    of whose strings are repeats, an odd one follows twice a string's start."""
    reach = p.length - p.seed
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

    def run(batches):
        for batch in batches:
            out = []
            for doc, text, ats in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                raw = text.as_py().encode()
                at = np.asarray(ats.values) if ats.is_valid else np.zeros(0, np.int64)
                sure, start = at[at % 2 == 0] // 2, at[at % 2 == 1] // 2
                r = _result(doc, raw, _spans([(sure - reach, sure + p.length), (start, start + p.length)], len(raw)))
                out.append(r if with_text else r[:5] + (None,))
            cols = list(zip(*out)) if out else [()] * 6
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, kinds)],
                                  [x.split()[0] for x in RESULT.split(", ")])
    return run


def remove_repeats(docs: DataFrame, params: Params = Params(), id_col: str = "doc_id",
                   text_col: str = "text", with_text: bool = True) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` of every
    document; ``kept`` holds the remaining bytes (null unless ``with_text``)."""
    p = params
    src = (docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
               .withColumn("key", F.xxhash64("doc_id", "text")))
    order = F.coalesce("doc_id", F.lit(NO_ID)).alias("doc")
    marks = land(src.select(order, "key", "text")
                    .mapInArrow(_sample(p), "h long, ctx long, pos int, doc long, key long")
                    .repartition(F.coalesce("h", "key")).sortWithinPartitions("h", "ctx", "doc")
                    .mapInArrow(_sorted_or_known, "key long, at long"), "repeat-marks")
    # sets by key are bounded by their document, however many rows repeat it
    asks = marks.where("at % 2 = 1").groupBy("key").agg(F.collect_set(F.shiftright("at", 1)).alias("ask"))
    again = land(src.join(asks, "key").select(order, "key", "text", "ask")
                    .mapInArrow(_strings(p), "name long, start int, doc long, key long")
                    .repartition("name").sortWithinPartitions("name", "doc")
                    .mapInArrow(_again, "key long, start int"), "repeat-strings")
    cover = (marks.where("at % 2 = 0").union(again.select("key", (F.col("start").cast("long") * 2 + 1).alias("at")))
                  .groupBy("key").agg(F.collect_set("at").alias("at")))
    return src.join(cover, "key", "left").select("doc_id", "text", "at").mapInArrow(_cut(p, with_text), RESULT)


def _sorted_or_known(batches):
    """Entries without a seed were met again inside their block; they come
    first in a sorted partition and are repeats as they stand."""
    def named():
        for batch in batches:
            known = np.asarray(batch.column(0).is_null())
            if known.any():
                k = pa.array(known)
                yield None, pa.record_batch([batch.column(4).filter(k), pa.array(
                    np.asarray(batch.column(2).filter(k)).astype(np.int64) * 2)], ["key", "at"])
                batch = batch.filter(pa.array(~known))
            if batch.num_rows:
                yield batch, None

    ready: list = []

    def seeds():
        for batch, told in named():
            if told is not None:
                ready.append(told)
            if batch is not None:
                yield batch

    for out in _repeats(seeds()):
        yield from ready
        ready.clear()
        yield out
    yield from ready
