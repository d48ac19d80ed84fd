"""Byte-level deduplication with an enhanced suffix array and its interval tree.

A string of ``length`` bytes that occurs twice is found in four steps.

1. Anchors.  Each window of ``length`` bytes picks its anchor: the leftmost
   smallest hash among its 32-byte grams.  Equal windows pick equal anchors, so
   a window can only repeat if its anchor's gram does; anchors go through the
   packed exchange of ``positions`` and only repeated ones stay.
2. Pieces.  The windows of one anchor are neighbours: they make a piece of text
   of fewer than ``2 * length`` bytes.  Pieces are dealt out by the anchor's
   hash, equal pieces of a task as one with their copies noted.
3. Suffix array.  Per bucket, the distinct pieces of anchors with several are
   concatenated, their window starts sorted by prefix doubling, common prefixes
   taken from the doubling ranks, and a stack scan over them yields the
   intervals of the common-prefix tree at depths of at least ``length``.  An
   interval whose suffixes all follow the same byte repeats its left neighbour
   and is left out (but for windows at the left edge of a piece).  What stays
   are the maximal repeats, each with all its occurrences.
4. Every occurrence but the earliest (smallest id, then start) is covered.

Matches never cross documents; null texts are empty; overlaps count.  Rows that
share id and start of a match (repeated rows) are not earlier than each other.
Ids are integers or null (null before all others).  Empty tables give empty
results; further columns are ignored.  Equality of grams and pieces is judged
by 64-bit hashes, order and prefixes by the bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, COEF, column, mix, powers, prefix_sums, R_INV, ranges, span_hash, task, text_buffers, width
from .positions import SCHEMA, deal, gather, join_parts, judge, pack_sorted, split_parts, unpack_sorted
from .substring_dedup import _keyed, doc_notes, read_notes

GRAM = 32
SA_BYTES = 512 << 10  # text of one suffix array; larger anchor groups get a larger one
NOWHERE = 256  # "byte" before a document's first; 257: different bytes


def pieces_of(data: np.ndarray, offs: np.ndarray, length: int):
    """(first window start, number of windows, anchor position, anchor hash) of
    every piece of a chunk."""
    n = len(data)
    empty = np.zeros(0, np.int64)
    if n < length:
        return empty, empty, empty, np.zeros(0, np.uint64)
    sums = prefix_sums(data)
    h = mix((sums[GRAM:] - sums[:-GRAM]) * powers(R_INV, n + 1)[: n - GRAM + 1])
    bits = max(22, int(n).bit_length())
    low = np.uint64((1 << bits) - 1)
    m = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    span, w = 1, length - GRAM + 1
    while span * 2 <= w:
        m = np.minimum(m[:-span], m[span:])
        span *= 2
    if span < w:
        m = np.minimum(m[: len(m) - (w - span)], m[w - span :])
    per = np.diff(offs)
    good = per >= length
    starts = ranges(offs[:-1][good], per[good] - length + 1)
    a = (m[starts] & low).astype(np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = (a[1:] != a[:-1]) | (starts[1:] != starts[:-1] + 1)
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(starts)))
    return starts[at], count, a[at], h[a[at]]


class Pieces:
    """Columns of pieces: anchor, offset of the anchor, number of windows,
    byte before, id, null flag, content key, start; and their texts."""

    KINDS = (("anchor", "<u8"), ("off", "<u2"), ("count", "<u2"), ("left", "<u2"), ("id", "<i8"), ("null", "u1"), ("k", "<i8"), ("start", "<i8"))

    def __init__(self, cols: dict, text: np.ndarray, length: int):
        self.cols, self.text, self.length = cols, text, length

    def __len__(self):
        return len(self.cols["anchor"])

    def bounds(self):
        size = self.cols["count"].astype(np.int64) + (self.length - 1)
        end = np.cumsum(size)
        return end - size, end

    def take(self, i: np.ndarray) -> "Pieces":
        a, z = self.bounds()
        return Pieces({k: v[i] for k, v in self.cols.items()}, self.text[ranges(a[i], (z - a)[i])], self.length)

    def dump(self) -> bytes:
        return join_parts(*[self.cols[k].astype(t).tobytes() for k, t in self.KINDS], self.text.tobytes())

    @classmethod
    def load(cls, blobs: list[bytes], length: int) -> "Pieces":
        parts = [split_parts(b) for b in blobs]
        cols = {k: np.concatenate([np.frombuffer(p[i].tobytes(), t) for p in parts]) for i, (k, t) in enumerate(cls.KINDS)}
        return cls(cols, np.concatenate([p[-1] for p in parts]), length)

    def hashes(self) -> np.ndarray:
        """Content hash of each piece, a megabyte of them at a time."""
        a, z = self.bounds()
        out = np.empty(len(a), np.uint64)
        i = 0
        while i < len(a):
            j = max(i + 1, int(np.searchsorted(z, a[i] + (1 << 20), side="right")))
            out[i:j] = span_hash(prefix_sums(self.text[a[i] : z[j - 1]]), a[i:j] - a[i], z[i:j] - a[i])
            i = j
        return out

    def collapse(self):
        """(distinct pieces with their earliest place, group of each piece,
        index of the earliest of each group)."""
        c = self.cols
        h = mix(self.hashes() + c["off"].astype(np.uint64) * COEF[2] ^ c["anchor"])
        order = np.lexsort((c["start"], c["id"], 1 - c["null"].astype(np.int8), h))
        sh = h[order]
        new = np.ones(len(sh), bool)
        new[1:] = sh[1:] != sh[:-1]
        at = np.flatnonzero(new)
        group = np.empty(len(sh), np.int64)
        group[order] = np.cumsum(new) - 1
        best = order[at]
        left = c["left"][order]
        mixed = np.minimum.reduceat(left, at) != np.maximum.reduceat(left, at) if len(at) else new
        return best, group, mixed

    def later(self, i: np.ndarray, j: np.ndarray, di=0, dj=0) -> np.ndarray:
        """Whether place i (+ offset) comes after place j."""
        c = self.cols
        n, d, s = (c["null"][j].astype(int) - c["null"][i]), c["id"][i], c["start"][i] + di
        e, t = c["id"][j], c["start"][j] + dj
        return (n > 0) | (n == 0) & ((d > e) | (d == e) & (s > t))


def suffix_array(text: np.ndarray, end: np.ndarray, starts: np.ndarray):
    """Order of the suffixes (each up to its piece's ``end``) at ``starts``,
    and the common prefix of each with the one before.  ``end`` is per byte."""
    n = len(text)
    rest = end - np.arange(n)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    value = np.zeros(n, np.uint64)
    for k in range(8):
        value = (value << np.uint64(8)) | np.where(rest > k, padded[k : k + n], 0).astype(np.uint64)
    _, r = np.unique(value, return_inverse=True)
    _, r = np.unique(r * 9 + np.minimum(rest, 8), return_inverse=True)
    levels, h, longest = [(8, r + 1)], 8, int(rest.max(initial=0))
    at = np.arange(n)
    while h < longest:
        r = levels[-1][1]
        nxt = np.where(rest > h, r[np.minimum(at + h, n - 1)], 0)
        _, s = np.unique(r * (n + 2) + nxt, return_inverse=True)
        h *= 2
        levels.append((h, s + 1))
    sa = starts[np.argsort(levels[-1][1][starts], kind="stable")]
    p, q = sa[1:].copy(), sa[:-1].copy()
    lcp = np.zeros(len(p), np.int64)
    for h, r in levels[::-1]:
        live = np.flatnonzero((p < n) & (q < n))
        same = live[(r[p[live]] == r[q[live]]) & (rest[p[live]] >= h) & (rest[q[live]] >= h)]
        # a suffix that ended inside its piece does not go on in the next
        same = same[(end[sa[1:][same]] >= p[same] + h) & (end[sa[:-1][same]] >= q[same] + h)]
        lcp[same] += h
        p[same] += h
        q[same] += h
    for _ in range(8):
        live = np.flatnonzero((p < end[sa[1:]]) & (q < end[sa[:-1]]))
        same = live[text[p[live]] == text[q[live]]]
        same = same[lcp[same] == p[same] - sa[1:][same]]
        lcp[same] += 1
        p[same] += 1
        q[same] += 1
    return sa, np.concatenate([[0], lcp])


def intervals(lcp: np.ndarray, least: int):
    """(first, last, depth) of the common-prefix tree's intervals that are at
    least so deep, by a scan with a stack.  lcp[i]: entries i-1 and i."""
    stack: list[list[int]] = []
    values = lcp.tolist()
    for i in range(1, len(values) + 1):
        v = values[i] if i < len(values) else 0
        first = i - 1
        while stack and stack[-1][1] > v:
            first, depth = stack.pop()
            yield first, i - 1, depth
        if v >= least and (not stack or stack[-1][1] < v):
            stack.append([first, v])


def maximal(ps: Pieces, mixed: np.ndarray):
    """Maximal repeats among distinct pieces: (piece, offset, depth, group) of
    every occurrence, groups numbered from 0."""
    length = ps.length
    a, z = ps.bounds()
    piece = np.repeat(np.arange(len(ps)), z - a)
    count = ps.cols["count"].astype(np.int64)
    starts = ranges(a, count)
    sa, lcp = suffix_array(ps.text, z[piece], starts)
    own = piece[sa]
    off = sa - a[own]
    before = np.where(off > 0, ps.text[np.maximum(sa - 1, 0)].astype(np.int64), np.where(mixed[own], 257, ps.cols["left"][own].astype(np.int64)))
    joined = lcp >= length
    first = np.flatnonzero(~joined)
    size = np.diff(np.append(first, len(sa)))
    many = size > 1
    first, size = first[many], size[many]
    out = []
    if not len(first):
        z = np.zeros(0, np.int64)
        return z, z, z, z
    # runs of suffixes that share the least depth
    inside = ranges(first, size)
    cut = np.cumsum(size) - size
    diverse = np.minimum.reduceat(before[inside], cut) != np.maximum.reduceat(before[inside], cut)
    edge = np.minimum.reduceat(off[inside], cut) == 0
    depth = np.where(np.isin(np.arange(len(sa)), first), np.iinfo(np.int64).max, lcp)[inside]
    low, high = np.minimum.reduceat(depth, cut), np.maximum.reduceat(np.where(depth == np.iinfo(np.int64).max, 0, depth), cut)
    use = diverse | edge
    flat = use & (low == high)
    n = int(flat.sum())
    if n:
        i = ranges(first[flat], size[flat])
        out.append((i, np.repeat(low[flat], size[flat]), np.repeat(np.arange(n), size[flat])))
    for f, s in zip(first[use & ~flat].tolist(), size[use & ~flat].tolist()):
        part = lcp[f : f + s].copy()
        part[0] = 0
        for i, j, d in intervals(part, length):
            c = before[f + i : f + j + 1]
            if c.min() != c.max() or off[f + i : f + j + 1].min() == 0 or c.max() == 257:
                k = np.arange(f + i, f + j + 1)
                out.append((k, np.full(len(k), d), np.full(len(k), n)))
                n += 1
    if not out:
        z = np.zeros(0, np.int64)
        return z, z, z, z
    i, d, g = (np.concatenate(x) for x in zip(*out))
    return own[i], off[i], d, g


def _covers(c: dict, i, start, stop) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(c["id"][i], pa.int64(), mask=c["null"][i].astype(bool)),
            pa.array(c["k"][i], pa.int64()),
            pa.array(start, pa.int64()),
            pa.array(stop, pa.int64()),
        ],
        ["id", "k", "start", "stop"],
    )


def _pieces(keyed: DataFrame, length: int, all_copies: bool) -> DataFrame:
    """Steps 1 and 2: packed pieces of repeated anchors by bucket (kind 0) and,
    unless all copies are wanted, the copies within a task (kind 2)."""
    n = width(keyed.sparkSession)
    fine = 4 * n  # buckets of pieces: a task works through several, one by one

    def anchors(batches):
        part, at = TaskContext.get().partitionId(), 0
        for b in chunks(batches, "text", 2 << 20):
            data, offs = text_buffers(column(b, "text"))
            _, _, a, h = pieces_of(data, offs, length)
            yield deal((part << 32) + at, a, h, n, 4, doc_notes(b, offs[:-1]))
            at += 1

    def judged(batches):
        return judge(batches, 4, False)

    def by_document(batches):
        for _, notes, pos, _ in gather(batches, False):
            if notes is None or not len(pos):
                continue
            ids, null, k, first = read_notes(notes)
            doc = np.searchsorted(first, pos, side="right") - 1
            at = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
            d = doc[at]
            blobs = [pack_sorted(pos[i:j] - first[x]) for i, j, x in zip(at, np.append(at[1:], len(doc)), d)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[d], pa.int64(), mask=null[d]), pa.array(k[d], pa.int64()), pa.array(blobs, pa.binary())], ["id", "k", "anchors"]
            )

    marks = (
        keyed.mapInArrow(task(anchors), SCHEMA)
        .repartition(n, "key").mapInArrow(task(judged), SCHEMA)
        .repartition(n, "src").mapInArrow(task(by_document), "id long, k long, anchors binary")
        .groupBy("id", "k").agg(F.max("anchors").alias("anchors"))  # equal rows have equal anchors
    )
    joined = keyed.alias("d").join(marks.alias("m"), F.col("d.id").eqNullSafe(F.col("m.id")) & (F.col("d.k") == F.col("m.k")), "left").select(
        "d.id", "d.k", "d.text", "m.anchors"
    )

    def cut(batches):
        part = TaskContext.get().partitionId()
        for b in chunks(batches, "text", 2 << 20):
            b = b.filter(column(b, "anchors").is_valid())
            if not b.num_rows:
                continue
            data, offs = text_buffers(column(b, "text"))
            start, count, a, h = pieces_of(data, offs, length)
            marks = [unpack_sorted(np.frombuffer(x, np.uint8)) for x in column(b, "anchors").to_pylist()]
            known = np.concatenate([x + o for x, o in zip(marks, offs)])
            keep = np.isin(a, known, assume_unique=True)
            start, count, a, h = start[keep], count[keep], a[keep], h[keep]
            doc = np.searchsorted(offs, start, side="right") - 1
            ids = column(b, "id")
            ps = Pieces(
                {
                    "anchor": h, "off": (a - start).astype(np.uint16), "count": count.astype(np.uint16),
                    "left": np.where(start > offs[doc], data[np.maximum(start - 1, 0)], NOWHERE).astype(np.uint16),
                    "id": ids.fill_null(0).to_numpy()[doc], "null": np.array(ids.is_null())[doc].astype(np.uint8),
                    "k": column(b, "k").to_numpy()[doc], "start": start - offs[doc],
                },
                data[ranges(start, count + length - 1)], length,
            )
            items = []
            if not all_copies and len(ps):
                best, group, mixed = ps.collapse()
                other = np.ones(len(ps), bool)
                other[best] = False
                i = np.flatnonzero(other)
                c = ps.cols
                late = ps.later(i, best[group[i]])
                i = i[late]
                stop = c["start"][i] + c["count"][i] + (length - 1)
                blob = join_parts(*[x.astype(t).tobytes() for x, t in ((c["id"][i], "<i8"), (c["null"][i], "u1"), (c["k"][i], "<i8"), (c["start"][i], "<i8"), (stop, "<i8"))])
                c["left"][best[mixed]] = 257
                if len(i):
                    items.append((part % n, 0, 2, blob))
                same = np.ones(len(ps), bool)
                same[np.flatnonzero(other)[late]] = False
                ps = ps.take(np.flatnonzero(same))
            bucket = ((ps.cols["anchor"] >> np.uint64(32)) * np.uint64(fine)) >> np.uint64(32)
            order = np.argsort(bucket, kind="stable")
            edges = np.searchsorted(bucket[order], np.arange(fine + 1, dtype=np.uint64))
            for x in range(fine):
                if edges[x] < edges[x + 1]:
                    items.append((x, 0, 0, ps.take(order[edges[x] : edges[x + 1]]).dump()))
            k, s, t, v = zip(*items) if items else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(s, pa.int64()), pa.array(t, pa.int32()), pa.array(v, pa.binary())], ["key", "src", "kind", "blob"])

    return joined.mapInArrow(task(cut), SCHEMA).repartition(n, "key")


def _buckets(batches):
    """(None, copies) as they come, then (bucket, [blobs])."""
    groups: dict[int, list] = {}
    for b in batches:
        for k, t, x in zip(column(b, "key").to_pylist(), column(b, "kind").to_pylist(), column(b, "blob").to_pylist()):
            if t == 2:
                yield None, x
            else:
                groups.setdefault(k, []).append(x)
    for k in list(groups):
        yield k, groups.pop(k)


def _arrays(ps: Pieces):
    """Step 3 per set of anchors: (distinct pieces, mixed, best, occurrences)."""
    best, group, mixed = ps.collapse()
    anchor = ps.cols["anchor"][best]
    order = np.argsort(anchor, kind="stable")
    sa = anchor[order]
    at = np.flatnonzero(np.append(True, sa[1:] != sa[:-1]))
    size = np.diff(np.append(at, len(sa)))
    several = np.repeat(size > 1, size)
    order, sa = order[several], sa[several]
    out = []
    if len(order):
        bytes_of = np.cumsum(ps.cols["count"][best[order]].astype(np.int64) + ps.length - 1)
        border = np.flatnonzero(np.append(sa[1:] != sa[:-1], True)) + 1
        i = 0
        while i < len(order):
            base = bytes_of[i - 1] if i else 0
            x = np.searchsorted(bytes_of[border - 1], base + SA_BYTES, side="right") - 1
            j = int(border[max(x, np.searchsorted(border, i, side="right"))])
            pick = order[i:j]
            out.append((pick, *maximal(ps.take(best[pick]), mixed[pick] | (ps.cols["left"][best[pick]] == 257))))
            i = j
    return best, group, out


def covered(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans that also start earlier: id, k, start, stop (bytes)."""
    return _covered(_keyed(docs, id_col, text_col), length)


def _covered(keyed: DataFrame, length: int) -> DataFrame:
    def run(batches):
        for key, x in _buckets(batches):
            if key is None:
                d, u, k, s, e = (np.frombuffer(p.tobytes(), t) for p, t in zip(split_parts(x), ("<i8", "u1", "<i8", "<i8", "<i8")))
                yield _covers({"id": d, "null": u, "k": k}, np.arange(len(d)), s, e)
                continue
            ps = Pieces.load(x, length)
            del x
            c = ps.cols
            best, group, found = _arrays(ps)
            i = np.arange(len(ps))
            i = i[ps.later(i, best[group])]
            yield _covers(c, i, c["start"][i], c["start"][i] + c["count"][i] + (length - 1))
            for pick, piece, off, depth, grp in found:
                if not len(piece):
                    continue
                own = best[pick[piece]]
                order = np.lexsort((c["start"][own] + off, c["id"][own], 1 - c["null"][own].astype(np.int8), grp))
                at = np.flatnonzero(np.append(True, np.diff(grp[order]) != 0))
                first = np.empty(int(grp.max()) + 1, np.int64)
                first[grp[order[at]]] = order[at]
                e = first[grp]
                late = ps.later(own, own[e], off, off[e])
                yield _covers(c, own[late], c["start"][own[late]] + off[late], c["start"][own[late]] + off[late] + depth[late])

    return _pieces(keyed, length, False).mapInArrow(task(run), "id long, k long, start long, stop long")


def repeat_groups(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Maximal repeats within pieces, one row per occurrence: repeat (a hash of
    the text), n_bytes, id, start.  All occurrences of a repeat are listed; a
    repeat longer than a piece shows as its overlapping parts."""
    keyed = _keyed(docs, id_col, text_col)

    def run(batches):
        for key, x in _buckets(batches):
            ps = Pieces.load(x, length)
            c = ps.cols
            best, group, found = _arrays(ps)
            a, _ = ps.bounds()
            sums = prefix_sums(ps.text)
            by = np.argsort(group, kind="stable")
            first = np.searchsorted(group[by], np.arange(len(best) + 1))
            copies = np.diff(first)
            whole = np.flatnonzero(copies > 1)
            sets = [(best[whole], np.zeros(len(whole), np.int64), c["count"][best[whole]].astype(np.int64) + length - 1, whole)]
            sets += [(best[p[q]], o, d, p[q]) for p, q, o, d, _ in found if len(q)]
            for rep, off, depth, g in sets:
                name = span_hash(sums, a[rep] + off, a[rep] + off + depth).astype(np.int64)
                i = by[ranges(first[g], copies[g])]
                r = np.repeat(np.arange(len(g)), copies[g])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(name[r], pa.int64()), pa.array(depth[r], pa.int64()),
                        pa.array(c["id"][i], pa.int64(), mask=c["null"][i].astype(bool)), pa.array(c["start"][i] + off[r], pa.int64()),
                    ],
                    ["repeat", "n_bytes", "id", "start"],
                )

    out = _pieces(keyed, length, True).mapInArrow(task(run), "repeat long, n_bytes long, id long, start long")
    return out.distinct().withColumnRenamed("id", id_col)


def remove_repeats(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """One row per input row: id, n_bytes, n_removed, n_spans, kept_sha256 and,
    where asked for, kept_bytes."""
    keyed = _keyed(docs, id_col, text_col)
    spans = _covered(keyed, length).groupBy("id", "k").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    joined = keyed.alias("d").join(spans.alias("m"), F.col("d.id").eqNullSafe(F.col("m.id")) & (F.col("d.k") == F.col("m.k")), "left").select(
        "d.id", "d.text", "m.spans"
    )
    schema = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept_bytes binary" * keep_text

    def apply(batches):
        for b in chunks(batches, "text", 2 << 20):
            data, offs = text_buffers(column(b, "text"))
            edge = np.zeros(len(data) + 1, np.int32)
            spans = column(b, "spans")
            size = np.diff(spans.offsets.to_numpy()).astype(np.int64)
            size[np.array(spans.is_null())] = 0
            flat = spans.flatten()
            base = np.repeat(offs[:-1], size)
            np.add.at(edge, base + flat.field("start").to_numpy(), 1)
            np.add.at(edge, base + flat.field("stop").to_numpy(), -1)
            gone = np.cumsum(edge)[:-1] > 0
            rise = gone.copy()
            rise[1:] &= ~gone[:-1]
            rise[offs[:-1][offs[:-1] < len(data)]] |= gone[offs[:-1][offs[:-1] < len(data)]]
            total = np.concatenate([[0], np.cumsum(gone)])[offs]
            runs = np.concatenate([[0], np.cumsum(rise)])[offs]
            left = memoryview(data[~gone].tobytes())
            at = offs - total
            kept = [left[i:j] for i, j in zip(at[:-1], at[1:])]
            cols = [column(b, "id"), *[pa.array(np.diff(x), pa.int64()) for x in (offs, total, runs)], pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())]
            names = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if keep_text:
                cols, names = [*cols, pa.array([bytes(x) for x in kept], pa.binary())], [*names, "kept_bytes"]
            yield pa.RecordBatch.from_arrays(cols, names)

    return joined.mapInArrow(task(apply), schema).withColumnRenamed("id", id_col)
