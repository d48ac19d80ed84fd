"""N-gram Jaccard join as a blocked sparse matrix product.

The document by n-gram incidence matrix is multiplied with its transpose, block
by block, and entries below the bounds that both sizes set are discarded:

* Documents are taken as classes of equal n-gram sets.
* A pair can only reach the threshold if it shares one of each side's first
  n - ceil(t n) + 1 n-grams in a common order (here, of their hashes).  Those
  columns are dealt out by n-gram; columns with one class in them go.  Columns
  of the same rows come into one block.
* In a block, pairs that share a column are bounded by their sizes, by the
  places of the shared n-gram, and by the bits in which their parity sketches
  differ (each bit stands for at least one n-gram that only one side has): first
  with sketches of one length for all, then, for rows left, with longer ones.
* The pairs' fronts of the common order, the n-grams up to the smaller end
  known in full, bound the overlap once more.
* What is left is multiplied exactly: the row of a class with blocks of the rows
  of its partners, overlap counts accumulated over shared columns and compared
  with the least overlap of both sizes.

None of the bounds discards a pair that links.  Products come in rounds.  The
first has a forest of each block: pairs that connect all rows that the bounds
let link.  The second takes one or two pairs per row that is not connected yet.
The last has all pairs that no link connects, so components are exact
while links inside one need not all be made.

Words: A-Z lower-cased, runs of bytes other than 0x20 and 0x09-0x0D.  Texts of
fewer words than n are one n-gram; null and empty texts have none and link with
nothing.  Ids are integers; rows without id link with nothing.  Rows that share
an id are one document, whatever their texts: links of any of them are its own.
Further columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, COEF, column, LOWER, mix, ranges, sieved, task, text_buffers, width, word_hashes, word_spans, written
from .components import components
from .positions import SCHEMA, deal, gather, join_parts, judge, split_parts

BITS = 1024  # least bits of a parity sketch; larger sets have 4 to 8 for each n-gram


def shingle_sets(data: np.ndarray, offs: np.ndarray, k: int):
    """(hashes of each document's distinct n-grams in order, first of each)."""
    data = LOWER[data]
    start, end, first = word_spans(data, offs)
    h = word_hashes(data, start, end)
    per = np.diff(first)
    n = np.where(per >= k, per - k + 1, np.minimum(per, 1))
    doc = np.repeat(np.arange(len(per)), n)
    at = ranges(first[:-1], n)
    size = np.where(per >= k, k, per)[doc]
    g = size.astype(np.uint64) * COEF[40]
    for i in range(k):
        ok = size > i
        g[ok] += h[at[ok] + i] * COEF[i]
    g = mix(g)
    order = np.lexsort((g, doc))
    g, doc = g[order], doc[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (doc[1:] != doc[:-1])
    g, doc = g[new], doc[new]
    return g, np.searchsorted(doc, np.arange(len(per) + 1))


def _describe(docs: DataFrame, k: int, percent: int) -> DataFrame:
    def run(batches):
        for b in chunks(batches, "text"):
            g, first = shingle_sets(*text_buffers(column(b, "text")), k)
            n = np.diff(first)
            doc = np.repeat(np.arange(len(n)), n)
            some = np.flatnonzero(n > 0)
            s = np.zeros((len(n), 2), np.uint64)
            short = np.zeros((len(n), BITS // 8), np.uint8)
            if len(g):
                s[some, 0] = np.add.reduceat(mix(g * COEF[20]), first[some])
                s[some, 1] = np.add.reduceat(mix(g ^ COEF[21]), first[some])
                bit = doc * BITS + (_bits(g) & (BITS - 1))
                short = np.packbits((np.bincount(bit, minlength=len(n) * BITS) & 1).astype(np.uint8)).reshape(len(n), -1)
            need = n - (n * percent + 99) // 100 + 1
            need[n == 0] = 0
            front = g[ranges(first[:-1], need)].astype("<u8")
            cut = np.concatenate([[0], np.cumsum(need)])
            yield pa.RecordBatch.from_arrays(
                [
                    column(b, "id"), column(b, "row"), pa.array(n, pa.int64()),
                    pa.array([r.tobytes() for r in s], pa.binary()), pa.array([r.tobytes() for r in short], pa.binary()),
                    pa.array([front[i:j].tobytes() for i, j in zip(cut[:-1], cut[1:])], pa.binary()),
                ],
                ["id", "row", "n", "c", "short", "front"],
            )

    return docs.mapInArrow(task(run), "id long, row binary, n long, c binary, short binary, front binary")


def _bits(g: np.ndarray) -> np.ndarray:
    """Places of n-grams in a parity sketch, modulo its bits."""
    return (mix(g * COEF[22]) >> np.uint64(24)).astype(np.int64)


def _sketches(docs: DataFrame, k: int) -> DataFrame:
    """(row, sketch) of each text, with 4 to 8 bits for each n-gram."""

    def run(batches):
        for b in chunks(batches, "text"):
            g, first = shingle_sets(*text_buffers(column(b, "text")), k)
            n = np.diff(first)
            wide = np.maximum(BITS, 1 << np.ceil(np.log2(np.maximum(4 * n, 1))).astype(np.int64))
            edge = np.concatenate([[0], np.cumsum(wide)])
            bit = np.repeat(edge[:-1], n) + (_bits(g) & np.repeat(wide - 1, n))
            sketch = np.packbits((np.bincount(bit, minlength=edge[-1]) & 1).astype(np.uint8))
            yield pa.RecordBatch.from_arrays([column(b, "row"), pa.array([sketch[i // 8 : j // 8].tobytes() for i, j in zip(edge[:-1], edge[1:])], pa.binary())], ["row", "sketch"])

    return docs.select("row", "text").mapInArrow(task(run), "row binary, sketch binary")


def _entries(info: DataFrame) -> DataFrame:
    """Entries of columns that several rows share: g, c, n, place, low (the
    smallest such column of the row)."""
    buckets = width(info.sparkSession)

    def put(batches):
        part, at = TaskContext.get().partitionId(), 0
        for b in batches:
            for i in range(0, b.num_rows, 2000):
                x = b.slice(i, 2000)
                front = column(x, "front").to_pylist()
                keys = np.frombuffer(b"".join(front), "<u8")
                size = np.array([len(f) // 8 for f in front])
                notes = join_parts(b"".join(column(x, "c").to_pylist()), size.astype("<i8").tobytes(), column(x, "n").to_numpy().astype("<i8").tobytes())
                yield deal((part << 32) + at, np.arange(len(keys)), keys.copy(), buckets, 4, notes)
                at += 1

    def judged(batches):
        return judge(batches, 4, True)

    def entries(batches):
        for _, notes, pos, ids in gather(batches, True):
            if notes is None or not len(pos):
                continue
            c, size, n = split_parts(notes)
            size, n = np.frombuffer(size.tobytes(), "<i8"), np.frombuffer(n.tobytes(), "<i8")
            c = c.reshape(len(size), 16)
            first = np.concatenate([[0], np.cumsum(size)])
            row = np.searchsorted(first, pos, side="right") - 1
            g = ids.view(np.int64)
            at = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
            low = np.repeat(np.minimum.reduceat(g, at), np.diff(np.append(at, len(row))))
            keys = pa.Array.from_buffers(pa.binary(16), len(row), [None, pa.py_buffer(np.ascontiguousarray(c[row]))]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(g), keys, pa.array(n[row]), pa.array(pos - first[row]), pa.array(low)], ["g", "c", "n", "place", "low"])

    return (
        info.mapInArrow(task(put), SCHEMA)
        .repartition(buckets, "key").mapInArrow(task(judged), SCHEMA)
        .repartition(buckets, "src").mapInArrow(task(entries), "g long, c binary, n long, place long, low long")
    )


def _columns(percent: int):
    """Entries of a partition's columns that have a partner of fitting size
    (one of the next sizes fits, if any does), with their column's block: the
    smallest column of any of its rows.  Rows of one class are one."""

    def run(batches):
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        t = pa.Table.from_batches(batches)
        g, n, place, low = (t.column(x).to_numpy() for x in ("g", "n", "place", "low"))
        c = np.frombuffer(b"".join(t.column("c").to_pylist()), "<u8").reshape(-1, 2)
        order = np.lexsort((place, c[:, 1], c[:, 0], n, g))
        g, n, place, low, c = g[order], n[order], place[order], low[order], c[order]
        same = np.zeros(len(g), bool)
        same[1:] = g[1:] == g[:-1]
        at = np.flatnonzero(~same)
        key = np.repeat(np.minimum.reduceat(low, at), np.diff(np.append(at, len(g))))
        new = ~same
        new[1:] |= (c[1:] != c[:-1]).any(axis=1)
        g, n, place, key, c = g[new], n[new], place[new], key[new], c[new]
        fits = np.zeros(len(g) + 1, bool)
        fits[1:-1] = (g[1:] == g[:-1]) & (n[:-1] * 100 >= percent * n[1:])
        keep = fits[1:] | fits[:-1]
        g, n, place, key, c = g[keep], n[keep], place[keep], key[keep], c[keep]
        if len(g):
            ids = pa.Array.from_buffers(pa.binary(16), len(c), [None, pa.py_buffer(np.ascontiguousarray(c))]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(key), ids, pa.array(g), pa.array(place)], ["key", "c", "g", "place"])

    return run


def _blocks_of(info: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Blocks of the matrix: key, c, n, sketch, cols and places (plain arrays: 12
    bytes an entry instead of 32 as structs).

    Near copies share nearly all columns, which so come into one block, where
    each of their pairs is met once.  Longer sketches are made from the texts of
    the rows left, which are few; for all rows they would be written for nothing."""
    buckets = width(info.sparkSession)
    e = _entries(info).repartition(buckets, "g").mapInArrow(task(_columns(percent)), "key long, c binary, g long, place long")
    rows = e.groupBy("key", "c").agg(F.collect_list(F.struct("g", "place")).alias("x"))
    plain = F.transform("x", lambda x: x["g"]).alias("cols"), F.transform("x", lambda x: x["place"].cast("int")).alias("places")
    rows = written(rows.select("key", "c", *plain), "ngram-rows")

    def classes(what: str, some: DataFrame) -> DataFrame:
        keys = some.select("c").distinct()
        return sieved(info.select("c", "n", what), keys, "c", some.count()).groupBy("c").agg(F.first("n").alias("n"), F.min(what).alias(what))

    short = classes("short", rows).withColumnRenamed("short", "sketch")
    with_short = rows.join(short, "c").select("key", "c", "n", "sketch", "cols", "places")
    left = written(with_short.repartition(buckets, "key").mapInArrow(task(_survivors(percent)), "key long, c binary"), "ngram-left")
    rows = rows.join(left, ["key", "c"], "left_semi")
    # a class's sketch is that of its least row
    least = written(classes("row", left).join(left.select("c"), "c", "left_semi"), "ngram-least")
    texts = sieved(docs.select("row", "text"), least, "row", least.count())
    sketches = _sketches(texts, k).groupBy("row").agg(F.first("sketch").alias("sketch")).join(least, "row")
    return rows.join(sketches, "c").select("key", "c", "n", "sketch", "cols", "places")


def _survivors(percent: int):
    """(key, c) of rows that have a partner by the bounds with short sketches.
    All pairs of small columns are tried at once, large columns row by row."""

    def run(batches):
        for key, _, x in _blocks(list(batches), percent):
            alive = np.zeros(len(x.n), bool)
            sketch = np.array(x.raw)
            size = np.diff(x.cut)

            def may(i, j, pi, pj):
                n, m = x.n[i], x.n[j]
                need = (percent * (n + m) + 99 + percent) // (100 + percent)
                ok = (np.minimum(n, m) * 100 >= percent * np.maximum(n, m)) & (np.minimum(pi, pj) + 1 + np.minimum(n - 1 - pi, m - 1 - pj) >= need)
                at = np.flatnonzero(ok)
                for a in range(0, len(at), 1 << 16):
                    q = at[a : a + (1 << 16)]
                    apart = np.bitwise_count(sketch[i[q]] ^ sketch[j[q]]).sum(axis=1, dtype=np.int64)
                    ok[q] = (n[q] + m[q] - apart) // 2 >= need[q]
                return ok

            for m in np.unique(size[(size > 1) & (size <= 12)]):
                first = x.cut[:-1][size == m]
                u, v = np.triu_indices(m, 1)
                for a in range(0, len(first), max(1, (1 << 18) // len(u))):
                    f = first[a : a + max(1, (1 << 18) // len(u)), None]
                    i, j = (f + u).ravel(), (f + v).ravel()
                    ok = may(x.row[i], x.row[j], x.place[i], x.place[j])
                    alive[x.row[i[ok]]] = alive[x.row[j[ok]]] = True
            for f, z in zip(x.cut[:-1][size > 12], x.cut[1:][size > 12]):
                row, place = x.row[f:z], x.place[f:z]
                stop = np.searchsorted(x.n[row], x.n[row] * 100 // percent, side="right")
                for k in range(len(row) - 1):
                    j = np.arange(k + 1, stop[k])
                    if alive[row[k]]:  # only partners that have none yet
                        j = j[~alive[row[j]]]
                    if len(j):
                        i = np.full(len(j), row[k])
                        ok = may(i, row[j], np.full(len(j), place[k]), place[j])
                        if ok.any():
                            alive[row[k]] = alive[row[j[ok]]] = True
            if alive.any():
                ids = [r.tobytes() for r in x.c[alive]]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), key)), pa.array(ids, pa.binary())], ["key", "c"])

    return run


class _Block:
    """A block's rows in the order of size and class, and its entries by column."""

    def __init__(self, c, n, sketches, row, g, place, percent):
        self.c, self.n, self.percent = c, n, percent
        order = np.lexsort((row, g))
        self.row, self.place, g = row[order], place[order], g[order]
        self.cut = np.append(np.flatnonzero(np.append(True, g[1:] != g[:-1])), len(g))
        self.raw = [np.frombuffer(x, "<u8") for x in sketches]
        self.wide = np.array([len(x) for x in self.raw])
        self.folded: dict[int, tuple] = {}

    def _sketch(self, w: int, rows: np.ndarray) -> np.ndarray:
        """Sketches folded to w words: of a power of two in size, halves add up."""
        if w not in self.folded:
            has = np.flatnonzero(self.wide >= w)
            at = np.full(len(self.n), -1)
            at[has] = np.arange(len(has))
            self.folded[w] = at, np.array([np.bitwise_xor.reduce(self.raw[k].reshape(-1, w), axis=0) for k in has])
        at, m = self.folded[w]
        return m[at[rows]]

    def may(self, i: int, j: np.ndarray, pi: int, pj: np.ndarray) -> np.ndarray:
        """Whether the bounds let row i link with rows j that share a column, at
        these places of their fronts."""
        n, m, p = self.n[i], self.n[j], self.percent
        need = (p * (n + m) + 99 + p) // (100 + p)
        ok = (np.minimum(n, m) * 100 >= p * np.maximum(n, m)) & (np.minimum(pi, pj) + 1 + np.minimum(n - 1 - pi, m - 1 - pj) >= need)
        at = np.flatnonzero(ok)
        w = np.minimum(self.wide[i], self.wide[j[at]])
        for one in np.unique(w):
            k = at[w == one]
            for s in range(0, len(k), 4096):
                q = k[s : s + 4096]
                apart = np.bitwise_count(self._sketch(one, j[q]) ^ self._sketch(one, np.array([i]))).sum(axis=1, dtype=np.int64)
                ok[q] = (n + m[q] - apart) // 2 >= need[q]
        return ok

    def columns(self):
        for a, z in zip(self.cut[:-1], self.cut[1:]):
            if z - a > 1:
                yield self.row[a:z], self.place[a:z]


def _blocks(batches, percent):
    """(key, labels or None, block) of each block of a partition."""
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    t = pa.Table.from_batches(batches)
    order = np.argsort(t.column("key").to_numpy(), kind="stable")
    keys = t.column("key").to_numpy()[order]
    at = np.append(np.flatnonzero(np.append(True, keys[1:] != keys[:-1])), len(keys))
    for a, z in zip(at[:-1], at[1:]):
        if z - a < 2:
            continue
        x = t.take(pa.array(order[a:z])).combine_chunks()
        n = x.column("n").to_numpy()
        c = np.frombuffer(b"".join(x.column("c").to_pylist()), "<u8").reshape(-1, 2)
        by = np.lexsort((c[:, 1], c[:, 0], n))
        place_of = np.empty(len(by), np.int64)
        place_of[by] = np.arange(len(by))
        cols = x.column("cols").combine_chunks()
        size = np.diff(cols.offsets.to_numpy())
        g, place = cols.flatten().to_numpy(), x.column("places").combine_chunks().flatten().to_numpy().astype(np.int64)
        sketches = x.column("sketch").to_pylist()
        block = _Block(c[by], n[by], [sketches[k] for k in by], place_of[np.repeat(np.arange(len(size)), size)], g, place, percent)
        label = None
        if "label" in x.column_names:
            raw = np.frombuffer(b"".join(x.column("label").to_pylist()), "<u8").reshape(-1, 2)[by]
            _, label = np.unique(np.ascontiguousarray(raw).view("V16").ravel(), return_inverse=True)
        yield keys[a], label, block


def _once(a: list, b: list) -> pa.RecordBatch:
    """Distinct pairs of a partition."""
    x = np.concatenate([np.concatenate(a), np.concatenate(b)], axis=1)
    x = np.unique(np.ascontiguousarray(x).view("V32").ravel())
    raw = [v.tobytes() for v in x]
    return _pairs_out([(v[:16], v[16:]) for v in raw])


def _spanning(percent):
    """Pairs that connect what the bounds let link: a forest of each block."""

    def run(batches):
        a, b = [], []
        for _, _, x in _blocks(list(batches), percent):
            root = np.arange(len(x.n))
            for row, place in x.columns():
                for k in range(len(row) - 1):
                    i = row[k]
                    stop = int(np.searchsorted(x.n[row], x.n[i] * 100 // percent, side="right"))
                    j, pj = row[k + 1 : stop], place[k + 1 : stop]
                    new = root[j] != root[i]
                    j, pj = j[new], pj[new]
                    if not len(j):
                        continue
                    j = j[x.may(i, j, place[k], pj)]
                    if len(j):
                        _, first = np.unique(root[j], return_index=True)
                        for r in np.unique(root[j]):
                            root[root == r] = root[i]
                        a.append(np.repeat(x.c[i : i + 1], len(first), axis=0))
                        b.append(x.c[j[first]])
        if a:
            yield _once(a, b)

    return run


def _apart(percent, every: bool):
    """Pairs whose rows no link connects yet: all that the bounds let link, or
    of each row at most one with the block's commonest component and one with
    another."""

    def run(batches):
        a, b = [], []
        for _, label, x in _blocks(list(batches), percent):
            if label.max() == 0:
                continue
            common = np.bincount(label).argmax()
            done: set = set()
            for row, place in x.columns():
                own = label[row]
                if (own == own[0]).all():
                    continue
                most = np.flatnonzero(own == common)
                other = np.flatnonzero(own != common)
                for k in other:
                    i = row[k]
                    for kind, at in ((0, most), (1, other[(own[other] != own[k]) & (other > k)])):
                        if not len(at) or (not every and (i, kind) in done):
                            continue
                        j = row[at][x.may(i, row[at], place[k], place[at])]
                        if len(j):
                            done.add((i, kind))
                            j = j if every else j[:1]
                            a.append(np.repeat(x.c[i : i + 1], len(j), axis=0))
                            b.append(x.c[j])
        if a:
            yield _once(a, b)

    return run


def _met(pairs: DataFrame, table: DataFrame) -> DataFrame:
    """Rows of ``table`` (by c) where the pairs need them: blocks of 256 partners
    of one class, the class first.  A popular class is in many blocks."""
    n = width(pairs.sparkSession)
    blocks = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / 256).cast("int").alias("m"))
    left = blocks.select("a", F.col("a").alias("c"), F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("s"))
    right = pairs.join(blocks, "a").select("a", F.col("b").alias("c"), F.pmod(F.xxhash64("b"), F.col("m")).cast("int").alias("s"))
    return left.unionByName(right).join(table, "c").repartition(n, "a", "s").sortWithinPartitions("a", "s", (F.col("c") != F.col("a")))


def _per_block(items, links):
    """Pairs of a sorted stream of (a, s, c, value) for which links(own, other)."""
    head, own = None, None
    for a, s, c, x in items:
        if a == c:
            head, own = (a, s), x
        elif head != (a, s):
            raise RuntimeError("a block came without its class")
        elif links(own, x):
            yield a, c


def _pairs_out(pairs: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.binary()), pa.array([p[1] for p in pairs], pa.binary())], ["a", "b"])


def _bounded(pairs: DataFrame, fronts: DataFrame, percent: int) -> DataFrame:
    """The pairs that their fronts let link.  Below the smaller of both fronts'
    ends all n-grams are known; the overlap is at most what is shared there and
    all that is left of the smaller rest."""

    def links(x, y):
        (n, f), (m, g) = x, y
        t = min(f[-1], g[-1])
        a, b = int(np.searchsorted(f, t)), int(np.searchsorted(g, t))
        both = int((g[np.minimum(np.searchsorted(g, f[:a]), len(g) - 1)] == f[:a]).sum())
        return both + min(n - a, m - b) >= (percent * (n + m) + 99 + percent) // (100 + percent)

    def run(batches):
        def items():
            for b in batches:
                for a, s, c, n, f in zip(*(column(b, x).to_pylist() for x in ("a", "s", "c", "n", "front"))):
                    yield a, s, c, (n, np.frombuffer(f, "<u4"))

        yield _pairs_out(list(_per_block(items(), links)))

    return _met(pairs, fronts).select("a", "s", "c", "n", "front").mapInArrow(task(run), "a binary, b binary")


def _product(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) that link: per block, the overlap counts of the class
    with each partner are accumulated over the class's columns, as a product of
    its row with the block of partners."""

    def run(batches):
        head, own = None, None
        for b in chunks(batches, "text", 1 << 20):
            g, first = shingle_sets(*text_buffers(column(b, "text")), k)
            keys = list(zip(*(column(b, x).to_pylist() for x in ("a", "s", "c"))))
            size = np.diff(first)
            out, i = [], 0
            while i < len(keys):
                block = keys[i][:2]
                j = i + 1
                while j < len(keys) and keys[j][:2] == block:
                    j += 1
                if head != block:  # the class comes first
                    if keys[i][2] != block[0]:
                        raise RuntimeError("a block came without its class")
                    head, own = block, g[first[i] : first[i + 1]].copy()
                    i += 1
                if j > i and len(own):
                    flat = g[first[i] : first[j]]
                    owner = np.repeat(np.arange(j - i), size[i:j])
                    shared = own[np.minimum(np.searchsorted(own, flat), len(own) - 1)] == flat
                    both = np.bincount(owner[shared], minlength=j - i)
                    linked = (size[i:j] > 0) & (100 * both >= percent * (len(own) + size[i:j] - both))
                    out += [(head[0], keys[i + x][2]) for x in np.flatnonzero(linked).tolist()]
                i = j
            yield _pairs_out(out)

    return _met(pairs, texts).select("a", "s", "c", "text").mapInArrow(task(run), "a binary, b binary")


def _short_fronts(rows: DataFrame) -> DataFrame:
    """Fronts by the upper halves of their hashes, which keep the order."""

    def run(batches):
        for b in batches:
            f = [(np.frombuffer(x, "<u8") >> np.uint64(32)).astype("<u4").tobytes() for x in column(b, "front").to_pylist()]
            yield pa.RecordBatch.from_arrays([column(b, "c"), column(b, "row"), column(b, "n"), pa.array(f, pa.binary())], ["c", "row", "n", "front"])

    return rows.select("c", "row", "n", "front").mapInArrow(task(run), "c binary, row binary, n long, front binary")


def link(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_shingles, component_id (the smallest id that
    links lead to; null without id)."""
    spark = docs.sparkSession
    n = width(spark)
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    docs = docs.withColumn("row", F.unhex(F.md5("text")))  # names a text, whatever its id
    info = written(_describe(docs, k, percent), "ngram-info")
    linked = info.where(F.col("id").isNotNull() & (F.col("n") > 0))
    pair = "a binary, b binary"
    blocks = written(_blocks_of(linked, docs, k, percent), "ngram-blocks")
    forest = written(blocks.repartition(n, "key").mapInArrow(task(_spanning(percent)), pair).distinct(), "ngram-forest")
    # whoever may link with anyone is in a forest: all others have no part in what follows
    members = forest.select(F.explode(F.array("a", "b")).alias("c")).distinct()
    members = written(members, "ngram-members")
    m = members.count()
    some = sieved(linked.select("c", "row", "n", "front"), members, "c", m)
    one = some.groupBy("c").agg(F.min("row").alias("row"), F.first("n").alias("n"), F.first("front").alias("front")).join(members, "c", "left_semi")
    one = written(_short_fronts(one), "ngram-fronts")
    blocks = written(blocks.join(one.select("c"), "c", "left_semi"), "ngram-blocks")
    # a class's text is that of its least row, found by id and content
    texts = sieved(docs, one, "row", m).groupBy("row").agg(F.first("text").alias("text")).join(one.select("c", "row"), "row")
    texts = written(texts.select("c", "text"), "ngram-texts")

    def product(pairs: DataFrame) -> DataFrame:
        return written(_product(pairs, texts, k, percent), "ngram-links")

    def apart(every: bool) -> DataFrame:
        again = blocks.join(labels, blocks["c"] == labels["node"], "left").select("key", "c", "n", "sketch", "cols", "places", F.coalesce("label", "c").alias("label"))
        return written(again.repartition(n, "key").mapInArrow(task(_apart(percent, every)), pair).distinct(), "ngram-apart")

    edges = product(_bounded(forest, one, percent))
    labels = written(components(edges), "ngram-labels")
    rest = apart(False)
    more = product(_bounded(rest, one, percent)) if rest.take(1) else None
    if more is not None and more.take(1):
        edges = edges.unionByName(more)
        labels = written(components(edges), "ngram-labels")
    if rest.take(1):
        rest = written(_bounded(apart(True), one, percent), "ngram-rest")
        more = product(rest) if rest.take(1) else None
        if more is not None and more.take(1):
            labels = written(components(edges.unionByName(more)), "ngram-labels")
    named = info.select("id", "n", "c").join(labels, info["c"] == labels["node"], "left").select(
        "id", "n", F.when(F.col("n") > 0, F.coalesce("label", "c")).alias("label")
    )
    # rows that share an id are one document: they tie their components together
    own = named.where(F.col("id").isNotNull() & F.col("label").isNotNull()).select("id", "label").distinct()
    tied = own.groupBy("id").agg(F.min("label").alias("a"), F.max("label").alias("z")).where("a < z")
    ties = own.join(tied.select("id", "a"), "id").where("label > a").select(F.col("label").alias("a"), F.col("a").alias("b"))
    again = components(ties).select(F.col("node").alias("own"), F.col("label").alias("top")).withColumnRenamed("own", "label")
    named = named.join(again, "label", "left").select("id", "n", F.coalesce("top", "label").alias("label"))
    low = named.where(F.col("id").isNotNull() & F.col("label").isNotNull()).groupBy("label").agg(F.min("id").alias("low"))
    return named.join(low, "label", "left").select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("low", "id")).alias("component_id"),
    )


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input without documents that link, directly or not, with one of a
    smaller id.  Rows without id stay; of rows of equal id and text one stays,
    and rows of different texts under one id stay or go together."""
    groups = link(docs, k, percent, id_col, text_col)
    go = groups.where(F.col(id_col) > F.col("component_id")).select(id_col).distinct()
    stay = docs.where(F.col(id_col).isNotNull()).join(go, id_col, "left_anti")
    return stay.select(docs.columns).dropDuplicates([id_col, text_col]).unionByName(docs.where(F.col(id_col).isNull()))
