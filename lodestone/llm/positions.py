"""Finding repeated keys among very many positions, in packed blocks.

A source is a chunk of documents in one task.  Its positions (increasing
integers) carry 64-bit keys.  ``deal`` splits them by key range into one packed
block per bucket, ``judge`` sees all blocks of a bucket and sends the positions
whose key turns up more than once back to their source, and ``gather`` puts a
source's answer together.  Blocks cost 6 to 10 bytes a position, so a corpus of
windows crosses an exchange in about the size of its text.

A key that repeats within a source is sent once, flagged, and its other
positions travel past the buckets to the source's answer: a bucket gets at most
one entry per key and source, however hot the key.

Rows are (key int, src long, kind int, blob binary); kind 0 are blocks, 1 the
source's own notes, 2 repeats within the source.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .common import mix

SCHEMA = "key int, src long, kind int, blob binary"
NAMES = ["key", "src", "kind", "blob"]


def pack(values: np.ndarray) -> bytes:
    """Variable-length bytes of non-negative integers, 7 bits each."""
    v = values.astype(np.uint64)
    size = np.ones(len(v), np.int64)
    for b in range(7, 64, 7):
        big = v >= np.uint64(1 << b)
        if not big.any():
            break
        size += big
    at = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint8)
    k = 0
    live = np.arange(len(v))
    while len(live):
        more = size[live] > k + 1
        out[at[live] + k] = ((v[live] >> np.uint64(7 * k)) & np.uint64(127)).astype(np.uint8) | (more.astype(np.uint8) << 7)
        live = live[more]
        k += 1
    return out.tobytes()


def unpack(raw: np.ndarray) -> np.ndarray:
    if not len(raw):
        return np.zeros(0, np.int64)
    last = raw < 128
    end = np.flatnonzero(last)
    start = np.empty_like(end)
    start[0] = 0
    start[1:] = end[:-1] + 1
    out = (raw[start] & 127).astype(np.int64)
    size = end - start
    for k in range(1, int(size.max()) + 1):
        has = size >= k
        out[has] |= (raw[start[has] + k] & 127).astype(np.int64) << (7 * k)
    return out


def pack_sorted(pos: np.ndarray) -> bytes:
    return pack(np.diff(pos, prepend=0))


def unpack_sorted(raw: np.ndarray) -> np.ndarray:
    return np.cumsum(unpack(raw))


def join_parts(*parts: bytes) -> bytes:
    head = np.array([len(parts), *map(len, parts)], "<u4").tobytes()
    return head + b"".join(parts)


def split_parts(blob: bytes) -> list[np.ndarray]:
    raw = np.frombuffer(blob, np.uint8)
    n = int(raw[:4].view("<u4")[0])
    size = raw[4 : 4 + 4 * n].view("<u4")
    at = 4 + 4 * n + np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
    return [raw[a:b] for a, b in zip(at[:-1], at[1:])]


def rows(items: list[tuple]) -> pa.RecordBatch:
    k, s, t, b = zip(*items) if items else ((), (), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(k, pa.int32()), pa.array(s, pa.int64()), pa.array(t, pa.int32()), pa.array(b, pa.binary())], NAMES
    )


def deal(src: int, pos: np.ndarray, keys: np.ndarray, buckets: int, width: int, notes: bytes | None) -> pa.RecordBatch:
    """Blocks of one source.  ``width``: bytes of a key sent beside its bucket
    (4 for a filter whose false hits a later level removes, 8 otherwise)."""
    home = int(src) % buckets
    out: list[tuple] = []
    if notes is not None:
        out.append((home, src, 1, notes))
    if len(pos):
        order = np.argsort(keys, kind="stable")
        sk = keys[order]
        new = np.ones(len(sk), bool)
        new[1:] = sk[1:] != sk[:-1]
        rep = order[new]  # first position of each key
        count = np.diff(np.append(np.flatnonzero(new), len(sk)))
        if len(rep) < len(pos):
            which = np.repeat(rep, count)[~new]
            rest = order[~new]
            by = np.argsort(rest)
            out.append((home, src, 2, join_parts(pack_sorted(pos[rest[by]]), pack(pos[which[by]]))))
        by = np.argsort(rep)
        rep, multi = rep[by], (count[by] > 1)
        p, k = pos[rep], keys[rep]
        bucket = ((k >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        order = np.argsort(bucket.astype(np.uint32 if buckets > 65535 else np.uint16), kind="stable")
        cut = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))
        p, multi = p[order], multi[order]
        low = k[order].astype("<u4") if width == 4 else k[order].astype("<u8")
        for b in range(buckets):
            i, j = cut[b], cut[b + 1]
            if i < j:
                out.append((b, src, 0, join_parts(low[i:j].tobytes(), pack((np.diff(p[i:j], prepend=0) << 1) | multi[i:j]))))
    return rows(out)


def judge(batches, width: int, labels: bool):
    """Bucket side: positions of repeated keys, back to their sources with a
    label of the key (where a further level follows)."""
    groups: dict[int, list] = {}
    for b in batches:
        passed = []
        for k, s, t, x in zip(*(b.column(i).to_pylist() for i in range(4))):
            if t == 0:
                groups.setdefault(k, []).append((s, x))
            else:
                passed.append((k, s, t, x))
        if passed:
            yield rows(passed)
    for bucket, items in groups.items():
        parts = [split_parts(x) for _, x in items]
        keys = np.concatenate([np.frombuffer(p[0].tobytes(), "<u4" if width == 4 else "<u8") for p in parts])
        coded = [unpack(p[1]) for p in parts]
        size = [len(c) for c in coded]
        multi = np.concatenate([c & 1 for c in coded]).astype(bool)
        order = np.argsort(keys, kind="stable")
        sk = keys[order]
        new = np.ones(len(sk), bool)
        new[1:] = sk[1:] != sk[:-1]
        first = np.flatnonzero(new)
        good = np.maximum(np.diff(np.append(first, len(sk))) > 1, np.logical_or.reduceat(multi[order], first)) if len(first) else new
        label = np.empty(len(sk), np.int64)
        name = np.cumsum(good) - 1
        label[order] = np.repeat(np.where(good, name, -1), np.diff(np.append(first, len(sk))))
        at, out = 0, []
        for (s, _), c, n in zip(items, coded, size):
            got = label[at : at + n]
            at += n
            keep = got >= 0
            if keep.any():
                pos = np.cumsum(c >> 1)[keep]
                blob = join_parts(pack_sorted(pos), pack(got[keep]) if labels else b"")
                out.append((bucket, s, 0, blob))
        groups[bucket] = []
        if out:
            yield rows(out)


def gather(batches, labels: bool):
    """Source side: (src, notes, positions, class keys) of every source whose
    rows are in this partition."""
    groups: dict[int, list] = {}
    for b in batches:
        for k, s, t, x in zip(*(b.column(i).to_pylist() for i in range(4))):
            groups.setdefault(s, []).append((k, t, x))
    for src in list(groups):
        notes, pos, ids, again = None, [], [], None
        for k, t, x in groups.pop(src):
            if t == 1:
                notes = x
                continue
            a, b = split_parts(x)
            if t == 2:
                again = (unpack_sorted(a), unpack(b))
                continue
            pos.append(unpack_sorted(a))
            if labels:
                ids.append(mix((np.uint64(k) << np.uint64(40)) + unpack(b).astype(np.uint64)))
        p = np.concatenate(pos) if pos else np.zeros(0, np.int64)
        c = np.concatenate(ids) if ids else np.zeros(len(p), np.uint64)
        order = np.argsort(p)
        p, c = p[order], c[order]
        if again is not None and len(p):
            rep = np.searchsorted(p, again[1])
            p2, c2 = again[0], c[np.minimum(rep, len(p) - 1)]
            p, c = np.concatenate([p, p2]), np.concatenate([c, c2])
            order = np.argsort(p, kind="stable")
            p, c = p[order], c[order]
        yield src, notes, p, c
