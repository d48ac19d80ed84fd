"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

The CGK embedding walks along a string: at step j it writes the current
character, and moves on if a random bit of (j, character) says so.  Strings at a
small edit distance get embeddings at a small Hamming distance, so samples of
embedding positions agree often.  Each repetition draws its own positions, each
eighth its own walk; windows of a document (from every word start) whose samples
are those of a benchmark item's window, and whose embeddings agree in half of the
steps, are candidates.

An item has a window at each of its words: a walk over a whole item of which a
fifth is edited hardly ever agrees with the item's, while some of its words are
followed by steps that do.  Items come in classes of length, each with its steps
and samples.  Where ``rounds`` is not given, items of a class, the shortest third
of them also by themselves, are edited as much as ``similarity`` admits (random
edits, and a typo in every word), and repetitions are added until the share
``recall`` of the edited items is found, and some more (``MARGIN``), as the sample is
small; at most ``MOST_ROUNDS``.

Each candidate is verified exactly: the item-sized window around it is searched
for the substring of least edit distance (Myers' bit vectors); the document is
contaminated if that is at most ``1 - similarity`` of the item's characters.
Before that, the least distances of the item's pieces of up to 64 characters, each
searched near its place, bound the item's from below, many candidates at a time.

Items of fewer than ``SHORT`` bytes are found where they stand unedited between
word borders.  A-Z count as lower case and white space as spaces.  Null texts
match nothing, nor do null and blank items.  Items are sent to the tasks in
blocks of bounded size, one pass over the documents per block.  Documents are
handled row by row, whole, without exchange: repeated rows, hot keys, very long
texts and further columns (whatever their names) need no care; repeated items,
and items at the same place, match each.  Empty tables give empty results.
"""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, column, LOWER, mix, prefix_sums, ranges, SPACE, span_hash, task, text_buffers, word_spans

SHORT = 24  # bytes; shorter items are compared exactly
PER_WALK, MOST_ROUNDS = 14, 96
MARGIN = 140  # percent of the repetitions that reach the recall on the edited sample
BLOCK = 1 << 16  # windows walked at once
BLOCK_BYTES = 4 << 20  # of item text sent to the tasks at once
_FOLD = np.where(SPACE, np.uint8(32), LOWER)
_WORD = np.array([chr(c).isalnum() and c < 128 or c >= 128 for c in range(256)])


def _starts(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Word starts, and every byte of words of more than 32 bytes."""
    start, end, _ = word_spans(data, offs)
    long = end - start > 32
    if not long.any():
        return start
    mark = np.zeros(len(data), bool)
    mark[start] = True
    mark[ranges(start[long], (end - start)[long])] = True
    return np.flatnonzero(mark)


class Shape:
    """How windows of a class of items are walked and sampled: items of at
    least ``size`` bytes, ``steps`` of a walk, ``samples`` of a sample set."""

    def __init__(self, size: int, steps: int, samples: int):
        self.size, self.steps, self.samples = size, steps, samples


SHAPES = [Shape(80, 40, 10), Shape(SHORT, 24, 7)]  # long items first


class Walk:
    """The random bits of one walk: the top bit of a multiple of each byte."""

    def __init__(self, shape: Shape, seed: int):
        rng = np.random.default_rng([seed, shape.steps, 90210])
        self.steps = shape.steps
        self.factor = rng.integers(0, 128, shape.steps).astype(np.uint8) * np.uint8(2) + np.uint8(1)
        self.shift = rng.integers(0, 256, shape.steps).astype(np.uint8)

    def embed(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The walk from every start: one row for each step."""
        out = np.empty((self.steps, len(starts)), np.uint8)
        pos = starts.astype(np.int64)
        for j in range(self.steps):
            data.take(pos, out=out[j], mode="clip")
            pos += (out[j] * self.factor[j] + self.shift[j]) >> np.uint8(7)
        return out


class Samples:
    """One repetition: sampled steps of a walk, and the items' windows by them."""

    def __init__(self, shape: Shape, seed: int, items: np.ndarray):
        rng = np.random.default_rng([seed, shape.samples, 4711])
        # one sample from each equal part of the walk
        edges = np.linspace(0, shape.steps, shape.samples + 1).astype(int)
        self.at = [int(rng.integers(a, b)) for a, b in zip(edges[:-1], edges[1:])]
        self.salt = rng.integers(1, 2**63, shape.samples, dtype=np.uint64) | np.uint64(1)
        self.front = rng.permutation(shape.samples)[:8].tolist()
        self.known = np.zeros(1 << 20, bool)
        self.known[self._number(items)] = True
        self.items = items
        key = self._key(items[self.at])
        self.order = np.argsort(key, kind="stable")
        self.keys = key[self.order]

    def _number(self, walked: np.ndarray) -> np.ndarray:
        """Number of 20 bits by up to eight of the samples."""
        key = np.zeros(walked.shape[1], np.uint32)
        for n, k in enumerate(self.front):
            if n == 4:
                key *= np.uint32(2654435769)
                key ^= key >> np.uint32(15)
            key += walked[self.at[k]].astype(np.uint32) << np.uint32(8 * (n % 4))
        return (key * np.uint32(2246822519)) >> np.uint32(12)

    def _key(self, sampled) -> np.ndarray:
        key = np.zeros(len(sampled[0]), np.uint64)
        for c, salt in zip(sampled, self.salt):
            key = mix((key + c.astype(np.uint64) + np.uint64(1)) * salt)
        return key

    def agree(self, walked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(column, item window) that agree on all samples, and in at least half
        of the steps."""
        i = np.flatnonzero(self.known.take(self._number(walked)))
        if not len(i):
            return i, i
        key, at = self._key([walked[k][i] for k in self.at]), np.arange(len(i))
        a = np.searchsorted(self.keys, key)
        same = self.keys[np.minimum(a, len(self.keys) - 1)] == key
        at, key, a = at[same], key[same], a[same]
        b = np.searchsorted(self.keys, key, side="right")
        at, j = np.repeat(at, b - a), self.order[ranges(a, b - a)]
        i = i[at]
        near = 2 * (walked[:, i] == self.items[:, j]).sum(0) >= len(walked)
        return i[near], j[near]


def least_distance(pattern: str, text: str) -> tuple[int, int]:
    """(least edit distance of the pattern to any substring of the text, end of
    the first such substring)."""
    m = len(pattern)
    peq: dict[str, int] = {}
    for i, c in enumerate(pattern):
        peq[c] = peq.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    vp, vn, score = full, 0, m
    best, end = m, 0
    for j, c in enumerate(text, 1):
        eq = peq.get(c, 0)
        d0 = (((eq & vp) + vp) ^ vp) | eq | vn
        hp = vn | (full & ~(d0 | vp))
        hn = d0 & vp
        if hp & top:
            score += 1
        elif hn & top:
            score -= 1
        hp = hp << 1 & full
        hn = hn << 1 & full
        vp = hn | (full & ~(d0 | hp))
        vn = d0 & hp
        if score < best:
            best, end = score, j
    return best, end


def _within(tests: list) -> np.ndarray:
    """Which (.., pattern, text, most) have a least distance of at most
    ``most``: ``least_distance`` for many at once, in words of 64 bits."""
    out = np.zeros(len(tests), bool)
    use = np.flatnonzero([bool(x[-3]) for x in tests])
    if not len(use):
        return out
    patterns = {p: k for k, p in enumerate(dict.fromkeys(tests[i][-3] for i in use))}
    letters = np.array(sorted(map(ord, set("".join(patterns)))), "<u4")
    none = len(letters)  # matches nothing: other characters, and the end

    def numbers(t: str) -> np.ndarray:
        c = np.frombuffer(t.encode("utf-32-le"), "<u4")
        at = np.minimum(np.searchsorted(letters, c), none - 1)
        return np.where(letters[at] == c, at, none)

    n, width = len(use), -(-max(map(len, patterns)) // 64)
    peq = np.zeros((width, len(patterns) * (none + 1)), np.uint64)
    for p, k in patterns.items():
        at = np.arange(len(p))
        np.bitwise_or.at(peq, (at // 64, k * (none + 1) + numbers(p)), np.uint64(1) << (at % 64).astype(np.uint64))
    longest = max(len(tests[i][-2]) for i in use)
    text = np.full((longest, n), none, np.int64)
    for k, i in enumerate(use):
        c = numbers(tests[i][-2])
        text[: len(c), k] = c
    text += np.array([patterns[tests[i][-3]] * (none + 1) for i in use])
    size = np.array([len(tests[i][-3]) for i in use])
    tops = [np.where((size - 1) // 64 == w, np.uint64(1) << ((size - 1) % 64).astype(np.uint64), np.uint64(0)) for w in range(width)]
    one, high = np.uint64(1), np.uint64(63)
    vp, vn = [np.full(n, ~np.uint64(0)) for _ in range(width)], [np.zeros(n, np.uint64) for _ in range(width)]
    score, best = size.copy(), size.copy()
    for row in text:
        carry = p_in = n_in = np.zeros(n, np.uint64)
        for w in range(width):
            eq = peq[w].take(row)
            a = eq & vp[w]
            total = a + vp[w]
            over = total < a
            total += carry
            carry = (over | (total < carry)).astype(np.uint64)
            d0 = (total ^ vp[w]) | eq | vn[w]
            hp = vn[w] | ~(d0 | vp[w])
            hn = d0 & vp[w]
            score += ((hp & tops[w]) != 0).astype(np.int64) - ((hn & tops[w]) != 0)
            p_out, n_out = hp >> high, hn >> high
            hp, hn = hp << one | p_in, hn << one | n_in
            p_in, n_in = p_out, n_out
            vp[w], vn[w] = hn | ~(d0 | hp), d0 & hp
        np.minimum(best, score, out=best)
    out[use] = best <= np.array([tests[i][-1] for i in use])
    return out


LANES = 1 << 14


def _least(peq: np.ndarray, size: np.ndarray, text: np.ndarray, first: np.ndarray, stop: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Least edit distance of patterns of up to 64 symbols to any substring of
    text[first:stop], many at a time.  ``peq[base + symbol]``: the pattern's bits."""
    out = np.empty(len(size), np.int64)
    order = np.argsort(stop - first, kind="stable")
    one = np.uint64(1)
    for k in range(0, len(order), LANES):
        i = order[k : k + LANES]
        a, n, row = first[i], (stop - first)[i], base[i]
        top = one << (size[i] - 1).astype(np.uint64)
        vp, vn = np.full(len(i), ~np.uint64(0)), np.zeros(len(i), np.uint64)
        score, best = size[i].astype(np.int32), size[i].astype(np.int32)
        for j in range(int(n[-1]) if len(n) else 0):
            c = text.take(a + j, mode="clip").astype(np.int64)
            c[n <= j] = 255  # matches nothing
            eq = peq.take(row + c)
            d0 = (((eq & vp) + vp) ^ vp) | eq | vn
            hp = vn | ~(d0 | vp)
            hn = d0 & vp
            score += (hp & top) != 0
            score -= (hn & top) != 0
            hp <<= one
            hn <<= one
            vp = hn | ~(d0 | hp)
            vn = d0 & hp
            np.minimum(best, score, out=best)
        out[i] = best
    return out


class Windows:
    """The windows of one class of items, with their repetitions."""

    def __init__(self, shape: Shape, chosen: list[int], texts: list[bytes], rounds: int):
        self.shape = shape
        gap = np.zeros(shape.steps + 1, np.uint8)
        pieces, starts, item, begin, at = [], [], [], [], 0
        for k in chosen:  # walks end in zeros after each item
            t = np.frombuffer(texts[k], np.uint8)
            s = _starts(t, np.array([0, len(t)]))
            s = s[s <= max(0, len(t) - shape.steps // 2)]
            pieces += [t, gap]
            starts.append(s + at)
            begin.append(s)
            item.append(np.full(len(s), k))
            at += len(t) + len(gap)
        self.flat = np.concatenate(pieces)
        self.starts, self.begin, self.item = np.concatenate(starts), np.concatenate(begin), np.concatenate(item)
        self.walks: list[tuple] = []
        for r in range(rounds):
            self.add(r)

    def add(self, seed: int) -> None:
        """Adds a repetition; ``PER_WALK`` of them share a walk."""
        if seed % PER_WALK == 0 or not self.walks:
            walk = Walk(self.shape, seed // PER_WALK)
            self.walks.append((walk, walk.embed(self.flat, self.starts), []))
        self.walks[-1][2].append(Samples(self.shape, seed, self.walks[-1][1]))

    def agree(self, padded: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (index of start, index of window) that agree in a repetition."""
        found, n = [np.zeros(0, np.int64)], len(self.starts)
        for a in range(0, len(starts), BLOCK):
            part, some = starts[a : a + BLOCK], []
            for walk, _, samples in self.walks:
                walked = walk.embed(padded, part)
                for s in samples:
                    i, j = s.agree(walked)
                    if len(i):
                        some.append((i + a) * n + j)
            if some:
                code = np.sort(np.concatenate(some))
                found.append(code[np.append(True, code[1:] != code[:-1])])
        code = np.concatenate(found)
        return code // max(n, 1), code % max(n, 1)


class Items:
    """Benchmark items: windows by class, and short items by their bytes."""

    def __init__(self, ids: list, texts: list[str], rounds: dict | None, similarity: float):
        self.ids, self.similarity = ids, similarity
        data, offs = text_buffers(pa.array(texts, pa.string()))
        raw = [_FOLD[data[i:j]].tobytes() for i, j in zip(offs[:-1], offs[1:])]
        self.texts = [t.decode() for t in raw]
        self.short: dict[int, dict[bytes, list[int]]] = {}
        classes: dict[int, list[int]] = {}
        for k, t in enumerate(raw):
            if len(t.strip()) < SHORT:
                if t.strip():
                    self.short.setdefault(len(t.strip()), {}).setdefault(t.strip(), []).append(k)
            else:
                classes.setdefault(next(n for n, s in enumerate(SHAPES) if len(t) >= s.size or n + 1 == len(SHAPES)), []).append(k)
        # pieces of up to 64 symbols (first bytes of characters), for a bound
        self.pieces: list[list[tuple]] = []  # per item: (row, offset, size)
        rows = []
        for t in raw:
            x = np.frombuffer(t, np.uint8)
            x = x[x & 192 != 128]
            n = -(-len(x) // 64)
            cut = [len(x) * k // max(n, 1) for k in range(n + 1)]
            self.pieces.append([(len(rows) + k, cut[k], cut[k + 1] - cut[k]) for k in range(n)])
            for k in range(n):
                peq = np.zeros(256, np.uint64)
                np.bitwise_or.at(peq, x[cut[k] : cut[k + 1]].astype(np.int64), np.uint64(1) << np.arange(cut[k + 1] - cut[k], dtype=np.uint64))
                peq[255] = 0
                rows.append(peq)
        self.peq = np.concatenate(rows) if rows else np.zeros(0, np.uint64)
        self.bytes = np.array([len(t) for t in raw], np.int64)
        self.most = np.array([int((1 - similarity) * len(t) + 1e-9) for t in self.texts], np.int64)
        self.plain = np.array([t.isascii() for t in raw], bool)
        self.windows = {n: Windows(SHAPES[n], c, raw, (rounds or {}).get(n, 0)) for n, c in sorted(classes.items())}

    def candidates(self, data: np.ndarray, offs: np.ndarray):
        """Distinct (document, item, byte where the item would begin)."""
        starts = _starts(data, offs)
        padded = np.concatenate([_FOLD[data], np.zeros(2, np.uint8)])
        found = [np.zeros((3, 0), np.int64)]
        for w in self.windows.values():
            i, j = w.agree(padded, starts)
            doc = np.searchsorted(offs, starts[i], side="right") - 1
            found.append(np.stack([doc, w.item[j], starts[i] - w.begin[j]]))
        doc, item, begin = np.concatenate(found, axis=1)
        order = np.lexsort((begin, item, doc))
        doc, item, begin = doc[order], item[order], begin[order]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (begin[1:] != begin[:-1])
        return np.stack([doc[new], item[new], begin[new]], 1)

    def plausible(self, got: np.ndarray, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Which candidates the least distances of their items' pieces, each
        near its place, let be within bounds: together they are at most the
        distance of the item."""
        if not len(got):
            return np.zeros(0, bool)
        lead = data & 192 != 128
        at = np.concatenate([[0], np.cumsum(lead)])  # characters before a byte
        wide = np.concatenate([[0], np.cumsum(data >= 128)])
        doc, item, begin = got.T
        low, high = offs[doc], offs[doc + 1]
        most, slack = self.most[item], 4 * self.most[item] + 8
        a, z = np.maximum(low, begin - slack), np.minimum(high, begin + self.bytes[item] + slack)
        slack = np.where(self.plain[item] & (wide[z] == wide[a]), most + most // 2 + 8, slack)
        count = np.array([len(p) for p in self.pieces])[item]
        row = np.repeat(np.arange(len(got)), count)
        flat = np.array([x for p in self.pieces for x in p], np.int64).reshape(-1, 3)
        start = np.cumsum([0, *map(len, self.pieces)])[item]
        piece, offset, size = flat[ranges(start, count)].T
        # the item's begin may lie before the document's
        home = at[np.clip(begin, 0, len(data))] + np.minimum(begin, 0)
        first = np.maximum(at[low][row], home[row] + offset - slack[row])
        stop = np.minimum(at[high][row], home[row] + offset + size + slack[row])
        least = _least(self.peq, size, _FOLD[data][lead], first, np.maximum(stop, first), piece * 256)
        return np.bincount(row, least, len(got)) <= most

    def exact(self, data: np.ndarray, offs: np.ndarray):
        """(document, item, byte where it begins) of short items, between
        letters, digits and bytes of other scripts on neither side."""
        folded = _FOLD[data]
        n = len(folded)
        inside = np.zeros(n + 1, bool)  # whether no word ends before this byte
        inside[1:n] = _WORD[folded[:-1]] & _WORD[folded[1:]]
        inside[offs] = False
        edge = np.flatnonzero(~inside[:n])
        sums = prefix_sums(folded)
        for size, known in self.short.items():
            at = edge[edge + size <= n]
            at = at[~inside[at + size]]
            keys = list(known)
            flat = np.frombuffer(b"".join(keys), np.uint8)
            ends = np.arange(len(keys) + 1) * size
            want = span_hash(prefix_sums(flat), ends[:-1], ends[1:])
            at = at[np.isin(span_hash(sums, at, at + size), want)]
            doc = np.searchsorted(offs, at, side="right") - 1
            for d, a in zip(doc.tolist(), at.tolist()):
                if a + size <= offs[d + 1]:
                    for k in known.get(folded[a : a + size].tobytes(), ()):
                        yield d, k, a

    def matches(self, batch: pa.RecordBatch, text_col: str):
        """(row, item index, edits, end character) of every contaminated pair."""
        data, offs = text_buffers(column(batch, text_col))
        if not len(data):
            return
        done: set = set()
        for doc, item, a in self.exact(data, offs) if self.short else ():
            if (doc, item) not in done:
                done.add((doc, item))
                before = data[offs[doc] : a].tobytes().decode("utf-8", "ignore")
                yield doc, item, 0, len(before) + len(self.texts[item].strip())
        if not self.windows:
            return
        got = self.candidates(data, offs)
        got = got[self.plausible(got, data, offs)]
        tried: dict = {}
        open_: list = []
        for doc, item, begin in got.tolist():
            text = self.texts[item]
            most = int((1 - self.similarity) * len(text) + 1e-9)
            near = tried.get((doc, item))
            if near is not None and begin - near <= most // 2:
                continue  # this window has just been searched
            tried[doc, item] = begin
            # bytes before and after in which the item may lie, by its edits
            slack = 4 * most + 8
            a = max(int(offs[doc]), begin - slack)
            z = min(int(offs[doc + 1]), begin + len(text.encode()) + slack)
            if not (data[a:z] & 128).any():  # a byte a character: no start is further off than all edits
                slack = most + most // 2 + 8
                a, z = max(a, begin - slack), min(z, begin + len(text) + slack)
            part = _FOLD[data[a:z]].tobytes().decode("utf-8", "ignore")
            open_.append((doc, item, a, text, part, most))
        open_.sort(key=lambda x: len(x[3]))
        within = np.concatenate([_within(open_[k : k + 2048]) for k in range(0, len(open_), 2048)] or [np.zeros(0, bool)])
        for k in sorted(np.flatnonzero(within).tolist(), key=lambda k: open_[k][:3]):
            doc, item, a, text, part, most = open_[k]
            if (doc, item) in done:
                continue
            edits, end = least_distance(text, part)
            if edits <= most:
                done.add((doc, item))
                before = data[offs[doc] : a].tobytes().decode("utf-8", "ignore")
                yield doc, item, edits, len(before) + end


def _edited(text: str, most: int, rnd: random.Random, words: bool) -> str:
    """The text with ``most`` random edits, or with one in every word."""
    out = list(text)
    if words:
        ends = [k for k, c in enumerate(out) if c == " "] + [len(out)]
        at = [rnd.randrange(a, z) for a, z in zip([0] + [k + 1 for k in ends], ends) if z > a]
        at = rnd.sample(at, min(most, len(at)))
    else:
        at = rnd.sample(range(len(out)), most)
    for k in at:
        c = rnd.choice(text)
        out[k] = rnd.choice(["", c, out[k] + c])
    return "".join(out)


def rounds_for(texts: list[str], similarity: float, recall: float = 0.99, sample: int = 60) -> dict[int, tuple[int, float]]:
    """Per class of items, (least number of repetitions by which edited items
    are found with this recall at the full threshold, that recall): of a sample
    of all items of the class and of one of its shortest third, the lower."""
    items = Items([], texts, None, similarity)
    out = {}
    for n, w in items.windows.items():
        by = sorted({items.texts[k] for k in w.item.tolist()}, key=lambda t: (len(t), t))
        if not by:
            out[n] = (1, 1.0)
            continue
        third = by[: max(1, len(by) // 3)]
        pick = lambda xs: [xs[k * len(xs) // min(sample, len(xs))] for k in range(min(sample, len(xs)))]
        low, rnd = pick(third), random.Random(17)
        some = low + pick(by)
        rows = [(k, _edited(t, int((1 - similarity) * len(t) + 1e-9), rnd, way % 2 == 1)) for k, t in enumerate(some) for way in range(4)]
        want = np.array([k for k, _ in rows])
        data, offs = text_buffers(pa.array([f"some words {t} and others" for _, t in rows], pa.string()))
        padded = np.concatenate([_FOLD[data], np.zeros(2, np.uint8)])
        starts = _starts(data, offs)
        doc = np.searchsorted(offs, starts, side="right") - 1
        tried = Windows(w.shape, list(range(len(some))), [t.encode() for t in some], 0)
        hit, short, reached = np.zeros(len(rows), bool), want < len(low), 0.0
        for r in range(MOST_ROUNDS):
            if r % PER_WALK == 0:
                tried.walks = []
            else:
                tried.walks[-1][2].clear()
            tried.add(r)
            i, j = tried.agree(padded, starts)
            d = doc[i]
            hit[d[want[d] == tried.item[j]]] = True
            reached = min(hit[short].mean(), hit[~short].mean())
            if reached >= recall:
                break
        out[n] = (min(MOST_ROUNDS, -(-MARGIN * (r + 1) // 100)), float(reached))
    return out


_BUILT: dict = {}


def built(block: tuple) -> Items:
    """The sketches of a block, made once in each Python worker."""
    key = hash(block)
    if key not in _BUILT:
        _BUILT.clear()
        ids, texts, rounds, similarity = block
        _BUILT[key] = Items(list(ids), list(texts), dict(rounds), similarity)
    return _BUILT[key]


def _blocks(items: DataFrame, id_col: str, text_col: str, rounds: int | None, similarity: float, recall: float):
    """Items in blocks of bounded size, fetched one block's rows at a time."""

    def made():
        need = {n: rounds for n in range(len(SHAPES))} if rounds else {n: r for n, (r, _) in rounds_for(texts, similarity, recall).items()}
        return tuple(ids), tuple(texts), tuple(need.items()), similarity

    rows = items.where(F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    ids, texts, size = [], [], 0
    for r in rows.toLocalIterator():
        if ids and size + len(r["text"]) > BLOCK_BYTES:
            yield made()
            ids, texts, size = [], [], 0
        ids.append(r["id"])
        texts.append(r["text"])
        size += len(r["text"])
    if ids:
        yield made()


FOUND = "id long, item_id long, n_edits long, item_chars long, end_char long"


def find(
    docs: DataFrame, items: DataFrame, similarity: float = 0.8, rounds: int | None = None,
    id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", recall: float = 0.99,
) -> DataFrame:
    """One row per document and item it contains: id, item_id, n_edits,
    item_chars, end_char (where the passage ends in the document)."""
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    out = None
    for block in _blocks(items, item_id_col, item_text_col, rounds, similarity, recall):

        def run(batches, block=block):
            block = built(block)
            for b in chunks(batches, "text", 4 << 20):
                got = list(block.matches(b, "text"))
                ids = column(b, "id")
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array([g[0] for g in got], pa.int64())),
                        pa.array([block.ids[g[1]] for g in got], pa.int64()),
                        pa.array([g[2] for g in got], pa.int64()),
                        pa.array([len(block.texts[g[1]]) for g in got], pa.int64()),
                        pa.array([g[3] for g in got], pa.int64()),
                    ],
                    ["id", "item_id", "n_edits", "item_chars", "end_char"],
                )

        one = docs.mapInArrow(task(run), FOUND)
        out = one if out is None else out.unionByName(one)
    if out is None:
        out = docs.sparkSession.createDataFrame([], FOUND)
    return out.withColumnRenamed("id", id_col)


def clean(
    docs: DataFrame, items: DataFrame, similarity: float = 0.8, rounds: int | None = None,
    text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", recall: float = 0.99,
) -> DataFrame:
    """The input without the documents that contain an item."""
    for block in _blocks(items, item_id_col, item_text_col, rounds, similarity, recall):

        def run(batches, block=block):
            block = built(block)
            for b in chunks(batches, text_col, 4 << 20):
                keep = np.ones(b.num_rows, bool)
                for doc, *_ in block.matches(b, text_col):
                    keep[doc] = False
                yield b.filter(pa.array(keep))

        docs = docs.mapInArrow(task(run), docs.schema)
    return docs
