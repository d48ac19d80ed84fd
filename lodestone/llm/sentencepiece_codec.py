"""SentencePiece encoding and decoding by shared-prefix Viterbi.

A text is escaped as the library does (a mark before it and for every space)
and cut into marked words, which no piece crosses.  The distinct words of a
chunk are sorted, which lays them out as a trie in depth-first order: moving
from a word to the next keeps the forward table of their common prefix and
only extends it.  Entry d of the table holds the best score of a segmentation
of the first d characters and its last piece.

For a unigram model the best score is the largest sum of piece scores.  For a
BPE model a transition from one piece to the next is allowed only where merging
both pieces' characters by rank leaves the border between them; exactly one
segmentation of each prefix meets that, and it is the library's (merges inside
two neighbours happen in the same order alone as within a longer text).

Null texts: null ids.  Empty texts: no ids, decoded as empty.  Word results
are kept from chunk to chunk in a table of bounded size.  Row-wise, without
exchange: repeated rows, hot keys and further columns need no care.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, column, task
from .token_counts import resolve

MARK = "▁"
KEPT_WORDS = 250_000  # size bound of the table of known words, not of results


class Codec:
    """Pure-Python encoder and decoder of one ``.model`` file."""

    def __init__(self, model: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        proto.ParseFromString(open(resolve(model), "rb").read())
        kinds = pb.ModelProto.SentencePiece
        del sentencepiece
        self.bpe = proto.trainer_spec.model_type == pb.TrainerSpec.BPE
        norm = proto.normalizer_spec
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
            raise ValueError("only models with identity normalization are supported")
        self.prefix = norm.add_dummy_prefix
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.byte = [-1] * 256
        self.raw: list[bytes] = []
        self.unk = 0
        for i, p in enumerate(proto.pieces):
            raw = p.piece.replace(MARK, " ").encode()
            if p.type == kinds.NORMAL:
                self.score[p.piece], self.id[p.piece] = p.score, i
            elif p.type == kinds.BYTE:
                self.byte[int(p.piece[3:-1], 16)] = i
                raw = bytes([int(p.piece[3:-1], 16)])
            elif p.type == kinds.UNKNOWN:
                self.unk, raw = i, " ⁇ ".encode()
            elif p.type == kinds.CONTROL:
                raw = b""
            else:
                raise ValueError("user-defined pieces are not supported")
            self.raw.append(raw)
        self.fallback = proto.trainer_spec.byte_fallback
        self.low = min(self.score.values()) - 10.0  # the library's unknown penalty
        self.longest = max(map(len, self.score))
        trie: dict = {}
        for p in self.score:
            node = trie
            for c in p:
                node = node.setdefault(c, {})
            node[""] = p
        self.trie = trie
        known = {c for p in self.score for c in p}
        inside = any(MARK in p.lstrip(MARK) for p in self.score)
        alone = re.escape("".join(c for c in "\n\t\r" if c not in known))
        if inside:
            self.split = lambda s: [s]
        elif alone:
            self.split = re.compile(f"{MARK}+[^{MARK}{alone}]*|[{alone}]|[^{MARK}{alone}]+").findall
        else:
            self.split = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+").findall
        self.known: dict[str, bytes] = {}
        self.border: dict[tuple[str, str], bool] = {}

    def _merged(self, text: str) -> list[str]:
        """Plain BPE of a short string: best-ranked pair first, leftmost on ties."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _allowed(self, left: str, right: str) -> bool:
        key = (left, right)
        ok = self.border.get(key)
        if ok is None:
            if len(self.border) > 2_000_000:
                self.border.clear()
            ok = self.border[key] = self._merged(left + right) == ([left, right] if left else [right])
        return ok

    def _ids(self, piece: str) -> list[int]:
        i = self.id.get(piece)
        if i is not None:
            return [i]
        return [self.byte[b] for b in piece.encode()] if self.fallback else [self.unk]

    def learn(self, words) -> None:
        """Encode distinct new words, depth-first over their trie."""
        bpe, allowed, root = self.bpe, self._allowed, self.trie
        score = [0.0]  # forward scores by depth
        last: list[str] = [""]  # last piece of the best segmentation
        live: list[list] = [[]]  # pieces under way: (start, node of the piece trie)
        before = ""
        for word in sorted(words):
            depth, most = 0, min(len(before), len(word))
            while depth < most and before[depth] == word[depth]:
                depth += 1
            del score[depth + 1 :], last[depth + 1 :], live[depth + 1 :]
            for d in range(depth, len(word)):
                c = word[d]
                nodes = []
                best, piece = None, None
                for s, node in live[d]:
                    node = node.get(c)
                    if node is not None:
                        nodes.append((s, node))
                node = root.get(c)
                if node is not None:
                    nodes.append((d, node))
                for s, node in nodes:  # longest piece first
                    p = node.get("")
                    if p is None:
                        continue
                    if bpe:
                        if allowed(last[s], p):
                            best, piece = score[s] + self.score[p], p
                            break
                    else:
                        v = score[s] + self.score[p]
                        if best is None or v > best:
                            best, piece = v, p
                if piece is None or (not bpe and c not in self.score and best < score[d] + self.low):
                    best, piece = score[d] + self.low, c
                score.append(best)
                last.append(piece)
                live.append(nodes)
            before = word
            ids: list[int] = []
            d = len(word)
            while d > 0:
                p = last[d]
                ids[:0] = self._ids(p)
                d -= len(p)
            self.known[word] = np.array(ids, "<i4").tobytes()

    def units(self, text: str) -> list[str]:
        if not text:
            return []
        return self.split((MARK if self.prefix else "") + text.replace(" ", MARK))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        cut = [self.units(t) for t in texts]
        new = {w for ws in cut for w in ws}
        if len(self.known) + len(new) > KEPT_WORDS:
            self.known.clear()
        new.difference_update(self.known)
        self.learn(new)
        known = self.known.__getitem__
        out = [b"".join(map(known, ws)) for ws in cut]
        if not self.fallback:
            out = [self._one_unknown(x) for x in out]
        return out

    def _one_unknown(self, ids: bytes) -> bytes:
        """Neighbouring unknown characters are one unknown piece."""
        a = np.frombuffer(ids, "<i4")
        keep = np.ones(len(a), bool)
        keep[1:] = (a[1:] != self.unk) | (a[:-1] != self.unk)
        return a[keep].tobytes()

    def decode(self, ids) -> str:
        raw = b"".join(map(self.raw.__getitem__, ids))
        if self.prefix and raw.startswith(b" "):
            raw = raw[1:]
        return raw.decode("utf-8", "replace")


def _codec(model: str) -> Codec:
    """One codec per Python worker and model."""
    global _CODECS
    try:
        cache = _CODECS
    except NameError:
        cache = _CODECS = {}
    if model not in cache:
        cache[model] = Codec(model)
    return cache[model]


def encode(docs: DataFrame, model: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """The input with a column of piece ids."""
    if ids_col in docs.columns:
        docs = docs.drop(ids_col)
    schema = T.StructType([*docs.schema.fields, T.StructField(ids_col, T.ArrayType(T.IntegerType(), False))])

    def run(batches):
        codec = _codec(model)
        for b in chunks(batches, text_col, 2 << 20):
            texts = column(b, text_col).to_pylist()
            raw = codec.encode([t or "" for t in texts])
            size = np.array([len(r) // 4 for r in raw], np.int32)
            offs = np.zeros(len(raw) + 1, np.int32)
            np.cumsum(size, out=offs[1:])
            missing = np.array([t is None for t in texts])
            ids = pa.ListArray.from_arrays(
                pa.array(offs, pa.int32(), mask=np.append(missing, False)) if missing.any() else pa.array(offs),
                pa.array(np.frombuffer(b"".join(raw), "<i4")),
            )
            yield pa.RecordBatch.from_arrays([*b.columns, ids], [*b.schema.names, ids_col])

    return docs.mapInArrow(task(run), schema)


def decode(df: DataFrame, model: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """The input with the text that a column of piece ids stands for."""
    if text_col in df.columns:
        df = df.drop(text_col)
    schema = T.StructType([*df.schema.fields, T.StructField(text_col, T.StringType())])

    def run(batches):
        codec = _codec(model)
        for b in batches:
            texts = [None if x is None else codec.decode(x) for x in column(b, ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], [*b.schema.names, text_col])

    return df.mapInArrow(task(run), schema)


def round_trip(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every text in one pass: id, n_tokens, ids_sha256 (of
    the ids as little-endian 32-bit integers), decoded_sha256 (of the decoded
    text in UTF-8) and exact (the decoded text is the text; a text's own mark
    characters come back as spaces, as from the library)."""
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema["id"].dataType
    schema = T.StructType(
        [
            T.StructField("id", kind),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()),
            T.StructField("exact", T.BooleanType()),
        ]
    )

    def run(batches):
        codec = _codec(model)
        for b in chunks(batches, "text", 2 << 20):
            texts = [t or "" for t in column(b, "text").to_pylist()]
            raw = codec.encode(texts)
            n, sha, back, same = [], [], [], []
            for t, r in zip(texts, raw):
                got = codec.decode(np.frombuffer(r, "<i4").tolist())
                n.append(len(r) // 4)
                sha.append(hashlib.sha256(r).hexdigest())
                back.append(hashlib.sha256(got.encode()).hexdigest())
                same.append(got == t)
            yield pa.RecordBatch.from_arrays(
                [column(b, "id"), pa.array(n, pa.int64()), pa.array(sha), pa.array(back), pa.array(same)],
                schema.names,
            )

    return docs.mapInArrow(task(run), schema).withColumnRenamed("id", id_col)
