"""Token ids and token bytes of the installed tokenizer files.

``load`` gives one interface to byte-level BPE files (.json, tokenizers) and
SentencePiece models (.model): ids of texts without special tokens, whose
strings inside texts are plain text, and the bytes of each id.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache
from itertools import chain, islice

import numpy as np

from .token_counts import resolve


class Vocabulary:
    """``encode(texts)``: a list of id lists; ``arrays(texts)``: the same as numpy
    arrays; ``pieces``: bytes by id; ``sizes``: their lengths; ``leading_space``:
    whether encoding itself puts a space before the text; ``specials``: strings
    of the file's special tokens; ``lossless``: whether ids always join to the
    text's bytes, or else to another number of bytes."""

    def __init__(self, encode, pieces: list[bytes], leading_space: bool, specials: list[str], lossless: bool = False, arrays=None):
        self.encode = encode
        self.arrays = arrays or (lambda texts: [np.array(ids, np.int32) for ids in encode(texts)])
        self.lossless = lossless
        self.pieces = pieces
        self.sizes = np.array([len(p) for p in pieces], np.int64)
        self.leading_space = leading_space
        self.specials = specials

    def joined(self, ids) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids))


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies:
    printable ones stand for themselves, the others follow from U+0100."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = (b for b in range(256) if b not in shown)
    return {chr(b): b for b in shown} | {chr(0x100 + k): b for k, b in enumerate(rest)}


# fixed value: the word pattern of byte-level files, in a form with the same
# matches and less to go back over
WORDS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
#: Characters that every version of Unicode puts into the same classes: printable
#: ASCII and its white space, Latin letters, dashes and quotation marks.
PLAIN = re.compile("[\t\n\r -~¡-ÿĀ-ɏ‐-‧]*")


def _ranked(pieces: list[bytes], merges: int):
    """The ids by rank of merges, which is their order in the vocabulary: what
    the library computes, several times faster.  It is used for texts of plain
    characters, on whose words two libraries' tables of characters agree."""
    import tiktoken

    fast = tiktoken.Encoding("own", pat_str=WORDS, mergeable_ranks={p: i for i, p in enumerate(pieces[: 256 + merges])}, special_tokens={})
    return fast


def _merges_in_order(path: str) -> int:
    """The number of merges, if the file splits texts by the word pattern alone
    and its k-th merge makes the k-th token after the bytes; else 0."""
    import json

    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    first, model = file["pre_tokenizer"], file["model"]
    plain = file["normalizer"] is None and first["type"] == "ByteLevel" and not first["add_prefix_space"] and first.get("use_regex", True)
    options = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    if not plain or model["type"] != "BPE" or any(model.get(x) for x in options):
        return 0
    pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
    return len(model["merges"]) if all(model["vocab"].get(a + b) == 256 + k for k, (a, b) in enumerate(pairs)) else 0


def _byte_level(path: str) -> Vocabulary:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    t.encode_special_tokens = True
    alphabet, special = byte_alphabet(), {k for k, x in t.get_added_tokens_decoder().items() if x.special}
    vocab = t.get_vocab(with_added_tokens=True)
    pieces = [b""] * (max(vocab.values()) + 1)
    for token, i in vocab.items():
        pieces[i] = token.encode() if i in special else bytes(alphabet[c] for c in token)
    names = [token for token, i in vocab.items() if i in special]
    plain = lambda texts: [x.ids for x in t.encode_batch_fast(texts, add_special_tokens=False)]
    every_byte = set(bytes([b]) for b in range(256)) <= set(pieces)
    merges = _merges_in_order(path)
    if not merges:
        return Vocabulary(plain, pieces, False, names, every_byte)
    ranked = _ranked(pieces, merges)

    def by(one, other):
        def encode(texts):
            fits = [bool(PLAIN.fullmatch(x)) for x in texts]
            rest = [x for x, ok in zip(texts, fits) if not ok]
            others = iter(plain(rest) if rest else [])
            return [one(x) if ok else other(next(others)) for x, ok in zip(texts, fits)]

        return encode

    arrays = by(lambda x: ranked.encode_to_numpy(x, disallowed_special=()).astype(np.int32), lambda ids: np.array(ids, np.int32))
    return Vocabulary(by(ranked.encode_ordinary, list), pieces, False, names, every_byte, arrays)


PART = 600  # characters, about: the library's queue of merges grows with the text


def _parts(text: str) -> list[str]:
    """The text cut at single places before words: at spaces that follow another
    character, which the model puts back before each part."""
    parts, i, at = [], 0, PART
    while 0 <= (j := text.find(" ", at)) < len(text) - 1:
        at = j + 1
        if text[j - 1] not in " ▁":
            parts.append(text[i:j])
            i, at = at, at + PART
    return [*parts, text[i:]]


def _by_words(path: str) -> bool:
    """Whether texts are taken as they are, with a space before them, and no piece
    goes on over the beginning of a word; ids of each character follow."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    norm, trainer, kinds = proto.normalizer_spec, proto.trainer_spec, pb.ModelProto.SentencePiece
    as_is = norm.add_dummy_prefix and norm.escape_whitespaces and not norm.remove_extra_whitespaces and not norm.precompiled_charsmap
    marked = trainer.model_type == pb.TrainerSpec.BPE and trainer.byte_fallback and not trainer.treat_whitespace_as_suffix
    simple = all(p.type in (kinds.NORMAL, kinds.BYTE, kinds.UNKNOWN, kinds.CONTROL) for p in proto.pieces)
    return bool(as_is and marked and simple) and not any("▁" in p.piece.lstrip("▁") for p in proto.pieces if p.type == kinds.NORMAL)


def _sentencepiece(path: str) -> Vocabulary:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = []
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        pieces.append(bytes([int(piece[3:5], 16)]) if sp.is_byte(i) else piece.replace("▁", " ").encode())
    names = [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if sp.is_control(i)]
    if not _by_words(path):
        return Vocabulary(lambda texts: sp.encode(texts, num_threads=1), pieces, True, names)

    def encode(texts):
        parts = [_parts(x) for x in texts]
        ids = iter(sp.encode([x for p in parts for x in p], num_threads=1))
        return [next(ids) if len(p) == 1 else list(chain.from_iterable(islice(ids, len(p)))) for p in parts]

    # of a text with the mark itself, shorter bytes come back
    return Vocabulary(encode, pieces, True, names, True)


@lru_cache(maxsize=4)
def load(tokenizer: str) -> Vocabulary:
    """By path, or by the name of an installed public tokenizer file."""
    path = resolve(tokenizer)
    if path.endswith(".json"):
        return _byte_level(path)
    if path.endswith(".model"):
        return _sentencepiece(path)
    raise ValueError(f"a .json or .model file is needed, not {tokenizer}")
