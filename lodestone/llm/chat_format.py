"""Chat formatting at token level, with a loss mask, and its reading back.

A turn becomes

    <|im_start|> role <|im_sep|> text <|im_end|>

Role and text are encoded separately, without special tokens, and the three
marks are spliced in as reserved ids that follow the vocabulary, so no text can
produce one.  In the written form control strings that occur inside a role or
text are escaped: one backslash more after their first character
(``<|im_end|>`` to ``<\\|im_end|>``, that to ``<\\\\|im_end|>``), which is
undone by taking one away.  The mask marks the tokens of the texts of the roles
to learn from; segment borders come from prefix sums of segment lengths.

Method at scale: rows are dealt by range of (conversation, turn, role, text), so
a conversation with a third of all rows is spread over many tasks, in order.
Each task encodes its rows and takes prefix sums along its conversations; what
a conversation has in earlier tasks is added from one small row for each task.
A conversation stays a table of turns: nothing gathers it in one row.

Defined cases: a null role or text is empty; a null conversation id is a
conversation of its own; null turns come first; rows of one turn are ordered
by role, then text (null first), and repeated rows are kept.  Empty texts and
very long ones are turns like others.  An empty table gives an empty result.
Further columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, column, task, width, written
from .vocabulary import load

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
MARKS = (START, SEP, END)
TOKENIZER = "byte_bpe_50k.json"
PIECES = "conv_id long, part int, run int, turn_no long, first_token long, n_head int, ids array<int>, mask array<boolean>"


class Escape:
    """Makes control strings inside texts harmless, reversibly."""

    def __init__(self, controls):
        for c in controls:
            if not re.fullmatch(r"<\|[^<>\\]+\|>", c):
                raise ValueError(f"a control string is <|name|>, not {c!r}")
        names = "|".join(re.escape(c[2:-2]) for c in sorted(controls, key=len, reverse=True))
        self._put = re.compile(rf"<(\\*)\|({names})\|>")
        self._take = re.compile(rf"<\\(\\*)\|({names})\|>")

    def put(self, text: str) -> str:
        return self._put.sub(r"<\\\1|\2|>", text) if "|>" in text else text

    def take(self, text: str) -> str:
        return self._take.sub(r"<\1|\2|>", text) if "|>" in text else text


class Template:
    """Reserved ids and escapes over one vocabulary."""

    def __init__(self, tokenizer: str = TOKENIZER):
        self.vocab = load(tokenizer)
        if self.vocab.leading_space:
            raise ValueError("segments can be encoded separately only where encoding adds no space")
        self.start, self.sep, self.end = (len(self.vocab.pieces) + k for k in range(3))
        self.escape = Escape({*MARKS, *(s for s in self.vocab.specials if s.startswith("<|"))})

    def text(self, ids) -> str:
        """Text of plain ids, unescaped."""
        return self.escape.take(self.vocab.joined(ids).decode())

    def read(self, ids, mask):
        """(role, text, text under the mask, characters of the written form)."""
        if ids[0] != self.start or ids[-1] != self.end:
            raise ValueError("a turn begins and ends with its marks")
        at = ids.index(self.sep)
        head, body = self.vocab.joined(ids[1:at]).decode(), self.vocab.joined(ids[at + 1 : -1]).decode()
        learned = [i for i, m in zip(ids, mask) if m and i < self.start]
        n = len(START) + len(head) + len(SEP) + len(body) + len(END)
        return self.escape.take(head), self.escape.take(body), self.text(learned), n


def _lists(lengths: np.ndarray, values: np.ndarray, kind) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), pa.array(values, kind))


def _assemble(tokenizer: str, learn: tuple[str, ...], learn_end: bool):
    def run(batches):
        from pyspark import TaskContext

        part, t = TaskContext.get().partitionId(), Template(tokenizer)
        last, run_no, turn_no, offset = object(), -1, 0, 0
        for b in chunks(batches, "text", 1 << 20):
            convs = column(b, "conv_id").to_pylist()
            roles = [r or "" for r in column(b, "role").to_pylist()]
            texts = [x or "" for x in column(b, "text").to_pylist()]
            distinct = list(dict.fromkeys(roles))
            head = dict(zip(distinct, t.vocab.encode([t.escape.put(r) for r in distinct])))
            bodies = t.vocab.encode([t.escape.put(x) for x in texts])
            n_head = np.array([len(head[r]) + 2 for r in roles])
            n_body = np.array([len(x) for x in bodies])
            ids: list[int] = []
            for r, x in zip(roles, bodies):
                ids += [t.start, *head[r], t.sep, *x, t.end]
            # segments of a turn: head, body, end; their borders by prefix sums
            lengths = np.stack([n_head, n_body, np.ones_like(n_head)], 1).ravel()
            wanted = np.array([r in learn for r in roles])
            flags = np.stack([np.zeros_like(wanted), wanted, wanted & learn_end], 1).ravel()
            border = np.cumsum(lengths)
            mask = np.zeros(len(ids), np.int8)
            np.add.at(mask, (border - lengths)[flags], 1)
            ends = border[flags]
            np.add.at(mask, ends[ends < len(mask)], -1)
            mask = np.cumsum(mask).astype(bool)
            runs, turns, first = [], [], []
            sizes = n_head + n_body + 1
            for c, n in zip(convs, sizes.tolist()):
                if c != last:
                    last, run_no, turn_no, offset = c, run_no + 1, 0, 0
                runs.append(run_no)
                turns.append(turn_no)
                first.append(offset)
                turn_no, offset = turn_no + 1, offset + n
            yield pa.RecordBatch.from_arrays(
                [
                    column(b, "conv_id"), pa.array([part] * len(convs), pa.int32()), pa.array(runs, pa.int32()), pa.array(turns, pa.int64()),
                    pa.array(first, pa.int64()), pa.array(n_head, pa.int32()), _lists(sizes, ids, pa.int32()), _lists(sizes, mask, pa.bool_()),
                ],
                ["conv_id", "part", "run", "turn_no", "first_token", "n_head", "ids", "mask"],
            )

    return run


def format_turns(
    rows: DataFrame, tokenizer: str = TOKENIZER, learn: tuple[str, ...] = ("assistant",), learn_end: bool = False,
    conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """One row per turn: conv_id, turn_no (from 0), first_token (place of its
    first token in the conversation), n_head (tokens before the text), ids,
    mask.  The conversation's sequence is its turns' ids by first_token."""
    spark = rows.sparkSession
    plain = rows.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    order = ["conv_id", "turn", "role", "text"]
    dealt = plain.repartitionByRange(width(spark), *order).sortWithinPartitions(*order)
    pieces = written(dealt.mapInArrow(task(_assemble(tokenizer, learn, learn_end)), PIECES), "chat-turns")
    # only the first and last conversation of a task can go on in another: at
    # most two rows a task, however large the table
    runs = pieces.groupBy("part", "run", "conv_id").agg(F.count("*").alias("n"), F.sum(F.size("ids")).alias("tokens"))
    edge = runs.groupBy("part").agg(F.min_by(F.struct("run", "conv_id", "n", "tokens"), "run").alias("a"), F.max_by(F.struct("run", "conv_id", "n", "tokens"), "run").alias("b"))
    edges = edge.select("part", F.inline(F.array_distinct(F.array("a", "b"))))
    before = "over (partition by conv_id order by part, run rows between unbounded preceding and 1 preceding)"
    carried = edges.select(
        F.col("part").alias("p"), F.col("run").alias("r"),
        F.expr(f"coalesce(sum(n) {before}, 0)").alias("turns_before"), F.expr(f"coalesce(sum(tokens) {before}, 0)").alias("tokens_before"),
    ).where("turns_before > 0")
    joined = pieces.join(F.broadcast(carried), (F.col("part") == F.col("p")) & (F.col("run") == F.col("r")), "left")
    return joined.select(
        "conv_id",
        (F.col("turn_no") + F.coalesce("turns_before", F.lit(0))).alias("turn_no"),
        (F.col("first_token") + F.coalesce("tokens_before", F.lit(0))).alias("first_token"),
        "n_head", "ids", "mask",
    )


def read_turns(turns: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """What ``format_turns`` wrote, as texts again: conv_id, turn_no, role,
    text, learned (text under the mask), written_chars."""

    def run(batches):
        t = Template(tokenizer)
        for b in batches:
            got = [t.read(i, m) for i, m in zip(column(b, "ids").to_pylist(), column(b, "mask").to_pylist())]
            role, text, learned, n = zip(*got) if got else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [column(b, "conv_id"), column(b, "turn_no"), pa.array(role, pa.string()), pa.array(text, pa.string()), pa.array(learned, pa.string()), pa.array(n, pa.int64())],
                ["conv_id", "turn_no", "role", "text", "learned", "written_chars"],
            )

    kinds = "conv_id long, turn_no long, role string, text string, learned string, written_chars long"
    return turns.select("conv_id", "turn_no", "ids", "mask").mapInArrow(task(run), kinds)


def digests(turns: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """Per conversation: n_turns, turns_sha256 (role, newline, text, newline of
    each turn), loss_chars and loss_sha256 of the text under the mask, and
    formatted_chars.  Turns stream through the digests in order; no more than a
    batch of them is held.  A digest over a whole conversation is one chain, so
    one task reads it; everything before (encoding, masks, reading back) is
    spread by turns."""
    spark = turns.sparkSession
    read = read_turns(turns, tokenizer)

    def run(batches):
        last, state = None, None

        def done():
            n, h, chars, loss, written_chars = state
            return last[0], n, h.hexdigest(), chars, loss.hexdigest(), written_chars

        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        pack = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
        for b in batches:
            out = []
            cols = (column(b, c).to_pylist() for c in ("conv_id", "role", "text", "learned", "written_chars"))
            for conv, role, text, learned, n in zip(*cols):
                if last != (conv,):
                    if state:
                        out.append(done())
                    last, state = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                state[2] += len(learned)
                state[3].update(learned.encode())
                state[4] += n
            if out:
                yield pack(out)
        if state:
            yield pack([done()])

    kinds = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    ordered = read.repartition(width(spark), "conv_id").sortWithinPartitions("conv_id", "turn_no")
    return ordered.mapInArrow(task(run), kinds)
