"""Chat formatting, token alignment and the point-in-time join."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lodestone.llm import chat_format, point_in_time, token_alignment, vocabulary
from lodestone.llm.queries import oracle_sql, queries
from tests.conftest import SF, rows

BYTE, PIECE = "byte_bpe_50k.json", "piece_bpe_32k.model"


# ------------------------------------------------------------------ chat


@given(st.lists(st.sampled_from([*"<|\\>ab", "<|im_end|>", "<|im_start|>", "im_sep"]), max_size=30).map("".join))
@settings(max_examples=300, deadline=None)
def test_escape_is_reversible(text):
    e = chat_format.Escape(chat_format.MARKS)
    put = e.put(text)
    assert e.take(put) == text
    assert not any(m in put for m in chat_format.MARKS)


def test_escape_refuses_other_marks():
    for bad in ("im_end", "<|a<|>", "<|a\\|>", "<||>"):
        with pytest.raises(ValueError):
            chat_format.Escape([bad])


CHATS = [
    (1, 0, "system", "Be <|im_end|> brief"), (1, 1, "user", None), (1, 2, "assistant", ""), (1, 3, "assistant", "<\\|im_end|> <|endoftext|> ok"),
    (2, 5, "assistant", "late"), (2, None, "user", "no turn"), (2, 5, "assistant", "late"), (2, 5, None, "no role"), (2, 5, "a<|im_sep|>\nb", "odd role"),
    (None, 0, "user", "no id"), (None, 1, "assistant", "yes"), (3, 0, "assistant", "<|im_start|>" * 3000 + "é🙂" * 5000),
]


def _expected(chats):
    key = lambda r: tuple((x is not None, x) for x in r[1:])
    out = {}
    by = defaultdict(list)
    for r in chats:
        by[r[0]].append(r)
    for conv, rs in by.items():
        said = [(r[2] or "", r[3] or "") for r in sorted(rs, key=key)]
        all_of, loss = "".join(f"{a}\n{b}\n" for a, b in said), "".join(b for a, b in said if a == "assistant")
        out[conv] = (len(said), hashlib.sha256(all_of.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


CHAT_SCHEMA = "conv_id long, turn long, role string, text string"


def test_chat_small(spark):
    df = spark.createDataFrame(CHATS, CHAT_SCHEMA).withColumn("ids", F.lit(1)).withColumn("mask", F.lit("x"))
    turns = chat_format.format_turns(df)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat_format.digests(turns).collect()}
    assert got == _expected(CHATS)
    assert chat_format.digests(chat_format.format_turns(df.limit(0))).count() == 0


def test_chat_hot_conversation_is_one_sequence(spark):
    # one conversation over all tasks: places and turn numbers go on across them
    hot = [(7, t, "user" if t % 2 else "assistant", f"turn {t} " * (t % 5)) for t in range(400)]
    chats = hot + CHATS
    turns = chat_format.format_turns(spark.createDataFrame(chats, CHAT_SCHEMA).repartition(5)).cache()
    assert turns.where("conv_id = 7").select(F.spark_partition_id()).distinct().count() > 1
    at = 0
    t = chat_format.Template()
    for n, r in enumerate(turns.where("conv_id = 7").orderBy("turn_no").collect()):
        assert (r.turn_no, r.first_token) == (n, at) and len(r.ids) == len(r.mask)
        assert [i for i in r.ids if i >= t.start] == [t.start, t.sep, t.end]
        learned = [k for k, m in enumerate(r.mask) if m]
        assert learned == (list(range(r.n_head, len(r.ids) - 1)) if n % 2 == 0 else [])
        assert t.vocab.encode([hot[n][3]])[0] == r.ids[r.n_head : -1]
        at += len(r.ids)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat_format.digests(turns).collect()}
    assert got == _expected(chats)
    ends = chat_format.format_turns(spark.createDataFrame(CHATS, CHAT_SCHEMA), learn=("user",), learn_end=True).collect()
    assert all(r.mask[-1] == any(r.mask) for r in ends) and sum(r.mask[-1] for r in ends) == 3


def test_chat_query(spark, duck):
    got = queries()["op11_chat_formatting"](spark, SF).toPandas()
    assert -1 in set(got.conv_id) and rows(got) == rows(duck.execute(oracle_sql()["op11_chat_formatting"]).df())


# ------------------------------------------------------------- alignment


def _token_bytes():
    t = Tokenizer.from_file(public_tokenizers.path(BYTE))
    t.encode_special_tokens = True
    back = vocabulary.byte_alphabet()
    a = {i: bytes(back[c] for c in s) for s, i in t.get_vocab().items() if s != "<|endoftext|>"}
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(PIECE))
    b = {i: bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in range(sp.get_piece_size())}
    return t, sp, a, b


def brute_alignment(docs):
    t, sp, a_bytes, b_bytes = _token_bytes()
    sides, counts = [], Counter()
    for d, text in docs:
        a, b, whole = [], [], (" " + (text or "")).encode()
        if text:
            a, b = t.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
            if b"".join(a_bytes[i] for i in a) != whole or b"".join(b_bytes[i] for i in b) != whole:
                a, b = [], []
        links, groups, i, j, x, y, cut = [], [], 0, 0, 0, 0, (0, 0)
        while i < len(a) and j < len(b):
            links.append((a[i], b[j]))
            ex, ey = x + len(a_bytes[a[i]]), y + len(b_bytes[b[j]])
            if ex <= ey:
                i, x = i + 1, ex
            if ey <= ex:
                j, y = j + 1, ey
            if x == y:
                groups.append(",".join(map(str, a[cut[0] : i])) + "|" + ",".join(map(str, b[cut[1] : j])))
                cut = (i, j)
        counts.update(links)
        sides.append((d, a, b, links, groups))
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return sorted(
        (
            (d, len(a), len(b), len(g), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), hashlib.sha256(";".join(g).encode()).hexdigest() if a else "")
            for d, a, b, links, g in sides
        ),
        key=repr,
    )


COLS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_alignment_small(spark):
    texts = [
        None, "", " ", "\n", "a", "Hello world", "Hello world", "  two  spaces ", "▁ mark", "a▁b", "x\x00y", "<s></s><|endoftext|><0x41>", "日本語 тест 🙂🙂 é é",
        "don't\t stop\r\n", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "tab\tend\t", "﻿bom", "1234567890 3.14 x=y;",
    ]
    docs = [(i, t) for i, t in enumerate(texts)] + [(None, "null id"), (5, "Hello again"), (99, "word " * 30000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("pairs", F.lit(1)).withColumn("id", F.lit("x"))
    got = sorted((tuple(r[c] for c in COLS) for r in token_alignment.statistics(df, BYTE, PIECE).collect()), key=repr)
    assert got == brute_alignment(docs)
    other = token_alignment.statistics(df, BYTE, PIECE, broadcast_pairs=10)  # the way for many pairs
    assert sorted((tuple(r[c] for c in COLS) for r in other.collect()), key=repr) == got
    assert token_alignment.statistics(df.limit(0), BYTE, PIECE).count() == 0


def test_byte_level_ids_are_the_librarys(spark):
    t, v, rng = _token_bytes()[0], vocabulary.load(BYTE), random.Random(3)
    some = [*"ab Z é ß×÷ '’\n\t .,;:!?1²½ªº-_ÁñĀɏ—“”‑¡«»日🙂", "'s", " don't", "<|endoftext|>", "  ", "\r\n", ". ", "ing", "tion", " of", "____", "00"]
    texts = ["".join(rng.choice(some) for _ in range(rng.randrange(60))) for _ in range(4000)] + [""]
    want = [t.encode(x, add_special_tokens=False).ids for x in texts]
    assert v.encode(texts) == want and [a.tolist() for a in v.arrays(texts)] == want
    every = [f"{c} {c}x 9{c}.{c}" for c in map(chr, range(0x2028)) if vocabulary.PLAIN.fullmatch(c)]
    assert v.encode(every) == [t.encode(x, add_special_tokens=False).ids for x in every]


def test_alignment_other_way_round(spark):
    df = spark.createDataFrame([(1, "Hello wörld")], "doc_id long, text string")
    size = len(vocabulary.load(BYTE).pieces)
    a = token_alignment.align(token_alignment.tokenise(df, BYTE, PIECE), 32000).first()
    b = token_alignment.align(token_alignment.tokenise(df, PIECE, BYTE), size).first()
    assert sorted((x // 32000, x % 32000) for x in a.links) == sorted((x % size, x // size) for x in b.links)
    assert (a.cut_a, a.cut_b) == (b.cut_b, b.cut_a)


def test_alignment_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries()["op12_token_alignment"](spark, SF)
    assert got.columns == COLS
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_alignment(docs)


def test_alignment_has_no_python_after_tokenising(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    rest = token_alignment.groups_text(token_alignment.align(token_alignment.tokenise(df, BYTE, PIECE), 32000))
    plan = rest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Python" not in plan


def test_alignment_lambdas_stay_short(spark):
    """Lambdas are interpreted for each token: the query's rows need few steps in them."""
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    rest = token_alignment.groups_text(token_alignment.align(token_alignment.tokenise(df, BYTE, PIECE), 32000))
    plan = rest.select("n_groups", "groups", "links")._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(" not in plan  # no walk over the places of each group


def test_pieces_cut_before_words_have_the_librarys_ids():
    sp, v, rng = _token_bytes()[1], vocabulary.load(PIECE), random.Random(5)
    some = [*"ab Z é.,1\n\t日🙂", " ", " ", "  ", "▁", "ing ", "tion", " of", "\x00", "<s>"]
    texts = ["".join(rng.choice(some) for _ in range(rng.randrange(4000))) for _ in range(150)] + ["", " ", " " * 2000, "x" * 599 + " ", "x" * 600 + "  y", "x" * 3000]
    assert max(len(vocabulary._parts(x)) for x in texts) > 3
    assert v.encode(texts) == sp.encode(texts)


# --------------------------------------------------------- point in time


def brute_join(asks, versions):
    out = []
    for k, (source, t) in enumerate(asks):
        ok = [
            v for v in versions
            if source is not None and t is not None and v[0] == source and None not in v[1:4] and v[1] <= t and v[2] <= t < v[3]
        ]
        best = max(ok, key=lambda v: (v[1], -v[2], v[4] is not None, v[4], v[5]), default=None)
        out.append((k, best and (best[1], best[2], best[3], best[4], best[5])))
    return sorted(out, key=repr)


VERSION = "source string, event long, arrival long, expiry long, doc_id long, lang string"


def _found(spark, asks, versions, **more):
    a = spark.createDataFrame([(k, s, t, k) for k, (s, t) in enumerate(asks)], "best long, source string, t long, level long")
    v = spark.createDataFrame(versions, VERSION)
    got = point_in_time.join(a, v, carry=["lang"], **more)
    assert got.columns == ["best", "source", "t", "level", "winner"]
    return sorted(((r.best, r.winner and tuple(r.winner)) for r in got.collect()), key=repr)


times = st.integers(-40, 120)
maybe = lambda s: st.one_of(st.none(), s)


@given(
    st.lists(st.tuples(maybe(st.sampled_from("ab")), maybe(times)), max_size=25),
    st.lists(st.tuples(maybe(st.sampled_from("ab")), maybe(times), maybe(times), maybe(st.integers(-40, 900)), maybe(st.integers(0, 3)), st.sampled_from("xy")), max_size=25),
)
@settings(max_examples=8, deadline=None)
def test_point_in_time_random(spark, asks, versions):
    assert _found(spark, asks, versions) == brute_join(asks, versions)


def test_point_in_time_cases(spark):
    versions = [
        ("a", 10, 5, 20, 1, "x"), ("a", 10, 4, 20, 0, "x"), ("a", 10, 4, 20, 2, "x"), ("a", 10, 4, 20, 2, "y"), ("a", 12, 18, 19, 9, "x"), ("a", 30, 30, 30, 3, "x"),
        ("b", -10, -(10**9), 10**9, 4, "x"), (None, 0, 0, 50, 5, "x"), ("a", None, 0, 50, 6, "x"), ("c", 0, 0, 50, None, "x"),
    ]
    asks = [("a", 9), ("a", 10), ("a", 10), ("a", 18), ("a", 19), ("a", 20), ("a", 30), ("b", -11), ("b", 999_999_999), ("b", 10**9), (None, 5), ("a", None), ("c", 49), ("d", 1)]
    assert _found(spark, asks, versions) == brute_join(asks, versions)
    for levels in (1, 3, 12):  # the number of widths changes cost only
        assert _found(spark, asks, [v for v in versions if v[0] != "b"], levels=levels) == brute_join(asks, [v for v in versions if v[0] != "b"])
    assert _found(spark, [], versions) == [] and _found(spark, asks, []) == brute_join(asks, [])
    with pytest.raises(ValueError):
        _found(spark, asks, versions, into="LEVEL")


def test_point_in_time_hot_source_makes_no_pairs(spark):
    n = 4000
    versions = spark.range(n).selectExpr("'a' source", "id % 500 event", "id % 500 arrival", "id % 500 + 400 expiry", "id doc_id")
    asks = spark.range(n).selectExpr("'a' source", "id % 700 t")
    got = point_in_time.join(asks, versions)
    assert got.agg(F.sum("winner.id")).first()[0] == sum(max(range(e, n, 500)) for t in range(n) if (e := min(t % 700, 499)) + 400 > t % 700)
    bins = point_in_time.covering_bins(F.lit(3).cast("long"), F.lit(903).cast("long"), 6)
    assert spark.range(1).select(F.size(bins)).first()[0] < 30


def test_point_in_time_query(spark, duck):
    got = queries()["op13_point_in_time"](spark, SF).toPandas()
    assert rows(got) == rows(duck.execute(oracle_sql()["op13_point_in_time"]).df())
