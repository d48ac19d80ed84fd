"""Alignment of two tokenizers over the same bytes.

Both token sequences of a text cut the bytes of space + text.  Offsets where
both cut make the groups; a link is a pair of token occurrences, one of each
side, whose byte ranges overlap.

Method: Arrow batches are tokenised into id and end arrays; everything after
that is Spark's own functions.  ``array_except`` of the ends gives the cuts of
one side only, which are few.  Sorted together with the left side's ends, their
places tell which token of the other side they are in.  For links, each side's
tokens are repeated at the cuts that only the other side has; both sides then
have a token at every cut, and one ``zip_with`` names the pairs.  Each cut ends
exactly one overlap, hence one link.  For groups, marks are sorted in behind the
tokens that end none, the ids are joined to one string and that is split at the
groups' ends.
Lambdas are interpreted, so those over all tokens are kept short; sorts and sets
are compiled, and no array is searched or copied for an element.  Counts by
pair are one aggregation with partial sums in every task.  They come back to
the documents by a join: broadcast where the counted pairs are few (vocabularies
bound them, not the corpus; see BROADCAST_PAIRS), else by an exchange of each
document's own distinct pairs.  Both give the same rows.

Defined cases: a text that is null or empty, or whose tokens' bytes on either
side are not those of space + text, has no tokens: zeros, and '' for the digest.
Repeated texts count each time; ids may be null or repeated (a result row per
input row).  Very long texts cost time and memory in proportion, n log n for
the sort.  An empty table gives an empty result.  Further columns of the input
are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from .common import chunks, column, task, written
from .vocabulary import Vocabulary, load

INTS, LONGS = ArrayType(IntegerType(), False), ArrayType(LongType(), False)
LOW = 2**32 - 1
SHIFT = 34  # bits for a link's code below a cut's byte offset, 31 at least
BROADCAST_PAIRS = 2_000_000  # at most this many counted pairs (about 24 bytes each) are broadcast


def _ids_and_ends(vocab: Vocabulary, texts: list[str], whole: list[bytes]):
    """Ids and byte ends of each text, or None where the bytes differ."""
    out = []
    for ids, want in zip(vocab.arrays(texts if vocab.leading_space else [" " + x for x in texts]), whole):
        ends = np.cumsum(vocab.sizes[ids], dtype=np.int64)
        same = len(ids) and ends[-1] == len(want) and (vocab.lossless or vocab.joined(ids.tolist()) == want)
        out.append((ids, ends) if same else None)
    return out


COLUMNS = ("a_ids", "a_keys", "a_codes", "b_ids", "b_keys", "b_codes")


def tokenise(docs: DataFrame, left: str, right: str, id_col: str = "doc_id", text_col: str = "text", shift: int = SHIFT) -> DataFrame:
    """id, a_ids, a_keys, a_codes, b_ids, b_keys, b_codes.  A token's key is its
    byte end in space + text, times 2**shift; the codes of two tokens of one key
    differ by left id * number of right ids + right id."""

    def run(batches):
        a, b = load(left), load(right)
        sides_of_code = len(b.pieces), -1
        if len(a.pieces) * len(b.pieces) >= 1 << shift:
            raise ValueError(f"links of these vocabularies need more than {shift} bits")
        nothing = np.zeros(0, np.int32), np.zeros(0, np.int64)
        for batch in chunks(batches, "text", 256 << 10):
            texts = [x or "" for x in column(batch, "text").to_pylist()]
            whole = [(" " + x).encode() for x in texts]
            if max(map(len, whole)) >= 1 << (63 - shift):
                raise ValueError("a text is too long for its cuts' keys")
            sides = list(zip(_ids_and_ends(a, texts, whole), _ids_and_ends(b, texts, whole)))
            sides = [(x, y) if t and x and y else (nothing, nothing) for t, (x, y) in zip(texts, sides)]
            lists = []
            for side in (0, 1):
                offsets = pa.array(np.cumsum([0, *(len(s[side][0]) for s in sides)]), pa.int32())
                ids, ends = (np.concatenate([s[side][k] for s in sides]) for k in (0, 1))
                keys = ends << shift
                for values, kind in ((ids, pa.int32()), (keys, pa.int64()), (keys + ids.astype(np.int64) * sides_of_code[side], pa.int64())):
                    lists.append(pa.ListArray.from_arrays(offsets, pa.array(values, kind)))
            yield pa.RecordBatch.from_arrays([column(batch, "id"), *lists], ["id", *COLUMNS])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kinds = StructType([StructField("id", rows.schema["id"].dataType), *[StructField(c, INTS if "ids" in c else LONGS, False) for c in COLUMNS]])
    return rows.mapInArrow(task(run), kinds)


def align(tokens: DataFrame, right_size: int, shift: int = SHIFT) -> DataFrame:
    """Adds n_a, n_b, n_groups, n_links, a_groups and b_groups (ids of each group's
    tokens, joined by commas), cut_a and cut_b (tokens of each side up to the end
    of each group) and links (left id * right_size + right id, in order)."""
    low = (1 << shift) - 1
    rows = tokens.withColumns({"only_a": F.array_except("a_keys", "b_keys"), "only_b": F.array_except("b_keys", "a_keys")})
    # both kinds of cut with their number among their kind, in the left side's order
    number = lambda c, kind: F.expr(f"transform({c}, (x, k) -> x + (shiftleft(cast(k as bigint), 2) + {kind}L))")
    rows = rows.withColumn("mixed", F.sort_array(F.concat("a_keys", number("only_a", 1), number("only_b", 2))))
    rows = rows.withColumn("marks", F.expr(f"array_remove(transform(mixed, (v, p) -> if((v & 3L) = 0L, 0L, shiftleft(cast(p as bigint), 32) | (v & {low}L))), 0L)"))
    # i: the left token that a cut ends or is in; own: 1 for the left side's; apart: from there to the right token
    rows = rows.withColumn(
        "odd",
        F.expr(f"""transform(marks, (v, q) -> named_struct(
            'i', cast(shiftright(v, 32) as int) - q - cast(v & 1L as int), 'own', cast(v & 1L as int),
            'apart', if((v & 1L) = 1L, q - 2 * cast(shiftright(v & {LOW}L, 2) as int), 2 * cast(shiftright(v & {LOW}L, 2) as int) - q)))"""),
    )
    rows = rows.withColumns({
        "a_all": F.sort_array(F.concat("a_codes", F.expr(f"zip_with(only_b, filter(odd, x -> x.own = 0), (v, x) -> v + a_ids[x.i] * {right_size}L)"))),
        "b_all": F.sort_array(F.concat("b_codes", F.expr("zip_with(only_a, filter(odd, x -> x.own = 1), (v, x) -> v - b_ids[x.i + x.apart])"))),
        # marks behind the tokens that end no group
        "a_marked": F.sort_array(F.concat("a_codes", F.expr(f"transform(only_a, x -> x + {low}L)"))),
        "b_marked": F.sort_array(F.concat("b_codes", F.expr("transform(only_b, x -> x + 1L)"))),
        "stops": F.concat("odd", F.expr("array(named_struct('i', size(a_ids), 'own', 0, 'apart', size(b_ids) - size(a_ids)))")),
    })
    # runs of left tokens that end groups, each with the right token ``apart`` places on
    rows = rows.withColumns({
        "links": F.expr("zip_with(a_all, b_all, (x, y) -> x - y)"),
        "n_links": F.greatest(F.size("a_all"), F.size("b_all")).cast("long"),
        "blocks": F.expr("""filter(
            transform(stops, (x, q) -> named_struct('first', if(q = 0, 0, get(stops, q - 1).i + get(stops, q - 1).own), 'last', x.i - 1, 'apart', x.apart)),
            x -> x.first <= x.last)"""),
    })

    def groups(s: str, of_code: str, mark: int) -> F.Column:
        ids = F.expr(f"transform({s}_marked, v -> {of_code})").cast("array<string>")
        joined = F.replace(F.array_join(ids, ";"), F.lit(f";{mark};"), F.lit(","))
        return F.when(F.size(f"{s}_marked") > 0, F.split(joined, ";")).otherwise(F.array().cast("array<string>"))

    return rows.select(
        "id",
        F.size("a_ids").cast("long").alias("n_a"), F.size("b_ids").cast("long").alias("n_b"),
        (F.size("a_ids") - F.size("only_a")).cast("long").alias("n_groups"), "n_links",
        groups("a", f"(v & {low}L) div {right_size}L", low // right_size).alias("a_groups"),
        groups("b", f"-v & {low}L", low).alias("b_groups"),
        F.expr("flatten(transform(blocks, x -> sequence(x.first + 1, x.last + 1)))").alias("cut_a"),
        F.expr("flatten(transform(blocks, x -> sequence(x.first + x.apart + 1, x.last + x.apart + 1)))").alias("cut_b"),
        "links",
    )


def groups_text(aligned: DataFrame) -> DataFrame:
    """Adds groups: ``a1,a2|b1;a3|b2,b3`` with decimal ids in order."""
    return aligned.withColumn("groups", F.expr("array_join(zip_with(a_groups, b_groups, (x, y) -> concat(x, '|', y)), ';')")).drop("a_groups", "b_groups")


def pair_counts(rows: DataFrame, right_size: int) -> DataFrame:
    """pair, n (links of the corpus), best (no pair with its right id has more)."""
    counts = rows.select(F.explode("links").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    # at most one row for each left id meets in a group, whatever the corpus
    top = F.expr(f"max(n) over (partition by pair % {right_size})")
    return counts.select("pair", "n", (F.col("n") == top).alias("best"))


def statistics(
    docs: DataFrame, left: str, right: str, id_col: str = "doc_id", text_col: str = "text", broadcast_pairs: int = BROADCAST_PAIRS
) -> DataFrame:
    """One row per input row: id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256."""
    size = len(load(right).pieces)
    shift = max(31, (len(load(left).pieces) * size).bit_length())
    aligned = groups_text(align(tokenise(docs, left, right, id_col, text_col, shift), size, shift))
    rows = written(
        aligned.select(
            F.monotonically_increasing_id().alias("row"), "id", "n_a", "n_b", "n_groups", "n_links",
            F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256"), "links",
        ),
        "token-links",
    )
    counts = written(pair_counts(rows, size), "token-pairs")
    each = rows.select("row", F.explode("links").alias("pair"))
    if counts.count() <= broadcast_pairs:
        found = each.join(F.broadcast(counts), "pair").withColumn("times", F.lit(1))
    else:
        own = each.groupBy("row", "pair").agg(F.count(F.lit(1)).alias("times"))
        found = own.join(counts.hint("shuffle_hash"), "pair")
    sums = found.groupBy("row").agg(F.sum(F.col("times") * F.col("n")).alias("count_sum"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return rows.drop("links").join(sums, "row", "left").select(
        F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256"
    )
