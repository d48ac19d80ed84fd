"""Edits against a plain version over lines."""

import random

from pyspark.sql import functions as F

from lodestone.functions import edits
from tests.conftest import SF


def plain(text, old, new):
    n = text.count(old)
    target = old
    if n == 0:
        rows, old_rows = text.splitlines(keepends=True), old.splitlines()
        words = [x.strip() for x in old_rows if x.strip()]
        runs = [i for i in range(len(rows) - len(old_rows) + 1) if words and [x.strip() for x in rows[i : i + len(old_rows)] if x.strip()] == words]
        if len(runs) == 1:
            run = "".join(rows[runs[0] : runs[0] + len(old_rows)])
            return text.replace(run, new, 1), "lines"
        document = old.strip().lower().startswith(("<!doctype", "<html"))
        if document or len(rows) > 0 and len(old_rows) >= max(3, int(0.6 * len(rows))):
            return new, "document"
        return text, "absent"
    return (text.replace(target, new, 1), "exact") if n == 1 else (text, "ambiguous")


def got(spark, cases):
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, t string, o string, n string")
    return [tuple(r.e) for r in df.select("i", edits.edit_text(F.col("t"), F.col("o"), F.col("n")).alias("e")).orderBy("i").collect()]


def test_cases(spark):
    page = "def f(x):\n    if x:\n\n        return 1\n    return 2\n"
    cases = [
        (page, "return 1", "return 3"), (page, "return", "x"), (page, "if x:\nreturn 1", "pass"), (page, "  if x:\n\nreturn 1\n", "pass\n"), (page, "missing", "y"), (page, "", "z"), ("", "", "z"), ("", "a", "z"),
        ("a\n\nb\n\n\nc", "a\nb\n", "X"), ("a\n\nb\n\n\nc", " a \n\n b", "X"), ("x\ny\nx\ny\n", " x\n y", "X"), ("p\nq\nr\ns\n", "1\n2\n3", "new"), ("old page", "<HTML>\nx", "<html>y</html>"), ("a\r\nb\r\n", " a\nb ", "c"),
        ("a b\n", "\n\n", "x"), ("é🙂\n  ü\nz", "é🙂\nü", "ok"), ("one", "one", "$1\\"),
    ]
    assert got(spark, cases) == [plain(*c) for c in cases]


def test_random_lines(spark):
    rng = random.Random(2)
    some = lambda n: "".join(rng.choice(["a", " a", "b ", "\t", "", "  ", "c"]) + "\n" for _ in range(n))
    cases = [(some(rng.randrange(9)), some(rng.randrange(1, 4)).rstrip("\n") + rng.choice(["", "\n"]), "NEW\n") for _ in range(400)]
    cases = [c for c in cases if c[1].strip()]
    want = [plain(*c) for c in cases]
    assert got(spark, cases) == want and len({h for _, h in want}) >= 4


def test_over_documents(spark):
    docs = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 6000").limit(60).collect()]
    rng, cases = random.Random(3), []
    for t in docs:
        rows = t.splitlines()
        k = rng.randrange(len(rows))
        cases.append((t, "\n".join(f"  {x}\t" for x in rows[k : k + 2]), "[edited]"))
    assert got(spark, cases) == [plain(*c) for c in cases]
    many = spark.createDataFrame([("a\n b\nc\n",)], "t string").select(
        edits.edit_all(F.col("t"), F.array(*[F.struct(F.lit(o).alias("old"), F.lit(n).alias("new")) for o, n in (("a", "x"), ("x\nb", "y\nz"), ("q", "r"), ("c", ""))])).alias("e")
    )
    assert tuple(many.first().e) == ("y\nz\n", ["exact", "lines", "absent", "exact"]) or tuple(many.first().e) == ("y\nz\n\n", ["exact", "lines", "absent", "exact"])


def test_nested_fence(spark):
    raw = "Sure.\n```language\n# filepath: a/b.py\n# action: CREATE\n```python\nprint('x')\n\n```\n```\n"
    df = spark.createDataFrame([(raw,), ("```python\nx\n```",), (None,)], "r string")
    rows = [r.f for r in df.select(edits.recover_nested_fence(F.col("r")).alias("f")).collect()]
    assert tuple(rows[0]) == ("python", "# filepath: a/b.py\n# action: CREATE", "print('x')") and rows[1:] == [None, None]
