"""Secret scan with a random forest that removes false positives.

Two passes of one Java regular expression over a whole text give the candidates
and the text between them, so each candidate knows its neighbouring words:

* private key blocks (PEM, encrypted PEM, PGP) to their END line; where that is
  missing, the header and base64 lines after BEGIN,
* the password of ``scheme://user:password@host``,
* values of 6 or more characters after an assignment sign.  Quoted ones go to
  their own quote, with white space only where a secret's name is assigned to
  (else a quoted sentence would hide the candidates in it).  Bare ones go to white
  space, a quote, bracket or semicolon; ``, : & | =`` belong to them unless at
  the end or before another ``name=``; a URL is none,
* runs of 12 or more key characters anywhere.

Shorter values than these are not found, nor values after a name alone, without
a sign (``password hunter2``).

A random forest over

* length, and share of each character kind,
* character transitions (changes between lower case, upper case, digit, other),
* dictionary coverage (letters that belong to words of a word list),
* the path the text came from, and
* the words before and after, the name assigned to among them, and the place in
  a URL

decides which candidates are secrets.  It is trained from labelled findings
(value, left, right, path, label: any table of reviewed findings will do);
``labelled_findings`` makes some by rule from the public shapes of credentials
and of their look-alikes, as no given table has labelled ones.  Everything is
DataFrame expressions and Spark's own forest.

Candidates without digit, upper case, known beginning, assignment and secret word
before them are most of a text's long words.  The forest's largest probability among all such candidates is worked out
from its trees; where it is below the threshold, their features need not be.
Findings are the same with and without that.

Null and empty texts have no findings; a null path counts as an empty one.
A secret that occurs twice in a text gives two findings.  Rows are handled one
by one without exchange: hot keys, repeated rows and very long texts need no
care, empty tables give empty results.  Further columns are kept, whatever their
names; but ``scan`` leaves out those that have the name of one of its results.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce
from string import ascii_letters, digits

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import written

# fixed values: candidates, context words and path words
_KEY = r"[A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----"
_LINES = r"(?:\s{0,4}+(?:[A-Za-z\-]{2,30}: [^\r\n]{0,120}+|[A-Za-z0-9+/=]{16,}+)){0,400}+"
BLOCK = rf"-----BEGIN {_KEY}(?:[^\-]*+(?:-{{1,4}}+(?!-)[^\-]*+){{0,400}}+-----END {_KEY}|{_LINES})"
USERINFO = r"(?<=:)(?<=://[^\s/:@\"'<>]{0,64}:)[^\s/@\"'<>]{4,128}+(?=@[A-Za-z0-9\[])"
_NAMED = r"(?i:pass(?:word|wd|phrase)?|pwd|secret|token|api[_\-]?key|access[_\-]?key|private[_\-]?key|credential)[A-Za-z0-9_.\-]{0,16}[\"'\])]?\s{0,3}(?::=|=>|[=:])\s{0,3}"
NAMED = "|".join(rf"(?<={q})(?<={_NAMED}{q})(?=[^{q}\r\n]{{6}})[^{q}\\\r\n]{{0,200}}+(?:\\.[^{q}\\\r\n]{{0,200}}+){{0,20}}+(?={q})" for q in "\"'`")
QUOTED = r"(?<=[\"'`])(?<=[=:]\s{0,2}[\"'`])[^\s\"'`]{6,}+(?=[\"'`])"
_BARE = r"[^\s\"'`<>,;(){}\[\]=:&|]++"
BARE = rf"(?<=[=:\s])(?<=[=:]\s{{0,2}})(?!//|[A-Za-z][A-Za-z0-9+.\-]{{1,15}}://)(?=[^\s\"'`<>;(){{}}\[\]]{{6}}){_BARE}(?:[,:&|=]++(?![A-Za-z_][A-Za-z0-9_.\-]{{0,40}}=){_BARE}){{0,64}}+=*+"
RUN = r"(?<![A-Za-z0-9_+/\-])[A-Za-z0-9_+/\-]{12,}+"
CANDIDATE = f"{BLOCK}|{USERINFO}|{NAMED}|{QUOTED}|{BARE}|{RUN}"
LEAST = 6  # shorter candidates are none, but in URLs
SHAPES = r"AKIA|ASIA|ghp_|gho_|ghs_|glpat-|xox[abpr]-|sk_live_|sk-|rk_live_|AIza|eyJ|-----BEGIN"
ASSIGNED = r"[=:]\s*[\"'`]?$"
SECRET_WORDS = r"(?i)(pass(word|wd|phrase)?|pwd|secret|token|api[_-]?key|apikey|access[_-]?key|private[_-]?key|auth|bearer|credential|client[_-]?secret)"
DIGEST_WORDS = r"(?i)(?<![a-z])(sha-?\d*|md5|commit|checksum|digest|etag|revision|rev|uuid|guid|hash|fingerprint|integrity|blob)(?![a-z])"
TEST_PATHS = r"(?i)(test|spec|example|sample|fixture|mock|demo|doc)"
CONFIG_PATHS = r"(?i)(\.env|config|settings|secret|credential|\.ya?ml|\.ini|\.properties|\.tf)"
DICTIONARY = (
    "about access account action address admin after again agent allow alpha apple apply archive array assert asset author backup basic batch before begin beta "
    "binary block board branch bucket buffer build button cache call center change channel check child class clean client clone cloud cluster code color column command "
    "comment common compile component config connect console const contact container content context control cookie copy core count create current custom data "
    "database date debug default delete demo deploy detail device dict directory disable display document domain download driver edit element email enable engine "
    "error event example export extend external factory feature field file filter final find first folder font format frame function general generate global group "
    "handler header hello help home host html http image import index info init input insert instance int interface item java json key label language last layout "
    "length level library light line link list load local lock log login main manager map master match message method mode model module name network node note null "
    "number object offset open option order output package page panel param parent parse part password path pattern place player plugin point policy port post prefix "
    "print private process profile project property provider public query queue random range read record remove render report request reset resource response result "
    "return role root route rule sample save schema screen script search secret section select send server service session set size sort source space start state "
    "static status stop store stream string style submit switch system table target task template test text theme thread time title token type update upload user "
    "util value version video view wait watch widget width window word work world write your"
).split()
FEATURES = [
    "length", "lower", "upper", "digit", "other", "changes", "distinct", "hexadecimal", "coverage", "shape",
    "secret_before", "digest_near", "assigned", "keyed", "quoted", "joined", "called", "test_path", "config_path", "userinfo", "spaces",
]
NEAR = 40  # characters before a candidate that can name it
USER = r"://[^\s/:@\"'<>]{0,64}:$"


def _words() -> str:
    """The dictionary's longer words as one expression, by first letter."""
    by: dict[str, list] = {}
    for w in sorted((w for w in DICTIONARY if len(w) >= 4), key=lambda w: (-len(w), w)):
        by.setdefault(w[0], []).append(w[1:])
    return "|".join(f"{c}(?:{'|'.join(ws)})" for c, ws in sorted(by.items()))


def kinds_of(value: Column) -> Column:
    """The value with a for each lower-case letter, A, 0 and _ for the others."""
    return F.regexp_replace(F.translate(value, ascii_letters + digits, "a" * 26 + "A" * 26 + "0" * 10), "[^aA0]", "_")


def near_of(left: Column) -> Column:
    return F.right(left, F.lit(NEAR))


def features(value: Column, left: Column, right: Column, path: Column, kinds: Column, near: Column) -> dict[str, Column]:
    """Numeric features of a candidate and its surroundings."""
    n = F.greatest(F.length(value), F.lit(1))
    share = lambda kind: 1 - F.length(F.replace(kinds, F.lit(kind), F.lit(""))) / n
    sign = r"[\"'`\])]?\s{0,3}(?::=|=>|[=:])[=>]?\s{0,3}[\"'`]?$"
    return {
        "length": F.least(n, F.lit(200)).cast("double"),
        "lower": share("a"),
        "upper": share("A"),
        "digit": share("0"),
        "other": share("_"),
        "changes": (F.regexp_count(kinds, F.lit("a+|A+|0+|_+")) - 1) / n,
        "distinct": F.size(F.array_distinct(F.split(F.left(value, F.lit(64)), ""))) / F.least(n, F.lit(64)),
        "hexadecimal": value.rlike(r"^([0-9a-f]+|[0-9A-F]+)$").cast("double"),
        "coverage": 1 - F.length(F.regexp_replace(F.lower(value), _words(), "")) / n,
        "shape": value.rlike(f"^(?:{SHAPES})").cast("double"),
        "secret_before": near.rlike(SECRET_WORDS).cast("double"),
        "digest_near": (near.rlike(DIGEST_WORDS) | F.substring(right, 1, 16).rlike(DIGEST_WORDS)).cast("double"),
        "assigned": left.rlike(ASSIGNED).cast("double"),
        "keyed": near.rlike(f"{SECRET_WORDS}[A-Za-z0-9_.\\-]{{0,16}}{sign}").cast("double"),
        "quoted": (left.rlike(r"[\"'`]$") & right.rlike(r"^[\"'`]")).cast("double"),
        "joined": (left.rlike(r"[.@%&#\\~]$") | right.rlike(r"^[.@\\~][A-Za-z0-9]")).cast("double"),
        "called": right.rlike(r"^[.\[({]").cast("double"),
        "test_path": path.rlike(TEST_PATHS).cast("double"),
        "config_path": path.rlike(CONFIG_PATHS).cast("double"),
        "userinfo": (left.rlike(USER) & right.startswith("@")).cast("double"),
        "spaces": value.rlike(r"\s").cast("double"),
    }


def feature_array(value: Column, left: Column, right: Column, path: Column, kinds: Column | None = None, near: Column | None = None) -> Column:
    made = features(value, left, right, F.coalesce(path, F.lit("")), kinds_of(value) if kinds is None else kinds, near_of(left) if near is None else near)
    return F.array(*[F.coalesce(made[k].cast("double"), F.lit(0.0)) for k in FEATURES])


def labelled_findings(spark: SparkSession, n: int = 8000) -> DataFrame:
    """value, left, right, path, label, kind: ``n`` findings made by rule; the
    bound of the training sample."""
    i = F.col("id")
    drawn: dict[str, Column] = {}  # the random parts, made once in a table of their own

    def draw(expression: Column) -> Column:
        name = f"x{len(drawn)}"
        drawn[name] = expression.alias(name)
        return F.col(name)

    h = lambda salt, bits=256: draw(F.sha2(F.concat_ws("|", F.lit(salt), i), bits))
    pick = lambda salt, xs: draw(F.element_at(F.split(F.lit("|".join(xs)), "[|]"), (F.pmod(F.xxhash64(F.lit(salt), i), F.lit(len(xs))) + 1).cast("int")))
    between = lambda salt, a, b: draw((F.pmod(F.xxhash64(F.lit(salt), i), F.lit(b - a + 1)) + a).cast("int"))
    raw64 = F.regexp_replace(F.base64(F.unhex(h("b"))), "=", "")
    mixed = F.translate(F.base64(F.unhex(F.concat(h("m"), h("mm")))), "0123456789+/=", "qWzXkBvNpT")
    upper = F.upper(F.regexp_replace(F.base64(F.unhex(F.concat(h("u"), h("v")))), "[^A-Za-z0-9]", ""))
    word = lambda salt: pick(salt, [w for w in DICTIONARY if len(w) > 3])
    syl = lambda salt: pick(salt, ["tion", "lich", "er", "an", "en", "ment", "ing", "keit", "re", "th", "ou", "es", "on", "ver", "ble", "st", "ho", "rse", "ba", "ple", "ca", "mo", "lu"])
    joint = pick("j", ["_", "-", "/"])
    prose = F.concat_ws(" ", word("p1"), syl("p2"), word("p3"))
    after = F.concat(F.lit(" "), word("p4"), F.lit(" "), syl("p5"))
    base = pick("k", ["password", "passwd", "secret", "token", "api_key", "apikey", "access_key", "auth_token", "client_secret", "pwd", "passphrase"])
    key = F.concat(pick("k0", ["", "", "", "db_", "jwt-", "x_"]), base, pick("k1", ["", "", "", "_id", "_base", "_2", '"']))
    key = F.when(between("ku", 0, 3) == 0, F.upper(key)).otherwise(key)
    sep = pick("s", ["=", " = ", ": ", ":", "= "])
    quote = pick("q", ["", '"', "'", '"'])
    plain = F.concat_ws(" ", word("p1"), pick("pk", ["name", "title", "see", "url", "version", "date", "color", "note", "type", "author", "kind", "size"]))
    none = F.lit("")
    secret, ends = F.concat(key, sep, quote), quote
    hexes = F.substring(h("h", 512), F.lit(1), pick("hl", ["16", "18", "24", "32", "40", "48", "64"]).cast("int"))
    syllables = lambda k: F.concat(*[syl(f"y{j}") for j in range(k)])
    kinds = [  # (value, left end, right start, label)
        (F.concat(F.lit("AKIA"), F.substring(upper, 1, 16)), pick("c1", ["", "key ", "aws ", "id = ", '"']), none, 1),
        (F.concat(pick("g", ["ghp_", "gho_", "glpat-", "sk_live_", "xoxb-", "sk-"]), F.substring(F.regexp_replace(raw64, "[/+]", "x"), 1, 36)), pick("c2", ["", "token ", '"', "= "]), none, 1),
        (hexes, secret, ends, 1),
        (F.substring(raw64, F.lit(1), between("rl", 10, 42)), secret, ends, 1),
        (F.concat(word("w1"), F.substring(h("n"), 1, 9)), secret, ends, 1),
        (F.concat(F.lit("-----BEGIN "), pick("pb", ["RSA ", "EC ", "", "OPENSSH "]), F.lit("PRIVATE KEY-----\n"), F.repeat(F.concat(raw64, F.lit("\n")), 4), pick("pe", ["-----END PRIVATE KEY-----", ""])), pick("c0", ["", "\n", "key: "]), none, 1),
        (F.substring(mixed, F.lit(1), between("ml", 10, 40)), secret, ends, 1),
        (syllables(7), F.concat(key, sep, pick("q1", ['"', "'"])), pick("q1", ['"', "'"]), 1),
        (F.concat(syl("a"), syl("b"), between("y", 1, 99).cast("string"), F.substring(h("n"), 1, 4)), secret, ends, 1),
        (F.concat(pick("s0", ["", "@", "P", "#"]), syl("a"), pick("sy", ["@", "!", "#", "$", "%", "~", ".", "0"]), syl("b"), F.substring(h("n"), F.lit(1), between("sn", 0, 3)), pick("sz", ["!", "$", "#", "@", "*"]), syl("c"), pick("sw", ["", "$", "!", "#"]), between("y", 1, 2024).cast("string"), pick("sv", ["", "#x", "!", "$"])), secret, ends, 1),
        (F.substring(raw64, F.lit(1), between("rl", 20, 42)), pick("ca", ["Bearer ", "Authorization: Bearer ", "authorization: Basic "]), none, 1),
        (hexes, F.concat(pick("d", ["commit", "sha256", "md5", "checksum", "digest", "etag", "rev", "uuid", "hash", "sha1"]), pick("ds", [" ", ": ", "=", " = "])), none, 0),
        (F.concat_ws("-", *[F.substring(h("uu"), a, b) for a, b in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), pick("c3", ["id: ", "", "uuid=", "request "]), none, 0),
        (hexes, none, none, 0),
        (syllables(6), pick("cz", ["", "", "the secret ", "password and "]), pick("c4", [".", ",", "", "!!", "%%%"]), 0),
        (F.upper(syllables(5)), none, pick("c4", [".", ",", "", "!!"]), 0),
        (F.concat(word("a"), F.initcap(syl("b")), F.initcap(word("c")), F.initcap(syl("d"))), pick("cy", ["", "see ", "new ", "x = "]), pick("cx", ["(", ".", " ", "()"]), 0),
        (F.concat(word("a"), joint, word("b"), joint, word("c")), pick("c5", ["", "/", '"', "token: ", "password = "]), none, 0),
        (F.concat(pick("ya", ["your_", "my-", "<", "${", "the_"]), pick("pl", ["api_key", "password", "secret_token", "access_key"]), pick("yb", ["_here", "}", ">", "_example", "1"])), secret, ends, 0),
        (F.concat(word("a"), F.lit("example"), between("y", 1, 99).cast("string")), pick("c6", ["@", "://", "www.", "mail."]), pick("c7", [".com", ".org", "@x", ""]), 0),
        (F.substring(F.translate(h("dg"), "abcdef", "012345"), F.lit(1), between("dl", 12, 19)), pick("c8", ["", "+", "card ", "id "]), none, 0),
        (F.repeat(pick("rp", ["x", "0", "a", "-", "_", "="]), between("rn", 12, 40)), pick("c9", ["", "password=", "token = "]), none, 0),
        (F.concat(syl("a"), syl("b"), syl("c"), pick("nz", ["", ".", "1.2.3", "-2"])), F.concat(plain, sep, quote), ends, 0),
        (F.concat(pick("ur", ["//", "/", "./"]), word("a"), F.lit("/"), syl("b"), between("y", 1, 99).cast("string"), pick("ue", [".html", ".com/x", "/y", ""])), F.concat(pick("us", ["http", "https", "url ", "path "]), F.lit(":")), none, 0),
        (F.concat(pick("gt", ["get", "read", "load", "fetch", "os.getenv", "request."]), F.initcap(word("a")), F.initcap(word("b"))), F.concat(key, sep), pick("cl", ["(", "[", "(x", "."]), 0),
        (F.concat(between("y1", 1990, 2030).cast("string"), F.lit("-0"), between("y2", 1, 9).cast("string"), F.lit("-1"), between("y3", 0, 9).cast("string")), F.concat(plain, sep, quote), ends, 0),
        (hexes, F.concat(plain, sep, quote), ends, 0),
        # from here on: the kinds with signs inside, in URLs, with white space, and their look-alikes
        (F.concat(F.substring(raw64, F.lit(1), between("rl", 10, 42)), pick("in", [":", "&", "|", ",", "="]), F.substring(h("n"), F.lit(1), between("il", 4, 16))), secret, ends, 1),
        (F.concat(syl("a"), between("y", 1, 99).cast("string"), pick("in", [":", "&", "|", ","]), F.substring(mixed, F.lit(1), between("il", 4, 16))), secret, ends, 1),
        (F.concat(pick("uc", ["S", "p", "x9", "Q!"]), syl("a"), F.substring(h("n"), F.lit(1), between("il", 2, 10)), pick("sv", ["", "!", "$", "%"])), F.concat(pick("db", ["postgres", "mysql", "mongodb", "amqp", "redis", "https"]), F.lit("://"), word("a"), F.lit(":")), F.concat(F.lit("@"), word("b"), F.lit(".host")), 1),
        (F.concat_ws(" ", syl("a"), word("b"), syl("c"), F.concat(word("d"), between("y", 1, 99).cast("string")), pick("sv", ["!", "now!", "#7", "$x"])), F.concat(base, sep, pick("q1", ['"', "'"])), pick("q1", ['"', "'"]), 1),
        (F.concat(F.translate(word("a"), "aeios", "43105"), pick("sv", ["", "", "!", "1"])), F.concat(base, sep, quote), ends, 1),
        (F.concat(F.lit("-----BEGIN "), pick("pg", ["PGP PRIVATE KEY BLOCK", "RSA PRIVATE KEY"]), F.lit("-----\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,"), F.upper(h("n")), F.lit("\n\n"), F.repeat(F.concat(raw64, F.lit("\n")), 6)), pick("c0", ["", "\n", "key: "]), none, 1),
        (F.concat(between("t1", 0, 23).cast("string"), F.lit(":"), between("t2", 10, 59).cast("string"), F.lit(":"), between("t3", 10, 59).cast("string")), F.concat(plain, sep), none, 0),
        (F.concat(between("t2", 10, 59).cast("string"), F.lit(":"), between("t3", 10, 59).cast("string"), pick("tz", ["Z", "", "+00:00", ".5Z"])), F.concat(pick("tw", ["", "time ", "at: "]), between("y1", 1990, 2030).cast("string"), F.lit("-01-1"), between("y3", 0, 9).cast("string"), pick("tx", ["T", " "]), between("t1", 0, 23).cast("string"), F.lit(":")), none, 0),
        (F.concat(pick("hp", ["localhost", "127.0.0.1", "10.0.0.7", "db.internal"]), F.lit(":"), between("t4", 1000, 9999).cast("string")), F.concat(plain, sep), none, 0),
        (F.concat(word("a"), F.lit(","), word("b"), pick("lc", ["", ",", "|", ":"]), syl("c")), F.concat(plain, sep), none, 0),
        (pick("pw", ["string", "required", "optional", "boolean", "undefined", "disabled", "default", "settings.value", "self.value", "None,None"]), F.concat(key, pick("s1", [": ", " = ", "="])), none, 0),
        (F.concat(word("a"), syl("b")), F.concat(prose, pick("s2", [": ", " = ", ":"])), none, 0),
        (F.concat_ws(" ", pick("ph", ["enter your", "please type the", "invalid", "the new", "forgot your", "must be a valid"]), base, pick("pt", ["", "here", "again", "or name"])), F.concat(base, sep, pick("q1", ['"', "'"])), pick("q1", ['"', "'"]), 0),
        (F.concat(word("a"), F.lit("."), F.when(between("ku", 0, 3) == 0, F.upper(word("b"))).otherwise(word("b")), pick("dt", ["", "", ".id", "_key"])), F.concat(key, pick("s1", [": ", " = ", "="])), pick("c7", ["", "(", "["]), 0),
        (F.concat(between("y1", 1, 99).cast("string"), pick("un", ["px,", "%|", "ms:", "kb,"]), between("t2", 10, 59).cast("string"), pick("uo", ["px", "%", "ms", "kb"])), F.concat(plain, sep), none, 0),
    ]
    path = pick("path", ["", "", "", "src3", "src11", "app/main.py", "config/settings.yml", ".env", "tests/test_auth.py", "docs/example.md"])
    base = written(spark.range(0, n, 1, 1).select("id", *drawn.values()), "findings")
    k = F.pmod(i, F.lit(len(kinds)))
    case = lambda at: reduce(lambda acc, x: acc.when(k == x[0], x[1][at] if isinstance(x[1][at], Column) else F.lit(x[1][at])), enumerate(kinds), F.when(F.lit(False), F.lit(None)))
    made = base.select(
        case(0).alias("value"),
        F.concat(prose, F.lit(" "), case(1)).alias("left"),
        F.concat(case(2), after).alias("right"),
        path.alias("path"),
        case(3).cast("double").alias("label"),
        k.cast("int").alias("kind"),
    )
    return written(made, "findings")


@dataclass
class Forest:
    """Trees as nested tuples (feature, threshold, left, right) with the
    probability of a secret at the leaves."""

    trees: list

    def sql(self, f: str) -> str:
        """Mean over the trees, as an expression on the feature array ``f``."""

        def walk(node) -> str:
            if not isinstance(node, tuple):
                return f"{float(node)}D"
            at, threshold, left, right = node
            return f"IF({f}[{at}] <= {float(threshold)!r}D, {walk(left)}, {walk(right)})"

        return f"({' + '.join(map(walk, self.trees))}) / {float(len(self.trees))}D"

    def most(self, known: dict[str, float]) -> float:
        """The largest probability of any candidate with these features."""
        fixed = {FEATURES.index(k): v for k, v in known.items()}

        def walk(node) -> float:
            if not isinstance(node, tuple):
                return float(node)
            at, threshold, left, right = node
            if at in fixed:
                return walk(left if fixed[at] <= threshold else right)
            return max(walk(left), walk(right))

        return sum(map(walk, self.trees)) / len(self.trees)

    def dumps(self) -> str:
        return json.dumps(self.trees)

    @classmethod
    def loads(cls, stored: str) -> "Forest":
        tuples = lambda x: tuple(map(tuples, x)) if isinstance(x, list) else x
        return cls([tuples(t) for t in json.loads(stored)])


def train(findings: DataFrame, trees: int = 16, depth: int = 8, seed: int = 11) -> Forest:
    """Random forest from labelled findings (value, left, right, path, label)."""
    rows = findings.coalesce(1).select(
        array_to_vector(feature_array(F.col("value"), F.col("left"), F.col("right"), F.col("path"))).alias("f"), "label"
    )
    model = RandomForestClassifier(
        featuresCol="f", labelCol="label", numTrees=trees, maxDepth=depth, seed=seed, subsamplingRate=0.8, maxMemoryInMB=64, featureSubsetStrategy="onethird"
    ).fit(rows)

    def node(n):
        if n.subtreeDepth() == 0:
            stats = list(n.impurityStats().stats())
            return round(stats[1] / sum(stats), 6)
        left, right = node(n.leftChild()), node(n.rightChild())
        return left if left == right else (n.split().featureIndex(), n.split().threshold(), left, right)

    return Forest([node(t.rootNode()) for t in model._java_obj.trees()])


PLAIN = {"digit": 0.0, "upper": 0.0, "shape": 0.0, "assigned": 0.0, "keyed": 0.0, "secret_before": 0.0}


def _free(columns: list[str], *names: str) -> list[str]:
    """These names, longer by underscores until no column has them."""
    out = []
    for n in names:
        while n in columns:
            n += "_"
        out.append(n)
    return out


def _judged(docs: DataFrame, forest: Forest, threshold: float, text_col: str, path_col: str | None):
    """(the input with two more columns, name of the texts between the
    candidates, name of the candidates as structs of value, left, right,
    probability; 0 for those that cannot reach the threshold)."""
    t, v, f, at = _free(docs.columns, "__t", "__v", "__f", "__path")
    path = F.col(path_col).cast("string") if path_col and path_col in docs.columns else F.lit("")
    text = F.coalesce(F.col(text_col), F.lit(""))
    skip = forest.most(PLAIN) < threshold
    open_ = lambda x: x["kinds"].rlike("[A0]") | x["value"].rlike(f"^(?:{SHAPES})") | x["left"].rlike(ASSIGNED) | x["near"].rlike(SECRET_WORDS)
    got = docs.withColumn(at, path).withColumn(v, F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)))
    got = got.withColumn(t, F.when(F.size(v) > 0, F.split(text, CANDIDATE, -1)))
    got = got.withColumn(
        v,
        F.when(
            F.col(t).isNotNull(),
            F.transform(
                v,
                lambda x, i: F.struct(
                    x.alias("value"),
                    F.right(F.concat(F.coalesce(F.get(v, i - 1), F.lit("")), F.get(t, i)), F.lit(60)).alias("left"),
                    F.left(F.get(t, i + 1), F.lit(40)).alias("right"),
                    kinds_of(x).alias("kinds"),
                ),
            ),
        ),
    )
    # one step each, as nothing within a step is shared
    got = got.withColumn(v, F.transform(v, lambda x: x.withField("near", near_of(x["left"]))))
    made = lambda x: feature_array(x["value"], x["left"], x["right"], F.col(at), x["kinds"], x["near"])
    long = lambda x: (F.length(x["value"]) >= LEAST) | x["left"].rlike(USER)
    got = got.withColumn(f, F.transform(v, lambda x: F.when(long(x) & open_(x) if skip else long(x), made(x))))
    p = F.expr(f"transform(`{f}`, x -> IF(x IS NULL, 0D, {forest.sql('x')}))")
    got = got.withColumn(f, p).withColumn(
        v,
        F.zip_with(v, f, lambda x, p: F.struct(x["value"].alias("value"), x["left"].alias("left"), x["right"].alias("right"), p.alias("probability"))),
    )
    return got.drop(at, f), t, v


def scan(docs: DataFrame, forest: Forest, threshold: float = 0.5, text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """Confirmed findings, one row each: the input's columns but the text, and
    value, left, right, start (characters before it), probability."""
    made = ("value", "left", "right", "start", "probability")
    keep = [c for c in docs.columns if c != text_col and c not in made]
    got, t, v = _judged(docs, forest, threshold, text_col, path_col)
    (y,) = _free(got.columns, "__y")
    numbered = F.filter(F.transform(v, lambda x, i: F.struct(x.alias("x"), i.alias("i"))), lambda z: z["x"]["probability"] >= threshold)
    total = lambda xs: F.aggregate(xs, F.lit(0), lambda a, n: a + n)
    start = total(F.transform(F.slice(t, F.lit(1), F.col(f"{y}.i") + 1), lambda s: F.length(s))) + total(
        F.transform(F.slice(v, F.lit(1), F.col(f"{y}.i")), lambda x: F.length(x["value"]))
    )
    # outer: an inner explode has its array worked out twice, for a filter below it
    return got.select(*keep, t, v, F.explode_outer(numbered).alias(y)).where(F.col(y).isNotNull()).select(
        *keep, F.col(f"{y}.x.value").alias("value"), F.col(f"{y}.x.left").alias("left"), F.col(f"{y}.x.right").alias("right"),
        start.cast("long").alias("start"), F.col(f"{y}.x.probability").alias("probability"),
    )


def redact(docs: DataFrame, forest: Forest, threshold: float = 0.5, text_col: str = "text", path_col: str | None = "source", mask: str = "[SECRET]") -> DataFrame:
    """The input with every confirmed secret replaced in its text; other
    columns, other texts and null texts stay as they are."""
    got, t, v = _judged(docs, forest, threshold, text_col, path_col)
    shown = F.transform(v, lambda x: F.when(x["probability"] >= threshold, F.lit(mask)).otherwise(x["value"]))
    parts = F.zip_with(t, shown, lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    dirty = F.exists(v, lambda x: x["probability"] >= threshold)
    return got.withColumn(text_col, F.when(dirty, F.array_join(parts, "")).otherwise(F.col(text_col))).select(*docs.columns)
