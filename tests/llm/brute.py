"""Brute-force versions of the operators, for small tables."""

import hashlib
from collections import Counter


def substring_dedup(texts: dict, window: int) -> dict:
    words = {i: (t or "").encode().split() for i, t in texts.items()}
    seen = Counter(tuple(w[a : a + window]) for w in words.values() for a in range(len(w) - window + 1))
    out = {}
    for i, w in words.items():
        gone = set()
        for a in range(len(w) - window + 1):
            if seen[tuple(w[a : a + window])] > 1:
                gone.update(range(a, a + window))
        left = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(left).hexdigest())
    return out


def suffix_dedup(texts: dict, length: int) -> dict:
    first, data = {}, {i: (t or "").encode() for i, t in texts.items()}
    for i in sorted(data):
        for a in range(len(data[i]) - length + 1):
            first.setdefault(data[i][a : a + length], (i, a))
    out = {}
    for i, x in data.items():
        gone = bytearray(len(x))
        for a in range(len(x) - length + 1):
            if first[x[a : a + length]] != (i, a):
                gone[a : a + length] = b"\1" * length
        runs = sum(1 for k in range(len(x)) if gone[k] and (k == 0 or not gone[k - 1]))
        left = bytes(c for c, g in zip(x, gone) if not g)
        out[i] = (len(x), sum(gone), runs, hashlib.sha256(left).hexdigest())
    return out


def shingles(text, k: int) -> frozenset:
    low = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    w = low.split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1)))


def ngram_components(texts: dict, k: int, percent: int) -> dict:
    sets = {i: shingles(t, k) for i, t in texts.items()}
    ids = sorted(sets)
    top = {i: i for i in ids}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            a, b = sets[i], sets[j]
            if a and b and min(len(a), len(b)) * 100 >= percent * max(len(a), len(b)):
                c = len(a & b)
                if 100 * c >= percent * (len(a) + len(b) - c):
                    x, y = find(i), find(j)
                    top[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def edit_distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


WHITE = " \t\n\x0b\f\r"
ALNUM = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"


def _while(t: str, at: int, ok, most: int = 1 << 60) -> int:
    end = at
    while end < len(t) and end - at < most and ok(t[end]):
        end += 1
    return end


def _head_end(t: str, at: int) -> int | None:
    """After the dashes of a private key's BEGIN or END line whose name starts here."""
    end = t.find("-----", at)
    name = t[at:end] if end >= 0 else ""
    plain = name.removesuffix(" BLOCK").removesuffix("PRIVATE KEY")
    return end + 5 if name.removesuffix(" BLOCK").endswith("PRIVATE KEY") and len(plain) <= 40 and all(c in ALNUM[26:] + " " for c in plain) else None


def _block(t, i):
    if not t.startswith("-----BEGIN ", i) or (body := _head_end(t, i + 11)) is None:
        return None
    dashes = t.find("-----", body)
    if dashes >= 0 and t.startswith("-----END ", dashes) and (end := _head_end(t, dashes + 9)):
        return end
    while True:
        at = _while(t, body, lambda c: c in WHITE, 4)
        name = _while(t, at, lambda c: c in ALNUM[:52] + "-", 30)
        if name - at >= 2 and t.startswith(": ", name):
            body = _while(t, name + 2, lambda c: c not in "\r\n", 120)
            continue
        end = _while(t, at, lambda c: c in ALNUM + "+/=")
        if end - at < 16:
            return body
        body = end


def _userinfo(t, i):
    slashes = t.rfind("://", max(0, i - 68), i)
    if i == 0 or t[i - 1] != ":" or slashes < 0 or not 0 <= i - 1 - slashes - 3 <= 64 or any(c in WHITE + "/:@\"'<>" for c in t[slashes + 3 : i - 1]):
        return None
    end = _while(t, i, lambda c: c not in WHITE + "/@\"'<>", 128)
    return end if end - i >= 4 and t[end : end + 1] == "@" and t[end + 1 : end + 2] and t[end + 1] in ALNUM + "[" else None


def _sign_before(t, i, most) -> int | None:
    """The place after = or : that stands before i with at most so many spaces."""
    k = i
    while k > 0 and i - k < most and t[k - 1] in WHITE:
        k -= 1
    return k if k > 0 and t[k - 1] in "=:" else None


def _named(t, i):
    import regex

    if i == 0 or t[i - 1] not in "\"'`":
        return None
    q, near = t[i - 1], t[max(0, i - 70) : i - 1]
    if not regex.search(r"(?:pass(?:word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credential)[A-Za-z0-9_.-]{0,16}[\"'\])]?[ \t\n\x0b\f\r]{0,3}(?::=|=>|[=:])[ \t\n\x0b\f\r]{0,3}$", near, regex.I | regex.A):
        return None
    end = i
    while end < len(t) and t[end] not in q + "\r\n":
        end += 2 if t[end] == "\\" else 1
    return end if t[end : end + 1] == q and not any(c in q + "\r\n" for c in t[i : i + 6]) and len(t[i : i + 6]) == 6 else None


def _quoted(t, i):
    if i == 0 or t[i - 1] not in "\"'`" or _sign_before(t, i - 1, 2) is None:
        return None
    end = _while(t, i, lambda c: c not in WHITE + "\"'`")
    return end if end - i >= 6 and t[end : end + 1] in ("\"", "'", "`") else None


def _bare(t, i):
    if _sign_before(t, i, 2) is None:
        return None
    stop = WHITE + "\"'`<>;(){}[]"
    scheme = _while(t, i, lambda c: c in ALNUM + "+.-", 16)
    if t.startswith("//", i) or t[i : i + 1] in tuple(ALNUM[:52]) and scheme - i >= 2 and t.startswith("://", scheme):
        return None
    plain = lambda c: c not in stop + ",=:&|"
    end = _while(t, i, plain)
    if end == i or _while(t, i, lambda c: c not in stop, 6) - i < 6:
        return None
    while True:
        signs = _while(t, end, lambda c: c in ",:&|=")
        name = _while(t, signs, lambda c: c in ALNUM + "_.-")
        if signs > end and t[signs : signs + 1] in tuple(ALNUM[:52] + "_") and name - signs <= 41 and t[name : name + 1] == "=":
            break
        more = _while(t, signs, plain)
        if signs == end or more == signs:
            break
        end = more
    return _while(t, end, lambda c: c == "=")


def _run(t, i):
    ok = ALNUM + "_+/-"
    if i and t[i - 1] in ok:
        return None
    end = _while(t, i, lambda c: c in ok)
    return end if end - i >= 12 else None


def secret_candidates(t: str) -> list[tuple[int, str]]:
    """(start, value), found character by character."""
    out, i = [], 0
    while i < len(t):
        end = next((e for f in (_block, _userinfo, _named, _quoted, _bare, _run) if (e := f(t, i)) is not None), None)
        if end is not None and end > i:
            out.append((i, t[i:end]))
        i = end if end is not None and end > i else i + 1
    return out


def secret_findings(texts: dict, path: str, forest, threshold: float = 0.5) -> set:
    """(id, start, value) by Python's own expressions, every candidate judged."""
    import regex
    from lodestone.llm import secrets as s

    words, near_words = regex.compile(s._words()), regex.compile(s.SECRET_WORDS)
    keyed = regex.compile(s.SECRET_WORDS + r"[A-Za-z0-9_.\-]{0,16}[\"'`\])]?\s{0,3}(?::=|=>|[=:])[=>]?\s{0,3}[\"'`]?$")
    digest = regex.compile(s.DIGEST_WORDS)
    out = set()
    for i, t in texts.items():
        found = secret_candidates(t or "")
        for k, (at, v) in enumerate(found):
            before = found[k - 1][0] if k else 0
            user = bool(regex.search(s.USER, t[before:at][-60:]))
            if len(v) < 6 and not user:
                continue
            left = t[before:at][-60:]
            right = t[at + len(v) : found[k + 1][0] if k + 1 < len(found) else len(t)][:40]
            kind = "".join("a" if "a" <= c <= "z" else "A" if "A" <= c <= "Z" else "0" if "0" <= c <= "9" else "_" for c in v)
            n, near = len(v), left[-s.NEAR :]
            f = {
                "length": min(n, 200), "lower": kind.count("a") / n, "upper": kind.count("A") / n, "digit": kind.count("0") / n, "other": kind.count("_") / n,
                "changes": (len(regex.findall("a+|A+|0+|_+", kind)) - 1) / n, "distinct": len(set(v[:64])) / min(n, 64),
                "hexadecimal": bool(regex.match(r"^([0-9a-f]+|[0-9A-F]+)$", v)), "coverage": 1 - len(words.sub("", v.lower())) / n,
                "shape": bool(regex.match(f"(?:{s.SHAPES})", v)), "secret_before": bool(near_words.search(near)),
                "digest_near": bool(digest.search(near) or digest.search(right[:16])), "assigned": bool(regex.search(s.ASSIGNED, left)), "keyed": bool(keyed.search(near)),
                "quoted": bool(regex.search(r"[\"'`]$", left) and regex.match(r"[\"'`]", right)),
                "joined": bool(regex.search(r"[.@%&#\\~]$", left) or regex.match(r"[.@\\~][A-Za-z0-9]", right)), "called": bool(regex.match(r"[.\[({]", right)),
                "test_path": bool(regex.search(s.TEST_PATHS, path)), "config_path": bool(regex.search(s.CONFIG_PATHS, path)),
                "userinfo": user and right.startswith("@"), "spaces": bool(regex.search(r"[ \t\n\x0b\f\r]", v)),
            }
            row = [float(f[x]) for x in s.FEATURES]

            def walk(node):
                while isinstance(node, tuple):
                    node = node[2] if row[node[0]] <= node[1] else node[3]
                return node

            if sum(map(walk, forest.trees)) / len(forest.trees) >= threshold:
                out.add((i, at, v))
    return out
