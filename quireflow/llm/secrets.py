"""Secret scans: anything that may be a secret is a candidate; a random forest removes the false positives.

Candidates, found over the bytes of a whole batch:

* runs of at least ``SHORTEST`` key characters that mix digits with letters, change case inside, or
  are ``LONG`` characters with a digit;
* the whole value after an assignment to a secret-like name, of any length and any characters, on the name's line or the next, and over
  several lines if it is quoted; blanks and names may be of any length;
* passwords in URLs, tokens after ``Bearer`` and ``Basic``, and whole blocks of private keys.

A value takes the place of the runs inside it.  The forest looks at length, character transitions,
dictionary coverage (whole words of a public tokenizer's vocabulary), path-like surroundings and
neighbouring words, and is trained from labelled findings (left context, candidate, right context,
label): any table of those, or ``example_findings`` and ``assigned_findings``, seeded sets of typical
true and false ones.  Trees are flattened into node arrays for vectorised scoring.

Defined results: null and empty texts have no findings; a candidate is judged wherever it stands, so
repeated ones give one finding each; a text of any length is scanned whole; an empty table gives no
rows, labelled findings of one class only give findings judged by that class; ``scan`` reads key and
text alone, ``redact`` keeps all columns whatever their names.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import passes, table, utf8

SHORTEST, LONG = 8, 16
#: Bytes of context on either side that features look at.
CONTEXT = 48
#: Labelled findings that one fit looks at, at most.
MAX_TRAIN_ROWS = 20_000
THRESHOLD = 0.5
MASK = "[SECRET]"

_KEYCHAR = np.isin(np.arange(256), np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-", np.uint8))
_UPPER = np.isin(np.arange(256), np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", np.uint8))
_LOWER = np.isin(np.arange(256), np.frombuffer(b"abcdefghijklmnopqrstuvwxyz", np.uint8))
_LETTERS = _UPPER | _LOWER
_DIGITS = np.isin(np.arange(256), np.frombuffer(b"0123456789", np.uint8))
_WORDS_NEAR = frozenset("token secret password passwd pass pgpass passphrase passcode pwd apikey api_key key auth bearer credential credentials access private signature client_secret access_token".split())
_WORDS_BENIGN = frozenset("commit sha sha1 sha256 md5 hash checksum digest uuid guid id version revision build example sample placeholder test ref order invoice card phone isbn page".split())
#: Openings of well-known key formats.
PREFIXES = ("AKIA", "ASIA", "ghp_", "gho_", "glpat-", "sk_live_", "sk-", "xoxb-", "AIza", "eyJ")
#: Letters of the words that the dictionary has.
_WORD_LENGTHS = range(12, 3, -1)
FEATURES = (
    "length", "digit_share", "upper_share", "letter_share", "class_turns", "letter_steps", "distinct_share", "entropy", "hex_share", "runs", "dictionary_cover",
    "slashes", "dashes", "path_before", "assigned", "quoted", "near_word", "benign_word", "uuid_like", "known_prefix", "in_url", "bearer", "armoured",
)
_PREFIXES = tuple(p.encode() for p in PREFIXES)
_UUID = re.compile(rb"[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}")
_ASSIGN = re.compile(rb"[=:]\s*[\"'`]?\s*$")
_NAME = re.compile(rb"[A-Za-z_0-9]+")
#: What makes the name of an assigned value secret-like, and the value: to the closing quote, or else to white space or a separator.
_SECRET_NAME = re.compile(rb"token|secret|passwo?r?d|pass_?(?:phrase|code|key)|(?<!by)(?<!com)(?<!sur)(?<!tres)pass$|pwd|api_?key|access_?key|private_?key|credential|auth")
_NAMECHAR = _LETTERS | _DIGITS | np.isin(np.arange(256), np.frombuffer(b"_-", np.uint8))
_BETWEEN = np.isin(np.arange(256), np.frombuffer(b" \t\"'`", np.uint8))


def _quoted(q: str) -> str:
    """A value between quotes: on one line, or on more if none of them is blank and something like an end follows."""
    return rf"{q}([^{q}\r\n]+){q}|{q}((?:[^{q}\r\n]|\r?\n(?![ \t]*\r?\n))+){q}(?=[\s,;)}}\]>]|\Z)"


#: The value is on the name's line or, quoted or indented, on the next.
VALUE = r"(?:[ \t]*|[ \t]*\r?\n[ \t]+|[ \t]*\r?\n(?=[\"'`]))(?:" + "|".join(map(_quoted, "\"'`")) + r"|[\"'`]?([^ \t\r\n\f\v,;\"'`]+))"
_VALUE = re.compile(VALUE.encode())
_URL = re.compile(rb"://[^\s:/@\"'<>]*:([^\s/@\"'<>]+)@")
_BEARER = re.compile(rb"(?i:bearer|basic)[ \t]+([A-Za-z0-9+/_.~=-]{8,})")
_ARMOUR = re.compile(rb"(-----BEGIN [A-Z0-9 ]*PRIVATE KEY[A-Z ]*-----.*?-----END [A-Z0-9 ]*PRIVATE KEY[A-Z ]*-----)", re.S)
_BEARER_BEFORE = re.compile(rb"(?i:bearer|basic)[ \t]+$")
_VOWEL = frozenset(b"aeiouAEIOU")


def _classes(s: bytes) -> list[int]:
    return [0 if 48 <= c <= 57 else 1 if 65 <= c <= 90 else 2 if 97 <= c <= 122 else 3 for c in s]


@lru_cache(maxsize=1)
def dictionary(name: str = "byte_bpe_50k.json") -> frozenset[str]:
    """Lower-case words of four letters and more that a public vocabulary has as one token."""
    from .tokens import _tokenizer, vocabulary

    words = (t[1:].lower() for t in _tokenizer(vocabulary(name)).get_vocab(False) if not t[0].isascii())
    return frozenset(w for w in words if len(w) > 3 and w.isascii() and w.isalpha())


def _cover(s: bytes) -> float:
    """Share of characters inside dictionary words, longest words first from the left."""
    low, at, got, words = s.decode("latin-1").lower(), 0, 0, dictionary()
    while at < len(low):
        n = next((k for k in _WORD_LENGTHS if low[at : at + k] in words), 0) if low[at].isalpha() else 0
        n = min(n, len(low) - at)
        got, at = got + n, at + max(n, 1)
    return got / max(len(low), 1)


def features(left: bytes, found: bytes, right: bytes) -> list[float]:
    n, kinds = max(len(found), 1), _classes(found)
    counts = {}
    for c in found:
        counts[c] = counts.get(c, 0) + 1
    letters = [c for c, k in zip(found, kinds, strict=True) if k in (1, 2)]
    steps = [(a in _VOWEL) != (b in _VOWEL) for a, b in zip(letters, letters[1:])]
    run = longest = 1
    for a, b in zip(found, found[1:]):
        run = run + 1 if b in (a, a + 1) else 1
        longest = max(longest, run)
    names = [w.lower().decode() for w in _NAME.findall(left)[-3:]]
    split = {p for w in names for p in w.split("_")} | set(names)
    return [
        n, kinds.count(0) / n, kinds.count(1) / n, len(letters) / n, sum(a != b for a, b in zip(kinds, kinds[1:])) / n, sum(steps) / max(len(steps), 1), len(counts) / n,
        -sum(v / n * math.log2(v / n) for v in counts.values()), sum(c in b"0123456789abcdefABCDEF" for c in found) / n, longest / n, _cover(found),
        found.count(b"/"), found.count(b"-") + found.count(b"_"), float(left[-1:] in (b"/", b"\\", b".", b":", b"@", b"#") or right[:1] in (b"/", b"\\", b".", b"@")),
        float(bool(_ASSIGN.search(left))), float(left[-1:] in (b'"', b"'", b"`") and right[:1] in (b'"', b"'", b"`")), float(bool(split & _WORDS_NEAR)), float(bool(split & _WORDS_BENIGN)),
        float(bool(_UUID.search(found))), float(found.startswith(_PREFIXES)), float(left[-1:] == b":" and right[:1] == b"@"),
        float(bool(_BEARER_BEFORE.search(left))), float(found.startswith(b"-----BEGIN")),
    ]


@dataclass
class Forest:
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    share: np.ndarray
    roots: np.ndarray
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Mean share of true secrets in the leaves that each row reaches."""
        at = np.repeat(self.roots[None, :], len(x), axis=0)
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[rows, self.feature[at]] <= self.cut[at], self.left[at], self.right[at])
        return self.share[at].mean(axis=1)


def fit_forest(x: np.ndarray, y: np.ndarray, n_trees: int = 48, depth: int = 10, min_rows: int = 3, seed: int = 7) -> Forest:
    """Bagged trees, each split the best Gini cut among sqrt(features) drawn features."""
    x, y = np.asarray(x, float), np.asarray(y, float)
    rng, tries = np.random.default_rng(seed), max(1, round(math.sqrt(x.shape[1])))
    nodes: list[list[float]] = []

    def grow(rows: np.ndarray, level: int) -> int:
        me, n, pos = len(nodes), len(rows), y[rows].sum()
        nodes.append([0, 0.0, me, me, pos / n])
        if level == depth or n < 2 * min_rows or pos in (0, n):
            return me
        best = (2 * pos * (n - pos) / n - 1e-9, -1, 0.0)
        for f in rng.permutation(x.shape[1])[:tries]:
            order = rows[np.argsort(x[rows, f], kind="stable")]
            v, k = x[order, f], np.arange(1, n)
            p = np.cumsum(y[order])[:-1]
            cost = 2 * p * (k - p) / k + 2 * (pos - p) * (n - k - pos + p) / (n - k)
            cost[(v[1:] == v[:-1]) | (k < min_rows) | (n - k < min_rows)] = np.inf
            i = int(np.argmin(cost))
            if cost[i] < best[0]:
                best = (cost[i], int(f), (v[i] + v[i + 1]) / 2)
        if best[1] >= 0:
            go = x[rows, best[1]] <= best[2]
            a = grow(rows[go], level + 1)
            b = grow(rows[~go], level + 1)
            nodes[me][:4] = [best[1], best[2], a, b]
        return me

    if not len(y):
        raise ValueError("no labelled findings")
    roots = [grow(np.sort(rng.integers(0, len(y), len(y))), 0) for _ in range(n_trees)]
    t = np.array(nodes)
    return Forest(t[:, 0].astype(np.int32), t[:, 1], t[:, 2].astype(np.int32), t[:, 3].astype(np.int32), t[:, 4], np.array(roots, np.int32), depth)


def example_findings(n: int = 6000, seed: int = 11) -> list[tuple[bytes, bytes, bytes, int]]:
    """Seeded labelled findings: keys in assignments and headers against ids, hashes, numbers, paths, words and placeholders."""
    rng = np.random.default_rng(seed)
    alphabets = {"hex": "0123456789abcdef", "HEX": "0123456789ABCDEF", "b62": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "b64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "up": "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "dec": "0123456789"}
    pick = lambda options: options[int(rng.integers(len(options)))]
    draw = lambda kind, k: "".join(pick(alphabets[kind]) for _ in range(k))
    syllables = "th er on an in re he ed es or ti st en of te le de ou la que ment tion ung keit sch ción dos".replace("ó", "o").split()
    word = lambda: "".join(pick(syllables) for _ in range(int(rng.integers(1, 5))))
    prose = lambda k: " ".join(word() for _ in range(k))
    case = lambda s: s.upper() if rng.random() < 0.2 else s
    names = ["token", "secret", "password", "api_key", "apiKey", "access_token", "auth", "client_secret", "private_key", "SECRET_KEY", "credential"]
    plain = ["commit", "sha256", "md5", "uuid", "id", "version", "build", "revision", "checksum", "digest", "ref", "order", "page"]
    out = []
    for i in range(n):
        left, right = prose(int(rng.integers(1, 6))), prose(int(rng.integers(1, 4)))
        true = i % 2 == 0
        if true:
            kind = pick(["hex", "hex", "HEX", "b62", "b64", "up"])
            key = draw(kind, int(pick([16, 16, 18, 18, 20, 20, 24, 32, 36, 40, 40, 48, 64]))) + pick(["=", "", ""]) * (kind == "b64")
            q = pick(['"', '"', "'", ""])
            bare = i % 8 == 0
            if bare:  # well-known formats need no name in front of them
                kind, prefix, k = pick([("up", "AKIA", 16), ("up", "ASIA", 16), ("b62", "ghp_", 36), ("b62", "glpat-", 20), ("b62", "sk_live_", 24), ("b62", "AIza", 35)])
                key, q = prefix + draw(kind, k), pick(["", "", '"'])
            before = pick(["", "", " ", "key "]) + q if bare else case(pick(names)) + pick([" = ", "=", ": ", ":", " := ", "\": "]) + q if rng.random() < 0.85 else pick(["Authorization: Bearer ", "Bearer ", "auth "])
            after = q + pick([" ", "\n", ",", ";", "!! "])
        else:
            q, before, after = "", "", pick([" ", ". ", "\n", ", "])
            style = int(rng.integers(13))
            if style == 0:
                key, before = draw("hex", int(pick([32, 40, 64]))), case(pick(plain)) + pick([" ", ": ", " = "])
            elif style == 1:
                key, before = draw("dec", int(rng.integers(16, 20))), pick(["", "", "+", "card ", "no. "])
            elif style == 2:
                h = draw("hex", 32)
                key, before = f"{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}", pick(["uuid ", "id=", "", "/"])
            elif style == 3:
                key, before = "/".join(word() for _ in range(4)) + "/" + draw("dec", 3) + word(), pick(["https://example.com/", "/usr/", ""])
            elif style == 4:
                key, before = "".join(word() for _ in range(5)) + draw("dec", int(rng.integers(1, 4))), pick(["", "", "the "])
            elif style == 5:
                key, before = pick(["your-api-key-here-123", "EXAMPLE_TOKEN_0000000000", "xxxxxxxxxxxxxxxxxxxxxxxx1", "placeholder-value-1234", "0123456789abcdef0123456789abcdef", "00000000000000000000"]), pick(["token = \"", "api_key=", "secret: "])
            elif style == 6:
                key, before = "-".join(draw("dec", 4) for _ in range(int(rng.integers(4, 6)))), pick(["", "tel ", "order "])
            elif style == 7:
                key, before = pick(["INV", "ORD", "REF", "SN", "TOKENS", "ITEM"]) + draw("dec", int(rng.integers(12, 18))), pick(["", "no. ", "order "])
            elif style == 8:  # what ids, versions, dates and names of things look like
                key = pick([word() + draw("dec", int(rng.integers(2, 7))), draw("dec", 4) + "-" + draw("dec", 2) + "-" + draw("dec", 2) + "T" + draw("dec", 2), "v" + draw("dec", 2) + "-" + word() + draw("dec", 2), draw("up", 3) + "-" + draw("dec", 6)])
                before = pick(["", "", "the ", "item ", "id="])
            elif style == 9:
                key = "".join(w.capitalize() for w in pick([["get", word(), "name"], [word(), "handler", word()], ["my", word(), word()], [word(), word(), "service"]])) + pick(["", "2"])
            elif style == 10:
                key, before = draw("hex", int(pick([8, 10, 12]))), pick(["commit ", "", "rev ", "#", "build "])
            elif style == 11:
                key, before = pick(["application/json2", "image-2024-01", "utf-8-string", "base64encoded", word() + "_" + draw("dec", 3) + "_" + word(), "font-size-12px", "10000000", "2048x1536px"]), pick(["", "type: ", "name="])
            else:
                key, before, after = draw("hex", int(pick([8, 16, 20]))) + "-" + word() + draw("dec", 2) + word(), pick(["static/", "assets/", "img."]), pick([".js ", ".css ", ".png "])
        out.append(((left + " " + before)[-CONTEXT:].encode(), key.encode(), (after + right)[:CONTEXT].encode(), int(true)))
    return out


def assigned_findings(n: int = 3600, seed: int = 12) -> list[tuple[bytes, bytes, bytes, int]]:
    """Seeded labelled values of assignments to secret-like names: passwords and passphrases of any length against ordinary words, numbers, placeholders and code."""
    rng = np.random.default_rng(seed)
    pick = lambda options: options[int(rng.integers(len(options)))]
    draw = lambda letters, k: "".join(pick(letters) for _ in range(k))
    lower, upper, digits, marks = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "!@#$%^&*.~?+-_"
    names = ["token", "secret", "password", "passwd", "pwd", "api_key", "access_token", "client_secret", "PASSWORD", "passphrase", "DB_PASSWORD", "auth", "pass", "DB_PASS", "PGPASS"]
    plain = "none null true false yes no required optional invalid missing changeme your-password your_token example placeholder string xxxxxx ****** <password> ${PASSWORD} $TOKEN the is was must will each Optional[str] str int os.environ getenv() self.token 0 1 2 3600 expired wrong".split()
    listed = sorted(dictionary())
    out = []
    for i in range(n):
        q = pick(['"', '"', "'", ""])
        before = pick(["", "the ", "user = x, ", "config "]) + pick(names) + pick([" = ", "=", ": ", ":", " := ", " =     ", ":\n  ", ":\n" if q else ": "]) + q
        if i % 2 == 0:
            style = int(rng.integers(7))
            if style == 4:  # people join words, digits and marks
                value = pick(listed) + draw(digits, int(rng.integers(1, 4))) + pick(["", *marks]) + pick(["", pick(listed).capitalize()])
            elif style == 5:
                value = pick(["-", "_", ".", " " if q else "-"]).join(pick(listed) for _ in range(int(rng.integers(3, 6))))
            elif style == 6:  # keys that go over several lines, or hold blanks
                parts = [draw(lower + upper + digits + marks, int(rng.integers(4, 30))) for _ in range(int(rng.integers(2, 5)))]
                value = pick(["\n", " ", "\n  "]).join(parts) if q else parts[0] + parts[1]
            elif style == 0:
                value = draw(lower + upper + digits + marks, int(rng.integers(6, 25)))
            elif style == 1:
                value = draw(lower + upper + digits, int(rng.integers(6, 16)))
            elif style == 2:
                value = draw(lower + upper, int(rng.integers(8, 28)))
            else:
                value = pick(["-", "_", ".", " " if q else "-"]).join(draw(lower, int(rng.integers(4, 8))) for _ in range(int(rng.integers(3, 6))))
        else:
            value = pick(plain) if rng.random() < 0.6 else " ".join(pick(listed) for _ in range(int(rng.integers(2, 9)))) if q and rng.random() < 0.3 else pick(["your-", "my_", "<", "${", "self.", ""]) + pick(listed) + pick(["", "", ">", "}", "()", "-here"])
        out.append((before[-CONTEXT:].encode(), value.encode(), (q + pick([" ", "\n", ",", ";"]) + pick(["and then", "next", ""])).encode(), int(i % 2 == 0)))
    return out


def located_findings(n: int = 1200, seed: int = 13) -> list[tuple[bytes, bytes, bytes, int]]:
    """Seeded labelled passwords of URLs, tokens of headers and blocks of private keys, against ports, placeholders and public text."""
    rng = np.random.default_rng(seed)
    pick = lambda options: options[int(rng.integers(len(options)))]
    b62 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    draw = lambda letters, k: "".join(pick(letters) for _ in range(k))
    out = []
    for i in range(n):
        true, style = i % 2 == 0, i // 2 % 3
        if style == 0:
            before = pick(["see ", "", "url: ", "DATABASE="]) + pick(["postgres", "mysql", "https", "redis", "amqp", "mongodb+srv"]) + "://" + pick(["admin", "app", "root", "svc", ""]) + ":"
            value = draw(b62 + "!$%^&*._-", int(rng.integers(6, 22))) if true else pick(["password", "<password>", "PASSWORD", "$PASS", "${DB_PASS}", "xxxx", "****", "pass", "secret", "changeme", "{pw}"])
            after = "@" + pick(["db.example.com/x", "localhost:5432 ", "10.0.0.3/"])
        elif style == 1:
            before = pick(["Authorization: ", "header ", "", "-H 'Authorization: "]) + pick(["Bearer ", "bearer ", "Basic "])
            value = draw(b62 + "-_.", int(pick([20, 24, 32, 40, 64, 120]))) if true else pick(["token-authentication", "authentication", "knowledge", "tokens12", "YOUR_TOKEN_HERE", "research", "principles", "arithmetic", "xxxxxxxxxxxx", "<access_token>"])
            after = pick([" ", "\n", "' "])
        else:
            kind = pick(["RSA ", "", "EC ", "OPENSSH ", "DSA "])
            body = "\n".join(draw(b62 + "+/", 64) for _ in range(int(rng.integers(3, 14)))) if true else pick(["...", "\n...\n", "<your key here>", "\nexample\n", "xxxx"])
            before, value, after = pick(["", "key:\n", "\n"]), f"-----BEGIN {kind}PRIVATE KEY-----{pick([chr(10), ''])}{body}\n-----END {kind}PRIVATE KEY-----", pick(["\n", " "])
        out.append((before[-CONTEXT:].encode(), value.encode(), after[:CONTEXT].encode(), int(true)))
    return out


def fit(findings: list[tuple[bytes, bytes, bytes, int]] | DataFrame | None = None, **options) -> Forest:
    """The forest of labelled findings; a table (left, candidate, right, label) is used up to ``MAX_TRAIN_ROWS`` rows, smallest hashes first."""
    if findings is None:
        findings = example_findings() + assigned_findings() + located_findings()
    elif isinstance(findings, DataFrame):
        parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("left", "candidate", "right")]
        rows = findings.where("label is not null").select(*parts, F.col("label").cast("int")).toDF("left", "candidate", "right", "label")
        rows = rows.orderBy(F.xxhash64("left", "candidate", "right", "label")).limit(MAX_TRAIN_ROWS).collect()
        findings = [(r[0].encode()[-CONTEXT:], r[1].encode(), r[2].encode()[:CONTEXT], r[3]) for r in rows]
    x = np.array([features(*f[:3]) for f in findings]).reshape(len(findings), len(FEATURES))
    return fit_forest(x, np.array([f[3] for f in findings], float), **options)


def candidates(off: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, start and end (bytes) of every candidate."""
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    inside = _KEYCHAR[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    before, after = np.concatenate(([False], inside)), np.concatenate((inside, [False]))
    start, end = np.flatnonzero(after & (~before | edge)), np.flatnonzero(before & (~after | edge))
    long = end - start >= SHORTEST
    start, end = start[long], end[long]
    digits, letters = (np.concatenate(([0], np.cumsum(c[data], dtype=np.int64))) for c in (_DIGITS, _LETTERS))
    # a capital after a small letter, counted where it stands
    turns = np.concatenate(([0, 0], np.cumsum(_UPPER[data[1:]] & _LOWER[data[:-1]], dtype=np.int64)))
    n_digits, n_letters, n_turns = digits[end] - digits[start], letters[end] - letters[start], turns[end] - turns[start + 1]
    some = (n_digits > 0) & ((n_letters > 0) | (end - start >= LONG)) | (n_turns > 0)
    start, end = start[some], end[some]
    doc_end = off[np.searchsorted(off, start, "right")]
    for _ in range(2):  # padding belongs to the key that it ends
        end = end + ((end < doc_end) & (data[np.minimum(end, len(data) - 1)] == 61))
    start, end = _with_values(off, data, start, end)
    return np.searchsorted(off, start, "right") - 1, start, end


def _values(off: np.ndarray, data: np.ndarray, raw: bytes) -> list[tuple[int, int]]:
    """Spans of assigned values, URL passwords, header tokens and private keys; documents lie next to each other."""
    found = []
    signs = np.flatnonzero((data == 61) | (data == 58))
    lows, highs = off[np.searchsorted(off, signs, "right") - 1], off[np.searchsorted(off, signs, "right")]
    # the name ends before blanks and quotes, and begins where no name character stands in front of it
    here = np.arange(len(data))
    back = lambda stop: np.maximum.accumulate(np.where(stop[data], here, -1))
    name_end = np.concatenate(([-1], back(~_BETWEEN)))[signs]
    begin = np.maximum(np.where(name_end >= 0, back(~_NAMECHAR)[np.maximum(name_end, 0)] + 1, 0), lows)
    named = (begin <= name_end) & (name_end >= lows)
    for at, lo, hi, a, b in zip(*(x[named].tolist() for x in (signs, lows, highs, begin, name_end + 1)), strict=True):
        if raw[at - 1 : at + 1] == b":=" and at - 1 >= lo:
            continue  # the colon's turn
        if _SECRET_NAME.search(raw[a:b].lower()):
            value = _VALUE.match(raw, at + (2 if raw[at : at + 2] in (b":=", b"=>") else 1), hi)
            if value:
                found.append(value.span(value.lastindex))
    bounds = [(lo, hi) for lo, hi in zip(off[:-1].tolist(), off[1:].tolist(), strict=True) if hi > lo]
    for mark, pattern in ((b"://", _URL), (b"PRIVATE KEY", _ARMOUR), (b"earer", _BEARER), (b"asic", _BEARER), (b"EARER", _BEARER), (b"ASIC", _BEARER)):
        if mark in raw:
            found += [m.span(1) for lo, hi in bounds if raw.find(mark, lo, hi) >= 0 for m in pattern.finditer(raw, lo, hi)]
    return list(dict.fromkeys(found))


def _with_values(off: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs and values in text order, never overlapping: a value takes the place of runs that it meets, joined where one sticks out."""
    values = _values(off, data, data.tobytes())
    if not values:
        return start, end
    a, b = np.array(values).T
    lo, hi = np.searchsorted(end, a, "right"), np.searchsorted(start, b, "left")
    alone = np.ones(len(start), bool)
    for i, (x, y) in enumerate(zip(lo.tolist(), hi.tolist(), strict=True)):
        if x < y:
            a[i], b[i] = min(a[i], start[x]), max(b[i], end[y - 1])
            alone[x:y] = False
    start, end = np.concatenate((start[alone], a)), np.concatenate((end[alone], b))
    order = np.lexsort((-end, start))
    start, end = start[order], end[order]
    keep = np.concatenate(([True], start[1:] >= np.maximum.accumulate(end)[:-1]))
    return start[keep], end[keep]


def _judged(off: np.ndarray, data: np.ndarray, forest: Forest) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    doc, start, end = candidates(off, data)
    if not len(doc):
        return doc, start, end, np.zeros(0)
    raw = data.tobytes()
    x = np.array([features(raw[max(int(off[d]), s - CONTEXT) : s], raw[s:e], raw[e : min(int(off[d + 1]), e + CONTEXT)]) for d, s, e in zip(doc.tolist(), start.tolist(), end.tolist(), strict=True)])
    return doc, start, end, np.concatenate([forest.score(x[i : i + 4096]) for i in range(0, len(x), 4096)])


def scan(docs: DataFrame, forest: Forest, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per candidate: key, start and length (code points), sha256 of the candidate, score, is_secret."""
    names = [key, "start", "length", "finding_sha256", "score", "is_secret"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            off_all, data_all = utf8(batch.column(1))
            for lo, hi in passes(off_all):
                off, data = off_all[lo : hi + 1] - off_all[lo], data_all[off_all[lo] : off_all[hi]]
                doc, start, end, score = _judged(off, data, forest)
                if not len(doc):
                    continue
                points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int64)))
                raw = [hashlib.sha256(data[s:e].tobytes()).hexdigest() for s, e in zip(start, end, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo).take(pa.array(doc)), pa.array(points[start] - points[off[doc]]), pa.array(points[end] - points[start]), pa.array(raw), pa.array(score), pa.array(score >= threshold)], names
                )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, start bigint, length bigint, finding_sha256 string, score double, is_secret boolean")


def redact(docs: DataFrame, forest: Forest, text: str = "text", threshold: float = THRESHOLD, mask: str = MASK) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``mask``; all rows and columns stay, null stays null."""
    names, at = docs.columns, docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            off_all, data_all = utf8(batch.column(at))
            for lo, hi in passes(off_all):
                off, data = off_all[lo : hi + 1] - off_all[lo], data_all[off_all[lo] : off_all[hi]]
                doc, start, end, score = _judged(off, data, forest)
                part = batch.slice(lo, hi - lo)
                hit: dict[int, list[tuple[int, int]]] = {}
                for d, s, e in zip(doc[score >= threshold].tolist(), start[score >= threshold].tolist(), end[score >= threshold].tolist(), strict=True):
                    hit.setdefault(d, []).append((s, e))
                if hit:
                    texts = part.column(at).to_pylist()
                    for d, spans in hit.items():
                        pieces, last = [], int(off[d])
                        for s, e in spans:
                            pieces += [data[last:s].tobytes(), mask.encode()]
                            last = e
                        texts[d] = b"".join([*pieces, data[last : off[d + 1]].tobytes()]).decode()
                    part = part.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
                yield part

    return docs.select(*names).mapInArrow(run, docs.schema)


def op8(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents").select("doc_id", "text"), fit())
