"""Secret scan: base patterns, and an assignment-aware lexer for source and configuration text.

The lexer reads name-literal pairs (`name = "x"`, `name: x`, `"name" => 'x'`,
`#define NAME "x"`, `export NAME=x`), follows names that are assigned other
names, joins concatenated literals, and scores each literal by the sensitivity
of every name it reaches.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogmart.llm.common import per_slice, texts

# The base patterns, in the order of their kinds, and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_ASSIGN, MIN_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "named")
_ASSIGN_HINTS = ("passw", "secret", "token", "api")

# How strongly a word in a name tells of a secret; negative words tell against it.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "passcode": 0.9, "pwd": 0.9, "pass": 0.7,
    "secret": 1.0, "secrets": 0.9, "token": 0.9, "bearer": 0.8, "jwt": 0.8,
    "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "creds": 0.8, "auth": 0.6,
    "authorization": 0.7, "private": 0.5, "key": 0.5, "access": 0.3, "api": 0.3, "client": 0.1,
    "signature": 0.4, "signing": 0.4, "encryption": 0.4, "salt": 0.4, "session": 0.3, "cookie": 0.4, "otp": 0.6, "pin": 0.4,
    "public": -0.6, "name": -0.5, "file": -0.6, "path": -0.6, "url": -0.4, "uri": -0.4, "type": -0.6, "length": -0.7,
    "count": -0.7, "max": -0.6, "min": -0.6, "size": -0.7, "limit": -0.7, "policy": -0.6, "field": -0.5, "label": -0.6,
    "hint": -0.6, "expiry": -0.6, "expires": -0.6, "ttl": -0.7, "enabled": -0.8, "required": -0.8, "prompt": -0.5,
}
PLACEHOLDER = re.compile(r"(?i)^(?:change_?me|example.*|your[-_ ].*|x{3,}|\*{3,}|\.{3,}|none|null|true|false|undefined|todo.*|test|dummy|placeholder|<.*>|\$\{.*\}|\{\{.*\}\}|%\w+%|\d{1,5})$")
#: Least product of name and literal score for a secret.
THRESHOLD = 0.4

#: A literal of more characters is known by its first and last ones, its length and the shares of its characters.
SHOWN = 512

_QUOTED = (
    r"(?:\b[bBfFrRuU]{1,2})?(?:"
    + "|".join([r'"""(?:[^"\\]|\\.|"(?!""))*+"""', r"'''(?:[^'\\]|\\.|'(?!''))*+'''", r'"(?:[^"\\\n]|\\.)*+"', r"'(?:[^'\\\n]|\\.)*+'"])
    + ")"
)
_OPENING = re.compile(r"""[A-Za-z]*(\"{3}|'{3}|["'])""")
_STATEMENT = re.compile(
    rf"""(?<![\w$.-])(?P<name>[A-Za-z_$][\w$.-]*+)(?:["']?\]?)(?:[ \t]*(?::=|=>|\+=|[:=])(?![=>])|(?<=\S)[ \t]+(?=["']))[ \t]*"""
    rf"""(?P<value>(?:{_QUOTED}|[^\s"',;(){{}}\[\]]+)(?:[ \t]*\+[ \t]*(?:{_QUOTED}|[A-Za-z_$][\w$.]*))*)""",
)
_PART = re.compile(rf"(?P<quoted>{_QUOTED})|(?P<bare>[^\s+\"']+(?:\+[^\s+\"']+)*)")
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
_IDENTIFIER = re.compile(r"[A-Za-z_$][\w$.]*\Z")


def name_score(name: str) -> float:
    """Between 0 and 1: the strongest word, raised or lowered by the others."""
    words = [x.lower() for x in _WORDS.findall(name)]
    weights = [SENSITIVE.get(x, 0.0) for x in words] + [SENSITIVE.get(a + b, 0.0) for a, b in zip(words, words[1:])]
    up, down = [x for x in weights if x > 0], [x for x in weights if x < 0]
    if not up:
        return 0.0
    return max(0.0, min(1.0, max(up) + 0.5 * (sum(up) - max(up)) + sum(down)))


class Literal:
    """A value put together from pieces of the text.

    Constants that add themselves to themselves double with every line, so a
    long value is never joined: beyond SHOWN characters both ends stand for it.
    places holds spans and the literals that it was made of.
    """

    __slots__ = ("shown", "length", "shares", "places")

    def __init__(self, value: str, places: list):
        self.length, self.places = len(value), places
        self.shown = value if len(value) <= SHOWN else value[: SHOWN // 2] + value[-SHOWN // 2 :]
        self.shares = {c: n / len(value) for c, n in Counter(value).items()} if len(value) > SHOWN else None

    @classmethod
    def joined(cls, parts: list[Literal]) -> Literal:
        if len(parts) == 1:
            return parts[0]
        length = sum(p.length for p in parts)
        if length <= SHOWN:
            return cls("".join(p.shown for p in parts), parts)
        out, half = cls("", parts), SHOWN // 2
        out.length = min(length, 1 << 53)
        head, tail = "", ""
        for part in parts:
            head += part.shown[:half]
            if part.length > half or len(head) >= half:
                break
        for part in reversed(parts):
            tail = part.shown[-half:] + tail
            if part.length > half or len(tail) >= half:
                break
        out.shown, shares = head[:half] + tail[-half:], Counter()
        for part in parts:
            for c, share in part.character_shares().items():
                shares[c] += share * (part.length / length)
        out.shares = dict(shares)
        return out

    def character_shares(self) -> dict[str, float]:
        return self.shares or {c: n / self.length for c, n in Counter(self.shown).items()}

    def score(self) -> float:
        """Between 0 and 1 by length and entropy; 0 for placeholders, blanks inside and under six characters."""
        if self.length < 6 or PLACEHOLDER.match(self.shown):
            return 0.0
        shares = self.character_shares()
        if any(c.isspace() for c in shares):
            return 0.0
        entropy = -sum(p * math.log2(p) for p in shares.values() if p)
        held = "".join(shares)
        kinds = sum(bool(re.search(p, held)) for p in (r"[a-z]", r"[A-Z]", r"[0-9]", r"[^A-Za-z0-9]"))
        return min(1.0, 0.15 * kinds + 0.2 * entropy)


def name_literal_pairs(text: str) -> list[tuple[str, Literal]]:
    """(name, literal) of every assignment, constants propagated; spans exclude quotes and the letters before them."""
    constants: dict[str, Literal] = {}
    pairs = []
    for m in _STATEMENT.finditer(text):
        parts, bare = [], []
        base = m.start("value")
        for part in _PART.finditer(m["value"]):
            if part["quoted"]:
                opening = _OPENING.match(part["quoted"])
                a, b = opening.end(), len(part["quoted"]) - len(opening[1])
                start = base + part.start()
                parts.append(Literal(part["quoted"][a:b], [(start + a, start + b)]))
            elif part["bare"] in constants:
                parts.append(constants[part["bare"]])
            else:
                bare.append(Literal(part["bare"], [(base + part.start(), base + part.end())]))
        if not parts and not bare:
            continue
        known = Literal.joined(parts or bare)  # beside a quoted or known part, a bare one is a name of unknown value
        if not parts and _IDENTIFIER.match(known.shown) and not any(c.isdigit() for c in known.shown):
            continue  # another name whose value is unknown, or prose
        constants[m["name"]] = known
        pairs.append((m["name"], known))
    return pairs


def named_spans(text: str, threshold: float = THRESHOLD) -> list[tuple[int, int]]:
    """Spans of literals that reach a sensitive name."""
    if not any(c in text for c in "=:\"'"):
        return []
    found, seen, open_ = set(), set(), []
    for name, literal in name_literal_pairs(text):
        sensitivity = name_score(name)
        if sensitivity and sensitivity * literal.score() >= threshold:
            open_.append(literal)
        while open_:
            at = open_.pop()
            if id(at) not in seen:
                seen.add(id(at))
                found.update(p for p in at.places if isinstance(p, tuple) and p[1] > p[0])
                open_.extend(p for p in at.places if isinstance(p, Literal))
    return sorted(found)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base spans as (kind, start, end), by start, then kind as listed."""
    found = []
    low = text.lower()
    if any(x in low for x in _ASSIGN_HINTS):
        found += [(0, m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    found += [(1, m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [(2, m.start(), m.end()) for m in HEX.finditer(text)]
    return [(KINDS[k], a, b) for a, k, b in sorted((a, k, b) for k, a, b in found)]


def scan(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans, and all spans with those of the lexer, in order."""
    base = base_spans(text)
    everything = base + [("named", a, b) for a, b in named_spans(text)]
    return base, sorted(everything, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def written(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan_secrets(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document with the number of spans of each kind, the digest of the base spans, and all spans.

    Spans count code points, end exclusive. A null text counts as empty: no
    spans. Repeated rows each get their row; further columns are ignored.
    """

    def process(part):
        rows = []
        for value in texts(part):
            base, everything = scan(value)
            kinds = Counter(k for k, _, _ in everything)
            digest = hashlib.sha256(written(base).encode()).hexdigest()
            rows.append((*[kinds[k] for k in KINDS], digest, written(everything)))
        columns = list(zip(*rows)) if rows else [()] * 6
        counts = [pa.array(c, pa.int64()) for c in columns[:4]]
        return pa.RecordBatch.from_arrays([part.column("doc_id"), *counts, pa.array(columns[4], pa.string()), pa.array(columns[5], pa.string())], names)

    narrow = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = f"doc_id {dict(narrow.dtypes)['doc_id']}, n_assign long, n_access long, n_hex long, n_named long, base_sha256 string, spans string"
    names = [x.split()[0] for x in schema.split(", ")]
    return narrow.mapInArrow(per_slice(process), schema)
