"""Secrets: an Aho-Corasick keyword automaton, anchored expressions at its hits, checksums.

One automaton finds every keyword in one pass over the lower-cased text. Each hit names the
kinds it may open; their expressions are matched only there, on the original text, and a
kind's matches never overlap. Tokens that carry a checksum count only if it is right.

For long hexadecimal strings the keywords are all decimal digits and all words of four
letters a to f: a run of 24 hexadecimal digits holds one or the other.

Defined results: a null text is the empty one and holds nothing; a match that fails its test
is used up, nothing is tried again inside it; spans are code points, end exclusive; rows
keep their place and other columns their values.
"""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidewire.llm.common import appended, ascii_lower_aligned, doc_columns, map_batches, slices, strings, table

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "hub_token", "package_token", "signed_token", "private_key", "service_token")

# What opens each kind, and what the match looks like from there.
_ASSIGN = re.compile(
    r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_HUB = re.compile(r"gh[pousr]_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
_PACKAGE = re.compile(r"npm_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
_SIGNED = re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{16,}")
_KEY = re.compile(r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END (?:[A-Z]+ )?PRIVATE KEY-----")
_SERVICE = re.compile(r"(?:xox[abpr]-[0-9A-Za-z-]{20,}|sk_live_[0-9A-Za-z]{20,})")
_KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "hub_token": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "package_token": ("npm_",),
    "signed_token": ("eyj",),
    "private_key": ("-----begin ",),
    "service_token": ("xoxa-", "xoxb-", "xoxp-", "xoxr-", "sk_live_"),
}
_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def _base62_crc(body: str) -> str:
    """CRC-32 of the body in base 62, six digits."""
    value, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        out = _BASE62[digit] + out
    return out


def _checked(match: re.Match) -> bool:
    return _base62_crc(match[1]) == match[2]


# Per kind: the expression, the test of a match, and whether a hit may lie inside the match.
_RULES = {
    "assign": (_ASSIGN, lambda m: len(m[1]) >= 6),
    "access": (_ACCESS, lambda m: m.end() - m.start() >= 20),
    "hex": (_HEX, lambda m: m.end() - m.start() >= 24),
    "hub_token": (_HUB, _checked),
    "package_token": (_PACKAGE, _checked),
    "signed_token": (_SIGNED, lambda m: True),
    "private_key": (_KEY, lambda m: True),
    "service_token": (_SERVICE, lambda m: True),
}
_HEX_LETTERS = frozenset("0123456789abcdef")
# A signed token that fails, fails from every later place of its first run of letters as well:
# the run ends where it ended, and is shorter.
_SIGNED_RUN = re.compile(r"[A-Za-z0-9_-]*")

_automaton = None


def _keywords() -> ahocorasick.Automaton:
    """Built once per Python worker from the rules above."""
    global _automaton
    if _automaton is None:
        own = ahocorasick.Automaton()
        for kind, words in _KEYWORDS.items():
            for word in words:
                own.add_word(word, (kind, len(word)))
        for digit in "0123456789":
            own.add_word(digit, ("hex", 1))
        for four in itertools.product("abcdef", repeat=4):
            own.add_word("".join(four), ("hex", 4))
        own.make_automaton()
        _automaton = own
    return _automaton


def scan(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind in the order of ``KINDS``."""
    if not text:
        return []
    used = dict.fromkeys(KINDS, 0)
    found = []
    for last, (kind, length) in _keywords().iter(ascii_lower_aligned(text)):
        start = last - length + 1
        if start < used[kind]:
            continue
        if kind == "hex":
            # The run around the hit, in the original letters; what was used lies before it.
            while start > used[kind] and text[start - 1] in _HEX_LETTERS:
                start -= 1
        rule, test = _RULES[kind]
        match = rule.match(text, start)
        if match is None:
            if kind == "signed_token":
                used[kind] = _SIGNED_RUN.match(text, start).end()
            continue
        used[kind] = match.end()
        if test(match):
            found.append((start, KINDS.index(kind), match.end()))
    return [(KINDS[k], s, e) for s, k, e in sorted(found)]


def secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with a column ``secrets``, in place of any of that name: an array of (kind, start, end)."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    docs = docs.drop("secrets")

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                spans = [[{"kind": k, "start": s, "end": e} for k, s, e in scan(t)] for t in strings(part.column("text"))]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(spans, kind)], names=[*part.schema.names, "secrets"])

    return map_batches(docs, run, appended(docs.schema, "secrets array<struct<kind:string,start:bigint,end:bigint>>"))


def op9_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets(doc_columns(table(spark, folder, "documents")))
    return found.selectExpr("doc_id", *span_digest("secrets", BASE))


def span_digest(column: str, base: tuple[str, ...]) -> list[str]:
    """Counts per base kind, the hash over the base spans, and all spans as text."""
    kinds = ", ".join(f"'{k}'" for k in base)
    text = "s -> concat(s.kind, ':', s.start, ':', s.end)"
    return [
        *[f"cast(size(filter({column}, s -> s.kind = '{k}')) as bigint) as n_{k}" for k in base],
        f"sha2(array_join(transform(filter({column}, s -> s.kind in ({kinds})), {text}), ','), 256) as base_sha256",
        f"array_join(transform({column}, {text}), ',') as spans",
    ]


def digest_of(spans: list[tuple[str, int, int]], base: tuple[str, ...]) -> str:
    """The hash that ``span_digest`` computes, for spans in Python."""
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans if k in base).encode()).hexdigest()
