"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors: at-signs, plus signs, digits, schemes and cue words
for addresses and accounts. From each anchor a small parser expands to the boundaries of what
it stands for and validates it. Every base kind is found exactly where a leftmost search of
its expression over the whole text would find it, because a match lies in a run of characters
around its anchor and nothing outside the run can change it.

Defined results: a null text is the empty one and holds nothing; a match that fails its test
is used up, nothing is tried again inside it; spans are code points, end exclusive, ordered by
kind and then by start; rows keep their place and other columns their values.
"""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidewire.llm.common import appended, ascii_lower_aligned, doc_columns, map_batches, slices, strings, table
from tidewire.llm.secret_scan import span_digest

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "iban", "account", "address")

# The characters and forms of the base kinds, then of the method's own.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGITS = re.compile(r"[0-9]+")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_URL = re.compile(r"(?:https?|ftp)://((?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}|localhost)(?::[0-9]{1,5})?(?:[/?#][^\s\"'<>]*)?", re.ASCII)
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_NUMBER = re.compile(r"(?: (?:number|nummer|no\.?|nr\.?))?[ :#]{1,3}([0-9](?:[ -]?[0-9]){5,17})(?![0-9])", re.IGNORECASE | re.ASCII)
_AFTER = re.compile(r",? ([0-9]{1,5}[a-z]?)(?![0-9A-Za-z])")
_BEFORE = re.compile(r"(?<![0-9A-Za-z])[0-9]{1,5}[a-z]?(?: [A-Z][a-z]+){1,3} $", re.ASCII)
_SCHEMES = ("http://", "https://", "ftp://")
_ACCOUNT_CUES = ("account", "acct", "konto", "cuenta", "compte")
_STREET_CUES = ("street", "avenue", "road", "boulevard")
_ADDRESS_REACH = 64

_automaton = None


def _anchors() -> ahocorasick.Automaton:
    """Built once per Python worker."""
    global _automaton
    if _automaton is None:
        own = ahocorasick.Automaton()
        for word in ("@", "+", *"0123456789", "iban"):
            own.add_word(word, (word if not word.isdigit() else "0", len(word)))
        for kind, words in (("url", _SCHEMES), ("account", _ACCOUNT_CUES), ("address", _STREET_CUES)):
            for word in words:
                own.add_word(word, (kind, len(word)))
        own.make_automaton()
        _automaton = own
    return _automaton


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) << (place & 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _iban_valid(text: str) -> bool:
    plain = text.replace(" ", "")
    return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def scan(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind in the order of ``KINDS``, then start."""
    if not text:
        return []
    used = dict.fromkeys(KINDS, 0)
    found = []

    def take(kind: str, start: int, end: int, valid: bool) -> None:
        used[kind] = end
        if valid:
            found.append((KINDS.index(kind), start, end))

    for last, (anchor, length) in _anchors().iter(ascii_lower_aligned(text)):
        at = last - length + 1
        if anchor == "0":
            if at >= used["card"] and (m := _CARD.match(text, at)):
                digits = m[0].replace(" ", "").replace("-", "")
                take("card", at, m.end(), 16 <= len(digits) <= 19 and luhn(digits))
            if at >= used["ip"]:
                if m := _IP.match(text, at):
                    take("ip", at, m.end(), all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")))
                else:
                    used["ip"] = _DIGITS.match(text, at).end()  # no start inside this run can do better
        elif anchor == "@":
            if m := _DOMAIN.match(text, at + 1):
                start = at
                while start > used["email"] and text[start - 1] in _LOCAL:
                    start -= 1
                if start < at:
                    take("email", start, m.end(), True)
        elif anchor == "+":
            if m := _PHONE.match(text, at):
                take("phone", at, m.end(), 8 <= sum(c.isdigit() for c in m[0]) <= 15)
        elif anchor == "url":
            if at >= used["url"] and (m := _URL.match(text, at)):
                take("url", at, m.end(), True)
        elif anchor == "iban":
            if m := re.compile(r"[ :]{0,3}").match(text, last + 1):
                number = _IBAN.match(text, m.end())
                if number and number.start() >= used["iban"]:
                    take("iban", number.start(), number.end(), _iban_valid(number[0]))
        elif anchor == "account":
            if (m := _NUMBER.match(text, last + 1)) and m.start(1) >= used["account"]:
                take("account", m.start(1), m.end(1), True)
        elif at >= used["address"]:
            # A house number behind the street's name, or before it.
            begin = max(used["address"], at - _ADDRESS_REACH)
            if m := _BEFORE.search(text[begin:at]):
                take("address", begin + m.start(), last + 1, True)
            elif m := _AFTER.match(text, last + 1):
                start = at
                while start > begin and text[start - 1].isalpha():
                    start -= 1
                take("address", start, m.end(), True)
    return [(KINDS[k], s, e) for k, s, e in sorted(found)]


def personal_data(docs: DataFrame) -> DataFrame:
    """``docs`` with a column ``personal_data``, in place of any of that name: an array of (kind, start, end)."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    docs = docs.drop("personal_data")

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                spans = [[{"kind": k, "start": s, "end": e} for k, s, e in scan(t)] for t in strings(part.column("text"))]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(spans, kind)], names=[*part.schema.names, "personal_data"])

    return map_batches(docs, run, appended(docs.schema, "personal_data array<struct<kind:string,start:bigint,end:bigint>>"))


def op6_pii_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = personal_data(doc_columns(table(spark, folder, "documents")))
    return found.selectExpr("doc_id", *span_digest("personal_data", BASE))
