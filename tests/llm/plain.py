"""Brute-force versions of the operators, in plain Python."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

SPACES = re.compile(r"[\x20\x09-\x0D]")
LICENSE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text):
    words = [w for w in SPACES.split(lower(text)) if w]
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def similar(rows):
    """{doc_id: (size, component)} by comparing all pairs."""
    sets = {i: shingles(t) for i, t in rows}
    ids, parent = sorted(sets), {i: i for i in sets}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            one, two = sets[a], sets[b]
            if one and two and 100 * len(one & two) >= 75 * len(one | two):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def same(rows):
    """{doc_id: (keep_id, size, sha256)} of texts equal without white space."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[SPACES.sub("", t or "")].append((-len(t or ""), i))
    out = {}
    for text, members in groups.items():
        for _, i in members:
            out[i] = (min(members)[1], len(members), hashlib.sha256(text.encode()).hexdigest())
    return out


def phrases(text):
    """[(first word, label)] of the base phrases."""
    words = LICENSE_WORD.findall(lower(text))
    found = []
    for phrase, label in PHRASES.items():
        parts = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    return len(words), sorted(found)


def luhn(digits):
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value // 10 + value % 10
    return total % 10 == 0


def personal(text):
    found = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((0, m.start(), m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            found.append((1, m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append((2, m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append((3, m.start(), m.end()))
    return [(("email", "ip", "card", "phone")[k], s, e) for k, s, e in sorted(found)]


_KEYS = "|".join("".join(f"[{c.upper()}{c}]" for c in w) for w in ("password", "passwd", "secret", "token"))
ASSIGN = re.compile(rf"({_KEYS}|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")


def secret(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(("assign", "access", "hex")[k], s, e) for s, k, e in sorted(found)]


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()


def distance(pattern, text):
    """Smallest edit distance of the pattern to any substring."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def damage(rows):
    """{conv_id: rows after damage}, from (conv_id, turn, role, text)."""
    out = {}
    for conv, turn, role, text in rows:
        own = out.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        own += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def repaired(rows):
    """What the audit says of one conversation's (turn, role, text), by trying all edits."""
    key = lambda r: hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], key(r)))
    counts, seen, kinds = [0, 0, 0], set(), []
    for _, role, text in rows:
        solid = SPACES.sub("", text)
        fault = 0 if not solid else 1 if (role, text) in seen else 2 if solid[-1] not in ".!?" else None
        seen.add((role, text))
        if fault is not None:
            counts[fault] += 1
        kinds.append((role, text, fault))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    follow = {"": "us", "s": "u", "u": "a", "a": "u"}
    ways = {"": (0, "", ())}  # by the initial of the last row

    def insert(ways):
        for _ in range(3):
            more = {}
            for state, (cost, audit, kept) in ways.items():
                for role in ("user", "assistant"):
                    if role[0] in follow[state]:
                        way = (cost + 5, audit + "I", (*kept, f"{role}:"))
                        more[role[0]] = min(more.get(role[0], way), way)
            for state, way in more.items():
                if state not in ways or way[:2] < ways[state][:2]:
                    ways = {**ways, state: way}
        return ways

    # States keep all ways that may still win: one per (state, letters inserted since a row).
    for role, text, fault in kinds:
        new = {}

        def offer(state, way):
            if state not in new or way[:2] < new[state][:2]:
                new[state] = way

        for start, first in ways.items():
            layer = {(start, 0): first}
            for k in range(3):
                for (state, depth), (cost, audit, kept) in list(layer.items()):
                    if depth == k:
                        for r in ("user", "assistant"):
                            if r[0] in follow[state]:
                                layer[r[0], k + 1] = (cost + 5, audit + "I", (*kept, f"{r}:"))
            for (state, _), (cost, audit, kept) in layer.items():
                offer(state, (cost + 2, audit + "D", kept))
                if fault in (0, 1):
                    continue
                extra = 5 if fault == 2 else 0
                for r in ("user", "assistant"):
                    if r[0] in follow[state]:
                        offer(r[0], (cost + 1 + extra, audit + "R", (*kept, f"{r}:{text}")))
                if role[:1] and role[:1] in follow[state]:
                    offer(role[:1], (cost + extra, audit + "K", (*kept, f"{role}:{text}")))
        ways = new
    cost, audit, kept = min(w for s, w in insert(ways).items() if s in ("", "a"))
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest())
