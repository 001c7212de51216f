"""License statements by ordered signature rules.

A rule is an expression over the lower-cased words of a text, with a label, a priority and
the keywords without which it cannot match. An Aho-Corasick pass over the raw text finds the
keywords; only texts that hold some are split into words, and around each only rules whose keywords
are all there are tried. Of overlapping detections, one whose words lie within a detection of the
same or a higher priority is suppressed. The base phrases are reported as they stand.

Defined results: a null text is the empty one, with no words, no labels, null positions and
score 0; repeated statements are all counted; rows keep their place and other columns their
values.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidewire.llm.common import appended, doc_columns, flat, map_batches, per_row, slices, strings, table

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

# The base phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Licenses: identifier, the names it goes by as words, the versions that exist.
_FAMILIES = (
    ("mit", ("mit license", "mit licence", "expat license", "x11 license"), ()),
    ("apache", ("apache license", "apache licence", "apache software license"), ("1 0", "1 1", "2 0")),
    ("gpl", ("gnu general public license", "general public license", "gnu gpl", "gpl"), ("1", "2", "2 0", "3", "3 0")),
    ("lgpl", ("gnu lesser general public license", "lesser general public license", "gnu library general public license", "lgpl"), ("2", "2 0", "2 1", "3", "3 0")),
    ("agpl", ("gnu affero general public license", "affero general public license", "agpl"), ("1", "1 0", "3", "3 0")),
    ("fdl", ("gnu free documentation license", "gfdl"), ("1 1", "1 2", "1 3")),
    ("bsd", ("bsd license", "bsd licence", "bsd style license"), ()),
    ("bsd-2-clause", ("2 clause bsd license", "simplified bsd license", "freebsd license", "bsd 2 clause license"), ()),
    ("bsd-3-clause", ("3 clause bsd license", "new bsd license", "modified bsd license", "revised bsd license", "bsd 3 clause license"), ()),
    ("bsd-4-clause", ("4 clause bsd license", "original bsd license"), ()),
    ("isc", ("isc license", "isc licence"), ()),
    ("mpl", ("mozilla public license",), ("1 0", "1 1", "2 0")),
    ("epl", ("eclipse public license",), ("1 0", "2 0")),
    ("cpl", ("common public license",), ("1 0",)),
    ("cddl", ("common development and distribution license", "cddl"), ("1 0", "1 1")),
    ("eupl", ("european union public licence", "european union public license", "eupl"), ("1 0", "1 1", "1 2")),
    ("artistic", ("artistic license",), ("1 0", "2 0")),
    ("zlib", ("zlib license", "zlib libpng license"), ()),
    ("boost", ("boost software license",), ("1 0",)),
    ("ofl", ("sil open font license", "open font license"), ("1 0", "1 1")),
    ("unlicense", ("the unlicense", "unlicense"), ()),
    ("wtfpl", ("do what the fuck you want to public license", "wtfpl"), ("1", "2")),
    ("psf", ("python software foundation license", "psf license"), ("2",)),
    ("postgresql", ("postgresql license",), ()),
    ("ms-pl", ("microsoft public license",), ()),
    ("ms-rl", ("microsoft reciprocal license",), ()),
    ("cc0", ("cc0", "creative commons zero", "creative commons cc0"), ("1 0",)),
    *(
        (
            "cc-" + "-".join(short for short, _ in parts),
            (
                "creative commons " + " ".join(long for _, long in parts),
                "cc " + " ".join(short for short, _ in parts),
            ),
            ("1 0", "2 0", "2 5", "3 0", "4 0"),
        )
        for parts in (
            (("by", "attribution"),),
            (("by", "attribution"), ("sa", "sharealike")),
            (("by", "attribution"), ("nd", "noderivatives")),
            (("by", "attribution"), ("nc", "noncommercial")),
            (("by", "attribution"), ("nc", "noncommercial"), ("sa", "sharealike")),
            (("by", "attribution"), ("nc", "noncommercial"), ("nd", "noderivatives")),
        )
    ),
)

# Statements around a name or identifier, strongest first, with how sure they make.
_STATEMENTS = (
    (r"spdx license identifier {id}", 1.0, ("spdx",)),
    (r"(?:this|the) (?:software|work|program|project|library|file|document) is (?:licensed )?under (?:the )?{name}", 0.95, ()),
    (r"(?:licensed|released|distributed|available|published|provided) under (?:the )?(?:terms of )?(?:the )?{name}", 0.95, ()),
    (r"(?:subject to|under) the terms (?:and conditions )?of the {name}", 0.9, ()),
    (r"{name}", 0.6, ()),
)

# Characteristic sentences of license texts themselves.
_SENTENCES = (
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy", "hereby granted"),
    ("isc", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "hereby granted"),
    ("bsd", r"redistribution and use in source and binary forms with or without modification are permitted", "redistribution"),
    ("gpl", r"this program is free software you can redistribute it and or modify it", "redistribute"),
    ("lgpl", r"this library is free software you can redistribute it and or modify it", "redistribute"),
    ("gpl-no-warranty", r"without even the implied warranty of merchantability or fitness for a particular purpose", "merchantability"),
    ("warranty-disclaimer", r"the software is provided as is without warranty of any kind", "warranty without"),
    ("zlib", r"this software is provided as is without any express or implied warranty", "warranty implied"),
    ("public-domain", r"(?:dedicated|released|placed) (?:in)?to the public domain", "domain public"),
    ("proprietary", r"all rights reserved", "reserved rights"),
)


@dataclass(frozen=True)
class Rule:
    label: str
    pattern: re.Pattern
    priority: int
    weight: float
    keywords: tuple[str, ...]


def _identifier(family: str, version: str) -> str:
    return f"{family}-{version.replace(' ', '.')}" if version else family


def _any_of(names) -> str:
    return "(?:" + "|".join(sorted(names, key=len, reverse=True)) + ")"


def _make_rules() -> tuple[Rule, ...]:
    """Statements times names times versions, and the sentences; highest priority first."""
    rules = []
    for family, names, versions in _FAMILIES:
        for version in ("", *versions):
            spelled = _any_of(names)
            if version:
                spelled += rf"(?: version| v)? v?{version}"
            # A version may stand right behind a short name ("gplv3"), an unknown one counts as none.
            if versions and (short := [n for n in names if n[-1].isalpha() and not n.endswith(("license", "licence"))]):
                spelled = rf"(?:{spelled}|{_any_of(short)}v?{version or '[0-9]+'})"
            later = r"(?P<later> (?:or (?:any )?later(?: version)?|only))?" if version and family.endswith("gpl") else ""
            label = _identifier(family, version)
            for place, (form, weight, extra) in enumerate(_STATEMENTS):
                shown = form.replace("{id}", label.replace("-", " ").replace(".", " ")).replace("{name}", spelled)
                # A version says more than none, a statement more than a bare name.
                priority = 20 * len(version.split()) + 2 * (len(_STATEMENTS) - place) + (family in ("lgpl", "agpl", "fdl"))
                # Each name needs its longest word; a rule with several names needs what all share.
                words = [max(n.split(), key=len) for n in names] if "{name}" in form else [label.split("-")[0]]
                common = {w for w in words if all(w in n for n in (names if "{name}" in form else [label]))}
                rules.append(Rule(label, re.compile(rf"(?<= ){shown}{later}(?= )"), priority, weight, (*extra, *sorted(common))))
    for label, form, keyword in _SENTENCES:
        rules.append(Rule(label, re.compile(rf"(?<= ){form}(?= )"), 12, 0.8, tuple(keyword.split())))
    return tuple(sorted(rules, key=lambda r: -r.priority))


RULES = _make_rules()
# Words of which every text with a detection holds at least one.
_TRIGGERS = frozenset(("licen", "spdx", "gpl", "gfdl", "cddl", "eupl", "wtfpl", "cc0", "creative", "cc by", *(s[2].split()[0] for s in _SENTENCES)))
_GATE = tuple(sorted(_TRIGGERS.union(*(r.keywords for r in RULES))))
_TRIGGER = re.compile("|".join(sorted(_TRIGGERS)))
# Triggers of two words as they may stand in the raw text, parted by whatever parts words.
_APART = re.compile("|".join(t.replace(" ", r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+") for t in sorted(_TRIGGERS) if " " in t))
_REACH = 256
# No match is as long.
_LONGEST = 4 * _REACH
_BASE_PATTERNS = tuple((re.compile(rf"(?<= ){phrase}(?= )"), label) for phrase, label in BASE.items())

_automaton = None


def _keywords() -> ahocorasick.Automaton:
    global _automaton
    if _automaton is None:
        own = ahocorasick.Automaton()
        for word in _GATE:
            own.add_word(word, word)
        own.make_automaton()
        _automaton = own
    return _automaton


def ascii_lower(text: str) -> str:
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def _windows(joined: str) -> list[tuple[int, int]]:
    """Stretches around the trigger words; a match is shorter than ``_REACH`` and holds one."""
    out: list[tuple[int, int]] = []
    for hit in _TRIGGER.finditer(joined):
        begin = joined.rfind(" ", 0, max(1, hit.start() - _REACH))
        end = joined.find(" ", min(len(joined) - 1, hit.end() + _REACH)) + 1
        begin, end = max(begin, 0), end or len(joined)
        if out and begin < out[-1][1]:
            out[-1] = (out[-1][0], end)
        else:
            out.append((begin, end))
    return out


def scan(text: str) -> dict:
    """Base places and surviving detections of one text; ``detections`` holds
    (label, first word, end word, weight), ``base`` (label, first word)."""
    low = ascii_lower(text)
    present = {word for _, word in _keywords().iter(low)} if low else set()
    if not present & _TRIGGERS and not _APART.search(low):
        return {"base": [], "detections": []}
    joined = f" {' '.join(_WORD.findall(low))} "
    blanks = np.flatnonzero(np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4") == 0x20)

    def word_at(place: int) -> int:
        return int(np.searchsorted(blanks, place)) - 1

    base = [(label, word_at(m.start())) for pattern, label in _BASE_PATTERNS for m in pattern.finditer(joined)]
    kept: list[tuple[int, int, Rule]] = []
    # Detections by where they begin: what holds another begins in the same stretch or the one before.
    nearby: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for begin, end in _windows(joined):
        near = {word for _, word in _keywords().iter(joined[begin:end])}
        matches = [(m.span(), rule) for rule in RULES if near.issuperset(rule.keywords) for m in rule.pattern.finditer(joined, begin, end)]
        # What may hold another comes before it: higher priorities first, then longer detections.
        for (first, last), rule in sorted(matches, key=lambda m: (-m[1].priority, m[0][0] - m[0][1])):
            stretch = first // _LONGEST
            if not any(s <= first and last <= e for at in (stretch, stretch - 1) for s, e in nearby[at]):
                kept.append((first, last, rule))
                nearby[stretch].append((first, last))
    found = [(rule.label, word_at(s), word_at(e), rule.weight) for s, e, rule in sorted(kept, key=lambda k: k[:2])]
    return {"base": sorted(base, key=lambda b: b[1]), "detections": found}


def count_words(batch: pa.RecordBatch) -> np.ndarray:
    """Words per text, counted on bytes: every byte of a non-ASCII character is a word's."""
    raw, offsets = flat(batch.column("text"))
    inside = _WORD_BYTES[raw]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    # A text begins anew even where the one before it ended in a word.
    firsts = offsets[:-1][offsets[1:] > offsets[:-1]]
    starts[firsts] = inside[firsts]
    return per_row(starts, offsets)


_WORD_BYTES = np.zeros(256, bool)
_WORD_BYTES[0x80:] = True
for _range in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B)):
    _WORD_BYTES[slice(*_range)] = True

_TYPE = "struct<n_words:bigint,base:array<struct<label:string,word:bigint>>,detections:array<struct<label:string,first:bigint,end:bigint,weight:double>>>"


def licenses(docs: DataFrame) -> DataFrame:
    """``docs`` with a struct column ``licenses``, in place of any of that name: n_words, base places, detections."""
    base = pa.struct([("label", pa.string()), ("word", pa.int64())])
    one = pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64()), ("weight", pa.float64())])
    kind = pa.struct([("n_words", pa.int64()), ("base", pa.list_(base)), ("detections", pa.list_(one))])

    docs = docs.drop("licenses")

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                rows = []
                for text, words in zip(strings(part.column("text")), count_words(part)):
                    found = scan(text)
                    rows.append(
                        {
                            "n_words": int(words),
                            "base": [dict(zip(("label", "word"), b)) for b in found["base"]],
                            "detections": [dict(zip(("label", "first", "end", "weight"), d)) for d in found["detections"]],
                        }
                    )
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(rows, kind)], names=[*part.schema.names, "licenses"])

    return map_batches(docs, run, appended(docs.schema, f"licenses {_TYPE}"))


def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses(doc_columns(table(spark, folder, "documents")))
    return found.selectExpr(
        "doc_id",
        "licenses.n_words as n_words",
        "cast(size(licenses.base) as bigint) as n_base",
        "array_min(licenses.base.word) as first_word",
        "array_max(licenses.base.word) as last_word",
        "array_join(array_sort(array_distinct(licenses.base.label)), ',') as base_labels",
        "array_join(array_sort(array_union(licenses.base.label, licenses.detections.label)), ',') as labels",
        "coalesce(array_max(licenses.detections.weight), if(size(licenses.base) > 0, 0.6D, 0D)) as score",
    )
