"""License, personal-data and secret scans against plain searches of whole texts."""

from __future__ import annotations

import random
import zlib

import plain
import pytest

from tidewire.llm import license_scan, pii_scan, secret_scan
from tidewire.llm.queries import QUERIES


def texts(spark, folder):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}


def check(kinds, row, spans):
    for kind in kinds:
        assert row[f"n_{kind}"] == sum(s[0] == kind for s in spans)
    assert row["base_sha256"] == plain.digest(spans)
    assert {f"{k}:{s}:{e}" for k, s, e in spans} <= set(row["spans"].split(",")) | {""}


def test_personal_data_of_documents(spark, larger):
    want = texts(spark, larger)
    rows = QUERIES["op6_pii_scan"](spark, larger).collect()
    assert len(rows) == len(want)
    for row in rows:
        check(pii_scan.BASE, row, plain.personal(want[row["doc_id"]]))


def test_secrets_of_documents(spark, larger):
    want = texts(spark, larger)
    rows = QUERIES["op9_secret_scan"](spark, larger).collect()
    assert len(rows) == len(want)
    for row in rows:
        check(secret_scan.BASE, row, plain.secret(want[row["doc_id"]]))


def test_licenses_of_documents(spark, larger):
    want = texts(spark, larger)
    rows = QUERIES["op3_license_scan"](spark, larger).collect()
    assert len(rows) == len(want)
    for row in rows:
        words, found = plain.phrases(want[row["doc_id"]])
        labels = sorted({label for _, label in found})
        assert (row["n_words"], row["n_base"]) == (words, len(found))
        assert (row["first_word"], row["last_word"]) == ((found[0][0], found[-1][0]) if found else (None, None))
        assert row["base_labels"] == ",".join(labels)
        assert set(labels) <= set(row["labels"].split(",")) | {""}
        assert row["labels"] == ",".join(sorted(set(row["labels"].split(","))))
        assert 0 <= row["score"] <= 1 and (row["score"] > 0) == (row["labels"] != "")


def test_spans_of_random_texts():
    pick = random.Random(3)
    secret_parts = ["password", "Secret", "api_key", "APIKEY", "token", ":", "=", "'", '"', " ", "abc123", "AKIA", "ABCDEF0123456789", "deadbeef", "cafe", "A", "é", "İ", "x."]
    personal_parts = ["a@b", "@", ".", "c.d", "+1", "+", "-", " ", "12", "4111111111111111", "0", "256", "1.2.3.4", "(5)", "é", "İ", "%", "iban "]
    for _ in range(4000):
        text = "".join(pick.choices(secret_parts, k=pick.randrange(14)))
        assert [s for s in secret_scan.scan(text) if s[0] in secret_scan.BASE] == plain.secret(text)
        text = "".join(pick.choices(personal_parts, k=pick.randrange(14)))
        assert [s for s in pii_scan.scan(text) if s[0] in pii_scan.BASE] == plain.personal(text)


def test_tokens_need_their_checksum():
    body = "a1B2c3D4e5F6g7H8i9J0k1L2m3N4o5"
    value, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, d = divmod(value, 62)
        digits = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"[d] + digits
    good = f"see ghp_{body}{digits} here"
    assert [s[0] for s in secret_scan.scan(good)] == ["hub_token"]
    assert not secret_scan.scan(good.replace("a1B2", "a1B3"))


def test_other_personal_data():
    found = pii_scan.scan("IBAN DE89 3704 0044 0532 0130 00, account no. 12345678, 12 Old Mill Road, https://a.example.org/x?y=1")
    assert {k for k, _, _ in found} == {"iban", "account", "address", "url"}
    assert not [s for s in pii_scan.scan("IBAN DE89 3704 0044 0532 0130 01") if s[0] == "iban"]


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("Licensed under the Apache License, Version 2.0.", ["apache-2.0"]),
        ("GNU Lesser General Public License v2.1 or later", ["lgpl-2.1"]),
        ("SPDX-License-Identifier: MIT", ["mit"]),
        ("This work is licensed under CC BY-SA 4.0", ["cc-by-sa-4.0"]),
        ("mit der Lizenz", []),
    ],
)
def test_contained_detections_give_way(text, labels):
    assert [d[0] for d in license_scan.scan(text)["detections"]] == labels


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("CC-BY-SA 4.0", ["cc-by-sa-4.0"]),
        ("Released under CC-BY-4.0", ["cc-by-4.0"]),
        ("(CC) BY-NC-ND 3.0", ["cc-by-nc-nd-3.0"]),
        ("a success by chance", []),
        ("GPLv3", ["gpl-3"]),
        ("LGPLv2.1", ["lgpl-2.1"]),
        ("under the AGPLv3", ["agpl-3"]),
        ("GNU GPLv2 or later; see LICENSE", ["gpl-2"]),
        ("GPL3, then GPL-2.0", ["gpl-3", "gpl-2.0"]),
        ("GPL v9 and GPLv9", ["gpl", "gpl"]),
        ("GPLvx", []),
    ],
)
def test_usual_spellings(text, labels):
    assert [d[0] for d in license_scan.scan(text)["detections"]] == labels


def test_usual_spellings_score(spark):
    frame = spark.createDataFrame([(1, "Released under CC-BY-4.0"), (2, "GPLv3")], "doc_id long, text string")
    found = {r["doc_id"]: [(d["label"], d["first"], d["end"], d["weight"]) for d in r["licenses"]["detections"]] for r in license_scan.licenses(frame).collect()}
    assert found == {1: [("cc-by-4.0", 0, 5, 0.95)], 2: [("gpl-3", 0, 0, 0.6)]}


def test_what_parts_words_decides_nothing():
    want = license_scan.scan("CC BY-NC")
    assert "cc-by-nc" in {d[0] for d in want["detections"]}
    assert all(license_scan.scan(text) == want for text in ("CC-BY-NC", "CC\nBY-NC", "cc/by_nc", "(CC) BY NC!"))


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("Under the Apache License, Version 2.0; parts: BSD license, Mozilla Public License.", ["apache-2.0", "bsd", "mpl"]),
        ("GPLv3 for the code, CC BY 4.0 for the texts, ISC license for the rest", ["gpl-3", "cc-by-4.0", "isc"]),
        ("CC BY-NC", ["cc-by-nc"]),
        ("Creative Commons Attribution ShareAlike", ["cc-by-sa"]),
    ],
)
def test_a_detection_hides_nothing_behind_it(text, labels):
    assert [d[0] for d in license_scan.scan(text)["detections"]] == labels


def test_detections_of_random_texts():
    pick = random.Random(8)
    parts = ["the", "MIT license", "licensed under", "Apache License", "2.0", "v3", "GPL", "GNU", "GPLv2", "or later", "CC", "BY", "NC", "SA", "4.0", "creative commons", "attribution", "BSD license", "all rights reserved", "SPDX-License-Identifier:", "MIT"]
    for _ in range(300):
        text = " ".join(pick.choices(parts, k=pick.randrange(40)))
        # Every rule over the whole text, without keywords or windows.
        joined = f" {' '.join(plain.LICENSE_WORD.findall(plain.lower(text)))} "
        hits = [(m.span(), r) for r in license_scan.RULES for m in r.pattern.finditer(joined)]
        kept = []
        for (first, last), rule in sorted(hits, key=lambda h: (-h[1].priority, h[0][0] - h[0][1])):
            if not any(f <= first and last <= e for f, e, _ in kept):
                kept.append((first, last, rule.label))
        want = [(label, joined.count(" ", 0, f) - 1, joined.count(" ", 0, e) - 1) for f, e, label in sorted(kept)]
        assert [d[:3] for d in license_scan.scan(text)["detections"]] == want, text


def test_rules_are_many_and_ordered():
    assert len(license_scan.RULES) > 300
    order = [r.priority for r in license_scan.RULES]
    assert order == sorted(order, reverse=True)


def test_odd_tables(odd, nothing):
    for scan, column in ((secret_scan.secrets, "secrets"), (pii_scan.personal_data, "personal_data"), (license_scan.licenses, "licenses")):
        out = scan(odd)
        assert out.columns[-1] == column and out.columns.count(column) == 1
        assert out.count() == odd.count()
        assert scan(nothing).count() == 0
    found = {r["doc_id"]: r["licenses"]["n_words"] for r in license_scan.licenses(odd).where("doc_id <> 7").collect()}
    assert (found[1], found[2], found[3], found[4], found[10]) == (0, 0, 0, 6, 1)


def test_scans_of_long_repeated_texts_are_quick():
    """Time in proportion to length: notices of a megabyte, and runs that open tokens without end."""
    import time

    def took(scan, text):
        began = time.perf_counter()
        scan(text)
        return time.perf_counter() - began

    for scan, text in ((license_scan.scan, "see the mit license and gpl v2 or so. " * 7_000), (secret_scan.scan, "eyJ" * 100_000), (secret_scan.scan, "eyJabcdefgh." * 40_000)):
        assert took(scan, text * 4) < 8 * took(scan, text) + 0.5
    found = license_scan.scan("see the mit license and gpl v2 or so. " * 300)
    assert len(found["base"]) == 300 and len(found["detections"]) == 600


def test_signed_tokens_behind_runs_that_fail():
    token = "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0In0.SflKxwRJSMeKKF2QT4fw"
    text = f"eyJeyJeyJ eyJshort. {token} eyJhbGciOiJIUzI1NiJ9.x"
    assert [text[s:e] for k, s, e in secret_scan.scan(text) if k == "signed_token"] == [token]
