"""Packing: round trip of ids, gapless sequences, little padding."""

from __future__ import annotations

import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidewire.llm import packing
from tidewire.llm.queries import QUERIES


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def check_sequences(rows):
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 4096
    return len(sequences)


def test_documents_are_packed_whole(spark, larger, tokenizer):
    rows = QUERIES["op7_packing"](spark, larger).collect()
    pieces = defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{larger}/documents.parquet").collect()}
    assert set(pieces) == set(texts)
    for i, own in pieces.items():
        ids, at = np.array(ids_of(tokenizer, texts[i]), "<u4"), 0
        for r in sorted(own, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : at].tobytes())
        assert at == len(ids)
    total = sum(r["length"] for r in rows)
    assert total / (4096 * check_sequences(rows)) > 0.97


def test_ids_of_odd_texts(tokenizer):
    encoder = packing.Encoder(packing.Settings(cached_words=8))
    texts = ["", "  ", "<|endoftext|> a<|EndOfText|>b", "İstanbul İ ≠ K", "it's IT'S don't 12 3x y\x1cz q", "é ́", "ΑΣ ΑΣ.", "中文字 テスト", "a... b!!! c,̸ d~ e|| f_ g.h. i'. j;", "word*** ED!! x<y <z>.", "one two three four five six seven eight nine ten eleven"]
    pick = random.Random(4)
    signs = list("ab'.,!<|>_-é́ \n\t\x0b\x1c\x85 ßÉ0") + ["'s", "<|endoftext|>"]
    texts += ["".join(pick.choices(signs, k=pick.randrange(25))) for _ in range(500)]
    for text in texts:
        ids, count = encoder.encode([text.encode()], 2)
        assert ids.tolist() == ids_of(tokenizer, text) and count.tolist() == [len(ids)], repr(text)


def test_ids_of_more_words_than_are_cached(tokenizer):
    """New and known words that do not fit together: none of them loses its ids."""
    encoder = packing.Encoder(packing.Settings(cached_words=8))
    known = "one two 3x"
    many = known + " " + " ".join(f"word{chr(97 + i)} {i}z" for i in range(20))
    few = "one wordb four five six seven eight nine"
    for texts in ([known], [many], [known], [few], [many, few, known, ""], [known, many]):
        ids, count = encoder.encode([t.encode() for t in texts], 2)
        want = [ids_of(tokenizer, t) for t in texts]
        assert ids.tolist() == sum(want, []) and count.tolist() == [len(w) for w in want]


def test_words_are_those_of_single_texts():
    tail = re.compile(rb"(?<=[a-z])([!-&(-/:;=?@\[-`{-~]+)(?=[ \t-\r]|\Z)")
    pick = random.Random(5)
    signs = list("abZ'.,!<|>_-é́ \n\t\x0b\x1c\x85 ßÉ0") + ["<|"]
    for _ in range(2000):
        texts = ["".join(pick.choices(signs, k=pick.randrange(12))).encode() for _ in range(pick.randrange(6))]
        want = [t.split() if b"<|" in t else tail.sub(rb" \1", t.lower()).split() for t in texts]
        words, counts = packing.words_of(texts)
        assert words.to_pylist() == sum(want, []) and counts.tolist() == [len(w) for w in want], texts


def test_a_word_is_looked_up_once_however_often_it_stands(tokenizer, monkeypatch):
    encoder = packing.Encoder(packing.Settings())
    asked = []
    look_up = encoder._look_up
    monkeypatch.setattr(encoder, "_look_up", lambda words: asked.extend(words) or look_up(words))
    text = "One word, two words, 3x words! " * 500
    ids, _ = encoder.encode([text.encode(), b"", text.encode()], 2)
    assert ids.tolist() == [*ids_of(tokenizer, text), 2, *ids_of(tokenizer, text)]
    # Once before and once after its ids are learned.
    assert max(asked.count(w) for w in asked) <= 2


def test_ids_of_words_of_letters(tokenizer):
    encoder = packing.Encoder(packing.Settings())
    pick = random.Random(6)
    signs = [c for c in map(chr, range(0x41, 0x100)) if c.isalpha() and c not in "ªµº"]
    for _ in range(300):
        text = " ".join("".join(pick.choices(signs, k=pick.randrange(1, 12))) for _ in range(10))
        assert encoder.encode([text.encode()], 2)[0].tolist() == ids_of(tokenizer, text), text


def test_odd_rows(odd, nothing, tokenizer):
    rows = packing.placed_pieces(odd).collect()
    check_sequences(rows)
    assert sum(r["start"] == 0 for r in rows) == odd.count()
    assert {(r["length"], r["doc_tokens"]) for r in rows if r["doc_id"] in (1, 2, 3)} == {(1, 1)}
    assert packing.placed_pieces(nothing).count() == 0


def test_pack_returns_ids(spark, tokenizer):
    texts = {1: "some words", 2: "word " * 9000, 3: None}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = packing.pack(frame).collect()
    check_sequences(rows)
    for i, text in texts.items():
        own = sorted((r["start"], bytes(r["ids"])) for r in rows if r["doc_id"] == i)
        assert np.frombuffer(b"".join(b for _, b in own), "<u4").tolist() == ids_of(tokenizer, text)


def test_recipe_uses_every_piece_once():
    settings = packing.Settings()
    pick = np.random.default_rng(0)
    for count in (1, 3, 50, 5_000):
        lengths = np.clip(np.exp(pick.normal(6.5, 1.2, count)).astype(int), 1, 4096)
        histogram = defaultdict(int)
        for n in lengths.tolist():
            histogram[int(packing.bin_of(n, settings))] += 1
        left = dict(histogram)
        for counts, repeats in packing.recipe(dict(histogram), settings):
            assert repeats > 0 and sum(b * n for b, n in counts) <= 4096
            for b, n in counts:
                left[b] -= n * repeats
        assert not any(left.values())


def test_least_squares_without_negatives():
    pick = np.random.default_rng(3)
    matrix, wanted = pick.random((12, 8)), np.maximum(pick.normal(size=8), 0)
    found = packing.nnls(matrix, matrix @ wanted)
    assert (found >= 0).all() and np.allclose(found, wanted, atol=1e-5)
