"""Language, quality and toxicity: held-out accuracy and odd input."""

from __future__ import annotations

import numpy as np
import pytest

from tidewire.llm import language_id, quality, toxicity
from tidewire.llm.queries import QUERIES


def test_language_of_held_out_documents(spark, larger):
    rows = QUERIES["op10_language_id"](spark, larger)
    assert rows.columns == ["doc_id", "held_out", "lang_pred", "score"]
    truth = spark.read.parquet(f"{larger}/documents.parquet").select("doc_id", "lang")
    both = rows.join(truth, "doc_id").where("held_out").collect()
    assert len(both) > 200
    assert np.mean([r["lang_pred"] == r["lang"] for r in both]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in both)


def test_language_of_odd_rows(spark, odd, nothing):
    model = language_id.train(odd.where("lang is not null"))
    assert set(model.dictionaries) == {"en", "de", "fr"}
    out = language_id.identify(odd, model)
    assert out.count() == odd.count() and out.columns.count("language_id") == 1
    found = {r["doc_id"]: r["language_id"] for r in out.collect()}
    for i in (1, 2, 3, 8):
        assert (found[i]["lang_pred"], found[i]["score"], found[i]["rejected"]) == ("und", 0.0, True)
    assert found[9]["lang_pred"] == "de" and not found[9]["rejected"]
    empty = language_id.train(nothing)
    assert empty.classify("some words") == ("und", 0.0, True)
    kept = language_id.identified_documents(odd)
    assert kept.columns == odd.columns
    assert language_id.identified_documents(nothing).count() == 0


def test_one_language_is_sure():
    model = language_id.Model({"en": b"the words of a text " * 10})
    assert model.classify("words") == ("en", 1.0, False)


@pytest.mark.parametrize(("name", "label", "least"), [("op1_quality", "quality", 0.95), ("op5_toxicity", "toxic", 0.9)])
def test_held_out_labels(spark, larger, name, label, least):
    rows = QUERIES[name](spark, larger)
    assert rows.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    assert rows.count() == 1000
    truth = spark.read.parquet(f"{larger}/labels.parquet")
    both = rows.join(truth, "doc_id").where("held_out").collect()
    good = [r["score"] for r in both if r[label] == 1]
    bad = [r["score"] for r in both if r[label] == 0]
    ranked = np.mean([[(g > b) + (g == b) / 2 for b in bad] for g in good])
    assert ranked > least
    limit = {"op1_quality": 0.3, "op5_toxicity": 0.7}[name]
    assert all(r["predicted"] == (r["score"] >= limit) for r in both)


@pytest.mark.parametrize("module", [quality, toxicity])
def test_classifiers_take_odd_rows(spark, odd, nothing, module):
    column = {quality: "quality_score", toxicity: "toxicity"}[module]
    labels = spark.createDataFrame([(4, 1, 0), (4, 0, 1), (9, 0, 0), (None, 1, 1), (10, None, None), (99, 1, 0)], "doc_id long, quality int, toxic int")
    for known in (labels, labels.limit(0)):
        model = module.train(odd, known)
        out = module.scored(odd.drop(column), model)
        assert out.count() == odd.count()
        assert all(0 <= r[column] <= 1 for r in out.collect())
        assert module.scored(nothing, model).count() == 0


def test_preferences_decide():
    pick = np.random.default_rng(0)
    rows = pick.normal(size=(400, 3))
    labels = (rows[:, 1] > -0.8).astype(int)
    model = quality.fit(rows, labels, float((labels == 0).mean()))
    assert ((model.score(rows) >= 0.3) == labels).mean() > 0.98


def test_sparse_weights():
    settings = toxicity.Settings(bits=12, least_rows=1, l1=2.0)
    hasher = toxicity.Hasher(settings)
    texts = [f"plain words number {'vile' if i % 2 else 'kind'} here" for i in range(200)]
    keys, values, count = hasher.sets(texts)
    ends = np.cumsum(count)
    rows = [(keys[e - c : e], values[e - c : e]) for e, c in zip(ends, count)]
    own = toxicity.train_shard(rows, np.arange(200) % 2, settings)
    at = np.flatnonzero(np.abs(own.z) > settings.l1)
    model = toxicity.average([(np.union1d(at, [len(own.z) - 1]), own.weights(np.union1d(at, [len(own.z) - 1])))], settings)
    assert len(model.at) < 20
    vile, kind, empty = model.score(hasher, ["vile words", "kind words", ""])
    assert vile > 0.7 > kind and 0 <= empty <= 1


def test_hashing_does_not_depend_on_company():
    hasher = toxicity.Hasher(toxicity.Settings(cached_words=3))
    one = hasher.sets(["a b c d e"])[0]
    both = hasher.sets(["a b c d e", "f g"])
    assert (both[0][: both[2][0]] == one).all()


def test_numerals_are_no_letters():
    model = language_id.Model({"de": b"ein Wort und noch ein Wort ", "en": b"a word and one more word "})
    for text in ("½ ² ³", "Ⅷ ⅷ", "́́", "①②", "_ - 12"):
        assert model.classify(text) == ("und", 0.0, True), text
    assert language_id.letters("10½kg Été² été x") == "kg été x"


def test_words_are_drawn_from_the_whole_text():
    words = [f"w{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyzabcd'[i // 100]}" for i in range(1000)]
    drawn = language_id.drawn_words(" ".join(words), 1000).decode().split()
    places = [words.index(w) for w in drawn]
    assert places == sorted(places) and 150 < len(drawn) <= 200 and places[0] < 100 and places[-1] > 900
    assert language_id.drawn_words("a b a", 100) == b"a b"


def test_language_sizes_are_those_of_plain_compression():
    """Every size against zstandard with a dictionary made here."""
    import zstandard

    raw = {"en": b"the words of a text and the next " * 9, "de": "die Wörter eines Textes und der nächste ".encode() * 9}
    model = language_id.Model(raw)
    for text in ("die Wörter eines Textes", "the next words " * 3, "Wort " * 50 + "x" * 4000):
        plain = language_id.letters(text)
        want = []
        for lang in sorted(raw):
            shared = zstandard.ZstdCompressionDict(raw[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            shared.precompute_compress(compression_params=zstandard.ZstdCompressionParameters(**language_id._PARAMETERS))
            own = zstandard.ZstdCompressor(dict_data=shared, write_content_size=False, write_checksum=False, write_dict_id=False)
            blocks = [plain[i : i + 2000] for i in range(0, len(plain), 2000)]
            want.append(sum(len(own.compress(b.encode() + b" " * 128)) for b in blocks))
        assert model.sizes(plain).tolist() == want
        best, other = sorted(want)
        assert model.classify(text) == (sorted(raw)[want.index(best)], (other - best) / other, (other - best) / other < 0.02)


def test_ftrl_is_that_of_a_plain_loop():
    """Weights against one coordinate at a time, over dicts."""
    settings = toxicity.Settings(bits=8, least_rows=1, epochs=1)
    pick = np.random.default_rng(4)
    rows = [(np.unique(pick.integers(0, 256, 6)), None) for _ in range(40)]
    rows = [(at, np.ones(len(at))) for at, _ in rows]
    labels = pick.integers(0, 2, 40)
    own = toxicity.train_shard(rows, labels, settings)
    rarer = min(max((40 - labels.sum()) / labels.sum(), 1.0), 50.0) ** 0.5
    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0)) <= settings.l1:
            return 0.0
        sign = 1 if z[i] > 0 else -1
        return (sign * settings.l1 - z[i]) / ((settings.beta + n[i] ** 0.5) / settings.alpha + settings.l2)

    for i in np.random.default_rng(7).permutation(40):
        at = [*rows[i][0].tolist(), 256]
        w = {a: weight(a) for a in at}
        p = 1 / (1 + np.exp(-sum(w.values())))
        g = (p - labels[i]) * (rarer if labels[i] else 1.0)
        for a in at:
            sigma = ((n.get(a, 0) + g * g) ** 0.5 - n.get(a, 0) ** 0.5) / settings.alpha
            z[a] = z.get(a, 0) + g - sigma * w[a]
            n[a] = n.get(a, 0) + g * g
    for a in range(257):
        assert own.z[a] == pytest.approx(z.get(a, 0)) and own.n[a] == pytest.approx(n.get(a, 0))


def test_preference_weights_are_a_minimum():
    """No step along any weight lowers the loss over all pairs."""
    pick = np.random.default_rng(6)
    good, bad = pick.normal(0.5, 1, (60, 4)), pick.normal(-0.5, 1, (30, 4))
    settings = quality.Settings()
    weights = quality.bradley_terry(good, bad, settings)
    turns = range(60 * settings.pairs_per_row)
    pairs = [good[t % 60] - bad[(t + t // 60 * 7919) % 30] for t in turns]

    def loss(w):
        return sum(np.log1p(np.exp(-(p @ w))) for p in pairs) / len(pairs) + settings.penalty * (w @ w) / 2

    for i in range(4):
        for step in (-1e-3, 1e-3):
            assert loss(weights + step * np.eye(4)[i]) > loss(weights)


def test_cut_is_the_quantile_of_all_labelled_rows(spark):
    pick = np.random.default_rng(8)
    values = np.round(pick.normal(size=700), 2)
    frame = spark.createDataFrame([(float(v),) for v in values], "raw double")
    ordered = np.sort(values)
    for share in (0.0, 0.1, 0.5, 0.999, 1.0):
        place = min(max(int(np.ceil(share * 700 - 1e-9)), 1), 699)
        low = ordered[place - 1]
        above = ordered[ordered > low]
        assert quality.quantile(frame, share, bins=8) == pytest.approx((low + above[0]) / 2 if len(above) else low)
    assert quality.quantile(frame.limit(0), 0.5) == 0.0
