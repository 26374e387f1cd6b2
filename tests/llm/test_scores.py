"""Quality, toxicity and language: held-out accuracy, exact neighbours, edge cases."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusforge.llm import language_profiles as L
from corpusforge.llm import pu_quality as Q
from corpusforge.llm import toxic_neighbours as X

WORDS = {"en": "the of and water house over under light".split(), "de": "der und nicht haus wasser über licht schön".split()}
EDGE = [(901, None), (902, ""), (903, " \n"), (904, "123 !?"), (905, "a" * 300_000), (906, "der"), (906, "der")]
COLUMNS = "doc_id long, text string, lang string, score double, held_out string, id int"


def prose(lang, n, rng, extra=()):
    words = [rng.choice(WORDS[lang]) + rng.choice(["", "", "s", "en"]) for _ in range(n)] + list(extra)
    rng.shuffle(words)
    return " ".join(words)


@pytest.fixture(scope="module")
def docs(spark):
    rng, rows = random.Random(3), []
    for i in range(240):
        lang = "de" if i % 3 == 0 else "en"
        extra = rng.sample(["idiotisch", "idiotin", "idiots", "idioten"], 2) if i % 5 == 0 else ()
        text = prose(lang, 40, rng, extra)
        if i % 4 == 0:
            text = " ".join(w.upper() + "!!" for w in text.split())
        rows.append((i, text, lang, 1.0, "x", 7))
    rows += [(i, t, None, None, None, None) for i, t in EDGE]
    return spark.createDataFrame(rows, COLUMNS).repartition(3)


def test_language(spark, docs):
    train = docs.filter("doc_id % 4 <> 2")
    profiles = L.learn_profiles(train, size=100)
    assert profiles.languages == ("de", "en")
    got = docs.select("doc_id", "lang", L.identify(docs, profiles).alias("f")).select("doc_id", "lang", "f.*").collect()
    assert all(r["lang_pred"] == r["lang"] for r in got if r["doc_id"] < 240)
    edge = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in got if r["doc_id"] > 900}
    assert all(edge[i] == ("und", 0.0) for i in (901, 902, 903, 904)) and edge[906][0] == "de"
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    none = L.learn_profiles(docs.limit(0))
    assert docs.select(L.identify(docs, none)["lang_pred"].alias("p")).distinct().collect()[0]["p"] == "und"


def brute_grams(text):
    clean = "".join(c if c.isalpha() else " " for c in text.lower())
    clean = " " + " ".join(clean.split()) + " "
    out = {}
    for n in (1, 2, 3):
        for i in range(len(clean) - n + 1):
            if clean[i:i + n] != " ":
                out[clean[i:i + n]] = out.get(clean[i:i + n], 0) + 1
    return out


@pytest.mark.parametrize("chunk", [7, 64, 1 << 18])
def test_grams_in_pieces(monkeypatch, chunk):
    monkeypatch.setattr(L, "CHUNK", chunk)
    text = "Über, die  Straße! und Ünd 12 x" * 9
    codes, counts = L.count_grams(text)
    spell = lambda c: "".join(chr(c >> s & 0x1FFFFF) for s in (0, 21, 42) if c >> s & 0x1FFFFF)
    assert {spell(int(c)): int(n) for c, n in zip(codes, counts, strict=True)} == brute_grams(text)


def test_rank_distance_equals_brute_force(docs):
    profiles = L.learn_profiles(docs, size=50)
    text = "Das Haus über dem Wasser und the light"
    grams = brute_grams(text)
    code = lambda g: sum(ord(c) << 21 * i for i, c in enumerate(g))
    top = sorted(grams, key=lambda g: (-grams[g], code(g)))[:50]
    ranks = [{int(c): int(r) for c, r in zip(profiles.codes, profiles.ranks[:, k], strict=True) if r >= 0} for k in range(2)]
    distance = [sum(abs(p[code(g)] - i) if code(g) in p else 50 for i, g in enumerate(top)) for p in ranks]
    lang, score = profiles.predict(text)
    assert lang == profiles.languages[int(np.argmin(distance))]
    assert score == pytest.approx((max(distance) - min(distance)) / max(distance))


def test_toxicity_held_out(spark, docs):
    labels = docs.filter("doc_id < 240").select("doc_id", (F.col("doc_id") % 5 == 0).cast("int").alias("toxic"), "id")
    model = X.learn(docs, labels.filter("doc_id % 4 <> 2"))
    got = docs.select("doc_id", X.toxicity(docs, model).alias("t")).select("doc_id", "t.*").collect()
    assert all((r["score"] >= 0.3) == (r["doc_id"] % 5 == 0) for r in got if r["doc_id"] < 240)
    rest = {r["doc_id"]: r["score"] for r in got if r["doc_id"] > 900}
    assert len(got) == docs.count() and rest[901] == rest[902] == rest[904] < 0.3
    toxic = next(r for r in got if r["doc_id"] == 0)
    assert toxic["neighbours"] and any(t.startswith("idi") for t in toxic["terms"])


def test_every_telling_term_is_known(spark):
    # More common terms of toxic texts than any bound on their number let through; all but 100 are as common in others.
    common, telling = [f"common{i}" for i in range(20_000)], [f"Zq{chr(97 + i // 10)}{chr(97 + i % 10)}x" for i in range(100)]
    letters = str.maketrans("0123456789", "abcdefghij")
    common = [w.translate(letters) for w in common]
    rows = [(i, " ".join(common + ["unlike" * (i % 3)]) + f" n{chr(97 + i % 26)}{chr(97 + i // 26)}", 0) for i in range(40)]
    rows += [(100 + i, " ".join(common + telling[i % 2::2]) + f" n{chr(97 + i % 26)}{chr(97 + i // 26)}", 1) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    found = X.learn(df, df).vocabulary.place
    assert {w.lower() for w in telling} <= found.keys() and not set(common) & found.keys()


def test_beginnings_of_three_letters():
    assert {"idi*", "idio*", "*iotin"} <= set(X.word_terms("idiotin")) and "*tin" not in X.word_terms("idiotin")


def test_toxicity_without_examples(docs, spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = X.learn(docs, none)
    assert docs.select(X.toxicity(docs, model)["score"].alias("s")).distinct().count() == 1
    empty = docs.limit(0)
    assert empty.select(X.toxicity(empty, X.learn(empty, none))["score"]).count() == 0


def test_block_search_is_exact():
    rng = np.random.default_rng(0)
    vectors = []
    for _ in range(400):
        places = np.sort(rng.choice(60, rng.integers(0, 6), replace=False))
        weights = rng.integers(1, 4, places.size).astype(float)
        vectors.append((places, weights / np.linalg.norm(weights) if places.size else weights))
    index = X.Index.build(vectors, [i % 2 for i in range(400)], range(400), 60)
    assert index.total.sum() == sum(p.size > 0 for p, _ in vectors)
    dense = np.zeros((index.total.size, 60))
    for k in range(index.total.size):
        span = slice(index.starts[k], index.starts[k + 1])
        dense[k, index.places[span]] = index.weights[span]
    for places, weights in vectors[:80]:
        entries, scores = index.nearest(places, weights, 9)
        all_scores = dense[:, places] @ weights
        want = np.sort(all_scores[all_scores > 1e-12])[::-1][:9]
        assert np.allclose(scores, want) and np.allclose(all_scores[entries], scores)


def test_postings_equal_the_blocks(monkeypatch):
    rng = np.random.default_rng(3)
    places = [np.sort(rng.choice(60, rng.integers(1, 12), replace=False)) for _ in range(3000)]
    weights = [rng.random(p.size) for p in places]
    vectors = [(p, w / np.linalg.norm(w)) for p, w in zip(places, weights, strict=True)]
    index = X.Index.build(vectors, [0] * 3000, range(3000), 60)
    got = [index.nearest(p, w) for p, w in vectors[:50]]
    monkeypatch.setattr(X, "SINGLY", 1 << 30)
    for (p, w), (entries, scores) in zip(vectors, got, strict=False):
        assert [x.tolist() for x in index.nearest(p, w)] == [entries.tolist(), scores.tolist()]


def test_calibration_is_monotone():
    steps, values = X.calibrate(np.array([.1, .2, .2, .5, .9, .9]), np.array([0, 1, 0, 0, 1, 1]))
    assert (np.diff(values) > 0).all() and (np.diff(steps) > 0).all() and 0 < values[0] < values[-1] < 1


def test_quality_held_out(docs):
    good = docs.filter("doc_id < 240 AND doc_id % 4 <> 0 AND doc_id % 5 <> 0").select("doc_id")
    network, prior = Q.learn(docs.filter("doc_id % 5 <> 0 AND doc_id < 240"), good)
    assert 0.5 < prior < 0.95
    got = docs.select("doc_id", Q.quality(docs, network, prior).alias("q")).collect()
    held = [r for r in got if r["doc_id"] % 5 == 0 and r["doc_id"] < 240]
    assert np.mean([(r["q"] >= 0.3) == (r["doc_id"] % 4 != 0) for r in held]) > 0.95
    assert len(got) == docs.count() and all(0 <= r["q"] <= 1 for r in got)


def test_quality_without_examples(docs):
    network, prior = Q.learn(docs, docs.limit(0).select("doc_id"))
    assert network is None and docs.select(Q.quality(docs, network, prior).alias("q")).distinct().first()["q"] == prior == 0.5


def test_risk_stays_useful_when_it_goes_negative():
    rng = np.random.default_rng(1)
    p = rng.normal(2, 1, (60, 4))
    u = np.concatenate([rng.normal(2, 1, (150, 4)), rng.normal(-2, 1, (150, 4))])
    net = Q.fit(p, u, 0.5, epochs=200)
    assert (net.probability(rng.normal(2, 1, (500, 4))) > 0.5).mean() > 0.95
    assert (net.probability(rng.normal(-2, 1, (500, 4))) < 0.5).mean() > 0.95
    assert abs(Q.estimate_prior(np.concatenate([p] * 20), np.concatenate([u] * 20)) - 0.5) < 0.1


def test_common_words_do_not_become_toxic_by_their_first_letters(spark):
    """The beginning of one toxic word is the beginning of many others."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice(["th", "er", "on", "an", "re", "he", "in", "ed"]) for _ in range(rng.randrange(1, 5)))
    texts = [" ".join(word() for _ in range(60)) + (" you idiot and moron" if i % 4 == 0 else "") for i in range(160)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int("idiot" in t)) for i, t in enumerate(texts)], "doc_id long, toxic int")
    model = X.learn(docs, labels)
    asked = spark.createDataFrame([(t,) for t in ("one more day", "the morning mortgage", "such an idiot", "one moron")], "text string")
    got = [r[0] for r in asked.select(X.toxicity(asked, model)["score"]).collect()]
    assert got[0] < 0.3 and got[1] < 0.3 and got[2] > 0.3 and got[3] > 0.3
