"""Line frequency, divergence of sources and whitening against brute force and edge cases."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import check
from corpusforge.llm import divergence_audit as D
from corpusforge.llm import line_frequency as L
from corpusforge.llm import whitening as W
from corpusforge.llm.queries import QUERIES, SQL

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", SQL)
def test_query_equals_sql(spark, name):
    verdict, _ = check.compare(spark, check.tables(SMALL), SMALL, name)
    assert verdict.startswith("same"), verdict


def test_every_query_runs_by_name():
    assert set(SQL) <= set(QUERIES)


# Line frequency

def slow_repeats(words):
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    return len({i + k for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for k in range(5)})


def test_repeated_words_equal_brute_force():
    rng = random.Random(3)
    for n in (0, 1, 4, 5, 6, 7, 30, 400):
        for letters in ("a", "ab", "abc", "abcdefghij"):
            words = [rng.choice(letters) for _ in range(n)]
            assert L.repeated_words(words) == slow_repeats(words)


@pytest.fixture(scope="module")
def ruled(spark):
    letters = lambda i: "".join(chr(97 + int(c)) for c in str(i))  # noqa: E731 - digits are alike, letters differ
    filler = lambda i: " ".join(f"{letters(i)}x{letters(k)}" for k in range(12))
    rows = [(i, f"{filler(i)}\nShare  this PAGE {i % 10} now\n\n", "a", i) for i in range(40)]
    rows += [(100 + i, "share this page 3 now\n" + " ".join("abcdefghi") + f" {letters(i)}x", "a", i) for i in range(30)]    # 5 of 15 words go
    rows += [(200 + i, "Share this page 1 now\n" * 6 + filler(i), "b", i) for i in range(5)]                         # another host
    rows += [(300, filler(9), "c", 0)] * 40                                                                     # copies count once
    rows += [(400, None, "a", 0), (401, "", None, 0), (None, "a b c d e f g h i j", "a", 0), (402, "# $ x|y <b>", "", 0)]
    rows += [(500, "a b c d e " * 50_000, "a", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, kept int")
    return df, [r.asDict() for r in L.judged(df).collect()]


def test_frequent_lines_are_counted_by_host(ruled):
    df, rows = ruled
    assert len(rows) == df.count()
    of = lambda a, b: [r for r in rows if r["doc"] is not None and a <= r["doc"] < b]
    assert all(r["kept"] and r["lost_words"] == 5 and len(r["removed"]) == 1 for r in of(0, 40))
    assert all(r["kept"] and r["lost_words"] == 5 for r in of(100, 130))  # ten of 15 words are left
    assert all(r["lost_words"] == 0 and r["n_dup_lines"] == 5 for r in of(200, 205))
    assert all(r["kept"] and r["lost_words"] == 0 for r in of(300, 301)) and len(of(300, 301)) == 40
    one = {r["doc"]: r for r in rows}
    assert one[400]["base_failed"] and one[401]["n_words"] == 0 and not one[401]["kept"] and one[None]["kept"]
    assert (one[402]["n_words"], one[402]["n_symbols"], one[402]["word_chars"]) == (4, 5, 8)
    assert one[500]["n_words"] == one[500]["n_repeat_words"] == 250_000 and one[500]["base_failed"]


def test_depleted_documents_go(spark):
    rows = [(i, "one two three four five six seven eight nine ten eleven\nown " + "x" * i + " a b c d e f g", "h") for i in range(25)]
    df = spark.createDataFrame(rows, "id long, body string, host string")
    got = L.judged(df, "id", "body", "host", min_words=3).collect()
    assert all(not r["base_failed"] and not r["kept"] and r["lost_words"] == 11 for r in got)
    assert all(r["kept"] for r in L.judged(df, "id", "body", "host", min_words=3, max_documents=25).collect())
    assert all(r["kept"] for r in L.judged(df, "id", "body", "host", min_words=3, max_share=1.0).collect())


def test_clean_gives_the_rest_of_the_text(ruled):
    df, rows = ruled
    done = L.clean(df)
    assert done.columns == df.columns
    texts = defaultdict(list)
    for r in done.collect():
        texts[r["doc_id"]].append(r["text"])
    assert texts[0] == [df.filter("doc_id = 0").first()["text"].split("\n")[0] + "\n\n"]
    assert texts[100] == ["a b c d e f g h i ax"] and len(texts[300]) == 40 and len(texts[None]) == 1 and 500 not in texts
    assert sum(map(len, texts.values())) == sum(r["kept"] for r in rows)


def test_no_rows_no_result(spark):
    none = spark.createDataFrame([], "doc_id long, text string, source string, lang string")
    assert L.judged(none).collect() == [] and L.clean(none).collect() == [] and D.audit(none).collect() == []
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    rows, fit = W.whiten(vectors)
    assert rows.collect() == [] and fit is None


# Divergence of sources

def slow_audit(rows, min_docs, top):
    terms = [(g or "", s or "", Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")))) for g, s, t in rows]
    out = set()
    for lang in {x[0] for x in terms}:
        seen = Counter(t for g, _, c in terms if g == lang for t in c)
        kept = {t for t, n in seen.items() if n >= min_docs}
        count = {s: Counter() for g, s, _ in terms if g == lang}
        for g, s, c in terms:
            if g == lang:
                count[s].update({t: n for t, n in c.items() if t in kept})
        whole = sum(count.values(), Counter())
        p = {s: {t: D.price(c[t], sum(c.values()), len(kept)) for t in kept} for s, c in count.items()}
        q = {t: D.price(whole[t], sum(whole.values()), len(kept)) for t in kept}
        for s in count:
            pairs = {o: sum(abs(p[s][t] - p[o][t]) for t in kept) for o in count if o != s}
            own = {t: p[s][t] - q[t] for t in kept if count[s][t] and p[s][t] > q[t]}
            for part, found, most in (("pair", pairs, None), ("term", own, top)):
                best = sorted(found.items(), key=lambda x: (-x[1], x[0].encode()))[:most]
                out |= {(lang, s, part, i, v, k + 1) for k, (i, v) in enumerate(best)}
    return out


@pytest.mark.parametrize("sizes", [(512, 64, 2048), (3, 2, 2)])
def test_audit_equals_brute_force(spark, monkeypatch, sizes):
    rng = random.Random(5)
    words = ["the", "The", "of", "Äpfel", "äpfel", "naïve", "x", "國家", "a1b", "z" * 300, *[f"w{c}" for c in "abcdefghijklmnop"]]
    rows = [(rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s3", "ß", None]), " ".join(rng.choices(words, range(len(words), 0, -1), k=rng.randrange(40))))
            for _ in range(150)]
    rows += [("en", "s9", None), ("xx", "s1", "rare words"), ("xx", "s2", ""), ("en", "s1", "the " * 30_000)] + [rows[0]] * 3
    for name, size in zip(("TERMS", "GROUPS", "COLUMNS"), sizes, strict=True):
        monkeypatch.setattr(D, name, size)
    df = spark.createDataFrame([(*r, "extra", 1) for r in rows], "lang string, source string, text string, item string, g int")
    got = [tuple(r) for r in D.audit(df, min_docs=4, top=5).collect()]
    wanted = slow_audit(rows, 4, 5)
    assert len(got) == len(set(got)) and set(got) == wanted
    assert ("xx", "s1", "pair", "s2", 0, 1) in wanted


def test_terms_are_letters_and_all_beyond_ascii():
    text = "The \tÄPFEL@naïve[x]`y{z~\x7f國家\u2003É\x00a1b_c"
    assert [t.decode() for t in D.terms_of(text.encode())] == ["the", "Äpfel", "naïve", "x", "y", "z", "國家\u2003É", "a", "b", "c"]


def test_joint_tables_count_terms():
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 4, (2, 30))
    at, place = np.tile(np.arange(30), 2), np.repeat(np.arange(2), 30)
    x = D.Indicator(30, at.tobytes(), place.tobytes(), counts.ravel().tobytes(), [50, 60], 30)
    (_, _, table), = x.joint(x)
    first = x.group == 0
    levels = [np.unique(c) for c in counts]
    for i, a in enumerate(levels[0]):
        for j, b in enumerate(levels[1]):
            assert table[np.ix_(first, ~first)][i, j] == ((counts[0] == a) & (counts[1] == b)).sum()


# Whitening

def test_whitening_equals_numpy(spark, monkeypatch):
    rng = np.random.default_rng(2)
    monkeypatch.setattr(W, "ROWS", 16)
    monkeypatch.setattr(W, "COLUMNS", 4)
    monkeypatch.setattr(W, "BLOCKS_A_PART", 2)
    data = (rng.normal(size=(150, 10)) @ np.diag(np.linspace(3, .1, 10))).astype(np.float32)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(data)]
    rows += [(500, None, 1), (501, [1.0, None], 1), (502, [float("nan")] * 10, 1), (503, [float("inf")] * 10, 1), (None, data[0].tolist(), 1), (0, data[0].tolist(), 1)]
    rows += [(600, [1.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, index int").repartition(5)
    done, fit = W.whiten(df, components=4)
    got = done.collect()
    full = [(i, [*v, *[0.0] * (10 - len(v))]) for i, v, _ in rows if i not in (500, 501, 502, 503)]
    x = np.floor(np.array([v for _, v in full], np.float32).astype(float) * 1024) + 100_000
    e, b = np.linalg.eigh(np.cov(x.T, bias=True))
    wanted = (x - x.mean(0)) @ b[:, ::-1][:, :4] / np.sqrt(e[::-1][:4])
    assert len(got) == len(full) and fit.n == len(full) and fit.identity_error < 1e-9
    assert np.allclose(fit.values, e[::-1][:4]) and np.isclose(fit.trace, e.sum())
    signs = np.sign((fit.vectors * b[:, ::-1][:, :4]).sum(0))
    exact, sums = x.astype(int).astype(object), x.astype(int).sum(0)
    deviation = ((len(x) * exact - sums) ** 2).sum(1)
    mine = sorted((str(r["vec_id"]), int(r["deviation"]), np.round(np.array(r["whitened"]) * signs, 6).tolist()) for r in got)
    theirs = sorted((str(i), int(d), np.round(w, 6).tolist()) for (i, _), d, w in zip(full, deviation, wanted, strict=True))
    assert [m[:2] for m in mine] == [t[:2] for t in theirs]
    assert np.allclose([m[2] for m in mine], [t[2] for t in theirs], atol=1e-5)


@pytest.mark.parametrize("vectors", [[[1.0, 2.0]], [[1.0, 2.0]] * 3, [[]], [[], []]])
def test_vectors_without_spread_have_no_component(spark, vectors):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = W.whiten(df)[0].collect()
    assert len(got) == len(vectors) and all(r["whitened"] == [] and r["deviation"] == 0 for r in got)


def test_flat_directions_are_left_out(spark):
    df = spark.createDataFrame([(i, [float(i), 5.0, float(2 * i)]) for i in range(9)], "vec_id long, embedding array<double>")
    done, fit = W.whiten(df)
    assert fit.values.size == 1 and all(len(r["whitened"]) == 1 for r in done.collect())
