"""Pieces against the library, round trips, spans; packing against its contract."""

import random
import struct
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpusforge.llm import piece_encoding as E
from corpusforge.llm import tier_packing as T

MODEL = P.path("piece_bpe_32k.model")
TEXTS = ["", " ", "  a", "a  b ", "a\n b", "▁", "a▁ b", "é你好😀", "\x00a", "<s> </s> <unk> <0x0A>", "a " * 300, "x" * 400, "\t t", "Ünïcode, text.",
         "plain words with commas, and stops. And\nlines"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([*"ab ▁\n", "the", " of", "  ", "é", "你", "😀", "<s>", "ing"]), max_size=40).map("".join))
def test_pieces_equal_the_library(library, text):
    check(library, text)


def check(library, text):
    ids, spans = E.load(MODEL).encode(text)
    assert np.frombuffer(ids, np.uint32).tolist() == library.encode(text, add_bos=True, add_eos=True)
    assert E.load(MODEL).decode(ids) == library.decode(np.frombuffer(ids, np.uint32).tolist())
    data = text.encode()
    assert b"".join(data[a:b] for a, b in np.frombuffer(spans, np.uint32).reshape(-1, 2)) == data


def test_columns(spark, library):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate([*TEXTS, None, TEXTS[-1]])], "doc_id int, text string, ids string")
    done = df.select("doc_id", "text", E.encode(df, MODEL).alias("e"))
    rows = done.select("text", "e.ids", E.decode(F.col("e.ids"), MODEL).alias("back")).collect()
    for r in rows:
        assert np.frombuffer(r["ids"], np.uint32).tolist() == library.encode(r["text"] or "", add_bos=True, add_eos=True)
        assert r["back"] == (r["text"] or "").replace("▁", " ")
    assert len(rows) == len(TEXTS) + 2 and df.limit(0).select(E.encode(df.limit(0), MODEL)).count() == 0
    for text in TEXTS:
        check(library, text)


def compiled(pairs):
    """A character map as a double array, laid out by first fit."""
    texts, at = b"", {}
    for key, new in pairs.items():
        at[key.encode()] = len(texts)
        texts += new.encode() + b"\0"
    units, used, bases = {0: 0}, {0}, set()

    def place(node, prefix):
        below = sorted({k[len(prefix)] for k in at if k.startswith(prefix) and len(k) > len(prefix)})
        labels = ([0] if prefix in at else []) + below
        base = next(b for b in range(1, 1 << 16) if b not in bases and all((b ^ c) not in used for c in labels))
        bases.add(base)
        used.update(base ^ c for c in labels)
        units[node] = units.get(node, 0) | (node ^ base) << 10 | (1 << 8 if prefix in at else 0)
        for c in labels:
            if c == 0:
                units[base] = 1 << 31 | at[prefix]
            else:
                units[base ^ c] = c
        for c in below:
            place(base ^ c, prefix + bytes([c]))

    place(0, b"")
    array = [units.get(i, 1 << 31) for i in range(max(units) + 256)]
    return struct.pack(f"<I{len(array)}I", 4 * len(array), *array) + texts


def test_longest_prefix_of_the_character_map():
    pairs = {"ﬁ": "fi", "Ａ": "A", "ab": "X", "abc": "YZ", "é": "e"}
    table = E.CharacterMap(compiled(pairs))
    assert table.longest("abcd".encode(), 0) == (3, b"YZ") and table.longest(b"abd", 0) == (2, b"X")
    assert table.longest(b"ba", 0) is None and table.longest("ﬁx".encode(), 0) == (3, b"fi")
    assert E.CharacterMap(b"").longest(b"a", 0) is None


def test_spans_through_a_character_map():
    model = E.PieceModel(open(MODEL, "rb").read())
    model.map, model.plain = E.CharacterMap(compiled({"ﬁ": "fi", "abc": "z"})), False
    text = "ﬁt abc"
    normal, align = model.normalise(text)
    assert normal == "▁fit▁z" and align.tolist() == [0, 0, 0, 0, 0, 3, 4, 4, 4, 5, 8]
    ids, spans = model.encode(text)
    pairs = np.frombuffer(spans, np.uint32).reshape(-1, 2)
    assert pairs[-2][1] == len(text.encode()) and model.decode(ids) == "fit z"


@given(st.lists(st.integers(1, 2048), max_size=120))
@settings(max_examples=60, deadline=None)
def test_windows_hold_their_pieces(lengths):
    lengths = np.array(lengths, np.int64)
    number, offset, tier = T.pack_lengths(lengths, [256, 512, 1024, 2048])
    used = np.bincount(number, lengths).astype(int) if lengths.size else []
    for w, n in enumerate(used):
        spans = sorted((offset[k], lengths[k]) for k in np.flatnonzero(number == w))
        assert n <= 2048 and [a for a, _ in spans] == [0, *np.cumsum([m for _, m in spans])[:-1]]
        assert tier[number == w][0] == (n if n in (256, 512, 1024) else 2048)


def test_packing(spark):
    rng = random.Random(0)
    texts = [" ".join(rng.choice(["alpha", "beta,", "gamma", "delta\n", "é"]) for _ in range(rng.randrange(0, 900))) for _ in range(60)]
    texts += ["", " ", "a  b", "x <|endoftext|> y", "\n\n a", "word " * 9000, "tab\tx y", "end "]
    df = spark.createDataFrame([(i, t, 5) for i, t in enumerate(texts)] + [(98, None, 1), (99, "same", 1), (99, "same", 1), (None, "no id", 1)],
                               "doc_id long, text string, length int")
    done = T.pack(df, P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN, per_shard=50)
    rows = done.toPandas()
    whole = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    for i, text in enumerate(texts):
        ids = np.array(whole.encode(text, add_special_tokens=False).ids + [1], "<u4")
        own = rows[rows.doc_id == i].sort_values("start")
        assert own.length.sum() == ids.size and (own.doc_tokens == ids.size).all()
        assert [zlib.crc32(ids[a:a + n].tobytes()) for a, n in zip(own.start, own.length, strict=True)] == own.ids_crc32.tolist()
    assert (rows[rows.doc_id == 99].length == 2).all() and len(rows[rows.doc_id == 99]) == 2 and rows.doc_id.isna().sum() == 1
    ordered = rows.sort_values(["sequence_id", "offset"])
    ends = ordered.groupby("sequence_id").length.cumsum()
    assert (ends - ordered.length == ordered.offset).all() and ends.max() <= 2048
    assert T.pack(df.limit(0), P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN).count() == 0


def test_tiers_are_packed_one_by_one():
    tiers = [256, 512, 1024, 2048]
    number, _, tier = T.pack_lengths(np.array([200, 56, 200, 56, 1500, 300, 212, 548]), tiers)
    windows = {tuple(sorted(np.flatnonzero(number == w))): tier[number == w][0] for w in set(number)}
    assert windows == {(4, 7): 2048, (5, 6): 512, (0, 1): 256, (2, 3): 256}
    number, _, tier = T.pack_lengths(np.array([700, 700, 600, 20]), tiers)
    assert set(number) == {0} and set(tier) == {2048}
    lengths = np.random.default_rng(0).integers(1, 2049, 30_000)
    number, _, tier = T.pack_lengths(lengths, tiers)
    sizes = np.zeros(number.max() + 1)
    sizes[number] = tier
    assert sizes.sum() / lengths.sum() < 1.01
    step = T.tier_steps(np.bincount(number, lengths.astype(float) ** 2), sizes, 64)
    assert all(len(set(sizes[step == k])) == 1 for k in set(step))


def test_ids_are_delivered(spark):
    df = spark.createDataFrame([(i, "some words " * n) for i, n in enumerate([0, 3, 90, 300, 1500, 5000])], "doc_id long, text string")
    packed = T.pack(df, P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN).persist()
    whole, rows = Tokenizer.from_file(P.path("byte_bpe_50k.json")), packed.toPandas()
    made = {r["sequence_id"]: np.frombuffer(r["ids"], "<u4") for r in T.sequences(packed, 7).collect()}
    for i, text in map(tuple, df.collect()):
        own = rows[rows.doc_id == i].sort_values("start")
        want = whole.encode(text, add_special_tokens=False).ids + [1]
        assert np.frombuffer(b"".join(own.ids), "<u4").tolist() == want
        got = [made[s][a:a + n] for s, a, n in zip(own.sequence_id, own.offset, own.length, strict=True)]
        assert np.concatenate(got).tolist() == want
    for w, group in rows.groupby("sequence_id"):
        assert made[w].size == group.tier.iloc[0] and (made[w][group.length.sum():] == 7).all()


def test_steps_are_balanced():
    cost = np.random.default_rng(0).integers(1, 1000, 640).astype(float)
    step = T.balanced_steps(cost, 64)
    totals = np.bincount(step, cost)
    assert (np.bincount(step) == 64).all() and totals.max() / totals.min() < 1.02
