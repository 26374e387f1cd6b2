"""The registered queries keep their contracts; the pipeline equals its parts done by hand."""

import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from corpusforge.llm import stages
from corpusforge.llm.queries import QUERIES
from test_pairs import brute

SMALL = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_pu_quality": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op2_inner_products": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"},
    "op3_language_profiles": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op4_piece_encoding": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op5_lsh_forest": {"doc_id": "bigint", "class_id": "bigint", "links": "bigint", "copies": "bigint"},
    "op6_tier_packing": {"doc_id": "bigint", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "doc_tokens": "bigint",
                         "sequence_id": "bigint", "offset": "bigint"},
    "op7_toxic_neighbours": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op8_pii_surrogates": {"doc_id": "bigint", "text": "string"},
    "op9_license_scan": {"doc_id": "bigint", "licence": "string", "origin": "string", "score": "double"},
    "op10_spot_signatures": {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string",
                             "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"},
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_contract(spark, name):
    df = QUERIES[name](spark, SMALL)
    assert COLUMNS[name].items() <= dict(df.dtypes).items()
    rows = df.toPandas()
    if name not in ("op2_inner_products", "op6_tier_packing"):
        documents = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id").toPandas().doc_id
        assert sorted(rows.doc_id) == sorted(documents)
    if "held_out" in rows:
        folds, wanted = (5, 0) if name.startswith("op1") else (4, 2)
        assert [zlib.crc32(str(i).encode()) % folds == wanted for i in rows.doc_id] == rows.held_out.tolist()
        assert rows.score.between(0, 1).all()
    if "predicted" in rows:
        assert ((rows.score >= 0.3) == (rows.predicted == 1)).all()


def test_pipeline(spark, tmp_path):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice(["th", "er", "on", "an", "re", "he", "in", "ed"]) for _ in range(rng.randrange(1, 5)))
    prose = lambda: " ".join(word() for _ in range(60))
    texts = [prose() + (" you idiot and moron" if i % 4 == 0 else "") for i in range(160)]
    texts += [t + " more" for t in texts[1:20] if "idiot" not in t] + [texts[1]] * 5 + ["12 34", "", None]
    texts.append("write to jo.doe@mail.example.com or 10.1.2.3 " + prose())
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, columns).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, int("idiot" in t)) for i, t in enumerate(texts[:160])]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")

    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, str(tmp_path)), name)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    clean = {i: t for i, t in enumerate(texts) if "idiot" not in (t or "")}
    assert set(kept["toxicity"]) ^ set(clean) == set()
    assert kept["toxicity"] == clean
    lettered = {i: t for i, t in clean.items() if any(c.isalpha() for c in t or "")}
    assert kept["language"] == lettered
    assert set(kept["near_duplicates"]) == {c for _, c, _, _ in brute(list(lettered.items()))}
    private = len(texts) - 1
    assert {i for i, t in kept["surrogates"].items() if t != texts[i]} == {private}
    assert "jo.doe" not in kept["surrogates"][private] and "10.1.2.3" not in kept["surrogates"][private]

    pieces = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    whole = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    assert set(pieces.doc_id) == set(kept["surrogates"])
    for i, text in kept["surrogates"].items():
        ids = np.array(whole.encode(text, add_special_tokens=False).ids + [1], "<u4")
        own = pieces[pieces.doc_id == i].sort_values("start")
        assert [zlib.crc32(ids[a:a + n].tobytes()) for a, n in zip(own.start, own.length, strict=True)] == own.ids_crc32.tolist()
        assert own.length.sum() == ids.size


def test_texts_stay_where_no_language_is_taught(spark):
    docs = spark.createDataFrame([(1, "some text", None), (3, "more text", None)], "doc_id long, text string, lang string")
    assert stages.drop_undetermined(spark, docs, "").count() == 2
