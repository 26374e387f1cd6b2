"""The registered queries of this package, each over its whole table.

`QUERIES` maps a name to a function of (spark, folder); `SQL` has DuckDB
statements where SQL can express a query.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusforge.llm import (divergence_audit, inner_products, language_profiles, license_scan, line_frequency, lsh_forest, pii_surrogates, piece_encoding,
                             pu_quality, spot_signatures, stages, tier_packing, toxic_neighbours, whitening)
from corpusforge.llm.common import fold, read


def op1_pu_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    held_out = F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False))
    good = read(spark, folder, "labels").filter((F.col("quality") == 1) & ~held_out).select("doc_id")
    network, prior = pu_quality.learn(docs.filter(~held_out), good)
    scored = docs.select("doc_id", held_out.alias("held_out"), pu_quality.quality(docs, network, prior).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op2_inner_products(spark: SparkSession, folder: str) -> DataFrame:
    return inner_products.top_k(read(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_language_profiles(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False))
    profiles = language_profiles.learn_profiles(docs.filter(~held_out))
    return docs.select("doc_id", held_out.alias("held_out"),
                       language_profiles.identify(docs, profiles).alias("found")).select("doc_id", "held_out", "found.*")


def op4_piece_encoding(spark: SparkSession, folder: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    docs = read(spark, folder, "documents").select("doc_id", "text")
    done = docs.select("doc_id", piece_encoding.encode(docs, model).alias("code"))
    done = done.select("doc_id", "code.ids", "code.spans", piece_encoding.decode(F.col("code.ids"), model).alias("decoded"))
    return done.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"), F.sha2("spans", 256).alias("spans_sha256"))


def op5_lsh_forest(spark: SparkSession, folder: str) -> DataFrame:
    found = lsh_forest.near_duplicates(read(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "class_id", "links", "copies")


def op6_tier_packing(spark: SparkSession, folder: str) -> DataFrame:
    packed = stages.pack(spark, read(spark, folder, "documents").select("doc_id", "text"), folder)
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op7_toxic_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    held_out = F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False))
    model = toxic_neighbours.learn(docs, read(spark, folder, "labels").filter(~held_out))
    scored = docs.select("doc_id", held_out.alias("held_out"), toxic_neighbours.toxicity(docs, model).alias("found"))
    return scored.select("doc_id", "held_out", "found.score", (F.col("found.score") >= 0.3).cast("int").alias("predicted"),
                         "found.neighbours", "found.terms")


def op8_pii_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    done = pii_surrogates.replace_private(docs, stages.SURROGATE_KEY, report="kinds")
    return done.select("doc_id", "text", F.array_join(F.array_sort("kinds"), ",").alias("kinds"))


def op9_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    # A document is a file of its source's and language's directory.
    path = F.concat_ws("/", F.coalesce("source", F.lit("-")), F.coalesce("lang", F.lit("-")), F.col("doc_id").cast("string"))
    docs = read(spark, folder, "documents").select("doc_id", path.alias("path"), "text")
    return license_scan.scan(docs)


def op10_spot_signatures(spark: SparkSession, folder: str) -> DataFrame:
    return spot_signatures.fingerprints(read(spark, folder, "documents").select("doc_id", "text"))


def op11_line_frequency(spark: SparkSession, folder: str) -> DataFrame:
    # The table has no host but a source.
    done = line_frequency.judged(read(spark, folder, "documents").select("doc_id", "text", "source"))
    return done.select(F.col("doc").alias("doc_id"), *line_frequency.COUNTS, "base_failed", "kept", "lost_words")


def op12_divergence_audit(spark: SparkSession, folder: str) -> DataFrame:
    return divergence_audit.audit(read(spark, folder, "documents").select("text", "lang", "source"))


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    rows, fit = whitening.whiten(read(spark, folder, "embeddings").select("vec_id", "embedding"))
    explained = F.lit([float(e) / fit.trace for e in fit.values] if fit else []).cast("array<double>")
    each = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return each.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(fit.n if fit else 0).cast("long").alias("n"),
                       F.col("deviation").cast("long").alias("deviation"), "whitened", F.get(explained, F.col("at")).alias("explained"),
                       F.lit(fit.identity_error if fit else 0.0).alias("identity_error"))


QUERIES = {f.__name__: f for f in (op1_pu_quality, op2_inner_products, op7_toxic_neighbours, op3_language_profiles, op4_piece_encoding, op5_lsh_forest, op6_tier_packing,
                                  op8_pii_surrogates, op9_license_scan, op10_spot_signatures, op11_line_frequency, op12_divergence_audit,
                                  op13_whitening)}
_VECTORS = ("v AS (SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: floor(64 * x::double)) AS e "
            "FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL "
            "AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)")
_SHINGLES = ("w AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+') AS w FROM documents), "
             "s AS (SELECT doc_id, list_sort(list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1), "
             "lambda i: array_to_string(w[i:i + 4], ' ')))) AS s FROM w WHERE len(w) > 0)")
SQL: dict[str, str] = {
    "op2_inner_products": f"WITH {_VECTORS}, p AS (SELECT q.vec_id AS query_id, q.r, c.vec_id, list_inner_product(q.e, c.e)::bigint AS score "
                          "FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 20 = 0), k AS (SELECT *, row_number() OVER "
                          "(PARTITION BY r ORDER BY score DESC, vec_id) AS n FROM p) SELECT query_id, n::int AS rank, vec_id, score FROM k WHERE n <= 20",
    "op5_lsh_forest": f"WITH RECURSIVE {_SHINGLES}, e AS (SELECT s, min(doc_id) AS e, count(*) AS copies FROM s GROUP BY s), "
                      "g AS (SELECT e, len(s) AS n, unnest(s) AS g FROM e), p AS (SELECT a.e AS a, b.e AS b FROM g a JOIN g b USING (g) "
                      "WHERE a.e <> b.e GROUP BY a.e, b.e, a.n, b.n HAVING count(*) >= 0.8::double * (a.n + b.n - count(*))), "
                      "r AS (SELECT e AS node, e AS label FROM e UNION SELECT p.b, r.label FROM r JOIN p ON p.a = r.node), "
                      "c AS (SELECT node, min(label) AS class_id FROM r GROUP BY node), l AS (SELECT a, count(*) AS links FROM p GROUP BY a) "
                      "SELECT doc_id, class_id, coalesce(links, 0) AS links, copies FROM s JOIN e USING (s) JOIN c ON node = e LEFT JOIN l ON a = e "
                      "UNION ALL SELECT doc_id, doc_id, 0, 1 FROM w WHERE coalesce(len(w), 0) = 0",
    "op11_line_frequency": r"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents),
l AS (SELECT r, host, generate_subscripts(string_split(text, chr(10)), 1) AS i, unnest(string_split(text, chr(10))) AS line FROM d),
m AS (SELECT r, host, i, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w FROM l),
n AS (SELECT r, host, i, line, w, regexp_replace(lower(array_to_string(w, ' ')), '[1-9]', '0', 'g') AS norm FROM m WHERE len(w) > 0),
c AS (SELECT r, string_agg(norm, chr(10) ORDER BY i) AS content FROM n GROUP BY r),
h AS (SELECT host, count(DISTINCT coalesce(content, '')) AS different FROM d LEFT JOIN c USING (r) GROUP BY host),
o AS (SELECT host, norm FROM n JOIN c USING (r) JOIN h USING (host) GROUP BY host, norm, different
 HAVING count(DISTINCT content) > 20 AND count(DISTINCT content) > 0.002::double * different),
x AS (SELECT r, sum(len(w)) AS lost FROM n SEMI JOIN o USING (host, norm) GROUP BY r),
b AS (SELECT r, sum(len(w)) AS n_words, count(*) - count(DISTINCT line) AS n_dup_lines FROM n GROUP BY r),
k AS (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM d),
v AS (SELECT r, unnest(range(1, len(w) - 3)) AS i, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS five FROM k WHERE len(w) >= 5),
t AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, five) AS n FROM v) WHERE n > 1),
u AS (SELECT r, count(DISTINCT j) AS n_repeat_words FROM (SELECT r, unnest(range(i, i + 5)) AS j FROM t) GROUP BY r),
f AS (SELECT doc_id, coalesce(n_words, 0)::bigint AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
 length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
 coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(lost, 0)::bigint AS lost_words
 FROM d LEFT JOIN b USING (r) LEFT JOIN u USING (r) LEFT JOIN x USING (r)),
g AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f)
SELECT *, NOT base_failed AND n_words - lost_words >= 10 AND n_words - lost_words >= 0.5::double * n_words AS kept FROM g""",
    "op12_divergence_audit": r"""WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
t AS (SELECT r, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
 '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS total FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
v AS (SELECT lang, count(*) AS v, sum(total) AS n FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
e AS (SELECT t.lang, t.source, t.term, count(*) AS c FROM t JOIN k USING (lang, term) GROUP BY ALL),
n AS (SELECT lang, source, coalesce(sum(c), 0) AS n FROM g LEFT JOIN e USING (lang, source) GROUP BY ALL),
p AS (SELECT n.lang, n.source, k.term, coalesce(c, 0) AS c, 1 + 1000000000::hugeint * (coalesce(c, 0) + 5) // (n.n + 5 * v.v) AS p,
 1 + 1000000000::hugeint * (k.total + 5) // (v.n + 5 * v.v) AS q
 FROM n JOIN v USING (lang) JOIN k USING (lang) LEFT JOIN e ON e.lang = n.lang AND e.source = n.source AND e.term = k.term),
s AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
x AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::bigint AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
 LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
 UNION ALL SELECT lang, source, 'term', term, (p - q)::bigint FROM p WHERE c > 0 AND p > q)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::int AS rank FROM x) WHERE part = 'pair' OR rank <= 50""",
}
