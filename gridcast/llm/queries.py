"""One query for each operator, with its production parameters, over the whole table it is meant for."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.llm import (
    chunk_dedup, decontaminate, hard_negatives, lm_score, packing, pii, prefix_trie, quality_crf, robust_rules, secret_scan, shingle_join, suffix_dedup, url_rules,
)

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    train = F.crc32(F.col("doc_id").cast("string")) % 7 != 2
    scored = lm_score.score_texts(table(spark, sf, "documents"), train)
    names = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), *names)


def op2_ngram_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return shingle_join.jaccard_components(table(spark, sf, "documents"))


def op3_suffix_array_dedup(spark: SparkSession, sf: str) -> DataFrame:
    kept = suffix_dedup.drop_repeated_strings(table(spark, sf, "documents"))
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return kept.select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                       F.sha2("kept", 256).alias("kept_sha256"))


def op4_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"), TOKENIZER)


def training_labels(labels: DataFrame) -> DataFrame:
    return labels.filter(F.crc32(F.col("doc_id").cast("string")) % 4 != 2)


def op5_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    field = quality_crf.train_quality(docs, training_labels(table(spark, sf, "labels")))
    scored = quality_crf.add_quality(docs.select("doc_id", "text"), field)
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op6_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return robust_rules.quality_rules(table(spark, sf, "documents"))


def op7_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, sf, "documents").select("doc_id", "text"))
    of = lambda i: lambda s: s["kind"] == i
    counts = [F.size(F.filter("secrets", of(i))).cast("long").alias(f"n_{k}") for i, k in enumerate(secret_scan.KINDS[:3])]
    base = F.filter("secrets", lambda s: s["kind"] < 3)
    text = secret_scan.as_text
    return found.select("doc_id", *counts, F.sha2(text(base), 256).alias("base_sha256"), text(F.col("secrets")).alias("spans"))


def op8_pii(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    found = pii.add_spans(docs.select("doc_id", "text"), pii.train_trees(docs))
    base = F.filter("pii", lambda s: s["score"].isNull())
    of = lambda i: lambda s: s["kind"] == i
    counts = [F.size(F.filter("base", of(i))).cast("long").alias(f"n_{k}") for i, k in enumerate(pii.KINDS)]
    found = found.select("doc_id", "pii", base.alias("base"))
    return found.select("doc_id", *counts, F.sha2(pii.as_text(F.col("base")), 256).alias("base_sha256"), pii.as_text(F.col("pii")).alias("spans"))


def op9_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    kept = chunk_dedup.drop_repeated_chunks(table(spark, sf, "documents"))
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    where = F.concat_ws(",", F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"])))
    size = F.size("spans").cast("long").alias("n_spans")
    return kept.select("doc_id", "n_bytes", gone.alias("n_removed"), size, F.sha2("text", 256).alias("kept_sha256"), where.alias("spans"))


def op10_benchmark_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.find_benchmark(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


# The seed rules by which pages are judged.
URL_SEEDS = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def op11_url_filters(spark: SparkSession, sf: str) -> DataFrame:
    return url_rules.judge_urls(table(spark, sf, "pages"), URL_SEEDS)


def op12_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine_hard_negatives(hard_negatives.integer_vectors(table(spark, sf, "embeddings"), moved), F.col("vec_id") % 50 == 0)


def rebuilt(encoded: DataFrame) -> DataFrame:
    """Each conversation c behind the first h turns of conversation c - c % 100, its own first h turns left out; h = crc32(c) % 6."""
    heads = encoded.filter("conv_id % 100 = 0").select(F.col("conv_id").alias("_base"), *[F.slice(c, 1, 5).alias(f"_{c}") for c in ("ids", "chars")])
    h = (F.crc32(F.col("conv_id").cast("string")) % 6).cast("int")
    placed = encoded.withColumn("_h", h).join(heads, F.col("conv_id") - F.col("conv_id") % 100 == F.col("_base"), "left")
    splice = lambda c: F.concat(F.coalesce(F.slice(f"_{c}", 1, F.col("_h")), F.array().cast("array<bigint>")), F.slice(c, F.col("_h") + 1, F.size(c) + 1)).alias(c)
    return placed.select("conv_id", splice("ids"), splice("chars"))


def op13_conversation_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    return prefix_trie.prefix_trie(rebuilt(prefix_trie.encode_turns(table(spark, sf, "conversations"))))


def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf)


QUERIES = {name: f for name, f in list(globals().items()) if name.startswith("op") and callable(f)} | {"pipeline": pipeline}

TRIE_SQL = """
WITH t AS (
  SELECT conv_id, turn, sha256(length(r) || ':' || r || x) AS k, length(x) AS chars
  FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL)),
c AS (
  SELECT conv_id, list(k ORDER BY turn NULLS FIRST, k) AS ks, list(chars ORDER BY turn NULLS FIRST, k) AS cs,
    xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
      lambda a, b: list_reduce(list_concat([xor(a, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
        lambda v, z: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END))), 4294967295::BIGINT) % 6 AS h
  FROM t GROUP BY conv_id),
r AS (
  SELECT c.conv_id, list_concat(coalesce(b.ks[1:c.h], []), c.ks[c.h + 1:]) AS ks, list_concat(coalesce(b.cs[1:c.h], []), c.cs[c.h + 1:]) AS cs
  FROM c LEFT JOIN c b ON b.conv_id = c.conv_id - c.conv_id % 100),
p AS (
  SELECT conv_id, d, md5(array_to_string(ks[1:d], ',')) AS node, CASE WHEN d > 0 THEN cs[d] ELSE 0 END AS chars, len(ks) = d AS ended
  FROM (SELECT *, unnest(range(0, len(ks) + 1)) AS d FROM r)),
n AS (
  SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs, min(chars) AS chars,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ended), '')) AS ends_sha256
  FROM p GROUP BY 1, 2),
u AS (SELECT n.*, q.node AS above FROM n LEFT JOIN p q ON q.conv_id = n.conv_id AND q.d = n.d - 1),
kids AS (SELECT above, count(*) AS n_children FROM u WHERE above IS NOT NULL GROUP BY 1),
below AS (
  SELECT a.node, count(*) FILTER (WHERE k.above IS NULL) AS n_leaves, sum((u.n_convs - 1) * u.chars) AS saved_tokens
  FROM u JOIN p a ON a.conv_id = u.conv_id AND a.d <= u.d LEFT JOIN kids k ON k.above = u.node GROUP BY 1)
SELECT u.conv_id, u.d::BIGINT AS depth, o.conv_id AS parent_conv_id, u.n_convs, coalesce(k.n_children, 0)::BIGINT AS n_children,
  b.n_leaves::BIGINT AS n_leaves, b.saved_tokens::BIGINT AS saved_tokens, u.ends_sha256
FROM u JOIN below b USING (node) LEFT JOIN kids k ON k.above = u.node LEFT JOIN n o ON o.node = u.above"""

URLS_SQL = r"""
WITH RECURSIVE seeds(verdict, rule, h, p) AS (VALUES ('block', 'net/', 'net', '/'), ('allow', 'example.net/en/', 'example.net', '/en/'),
  ('block', 'example.com/de/', 'example.com', '/de/'), ('allow', 'org/fr/', 'org', '/fr/')),
u AS (
  SELECT row_number() OVER () AS row, page_id, translate(regexp_extract(u, pat, 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(u, pat, 2) AS path, regexp_extract(u, pat, 3) AS query, regexp_extract(u, pat, 4) AS fragment
  FROM (SELECT page_id, coalesce(url, '') AS u, '(?s)^.*?://([^/?#]*)([^?#]*)([?][^#]*)?(#.*)?$' AS pat FROM pages)),
fit AS (
  SELECT u.row, s.* FROM u JOIN seeds s ON (u.host = s.h OR ends_with(u.host, '.' || s.h)) AND starts_with(u.path, s.p)
  QUALIFY row_number() OVER (PARTITION BY u.row ORDER BY length(s.rule) DESC) = 1),
parts AS (
  SELECT u.row, fit.rule, fit.verdict, string_split(host, '.') AS hs, query, fragment, path, substring(path, length(fit.p) + 1) AS rest
  FROM u LEFT JOIN fit USING (row)),
pieces AS (
  SELECT row, rule, verdict, list_transform(list_filter(hs, lambda x: x <> ''), lambda x: 'h:' || x) AS hs,
    list_transform(regexp_extract_all(translate(path, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), word, 1), lambda x: 'p:' || CASE WHEN regexp_matches(x, '^[0-9]+$') THEN '#' ELSE x END) AS ps,
    list_transform(regexp_extract_all(translate(rest, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), word, 1), lambda x: 'p:' || CASE WHEN regexp_matches(x, '^[0-9]+$') THEN '#' ELSE x END) AS rs,
    list_transform(regexp_extract_all(translate(query, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[?&]([^=&]+)', 1), lambda x: 'q:' || x) AS qs,
    list_transform(regexp_extract_all(translate(fragment, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), word, 1), lambda x: 'f:' || CASE WHEN regexp_matches(x, '^[0-9]+$') THEN '#' ELSE x END) AS fs
  FROM (SELECT *, '([^\x00-/:-@\[-`{-\x7f]+)' AS word FROM parts)),
single AS (
  SELECT DISTINCT row, verdict, unnest(list_concat(list_filter(hs, lambda x: x NOT IN ('h:net', 'h:example', 'h:com', 'h:org')), rs, qs, fs)) AS token
  FROM pieces WHERE rule IS NOT NULL),
total AS (SELECT count(*) AS n, greatest(1, ceil(count(*) * 0.01)) AS least FROM fit),
shares AS (SELECT verdict, count(*) AS n FROM fit GROUP BY 1),
rows_of AS (SELECT token, count(*) AS n, list(row ORDER BY row) AS rs FROM single GROUP BY 1),
items AS (
  SELECT min(token) AS token, list(token ORDER BY token) AS members, any_value(n) AS n
  FROM rows_of, (SELECT n AS total, least FROM total) WHERE n >= least AND n < total GROUP BY rs),
basket AS (SELECT row, verdict, token FROM single JOIN items USING (token)),
sets AS (
  SELECT row, verdict, [token] AS items, token AS last FROM basket
  UNION ALL
  SELECT * FROM (SELECT s.row, s.verdict, list_append(s.items, b.token) AS items, b.token AS last FROM sets s JOIN basket b ON b.row = s.row AND b.token > s.last)
  QUALIFY count(*) OVER (PARTITION BY items) >= (SELECT least FROM total)),
pairs AS (SELECT items, verdict, count(*) AS n_both FROM sets GROUP BY 1, 2),
rules AS (
  SELECT b.items, b.verdict, n_both, w.n FROM pairs b JOIN (SELECT items, count(*) AS n FROM sets GROUP BY 1) w USING (items) JOIN shares s ON s.verdict = b.verdict, total t
  WHERE n_both >= t.least AND n_both * 100 >= w.n * 90 AND n_both * t.n > w.n * s.n),
kept AS (
  SELECT * FROM rules r WHERE NOT EXISTS (
    SELECT 1 FROM rules l WHERE l.verdict = r.verdict AND len(l.items) = len(r.items) - 1 AND list_has_all(r.items, l.items) AND l.n_both * r.n >= r.n_both * l.n)),
needed AS (
  SELECT k.items, k.verdict, k.n, k.n_both, list_sort(flatten(list(i.members))) AS tokens
  FROM (SELECT *, unnest(items) AS token FROM kept) k JOIN items i USING (token) GROUP BY 1, 2, 3, 4),
best AS (
  SELECT p.row, n.verdict, n.n_both / n.n AS confidence, array_to_string(n.tokens, ' ') AS mined
  FROM pieces p JOIN needed n ON p.rule IS NULL AND list_has_all(list_concat(p.hs, p.ps, p.qs, p.fs), n.tokens)
  QUALIFY row_number() OVER (PARTITION BY p.row ORDER BY n.n_both / n.n DESC, len(n.items), n.n_both DESC, n.verdict DESC, array_to_string(n.tokens, ' ') DESC) = 1)
SELECT u.page_id, u.host, u.path, fit.rule, coalesce(fit.verdict, best.verdict, 'allow') AS verdict, best.confidence, best.mined
FROM u LEFT JOIN fit USING (row) LEFT JOIN best USING (row)"""

NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS a, v.vec_id AS x, a.label = v.label AS same, list_inner_product(a.q, v.q)::BIGINT AS score
  FROM v a JOIN v ON a.vec_id <> v.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, x) <= 5)
SELECT p.a AS anchor_id, p.x AS positive_id, row_number() OVER (PARTITION BY p.a, p.x ORDER BY s.score DESC, s.x)::INTEGER AS rank, s.x AS negative_id,
  p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.a = p.a AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score QUALIFY rank <= 3"""

SQL: dict[str, str] = {"op11_url_filters": URLS_SQL, "op12_hard_negatives": NEGATIVES_SQL, "op13_conversation_prefix_trie": TRIE_SQL}
