"""The dealt operators on their whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from legwise.llm import (
    centroid_clustering, combination_join, fill_in_middle, hilbert_shards, marginal_unigrams, neighbour_vote, piece_counts, pu_toxicity,
    rule_cascade, string_tiling, tier_packing, tree_extract, warc,
)
from legwise.llm.registry import ORACLE, QUERIES, query, table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: Vocabulary of the language model.
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

__all__ = ["ORACLE", "QUERIES"]

def remainder(divisor: int) -> Column:
    """crc32 of the id as text, modulo the number of folds."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(divisor))


@query("op1_neighbour_vote")
def op1_neighbour_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), remainder(5) == 0
    space = neighbour_vote.fit(docs, table(spark, sf_dir, "labels"), ~held_out)
    return neighbour_vote.score(docs, space).select("doc_id", held_out.alias("held_out"), "score", "predicted")


#: Measures and verdict of op2 over a relation ``src(doc_id, text)``; {src} is its SELECT.
RULES_SQL = r"""
src AS ({src}),
body AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM src),
split AS (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
                 list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM body),
windows AS (SELECT r, unnest(range(1, len(w) - 1)) AS i, w FROM split),
grams AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM windows),
twice AS (SELECT r, g FROM grams GROUP BY r, g HAVING count(*) > 1),
covered AS (SELECT DISTINCT r, i + unnest([0, 1, 2]) AS p FROM grams JOIN twice USING (r, g)),
repeats AS (SELECT r, count(*) AS n FROM covered GROUP BY r),
measures AS (
  SELECT doc_id, text, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, len(l) AS n_lines,
         CAST(coalesce(repeats.n, 0) AS BIGINT) AS n_repeat_words
  FROM body JOIN split USING (r) LEFT JOIN repeats USING (r)),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         100 * n_symbols > 5 * word_chars OR 10 * n_dup_lines > 3 * n_lines
         OR word_chars < 2 * n_words OR word_chars > 15 * n_words
         OR 100 * length(regexp_replace(text, '\P{Lu}+', '', 'g')) > 40 * word_chars
         OR 100 * length(regexp_replace(text, '\P{L}+', '', 'g')) < 60 * word_chars
         OR 100 * length(regexp_replace(text, '[^!?]+', '', 'g')) > 10 * word_chars AS broken
  FROM measures)"""


@query(
    "op2_rule_cascade",
    "WITH " + RULES_SQL.replace("{src}", "SELECT doc_id, text FROM documents")
    + " SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,"
    " NOT (base_failed OR broken) AS kept FROM judged",
)
def op2_rule_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_cascade.judge(table(spark, sf_dir, "documents"))


@query("op3_tier_packing")
def op3_tier_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = tier_packing.pack(table(spark, sf_dir, "documents"), TOKENIZER)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query("op9_pu_toxicity")
def op9_pu_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), remainder(3) == 1
    model = pu_toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held_out)
    return pu_toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query("op10_piece_counts")
def op10_piece_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_counts.count_tokens(table(spark, sf_dir, "documents"), TOKENIZER)


@query("op4_string_tiling")
def op4_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return string_tiling.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "item_id", "item_words", "covered_words", "coverage", F.size("tiles").cast("bigint").alias("n_tiles")
    )


@query("op5_combination_join")
def op5_combination_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return combination_join.group(table(spark, sf_dir, "documents"))


@query("op6_hilbert_shards")
def op6_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = hilbert_shards.write_shards(table(spark, sf_dir, "documents"), hilbert_shards.new_folder(spark))
    text = F.coalesce("text", F.lit(""))
    return written.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query(
    "op7_warc",
    """
WITH pages_ AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(encode(coalesce(html, ''))) AS digest FROM pages),
sized AS (SELECT page_id, payload, digest, octet_length(payload) AS payload_bytes FROM pages_),
kept AS (SELECT *, max(page_id) OVER (PARTITION BY digest) AS response FROM sized),
bits AS (SELECT *, list_transform(range(1, 41), lambda i: lpad(bin(('0x' || digest[i])::INTEGER), 4, '0')) AS b FROM kept)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda k:
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + list_sum(list_transform(range(0, 5), lambda j:
           array_to_string(b, '')[5 * k + j + 1]::INTEGER * (16 >> j::INTEGER)))::INTEGER]), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> response THEN response END AS refers_to
FROM bits""",
)
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.new_folder(spark)
    files = warc.write(table(spark, sf_dir, "pages"), folder)
    return warc.read(files, folder).select(
        warc.record_number("record_id").cast("bigint").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.record_number("refers_to").cast("bigint").alias("refers_to"),
    )


@query("op8_tree_extract")
def op8_tree_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree_extract.extract(table(spark, sf_dir, "pages"))


@query("op11_marginal_unigrams")
def op11_marginal_unigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), remainder(4) == 2
    model = marginal_unigrams.fit(docs, ~held_out, RANKS)
    return marginal_unigrams.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query(
    "op12_fill_in_middle",
    """
WITH given AS (
  SELECT doc_id, coalesce(text, '') AS t, CAST(length(coalesce(text, '')) AS BIGINT) AS n,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
drawn AS (
  SELECT doc_id, t, n, ('0x' || substr(h, 1, 8))::BIGINT % (n + 1) AS x, ('0x' || substr(h, 9, 8))::BIGINT % (n + 1) AS y,
         CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                   OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 90 THEN 'plain'
              WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM given),
cut AS (
  SELECT doc_id, t, n, form, least(x, y) AS a, greatest(x, y) AS b FROM drawn),
parts AS (
  SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1, n - b) AS s FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts""",
)
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_in_middle.transform(table(spark, sf_dir, "documents"))
    output = F.col("output")
    return found.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(output.cast("binary"), 256).alias("output_sha256"),
        F.sha2(fill_in_middle.restored(output, F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )


def _rounds_sql(rounds: int) -> str:
    """The centroids c1 to c{rounds} and the nearest ones n0 to n{rounds}; distances are far below 2^50."""
    parts = []
    for k in range(rounds + 1):
        parts.append(f"""
n{k} AS (
  SELECT r, nearest % 64 AS cluster, nearest // 64 AS distance FROM (
    SELECT r, min(64 * CAST(list_sum(list_transform(range(1, 65), lambda j: (kept.v[j] - c{k}.v[j]) * (kept.v[j] - c{k}.v[j]))) AS BIGINT) + c) AS nearest
    FROM kept, c{k} GROUP BY r))""")
        if k < rounds:
            parts.append(f"""
s{k} AS (
  SELECT cluster, j, CAST(sum(x) AS BIGINT) AS total, count(*) AS members
  FROM (SELECT cluster, unnest(range(1, 65)) AS j, unnest(v) AS x FROM n{k} JOIN kept USING (r)) GROUP BY cluster, j),
m{k} AS (
  SELECT cluster, list((total - (total % members + members) % members) // members ORDER BY j) AS v FROM s{k} GROUP BY cluster),
c{k + 1} AS (SELECT c, coalesce(m{k}.v, c{k}.v) AS v FROM c{k} LEFT JOIN m{k} ON c = cluster)""")
    return ",".join(parts)


@query(
    "op13_simplex_clustering",
    """
WITH kept AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS (
  SELECT CAST(row_number() OVER (ORDER BY h, v) - 1 AS BIGINT) AS c, v
  FROM (SELECT sha256('2:' || CAST(vec_id AS VARCHAR)) AS h, v FROM kept ORDER BY h, v LIMIT 40)),"""
    + _rounds_sql(centroid_clustering.ROUNDS)
    + """
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c5.v, ',')) AS centroid_sha256
FROM n5 JOIN kept USING (r) JOIN c5 ON cluster = c""",
)
def op13_simplex_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clustering.cluster(table(spark, sf_dir, "embeddings"))
