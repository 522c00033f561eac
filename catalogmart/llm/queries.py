"""The registered queries of this package, and their check SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogmart.llm import (
    exact_dedup,
    language,
    line_dedup,
    merkle,
    mixing,
    periodic,
    piece_sampling,
    quality,
    secret_scan,
    sharding,
    simhash,
    token_files,
    toxicity,
)
from catalogmart.llm.common import documents

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(documents(spark, sf_dir))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(documents(spark, sf_dir))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    lexicon = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score_toxicity(docs, lexicon)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(documents(spark, sf_dir))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_round_trip(documents(spark, sf_dir), BYTE_BPE)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return language.identify_languages(docs, language.train(docs))


def op7_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_sampling.digest_pieces(documents(spark, sf_dir), PIECES)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest_lines(line_dedup.dedup_lines(documents(spark, sf_dir)))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digest_runs(periodic.periodic_runs(documents(spark, sf_dir), words=periodic.planted_words))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(documents(spark, sf_dir), merkle.stripped_text(F.col("doc_id"), F.col("text")))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_secret_scan,
        op3_toxicity,
        op4_sharding,
        op5_token_files,
        op6_language_id,
        op7_piece_sampling,
        op8_simhash,
        op9_exact_dedup,
        op10_mixing,
        op11_line_dedup,
        op12_periodic_runs,
        op13_merkle_manifest,
        pipeline,
    )
}

_EXACT = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS body FROM documents)
SELECT doc_id,
       max(doc_id) OVER w AS keep_id,
       count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept,
       sha256(body) AS text_sha256
FROM d WINDOW w AS (PARTITION BY body)
"""

_MIX = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS place
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
  FROM d GROUP BY source),
w AS (SELECT *, CASE rank % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM s),
shared AS (
  SELECT 0 AS round, rank, source_size, weight, false AS full_up,
         sum(source_size) OVER () * weight / sum(weight) OVER () AS target
  FROM w
  UNION ALL
  SELECT round + 1, rank, source_size, weight, f,
         CASE WHEN f THEN 3.0::DOUBLE * source_size
              ELSE (total - sum(CASE WHEN f THEN 3.0::DOUBLE * source_size ELSE 0 END) OVER ()) * weight
                   / sum(CASE WHEN f THEN 0 ELSE weight END) OVER () END
  FROM (SELECT *, full_up OR target > 3 * source_size AS f, sum(source_size) OVER () AS total FROM shared)
  WHERE round < (SELECT count(*) FROM w)),
t AS (SELECT rank, target FROM shared WHERE round = (SELECT max(round) FROM shared)),
const AS (
  SELECT greatest(1, min(source_size) FILTER (source_size > 0) // {mixing.BLOCKS_PER_SOURCE}) AS b, sum(source_size)::BIGINT AS total FROM s),
q AS (
  SELECT rank, count(*) AS won FROM (
    SELECT rank, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, rank, k) AS n
    FROM (SELECT rank, target, unnest(range(3 * source_size // b)) AS k FROM t JOIN s USING (rank) CROSS JOIN const))
  WHERE n <= (SELECT total // b FROM const) GROUP BY rank),
seat AS (
  SELECT rank, j, (row_number() OVER (ORDER BY rank, j) - 1) % {mixing.SHARDS} AS shard
  FROM (SELECT rank, unnest(range(won)) AS j FROM q)),
share AS (
  SELECT rank, shard, sum(count(*)) OVER (PARTITION BY rank ORDER BY shard) * b AS hi, (sum(count(*)) OVER (PARTITION BY rank ORDER BY shard) - count(*)) * b AS lo
  FROM seat CROSS JOIN const GROUP BY rank, shard, b),
placed AS (
  SELECT row_number() OVER () AS r, doc_id, size, s.rank, source_size, target,
         sum(size) OVER (PARTITION BY s.rank ORDER BY place ROWS UNBOUNDED PRECEDING) - size AS lo
  FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source JOIN t ON t.rank = s.rank),
part AS (
  SELECT r, shard, sum(greatest(0, least(p.lo + size + m * source_size, hi) - greatest(p.lo + m * source_size, x.lo))) AS words
  FROM placed p CROSS JOIN range(3) AS m(m) CROSS JOIN range({mixing.SHARDS}) AS h(shard) LEFT JOIN share x USING (rank, shard) GROUP BY r, shard)
SELECT doc_id, size, source_size, target, CAST(sum(coalesce(words, 0)) AS BIGINT) AS taken,
       list(CAST(coalesce(words, 0) AS BIGINT) ORDER BY shard) AS shard_words
FROM placed JOIN part USING (r) GROUP BY r, doc_id, size, source_size, target
"""

_BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _crc32(digits: str) -> str:
    """Checksum of an ASCII text, bit by bit."""
    byte = f"list_transform(range(1, strlen({digits}) + 1), lambda k: ascii(substr({digits}, k, 1)))"
    bits = "list_reduce(range(8), lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(c, b))"
    return f"xor(list_reduce({byte}, lambda c, b: {bits}, 4294967295), 4294967295)"


_LINES = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
l AS (SELECT r, doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS position FROM d),
k AS (SELECT *, translate(trim(line, {_BLANKS}), '{_UPPER}', '{_LOWER}') AS key FROM l),
s AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= {line_dedup.MIN_LENGTH} GROUP BY key
      HAVING count(DISTINCT doc_id) >= {line_dedup.MIN_DOCUMENTS})
SELECT k.doc_id, count(*) AS n_lines, count(*) FILTER (keeper <> k.doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY position) FILTER (keeper IS NULL OR keeper = k.doc_id), '')) AS kept_sha256
FROM k LEFT JOIN s USING (key) GROUP BY r, k.doc_id
"""

_RUNS = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS words, {_crc32("coalesce(doc_id::VARCHAR, '')")} AS h FROM documents),
e AS (SELECT *, len(words) AS n, CASE WHEN len(words) > 0 THEN h // 10 % len(words) END AS a FROM d),
f AS (SELECT *, 1 + (n - a) // (3 + h // 10 % 8) AS p FROM e),
v AS (SELECT r, doc_id, n, unnest(range(n)) AS i, h, a, p, words FROM f),
w AS (SELECT r, i, words[1 + CASE WHEN h % 10 = 0 AND i >= a THEN a + (i - a) % p ELSE i END] AS word FROM v),
grams AS (
  SELECT r, i, concat_ws(' ', word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o,
                          lead(word, 5) OVER o) AS gram, lead(i, 5) OVER o AS whole
  FROM w WINDOW o AS (PARTITION BY r ORDER BY i)),
distances AS (
  SELECT DISTINCT x.r, y.i - x.i AS q FROM grams x JOIN grams y ON x.r = y.r AND x.gram = y.gram AND x.i < y.i
  JOIN e ON e.r = x.r WHERE x.whole IS NOT NULL AND y.whole IS NOT NULL AND 2 * (y.i - x.i) <= n),
equal AS (
  SELECT q.r, q.q, x.i, x.i - row_number() OVER (PARTITION BY q.r, q.q ORDER BY x.i) AS island
  FROM distances q JOIN w x ON x.r = q.r JOIN w y ON y.r = q.r AND y.i = x.i + q.q AND x.word = y.word),
stretches AS (SELECT r, q, min(i) AS start, count(*) + q AS length FROM equal GROUP BY r, q, island HAVING count(*) >= q AND count(*) + q >= 12),
runs AS (SELECT r, start, length, min(q) AS period FROM stretches GROUP BY r, start, length),
best AS (
  SELECT r, count(*) AS n_runs, first(start ORDER BY length DESC, start, period) AS start, max(length) AS length,
         first(period ORDER BY length DESC, start, period) AS period,
         string_agg(concat_ws(',', start, length, period) || chr(10), '' ORDER BY start, period) AS listed
  FROM runs GROUP BY r),
gone AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS body FROM w ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
       sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(body, '')) AS collapsed_sha256, CAST(n AS BIGINT) AS n_words
FROM e LEFT JOIN best USING (r) LEFT JOIN kept USING (r)
"""


def _field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({value}::VARCHAR) || ':' || {value}::VARCHAR END"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", text))) + ")"


_MERKLE = rf"""
WITH RECURSIVE d AS (
  SELECT *, CASE WHEN {_crc32("coalesce(doc_id::VARCHAR, '')")} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS stripped FROM documents),
h AS (SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s, {_leaf("text")} AS leaf, {_leaf("stripped")} AS tampered FROM d),
leaves AS (
  SELECT *, row_number() OVER () AS r, row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
         count(*) OVER (PARTITION BY s) AS n FROM h),
t AS (
  SELECT 0 AS level, s, place, leaf AS digest, n FROM leaves
  UNION ALL
  SELECT any_value(level) + 1, s, place // 3, sha256(string_agg(digest, '' ORDER BY place)), (any_value(n) + 2) // 3
  FROM t WHERE n > 1 GROUP BY s, place // 3),
subroots AS (SELECT s, digest AS subroot FROM t WHERE n = 1),
u AS (
  SELECT 0 AS level, s AS place, subroot AS digest, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT any_value(level) + 1, place // 3, sha256(string_agg(digest, '' ORDER BY place)), (any_value(n) + 2) // 3
  FROM u WHERE n > 1 GROUP BY place // 3),
near AS (
  SELECT r, level, t.place AS i, x.place // (3 ** level)::BIGINT AS own, digest
  FROM leaves x JOIN t ON x.s = t.s AND t.n > 1 AND t.place // 3 = x.place // (3 ** (level + 1))::BIGINT
  UNION ALL
  SELECT r, 1000 + level, u.place, s // (3 ** level)::BIGINT, digest
  FROM leaves x JOIN u ON u.n > 1 AND u.place // 3 = s // (3 ** (level + 1))::BIGINT),
steps AS (
  SELECT r, row_number() OVER (PARTITION BY r ORDER BY level) AS k,
         coalesce(string_agg(digest, '' ORDER BY i) FILTER (i < own), '') AS ahead,
         coalesce(string_agg(digest, '' ORDER BY i) FILTER (i > own), '') AS behind
  FROM near GROUP BY r, level),
folded AS (
  SELECT r, 1 AS k, tampered AS digest FROM leaves
  UNION ALL
  SELECT f.r, f.k + 1, sha256(ahead || digest || behind) FROM folded f JOIN steps s ON s.r = f.r AND s.k = f.k),
ends AS (SELECT r, arg_max(digest, k) AS folded_root FROM folded GROUP BY r),
proofs AS (SELECT r, string_agg(ahead || behind, '' ORDER BY k) AS proof FROM steps GROUP BY r)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(proof, '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM leaves JOIN subroots USING (s) JOIN ends USING (r) LEFT JOIN proofs USING (r) CROSS JOIN (SELECT digest AS root FROM u WHERE n = 1)
"""

SQL = {
    "op9_exact_dedup": _EXACT,
    "op10_mixing": _MIX,
    "op11_line_dedup": _LINES,
    "op12_periodic_runs": _RUNS,
    "op13_merkle_manifest": _MERKLE,
}
