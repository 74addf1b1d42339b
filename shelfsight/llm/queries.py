"""The registered queries of this folder and the DuckDB text of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfsight.llm import (
    backoff_lm, curriculum, exact_dedup, merkle, ngram_join, packing, page_text, pii, quality_rules, records, repeats,
    sharded_kmeans, slack_packing,
)
from shelfsight.llm.common import table, tokenizer_file

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_classes(table(spark, sf_dir, "documents")).drop("text_key")


@query
def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curriculum.in_order(curriculum.curriculum(table(spark, sf_dir, "documents"))).drop("positions")


@query
def op4_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff_lm.lm_scores(table(spark, sf_dir, "documents"))


@query
def op5_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_spans(table(spark, sf_dir, "documents"))


@query
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


@query
def op7_binary_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = records.write_records(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), 1)
    return records.read_records(index)


@query
def op8_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


@query
def op9_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.main_text(table(spark, sf_dir, "pages"))


@query
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.document_pieces(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), 0)
    return packing.pack(pieces)


@query
def op11_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = slack_packing.document_pieces(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), 0)
    return slack_packing.pack(pieces).drop("row", "inside")


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


@query
def op13_sharded_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded_kmeans.clusters(table(spark, sf_dir, "embeddings"))


ORACLES["op6_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
      FROM documents)
WINDOW same AS (PARTITION BY t)
"""

ORACLES["op3_mix_sources"] = r"""
WITH sized AS (
  SELECT doc_id, source, md5(coalesce(cast(doc_id AS VARCHAR), '')) AS digest,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS no
  FROM sized GROUP BY source),
weighed AS (
  SELECT *, source_size * 3 AS cap, [5.0, 2.0, 1.0][(no % 3 + 1)::INT]::DOUBLE AS weight FROM sources),
levels AS (
  SELECT *, cap / weight AS ratio,
    (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(weight) OVER (ORDER BY cap / weight, no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
targets AS (
  SELECT source, source_size,
         least(cap::DOUBLE, weight * coalesce((SELECT arg_min(level, (ratio, no)) FROM levels WHERE level <= ratio), 0.0)) AS target
  FROM levels),
placed AS (
  SELECT s.*, t.source_size, t.target,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY digest, doc_id, s.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begin
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * ((size > 0 AND begin + size / 2 <= target)::INT
              + (size > 0 AND source_size + begin + size / 2 <= target)::INT
              + (size > 0 AND 2 * source_size + begin + size / 2 <= target)::INT))::BIGINT AS taken
FROM placed
"""

ORACLES["op12_merkle_manifest"] = r"""
WITH RECURSIVE
rows AS (
  SELECT doc_id, lang,
    concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
           coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head,
    text, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
    -- CRC-32 bit by bit: each digit is mixed in (its code), then eight steps follow (-1).
    xor(list_reduce([4294967295::BIGINT] || flatten(list_transform(string_split(doc_id::VARCHAR, ''),
        lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
      lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, (c & 1) * 3988292384) END), 4294967295) AS crc
  FROM documents),
hashed AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN crc % 3 = 0 THEN sha256(head || coalesce(strlen(low) || ':' || low, '-')) END AS changed
  FROM rows),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
    dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, count(*) OVER (PARTITION BY lang) AS n,
    row_number() OVER () AS no
  FROM hashed),
nodes AS (
  SELECT tree, 0 AS level, idx, leaf AS h, n FROM leaves
  UNION ALL
  SELECT tree, level + 1, idx // 8, sha256(string_agg(h, '' ORDER BY idx)), (n + 7) // 8
  FROM nodes WHERE n > 1 GROUP BY tree, level, idx // 8, n),
subroots AS (SELECT tree, h AS subroot, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, tree AS idx, subroot AS h, n FROM subroots
  UNION ALL
  SELECT level + 1, idx // 8, sha256(string_agg(h, '' ORDER BY idx)), (n + 7) // 8
  FROM tops WHERE n > 1 GROUP BY level, idx // 8, n),
sides AS (
  SELECT tree, level, idx,
    coalesce(string_agg(h, '') OVER (PARTITION BY tree, level, idx // 8 ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(h, '') OVER (PARTITION BY tree, level, idx // 8 ORDER BY idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM nodes WHERE n > 1),
top_sides AS (
  SELECT level, idx,
    coalesce(string_agg(h, '') OVER (PARTITION BY level, idx // 8 ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(h, '') OVER (PARTITION BY level, idx // 8 ORDER BY idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM tops WHERE n > 1),
climb AS (
  SELECT no, tree, 0 AS level, idx, '' AS proof, coalesce(changed, leaf) AS fold FROM leaves
  UNION ALL
  SELECT c.no, c.tree, c.level + 1, c.idx // 8, proof || l || r, sha256(l || fold || r)
  FROM climb c JOIN sides s ON s.tree = c.tree AND s.level = c.level AND s.idx = c.idx),
climbed AS (SELECT no, tree, arg_max(proof, level) AS proof, arg_max(fold, level) AS fold FROM climb GROUP BY no, tree),
rise AS (
  SELECT no, 0 AS level, tree AS idx, proof, fold FROM climbed
  UNION ALL
  SELECT c.no, c.level + 1, c.idx // 8, proof || l || r, sha256(l || fold || r)
  FROM rise c JOIN top_sides s ON s.level = c.level AND s.idx = c.idx),
risen AS (SELECT no, arg_max(proof, level) AS proof, arg_max(fold, level) AS fold FROM rise GROUP BY no)
SELECT doc_id, leaf, subroot, t.h AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = t.h AS verified
FROM leaves JOIN risen USING (no) JOIN subroots USING (tree) JOIN tops t ON t.n = 1
"""


def _lloyd(rounds: int = sharded_kmeans.ROUNDS) -> str:
    """The rounds written out: distances, nearest centroids (n0, n1, ...) and new centroids (c1, c2, ...)."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
d{r} AS (
  SELECT k.no, c.cluster, list_sum(list_transform(range(1, 65), lambda i: (k.v[i] - c.v[i]) * (k.v[i] - c.v[i])))::BIGINT AS distance
  FROM kept k CROSS JOIN c{r} c),
n{r} AS (SELECT no, arg_min(cluster, (distance, cluster)) AS cluster, min(distance) AS distance FROM d{r} GROUP BY no)""")
        if r < rounds:
            steps.append(f"""
s{r} AS (
  SELECT cluster, i, sum(v[i])::BIGINT AS s, count(*) AS n
  FROM n{r} JOIN kept USING (no) CROSS JOIN range(1, 65) t(i) GROUP BY cluster, i),
m{r} AS (SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM s{r} GROUP BY cluster),
c{r + 1} AS (SELECT c.cluster, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN m{r} m USING (cluster))""")
    return ",".join(steps)


ORACLES["op13_sharded_kmeans"] = f"""
WITH kept AS (
  SELECT vec_id, row_number() OVER () AS no, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS cluster, v FROM kept
  QUALIFY cluster < {sharded_kmeans.CLUSTERS}),{_lloyd()}
SELECT vec_id, cluster::INT AS cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
       sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM n{sharded_kmeans.ROUNDS} JOIN kept USING (no) JOIN c{sharded_kmeans.ROUNDS} c USING (cluster)
"""
