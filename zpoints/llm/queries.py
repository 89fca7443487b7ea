"""Registered queries of the training-data operators, with production parameters, and their SQL where it can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, egojoin, htmlcrf, mixing, patricia, probminhash, quality, sharding, substring, tokenalign, toxicity,
               vptree, whitening)
from .common import table


def op1_vptree_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 vectors of largest inner product for every vector whose id is divisible by 20."""
    return vptree.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, factor=1.2)


def op2_gam_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality score by the additive model."""
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3)


def op5_grammar_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity score by the pattern grammar."""
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.5)


def op3_ego_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector with the number of vectors at cosine 0.9 or more and the component these links give."""
    return egojoin.cosine_links(table(spark, sf_dir, "embeddings"), least=0.9)


def op4_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its source's target and the words the curriculum mix takes of it."""
    docs = table(spark, sf_dir, "documents")
    return mixing.mix_digests(mixing.mix_sources(docs, carry=["text"]))


def op6_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 40 shards of near-equal bytes."""
    out = sharding.kd_shards(table(spark, sf_dir, "documents"), n_shards=40, overhead=16)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op7_automata_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words left after windows of 20 words that start earlier are removed."""
    return substring.removal_digests(table(spark, sf_dir, "documents"), size=20)


def op8_crf_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text by the conditional random field."""
    return htmlcrf.extract_main_text(table(spark, sf_dir, "pages"))


def op9_bpe_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token ids under the public rank file, and the bytes they decode to, as digests."""
    import public_tokenizers

    return bpe.encode_digests(table(spark, sf_dir, "documents"),
                              public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op10_probminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the class of near duplicates it belongs to: five words, similarity 0.8 or more."""
    return probminhash.near_duplicates(table(spark, sf_dir, "documents"), threshold=0.8, k=5)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's overlap links between the tokens of two public tokenizers, as counts and a digest of its groups."""
    import public_tokenizers

    return tokenalign.alignment_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                        public_tokenizers.path("piece_bpe_32k.model"))


def op12_cholesky_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's coordinates on the 32 leading principal components, scaled to unit variance."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"), n_components=32)


def op13_patricia_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the least doc_id of those whose text equals its own up to runs of white space."""
    return patricia.exact_duplicates(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_vptree_neighbours": op1_vptree_neighbours,
    "op2_gam_quality": op2_gam_quality,
    "op3_ego_join": op3_ego_join,
    "op4_curriculum_mix": op4_curriculum_mix,
    "op5_grammar_toxicity": op5_grammar_toxicity,
    "op6_kd_shards": op6_kd_shards,
    "op7_automata_dedup": op7_automata_dedup,
    "op8_crf_extract": op8_crf_extract,
    "op9_bpe_replay": op9_bpe_replay,
    "op10_probminhash": op10_probminhash,
    "op11_token_alignment": op11_token_alignment,
    "op12_cholesky_whitening": op12_cholesky_whitening,
    "op13_patricia_dedup": op13_patricia_dedup,
}

OP4_SQL = r"""
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS turn FROM documents),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY (source IS NULL), source) AS nth FROM sizes GROUP BY source),
w AS (
  SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][(nth - 1) % 3 + 1] AS weight,
         [0.6::DOUBLE, 0.0::DOUBLE, (-0.6)::DOUBLE][(nth - 1) % 3 + 1] AS slope,
         2.0::DOUBLE * source_size AS most FROM per),
f AS (
  SELECT *, 1.5::DOUBLE * sum(source_size) OVER () AS budget,
         coalesce(sum(most) OVER r, 0.0::DOUBLE) AS spent,
         sum(weight) OVER () - coalesce(sum(weight) OVER r, 0.0::DOUBLE) AS heavy FROM w
  WINDOW r AS (ORDER BY most / weight, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (
  SELECT *, max(CASE WHEN most > (budget - spent) / heavy * weight THEN (budget - spent) / heavy END) OVER () AS level
  FROM f),
t AS (SELECT source, source_size, slope, least(most, coalesce(level * weight, most)) AS target FROM l),
d AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, t.slope,
         (coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.turn, s.doc_id, s.size
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS o
  FROM sizes s JOIN t ON s.source IS NOT DISTINCT FROM t.source),
c AS (
  SELECT *, ((o + size / 2 <= target)::INT + (source_size + (o + size / 2) <= target)::INT) AS copies,
         CASE WHEN target > 0 THEN least(o / target, 1.0::DOUBLE) ELSE 0.0::DOUBLE END AS c FROM d)
SELECT doc_id, size, source_size, target, (copies * size)::BIGINT AS taken, copies,
       CASE WHEN copies > 0 THEN CASE WHEN abs(slope) < 1e-12 OR c = 0 THEN c
            ELSE 2 * c / ((1 - slope) + sqrt(greatest((1 - slope) * (1 - slope) + 4 * slope * c, 0.0::DOUBLE))) END
       END AS position
FROM c
"""

OP13_SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, (count(*) OVER g)::BIGINT AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM n WINDOW g AS (PARTITION BY t)
"""

# brute force: every pair of vectors, and what is reachable by links
OP3_SQL = """
WITH RECURSIVE e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
u AS (SELECT vec_id, v, sqrt(list_inner_product(v, v)) AS norm FROM e),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id
          WHERE list_inner_product(a.v, b.v) / (a.norm * b.norm) >= 0.9::DOUBLE),
reach AS (SELECT vec_id AS node, vec_id AS r FROM e UNION SELECT node, b FROM reach JOIN links ON r = a),
component AS (SELECT node, min(r) AS component_id FROM reach GROUP BY node),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM e JOIN component ON node = vec_id LEFT JOIN degree ON a = vec_id
"""

# every window of 20 words as a string; all but its first occurrence remove their words
OP7_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, s, array_to_string(w[s:s + 19], ' ') AS k FROM d, unnest(range(1, len(w) - 18)) t(s)),
again AS (SELECT doc_id, s FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS nth FROM win) WHERE nth > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS p FROM again),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

# every pair of documents that share a run of five words, by the Jaccard similarity of their sets of runs
OP10_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
runs AS (SELECT DISTINCT doc_id, array_to_string(w[s:s + 4], ' ') AS k FROM d, unnest(range(1, greatest(len(w) - 3, 2))) t(s) WHERE len(w) > 0),
size AS (SELECT doc_id, count(*) AS n FROM runs GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM runs a JOIN runs b USING (k) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
near AS (SELECT a, b FROM shared JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE c::DOUBLE / (x.n + y.n - c) >= 0.8::DOUBLE),
links AS (SELECT a, b FROM near UNION ALL SELECT b, a FROM near),
reach AS (SELECT doc_id AS node, doc_id AS r FROM d UNION SELECT node, b FROM reach JOIN links ON r = a)
SELECT node AS doc_id, min(r) AS class_id, node = min(r) AS kept FROM reach GROUP BY node
"""

ORACLES: dict[str, str] = {"op3_ego_join": OP3_SQL, "op4_curriculum_mix": OP4_SQL, "op7_automata_dedup": OP7_SQL,
                           "op10_probminhash": OP10_SQL, "op13_patricia_dedup": OP13_SQL}
