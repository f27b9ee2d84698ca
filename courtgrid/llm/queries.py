"""The registered queries of the corpus operators, with production parameters.

Each reads its whole table; ``ORACLE_SQL`` holds DuckDB SQL where SQL can
express the result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (embedding_dedup, fingerprints, line_dedup, lm, mixing, ngram_join, packing, sharding, spelling,
               token_counts, topk, toxicity, whitening)
from .common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


def tokenizer_file(name: str) -> str:
    """Path of a public tokenizer file on this machine (every executor has them installed)."""
    import public_tokenizers

    return public_tokenizers.path(name)


@register("op1_ngram_join")
def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class and number of links of every document."""
    return ngram_join.join(read_table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "kept")


def line_dedup_sql(min_sites: int = line_dedup.MIN_SITES, min_words: int = line_dedup.MIN_WORDS) -> str:
    """Exact counts in place of sketches: the same lines, as near estimates are counted exactly."""
    bare = r"trim(line, chr(32) || chr(9) || chr(11) || chr(12) || chr(13))"
    return rf"""
WITH l AS (SELECT doc_id, source, coalesce(text, '') AS text, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place,
                  unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents),
b AS (SELECT *, {bare} AS bare, len(regexp_extract_all({bare}, '[^\x20\x09-\x0D]+')) >= {min_words} AS counts FROM l),
s AS (SELECT bare, count(DISTINCT coalesce('+' || source, '-')) AS sites, min((doc_id, place)) AS keeper
      FROM b WHERE counts GROUP BY bare),
k AS (SELECT b.*, coalesce(b.counts AND s.sites >= {min_sites} AND (b.doc_id, b.place) <> s.keeper, false) AS gone
      FROM b LEFT JOIN s ON b.counts AND b.bare = s.bare)
SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '') AS text,
       count(*) FILTER (NOT (text = '')) AS n_lines, count(*) FILTER (gone) AS n_removed
FROM k GROUP BY doc_id, text"""


@register("op2_line_dedup", line_dedup_sql())
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without cross-site boilerplate lines."""
    cleaned = line_dedup.clean_lines(read_table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "n_lines", "n_removed")


@register("op3_embedding_dedup")
def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector at cosine 0.95."""
    return embedding_dedup.near_duplicates(read_table(spark, sf_dir, "embeddings"), 0.95)


@register("op4_toxicity")
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@register("op5_fingerprints")
def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and its edited text, with their likeness."""
    return fingerprints.fingerprint_rows(read_table(spark, sf_dir, "documents"))


@register("op6_lm_scoring")
def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and log-bilinear scores of every document."""
    return lm.score(read_table(spark, sf_dir, "documents"))


@register("op7_sharding")
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 16 shards of nearly equal bytes."""
    placed = sharding.shard_by_size(read_table(spark, sf_dir, "documents"), 16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@register("op8_token_counts")
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count of every whole document, and how much of it fits 4096 tokens."""
    return token_counts.token_counts(read_table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"), 4096)


MIXING_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
                  substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15) AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, list_extract([3, 1, 2], ((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1)::DOUBLE AS weight,
             2.0::DOUBLE * source_size AS cap FROM s),
r AS (SELECT *, cap / weight AS full_at FROM w),
v AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY full_at, source NULLS LAST
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY full_at, source NULLS LAST
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level FROM r),
t AS (SELECT source, source_size, least(cap, weight * (SELECT arg_min(level, full_at) FROM v WHERE level <= full_at)) AS target FROM v),
c AS (SELECT d.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS passes,
             sum(size) OVER (PARTITION BY d.source ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
             sum(size) OVER (PARTITION BY d.source, h) AS own
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
-- whole hashes up to the budget, and the first one past it if that comes nearer
g AS (SELECT *, target - passes * source_size AS budget, upto - own AS below FROM c)
SELECT doc_id, size, source_size, target,
       (size * (passes + CASE WHEN upto <= budget OR (below <= budget AND upto - budget < budget - below) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM g"""


@register("op9_mixing", MIXING_SQL)
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.mix(read_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@register("op10_packing")
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    return packing.pack(read_table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), 2048, 1)


TOP_K_SQL = """
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id IS DISTINCT FROM c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""


@register("op11_topk_search", TOP_K_SQL)
def op11_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five rows of highest integer inner product of every fiftieth vector."""
    return topk.top_k(read_table(spark, sf_dir, "embeddings"))


@register("op12_spelling_variants")
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form and root of every word of all documents."""
    return spelling.spelling_variants(read_table(spark, sf_dir, "documents"))


@register("op13_whitening")
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened coordinates of every vector on the first four components."""
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


@register("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline of ``corpus_pipeline.py``."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
