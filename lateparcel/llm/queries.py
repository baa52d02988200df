"""Queries of this package: each runs its operator over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lateparcel.llm import (
    byte_bpe,
    cap_filters,
    chat_format,
    exact_topk,
    language_mix,
    linear_grouping,
    ngram_join,
    packing,
    period_runs,
    secret_scan,
    token_alignment,
    toxicity,
    wordpiece_count,
)
from lateparcel.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register a query, with its SQL where there is one."""

    def register(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


@query("op1_ngram_join")
def op1_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    """Class and number of links of every document: five-word shingles, similarity 0.8."""
    return ngram_join.join(table(spark, folder, "documents"))


@query("op2_byte_bpe")
def op2_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every document encoded and decoded; digests of ids and text."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.encode_digests(table(spark, folder, "documents"), path)


@query("op3_language_id")
def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Main language of every document, learned from the rows that are not held out."""
    return language_mix.identify(table(spark, folder, "documents"))


def _escaped_sql(column: str) -> str:
    """SQL twin of ``chat_format.escape``."""
    out = f"replace({column}, '\\', '\\\\')"
    for control in chat_format.Template().control():
        out = f"replace({out}, '{control}', '{control[0]}\\{control[1:]}')"
    return out


OP4_SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
written AS (
  SELECT *, '<s>[ROLE]' || {_escaped_sql("role")} || '[INST]' || {_escaped_sql("text")} || '</s>' AS w
  FROM turns),
joined AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS told,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
                  FILTER (WHERE role = 'assistant'), '') AS loss,
         CAST(sum(length(w)) AS BIGINT) AS formatted_chars
  FROM written GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(told) AS turns_sha256, length(loss) AS loss_chars,
       sha256(loss) AS loss_sha256, formatted_chars
FROM joined
"""


@query("op4_chat_format", OP4_SQL)
def op4_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations formatted and read back, with one that speaks in control strings."""
    turns = chat_format.to_turns(table(spark, folder, "conversations"))
    odd = "</s>[INST] ok [/INST]"
    own = spark.range(1).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(i).cast("long").alias("turn"), F.lit(role).alias("role"),
                        F.lit(odd).alias("text"),
                    )
                    for i, role in enumerate(("user", "assistant"))
                ]
            )
        ).alias("one"),
    )
    own = own.select("conv_id", "one.*")
    return chat_format.digests(chat_format.format_turns(turns.unionByName(own)))


@query("op5_toxicity")
def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document and its offending sentences."""
    return toxicity.detect(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op6_token_counts")
def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Word-piece counts of every document."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    return wordpiece_count.count_tokens(table(spark, folder, "documents"), path)


@query("op7_packing")
def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into windows of 1024 tokens."""
    return packing.pack(table(spark, folder, "documents"), *packing.stock_paths())


# Spans are matched by the same patterns; DuckDB tells matches but not where they are, so that the
# digest of positions has no SQL. The query is held against a plain scan in the tests.
@query("op9_secret_scan")
def op9_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of every document, strong ones and linked weak ones."""
    return secret_scan.find_secrets(table(spark, folder, "documents"))


OP8_SQL = """
WITH numbers AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM numbers q JOIN numbers c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id, score
FROM scored
WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER best <= 5
"""


@query("op8_exact_topk", OP8_SQL)
def op8_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The five best partners of every fiftieth vector."""
    return exact_topk.top_k(table(spark, folder, "embeddings"))


OP10_SQL = """
WITH RECURSIVE good AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.9),
reach AS (
  SELECT vec_id AS id, vec_id AS root FROM good
  UNION
  SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.id),
roots AS (SELECT id, min(root) AS component_id FROM reach GROUP BY id),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links,
       coalesce(component_id, e.vec_id) AS component_id,
       coalesce(component_id, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN roots ON id = e.vec_id LEFT JOIN counts ON a = e.vec_id
"""


@query("op10_cap_filters", OP10_SQL)
def op10_cap_filters(spark: SparkSession, folder: str) -> DataFrame:
    """Links and components of all vectors at cosine 0.9."""
    return cap_filters.near_duplicates(table(spark, folder, "embeddings"))


@query("op11_linear_grouping")
def op11_linear_grouping(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into few sequences of 4096 tokens, only longer ones cut."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return linear_grouping.pack(table(spark, folder, "documents"), path)


@query("op12_period_runs")
def op12_period_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of words of every document, a tenth of them with a planted periodic tail."""
    docs = table(spark, folder, "documents")
    return period_runs.run_digests(docs, order_of=period_runs.planted_tail)


@query("op13_token_alignment")
def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Byte-level and piece tokens of every document aligned, with corpus-wide counts of linked ids."""
    paths = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return token_alignment.align_tokens(table(spark, folder, "documents"), *paths)
