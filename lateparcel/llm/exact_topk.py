"""Exact top-k search by distributed histogram selection.

Every query meets every candidate, block by block. A round gives each query a histogram of its scores
between two bounds; summed over all blocks it tells in which bin the k-th score lies, and that bin is
the range of the next round. When the range is a single value, the k-th score is known, and a last
round keeps the scores above it and the ties with the smallest ids. A block tells only the bins from
its own k-th score up: the global one cannot be lower.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lateparcel.session import cut_lineage

#: Rows of a query block and of a candidate block, bins of a round.
QUERIES, CANDIDATES, BINS = 1024, 1024, 1024
#: Scores beyond this count as this; twice of it still fits 64 bits.
FURTHEST = (1 << 62) - 1


def _matrix(blobs: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), "<f8").reshape(len(blobs), -1)


def _scores(queries: pd.DataFrame, candidates: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Scores of all pairs as whole numbers, and which pairs count.

    Rows whose scores may not be exact in double precision, or not fit 64 bits, are scored apart.
    """
    a, b = _matrix(queries["vector"]), _matrix(candidates["vector"])
    scores = np.zeros((len(a), len(b)), np.int64)
    tops_a, tops_b = np.abs(a).max(axis=1), np.abs(b).max(axis=1)
    with np.errstate(over="ignore"):
        few = tops_b * np.median(tops_a) * a.shape[1] < 2.0**52
        plain = tops_a * tops_b[few].max(initial=0.0) * a.shape[1] < 2.0**53
    if plain.any() and few.any():
        scores[np.ix_(plain, few)] = (a[plain] @ b[few].T).astype(np.int64)
    for i, j in np.argwhere(~(plain[:, None] & few)).tolist():
        total = sum(int(x) * int(y) for x, y in zip(a[i].tolist(), b[j].tolist(), strict=True))
        scores[i, j] = max(-FURTHEST, min(FURTHEST, total))
    other = queries["query_id"].to_numpy()[:, None] != candidates["vec_id"].to_numpy()[None, :]
    return scores, other


def _best(scores: np.ndarray, counts: np.ndarray, k: int) -> np.ndarray:
    """Each row's k-th score of those that count, or the least possible value."""
    low = np.iinfo(np.int64).min
    held = np.where(counts, scores, low)
    if held.shape[1] <= k:
        return np.full(len(held), low) if held.shape[1] < k else held.min(axis=1)
    return np.partition(held, held.shape[1] - k, axis=1)[:, -k]


def whole_numbers(vectors: DataFrame, scale: int) -> DataFrame:
    """(vec_id, vector as bytes, width, norm) of the vectors that take part."""
    rows = vectors.select(
        F.col("vec_id").cast("long"),
        F.transform("embedding", lambda x: x.cast("double")).alias("embedding"),
    )
    valid = F.col("embedding").isNotNull() & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    single = (
        rows.where(F.col("vec_id").isNotNull() & valid & (F.size("embedding") > 0))
        .groupBy("vec_id")
        .agg(F.min("embedding").alias("embedding"))
    )

    def work(frames):
        for frame in frames:
            with np.errstate(over="ignore"):
                whole = [np.floor(scale * np.asarray(v, "<f8")) for v in frame["embedding"]]
            most = np.finfo(float).max
            whole = [np.clip(v, -most, most) for v in whole]
            yield pd.DataFrame(
                {
                    "vec_id": frame["vec_id"],
                    "vector": [v.astype("<f8").tobytes() for v in whole],
                    "width": [len(v) for v in whole],
                    "norm": [float(np.linalg.norm(v / (m := max(1.0, np.abs(v).max()))) * m) for v in whole],
                }
            )

    return single.mapInPandas(work, "vec_id long, vector binary, width int, norm double")


def top_k(
    vectors: DataFrame, k: int = 5, every: int = 50, scale: int = 256
) -> DataFrame:
    """Each query's k best candidates: query_id, rank, vec_id, score.

    Queries are the rows whose id is divisible by ``every``; candidates are all rows but the
    query's own. A component x counts as floor(scale * x), the score is the inner product, ties go
    to the smaller id. Vectors that are null, empty, or hold null or non-finite components, and
    null ids, take no part; rows of one id are one vector (the smallest). Only vectors of one width
    meet. A query with fewer than k candidates returns all. Scores are exact up to 2^62 - 1 either way;
    beyond, they count as that.
    """
    base = cut_lineage(whole_numbers(vectors, scale))
    asked = base.where(F.col("vec_id") % every == 0)
    sizes = base.agg(
        F.count("*").alias("rows"), F.max("norm").alias("norm"),
        F.count_if(F.col("vec_id") % every == 0).alias("asked"),
    ).first()
    parts = -(-sizes["rows"] // CANDIDATES) or 1
    blocks = -(-sizes["asked"] // QUERIES) or 1
    number = F.xxhash64("vec_id")
    candidates = base.select(
        "vec_id", "vector", "width", F.pmod(number, F.lit(parts)).cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
    )
    # no score is beyond the product of the lengths
    length = F.col("norm") * F.lit(sizes["norm"] or 0.0) * 1.000001 + 1
    reach = F.when(length < float(1 << 61), F.ceil(length).cast("long")).otherwise(F.lit(FURTHEST))
    queries = cut_lineage(
        asked.select(
            F.col("vec_id").alias("query_id"), "vector", "width",
            F.pmod(number, F.lit(blocks)).cast("int").alias("block"),
            (-reach).alias("low"), (reach + 1).alias("high"),  # high is outside
            F.lit(0).cast("long").alias("above"),
        )
    )
    keys = ["width", "block", "part"]

    def met(queries: DataFrame, work, schema: str) -> DataFrame:
        spread = queries.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        return spread.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInPandas(work, schema)

    def histogram(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        names = ["query_id", "bin", "n"]
        if not len(left) or not len(right):
            return pd.DataFrame({n: np.zeros(0, np.int64) for n in names})
        scores, counts = _scores(left, right)
        low, high = left["low"].to_numpy()[:, None], left["high"].to_numpy()[:, None]
        width = np.maximum(1, -(-(high - low) // BINS))
        kept = counts & (scores >= np.maximum(low, _best(scores, counts, k)[:, None])) & (scores < high)
        where, column = np.nonzero(kept)
        bins = (scores[where, column] - low[where, 0]) // width[where, 0]
        both, n = np.unique(where * BINS + bins, return_counts=True)
        ids = left["query_id"].to_numpy()
        return pd.DataFrame({"query_id": ids[both // BINS], "bin": both % BINS, "n": n})

    def final(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        names = ["query_id", "vec_id", "score"]
        if not len(left) or not len(right):
            return pd.DataFrame({n: np.zeros(0, np.int64) for n in names})
        scores, counts = _scores(left, right)
        where, column = np.nonzero(counts & (scores >= left["low"].to_numpy()[:, None]))
        found = pd.DataFrame(
            {
                "query_id": left["query_id"].to_numpy()[where],
                "vec_id": right["vec_id"].to_numpy()[column],
                "score": scores[where, column],
            }
        ).sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
        return found.groupby("query_id").head(k)

    while True:
        counted = met(queries, histogram, "query_id long, bin long, n long")
        totals = counted.groupBy("query_id", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("query_id").orderBy(F.desc("bin"))
        upto = totals.withColumn("upto", F.sum("n").over(down))
        # the first bin from above in which the k-th score lies; none if there are fewer scores
        hit = (
            upto.join(queries.select("query_id", "above"), "query_id")
            .where(F.col("above") + F.col("upto") >= k)
            .groupBy("query_id")
            .agg(F.max(F.struct("bin", (F.col("upto") - F.col("n")).alias("passed"))).alias("hit"))
            .select("query_id", F.col("hit.bin").alias("bin"), F.col("hit.passed").alias("passed"))
        )
        width = F.expr(
            f"greatest(1L, (high - low) div {BINS} + CASE WHEN (high - low) % {BINS} > 0 THEN 1L ELSE 0L END)"
        )
        low = F.col("low") + F.col("bin") * width
        queries = cut_lineage(
            queries.join(hit, "query_id", "left").select(
                "query_id", "vector", "width", "block",
                F.when(F.col("bin").isNull(), F.col("low")).otherwise(low).alias("low"),
                F.when(F.col("bin").isNull(), F.col("low") + 1)
                .otherwise(F.least(low + width, "high")).alias("high"),
                (F.col("above") + F.coalesce("passed", F.lit(0))).alias("above"),
            )
        )
        if queries.where("high - low > 1").isEmpty():
            break
    kept = met(queries, final, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return (
        kept.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int"), "vec_id", "score")
    )
