"""Exact top-k inner products by MaxScore over quantised vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARD, QUERIES = 8192, 4096


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """(vec_id, q): floor(scale * x) of every component; vectors null or with null or non-finite parts are left out."""
    x = F.col(vector_col).cast("array<double>")
    whole = x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vectors.where(whole & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("vec_id"), F.transform(x, lambda v: F.floor(v * scale)).alias("q"))


def _matrix(lists: pa.ChunkedArray, width: int) -> np.ndarray:
    """Terms as columns; a vector without a term has 0 there."""
    flat = lists.combine_chunks()
    sizes = np.diff(flat.offsets.to_numpy())
    values = flat.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def saturated(postings: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in unbounded whole numbers, those beyond 64 bits set to the nearest end of the range."""
    ends = np.iinfo(np.int64)
    scores = (postings.astype(object) * query.astype(object)[:, None]).sum(0)
    return np.array([min(max(int(s), ends.min), ends.max) for s in scores], np.int64)


def small(values: np.ndarray) -> np.ndarray:
    """Rows whose sums of products, and the bounds of these, stay in 64 bits."""
    limit = int((2**60 / max(1, values.shape[1])) ** 0.5)
    return ((values < limit) & (values > -limit)).all(1)


def shard_top(postings: np.ndarray, low: np.ndarray, high: np.ndarray, ids: np.ndarray, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of one shard for one query, by MaxScore.

    ``postings[t]`` holds the values of term t. A term adds between its bounds; bounds are
    shifted so that the lower one is 0. The terms with the widest bounds are traversed first.
    They are essential until the bounds of the rest together no longer reach the k-th best
    score; then only vectors that can still reach it are probed, widest bound first.
    """
    at = np.minimum(query * low, query * high)
    bound = np.maximum(query * low, query * high) - at
    order = np.argsort(-bound, kind="stable")
    order = order[bound[order] > 0]
    rest = np.concatenate([np.cumsum(bound[order][::-1])[::-1], [0]])
    alive = np.flatnonzero(ids != own)
    base = int(at.sum())
    if len(alive) <= k:
        return alive, query @ postings[:, alive]
    score, least = np.full(len(alive), 0, np.int64), -1
    probe = max(1, len(order) // 4)
    for n, t in enumerate(order):
        score += query[t] * postings[t, alive] - at[t]
        if n + 1 == probe:
            some = alive[np.argpartition(-score, k)[:k]] if len(alive) > k else alive
            least = max(least, int((query @ postings[:, some]).min()) - base)
        if n + 1 >= probe and n % 4 == 3 and rest[n + 1] < max(1, least):
            stay = score + rest[n + 1] >= least
            if not stay.all():
                alive, score = alive[stay], score[stay]
    score += base
    best = np.lexsort((ids[alive], -score))[:k]
    return alive[best], score[best]


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, shard: int = SHARD, block: int = QUERIES) -> DataFrame:
    """The k rows of ``vectors`` with the highest inner product for each row of ``queries``, both (vec_id, q).

    Returns query_id, rank (from 1), vec_id, score; ties go to the smaller vec_id, a query's
    own id is no candidate, fewer candidates give fewer rows, empty tables none. Repeated
    rows count once; of different vectors under one id the smallest counts. Vectors of unequal
    length are filled with zeros. Null ids and vectors are left out (by ``quantised``). Components and scores beyond a long are set to the
    nearest end of its range, so such scores may tie; products with components too large for exact 64-bit sums are taken in unbounded numbers.

    Vectors are dealt into shards and queries into blocks of bounded size; each pair of a shard
    and a block is one group, which sends k rows a query to the merge.
    """
    one = vectors.groupBy("vec_id").agg(F.min("q").alias("q"))
    asked = queries.groupBy("vec_id").agg(F.min("q").alias("q"))
    spark = vectors.sparkSession
    n, m = vectors.count(), queries.count()
    shards = max(-(-n // shard), min(spark.sparkContext.defaultParallelism * 2, n // 512), 1)
    groups = max(-(-m // block), 1)
    number = F.xxhash64("vec_id")
    dealt = one.select(F.pmod(number, F.lit(shards)).alias("shard"), F.explode(F.expr(f"sequence(0L, {groups - 1}L)")).alias("block"), F.lit(False).alias("asks"), "vec_id", "q")
    blocks = asked.select(F.explode(F.expr(f"sequence(0L, {shards - 1}L)")).alias("shard"), F.pmod(number, F.lit(groups)).alias("block"), F.lit(True).alias("asks"), "vec_id", "q")

    def work(rows: pa.Table) -> pa.Table:
        width = max([0, *(len(x) for x in rows["q"])])
        asks = rows["asks"].to_numpy()
        ids, values = rows["vec_id"].to_numpy(), _matrix(rows["q"], width)
        tame = small(values)
        plain, large = ~asks & tame, ~asks & ~tame
        postings, own = np.ascontiguousarray(values[plain].T), ids[plain]
        beyond, theirs = np.ascontiguousarray(values[large].T), ids[large]
        found: list[tuple] = [(np.zeros(0, np.int64),) * 3]
        low, high = (postings.min(1), postings.max(1)) if width and len(own) else (np.zeros(0, np.int64),) * 2
        for q, v, exact in zip(ids[asks], values[asks], tame[asks]):
            near = []
            if len(own):
                place, score = shard_top(postings, low, high, own, v, q, k) if exact else (slice(None), saturated(postings, v))
                near.append((own[place], score.astype(np.int64)))
            if len(theirs):
                near.append((theirs, saturated(beyond, v)))
            for one, score in near:
                best = np.flatnonzero(one != q)
                best = best[np.lexsort((one[best], ~score[best]))[:k]]
                found.append((np.full(len(best), q, np.int64), one[best], score[best]))
        a, b, c = map(np.concatenate, zip(*found))
        return pa.table({"query_id": a, "vec_id": b, "score": c})

    parts = dealt.union(blocks).groupBy("shard", "block").applyInArrow(work, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return parts.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
