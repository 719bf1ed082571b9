"""Exact top-k search by inner product, by aggregation of sorted lists without random access.

Each block of vectors has two sorted lists per component, the ascending and the descending one. A query reads, in
rounds, the list of each component in the order of falling contribution (descending for positive weights, ascending for
negative ones). What it has read of a candidate plus the list's far end for the rest is a lower bound of the score, plus
the list's current front an upper bound. Reading stops when at most ``few`` candidates have an upper bound that reaches
the k-th best lower bound; their final scores are resolved from the rest of the lists. The k best per block are merged.

Vectors are integers floor(scale * x). Defined cases: null vectors, vectors with null or non-finite components and rows
without id take no part; missing components of a shorter vector are 0; repeated rows are candidates each (equal ones are
scored once), equal queries are asked once; rows that share an id are not candidates of each other; ties go to the smaller id; fewer than k candidates give all of them; empty tables
give no rows. Other columns are not read.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tabulon.llm.common import stored, table

K, SCALE = 5, 256
BLOCK, QUERY_BLOCK = 4096, 512
#: Parts of the lists that have been read after each round.
ROUNDS = (1 / 16, 1 / 8, 1 / 4, 1 / 2, 1)


def integers(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component as an array of longs."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def best_of_block(vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int, few: int = 64):
    """(query index, candidate index, score) of each query's k best candidates of one block of integer vectors."""
    n = len(ids)
    order = np.argsort(vectors, axis=0, kind="stable")
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(n)[:, None], axis=0)
    lists = np.take_along_axis(vectors, order, axis=0)  # ascending; read from the end it is the descending list
    low, high = lists[0], lists[-1]
    up, down = np.maximum(queries, 0).T, np.minimum(queries, 0).T
    own = ids[:, None] == query_ids[None, :]
    open_, found = np.arange(len(queries)), []
    for part in ROUNDS:
        read = max(1, int(np.ceil(part * n)))
        from_top, from_bottom = rank >= n - read, rank < read
        bound = lambda at_top, at_bottom: (np.where(from_top, vectors, at_top) @ up[:, open_]
                                           + np.where(from_bottom, vectors, at_bottom) @ down[:, open_])
        upper, lower = bound(lists[n - read], lists[read - 1]), bound(low, high)
        mine = own[:, open_]
        upper[mine], lower[mine] = -np.inf, -np.inf
        kth = np.partition(lower, max(n - k, 0), axis=0)[max(n - k, 0)]
        alive = (upper >= kth) & ~mine
        done = (alive.sum(axis=0) <= few) | (read == n)
        for c in np.flatnonzero(done):
            q, rows = open_[c], np.flatnonzero(alive[:, c])
            score = vectors[rows] @ queries[q]
            best = np.lexsort((ids[rows], -score))[:k]
            found.append((np.full(len(best), q), rows[best], score[best]))
        open_ = open_[~done]
        if not len(open_):
            break
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.array([], int),) * 3


def top_k(vectors: DataFrame, queries: DataFrame, id_column: str = "vec_id", vector: str = "embedding", k: int = K,
          scale: int = SCALE, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k candidates of ``vectors`` with the highest score for each row of ``queries``."""
    def clean(df):
        return (df.where(F.col(id_column).isNotNull() & usable(F.col(vector)))
                .select(F.col(id_column).cast("long").alias("id"), integers(F.col(vector), scale).alias("v"))
                .groupBy("id", "v").agg(F.least(F.count("*"), F.lit(k)).cast("int").alias("copies")))  # more cannot be among k
    rows, asked = stored(clean(vectors), "topk-vectors"), stored(clean(queries).drop("copies"), "topk-queries")
    n, width = rows.agg(F.count("*"), F.max(F.size("v"))).first()
    m, query_width = asked.agg(F.count("*"), F.max(F.size("v"))).first()
    width = max(width or 0, query_width or 0)
    blocks, query_blocks = -(-max(n, 1) // block), -(-max(m, 1) // query_block)
    spread = lambda count: F.pmod(F.xxhash64("id", "v"), F.lit(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    left = rows.withColumn("block", spread(blocks)).withColumn("query_block", every(query_blocks))
    right = asked.withColumn("query_block", spread(query_blocks)).withColumn("block", every(blocks))

    def search(v: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if not len(v) or not len(q):
            return pd.DataFrame({"query_id": [], "query_key": [], "vec_id": [], "score": []})
        ids, query_ids = v["id"].to_numpy(), q["id"].to_numpy()
        found = best_of_block(_matrix(v["v"], width), ids, _matrix(q["v"], width), query_ids, k)
        a, b, score = (np.repeat(x, v["copies"].to_numpy()[found[1]]) for x in found)
        return pd.DataFrame({"query_id": query_ids[a], "query_key": q["key"].to_numpy()[a], "vec_id": ids[b],
                             "score": score.astype("int64")})

    found = (left.groupBy("block", "query_block").cogroup(right.withColumn("key", F.xxhash64("id", "v")).groupBy("block", "query_block"))
             .applyInPandas(search, "query_id long, query_key long, vec_id long, score long"))
    place = F.row_number().over(Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op1_top_k(spark, folder):
    vectors = table(spark, folder, "embeddings")
    return top_k(vectors, vectors.where("vec_id % 50 = 0"))


SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score, q.v AS asked
      FROM (SELECT DISTINCT * FROM v) q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT query_id, (row_number() OVER (PARTITION BY query_id, asked ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 5"""
