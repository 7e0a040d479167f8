"""Exact top-k by inner product: MaxScore over shards of the candidates.

A query's terms are its dimensions. In each block of a shard, a term's score bounds come from the block's own least and
greatest values. Terms are split by these bounds: while the non-essential ones cannot lift a candidate past the
query's k-th best score so far, only essential postings are traversed; the others are probed, widest bound first, for
the candidates that are still competitive. Shards hand on at most k rows a query and the merge ranks them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import read

#: Queries that are broadcast at once; candidates scored as one block.
QUERY_BLOCK, CANDIDATE_BLOCK = 4096, 2048
#: Sums of products below this are exact in doubles.
EXACT = float(2**53)


def integer_vectors(table: DataFrame, scale: int = 1024, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(vec_id, v): floor(scale * x) of each component as long. Null vectors, and vectors holding null or non-finite
    components, are left out; so are null ids."""
    x = F.col(vector).cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return table.where(F.col(vector).isNotNull() & F.col(key).isNotNull() & ~bad).select(
        F.col(key).alias("vec_id"), F.transform(x, lambda c: F.floor(c * F.lit(float(scale))).cast("long")).alias("v")
    )


class Shard:
    """The k best candidates so far for each query of a block."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.q, self.k = ids, vectors, k
        n = len(ids)
        self.scores = np.full((n, 0), 0, dtype=np.int64)
        self.best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in range(n)]

    def add(self, ids: np.ndarray, x: np.ndarray) -> None:
        least, most = x.min(0), x.max(0)
        bound = float(max(abs(int(least.min())), abs(int(most.max())))) * float(np.abs(self.q).max(initial=0)) * x.shape[1]
        x = x.astype(np.float64) if bound < EXACT else x.astype(object) if bound >= 2**62 else x
        postings = np.asfortranarray(x)
        for j, q in enumerate(self.q):
            self._query(j, q, ids, postings, least, most)

    def _query(self, j: int, q: np.ndarray, ids: np.ndarray, x: np.ndarray, least: np.ndarray, most: np.ndarray) -> None:
        kept_scores, kept_ids = self.best[j]
        q = q.astype(x.dtype)
        ends = np.stack([q * least, q * most])
        low, high = ends.min(0), ends.max(0)
        order = np.argsort(-(high - low).astype(float), kind="stable")
        # rest[e]: the most that the terms from the e-th on can add.
        rest = np.concatenate([np.cumsum(high[order][::-1])[::-1], [0]])
        rows = np.arange(len(ids))
        if len(kept_ids) < self.k:
            score = x @ q
        else:
            worst = kept_scores[-1]
            if rest[0] < worst:
                return
            # Essential: the fewest terms without which no candidate reaches the k-th best, the others at their most.
            spread = np.concatenate([np.cumsum((high - low)[order][::-1])[::-1], [0]])
            e = int(np.flatnonzero(low.sum() + spread < worst)[:1].sum()) or len(order)
            step = e
            score = np.zeros(len(ids), dtype=x.dtype)
            at = 0
            while at < len(order) and len(rows):
                terms = order[at : at + step]
                score = score + x[np.ix_(rows, terms)] @ q[terms]
                at, step = at + len(terms), 8
                stay = score + rest[min(at, len(order))] >= worst
                if not stay.all():
                    rows, score = rows[stay], score[stay]
        own = ids[rows] != self.ids[j]
        rows, score = rows[own], score[own]
        if not len(rows):
            return
        if len(rows) > 4 * self.k:
            cut = np.partition(score, len(score) - self.k)[len(score) - self.k]
            rows, score = rows[score >= cut], score[score >= cut]
        all_scores, all_ids = np.concatenate([kept_scores, score.astype(np.int64)]), np.concatenate([kept_ids, ids[rows]])
        top = np.lexsort((all_ids, -all_scores))[: self.k]
        self.best[j] = (all_scores[top], all_ids[top])


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 10, query_block: int = QUERY_BLOCK) -> DataFrame:
    """Each query's ``k`` highest integer inner products: query_id, rank (from 1), vec_id, score; ties to smaller ids.

    Both inputs are (vec_id, v) as ``integer_vectors`` gives them. A row is no candidate of a query with its own id.
    Vectors of another dimension than a query's are no candidates of it; an empty side gives an empty table. Repeated
    candidate rows count once a row. Queries are worked off in blocks of ``query_block``, so that what is broadcast and
    what the driver holds has a fixed bound; each block scans all candidates.
    """
    spark = candidates.sparkSession
    schema = "query_id long, vec_id long, score long"
    sources = candidates.select(F.col("vec_id").cast("long").alias("vec_id"), "v")

    def scan(shared) -> DataFrame:
        def search(batches: Iterator) -> Iterator:
            import pyarrow as pa

            shards = [Shard(ids, vectors, k) for ids, vectors in shared.value]
            for batch in batches:
                for at in range(0, batch.num_rows, CANDIDATE_BLOCK):
                    part = batch.slice(at, CANDIDATE_BLOCK)
                    lists = part.column(1)
                    flat, sizes = lists.flatten().to_numpy(zero_copy_only=False), np.diff(lists.offsets.to_numpy())
                    ids, starts = part.column(0).to_numpy(), np.concatenate([[0], np.cumsum(sizes)])
                    for shard in shards:
                        width = shard.q.shape[1]
                        own = np.flatnonzero(sizes == width)
                        if len(own) and width:
                            shard.add(ids[own], flat[starts[own][:, None] + np.arange(width)].reshape(len(own), width))
            rows = [(q, s, i) for shard in shards for q, (s, i) in zip(shard.ids, shard.best, strict=True) if len(i)]
            if rows:
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([np.full(len(i), q) for q, _, i in rows]), pa.int64()),
                    pa.array(np.concatenate([i for _, _, i in rows]), pa.int64()),
                    pa.array(np.concatenate([s for _, s, _ in rows]), pa.int64()),
                ], names=["query_id", "vec_id", "score"])

        return sources.mapInArrow(search, schema)

    found: DataFrame | None = None
    block: list[tuple[int, list[int]]] = []

    def flush() -> None:
        nonlocal found, block
        by_width: dict[int, list] = {}
        for vec_id, v in block:
            by_width.setdefault(len(v), []).append((vec_id, v))
        shared = [(np.asarray([i for i, _ in x], np.int64), np.asarray([v for _, v in x], np.int64).reshape(len(x), -1)) for x in by_width.values()]
        part = scan(spark.sparkContext.broadcast(shared))
        found = part if found is None else found.unionByName(part)
        block = []

    for r in queries.select(F.col("vec_id").cast("long"), "v").distinct().toLocalIterator():
        block.append((r[0], r[1]))
        if len(block) >= query_block:
            flush()
    if block or found is None:
        flush()
    ranked = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = integer_vectors(read(spark, sf_dir, "embeddings"))
    return top_k(vectors.where(F.col("vec_id") % 100 == 0), vectors)


QUERIES = {"op7_top_k": op7_top_k}
ORACLE = {
    "op7_top_k": """
        WITH v AS (
          SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
          WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
          SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                 CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
          FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
        SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM s
        WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 10"""
}
