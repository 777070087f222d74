"""Exact top-k inner-product search by MaxScore over shards of postings."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqspark.llm.common import settle

# Vectors of a shard and queries of a block, on average.
SHARD = 8_192
QUERY_BLOCK = 1_024

SCALE = 64

# Terms whose contributions are added at a time.
STEP = 16


class Postings:
    """Impact-ordered postings of a shard of integer vectors.

    A term is a dimension with a sign. Shifted by the shard's smallest (or, for the negative sign, largest)
    value, its weights are not negative, and a query's score is a constant plus a sum of products that are
    not negative either. Rows of weight 0 are not in a term's list.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.low, self.high = self.vectors.min(axis=0), self.vectors.max(axis=0)
        # Term t < d: dimension t, weights above the smallest value. Term d + t: below the largest.
        # Held as doubles, in which whole numbers below 2**53 add and multiply exactly.
        self.weights = np.ascontiguousarray(np.concatenate([(self.vectors - self.low).T, (self.high - self.vectors).T]), dtype=np.float64)
        self.most = self.weights.max(axis=1)
        # Lists are made when a query first opens them.
        self._lists: dict[int, np.ndarray] = {}

    def rows(self, term: int) -> np.ndarray:
        """Rows of a term's list, heaviest first."""
        if term not in self._lists:
            weight = self.weights[term]
            order = np.argsort(-weight, kind="stable")
            self._lists[term] = order[: np.count_nonzero(weight)].astype(np.int32)
        return self._lists[term]

    def search(self, query: np.ndarray, k: int, own: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best rows but ``own``, ties to the smaller id."""
        d = len(query)
        terms = np.where(query >= 0, np.arange(d), np.arange(d) + d)[query != 0]
        factors = np.abs(query)[query != 0].astype(np.float64)
        base = int(np.where(query >= 0, query * self.low, query * self.high).sum())
        bounds = factors * self.most[terms]
        order = np.argsort(-bounds, kind="stable")
        terms, factors, bounds = terms[order], factors[order], bounds[order]
        # What the terms from each one on can still add.
        rest = np.concatenate([np.cumsum(bounds[::-1])[::-1], [0]])
        allowed = self.ids != own if own is not None else np.ones(len(self.ids), dtype=bool)

        # A first threshold: true scores of the heaviest rows of the leading terms.
        first = np.unique(np.concatenate([self.rows(int(t))[: 4 * k] for t in terms[:4]])) if len(terms) else np.zeros(0, np.int32)
        first = first[allowed[first]]
        least = None
        if len(first) >= k:
            scores = self.vectors[first] @ query
            least = int(np.partition(scores, len(scores) - k)[len(scores) - k])

        # Essential terms: a row in none of their lists stays below the threshold.
        essential = len(terms) if least is None else int(np.searchsorted(-rest, base - least, side="right"))
        essential = min(essential, len(terms))
        if least is None or base + rest[essential] >= least:
            rows = np.flatnonzero(allowed)
        else:
            seen = np.zeros(len(self.ids), dtype=bool)
            for t in terms[:essential]:
                listed = self.rows(int(t))
                seen[listed] = True
                if len(listed) == len(self.ids):
                    break
            rows = np.flatnonzero(seen & allowed)
        scores = np.full(len(rows), base, dtype=np.float64)
        for at in range(0, len(terms), STEP):
            stop = min(at + STEP, len(terms))
            listed = self.weights[terms[at:stop]]
            # Whole lists while most rows are alive, else the weights of those alone.
            part = factors[at:stop] @ listed if len(rows) == len(self.ids) else factors[at:stop] @ listed[:, rows]
            scores += part
            if len(scores) > k:
                if least is None or at == 0:
                    reached = int(np.partition(scores, len(scores) - k)[len(scores) - k])
                    least = reached if least is None else max(least, reached)
                alive = scores + rest[stop] >= least
                rows, scores = rows[alive], scores[alive]
        scores = scores.astype(np.int64)
        best = np.lexsort((self.ids[rows], -scores))[:k]
        return self.ids[rows[best]], scores[best]


def quantised(table: DataFrame, vec_id: str, vector: str, scale: float) -> DataFrame:
    """``id, v`` of usable vectors, each component floor(scale * x); one row per id and vector."""
    x = F.col(vector)
    usable = x.isNotNull() & F.col(vec_id).isNotNull() & ~F.exists(
        x, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf"))
    )
    return table.where(F.coalesce(usable, F.lit(False))).select(
        F.col(vec_id).cast("bigint").alias("id"),
        F.transform(x, lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("bigint")).alias("v"),
    ).distinct()


def search_top_k(
    table: DataFrame, query_every: int = 20, k: int = 20, scale: float = SCALE, shard: int = SHARD, block: int = QUERY_BLOCK,
    vec_id: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """Exact ``k`` best rows for every query, a row whose id is divisible by ``query_every``.

    Returns ``query_id, rank, vec_id, score``. Vectors fall into shards and queries into blocks by hash; each
    pair of a shard and a block is one task's work, and the shards' best rows are merged. A vector that is
    null or holds a null, NaN or infinity takes no part, nor does a row without an id. Repeated rows count
    once; different vectors under one id are rows of their own, none of which is an answer to that id.
    Missing components of a shorter vector count as 0; an empty vector scores 0. Ties go to the smaller id.
    """
    rows = settle(quantised(table, vec_id, vector, scale))
    total, widest = rows.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    queries = rows.where(F.col("id") % query_every == 0)
    shards, blocks = max(1, -(-total // shard)), max(1, -(-(total // query_every) // block))
    width = max(1, widest or 0)
    hashed = F.xxhash64("id", "v")
    left = rows.select(
        "id", "v", F.pmod(hashed, F.lit(shards)).cast("int").alias("shard"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
    )
    right = queries.select(
        F.col("id").alias("query_id"), F.col("v").alias("q"),
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
        F.pmod(hashed, F.lit(blocks)).cast("int").alias("block"),
    )

    def matrix(values: pd.Series) -> np.ndarray:
        out = np.zeros((len(values), width), dtype=np.int64)
        for i, v in enumerate(values):
            out[i, : len(v)] = v
        return out

    def search(vectors: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(vectors) and len(asked):
            postings = Postings(vectors["id"].to_numpy(), matrix(vectors["v"]))
            for query_id, q in zip(asked["query_id"], matrix(asked["q"]), strict=True):
                ids, scores = postings.search(q, k, query_id)
                found.append(pd.DataFrame({"query_id": query_id, "query": [q.tolist()] * len(ids), "vec_id": ids, "score": scores}))
        if not found:
            return pd.DataFrame({"query_id": [], "query": [], "vec_id": [], "score": []})
        return pd.concat(found, ignore_index=True)

    keys = ["shard", "block"]
    best = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        search, "query_id bigint, query array<bigint>, vec_id bigint, score bigint"
    )
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )


def top_k_sql(query_every: int, k: int, scale: int, embeddings: str = "embeddings") -> str:
    """The rows of ``search_top_k`` over vectors of one length without odd components and repeated ids."""
    return f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)) AS v FROM {embeddings}),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % {query_every} = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= {k}"""
