"""Exact top-k inner products by the threshold algorithm.

Candidates are cut into shards where they lie, and a shard keeps, for every dimension, its
rows sorted by that component: a table with a row per shard, made once. Queries pass over it
in blocks, each broadcast, so no vector crosses the network however many blocks there are; a
task hands a query's kth score so far from each of its shards to the next. A query reads
the lists in step, from the top where its own component is positive and from the bottom
where it is negative, and scores each row it meets. The components at the current depth
bound the score of every row not met yet; once that bound is below the kth best score the
query stops; a query whose bound never closes stops once it has met all rows. The tasks'
results are merged, ties going to the smaller id.

Defined cases: vectors that are null or hold null, NaN or infinite components take no part;
missing trailing components count as 0; rows with the query's own id are not its candidates
(a repeated query id is one query for each of its rows' distinct vectors, ranked together);
null ids are candidates (last among ties), never queries; no queries or candidates, no rows.
Components are integers here, so scores are exact; a product sum beyond 64 bits is an error.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripstream.llm.blocks import pack, unpack
from tripstream.llm.common import staged

K = 20
SCALE = 64
SHARD_ROWS = 16_384
#: queries that a task holds at a time
BLOCK_QUERIES = 16_384
FIRST_DEPTH = 16
NONE = np.iinfo(np.int64).max  # stands for a null id, which is last among ties


def scaled(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component, x as a double; null unless all components are finite numbers."""
    x = F.transform(vector, lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(~F.coalesce(bad, F.lit(True)), F.transform(x, lambda v: F.floor(v * scale).cast("long")))


def _matrix(vectors, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _exact_type(a: np.ndarray, b: np.ndarray):
    """The cheapest type in which every inner product is exact."""
    top = max(1, a.shape[1]) * int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0))
    if top >= 1 << 63:
        raise OverflowError("inner products do not fit 64 bits")
    return np.float32 if top < 1 << 24 else np.float64 if top < 1 << 53 else np.int64


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(scores) > k:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= kth)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))][:k]


class Lists:
    """A shard: its vectors and, per dimension, its rows in descending order."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, kind, down: np.ndarray | None = None):
        self.ids, self.x = ids, vectors.astype(kind)
        down = self.sorted(vectors) if down is None else down
        #: [0]: read from the top, [1]: from the bottom
        self.rows = np.stack([down, down[:, ::-1]]).astype(np.int32)
        self.values = np.take_along_axis(vectors.T, down, axis=1)

    @staticmethod
    def sorted(vectors: np.ndarray) -> np.ndarray:
        """Per dimension the rows by descending component."""
        return np.argsort(-vectors, axis=0, kind="stable").T

    def search(self, own: int | None, query: np.ndarray, k: int, least: int | None = None):
        """Places and scores of the best rows, read until the bound closes or all rows were met.

        ``least``: a score that ``k`` rows elsewhere reach; rows below it may be missing.
        """
        n, width = self.x.shape
        used = np.flatnonzero(query)
        side = (query[used] < 0).astype(np.int64)
        w = query.astype(self.x.dtype)
        met = np.zeros(n, bool)
        met[self.ids == own] = True
        places, scores = np.zeros(0, np.int64), np.zeros(0, self.x.dtype)
        depth, step = 0, FIRST_DEPTH
        while len(used) and depth < n and not met.all():
            fresh = np.zeros(n, bool)
            fresh[self.rows[side, used, depth : depth + step]] = True
            fresh &= ~met
            met |= fresh
            new = np.flatnonzero(fresh)
            places, scores = np.concatenate([places, new]), np.concatenate([scores, self.x[new] @ w])
            depth, step = min(n, depth + step), 2 * step
            if len(places) >= k or least is not None:
                at = _best(scores, self.ids[places], k)
                places, scores = places[at], scores[at]
                edge = int((self.values[used, np.where(side == 0, depth - 1, n - depth)] * query[used]).sum())
                if (len(places) >= k and edge < scores[-1]) or (least is not None and edge < least):
                    return places, scores
        if not len(used):  # a query without components: every row scores 0
            places = np.flatnonzero(~met)
            scores = np.zeros(len(places), self.x.dtype)
        at = _best(scores, self.ids[places], k)
        return places[at], scores[at]


def _search(ids, vectors, query_ids, queries, k):
    """(query place, candidate place, score) of each query's k best rows in a shard."""
    kind = _exact_type(vectors, queries)
    lists = Lists(ids, vectors, kind)
    return [(q, p, int(s)) for q in range(len(queries)) for p, s in zip(*lists.search(query_ids[q], queries[q], k))]


def _shards(width: int, limit: int):
    def shard(ids, vectors):
        x = _matrix(vectors, width)
        return pa.RecordBatch.from_arrays([pa.array([pack(np.array(ids, np.int64), x.reshape(-1), Lists.sorted(x).astype(np.int32).reshape(-1))], pa.binary())], ["body"])

    def run(batches):
        ids, vectors = [], []
        for batch in batches:
            for i, v in zip(batch.column("id").to_pylist(), batch.column("v").to_pylist()):
                ids.append(NONE if i is None else i)
                vectors.append(v)
                if len(ids) == limit:
                    yield shard(ids, vectors)
                    ids, vectors = [], []
        if ids:
            yield shard(ids, vectors)

    return run


def _passed(sent, width: int, k: int):
    def run(batches):
        query_ids, queries = sent.value
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(queries)  # ids and scores, best first
        for batch in batches:
            for body in batch.column("body").to_pylist():
                ids, x, down = unpack(body)
                x, ids = x.astype(np.int64).reshape(-1, width), ids.astype(np.int64)
                lists = Lists(ids, x, _exact_type(x, queries), down.reshape(width, -1))
                for q, (own, query) in enumerate(zip(query_ids, queries)):
                    held, scores = best[q]
                    places, fresh = lists.search(own, query, k, int(scores[-1]) if len(scores) == k else None)
                    held, scores = np.concatenate([held, ids[places]]), np.concatenate([scores, fresh.astype(np.int64)])
                    at = _best(scores, held, k)
                    best[q] = held[at], scores[at]
        for q, (held, scores) in enumerate(best):
            if len(held):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(held), query_ids[q])), pa.array(held), pa.array(scores)], ["query_id", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, queries: DataFrame, *, k: int = K, shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score; both frames have id (long) and v (array of long), nulls in v left out."""
    vectors = vectors.where("v IS NOT NULL").select("id", "v")
    queries = staged(queries.where("v IS NOT NULL AND id IS NOT NULL").select("id", "v").distinct(), "topk-queries")
    size = vectors.agg(F.max(F.size("v")).alias("w")).first()
    asked = queries.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("w")).first()
    width = max(size.w or 0, asked.w or 0, 1)
    shards = staged(vectors.mapInArrow(_shards(width, shard_rows), "body binary"), "topk-lists")
    blocks, near = max(1, math.ceil(asked.n / block_queries)), None
    for b in range(blocks):
        own = queries.where(F.pmod(F.xxhash64("id", "v"), F.lit(blocks)) == b).collect()  # bounded: one block
        sent = vectors.sparkSession.sparkContext.broadcast((np.array([r["id"] for r in own], np.int64), _matrix([r["v"] for r in own], width)))
        part = shards.mapInArrow(_passed(sent, width, k), "query_id bigint, vec_id bigint, score bigint")
        if blocks > 1:  # one block's queries at a time
            part = staged(part, "topk-block")
            sent.unpersist()
        near = part if near is None else near.unionByName(part)
    near = near.withColumn("vec_id", F.when(F.col("vec_id") != NONE, F.col("vec_id")))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def report(embeddings: DataFrame, *, every: int = 20, **options) -> DataFrame:
    """Queries: the rows whose vec_id is divisible by ``every``; candidates: all rows."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("id"), scaled(F.col("embedding")).alias("v"))
    return top_k(rows, rows.where(F.col("id") % every == 0), **options)
