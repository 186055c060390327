"""Ranked lexical search: a K2-treap over the term-document grid.

Documents are cut into shards of about ``shard_points`` (term, document) pairs. A shard is a
grid with a row per term and a column per document; each pair is a point that carries its
impact, the part of the score that does not depend on the query. The grid is stored as a
compressed quadtree: cells with one occupied quadrant are skipped, every other cell keeps the
largest impact inside it. A query descends from the whole grid, all its rows jointly: a state
is a range of documents with, per row, the smallest cell that covers the row there; its bound
is the weighted sum of these cells' maxima. States are split best-first until no bound reaches
the kth score found so far. That score is carried from shard to shard within a task.

The index is a table, a row per shard (``build``); ``search`` reads it for any set of items.

Defined cases: a null, empty or termless text is no document and never found; each row is a
document, so rows with one doc_id are ranked one by one; a null doc_id comes after others;
rows of items that share an item_id are one item with the terms of all; equal scores rank by
doc_id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripstream.llm.blocks import pack, unpack
from tripstream.llm.common import pieces, staged, work_path

SHARD_POINTS = 1 << 16
K = 10
#: best states of each item that are split at a time
BEAM = 8
#: (item, term) pairs that a task holds at a time
BLOCK_PAIRS = 500_000
#: of which so many descend together through one shard
GROUP_PAIRS = 2_000

#: A-Z to a-z, every ASCII byte that is no letter or digit to a blank
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))

#: ``body``: the ids (with a mark where null) and the arrays of the treap, packed
INDEX = "height int, terms array<string>, df array<int>, body binary"


def terms_of(raw: bytes | None) -> list[bytes]:
    return raw.translate(_TERMS).split() if raw else []


def _spread(x: np.ndarray) -> np.ndarray:
    """A zero bit behind each bit."""
    x = x.astype(np.int64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << shift)) & mask
    return x


def _gathered(x: np.ndarray) -> np.ndarray:
    x = x & 0x5555555555555555
    for shift, mask in ((1, 0x3333333333333333), (2, 0x0F0F0F0F0F0F0F0F), (4, 0x00FF00FF00FF00FF), (8, 0x0000FFFF0000FFFF), (16, 0x00000000FFFFFFFF)):
        x = (x | (x >> shift)) & mask
    return x


class Treap:
    """Compressed quadtree: points (nodes 0..p-1 in Morton order), then cells with two or more occupied quadrants."""

    def __init__(self, height, steps, impacts, levels, firsts, kids, peaks):
        codes = np.cumsum(steps, dtype=np.int64)
        self.height, self.kids, self.points = height, kids.astype(np.int32).reshape(-1, 4) - 1, len(codes)
        self.level = np.concatenate([np.zeros(len(codes), np.int8), levels])
        self.peak = np.concatenate([impacts, peaks])
        first = np.concatenate([np.arange(len(codes), dtype=np.int32), firsts])
        self.row, self.col = _gathered(codes >> 1).astype(np.int32)[first], _gathered(codes).astype(np.int32)[first]
        self.root = len(self.level) - 1

    @classmethod
    def build(cls, rows: np.ndarray, cols: np.ndarray, impacts: np.ndarray, height: int) -> tuple[np.ndarray, ...]:
        """The arrays that a treap is made from."""
        codes = _spread(rows) << 1 | _spread(cols)
        order = np.argsort(codes)
        codes, impacts = codes[order], impacts[order].astype(np.int32)
        at, node, peak, first = codes, np.arange(len(codes), dtype=np.int32), impacts, np.arange(len(codes), dtype=np.int32)
        made, levels, firsts, kids, peaks = len(codes), [], [], [], []
        for level in range(1, height + 1):
            if len(at) == 1:
                break
            up = at >> 2
            starts = np.flatnonzero(np.concatenate([[True], up[1:] != up[:-1]]))
            sizes = np.diff(np.append(starts, len(up)))
            many = sizes > 1
            if many.any():
                group = np.cumsum(many) - 1
                inside = np.repeat(many, sizes)
                new = np.full((int(many.sum()), 4), -1, np.int32)
                new[np.repeat(group, sizes)[inside], at[inside] & 3] = node[inside]
                top = np.maximum.reduceat(peak, starts)
                node, first = node[starts], first[starts]
                node[many] = made + np.arange(len(new), dtype=np.int32)
                made += len(new)
                levels.append(np.full(len(new), level, np.int8))
                firsts.append(first[many])
                kids.append(new)
                peaks.append(top[many])
                peak = top
            else:
                node, first, peak = node[starts], first[starts], peak[starts]
            at = up[starts]
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        # codes by their differences; 0 for no child
        kids = join(kids, np.int32).reshape(-1)
        return np.diff(codes, prepend=0), impacts, join(levels, np.int8), join(firsts, np.int32), kids + 1, join(peaks, np.int32)

    def covers(self, node: np.ndarray, row: np.ndarray) -> np.ndarray:
        level = self.level[node]
        return self.row[node] >> level == row >> level

    def halves(self, node: np.ndarray, row: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For nodes inside cells of side 2^level: the node in the left and in the right half of the columns (-1: none)."""
        own = self.level[node] == level
        side = self.col[node] >> (level - 1) & 1
        out = []
        for h in (0, 1):
            to = np.where(~own & (side == h), node, np.int32(-1))
            if own.any():
                kid = self.kids[node[own] - self.points, 2 * (row[own] >> (level[own] - 1) & 1) + h]
                there = kid >= 0
                there[there] = self.covers(kid[there], row[own][there])
                to[own] = np.where(there, kid, -1)
            out.append(to)
        return out[0], out[1]


def best_first(tree: Treap, item: np.ndarray, row: np.ndarray, weight: np.ndarray, least: np.ndarray):
    """Documents (item, column, score) that may be among the best, best-first per item.

    ``item``, ``row``, ``weight``: the query terms found in this shard. ``least``: by item, the
    score to reach; the caller raises it between the yields.
    """
    def bounds(n: int) -> np.ndarray:  # whole numbers far below 2^53
        return np.bincount(state, weight * tree.peak[node].astype(float), n).astype(np.int64)

    row, node = row.astype(np.int32), np.full(len(row), tree.root, np.int32)
    ok = tree.covers(node, row)
    item, row, weight, node = item[ok], row[ok], weight[ok], node[ok]
    owner, state = np.unique(item, return_inverse=True)
    owner, state = owner.astype(np.int32), state.astype(np.int32)
    low, level = np.zeros(len(owner), np.int32), np.full(len(owner), tree.height, np.int8)
    bound = bounds(len(owner))
    while len(owner):
        rank = np.lexsort((low, -bound, owner))
        sorted_owner = owner[rank]
        place = np.empty(len(owner), np.int64)
        starts = np.flatnonzero(np.concatenate([[True], sorted_owner[1:] != sorted_owner[:-1]]))
        place[rank] = np.arange(len(owner)) - np.repeat(starts, np.diff(np.append(starts, len(owner))))
        chosen = place < BEAM
        found = chosen & (level == 0)
        if found.any():
            yield owner[found], low[found], bound[found]
        split, rest = chosen & ~found, ~chosen
        # what is left, then the left and the right halves of what is split
        pieces, terms = [(owner[rest], low[rest], level[rest])], []
        renumber = np.cumsum(rest, dtype=np.int32) - 1
        mine = rest[state]
        terms.append((renumber[state[mine]], row[mine], weight[mine], node[mine]))
        mine = split[state]
        s, r, w, n = state[mine], row[mine], weight[mine], node[mine]
        left, right = tree.halves(n, r, level[s])
        renumber, count, base = np.cumsum(split, dtype=np.int32) - 1, int(split.sum()), int(rest.sum())
        for h, to in enumerate((left, right)):
            pieces.append((owner[split], low[split] + np.left_shift(h, level[split] - 1, dtype=np.int32), level[split] - 1))
            there = to >= 0
            terms.append((base + h * count + renumber[s[there]], r[there], w[there], to[there]))
        owner, low, level = (np.concatenate(x) for x in zip(*pieces))
        state, row, weight, node = (np.concatenate(x) for x in zip(*terms))
        bound = bounds(len(owner))
        keep = (bound > 0) & (bound >= least[owner])
        if not keep.all():
            mine = keep[state]
            state, row, weight, node = (np.cumsum(keep, dtype=np.int32) - 1)[state[mine]], row[mine], weight[mine], node[mine]
            owner, low, level, bound = owner[keep], low[keep], level[keep], bound[keep]


def _counted(batches):
    docs = words = 0
    for batch in pieces(batches):
        for raw in batch.column("text").cast(pa.binary()).to_pylist():
            n = len(terms_of(raw))
            docs += n > 0
            words += n
    yield pa.RecordBatch.from_arrays([pa.array([docs], pa.int64()), pa.array([words], pa.int64())], ["docs", "words"])


def _shards(n_docs: int, n_words: int, limit: int):
    def row(vocabulary, docs):
        docs.sort(key=lambda d: d[1])  # columns by length: neighbours have like impacts
        names = sorted(vocabulary)
        place = np.empty(len(names), np.int64)
        place[[vocabulary[t] for t in names]] = np.arange(len(names))
        sizes = [len(d[2]) for d in docs]
        rows, tf = place[np.concatenate([d[2] for d in docs])], np.concatenate([d[3] for d in docs])
        m = np.repeat(np.array([10 + 90 * d[1] * n_docs // n_words for d in docs], np.int64), sizes)
        impacts = 1_000_000_000 * tf // (1000 * tf + 8 * m)
        height = max(len(names) - 1, len(docs) - 1, 1).bit_length()
        tree = Treap.build(rows, np.repeat(np.arange(len(docs)), sizes), impacts, height)
        ids = [np.array([d[0] or 0 for d in docs], np.int64), np.array([d[0] is None for d in docs], np.uint8)]
        arrays = [pa.array([height], pa.int32()), pa.array([[t.decode() for t in names]], pa.list_(pa.string())),
                  pa.array([np.bincount(rows, minlength=len(names))], pa.list_(pa.int32())), pa.array([pack(*ids, *tree)], pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, ["height", "terms", "df", "body"])

    def run(batches):
        vocabulary, docs, points = {}, [], 0
        for batch in pieces(batches):
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                words = terms_of(raw)
                if not words:
                    continue
                tf: dict[bytes, int] = {}
                for w in words:
                    tf[w] = tf.get(w, 0) + 1
                if docs and points + len(tf) > limit:
                    yield row(vocabulary, docs)
                    vocabulary, docs, points = {}, [], 0
                ids = np.fromiter((vocabulary.setdefault(t, len(vocabulary)) for t in tf), np.int64, len(tf))
                docs.append((doc_id, len(words), ids, np.fromiter(tf.values(), np.int64, len(tf))))
                points += len(tf)
        if docs:
            yield row(vocabulary, docs)

    return run


class Index:
    """The stored shards and the two totals that their impacts are computed with."""

    def __init__(self, shards: DataFrame, n_docs: int, n_words: int):
        self.shards, self.n_docs, self.n_words = shards, n_docs, n_words


def build(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shard_points: int = SHARD_POINTS) -> Index:
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    total = rows.select("text").mapInArrow(_counted, "docs bigint, words bigint").agg(F.sum("docs").alias("docs"), F.sum("words").alias("words")).first()
    n_docs, n_words = total["docs"] or 0, total["words"] or 0
    path = work_path(docs.sparkSession, "term-document-grid")
    # few long rows: groups of rows are cut by size, not by number
    made = rows.mapInArrow(_shards(n_docs, max(n_words, 1), shard_points), INDEX)
    made.write.option("parquet.block.size", 8 << 20).option("parquet.block.size.row.check.min", 1).parquet(path)
    return Index(docs.sparkSession.read.schema(made.schema).parquet(path), n_docs, n_words)


def weighted(index: Index, items: DataFrame, *, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """item_id, term, weight: the distinct terms of every item that some document holds."""

    def split(batches):
        for batch in batches:
            pairs = [(i, t.decode()) for i, raw in zip(batch.column("item_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()) for t in set(terms_of(raw))]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in pairs], batch.column("item_id").type), pa.array([t for _, t in pairs], pa.string())], ["item_id", "term"])

    rows = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))
    kind = rows.schema["item_id"].dataType.simpleString()
    pairs = staged(rows.mapInArrow(split, f"item_id {kind}, term string").distinct(), "item-terms")
    held = index.shards.select(F.explode(F.arrays_zip("terms", "df")).alias("x")).select(F.col("x.terms").alias("term"), F.col("x.df").alias("df"))
    df = held.join(pairs.select("term").distinct(), "term").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(float(2 * index.n_docs + 2)) / (2 * F.col("df") + 1).cast("double")))
    return pairs.join(df, "term").select("item_id", "term", weight.cast("long").alias("weight"))


def _searched(queries, k: int):
    """``queries``: broadcast (terms, and per pair the item number, the term's number and the weight)."""

    def run(batches):
        names, item, term, weight, n_items = queries.value
        least, best = np.zeros(n_items, np.int64), [[] for _ in range(n_items)]
        for batch in batches:
            for i in range(batch.num_rows):
                ids, missing, *arrays = unpack(batch.column("body")[i].as_py())
                tree = Treap(batch.column("height")[i].as_py(), *arrays)
                rows = pc.index_in(names, value_set=batch.column("terms")[i].values).to_numpy(zero_copy_only=False)
                at = rows[term]
                held = np.flatnonzero(~np.isnan(at)) if at.dtype.kind == "f" else np.arange(len(at))
                cuts = np.flatnonzero(np.diff(item[held], prepend=-1))  # pairs are sorted by item
                group = [0]
                for c, e in zip(cuts, [*cuts[1:], len(held)]):
                    if e - group[-1] > GROUP_PAIRS and c > group[-1]:
                        group.append(int(c))
                for a, b in zip(group, [*group[1:], len(held)]):
                    part = held[a:b]
                    for owners, cols, scores in best_first(tree, item[part], at[part].astype(np.int64), weight[part], least):
                        for o, c, s in zip(owners.tolist(), cols.tolist(), scores.tolist()):
                            d = None if missing[c] else int(ids[c])
                            best[o] = sorted([*best[o], (-s, d is None, d or 0, d)])[:k]
                            if len(best[o]) == k:
                                least[o] = -best[o][-1][0]
        flat = [(o, x[3], -x[0]) for o, found in enumerate(best) for x in found]
        o, d, s = zip(*flat) if flat else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(o, pa.int64()), pa.array(d, pa.int64()), pa.array(s, pa.int64())], ["item", "doc_id", "score"])

    return run


def search(index: Index, items: DataFrame, *, item_id: str = "item_id", text: str = "text", k: int = K, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of every item.

    Items go to the tasks in blocks of about ``block_pairs`` terms, whatever their number.
    """
    spark = index.shards.sparkSession
    pairs = staged(weighted(index, items, item_id=item_id, text=text).where("weight > 0"), "weighted-terms")
    kind = pairs.schema["item_id"].dataType.simpleString()
    blocks = max(1, math.ceil(pairs.count() / block_pairs))
    found = None
    for b in range(blocks):
        own = pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).collect()  # bounded: one block
        ids = sorted({r["item_id"] for r in own}, key=lambda x: (x is None, x))
        number, names = {x: i for i, x in enumerate(ids)}, sorted({r["term"] for r in own})
        place = {t: i for i, t in enumerate(names)}
        own.sort(key=lambda r: number[r["item_id"]])
        sent = spark.sparkContext.broadcast((pa.array(names, pa.string()), np.array([number[r["item_id"]] for r in own], np.int64),
                                             np.array([place[r["term"]] for r in own], np.int64), np.array([r["weight"] for r in own], np.int32), len(ids)))
        hits = index.shards.select("height", "terms", "body").mapInArrow(_searched(sent, k), "item bigint, doc_id bigint, score bigint")
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        top = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        labels = spark.createDataFrame(list(enumerate(ids)), f"item bigint, item_id {kind}")
        part = top.join(labels, "item").select("item_id", "rank", "doc_id", "score")
        if blocks > 1:
            part = staged(part, "ranked")
            sent.unpersist()
        found = part if found is None else found.unionByName(part)
    return found


def report(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", k: int = K, **options) -> DataFrame:
    return search(build(docs, doc_id=doc_id, text=text, **options), items, item_id=item_id, text=text, k=k)
