"""SimHash near-duplicates with pivot distance tables.

Fingerprint: one bit per position of the shingle hashes, set where over half of the
hashes have it. Copies share a fingerprint, so everything after works on distinct ones.

Linking is exact. Fingerprints that differ in at most ``bits`` positions agree on
``BLOCKS - bits`` of ``BLOCKS`` bit blocks, so each is dealt to one bucket for every such
choice of blocks and linked fingerprints meet in a bucket. A bucket of more than
``CELL`` is cut into sub-blocks, and each pair of sub-blocks is a task's work of its own.
Within a cell, a table of Hamming distances to ``PIVOTS`` reference fingerprints is
computed; by the triangle inequality a pair whose distances to some reference differ by
more than ``bits`` cannot be linked and is discarded; survivors are verified. A cell
gives back a spanning forest of its links, never all of its pairs.

Defined cases: a null or empty text, or one of white space alone, has fingerprint 0 and
links like any other; texts shorter than a shingle are one shingle; repeated rows (and
repeated ids) are rows of their own; a null id never becomes a component's id unless the
component has no other; an empty table gives no rows; other columns are ignored, or
carried by ``survivors``.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstream.llm.common import carried, ddl, extended, staged
from tripstream.llm.components import labels, stars

WORDS = 3
SEED = 42
BITS = 3
BLOCKS = 5
PIVOTS = 24
CELL = 1024
PAIRS_AT_ONCE = 2_000_000


def fingerprint(text: str | None, words: int = WORDS) -> int:
    from xxhash import xxh64_intdigest

    w = text.encode("utf-8", "surrogatepass").lower().split() if isinstance(text, str) else []
    if not w:
        return 0
    n = max(1, len(w) - words + 1)
    count = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        part = zip(*(w[at + k : min(at + (1 << 16), n) + k] for k in range(min(words, len(w)))))
        h = np.array([xxh64_intdigest(s, SEED) for s in map(b" ".join, part)], "<u8")
        count += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(count * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, *, text: str = "text", keep: list[str] | None = None, words: int = WORDS) -> DataFrame:
    """The columns of ``keep`` (all by default) with ``_fp``, the fingerprint as a signed long."""
    frame, inner, names = carried(docs)
    keep = names if keep is None else keep
    kept = frame.select(*[inner[names.index(c)] for c in keep])
    columns, key = kept.columns, inner[names.index(text)]

    def run(batches):
        for batch in batches:
            prints = np.array([fingerprint(t, words) for t in batch.column(key).to_pylist()], np.uint64)
            yield extended(batch, columns, _fp=pa.array(prints.view(np.int64)))

    return frame.mapInArrow(run, f"{ddl(kept.schema)}, _fp bigint").toDF(*keep, "_fp")


def _masks(bits: int) -> list[int]:
    """One mask for each choice of bit blocks that a linked pair may have in common."""
    edges = [64 * k // BLOCKS for k in range(BLOCKS + 1)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(blocks, BLOCKS - bits)]


def references(n: int = PIVOTS) -> np.ndarray:
    """Fixed, spread-out reference fingerprints (multiples of the golden ratio, mixed)."""
    x = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def linked(fps: np.ndarray, side: np.ndarray, bits: int, pivots: np.ndarray) -> np.ndarray:
    """Label of each fingerprint of a cell: the first of its linked group.

    ``side`` tells the two sub-blocks of a cell apart (pairs within one side are another
    cell's work); where all are alike every pair is looked at.
    """
    n = len(fps)
    table = np.bitwise_count(fps[:, None] ^ pivots[None, :]).astype(np.int8)
    order = np.argsort(table[:, 0], kind="stable")
    fps, side, table = fps[order], side[order], table[order]
    two = side.min() != side.max()
    last = np.searchsorted(table[:, 0], table[:, 0] + bits, "right")
    label = np.arange(n)
    at = 0
    while at < n:
        size = np.cumsum(last[at:] - np.arange(at + 1, n + 1))
        stop = at + max(1, int(np.searchsorted(size, PAIRS_AT_ONCE)))
        own = np.arange(at, min(stop, n))
        many = last[own] - own - 1
        i = np.repeat(own, many)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(many) - many, many)
        if two:
            keep = side[i] != side[j]
            i, j = i[keep], j[keep]
        for p in range(1, table.shape[1]):
            if not len(i):
                break
            keep = np.abs(table[i, p] - table[j, p]) <= bits
            i, j = i[keep], j[keep]
        keep = np.bitwise_count(fps[i] ^ fps[j]) <= bits
        i, j = i[keep], j[keep]
        if len(i):
            # joined through the labels so far, so that blocks add up
            label = labels(np.concatenate([i, np.arange(n)]), np.concatenate([j, label]), n)
        at = stop
    out = np.empty(n, np.int64)
    out[order] = order[label]
    return out


def links(distinct: DataFrame, bits: int = BITS, cell: int = CELL) -> DataFrame:
    """(a, b): links that connect whatever fingerprints of ``distinct`` (column ``_fp``) are linked."""
    dealt = distinct.select("_fp", F.explode(F.array(*[
        F.struct(F.lit(t).alias("t"), F.col("_fp").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m)).alias("k"))
        for t, m in enumerate(_masks(bits))])).alias("x")).select("_fp", "x.t", "x.k")
    sizes = staged(dealt.groupBy("t", "k").agg(F.count("*").alias("n")).where("n > 1"), "simhash-buckets")
    shared = dealt.join(sizes, ["t", "k"]).withColumn("s", F.ceil(F.col("n") / cell).cast("int"))
    shared = shared.withColumn("i", F.pmod(F.xxhash64("_fp"), F.col("s")).cast("int"))
    cells = shared.select("t", "k", "_fp", "i", F.explode(F.sequence(F.lit(0), F.col("s") - 1)).alias("j"))
    # a stated number of partitions is not merged by size: cells are small but take time
    tasks = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = cells.select("t", "k", F.least("i", "j").alias("lo"), F.greatest("i", "j").alias("hi"), "_fp", "i").repartition(tasks, "t", "k", "lo", "hi")
    cells = cells.groupBy("t", "k", "lo", "hi").agg(F.collect_list("_fp").alias("fps"), F.collect_list("i").alias("sides"))
    pivots = references()

    def compare(batches):
        for pdf in batches:
            a, b = [], []
            for fps, sides in zip(pdf["fps"], pdf["sides"]):
                fps = np.asarray(fps, np.int64)
                label = linked(fps.view(np.uint64), np.asarray(sides), bits, pivots)
                at = np.flatnonzero(label != np.arange(len(fps)))
                a.append(fps[at])
                b.append(fps[label[at]])
            yield pd.DataFrame({"a": np.concatenate(a) if a else [], "b": np.concatenate(b) if b else []}, dtype="int64")

    return cells.select("fps", "sides").mapInPandas(compare, "a bigint, b bigint")


def components(distinct: DataFrame, bits: int = BITS) -> DataFrame:
    """``_root`` for every row of ``distinct`` (staged, one per ``_fp``), its columns kept."""
    star = stars(links(distinct, bits))
    joined = distinct.join(star, distinct["_fp"] == star["node"], "left")
    return joined.select(*[distinct[c] for c in distinct.columns], F.coalesce("root", "_fp").alias("_root"))


def report(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, bits: int = BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable)."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    prints = staged(fingerprints(rows, keep=["doc_id"], words=words), "simhash-prints")
    least = staged(prints.groupBy("_fp").agg(F.min("doc_id").alias("d")), "simhash-least")
    roots = staged(components(least, bits), "simhash-roots")
    ids = staged(roots.groupBy("_root").agg(F.min("d").alias("component_id")), "simhash-ids")
    of_print = staged(roots.join(ids, "_root").select("_fp", "component_id"), "simhash-of-print")
    return prints.join(of_print, "_fp").select("doc_id", F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), "component_id")


def survivors(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, bits: int = BITS) -> DataFrame:
    """One document of each group of linked documents (the smallest id), unchanged."""
    frame, inner, names = carried(docs)
    d = inner[names.index(doc_id)]
    whole = staged(fingerprints(frame, text=inner[names.index(text)], words=words), "simhash-whole")
    # an id is a row's name only together with its fingerprint; equal rows are told apart by nothing
    least = F.min(F.struct(F.col(d).isNull().alias("no"), F.col(d).alias("d"))).alias("x")
    own = staged(whole.groupBy("_fp").agg(least), "simhash-least")
    roots = staged(components(own, bits), "simhash-roots")
    best = roots.groupBy("_root").agg(F.min(F.struct("x.no", "x.d", "_fp")).alias("x")).select("x.d", F.col("x._fp").alias("f"))
    best = staged(best, "simhash-best")
    repeated = whole.groupBy(F.col(d).alias("d"), F.col("_fp").alias("f")).agg(F.count("*").alias("n")).where("n > 1")
    best = best.join(repeated, best["d"].eqNullSafe(repeated["d"]) & (best["f"] == repeated["f"]), "left").select(best["d"], best["f"], F.coalesce("n", F.lit(1)).alias("n"))
    chosen = whole.join(staged(best, "simhash-chosen"), whole[d].eqNullSafe(F.col("d")) & (F.col("_fp") == F.col("f")))
    single = chosen.where("n = 1").select(*inner)
    several = chosen.where("n > 1").dropDuplicates([d, "_fp"]).select(*inner)
    return single.unionByName(several).toDF(*names)
