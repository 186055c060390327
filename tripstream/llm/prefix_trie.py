"""Conversation prefix trie: shared beginnings of conversations, by double-array tries.

A turn is the 128-bit digest of its role and text; a conversation is the sequence of its
turns. Equal conversations are merged first. The distinct sequences are then dealt out in
lexicographic ranges, each cut into shards of at most ``shard_turns`` turns, so a first
turn that a third of all conversations share is spread like any other. Each shard numbers
its turns densely and packs them into a double array (a child of state s by turn c is slot
BASE[s] + c, where CHECK holds s); walking the sequences through it gives the nodes.

In sorted order a node that several shards share lies on the path of the first or the last
sequence of each of them. Nodes off these two paths are complete; those on them are merged
by key over all shards: counts add up, and the sums over subtrees run along the paths, a
node being counted on one of its paths only.

Defined cases: rows without a conv_id are left out; turns with equal numbers are ordered by
role, then by digest; repeated rows are turns of their own; null role or text is empty; an
empty table has no nodes; other columns are ignored. A conversation's digests (16 bytes a
turn) must fit one row.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripstream.llm.common import staged

WIDTH = 16
SHARD_TURNS = 200_000
#: turns of a sequence that the ranges are dealt by; longer equal beginnings stay in one range
ORDER_TURNS = 128
#: free slots tried for a node with several children before it goes behind the last slot
TRIES = 64
IDS_PER_ROW = 8_192
GROUP = 20
HEADS = 4

NODES = ("kind int, shard binary, path int, depth bigint, key binary, parent_key binary, conv_id bigint, parent_conv_id bigint, "
         "n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, words bigint, ends_sha256 string")
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
COMPLETE, BORDER = 0, 1


class DoubleArray:
    """BASE and CHECK of a trie over dense codes from 1; state 0 is the root."""

    def __init__(self, size: int = 16):
        self.base, self.check, self.free, self.top = [0] * size, [-1] * size, 1, 1
        self.check[0] = -2

    def _grow(self, size: int) -> None:
        more = max(size, 2 * len(self.check)) - len(self.check)
        self.base += [0] * more
        self.check += [-1] * more

    def place(self, state: int, codes: list[int]) -> int:
        """Give ``state`` a child for each of its ascending ``codes``; returns its BASE."""
        check, first = self.check, codes[0]
        while self.free < len(check) and check[self.free] != -1:
            self.free += 1
        slot = self.free
        if len(codes) > 1:
            tries, last = 0, codes[-1] - first
            while slot < self.top and (tries == TRIES or check[slot] != -1 or any(
                    slot - first + c < len(check) and check[slot - first + c] != -1 for c in codes)):
                if tries == TRIES:
                    slot = self.top
                    break
                tries += check[slot] == -1
                slot += 1
            end = slot + last
        else:
            end = slot
        if end >= len(check):
            self._grow(end + 1)
            check = self.check
        base = slot - first  # may be negative; a child's slot never is
        for c in codes:
            check[base + c] = state
        self.base[state] = base
        self.top = max(self.top, end + 1)
        return base

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        return np.array(self.base[: self.top], np.int64), np.array(self.check[: self.top], np.int64)


def packed(codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """BASE and CHECK over sequences in lexicographic order (``codes`` laid end to end)."""
    trie, at = DoubleArray(), np.zeros(len(sizes), np.int64)
    for d in range(int(sizes.max(initial=0))):
        live = np.flatnonzero(sizes > d)
        parent, code = at[live], codes[starts[live] + d]
        new = np.concatenate([[True], (parent[1:] != parent[:-1]) | (code[1:] != code[:-1])])
        pairs = np.flatnonzero(new)
        p, c = parent[pairs], code[pairs]
        cuts = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]])).tolist() + [len(p)]
        states, kids, bases = p.tolist(), c.tolist(), np.empty(len(p), np.int64)
        for a, b in zip(cuts, cuts[1:]):
            bases[a:b] = trie.place(states[a], kids[a:b])
        at[live] = (bases + c)[np.cumsum(new) - 1]
    return trie.arrays()


def _shard(seqs: list[bytes], words: np.ndarray, n: np.ndarray, conv: np.ndarray, ends: list[str]) -> dict[str, list | np.ndarray]:
    """The nodes of one shard; ``words`` of all sequences are laid end to end."""
    sizes = np.array([len(s) // WIDTH for s in seqs], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    flat = b"".join(seqs)
    # equal strings of a fixed width compare as the digests do: zero bytes at the end are cut from both
    codes = np.unique(np.frombuffer(flat, f"S{WIDTH}"), return_inverse=True)[1].astype(np.int64) + 1 if flat else np.zeros(0, np.int64)
    base, check = packed(codes, starts, sizes)
    size = len(check)
    members, least = np.zeros(size, np.int64), np.full(size, np.iinfo(np.int64).max)
    last, end = np.zeros(size, np.int64), np.full(size, -1)
    depth = np.zeros(size, np.int64)
    at, levels = np.zeros(len(seqs), np.int64), []
    for d in range(int(sizes.max(initial=0)) + 1):
        live = np.flatnonzero(sizes >= d)
        if d:
            to = base[at[live]] + codes[starts[live] + d - 1]
            assert (check[to] == at[live]).all()
            at[live] = to
            last[to] = words[starts[live] + d - 1]
        here = at[live]
        np.add.at(members, here, n[live])
        np.minimum.at(least, here, conv[live])
        done = sizes[live] == d
        end[here[done]] = live[done]
        levels.append(np.unique(here))
        depth[levels[-1]] = d
    ends_of = sorted({0, len(seqs) - 1})
    paths = [_path(base, codes[starts[i]: starts[i] + sizes[i]]) for i in ends_of]
    border = np.zeros(size, bool)
    for p in paths:
        border[p] = True
    kids, leaves, saved = np.zeros(size, np.int64), np.zeros(size, np.int64), np.where(border, 0, (members - 1) * last)
    for slots in reversed(levels[1:]):
        own = slots[~border[slots]]
        leaves[own[kids[own] == 0]] = 1
        up = check[own]
        np.add.at(kids, up, 1)
        np.add.at(leaves, up, leaves[own])
        np.add.at(saved, up, saved[own])
    mark = hashlib.blake2b(seqs[0], digest_size=WIDTH).digest()
    out: dict[str, list] = {f.split()[0]: [] for f in NODES.split(", ")}

    def put(**values):
        for name, column in out.items():
            column.extend(values[name])

    below = np.concatenate(levels[1:]) if len(levels) > 1 else np.zeros(0, np.int64)
    below = below[~border[below]]
    keys = {}
    for p, i in zip(paths, ends_of):
        for d, s in enumerate(p):
            if s not in keys:
                keys[s] = hashlib.blake2b(seqs[i][: d * WIDTH], digest_size=WIDTH).digest()
    up = check[below]
    hung = border[up]
    parents, blank = up.tolist(), [None] * len(below)
    put(kind=[COMPLETE] * len(below), shard=[mark if h else None for h in hung.tolist()], path=blank, depth=depth[below].tolist(), key=blank,
        parent_key=[keys[s] if h else None for s, h in zip(parents, hung.tolist())], conv_id=least[below].tolist(),
        parent_conv_id=[None if h else x for x, h in zip(least[up].tolist(), hung.tolist())], n_convs=members[below].tolist(),
        n_children=kids[below].tolist(), n_leaves=leaves[below].tolist(), saved_tokens=saved[below].tolist(), words=blank,
        ends_sha256=[ends[e] if e >= 0 else None for e in end[below].tolist()])
    seen = set()
    for k, p in enumerate(paths):
        for d, s in enumerate(p):
            own = s not in seen  # the paths share their beginning: its values go with the first
            seen.add(s)
            put(kind=[BORDER], shard=[mark], path=[k], depth=[d], key=[keys[s]], parent_key=[keys[p[d - 1]] if d else None],
                conv_id=[int(least[s]) if own else None], parent_conv_id=[None], n_convs=[int(members[s]) * own],
                n_children=[int(kids[s]) * own], n_leaves=[int(leaves[s]) * own], saved_tokens=[int(saved[s]) * own], words=[int(last[s]) if d else 0],
                ends_sha256=[ends[end[s]] if own and end[s] >= 0 else None])
    return out


def _path(base: np.ndarray, codes: np.ndarray) -> list[int]:
    out = [0]
    for c in codes.tolist():
        out.append(int(base[out[-1]]) + c)
    return out


def _tries(limit: int):
    names = [f.split()[0] for f in NODES.split(", ")]
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    schema = pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in NODES.split(", ")])

    def built(rows):
        seqs, words, n, conv, ends = zip(*rows)
        out = _shard(list(seqs), np.concatenate([np.asarray(w, np.int64) for w in words]), np.array(n), np.array(conv), list(ends))
        table = pa.table({k: pa.array(out[k], schema.field(k).type) for k in names}, schema=schema)
        yield from table.to_batches(max_chunksize=20_000)

    def run(batches):
        rows, turns = [], 0
        for batch in batches:
            for r in zip(*(batch.column(c).to_pylist() for c in ("seq", "words", "n", "conv_id", "ends"))):
                if rows and turns + len(r[1]) > limit:
                    yield from built(rows)
                    rows, turns = [], 0
                rows.append(r)
                turns += len(r[1])
        if rows:
            yield from built(rows)

    return run


def ordered_turns(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """conv_id and its turns in order, as structs of digest (hex) and words; dealt by the conversation's group."""
    empty = F.lit("")
    t = turns.select(F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(role, empty).alias("role"),
                     F.coalesce(text, empty).alias("text")).where("conv_id IS NOT NULL")
    digest = F.substring(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256), 1, 2 * WIDTH)
    t = t.select((F.col("conv_id") - F.col("conv_id") % GROUP).alias("root"), "conv_id", "turn", "role", digest.alias("d"),
                 F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).alias("n"))
    own = t.repartition("root").groupBy("root", "conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "d", "n"))).alias("turns"))
    return own.select("root", "conv_id", F.transform("turns", lambda x: F.struct(x["d"].alias("d"), x["n"].alias("n"))).alias("turns"))


def rebuilt(own: DataFrame) -> DataFrame:
    """Every conversation c with the first h turns of conversation c - c % 20 before its own after h; h = crc32(c) % 4."""
    head = F.first(F.when(F.col("conv_id") == F.col("root"), F.slice("turns", 1, HEADS - 1)), ignorenulls=True).over(Window.partitionBy("root"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    rest = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    none = F.slice("turns", 1, 0)
    return own.withColumn("head", head).select("conv_id", F.concat(F.slice(F.coalesce("head", none), F.lit(1), h), rest).alias("turns"))


def _sequence() -> list[Column]:
    return [F.unhex(F.array_join(F.transform("turns", lambda x: x["d"]), "")).alias("seq"), F.transform("turns", lambda x: x["n"]).alias("words")]


def _key(seq) -> Column:
    return F.unhex(F.substring(F.sha2(seq, 256), 1, 2 * WIDTH))


def _listed(batches):
    """Runs of sorted ids of one key -> rows of at most ``IDS_PER_ROW`` ids as text."""
    key, ids = None, []

    def row():
        return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))])], ["key", "first", "ids"])

    for batch in batches:
        for k, i in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()):
            if ids and (k != key or len(ids) == IDS_PER_ROW):
                yield row()
                ids = []
            key = k
            ids.append(i)
    if ids:
        yield row()


def _hashed(batches):
    """SHA-256 over the texts of each key, in order, one row at a time."""
    key, sha = None, None

    def row():
        return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([sha.hexdigest()])], ["key", "ends"])

    for batch in batches:
        for k, t in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
            if k != key:
                if sha:
                    yield row()
                key, sha = k, hashlib.sha256(t.encode())
            else:
                sha.update(b"," + t.encode())
    if sha:
        yield row()


def ending(convs: DataFrame) -> DataFrame:
    """key, ends: the digest of all ids with a key. A hot key's ids are sorted in ranges; only
    their text, in long rows, meets in one task, which hashes it as it streams by."""
    ranged = convs.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    lists = ranged.mapInArrow(_listed, "key binary, first bigint, ids string")
    return lists.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_hashed, "key binary, ends string")


def report(turns: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node: smallest member, depth, parent, members, children, leaves, tokens saved, digest of its own ends."""
    convs = staged(rebuilt(ordered_turns(turns, conv_id, turn, role, text)).select("conv_id", *_sequence()).withColumn("key", _key("seq")), "trie-convs")
    merged = convs.groupBy("key", "seq", "words").agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id"))
    lists = merged.join(ending(convs), "key").select("seq", "words", "n", "conv_id", "ends")
    ranges = lists.repartitionByRange(F.substring("seq", 1, WIDTH * ORDER_TURNS)).sortWithinPartitions("seq")
    nodes = staged(ranges.mapInArrow(_tries(shard_turns), NODES), "trie-nodes")
    complete, border = nodes.where(F.col("kind") == COMPLETE), nodes.where(F.col("kind") == BORDER)

    upper = border.groupBy("key").agg(
        F.max("parent_key").alias("parent_key"), F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("hung"), F.sum("n_leaves").alias("below"), F.sum("saved_tokens").alias("saved"), F.max("words").alias("words"),
        F.max("ends_sha256").alias("ends"), F.min(F.struct("shard", "path")).alias("owner"))
    kids = upper.where("parent_key IS NOT NULL").groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("kids"))
    children = F.col("hung") + F.coalesce("kids", F.lit(0))
    upper = staged(upper.join(kids, "key", "left").select(
        "key", "parent_key", "depth", "conv_id", "n_convs", children.alias("n_children"), "ends", "owner",
        (F.col("below") + (children == 0).cast("long")).alias("own_leaves"), (F.col("saved") + (F.col("n_convs") - 1) * F.col("words")).alias("own_saved")), "trie-upper")

    # each upper node counts on one path; its ancestors on that path take it up
    mine = F.col("owner") == F.struct("shard", "path")
    along = Window.partitionBy("shard", "path").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    totals = (border.select("shard", "path", "depth", "key").join(upper.select("key", "owner", "own_leaves", "own_saved"), "key")
              .select("key", *[F.sum(F.when(mine, F.col(c)).otherwise(0)).over(along).alias(c) for c in ("own_leaves", "own_saved")])
              .groupBy("key").agg(F.sum("own_leaves").alias("n_leaves"), F.sum("own_saved").alias("saved_tokens")))
    names = upper.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    top = (upper.join(totals, "key").join(names, "parent_key", "left").withColumnRenamed("ends", "ends_sha256"))
    # an upper parent is looked up per shard, so that no parent is a hot key
    local = border.select("shard", F.col("key").alias("parent_key")).distinct().join(names, "parent_key")
    hung = complete.where("parent_key IS NOT NULL").drop("parent_conv_id").join(local, ["shard", "parent_key"])
    every = top.select(*COLUMNS).unionByName(complete.where("parent_key IS NULL").select(*COLUMNS)).unionByName(hung.select(*COLUMNS))
    return every.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())))
