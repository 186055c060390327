"""Exact substring removal with suffix arrays built by two-stage sorting.

A byte goes when some ``length``-byte string that covers it also starts anywhere else in
the corpus, the same document included; strings never cross documents.

Every such string holds one anchor, its smallest ``gram``-byte gram by hash (the first of
equals), so equal strings have equal anchors at equal places and meet under the anchor's
hash. The strings that share one anchor form a segment of a document. In order:

1. Tasks list the segments of their documents (anchor hash, content hash, place); segments
   whose anchor occurs once in the corpus can hold no repeated string and go.
2. Segments with equal content are merged before anything else moves; where there are
   several, all their strings repeat. Anchors under which different segments remain send
   one segment of each content, as bytes, to the sorter.
3. Per task, runs of whole anchor groups become one buffer. Its suffix array is built in
   two stages: the suffixes smaller than their successors are sorted directly, all others
   are induced by one scan over the buckets; then the common prefix of adjacent suffixes
   is computed. Neighbours with ``length`` bytes in common are repeated strings.
4. An anchor with more than ``most`` different segments (a very common line in many
   contexts) is dealt anew before sorting: the strings that reach far enough to its left go
   by the bytes left of it, the others by the bytes right of it. What then is still too
   large a group goes string by string, by the fingerprints of each string's two halves, and
   repeats are counted; no task ever gets a group. Joins keep the rows of hot anchors,
   contents and strings where they are (``joined_by_key``).
5. The ranges found are merged per document and cut out.

Defined cases: a null or empty text, or one shorter than ``length`` bytes, is kept whole
(null as empty); repeated rows are copies of each other, so all their long strings go; null
ids are ids like any other; an empty table gives no rows; texts of any length are read in
bounded runs; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstream.llm.common import discard, extended, joined_by_key, release, staged

LENGTH = 200
GRAM = 64
MOST = 500
BUFFER = 1 << 20
POSITION = np.uint64(BUFFER - 1)
SORT_BYTES = 1 << 20
SEPARATOR = 0xFF  # no byte of UTF-8

_ODD, _MIX = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9


class Grams:
    """Hashes of all ``gram``-byte grams of a buffer, from running sums of weighted bytes."""

    def __init__(self, gram: int = GRAM):
        self.gram = gram
        up, down = np.empty(BUFFER + 1, np.uint64), np.empty(BUFFER + 1, np.uint64)
        up[0] = down[0] = 1
        inverse = pow(_ODD, -1, 1 << 64)
        for powers, base in ((up, _ODD), (down, inverse)):
            powers[1:] = np.uint64(base)
            np.multiply.accumulate(powers, out=powers)
        self.up, self.down = up, down

    def hashes(self, data: np.ndarray) -> np.ndarray:
        n = len(data)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.down[:n], out=sums[1:])
        h = (sums[self.gram :] - sums[: -self.gram]) * self.up[: n - self.gram + 1]
        h ^= h >> np.uint64(31)
        h *= np.uint64(_MIX)
        return h ^ (h >> np.uint64(29))


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbouring values."""
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[: len(values) - (width - size)], values[width - size :]) if width > size else values


def segments(texts: list[bytes], grams: Grams, length: int = LENGTH):
    """(document, first byte, strings, anchor's place in it, anchor hash, content hash) of each segment."""
    from xxhash import xxh3_64_intdigest

    step = BUFFER - length
    runs, run, size = [], [], 0
    for i, t in enumerate(texts):
        for at in range(0, max(0, len(t) - length + 1), step):
            part = t[at : at + step + length - 1]
            if run and size + len(part) > BUFFER:
                runs.append(run)
                run, size = [], 0
            run.append((i, at, part))
            size += len(part)
    if run:
        runs.append(run)
    for run in runs:
        data = np.frombuffer(b"".join(p for _, _, p in run), np.uint8)
        whole = data.tobytes()
        begins = np.cumsum([0, *(len(p) for _, _, p in run)])
        h = grams.hashes(data)
        least = _smallest((h & ~POSITION) | np.arange(len(h), dtype=np.uint64), length - grams.gram + 1) & POSITION
        inside = np.zeros(len(least), bool)
        for a, b in zip(begins, begins[1:]):
            inside[a : b - length + 1] = True
        at = np.flatnonzero(inside)
        anchor = least[at].astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)]))
        count = np.diff(np.concatenate([first, [len(at)]]))
        start = at[first]
        part = np.searchsorted(begins, start, "right") - 1
        content = np.fromiter((xxh3_64_intdigest(whole[s : s + c + length - 1]) for s, c in zip(start.tolist(), count.tolist())), np.uint64, len(start))
        document = np.array([i for i, _, _ in run])[part]
        yield document, start - begins[part] + np.array([a for _, a, _ in run])[part], count, anchor[first] - start, h[anchor[first]].view(np.int64), content.view(np.int64)


def suffix_array(data: bytes, depth: int) -> np.ndarray:
    """Suffixes in order of their first ``depth`` bytes (at least), by two-stage sorting.

    Type B suffixes (smaller than their successors) are sorted directly. Type A suffixes,
    the rest, are induced: scanning the buckets from the smallest byte, the predecessor of
    each suffix met goes to the front part of its own bucket, behind those already there.
    """
    t = np.frombuffer(data, np.uint8)
    n = len(t)
    # a run of equal bytes takes its type from the byte after it; the end is smaller than all
    ends = np.flatnonzero(np.concatenate([t[1:] != t[:-1], [True]]))
    following = np.append(t[ends[:-1] + 1].astype(np.int16), -1)
    type_a = np.repeat(following < t[ends], np.diff(np.concatenate([[-1], ends])))
    direct = np.array(sorted(np.flatnonzero(~type_a).tolist(), key=lambda i: data[i : i + depth]), np.int64)
    edges = np.searchsorted(t[direct], np.arange(257))
    front: list[list[np.ndarray]] = [[] for _ in range(256)]
    front[t[n - 1]].append(np.array([n - 1]))  # the predecessor of the empty suffix
    out = []
    for c in range(256):
        met, queue = [], front[c]
        while queue:
            own = np.concatenate(queue)
            met.append(own)
            queue = []
            for byte, group in _predecessors(own, t, type_a):
                (queue if byte == c else front[byte]).append(group)
        back = direct[edges[c] : edges[c + 1]]
        for byte, group in _predecessors(back, t, type_a):
            front[byte].append(group)
        out += [*met, back]
    return np.concatenate(out)


def _predecessors(suffixes: np.ndarray, t: np.ndarray, type_a: np.ndarray):
    """Type A predecessors by their first byte, in the order of ``suffixes``."""
    p = suffixes[suffixes > 0] - 1
    p = p[type_a[p]]
    if not len(p):
        return []
    byte = t[p]
    order = np.argsort(byte, kind="stable")
    p, byte = p[order], byte[order]
    cuts = np.flatnonzero(byte[1:] != byte[:-1]) + 1
    return [(int(t[g[0]]), g) for g in np.split(p, cuts)]


def common_prefixes(data: bytes, suffixes: np.ndarray, depth: int) -> np.ndarray:
    """Bytes (up to ``depth``) that each suffix has in common with the one before it; all reach ``depth``."""
    rows = np.lib.stride_tricks.sliding_window_view(np.frombuffer(data, np.uint8), depth)
    out = np.zeros(len(suffixes), np.int64)
    for at in range(1, len(suffixes), 20_000):
        k = np.arange(at, min(at + 20_000, len(suffixes)))
        differ = rows[suffixes[k]] != rows[suffixes[k - 1]]
        out[k] = np.where(differ.any(axis=1), differ.argmax(axis=1), depth)
    return out


def repeated(parts: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """Per segment: places of its strings that occur elsewhere among the segments."""
    data = bytes([SEPARATOR]).join(parts) + bytes([SEPARATOR])
    begins = np.cumsum([0, *(len(p) + 1 for p in parts)])[:-1]
    whole = np.zeros(len(data), bool)
    for a, p in zip(begins, parts):
        whole[a : a + len(p) - length + 1] = True
    order = suffix_array(data, length)
    order = order[whole[order]]
    same = common_prefixes(data, order, length) >= length
    twice = same.copy()
    twice[:-1] |= same[1:]
    at = np.sort(order[twice])
    cuts = np.searchsorted(at, begins)
    return [at[a:b] - s for a, b, s in zip(cuts, [*cuts[1:], len(at)], begins)]


def ranges(places: np.ndarray, length: int = LENGTH) -> list[tuple[int, int]]:
    """Bytes covered by strings at sorted ``places``."""
    if not len(places):
        return []
    cut = np.flatnonzero(places[1:] > places[:-1] + length) + 1
    return [(int(g[0]), int(g[-1]) + length) for g in np.split(places, cut)]


def _listed(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """Step 1: d, t (the document), at, n, o (anchor's place), h (anchor), c (content) of every segment."""

    def run(batches):
        grams = Grams(gram)
        for batch in batches:
            texts = [(t or "").encode("utf-8", "surrogatepass") for t in batch.column("text").to_pylist()]
            for document, at, n, o, h, c in segments(texts, grams, length):
                rows = batch.select(["d", "t"]).take(pa.array(document))
                yield extended(rows, ["d", "t"], at=pa.array(at.astype(np.int64)), n=pa.array(n.astype(np.int32)), o=pa.array(o.astype(np.int32)), h=pa.array(h), c=pa.array(c))

    return docs.mapInArrow(run, "d bigint, t bigint, at bigint, n int, o int, h bigint, c bigint")


def _sorted(parts: DataFrame, length: int) -> DataFrame:
    """Step 3: d, t, a, b of the repeated ranges among ``parts`` (h, m copies, d, t, at, bytes)."""

    def flush(rows):
        out = []
        groups: dict[int, list] = {}
        for r in rows:
            groups.setdefault(r[0], []).append(r)
        # two groups share no string, so one buffer serves many
        flat = [r for g in groups.values() if len(g) > 1 for r in g]
        for r, places in zip(flat, repeated([r[5] for r in flat], length) if flat else []):
            if r[1] == 1:
                out += [(r[2], r[3], r[4] + a, r[4] + b) for a, b in ranges(places, length)]
        columns = list(zip(*out)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=["d", "t", "a", "b"])

    def run(batches):
        rows, size, last = [], 0, None
        for batch in batches:
            for r in zip(*(batch.column(x).to_pylist() for x in ("h", "m", "d", "t", "at", "bytes"))):
                if size > SORT_BYTES and r[0] != last:
                    yield flush(rows)
                    rows, size = [], 0
                rows.append(r)
                size += len(r[5])
                last = r[0]
        if rows:
            yield flush(rows)

    dealt = parts.select("h", "m", "d", "t", "at", "bytes").repartition("h").sortWithinPartitions("h")
    return dealt.mapInArrow(run, "d bigint, t bigint, a bigint, b bigint")


def _by_context(parts: DataFrame, length: int, gram: int, most: int) -> DataFrame:
    """Step 4: the same for anchors with very many segments."""
    side = (length - gram) // 2
    start = F.greatest(F.lit(0), F.col("o") - side + 1)  # the first string with less than ``side`` bytes left of the anchor
    cut = lambda a, n: F.substr("bytes", a + 1, n + length - 1)
    lefts = F.least(F.col("n"), F.col("o") - side + 1)
    left = parts.where(F.col("o") >= side).select("m", "d", "t", "at", lefts.alias("n"), F.xxhash64("h", F.substr("bytes", F.col("o") - side + 1, F.lit(side)), F.lit(0)).alias("h"), cut(F.lit(0), lefts).alias("bytes"))
    rights = F.col("n") - start
    right = parts.where(rights > 0).select("m", "d", "t", (F.col("at") + start).alias("at"), rights.alias("n"), F.xxhash64("h", F.substr("bytes", F.col("o") + gram + 1, F.lit(side)), F.lit(1)).alias("h"), cut(start, rights).alias("bytes"))
    dealt = staged(left.unionByName(right).withColumn("c", F.xxhash64("bytes")), "suffix-contexts")
    contents = staged(dealt.groupBy("h", "c").agg(F.sum("m").alias("s"), F.min(F.struct("d", "t", "at")).alias("x")), "suffix-context-contents")
    n = dealt.count()
    copies = staged(contents.where("s > 1").select("h", "c", F.col("s").alias("w")), "suffix-context-copies")
    whole = joined_by_key(dealt.where("m = 1"), copies, ["h", "c"], "w", n).select("d", "t", F.col("at").alias("a"), (F.col("at") + F.col("n") + length - 1).alias("b"))
    several = contents.groupBy("h").agg(F.count("*").alias("k")).where("k > 1")
    chosen = joined_by_key(contents, staged(several, "suffix-context-several"), ["h"], "k", contents.count()).select("h", "c", "s", "k", F.col("x").alias("_x"))
    chosen = staged(chosen, "suffix-context-chosen")
    one = joined_by_key(dealt, chosen, ["h", "c"], "s", n).where(F.struct("d", "t", "at").eqNullSafe(F.col("_x"))).dropDuplicates(["h", "c"])
    one = staged(one.select("h", F.col("s").alias("m"), "k", "d", "t", "at", "n", "bytes"), "suffix-context-parts")
    found = whole.unionByName(_sorted(one.where(F.col("k") <= most), length))
    return found.unionByName(_by_string(one.where(F.col("k") > most), length))


def _by_string(parts: DataFrame, length: int) -> DataFrame:
    """Step 4, what is left: string by string."""
    half = length // 2
    strings = parts.select("m", "d", "t", F.posexplode(F.transform(F.sequence(F.lit(1), F.col("n")), lambda i: F.struct(
        F.md5(F.substr("bytes", i, F.lit(half))).alias("x"), F.md5(F.substr("bytes", i + half, F.lit(length - half))).alias("y")))), "at")
    strings = strings.select("m", "d", "t", (F.col("at") + F.col("pos")).alias("a"), F.xxhash64("col.x", "col.y").alias("s"), F.xxhash64("col.y", "col.x").alias("r"))
    strings = staged(strings, "suffix-strings")
    many = staged(strings.groupBy("s", "r").agg(F.sum("m").alias("k")).where("k > 1"), "suffix-many")
    return joined_by_key(strings.where("m = 1"), many, ["s", "r"], "k", strings.count()).select("d", "t", "a", (F.col("a") + length).alias("b"))


def repeated_ranges(docs: DataFrame, *, length: int = LENGTH, gram: int = GRAM, most: int = MOST) -> DataFrame:
    """d, t, a, b: byte ranges (which may overlap) of the documents (d, t, text) that go."""
    listed = staged(_listed(docs, length, gram), "suffix-segments")
    anchors = staged(listed.groupBy("h").agg(F.count("*").alias("k")).where("k > 1"), "suffix-anchors")
    shared = staged(joined_by_key(listed, anchors, ["h"], "k", listed.count()).select(*listed.columns), "suffix-shared")
    discard(listed, anchors)
    listed = shared
    contents = listed.groupBy("h", "c").agg(F.count("*").alias("m"), F.min(F.struct("d", "t", "at", "n", "o")).alias("x"))
    contents = staged(contents.select("h", "c", "m", "x.*"), "suffix-contents")
    release(docs.sparkSession)
    copies = staged(contents.where("m > 1").select("h", "c", "m"), "suffix-copies")
    whole = joined_by_key(listed, copies, ["h", "c"], "m", listed.count()).select("d", "t", F.col("at").alias("a"), (F.col("at") + F.col("n") + length - 1).alias("b"))
    several = staged(contents.groupBy("h").agg(F.count("*").alias("k")).where("k > 1"), "suffix-several")
    chosen = joined_by_key(contents, several, ["h"], "k", contents.count()).select("h", "k", "m", F.col("d").alias("_d"), F.col("t").alias("_t"), "at", "n", "o")
    parts = docs.join(chosen, docs["d"].eqNullSafe(F.col("_d")) & (docs["t"] == F.col("_t")))
    parts = parts.select("h", "k", "m", "d", "t", "at", "n", "o", F.substring(F.col("text").cast("binary"), F.col("at").cast("int") + 1, F.col("n") + length - 1).alias("bytes"))
    # a repeated row brings its segment again; one is enough
    parts = staged(parts.dropDuplicates(["h", "d", "t", "at"]), "suffix-parts")
    discard(contents, several)
    found = whole.unionByName(_sorted(parts.where(F.col("k") <= most), length))
    hot = parts.where(F.col("k") > most)
    return found if hot.isEmpty() else found.unionByName(_by_context(hot, length, gram, most))


def report(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    rows = docs.select(F.col(doc_id).cast("long").alias("d"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("t"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    found = repeated_ranges(rows, length=length, **options).distinct()
    per = found.groupBy("d", "t").agg(F.collect_list(F.struct("a", "b")).alias("r")).select(F.col("d").alias("_d"), F.col("t").alias("_t"), "r")
    removed = staged(per, "suffix-ranges")
    del found, per
    release(docs.sparkSession)  # the files of all shuffles before the texts move
    joined = rows.join(removed, rows["d"].eqNullSafe(F.col("_d")) & (rows["t"] == F.col("_t")), "left")

    def cut(batches):
        for batch in batches:
            out = []
            for t, r in zip(batch.column("text").to_pylist(), batch.column("r").to_pylist()):
                data, at, kept, spans, gone = t.encode("utf-8", "surrogatepass"), 0, hashlib.sha256(), 0, 0
                for a, b in sorted((x["a"], x["b"]) for x in r or []):
                    if a > at or not spans:
                        kept.update(data[at:a])
                        spans, gone, at = spans + 1, gone + b - a, b
                    elif b > at:
                        gone, at = gone + b - at, b
                kept.update(data[at:])
                out.append((len(data), gone, spans, kept.hexdigest()))
            n, gone, spans, kept = zip(*out) if out else ((),) * 4
            yield extended(batch, ["d"], n_bytes=pa.array(n, pa.int64()), n_removed=pa.array(gone, pa.int64()), n_spans=pa.array(spans, pa.int64()), kept_sha256=pa.array(kept, pa.string()))

    out = joined.select("d", "text", "r").mapInArrow(cut, "d bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
    return out.withColumnRenamed("d", "doc_id")
