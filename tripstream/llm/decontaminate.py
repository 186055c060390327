"""Benchmark decontamination over a distributed positional inverted index.

``build`` stores the postings of every training token: documents are cut into shards, and a
shard is a row of the index table, with its terms, how often each occurs and, packed, the
positions of each term in turn. ``search`` answers any benchmark from that table. A test phrase is answered from its rarest term: that
term's list, shifted by the term's offset in the phrase, is intersected with the
next rarest term's shifted list, and so on; what survives all of them is an exact
occurrence. Proximity matches (``slop`` given) start from the rarest term's postings
too and keep the phrases whose every term occurs within some ``slop`` consecutive words.

The index is sharded by document, so no posting ever crosses the network. Test
phrases go to the shards in blocks of at most ``block_chars`` characters, the
proven bound of one broadcast; a larger benchmark is answered in several blocks, one
after the other, each staged before the next. ``flagged``, a filter that passes over a text
once and keeps its columns, holds the postings of the test terms of one batch at a time
instead and stores nothing.

Defined cases: a null or empty text has no words (n_words 0, nothing hit); an item
without words matches nothing; an item shorter than the window is one window of
its own length; repeated rows are judged one by one; items with the same id count
once; an item whose id is null marks words but is not listed; an empty benchmark
or an empty documents table gives no hits or no rows. Extra columns are ignored,
or carried unchanged by ``flagged``.
"""

from __future__ import annotations

import math
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstream.llm.blocks import pack, unpack
from tripstream.llm.common import carried, ddl, extended, pieces, staged

WINDOW = 10
#: a proximity match has every word of a window within this many consecutive words
SLOP = 15
SHARD_WORDS = 300_000
BLOCK_CHARS = 16_000_000
CHUNK_WORDS = 2_000_000
MAX_CANDIDATES = 4_000_000

#: a-z, 0-9 and every byte from 0x80 belong to words; A-Z is lower-cased; the rest separates
_TO_WORDS = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TO_WORDS).split() if isinstance(text, str) else []


class TestPhrases:
    """Distinct windows of a block of items as term numbers, with the items that hold each."""

    __test__ = False

    def __init__(self, items: list[tuple[object, str | None]], window: int):
        self.terms: dict[bytes, int] = {}
        self.item_ids: list[str | None] = []
        windows: dict[tuple[int, ...], set[int]] = {}
        for item_id, text in items:
            w = [self.terms.setdefault(x, len(self.terms)) for x in words_of(text)]
            if not w:
                continue
            k = len(self.item_ids)
            self.item_ids.append(None if item_id is None else str(item_id))
            for i in range(max(1, len(w) - window + 1)):
                windows.setdefault(tuple(w[i : i + window]), set()).add(k)
        self.lengths = np.array([len(x) for x in windows], np.int32)
        self.matrix = np.full((len(windows), window), -1, np.int32)
        for i, x in enumerate(windows):
            self.matrix[i, : len(x)] = x
        self.items = [sorted(x) for x in windows.values()]


class Shard:
    """Postings of the test terms in a run of documents, and the answers to phrases."""

    def __init__(self, docs: list[np.ndarray], n_terms: int, gap: int):
        self.sizes = np.array([len(x) for x in docs], np.int64)
        pad = np.full(gap, -1, np.int32)  # keeps a phrase from reaching into the next document
        self.starts = np.zeros(len(docs), np.int64)
        parts = [pad]
        at = gap
        for i, x in enumerate(docs):
            self.starts[i] = at
            parts += [x, pad]
            at += len(x) + gap
        terms = np.concatenate(parts)
        at = np.flatnonzero(terms >= 0)
        by_term = np.argsort(terms[at], kind="stable")
        self._listing(at[by_term], np.bincount(terms[at], minlength=n_terms) if len(at) else np.zeros(n_terms, np.int64), len(terms))

    def _listing(self, positions: np.ndarray, counts: np.ndarray, size: int) -> None:
        self.width, self.positions, self.counts = size + 1, positions, counts
        self.keys = np.repeat(np.arange(len(counts), dtype=np.int64), counts) * self.width + positions
        self.first = np.concatenate([[0], np.cumsum(counts)])[:-1]

    @classmethod
    def stored(cls, sizes: np.ndarray, steps: np.ndarray, counts: np.ndarray, rows: np.ndarray, gap: int) -> "Shard":
        """From a row of the index; ``rows``: for each test term its place among the shard's terms, or -1."""
        shard = cls.__new__(cls)
        shard.sizes = sizes = sizes.astype(np.int64)
        ends = np.cumsum(sizes)
        shard.starts = ends - sizes + gap * np.arange(1, len(sizes) + 1)
        first = np.concatenate([[0], np.cumsum(counts)])[:-1].astype(np.int64)
        n = np.where(rows >= 0, counts[rows], 0).astype(np.int64)
        # the lists of the test terms, one after the other
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(np.where(rows >= 0, first[rows], 0), n)
        run = np.cumsum(steps, dtype=np.int64)
        positions = run[at] - np.repeat(np.where(rows >= 0, run[first[rows]] - steps[first[rows]], 0), n)
        positions += gap * (np.searchsorted(ends, positions, "right") + 1)
        shard._listing(positions, n, int(sizes.sum()) + gap * (len(sizes) + 1))
        return shard

    def _listed(self, term: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether a term has a posting in [low, high]."""
        j = np.searchsorted(self.keys, term * self.width + low)
        ok = j < len(self.keys)
        ok[ok] = self.keys[j[ok]] <= term[ok] * self.width + high[ok]
        return ok

    def search(self, phrases: TestPhrases, slop: int | None):
        """(window, first position, last position, exact) of each match."""
        if not len(phrases.lengths) or not len(self.keys):
            return
        used = phrases.matrix >= 0
        seen = np.where(used, self.counts[phrases.matrix], np.iinfo(np.int64).max)
        rank = np.argsort(seen, axis=1, kind="stable")
        rows = np.arange(len(phrases.lengths))
        expect = seen[rows, rank[:, 0]]
        live = rows[(expect > 0) & (np.where(used, seen, 1) > 0).all(axis=1)]
        group = np.cumsum(expect[live]) // MAX_CANDIDATES
        for g in np.unique(group):
            yield from self._search(phrases, live[group == g], rank, slop)

    def _search(self, phrases, rows, rank, slop):
        rare = phrases.matrix[rows, rank[rows, 0]]
        n = self.counts[rare]
        which = np.repeat(rows, n)
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at = self.positions[np.repeat(self.first[rare], n) + inside]
        shifted = at - rank[which, 0]
        w, s = which, shifted
        for r in range(1, phrases.matrix.shape[1]):
            off = rank[w, r]
            t = phrases.matrix[w, off].astype(np.int64)
            p = s + off
            keep = (t < 0) | self._listed(np.maximum(t, 0), p, p)
            w, s = w[keep], s[keep]
        for a, b, c in zip(w, s, s + phrases.lengths[w] - 1):
            yield a, b, c, True
        if slop is None:
            return
        w, p = which, at
        for r in range(1, phrases.matrix.shape[1]):
            t = phrases.matrix[w, rank[w, r]].astype(np.int64)
            keep = (t < 0) | self._listed(np.maximum(t, 0), p - slop + 1, p + slop - 1)
            w, p = w[keep], p[keep]
        for a, b in zip(w, p):
            if self._spanned(set(phrases.matrix[a].tolist()) - {-1}, int(b), slop):
                yield a, b, b, False

    def _spanned(self, terms: set[int], p: int, slop: int) -> bool:
        """Whether some ``slop`` consecutive words around ``p`` hold every term."""
        near = []
        for t in terms:
            lo, hi = np.searchsorted(self.keys, [t * self.width + p - slop + 1, t * self.width + p + slop])
            near += [(int(x), t) for x in self.positions[lo:hi]]
        last: dict[int, int] = {}
        for x, t in sorted(near):
            last[t] = x
            if len(last) == len(terms) and x - min(last.values()) < slop:
                return True
        return False

    def document(self, position: int) -> int:
        return int(np.searchsorted(self.starts, position, "right")) - 1


def _chunks(texts):
    """Runs of documents of about CHUNK_WORDS words (a longer document is a run of its own)."""
    run, size, base = [], 0, 0
    for i, text in enumerate(texts):
        w = words_of(text)
        if run and size + len(w) > CHUNK_WORDS:
            yield base, run
            run, size, base = [], 0, i
        run.append(w)
        size += len(w)
    if run:
        yield base, run


def _answers(texts, phrases: TestPhrases, slop: int | None, window: int):
    """Per document: number of words, exact hits [(item, first word, last word)], items only near."""
    out = []
    for _, run in _chunks(texts):
        get = phrases.terms.get
        coded = [np.fromiter((get(x, -1) for x in w), np.int32, len(w)) for w in run]
        shard = Shard(coded, len(phrases.terms), max(window, slop or 0) + 1)
        hits: list[list] = [[] for _ in run]
        near: list[set] = [set() for _ in run]
        for w, a, b, exact in shard.search(phrases, slop):
            d = shard.document(a)
            if exact:
                hits[d].append((int(w), int(a - shard.starts[d]), int(b - shard.starts[d])))
            else:
                near[d].update(phrases.items[w])
        for i, w in enumerate(run):
            found = [(k, a, b) for x, a, b in hits[i] for k in phrases.items[x]]
            out.append((len(w), found, near[i] - {k for k, _, _ in found}))
    return out


FOUND = "_n_words bigint, _n_hit bigint, _items array<string>, _near array<string>, _spans array<int>"


def flagged(docs: DataFrame, items: DataFrame, *, text: str = "text", item_id: str = "item_id", item_text: str = "text",
            keep: list[str] | None = None, window: int = WINDOW, slop: int | None = None,
            block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` (the columns of ``keep``, all by default) with what of the benchmark each document holds.

    Added: ``_n_words``; ``_n_hit``, words inside an exact occurrence; ``_items``, ids with
    an exact occurrence, sorted as strings; ``_near``, ids with a proximity match only;
    ``_spans``, first and last word of each run of hit words, flat.
    """
    spark = docs.sparkSession
    items = items.select(F.col(item_id).alias("i"), F.col(item_text).alias("t")).distinct()
    chars = items.agg(F.sum(F.length("t")).alias("n")).first()["n"] or 0
    blocks = max(1, math.ceil(chars / block_chars))
    frame, inner, names = carried(docs)
    keep = names if keep is None else keep
    kept = frame.select(*[inner[names.index(c)] for c in keep])
    kept_columns, kept_ddl = kept.columns, ddl(kept.schema)
    key = inner[names.index(text)]
    # matches so far: item, first word, last word (-1 for a proximity match), flat
    out = frame.withColumn("_ids", F.lit(None).cast("array<string>")).withColumn("_at", F.lit(None).cast("array<int>"))
    for block in range(blocks):
        last = block == blocks - 1
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == block)
        phrases = spark.sparkContext.broadcast(vars(TestPhrases([(r.i, r.t) for r in part.collect()], window)))

        def search(batches, phrases=phrases, last=last):
            p = SimpleNamespace(**phrases.value)
            strings = pa.list_(pa.string())
            for batch in pieces(batches):
                found = _answers(batch.column(key).to_pylist(), p, slop, window)
                ids, at = [], []
                for old, old_at, (_, exact, near) in zip(batch.column("_ids").to_pylist(), batch.column("_at").to_pylist(), found):
                    ids.append((old or []) + [p.item_ids[k] for k, _, _ in exact] + [p.item_ids[k] for k in near])
                    at.append((old_at or []) + [x for _, a, b in exact for x in (a, b)] + [-1, -1] * len(near))
                if not last:
                    yield extended(batch, inner, _ids=pa.array(ids, strings), _at=pa.array(at, pa.list_(pa.int32())))
                    continue
                hit, items, near, spans = zip(*[_summed(i, a) for i, a in zip(ids, at)]) if ids else ((),) * 4
                yield extended(batch, kept_columns, _n_words=pa.array([n for n, _, _ in found], pa.int64()), _n_hit=pa.array(hit, pa.int64()),
                               _items=pa.array(items, strings), _near=pa.array(near, strings), _spans=pa.array(spans, pa.list_(pa.int32())))

        out = out.mapInArrow(search, f"{kept_ddl}, {FOUND}" if last else ddl(out.schema))
        if not last:  # one block's phrases at a time
            out = staged(out, f"decontaminate-{block}")
            phrases.unpersist()
    return out.toDF(*keep, *[c.split()[0] for c in FOUND.split(", ")])


def _summed(ids, at):
    """Words hit, ids hit exactly, ids only near, runs of hit words."""
    spans: list[int] = []
    hit, n = set(), 0
    for a, b, i in sorted((a, b, str(i)) for i, a, b in zip(ids, at[::2], at[1::2]) if a >= 0):
        if spans and a <= spans[-1] + 1:
            spans[-1] = max(spans[-1], b)
        else:
            spans += [a, b]
    hit = {i for i, a in zip(ids, at[::2]) if a >= 0} - {None}
    near = {i for i, a in zip(ids, at[::2]) if a < 0} - hit - {None}
    n = sum(b - a + 1 for a, b in zip(spans[::2], spans[1::2]))
    return n, sorted(hit), sorted(near), spans


INDEX = "shard bigint, doc_ids array<{id}>, sizes array<int>, terms array<string>, counts array<int>, body binary"


class Index:
    """The stored shards: documents with their sizes, terms with their counts, packed positions."""

    def __init__(self, shards: DataFrame):
        self.shards = shards


def build(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shard_words: int = SHARD_WORDS) -> Index:
    """Postings of all words of ``docs``, in shards of about ``shard_words`` words (a longer document is one alone)."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def shard(number, ids, coded, vocabulary):
        terms = np.concatenate([np.zeros(0, np.int32), *coded])
        order = np.argsort(terms, kind="stable")
        counts = np.bincount(terms, minlength=len(vocabulary))
        steps = np.diff(order, prepend=0)
        first = (np.cumsum(counts) - counts)[counts > 0]
        steps[first] = order[first]  # a term's first position as it is, then the distances
        return pa.RecordBatch.from_arrays([
            pa.array([number], pa.int64()), pa.array([ids.to_pylist()], pa.list_(ids.type)), pa.array([[len(x) for x in coded]], pa.list_(pa.int32())),
            pa.array([[t.decode("utf-8", "surrogatepass") for t in vocabulary]], pa.list_(pa.string())), pa.array([counts], pa.list_(pa.int32())),
            pa.array([pack(steps)], pa.binary())], ["shard", "doc_ids", "sizes", "terms", "counts", "body"])

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        ids, coded, vocabulary, size = [], [], {}, 0
        for batch in pieces(batches):
            at = 0
            for i, t in enumerate(batch.column("text").to_pylist()):
                words = words_of(t)
                if coded and size + len(words) > shard_words:
                    yield shard(number, pa.concat_arrays([*ids, batch.column("doc_id").slice(at, i - at)]), coded, vocabulary)
                    number, at = number + 1, i
                    ids, coded, vocabulary, size = [], [], {}, 0
                coded.append(np.fromiter((vocabulary.setdefault(w, len(vocabulary)) for w in words), np.int32, len(words)))
                size += len(words)
            ids.append(batch.column("doc_id").slice(at))
        if coded:
            yield shard(number, pa.concat_arrays(ids), coded, vocabulary)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return Index(staged(rows.mapInArrow(run, INDEX.format(id=kind)), "positional-index"))


def search(index: Index, items: DataFrame, *, item_id: str = "item_id", text: str = "text", window: int = WINDOW, slop: int | None = SLOP,
           block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id with _n_words, _n_hit, _items, _near, _spans (as ``flagged`` has them) for every indexed document."""
    spark = index.shards.sparkSession
    items = items.select(F.col(item_id).alias("i"), F.col(text).alias("t")).distinct()
    chars = items.agg(F.sum(F.length("t")).alias("n")).first()["n"] or 0
    blocks, hits = max(1, math.ceil(chars / block_chars)), None
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == block)
        phrases = spark.sparkContext.broadcast(vars(TestPhrases([(r.i, r.t) for r in part.collect()], window)))

        def run(batches, phrases=phrases):
            p = SimpleNamespace(**phrases.value)
            names = pa.array([t.decode("utf-8", "surrogatepass") for t in p.terms], pa.string())
            for batch in batches:
                for i in range(batch.num_rows):
                    place = pc.fill_null(pc.index_in(names, value_set=batch.column("terms")[i].values), -1).to_numpy(zero_copy_only=False)
                    sizes, counts = (batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in ("sizes", "counts"))
                    if not (place >= 0).any():
                        continue
                    shard = Shard.stored(sizes, unpack(batch.column("body")[i].as_py())[0], counts, place, max(window, slop or 0) + 1)
                    found = set()
                    for w, a, b, exact in shard.search(p, slop):
                        d = shard.document(int(a))
                        lo, hi = (int(a - shard.starts[d]), int(b - shard.starts[d])) if exact else (-1, -1)
                        found |= {(d, p.item_ids[k], lo, hi) for k in p.items[w]}
                    if found:
                        d, ids, lo, hi = zip(*sorted(found, key=str))
                        yield pa.RecordBatch.from_arrays([batch.column("shard").take(pa.array([i] * len(d))), pa.array(d, pa.int32()), pa.array(ids, pa.string()),
                                                          pa.array(lo, pa.int32()), pa.array(hi, pa.int32())], ["shard", "doc", "id", "a", "b"])

        found = index.shards.select("shard", "sizes", "terms", "counts", "body").mapInArrow(run, "shard bigint, doc int, id string, a int, b int")
        if blocks > 1:  # one block's phrases at a time
            found = staged(found, f"decontaminate-{block}")
            phrases.unpersist()
        hits = found if hits is None else hits.unionByName(found)
    per = hits.groupBy("shard", "doc").agg(F.collect_list(F.struct("id", "a", "b")).alias("h"))
    docs = index.shards.select("shard", F.posexplode(F.arrays_zip("doc_ids", "sizes")).alias("doc", "x")).select("shard", "doc", F.col("x.doc_ids").alias("doc_id"), F.col("x.sizes").cast("long").alias("_n_words"))
    joined = docs.join(per, ["shard", "doc"], "left").select("doc_id", "_n_words", "h")

    def summed(batches):
        for batch in batches:
            rows = [_summed([x["id"] for x in h or []], [y for x in h or [] for y in (x["a"], x["b"])]) for h in batch.column("h").to_pylist()]
            hit, ids, near, spans = zip(*rows) if rows else ((),) * 4
            strings = pa.list_(pa.string())
            yield extended(batch, ["doc_id", "_n_words"], _n_hit=pa.array(hit, pa.int64()), _items=pa.array(ids, strings), _near=pa.array(near, strings), _spans=pa.array(spans, pa.list_(pa.int32())))

    return joined.mapInArrow(summed, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {FOUND}")


def report(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shard_words: int = SHARD_WORDS, **options) -> DataFrame:
    """One row per document: n_words, n_hit, n_items, items_sha256, contaminated; n_near, items with a proximity match only."""
    found = search(build(docs, doc_id=doc_id, text=text, shard_words=shard_words), items, **options)
    return found.select(
        "doc_id", F.col("_n_words").alias("n_words"), F.col("_n_hit").alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"), F.sha2(F.array_join("_items", ","), 256).alias("items_sha256"),
        (F.col("_n_hit") > 0).alias("contaminated"), F.size("_near").cast("long").alias("n_near"))


def clean(docs: DataFrame, items: DataFrame, *, text: str = "text", **options) -> DataFrame:
    """The documents that hold no benchmark phrase, with the columns they came with."""
    frame, inner, names = carried(docs)
    return flagged(frame, items, text=inner[names.index(text)], **options).where("_n_hit = 0").select(*inner).toDF(*names)
