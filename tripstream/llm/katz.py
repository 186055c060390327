"""Language-model scores: a Katz backoff model of word pairs.

A text's tokens are its words and one end mark. Words are known by a 64-bit hash. The
model is two tables in ``parts``, dealt by the hash of the predicted word:

* pairs: (word, context, count), the count discounted by Good-Turing (counts up to ``K``);
* words: (word, count, denominator, backoff), the last two for the word as a context.

A token is evaluated recursively: its pair if training has it, else the context's backoff
weight times the word's own Good-Turing estimate, else (unknown word) the mass that
estimate leaves over, shared by all unknown words as one class. Backoff weights are exact:
the mass that a context's discounts leave, over one minus the own estimates of the words
seen after it, so that the probabilities after any context add up to one. A context whose
counts are all above ``K`` leaves nothing; its denominator counts one more.

How it runs: tasks cut their documents into chunks and send, per part, one block of sorted
arrays (numbers of distinct pairs, with the documents that hold them); no row per token
crosses the network. Words that make up a large share of all tokens are few: their pairs
are dealt by the whole pair and their statistics broadcast (at most ``HOT * parts`` words).
Which words these are is read off one text in ``SAMPLE``; that list decides only where pairs
are dealt to, all counts are over all texts.
Where the training counts of counts do not allow Good-Turing (small corpora), absolute
discounting with the usual estimate n1 / (n1 + 2 n2) takes its place.

Defined cases: a null or empty text is its end mark; with nothing to learn from every token
is unknown and scores 0; repeated rows are scored each and learned each; a null doc_id is
held out (its text form is empty); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstream.llm.blocks import pack, unpack
from tripstream.llm.common import carried, ddl, extended, pieces, release, staged

CHUNK_TOKENS = 500_000
#: documents are scored in this many rounds, one after the other, so that a part of their blocks is on disk at a time
ROUNDS = 3
#: counts up to here are discounted
K = 5
HOT = 8
SAMPLE = 32
START, END = b" start", b" end"  # no word holds a blank
BLOCK = "part int, kind int, chunk bigint, data binary"
SCORED = "kind int, chunk bigint, data binary, context bigint, doc int, n int"
TABLE_WORDS, TABLE_PAIRS, DOCS, TOKENS, SUMS, REST = range(6)
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def _hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word) - (1 << 63)


H_START, H_END = _hash(START), _hash(END)


def words_of(raw: bytes | None) -> list[bytes]:
    return raw.translate(_LOWER).split() if raw else []


class _Local(dict):
    """Words of one chunk, numbered as they come."""

    def __init__(self):
        super().__init__({START: 0, END: 1})

    def __missing__(self, word):
        n = self[word] = len(self)
        return n


def _runs(x: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, np.int64)


def _sizes(starts: np.ndarray, n: int) -> np.ndarray:
    return np.diff(np.append(starts, n))


def _pairs(texts: list[np.ndarray], local: _Local, parts: int, hot: np.ndarray, documents: bool):
    """Per part: (words, pairs per word, contexts, context of each pair, occurrences per pair, and their documents)."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    word = np.concatenate(texts)
    before = np.concatenate([np.zeros(1, np.int32), word[:-1]])
    before[np.concatenate([[0], np.cumsum(sizes)[:-1]])] = local[START]
    hashes = np.fromiter(map(_hash, local), np.int64, len(local))
    order = np.argsort(hashes)
    rank, hashes = np.empty(len(order), np.int32), hashes[order]
    rank[order] = np.arange(len(order), dtype=np.int32)
    word, before = rank[word], rank[before]
    part = np.mod(hashes, parts)[word]
    often = np.isin(hashes, hot)[word]
    part[often] = np.mod(hashes[word[often]] * 31 + hashes[before[often]], parts)
    n = len(hashes)
    del often
    key = (part * n + word) * n + before  # below 2^63 for any number of parts that a chunk's words leave room for
    doc = None
    if documents:
        order = np.argsort(key, kind="stable")
        key, doc = key[order], np.repeat(np.arange(len(texts), dtype=np.int32), sizes)[order]
    else:
        key.sort()
    first = _runs(key)
    times, pair = _sizes(first, len(key)), key[first]
    context, word = pair % n, pair // n
    part, word = word // n, word % n
    starts = _runs(part)
    ends = np.append(first[starts], len(key))
    for i, (p, a, size) in enumerate(zip(part[starts].tolist(), starts.tolist(), _sizes(starts, len(part)).tolist())):
        w, c, t = word[a: a + size], context[a: a + size], times[a: a + size]
        heads = _runs(w)
        contexts, which = np.unique(c, return_inverse=True)
        yield p, hashes[w[heads]], _sizes(heads, size), hashes[contexts], which, t, *([doc[ends[i]: ends[i + 1]]] if documents else [])


def _chunks(keep: list[str], limit: int, learns: str | None):
    """Batches -> (chunk number, kept columns, texts as local numbers, local words); ``learns``: only rows where it holds."""

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        local, texts, kept, tokens = _Local(), [], [], 0
        for batch in pieces(batches):
            take = batch.column(learns).to_pylist() if learns else [True] * batch.num_rows
            raws = batch.column("_text").cast(pa.binary()).to_pylist()
            at = 0
            for i, (raw, yes) in enumerate(zip(raws, take)):
                if not yes:
                    continue
                words = words_of(raw)
                words.append(END)
                text = np.fromiter(map(local.__getitem__, words), np.int32, len(words))
                texts.append(text)
                tokens += len(text)
                if tokens >= limit:
                    kept.append(batch.select(keep).slice(at, i + 1 - at))
                    yield number, kept, texts, local
                    number += 1
                    local, texts, kept, tokens, at = _Local(), [], [], 0, i + 1
            kept.append(batch.select(keep).slice(at))
        if texts:
            yield number, kept, texts, local

    return run


def _rows(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema=schema)


_BLOCK = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("chunk", pa.int64()), ("data", pa.binary())])
_SCORED = pa.schema([("kind", pa.int32()), ("chunk", pa.int64()), ("data", pa.binary()), ("context", pa.int64()), ("doc", pa.int32()), ("n", pa.int32())])


def _counted(batches):
    """Word counts of each chunk."""
    for _, _, texts, local in _chunks([], CHUNK_TOKENS, None)(batches):
        counts = np.bincount(np.concatenate(texts), minlength=len(local))
        yield pa.RecordBatch.from_arrays([pa.array(np.fromiter(map(_hash, local), np.int64, len(local))), pa.array(counts)], ["word", "c"])


def _sent(parts: int, hot, keep: list[str] | None):
    """Blocks per part: of the learned rows to be counted (``keep`` None), or of all rows with their documents."""

    def run(batches):
        for number, kept, texts, local in _chunks(keep or [], CHUNK_TOKENS, None if keep is not None else "_learn")(batches):
            if keep is not None:
                table = pa.Table.from_batches([b for b in kept if b.num_rows])
                table = table.append_column("_n", pa.array([len(t) for t in texts], pa.int64())).combine_chunks()
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, table.schema) as w:
                    w.write_table(table)
                yield _rows(_BLOCK, [(number % parts, DOCS, number, sink.getvalue().to_pybytes())])
            rows = []
            for p, *arrays in _pairs(texts, local, parts, hot.value, keep is not None):
                rows.append((p, TOKENS, number, pack(*arrays)))
                if len(rows) == 64:
                    yield _rows(_BLOCK, rows)
                    rows = []
            if rows:
                yield _rows(_BLOCK, rows)

    return run


#: a part's pairs, how many were seen 1 to K + 1 times, the same of its own words, and its share of the often ones
PART = BLOCK + ", seen array<bigint>, word_seen array<bigint>, tokens bigint, types bigint, hot array<struct<word:bigint,c:bigint>>"


def _seen(count: np.ndarray) -> list[int]:
    return np.bincount(np.minimum(count, K + 2), minlength=K + 3)[1: K + 2].tolist()


def _merged(hot):
    """Blocks of a part -> one block of its pairs with their counts."""
    schema = pa.schema([*_BLOCK, ("seen", pa.list_(pa.int64())), ("word_seen", pa.list_(pa.int64())), ("tokens", pa.int64()), ("types", pa.int64()),
                        ("hot", pa.list_(pa.struct([("word", pa.int64()), ("c", pa.int64())])))])

    def row(part, blocks):
        word = np.concatenate([np.repeat(b[0], b[1]) for b in blocks])
        context, count = np.concatenate([b[2][b[3]] for b in blocks]), np.concatenate([b[4].astype(np.int64) for b in blocks])
        order = np.lexsort((context, word))
        word, context, count = word[order], context[order], count[order]
        first = np.flatnonzero(np.concatenate([[True], (word[1:] != word[:-1]) | (context[1:] != context[:-1])]))
        word, context, count = word[first], context[first], np.add.reduceat(count, first)
        heads = _runs(word)
        contexts, which = np.unique(context, return_inverse=True)
        names, total = word[heads], np.add.reduceat(count, heads)
        often = np.isin(names, hot.value)
        data = pack(names, _sizes(heads, len(word)), contexts, which, count)
        return _rows(schema, [(part, TABLE_PAIRS, 0, data, _seen(count), _seen(total[~often]), int(count.sum()), int((~often).sum()),
                               [{"word": w, "c": c} for w, c in zip(names[often].tolist(), total[often].tolist())])])

    def run(batches):
        part, blocks = None, []
        for batch in pieces(batches, 100):
            for p, data in zip(batch.column("part").to_pylist(), batch.column("data").to_pylist()):
                if blocks and p != part:
                    yield row(part, blocks)
                    blocks = []
                part = p
                blocks.append(unpack(data))
        if blocks:
            yield row(part, blocks)

    return run


def discounts(n: list[int], k: int = K) -> np.ndarray:
    """Factor by count, 0 to K + 1 (1 from there on), from the numbers of items seen 1 to K + 1 times."""
    d = np.ones(K + 2)
    for top in range(k, 1, -1):
        if min(n[: top + 1]) > 0:
            r = np.arange(1, top + 1)
            common = (top + 1) * n[top] / n[0]
            d[1: top + 1] = ((r + 1) * np.array(n[1: top + 1]) / np.array(n[:top]) / r - common) / (1 - common) if common < 1 else 0
            if (d[1: top + 1] > 0).all() and (d[1: top + 1] < 1).all():
                return d
            d[:] = 1
    cut = n[0] / (n[0] + 2 * n[1]) if n[0] and n[1] else 0.5
    d[1: K + 1] = 1 - cut / np.arange(1, K + 1)
    return d


class Totals:
    """What every task needs: counts of the training text and the discounts. A few numbers."""

    def __init__(self, tokens: int, types: int, texts: int, word_seen: list[int], pair_seen: list[int]):
        self.tokens, self.types, self.texts = tokens, types, texts
        self.word_d, self.pair_d = discounts(word_seen), discounts(pair_seen)
        left = sum((1 - self.word_d[r]) * r * word_seen[r - 1] for r in range(1, K + 1))
        self.base = tokens if left > 0 else tokens + 1
        self.unknown = (left if left > 0 else 1) / self.base

    def own(self, count: np.ndarray) -> np.ndarray:
        """Probability of a word without context."""
        return np.where(count > 0, self.word_d[np.minimum(count, K + 1)] * count / self.base, self.unknown)

    def plain(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 0.1) / (self.tokens + 0.1 * (self.types + 1)))


def _word_sums(totals: Totals, hot):
    """Per part: of its words the count; of its contexts the mass that their discounts leave, and
    the own estimates of the words seen after them."""

    def run(batches):
        often, often_count = hot.value
        for batch in batches:
            for data in batch.column("data").to_pylist():
                words, pairs, contexts, which, count = unpack(data)
                heads = np.concatenate([[0], np.cumsum(pairs.astype(np.int64))[:-1]])
                total = here = np.add.reduceat(count.astype(np.int64), heads)
                if len(often):  # dealt by pairs: the part holds some of them only
                    at = np.minimum(np.searchsorted(often, words), len(often) - 1)
                    total = np.where(often[at] == words, often_count[at], here)
                left = np.bincount(which, (1 - totals.pair_d[np.minimum(count, K + 1)]) * count, len(contexts))
                own = np.bincount(which, np.repeat(totals.own(total), pairs), len(contexts))
                a, b = np.zeros(len(words)), np.zeros(len(contexts), np.int64)
                columns = [np.concatenate(x) for x in ((words, contexts), (here, b), (a, left), (a, own))]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["word", "c", "left", "own"])

    return run


def _word_blocks(batches):
    """Rows of one part after the other, sorted by word -> a block a part."""
    part, held = None, []

    def row():
        return _rows(_BLOCK, [(part, TABLE_WORDS, 0, pack(*(np.concatenate(x) for x in zip(*held))))])

    for batch in batches:
        of = batch.column("part").to_numpy()
        starts = _runs(of)
        for a, n in zip(starts.tolist(), _sizes(starts, len(of)).tolist()):
            if held and of[a] != part:
                yield row()
                held = []
            part = int(of[a])
            held.append([batch.column(c).to_numpy()[a: a + n] for c in ("word", "c", "denominator")])
    if held:
        yield row()


class _Words:
    """Sorted words with count and denominator; those that are often come from the broadcast, which has their backoff too."""

    def __init__(self, own: list[np.ndarray], hot: list[np.ndarray]):
        self.tables = [t for t in (own, hot) if len(t) and len(t[0])]

    def of(self, words: np.ndarray) -> list[np.ndarray]:
        """count, denominator, backoff; 0, 1, 0 for words that the tables lack."""
        out = [np.zeros(len(words), np.int64), np.ones(len(words)), np.zeros(len(words))]
        for names, *values in self.tables:
            at = np.minimum(np.searchsorted(names, words), len(names) - 1)
            there = names[at] == words
            for o, v in zip(out, values):
                o[there] = v[at[there]]
        return out


def _scored(totals: Totals, hot):
    """Blocks of a part, its tables first -> sums per document, and the contexts of pairs that training lacks."""

    def sums(block, words: _Words, table, often: _Words):
        names, pairs, contexts, which, times, docs = block
        count, denominator = words.of(names)[:2]
        word = np.repeat(np.arange(len(names)), pairs)
        seen = np.zeros(len(which), np.int64)
        if table is not None:
            t_names, t_contexts, t_key, t_count = table
            a, b = (np.minimum(np.searchsorted(t, x), len(t) - 1) for t, x in ((t_names, names), (t_contexts, contexts)))
            key = a[word] * len(t_contexts) + b[which]
            at = np.minimum(np.searchsorted(t_key, key), len(t_key) - 1)
            there = (t_names[a] == names)[word] & (t_contexts[b] == contexts)[which] & (t_key[at] == key)
            seen[there] = t_count[at[there]]
        own = np.log10(totals.own(count))[word]
        paired = np.log10(np.where(seen > 0, totals.pair_d[np.minimum(seen, K + 1)] * seen, 1))
        # the denominator of a pair is that of its context: each word pays its own here, as if what follows it were seen
        model = np.where(seen > 0, paired, own) - np.log10(denominator)[word]
        lacking = np.flatnonzero(seen == 0)
        back = often.of(contexts)[2]
        known = np.isin(contexts, often.tables[-1][0]) if often.tables else np.zeros(len(contexts), bool)
        model[lacking] += np.where(known, back, 0)[which[lacking]]
        per = np.repeat(np.arange(len(which)), times)
        size = int(docs.max()) + 1
        held = np.bincount(docs, minlength=size)
        at = np.flatnonzero(held)
        values = [np.bincount(docs, x[per], size)[at] for x in ((count > 0)[word].astype(float), totals.plain(count)[word], model)]
        data = pack(at, values[0].astype(np.int64), *values[1:])
        ask = (seen == 0) & ~known[which]
        mine = ask[per]
        return data, contexts[which[per[mine]]], docs[mine]

    def run(batches):
        part, words, table = None, None, None
        often = _Words([], hot.value)
        for batch in pieces(batches, 100):
            for p, kind, chunk, data in zip(*(batch.column(c).to_pylist() for c in ("part", "kind", "chunk", "data"))):
                if p != part:
                    part, words, table = p, _Words([], hot.value), None
                if kind == TABLE_WORDS:
                    words = _Words(unpack(data), hot.value)
                elif kind == TABLE_PAIRS:
                    names, pairs, contexts, which, count = unpack(data)
                    table = names, contexts, np.repeat(np.arange(len(names)), pairs) * len(contexts) + which, count
                elif kind == DOCS:
                    yield _rows(_SCORED, [(DOCS, chunk, data, None, None, None)])
                else:
                    data, contexts, docs = sums(unpack(data), words, table, often)
                    yield _rows(_SCORED, [(SUMS, chunk, data, None, None, None)])
                    if len(contexts):
                        n = len(contexts)
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(n, REST, np.int32)), pa.array(np.full(n, chunk)), pa.nulls(n, pa.binary()), pa.array(contexts),
                                                          pa.array(docs.astype(np.int32)), pa.array(np.ones(n, np.int32))], schema=_SCORED)

    return run


def _assembled(totals: Totals, start: float):
    """Blocks of one chunk after the other -> its documents with their sums."""

    def rows(docs, n_known, base, model):
        if docs is None:
            return
        at = 0
        for b in docs.to_batches():
            part = slice(at, at + b.num_rows)
            at += b.num_rows
            keep = [c for c in b.schema.names if c != "_n"]
            yield extended(b, keep, _n=b.column("_n"), _known=pa.array(n_known[part]), _train=pa.array(np.full(b.num_rows, totals.tokens)),
                           _base=pa.array(base[part]), _score=pa.array(model[part] - start))

    def run(batches):
        chunk, docs, sums = None, None, None
        for batch in pieces(batches, 100):
            for *c, kind, data, doc, value in zip(*(batch.column(x).to_pylist() for x in ("round", "chunk", "kind", "data", "doc", "value"))):
                if c != chunk:
                    if docs is not None:
                        yield from rows(docs, *sums)
                    chunk, docs = c, None
                if kind == DOCS:  # comes first
                    docs = pa.ipc.open_stream(data).read_all()
                    sums = np.zeros(len(docs), np.int64), np.zeros(len(docs)), np.zeros(len(docs))
                elif kind == SUMS:
                    at, *values = unpack(data)
                    for total, v in zip(sums, values):
                        total[at] += v.astype(total.dtype)
                else:
                    sums[2][doc] += value
        if docs is not None:
            yield from rows(docs, *sums)

    return run


def _dealt(blocks: DataFrame, tasks: int) -> DataFrame:
    return blocks.repartition(tasks, "part").sortWithinPartitions("part", "kind")


class Katz:
    """The fitted model: its tables (a block per part), totals, and the words that are broadcast."""

    def __init__(self, words: DataFrame, rows: DataFrame, pairs: DataFrame, totals: Totals, names: np.ndarray, hot: list[np.ndarray], parts: int, tasks: int):
        self.words, self.rows, self.pairs, self.totals, self.names, self.hot, self.parts, self.tasks = words, rows, pairs, totals, names, hot, parts, tasks


def fit(docs: DataFrame, learn: Column, *, text: str = "text", parts: int | None = None) -> Katz:
    """Count the texts of the rows where ``learn`` holds. ``parts``: one for each shuffle partition by default."""
    spark = docs.sparkSession
    sc, tasks = spark.sparkContext, int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = parts or tasks
    rows = docs.select(F.col(text).alias("_text"), F.coalesce(learn, F.lit(False)).alias("_learn"))
    some = rows.where(F.col("_learn") & (F.pmod(F.xxhash64("_text"), F.lit(SAMPLE)) == 0)).mapInArrow(_counted, "word bigint, c bigint")
    some = staged(some.groupBy("word").agg(F.sum("c").alias("c")), "sampled-words")
    share = (some.agg(F.sum("c")).first()[0] or 0) / (HOT * parts)
    # at most HOT * parts words, and the end mark
    names = np.array(sorted({r["word"] for r in some.where(F.col("c") > share).collect()} - {H_START} | {H_END}), np.int64)

    sent = sc.broadcast(names)
    pairs = staged(_dealt(rows.mapInArrow(_sent(parts, sent, None), BLOCK), tasks).mapInArrow(_merged(sent), PART), "pairs")
    r = range(1, K + 2)
    t = pairs.agg(F.sum("tokens").alias("tokens"), F.sum("types").alias("types"), *[F.sum(F.element_at(c, i)).alias(f"{c}{i}") for c in ("seen", "word_seen") for i in r]).first()
    often = {x["word"]: x["c"] for x in pairs.select(F.explode("hot").alias("x")).groupBy("x.word").agg(F.sum("x.c").alias("c")).collect()}
    counts = np.array([often.get(w, 0) for w in names.tolist()], np.int64)
    word_seen = [(t[f"word_seen{i}"] or 0) + int((counts == i).sum()) for i in r]
    totals = Totals(t["tokens"] or 0, (t["types"] or 0) + int((counts > 0).sum()), often.get(H_END, 0), word_seen, [t[f"seen{i}"] or 0 for i in r])
    release(spark)

    sums = pairs.select("data").mapInArrow(_word_sums(totals, sc.broadcast((names, counts))), "word bigint, c bigint, left double, own double")
    every = sums.groupBy("word").agg(*[F.sum(c).alias(c) for c in ("c", "left", "own")])
    times = F.when(F.col("word") == H_START, totals.texts).otherwise(F.col("c"))
    # a context has words after it; the end mark is none, and a denominator of 1 costs nothing
    context, open_ = F.col("own") > 0, F.col("left") > 0
    table = staged(every.select(
        "word", "c",
        F.when(context, F.when(open_, times).otherwise(times + 1)).otherwise(1).cast("long").alias("denominator"),
        F.when(context, F.log10(F.when(open_, F.col("left")).otherwise(1.0) / (1 - F.col("own")))).otherwise(0.0).alias("backoff"),
    ), "words")
    by_part = table.select(F.pmod("word", F.lit(parts)).cast("int").alias("part"), "word", "c", "denominator")
    blocks = staged(by_part.repartition(tasks, "part").sortWithinPartitions("part", "word").mapInArrow(_word_blocks, BLOCK), "word-blocks")
    held = table.join(spark.createDataFrame([(int(x),) for x in [*names, H_START]], "word bigint"), "word", "left_semi")
    found = sorted((x["word"], x["c"], x["denominator"], x["backoff"]) for x in held.collect())  # as many as ``names``, and the start mark
    hot = [np.array(x, kind) for x, kind in zip(zip(*found), (np.int64, np.int64, float, float))] if found else []
    release(spark)
    return Katz(blocks, table, pairs, totals, names, hot, parts, tasks)


def score(docs: DataFrame, model: Katz, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns of ``keep`` (all by default) with _n, _known, _train, _base and _score."""
    frame, inner, names = carried(docs)
    keep = names if keep is None else keep
    kept = [inner[names.index(c)] for c in keep]
    rows = frame.select(*kept, F.col(inner[names.index(text)]).alias("_text"))
    sc = docs.sparkSession.sparkContext
    hot_words = model.hot[0] if model.hot else np.zeros(0, np.int64)
    start = float(np.log10(model.hot[2][hot_words == H_START][0])) if H_START in hot_words else 0.0
    dealt, hot = sc.broadcast(model.names), sc.broadcast(model.hot)
    tables = model.words.unionByName(model.pairs.select("part", "kind", "chunk", "data"))
    scored = None
    for n in range(ROUNDS):
        own = rows.where(F.pmod(F.xxhash64("_text"), F.lit(ROUNDS)) == n)
        blocks = own.mapInArrow(_sent(model.parts, dealt, kept), BLOCK).unionByName(tables)
        part = staged(_dealt(blocks, model.tasks).mapInArrow(_scored(model.totals, hot), SCORED).withColumn("round", F.lit(n)), "katz-sums")
        release(docs.sparkSession)
        scored = part if scored is None else scored.unionByName(part)
    asked = scored.where(F.col("kind") == REST).groupBy("round", "chunk", "doc", "context").agg(F.sum("n").alias("n"))
    back = (asked.join(model.rows.select(F.col("word").alias("context"), "backoff"), "context").groupBy("round", "chunk", "doc")
            .agg(F.sum(F.col("n") * F.col("backoff")).alias("value")).select("round", "chunk", F.lit(REST).alias("kind"), F.lit(None).cast("binary").alias("data"), "doc", "value"))
    sums = scored.where(F.col("kind") != REST).select("round", "chunk", "kind", "data", F.lit(0).alias("doc"), F.lit(0.0).alias("value"))
    by_chunk = sums.unionByName(back).repartition("round", "chunk").sortWithinPartitions("round", "chunk", "kind")
    out = by_chunk.mapInArrow(_assembled(model.totals, start), f"{ddl(frame.select(*kept).schema)}, _n bigint, _known bigint, _train bigint, _base double, _score double")
    return out.toDF(*keep, "_n", "_known", "_train", "_base", "_score")


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 10 == 0


def report(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    model = fit(rows, ~held_out(), **options)
    out = score(rows.withColumn("held_out", held_out()), model, keep=["doc_id", "held_out"])
    return out.select("doc_id", "held_out", F.col("_n").alias("n_tokens"), F.col("_known").alias("n_known"), F.col("_train").alias("train_tokens"),
                      F.col("_base").alias("base_score"), F.col("_score").alias("score"))
