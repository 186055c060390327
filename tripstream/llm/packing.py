"""Best-fit packing planned on the histogram of lengths.

1. Every document is tokenized (once, its pieces staged) and cut into pieces of at
   most ``size`` tokens; only longer documents are cut.
2. The histogram of piece lengths has at most ``size`` entries whatever the corpus.
   Best-fit decreasing runs over counts: sequences with the same free space are one
   group, a length takes the tightest groups that hold it, and each step splits at
   most two groups, so the plan has at most a few thousand groups.
3. The plan gives each length runs of slots. A piece takes the slot of its rank
   within its length: the rank is a count per (length, salt) summed over the salts
   plus a row number inside one (length, salt), so a length held by a third of all
   pieces is still spread over ``salts`` tasks.

Defined cases: a null or empty text is the closing token alone; repeated rows are
packed one by one; an empty table gives no rows; very long texts give many pieces;
extra columns are ignored. Pieces equal in length are interchangeable, so which of
them gets which slot carries no meaning.
"""

from __future__ import annotations

import gc
import os
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripstream.llm.common import ddl, extended, staged
from tripstream.llm.common import pieces as slices

SIZE = 2048
CLOSING = 0
SALTS = 64
#: pieces that one salt of a length may hold, should all have that length
SALT_ROWS = 1_000_000
VOCABULARY = "word_bpe_49k.json"
CACHED_WORDS = 1_000_000
WORDS_AT_ONCE = 20_000
AT_ONCE = 8_000_000

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: parts of one word and sentence marks, the most usual ones: two pre-tokens
_USUAL = "^(?P<w>[A-Za-z\\x{c0}-\\x{d6}\\x{d8}-\\x{f6}\\x{f8}-\\x{ff}]*)(?P<m>[.,;:!?]*)$"
#: other parts of these characters are cut into pre-tokens here: runs of letters, digits, runs of marks
_PLAIN = re.compile(r"[!-&(-~\u00df-\u00f6\u00f8-\u00ff]+")
_PRETOKEN = re.compile(r"[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff]+")


def _gather(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` one after another."""
    before = np.cumsum(size) - size
    return flat[np.repeat(start - before, size) + np.arange(size.sum())]


class Words:
    """Token ids of pre-tokens and of unusual parts, kept while there are at most ``limit``.

    The vocabulary's pre-tokenizer never joins anything across white space, so a text's ids
    are those of its parts between blanks one after another, and each part needs encoding
    once. Unseen pre-tokens are encoded many at a time and told apart by the mark that ends
    a word.
    """

    def __init__(self, path: str, limit: int = CACHED_WORDS):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.encode, self.encode_batch, self.limit = tokenizer.encode, tokenizer.encode_batch_fast, limit
        vocabulary = tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.index = {"": 0}
        self.flat, self.start, self.size = np.zeros(0, "<u4"), np.zeros(1, np.int64), np.zeros(1, np.int64)

    def _keep(self, keys: list[str], ids: np.ndarray, size: np.ndarray) -> None:
        self.index.update(zip(keys, range(len(self.start), len(self.start) + len(keys))))
        self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(size) - size])
        self.size, self.flat = np.concatenate([self.size, size]), np.concatenate([self.flat, ids])

    def _learn(self, words: list[str]) -> None:
        """Entries for pre-tokens."""
        for at in range(0, len(words), WORDS_AT_ONCE):
            own = words[at : at + WORDS_AT_ONCE]
            runs = [" ".join(own[k : k + 500]) for k in range(0, len(own), 500)]
            ids = np.concatenate([np.array(e.ids, "<u4") for e in self.encode_batch(runs, add_special_tokens=False)])
            last = np.flatnonzero(self.ends[ids])
            if len(last) != len(own):
                raise ValueError("the vocabulary does not mark the ends of words")
            self._keep(own, ids, np.diff(last, prepend=-1))

    def _learn_parts(self, parts: list[str]) -> None:
        """Entries for parts that are neither a word nor a word with sentence marks."""
        cut = {}
        for part in parts:
            low = part.lower()
            cut[part] = _PRETOKEN.findall(low) if _PLAIN.fullmatch(low) and "<|" not in low else None
        known = self.index
        self._learn(list({w for c in cut.values() if c for w in c if w not in known}))
        ids = [_gather(self.flat, self.start[at], self.size[at]) if c else np.array(self.encode(part, add_special_tokens=False).ids, "<u4")
               for part, c in cut.items() for at in [[known[w] for w in c or ()]]]
        self._keep(list(cut), np.concatenate(ids), np.array([len(x) for x in ids]))

    def _entries(self, strings: pa.Array, learn) -> np.ndarray:
        coded = strings.dictionary_encode()
        keys = coded.dictionary.to_pylist()
        fresh = [k for k in keys if k not in self.index]
        if fresh:
            learn(fresh)
        return np.fromiter((self.index[k] for k in keys), np.int64, len(keys))[coded.indices.to_numpy()]

    def ids(self, texts: list[str]) -> list[bytes]:
        if len(self.index) > self.limit:
            self._forget()
        lists = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " "), " ")
        coded = lists.flatten().dictionary_encode()
        parts, which = coded.dictionary, coded.indices.to_numpy()
        usual = pc.extract_regex(parts, _USUAL)
        is_usual = usual.is_valid().to_numpy(zero_copy_only=False)
        word, marks = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        if is_usual.any():
            both = usual.drop_null()
            word[is_usual] = self._entries(pc.utf8_lower(both.field("w")), self._learn)
            marks[is_usual] = self._entries(both.field("m"), self._learn)
        if not is_usual.all():
            word[~is_usual] = self._entries(parts.filter(pa.array(~is_usual)), self._learn_parts)
        # ids of each distinct part, then of each part of each text
        pair = np.stack([word, marks], axis=1).ravel()
        own = _gather(self.flat, self.start[pair], self.size[pair])
        size = self.size[word] + self.size[marks]
        out = _gather(own, (np.cumsum(size) - size)[which], size[which])
        ends = np.concatenate([[0], np.cumsum(size[which])])[lists.offsets.to_numpy()]
        return [out[a:b].tobytes() for a, b in zip(ends, ends[1:])]


def _slices(text: str) -> list[str]:
    """A text in pieces of about ``AT_ONCE`` characters, cut at blanks."""
    out, at = [], 0
    while len(text) - at > AT_ONCE:
        cut = text.find(" ", at + AT_ONCE)
        if cut < 0:
            break
        out.append(text[at:cut])
        at = cut
    return [*out, text[at:]]


def token_ids(cache: Words, texts: list[str | None]):
    """Ids of each text, in bounded runs."""
    run, size = [], 0
    for t in texts:
        if t is not None and len(t) > AT_ONCE:
            yield from cache.ids(run) if run else ()
            run, size = [], 0
            yield b"".join(x for part in _slices(t) for x in cache.ids([part]))
            continue
        run.append(t or "")
        size += len(run[-1])
        if size > AT_ONCE:
            yield from cache.ids(run)
            run, size = [], 0
    yield from cache.ids(run) if run else ()


def pieces(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", size: int = SIZE,
           closing: int = CLOSING, vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and the ids themselves)."""
    path = vocabulary or vocabulary_path()
    end = np.array([closing], "<u4").tobytes()
    schema = PIECES + (", ids array<bigint>" if with_ids else "")
    names = [c.split()[0] for c in schema.split(", ")]

    def cut(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        cache = Words(path)
        gc.disable()  # only acyclic data here, and a lot of it: collections would walk the cache over and over
        for batch in slices(batches):
            row, ids, number, start, length, crc = [], [], [], [], [], []
            for i, own in enumerate(token_ids(cache, batch.column("text").to_pylist())):
                own += end
                for k, at in enumerate(range(0, len(own), 4 * size)):
                    part = own[at : at + 4 * size]
                    row.append(i)
                    number.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<u4").astype(np.int64))
            out = [batch.column("doc_id").take(pa.array(row, pa.int64())), pa.array(number, pa.int32())]
            out += [pa.array(x, pa.int64()) for x in (start, length, crc)] + ([pa.array(ids, pa.list_(pa.int64()))] if with_ids else [])
            yield pa.RecordBatch.from_arrays(out, names=names)

    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return source.mapInArrow(cut, schema)


@dataclass
class Group:
    """``n`` sequences of the same make-up: ``slots`` are (length, how many, offset)."""

    n: int
    slots: list[tuple[int, int, int]]


def plan(histogram: dict[int, int], size: int = SIZE) -> list[Group]:
    """Best-fit decreasing over counts of lengths."""
    by_space: dict[int, list[Group]] = {}
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            space = min((s for s in by_space if s >= length), default=None)
            if space is None:
                fit = min(size // length, left)
                group, space = Group(left // fit, []), size
            else:
                own = by_space[space]
                group = own.pop()
                if not own:
                    del by_space[space]
                fit = min(space // length, left)
                if group.n * fit > left:
                    by_space.setdefault(space, []).append(Group(group.n - left // fit, list(group.slots)))
                    group.n = left // fit
            left -= group.n * fit
            group.slots.append((length, fit, size - space))
            by_space.setdefault(space - length * fit, []).append(group)
    return [g for own in by_space.values() for g in own]


def _runs(groups: list[Group]) -> dict[int, tuple[np.ndarray, ...]]:
    """Per length: first rank of each run of slots, its group's first sequence, slots a sequence, offset."""
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    taken: dict[int, int] = {}
    first = 0
    for g in groups:
        for length, fit, offset in g.slots:
            runs.setdefault(length, []).append((taken.get(length, 0), first, fit, offset))
            taken[length] = taken.get(length, 0) + g.n * fit
        first += g.n
    return {k: tuple(np.array(c, np.int64) for c in zip(*v)) for k, v in runs.items()}


def place(cut: DataFrame, *, size: int = SIZE, salts: int = SALTS) -> DataFrame:
    """``cut`` (staged pieces) with sequence_id and offset."""
    spark = cut.sparkSession
    # a full piece is a sequence by itself and needs no rank
    full = cut.where(F.col("length") >= size).select("*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    cut = cut.where(F.col("length") < size)
    salts = max(salts, -(-cut.count() // SALT_ROWS))
    salted = cut.withColumn("_s", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)).cast("int"))
    counts = salted.groupBy("length", "_s").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    counts = staged(counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))), "packing-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    runs = spark.sparkContext.broadcast(_runs(plan(histogram, size)))
    columns = cut.columns
    order = Window.partitionBy("length", "_s").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("_rank", F.row_number().over(order)).join(counts, ["length", "_s"])
    ranked = ranked.select(*cut.columns, (F.col("_rank") - 1 + F.col("_before")).alias("_rank"))

    def slots(batches):
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("_rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            order = np.argsort(length, kind="stable")
            for at in np.split(order, np.flatnonzero(np.diff(length[order])) + 1) if len(order) else []:
                n = int(length[at[0]])
                start, first, fit, off = runs.value[n]
                k = np.searchsorted(start, rank[at], "right") - 1
                inside = rank[at] - start[k]
                sequence[at] = first[k] + inside // fit[k]
                offset[at] = off[k] + inside % fit[k] * n
            yield extended(batch, columns, sequence_id=pa.array(sequence), offset=pa.array(offset))

    return full.unionByName(ranked.mapInArrow(slots, f"{ddl(cut.schema)}, sequence_id bigint, offset bigint"))


def pack(docs: DataFrame, *, size: int = SIZE, salts: int = SALTS, **options) -> DataFrame:
    """One row per piece with its place: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return place(staged(pieces(docs, size=size, **options), "packing-pieces"), size=size, salts=salts)
