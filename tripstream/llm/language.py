"""Language identification: known words first, then ever shorter character n-grams.

A word that the learned vocabulary holds scores its log frequency in each language.
An unseen word is cut into character n-grams (word ends marked) of the longest length
of which the model knows any, falling back from ``ORDERS[0]`` to single characters,
and scores their mean log frequency. The language with the highest sum wins, ties go
to the smaller code; the score is its share of the posterior with equal priors.

The model is fitted on a bounded sample of labelled rows: about ``sample_rows`` per
language, drawn by a hash of the row (all rows of a language that has no more). Every word
of the sample counts, once-seen ones too, so a language with a single labelled row is
learned. Every document is judged on its whole text.

Defined cases: a null text, an empty one, or one without a letter is ``und`` with
score 0; without labelled rows every document is ``und``; a document none of whose words
or characters the model knows scores the same in all languages and gets the smallest code;
repeated rows get the same answer; an empty table gives no rows; extra columns are ignored,
or carried by ``kept``.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstream.llm.common import carried, ddl, extended, pieces

UNKNOWN = "und"
ORDERS = (4, 3, 2, 1)
SAMPLE_ROWS = 500
CACHED_WORDS = 200_000
MIN_SCORE = 0.5

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def has_letter(words: list[str]) -> bool:
    return any(c.isalpha() for w in words for c in w)


def _grams(word: str, n: int) -> list[str]:
    w = f"<{word}>" if n > 1 else word
    return [w[i : i + n] for i in range(len(w) - n + 1)]


class Model:
    """Log frequencies per language of words and of character n-grams."""

    def __init__(self, counts: dict[str, dict[str, int]]):
        self.languages = sorted(counts)
        index = {x: i for i, x in enumerate(self.languages)}
        words: dict[str, np.ndarray] = {}
        grams: dict[int, dict[str, np.ndarray]] = {n: {} for n in ORDERS}
        zero = np.zeros(len(index))
        for lang, own in counts.items():
            for w, c in sorted(own.items()):
                words.setdefault(w, zero.copy())[index[lang]] += c
                for n in ORDERS:
                    for g in _grams(w, n):
                        grams[n].setdefault(g, zero.copy())[index[lang]] += c
        self.words, self.word_logs = self._logs(words)
        self.grams = {n: self._logs(x) for n, x in grams.items()}

    @staticmethod
    def _logs(table: dict[str, np.ndarray]) -> tuple[dict[str, int], np.ndarray]:
        rows = np.array(list(table.values())) if table else np.zeros((0, 1))
        return {k: i for i, k in enumerate(table)}, np.log((rows + 0.5) / (rows.sum(axis=0) + 0.5 * len(table)))

    @classmethod
    def of(cls, state: dict) -> "Model":
        """From ``vars()`` of another, which is plain data."""
        model = cls.__new__(cls)
        vars(model).update(state)
        return model

    def score(self, word: str) -> np.ndarray:
        known = self.words.get(word)
        if known is not None:
            return self.word_logs[known]
        for n in ORDERS:
            index, logs = self.grams[n]
            known = [index[g] for g in _grams(word, n) if g in index]
            if known:
                return logs[known].mean(axis=0)
        return np.zeros(len(self.languages))


class Judge(dict):
    """Word -> row of ``rows``; the cache is emptied at ``limit`` words."""

    def __init__(self, model: Model, limit: int = CACHED_WORDS):
        super().__init__()
        self.model, self.limit = model, limit
        self.rows = np.zeros((1024, len(model.languages)))

    def __missing__(self, word: str) -> int:
        k = len(self)
        if k == len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.rows[k] = self.model.score(word)
        self[word] = k
        return k

    def judge(self, text: str | None) -> tuple[str, float]:
        words = words_of(text) if isinstance(text, str) else []
        if not self.model.languages or not has_letter(words):
            return UNKNOWN, 0.0
        if len(self) > self.limit:
            self.clear()
        at = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        total = self.rows[at].sum(axis=0)
        best = int(total.argmax())
        return self.model.languages[best], float(1 / np.exp(np.minimum(total - total[best], 0)).sum())


def fit(labelled: DataFrame, *, text: str = "text", lang: str = "lang", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn from at most about ``sample_rows`` rows of each language (rows without label or text are left out)."""
    rows = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in labelled.where(F.col(lang).isNotNull()).groupBy(F.col(lang).alias("lang")).agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model({})
    part = F.lit(0.0)
    for x, n in sizes.items():
        part = F.when(F.col("lang") == x, F.lit(min(1.0, sample_rows / n))).otherwise(part)
    drawn = rows.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < part * (1 << 20))

    def counted(batches):
        for pdf in batches:
            own: dict[str, Counter] = {}
            for x, t in zip(pdf["lang"], pdf["text"]):
                own.setdefault(x, Counter()).update(words_of(t))
            yield pd.DataFrame([(x, w, n) for x, c in own.items() for w, n in c.items()], columns=["lang", "word", "n"])

    counts = drawn.mapInPandas(counted, "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    got: dict[str, dict[str, int]] = {x: {} for x in sizes}
    for r in counts.toLocalIterator():  # bounded: the words of ``sample_rows`` texts of each language
        got[r["lang"]][r["word"]] = r["n"]
    return Model({x: words for x, words in got.items() if words})


def identify(docs: DataFrame, model: Model, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns of ``keep`` (all by default) with ``_lang`` and ``_score``."""
    frame, inner, names = carried(docs)
    keep = names if keep is None else keep
    kept = frame.select(*[inner[names.index(c)] for c in keep])
    columns, key = kept.columns, inner[names.index(text)]
    model_b = docs.sparkSession.sparkContext.broadcast(vars(model))

    def judged(batches):
        judge = Judge(Model.of(model_b.value))
        for batch in pieces(batches):
            found = [judge.judge(t) for t in batch.column(key).to_pylist()]
            yield extended(batch, columns, _lang=pa.array([x for x, _ in found], pa.string()), _score=pa.array([s for _, s in found], pa.float64()))

    return frame.mapInArrow(judged, f"{ddl(kept.schema)}, _lang string, _score double").toDF(*keep, "_lang", "_score")


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def report(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", **options) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learned from the rows that are not held out."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    model = fit(rows.where(~held_out()), **options)
    out = identify(rows.select("doc_id", held_out().alias("held_out"), "text"), model, keep=["doc_id", "held_out"])
    return out.select("doc_id", "held_out", F.col("_lang").alias("lang_pred"), F.col("_score").alias("score"))


def kept(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", min_score: float = MIN_SCORE, **options) -> DataFrame:
    """The documents whose language is known with at least ``min_score``, unchanged."""
    model = fit(docs.where(~held_out(doc_id)), text=text, **options)
    frame, inner, names = carried(docs)
    judged = identify(frame, model, text=inner[names.index(text)])
    return judged.where((F.col("_lang") != UNKNOWN) & (F.col("_score") >= min_score)).select(*inner).toDF(*names)
