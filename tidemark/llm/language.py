"""Language identification (operator 1) by words first, then shorter and shorter n-grams.

``fit`` counts, for each language of labelled training texts, words and the character
n-grams (1 to ``MAX_GRAM``) of its words with their ends marked. A known word is scored by
its log frequency in each language. An unseen word falls back to the longest n-gram length
at which any of its n-grams is known, and takes their mean log frequency there.

The model has a fixed bound: ``WORDS`` words and ``GRAMS`` n-grams of each length in all, the
most frequent ones, in equal parts for each language, counted over at most about
``TRAIN_DOCS`` training documents (chosen by a hash of their id, whole texts; a language with
few documents gives all of them, the others equal numbers). One plan ranks all languages'
entries; tasks cut their own share before the shuffle. Prediction covers every row.

A worker remembers at most ``REMEMBERED`` scored tokens of at most ``TOKEN`` characters (about
30 MB) and forgets them when its task ends; texts become Python strings a few hundred at a
time.

Defined cases: a text that is null or has no letter gives ``und`` with score 0. Ties go to
the language that sorts first. Rows without a language are not learned from. With no
training rows at all every text gives ``und``. Repeated rows and long texts are scored like
others; columns other than the text are never used for a prediction.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import class_fractions, hash_share_by, read, remainder, stored

TRAIN_DOCS = 8_000
WORDS, GRAMS, MAX_GRAM = 80_000, 24_000, 4  # of all languages together
UNKNOWN = "und"
LETTERS = re.compile(r"[^\W\d_]+")
#: Tokens whose score a worker keeps, and their greatest length; the memory starts anew beyond it.
REMEMBERED, TOKEN = 120_000, 64
SLICE = 256  # texts that are Python strings at one time


def word_counts(training: DataFrame) -> DataFrame:
    """lang, word, n over the training texts (columns lang, text)."""
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), F.lit(1))
    return (training.select("lang", F.explode(words).alias("word"))
            .groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")))


def gram_counts(words: DataFrame) -> DataFrame:
    """lang, size, gram, n of the n-grams of words with marked ends."""
    marked = F.concat(F.lit("^"), "word", F.lit("$"))

    def of_size(size: int) -> Column:  # a lambda's second parameter would be the index
        starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length("marked") - size + 1))
        return F.transform(starts, lambda i: F.struct(F.lit(size).alias("size"), F.substring(F.col("marked"), i, F.lit(size)).alias("gram")))

    sizes = [of_size(size) for size in range(1, MAX_GRAM + 1)]
    rows = words.withColumn("marked", marked).select("lang", "n", F.inline(F.concat(*sizes)))
    return rows.groupBy("lang", "size", "gram").agg(F.sum("n").alias("n"))


class Model:
    """Log frequencies of words and n-grams by language, one row of a matrix each; scores tokens and texts."""

    def __init__(self, languages: list[str], words: dict[str, dict[str, int]], grams: dict[int, dict[str, dict[str, int]]]):
        self.languages = languages
        self.words: dict[str, int] = {}
        self.grams: dict[int, dict[str, int]] = {}
        parts, n = [], 0
        for size, table in [(0, words), *sorted(grams.items())]:
            own = dict(zip(table, range(n, n + len(table)), strict=True))
            parts.append(self._logs(table))
            n += len(table)
            if size:
                self.grams[size] = own
            else:
                self.words = own
        self.matrix = np.concatenate(parts) if n else np.zeros((0, len(languages)))
        self.forget()

    def _logs(self, table: dict[str, dict[str, int]]) -> np.ndarray:
        counts = np.array([[c.get(lang, 0) for lang in self.languages] for c in table.values()], float)
        counts = counts.reshape(len(table), len(self.languages))
        return np.log((counts + 0.5) / (counts.sum(0) + max(1, len(table))))

    def forget(self) -> None:
        """An empty memory of tokens."""
        self.memory: dict[str, int] = {}
        self.rows = np.zeros((0, len(self.languages) + 1))

    def __getstate__(self):
        return self.__dict__ | {"memory": {}, "rows": np.zeros((0, len(self.languages) + 1))}

    def _entries(self, word: str) -> list[int]:
        """The rows of the matrix whose mean is the word's score: its own, or its n-grams' of the
        longest size at which any is known, or none."""
        known = self.words.get(word)
        if known is not None:
            return [known]
        marked = f"^{word}$"
        for size in range(MAX_GRAM, 0, -1):
            table = self.grams.get(size, {})
            found = [k for i in range(len(marked) - size + 1) if (k := table.get(marked[i:i + size])) is not None]
            if found:
                return found
        return []

    def scores(self, tokens: list[str]) -> np.ndarray:
        """A row for each white-space token: the summed scores of its words, and their number."""
        entries, shares, owners, words = [], [], [], []
        for t, token in enumerate(tokens):
            found = LETTERS.findall(token)
            words.append(len(found))
            for w in found:
                own = self._entries(w)
                if own:
                    entries += own
                    shares += [1 / len(own)] * len(own)
                    owners += [t] * len(own)
        out = np.zeros((len(tokens), len(self.languages) + 1))
        out[:, -1] = words
        if entries:
            each = self.matrix[entries] * np.array(shares)[:, None]
            for j in range(len(self.languages)):
                out[:, j] = np.bincount(owners, each[:, j], len(tokens))
        return out

    def total(self, text: str) -> np.ndarray:
        """Summed log scores for each language, and the number of words."""
        total, tokens = np.zeros(len(self.languages) + 1), text.lower().split()
        if not len(self.rows):
            self.rows = np.zeros((REMEMBERED, len(self.languages) + 1))
        for at in range(0, len(tokens), 10_000):
            part = tokens[at:at + 10_000]
            if len(self.memory) + len(part) > REMEMBERED:
                self.memory.clear()
            rows = list(map(self.memory.get, part))
            if None in rows:
                missing = [t for t, row in zip(part, rows, strict=True) if row is None]
                total += self.scores([t for t in missing if len(t) > TOKEN]).sum(0)
                new = list(dict.fromkeys(t for t in missing if len(t) <= TOKEN))
                first = len(self.memory)
                self.rows[first:first + len(new)] = self.scores(new)
                self.memory.update(zip(new, range(first, first + len(new)), strict=True))
                rows = [row for t in part if (row := self.memory.get(t)) is not None]
            total += self.rows[rows].sum(0)
        return total

    def predict(self, text: str | None) -> tuple[str, float]:
        *scores, words = self.total(text) if text and self.languages else (0,)
        if not words:
            return UNKNOWN, 0.0
        scores = np.array(scores) / math.sqrt(words)  # words are not independent witnesses
        odds = np.exp(scores - scores.max())
        best = int(odds.argmax())
        return self.languages[best], float(odds[best] / odds.sum())


def fit(documents: DataFrame, trainable: Column) -> Model:
    """The model of the rows that satisfy ``trainable`` (columns doc_id, text, lang)."""
    rows = documents.where(trainable & F.col("lang").isNotNull())
    shares = class_fractions(TRAIN_DOCS, {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()})
    chosen = rows.where(hash_share_by(F.col("doc_id"), F.col("lang"), shares, 1)).select("lang", "text")
    words = stored(word_counts(chosen), "language-words")
    languages = sorted(r.lang for r in words.select("lang").distinct().collect())
    known: dict[str, dict[str, int]] = {}
    by_size: dict[int, dict[str, dict[str, int]]] = {}
    if languages:
        entries = words.select("lang", F.lit(0).alias("size"), F.col("word").alias("entry"), "n").unionByName(
            gram_counts(words).select("lang", "size", F.col("gram").alias("entry"), "n"))
        most = F.when(F.col("size") == 0, max(1, WORDS // len(languages))).otherwise(max(1, GRAMS // len(languages)))
        place = F.row_number().over(Window.partitionBy("lang", "size").orderBy(F.desc("n"), "entry"))
        largest = max(1, max(WORDS, GRAMS) // len(languages))  # a plain bound, so that tasks cut before the shuffle
        ranked = entries.withColumn("place", place).where(F.col("place") <= largest).where(F.col("place") <= most)
        for r in ranked.select("lang", "size", "entry", "n").collect():  # at most WORDS + MAX_GRAM * GRAMS, or one a language
            table = by_size.setdefault(r.size, {}) if r.size else known
            table.setdefault(r.entry, {})[r.lang] = r.n
    return Model(languages, known, by_size)


def predictor(spark, model: Model):
    """A column function: text -> struct(lang_pred, score)."""
    shared = spark.sparkContext.broadcast(model)
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64())])

    @F.arrow_udf(T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        try:
            for texts in batches:
                rows = [model.predict(t) for at in range(0, len(texts), SLICE) for t in texts.slice(at, SLICE).to_pylist()]
                yield pa.array([{"lang_pred": lang, "score": score} for lang, score in rows], kind)
        finally:
            model.forget()

    return run.asNondeterministic()


def op1_language_id(spark, sf_dir: str) -> DataFrame:
    """Language of every document, learned where crc32(doc_id) mod 5 is not 0."""
    docs = read(spark, sf_dir, "documents")
    model = fit(docs, remainder("doc_id", 5) != 0)
    return docs.select("doc_id", F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
                       predictor(spark, model)("text").alias("_tm")).select("doc_id", "held_out", "_tm.*")


QUERIES = {"op1_language_id": op1_language_id}
