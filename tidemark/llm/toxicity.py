"""Toxicity (operator 5): a learned lexicon matched with Levenshtein automata.

Learning. Labelled training documents are dealt to two halves by a hash of their id. On the
first half (copies, told by their least shingle, count once) every word gets its number of
toxic and of clean documents. Words whose share of toxic documents is too high for chance,
given how many words were tried, form the *lexicon*; word beginnings that only toxic words
share become *stems* (families of inflected terms). On the second half the weights of the
score are fitted, so that they see unseen words the way later texts show them.

Matching. The lexicon is a trie. A Levenshtein automaton for a token is run along its
branches (the rows of the edit matrix are its states, one row for each trie node), and a
branch is left as soon as no state can accept within one edit; swapping two neighbouring
letters is one edit too. A pigeonhole test on the intact beginning or end of a term keeps
nearly all other tokens away from the automaton. Words that clean training documents use
are never taken for misspellings.

Context. Each hit is scored by a window around it: hits between quotation marks, or near a
word that reports speech, count as quoted; the rest count as abuse. A logistic curve over
abusive hits (misspelled ones weigh less), their density and quoted hits gives the score.

Bounds: at most about ``TRAIN_DOCS`` labelled documents (whole texts, chosen by a hash of
the id; of the rarer label up to half of them, which the shares of words and the weights of
the score allow for), ``TERMS`` terms, ``STEMS`` stems and ``CLEAN`` clean look-alikes. Every
row is scored over its whole text.

Defined cases: a null or empty text has no hits and gets the score of that. Without toxic
or without clean training documents every score is the share of toxic labels. Repeated rows
get equal scores. Only the text is used for a score.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import class_fractions, hash_share, hash_share_by, read, remainder, stored
from tidemark.llm.near_dedup import shingle_set

TRAIN_DOCS = 16_000
TERMS, STEMS, CLEAN = 4_000, 1_000, 50_000
#: Documents that a word needs to be tried, its least share of toxic ones among them, how much rarer
#: than one in the number of words a chance result must be (log), and the shortest term matched with an edit.
SUPPORT, PRECISION, MARGIN, FUZZY_LENGTH = 3, 0.7, 1.0, 4
STEM_SIZES, STEM_WORDS = range(4, 9), 5
WINDOW, THRESHOLD = 6, 0.7
EXACT, FUZZY = 1, 2
#: Weight of a misspelled hit against an exact one.
MISSPELLED = 0.7
#: Tokens whose match a worker keeps; the memory starts anew beyond it.
REMEMBERED = 500_000

# Quotation marks and words that report speech.
OPENING, CLOSING = "\"“”„«»‘'‹", "\"“”»«’'›"
REPORTING = frozenset("said says wrote called quote quoted term word sagte schrieb nannte zitat wort begriff "
                      "dit écrit appelé citation mot terme dijo escribió llamó cita palabra término".split())
EDGE = re.compile(r"^[\W_]+|[\W_]+$")


def bare(token: str) -> str:
    """A lower-case token without the marks around it; marks inside stay."""
    return token if token.isalnum() else EDGE.sub("", token)


# ------------------------------------------------------------------------------ matching

class Lexicon:
    """Terms as a trie, matched by automata that allow one edit; stems matched as beginnings."""

    def __init__(self, terms: list[str], stems: list[str], clean: list[str]):
        self.terms, self.stems, self.clean = frozenset(terms), frozenset(stems), frozenset(clean)
        self.stem_sizes = sorted({len(s) for s in stems})
        self.trie: dict = {}
        self.heads: dict[str, set[int]] = {}
        self.tails: dict[str, set[int]] = {}
        for term in terms:
            if len(term) < FUZZY_LENGTH:
                continue
            node = self.trie
            for letter in term:
                node = node.setdefault(letter, {})
            node[""] = term
            half = len(term) // 2  # one edit, or a swap over the middle, leaves one of these whole
            self.heads.setdefault(term[:max(1, half - 1)], set()).add(len(term))
            self.tails.setdefault(term[half + 1:], set()).add(len(term))
        self.head_sizes = sorted({len(h) for h in self.heads})
        self.tail_sizes = sorted({len(t) for t in self.tails})

    def stem(self, word: str) -> bool:
        return any(word[:n] in self.stems for n in self.stem_sizes)

    def _possible(self, word: str) -> bool:
        size = len(word)
        near = lambda sizes: sizes is not None and (size in sizes or size - 1 in sizes or size + 1 in sizes)
        return any(near(self.heads.get(word[:n])) for n in self.head_sizes) or any(
            near(self.tails.get(word[size - n:])) for n in self.tail_sizes if n <= size)

    def accepts(self, word: str) -> str | None:
        """A term within one edit of ``word``: the automaton of the word meets the trie."""
        stack = [(self.trie, tuple(range(len(word) + 1)), None, "")]
        while stack:
            node, row, before, last = stack.pop()
            term = node.get("")
            if term is not None and row[-1] <= 1:
                return term
            for letter, child in node.items():
                if not letter:
                    continue
                state = [row[0] + 1]
                for i, own in enumerate(word):
                    cost = min(state[i] + 1, row[i + 1] + 1, row[i] + (own != letter))
                    if before is not None and i and own == last and word[i - 1] == letter:
                        cost = min(cost, before[i - 1] + 1)
                    state.append(cost)
                if min(state) <= 1:
                    stack.append((child, tuple(state), row, letter))
        return None

    def match(self, token: str) -> int:
        """0, EXACT or FUZZY for a lower-case token."""
        word = bare(token)
        if not word:
            return 0
        if word in self.terms or self.stem(word):
            return EXACT
        if len(word) < FUZZY_LENGTH - 1 or word in self.clean or not self._possible(word):
            return 0
        return FUZZY if self.accepts(word) else 0


class Matcher:
    """Hits of whole texts, with the matches of tokens kept in a bounded memory."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon, self.memory = lexicon, {}

    def __getstate__(self):
        return {"lexicon": self.lexicon, "memory": {}}

    def hits(self, tokens: list[str]) -> list[tuple[int, int]]:
        kinds = list(map(self.memory.get, tokens))
        if None in kinds:
            if len(self.memory) > REMEMBERED:
                self.memory.clear()
            for i, kind in enumerate(kinds):
                if kind is None:
                    kinds[i] = self.memory[tokens[i]] = self.lexicon.match(tokens[i])
        return [(i, kind) for i, kind in enumerate(kinds) if kind] if any(kinds) else []


def quoted(tokens: list[str], at: int) -> bool:
    """Whether the window around a hit shows a quotation rather than abuse."""
    left, right = tokens[max(0, at - WINDOW):at + 1], tokens[at:at + WINDOW + 1]
    opened = any(t[0] in OPENING for t in left)
    closed = any(t.rstrip(".,;:!?")[-1:] in CLOSING and len(t) > 1 for t in right)
    return (opened and closed) or any(bare(t) in REPORTING for t in left[:-1] + right[1:])


def features(matcher: Matcher, text: str | None) -> list[float]:
    tokens = (text or "").lower().split()
    abuse = fuzzy = cited = 0
    for at, kind in matcher.hits(tokens):
        if quoted(tokens, at):
            cited += 1
        elif kind == EXACT:
            abuse += 1
        else:
            fuzzy += 1
    hits = abuse + MISSPELLED * fuzzy  # misspellings are too rare in labels for a weight of their own
    dense = 100 * hits / len(tokens) if tokens else 0.0
    return [math.log1p(hits), min(1.0, hits), math.log1p(cited), math.log1p(dense)]


# ------------------------------------------------------------------------------ learning

def _document_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, toxic) once for each distinct word of a document."""
    for batch in batches:
        for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = {w for t in set((text or "").lower().split()) if 2 < len(w := bare(t)) <= 40}
            yield pa.RecordBatch.from_arrays([pa.array(list(words), pa.string()),
                                              pa.array([toxic] * len(words), pa.int32())], names=["word", "toxic"])


def _least_shingle(texts: pd.Series) -> pd.Series:
    """Equal for copies, and for most near copies, of a text."""
    return pd.Series([int(s[0].view(np.int64)) if len(s := shingle_set(t)) else 0 for t in texts])


def learn_lexicon(labelled: DataFrame, shares: dict[int, float] | None = None) -> Lexicon:
    """The lexicon of labelled texts (columns toxic, text), sampled with these shares by label."""
    shares = shares or {0: 1.0, 1: 1.0}
    once = labelled.withColumn("least", F.pandas_udf(_least_shingle, "long")("text")).dropDuplicates(["least", "toxic"])
    once = stored(once.select(F.col("toxic").cast("int").alias("toxic"), "text"), "toxic-once")
    toxic, clean = once.select(F.count(F.when(F.col("toxic") == 1, 1)), F.count(F.when(F.col("toxic") == 0, 1))).first()
    if not toxic or not clean:
        return Lexicon([], [], [])
    words = stored(once.mapInArrow(_document_words, "word string, toxic int")
                   .groupBy("word").agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good")),
                   "toxic-words")

    def beyond_chance(df: DataFrame) -> DataFrame:
        """Rows (bad, good) whose toxic share is no accident among as many rows as there are."""
        tried = df.where(F.col("bad") + F.col("good") >= SUPPORT)
        share, usual = F.col("bad") / (F.col("bad") + F.col("good")), toxic / (toxic + clean)
        bad, good = F.col("bad") / shares[1], F.col("good") / shares[0]  # in all labelled documents
        surprise = (F.col("bad") * F.log(share / usual)
                    + F.when(F.col("good") > 0, F.col("good") * F.log((1 - share) / (1 - usual))).otherwise(0.0))
        needed = math.log(max(1, tried.count())) + MARGIN
        return tried.where((F.col("bad") > 0) & (bad / (bad + good) >= PRECISION) & (surprise >= needed))

    terms = [r.word for r in beyond_chance(words).orderBy(F.desc("bad"), "word").limit(TERMS).collect()]
    starts = F.array(*[F.when(F.length("word") >= n, F.substring("word", 1, n)) for n in STEM_SIZES])
    families = beyond_chance(words.select(F.explode(F.array_compact(starts)).alias("stem"), "bad", "good")
                             .groupBy("stem").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"),
                                                  F.count(F.when(F.col("bad") > 0, 1)).alias("n"))
                             .where((F.col("n") >= STEM_WORDS) & (F.col("good") == 0)))
    stems: list[str] = []
    for r in families.orderBy(F.length("stem"), F.desc("bad"), "stem").limit(STEMS).collect():
        if not any(r.stem.startswith(s) for s in stems):
            stems.append(r.stem)
    lexicon = Lexicon(terms, stems, [])

    def look_alikes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([lexicon.match(w) == FUZZY for w in batch.column(0).to_pylist()], pa.bool_())
            yield batch.filter(found)

    near = (words.where("good > 0").select("word", "good").mapInArrow(look_alikes, "word string, good long")
            .orderBy(F.desc("good"), "word").limit(CLEAN).collect())
    return Lexicon(terms, stems, [r.word for r in near])


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, counted: np.ndarray | float = 1.0) -> np.ndarray:
    """Ridge logistic weights (last: constant), by Newton steps; ``counted``: rows that each row stands for."""
    design, w = np.c_[x, np.ones(len(x))], np.zeros(x.shape[1] + 1)
    keep = ridge * np.diag([*np.ones(x.shape[1]), 1e-3])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        curve = design.T @ (design * (counted * p * (1 - p))[:, None]) + keep + 1e-9 * np.eye(len(w))
        w = w + np.clip(np.linalg.solve(curve, design.T @ (counted * (y - p)) - keep @ w), -3, 3)
    return w


class Model:
    def __init__(self, lexicon: Lexicon, weights: np.ndarray):
        self.matcher, self.weights = Matcher(lexicon), weights

    def score(self, texts) -> np.ndarray:
        rows = np.array([features(self.matcher, t) for t in texts], float).reshape(-1, len(self.weights) - 1)
        return 1 / (1 + np.exp(-np.clip(rows @ self.weights[:-1] + self.weights[-1], -30, 30)))


def fit(documents: DataFrame, labels: DataFrame, trainable: Column) -> Model:
    """The model of documents (doc_id, text) and their labels (doc_id, toxic); labels of rows
    that do not satisfy ``trainable`` are not looked at."""
    known = labels.where(trainable & F.col("toxic").isin(0, 1)).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    total, ones = known.select(F.count(F.lit(1)), F.count(F.when(F.col("toxic") == 1, 1))).first()
    shares = class_fractions(TRAIN_DOCS, {0: total - ones, 1: ones})
    chosen = known.where(hash_share_by(F.col("doc_id"), F.col("toxic"), shares, 6))
    texts = stored(documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # a sample of stated size
                   .withColumn("first", hash_share(F.col("doc_id"), 0.6, 7)), "toxic-texts")
    lexicon = learn_lexicon(texts.where("first"), shares)
    matcher = Matcher(lexicon)

    def second_half(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"toxic": batch["toxic"], "x": [features(matcher, t) for t in batch["text"]]})

    rows = texts.where(~F.col("first")).select("toxic", "text").mapInPandas(second_half, "toxic int, x array<double>").toPandas()
    width = len(features(Matcher(Lexicon([], [], [])), ""))
    if not lexicon.terms or rows["toxic"].nunique() < 2:
        share = (ones + 1) / (total + 2)
        return Model(lexicon, np.r_[np.zeros(width), math.log(share / (1 - share))])
    toxic, most = rows["toxic"].to_numpy(float), max(shares.values())
    counted = np.where(toxic == 1, most / shares[1], most / shares[0])  # as among all labelled documents
    return Model(lexicon, logistic(np.array(rows["x"].tolist()), toxic, counted=counted))


def scorer(spark, model: Model):
    """A column function: text -> score."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(shared.value.score(texts))

    return run.asNondeterministic()


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned where crc32(doc_id) mod 3 is not 1."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = fit(docs, labels, remainder("doc_id", 3) != 1)
    scored = docs.select("doc_id", F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
                         scorer(spark, model)("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


QUERIES = {"op5_toxicity": op5_toxicity}
