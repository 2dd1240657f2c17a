"""Quality rules as weak supervision (operator 11).

Each rule looks at counts of a whole text and votes good (1), bad (-1) or abstains (0). No
label is used. Expectation-maximisation over all documents estimates, for each rule, how
often its vote is right on good and on bad texts, and the share of good texts. The posterior
probability of "good" under these estimates replaces "all rules must pass".

The latent model: a text is good with probability ``prior``; a rule that votes says good with
probability ``accuracy_good`` on a good text and bad with probability ``accuracy_bad`` on a
bad one, independently of other rules; an abstention tells nothing. The estimates weigh the data
against a stated belief (``BELIEF``) that counts as much as the table itself: kinds of bad
text that a single rule sees leave no agreement between rules to learn from, and without it
the likelihood explains only the kind that several rules see. All documents count: what
leaves the executors is one row for each distinct pattern of votes, at most 3 ** 10 of them,
which is also the exact input of the estimation.

Counts come from one Arrow pass over the texts; votes compare integers and posteriors are
sums of one weight a rule, both as column expressions.

Defined cases: a null or empty text has no words and all counts 0; every rule that needs
words abstains, and ``base_failed`` holds. A text that fails the base is never kept. Repeated
rows count as often as they occur and get equal results. An empty table gives no rows, and
priors alone decide. Columns other than doc_id and text are not looked at. A text is held
whole in memory, one at a time with its words; there is no cap on its length.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import read, stored

SPACES = " \t\n\r\x0b\x0c"  # what separates words
SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals",
          "n_exclaims", "n_bars", "n_digits", "n_stutters")

#: Fixed values of the base: fewest words, and the most of them in repeated windows (per cent).
BASE_WORDS, BASE_REPEATED = 50, 50

#: name, bad if, good if; else the rule abstains. Per cent of words or lines, as integers.
RULES = (
    ("symbols", "100 * n_symbols > 10 * n_words", "n_words > 0 and 100 * n_symbols <= 2 * n_words"),
    ("capitals", "100 * n_capitals > 30 * n_words", "n_words > 0 and 100 * n_capitals <= 10 * n_words"),
    ("exclamations", "100 * n_exclaims > 15 * n_words", "n_words > 0 and 100 * n_exclaims <= 3 * n_words"),
    ("bars", "100 * n_bars > 10 * n_words", "n_words > 0 and 100 * n_bars <= 1 * n_words"),
    ("word_length", "n_words > 0 and (word_chars < 2 * n_words or word_chars > 12 * n_words)",
     "word_chars >= 3 * n_words and word_chars <= 10 * n_words and n_words > 0"),
    ("digits", "100 * n_digits > 25 * word_chars", "n_words > 0 and 100 * n_digits <= 10 * word_chars"),
    ("stutters", "100 * n_stutters > 8 * n_words", "n_words > 0 and 100 * n_stutters <= 3 * n_words"),
    ("repeated_words", "100 * n_repeat_words > 40 * n_words", "n_words > 0 and 100 * n_repeat_words <= 15 * n_words"),
    ("repeated_lines", "100 * n_dup_lines > 40 * n_lines", "n_lines > 0 and 100 * n_dup_lines <= 10 * n_lines"),
)
assert len(RULES) <= 10  # at most 59,049 patterns of votes

#: What is believed beforehand of the share of good texts, and of a rule's accuracy on good and
#: on bad texts: false alarms are rare, and one rule sees only some kinds of bad text.
BELIEF = (0.5, 0.995, 0.2)
#: Weight of that belief: this many times the number of documents, and so many rows besides.
BELIEF_SHARE, BELIEF_ROWS = 1.0, 2.0
ROUNDS = 30
KEEP = 0.5  # least posterior of a kept document


def _repeated(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more."""
    windows = list(zip(words, words[1:], words[2:]))  # noqa: B905  the shortest ends it
    if len(set(windows)) == len(windows):
        return 0
    often = {w for w, n in Counter(windows).items() if n > 1}
    covered, end = 0, 0
    for at, window in enumerate(windows):
        if window in often:
            covered += at + 3 - max(at, end)
            end = at + 3
    return covered


def counts(text: str | None) -> tuple[int, ...]:
    """The ``COUNTS`` of a whole text."""
    if not text:
        return (0,) * len(COUNTS)
    words = text.encode("utf-8", "surrogatepass").split()  # bytes split at the six ASCII spaces only
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        _repeated(words),
        len(lines),
        sum(len(w) > 1 for w in words if w.isupper()),  # of bytes: A-Z but no a-z
        text.count("!"),
        text.count("|"),
        sum(map(text.count, "0123456789")),
        sum(a == b for a, b in zip(words, words[1:])),  # noqa: B905
    )


def counted(documents: DataFrame) -> DataFrame:
    """doc_id and the counts of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([counts(t) for t in batch.column(1).to_pylist()], np.int64).reshape(-1, len(COUNTS))
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, rows.T)], ["doc_id", *COUNTS])

    narrow = documents.select("doc_id", "text")
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in COUNTS))


def base_failed() -> Column:
    """The fixed part: too short, or mostly repeated."""
    return (F.col("n_words") < BASE_WORDS) | (100 * F.col("n_repeat_words") > BASE_REPEATED * F.col("n_words"))


def votes() -> list[Column]:
    """One column a rule: 1 good, -1 bad, 0 abstains."""
    return [F.when(F.expr(bad), -1).when(F.expr(good), 1).otherwise(0).cast("byte").alias(f"vote_{name}")
            for name, bad, good in RULES]


class LabelModel:
    """Estimated share of good texts, and each rule's accuracy on good and on bad texts."""

    def __init__(self, prior: float, on_good: np.ndarray, on_bad: np.ndarray):
        self.prior, self.on_good, self.on_bad = prior, on_good, on_bad

    def weights(self) -> tuple[float, np.ndarray, np.ndarray]:
        """The prior's log odds, and what a good and a bad vote of each rule add to them."""
        return (math.log(self.prior / (1 - self.prior)), np.log(self.on_good / (1 - self.on_bad)),
                np.log((1 - self.on_good) / self.on_bad))

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        start, good, bad = self.weights()
        odds = start + (patterns == 1) @ good + (patterns == -1) @ bad
        return 1 / (1 + np.exp(-np.clip(odds, -700, 700)))

    def posterior_column(self) -> Column:
        start, good, bad = self.weights()
        odds = F.lit(start)
        for (name, _, _), g, b in zip(RULES, good, bad, strict=True):
            vote = F.col(f"vote_{name}")
            odds = odds + F.when(vote == 1, float(g)).when(vote == -1, float(b)).otherwise(0.0)
        return 1 / (1 + F.exp(-odds))


def estimate(patterns: np.ndarray, n: np.ndarray) -> LabelModel:
    """Expectation-maximisation over distinct vote patterns and their numbers of documents."""
    share, on_good, on_bad = BELIEF
    total, k = n.sum(), BELIEF_SHARE * n.sum() + BELIEF_ROWS
    model = LabelModel(share, np.full(patterns.shape[1], on_good), np.full(patterns.shape[1], on_bad))
    good, bad = (patterns == 1), (patterns == -1)
    for _ in range(ROUNDS):
        is_good = n * model.posterior(patterns)
        is_bad = n - is_good
        right, missed = good.T @ is_good, good.T @ is_bad
        alarm, caught = bad.T @ is_good, bad.T @ is_bad
        model = LabelModel(float((is_good.sum() + k * share) / (total + k)),
                           (right + k * on_good) / (right + alarm + k), (caught + k * on_bad) / (missed + caught + k))
    return model


def fit(voted: DataFrame) -> LabelModel:
    """The model of a table with the rules' votes: patterns are counted in Spark, and at most
    3 ** len(RULES) of them are collected."""
    names = [f"vote_{name}" for name, _, _ in RULES]
    rows = voted.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).orderBy(*names).collect()
    flat = np.fromiter(chain.from_iterable(r[:-1] for r in rows), np.int64)
    return estimate(flat.reshape(len(rows), len(names)), np.array([r[-1] for r in rows], float))


def judged(documents: DataFrame) -> DataFrame:
    """doc_id, counts, votes, base_failed, posterior and kept of every document. The counts are
    written once: the estimation and the result read them, not the texts."""
    voted = stored(counted(documents).select("*", *votes()), "rules-votes")
    model = fit(voted)
    return (voted.withColumn("base_failed", base_failed()).withColumn("posterior", model.posterior_column())
            .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= KEEP)))


def op11_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Counts, base and verdict of every document."""
    return judged(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _oracle() -> str:
    """The same in SQL; the estimation is a recursion over the table of vote patterns."""
    rules = range(len(RULES))
    each = lambda f, sep=", ": sep.join(f(j) for j in rules)
    vote = lambda j: f"CASE WHEN {RULES[j][1]} THEN -1 WHEN {RULES[j][2]} THEN 1 ELSE 0 END AS v{j}"
    odds = "ln(prior / (1 - prior)) + " + each(
        lambda j: f"CASE v{j} WHEN 1 THEN ln(g{j} / (1 - b{j})) WHEN -1 THEN ln((1 - g{j}) / b{j}) ELSE 0 END", " + ")
    share, on_good, on_bad = BELIEF
    summed = lambda what, j, v: f"coalesce(sum({what}) FILTER (v{j} = {v}), 0)"
    k = f"({BELIEF_SHARE} * sum(n) + {BELIEF_ROWS})"
    again = lambda j: (
        f"({summed('w', j, 1)} + {k} * {on_good}) / ({summed('w', j, 1)} + {summed('w', j, -1)} + {k}), "
        f"({summed('n - w', j, -1)} + {k} * {on_bad}) / ({summed('n - w', j, 1)} + {summed('n - w', j, -1)} + {k})")
    word = r"[^\x20\x09-\x0D]+"
    return f"""
WITH RECURSIVE texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
words AS (SELECT r, unnest(regexp_extract_all(text, '{word}')) AS w, generate_subscripts(regexp_extract_all(text, '{word}'), 1) AS i FROM texts),
windows AS (SELECT r, i, w, lead(w) OVER t AS w2, lead(w, 2) OVER t AS w3 FROM words WINDOW t AS (PARTITION BY r ORDER BY i)),
often AS (SELECT r, i FROM (SELECT r, i, w3, count(*) OVER (PARTITION BY r, w, w2, w3) AS c FROM windows) WHERE w3 IS NOT NULL AND c > 1),
covered AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM often) GROUP BY r),
by_word AS (SELECT r, count(*) AS n_words, sum(length(w)) AS word_chars, count(*) FILTER (w = w2) AS n_stutters,
  count(*) FILTER (regexp_matches(w, '[A-Z]') AND NOT regexp_matches(w, '[a-z]') AND strlen(w) > 1) AS n_capitals FROM windows GROUP BY r),
lines AS (SELECT r, l FROM (SELECT r, unnest(string_split(text, chr(10))) AS l FROM texts) WHERE regexp_matches(l, '{word}')),
by_line AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines FROM lines GROUP BY r),
counts AS (SELECT t.doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
  coalesce(n_lines, 0) AS n_lines, coalesce(n_capitals, 0) AS n_capitals, coalesce(n_stutters, 0) AS n_stutters,
  length(regexp_replace(text, '[^!]', '', 'g')) AS n_exclaims, length(regexp_replace(text, '[^|]', '', 'g')) AS n_bars,
  length(regexp_replace(text, '[^0-9]', '', 'g')) AS n_digits
  FROM texts t LEFT JOIN by_word USING (r) LEFT JOIN by_line USING (r) LEFT JOIN covered c USING (r)),
voted AS (SELECT *, {each(vote)}, n_words < {BASE_WORDS} OR 100 * n_repeat_words > {BASE_REPEATED} * n_words AS base_failed FROM counts),
patterns AS MATERIALIZED (SELECT {each(lambda j: f"v{j}")}, count(*)::DOUBLE AS n FROM voted GROUP BY ALL),
model(round, prior, {each(lambda j: f"g{j}, b{j}")}) AS (
  SELECT 0, {share}::DOUBLE, {each(lambda j: f"{on_good}::DOUBLE, {on_bad}::DOUBLE")}
  UNION ALL SELECT round + 1, (sum(w) + {k} * {share}) / (sum(n) + {k}), {each(again)}
  FROM (SELECT *, n / (1 + exp(-({odds}))) AS w FROM model, patterns WHERE round < {ROUNDS}) GROUP BY round)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND 1 / (1 + exp(-({odds}))) >= {KEEP} AS kept
FROM voted, (SELECT * FROM model WHERE round = {ROUNDS})"""


QUERIES = {"op11_quality_rules": op11_quality_rules}
ORACLE = {"op11_quality_rules": _oracle()}
