"""Spelling variants (operator 13): words that differ by one code point, and their usual form.

Near words come from a dictionary of pairs of trie nodes. Every prefix of a word is a node of
the forward trie, every suffix a node of the reversed one, both numbered by integers. Leaving
out position i of a word gives the pair (prefix before i, suffix after i); splitting a word at
i, without leaving anything out, gives (prefix before i, suffix from i). Then

* two words with an equal left-out pair differ in that one position;
* a word whose left-out pair equals another's split pair has one code point more, there.

Equal pairs are exact neighbours, nothing has to be verified. A pair of the first kind meets
at one key only. Of the second kind, a run of equal code points gives the same shorter word
at each of its places, so a left-out pair counts only at the first place of its run.

Numbers come from two sorts: in sorted order a word's path shares the nodes of the prefix it
has in common with the word before. Each range partition numbers the nodes that only it
holds; nodes that lie on a boundary (prefixes of both the last word before it and the first
one after) are numbered on the driver, from two words a partition.

A key holds at most one split word and at most ``LETTERS`` words that differ in one letter:
groups are bounded by the alphabet, whatever the input. They are reduced to a count and the
best two, never spread into pairs. The dictionary has 2 * length + 1 rows for each word.

Forms chain to a root by pointer jumping; each hop multiplies n by ``RATIO``, so there are few
rounds. Occurrences are counted by document in the workers, then by partial sums.

Defined cases: a null text has no runs. A null doc_id counts as the empty string in the
hash. Rows that repeat a doc_id count each, with equal hashes. Runs and words have any length; a word of length L
costs 2 * L + 1 rows. Ties of n go to the word first in code-point order. Empty tables give
no rows. Columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import CRC_TABLE, crc32_sql, ensure_checkpoint_dir, read, shuffle_partitions, stored

LEAST_LETTERS, LEAST_OCCURRENCES, RATIO = 6, 5, 5
MODULUS = 199  # one run in so many loses a code point
LETTERS = 26 + 64  # code points that a word can have at one place
RUN = re.compile("[a-zÀ-ÿ]+")
HELD = 200_000  # distinct words that a task sums up before it sends them on
ROWS_PER_SLICE = 2_000_000
LOCAL_BITS = 40  # numbers of one range partition


def written_word(run: str, seed: int) -> str:
    """The run as counted: one in ``MODULUS`` loses a code point; ``seed`` is the crc32 of "<doc_id>:"."""
    h = zlib.crc32(run.encode("utf-8"), seed)
    if h % MODULUS:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def vocabulary(documents: DataFrame) -> DataFrame:
    """word, n of all words with enough letters and occurrences."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        sent = lambda: pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not text:
                    continue
                seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                lowered = text.encode("utf-8").lower().decode("utf-8")  # of bytes: A-Z only
                for word, n in Counter(RUN.findall(lowered)).items():
                    if len(word) >= LEAST_LETTERS and len(word := written_word(word, seed)) >= LEAST_LETTERS:
                        total[word] += n
                if len(total) >= HELD:
                    yield sent()
                    total.clear()
        yield sent()

    counted = documents.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_OCCURRENCES)


def _boundaries(ends: list) -> dict[int, tuple[str, list[int], str, list[int]]]:
    """For each range partition, the string shared across its left boundary with the numbers of
    its prefixes' nodes, and the same for the right one. Rows: partition, first and last word."""
    shared, before, path, made = [("", [])], "", [], 0
    for left, right in zip(ends, ends[1:]):  # noqa: B905
        text = commonprefix((left.last, right.first))
        keep = len(commonprefix((before, text)))
        path = path[:keep] + [-(made + d) for d in range(1, len(text) - keep + 1)]
        made += len(text) - keep
        before = text
        shared.append((text, path))
    shared.append(("", []))
    return {row.part: (*shared[i], *shared[i + 1]) for i, row in enumerate(ends)}


def numbered(words: DataFrame, key: str) -> DataFrame:
    """word, n, id (ascending in ``key``), nodes: the numbers of the trie nodes of the prefixes of
    the string column ``key`` of length 0, 1, ... and fresh: whether each code point differs from
    the one before it. ``key`` must be unique."""
    spark = words.sparkSession
    ensure_checkpoint_dir(spark)
    parts = max(shuffle_partitions(spark), -(-words.count() // ROWS_PER_SLICE))
    ranged = (words.select("word", "n", F.col(key).alias("key"))
              .repartitionByRange(parts, "key").sortWithinPartitions("key")
              .withColumn("part", F.spark_partition_id()).checkpoint(eager=True))  # bounds come from a sample
    ends = ranged.groupBy("part").agg(F.min("key").alias("first"), F.max("key").alias("last")).orderBy("part").collect()
    shared = spark.sparkContext.broadcast(_boundaries(ends))  # two words a partition

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, path, fresh, made, ids = "", [0], [], 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column(3)[0].as_py()
            left, left_path, right, right_path = shared.value[part]
            first = (part + 1) << LOCAL_BITS
            paths, starts, numbers = [], [], []
            for text in batch.column(2).to_pylist():
                keep = len(commonprefix((before, text)))
                path = path[:keep + 1]
                on_left, on_right = len(commonprefix((left, text))), len(commonprefix((right, text)))
                for depth in range(keep + 1, len(text) + 1):
                    if depth <= on_left:
                        path.append(left_path[depth - 1])
                    elif depth <= on_right:
                        path.append(right_path[depth - 1])
                    else:
                        path.append(first + made)
                        made += 1
                paths.append(path)
                fresh = [a != b for a, b in zip("\0" + text, text)]  # noqa: B905
                starts.append(fresh)
                numbers.append(first + ids)
                ids, before = ids + 1, text
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(numbers, pa.int64()), pa.array(paths, pa.list_(pa.int64())),
                 pa.array(starts, pa.list_(pa.bool_()))], ["word", "n", "id", "nodes", "fresh"])

    return ranged.select("word", "n", "key", "part").mapInArrow(
        run, "word string, n long, id long, nodes array<long>, fresh array<boolean>")


def pair_dictionary(words: DataFrame, forward: DataFrame) -> DataFrame:
    """before, after (node numbers), id, n, fresh of each word's left-out pairs; ``fresh`` is null
    for its split pairs. ``forward`` is the numbered table of ``words``."""
    backward = numbered(words.withColumn("back", F.reverse("word")), "back")
    both = forward.join(backward.select("word", F.col("nodes").alias("back")), "word")
    last = F.size("fresh") - 1
    pair = lambda i, skipped, fresh: F.struct(
        F.get("nodes", i).alias("before"), F.get("back", last + 1 - i - skipped).alias("after"), fresh.alias("fresh"))
    left_out = F.transform(F.sequence(F.lit(0), last), lambda i: pair(i, 1, F.get("fresh", i)))
    split = F.transform(F.sequence(F.lit(0), last + 1), lambda i: pair(i, 0, F.lit(None).cast("boolean")))
    return both.select("id", "n", F.inline(F.concat(left_out, split)))


def near_words(pairs: DataFrame) -> DataFrame:
    """id, n_near, best (less: minus n of the best near word, id: its id) of words with near words."""
    member = F.struct((-F.col("n")).alias("less"), "id", "fresh")
    keys = pairs.groupBy("before", "after").agg(
        F.array_sort(F.collect_list(F.when(F.col("fresh").isNotNull(), member))).alias("others"),  # at most LETTERS
        F.max(F.when(F.col("fresh").isNull(), F.struct((-F.col("n")).alias("less"), "id"))).alias("split"))
    keys = keys.where(F.size("others") + F.col("split").isNotNull().cast("int") >= 2)
    plain = lambda x: F.struct(x["less"].alias("less"), x["id"].alias("id"))
    at = lambda column, i: F.get(F.col(column), F.lit(i))
    none = F.lit(None).cast("struct<less:bigint,id:bigint>")
    found = keys.withColumn("longer", F.filter("others", lambda x: x["fresh"]))

    def of_other(x):
        top, second = at("others", 0), at("others", 1)
        rest = F.when(x["id"] != top["id"], plain(top)).when(second.isNotNull(), plain(second)).otherwise(none)
        shorter = F.when(x["fresh"] & F.col("split").isNotNull(), F.col("split")).otherwise(none)
        return F.struct(x["id"].alias("id"), (F.size("others") - 1 + shorter.isNotNull().cast("int")).alias("near"),
                        F.least(rest, shorter).alias("best"))

    of_split = F.when(F.col("split").isNotNull() & (F.size("longer") > 0), F.array(F.struct(
        F.col("split.id").alias("id"), F.size("longer").alias("near"), plain(at("longer", 0)).alias("best"))))
    nothing = F.array().cast("array<struct<id:bigint,near:int,best:struct<less:bigint,id:bigint>>>")
    each = found.select(F.inline(F.concat(F.transform("others", of_other), F.coalesce(of_split, nothing))))
    return (each.where(F.col("near") > 0).groupBy("id")
            .agg(F.sum("near").cast("long").alias("n_near"), F.min("best").alias("best")))


def roots(forms: DataFrame) -> DataFrame:
    """id, root: the last of the chain id -> form_id -> ..., for every id with a form."""
    links = stored(forms.select("id", F.col("form_id").alias("root")), "spelling-links")
    while True:  # twice as far each round; n grows by RATIO with every hop, so chains are short
        onward = links.select(F.col("id").alias("root"), F.col("root").alias("beyond"))
        joined = links.join(onward, "root", "left")
        further = stored(joined.select("id", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")),
                         "spelling-links")
        links = further.drop("moved")
        if further.where("moved").isEmpty():
            return links


def variants(documents: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of the whole vocabulary of ``documents``."""
    words = stored(vocabulary(documents), "spelling-words")
    forward = stored(numbered(words, "word"), "spelling-forward")
    near = near_words(pair_dictionary(words, forward))
    plain = forward.select("id", "word", "n")
    usual = -F.col("best.less") >= RATIO * F.col("n")
    decided = stored(plain.join(near, "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(usual, F.col("best.id")).alias("form_id"), F.when(usual, -F.col("best.less")).alias("form_n")), "spelling-forms")
    named = lambda key, name: plain.select(F.col("id").alias(key), F.col("word").alias(name))
    with_form = decided.where(F.col("form_id").isNotNull())
    known = (with_form.join(roots(with_form), "id").join(named("form_id", "form"), "form_id").join(named("root", "root_word"), "root")
             .select("word", "form", F.col("root_word").alias("root"), "n", "n_near", "form_n"))
    others = decided.where(F.col("form_id").isNull()).select(
        "word", F.lit(None).cast("string").alias("form"), F.col("word").alias("root"), "n", "n_near", "form_n")
    return known.unionByName(others)


def op13_spelling_variants(spark, sf_dir: str) -> DataFrame:
    """Near words, usual form and root of every word of ``documents``."""
    return variants(read(spark, sf_dir, "documents"))


ORACLE = {"op13_spelling_variants": f"""
WITH RECURSIVE {CRC_TABLE},
texts AS (SELECT row_number() OVER () AS r, coalesce(doc_id::VARCHAR, '') AS name,
  translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
runs AS (SELECT name, run, count(*) AS n FROM (SELECT name, unnest(regexp_extract_all(text, '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM texts)
  WHERE length(run) >= {LEAST_LETTERS} GROUP BY ALL),
hashed AS (SELECT run, n, {crc32_sql("name || ':' || run")} AS h FROM runs, crc_table),
counted AS (SELECT CASE WHEN h % {MODULUS} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
  FROM hashed),
words AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM counted WHERE length(word) >= {LEAST_LETTERS} GROUP BY word
  HAVING sum(n) >= {LEAST_OCCURRENCES}),
skips AS MATERIALIZED (SELECT word, n, substr(word, 1, i) AS a, substr(word, i + 2) AS b
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
shorter AS (SELECT DISTINCT s.word, s.n, w.word AS other, w.n AS other_n FROM skips s JOIN words w ON w.word = s.a || s.b),
near AS (SELECT x.word, y.word AS other, y.n AS other_n FROM skips x JOIN skips y ON x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION ALL SELECT word, other, other_n FROM shorter UNION ALL SELECT other, word, n FROM shorter),
best AS (SELECT word, count(*) AS n_near, arg_max(other, (other_n, -place)) AS other, max(other_n) AS other_n
  FROM (SELECT *, row_number() OVER (ORDER BY other) AS place FROM near) GROUP BY word),
forms AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= {RATIO} * w.n THEN other END AS form,
  CASE WHEN other_n >= {RATIO} * w.n THEN other_n END AS form_n FROM words w LEFT JOIN best USING (word)),
chain(word, reached, hops) AS (SELECT word, word, 0 FROM forms
  UNION ALL SELECT c.word, f.form, hops + 1 FROM chain c JOIN forms f ON f.word = c.reached WHERE f.form IS NOT NULL)
SELECT f.word, form, root, n, n_near, form_n FROM forms f JOIN (SELECT word, arg_max(reached, hops) AS root FROM chain GROUP BY word) USING (word)"""}
QUERIES = {"op13_spelling_variants": op13_spelling_variants}
