"""Membership filter: drop fact rows of keys that nothing asks for, before they are shuffled.

A set of keys becomes a blocked Bloom filter held as a table: ``words`` 64-bit words, one row
each. A key picks one word by a hash and four bits in it by another; ``bit_or`` builds the
words with partial aggregation, so nothing but (word, bits) rows is shuffled. Facts meet the
table in a broadcast left-semi join on the word, with the bit test as its condition: a
row-local step of the fact scan, without Python and without a shuffle.

The filter never drops a wanted key. It lets some others pass (about one in a hundred at
``BITS_PER_KEY``), so the exact join on the key stays where it was.

The table's size follows from the counted keys: at most ``MAX_KEYS`` * ``BITS_PER_KEY`` / 64
rows of two longs, a quarter of a row for each key. With more keys than ``MAX_KEYS`` no filter
is made, and facts pass as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Most keys of a filter: 1,000,000 words, about 50 MB on an executor.
MAX_KEYS = 4_000_000
BITS_PER_KEY = 16


def _bits(key: str) -> Column:
    """Four bits of a word, from the hash of the key."""
    h = F.xxhash64(F.col(key), F.lit(1))
    one = F.lit(1).cast("long")
    bit = lambda i: F.call_function("shiftleft", one, F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int"))
    return bit(0).bitwiseOR(bit(1)).bitwiseOR(bit(2)).bitwiseOR(bit(3))


def _word(key: str, words: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(words))


@dataclass(frozen=True)
class Members:
    """The filter of a set of keys; ``table`` is None if there were too many."""

    table: DataFrame | None
    words: int
    n_keys: int

    def _may_hold(self, held: DataFrame, key: str) -> Column:
        bits = _bits(key)
        return (_word(key, self.words) == held["_word"]) & (held["_bits"].bitwiseAND(bits) == bits)

    def keep(self, facts: DataFrame, key: str) -> DataFrame:
        """The rows of ``facts`` whose ``key`` may be in the set (all that are, few others). A
        null key is in no set."""
        if self.table is None:
            return facts.where(F.col(key).isNotNull())
        held = F.broadcast(self.table)
        return facts.where(F.col(key).isNotNull()).join(held, self._may_hold(held, key), "left_semi")

    def drop(self, facts: DataFrame, key: str) -> DataFrame | None:
        """The rows of ``facts`` that ``keep`` leaves out: their ``key`` is in no case in the set.
        None if there is no filter to tell."""
        if self.table is None:
            return None
        held = F.broadcast(self.table)
        return facts.join(held, F.col(key).isNotNull() & self._may_hold(held, key), "left_anti")


def without(facts: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """The rows of ``facts`` whose ``key`` is not in ``gone`` (a written table), an anti-join that
    shuffles only the rows that may be in it: wide rows that surely stay are not moved."""
    held = members(gone, key)
    staying = held.drop(facts, key)
    if staying is None:
        return facts.join(gone.select(key), key, "left_anti")
    return staying.unionByName(held.keep(facts, key).join(gone.select(key), key, "left_anti"))


def members(ids: DataFrame, key: str, max_keys: int = MAX_KEYS) -> Members:
    """The filter of the non-null values of ``key`` in ``ids``. ``ids`` is read twice (counted,
    then folded), so it should be a written table."""
    named = ids.where(F.col(key).isNotNull()).select(key)
    n = named.count()  # with repeats: an upper bound of the number of keys
    if n > max_keys:
        return Members(None, 0, n)
    words = 64
    while words * 64 < n * BITS_PER_KEY:
        words *= 2
    table = named.groupBy(_word(key, words).alias("_word")).agg(F.bit_or(_bits(key)).alias("_bits"))
    return Members(table, words, n)
