"""Sets of items of an entity as bitmaps over a dictionary of dense ids.

A roll-up by strings ships every distinct (entity, item) pair as text, twice: to remove
repeats, and to build the lists. Here items become dense numbers first and a set becomes
(entity, word, bits) rows, 64 items in a long:

1. ``dictionary``: items counted with partial aggregation and numbered by frequency with a
   distributed position, so frequent items share the first words.
2. ``sets_of``: items meet their number, ``bit_or`` folds each entity's bits. Repeats vanish in
   the map-side part, however hot an entity or an item is.
3. ``merged`` unites sets along any grouping (patients to splits) by ``bit_or`` again, and
   ``sizes`` counts them by ``bit_count``: no string and no distinct is needed for either.
4. ``lists_of`` turns sets into sorted lists of strings. An entity's words meet in one place as
   numbers; strings appear behind that shuffle only.

Meeting the dictionary: a dictionary within ``BROADCAST_ITEMS`` counted rows and
``BROADCAST_BYTES`` measured characters is broadcast. Beyond that its ``HOT_ITEMS`` most
frequent items are (if they are within those bytes), and the others go through a shuffle join:
none of them can hold more than 1 / ``HOT_ITEMS`` of the rows.

Defined cases: null items are in no set; an empty string is an item. Rows with a null key belong
to no entity and form no set. Entities without items have no rows here (``lists_of`` of them is
left to a left join). The order of a list is that of its strings.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ranking import with_global_position

BROADCAST_ITEMS = 200_000
BROADCAST_BYTES = 16 << 20
HOT_ITEMS = 10_000
WORD = 64


@dataclass(frozen=True)
class Dictionary:
    """``table``: kind, item, item_id (dense, by falling frequency); its counted size and the
    measured characters of all its items and of the hot ones."""

    table: DataFrame
    n_items: int
    n_bytes: int
    hot_bytes: int

    def meet(self, rows: DataFrame, on: list[str]) -> DataFrame:
        """Inner join of ``rows`` with the dictionary on its id or its (kind, item)."""
        if self.n_items <= BROADCAST_ITEMS and self.n_bytes <= BROADCAST_BYTES:
            return rows.join(F.broadcast(self.table), on)
        if self.hot_bytes > BROADCAST_BYTES:
            return rows.join(self.table, on)
        hot = F.col("item_id") < HOT_ITEMS
        if on == ["item_id"]:  # the number itself tells the two apart
            return (rows.where(hot).join(F.broadcast(self.table.where(hot)), on)
                    .unionByName(rows.where(~hot).join(self.table.where(~hot), on)))
        first = rows.join(F.broadcast(self.table.where(hot).withColumnRenamed("item_id", "_hot")), on, "left")
        cold = first.where(F.col("_hot").isNull()).drop("_hot").join(self.table.where(~hot), on)
        return first.where(F.col("_hot").isNotNull()).withColumnRenamed("_hot", "item_id").unionByName(cold)


def dictionary(items: DataFrame) -> Dictionary:
    """The dictionary of ``items`` (kind, item); equal counts are numbered by kind and item."""
    counts = items.where(F.col("item").isNotNull()).groupBy("kind", "item").agg(F.count(F.lit(1)).alias("_rows"))
    table = with_global_position(counts, [F.desc("_rows"), F.col("kind"), F.col("item")], "item_id").drop("_rows")
    size = F.octet_length("item") + F.octet_length("kind")
    seen = table.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("b"),
                     F.coalesce(F.sum(F.when(F.col("item_id") < HOT_ITEMS, size)), F.lit(0)).alias("h")).first()
    return Dictionary(table, seen["n"], seen["b"], seen["h"])


def _bit(at: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), at)


def sets_of(rows: DataFrame, words: Dictionary, keys: list[str]) -> DataFrame:
    """(keys, word, bits) of ``rows`` (keys, kind, item)."""
    known = rows.where(F.col("item").isNotNull())
    for k in keys:
        known = known.where(F.col(k).isNotNull())
    ids = words.meet(known, ["kind", "item"])
    at = F.pmod("item_id", F.lit(WORD)).cast("int")
    return (ids.groupBy(*keys, F.floor(F.col("item_id") / WORD).cast("int").alias("word"))
            .agg(F.bit_or(_bit(at)).alias("bits")))


def merged(sets: DataFrame, keys: list[str]) -> DataFrame:
    """The unions of ``sets`` along ``keys``, columns of it."""
    return sets.groupBy(*keys, "word").agg(F.bit_or("bits").alias("bits"))


def by_kind(words: Dictionary) -> DataFrame:
    """kind, word, mask: which bits of a word are items of a kind (a row for 64 items)."""
    at = F.pmod("item_id", F.lit(WORD)).cast("int")
    return (words.table.groupBy("kind", F.floor(F.col("item_id") / WORD).cast("int").alias("word"))
            .agg(F.bit_or(_bit(at)).alias("mask")))


def sizes(sets: DataFrame, words: Dictionary, keys: list[str]) -> DataFrame:
    """(keys, kind, n): how many items of each kind the sets hold (none: no row)."""
    masks = by_kind(words)
    if words.n_items <= BROADCAST_ITEMS:
        masks = F.broadcast(masks)
    n = F.bit_count(F.col("bits").bitwiseAND(F.col("mask"))).cast("long")
    return sets.join(masks, "word").groupBy(*keys, "kind").agg(F.sum(n).alias("n")).where("n > 0")


def overlaps(left: DataFrame, right: DataFrame) -> DataFrame:
    """n_shared of two tables (word, bits): the size of their intersection."""
    both = left.select("word", F.col("bits").alias("_l")).join(right.select("word", F.col("bits").alias("_r")), "word")
    return both.agg(F.coalesce(F.sum(F.bit_count(F.col("_l").bitwiseAND(F.col("_r"))).cast("long")), F.lit(0)).alias("n_shared"))


def lists_of(sets: DataFrame, words: Dictionary, key: str, kinds: dict[str, str]) -> DataFrame:
    """key and, for each kind, its sorted list of items under the column ``kinds`` names.

    The words of an entity meet first (at most a 64th of the dictionary's size); the strings
    join behind that exchange, whose partitioning the last aggregation uses again.
    """
    held = sets.groupBy(key).agg(F.collect_list(F.struct("word", "bits")).alias("_w"))
    each = held.select(key, F.explode("_w").alias("_e")).select(key, "_e.word", "_e.bits")
    places = F.filter(F.sequence(F.lit(0), F.lit(WORD - 1)), lambda i: F.col("bits").bitwiseAND(_bit(i)) != 0)
    ids = each.select(key, "word", F.explode(places).alias("_at")).select(
        key, (F.col("word").cast("long") * WORD + F.col("_at")).alias("item_id"))
    return words.meet(ids, ["item_id"]).groupBy(key).agg(*[
        F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.col("item")))).alias(name)
        for kind, name in kinds.items()])


def _marked(kind: str, name: str) -> Column:
    """A list's items as (kind, item) structs; a null list is empty."""
    held = F.coalesce(F.col(name), F.array().cast("array<string>"))
    return F.transform(held, lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("item")))


def items_of_history(tl: DataFrame, *keys: str) -> DataFrame:
    """(keys, kind, item) of the list items of the history visits of a timeline with lists."""
    marked = F.concat(_marked("dx", "diagnoses"), _marked("lab", "abnormal_labs"))
    return tl.where("in_history").select(*keys, F.explode(marked).alias("_e")).select(*keys, "_e.kind", "_e.item")


def patient_rows_by_sets(tl: DataFrame) -> DataFrame:
    """The rows of ``aggregate.patient_rows``, with the unions taken on bitmaps.

    The facts of a patient are one narrow aggregate; lists are decoded and joined on the same
    partitioning. ``tl`` is read three times (dictionary, sets, facts): give a written table.
    """
    renamed = tl.withColumnRenamed("subject_id", "patient_id").where(F.col("patient_id").isNotNull())
    split = [F.min(c).alias(c) for c in ("split",) if c in tl.columns]
    facts = renamed.where("in_history").groupBy("patient_id").agg(
        F.min("age").alias("age"), F.min("gender").alias("gender"),
        F.max(F.when(F.col("kept"), F.col("next_ckd"))).cast("int").alias("is_ckd"),
        F.count_if("kept").alias("num_samples"), F.count(F.lit(1)).alias("num_distinct_visits"), *split)
    facts = facts.where("num_samples > 0").withColumn(
        "num_visits", (F.col("num_samples") * (F.col("num_samples") + 1) / 2).cast("bigint"))
    words = dictionary(items_of_history(renamed))
    sets = sets_of(items_of_history(renamed, "patient_id"), words, ["patient_id"])
    lists = lists_of(sets, words, "patient_id", {"dx": "diagnoses", "lab": "abnormal_labs"})
    none = F.array().cast("array<string>")
    return (facts.join(lists, "patient_id", "left")
            .withColumn("diagnoses", F.coalesce("diagnoses", none))
            .withColumn("abnormal_labs", F.coalesce("abnormal_labs", none)))
