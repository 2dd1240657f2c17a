"""Near-duplicate detection (operator 2) with HyperMinHash sketches.

1. Sketch. A text is cut into distinct five-word shingles, each a 64-bit hash. The top bits
   of a hash choose one of ``BUCKETS`` buckets; of the least remainder in a bucket the
   register keeps its number of leading zeros and ``MANTISSA`` following bits (16 bits in
   all). For the bands, empty buckets borrow the register of another bucket by a fixed
   random order; the estimate looks at buckets that either set fills.
2. Classes. Texts with the same shingle set (compared by a 128-bit digest of the set) are
   one class, with the smallest doc_id as its representative, so copies cost one row each.
3. Bands. ``BANDS`` groups of ``BAND_ROWS`` compressed registers are the keys that bring
   candidates together. At similarity 0.75 a pair misses all bands with probability below
   1e-5.
4. Links. Within a band key nobody is compared with everybody. First each class meets the
   smallest member of each of its keys, then, in keys that still hold several components,
   about ``LEADERS`` members meet the others of different components. What is connected by
   then needs no further look. The rest is joined on the rarest shingles of its sets: a linked
   pair must share one of them early in both (an exact prefix condition), so no link between
   open classes can be lost, while a group of thousands of alike texts costs little more than
   one comparison for each.
5. Verification. A pair first passes the size test (exact), then the Jaccard estimate from
   the registers, corrected for accidental register collisions, ``SIGMAS`` standard deviations
   below the threshold; the remaining pairs are confirmed on full shingle sets, which are
   made only for classes that have candidates.
6. Components of the confirmed links by alternating star contractions, checkpointed.

Defined cases: texts without words (null and empty ones too) have the empty set and are
linked with nothing; with fewer than five words the whole sequence is one shingle. Rows that
repeat a doc_id share one result; if their texts differ, the document has the shingles of
all of them (a set that is held whole, like that of one text). A null doc_id takes no
part: its component is null and it is kept. Long texts are sketched whole. Empty tables give
empty results; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import read, stored
from tidemark.operators.membership import without

SHINGLE = 5
PERCENT = 75  # link: 100 * |A and B| >= PERCENT * |A or B|
BUCKETS, BANDS, BAND_ROWS, MANTISSA = 256, 32, 4, 10
LEADERS, SIGMAS = 2, 5
EMPTY = 0xFFFF
#: Counted bound under which a list of ids and digests is broadcast (24 bytes each); longer ones are joined.
BROADCAST_IDS = 500_000
#: Parts that the edges of one node are dealt to while components are contracted.
SPREAD = 32
#: Word hashes that a worker keeps; the memory starts anew beyond it.
REMEMBERED = 300_000

_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                     0xA0761D6478BD642F], np.uint64)
_memory: dict[bytes, int] = {}


# ------------------------------------------------------------------------ sets and sketches

def _mixed(h: np.ndarray) -> np.ndarray:
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(31))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a whole text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z, only ASCII space
    if not words:
        return np.zeros(0, np.uint64)
    hashes = list(map(_memory.get, words))
    if None in hashes:
        if len(_memory) > REMEMBERED:
            _memory.clear()
        for i, known in enumerate(hashes):
            if known is None:
                hashes[i] = _memory[words[i]] = xxhash.xxh64_intdigest(words[i])
    h = np.array(hashes, np.uint64)
    width = min(SHINGLE, len(h))
    n = len(h) - width + 1
    total = np.full(n, len(h) if len(h) < SHINGLE else SHINGLE, np.uint64)
    for k in range(width):
        total += h[k:k + n] * _FACTORS[k]
    return np.unique(_mixed(total))


def _donors() -> np.ndarray:
    """For each bucket, the order in which it looks at others when it is empty."""
    order = np.random.default_rng(20240229)
    return np.array([order.permutation(BUCKETS) for _ in range(BUCKETS)], np.int64)


DONORS = _donors()
_BITS = int(math.log2(BUCKETS))


def registers(shingles: np.ndarray) -> np.ndarray:
    """16-bit registers of a sorted non-empty set: leading zeros, then mantissa bits; or EMPTY."""
    buckets = (shingles >> np.uint64(64 - _BITS)).astype(np.int64)
    first = np.searchsorted(buckets, np.arange(BUCKETS))  # sorted: the first is the least
    filled = first < len(buckets)
    filled[filled] = buckets[first[filled]] == np.flatnonzero(filled)
    least = shingles[first[filled]] << np.uint64(_BITS)
    top = np.maximum(least, np.uint64(1))
    zeros = 63 - np.floor(np.log2(top.astype(np.float64))).astype(np.int64)  # rounding up costs at most one
    zeros = np.clip(zeros, 0, 62)
    zeros += (least >> (np.uint64(63) - zeros.astype(np.uint64))) == 0  # exact number of leading zeros
    zeros = np.minimum(zeros, 62)
    rest = least << np.minimum(zeros + 1, 63).astype(np.uint64)
    out = np.full(BUCKETS, EMPTY, np.uint16)
    out[filled] = (zeros.astype(np.uint16) << np.uint16(MANTISSA)) | (rest >> np.uint64(64 - MANTISSA)).astype(np.uint16)
    return out


def band_registers(regs: np.ndarray) -> np.ndarray:
    """The registers of the bands, with borrowed ones in the place of empty ones (rows)."""
    out = regs[:, :BANDS * BAND_ROWS].copy()
    for row in np.flatnonzero((out == EMPTY).any(1)):
        empty = np.flatnonzero(out[row] == EMPTY)
        filled = regs[row] != EMPTY
        out[row, empty] = regs[row, DONORS[empty, filled[DONORS[empty]].argmax(1)]]
    return out


def collision_rate() -> float:
    """Chance that registers of different minima are equal: equal zeros (sum of 4**-z) and mantissa."""
    return sum(4.0 ** -(z + 1) for z in range(63)) * 2.0 ** -MANTISSA


def estimated_jaccard(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Share of equal registers among the buckets that either set fills (rows), corrected for
    accidental collisions; and the number of those buckets."""
    filled = (a != EMPTY) | (b != EMPTY)
    witnesses = np.maximum(filled.sum(-1), 1)
    equal, by_chance = ((a == b) & filled).sum(-1) / witnesses, collision_rate()
    return np.clip((equal - by_chance) / (1 - by_chance), 0, 1), witnesses


def estimate_floor(n_a: np.ndarray, n_b: np.ndarray, witnesses: np.ndarray) -> np.ndarray:
    """Estimates below this are hopeless: ``SIGMAS`` standard deviations under the threshold.

    Each filled bucket shows one member of the union, no member twice: sampling without
    replacement, from a union of (n_a + n_b) / (1 + J) members.
    """
    share = PERCENT / 100
    unseen = np.maximum(1 - witnesses * (1 + share) / (n_a + n_b), 0.05)
    return share - SIGMAS * np.sqrt(share * (1 - share) * unseen / witnesses)


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text in batch.column(1).to_pylist():
            s = shingle_set(text)
            rows.append((len(s), hashlib.md5(s.tobytes()).digest(), registers(s).tobytes()) if len(s) else (0, None, None))
        sizes, digests, regs = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                                          pa.array(regs, pa.binary())], names=["doc_id", "n_shingles", "digest", "regs"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rep, shingles) of the texts whose set has the wanted digest."""
    for batch in batches:
        rows = []
        for rep, digest, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            raw = shingle_set(text).tobytes()
            if hashlib.md5(raw).digest() == digest:
                rows.append((rep, raw))
        yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in rows], pa.int64()),
                                          pa.array([s for _, s in rows], pa.binary())], names=["rep", "shingles"])


def _each_shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, shingle) of each text."""
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            own = shingle_set(text).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), doc_id, np.int64)), pa.array(own)],
                                             names=["doc_id", "shingle"])


def _united_sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Like ``_sketches`` from (doc_id, list of distinct shingles), with the set itself."""
    for batch in batches:
        rows = []
        for own in batch.column(1):
            s = np.sort(own.values.to_numpy().view(np.uint64))
            rows.append((len(s), hashlib.md5(s.tobytes()).digest(), registers(s).tobytes(), s.tobytes()))
        columns = zip(*rows, strict=True) if rows else ((),) * 4
        kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                                         names=["doc_id", "n_shingles", "digest", "regs", "shingles"])


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, rep, n) for each band of each class."""
    for batch in batches:
        if not batch.num_rows:
            continue
        regs = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint16).reshape(batch.num_rows, BUCKETS)
        keys = band_registers(regs).view(np.uint64)  # four registers are one 64-bit key
        keys = _mixed(keys ^ _mixed(np.arange(1, BANDS + 1, dtype=np.uint64)))  # one-to-one within a band
        rep, n = (np.repeat(batch.column(i).to_numpy(), BANDS) for i in (0, 1))
        yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).view(np.int64)), pa.array(rep), pa.array(n)],
                                         names=["key", "rep", "n"])


def _estimates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose estimate leaves room for the threshold."""
    for batch in batches:
        if not batch.num_rows:
            continue
        n_a, n_b = batch.column(2).to_numpy(), batch.column(3).to_numpy()
        regs = [np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, BUCKETS) for i in (4, 5)]
        estimate, witnesses = estimated_jaccard(*regs)
        keep = pa.array(estimate >= estimate_floor(n_a, n_b, witnesses))
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """The exact test on two sorted sets."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both > 0 and 100 * both >= PERCENT * (len(a) + len(b) - both)


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
        keep = pa.array([linked(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)) for a, b in pairs], pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])


# ---------------------------------------------------------------------------- the operator

def _is_star_forest(edges: DataFrame) -> bool:
    """Whether each node is either a root or has one edge, to a root (edges lead to smaller nodes)."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("out")),
                                          F.struct(F.col("v").alias("node"), F.lit(0).alias("out")))).alias("e"))
    seen = ends.groupBy("e.node").agg(F.sum("e.out").alias("out"), F.min("e.out").alias("least"))
    return seen.where("out > 1 or (out = 1 and least = 0)").isEmpty()


def _to_least(edges: DataFrame) -> DataFrame:
    """edges (u, v) with m: the least of u and all v of that u.

    A node's edges are dealt to ``SPREAD`` parts by a hash of v. Each part finds its least, the
    leasts of a node meet (``SPREAD`` rows at most), and the result goes back to the node's parts
    one by one, so no task holds all edges of a node.
    """
    dealt = edges.withColumn("part", F.pmod(F.xxhash64("v"), F.lit(SPREAD)))
    least = dealt.groupBy("u", "part").agg(F.min("v").alias("m")).groupBy("u").agg(
        F.least(F.col("u"), F.min("m")).alias("m"), F.collect_list("part").alias("parts"))
    return dealt.join(least.select("u", "m", F.explode("parts").alias("part")), ["u", "part"]).drop("part")


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest reachable node) of the nodes of ``edges`` (a, b).

    Alternating large-star and small-star contractions on the edge list, which is written after
    each round; the edges of a node with many (a root late in the work) are dealt to parts. It
    ends when every edge leads straight to the smallest node of its component.
    """
    now = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v"), "star")
    while not _is_star_forest(now):
        # large star: larger neighbours of u go to the least of u and its neighbours
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _to_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: smaller neighbours of u, and u itself, go to the least of them
        small = _to_least(large).select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        now = stored(small.select("e.*").where("u <> v").distinct(), "star")
    tops = now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(tops)


def _reaches(most: F.Column, n_a: str = "n_a", n_b: str = "n_b") -> F.Column:
    """Whether sets of these sizes can be linked if they share ``most`` shingles at most."""
    return (100 + PERCENT) * most >= PERCENT * (F.col(n_a) + F.col(n_b))


def _rare_partners(sets: DataFrame, open_: DataFrame) -> DataFrame:
    """Candidates (a, n_a, b, n_b) of different components among all open classes, exactly.

    With the shingles of every set ordered by their number of open classes, rarest first, the
    first common shingle of a linked pair stands early in both: behind it there must be room
    for the whole intersection. So only the rarest quarter of a set is joined on, and pairs
    whose positions leave too little room are left out. A group here is one text's shingles.
    """
    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rep, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = np.frombuffer(raw, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), rep)), pa.array(own)], names=["rep", "shingle"])

    classes = stored(open_.select("rep", "n", "component").distinct(), "near-open-classes")
    each = (sets.join(classes.select("rep"), "rep", "left_semi").dropDuplicates(["rep"]).select("rep", "shingles")
            .mapInArrow(shingles, "rep long, shingle long"))
    each = stored(each, "near-shingles")
    shared = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("classes")).where("classes > 1")
    ordered = each.join(shared, "shingle").groupBy("rep").agg(
        F.array_sort(F.collect_list(F.struct("classes", "shingle"))).alias("rarest"))
    early = (ordered.join(classes, "rep").select("rep", "n", "component", F.size("rarest").alias("m"),
                                                 F.posexplode(F.slice("rarest", 1, F.greatest(F.lit(1), F.ceil(
                                                     F.size("rarest") - F.col("n") * PERCENT / 100).cast("int") + 1))))
             .select("rep", "n", "component", F.col("col.shingle").alias("shingle"), (F.col("m") - F.col("pos")).alias("room"))
             .where(100 * F.col("room") >= PERCENT * F.col("n")))
    early = stored(early, "near-rarest")
    side = lambda c: early.select("shingle", F.col("rep").alias(c), F.col("n").alias(f"n_{c}"),
                                  F.col("component").alias(f"c_{c}"), F.col("room").alias(f"room_{c}"))
    met = side("a").alias("x").join(side("b").alias("y"), (F.col("x.shingle") == F.col("y.shingle")) & (F.col("a") < F.col("b"))
                                    & (F.col("c_a") != F.col("c_b")) & _reaches(F.least("room_a", "room_b")))
    return met.select("a", "n_a", "b", "n_b")


def _pairs_of(candidates: DataFrame) -> DataFrame:
    """Ordered, size-tested, distinct pairs from rows (a, n_a, b, n_b)."""
    fits = _reaches(F.least("n_a", "n_b"))
    return (candidates.where(fits & (F.col("a") != F.col("b")))
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def _verified(pairs: DataFrame, sketches: DataFrame, sets: DataFrame) -> DataFrame:
    """The linked ones among distinct pairs (a, b)."""
    side = lambda df, c, *cols: df.select(F.col("rep").alias(c), *[F.col(x).alias(f"{x}_{c}") for x in cols])
    likely = (pairs.join(side(sketches, "a", "n", "regs"), "a").join(side(sketches, "b", "n", "regs"), "b")
              .select("a", "b", "n_a", "n_b", "regs_a", "regs_b").mapInArrow(_estimates, "a long, b long"))
    return (likely.join(side(sets, "a", "shingles"), "a").join(side(sets, "b", "shingles"), "b")
            .select("a", "b", "shingles_a", "shingles_b").mapInArrow(_confirm, "a long, b long"))


def _texts_of(docs: DataFrame, reps: DataFrame, count: int) -> DataFrame:
    """rep, digest, text of the classes' representatives; a short counted list is broadcast."""
    texts = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("rep"), "text")
    return texts.join(F.broadcast(reps) if count <= BROADCAST_IDS else reps, "rep")


def _open(members: DataFrame, found: DataFrame) -> DataFrame:
    """The members of keys that hold several components, with their component."""
    labelled = members.select("key", "size", "rep", "n").join(
        found.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    spread = labelled.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    return stored(labelled.join(spread.select("key"), "key", "left_semi"), "near-open")


def united(docs: DataFrame, rows: DataFrame) -> DataFrame | None:
    """doc_id, n_shingles, digest, regs, shingles of the ids whose rows have different sets; None without any."""
    several = stored(rows.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.min("digest").alias("lo"), F.max("digest").alias("hi"), F.count("digest").alias("n"), F.count(F.lit(1)).alias("all"))
        .where("lo < hi or (n > 0 and n < all)").select("doc_id"), "near-several")
    if several.isEmpty():
        return None
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(several, "doc_id", "left_semi")
    sets = (texts.mapInArrow(_each_shingle, "doc_id long, shingle long").distinct()
            .groupBy("doc_id").agg(F.collect_list("shingle").alias("shingles")))
    return stored(sets.mapInArrow(_united_sketches, "doc_id long, n_shingles long, digest binary, regs binary, shingles binary"),
                  "near-united")


def links(docs: DataFrame, reps: DataFrame, joint: DataFrame | None = None) -> DataFrame:
    """node, component of the classes that have a link; ``reps``: rep, digest, n, regs of each;
    ``joint``: the ``united`` sets."""
    bands = reps.select("rep", "n", "regs").mapInArrow(_bands, "key long, rep long, n long")
    keys = bands.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("rep").alias("least")).where("size > 1")
    members = stored(bands.join(keys, "key"), "near-members")
    sketches = stored(reps.join(members.select("rep").distinct(), "rep", "left_semi"), "near-sketches")
    wanted = sketches.select("rep", "digest")
    sets = _texts_of(docs, wanted, wanted.count()).select("rep", "digest", "text").mapInArrow(_sets, "rep long, shingles binary")
    if joint is not None:
        sets = sets.unionByName(joint.select(F.col("doc_id").alias("rep"), "shingles").join(wanted.select("rep"), "rep", "left_semi"))
    sets = stored(sets, "near-sets")

    # first meeting: each class with the smallest member of its keys, one partner each
    partner = (members.where("rep <> least").groupBy("rep").agg(F.min("least").alias("a"))
               .join(sketches.select(F.col("rep").alias("a"), F.col("n").alias("n_a")), "a")
               .join(sketches.select("rep", F.col("n").alias("n_b")), "rep")
               .select("a", "n_a", F.col("rep").alias("b"), "n_b"))
    found = stored(components(_verified(_pairs_of(partner), sketches, sets)), "near-components")
    for last in (False, True):
        open_ = _open(members, found)
        if open_.isEmpty():
            break
        if last:
            met = _rare_partners(sets, open_)
        else:
            draw = F.pmod(F.xxhash64("rep", "key"), F.lit(1 << 30)) / F.lit(float(1 << 30))
            leading = open_.where(draw * F.col("size") < F.lit(float(LEADERS))).select(
                "key", F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("component").alias("c"))
            met = open_.join(leading, "key").where(F.col("component") != F.col("c")).select(
                "a", "n_a", F.col("rep").alias("b"), F.col("n").alias("n_b"))
        new = _verified(_pairs_of(met), sketches, sets)
        known = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
        found = stored(components(known.unionByName(new)), "near-components")
    return found


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text)."""
    rows = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _sketches, "doc_id long, n_shingles long, digest binary, regs binary"), "near-sketched")
    joint = united(docs, rows)
    if joint is not None:
        sketch = ("n_shingles", "digest", "regs")
        theirs = joint.select("doc_id", F.struct(*sketch).alias("theirs"))
        rows = stored(rows.join(theirs, "doc_id", "left").select("doc_id", *[
            F.when(F.col("theirs").isNotNull(), F.col(f"theirs.{c}")).otherwise(F.col(c)).alias(c) for c in sketch]), "near-sketched")
    named = rows.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    classes = named.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"),
                                          F.first("regs").alias("regs"))
    reps = stored(classes, "near-classes")  # an id has one set, so it stands for one class at most
    found = links(docs, reps, joint)
    whole = stored(reps.select("digest", "rep").join(found.withColumnRenamed("node", "rep"), "rep", "left")
                   .select("digest", F.coalesce("component", "rep").alias("component_id")), "near-whole")
    out = rows.select("doc_id", "n_shingles", "digest").join(whole, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    gone = stored(near_duplicates(docs).where(~F.col("kept")).select(F.col("doc_id").alias("_tm_id")).distinct(), "near-dropped")
    return without(docs.withColumn("_tm_id", F.col("doc_id").cast("long")), gone, "_tm_id").drop("_tm_id")


def op2_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate components of the whole texts of ``documents``."""
    return near_duplicates(read(spark, sf_dir, "documents"))


ORACLE = {"op2_near_dedup": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(words[i : i + 4], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(2, len(words) - 3))) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
      FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM p JOIN n na ON na.doc_id = x JOIN n nb ON nb.doc_id = y
      WHERE 100 * shared >= 75 * (na.n + nb.n - shared)),
r(node, seen) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.node, e.y FROM r JOIN e ON r.seen = e.x),
c AS (SELECT node, min(seen) AS component_id FROM r GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN c ON c.node = d.doc_id"""}
QUERIES = {"op2_near_dedup": op2_near_dedup}
