"""Token-ID output (operator 8): raw id payloads with a minimal perfect hash index.

``write_store`` deals the documents to range partitions of their id, encodes them and
writes *shards*: runs of whole documents in ascending id order. A shard is one row of a
Parquet table (so that it can lie in any store that Spark reaches) and holds

* ``payload``: the ids of its documents, end to end, raw little-endian integers;
* ``levels``: a minimal perfect hash over its document keys. Level by level, keys that meet
  no other key in a bit field of twice their number set their bit; the others go on to the
  next level. A key's slot is the number of set bits in front of its own, and counting
  words in steps makes that a constant-time look-up;
* ``slots``: for each slot the key's 32-bit fingerprint, which tells strangers apart, and
  the first position and length of its ids in the payload;
* ``keys``: the document ids in order, to list a shard without knowing them;
* ``low``, ``high``, ``low_first``, ``nulls``, ``nulls_first``: its smallest and largest id, how many
  null ids it holds, and the occurrence numbers at which ``low`` and the null ids begin here.

A look-up reads ``low`` and ``high`` first: row groups hold few shards, so Parquet's statistics skip
the others with their payloads. In a shard that may hold an id, (id, occurrence) is probed from
the first occurrence on until a fingerprint says no; a probe is one place of the index, whatever
the shard's size. A stranger passes a fingerprint with a chance of 2**-32 a probe.

``positions`` is the place of the shard in the whole: the ids of all documents before it.

Defined cases: a null text is the empty text, whose ids are the end id alone. Rows that
repeat a doc_id are told apart by their occurrence number (in the order of a hash of the text); null
ids come first. An empty table gives a store without shards. Other columns are ignored.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import Sequence, Split

from tidemark.llm.chunks import FIRST, ChunkEncoder, blocks, is_usual
from tidemark.llm.common import ensure_checkpoint_dir, read, shuffle_partitions

VOCABULARY = "byte_bpe_50k.json"
END = 0
#: Ids after which a shard is closed (one document is never cut).
SHARD_IDS = 1 << 20
SHARD = ("part int, shard int, first long, n_docs long, n_ids long, width int, "
         "low long, high long, low_first long, nulls long, nulls_first long, keys binary, levels binary, slots binary, payload binary")
SLOT = np.dtype([("fingerprint", "<u4"), ("first", "<u8"), ("length", "<u8")])
KEY = np.dtype([("doc_id", "<i8"), ("null", "<u8"), ("occurrence", "<u8")])
GAMMA, MAX_LEVELS = 2, 64
#: Bytes of one generation of a worker's memory of chunks of unusual texts (two memories, two generations).
MEMORY_BYTES = 16 << 20
#: Most words that a worker remembers between blocks, and characters of one: about 60 bytes a word.
KNOWN_WORDS, KNOWN_LENGTH = 1_000_000, 64
#: Bytes of a row group of a store, so that a look-up skips most payloads of a file.
ROW_GROUP = 8 << 20
#: Ids of a look-up that are told one by one to the scan; of more, only the smallest and largest.
TOLD_IDS = 64


# ---------------------------------------------------------------- keys and the hash index

def hashed(keys: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hash of each key; different seeds give independent hashes."""
    h = keys["doc_id"].astype("<u8") ^ (keys["occurrence"] * np.uint64(0x9E3779B97F4A7C15)) ^ (keys["null"] << np.uint64(63))
    h = h + np.uint64((seed * 0xD1B54A32D192ED03 + 0x632BE59BD9B4E019) % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(31))


def build_levels(keys: np.ndarray) -> list[np.ndarray]:
    """Bit fields of the minimal perfect hash of distinct keys."""
    levels, left = [], keys
    while len(left):
        if len(levels) == MAX_LEVELS:
            raise ValueError("keys of a hash index must be distinct")
        size = -(-GAMMA * len(left) // 64) * 64
        at = hashed(left, len(levels)) % np.uint64(size)
        hits = np.bincount(at.astype(np.int64), minlength=size)
        alone = hits[at.astype(np.int64)] == 1
        levels.append(np.packbits(hits == 1, bitorder="little"))
        left = left[~alone]
    return levels


class PerfectHash:
    """Slots 0..n-1 of the n keys an index was built from; others get any slot or -1."""

    def __init__(self, levels: list[np.ndarray]):
        self.sizes = [8 * len(b) for b in levels]
        self.words = [b.view("<u8") for b in levels]
        self.before, total = [], 0  # set bits in front of each word
        for words in self.words:
            counts = np.bitwise_count(words).astype(np.int64)
            self.before.append(total + np.cumsum(counts) - counts)
            total += int(counts.sum())

    def slots(self, keys: np.ndarray) -> np.ndarray:
        out, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for i, (size, words, before) in enumerate(zip(self.sizes, self.words, self.before, strict=True)):
            if not len(open_):
                break
            at = hashed(keys[open_], i) % np.uint64(size)
            word, bit = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            found = (words[word] >> bit) & np.uint64(1) == 1
            below = words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            out[open_[found]] = (before[word] + np.bitwise_count(below))[found]
            open_ = open_[~found]
        return out


def pack_levels(levels: list[np.ndarray]) -> bytes:
    head = np.array([len(levels), *map(len, levels)], "<u4").tobytes()
    return head + b"".join(b.tobytes() for b in levels)


def unpack_levels(raw: bytes) -> list[np.ndarray]:
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    sizes = np.frombuffer(raw, "<u4", n, 4).tolist()
    ends = np.cumsum([4 + 4 * n, *sizes]).tolist()
    return [np.frombuffer(raw, np.uint8, size, start) for size, start in zip(sizes, ends, strict=False)]


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (hashed(keys, 1 << 20) >> np.uint64(32)).astype("<u4")


def make_keys(doc_ids: list, occurrences: list[int]) -> np.ndarray:
    keys = np.zeros(len(doc_ids), KEY)
    keys["doc_id"] = [0 if d is None else d for d in doc_ids]
    keys["null"] = [d is None for d in doc_ids]
    keys["occurrence"] = occurrences
    return keys


class Shard:
    """One shard as read back: keyed access to the ids of its documents."""

    def __init__(self, levels: bytes, slots: bytes, payload: bytes, width: int):
        self.index = PerfectHash(unpack_levels(levels))
        self.slots = np.frombuffer(slots, SLOT)
        self.payload = np.frombuffer(payload, f"<u{width}")

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 where the fingerprint says that the shard has no such key."""
        at = self.index.slots(keys)
        known = at >= 0
        known[known] = self.slots["fingerprint"][at[known]] == fingerprints(keys[known])
        return np.where(known, at, -1)

    def ids(self, slot: int) -> np.ndarray:
        first, length = int(self.slots["first"][slot]), int(self.slots["length"][slot])
        return self.payload[first:first + length].astype("<u4")


# ---------------------------------------------------------------------------- encoding

#: A word of letters that are letters in every version of Unicode's tables, and punctuation behind it:
#: the patterns cut between the two and nowhere else.
REGULAR = r"^[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}]+[!-/:-@\[-`{-~]*$"
BEFORE_TAIL = r"([!-/:-@\[-`{-~]+)$"
#: Stands where a regular word is cut; no such word holds it.
CUT = "\x01"
#: Regular words that tell whether a tokenizer file cuts and spells as is supposed here.
PROBE = ["\u00e9t\u00e9", " word,", "Stra\u00dfe", " \u0104\u017c(!)", " x'", "it"]


def byte_letters() -> np.ndarray:
    """The letter (code point) by which byte-level vocabularies spell each byte: printable
    Latin-1 stands for itself, the others follow from 256 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return np.array([b if b in own else next(rest) for b in range(256)], "<u4")


class Encoder:
    """Ids of texts by a tokenizer file; equal words of a block of texts are encoded once, and those
    of earlier blocks are found among the ``KnownWords``.

    Texts of words between single spaces and line feeds are split and told apart by Arrow's
    kernels. Regular words (``REGULAR``) go to the tokenizer's model without its pattern, all
    other words through the tokenizer, in one call each; numpy lays the ids out again. Texts with
    other white space are cut by ``chunks.py``.

    Strings of added tokens count as ordinary text, or, with ``added``, as the library's
    defaults have it: a text that holds one is encoded whole, by one call.
    """

    def __init__(self, path: str, added: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs one task on each core
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.break_id = self._ids("\n")
        self.letters = byte_letters()
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = Sequence([Split(chr(self.letters[0x0A]), "isolated"),
                                             Split(chr(self.letters[ord(CUT)]), "removed")])
        probe = pa.array(PROBE, pa.large_string())
        self.by_model = (len(self.break_id) == 1 and self.tokenizer.normalizer is None
                         and self._model_ids(probe).tolist() == self._ids("\n" + "\n".join(PROBE)))
        self.known = KnownWords(self.width)
        self.chunked = ChunkEncoder(self._chunks, MEMORY_BYTES).encode
        self.whole = Tokenizer.from_file(path) if added else None
        self.strings = [t.content for t in self.whole.get_added_tokens_decoder().values()] if added else []

    def encode(self, texts: list[str]) -> list[bytes]:
        out = [b""] * len(texts)
        usual, unusual = [], []
        for i, t in enumerate(texts):
            if self.strings and any(map(t.__contains__, self.strings)):
                ids = self.whole.encode_batch_fast([t], add_special_tokens=False)[0].ids
                out[i] = np.array(ids, f"<u{self.width}").tobytes()
            elif len(self.break_id) == 1 and is_usual(t):
                usual.append(i)
            else:
                unusual.append(i)
        for some, method in ((usual, self._split), (unusual, self.chunked)):
            for i, ids in zip(some, method([texts[i] for i in some]), strict=True):
                out[i] = ids
        return out

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _split(self, texts: list[str]) -> list[bytes]:
        """Encodings of texts of words between single spaces and line feeds."""
        if not texts:
            return []
        spaced = pc.replace_substring(pa.array([FIRST + t for t in texts], pa.large_string()), "\n", " \n")
        lists = pc.split_pattern(spaced, " ")
        words = lists.flatten().dictionary_encode()
        ids, starts, lengths = self.known.look_up(words.dictionary, self._of_words)
        at = words.indices.to_numpy()
        ends = np.cumsum(lengths[at])
        # place of every id of the block: its word's beginning and how far it stands behind that
        total = int(ends[-1])
        places = np.arange(total) + np.repeat(starts[at] - (ends - lengths[at]), lengths[at])
        raw = memoryview(ids[places].tobytes())
        bounds = (np.r_[0, ends][lists.offsets.to_numpy()] * self.width).tolist()
        return [bytes(raw[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]

    def _of_words(self, words: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where in them each of the distinct words begins and how many it has. A word
        beginning with a line feed or FIRST follows that, any other one a space."""
        fed = pc.starts_with(words, "\n").to_numpy(zero_copy_only=False)
        marked = pc.or_(pc.starts_with(words, "\n"), pc.starts_with(words, FIRST))
        bare = pc.if_else(marked, pc.utf8_slice_codeunits(words, 1), words)
        pieces = pc.if_else(marked, bare, after(" ", words))
        regular = (pc.match_substring_regex(bare, REGULAR).to_numpy(zero_copy_only=False) if self.by_model
                   else np.zeros(len(words), bool))
        starts, lengths = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        made, before = [], 0
        for chosen, encode in ((regular, self._model_ids), (~regular, self._pattern_ids)):
            rows = np.flatnonzero(chosen)
            if len(rows):
                ids = encode(pieces.take(pa.array(rows)))
                at = np.flatnonzero(ids == self.break_id[0])  # a line feed stands in front of each word
                if len(at) != len(rows):
                    raise ValueError("a line feed between two words is not a token of its own")
                begin = at + ~fed[rows]  # a word that follows a line feed begins with it
                starts[rows] = begin + before
                lengths[rows] = np.r_[at[1:], len(ids)] - begin
                made.append(ids)
                before += len(ids)
        return np.concatenate(made), starts, lengths

    def _model_ids(self, pieces: pa.LargeStringArray) -> np.ndarray:
        """Ids of regular words, a line feed in front of each, by the model alone."""
        cut = pc.replace_substring_regex(pieces, BEFORE_TAIL, CUT + r"\1")
        raw = np.frombuffer(joined(cut), np.uint8)
        text = self.letters[raw].tobytes().decode("utf-32-le")
        return np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, f"<u{self.width}")

    def _pattern_ids(self, pieces: pa.LargeStringArray) -> np.ndarray:
        """Ids of words without white space in them, a line feed in front of each."""
        return np.array(self._ids(joined(pieces).decode()), f"<u{self.width}")

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        return [np.array(e.ids, f"<u{self.width}").tobytes()
                for e in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]


class KnownWords:
    """What was encoded, as arrays: words, their ids end to end, and where each word's ids are.

    A look-up is one hash join of a block's distinct words with the known ones by Arrow. Of
    more than ``KNOWN_WORDS`` words only those of the current block stay, so what is in use
    stays and the size is bounded.
    """

    def __init__(self, width: int):
        self.words = pa.array([], pa.large_string())
        self.ids, self.starts, self.lengths = np.zeros(0, f"<u{width}"), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def look_up(self, words: pa.LargeStringArray, encode) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and each word's beginning and number of ids in them; ``encode`` does so for new words."""
        at = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy()
        new = np.flatnonzero(at < 0)
        ids, starts, lengths = self.ids, np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        starts[at >= 0], lengths[at >= 0] = self.starts[at[at >= 0]], self.lengths[at[at >= 0]]
        if len(new):
            made, starts_new, lengths[new] = encode(words.take(pa.array(new)))
            starts[new] = starts_new + len(ids)
            ids = np.concatenate([ids, made])
            self._remember(words, new, ids, starts, lengths)
        return ids, starts, lengths

    def _remember(self, words: pa.LargeStringArray, new: np.ndarray, ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> None:
        short = pc.less_equal(pc.utf8_length(words), KNOWN_LENGTH).to_numpy(zero_copy_only=False)
        added = new[short[new]]
        if len(self.words) + len(added) <= KNOWN_WORDS:
            self.words = pa.concat_arrays([self.words, words.take(pa.array(added))])
            self.starts, self.lengths = np.r_[self.starts, starts[added]], np.r_[self.lengths, lengths[added]]
        else:
            kept = np.flatnonzero(short)[:KNOWN_WORDS]
            self.words, self.starts, self.lengths = words.take(pa.array(kept)), starts[kept], lengths[kept]
        # their ids alone: those of words that are not kept go
        ends = np.cumsum(self.lengths)
        self.ids = ids[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.starts - (ends - self.lengths), self.lengths)]
        self.starts = ends - self.lengths


def after(mark: str, words: pa.LargeStringArray) -> pa.LargeStringArray:
    return pc.binary_join_element_wise(pa.scalar("", pa.large_string()), words, pa.scalar(mark, pa.large_string()))


def joined(pieces: pa.LargeStringArray) -> bytes:
    """UTF-8 of the pieces, a line feed in front of each."""
    fed = after("\n", pieces)
    ends = np.frombuffer(fed.buffers()[1], np.int64)
    return fed.buffers()[2].to_pybytes()[int(ends[fed.offset]):int(ends[fed.offset + len(fed)])]


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, added: bool = False) -> Encoder:
    if (path, added) not in _ENCODERS:
        _ENCODERS[path, added] = Encoder(path, added)
    return _ENCODERS[path, added]


# -------------------------------------------------------------------- writing and reading

def _shard_row(part: int, number: int, first: int, doc_ids: list, occurrences: list[int], lengths: list[int],
               pieces: list[bytes], width: int) -> pa.RecordBatch:
    keys = make_keys(doc_ids, occurrences)
    levels = build_levels(keys)
    at = PerfectHash(levels).slots(keys)
    ends = np.cumsum(lengths)
    slots = np.zeros(len(keys), SLOT)
    slots["fingerprint"][at] = fingerprints(keys)
    slots["first"][at] = ends - lengths
    slots["length"][at] = lengths
    nulls = int(keys["null"].sum())  # they come first
    some = nulls < len(keys)
    values = (part, number, first, len(keys), int(ends[-1]), width,
              doc_ids[nulls] if some else None, doc_ids[-1] if some else None, occurrences[nulls] if some else None,
              nulls, occurrences[0] if nulls else None,
              keys.tobytes(), pack_levels(levels), slots.tobytes(), b"".join(pieces))
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 5, *[pa.binary()] * 4)
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)],
                                      names=[f.split()[0] for f in SHARD.split(", ")])


def _shards(path: str, shard_ids: int, added: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, end = encoder(path, added), None
        part = number = total = 0
        doc_ids, occurrences, lengths, pieces, held = [], [], [], [], 0
        previous, occurrence = object(), 0
        for batch in batches:
            end = end or np.array([END], f"<u{bpe.width}").tobytes()
            encoded = (ids for block in blocks(batch.column(2).to_pylist()) for ids in bpe.encode(block))
            for part, doc_id, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), encoded, strict=True):
                occurrence = occurrence + 1 if doc_id == previous else 0
                previous = doc_id
                ids += end
                doc_ids.append(doc_id)
                occurrences.append(occurrence)
                lengths.append(len(ids) // bpe.width)
                pieces.append(ids)
                held += lengths[-1]
                if held >= shard_ids:
                    yield _shard_row(part, number, total, doc_ids, occurrences, lengths, pieces, bpe.width)
                    number, total, held = number + 1, total + held, 0
                    doc_ids, occurrences, lengths, pieces = [], [], [], []
        if doc_ids:
            yield _shard_row(part, number, total, doc_ids, occurrences, lengths, pieces, bpe.width)
    return run


def write_store(docs: DataFrame, path: str, vocabulary: str | None = None, shard_ids: int = SHARD_IDS,
                added: bool = False) -> None:
    """Encode ``docs`` and write their shards below ``path``; ``added``: see ``Encoder``.

    The range partitions follow (doc_id, hash of the text), so many rows of one id spread.
    """
    parts = shuffle_partitions(docs.sparkSession)
    order = [F.col("doc_id").asc_nulls_first(), F.col("digest")]  # range bounds hold no texts
    ranged = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
              .withColumn("digest", F.xxhash64("text"))
              .repartitionByRange(parts, *order).sortWithinPartitions(*order, "text")
              .select(F.spark_partition_id().alias("part"), "doc_id", "text"))
    shards = ranged.mapInArrow(_shards(vocabulary or public_tokenizers.path(VOCABULARY), shard_ids, added), SHARD)
    (shards.write.option("compression", "zstd").option("parquet.block.size", ROW_GROUP)
     .option("parquet.page.size.row.check.min", 1).parquet(path))


def open_store(spark, path: str) -> DataFrame:
    """The shards with ``positions``: ids of all documents before the shard.

    Sums run over one row for each range partition, a number that the writer has set.
    """
    shards = spark.read.schema(SHARD).parquet(path)
    totals = shards.groupBy("part").agg(F.sum("n_ids").alias("_n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (shards.join(F.broadcast(offsets), "part")
            .withColumn("positions", F.col("_before") + F.col("first")).drop("_before"))


def listing(store: DataFrame) -> DataFrame:
    """Every document as read back by its key: doc_id, start, n_tokens, ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row["levels"], row["slots"], row["payload"], row["width"])
                keys = np.frombuffer(row["keys"], KEY)
                at = shard.find(keys)
                if (at < 0).any():
                    raise ValueError("a shard does not hold one of its keys")
                yield pa.RecordBatch.from_arrays([
                    pa.array(keys["doc_id"].astype(np.int64), pa.int64(), mask=keys["null"] == 1),
                    pa.array(row["positions"] + shard.slots["first"][at].astype(np.int64), pa.int64()),
                    pa.array(shard.slots["length"][at].astype(np.int64), pa.int64()),
                    pa.array([zlib.crc32(shard.ids(i).tobytes()) for i in at], pa.int64()),
                ], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    needed = store.select("positions", "width", "keys", "levels", "slots", "payload")
    return needed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def occurrences_of(shard: Shard, doc_id: int | None, start: int) -> np.ndarray:
    """Slots of (doc_id, start), (doc_id, start + 1), ... until the shard has no such key."""
    found, width = [], 1
    while True:
        keys = np.zeros(width, KEY)
        keys["doc_id"], keys["null"] = doc_id or 0, doc_id is None
        keys["occurrence"] = np.arange(start, start + width)
        at = shard.find(keys)
        ends = np.flatnonzero(at < 0)
        found.append(at[:ends[0]] if len(ends) else at)
        if len(ends):
            return np.concatenate(found)
        start, width = start + width, min(2 * width, 1 << 16)


def may_hold(doc_ids: list[int | None]) -> Column:
    """Condition on ``low``, ``high`` and ``nulls``: the shard may hold one of the ids."""
    known = sorted({i for i in doc_ids if i is not None})
    spans = [(i, i) for i in known] if len(known) <= TOLD_IDS else [(known[0], known[-1])]
    tests = [(F.col("low") <= last) & (F.col("high") >= first) for first, last in spans]
    if None in doc_ids:
        tests.append(F.col("nulls") > 0)
    return reduce(or_, tests, F.lit(False))


def lookup(store: DataFrame, doc_ids: list[int | None]) -> DataFrame:
    """doc_id, ids of the stated documents (a list that the caller bounds), one row for each of
    the rows that repeat an id; None asks for the rows without an id.

    Only shards whose range holds one of the ids are read; there each row costs one probe of the
    index, one fingerprint comparison and one slice of the payload, and each id one probe more.
    """
    wanted = np.array(sorted({i for i in doc_ids if i is not None}), np.int64)
    with_null = None in doc_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row["levels"], row["slots"], row["payload"], row["width"])
                asked = [(None, row["nulls_first"])] if with_null and row["nulls"] else []
                if row["low"] is not None:
                    inside = wanted[np.searchsorted(wanted, row["low"]):np.searchsorted(wanted, row["high"], "right")]
                    asked += [(i, row["low_first"] if i == row["low"] else 0) for i in inside.tolist()]
                for doc_id, start in asked:
                    at = occurrences_of(shard, doc_id, start)
                    if len(at):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([doc_id] * len(at), pa.int64()),
                             pa.array([shard.ids(i).astype("<i4") for i in at], pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return (store.where(may_hold(doc_ids))
            .select("width", "low", "high", "low_first", "nulls", "nulls_first", "levels", "slots", "payload")
            .mapInArrow(run, "doc_id long, ids array<int>"))


def op8_token_store(spark, sf_dir: str) -> DataFrame:
    """Write the ids of all documents, then report them as read back through the index."""
    path = f"{ensure_checkpoint_dir(spark)}/token-store-{uuid.uuid4().hex}"
    write_store(read(spark, sf_dir, "documents"), path, added=True)
    return listing(open_store(spark, path))


QUERIES = {"op8_token_store": op8_token_store}
