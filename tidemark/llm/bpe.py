"""Byte-level BPE encoding and decoding (operator 7).

The vocabulary is a file of ranks. Its byte strings are mapped to Latin-1, one character
per byte, so that a pyahocorasick automaton can report every vocabulary match of a piece in
one pass. The encoder walks the piece with the longest match at each position and steps
back to shorter ones when two adjacent tokens are not *compatible*: a pair is compatible if
merging its joined bytes gives exactly that pair. A tokenisation whose adjacent pairs are
all compatible is the one that merging by rank produces, so the result is exact. Pair
compatibility is memoised, and positions proven to be dead ends are never tried twice,
which keeps the walk linear in the piece.

Texts are cut at safe places before they are encoded (``chunks.py``), and the ids of chunks
and pieces are kept in bounded memories of each Python worker.

Defined cases: a null text is the empty text (no ids, digest of no bytes). Strings of
special tokens are ordinary text. Long texts are encoded whole; repeated rows are encoded
each; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.chunks import ChunkEncoder, Memory, blocks
from tidemark.llm.common import read

RANKS = "byte_bpe_50k.tiktoken"
#: Token pairs whose compatibility a worker keeps (about 80 MB); the memory starts anew beyond it.
PAIRS = 1_000_000
#: Bytes of one generation of each of a worker's three memories (pieces, chunks, spaced words), two
#: generations each: 6 x 56 MB at most.
MEMORY_BYTES = 56 << 20
#: Characters of texts encoded in one step.
BLOCK = 1 << 22


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Encoder:
    """Encodes and decodes with one table of ranks; made once in each Python worker."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.pattern = regex.compile(pattern)
        self.pairs: dict[int, bool] = {}  # key: left << 32 | right
        self.automaton = ahocorasick.Automaton()
        usable = {token: rank for token, rank in ranks.items() if len(token) == 1 or self.merge(token) == [rank]}
        for token, rank in usable.items():  # the tokens that merging can reach
            self.automaton.add_word(token.decode("latin-1"), (rank, len(token) - 1))
        self.automaton.make_automaton()
        #: the longest shorter token that a token begins with
        self.shorter = {rank: next((usable[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in usable), None)
                        for token, rank in usable.items()}
        self.length = {rank: len(token) for token, rank in usable.items()}
        self.pieces = Memory(most_bytes=MEMORY_BYTES)
        self.chunks = ChunkEncoder(self._chunks, MEMORY_BYTES)

    def merge(self, piece: bytes) -> list[int]:
        """Ids by the definition: join the adjacent pair of least rank until none is left."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if rank == 1 << 60:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def compatible(self, left: int, right: int) -> bool:
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        known = self.merge(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
        self.pairs[left << 32 | right] = known
        return known

    def piece(self, piece: bytes) -> list[int]:
        """Ids of one match of the pattern."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        longest = {}  # longest match by its start: later ends overwrite
        for end, (rank, back) in self.automaton.iter(piece.decode("latin-1")):
            longest[end - back] = rank
        size, pairs, length, shorter = len(piece), self.pairs, self.length, self.shorter
        taken, dead, at, token = [], set(), 0, longest[0]
        while at < size:
            while token is not None:
                end = at + length[token]
                if end not in dead:
                    if not taken:
                        break
                    fits = pairs.get(taken[-1] << 32 | token)
                    if fits is None:
                        fits = self.compatible(taken[-1], token)
                    if fits:
                        break
                token = shorter[token]
            if token is None:  # nothing fits here: step back and try a shorter token there
                dead.add(at)
                token = taken.pop()
                at -= length[token]
            else:
                taken.append(token)
                at = end
                token = longest.get(at)
        return taken

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        out, memory = [], self.pieces
        memory.turn()
        for chunk in chunks:
            ids = []
            for match in self.pattern.findall(chunk):
                known = memory.new.get(match)
                if known is None:
                    known = memory.older(match)
                if known is None:
                    known = np.array(self.piece(match.encode("utf-8")), "<u4").tobytes()
                    if len(match) <= 64:
                        memory.put(match, known)
                ids.append(known)
            out.append(b"".join(ids))
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        return self.chunks.encode(texts)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """The worker's encoder for a file of ranks: built once, kept for later tasks."""
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = Encoder(load_ranks(path), pattern)
    return _ENCODERS[path, pattern]


def encoded(path: str, pattern: str, keep_ids: bool = False):
    """A column function: text -> struct(n_tokens, ids_sha256, decoded_sha256[, ids])."""
    kind = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * keep_ids

    @F.pandas_udf(kind)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = encoder(path, pattern)
        for texts in batches:
            rows = []
            for ids in (ids for block in blocks(texts, BLOCK) for ids in bpe.encode(block)):
                row = (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(bpe.decode(ids)).hexdigest())
                rows.append((*row, ids) if keep_ids else row)
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * keep_ids])

    return run.asNondeterministic()  # else the planner may evaluate it once for each field


def tokenised(docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN,
              keep_ids: bool = False) -> DataFrame:
    """doc_id and the encoding of its text, with the raw ids if asked for."""
    run = encoded(path or public_tokenizers.path(RANKS), pattern, keep_ids)
    return docs.select("doc_id", run("text").alias("_tm")).select("doc_id", "_tm.*")


def op7_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids, and of the bytes decoded from them."""
    return tokenised(read(spark, sf_dir, "documents"))


QUERIES = {"op7_byte_bpe": op7_byte_bpe}
