"""Safe cuts of texts before tokenisation, and a bounded memory of what was encoded.

The byte-level patterns cut in front of every run of white space that follows another
character, so the strings between such places can be encoded alone and joined again. Most
texts are words separated by one space or line feed. Those are split, told apart and joined
again by Arrow's kernels, so Python looks only at the distinct words of a block of texts; a
word after a line feed keeps it, and the first word of a text has a NUL, as first character.
Texts with other white space are cut less finely or not at all; the result is the same.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Entries of one generation of a memory; a full one becomes the older generation.
REMEMBERED = 800_000
#: Bytes of an entry besides its characters: two objects' heads and a dictionary's place.
ENTRY = 180
RUN = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
#: A letter or digit, then only punctuation to the end of the chunk: the patterns cut between.
TAIL = re.compile(r"(.*[^\W_])([!-/:-@\[-`{-~]+)", re.S)
OTHER_SPACE = re.compile(r"[^\S \n]")
MARKS = "\n\0"
#: What a text of words between single spaces and line feeds does not hold.
FIRST = "\0"
UNUSUAL = [FIRST, "  ", " \n", "\n ", "\n\n", *(chr(c) for c in range(0x3001) if chr(c).isspace() and chr(c) not in " \n")]


class Memory:
    """string -> encoded bytes in two generations: a full one replaces the older one, so what is
    in use stays and the size is bounded: by entries at each step, and by ``most_bytes`` of one
    generation (keys, values and ``ENTRY`` for each) at each entry, if given."""

    def __init__(self, limit: int = REMEMBERED, most_bytes: int | None = None):
        self.limit, self.most_bytes, self.held = limit, most_bytes, 0
        self.new, self.old = {}, {}

    def turn(self) -> None:
        """Between two steps: start a new generation if this one is full."""
        if len(self.new) >= self.limit:
            self._next()

    def _next(self) -> None:
        self.old, self.new, self.held = self.new, {}, 0

    def older(self, key):
        value = self.old.get(key)
        if value is not None:
            self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if self.most_bytes is not None:
            self.held += ENTRY + len(key) + len(value)
            if self.held > self.most_bytes:
                self._next()
                self.held = ENTRY + len(key) + len(value)
        self.new[key] = value


class ChunkEncoder:
    """Encodes texts chunk by chunk; ``encode_many`` encodes a list of distinct chunks."""

    def __init__(self, encode_many: Callable[[list[str]], list[bytes]], most_bytes: int | None = None):
        self.encode_many = encode_many
        self.bare, self.spaced = Memory(most_bytes=most_bytes), Memory(most_bytes=most_bytes)  # chunks as they are; words after a space or line feed
        self.line_feed = encode_many(["\n"])[0]

    def _known(self, memory: Memory, keys: set[str]) -> tuple[dict[str, bytes], list[str]]:
        found = dict(zip(keys, map(memory.new.get, keys), strict=True))
        missing = []
        for key in [k for k, v in found.items() if v is None]:
            value = memory.older(key)
            if value is None:
                missing.append(key)
            else:
                found[key] = value
        return found, missing

    def _as_they_are(self, chunks: set[str]) -> dict[str, bytes]:
        found, missing = self._known(self.bare, chunks)
        if missing:
            for key, value in zip(missing, self.encode_many(missing), strict=True):
                found[key] = value
                if len(key) <= 64:
                    self.bare.put(key, value)
        return found

    def _after_space(self, words: list[str], cut: bool = True) -> dict[str, bytes]:
        """Distinct words that follow a space, or begin with the line feed they follow or with FIRST."""
        found, missing = self._known(self.spaced, words)
        if missing:
            marked = [w for w in missing if w[0] in MARKS]
            plain = [w for w in missing if w[0] not in MARKS]
            tails = {w: m.groups() for w in plain if cut and (m := TAIL.fullmatch(w))}
            whole = [w for w in plain if w not in tails]
            made = dict(zip(whole, self.encode_many([" " + w for w in whole]) if whole else [], strict=True))
            if marked or tails:
                bare = self._as_they_are({w[1:] for w in marked} | {tail for _, tail in tails.values()})
                stems = self._after_space(list({stem for stem, _ in tails.values()}), cut=False)
                made.update((w, bare[w[1:]] if w[0] == FIRST else self.line_feed + bare[w[1:]]) for w in marked)
                made.update((w, stems[stem] + bare[tail]) for w, (stem, tail) in tails.items())
            for word, value in made.items():
                if len(word) <= 64:
                    self.spaced.put(word, value)
            found.update(made)
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's encoding; words that are new to the worker are encoded in one call."""
        self.bare.turn()
        self.spaced.turn()
        usual = [is_usual(t) for t in texts]
        split = iter(self._split([t for t, u in zip(texts, usual, strict=True) if u]))
        out = []
        for text, plain in zip(texts, usual, strict=True):
            if plain:
                out.append(next(split))
            else:
                chunks = RUN.findall(text) if OTHER_SPACE.search(text) is None else [text] * bool(text)
                out.append(b"".join(map(self._as_they_are(set(chunks)).__getitem__, chunks)))
        return out

    def _split(self, texts: list[str]) -> list[bytes]:
        """Encodings of texts of words between single spaces and line feeds."""
        if not texts:
            return []
        spaced = pc.replace_substring(pa.array([FIRST + t for t in texts], pa.large_string()), "\n", " \n")
        lists = pc.split_pattern(spaced, " ")
        words = lists.flatten().dictionary_encode()
        distinct = words.dictionary.to_pylist()
        known = self._after_space(distinct)
        values = pa.array(list(map(known.__getitem__, distinct)), pa.large_binary()).take(words.indices)
        ends, data = np.frombuffer(values.buffers()[1], np.int64), memoryview(values.buffers()[2] or b"")
        at = ends[lists.offsets.to_numpy()].tolist()
        return [bytes(data[a:b]) for a, b in zip(at, at[1:], strict=False)]


def is_usual(text: str) -> bool:
    """A text of words between single spaces and line feeds."""
    return bool(text) and text[0] not in " \n" and text[-1] not in " \n" and not any(map(text.__contains__, UNUSUAL))


def blocks(texts: list, most: int = 1 << 23) -> Iterator[list]:
    """Consecutive runs of texts of about ``most`` characters together; a text is never cut."""
    held, size = [], 0
    for text in texts:
        held.append(text or "")
        size += len(held[-1])
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held
