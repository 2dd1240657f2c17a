"""Tokenisation and the token store against the public libraries, and exact round trips."""

import hashlib
import random
import tempfile
import zlib

import numpy as np
import public_tokenizers
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import bpe, chunks, token_store

SF = "/root/testdata/sf0.001"
ODD = ["", " ", "  ", "a  b", " \n x", "\t a\xa0b  c", "\x1c\x1d a", "éba\n\xa0\xa0!<", "a\n\n\nb  \n c ", "\r\n\r\n a",
       "don't we'll 's", "日本語 🙂🙂 mixed", "<|endoftext|> hi", "x" * 5000, "é" * 700, "a\nb\nc", "word, word. word!!", "a' b's"]

_rank = bpe.load_ranks(public_tokenizers.path(bpe.RANKS))
_theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=_rank, special_tokens={})
_mine = bpe.encoder(public_tokenizers.path(bpe.RANKS), public_tokenizers.PATTERN)
_file = Tokenizer.from_file(public_tokenizers.path(token_store.VOCABULARY))
_file.encode_special_tokens = True


def random_texts(n, seed=0):
    rng = random.Random(seed)
    return ["".join(rng.choice(" \n\tab'sdeßéth!1\xa0<|日.,") for _ in range(rng.randint(1, 80))) for _ in range(n)]


def test_equals_tiktoken_and_round_trips():
    texts = ODD + random_texts(2000)
    for text, ids in zip(texts, _mine.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == _theirs.encode_ordinary(text)
        assert _mine.decode(ids) == text.encode()


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_any_text_equals_tiktoken(text):
    assert np.frombuffer(_mine.encode([text])[0], "<u4").tolist() == _theirs.encode_ordinary(text)


def test_memory_is_bounded_by_bytes_and_keeps_what_is_used():
    memory = chunks.Memory(most_bytes=100_000)
    for i in range(5000):
        memory.put(f"word{i}", b"x" * (1 + i % 50))
        assert memory.new.get("word0") or memory.older("word0") is not None  # in use: never lost
        for kept in (memory.new, memory.old):
            assert sum(chunks.ENTRY + len(k) + len(v) for k, v in kept.items()) <= 100_000
    assert memory.new.get("word1") is None and memory.older("word1") is None
    memory.put("long", b"x" * 200_000)  # one entry beyond the bound stands alone
    assert list(memory.new) == ["long"]


def test_small_memories_change_no_result(monkeypatch):
    monkeypatch.setattr(bpe, "MEMORY_BYTES", 2_000)
    monkeypatch.setattr(bpe, "PAIRS", 5)
    small = bpe.Encoder(_rank, public_tokenizers.PATTERN)
    texts = ODD + random_texts(300, 3) + ["many different words " + " ".join(f"w{i}x{i * 7}" for i in range(400))]
    for text, ids in zip(texts, small.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == _theirs.encode_ordinary(text)
    assert len(small.pairs) <= 5


def test_piece_equals_merging_by_definition():
    rng = random.Random(1)
    for _ in range(500):
        piece = bytes(rng.choice(b"thereinaationesouq\xc3\xa9") for _ in range(rng.randint(1, 30)))
        assert _mine.piece(piece) == (_mine.merge(piece) if piece not in _rank else [_rank[piece]])


def test_query_rows(spark):
    rows = [(1, "hello world"), (1, "hello world"), (2, None), (3, ""), (None, "x y"), (4, "ab " * 50_000)]
    docs = spark.createDataFrame([(*r, "clash", 0) for r in rows], "doc_id long, text string, ids string, n_tokens int")
    out = bpe.tokenised(docs).collect()
    want = sorted((i or -1, len(t := _theirs.encode_ordinary(x or "")), hashlib.sha256(np.array(t, "<u4").tobytes()).hexdigest(),
                   hashlib.sha256((x or "").encode()).hexdigest()) for i, x in rows)
    assert sorted((r.doc_id or -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in out) == want
    assert bpe.tokenised(docs.limit(0)).collect() == []
    kept = bpe.tokenised(docs.where("doc_id = 1"), keep_ids=True).first()
    assert np.frombuffer(kept.ids, "<u4").tolist() == _theirs.encode_ordinary("hello world")


def test_perfect_hash_is_minimal_and_knows_strangers():
    for n in (1, 2, 63, 64, 65, 5000):
        keys = token_store.make_keys([3 * i - 50 for i in range(n)], [0] * n)
        raw = token_store.pack_levels(token_store.build_levels(keys))
        index = token_store.PerfectHash(token_store.unpack_levels(raw))
        assert sorted(index.slots(keys).tolist()) == list(range(n))
    slots = np.zeros(n, token_store.SLOT)
    slots["fingerprint"][index.slots(keys)] = token_store.fingerprints(keys)
    shard = token_store.Shard(raw, slots.tobytes(), b"", 2)
    assert (shard.find(keys) >= 0).all()
    strangers = token_store.make_keys([3 * i - 49 for i in range(n)], [0] * n)
    assert (shard.find(strangers) >= 0).sum() <= 2


def encoded(text):
    return np.array([*_file.encode(text, add_special_tokens=False).ids, token_store.END], "<u4")


def test_store_round_trip(spark):
    texts = ODD + random_texts(150, 2)
    rows = [(1000 - 7 * i, t) for i, t in enumerate(texts)] + [(5, None), (-3, "negative id")]
    path = tempfile.mkdtemp(prefix="tm-store-") + "/store"
    token_store.write_store(spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, part string"),
                            path, shard_ids=200)
    store = token_store.open_store(spark, path)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_store.listing(store).collect()}
    start, want = 0, {}
    for i, text in sorted(rows):
        ids = encoded(text or "")
        want[i] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert got == want
    found = {r.doc_id: r.ids for r in token_store.lookup(store, [5, -3, 1000, 999_999]).collect()}
    assert found == {5: [0], -3: encoded("negative id").tolist(), 1000: encoded(texts[0]).tolist()}


def test_store_repeated_and_null_ids_and_empty(spark):
    rows = [(4, "b"), (4, "a"), (4, "a"), (None, "n"), (9, "z")]
    path = tempfile.mkdtemp(prefix="tm-store-") + "/store"
    token_store.write_store(spark.createDataFrame(rows, "doc_id long, text string"), path)
    out = token_store.listing(token_store.open_store(spark, path)).collect()
    assert sorted(r.doc_id or -1 for r in out) == [-1, 4, 4, 4, 9]
    starts = sorted((r.start, r.n_tokens) for r in out)
    assert [s for s, _ in starts] == np.cumsum([0, *[n for _, n in starts][:-1]]).tolist()
    token_store.write_store(spark.createDataFrame([], "doc_id long, text string"), path + "-empty")
    assert token_store.listing(token_store.open_store(spark, path + "-empty")).collect() == []


def test_query_equals_the_library_with_its_defaults(spark):
    """Also where a text holds the string of an added token."""
    plain = Tokenizer.from_file(public_tokenizers.path(token_store.VOCABULARY))
    strings = [t.content for t in plain.get_added_tokens_decoder().values()]
    texts = ["plain words", *ODD, *(f"a {x} b" for x in strings), *(f"{x}{x}" for x in strings), *random_texts(50, 3)]
    folder = tempfile.mkdtemp(prefix="tm-store-")
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_store.op8_token_store(spark, folder).collect()}
    start, want = 0, {}
    for i, text in enumerate(texts):
        ids = np.array([*plain.encode(text, add_special_tokens=False).ids, token_store.END], "<u4")
        want[i] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert strings and got == want


def latin_texts(n, seed):
    rng = random.Random(seed)
    letters = ["the", "aß", "Été", "ø", "ż", "Ą", "don't", "x.", "(no", "yes!)", "12", "a1", "_", "...", "日本", "µ", "×", "ʰ", "e\u0301", "'s", "\x01", "v\x01!", "ē", "ª"]
    return [rng.choice(" \n").join(["start", *("".join(rng.choices(letters, k=rng.randint(1, 3))) + rng.choice(["", ",", "?!"])
                                              for _ in range(rng.randint(1, 40)))]) for _ in range(n)]


def test_words_by_the_model_equal_the_library():
    mine = token_store.Encoder(public_tokenizers.path(token_store.VOCABULARY))
    assert mine.by_model
    texts = latin_texts(600, 4) + ["long words " + "abcdefgh" * 3000 + " end\n" + "z" * 200_000]
    assert sum(map(chunks.is_usual, texts)) > 500
    got = mine.encode(texts)
    mine.by_model = False  # a file whose cuts are others: all words through the tokenizer
    for text, ids, plain in zip(texts, got, mine.encode(texts), strict=True):
        assert ids == plain == encoded(text)[:-1].astype("<u2").tobytes()


def test_known_words_are_bounded_and_change_no_result(monkeypatch):
    monkeypatch.setattr(token_store, "KNOWN_WORDS", 50)
    mine = token_store.Encoder(public_tokenizers.path(token_store.VOCABULARY))
    rng = random.Random(8)
    for _ in range(60):
        texts = [" ".join(["start", *rng.choices([f"wörd{'abc'[i % 3]}{'x' * i}" for i in range(90)], k=rng.randint(1, 30)), "y" * 70])]
        assert mine.encode(texts) == [encoded(t)[:-1].astype("<u2").tobytes() for t in texts]
        assert len(mine.known.words) == len(mine.known.starts) <= 50
        assert len(mine.known.ids) == mine.known.lengths.sum()
        assert max(map(len, mine.known.words.to_pylist())) <= token_store.KNOWN_LENGTH


def test_lookup_by_index(spark):
    """Null ids, occurrences that go on across shards, ids far apart and absent ones, long lists."""
    rng = random.Random(6)
    rows = [(rng.choice([None, -(1 << 62), -5, 0, 7, 8, 900, 1 << 62]), f"text {i}") for i in range(300)]
    path = tempfile.mkdtemp(prefix="tm-store-") + "/store"
    token_store.write_store(spark.createDataFrame(rows, "doc_id long, text string"), path, shard_ids=40)
    store = token_store.open_store(spark, path)
    for asked in ([None], [7, None, 6, 5], [1 << 62, -(1 << 62)], [], list(range(0, 1000, 4)), [3]):
        found = token_store.lookup(store, asked).collect()
        assert sorted((str(r.doc_id), r.ids) for r in found) == sorted((str(i), encoded(t).tolist()) for i, t in rows if i in asked)


def test_lookup_reads_few_shards(spark, monkeypatch):
    """The scan gets the ids as conditions on a shard's range, and small row groups to skip."""
    import glob

    import pyarrow.parquet as pq
    monkeypatch.setattr(token_store, "ROW_GROUP", 20_000)
    rng = random.Random(7)
    rows = [(i, "".join(rng.choices("abcdefgh ", k=2000))) for i in range(400)]
    path = tempfile.mkdtemp(prefix="tm-store-") + "/store"
    token_store.write_store(spark.createDataFrame(rows, "doc_id long, text string"), path, shard_ids=10_000)
    groups = [pq.ParquetFile(f).metadata.num_row_groups for f in glob.glob(path + "/*.parquet")]
    assert max(groups) >= 5
    found = token_store.lookup(spark.read.schema(token_store.SHARD).parquet(path), [17, 399])
    assert "PushedFilters: [Or(And(" in found._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.doc_id, r.ids) for r in found.collect()) == [(i, encoded(rows[i][1]).tolist()) for i in (17, 399)]


def test_lookup_returns_every_row_of_a_repeated_id(spark):
    rows = [(4, f"text {i} of four") for i in range(30)] + [(4, "text 1 of four"), (3, "three"), (5, "five"), (None, "null")]
    path = tempfile.mkdtemp(prefix="tm-store-") + "/store"
    token_store.write_store(spark.createDataFrame(rows, "doc_id long, text string"), path, shard_ids=20)  # several shards
    found = token_store.lookup(token_store.open_store(spark, path), [4, 5, 0, 99]).collect()
    assert sorted((r.doc_id, r.ids) for r in found) == sorted((i, encoded(t).tolist()) for i, t in rows if i in (4, 5))
