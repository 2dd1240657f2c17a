"""Vocabulary, id lookup with hot tokens, fixed-length encoding."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import text


def _rows(spark):
    # "the" and "a" are in every row (hot keys); the rest are rare
    data = [(i, f"the a w{i % 5} the z{i}") for i in range(60)]
    return spark.createDataFrame(data, "patient_id long, text string")


@pytest.mark.parametrize("hot_tokens,hot_bytes", [(2, 1 << 20), (0, 1 << 20), (2, 0)])
def test_lookup_ids_equals_plain_join(spark, monkeypatch, hot_tokens, hot_bytes):
    monkeypatch.setattr(text, "HOT_TOKENS", hot_tokens)
    monkeypatch.setattr(text, "HOT_BYTES", hot_bytes)
    rows = _rows(spark)
    vocab = text.build_vocabulary(rows.where("patient_id < 40"))
    pieces = rows.select("patient_id", F.posexplode(text.tokens("text")).alias("pos", "token"))
    got = sorted(tuple(r) for r in text.lookup_ids(pieces, vocab).select("patient_id", "pos", "id").collect())
    want = sorted(tuple(r) for r in pieces.join(vocab, "token", "left").select("patient_id", "pos", "id").collect())
    assert got == want and len(got) == 300


def test_vocabulary_ranks_and_encoding(spark):
    rows = _rows(spark)
    vocab = text.build_vocabulary(rows)
    ids = {r["token"]: r["id"] for r in vocab.collect()}
    assert ids["the"] == text.FIRST_ID and ids["a"] == text.FIRST_ID + 1  # by frequency
    enc = text.encode_fixed_length(rows, vocab, max_length=4).where("patient_id = 7").first()
    assert enc["input_ids"] == [ids["the"], ids["a"], ids["w2"], ids["the"]]
    assert enc["attention_mask"] == [1, 1, 1, 1]
    short = text.encode_fixed_length(rows.where("patient_id = 3").withColumn("text", F.lit("the q")),
                                     vocab, max_length=4).first()
    assert short["input_ids"] == [ids["the"], text.UNKNOWN_ID, text.PAD_ID, text.PAD_ID]
    assert short["attention_mask"] == [1, 1, 0, 0]


def test_repeated_and_null_keys_are_encoded_by_row(spark):
    data = [(1, "the a"), (1, "b the a q"), (None, "the"), (None, "a b"), (2, None), (2, "")]
    rows = spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(data)], "patient_id long, text string, id int")
    vocab = text.build_vocabulary(rows)
    ids = {r["token"]: r["id"] for r in vocab.collect()}
    enc = text.encode_fixed_length(rows, vocab, max_length=4)
    assert enc.columns == ["patient_id", "text", "id", "input_ids", "attention_mask"]
    got = {r["id"]: (r["patient_id"], r["input_ids"], sum(r["attention_mask"])) for r in enc.collect()}
    for i, (key, words) in enumerate(data):
        own = [ids[w] for w in (words or "").split()]
        assert got[i] == (key, own + [text.PAD_ID] * (4 - len(own)), len(own))
