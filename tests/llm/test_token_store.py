import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from paperloom.llm import token_store, tokens
from paperloom.llm.tokens import Encoder


@pytest.fixture(scope="module")
def whole(tokenizer):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer)
    return lambda t: tok.encode(t or "", add_special_tokens=False).ids


def test_encoder_equals_the_library(tokenizer, whole):
    rng = random.Random(3)
    parts = ["a", "Be", "é", " ", "  ", "\n", "\t", "\r", " ", ".", ",", "'s", "!", "|", "1", "٣", "漢字", "\x1c", "\x85", "<|endoftext|>", "'", "ll", "\U0001F600", "́"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(14))) for _ in range(4_000)] + [None, ""]
    enc = Encoder(tokenizer)
    for i in range(0, len(texts), 301):
        some = texts[i : i + 301]
        for t, raw in zip(some, enc.encode(pa.array(some, pa.string()))):
            assert np.frombuffer(raw, "<u4").tolist() == whole(t), t


@pytest.mark.parametrize("texts", [[""], [None, "", None], ["a b", ""], ["word " * 30, None, ""], ["x", "word " * 30, "", ""], ["", "word " * 30]])
def test_rows_behind_a_flush_stay(tokenizer, whole, monkeypatch, texts):
    monkeypatch.setattr(tokens, "BATCH_CHARS", 100)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])
    got = [(k, np.frombuffer(raw, "<u4").tolist()) for k, raw in tokens.encoded(tokenizer, [batch, batch], 2)]
    assert got == 2 * [(k, whole(t) + [2]) for k, t in enumerate(texts)]


def test_table_of_empty_texts(spark, tokenizer, work):
    docs = spark.createDataFrame([(i, None if i % 2 else "") for i in range(6)], "doc_id long, text string")
    token_store.write_token_store(spark, docs, work, tokenizer, 2, shards=1)
    rows = token_store.read_token_store(spark, work).select("doc_id", "start", "n_tokens").orderBy("start").collect()
    assert [tuple(r) for r in rows] == [(i, i, 1) for i in range(6)]


def test_round_trip(spark, rough, tokenizer, whole, work):
    token_store.write_token_store(spark, rough, work, tokenizer, 2, shards=3)
    rows = token_store.read_token_store(spark, work).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("crc"), "ids").orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == [None, None, 1, 2, 3, 4, 5, 6, 7, 7, 8, 9, 10, 12, 13]
    want = {}
    for r in rough.select("doc_id", "text").collect():
        want.setdefault(r["doc_id"], []).append(whole(r["text"]) + [2])
    start = 0
    for r in rows:
        ids = np.frombuffer(bytes(r["ids"]), "<u4").tolist()
        assert ids in want[r["doc_id"]] and r["n_tokens"] == len(ids) and r["start"] == start
        assert r["crc"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_one_document_is_read_alone(spark, rough, tokenizer, whole, work):
    token_store.write_token_store(spark, rough.filter("doc_id is not null"), work, tokenizer, 2, shards=1)
    assert token_store.read_document(work, 0, 4) == whole("one") + [2]
    assert token_store.read_document(work, 0, 1) == [2]


def test_empty_table(spark, empty, tokenizer, work):
    token_store.write_token_store(spark, empty, work, tokenizer, 2)
    assert token_store.read_token_store(spark, work).count() == 0


def test_wrong_dictionary_is_refused(spark, rough, tokenizer, work):
    token_store.write_token_store(spark, rough, work, tokenizer, 2, shards=1)
    fs, base = token_store.common.open_fs(work)
    with fs.open_output_stream(f"{base}/dictionary.zdict") as f:
        f.write(b"other")
    with pytest.raises(AssertionError):
        token_store.read_document(work, 0, 4)


def test_strings_of_added_tokens_are_ids_of_their_own(spark, tokenizer, whole, work):
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y and more words", "line\n<|endoftext|>\nline", "<|endof text|> a b", "plain words only"]
    got = [np.frombuffer(raw, "<u4").tolist() for raw in Encoder(tokenizer).encode(pa.array(texts, pa.string()))]
    assert got == [whole(t) for t in texts] and [ids.count(50256) for ids in got] == [1, 1, 1, 1, 0, 0]
    assert len(got[0]) == 4


def test_the_dictionary_sample_is_bounded_by_rows(spark):
    """Ids that are all null or all equal don't enlarge what the driver collects."""
    docs = spark.range(100_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("some text").alias("text"))
    n = token_store.dictionary_rows(docs).count()
    assert 0.7 * token_store.DICT_SAMPLE < n < 1.3 * token_store.DICT_SAMPLE
    assert token_store.dictionary_rows(docs.limit(5)).count() == 5


def test_a_repeated_attempt_leaves_one_shard(spark, tokenizer, work):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(20)], "doc_id long, text string")
    fs, base = token_store.common.open_fs(work)
    token_store.write_token_store(spark, docs, work, tokenizer, 2, shards=2)
    with fs.open_output_stream(f"{base}/00000.ids.lost") as f:
        f.write(b"half")
    token_store.write_token_store(spark, docs, work, tokenizer, 2, shards=2)
    names = [x.base_name for x in fs.get_file_info(__import__("pyarrow.fs").fs.FileSelector(base))]
    assert "00000.ids.lost" not in names
    rows = token_store.read_token_store(spark, work).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == list(range(20))
