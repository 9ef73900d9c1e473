"""Encoding and decoding against the sentencepiece library itself."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tessellate.llm import queries
from tessellate.llm.piece_codec import PieceCodec, digests, encode_pieces

tokens = pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
DATA = "/root/testdata/sf0.001"
LETTERS = ("ab", " ", "aeinrst ", "abcdefghijklmnopqrstuvwxyz  ", "\u2581 a", "=-_* \n\t", "0123456789abcdef", "日本語中文の是 不我", "é🙂\x00ﬁ①\xa0\u3000", "<s>/ </s>")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=tokens.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def codec():
    return PieceCodec(tokens.path("piece_bpe_32k.model"))


def coded(codec, texts, known):
    spelled = codec.encode_batch(texts, known)
    ids = np.frombuffer(b"".join(spelled), "<u4").astype(np.int32)
    ends = np.cumsum([len(s) // 4 for s in spelled])
    return [np.frombuffer(s, "<u4").tolist() for s in spelled], codec.decode_batch(ids, ends)


def test_random_texts(codec, library):
    rng, known = random.Random(3), {}
    for _ in range(60):
        texts = []
        for _ in range(20):
            letters = rng.choice(LETTERS) + rng.choice(("", rng.choice(LETTERS)))
            texts.append("".join(rng.choice(letters) for _ in range(rng.choice((0, 1, 2, 5, 20, 100, 400)))))
        ids, decoded = coded(codec, texts, known)
        assert ids == [library.encode(t) for t in texts]
        assert decoded == [library.decode(i) for i in ids]


def test_words_that_need_the_queue(codec, library):
    """Pairs of one rank in a long run merge one by one; so do long words of many pairs."""
    for t in (" " * 3000 + "x", "\u2581" * 999, "a" * 5000, "ab" * 4000, "".join(random.Random(1).choices("abcdefghij", k=20000))):
        assert coded(codec, [t], {})[0] == [library.encode(t)]
    symbols = codec.symbol_of[np.frombuffer(("hello" * 9).encode("utf-32-le"), "<u4")].astype(np.int64)
    by_rounds = codec.merge_rounds(symbols, np.zeros(len(symbols), np.int64))
    by_queue = codec._queued(symbols.tolist(), np.arange(len(symbols)))
    assert by_rounds[0].tolist() == by_queue[0].tolist() and by_rounds[1].tolist() == by_queue[1].tolist()


def test_decoding_any_ids(codec, library):
    rng = random.Random(5)
    for _ in range(500):
        ids = [rng.choice((rng.randrange(32000), rng.randrange(262))) for _ in range(rng.randrange(12))]
        assert codec.decode_batch(np.array(ids, np.int32), np.array([len(ids)])) == [library.decode(ids)]
    with pytest.raises(ValueError):
        codec.decode_batch(np.array([32000]), np.array([1]))


def test_query_equals_library(spark, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    rows = queries.op12_piece_codec(spark, DATA).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r["doc_id"]] or "")
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_odd_rows(spark, library):
    rows = [(1, "a b"), (1, "a b"), (None, "x"), (2, None), (3, ""), (4, " "), (5, "word " * 50_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").select("*", F.lit(0).alias("ids"), F.lit(1).alias("decoded"))
    got = encode_pieces(df)
    assert got.columns == ["doc_id", "ids", "decoded"]
    want = sorted((i or 0, tuple(library.encode(t or "")), library.decode(library.encode(t or ""))) for i, t in rows)
    assert sorted((r["doc_id"] or 0, tuple(r["ids"]), r["decoded"]) for r in got.collect()) == want
    assert digests(encode_pieces(df.limit(0))).collect() == []
