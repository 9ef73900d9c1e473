"""Strings of the vocabulary's added tokens in texts."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tessellate.llm.packing import added_tokens, byte_bpe, pack_documents
from tokenizers import Tokenizer

END = "<|endoftext|>"
TEXTS = [
    f"one document{END}another one",
    END,
    f"{END}{END} x",
    f"spaces  {END}  after\n{END}\n",
    f"cut<|endoftext|{END}|>endoftext",
    "<|endoftext|",
    "<|ENDOFTEXT|> <|endoftext |>",
    f"été {END}là-bas don't{END}'t 123{END}456",
    f"word{END} " * 700,
]


@pytest.fixture(scope="module")
def contract():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_ids_equal_the_json_form(contract):
    added = added_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    encode = byte_bpe(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, added)
    assert added == {END: 50256}
    for t in ["", "plain text", *TEXTS]:
        assert np.frombuffer(encode(t), "<u4").tolist() == contract.encode(t, add_special_tokens=False).ids


def test_packing_emits_added_tokens(spark, contract):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = pack_documents(df).collect()
    for i, t in enumerate(TEXTS):
        ids = contract.encode(t, add_special_tokens=False).ids + [2]
        own = sorted((r for r in got if r["doc_id"] == i), key=lambda r: r["piece"])
        assert sum(r["length"] for r in own) == len(ids)
        for r in own:
            assert zlib.crc32(np.array(ids[r["start"] : r["start"] + r["length"]], "<u4").tobytes()) == r["ids_crc32"]
