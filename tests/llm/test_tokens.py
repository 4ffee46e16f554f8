"""Token ids: chunks against whole texts, another library, round trips, edge cases."""

from __future__ import annotations

import random
from pathlib import Path

import pytest

from quire.llm.tokens import VOCABULARY, decode, encode_text, encoder, pieces, token_ids

pytestmark = pytest.mark.skipif(not Path(VOCABULARY).exists(), reason="no vocabulary")
PARTS = ["a", "word", " ", "  ", "\n", "'ll", "'s", "12", " é", "ß", "😀", "...", "\t", "’", "x" * 9, "    ", "don't", "<|endoftext|>", "\r\n", " ", "е"]


def test_chunks_equal_whole():
    rng, bpe = random.Random(1), encoder(VOCABULARY)[0]
    for _ in range(1500):
        text = "".join(rng.choices(PARTS, k=rng.randint(50, 300)))
        chunk, overlap = rng.randint(30, 90), rng.randint(8, 28)
        ids = encode_text(text, chunk=chunk, overlap=overlap)
        assert ids == bpe.encode_ordinary(text)
        assert decode(ids) == text
    prose = "".join(rng.choices(["the ", "old ", "town's ", "gate, ", "12 "], k=3000))
    assert len(pieces(prose)) == len(range(0, len(prose) - 400, 3000)) > 3 and "".join(pieces(prose)) == prose
    assert pieces("z" * 9000) == ["z" * 9000] and pieces("") == [""]


def test_table(spark):
    from tokenizers import Tokenizer

    other = Tokenizer.from_file(VOCABULARY.replace(".tiktoken", ".json"))
    other.encode_special_tokens = True
    data = [(1, "ab " * 300), (2, None), (3, ""), (4, "x" * 700), (5, "don't 12 \n\n<|endoftext|> " * 90), (5, "don't 12 \n\n<|endoftext|> " * 90), (None, "hi"), (7, "z" * 9000 + " a"), (8, " " * 5000)]
    df = spark.createDataFrame([(i, t, 1, "k") for i, t in data], "doc_id long, text string, ids int, key string").drop("ids")
    want = sorted((i or -1, other.encode(t or "", add_special_tokens=False).ids) for i, t in data)
    for chunk, overlap, spread in ((150, 60, 0), (150, 60, 1000), (3000, 400, 1 << 30)):
        got = token_ids(df, "doc_id", "text", chunk=chunk, overlap=overlap, spread=spread)
        assert got.schema["ids"].dataType.simpleString() == "array<int>"
        assert sorted((r["doc_id"] or -1, r["ids"]) for r in got.collect()) == want
    sizes = token_ids(df, "doc_id", "text", chunk=150, overlap=60, spread=0, keep=["key"], count_only=True)
    assert sorted((r["doc_id"] or -1, r["ids"]) for r in sizes.collect()) == [(i, len(x)) for i, x in want]
    assert token_ids(df.where("false"), "doc_id", "text").count() == 0
