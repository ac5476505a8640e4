import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from llm_cases import awkward

from quire.llm import bpe, queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def ranks():
    with open(queries.RANKS, "rb") as file:
        return bpe.read_ranks(file.read())


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def strings():
    rng = random.Random(1)
    alphabets = ["ab", "a", "abcd efgh", "aeé ü1 ", "zß漢字🙂\n ", "it's  \x1c\x85\xa0 ²½1-'re", "<|endoftext|> ", "".join(map(chr, range(bpe.QUICK_BELOW)))]
    for _ in range(800):
        alphabet = rng.choice(alphabets)
        yield "".join(rng.choice(alphabet) for _ in range(rng.choice([0, 1, 3, 10, 60, 300])))
    yield "a" * 50_000
    yield "".join(rng.choice("abcdefgh") for _ in range(50_000))


def test_equals_library(ranks, library):
    encoder = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    for text in strings():
        packed = encoder.encode(text)
        assert np.frombuffer(packed, "<u4").tolist() == library.encode_ordinary(text), text[:200]
        assert encoder.decode(packed).decode() == text


def test_quick_pattern_on_every_code_point():
    quick, full = bpe.quick_pattern(public_tokenizers.PATTERN), bpe.regex.compile(public_tokenizers.PATTERN)
    for code in range(bpe.QUICK_BELOW):
        text = f"a{chr(code)}b1{chr(code)}2{chr(code)} {chr(code)}{chr(code)}x "
        assert quick.findall(text) == full.findall(text)


def test_memory_is_bounded(ranks, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    encoder = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    text = " ".join(f"word{i}" for i in range(50)) + "y" * 100
    assert encoder.decode(encoder.encode(text)) == text.encode() and len(encoder) <= 5


def test_awkward(spark):
    df = awkward(spark).selectExpr("*", "1 AS token_ids", "'x' AS decoded")
    encoded = bpe.encode(df, queries.RANKS, public_tokenizers.PATTERN)
    rows = bpe.decode(encoded, queries.RANKS, public_tokenizers.PATTERN).collect()
    given = sorted((str(r.doc_id), (r.text or "").encode()) for r in df.collect())
    assert sorted((str(r.doc_id), bytes(r.decoded)) for r in rows) == given
    both = bpe.round_trip(df, queries.RANKS, public_tokenizers.PATTERN).collect()
    assert sorted(map(repr, both)) == sorted(map(repr, rows))
    assert bpe.encode(df.limit(0), queries.RANKS, public_tokenizers.PATTERN).count() == 0


def test_query(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = queries.registered()["op4_byte_bpe"](spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode_ordinary(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()


def test_rank_file():
    line = base64.b64encode(b"ab") + b" 7"
    assert bpe.read_ranks(line + b"\n") == {b"ab": 7}
