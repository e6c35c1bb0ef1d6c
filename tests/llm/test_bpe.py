"""Byte-level BPE against the tiktoken library."""

import hashlib
import random
from array import array

import public_tokenizers as P
import pytest
import tiktoken

from clickloom.llm import bpe

PATH = P.path("byte_bpe_50k.tiktoken")
RANKS = bpe.read_ranks(PATH)


@pytest.fixture(scope="module")
def codec():
    return bpe.BytePairEncoding(RANKS, P.PATTERN)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def ids(packed):
    return array("I", packed).tolist()


def test_random_texts(codec, library):
    rnd = random.Random(1)
    alphabets = ["abcde ", "aA \n\t\x0b\x1c\x85 ", "éü漢字🙂 é", "0123456789 .,!", " the and of'll'sre", "aaaab"]
    for _ in range(2000):
        text = "".join(rnd.choice(rnd.choice(alphabets)) for _ in range(rnd.randrange(80)))
        assert ids(codec.encode(text)) == library.encode_ordinary(text)
        assert codec.decode(codec.encode(text)) == text.encode()


@pytest.mark.parametrize("text", ["", "a" * 50_000, "ab" * 20_000, " " * 9_000 + "x", "é" * 9_000, "<|endoftext|>"])
def test_long_pieces(codec, library, text):
    assert ids(codec.encode(text)) == library.encode_ordinary(text)


def test_small_vocabulary_with_a_token_no_merge_makes():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"bc": 257, b"abcd": 258}
    own = bpe.BytePairEncoding(ranks, r"\S+")
    library = tiktoken.Encoding("small", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
    for text in ("abcd", "xabcd", "abcde", "bcab", "abc", "cdab"):
        assert ids(own.encode(text)) == library.encode_ordinary(text)


def test_query_against_library(docs, library):
    given = [(1, "Hello, world's  end\n"), (2, ""), (3, None), (None, "null id"), (1, "Hello, world's  end\n"), (4, "word " * 30_000)]
    encoded = bpe.encode(docs(*given), PATH, P.PATTERN)
    found = sorted((str(r["doc_id"]), r["ids"], r["decoded"]) for r in bpe.decode(encoded, PATH, P.PATTERN).collect())
    want = sorted(
        (str(k), array("I", library.encode_ordinary(t or "")).tobytes(), (t or "").encode()) for k, t in given
    )
    assert found == want


def test_empty_table(docs, spark):
    empty = docs((1, "x")).where("doc_id > 1")
    assert bpe.decode(bpe.encode(empty, PATH, P.PATTERN), PATH, P.PATTERN).collect() == []


def test_query_on_the_given_tables(spark, library):
    from samples import SF_DIR

    from clickloom.llm.queries import QUERIES

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    found = QUERIES["op5_byte_bpe"](spark, SF_DIR).collect()
    assert len(found) == len(texts)
    for r in found:
        want = array("I", library.encode_ordinary(texts[r["doc_id"]] or ""))
        assert (r["n_tokens"], r["ids_sha256"]) == (len(want), hashlib.sha256(want.tobytes()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256((texts[r["doc_id"]] or "").encode()).hexdigest()
