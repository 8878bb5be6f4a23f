import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tillcast.llm import bpe, entry

PATH = public_tokenizers.path(entry.BYTE_RANKS)


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={}
    )


@pytest.fixture(scope="module")
def encoder():
    return bpe.ByteBpe(PATH, public_tokenizers.PATTERN, memo=500)


def same(encoder, reference, texts):
    got = [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encode(texts)]
    assert got == [reference.encode_ordinary(text) for text in texts]


def test_random_texts(encoder, reference):
    random.seed(3)
    letters = ["a", "b", " ", "  ", "\n", "\t", "'s", "1", "é", "##", "　", "\x1c", "the", " in", "日本"]
    same(encoder, reference, ["".join(random.choices(letters, k=random.randint(0, 30))) for _ in range(3000)])


def test_every_character_of_the_first_planes(encoder, reference):
    letters = [chr(c) for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    same(encoder, reference, [f"a{c} {c}b1{c}{c}\n{c}  x" for c in letters])


def test_very_long_piece(encoder, reference):
    same(encoder, reference, ["x" * 60_000 + "aab" * 20_000, "ab" * 30_000])


def test_lower_rank_made_inside_a_bucket():
    # Merging "ab" makes "abc", whose rank is lower; it goes before the next "ab".
    ranks = {b"a": 0, b"b": 1, b"c": 2, b"abc": 3, b"ab": 4, b"bca": 5}
    assert bpe.merge(b"abcabcab", ranks) == [3, 3, 4]


def test_round_trip(encoder, documents):
    texts = [text or "" for _, text in documents]
    assert [encoder.decode(ids).decode() for ids in encoder.encode(texts)] == texts


def test_query(spark, folder, documents, reference):
    rows = {r["doc_id"]: r for r in entry.QUERIES["op1_byte_bpe"](spark, folder).collect()}
    assert len(rows) == len(documents)
    for doc_id, text in documents:
        ids = reference.encode_ordinary(text or "")
        row = rows[doc_id]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_edges(edges, nothing):
    rows = bpe.digests(edges, PATH, public_tokenizers.PATTERN).collect()
    assert len(rows) == 10 and [r["n_tokens"] for r in rows if r["doc_id"] in (1, 2)] == [0, 0]
    assert bpe.digests(nothing, PATH, public_tokenizers.PATTERN).count() == 0
    ids = {r["doc_id"]: r["ids"] for r in bpe.encoded(edges, PATH, public_tokenizers.PATTERN).collect()}
    assert ids[2] == [] and len(ids[4]) > 0
