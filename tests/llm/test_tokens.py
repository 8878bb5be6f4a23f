import random
import time
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tillcast.llm import entry, packing, range_coder, token_files, word_ids
from tillcast.llm.word_ids import WordIds

PATH = public_tokenizers.path(entry.WORD_FILE)


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda texts: [e.ids for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_words_are_those_of_the_library(library):
    random.seed(1)
    letters = ["a", "É", "́", " ", "\n", "\t", "'s", "1", "##", "\x1c", "\x85", " ", "Σ", "̸", "<", "e",
               "\x7f", "K", "İ", "ﬁ", "日"]
    texts = ["".join(random.choices(letters, k=random.randint(0, 25))) for _ in range(4000)] + ["", None]
    words = WordIds(PATH, memo=300)
    ids, edges = words.encode(pa.array(texts), 7)
    got = [ids[a:b].tolist() for a, b in zip(edges, edges[1:])]
    assert got == [x + [7] for x in library(texts)]


@pytest.mark.parametrize("n", [0, 1, 2, 4095, 4096, 4097, 50_000])
@pytest.mark.parametrize("kind", ["random", "repeats", "constant"])
def test_coder_round_trip(n, kind):
    rng = np.random.default_rng(n)
    ids = {
        "random": rng.integers(0, 1 << 16, n),
        "repeats": np.resize(rng.integers(0, 1 << 16, 37), n),
        "constant": np.full(n, 65_535),
    }[kind].astype(np.uint32)
    payload, sizes, checks = range_coder.encode(ids, 16)
    assert np.array_equal(range_coder.decode(payload, sizes, checks, n), ids)
    assert sum(sizes) == len(payload)
    if kind != "random" and n > 4000:
        assert len(payload) < n / 4


def adaptive_counts(ids):
    """Bytes of an ideal coder of plain adaptive counts with an escape, reset at each block."""
    bits = 0.0
    for start in range(0, len(ids), range_coder.BLOCK):
        seen, n = {}, 0
        for i in ids[start : start + range_coder.BLOCK].tolist():
            known = seen.get(i, 0)
            share = known / (n + len(seen)) if known else (len(seen) or 1) / ((n + len(seen)) or 1) / 2**16
            bits -= np.log2(share)
            seen[i], n = known + 1, n + 1
    return bits / 8


def test_mixture_beats_counts_alone_on_real_ids(documents):
    texts = pa.array([text for _, text in documents], pa.string())
    ids, _ = word_ids.loaded(public_tokenizers.path(entry.WORD_FILE)).encode(texts, 1)
    payload, sizes, checks = range_coder.encode(ids, 16)
    blocks = [ids[i : i + range_coder.BLOCK].astype("<u2").tobytes() for i in range(0, len(ids), range_coder.BLOCK)]
    assert len(payload) < 0.97 * adaptive_counts(ids)
    assert len(payload) < 0.85 * sum(len(zlib.compress(block, 9)) for block in blocks)
    assert np.array_equal(range_coder.decode(payload, sizes, checks, len(ids)), ids)


def test_coder_takes_little_time(monkeypatch, documents):
    monkeypatch.setattr(range_coder, "BLOCK", 1024)
    texts = pa.array([text for _, text in documents], pa.string())
    ids, _ = word_ids.loaded(public_tokenizers.path(entry.WORD_FILE)).encode(texts, 1)
    ids = np.resize(ids, 1024 * 1024)
    ratios = []
    for _ in range(2):
        start = time.process_time()
        raw = ids.astype("<u2").tobytes()
        for at in range(0, len(raw), 8192):
            zlib.compress(raw[at : at + 8192], 9)
        middle = time.process_time()
        assert np.array_equal(range_coder.decode(*range_coder.encode(ids, 16), len(ids)), ids)
        ratios.append((time.process_time() - middle) / (middle - start))
    assert min(ratios) < 20


def test_carries_reach_words_put_out():
    coder = range_coder._Encoder(2, 8)
    coder.out[:3], coder.place[0] = (5, 2**32 - 1, 2**32), 3
    coder.low[0] = np.uint64(1 << 63)
    words = [np.frombuffer(coded, "<u4").tolist() for coded in coder.finish()]
    assert words[0][:3] == [6, 0, 1] and words[1] == [0]


def test_damaged_counts_name_their_block():
    ids = np.random.default_rng(6).integers(0, 300, 2 * range_coder.BLOCK).astype(np.uint32)
    payload, sizes, checks = range_coder.encode(ids, 16)
    for at in range(0, 200, 7):
        broken = bytearray(payload)
        broken[sizes[0] + at] ^= 0x5A
        with pytest.raises(ValueError, match="block 1"):
            range_coder.decode(bytes(broken), sizes, checks, len(ids))


def test_blocks_are_dealt_evenly(monkeypatch):
    monkeypatch.setattr(range_coder, "LANES", 1024)
    assert [len(part) for part in range_coder._batches(np.arange(1150))] == [575, 575]


@pytest.mark.parametrize("lanes", [1, 3])
def test_lanes_and_wide_ids(monkeypatch, lanes):
    monkeypatch.setattr(range_coder, "LANES", lanes)
    monkeypatch.setattr(range_coder, "BLOCK", 512)
    rng = np.random.default_rng(lanes)
    ids = (rng.zipf(1.4, 3000) % (1 << 20)).astype(np.uint32)
    payload, sizes, checks = range_coder.encode(ids, 20)
    assert len(sizes) == 6
    assert np.array_equal(range_coder.decode(payload, sizes, checks, len(ids)), ids)
    every = np.arange(512, dtype=np.uint32)  # as many new ids as a block holds
    payload, sizes, checks = range_coder.encode(every, 9)
    assert np.array_equal(range_coder.decode(payload, sizes, checks, 512), every)


def test_blocks_stand_alone_and_are_checked():
    ids = np.random.default_rng(5).integers(0, 300, 3 * range_coder.BLOCK).astype(np.uint32)
    payload, sizes, checks = range_coder.encode(ids, 16)
    second = payload[sizes[0] : sizes[0] + sizes[1]]
    block = range_coder.decode(second, sizes[1:2], checks[1:2], range_coder.BLOCK)
    assert np.array_equal(block, ids[range_coder.BLOCK : 2 * range_coder.BLOCK])
    broken = bytearray(payload)
    broken[sizes[0] + 40] ^= 1
    with pytest.raises(ValueError, match="block 1"):
        range_coder.decode(bytes(broken), sizes, checks, len(ids))
    with pytest.raises(ValueError):
        range_coder.encode(np.array([1 << 16], np.uint32), 16)


def test_file_query(spark, folder, documents, library):
    rows = {r["doc_id"]: r for r in entry.QUERIES["op6_token_files"](spark, folder).collect()}
    start = 0
    for (doc_id, _), ids in zip(documents, library([t for _, t in documents])):
        ids = ids + [1]
        row = rows[doc_id]
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (start, len(ids), crc(ids))
        start += len(ids)
    assert len(rows) == len(documents)


def test_file_of_many_segments(spark, tmp_path, edges, nothing, library):
    token_files.write(edges, f"{tmp_path}/a", PATH, end_id=1, segment_ids=10)
    rows = token_files.read(spark, f"{tmp_path}/a").orderBy("start").collect()
    texts = {r["doc_id"]: r["text"] for r in edges.collect()}
    assert [r["doc_id"] for r in rows] == [None, 1, 2, 3, 4, 4, 5, 6, 7, 8]
    place = 0
    for row in rows:
        assert row["start"] == place and row["ids"] == library([texts[row["doc_id"]]])[0] + [1]
        place += len(row["ids"])
    token_files.write(nothing, f"{tmp_path}/b", PATH, end_id=1)
    assert token_files.read_digests(spark, f"{tmp_path}/b").count() == 0


def check_packing(rows, ids_of, capacity):
    by_doc, by_sequence = {}, {}
    for r in rows:
        ids = ids_of[r["doc_id"]]
        assert r["doc_tokens"] == len(ids)
        assert r["ids_crc32"] == crc(ids[r["start"] : r["start"] + r["length"]])
        by_doc.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for doc_id, parts in by_doc.items():
        end = 0
        for start, length in sorted(set(parts)):
            assert start == end
            end += length
        assert end == len(ids_of[doc_id])
    for parts in by_sequence.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    return len(by_sequence)


def test_packing_query(spark, folder, documents, library):
    rows = entry.QUERIES["op10_packing"](spark, folder).collect()
    ids_of = {doc_id: ids + [2] for (doc_id, _), ids in zip(documents, library([t for _, t in documents]))}
    assert {r["doc_id"] for r in rows} == set(ids_of)
    sequences = check_packing(rows, ids_of, 4096)
    assert sum(map(len, ids_of.values())) / 4096 / sequences > 0.95


def test_packing_edges(edges, nothing, library):
    rows = packing.pack(edges, PATH, end_id=2, capacity=64).collect()
    ids_of = {r["doc_id"]: library([r["text"]])[0] + [2] for r in edges.collect()}
    check_packing(rows, ids_of, 64)
    assert len([r for r in rows if r["doc_id"] == 4]) == 2
    assert packing.pack(nothing, PATH, end_id=2).count() == 0


def test_plan_is_near_its_bound_and_whole():
    rng = np.random.default_rng(2)
    demand = {int(s): int(n) for s, n in zip(rng.choice(np.arange(1, 65), 40, replace=False), rng.integers(1, 3000, 40))}
    made = packing.plan(demand, 64)
    packed = {}
    for pattern, uses in zip(made.patterns, made.uses):
        assert sum(size * n for size, n in pattern.items()) <= 64
        for size, n in pattern.items():
            packed[size] = packed.get(size, 0) + n * uses
    assert packed == demand
    assert made.bound <= sum(made.uses) <= 1.01 * made.bound + 2


def test_plan_of_little():
    assert packing.plan({}, 8).patterns == []
    assert packing.plan({8: 5}, 8).uses == [5]
    assert sum(packing.plan({3: 1, 5: 1}, 8).uses) == 1
