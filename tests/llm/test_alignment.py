import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tillcast.llm import alignment, entry

LEFT, RIGHT = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
ZEROS = (0, 0, 0, 0, 0, 0, "")


@pytest.fixture(scope="module")
def sides():
    """Both libraries and the bytes of their tokens, read without the operator."""
    left = Tokenizer.from_file(LEFT)
    left.encode_special_tokens = True
    right = sentencepiece.SentencePieceProcessor(model_file=RIGHT)
    letters = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in letters} | {chr(256 + i): b for i, b in enumerate(sorted({*range(256)} - {*letters}))}
    a_bytes = {i: bytes(byte[c] for c in entry) for entry, i in left.get_vocab().items() if i != 50256}
    b_bytes = {}
    for i in range(right.get_piece_size()):
        piece = right.id_to_piece(i)
        b_bytes[i] = bytes([int(piece[3:5], 16)]) if right.is_byte(i) else piece.replace("▁", " ").encode()
    return left, right, a_bytes, b_bytes


def brute(rows, sides):
    """doc_id and the query's columns by a merge of both end lists."""
    left, right, a_bytes, b_bytes = sides
    texts, pairs = [], Counter()
    for doc, text in rows:
        a = left.encode(" " + text, add_special_tokens=False).ids if text else []
        b = right.encode(text) if text else []
        whole = (" " + text).encode() if text else b""
        if b"".join(a_bytes[i] for i in a) != whole or b"".join(b_bytes[i] for i in b) != whole:
            a = b = []
        groups, now, i, j, ends = [], ([], []), 0, 0, [0, 0]
        while i < len(a) or j < len(b):
            if ends[0] <= ends[1]:
                now[0].append(a[i])
                ends[0] += len(a_bytes[a[i]])
                i += 1
            else:
                now[1].append(b[j])
                ends[1] += len(b_bytes[b[j]])
                j += 1
            if ends[0] == ends[1]:
                groups.append(now)
                now = ([], [])
        pairs.update((x[-1], y[-1]) for x, y in groups)
        texts.append((doc, len(a), len(b), groups))
    most = Counter()
    for (_, b), n in pairs.items():
        most[b] = max(most[b], n)
    out = []
    for doc, n_a, n_b, groups in texts:
        linked = [(x[-1], y[-1]) for x, y in groups]
        spelled = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        digest = hashlib.sha256(spelled.encode()).hexdigest() if groups else ""
        best = sum(pairs[p] == most[p[1]] for p in linked)
        out.append((doc, n_a, n_b, len(groups), len(linked), best, sum(pairs[p] for p in linked), digest))
    return sorted(out, key=repr)


def aligned(docs):
    rows = alignment.digests(docs, LEFT, RIGHT, public_tokenizers.PATTERN).collect()
    return sorted(map(tuple, rows), key=repr)


def test_query_matches_brute_force(spark, folder, documents, sides):
    rows = entry.QUERIES["op11_shared_cuts"](spark, folder).collect()
    assert sorted(map(tuple, rows), key=repr) == brute(documents, sides)


def test_odd_texts(made, sides):
    pick = random.Random(3)
    letters = "ab  \n\t'ß漢字😀é<|endoftext|>▁\x00<0x41>123.,"
    rows = [(i, "".join(pick.choices(letters, k=pick.randrange(60)))) for i in range(300)]
    rows += [(400, "x" * 20_000), (401, " " * 5_000), (402, "漢" * 4_000), (403, "<s> <|endoftext|> <unk> ▁"), (None, "a b")]
    rows += rows[:3]
    assert aligned(made(rows)) == brute(rows, sides)


def test_edges(edges, nothing):
    rows = aligned(edges)
    assert len(rows) == 10 and [r for r in rows if r[0] in (1, 2)] == [(1, *ZEROS), (2, *ZEROS)]
    assert len({r for r in rows if r[0] == 4}) == 1
    assert aligned(nothing) == []


def test_many_small_batches_change_nothing(made, documents, monkeypatch):
    docs = made(documents[:60])
    before = aligned(docs)
    monkeypatch.setattr(alignment, "BATCH_BYTES", 500)
    assert aligned(docs) == before


def test_shared_cuts_of_random_ends():
    rng = np.random.default_rng(5)
    for share in (0.02, 0.3, 0.9):
        for _ in range(40):
            n = int(rng.integers(1, 400))
            ends = [np.sort(rng.choice(n, int(n * share), replace=False)) for _ in range(2)]
            closes = np.unique(np.concatenate([rng.choice(n, min(n, 3)), [n - 1]]))
            a, b = (np.union1d(e, closes) for e in ends)
            found = alignment.shared_cuts(a, b, np.searchsorted(a, closes))
            assert a[found].tolist() == np.intersect1d(a, b).tolist()


def test_groups_spell_the_text(made, documents, sides):
    _, _, a_bytes, b_bytes = sides
    texts = dict(documents)
    for row in alignment.groups(made(documents[:40]), LEFT, RIGHT, public_tokenizers.PATTERN).collect():
        parts = []
        for ids, stops, spelled in ((row.a_ids, row.a_stops, a_bytes), (row.b_ids, row.b_stops, b_bytes)):
            cuts = [0, *stops]
            parts.append([b"".join(spelled[i] for i in ids[s:e]) for s, e in zip(cuts, cuts[1:])])
        assert parts[0] == parts[1]
        text = texts[row.doc_id]
        assert b"".join(parts[0]) == ((" " + text).encode() if text else b"")
