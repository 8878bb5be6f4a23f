"""Byte-level BPE with a rank queue: encoding, decoding and the per-document digest.

A pre-token's merges wait in buckets by merge rank.  A bucket holds positions of a linked list of
parts, and a two-level bitmap over the ranks finds the next bucket with two find-first-set
steps, so a pre-token of any length costs about its number of merges.  Entries made stale by
a neighbour's merge stay in their bucket and are skipped.

Texts are cut into pre-tokens by the given pattern.  A space or a line break between two
characters that are not white space always begins a pre-token of its own match, so texts are
cut there first and the parts are looked up in a bounded memo; a text with longer runs of white
space takes the pattern as a whole.  Both give the same ids.

Defined results: a null or empty text has no ids; repeated rows count each; an empty table gives
an empty result; only the named columns are read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm.memo import Memo, parts

_WORD = 256  # bits of a lower bitmap word


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class RankQueue:
    """Occupied ranks as a bitmap of words and a summary of the words that aren't zero."""

    def __init__(self) -> None:
        self.summary = 0
        self.words: dict[int, int] = {}
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            bucket.append(position)
            return
        self.buckets[rank] = [position]
        high, low = divmod(rank, _WORD)
        self.words[high] = self.words.get(high, 0) | 1 << low
        self.summary |= 1 << high

    def pop(self) -> tuple[int, list[int]]:
        """The lowest occupied rank and its positions, leftmost first."""
        high = (self.summary & -self.summary).bit_length() - 1
        word = self.words[high]
        lowest = word & -word
        word ^= lowest
        self.words[high] = word
        if not word:
            self.summary ^= 1 << high
        rank = high * _WORD + lowest.bit_length() - 1
        bucket = self.buckets.pop(rank)
        bucket.sort()
        return rank, bucket


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the lowest rank merges first, the leftmost of equal ranks first."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    size = len(piece)
    after, before = list(range(1, size + 1)), list(range(-1, size - 1))
    pair = [-1] * size  # rank of the part that begins here joined with the next one
    queue = RankQueue()
    push, rank_of = queue.push, ranks.get
    for i in range(size - 1):
        rank = rank_of(piece[i : i + 2])
        if rank is not None:
            pair[i] = rank
            push(rank, i)
    while queue.summary:
        rank, bucket = queue.pop()
        for at, i in enumerate(bucket):
            if pair[i] != rank:  # stale
                continue
            middle = after[i]
            end = after[middle]
            after[i] = end
            pair[middle] = pair[i] = -1
            lowest = rank
            if end < size:
                before[end] = i
                new = rank_of(piece[i : after[end]])
                if new is not None:
                    pair[i] = new
                    push(new, i)
                    lowest = min(lowest, new)
            left = before[i]
            if left >= 0:
                new = rank_of(piece[left:end])
                if new is None:
                    pair[left] = -1
                else:
                    pair[left] = new
                    push(new, left)
                    lowest = min(lowest, new)
            if lowest < rank:  # the rest of this bucket waits for the lower rank
                for rest in bucket[at + 1 :]:
                    if pair[rest] == rank:
                        push(rank, rest)
                break
    ids, i = [], 0
    while i < size:
        ids.append(ranks[piece[i : after[i]]])
        i = after[i]
    return ids


class ByteBpe:
    """Encoder and decoder of one vocabulary; ids are little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, pattern: str, memo: int = 300_000):
        self.ranks = read_ranks(path)
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.split = regex.compile(pattern).findall
        self.pieces = Memo(self._ids, memo)
        self.parts = Memo(self._part, memo)

    def _ids(self, piece: str) -> bytes:
        return np.array(merge(piece.encode(), self.ranks), "<u4").tobytes()

    def _split(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.split(text)))

    def _part(self, part: str) -> bytes | bool:
        """Ids of a part as it stands after a space, or False where the cut isn't safe."""
        if part in ("", "\n") or part[-1].isspace() or part[1 if part[0] == "\n" else 0].isspace():
            return False
        return self._split(part if part[0] == "\n" else " " + part)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, packed."""
        self.pieces.turn()
        self.parts.turn()
        known = self.parts.__getitem__
        out = []
        for text in texts:
            parts = text.replace("\n", " \n").split(" ")
            head = parts[0]
            try:
                if not head or head[-1].isspace():
                    raise TypeError
                out.append(self._split(head) + b"".join(map(known, parts[1:])))
            except TypeError:  # a part of False: white space stands in runs or at an end
                out.append(self._split(text))
        return out

    def decode(self, ids: bytes) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()])


@lru_cache(maxsize=2)
def _loaded(path: str, pattern: str) -> ByteBpe:
    """One per Python worker; its memo serves all tasks of the worker."""
    return ByteBpe(path, pattern)


def digests(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every whole text, by encoding and decoding it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(path, pattern)
        for batch in batches:
            rows = []
            for part in parts(batch, most=1_000_000):
                for ids in bpe.encode([text or "" for text in part.column(1).to_pylist()]):
                    decoded = hashlib.sha256(bpe.decode(ids)).hexdigest()
                    rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), decoded))
            counts, hashes, back = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(hashes, pa.string()), pa.array(back, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encoded(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and ids (array of long) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(path, pattern)
        for batch in batches:
            for part in parts(batch, most=1_000_000):
                packed = bpe.encode([text or "" for text in part.column(1).to_pylist()])
                ids = [np.frombuffer(x, "<u4").astype("int64") for x in packed]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int64()))], ["doc_id", "ids"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<long>")
