"""Groups of tokens that two tokenizers cut alike, by divide and conquer at shared cuts.

Both token sequences of a text spell the same bytes.  An interval starts and closes at byte offsets
where tokens of both sides end.  Inside it, a common end near the middle is located by bisecting one
side's ends in the other's, leaping from end to end; the interval splits there and both halves go
on.  Intervals without an inner common end are leaf groups.  All intervals of a level, over all texts of
a batch, are bisected together.

Results for edge cases.  A text that is null, empty, or that one side doesn't spell byte for byte
(a tokenizer that normalizes it) has no tokens: zeros and an empty digest.  Texts are encoded whole,
however long; a task holds the tokens of about 4 MB of text, or of one longer text.  Repeated rows give
a row each, null ids included; ties for a token's best partner all count as best.  No rows give no
rows.  Columns other than the id and the text aren't read, so their names can't clash.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.llm.memo import parts
from tillcast.llm.word_ids import _byte_letters
from tillcast.session import stored

#: Bytes of text a task aligns at once.
BATCH_BYTES = 4_000_000
# Places of a row, a left and a right id in one sort key.
_ID_BITS = 20


class ByteLevel:
    """A byte-level tokenizer file whose ids order its merges: its entries serve as merge ranks."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        byte = {letter: value for value, letter in enumerate(_byte_letters())}
        ranks = {bytes(map(byte.__getitem__, entry)): number for entry, number in vocabulary.items()}
        self.bytes = [b""] * (max(ranks.values()) + 1)
        for spelled, number in ranks.items():
            self.bytes[number] = spelled
        self.encoding = tiktoken.Encoding("left", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of a blank and each text."""
        return [self.encoding.encode_ordinary(" " + text) for text in texts]


class Pieces:
    """A sentencepiece model that puts a blank before the text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [self._spelled(i) for i in range(self.model.get_piece_size())]

    def _spelled(self, number: int) -> bytes:
        piece = self.model.id_to_piece(number)
        if self.model.is_byte(number):
            return bytes([int(re.fullmatch("<0x(..)>", piece)[1], 16)])
        return piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


@lru_cache(maxsize=2)
def _loaded(left: str, right: str, pattern: str) -> tuple[ByteLevel, Pieces]:
    """One pair per Python worker."""
    return ByteLevel(left, pattern), Pieces(right)


def _next_common(i: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Places in ``a`` of the first ends from ``i`` on that ``b`` has too; each interval closes with one."""
    out = i.copy()
    open_ = np.arange(len(i))
    while len(open_):
        here = a[out[open_]]
        at = b[np.searchsorted(b, here)]
        open_, at = open_[at != here], at[at != here]
        out[open_] = np.searchsorted(a, at)
    return out


def _last_common(i: np.ndarray, first: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Places in ``a`` of the last ends up to ``i``, not before ``first``, that ``b`` has too; else -1."""
    out = np.where(i < first, -1, i)
    open_ = np.flatnonzero(out >= 0)
    while len(open_):
        here = a[out[open_]]
        before = np.searchsorted(b, here, "right") - 1
        at = np.where(before >= 0, b[before], -1)
        open_, at = open_[at != here], at[at != here]
        back = np.searchsorted(a, at, "right") - 1
        gone = back < first[open_]
        out[open_] = np.where(gone, -1, back)
        open_ = open_[~gone]
    return out


def shared_cuts(a: np.ndarray, b: np.ndarray, closes: np.ndarray) -> np.ndarray:
    """Places in ``a``, ascending, of all ends that ``b`` has too.

    ``a`` and ``b`` hold the byte offsets at which tokens end, strictly ascending over all texts of a
    batch; ``closes`` are the places in ``a`` of the texts' last tokens, which close the first intervals.
    """
    closes = np.asarray(closes, np.int64)
    found = [closes]
    start, close = np.concatenate([[0], closes[:-1] + 1])[: len(closes)], closes
    while len(start):
        inner = close > start
        start, close = start[inner], close[inner]
        middle = (start + close) // 2
        cut = _next_common(middle, a, b)
        # Nothing between the middle and the close: look back from the middle.
        none = np.flatnonzero(cut == close)
        cut[none] = _last_common(middle[none] - 1, start[none], a, b)
        held = cut >= 0
        cut, start, close = cut[held], start[held], close[held]
        found.append(cut)
        start, close = np.concatenate([start, cut + 1]), np.concatenate([cut, close])
    return np.sort(np.concatenate(found))


class _Batch:
    """Token sequences of some texts, joined end to end, and their groups."""

    def __init__(self, texts: list[str | None], left: ByteLevel, right: Pieces):
        some = [i for i, text in enumerate(texts) if text]
        plain = [texts[i] for i in some]
        self.a, self.b, self.rows = [], [], []
        for i, text, a, b in zip(some, plain, left.encode(plain), right.encode(plain)):
            spelled = b" " + text.encode()
            if b"".join(map(left.bytes.__getitem__, a)) == spelled == b"".join(map(right.bytes.__getitem__, b)):
                self.rows.append(i)
                self.a.append(a)
                self.b.append(b)
        self.n_a, self.n_b = (np.fromiter(map(len, side), np.int64, len(side)) for side in (self.a, self.b))
        self.a_ids, self.b_ids = (np.fromiter((i for ids in side for i in ids), np.int64) for side in (self.a, self.b))
        a_ends = np.cumsum(_sizes(left)[self.a_ids])
        b_ends = np.cumsum(_sizes(right)[self.b_ids])
        self.a_stops, self.b_stops = np.cumsum(self.n_a), np.cumsum(self.n_b)
        self.a_cuts = shared_cuts(a_ends, b_ends, self.a_stops - 1)
        self.b_cuts = np.searchsorted(b_ends, a_ends[self.a_cuts])
        #: Groups before the end of each text.
        self.g_stops = np.searchsorted(self.a_cuts, self.a_stops - 1, "right")
        self.n_groups = np.diff(self.g_stops, prepend=0)

    def spelled_digests(self) -> list[str]:
        """SHA-256 of each text's groups as ``a1,a2|b1;a3|b2,b3``."""
        if not self.rows:
            return []
        group = np.arange(len(self.a_cuts))
        # Before a group's left tokens stand the right tokens of all earlier groups, and so on.
        a_before = np.concatenate([[0], self.b_cuts[:-1] + 1])
        a_counts = np.diff(self.a_cuts, prepend=-1)
        b_counts = np.diff(self.b_cuts, prepend=-1)
        a_place = np.arange(len(self.a_ids)) + np.repeat(a_before, a_counts)
        b_place = np.arange(len(self.b_ids)) + np.repeat(self.a_cuts[group] + 1, b_counts)
        marks = _decimals(1 + int(max(self.a_ids.max(), self.b_ids.max())))
        n = len(marks) // 3
        code = np.empty(len(self.a_ids) + len(self.b_ids), np.int64)
        a_code, b_code = self.a_ids.copy(), self.b_ids.copy()
        a_code[self.a_cuts] += n
        b_code[self.b_cuts] += 2 * n
        code[a_place], code[b_place] = a_code, b_code
        spelled = list(map(marks.__getitem__, code.tolist()))
        stops = (self.a_stops + self.b_stops).tolist()
        return [
            hashlib.sha256(b"".join(spelled[i:j])[:-1]).hexdigest() for i, j in zip([0, *stops[:-1]], stops)
        ]

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (left, right) pairs of last tokens in each text, with how often; and places between texts."""
        row = np.repeat(np.arange(len(self.rows)), self.n_groups)
        key = row << 2 * _ID_BITS | self.a_ids[self.a_cuts] << _ID_BITS | self.b_ids[self.b_cuts]
        key, count = np.unique(key, return_counts=True)
        low = (1 << _ID_BITS) - 1
        stops = np.searchsorted(key >> 2 * _ID_BITS, np.arange(len(self.rows)), "right")
        return key >> _ID_BITS & low, key & low, count, stops


@lru_cache(maxsize=4)
def _sizes(side: ByteLevel | Pieces) -> np.ndarray:
    return np.fromiter(map(len, side.bytes), np.int64, len(side.bytes))


@lru_cache(maxsize=2)
def _decimals(n: int) -> list[bytes]:
    """Ids below a power of two above ``n`` with each of the marks that may follow one."""
    size = 1 << n.bit_length()
    return [b"%d%b" % (i, mark) for mark in (b",", b"|", b";") for i in range(size)]


def _spread(values: np.ndarray, rows: list[int], n: int) -> np.ndarray:
    """One value per text: that of its row, or zero."""
    out = np.zeros(n, np.int64)
    out[rows] = values
    return out


def _lists(stops: np.ndarray, rows: list[int], n: int, values: pa.Array) -> pa.ListArray:
    sizes = np.zeros(n, np.int64)
    sizes[rows] = np.diff(stops, prepend=0)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), values)


_LINK = T.StructType([T.StructField(name, T.IntegerType()) for name in ("a", "b", "n")])
_COUNTS = [T.StructField(name, T.LongType()) for name in ("n_a", "n_b", "n_groups", "n_links")]


def _mapped(docs: DataFrame, left: str, right: str, pattern: str, fields: list[T.StructField], columns) -> DataFrame:
    """Columns that ``columns`` makes of each batch, after the id of each text."""

    def aligned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = _loaded(left, right, pattern)
        for whole in batches:
            for batch in parts(whole, most=BATCH_BYTES):
                n = batch.num_rows
                arrays = columns(_Batch(batch.column(1).to_pylist(), *sides), n)
                yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["doc_id", *(f.name for f in fields)])

    schema = T.StructType([docs.select("doc_id").schema[0], *fields])
    return docs.select("doc_id", "text").mapInArrow(aligned, schema)


def groups(docs: DataFrame, left: str, right: str, pattern: str) -> DataFrame:
    """doc_id, the ids of both sides, and for each group the place after its last token on each side."""
    names = ("a_ids", "b_ids", "a_stops", "b_stops")
    fields = [T.StructField(name, T.ArrayType(T.IntegerType())) for name in names]

    def columns(batch: _Batch, n: int) -> list[pa.Array]:
        first_a = np.repeat(batch.a_stops - batch.n_a, batch.n_groups)
        first_b = np.repeat(batch.b_stops - batch.n_b, batch.n_groups)
        values = (
            (batch.a_stops, batch.a_ids),
            (batch.b_stops, batch.b_ids),
            (batch.g_stops, batch.a_cuts + 1 - first_a),
            (batch.g_stops, batch.b_cuts + 1 - first_b),
        )
        return [_lists(stops, batch.rows, n, pa.array(v, pa.int32())) for stops, v in values]

    return _mapped(docs, left, right, pattern, fields, columns)


def links(docs: DataFrame, left: str, right: str, pattern: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256 and the text's distinct links (a, b, n).

    A link joins two tokens that end together.  Tokens aren't empty, so each group holds one: its last two.
    """
    fields = [*_COUNTS, T.StructField("groups_sha256", T.StringType()), T.StructField("links", T.ArrayType(_LINK))]

    def columns(batch: _Batch, n: int) -> list[pa.Array]:
        digests = np.full(n, "", object)
        digests[batch.rows] = batch.spelled_digests()
        a, b, count, stops = batch.links()
        pairs = pa.StructArray.from_arrays([pa.array(v, pa.int32()) for v in (a, b, count)], ["a", "b", "n"])
        counts = [batch.n_a, batch.n_b, batch.n_groups, batch.n_groups]
        return [
            *(pa.array(_spread(c, batch.rows, n)) for c in counts),
            pa.array(digests, pa.string()),
            _lists(stops, batch.rows, n, pairs),
        ]

    return _mapped(docs, left, right, pattern, fields, columns)


def pair_counts(linked: DataFrame) -> DataFrame:
    """a, b, the corpus-wide count of their links, and whether no other left id has more with b.

    Of two tokens that end together one spells the other's tail, so there are at most as many pairs as
    the entries of both vocabularies have bytes: under a million, whatever the corpus.
    """
    counts = linked.select(F.inline("links")).groupBy("a", "b").agg(F.sum("n").alias("pair_count"))
    best = counts.groupBy("b").agg(F.max("pair_count").alias("most"))
    return counts.join(best, "b").select("a", "b", "pair_count", (F.col("pair_count") == F.col("most")).alias("best"))


def digests(docs: DataFrame, left: str, right: str, pattern: str) -> DataFrame:
    """One row per text: counts of tokens, groups and links, links to a best partner, and the groups' digest."""
    linked = stored(
        links(docs, left, right, pattern).withColumn("row", F.monotonically_increasing_id()), "aligned"
    )
    # The counts are broadcast: their number is bounded by the vocabularies.  A text's links lie in one
    # partition, so only one partial sum per text is shuffled, however common a pair is.
    held = linked.select("row", F.inline("links")).join(F.broadcast(pair_counts(linked)), ["a", "b"])
    sums = held.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"),
        F.sum(F.col("n") * F.col("pair_count")).alias("count_sum"),
    )
    return linked.join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", F.lit(0).cast("long")).alias("n_best"),
        F.coalesce("count_sum", F.lit(0).cast("long")).alias("count_sum"),
        "groups_sha256",
    )
