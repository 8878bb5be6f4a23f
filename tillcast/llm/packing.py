"""Packing by cutting-stock column generation.

Documents longer than a sequence give full sequences and a remainder.  The histogram of piece
lengths (in classes of ``unit`` ids, rounded up) is a cutting-stock problem of bounded size,
whatever the number of documents: a linear program over patterns, whose columns a knapsack
dynamic program prices until the proven gap to the optimum is small.  Patterns are used the
whole number of times below their value, and what that leaves of each class is packed best-fit
decreasing.  The pieces of a class are then numbered, and ranges of numbers belong to patterns.

Defined results: a null or empty text has only the end id; repeated rows are packed each; an
empty table gives no pieces; only the named columns are read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm.memo import parts
from tillcast.llm.word_ids import loaded
from tillcast.session import stored

# Pieces of one class that are numbered in one task.
_NUMBERED = 200_000


@dataclass(frozen=True)
class Plan:
    """Patterns as class -> count, and how often each is used."""

    patterns: list[dict[int, int]]
    uses: list[int]
    bound: float  # no packing of these classes takes fewer sequences


def _price(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable pattern, by dynamic programming over the filled capacity."""
    best = np.zeros(capacity + 1)
    chosen = np.full(capacity + 1, -1)
    useful = values > 1e-12
    where, size, value = np.flatnonzero(useful), sizes[useful], values[useful]
    order = np.argsort(size)
    where, size, value = where[order], size[order], value[order]
    fits = np.searchsorted(size, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        n = fits[c]
        if n:
            gains = best[c - size[:n]] + value[:n]
            i = int(gains.argmax())
            if gains[i] > best[c] + 1e-12:
                best[c], chosen[c] = gains[i], i
    counts = np.zeros(len(sizes), np.int64)
    c = capacity
    while c > 0:
        if chosen[c] < 0:
            c -= 1
        else:
            counts[where[chosen[c]]] += 1
            c -= int(size[chosen[c]])
    return float(best[capacity]), counts


def plan(demand: dict[int, int], capacity: int, gap: float = 0.001) -> Plan:
    """Patterns for ``demand`` (class size -> pieces), within ``gap`` of the linear optimum before rounding."""
    sizes = np.array(sorted(demand), np.int64)
    if not len(sizes):
        return Plan([], [], 0.0)
    needed = np.array([demand[s] for s in sizes.tolist()], float)
    # The first basis fills a sequence with one class.
    basis = np.diag(capacity // sizes).astype(np.int64)
    inverse = np.diag(1.0 / (capacity // sizes))
    amounts = inverse @ needed
    bound = 0.0
    while True:
        duals = inverse.sum(axis=0)
        best, column = _price(sizes, duals, capacity)
        bound = max(bound, float(amounts.sum()) / max(best, 1.0))
        if best <= 1 + 1e-9 or bound >= (1 - gap) * amounts.sum():
            break
        direction = inverse @ column
        rows = np.flatnonzero(direction > 1e-9)
        ratios = amounts[rows] / direction[rows]
        leaving = rows[int(ratios.argmin())]
        step = max(0.0, float(ratios.min()))
        amounts -= step * direction
        amounts[leaving] = step
        np.maximum(amounts, 0.0, out=amounts)
        basis[:, leaving] = column
        inverse[leaving] /= direction[leaving]
        others = direction.copy()
        others[leaving] = 0.0
        inverse -= np.outer(others, inverse[leaving])
    uses = np.floor(amounts + 1e-6).astype(np.int64)
    left = needed.astype(np.int64) - basis @ uses
    while (left < 0).any():  # rounding noise
        uses[int(np.flatnonzero((basis[left < 0].sum(axis=0) > 0) & (uses > 0))[0])] -= 1
        left = needed.astype(np.int64) - basis @ uses
    patterns: list[dict[int, int]] = []
    counts: list[int] = []
    for j in np.flatnonzero(uses):
        patterns.append({int(sizes[i]): int(basis[i, j]) for i in np.flatnonzero(basis[:, j])})
        counts.append(int(uses[j]))
    rest = Counter(tuple(sorted(Counter(b).items())) for b in _best_fit(sizes, left, capacity))
    for items, n in sorted(rest.items(), reverse=True):
        patterns.append(dict(items))
        counts.append(n)
    return Plan(patterns, counts, bound)


def _best_fit(sizes: np.ndarray, left: np.ndarray, capacity: int) -> list[list[int]]:
    """Best-fit decreasing; fewer pieces than classes times the patterns of a basis remain here."""
    by_room: dict[int, list[list[int]]] = {}
    for size, n in sorted(zip(sizes.tolist(), left.tolist()), reverse=True):
        for _ in range(n):
            room = next((r for r in range(size, capacity) if by_room.get(r)), capacity)
            bin_ = by_room[room].pop() if by_room.get(room) else []
            bin_.append(size)
            by_room.setdefault(room - size, []).append(bin_)
    return [b for bins in by_room.values() for b in bins]


def _intervals(made: Plan) -> list[tuple[int, int, int, int, int, int]]:
    """(class, first number, last number, pieces a sequence, first sequence, first slot)."""
    rows, taken, sequence = [], Counter(), 0
    for pattern, uses in zip(made.patterns, made.uses):
        slot = 0
        for size, n in sorted(pattern.items(), reverse=True):
            rows.append((size, taken[size], taken[size] + n * uses - 1, n, sequence, slot))
            taken[size] += n * uses
            slot += n
        sequence += uses
    return rows


def pieces(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 4096, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, start, length, ids_crc32 and doc_tokens of full pieces and remainders."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = loaded(tokenizer)
        for batch in batches:
            for part in parts(batch):
                ids, edges = words.encode(part.column(1), end_id)
                sizes = np.diff(edges)
                # One row for each piece: its document's place in the part and its start there.
                number = -(-sizes // capacity)
                row = np.repeat(np.arange(len(sizes)), number)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)) * capacity
                length = np.minimum(sizes[row] - start, capacity)
                first = ((edges[row] + start) * 4).tolist()
                raw = memoryview(ids.astype("<u4").tobytes())
                checks = [zlib.crc32(raw[i : i + 4 * n]) for i, n in zip(first, length.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row)), pa.array(start), pa.array(length),
                     pa.array(checks, pa.int64()), pa.array(sizes[row])],
                    ["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
                )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def assign(cut: DataFrame, capacity: int = 4096, unit: int = 8) -> DataFrame:
    """Sequence and offset of each piece of a stored table of pieces.

    The histogram has at most ``capacity / unit`` classes, and the ranges at most the items of as
    many patterns, so both stay small for any input.  Numbers inside a class are given in
    buckets that follow the size of the table, so a class may hold most of the pieces.
    """
    spark = cut.sparkSession
    buckets = max(1, math.ceil(cut.count() / _NUMBERED))
    size = F.ceil(F.col("length") / unit).cast("int")
    placed = cut.withColumns({"size": size, "bucket": F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets))})
    counts = placed.groupBy("size", "bucket").agg(F.count(F.lit(1)).alias("n"))
    demand = {row["size"]: row["n"] for row in counts.groupBy("size").agg(F.sum("n").alias("n")).collect()}
    ranges = spark.createDataFrame(
        _intervals(plan(demand, capacity // unit)),
        "size int, first long, last long, each long, sequence long, slot long",
    )
    before = Window.partitionBy("size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("size", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip"))
    inside = Window.partitionBy("size", "bucket").orderBy("doc_id", "start", "ids_crc32")
    numbered = placed.withColumn("inner", F.row_number().over(inside) - 1).join(offsets, ["size", "bucket"])
    numbered = numbered.withColumn("number", F.col("skip") + F.col("inner")).drop("skip", "inner", "bucket")
    found = numbered.join(
        F.broadcast(ranges.withColumnRenamed("size", "range_size")),
        (F.col("size") == F.col("range_size")) & F.col("number").between(F.col("first"), F.col("last")),
    )
    local = F.col("number") - F.col("first")
    found = found.withColumns(
        {
            "sequence_id": F.col("sequence") + F.floor(local / F.col("each")),
            "place": F.col("slot") + F.pmod(local, F.col("each")),
        }
    )
    earlier = Window.partitionBy("sequence_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return found.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
        F.coalesce(F.sum("length").over(earlier), F.lit(0)).alias("offset"),
    )


def pack(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 4096, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """All documents packed; one row for each piece.  Texts are tokenized once and never shuffled."""
    return assign(stored(pieces(docs, tokenizer, end_id, capacity, doc_id, text), "pieces"), capacity)
