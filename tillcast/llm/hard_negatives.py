"""Hard negatives of anchors by a secondary sort: windows below each positive, read as a stream.

Scores are exact integer inner products.  Rows are dealt into parts of bounded size, and every anchor
visits every part.  A part gives each anchor its own best positives; when the best of all parts
are known, a second visit gives each positive's window its best negatives of that part, which hold all
that can be among the best overall.  These pairs are packed into keys of (anchor, descending score,
positives first, id), dealt by anchor with ``repartitionAndSortWithinPartitions``, and read in one
stream: a positive opens a window, the negatives that follow fill the open windows, a window closes
when it is full or the scores fall below its edge.  No anchor's pairs are held together.

Results for edge cases.  Rows with a null id, a null label, a null vector or any null or non-finite
component take no part.  Rows that share an id count once, with the smallest label, then vector.  Equal
scores go by the smaller id; a negative as near as the positive lies inside its window.  A positive of
negative score has an empty window, an anchor without another row of its label gives no rows.  Vectors of
another length than the anchor's aren't compared with it; empty ones score zero among themselves.  No rows give no
rows.  Columns other than the three named aren't read, so their names can't clash; there is no text.
Components or scores beyond 64 bits stop the job.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm.visits import parts_of, passing_by
from tillcast.session import shuffle_width, stored

#: Rows of one part, which a task holds while the anchors pass by.
ROWS = 16_384
# Anchors scored at once.
_ANCHORS = 128
_EXACT, _LONG = 2**53, 2**63
_KEY = struct.Struct(">QQBQ")
_FLIP = 1 << 63

_PAIR = pa.schema([("anchor_id", pa.int64()), ("positive", pa.bool_()), ("score", pa.int64()), ("vec_id", pa.int64())])
_PAIR_DDL = "anchor_id long, positive boolean, score long, vec_id long"


def quantized(table: DataFrame, label: Column, scale: float, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, label and vector (floors of the scaled components) of the rows that take part."""
    doubles = F.col(vector).cast("array<double>")
    bad = F.exists(doubles, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    rows = table.where(doubles.isNotNull() & ~bad).select(
        F.col(vec_id).cast("long").alias("vec_id"),
        label.cast("long").alias("label"),
        F.transform(doubles, lambda x: F.floor(x * F.lit(float(scale)))).alias("vector"),
    )
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull())
    least = rows.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row"))
    return least.select("vec_id", "row.label", "row.vector")


def _scores(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products of integer rows, exact: in doubles where these hold them, else in Python's integers."""
    most = int(np.abs(x).max(initial=0)) * int(np.abs(q).max(initial=0)) * max(x.shape[1], 1)
    if most < _EXACT:
        return (x.astype(np.float64) @ q.astype(np.float64).T).astype(np.int64)
    wide = x.astype(object) @ q.astype(object).T
    if wide.size and not (-_LONG <= wide.min() and wide.max() < _LONG):
        raise OverflowError("an inner product passes 64 bits")
    return wide.astype(np.int64)


def _first(scores: np.ndarray, places: np.ndarray, k: int) -> np.ndarray:
    """Of ``places``, which ascend by id, the k of highest scores; ties go by place."""
    s = scores[places]
    if len(s) > k:
        least = np.partition(s, len(s) - k)[len(s) - k]
        places = places[s >= least]
        s = scores[places]
    return places[np.argsort(-s, kind="stable")[:k]]


def _least_negative(positive: int, low: tuple[int, int]) -> int:
    """The smallest integer score that a window from low[0] / low[1] of ``positive`` holds."""
    return -((-low[0] * positive) // low[1])


class _Part:
    """The rows of one part as matrices, one for each length of vector."""

    def __init__(self, rows: pa.Table):
        # They come in the order of their ids.
        rows = rows.combine_chunks()
        sizes = np.diff(rows["vector"].chunk(0).offsets.to_numpy()) if rows.num_rows else np.zeros(0, int)
        self.by_size = {}
        for size in np.unique(sizes).tolist():
            some = rows.filter(pa.array(sizes == size))
            self.by_size[size] = (*(some[c].to_numpy() for c in ("vec_id", "label")), _matrix(some["vector"], size))

    def pairs(self, anchors: pa.RecordBatch, k: int, low: tuple[int, int]) -> Iterator[tuple[int, bool, np.ndarray, np.ndarray]]:
        """(anchor, positive?, scores, ids) of each anchor: its positives, or the negatives of its windows."""
        vectors = anchors.column("vector")
        sizes = np.diff(vectors.offsets.to_numpy())
        for size, (ids, labels, x) in self.by_size.items():
            at = np.flatnonzero(sizes == size)
            if not len(at):
                continue
            some = anchors.take(pa.array(at))
            scores = np.ascontiguousarray(_scores(x, _matrix(some.column("vector"), size)).T)
            windows = some.column("windows").to_pylist()
            for j, (anchor, label) in enumerate(zip(some.column("vec_id").to_pylist(), some.column("label").to_pylist())):
                if windows[j] is None:
                    places = _first(scores[j], np.flatnonzero((labels == label) & (ids != anchor)), k)
                    yield anchor, True, scores[j][places], ids[places]
                    continue
                other = np.flatnonzero(labels != label)
                held = set()
                for positive in set(windows[j]):
                    s = scores[j][other]
                    inside = other[(s <= positive) & (s >= _least_negative(positive, low))]
                    held.update(_first(scores[j], inside, k).tolist())
                places = np.array(sorted(held), np.int64)
                yield anchor, False, scores[j][places], ids[places]


def _matrix(column: pa.Array | pa.ChunkedArray, size: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = flat.flatten().to_numpy(zero_copy_only=False)
    # The floor of a double stops at the ends of a long.
    if len(flat) and (flat.max() == _LONG - 1 or flat.min() == -_LONG):
        raise OverflowError("a component passes 64 bits")
    return flat.reshape(-1, size) if size else np.zeros((len(column), 0), np.int64)


def _visits(rows: DataFrame, anchors: DataFrame, parts: int, k: int, low: tuple[int, int]) -> DataFrame:
    """Pairs of every anchor with the rows of every part: the rows move once, the anchors pass by."""

    def answer(part: _Part, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = list(part.pairs(batch, k, low))
        sizes = [len(ids) for *_, ids in found]
        if not sum(sizes):
            return
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat([a for a, *_ in found], sizes), pa.int64()),
                pa.array(np.repeat([p for _, p, *_ in found], sizes)),
                pa.array(np.concatenate([s for _, _, s, _ in found])),
                pa.array(np.concatenate([ids for *_, ids in found])),
            ],
            schema=_PAIR,
        )

    return passing_by(rows, "vec_id", anchors, parts, _Part, answer, _PAIR_DDL, _ANCHORS)


def _key(row) -> bytes:
    """Orders as (anchor, descending score, positives first, id)."""
    return _KEY.pack(row.anchor_id + _FLIP, _FLIP - 1 - row.score, not row.positive, row.vec_id + _FLIP)


def stream(keys: Iterable[bytes], k: int, low: tuple[int, int]) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(anchor, positive, rank, negative, both scores) from sorted keys; holds the open windows of one anchor only."""
    now, windows = None, []
    for key in keys:
        anchor, down, negative, number = _KEY.unpack(key)
        score = _FLIP - 1 - down
        if anchor != now:
            now, windows = anchor, []
        if not negative:
            windows.append([number - _FLIP, score, _least_negative(score, low), 0])
            continue
        windows = [w for w in windows if w[3] < k and score >= w[2]]
        for window in windows:
            window[3] += 1
            yield anchor - _FLIP, window[0], window[3], number - _FLIP, window[1], score


def mine(rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5, low: tuple[int, int] = (80, 100)) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id and both scores.

    ``rows`` are ``quantized``; ``anchors`` is a condition on them.  Negatives score from
    low[0] / low[1] of their positive up to all of it.
    """
    spark = rows.sparkSession
    rows = stored(rows, "mining-rows")
    parts = parts_of(rows.count(), ROWS)
    asking = rows.where(anchors)
    own = _visits(rows, asking.withColumn("windows", F.lit(None).cast("array<long>")), parts, positives, low)
    order = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    best = own.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives).drop("place")
    best = stored(best, "mining-positives")
    windows = best.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_list("score").alias("windows"))
    pairs = best.unionByName(_visits(rows, asking.join(windows, "vec_id"), parts, negatives, low))

    # Named here so that tasks get plain values.
    k = negatives
    found = (
        pairs.rdd.map(lambda row: (_key(row), None))
        .repartitionAndSortWithinPartitions(shuffle_width(spark), lambda key: zlib.crc32(key[:8]))
        .mapPartitions(lambda sorted_: stream((key for key, _ in sorted_), k, low))
    )
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    return spark.createDataFrame(found, schema, verifySchema=False)


#: The query in DuckDB.
ORACLE = """
WITH c AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
           FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS (SELECT vec_id, label, e FROM c
      QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY label, e) = 1),
s AS (SELECT a.vec_id AS anchor_id, v.vec_id, v.label = a.label AS same,
             coalesce(list_sum(list_transform(range(1, len(a.e) + 1), lambda i: a.e[i] * v.e[i])), 0)::BIGINT AS score
      FROM v AS a JOIN v ON v.vec_id <> a.vec_id AND len(v.e) = len(a.e) WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id, score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id,
             (row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id))::INTEGER AS rank,
             s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
        AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
SELECT * FROM n WHERE rank <= 5
"""
