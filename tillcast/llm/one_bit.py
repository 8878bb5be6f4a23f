"""Approximate nearest neighbours with randomly rotated one-bit codes.

A vector, less the centroid and scaled to length one, is rotated at random and kept as the signs of
its coordinates, packed into words, plus two scalars: its distance from the centroid and the inner product of the
rotated vector with its code.  A query is rotated alike and kept as ``PLANES`` bits a coordinate, one packed plane for
each bit, so that its inner product with a code is a few ANDs and bit counts.  This estimates the true
one without bias, and the error has a standard deviation that both scalars tell.

Rows stay where the index puts them, in parts of bounded size, and the queries pass by twice.
First, each part compares the k rows of its best estimates exactly; the k-th distance of all parts together bounds the true
one.  Then only rows whose lower bound, the estimate less ``CERTAINTY`` standard deviations, reaches that distance are
compared exactly.  Each part keeps its k best, and these few rows are ranked in the end.

Defined results: vectors that are null, zero, of another length than most, or that hold null or
non-finite components take no part; a query that is itself such gives no rows; repeated rows are
candidates each; a row with the query's own id is no candidate; equal distances go by the smaller id; an empty table
gives an empty result.  There is no text.  Columns other than id and vector aren't read, so their names can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm.visits import parts_of, passing_by
from tillcast.session import stored

#: Rows of one part, which a task holds, and queries that it answers at once.
ROWS, QUERIES = 65_536, 256
#: Rows that the centroid is fitted on; a bound of the sample only, every row is indexed.
CENTROID_ROWS = 10_000
#: Standard deviations of the estimate that a lower bound lies below it.
CERTAINTY = 2.0
#: Bits of a query's coordinates.
PLANES = 5

_INDEX = "seq long, vec_id long, bits binary, norm double, dot double, vector binary"
_ARROW = pa.schema(
    [("seq", pa.int64()), ("vec_id", pa.int64()), ("bits", pa.binary()), ("norm", pa.float64()),
     ("dot", pa.float64()), ("vector", pa.binary())]
)
_FOUND = pa.schema([("query_id", pa.int64()), ("query_no", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
_FOUND_DDL = "query_id long, query_no long, vec_id long, score double"


def _usable(vector: Column) -> Column:
    """The vector as doubles, or null."""
    doubles = vector.cast("array<double>")
    bad = F.exists(doubles, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.when(F.exists(doubles, lambda x: x != 0) & ~bad, doubles)


def vectors(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id and vector of the rows that take part."""
    rows = table.select(F.col(vec_id).cast("long").alias("vec_id"), _usable(F.col(vector)).alias("vector"))
    rows = rows.where(F.col("vector").isNotNull() & F.col("vec_id").isNotNull())
    sizes = rows.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    most = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    return rows.where(F.size("vector") == (most["d"] if most else 0))


def rotation(dimension: int, seed: int = 7) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dimension, dimension)))
    return q * np.sign(np.diag(r))


def _matrix(column: pa.Array | pa.ChunkedArray, dimension: int) -> np.ndarray:
    flat = column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(-1, dimension)


def _words(bits: np.ndarray) -> np.ndarray:
    """Rows of bits packed into rows of 64-bit words."""
    packed = np.packbits(bits, axis=-1)
    room = -packed.shape[-1] % 8
    return np.ascontiguousarray(np.pad(packed, [(0, 0)] * (packed.ndim - 1) + [(0, room)])).view(np.uint64)


def encode(x: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs, distance from the centre, and inner product of unit vector and code."""
    rest = x - centre
    norm = np.sqrt((rest * rest).sum(axis=1))
    unit = (rest / np.where(norm > 0, norm, 1.0)[:, None]) @ turn.T
    dot = np.abs(unit).sum(axis=1) / np.sqrt(x.shape[1])
    return _words(unit >= 0), norm, np.where(norm > 0, dot, 1.0)


class Index:
    """Codes of all rows beside their vectors, and what is needed to search them."""

    def __init__(self, codes: DataFrame, centre: np.ndarray, turn: np.ndarray):
        self.codes, self.centre, self.turn = codes, centre, turn


def build(rows: DataFrame) -> Index:
    """Index every row of ``vectors``; the index is stored, so a lost executor doesn't cost a rebuild."""
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(CENTROID_ROWS).collect()
    dimension = len(sample[0]["vector"]) if sample else 1
    centre = np.mean([row["vector"] for row in sample], axis=0) if sample else np.zeros(1)
    turn = rotation(dimension)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows are dealt by their number, so rows of one id spread over the parts.
        first = TaskContext.get().partitionId() << 32
        for batch in batches:
            x = _matrix(batch.column(1), dimension)
            bits, norm, dot = encode(x, centre, turn)
            yield pa.RecordBatch.from_arrays(
                [pa.array(first + np.arange(len(x))), batch.column(0), pa.array([b.tobytes() for b in bits], pa.binary()),
                 pa.array(norm), pa.array(dot), pa.array([v.tobytes() for v in x], pa.binary())],
                schema=_ARROW,
            )
            first += len(x)

    return Index(stored(rows.mapInArrow(run, _INDEX), "one-bit-index"), centre, turn)


def _distance(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean distances, the squares added up in the order of the components."""
    total = np.zeros(len(x))
    for part in (x - q).T:
        total += part * part
    return np.sqrt(total)


class Part:
    """Codes and vectors of the rows of one part."""

    def __init__(self, ids: np.ndarray, words: np.ndarray, norm: np.ndarray, dot: np.ndarray, x: np.ndarray):
        self.ids, self.words, self.norm, self.dot, self.x = ids, words, norm, dot, x
        self.ones = np.bitwise_count(words).sum(axis=1, dtype=np.int64)
        self.noise = (1 - dot * dot) / (dot * dot) / max(x.shape[1] - 1, 1)

    @classmethod
    def of(cls, rows: pa.Table, dimension: int) -> Part:
        words = np.frombuffer(b"".join(rows["bits"].to_pylist()), np.uint64).reshape(rows.num_rows, -1)
        x = np.frombuffer(b"".join(rows["vector"].to_pylist()), np.float64).reshape(-1, dimension)
        return cls(*(rows["vec_id"].to_numpy(), words, rows["norm"].to_numpy(), rows["dot"].to_numpy(), x))

    def estimates(self, unit: np.ndarray, far: float) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances from a query, as estimated, and the standard deviation of each.

        ``unit`` is the query's rotated unit vector and ``far`` its distance from the centroid.
        """
        root = np.sqrt(len(unit))
        low, high = unit.min(), unit.max()
        step = (high - low) / (2**PLANES - 1) or 1.0
        levels = np.rint((unit - low) / step).astype(np.int64)
        hits = np.zeros(len(self.ids), np.int64)
        for plane in range(PLANES):
            common = np.bitwise_count(self.words & _words(levels >> plane & 1 == 1))
            hits += common.sum(axis=1, dtype=np.int64) << plane
        # The code's sum over its ones, less the sum over its zeros.
        rounded = step * levels.sum() + low * len(unit)
        cosine = (2 * (step * hits + low * self.ones) - rounded) / root / self.dot
        reach = 2 * self.norm * far
        rounding = (step / self.dot) ** 2 / 12
        return self.norm**2 + far**2 - reach * cosine, reach * np.sqrt(self.noise + rounding)

    def nearest(self, places: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and exact distances of the k nearest of some places, ties by id."""
        distance = _distance(self.x[places], q)
        order = np.lexsort((self.ids[places], distance))[:k]
        return self.ids[places][order], distance[order]

    def survivors(self, own: int, unit: np.ndarray, far: float, k: int, bound: float | None) -> np.ndarray:
        """Places to compare exactly: without a bound those of the k best estimates, else those whose lower bounds reach it."""
        others = np.flatnonzero(self.ids != own)
        guess, deviation = self.estimates(unit, far)
        if bound is not None:
            return others[guess[others] - CERTAINTY * deviation[others] <= bound * bound * (1 + 1e-9)]
        if len(others) > k:
            others = others[np.argpartition(guess[others], k - 1)[:k]]
        return others


def _rotated(q: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of queries, rotated, and their distances from the centre."""
    rest = q - centre
    far = np.sqrt((rest * rest).sum(axis=1))
    return (rest / np.where(far > 0, far, 1.0)[:, None]) @ turn.T, far


def _visits(index: Index, asked: DataFrame, parts: int, k: int) -> DataFrame:
    """query_id, query_no, vec_id and score of the k nearest in each part among the rows compared exactly.

    ``asked`` has query_id, query_no, query and bound.
    """
    centre, turn = index.centre, index.turn
    dimension = len(centre)

    def answer(part: Part, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        q = _matrix(batch.column("query"), dimension)
        units, far = _rotated(q, centre, turn)
        out: list[list[np.ndarray]] = [[], [], [], []]
        names = zip(*(batch.column(c).to_pylist() for c in ("query_id", "query_no", "bound")))
        for j, (own, number, bound) in enumerate(names):
            near, distance = part.nearest(part.survivors(own, units[j], far[j], k, bound), q[j], k)
            for column, values in zip(out, (np.full(len(near), own), np.full(len(near), number), near, distance)):
                column.append(values)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), f.type) for c, f in zip(out, _FOUND)], schema=_FOUND)

    def hold(rows: pa.Table) -> Part:
        return Part.of(rows, dimension)

    return passing_by(index.codes, "seq", asked, parts, hold, answer, _FOUND_DDL, QUERIES)


def search(index: Index, queries: DataFrame, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id and score (Euclidean distance) of the k nearest of each query row.

    ``queries`` has vec_id and vector, as from ``vectors``.
    """
    asked = queries.select(F.col("vec_id").alias("query_id"), F.col("vector").alias("query")).dropDuplicates()
    asked = stored(asked.withColumn("query_no", F.xxhash64("query_id", "query")), "one-bit-queries")
    parts = parts_of(index.codes.count(), ROWS)
    nearest = Window.partitionBy("query_id", "query_no").orderBy("score", "vec_id")

    def ranked(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)

    first = ranked(_visits(index, asked.withColumn("bound", F.lit(None).cast("double")), parts, k))
    # With fewer than k candidates at all, every row is near enough.
    reached = F.when(F.count(F.lit(1)) == k, F.max("score")).otherwise(F.lit(float("inf")))
    bounds = first.groupBy("query_id", "query_no").agg(reached.alias("bound"))
    found = _visits(index, asked.join(bounds, ["query_id", "query_no"]), parts, k)
    return ranked(found).select("query_id", "rank", "vec_id", "score")


#: The exact answer by DuckDB, which the search reaches where no bound is exceeded.
ORACLE = """
WITH v AS (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
             AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
d AS (SELECT len(e) AS n FROM v GROUP BY 1 ORDER BY count(*) DESC, n DESC LIMIT 1),
u AS (SELECT v.* FROM v JOIN d ON len(e) = n),
q AS (SELECT vec_id, e, min(rid) AS rid FROM u WHERE vec_id % 100 = 0 GROUP BY vec_id, e),
s AS (SELECT q.rid, q.vec_id AS query_id, u.vec_id, sqrt(list_reduce(list_transform(range(1, len(q.e) + 1),
        lambda i: (u.e[i] - q.e[i]) * (u.e[i] - q.e[i])), lambda a, b: a + b)) AS score
      FROM q JOIN u ON u.vec_id <> q.vec_id),
r AS (SELECT query_id, row_number() OVER (PARTITION BY rid ORDER BY score, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
