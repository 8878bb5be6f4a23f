"""Bootstrap intervals of group means, all replicates in one pass.

A replicate weighs each row by a Poisson(1) number instead of drawing rows, so rows needn't be gathered or
counted first: weights come from a hash of the row's identity and the replicate's number, the same on any
cluster.  A task sorts its rows by group, adds up their weights and weighted values per group and replicate,
and passes each group's sums on once; only these sums are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import groupby
from math import exp, factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

REPLICATES = 1000
LEVEL = 0.95
#: Fixed values of the weights' arithmetic: a prime below 2^31 and two multipliers.
PRIME, MULTIPLIER, SHIFT = 2**31 - 1, 48271, 69621
#: Where the Poisson(1) distribution passes from one weight to the next, in parts of the prime.
STEPS = [int(PRIME * sum(exp(-1) / factorial(j) for j in range(k + 1))) for k in range(9)]

# Rows whose weights are drawn together, few enough to stay in the processor's cache.
_ROWS = 64


def row_hash(*identity: str | Column) -> Column:
    """A whole number below the prime from the columns that tell rows apart."""
    digest = F.md5(F.concat_ws("|", *[F.col(c).cast("string") if isinstance(c, str) else c for c in identity]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % PRIME


def _folded(x: np.ndarray) -> np.ndarray:
    """The same remainder by the prime, which is all ones in binary: high and low bits are added, twice, in place."""
    for _ in range(2):
        high = x >> 31
        x &= PRIME
        x += high
    return x


def weights(hashes: np.ndarray, replicates: int) -> np.ndarray:
    """Rows by replicates: a linear and a quadratic step modulo the prime, then the Poisson steps."""
    number = np.arange(1, replicates + 1, dtype=np.int64)
    mixed = hashes[:, None] * (number * MULTIPLIER % PRIME)
    mixed += number * SHIFT % PRIME
    mixed = _folded(mixed)
    mixed *= mixed
    place = _folded(mixed)
    place[place == PRIME] = 0
    place = place.astype(np.int32)
    out = np.zeros(place.shape, np.uint8)
    for step in STEPS:
        out += place >= step
    return out


def replicate_means(df: DataFrame, value: str, keys: list[str], identity: list[str], replicates: int) -> DataFrame:
    """``keys``, ``replicate`` and ``mean``: the weighted mean of each group in each replicate."""
    rows = df.where(F.col(value).isNotNull()).select(
        *keys, row_hash(*identity).alias("_hash"), F.col(value).cast("double").alias("_value")
    )
    fields = [rows.schema[k] for k in keys]
    sums = [T.StructField("replicate", T.IntegerType()), T.StructField("_w", T.DoubleType()), T.StructField("_wx", T.DoubleType())]

    def tiles(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = None, np.zeros((2, replicates))

        def passed_on() -> pa.RecordBatch:
            columns = [pa.array([v] * replicates, batch.schema.field(i).type) for i, v in enumerate(held)]
            columns += [pa.array(np.arange(replicates, dtype=np.int32)), pa.array(total[0]), pa.array(total[1])]
            return pa.RecordBatch.from_arrays(columns, [*keys, "replicate", "_w", "_wx"])

        for batch in batches:
            hashes = batch.column("_hash").to_numpy()
            measured = np.stack([np.ones(batch.num_rows), batch.column("_value").to_numpy()])
            at = 0
            for key, run in groupby(zip(*[batch.column(k).to_pylist() for k in keys])):
                if key != held:
                    if held is not None:
                        yield passed_on()
                    held, total = key, np.zeros((2, replicates))
                stop = at + sum(1 for _ in run)
                for i in range(at, stop, _ROWS):
                    block = slice(i, min(i + _ROWS, stop))
                    total += measured[:, block] @ weights(hashes[block], replicates).astype(float)
                at = stop
        if held is not None:
            yield passed_on()

    summed = rows.sortWithinPartitions(*keys).mapInArrow(tiles, T.StructType(fields + sums)).groupBy(*keys, "replicate")
    totals = summed.agg(F.sum("_w").alias("_w"), F.sum("_wx").alias("_wx"))
    return totals.where("_w > 0").select(*keys, "replicate", (F.col("_wx") / F.col("_w")).alias("mean"))


def mean_intervals(
    df: DataFrame, value: str, keys: list[str], identity: list[str], replicates: int = REPLICATES, level: float = LEVEL
) -> DataFrame:
    """``keys``, ``ci_low``, ``ci_high``: percentiles of the replicates' means, null keys a group like any other."""
    means = replicate_means(df, value, keys, identity, replicates)
    outside = (1 - level) / 2
    bounds = F.percentile("mean", F.array(F.lit(outside), F.lit(1 - outside)))
    found = means.groupBy(*keys).agg(bounds.alias("_bounds"))
    return found.select(*keys, F.get("_bounds", F.lit(0)).alias("ci_low"), F.get("_bounds", F.lit(1)).alias("ci_high"))
