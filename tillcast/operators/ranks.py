"""Exact order statistics without ever sorting a whole column in one task, each in one plan.

A mergeable quantile summary (Spark's ``percentile_approx``, whose rank error is bounded) brackets what is
wanted.  Rows outside the brackets fold into a few counts in the task that reads them; only the distinct values inside are
sorted.  No job runs before the caller's action.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.session import shuffle_width

#: One over the largest error of a summary's ranks, as a share of the rows.
ACCURACY = 10_000


def ecdf(df: DataFrame, column: str) -> DataFrame:
    """``(x, y)``: the share of non-null values that are at most ``x``, one row per distinct value.

    Distinct values are cut into ranges by a summary of them, four for each shuffle partition; the
    ranges' sizes, a small aggregate, shift the running counts inside a range.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("double").alias("x")).count()
    ranges = max(2, 4 * shuffle_width(df.sparkSession))
    inner = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    # Both columns of the counts, so that the rows counted for the cuts are those read below.
    summary = F.struct(F.percentile_approx("x", inner, ACCURACY).alias("cuts"), F.sum("count").alias("total"))
    told = counts.withColumn("_told", counts.agg(summary).scalar())
    # Never null, so the join below asks nothing of the rows before they are counted.
    below = F.coalesce(F.size(F.filter("_told.cuts", lambda c: c < F.col("x"))), F.lit(0))
    placed = told.withColumn("_range", below)
    in_order = Window.orderBy("_range")  # one row per range
    offsets = (
        placed.groupBy("_range")
        .agg(F.sum("count").alias("_inside"))
        .select("_range", (F.sum("_inside").over(in_order) - F.col("_inside")).alias("_before"))
    )
    running = F.sum("count").over(Window.partitionBy("_range").orderBy("x"))
    share = (F.col("_before") + running) / F.col("_told.total")
    return placed.join(offsets, "_range").select("x", share.alias("y"))


def _summaries(rows: DataFrame, fractions: dict[str, float], by: list[str], also: list[Column]) -> DataFrame:
    """Per group the count ``_n``, further aggregates, and ``_brackets``: values around each wanted rank."""
    slack = 3 / ACCURACY
    places = [min(max(f + d, 0.0), 1.0) for f in fractions.values() for d in (-slack, slack)]
    cuts = F.percentile_approx("_value", F.array(*[F.lit(p) for p in places]), ACCURACY)
    brackets = F.array(
        *[
            F.struct(F.get("_cuts", F.lit(2 * i)).alias("low"), F.get("_cuts", F.lit(2 * i + 1)).alias("high"))
            for i in range(len(fractions))
        ]
    )
    return rows.groupBy(*by).agg(F.count("_value").alias("_n"), cuts.alias("_cuts"), *also).withColumn("_brackets", brackets)


def _picked(rows: DataFrame, summaries: DataFrame, fractions: dict[str, float], by: list[str]) -> DataFrame:
    """Interpolated quantiles of each group, one output column per named fraction.

    Without ``by`` there is one summary, which every task gets as a scalar: a join would meet in one.
    """
    value = F.col("_value")
    known = rows.where(value.isNotNull())
    if by:
        narrow = summaries.select(*[F.col(c).alias(f"_by_{c}") for c in by], "_n", "_brackets")
        joined = known.join(narrow, [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by])
    else:
        told = summaries.select(F.struct("_n", "_brackets").alias("_told")).scalar()
        joined = known.withColumn("_told", told).select("_value", "_told._n", "_told._brackets")
    inside = F.exists("_brackets", lambda b: (b["low"] <= value) & (value <= b["high"]))
    gap = F.size(F.filter("_brackets", lambda b: b["high"] < value))
    merged = joined.groupBy(*by, "_n", gap.alias("_gap"), F.when(inside, value).alias("_kept")).agg(
        F.count(F.lit(1)).alias("_count"), F.min("_value").alias("_least"), F.max("_value").alias("_most")
    )
    running = F.sum("_count").over(Window.partitionBy(*by).orderBy("_least"))
    ranked = merged.withColumn("_start", running - F.col("_count"))

    def lower(fraction: float) -> Column:
        return F.floor((F.col("_n") - 1) * F.lit(fraction))

    def upper(fraction: float) -> Column:
        return F.least(lower(fraction) + 1, F.col("_n") - 1)

    def at(rank: Column) -> Column:
        """The value of a rank: known where the row is one value, or at either end of what was folded."""
        place = rank - F.col("_start")
        held = (place >= 0) & (place < F.col("_count"))
        missed = F.raise_error(F.lit("a rank lies outside its bracket")).cast("double")
        known = (
            F.when(place == 0, F.col("_least"))
            .when((place == F.col("_count") - 1) | (F.col("_least") == F.col("_most")), F.col("_most"))
            .otherwise(missed)
        )
        return F.max(F.when(held, known))

    picked = ranked.groupBy(*by).agg(
        F.max("_n").alias("_n"),
        *[at(lower(f)).alias(f"_low_{name}") for name, f in fractions.items()],
        *[at(upper(f)).alias(f"_high_{name}") for name, f in fractions.items()],
    )

    def interpolated(name: str, fraction: float) -> Column:
        weight = (F.col("_n") - 1) * F.lit(fraction) - lower(fraction)
        return F.col(f"_low_{name}") * (1 - weight) + F.col(f"_high_{name}") * weight

    return picked.select(*by, *[interpolated(name, f).alias(name) for name, f in fractions.items()])


def exact_quantiles(df: DataFrame, column: str, fractions: dict[str, float], by: list[str]) -> DataFrame:
    """Interpolated quantiles of a column per group with a value, one output column per named fraction."""
    rows = df.where(F.col(column).isNotNull()).select(*by, F.col(column).cast("double").alias("_value"))
    return _picked(rows, _summaries(rows, fractions, by, []), fractions, by)


def describe(df: DataFrame, column: str, by: str | None = None) -> DataFrame:
    """Count, mean, standard deviation, extremes and quartiles of a column, overall or per group."""
    groups = [by] if by else []
    rows = df.select(*groups, F.col(column).cast("double").alias("_value"))
    quartiles = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    measures = [
        F.avg("_value").alias("mean"),
        F.stddev_samp("_value").alias("std"),
        F.min("_value").alias("min"),
        F.max("_value").alias("max"),
        F.count(F.lit(1)).alias("_rows"),
    ]
    summaries = _summaries(rows, quartiles, groups, measures)
    picked = _picked(rows, summaries, quartiles, groups)
    names = [F.col("_n").alias("count"), "mean", "std", "min", "max"]
    if by:
        picked = picked.withColumnRenamed(by, "_label")
        return summaries.join(picked, F.col(by).eqNullSafe(F.col("_label")), "left").select(by, *names, *quartiles)
    # A table without rows is described by none.
    found = summaries.where("_rows > 0").withColumn("_picked", picked.select(F.struct(*quartiles).alias("_picked")).scalar())
    return found.select(F.lit("all").alias("scope"), *names, *[f"_picked.{q}" for q in quartiles])


def exact_median(df: DataFrame, column: str) -> Column:
    """Median of a column as a scalar subquery."""
    return exact_quantiles(df, column, {"median": 0.5}, []).select("median").scalar()
