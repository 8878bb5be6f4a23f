"""Data profile: missing values, group statistics, correlations (the tables behind the plots)."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.functions.scalars import months_between_opening, promo_age
from tillcast.operators.bootstrap import mean_intervals
from tillcast.operators.ranks import exact_median
from tillcast.session import stored

UNKNOWN = "Unknown"
#: Deviations below this share of a column's squares are rounding.
NO_SPREAD = 1e-12


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def date_parts(df: DataFrame) -> DataFrame:
    """Year, month, day and ISO week plus sales per customer (null without customers)."""
    return df.withColumns(
        {
            "Year": F.year("Date"),
            "Month": F.month("Date"),
            "Day": F.dayofmonth("Date"),
            "WeekOfYear": F.weekofyear("Date"),
            "SalePerCustomer": F.try_divide(F.col("Sales"), F.col("Customers")),
        }
    )


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``(column_name, nulls)`` from one pass over the table."""
    columns = columns or df.columns
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], columns, "column_name", "nulls")


def fill_typed(df: DataFrame) -> DataFrame:
    """Absent numbers become 0, absent texts 'Unknown'."""
    return df.fillna(0, numeric_columns(df)).fillna(UNKNOWN, string_columns(df))


def impute_median(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.coalesce(F.col(column), exact_median(df, column)))


def implication_breaks(df: DataFrame) -> DataFrame:
    """Rows whose Promo2 start is absent although the store takes part, per start column."""
    columns = ["Promo2SinceWeek", "Promo2SinceYear"]
    broken = df.agg(*[F.count_if(F.col(c).isNull() & (F.col("Promo2") != 0)).alias(c) for c in columns])
    return broken.unpivot([], columns, "column_name", "breaks")


def closed_and_zero_sales(df: DataFrame) -> DataFrame:
    zero = F.col("Sales") == 0
    return df.agg(
        F.count_if((F.col("Open") == 0) & zero).alias("closed_zero_sales"),
        F.count_if((F.col("Open") != 0) & zero).alias("open_zero_sales"),
        F.count(F.lit(1)).alias("total_rows"),
    )


def sunday_stores(df: DataFrame) -> DataFrame:
    return df.where("Open = 1 and DayOfWeek = 7").select("Store").distinct()


def table_summary(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct("Store").alias("stores"),
        F.min("Date").alias("first_date"),
        F.max("Date").alias("last_date"),
    )


def mean_by(
    df: DataFrame, value: str, keys: list[str], error: bool = True, identity: tuple[str, ...] = ("Store", "Date")
) -> DataFrame:
    """Mean of a value per key combination; ``error`` adds the analytic standard error and a bootstrap interval.

    ``identity`` names the columns that tell rows apart.
    """
    aggregates = [F.avg(value).alias(f"mean_{value}"), F.count(value).alias("n")]
    if not error:
        return df.groupBy(*keys).agg(*aggregates)
    aggregates.append((F.stddev_samp(value) / F.sqrt(F.count(value))).alias(f"se_{value}"))
    # Read once for the means and once for the replicates.
    rows = stored(df.select(*keys, *[c for c in identity if c not in keys], value), "means")
    means = rows.groupBy(*keys).agg(*aggregates)
    intervals = mean_intervals(rows, value, keys, list(identity))
    same = [means[k].eqNullSafe(intervals[k]) for k in keys]
    return means.join(intervals, same, "left").select(
        *[means[c] for c in means.columns], intervals.ci_low, intervals.ci_high
    )


def zero_filled(df: DataFrame) -> DataFrame:
    """Every absent value of the table as 0, in texts as '0'."""
    return df.fillna(0, subset=numeric_columns(df)).fillna("0", subset=string_columns(df))


def opening_times(df: DataFrame) -> DataFrame:
    """Months since the competitor opened and since the long promotion began.

    ``CompetitionOpen`` follows the filled table, where an unknown year is 0 and the result
    is some 24,000 months; ``CompetitionOpenKnown`` is null there instead.
    """
    since_year, since_month = F.col("CompetitionOpenSinceYear"), F.col("CompetitionOpenSinceMonth")
    months = months_between_opening(F.col("Year"), F.col("Month"), since_year, since_month)
    promo = promo_age(F.col("Year"), F.col("WeekOfYear"), F.col("Promo2SinceYear"), F.col("Promo2SinceWeek"))
    return df.withColumns(
        {
            "CompetitionOpen": months,
            "CompetitionOpenKnown": F.when((since_year != 0) & (since_month != 0), months),
            "PromoOpen": promo,
        }
    )


def _moment_tiles(df: DataFrame, n_columns: int) -> DataFrame:
    """``(first, second, n, x, y, xx, yy, xy)``: sums over the rows that have both columns, one tile of pairs per task, added up."""
    names = ["n", "x", "y", "xx", "yy", "xy"]

    def tiles(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(names), n_columns, n_columns))
        for batch in batches:
            raw = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns])
            known = ~np.isnan(raw)
            value, there = np.where(known, raw, 0.0), known.astype(float)
            square = value * value
            total += np.stack(
                [there.T @ there, value.T @ there, there.T @ value, square.T @ there, there.T @ square, value.T @ value]
            )
        first, second = np.tril_indices(n_columns, -1)
        columns = [pa.array(first, pa.int32()), pa.array(second, pa.int32())]
        yield pa.RecordBatch.from_arrays(columns + [pa.array(t[first, second]) for t in total], ["first", "second", *names])

    sums = df.mapInArrow(tiles, "first int, second int, " + ", ".join(f"{name} double" for name in names))
    return sums.groupBy("first", "second").agg(*[F.sum(name).alias(name) for name in names])


def correlations(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Strict lower triangle of the Pearson matrix, ``(column_1, column_2, r)``.

    Values are taken less their column's mean, so that sums of products lose nothing far from zero;
    each task adds up the moments of all pairs of columns, over the rows that have both values.  A pair
    with a column that doesn't vary gives null.
    """
    columns = columns or [c for c in numeric_columns(df) if c != "Open"]
    # Read for the means and for the moments.
    doubles = stored(df.select(*[F.col(c).cast("double").alias(c) for c in columns]), "correlations")
    means = doubles.agg(F.struct(*[F.avg(c).alias(c) for c in columns])).scalar()
    centred = doubles.select(*[(F.col(c) - means.getField(c)).alias(c) for c in columns])
    names = F.array(*[F.lit(c) for c in columns])

    def spread(square: str, total: str) -> Column:
        """n times the sum of squared deviations; null where nothing but rounding is left."""
        rest = F.col("n") * F.col(square) - F.col(total) * F.col(total)
        return F.when(rest > NO_SPREAD * F.col("n") * F.col(square), rest)

    r = (F.col("n") * F.col("xy") - F.col("x") * F.col("y")) / F.sqrt(spread("xx", "x") * spread("yy", "y"))
    return _moment_tiles(centred, len(columns)).select(
        F.element_at(names, F.col("first") + 1).alias("column_1"),
        F.element_at(names, F.col("second") + 1).alias("column_2"),
        r.alias("r"),
    )
