"""Time splits, history context and row filters."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOLDOUT_WEEKS = 6
HISTORY_DAYS = 500
SEASON_MONTHS = (5, 6, 7, 8, 9)


def last_date(df: DataFrame) -> Column:
    return df.agg(F.max("Date")).scalar()


def time_split(
    df: DataFrame, weeks: int = HOLDOUT_WEEKS, last_day: Column | None = None, boundary: str = "holdout"
) -> tuple[DataFrame, DataFrame]:
    """(train, holdout) at ``last day - weeks``.

    The boundary day itself goes to ``"holdout"`` (the job: 43 days) or to ``"train"``
    (the exploration: 42 days).
    """
    edge = F.date_sub(last_date(df) if last_day is None else last_day, 7 * weeks)
    if boundary == "holdout":
        return df.where(F.col("Date") < edge), df.where(F.col("Date") >= edge)
    if boundary == "train":
        return df.where(F.col("Date") <= edge), df.where(F.col("Date") > edge)
    raise ValueError(f"boundary must be 'holdout' or 'train', not {boundary!r}")


def recent_history(df: DataFrame, last_day: Column | None = None, days: int = HISTORY_DAYS) -> DataFrame:
    """The rows of the last ``days`` days up to ``last_day``."""
    end = last_date(df) if last_day is None else last_day
    return df.where(F.col("Date") >= F.date_sub(end, days))


def with_context(
    context: DataFrame,
    target: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    first_day: Column | None = None,
) -> DataFrame:
    """Apply ``transform`` to context and target together and keep the target period.

    Columns are matched by name; those absent on one side are null there.
    """
    start = target.agg(F.min("Date")).scalar() if first_day is None else first_day
    union = context.unionByName(target, allowMissingColumns=True)
    return transform(union).where(F.col("Date") >= start)


def scoring_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col("Id").isNotNull())


def open_by_default(df: DataFrame) -> DataFrame:
    """An absent ``Open`` counts as open."""
    return df.withColumn("Open", F.coalesce(F.col("Open"), F.lit(1)).cast("int"))


def is_trainable(df: DataFrame) -> Column:
    """Whether a model is fitted or scored on a row; a missing column imposes no condition."""
    rules = [rule for name, rule in (("Open", F.col("Open") == 1), ("Sales", F.col("Sales") > 0)) if name in df.columns]
    return reduce(Column.__and__, rules, F.lit(True))


def trainable(df: DataFrame) -> DataFrame:
    """Rows a model is fitted or scored on."""
    return df.where(is_trainable(df))


def explored(df: DataFrame) -> DataFrame:
    """Rows kept for exploration: neither closed nor without sales."""
    return df.where("Open != 0 and Sales != 0")


def season(df: DataFrame) -> DataFrame:
    return df.where(F.month("Date").isin(*SEASON_MONTHS))
