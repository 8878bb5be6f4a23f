"""Deterministic forecasts that stand in for fitted models, so that the ensemble operators
have results an independent engine can check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.functions.scalars import epoch_day
from tillcast.operators.split import HOLDOUT_WEEKS, time_split, trainable
from tillcast.session import by_store

MODELS = 60
ROW_STRIDE = 100_000
FAMILY_A = (0, 1, 2, 50, 51)
FAMILY_B = (3, 4, 5, 52, 53)


def _stand_in(model: int) -> Column:
    """Models 0..49: the last sale above zero at least 30 + 7 m days back; from 50 on: the
    sales exactly 28 + m days back.  0 where there is none.  The panel has a row per day, so days are rows."""
    by_day = Window.partitionBy("Store").orderBy("_day")
    value = F.lag("_last_sale", 30 + 7 * model) if model < 50 else F.lag("Sales", 28 + model)
    return F.coalesce(value.over(by_day), F.lit(0.0))


def with_stand_ins(panel: DataFrame, models: list[int], first_day: Column | None = None) -> DataFrame:
    """One array column ``preds`` with the forecasts of the given models.

    Rows long before ``first_day``, from which on forecasts are wanted, are dropped once their last sale is known.
    """
    running = Window.partitionBy("Store").orderBy("_day").rowsBetween(Window.unboundedPreceding, 0)
    last_sale = F.last(F.nullif("Sales", F.lit(0.0)), ignorenulls=True).over(running)
    placed = by_store(panel).withColumn("_day", epoch_day("Date")).withColumn("_last_sale", last_sale)
    if first_day is not None:
        reach = max((30 + 7 * m if m < 50 else 28 + m for m in models), default=0)
        placed = placed.where(F.col("Date") >= F.date_sub(first_day, reach))
    return placed.withColumn("preds", F.array(*[_stand_in(m) for m in models])).drop("_last_sale")


def holdout_predictions(panel: DataFrame, last_day: Column, models: list[int] | None = None) -> DataFrame:
    """Packed predictions ``(row_id, y, preds)`` over the trainable rows of the holdout."""
    models = list(range(MODELS)) if models is None else models
    first_day = F.date_sub(last_day, 7 * HOLDOUT_WEEKS)
    _, holdout = time_split(with_stand_ins(panel, models, first_day), last_day=last_day)
    row_id = F.col("Store") * ROW_STRIDE + F.col("_day")
    return trainable(holdout).select(row_id.alias("row_id"), F.col("Sales").alias("y"), "preds")
