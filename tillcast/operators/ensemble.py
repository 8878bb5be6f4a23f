"""Scores and ensembles over packed predictions ``(row_id, y, preds)``.

``preds`` holds the forecasts of all models of a row in one array, in the order of a list of model ids
that goes with the table.  No operator here spreads a row over models or pairs: errors are added up in
the task that reads the rows, and only the sums are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.functions.scalars import (
    CORRECTION,
    floored,
    rmspe,
    weighted_harmonic,
)

TOP_MODELS = 50
TOP_PAIRS = 10

# Rows of a tile's inner step: a few hundred kilobytes per model.
_STEP = 2048
_SUMS = "first int, second int, error double, n long"


def _matrix(preds: pa.Array, n_models: int) -> np.ndarray:
    """Predictions as rows by models; absent ones are NaN."""
    return preds.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False).reshape(-1, n_models)


def _squares(y: np.ndarray, preds: np.ndarray) -> np.ndarray:
    return ((y[:, None] - preds) / y[:, None]) ** 2


def _tile(y: np.ndarray, preds: np.ndarray, error: np.ndarray, n: np.ndarray) -> None:
    """Add the squared errors of all pairs of models, and of each model alone, to a square of sums.

    An error that isn't a number (an absent prediction, two that cancel) counts nowhere.
    """
    with np.errstate(divide="ignore", invalid="ignore"):
        inverse = np.where(preds == 0, np.inf, 1 / preds)
        for i in range(preds.shape[1]):
            both = 2 / (inverse[:, i : i + 1] + inverse[:, i + 1 :])
            square = _squares(y, np.concatenate([preds[:, i : i + 1], both], axis=1))
            known = np.isfinite(square)
            error[i, i:] += np.where(known, square, 0).sum(axis=0)
            n[i, i:] += known.sum(axis=0)


def _error_sums(packed: DataFrame, preds: Column, n_models: int) -> DataFrame:
    """``(first, second, error, n)`` of each pair of places, equal ones for a model alone: one tile per task, added up."""

    def tiles(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        error, n = np.zeros((n_models, n_models)), np.zeros((n_models, n_models), np.int64)
        for batch in batches:
            y = batch.column(0).to_numpy(zero_copy_only=False)
            rows = _matrix(batch.column(1), n_models)
            for i in range(0, len(y), _STEP):
                _tile(y[i : i + _STEP], rows[i : i + _STEP], error, n)
        first, second = np.triu_indices(n_models)
        yield pa.RecordBatch.from_arrays(
            [pa.array(first, pa.int32()), pa.array(second, pa.int32()), pa.array(error[first, second]), pa.array(n[first, second])],
            ["first", "second", "error", "n"],
        )

    rows = packed.where("y > 0").select(F.col("y").cast("double"), preds.cast("array<double>"))
    sums = rows.mapInArrow(tiles, _SUMS).groupBy("first", "second")
    return sums.agg(F.sum("error").alias("error"), F.sum("n").alias("n"))


def model_scores(packed: DataFrame, models: list[int]) -> DataFrame:
    """``(model_id, rmspe)`` of each model."""
    pred = F.posexplode("preds").alias("_at", "pred")
    ids = F.array(*[F.lit(m) for m in models])
    scored = packed.select("y", pred).groupBy("_at").agg(rmspe().alias("rmspe"))
    return scored.select(F.element_at(ids, F.col("_at") + 1).alias("model_id"), "rmspe")


def top_models(scores: DataFrame, n: int = TOP_MODELS) -> DataFrame:
    """The best models; equal scores are ordered by model id."""
    return scores.orderBy("rmspe", "model_id").limit(n)


def best_pairs(packed: DataFrame, models: list[int], scores: DataFrame, top_n: int = TOP_MODELS) -> DataFrame:
    """Score of the harmonic mean of every pair among the ``top_n`` models.

    Each row's predictions are put in the order of the ranking by one small array, and a task adds all
    pairs' errors of its rows to one square of running sums.
    """
    top_n = min(top_n, len(models))
    ids = F.array(*[F.lit(m) for m in models])
    best = top_models(scores, top_n).withColumn(
        "rank", F.row_number().over(Window.orderBy("rmspe", "model_id")) - 1  # top_n rows
    )
    place = (F.array_position(ids, F.col("model_id")) - 1).cast("int")
    order = best.agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", place.alias("place")))), lambda s: s["place"]))
    ordered = packed.withColumn("_order", order.scalar())
    ranked = F.transform("_order", lambda i: F.get("preds", i))
    sums = _error_sums(ordered, ranked, top_n).where("first < second and n > 0")
    single = best.select("rank", "model_id", "rmspe")
    return (
        sums.join(F.broadcast(single.toDF("first", "model_1", "rmspe_single1")), "first")
        .join(F.broadcast(single.toDF("second", "model_2", "rmspe_single2")), "second")
        .select(
            "model_1", "model_2", "rmspe_single1", "rmspe_single2",
            F.sqrt(F.col("error") / F.col("n")).alias("rmspe_ensemble"),
        )
        .orderBy("rmspe_ensemble", "model_1", "model_2")
    )


def models_of_pairs(pairs: DataFrame, top_pairs: int = TOP_PAIRS) -> DataFrame:
    """Distinct ``model_id`` of the best pairs."""
    chosen = pairs.orderBy("rmspe_ensemble", "model_1", "model_2").limit(top_pairs)
    return chosen.select(F.explode(F.array("model_1", "model_2")).alias("model_id")).distinct()


def harmonic(models: list[int], members: Iterable[int]) -> Column:
    """Floored harmonic mean of the known predictions of some models of a row."""
    preds = [F.get("preds", F.lit(models.index(m))) for m in members]
    inverse = sum((F.coalesce(1 / floored(p), F.lit(0.0)) for p in preds), F.lit(0.0))
    known = sum((F.when(p.isNotNull(), 1.0).otherwise(0.0) for p in preds), F.lit(0.0))
    return F.try_divide(known, inverse)


def final_ensemble(
    packed: DataFrame, models: list[int], members: Iterable[int] | None = None, correction: float = CORRECTION
) -> DataFrame:
    """``(row_id, y, pred)``: the members' harmonic mean, times the correction; all models by default."""
    pred = harmonic(models, models if members is None else members) * correction
    return packed.select("row_id", "y", pred.alias("pred"))


def cross_ensemble(
    packed: DataFrame,
    models: list[int],
    family_a: Iterable[int],
    family_b: Iterable[int],
    weight_a: float = 0.5,
    correction: float = CORRECTION,
) -> DataFrame:
    """Weighted harmonic mean of two families' ensembles, then the correction."""
    pred = weighted_harmonic(harmonic(models, family_a), harmonic(models, family_b), weight_a) * correction
    return packed.select("row_id", "y", pred.alias("pred"))


def total_scores(packed: DataFrame, preds: dict[str, Column]) -> DataFrame:
    """``(model, rmspe)`` of several forecasts of a row, in one pass."""
    scores = packed.agg(*[rmspe("y", pred).alias(name) for name, pred in preds.items()])
    return scores.unpivot([], list(preds), "model", "rmspe")


def recommend(scores: DataFrame, preference: list[str]) -> DataFrame:
    """Mark the best score; equal scores go to the earlier name in ``preference``."""
    order = F.array_position(F.array(*[F.lit(p) for p in preference]), F.col("model"))
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("rmspe"), order))  # a few rows
    return scores.withColumn("recommended", (place == 1).cast("int"))


def close_stores(scored: DataFrame) -> DataFrame:
    """Forecast 0 wherever the store is closed."""
    return scored.withColumn("Sales", F.when(F.col("Open") == 0, 0.0).otherwise(F.col("Sales")))


def forecast_summary(submission: DataFrame) -> DataFrame:
    """What a submission looks like: rows, closed rows, and the range of its forecasts."""
    return submission.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("Sales") == 0).alias("zero_rows"),
        F.min("Sales").alias("least"),
        F.max("Sales").alias("most"),
    )
