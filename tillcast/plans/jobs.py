"""End-to-end jobs over the featured tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.functions.scalars import rmspe
from tillcast.operators import features
from tillcast.operators.ensemble import recommend
from tillcast.plans import train as training
from tillcast.session import scratch
from tillcast.sources.schema import read_featured, require_columns
from tillcast.sources.sinks import append_score, write_submission

NEEDED = ["Store", "Date", "Sales", "Open"]


@dataclass(frozen=True)
class TrainOptions:
    """Sizes of a training run; the defaults are the full job."""

    n_models: int = 500
    min_features: int = 20
    max_features: int = 60
    top_models: int = 50
    top_pairs: int = 10
    probe_rounds: int = 100
    rounds: int = 1000
    seed: int = 42
    parallel: int = 4
    weight_first: float = 0.5


def train_families(
    tables: dict[str, DataFrame], names: list[str], options: TrainOptions = TrainOptions(), progress: str | None = None
) -> tuple[dict[str, training.FamilyRun], DataFrame]:
    """Fit the named families on the featured tables; returns the runs and the score table.

    With a folder for ``progress``, a job that is started again with the same tables and options fits
    only what it hadn't fitted before.
    """
    train = require_columns(tables["train_featured"], NEEDED, "train_featured")
    holdout = require_columns(tables["holdout_featured"], NEEDED, "holdout_featured")
    spark = train.sparkSession
    listed = features.feature_candidates(train)
    candidates = [r.feature for r in listed.orderBy("position").collect()]
    matrix = training.fit_matrix(train, candidates)
    keyed = [df.withColumn("row_id", F.struct("Store", "Date")) for df in (train, holdout)]
    fit_rows, check_rows = [
        training.labelled(matrix, df, "row_id", "Date").persist(StorageLevel.MEMORY_AND_DISK) for df in keyed
    ]
    subsets = features.random_subsets(
        listed, options.n_models, options.min_features, min(options.max_features, len(candidates)), options.seed
    )
    records = training.Progress(spark, progress) if progress else None
    runs = {}
    try:
        for name in names:
            base = training.FAMILIES[name]
            runs[name] = training.run_family(
                name,
                matrix,
                fit_rows,
                check_rows,
                subsets,
                training.replace(base, rounds=options.rounds),
                options.probe_rounds,
                options.top_models,
                options.top_pairs,
                options.parallel,
                records,
            )
        scores = [(name, float(run.rmspe)) for name, run in runs.items()]
        if len(runs) == 2:
            scores.append(("cross", cross_score(check_rows, *runs.values(), options.weight_first)))
    finally:
        fit_rows.unpersist()
        check_rows.unpersist()
    table = spark.createDataFrame(scores, "model string, rmspe double")
    preference = ["cross", *reversed(list(runs))]
    return runs, recommend(table, preference)


def cross_score(
    rows: DataFrame, first: training.FamilyRun, second: training.FamilyRun, weight_first: float = 0.5
) -> float:
    crossed = training.cross_predictions(rows, first, second, weight_first)
    return float(crossed.agg(rmspe().alias("r")).first().r)


def cross_from_saved(
    spark: SparkSession, featured: str, first: str, second: str, out: str, run_id: str, weight_first: float = 0.5
) -> float:
    """Second step on its own: score and submission of two saved families, from their folders alone."""
    tables = read_featured(spark, featured)
    a, b = training.load_family(spark, first), training.load_family(spark, second)
    holdout = training.labelled(a.matrix, tables["holdout_featured"])
    score = cross_score(holdout, a, b, weight_first)
    write_submission(training.cross_forecast(a, b, tables["test_featured"], weight_first), f"{out}/submission_cross")
    append_score(spark, f"{out}/scores", run_id, "cross", score)
    return score


def train_and_submit(
    spark: SparkSession, featured: str, out: str, run_id: str, options: TrainOptions = TrainOptions()
) -> DataFrame:
    """Both families, their submissions and the weighted one, models, scores; returns the comparison."""
    with scratch(spark):
        return _train_and_submit(spark, featured, out, run_id, options)


def _train_and_submit(spark: SparkSession, featured: str, out: str, run_id: str, options: TrainOptions) -> DataFrame:
    tables = read_featured(spark, featured)
    test = tables["test_featured"]
    runs, scores = train_families(tables, list(training.FAMILIES), options, f"{out}/progress/{run_id}")
    for name, run in runs.items():
        write_submission(training.forecast(run, test), f"{out}/submission_{name}")
        training.save_family(run, f"{out}/models/{name}")
    first, second = runs.values()
    write_submission(
        training.cross_forecast(first, second, test, options.weight_first), f"{out}/submission_cross"
    )
    for row in scores.collect():  # three rows
        append_score(spark, f"{out}/scores", run_id, row.model, row.rmspe)
    for name, run in runs.items():
        for member in run.members:
            append_score(spark, f"{out}/scores", run_id, f"{name}/{member.kind}", member.rmspe)
    return scores
