import datetime as dt

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tillcast.functions.scalars import rmspe
from tillcast.operators import features
from tillcast.operators.forest import Forest, node_table, nodes_of, read_forest, scores
from tillcast.plans import jobs
from tillcast.plans import train as training


def test_best_round():
    assert training.best_round([3, 2, 1, 2, 3], 100) == 3
    assert training.best_round([3, 2, 4, 4, 1], 2) == 2  # stopped before the later minimum
    assert training.best_round([1.0], 1) == 1
    assert training.stops([3, 2, 4, 4], 2) and not training.stops([3, 2, 4], 2) and not training.stops([], 1)


@pytest.fixture(scope="module")
def tables(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(600):
        x = rng.normal(size=3)
        kind = "ab"[i % 2]
        sales = 0.0 if i % 10 == 0 else float(np.exp(6 + x[0] + 0.5 * (kind == "b")))
        rows.append((i, dt.date(2014, 1, 1) + dt.timedelta(days=i), sales, 1, kind, float(x[0]), float(x[1]), None if i % 7 == 0 else float(x[2])))
    df = spark.createDataFrame(
        rows, "Store long, Date date, Sales double, Open int, kind string, x0 double, x1 double, recent_q_x double"
    ).cache()
    train, holdout = df.where("Store < 480"), df.where("Store >= 480")
    test = holdout.withColumns({"Id": F.col("Store"), "Open": (F.col("Store") % 5 != 0).cast("int")}).drop("Sales")
    return {"train_featured": train, "holdout_featured": holdout, "test_featured": test}


OPTIONS = jobs.TrainOptions(
    n_models=3, min_features=2, max_features=4, top_models=3, top_pairs=2, probe_rounds=2, rounds=3, parallel=3
)


@pytest.fixture(scope="module")
def trained(spark, tables):
    return jobs.train_families(tables, ["depthwise", "leafwise"], OPTIONS)


def test_family_end_to_end(spark, tables, trained, tmp_path):
    runs, scores = trained
    assert {r.model for r in scores.collect()} == {"depthwise", "leafwise", "cross"}
    assert scores.agg(F.sum("recommended")).first()[0] == 1
    run = runs["depthwise"]
    assert [m.kind for m in run.members] == ["combined", "season", "month_ahead", "probe", "probe"]
    assert "recent_q_x" not in run.members[2].features
    assert run.pairs.count() == 3 and run.scores.count() == 3 and 0 < run.rmspe < 2
    forecast = {r.Id: r.Sales for r in training.forecast(run, tables["test_featured"]).collect()}
    assert len(forecast) == 120 and all((v == 0) == (i % 5 == 0) for i, v in forecast.items())

    training.save_family(run, str(tmp_path / "m"))
    loaded = training.load_family(spark, str(tmp_path / "m"))
    assert loaded.rmspe == run.rmspe and loaded.scores.count() == 3
    again = {r.Id: r.Sales for r in training.forecast(loaded, tables["test_featured"]).collect()}
    assert again == pytest.approx(forecast)

    for name in ("train", "holdout", "test"):
        tables[f"{name}_featured"].write.parquet(f"{tmp_path}/featured/{name}_featured")
    training.save_family(runs["leafwise"], f"{tmp_path}/n")
    score = jobs.cross_from_saved(
        spark, f"{tmp_path}/featured", f"{tmp_path}/m", f"{tmp_path}/n", f"{tmp_path}/out", "r"
    )
    assert score == pytest.approx(next(r.rmspe for r in scores.collect() if r.model == "cross"))
    assert spark.read.option("header", True).csv(f"{tmp_path}/out/submission_cross").count() == 120


def test_absent_features_count_as_missing(spark, tables):
    matrix = training.fit_matrix(tables["train_featured"], ["x0", "x1", "kind"])
    with pytest.warns(UserWarning, match="x1"):
        row = matrix.rows(tables["test_featured"].drop("x1"), "Id").first()
    assert row[training.VECTOR][1] == features.MISSING_NUMBER
    with pytest.warns(UserWarning, match="gone"):
        assert matrix.slicer(["x0", "gone"]).getIndices() == [0]


def matrix_rows(tables, names):
    matrix = training.fit_matrix(tables["train_featured"], names)
    return matrix, *(training.labelled(matrix, tables[f"{t}_featured"]) for t in ("train", "holdout"))


def alike(a, b):
    """The same trees up to the last digits: margins are added up in another order across blocks."""
    pairs = [(m, n) for s, t in zip(a.trees, b.trees, strict=True) for m, n in zip(s, t, strict=True)]
    return all(
        (m.feature, m.left, m.right) == (n.feature, n.left, n.right)
        and (m.cut, m.value) == pytest.approx((n.cut, n.value), rel=1e-6, abs=1e-9)
        for m, n in pairs
    )


# Steps this large overshoot, so the holdout error soon rises.
EAGER = training.TreeParams(rounds=24, step_size=1.5, patience=5, block=4, max_depth=3, feature_share=1.0)


def test_fitting_stops_on_the_holdout(spark, tables):
    matrix, train, holdout = matrix_rows(tables, ["x0", "x1", "kind"])
    stopped = training.fit_trees(matrix, train, holdout, ["x0", "x1", "kind"], EAGER)
    assert len(stopped.losses) < EAGER.rounds
    # All rounds fitted, in blocks of another size, then cut: the same prefix and the same score.
    whole = training.fit_trees(
        matrix, train, holdout, ["x0", "x1", "kind"], training.replace(EAGER, patience=100, block=24)
    )
    assert len(whole.losses) == EAGER.rounds
    assert whole.losses[: len(stopped.losses)] == pytest.approx(stopped.losses)
    rounds = training.best_round(list(whole.losses), EAGER.patience)
    assert alike(stopped.model, whole.model.first(rounds)) and len(stopped.model.trees) == rounds
    scored = holdout.withColumn(
        "pred", F.expm1(F.get(scores([stopped.model], matrix.candidates, vector_to_array(training.VECTOR)), F.lit(0)))
    )
    assert scored.agg(rmspe().alias("r")).first().r == pytest.approx(stopped.rmspe)


def test_forest_scores_as_its_trees_do(spark, tables):
    """The node table against MLlib's own predictions."""
    matrix, train, _ = matrix_rows(tables, ["x0", "x1", "kind"])
    names = matrix.candidates
    fitter = training.RandomForestRegressor(featuresCol=training.VECTOR, numTrees=3, maxDepth=4, seed=2)
    model = fitter.fit(train)
    forest = Forest([nodes_of(t.toDebugString, names) for t in model.trees], 0.0, 1 / 3)
    again = read_forest(node_table(spark, {"a": forest, "b": forest.first(1)}), "a", 0.0, 1 / 3)
    assert again == forest
    both = scores([forest, forest.first(1)], names, vector_to_array(training.VECTOR))
    rows = model.transform(train).withColumn("own", both).collect()
    assert [r.own[0] for r in rows] == pytest.approx([r.prediction for r in rows])
    one = [t.value for t in forest.trees[0] if t.feature is None]
    assert {round(r.own[1] * 3, 9) for r in rows} <= {round(v, 9) for v in one}


def test_a_killed_job_goes_on(spark, tables, tmp_path, monkeypatch):
    """Neither a recorded fit nor a recorded block is fitted again, and the scores are those of an unbroken job."""
    options = training.replace(OPTIONS, parallel=1, rounds=4, probe_rounds=4)
    monkeypatch.setitem(training.FAMILIES, "depthwise", training.TreeParams(block=2))
    unbroken, _ = jobs.train_families(tables, ["depthwise"], options)
    fit_block, fitted = training._fit_block, []

    def counted(train, holdout, forest, names, params, rounds):
        if len(fitted) == limit:
            raise RuntimeError("driver lost")
        fitted.append((tuple(names), len(forest.trees)))
        return fit_block(train, holdout, forest, names, params, rounds)

    monkeypatch.setattr(training, "_fit_block", counted)
    folder = f"{tmp_path}/progress"
    # Three probes and three specialists of two blocks each: lost inside a probe, then inside a specialist.
    for limit in (3, 9):
        with pytest.raises(RuntimeError, match="driver lost"):
            jobs.train_families(tables, ["depthwise"], options, folder)
    limit = 100
    runs, _ = jobs.train_families(tables, ["depthwise"], options, folder)
    assert len(fitted) == 6 * 2
    for got, want in zip(runs["depthwise"].members, unbroken["depthwise"].members):
        assert (got.kind, got.features, got.losses) == (want.kind, want.features, pytest.approx(want.losses))
        assert alike(got.model, want.model)
    assert runs["depthwise"].rmspe == pytest.approx(unbroken["depthwise"].rmspe)
    done = len(fitted)
    jobs.train_families(tables, ["depthwise"], options, folder)
    assert len(fitted) == done


def test_a_crash_while_saving_leaves_the_old_family(spark, trained, tmp_path, monkeypatch):
    run, folder = trained[0]["depthwise"], f"{tmp_path}/family"
    with pytest.raises(FileNotFoundError):
        training.load_family(spark, folder)
    training.save_family(run, folder)
    monkeypatch.setattr(training, "switch", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        training.save_family(training.replace(run, rmspe=9.0), folder)
    assert training.load_family(spark, folder).rmspe == run.rmspe
    monkeypatch.undo()
    training.save_family(training.replace(run, rmspe=9.0), folder)
    assert training.load_family(spark, folder).rmspe == 9.0
