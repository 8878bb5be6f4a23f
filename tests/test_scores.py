import numpy as np
import pytest
from pyspark.sql import functions as F

from tillcast.functions import scalars
from tillcast.operators import bootstrap, ensemble, exploration, features, ranks

PACKED = "row_id long, y double, preds array<double>"


def test_harmonic_pairs_and_ties(spark):
    packed = spark.createDataFrame([(1, 100.0, [50.0, 100.0, 0.0, 50.0]), (2, 0.0, [9.0, None, None, None])], PACKED)
    models = [0, 1, 2, 3]
    scores = ensemble.model_scores(packed, models)
    assert [r.model_id for r in ensemble.top_models(scores, 4).collect()] == [1, 0, 3, 2]
    pairs = {(r.model_1, r.model_2): r for r in ensemble.best_pairs(packed, models, scores, 4).collect()}
    assert len(pairs) == 6
    assert pairs[1, 0].rmspe_ensemble == pytest.approx(1 - 0.6666666667)
    assert pairs[0, 2].rmspe_ensemble == 1.0 and pairs[0, 2].rmspe_single2 == 1.0
    best = ensemble.best_pairs(packed, models, scores, 4)
    assert {r.model_id for r in ensemble.models_of_pairs(best, 1).collect()} == {0, 1}


def test_pairs_against_each_row(spark):
    """Top models only, ids that aren't places, several tasks, absent predictions."""
    rng = np.random.default_rng(8)
    y, preds = rng.uniform(50, 150, 700), rng.uniform(0, 200, (700, 6))
    preds[::50, 2] = np.nan
    rows = [(i, float(y[i]), [None if np.isnan(p) else float(p) for p in preds[i]]) for i in range(700)]
    models = [40, 10, 30, 20, 60, 50]
    packed = spark.createDataFrame(rows, PACKED).repartition(3)
    scores = ensemble.model_scores(packed, models)
    single = {m: np.sqrt(np.nanmean(((y - preds[:, i]) / y) ** 2)) for i, m in enumerate(models)}
    assert {r.model_id: pytest.approx(r.rmspe) for r in scores.collect()} == single
    top = sorted(single, key=single.get)[:4]
    got = ensemble.best_pairs(packed, models, scores, 4).collect()
    assert [(r.model_1, r.model_2) for r in sorted(got, key=lambda r: (top.index(r.model_1), top.index(r.model_2)))] == [
        (a, b) for i, a in enumerate(top) for b in top[i + 1 :]
    ]
    for r in got:
        a, b = preds[:, models.index(r.model_1)], preds[:, models.index(r.model_2)]
        assert r.rmspe_ensemble == pytest.approx(np.sqrt(np.nanmean(((y - 2 / (1 / a + 1 / b)) / y) ** 2)))
        assert (r.rmspe_single1, r.rmspe_single2) == pytest.approx((single[r.model_1], single[r.model_2]))
    assert [r.rmspe_ensemble for r in got] == sorted(r.rmspe_ensemble for r in got)


def test_zero_targets_are_ignored(spark):
    packed = spark.createDataFrame([(1, 0.0, [5.0]), (2, 10.0, [5.0])], PACKED)
    assert ensemble.model_scores(packed, [0]).first().rmspe == 0.5


def test_final_and_cross(spark):
    a = spark.createDataFrame([(1, 10.0, [0.0, 100.0]), (2, 10.0, [50.0, None]), (3, 1.0, [None, None])], PACKED)
    got = {r.row_id: r.pred for r in ensemble.final_ensemble(a, [7, 8]).collect()}
    assert got[1] == pytest.approx(0.985 * 2 / (1e6 + 0.01)) and got[2] == pytest.approx(49.25) and got[3] is None
    both = spark.createDataFrame([(1, 1.0, [50.0, 9.0, 100.0])], PACKED)
    assert ensemble.cross_ensemble(both, [0, 1, 2], [0], [2]).first().pred == pytest.approx(0.985 * 200 / 3)
    totals = ensemble.total_scores(both, {"a": F.lit(2.0), "b": F.lit(1.5)})
    assert {r.model: r.rmspe for r in totals.collect()} == {"a": 1.0, "b": 0.5}


def test_forecast_summary(spark):
    rows = spark.createDataFrame([(1, 0.0), (2, 5.0), (3, 2.0)], "Id int, Sales double")
    assert tuple(ensemble.forecast_summary(rows).first()) == (3, 1, 0.0, 5.0)


def test_recommendation_and_closed(spark):
    scores = spark.createDataFrame([("a", 0.2), ("b", 0.1), ("cross", 0.1)], "model string, rmspe double")
    best = ensemble.recommend(scores, ["cross", "b", "a"]).where("recommended = 1").collect()
    assert [r.model for r in best] == ["cross"]
    rows = spark.createDataFrame([(1, 0, 5.0), (2, 1, 5.0), (3, None, 5.0)], "Id int, Open int, Sales double")
    assert [r.Sales for r in ensemble.close_stores(rows).orderBy("Id").collect()] == [0.0, 5.0, 5.0]


@pytest.mark.parametrize("share", [0.0, 0.6])
def test_quantiles_and_ecdf(spark, share):
    """Also with one value filling most rows."""
    rng = np.random.default_rng(1)
    x = np.where(rng.random(5000) < share, 0.0, rng.normal(10, 50, 5000).round(2))
    group = rng.integers(0, 3, 5000)
    df = spark.createDataFrame([(int(g), float(v)) for g, v in zip(group, x)] + [(0, None)], "g int, v double")
    got = {r.g: r for r in ranks.exact_quantiles(df, "v", {"a": 0.1, "m": 0.5, "z": 0.97}, ["g"]).collect()}
    for g in range(3):
        want = np.quantile(x[group == g], [0.1, 0.5, 0.97])
        assert [got[g].a, got[g].m, got[g].z] == pytest.approx(list(want))
    steps = ranks.ecdf(df, "v").orderBy("x").collect()
    values, counts = np.unique(x, return_counts=True)
    assert [r.x for r in steps] == list(values)
    assert [r.y for r in steps] == pytest.approx(list(np.cumsum(counts) / len(x)))


def test_describe_of_one_group(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (None,)], "v double")
    row = ranks.describe(df, "v").first()
    assert (row["count"], row.p25, row.p50, row.p75, row.max) == (3, 1.5, 2.0, 3.0, 4.0)


def test_correlations(spark):
    rows = [(1.0, 2.0, 1.0, 5.0), (2.0, 1.0, 1.0, None), (3.0, 5.0, 1.0, 1.0), (4.0, 4.0, 1.0, 2.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    got = {(r.column_1, r.column_2): r.r for r in exploration.correlations(df).collect()}
    assert len(got) == 6
    assert got["b", "a"] == pytest.approx(np.corrcoef([1, 2, 3, 4], [2, 1, 5, 4])[0, 1])
    assert got["d", "a"] == pytest.approx(np.corrcoef([1, 3, 4], [5, 1, 2])[0, 1])
    assert got["c", "a"] is None and got["d", "c"] is None


def test_correlations_far_from_zero(spark):
    """A large offset, an outlier and a column that is constant where the other is known."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=400)
    y = 1e9 + x + rng.normal(size=400)
    y[0] = 1e9 + 1000
    z = [0.1 if i % 2 else None for i in range(400)]
    rows = [(float(a), float(b), c, float(a) if c is None else None) for a, b, c in zip(x, y, z)]
    df = spark.createDataFrame(rows, "x double, y double, z double, w double").repartition(5)
    got = {(r.column_1, r.column_2): r.r for r in exploration.correlations(df).collect()}
    assert got["y", "x"] == pytest.approx(np.corrcoef(x, y)[0, 1], rel=1e-7)
    assert got["w", "x"] == pytest.approx(1) and got["z", "x"] is None and got["z", "y"] is None and got["w", "z"] is None


def test_bootstrap_intervals(spark):
    """Weights are Poisson, replicates agree with plain weighted means, intervals with the spread of the mean."""
    rng = np.random.default_rng(6)
    drawn = bootstrap.weights(rng.integers(0, bootstrap.PRIME, 3000), 200)
    assert drawn.mean() == pytest.approx(1, abs=0.01) and drawn.var() == pytest.approx(1, abs=0.02)
    assert abs(np.corrcoef(drawn[:, 3], drawn[:, 4])[0, 1]) < 0.08
    values = rng.normal(20, 4, 900)
    rows = [(i, "b" if i % 3 else None, None if i == 7 else float(v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i long, k string, v double").repartition(3)
    means = bootstrap.replicate_means(df, "v", ["k"], ["i"], 40).collect()
    assert len(means) == 80
    hashes = df.select("i", bootstrap.row_hash("i").alias("h")).collect()
    weight = {r.i: bootstrap.weights(np.array([r.h]), 40)[0].tolist() for r in hashes}
    for r in means:
        own = [(weight[i][r.replicate], v) for i, k, v in rows if k == r.k and v is not None]
        assert r.mean == pytest.approx(sum(w * v for w, v in own) / sum(w for w, _ in own))
    for r in bootstrap.mean_intervals(df, "v", ["k"], ["i"]).collect():
        own = [v for _, k, v in rows if k == r.k and v is not None]
        error = np.std(own, ddof=1) / np.sqrt(len(own))
        assert (r.ci_low, r.ci_high) == pytest.approx((np.mean(own) - 1.96 * error, np.mean(own) + 1.96 * error), abs=0.4 * error)


def test_means_with_intervals(spark):
    rows = [(1, "a", 2.0), (2, "a", 4.0), (3, "b", 5.0)]
    df = spark.createDataFrame(rows, "Store int, k string, v double")
    got = {r.k: r for r in exploration.mean_by(df, "v", ["k"], identity=("Store",)).collect()}
    assert (got["a"].mean_v, got["a"].n, got["a"].se_v) == (3.0, 2, 1.0) and 2 <= got["a"].ci_low <= got["a"].ci_high <= 4
    assert (got["b"].ci_low, got["b"].ci_high, got["b"].se_v) == (5.0, 5.0, None)


def test_fills_and_implication(spark):
    df = spark.createDataFrame([(1, None, 1, None), (2, 4.0, 0, "x"), (3, 8.0, 0, "x")], "Store int, d double, Promo2 int, t string")
    assert [r.d for r in exploration.impute_median(df, "d").orderBy("Store").collect()] == [6.0, 4.0, 8.0]
    assert exploration.fill_typed(df).orderBy("Store").first().asDict() == {"Store": 1, "d": 0.0, "Promo2": 1, "t": "Unknown"}
    weeks = df.withColumns({"Promo2SinceWeek": F.lit(None).cast("int"), "Promo2SinceYear": F.lit(1)})
    assert {r.column_name: r.breaks for r in exploration.implication_breaks(weeks).collect()} == {
        "Promo2SinceWeek": 1, "Promo2SinceYear": 0
    }


def test_sale_per_customer_without_customers(raw):
    assert exploration.date_parts(raw([(1, 0, dict(Sales=0.0, Customers=0))])).first().SalePerCustomer is None


def test_codes_and_candidates(spark):
    df = spark.createDataFrame([("b", "x0", 1), (None, "x1", 2), ("a", "x2", 3), ("b", "x3", 4)], "t string, u string, Sales int")
    assert [r.t for r in features.category_codes(df, ["t"]).orderBy("Sales").collect()] == [2, 0, 1, 2]
    many = spark.createDataFrame([(f"v{i:03d}" if i % 5 else None, i) for i in range(150)], "t string, n int")
    order = sorted({r.t or "-999" for r in many.collect()})
    coded = features.category_codes(many, ["t"]).join(many.withColumnRenamed("t", "was"), "n").collect()
    assert len(coded) == 150 and all(order[r.t] == (r.was or "-999") for r in coded)
    assert features.candidate_list(df, max_distinct=3) == ["t"]
    # One text far beyond the limit, one just beyond, one at it; texts of a dimension are counted there.
    texts = spark.createDataFrame([(f"v{i}", f"v{i % 11}", f"v{i % 10}") for i in range(3000)], "a string, b string, c string")
    assert features.candidate_list(texts, max_distinct=10) == ["c"]
    both = features.feature_candidates(df, 10, columns=["n", "a", "c", "t"], text_sources=[df, texts]).orderBy("position")
    assert [r.feature for r in both.collect()] == ["n", "c", "t"]
    assert features.present(["t", "w"], df) == (["t"], ["w"])


def test_random_subsets(spark):
    names = spark.createDataFrame([(i, f"f{i}") for i in range(80)], "position int, feature string")
    first, again = (
        {r.model_id: r.features for r in features.random_subsets(names, 30).collect()} for _ in range(2)
    )
    assert first == again and len(first) == 30
    sizes = {len(f) for f in first.values()}
    assert min(sizes) >= 20 and max(sizes) <= 60 and len(sizes) > 5
    assert all(len(set(f)) == len(f) for f in first.values())
    assert features.without_short_term(["recent_q_all_mean", "recent_h_all_mean"]) == ["recent_h_all_mean"]


def test_replicates_of_many_groups_leave_a_task_once(spark):
    df = spark.range(4000, numPartitions=1).selectExpr("id", "id % 500 AS k", "double(id) AS v")
    means = bootstrap.replicate_means(df, "v", ["k"], ["id"], 3)
    means.collect()
    node = means._jdf.queryExecution().executedPlan()
    found = []

    def walk(plan):
        if plan.nodeName() == "AdaptiveSparkPlan":
            return walk(plan.executedPlan())
        if plan.nodeName().endswith("QueryStage"):
            return walk(plan.plan())
        if plan.nodeName() == "MapInArrow":
            found.append(plan.metrics().get("pythonNumRowsReceived").get().value())
        children = plan.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(node)
    assert found == [500 * 3]


def test_one_group_is_described_without_a_join(spark):
    df = spark.range(0, 1001, 1, 4).selectExpr("double(id) AS v")
    described = ranks.describe(df, "v")
    assert "Join" not in described._jdf.queryExecution().optimizedPlan().toString()
    assert described.collect() == [("all", 1001, 500.0, pytest.approx(289.1081, abs=1e-3), 0.0, 1000.0, 250.0, 500.0, 750.0)]
    assert ranks.describe(df.where("v < 0"), "v").collect() == []
    absent = ranks.describe(df.limit(1).selectExpr("double(NULL) AS v"), "v").first()
    assert absent["count"] == 0 and absent.p50 is None
    assert df.select(ranks.exact_median(df.where("v < 0"), "v").alias("m")).first().m is None


@pytest.mark.parametrize("digits", [2, 3, 8])
def test_rounded_is_round_without_decimals(spark, digits):
    rng = np.random.default_rng(digits)
    whole = rng.integers(-(10**7), 10**7, 3000)
    values = [*(whole / 10**digits), *(whole + 0.5) / 10**digits, *rng.normal(0, 1e5, 3000), *(10.0 ** rng.uniform(-12, 18, 300))]
    values += [1.005, 2.675, -0.5, -0.0004, 0.0, -0.0, 1e300, float("inf"), float("nan")]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    got = df.select(scalars.rounded("v", digits).alias("fast"), F.round("v", digits).alias("exact"))
    assert got.where("NOT (fast <=> exact)").collect() == []
    assert "floor" in got._jdf.queryExecution().optimizedPlan().toString().lower()
