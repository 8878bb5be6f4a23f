import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillcast.operators import split
from tillcast.plans import build, explore
from tillcast.sources import panel, schema, sinks


def test_boundary_day(raw, day):
    df = raw([(1, n, {}) for n in range(100)])
    train, holdout = split.time_split(df)
    assert holdout.count() == 43 and holdout.agg(F.min("Date")).first()[0] == day(57)
    train, holdout = split.time_split(df, boundary="train")
    assert holdout.count() == 42 and train.agg(F.max("Date")).first()[0] == day(57)


def test_context_is_trimmed_and_open_defaults(spark, raw, day):
    history = raw([(1, n, {}) for n in range(20)])
    target = spark.createDataFrame([(7, 1, day(20), None), (8, 1, day(21), 0.0)], "Id int, Store long, Date date, Open double")
    seen = {}

    def look(df):
        seen["rows"] = df.count()
        return df

    out = split.scoring_rows(split.with_context(history, split.open_by_default(target), look)).orderBy("Id").collect()
    assert seen["rows"] == 22
    assert [(r.Id, r.Open, r.Sales) for r in out] == [(7, 1, None), (8, 0, None)]


def test_history_cut(raw, day):
    df = raw([(1, n, {}) for n in range(600)])
    assert split.recent_history(df).agg(F.min("Date")).first()[0] == day(99)


def test_filters(raw):
    df = raw([(1, 0, {}), (1, 1, dict(Open=0, Sales=0.0)), (1, 2, dict(Sales=0.0)), (1, 3, dict(Sales=None))])
    assert split.trainable(df).count() == 1
    assert split.explored(df).count() == 1
    assert split.trainable(df.drop("Sales")).count() == 3


def test_inputs_are_checked(spark, raw, tmp_path):
    with pytest.raises(ValueError, match="not unique"):
        schema.require_unique(raw([(1, 0, {}), (1, 0, {})]), ["Store", "Date"])
    with pytest.raises(schema.MissingInput, match="holdout_featured"):
        schema.read_featured(spark, str(tmp_path))
    with pytest.raises(schema.MissingInput, match="Sales"):
        schema.require_columns(raw([(1, 0, {})]).drop("Sales"), ["Sales"], "t")


def test_csv_reader(spark, tmp_path):
    (tmp_path / "store.csv").write_text(
        "Store,StoreType,Assortment,CompetitionDistance,CompetitionOpenSinceMonth,CompetitionOpenSinceYear,"
        'Promo2,Promo2SinceWeek,Promo2SinceYear,PromoInterval\n1,c,a,1270.0,9,2008,0,,,\n2,a,a,NaN,,,1,13,2010,"Jan,Apr,Jul,Oct"\n'
    )
    rows = schema.read_csv(spark, str(tmp_path / "store.csv"), schema.STORE).orderBy("Store").collect()
    assert rows[0].PromoInterval is None and rows[1].CompetitionDistance is None
    assert rows[1].PromoInterval == "Jan,Apr,Jul,Oct"


def test_dense_panel(spark, day):
    daily = spark.createDataFrame(
        [(1, day(2), 5.0, 1, 1), (1, day(4), 7.0, 2, 0), (2, day(0), 3.0, 1, 0)],
        "Store long, Date date, Sales double, Customers int, Promo int",
    )
    dense = panel.densify(daily, F.lit(day(0)), F.lit(day(5)))
    assert dense.count() == 12
    assert {(r.Store, r.Date): r.Sales for r in dense.where("Open = 1").collect()} == {
        (1, day(2)): 5.0, (1, day(4)): 7.0, (2, day(0)): 3.0
    }


def test_submission_and_scores(spark, tmp_path):
    df = spark.createDataFrame([(i, float(i)) for i in reversed(range(50))], "Id int, Sales double")
    path = sinks.write_submission(df, str(tmp_path / "sub"))
    ids = []
    for part in sorted((tmp_path / "sub").glob("part-*.csv")):
        lines = part.read_text().split()
        assert lines[0] == "Id,Sales"
        ids += [int(line.split(",")[0]) for line in lines[1:]]
    assert ids == list(range(50)) and path.endswith("sub")
    scores = str(tmp_path / "scores")
    assert {r.shown for r in sinks.read_scores(spark, scores, ["a"]).collect()} == {"N/A"}
    sinks.append_score(spark, scores, "r1", "a", 0.5)
    sinks.append_score(spark, scores, "r2", "a", 0.25)
    shown = {r.model: r.shown for r in sinks.read_scores(spark, scores, ["a", "b"]).collect()}
    assert shown == {"a": "0.25000", "b": "N/A"}


def test_feature_job(spark, raw, day, tmp_path):
    train = raw([(s, n, dict(Sales=100.0 + n + s, Promo=int(n % 5 == 0))) for s in (1, 2) for n in range(200)])
    test = raw([(s, n, {}) for s in (1, 2) for n in range(200, 220)]).drop("Sales", "Customers").withColumns(
        {"Id": F.col("Store") * 1000 + F.dayofyear("Date"), "Open": F.lit(None).cast("double")}
    )
    store = spark.createDataFrame(
        [(1, "a", "a", 10.0, 1, 2010, 1, 1, 2011, "Jan,Apr,Jul,Oct")], schema.STORE
    )
    build.build_features(train, test, store, str(tmp_path), history_days=120)
    tables = schema.read_featured(spark, str(tmp_path))
    assert {k: t.count() for k, t in tables.items()} == {
        "train_featured": 2 * 157, "holdout_featured": 2 * 43, "test_featured": 2 * 20
    }
    inputs = build.feature_columns()
    assert len(inputs) == 191 and set(inputs) <= set(tables["train_featured"].columns)
    row = tables["test_featured"].where(f"Store = 1 and Date = date'{day(210)}'").first()
    assert row.Sales is None and row.Open == 1 and row.recent_q_all_mean == pytest.approx(101 + np_mean(91, 180))
    assert tables["train_featured"].where("Store = 2 and Promo2 is null").count() == 157


def np_mean(low, high):
    return (low + high) / 2


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_exploration_job(spark, raw, tmp_path, fmt):
    train = raw([(s, n, dict(Sales=float(n % 4), Customers=n % 3)) for s in (1, 2) for n in range(60)])
    rows = [(1, "a", "a", None, None, None, 0, None, None, None), (2, "b", "c", 5.0, 3, 2010, 1, 4, 2012, "Jan")]
    store = spark.createDataFrame(rows, schema.STORE)
    paths = explore.build_exploration(train, store, str(tmp_path), fmt)
    tables = [spark.read.option("header", True).format(fmt).load(p) for p in paths.values()]
    whole, fit, holdout = (t.count() for t in tables)
    assert whole == 2 * 45 and fit + holdout == whole and holdout == 2 * sum(n % 4 > 0 for n in range(18, 60))
    assert all(v is not None for row in tables[0].collect() for v in row)


def shuffles(df):
    """Shuffles of the plan that place rows, those of subqueries left out."""
    plan = df._jdf.queryExecution().sparkPlan().toString()
    prepared = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    return [line for line in prepared.splitlines() if "Exchange hashpartitioning" in line], plan


def test_features_of_a_table_by_store_need_no_shuffle(spark, raw, day, tmp_path):
    rows = raw([(store, n, dict(Sales=float(100 * store + n), Open=int(n % 9 > 0))) for store in range(1, 6) for n in range(150)])
    path = f"{tmp_path}/rows"
    table = sinks.write_by_store(rows, "rows_by_store", path, 3)
    try:
        origin = F.lit(day(0))
        found = build.add_features(table, origin, placed=True)
        assert shuffles(found)[0] == [] and shuffles(build.add_features(table, origin))[0] != []
        names = ["Store", "Date", "recent_q_dow_median", "trend_q_slope", "days_since_promo", "holidays_next_week"]
        got, want = (
            sorted(map(tuple, df.select(*names).collect())) for df in (found, build.add_features(rows, origin))
        )
        assert str(got) == str(want) and len(got) == 750
        # A file per bucket; a session that doesn't know the table finds it again.
        assert len([p for p in (tmp_path / "rows").iterdir() if p.suffix == ".parquet"]) <= 3
        spark.sql("DROP TABLE rows_by_store")
        again = sinks.read_by_store(spark, "rows_by_store", path, rows.schema, 3)
        assert shuffles(build.add_features(again, origin, placed=True))[0] == [] and again.count() == 750
    finally:
        spark.sql("DROP TABLE IF EXISTS rows_by_store")


def test_featured_rows_are_written_without_a_shuffle_or_sort(spark, raw, tmp_path):
    rows = raw([(store, 8 * n, dict(Sales=float(store + n))) for store in range(1, 30) for n in range(100)])
    path = sinks.write_featured(build.add_features(rows), str(tmp_path), "train_featured")
    executions = spark._jsparkSession.sharedState().statusStore().executionsList()
    plan = executions.apply(executions.size() - 1).physicalPlanDescription().split("\n\n\n")[0]
    write = plan[plan.index("WriteFiles"):].split("ArrowEvalPython")[0]
    assert "Exchange" not in write and "Sort" not in write
    years = sorted(p for p in (tmp_path / "train_featured").iterdir() if p.is_dir())
    assert [p.name for p in years] == ["sales_year=2015", "sales_year=2016", "sales_year=2017"]
    for year in years:
        files = [spark.read.parquet(str(p)).select("Store", "Date").collect() for p in year.glob("*.parquet")]
        # A store's rows of a year lie in one file, in the order of days.
        stores = [store for rows in files for store in {r.Store for r in rows}]
        assert sorted(stores) == list(range(1, 30)) and len(files) <= 4
        assert all(rows == sorted(rows) for rows in files)
    assert spark.read.parquet(path).count() == 2900
