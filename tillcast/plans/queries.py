"""The registered queries: each operator on the whole test tables.

Rounding happens here only, for comparison with an engine that adds in another order.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillcast.functions.scalars import harmonic_of, rounded, weighted_harmonic
from tillcast.operators import ensemble, events, exploration, features, ranks, rolling, split, trend
from tillcast.plans import build, drawn, explore, standins
from tillcast.plans import train as training
from tillcast.session import by_store, cut_lineage, shared_folder, stored, tune
from tillcast.sources import panel as source
from tillcast.sources import schema, sinks

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    @functools.wraps(fn)
    def tuned(spark: SparkSession, folder: str) -> DataFrame:
        tune(spark)
        return fn(spark, folder)

    REGISTRY[fn.__name__] = tuned
    return tuned


def _round(df: DataFrame, **digits: int) -> DataFrame:
    kinds = dict(df.dtypes)
    return df.withColumns({c: rounded(c, d) if kinds[c] == "double" else F.round(c, d) for c, d in digits.items()})


def _panel(spark: SparkSession, folder: str) -> DataFrame:
    return source.store_panel(spark, folder)


def _by_store(df: DataFrame) -> DataFrame:
    return events.with_day(by_store(df))


def _stores(spark: SparkSession, folder: str) -> DataFrame:
    return source.store_attributes(spark, folder)


def _joined(spark: SparkSession, folder: str) -> DataFrame:
    return source.join_store(_panel(spark, folder), _stores(spark, folder))


def _filled_stores(spark: SparkSession, folder: str) -> DataFrame:
    return exploration.fill_typed(exploration.impute_median(_stores(spark, folder), "CompetitionDistance"))


def _explored(spark: SparkSession, folder: str) -> DataFrame:
    return explore.explored_rows(_panel(spark, folder), _stores(spark, folder))


def _csv_round_trip(spark: SparkSession, df: DataFrame, table_schema) -> DataFrame:
    path = shared_folder(spark, "csv")
    ordered = df.select(*[F.col(f.name).cast(f.dataType) for f in table_schema.fields])
    ordered.write.mode("overwrite").option("header", True).csv(f"{path}/table")
    return schema.read_csv(spark, f"{path}/table", table_schema)


# ---------------------------------------------------------------- sources, joins, splits


@query
def panel_daily(spark, folder):
    return _panel(spark, folder)


@query
def csv_train_scan(spark, folder):
    return _csv_round_trip(spark, _panel(spark, folder), schema.TRAIN)


@query
def csv_store_scan(spark, folder):
    return _csv_round_trip(spark, _stores(spark, folder), schema.STORE)


@query
def csv_test_scan(spark, folder):
    _, last_day = source.calendar_bounds(spark, folder)
    _, scoring = source.scoring_split(_panel(spark, folder), last_day)
    return _csv_round_trip(spark, scoring, schema.TEST)


@query
def panel_store_left_join(spark, folder):
    return _joined(spark, folder)


@query
def panel_store_inner_join(spark, folder):
    return source.join_store(_panel(spark, folder), _filled_stores(spark, folder), "inner")


@query
def time_split_counts(spark, folder):
    panel, (_, last_day) = _panel(spark, folder), source.calendar_bounds(spark, folder)
    edge = F.date_sub(last_day, 7 * split.HOLDOUT_WEEKS)
    before, at, after = F.col("Date") < edge, F.col("Date") == edge, F.col("Date") > edge
    # The four parts overlap only on the boundary day, so one pass labels every row for both rules.
    parts = F.when(before, F.array(F.lit("job_train"), F.lit("explore_train"))).when(
        at, F.array(F.lit("job_holdout"), F.lit("explore_train"))
    ).when(after, F.array(F.lit("job_holdout"), F.lit("explore_holdout")))
    return panel.select("Store", "Date", F.explode(parts).alias("part")).groupBy("part").agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct("Store").alias("stores"),
        F.min("Date").alias("first_date"),
        F.max("Date").alias("last_date"),
    )


@query
def context_union_trim(spark, folder):
    panel, (_, last_day) = _panel(spark, folder), source.calendar_bounds(spark, folder)
    history, scoring = source.scoring_split(panel, last_day)
    context = split.recent_history(history, F.date_sub(last_day, source.SCORING_DAYS))
    in_store = Window.partitionBy("Store")

    def featured(df: DataFrame) -> DataFrame:
        return _by_store(df).withColumns(
            {
                "days_since_promo": events.days_since(F.col("Promo") == 1),
                "context_rows": F.count("Sales").over(in_store),
            }
        )

    rows = split.with_context(context, split.open_by_default(scoring), featured)
    return split.scoring_rows(rows).select(
        "Id", "Store", "Date", "Open", "Sales", "days_since_promo", "context_rows"
    )


@query
def trainable_rows(spark, folder):
    panel = _panel(spark, folder)
    rules = {
        "trainable": (F.col("Open") == 1) & (F.col("Sales") > 0),
        "explored": (F.col("Open") != 0) & (F.col("Sales") != 0),
        "closed": F.col("Open") == 0,
    }
    names = F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()]))
    return panel.select("Sales", F.explode(names).alias("filter")).groupBy("filter").agg(
        F.count(F.lit(1)).alias("total_rows"), F.sum("Sales").alias("sales")
    )


# ---------------------------------------------------------------- rolling statistics

_DIGITS = {"std": 3, "skew": 6, "cv": 6, "p10": 3, "p90": 3, "harmonic_mean": 2}


def _recent_digits(names: list[str]) -> dict[str, int]:
    return {n: d for n in names for stat, d in _DIGITS.items() if n.endswith(f"_{stat}")}


def _recent(spark, folder, split_name: str, **options) -> DataFrame:
    out = rolling.add_recent_features(_panel(spark, folder), splits=[split_name], **options)
    names = rolling.feature_names([split_name])
    return _round(out.select("Store", "Date", *names), **_recent_digits(names))


@query
def recent_all(spark, folder):
    return _recent(spark, folder, "all")


@query
def recent_dow(spark, folder):
    return _recent(spark, folder, "dow")


@query
def recent_promo(spark, folder):
    return _recent(spark, folder, "promo")


@query
def recent_holiday(spark, folder):
    return _recent(spark, folder, "holiday")


@query
def recent_dow_promo(spark, folder):
    return _recent(spark, folder, "dow_promo")


@query
def recent_target_row_key(spark, folder):
    return _recent(spark, folder, "dow", split_key="target_row")


# ---------------------------------------------------------------- calendar and events


@query
def calendar_parts(spark, folder):
    return events.calendar_parts(_panel(spark, folder)).select(
        "Store", "Date", "day_of_week", "day_of_month", "week_of_year", "month", "year", "day_of_year"
    )


@query
def summer_days(spark, folder):
    return events.summer(_panel(spark, folder)).select("Store", "Date", "is_summer", "days_into_summer")


@query
def promo_cycles(spark, folder):
    first_day, _ = source.calendar_bounds(spark, folder)
    return events.promo_cycles(_joined(spark, folder), first_day).select(
        "Store", "Date", "day_in_promo_cycle", "day_in_promo2_cycle"
    )


@query
def days_since_events(spark, folder):
    rows = _by_store(_joined(spark, folder))
    return rows.select(
        "Store",
        "Date",
        events.days_since(F.col("Promo") == 1).alias("days_since_promo"),
        events.days_since(F.col("Promo2") == 1).alias("days_since_promo2"),
        events.days_since(F.col("SchoolHoliday") == 1).alias("days_since_school_holiday"),
    )


@query
def days_until_events(spark, folder):
    rows = _by_store(_panel(spark, folder))
    return rows.select(
        "Store",
        "Date",
        events.days_until(F.col("Promo") == 1).alias("days_until_promo"),
        events.days_until(F.col("SchoolHoliday") == 1).alias("days_until_school_holiday"),
    )


@query
def refurb_starts(spark, folder):
    return events.closure_starts(_by_store(_panel(spark, folder))).select("Store", "Date", "is_refurb_closure")


@query
def closure_runs(spark, folder):
    return events.closure_runs(_by_store(_panel(spark, folder)))


@query
def days_around_refurb(spark, folder):
    rows = events.closure_starts(_by_store(_panel(spark, folder)))
    refurb = F.col("is_refurb_closure") == 1
    rows = rows.withColumn("days_until_refurb", events.days_until(refurb))
    return rows.withColumn("days_since_refurb", events.days_since(refurb)).select(
        "Store", "Date", "days_since_refurb", "days_until_refurb"
    )


@query
def competition_days(spark, folder):
    return events.competition(_joined(spark, folder)).select("Store", "Date", "days_since_competition")


@query
def holiday_week_counts(spark, folder):
    rows = _by_store(_panel(spark, folder)).withColumn("flag", events.holiday_flag("StateHoliday"))
    return events.week_sums(rows, "flag", "holidays").select(
        "Store", "Date", "holidays_this_week", "holidays_last_week", "holidays_next_week"
    )


@query
def school_week_counts(spark, folder):
    return events.week_sums(_by_store(_panel(spark, folder)), "SchoolHoliday", "school_holidays").select(
        "Store", "Date", "school_holidays_this_week", "school_holidays_last_week", "school_holidays_next_week"
    )


# ---------------------------------------------------------------- trend


def _trend(spark, folder) -> DataFrame:
    first_day, _ = source.calendar_bounds(spark, folder)
    return trend.add_trend_features(_panel(spark, folder), first_day)


@query
def trend_yoy(spark, folder):
    return _round(_trend(spark, folder).select("Store", "Date", "trend_yoy", "day_number"), trend_yoy=8)


@query
def trend_ridge_q(spark, folder):
    names = ["trend_q_slope", "trend_q_dow_coef", "trend_q_promo_coef", "trend_q_pred"]
    return _round(_trend(spark, folder).select("Store", "Date", *names), **{n: 2 for n in names})


@query
def trend_ridge_y(spark, folder):
    names = ["trend_y_slope", "trend_y_pred"]
    return _round(_trend(spark, folder).select("Store", "Date", *names), **{n: 2 for n in names})


# ---------------------------------------------------------------- exploration


@query
def null_counts(spark, folder):
    return exploration.null_counts(_stores(spark, folder))


@query
def median_impute(spark, folder):
    return exploration.impute_median(_stores(spark, folder), "CompetitionDistance").select(
        "Store", "CompetitionDistance"
    )


@query
def fill_typed(spark, folder):
    return exploration.fill_typed(_stores(spark, folder))


@query
def null_implication(spark, folder):
    return exploration.implication_breaks(_stores(spark, folder))


@query
def closed_and_zero_sales(spark, folder):
    return exploration.closed_and_zero_sales(_panel(spark, folder))


@query
def sunday_stores(spark, folder):
    return exploration.sunday_stores(_panel(spark, folder))


@query
def table_summary(spark, folder):
    return exploration.table_summary(_panel(spark, folder))


def _explored_sales(spark, folder, *more: str) -> DataFrame:
    """Explored sales, stored because the summaries, the ranks and the result each read them."""
    return stored(_explored(spark, folder).select("Sales", *more), "explored")


@query
def describe_sales(spark, folder):
    return _round(ranks.describe(_explored_sales(spark, folder), "Sales"), mean=4, std=2)


@query
def describe_sales_by_type(spark, folder):
    return _round(ranks.describe(_explored_sales(spark, folder, "StoreType"), "Sales", "StoreType"), mean=4, std=2)


@query
def describe_competition_distance(spark, folder):
    described = ranks.describe(_stores(spark, folder), "CompetitionDistance")
    return _round(described, mean=4, std=4, p25=6, p50=6, p75=6)


@query
def sum_by_type(spark, folder):
    return _explored(spark, folder).groupBy("StoreType").agg(
        F.sum("Customers").alias("Customers"), F.sum("Sales").alias("Sales")
    )


def _means(spark, folder, value: str, keys: list[str], error: bool = True) -> DataFrame:
    means = exploration.mean_by(_explored(spark, folder), value, keys, error)
    return _round(means, **{c: 4 for c in means.columns if c.startswith(("mean_", "se_", "ci_"))})


@query
def mean_sales_month_type_promo(spark, folder):
    return _means(spark, folder, "Sales", ["Month", "StoreType", "Promo"])


@query
def mean_customers_month_type_promo(spark, folder):
    return _means(spark, folder, "Customers", ["Month", "StoreType", "Promo"])


@query
def mean_sale_per_customer_month_type_promo(spark, folder):
    return _means(spark, folder, "SalePerCustomer", ["Month", "StoreType", "Promo"])


@query
def mean_dow_month_type(spark, folder):
    return _means(spark, folder, "Sales", ["DayOfWeek", "Month", "StoreType"])


@query
def mean_dow_promo_promo2(spark, folder):
    return _means(spark, folder, "Sales", ["DayOfWeek", "Promo", "Promo2"], error=False)


@query
def open_time_means(spark, folder):
    names = ["Sales", "Customers", "PromoOpen", "CompetitionOpen", "CompetitionOpenKnown"]
    means = _explored(spark, folder).groupBy("StoreType").agg(*[F.avg(c).alias(c) for c in names])
    return _round(means, **{c: 4 for c in names} | {"Customers": 6})


def _ecdf(spark, folder, column: str) -> DataFrame:
    return _round(ranks.ecdf(exploration.date_parts(_panel(spark, folder)), column), x=6, y=9)


@query
def ecdf_sales(spark, folder):
    return _ecdf(spark, folder, "Sales")


@query
def ecdf_customers(spark, folder):
    return _ecdf(spark, folder, "Customers")


@query
def ecdf_sale_per_customer(spark, folder):
    return _ecdf(spark, folder, "SalePerCustomer")


@query
def corr_lower_triangle(spark, folder):
    explored = _explored(spark, folder).drop("CompetitionOpenKnown")
    return _round(exploration.correlations(explored), r=6)


@query
def explored_zero_filled(spark, folder):
    names = ["SalePerCustomer", "CompetitionDistance", "CompetitionOpen", "CompetitionOpenKnown", "PromoOpen"]
    table = exploration.zero_filled(_explored(spark, folder))
    doubles = [F.col(c).cast("double").alias(c) for c in names]
    return _round(table.select("Store", "Date", "PromoInterval", *doubles), **{c: 6 for c in names})


@query
def log_sales_split(spark, folder):
    # Read for the last day and for both parts.
    explored = stored(_explored(spark, folder).select("Store", "Date", "Sales"), "explored")
    train, holdout = split.time_split(explored, boundary="train")
    parts = train.withColumn("part", F.lit("train")).unionByName(holdout.withColumn("part", F.lit("holdout")))
    return parts.select("Store", "Date", F.round(F.log1p("Sales"), 8).alias("Sales"), "part")


# ---------------------------------------------------------------- feature names and codes


def _candidates(spark, folder, *more: str) -> DataFrame:
    """Candidates of the featured frame, each text counted in the table that it comes from."""
    days = source.calendar_days(spark, folder).withColumn("DayText", F.date_format("Date", "yyyy-MM-dd"))
    return features.feature_candidates(
        days, columns=[*build.feature_columns(), *more], text_sources=[days, _stores(spark, folder)]
    )


@query
def category_codes(spark, folder):
    texts = ["StateHoliday", "StoreType", "Assortment", "PromoInterval"]
    return features.category_codes(_joined(spark, folder), texts).select("Store", "Date", *texts)


_TREND_DIGITS = {"trend_yoy": 8} | {c: 2 for c in trend.TREND_COLUMNS if c != "trend_yoy"}


@query
def training_matrix(spark, folder):
    """All model inputs of the trainable rows, before they become vectors."""
    first_day, _ = source.calendar_bounds(spark, folder)
    joined = _joined(spark, folder)
    rows = split.trainable(build.add_features(joined, first_day, wanted=split.is_trainable(joined)))
    candidates = [r.feature for r in _candidates(spark, folder).orderBy("position").collect()]
    texts = [c for c in exploration.string_columns(rows) if c in candidates]
    digits = _recent_digits(rolling.feature_names()) | _TREND_DIGITS
    rows = stored(_round(rows, **digits).select("Store", "Date", "Sales", *candidates), "featured")
    coded = features.category_codes(training.filled(rows, candidates, texts), texts)
    return coded.select("Store", "Date", F.round(F.log1p("Sales"), 8).alias("log_Sales"), *candidates)


@query
def feature_candidates(spark, folder):
    # One more text, which has a value for every day.
    return _candidates(spark, folder, "DayText").select("feature")


def _subsets(spark, folder, n_models: int) -> DataFrame:
    return features.random_subsets(_candidates(spark, folder, "DayText"), n_models)


@query
def random_feature_subsets(spark, folder):
    return _subsets(spark, folder, 500).withColumn("features", F.concat_ws(",", "features"))


# ---------------------------------------------------------------- scores and ensembles

_MODELS = list(range(standins.MODELS))


def _predictions(spark, folder) -> DataFrame:
    _, last_day = source.calendar_bounds(spark, folder)
    return standins.holdout_predictions(_panel(spark, folder), last_day)


@query
def model_scores(spark, folder):
    return _round(ensemble.model_scores(_predictions(spark, folder), _MODELS), rmspe=8)


@query
def top_models(spark, folder):
    return _round(ensemble.top_models(ensemble.model_scores(_predictions(spark, folder), _MODELS)), rmspe=8)


def _pairs(spark, folder) -> DataFrame:
    predictions = cut_lineage(_predictions(spark, folder))  # read twice
    return ensemble.best_pairs(predictions, _MODELS, ensemble.model_scores(predictions, _MODELS))


@query
def best_pairs(spark, folder):
    return _round(_pairs(spark, folder), rmspe_single1=8, rmspe_single2=8, rmspe_ensemble=8)


def _combined(spark, folder) -> DataFrame:
    subsets = _subsets(spark, folder, standins.MODELS)
    return features.union_of_features(subsets, ensemble.models_of_pairs(_pairs(spark, folder)))


@query
def combined_features(spark, folder):
    return _combined(spark, folder)


@query
def month_ahead_features(spark, folder):
    return _combined(spark, folder).where(~F.startswith("feature", F.lit(features.SHORT_TERM_PREFIX)))


@query
def season_rows(spark, folder):
    _, last_day = source.calendar_bounds(spark, folder)
    train, _ = split.time_split(_panel(spark, folder), last_day=last_day)
    return split.trainable(split.season(train)).select(
        "Store", "Date", "Sales", F.round(F.log1p("Sales"), 8).alias("log_Sales")
    )


@query
def final_ensemble(spark, folder):
    return _round(ensemble.final_ensemble(_predictions(spark, folder), _MODELS, standins.FAMILY_A), pred=6)


@query
def cross_ensemble(spark, folder):
    families = (standins.FAMILY_A, standins.FAMILY_B)
    return _round(ensemble.cross_ensemble(_predictions(spark, folder), _MODELS, *families), pred=6)


@query
def score_comparison(spark, folder):
    a, b = (ensemble.harmonic(_MODELS, family) for family in (standins.FAMILY_A, standins.FAMILY_B))
    preds = {"family_a": a, "family_b": b, "cross": weighted_harmonic(a, b, 0.5)}
    totals = ensemble.total_scores(
        _predictions(spark, folder), {name: pred * ensemble.CORRECTION for name, pred in preds.items()}
    )
    return _round(ensemble.recommend(totals, ["cross", "family_b", "family_a"]), rmspe=8)


def _submission(spark, folder) -> DataFrame:
    _, last_day = source.calendar_bounds(spark, folder)
    rows = split.open_by_default(source.scoring_frame(_panel(spark, folder), last_day))
    members = list(range(5))
    members_of_row = [F.get("preds", F.lit(m)) for m in members]
    scored = standins.with_stand_ins(rows, members).withColumn(
        "Sales", F.round(harmonic_of(members_of_row) * ensemble.CORRECTION, 6)
    )
    return ensemble.close_stores(split.scoring_rows(scored)).select("Id", "Sales")


@query
def submission(spark, folder):
    return _submission(spark, folder).orderBy("Id")


@query
def submission_summary(spark, folder):
    return ensemble.forecast_summary(_submission(spark, folder))


@query
def submission_file(spark, folder):
    """The submission written as ordered CSV files and read back."""
    path = sinks.write_submission(_submission(spark, folder), shared_folder(spark, "submission"))
    return spark.read.schema("Id long, Sales double").option("header", True).csv(path)


@query
def featured_tables(spark, folder):
    """The feature job from raw tables to three stored ones, and what a reader finds in them."""
    _, last_day = source.calendar_bounds(spark, folder)
    history, scoring = source.scoring_split(_panel(spark, folder), last_day)
    path = shared_folder(spark, "featured")
    build.build_features(history, scoring, _stores(spark, folder), path)
    found = [
        df.agg(
            F.lit(name).alias("name"),
            F.count(F.lit(1)).alias("total_rows"),
            F.min("Date").alias("first_date"),
            F.max("Date").alias("last_date"),
            F.sum(F.col("Sales")).alias("sales"),
            F.count("recent_y2_all_harmonic_mean").alias("with_harmonic"),
            F.round(F.sum("recent_q_all_median"), 2).alias("medians"),
            F.sum("days_since_promo").alias("days_since_promo"),
            F.count("trend_yoy").alias("with_growth"),
            F.sum("day_number").alias("day_numbers"),
        )
        for name, df in schema.read_featured(spark, path).items()
    ]
    return functools.reduce(DataFrame.unionByName, found)


@query
def feature_presence(spark, folder):
    """Requested features that the joined rows have, and those they lack."""
    have, lack = features.present([*build.feature_columns(), "Weather"], _joined(spark, folder))
    rows = [(name, 1) for name in have] + [(name, 0) for name in lack]
    return spark.createDataFrame(rows, "feature string, present int")


# ---------------------------------------------------------------- forests


def _holdout_forecasts(spark, folder) -> DataFrame:
    _, last_day = source.calendar_bounds(spark, folder)
    edge = F.date_sub(last_day, 7 * split.HOLDOUT_WEEKS)
    # Read for the extremes, the leaves and the holdout.
    rows = split.trainable(drawn.featured(_panel(spark, folder)))
    rows = rows.select("Store", "Date", "Sales", "x", (F.col("Date") < edge).alias("learns"))
    return drawn.forecasts(stored(rows, "forest-rows"), F.col("learns"), "Store", "Date", "Sales")


@query
def forest_holdout(spark, folder):
    digits = {c: 2 for c in (*drawn.MEMBERS, "pred")}
    return _round(_holdout_forecasts(spark, folder), **digits)


@query
def forest_scores(spark, folder):
    """Holdout errors of the members and their ensemble, in sales."""
    preds = {m: F.col(m) for m in (*drawn.MEMBERS, "pred")}
    scored = _holdout_forecasts(spark, folder).withColumnRenamed("Sales", "y")
    return _round(ensemble.total_scores(scored, preds), rmspe=8)


@query
def forest_submission(spark, folder):
    """Forecasts of the scoring rows by forests that learned from all history; closed stores sell nothing."""
    _, last_day = source.calendar_bounds(spark, folder)
    rows = split.open_by_default(source.scoring_frame(_panel(spark, folder), last_day))
    sold = (F.col("Open") == 1) & (F.col("Sales") > 0)
    rows = drawn.featured(rows.withColumn("learns", F.col("Id").isNull() & F.coalesce(sold, F.lit(False))))
    rows = rows.where("learns or Id is not null").select("Id", "Open", "Date", "Sales", "x", "learns")
    scored = drawn.forecasts(stored(rows, "forest-rows"), F.col("learns"), "Id", "Open")
    closed = ensemble.close_stores(scored.withColumn("Sales", F.round("pred", 2)))
    return closed.select("Id", "Sales").orderBy("Id")


@query
def stored_scores(spark, folder):
    """Scores recorded run by run and read back: the latest of each model, none for one never scored."""
    path = shared_folder(spark, "scores")
    scored = forest_scores(spark, folder).collect()  # a row per member
    for run_id, factor in (("run-1", 2.0), ("run-2", 1.0)):
        for row in scored:
            sinks.append_score(spark, path, run_id, row.model, row.rmspe * factor)
    return sinks.read_scores(spark, path, [*(row.model for row in scored), "unscored"])
