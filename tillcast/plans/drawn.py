"""Small forests that any engine can refit: trees drawn by rule, leaves from the data.

The three specialists (all rows, summer rows, no short-term features) go through node tables, scores, the
harmonic ensemble and the closed rule as boosted models do.  Splits are drawn by arithmetic on tree and node
numbers between a feature's extremes, and a leaf is the mean log sale of the rows that reach it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.functions.scalars import CORRECTION, harmonic_of
from tillcast.operators import rolling, split
from tillcast.operators.events import calendar_parts, summer
from tillcast.operators.features import MISSING_NUMBER, without_short_term
from tillcast.operators.forest import Forest, Node, fit_leaves, node_table, read_forest, scores
from tillcast.session import stored

FEATURES = (
    "DayOfWeek", "Promo", "SchoolHoliday", "month", "day_of_month", "days_into_summer",
    "recent_q_all_mean", "recent_q_all_p90", "recent_h_all_mean", "recent_y_all_median",
)
TREES, DEPTH = 5, 3
#: Labels are whole numbers of this part of a log sale, so that their sums are exact in any order.
UNIT = 1e-8
MEMBERS = ("combined", "season", "month_ahead")


def featured(rows: DataFrame) -> DataFrame:
    """The features of the drawn trees, none absent, as columns and as the array ``x``."""
    out = summer(calendar_parts(rolling.add_recent_features(rows, splits=["all"])))
    numbers = {c: F.coalesce(F.round(F.col(c).cast("double"), 4), F.lit(MISSING_NUMBER)) for c in FEATURES}
    return out.withColumns(numbers).withColumn("x", F.array(*FEATURES))


def structure(member: int, names: list[str], bounds: dict[str, tuple[float, float]]) -> Forest:
    """Complete trees in heap order, without values in their leaves."""
    trees = []
    for t in range(TREES):
        tree = []
        for i in range(2 ** (DEPTH + 1) - 1):
            if i >= 2**DEPTH - 1:
                tree.append(Node(i, None, 0.0, -1, -1, 0.0))
                continue
            feature = names[(5 * t + 3 * i + member + t * i) % len(names)]
            low, high = bounds[feature]
            tree.append(Node(i, feature, low + (high - low) * ((3 * t + 5 * i + member) % 7 + 1) / 8, 2 * i + 1, 2 * i + 2, 0.0))
        trees.append(tree)
    return Forest(trees, 0.0, UNIT / TREES)


def forecasts(rows: DataFrame, learns: Column, *keep: str) -> DataFrame:
    """``keep`` columns of ``featured`` rows that don't learn, each member's forecast and the ensemble's.

    The forests are written as a node table and read back from it.
    """
    spark = rows.sparkSession
    known = rows.where(learns).select("x", "Date", F.round(F.log1p("Sales") / UNIT).cast("long").alias("label"))
    extremes = known.agg(*[F.struct(F.min(F.get("x", F.lit(i))), F.max(F.get("x", F.lit(i)))) for i in range(len(FEATURES))])
    bounds = {name: tuple(pair) for name, pair in zip(FEATURES, extremes.first())}
    names = list(FEATURES)
    drawn = {
        m: structure(i, without_short_term(names) if m == "month_ahead" else names, bounds) for i, m in enumerate(MEMBERS)
    }
    summer_row = F.month("Date").isin(*split.SEASON_MONTHS)
    uses = {m: summer_row if m == "season" else F.lit(True) for m in MEMBERS}
    fitted = fit_leaves(known, drawn, names, F.col("x"), uses)
    nodes = stored(node_table(spark, fitted), "forests")
    forests = [read_forest(nodes, m, fitted[m].base, fitted[m].weight) for m in MEMBERS]
    scored = rows.where(~learns).select(*keep, scores(forests, names, F.col("x")).alias("_scores"))
    members = [F.expm1(F.get("_scores", F.lit(i))) for i in range(len(MEMBERS))]
    ensemble = harmonic_of(members) * CORRECTION
    return scored.select(*keep, *[p.alias(m) for m, p in zip(MEMBERS, members)], ensemble.alias("pred"))

