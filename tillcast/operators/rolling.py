"""Rolling sales statistics over time frames, per store and split key.

For every row the frame is ``(day - N, day]`` among the rows of its store that share its
split key.  The block is then read 30 days later, so a row sees nothing of the last month.

Cost.  A RANGE frame re-aggregated per row would cost N updates per row and statistic.
Here each row pays a constant for counts and moments (a running total at the frame's upper edge minus
that at its lower edge) and a descent per percentile in an index over the values
(``order_index``), read by the frame's first and last position: no row carries a list or comes once per split.
Everything is one shuffle by store and one sort by day inside the partition.  A store has at most
one row per calendar day, so what a task holds of it is bounded by the calendar.

The expressions are SQL text: over a hundred of them are needed, and text reaches the
analyzer in one call.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.functions.scalars import EPSILON, epoch_day, holiday_flag
from tillcast.operators.order_index import FRACTIONS, MOMENTS, frame_order
from tillcast.session import by_store

HORIZONS = {"q": 90, "h": 180, "y": 365, "y2": 730}
SPLITS = {
    "all": [],
    "dow": ["DayOfWeek"],
    "promo": ["Promo"],
    "holiday": ["is_holiday"],
    "dow_promo": ["DayOfWeek", "Promo"],
}
FULL_STATS = ("mean", "median", "std", "p10", "p90", "skew", "cv", "harmonic_mean")
SPLIT_STATS = {name: FULL_STATS for name in SPLITS} | {"dow_promo": ("mean", "median", "std", "skew")}
MIN_PERIODS = 2
LAG_DAYS = 30


def feature_names(splits: list[str] | None = None) -> list[str]:
    """Names in the order the columns are produced: horizon, split, statistic."""
    return [
        f"recent_{h}_{s}_{stat}" for h in HORIZONS for s in SPLITS if not splits or s in splits for stat in SPLIT_STATS[s]
    ]


def _statistics(s: str, h: str) -> dict[str, str]:
    """The eight statistics of one split and horizon."""
    found = {stat: f"_order.{s}_{h}_{stat}" for stat in FULL_STATS}
    mean, median, std = found["mean"], found["median"], found["std"]
    return found | {
        "skew": f"({mean} - {median}) / ({std} + {EPSILON}D)",
        "cv": f"try_divide({std}, {mean} + {EPSILON}D)",
    }


def recent_columns(
    ordered: DataFrame,
    target: str,
    splits: list[str] | None,
    split_key: str,
    lag_days: int,
    wanted: Column | None = None,
) -> DataFrame:
    """The work of ``add_recent_features`` on rows placed by store and sorted by store and day.

    Only rows for which ``wanted`` holds are returned, and only for them statistics are worked out; the others
    count in the frames.
    """
    chosen = [s for s in SPLITS if not splits or s in splits]
    lagged = split_key == "source_row"
    ago, shift = (lag_days, 0) if lagged else (0, lag_days)
    keyed = ordered.withColumns({"is_holiday": holiday_flag("StateHoliday"), "_day": epoch_day("Date")})
    keys = sorted({k for s in chosen for k in SPLITS[s]})
    statistics = frame_order(
        {s: [keys.index(k) for k in SPLITS[s]] for s in chosen},
        HORIZONS,
        {s: [name for name in (*FRACTIONS, *MOMENTS) if name in SPLIT_STATS[s]] for s in chosen},
        ago,
        shift,
        MIN_PERIODS,
        wanted is not None,
    )
    inputs = [F.col("Store"), F.col("_day"), *[F.col(c).cast("double") for c in (target, *keys)]]
    flags = [] if wanted is None else [wanted]
    out = keyed.withColumn("_order", statistics(*inputs, *flags))
    out = out.where(wanted) if flags else out
    names = [
        f"{_statistics(s, h)[stat]} AS recent_{h}_{s}_{stat}"
        for h in HORIZONS
        for s in chosen
        for stat in SPLIT_STATS[s]
    ]
    return out.select(*ordered.columns, "is_holiday", *[F.expr(n) for n in names])


def add_recent_features(
    df: DataFrame,
    target: str = "Sales",
    splits: list[str] | None = None,
    split_key: str = "source_row",
    lag_days: int = LAG_DAYS,
) -> DataFrame:
    """Add ``is_holiday`` and the ``recent_*`` columns (144 for all five splits).

    ``split_key="source_row"`` (default): row D carries the block of the store's row at
    D - 30, computed with that row's weekday, promotion and holiday; without such a row
    everything is null.  ``"target_row"``: the frame ends at D - 30 as well, but holds the
    rows that share the key of row D itself.
    """
    return recent_columns(by_store(df).sortWithinPartitions("Store", "Date"), target, splits, split_key, lag_days)
