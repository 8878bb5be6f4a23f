"""Calendar, event-distance, closure and holiday-week features.

All windows are per store.  "Last event" reads rows in day order, "next event" reads the
same rows in reverse day order, so both are running frames with constant cost per row; a
frame that reaches forward to the end of the store would be rebuilt for every row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tillcast.functions.scalars import (
    cycle_position,
    days_into_summer,
    days_since_competition,
    epoch_day,
    holiday_flag,
    iso_weekday,
    summer_flag,
)
from tillcast.session import by_store, unpacked

PROMO_CYCLE = 14
PROMO2_CYCLE = 91
CLOSURE_GAP = 2
CLOSURE_ROWS = 7

TEMPORAL_COLUMNS = (
    "day_of_week", "day_of_month", "week_of_year", "month", "year", "day_of_year",
    "day_in_promo_cycle", "days_since_promo", "days_until_promo", "day_in_promo2_cycle", "days_since_promo2",
    "days_since_school_holiday", "days_until_school_holiday", "is_summer", "days_into_summer",
    "is_refurb_closure", "days_since_refurb", "days_until_refurb", "days_since_competition",
    "holidays_this_week", "holidays_last_week", "holidays_next_week",
    "school_holidays_this_week", "school_holidays_last_week", "school_holidays_next_week",
)


def _forward() -> WindowSpec:
    return Window.partitionBy("Store").orderBy("_day")


def _backward() -> WindowSpec:
    return Window.partitionBy("Store").orderBy(F.desc("_day"))


def _up_to_now() -> WindowSpec:
    return _forward().rowsBetween(Window.unboundedPreceding, 0)


def _from_now() -> WindowSpec:
    return _backward().rowsBetween(Window.unboundedPreceding, 0)


def days_since(event: Column) -> Column:
    """Days since the store's last row with the event; 0 on the day, null before the first."""
    return F.col("_day") - F.last(F.when(event, F.col("_day")), ignorenulls=True).over(_up_to_now())


def days_until(event: Column) -> Column:
    """Days to the store's next row with the event; 0 on the day, null after the last."""
    return F.last(F.when(event, F.col("_day")), ignorenulls=True).over(_from_now()) - F.col("_day")


def calendar_parts(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "day_of_week": iso_weekday("Date"),
            "day_of_month": F.dayofmonth("Date"),
            "week_of_year": F.weekofyear("Date"),
            "month": F.month("Date"),
            "year": F.year("Date"),
            "day_of_year": F.dayofyear("Date"),
        }
    )


def first_date(df: DataFrame) -> Column:
    """The frame's own first date, as a scalar subquery over the Date column alone."""
    return df.agg(F.min("Date")).scalar()


def promo_cycles(df: DataFrame, origin: Column | None = None) -> DataFrame:
    """Position in the 14-day and 91-day cycles that start at ``origin`` (default: the frame's first date)."""
    origin = first_date(df) if origin is None else origin
    out = df.withColumn("day_in_promo_cycle", cycle_position("Date", origin, PROMO_CYCLE))
    if "Promo2" in df.columns:
        out = out.withColumn("day_in_promo2_cycle", cycle_position("Date", origin, PROMO2_CYCLE))
    return out


def summer(df: DataFrame) -> DataFrame:
    return df.withColumns({"is_summer": summer_flag("Date"), "days_into_summer": days_into_summer("Date")})


def competition(df: DataFrame) -> DataFrame:
    if not {"CompetitionOpenSinceYear", "CompetitionOpenSinceMonth"} <= set(df.columns):
        return df
    return df.withColumn(
        "days_since_competition",
        days_since_competition("Date", "CompetitionOpenSinceYear", "CompetitionOpenSinceMonth"),
    )


def week_sums(df: DataFrame, flag: str, prefix: str) -> DataFrame:
    """Sums of a daily flag over seven rows around, before and after each row of a store.

    The sum for next week never reads the first seven rows of a store, so it is short at
    the head; a frame without any value gives null.
    """
    value = F.col(flag).cast("double")
    head = F.row_number().over(_forward()) <= 7
    return df.withColumn("_past_head", F.when(~head, value)).withColumns(
        {
            f"{prefix}_this_week": F.sum(value).over(_forward().rowsBetween(-3, 3)),
            f"{prefix}_last_week": F.sum(value).over(_forward().rowsBetween(-13, -7)),
            f"{prefix}_next_week": F.sum("_past_head").over(_forward().rowsBetween(1, 7)),
        }
    ).drop("_past_head")


def holiday_weeks(df: DataFrame) -> DataFrame:
    out = df.withColumn("state_holiday_flag", holiday_flag("StateHoliday"))
    out = week_sums(out, "state_holiday_flag", "holidays")
    return week_sums(out, "SchoolHoliday", "school_holidays") if "SchoolHoliday" in df.columns else out


def closure_starts(df: DataFrame, min_rows: int = CLOSURE_ROWS) -> DataFrame:
    """Add ``is_refurb_closure``: 1 on the first day of a run of at least ``min_rows`` closed rows.

    Closed rows of a store belong to one run while neighbours are at most two days apart.
    The run's length is the difference of the closed rows left at its own start and at the next
    run's, which needs one pass backwards and no grouping by run.
    """
    marked = df.withColumn("_closed_day", F.expr("CASE WHEN Open = 0 THEN _day END"))
    previous = F.expr("lead(_closed_day) IGNORE NULLS OVER (PARTITION BY Store ORDER BY _day DESC)")
    counted = marked.withColumns(
        {
            "_begins": F.col("_closed_day").isNotNull() & (previous.isNull() | (F.col("_day") - previous > CLOSURE_GAP)),
            "_closed_left": F.count("_closed_day").over(_from_now()),
        }
    )
    left_after = F.last(F.when(F.col("_begins"), F.col("_closed_left")), ignorenulls=True).over(
        _backward().rowsBetween(Window.unboundedPreceding, -1)
    )
    length = F.col("_closed_left") - F.coalesce(left_after, F.lit(0))
    return (
        counted.withColumn("_run_rows", length)
        .withColumn("is_refurb_closure", (F.col("_begins") & (F.col("_run_rows") >= min_rows)).cast("int"))
        .drop("_closed_day", "_begins", "_closed_left", "_run_rows")
    )


def closure_runs(df: DataFrame) -> DataFrame:
    """One row per run of closed days: ``(Store, start_day, closed_rows)``.

    The closed rows of a store stay in the partition that already holds the store.
    """
    closed = df.where("Open = 0")
    gap = F.col("_day") - F.lag("_day").over(_forward())
    opens = F.when(gap <= CLOSURE_GAP, 0).otherwise(1)
    return (
        closed.withColumn("_opens", opens)
        .withColumn("_run", F.sum("_opens").over(_up_to_now()))
        .groupBy("Store", "_run")
        .agg(F.min("_day").alias("start_day"), F.count(F.lit(1)).alias("closed_rows"))
        .drop("_run")
    )


def with_day(df: DataFrame) -> DataFrame:
    return df.withColumn("_day", epoch_day("Date"))


def add_temporal_features(df: DataFrame, origin: Column | None = None) -> DataFrame:
    """Add the 25 calendar and event features plus ``state_holiday_flag``."""
    return temporal_blocks(by_store(df), first_date(df) if origin is None else origin)


def temporal_blocks(df: DataFrame, origin: Column) -> DataFrame:
    """The work of ``add_temporal_features`` on rows already placed by store."""
    out = ordered_temporal(df, origin)
    return out if "_day" in df.columns else out.drop("_day")


def ordered_temporal(df: DataFrame, origin: Column) -> DataFrame:
    """``temporal_blocks`` with ``_day``, its rows in the order of store and day, which the planner knows.

    The windows handle a few narrow columns while the row itself travels as one struct.
    Steps are ordered by reading direction, so a store's rows are sorted twice: backward, then forward.
    """
    inputs = [c for c in ("Promo", "Promo2", "SchoolHoliday", "StateHoliday", "Open") if c in df.columns]
    rows = df.select("Store", epoch_day("Date").alias("_day"), *inputs, F.struct(*df.columns).alias("_row"))
    promo = F.col("Promo") == 1
    school = F.col("SchoolHoliday") == 1
    refurb = F.col("is_refurb_closure") == 1
    has_open = "Open" in df.columns

    if has_open:
        rows = closure_starts(rows)
    backward = {"days_until_promo": days_until(promo), "days_until_school_holiday": days_until(school)}
    if has_open:
        backward["days_until_refurb"] = days_until(refurb)
    rows = rows.withColumns(backward)
    forward = {"days_since_promo": days_since(promo), "days_since_school_holiday": days_since(school)}
    if "Promo2" in df.columns:
        forward["days_since_promo2"] = days_since(F.col("Promo2") == 1)
    if has_open:
        forward["days_since_refurb"] = days_since(refurb)
    rows = holiday_weeks(rows.withColumns(forward))

    windowed = [c for c in (*TEMPORAL_COLUMNS, "state_holiday_flag") if c in rows.columns]
    kept = [c for c in df.columns if c not in (*windowed, "_day")]
    out = rows.select("_day", *unpacked(kept), *windowed)
    out = competition(summer(promo_cycles(calendar_parts(out), origin)))
    added = [c for c in (*TEMPORAL_COLUMNS, "state_holiday_flag") if c in out.columns]
    return out.select("_day", *[c for c in kept if c not in added], *added)
