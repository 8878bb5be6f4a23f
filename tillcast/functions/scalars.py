"""Column expressions shared by the operators.  ANSI mode stays on: risky forms use ``try_``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

EPSILON = 1e-8        # added to denominators of the rolling ratios
PREDICTION_FLOOR = 1e-6
CORRECTION = 0.985


def epoch_day(date: str | Column = "Date") -> Column:
    """Whole days since 1970-01-01: the numeric order key that RANGE frames need."""
    return F.unix_date(date)


def holiday_flag(col: str = "StateHoliday") -> Column:
    """1 for anything but the text '0'; an absent value counts as a holiday."""
    return (~F.col(col).eqNullSafe(F.lit("0"))).cast("int")


def iso_weekday(date: str = "Date") -> Column:
    return (F.weekday(date) + 1).cast("int")


def cycle_position(date: str, origin: Column, length: int) -> Column:
    return F.datediff(F.col(date), origin) % length


def summer_flag(date: str = "Date") -> Column:
    return F.month(date).isin(6, 7, 8).cast("int")


def days_into_summer(date: str = "Date") -> Column:
    """Days since 1 June from June to December, else 0."""
    june = F.make_date(F.year(date), F.lit(6), F.lit(1))
    return F.greatest(F.datediff(F.col(date), june), F.lit(0))


def days_since_competition(date: str, year: str, month: str) -> Column:
    """-1 without a known year, 0 before the opening, null for an impossible month."""
    opening_month = F.coalesce(F.col(month), F.lit(1))
    opening = F.when(
        opening_month.between(1, 12), F.make_date(F.col(year).cast("int"), opening_month.cast("int"), F.lit(1))
    )
    elapsed = F.datediff(F.col(date), opening)
    return F.when(F.col(year).isNull(), -1).when(elapsed < 0, 0).otherwise(elapsed)


def months_between_opening(year: Column, month: Column, since_year: Column, since_month: Column) -> Column:
    return 12 * (year - since_year) + (month - since_month)


def promo_age(year: Column, week: Column, since_year: Column, since_week: Column) -> Column:
    """Months since a long-running promotion began, a week counting a quarter of a month."""
    return 12 * (year - since_year) + (week - since_week) / F.lit(4.0)


def squared_percentage_error(y: Column, pred: Column) -> Column:
    return F.pow((y - pred) / y, F.lit(2.0))


def rmspe(y: str | Column = "y", pred: str | Column = "pred") -> Column:
    """Aggregate: root mean square percentage error over rows with a positive target."""
    y = F.col(y) if isinstance(y, str) else y
    pred = F.col(pred) if isinstance(pred, str) else pred
    return F.sqrt(F.avg(F.when(y > 0, squared_percentage_error(y, pred))))


def harmonic_pair(a: Column, b: Column) -> Column:
    """Unfloored harmonic mean of two predictions; 0 as soon as one of them is 0."""
    return F.when((a == 0) | (b == 0), F.lit(0.0)).otherwise(F.try_divide(F.lit(2.0), 1 / a + 1 / b))


def floored(pred: Column) -> Column:
    """The prediction or the floor; an absent prediction stays absent."""
    return F.when(pred.isNotNull(), F.greatest(pred, F.lit(PREDICTION_FLOOR)))


def harmonic_of(preds: list[Column]) -> Column:
    """Floored harmonic mean of several prediction columns of one row."""
    return F.lit(float(len(preds))) / reduce(lambda total, p: total + p, [1 / floored(p) for p in preds])


def harmonic_agg(pred: str | Column = "pred") -> Column:
    """Aggregate: floored harmonic mean of the predictions of a group."""
    pred = F.col(pred) if isinstance(pred, str) else pred
    return F.count(pred) / F.sum(1 / floored(pred))


def weighted_harmonic(a: Column, b: Column, weight_a: float) -> Column:
    return 1 / (weight_a / floored(a) + (1.0 - weight_a) / floored(b))


def rounded(column: str, digits: int) -> Column:
    """``round`` of a double column, half up: the same numbers, without decimal arithmetic except near a tie or far from zero."""
    scaled = F.col(column) * F.lit(10.0**digits)
    whole = F.floor(scaled + 0.5)
    over = scaled + 0.5 - whole
    clear = (F.abs(scaled) < 1e11) & (over > 1e-3) & (over < 1 - 1e-3)
    return F.when(clear, whole / F.lit(10.0**digits)).otherwise(F.round(column, digits))
