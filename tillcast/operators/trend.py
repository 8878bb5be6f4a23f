"""Monthly trend features: growth against last year and ridge trends in closed form.

Every store-month looks back from its first day present, ``s``.  The history of a month is the difference of two running
totals of its store's moments (counts, sums, products of positive sales), read at the edges of the range.  So a row
costs a constant, no history row is copied, and everything happens in the partition that holds the store: no join and no
shuffle beyond the one by store.  Spark sorts the rows by store and day; they are read in that order as Arrow batches,
one held at a time with the days of its first store that its months reach back to.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.functions.scalars import epoch_day
from tillcast.operators.events import first_date
from tillcast.session import by_store

GAP = 30                      # days between the history and the month
RIDGE_DAYS = {"q": 90, "y": 365}
YOY_DAYS, YEAR = 30, 365
MIN_HISTORY = 10
NO_DAY = -1_000_000
ALPHA = 1.0
REGRESSORS = ("day", "dow", "promo")
TREND_COLUMNS = (
    "trend_q_pred", "trend_y_pred", "trend_q_slope", "trend_y_slope",
    "trend_q_dow_coef", "trend_q_promo_coef", "trend_yoy",
)

_PAIRS = [(a, b) for i, a in enumerate(REGRESSORS) for b in REGRESSORS[i:]]
# Sums of all positive sales, and of those whose regressors are known.
_SUMS = (
    "all_n", "all_y", "n", "y", *REGRESSORS, *[f"{a}_{b}" for a, b in _PAIRS], *[f"{a}_y" for a in REGRESSORS],
)
# Days before a row that its month's history may begin: a month, the gap, a year and the days compared.
_REACH = 31 + GAP + YEAR + max(YOY_DAYS, *RIDGE_DAYS.values())
_KIND = pa.struct([(name, pa.float64()) for name in TREND_COLUMNS])


def _divided(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The quotient, absent where the divisor is 0."""
    return np.divide(a, b, out=np.full(np.broadcast(a, b).shape, np.nan), where=b != 0)


class _Totals:
    """Running sums of the moments of each store, for rows in the order of store and day.

    Days count from the store's first, sales from a whole number near the store's mean: small summands keep the
    differences of totals exact or nearly so.
    """

    def __init__(self, store: np.ndarray, day: np.ndarray, sales: np.ndarray, dow: np.ndarray, promo: np.ndarray):
        starts = np.flatnonzero(np.concatenate([[True], store[1:] != store[:-1]]))
        lengths = np.diff([*starts, len(store)])
        positive = sales > 0
        counted = np.add.reduceat(positive.astype(float), starts)
        mean = _divided(np.add.reduceat(np.where(positive, sales, 0.0), starts), counted)
        self.centre = np.repeat(np.round(np.nan_to_num(mean)), lengths)
        self.x = {"day": (day - np.repeat(day[starts], lengths)).astype(float), "dow": dow, "promo": promo}
        usable = positive & ~np.isnan(dow) & ~np.isnan(promo)
        y = np.where(positive, sales - self.centre, 0.0)
        x = {name: np.where(usable, value, 0.0) for name, value in self.x.items()}
        used_y = np.where(usable, y, 0.0)
        parts = [positive, y, usable, used_y, *x.values(), *[x[a] * x[b] for a, b in _PAIRS], *[v * used_y for v in x.values()]]
        parts = np.stack([p.astype(float) for p in parts])
        # Each store begins with a place of its own, before which there is nothing.
        self.sums = np.zeros((len(parts), len(store) + len(starts)))
        for group, (start, length) in enumerate(zip(starts.tolist(), lengths.tolist())):
            into = self.sums[:, start + group + 1 : start + group + 1 + length]
            np.cumsum(parts[:, start : start + length], axis=1, out=into)
        self.store = store
        self.since = day - day.min() + _REACH
        self.span = int(self.since.max()) + 1
        self.place = store * self.span + self.since

    def between(self, at: np.ndarray, first: int, last: int) -> dict[str, np.ndarray]:
        """Sums over the days from ``first`` to ``last`` days before those of the rows ``at``, of their stores."""
        low = np.searchsorted(self.place, self.place[at] - first, "left")
        high = np.searchsorted(self.place, self.place[at] - last, "right")
        return dict(zip(_SUMS, self.sums[:, high + self.store[at]] - self.sums[:, low + self.store[at]]))


def _growth(totals: _Totals, at: np.ndarray) -> np.ndarray:
    """Mean of the last 30 days of history over that of the same days a year before, less one."""

    def mean(ago: int) -> np.ndarray:
        found = totals.between(at, ago + YOY_DAYS, ago + 1)
        return totals.centre[at] + _divided(found["all_y"], found["all_n"])

    # Only positive sales count, so a year-before mean is positive wherever it exists.
    return mean(GAP) / mean(GAP + YEAR) - 1


def _ridge(found: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Coefficients of standardised ridge (alpha 1, free intercept), absent for a short history.

    With population deviations s_i (1 for a constant regressor) and correlations R, the
    normal equations are (n R + alpha I) w = n c / s; the 3 x 3 system is solved by its
    adjugate.  ``b0 + b_i x_i`` is the fitted line in raw units.
    """
    n = np.where(found["n"] >= MIN_HISTORY, found["n"], np.nan)

    def cov(product: str, a: str, b: str) -> np.ndarray:
        return (n * found[product] - found[a] * found[b]) / (n * n)

    mean = {a: found[a] / n for a in ("y", *REGRESSORS)}
    square = {a: cov(f"{a}_{a}", a, a) for a in REGRESSORS}
    scale = {a: np.sqrt(np.where(v > 0, v, 1.0)) for a, v in square.items()}
    g = {
        (a, b): n * cov(f"{a}_{b}", a, b) / (scale[a] * scale[b]) + (ALPHA if a == b else 0.0) for a, b in _PAIRS
    }
    g |= {(b, a): v for (a, b), v in g.items()}
    right = {a: n * cov(f"{a}_y", a, "y") / scale[a] for a in REGRESSORS}

    def cofactor(a: str, b: str) -> np.ndarray:
        """Signed minor of the symmetric 3 x 3 matrix, by cyclic index shifts."""
        i, j = REGRESSORS.index(a), REGRESSORS.index(b)
        r1, r2 = REGRESSORS[(i + 1) % 3], REGRESSORS[(i + 2) % 3]
        c1, c2 = REGRESSORS[(j + 1) % 3], REGRESSORS[(j + 2) % 3]
        return g[r1, c1] * g[r2, c2] - g[r1, c2] * g[r2, c1]

    k = {(a, b): cofactor(a, b) for a in REGRESSORS for b in REGRESSORS}
    first = REGRESSORS[0]
    determinant = sum(g[first, b] * k[first, b] for b in REGRESSORS)
    out = {f"w_{a}": _divided(sum(k[a, b] * right[b] for b in REGRESSORS), determinant) for a in REGRESSORS}
    out |= {f"b_{a}": out[f"w_{a}"] / scale[a] for a in REGRESSORS}
    return out | {"b0": mean["y"] - sum(out[f"b_{a}"] * mean[a] for a in REGRESSORS)}


def _features(
    store: np.ndarray, day: np.ndarray, month: np.ndarray, sales: np.ndarray, dow: np.ndarray, promo: np.ndarray, new: int
) -> dict[str, np.ndarray]:
    """The trend columns of the rows from ``new`` on; a month's fits are made once, where it opens."""
    totals = _Totals(store, day, sales, dow, promo)
    opens = np.concatenate([[True], (store[1:] != store[:-1]) | (month[1:] != month[:-1])])
    opening = np.maximum.accumulate(np.where(opens, np.arange(len(store)), 0))[new:]
    at, month_of = np.unique(opening, return_inverse=True)
    out = {"trend_yoy": _growth(totals, at)[month_of]}
    for tf, days in RIDGE_DAYS.items():
        fit = {name: v[month_of] for name, v in _ridge(totals.between(at, GAP + days, GAP + 1)).items()}
        line = sum(fit[f"b_{a}"] * totals.x[a][new:] for a in REGRESSORS)
        out[f"trend_{tf}_pred"] = totals.centre[new:] + fit["b0"] + line
        out |= {f"trend_{tf}_slope": fit["w_day"], f"trend_{tf}_dow_coef": fit["w_dow"], f"trend_{tf}_promo_coef": fit["w_promo"]}
    return out


def _read(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
    held: list[np.ndarray] = []
    for batch in batches:
        number, day, month, *others = (c.to_numpy(zero_copy_only=False) for c in batch)
        columns = [number, day.astype(np.int64), month.astype(np.int64), *(c.astype(float) for c in others)]
        new = len(held[0]) if held else 0
        columns = [np.concatenate(pair) for pair in zip(held, columns)] if held else columns
        number, day, *others = columns
        if not len(number):
            yield pa.array([], _KIND)
            continue
        # An absent number differs from itself; its rows are one store all the same.
        unnamed = number != number
        store = np.concatenate([[0], np.cumsum((number[1:] != number[:-1]) & ~(unnamed[1:] & unnamed[:-1]))])
        found = _features(store, day, *others, new)
        yield pa.StructArray.from_arrays([pa.array(found[c], from_pandas=True) for c in TREND_COLUMNS], fields=list(_KIND))
        kept = (store == store[-1]) & (day >= day[-1] - _REACH)
        held = [c[kept] for c in columns]


_read.__annotations__ = {"batches": Iterator[tuple[pa.Array, ...]], "return": Iterator[pa.Array]}


def trend_columns(ordered: DataFrame, origin: Column) -> DataFrame:
    """The work of ``add_trend_features`` on rows placed by store and sorted by store and day."""
    read = F.arrow_udf(_read, f"struct<{', '.join(f'{c}: double' for c in TREND_COLUMNS)}>")
    # Rows without a date come first, in a month of their own.
    day, month = F.coalesce(epoch_day("Date"), F.lit(NO_DAY)), F.coalesce(F.year("Date") * 12 + F.month("Date"), F.lit(NO_DAY))
    inputs = [F.col("Store"), day, month, *[F.col(c).cast("double") for c in ("Sales", "DayOfWeek", "Promo")]]
    # What it gives a row depends on the rows before, so no later filter may go ahead of it.
    out = ordered.withColumn("_trend", read.asNondeterministic()(*inputs))
    return out.select(
        *[c for c in ordered.columns if c not in ("day_number", *TREND_COLUMNS)],
        F.datediff(F.col("Date"), origin).cast("double").alias("day_number"),
        *[F.col(f"_trend.{c}") for c in TREND_COLUMNS],
    )


def trend_blocks(placed: DataFrame, origin: Column) -> DataFrame:
    """The work of ``add_trend_features`` on rows already placed by store."""
    return trend_columns(placed.sortWithinPartitions("Store", "Date"), origin)


def add_trend_features(df: DataFrame, origin: Column | None = None) -> DataFrame:
    """Add ``day_number`` and the seven ``trend_*`` columns."""
    return trend_blocks(by_store(df), first_date(df) if origin is None else origin)
