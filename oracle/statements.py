"""One DuckDB statement per registered query, written against the raw test tables.

The statements restate each operator in plain SQL (calendar cross join, RANGE frames,
range joins, covariances) and share no formula with the Spark code.
"""

from __future__ import annotations

import math

PANEL = """
lines AS (
  SELECT l_suppkey AS Store, CAST(l_shipdate AS DATE) AS Date, l_orderkey,
         CAST(round(l_discount * 100) AS BIGINT) AS discount,
         CAST(round(l_extendedprice * 100) AS BIGINT) * (100 - CAST(round(l_discount * 100) AS BIGINT)) AS amount
  FROM lineitem),
daily AS (
  SELECT Store, Date, CAST((sum(amount) + 5000) // 10000 AS DOUBLE) AS Sales,
         CAST(count(DISTINCT l_orderkey) AS INTEGER) AS Customers,
         CAST(max(discount) >= 8 AS INTEGER) AS Promo
  FROM lines GROUP BY Store, Date),
cal AS (
  SELECT CAST(unnest(generate_series(min(Date), max(Date), INTERVAL 1 DAY)) AS DATE) AS Date FROM daily),
panel AS (
  SELECT s.Store, CAST(isodow(c.Date) AS INTEGER) AS DayOfWeek, c.Date,
         coalesce(d.Sales, 0.0) AS Sales, coalesce(d.Customers, 0) AS Customers,
         CAST(d.Store IS NOT NULL AS INTEGER) AS Open, coalesce(d.Promo, 0) AS Promo,
         CASE WHEN month(c.Date) = 1 AND day(c.Date) = 1 THEN 'a'
              WHEN month(c.Date) = 12 AND day(c.Date) IN (25, 26) THEN 'b' ELSE '0' END AS StateHoliday,
         CAST(month(c.Date) IN (7, 8) AS INTEGER) AS SchoolHoliday
  FROM (SELECT DISTINCT Store FROM daily) s CROSS JOIN cal c
  LEFT JOIN daily d ON d.Store = s.Store AND d.Date = c.Date)"""

STORES = """
stores AS (
  SELECT s_suppkey AS Store, substr('abcd', r_regionkey % 4 + 1, 1) AS StoreType,
         substr('abc', CAST(s_suppkey % 3 AS INTEGER) + 1, 1) AS Assortment,
         CASE WHEN s_suppkey % 10 <> 0 THEN abs(s_acctbal) END AS CompetitionDistance,
         CASE WHEN s_suppkey % 5 <> 0 AND s_suppkey % 7 <> 0 THEN CAST(s_suppkey % 13 + 1 AS INTEGER) END
           AS CompetitionOpenSinceMonth,
         CASE WHEN s_suppkey % 5 <> 0 THEN CAST(s_suppkey % 15 + 1990 AS INTEGER) END AS CompetitionOpenSinceYear,
         CAST(s_suppkey % 2 AS INTEGER) AS Promo2,
         CASE WHEN s_suppkey % 2 = 1 THEN CAST(s_suppkey % 50 + 1 AS INTEGER) END AS Promo2SinceWeek,
         CASE WHEN s_suppkey % 2 = 1 THEN CAST(s_suppkey % 6 + 1994 AS INTEGER) END AS Promo2SinceYear,
         CASE WHEN s_suppkey % 2 = 1 THEN
           CASE s_suppkey % 3 WHEN 0 THEN 'Jan,Apr,Jul,Oct' WHEN 1 THEN 'Feb,May,Aug,Nov' ELSE 'Mar,Jun,Sept,Dec' END
         END AS PromoInterval
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

FILLED = """
filled AS (
  SELECT Store, StoreType, Assortment,
         coalesce(CompetitionDistance, (SELECT quantile_cont(CompetitionDistance, 0.5) FROM stores)) AS CompetitionDistance,
         coalesce(CompetitionOpenSinceMonth, 0) AS CompetitionOpenSinceMonth,
         coalesce(CompetitionOpenSinceYear, 0) AS CompetitionOpenSinceYear, Promo2,
         coalesce(Promo2SinceWeek, 0) AS Promo2SinceWeek, coalesce(Promo2SinceYear, 0) AS Promo2SinceYear,
         coalesce(PromoInterval, 'Unknown') AS PromoInterval
  FROM stores)"""

EXPLORED = """
explored AS (
  SELECT p.*, CAST(year(Date) AS INTEGER) AS Year, CAST(month(Date) AS INTEGER) AS Month,
         CAST(day(Date) AS INTEGER) AS Day, CAST(week(Date) AS INTEGER) AS WeekOfYear,
         Sales / nullif(Customers, 0) AS SalePerCustomer, f.* EXCLUDE (Store),
         12 * (year(Date) - CompetitionOpenSinceYear) + (month(Date) - CompetitionOpenSinceMonth) AS CompetitionOpen,
         CASE WHEN CompetitionOpenSinceYear <> 0 AND CompetitionOpenSinceMonth <> 0 THEN
           12 * (year(Date) - CompetitionOpenSinceYear) + (month(Date) - CompetitionOpenSinceMonth) END
           AS CompetitionOpenKnown,
         12 * (year(Date) - Promo2SinceYear) + CAST(week(Date) - Promo2SinceWeek AS DOUBLE) / 4 AS PromoOpen
  FROM panel p JOIN filled f ON f.Store = p.Store
  WHERE Open <> 0 AND Sales <> 0)"""

DAYS = "days AS (SELECT *, CAST(Date - DATE '1970-01-01' AS INTEGER) AS d FROM panel)"
BOUNDARY = "edge AS (SELECT max(Date) - 42 AS e, max(Date) AS last FROM daily)"


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


# ---------------------------------------------------------------- rolling statistics

_FRAMES = {"q": 90, "h": 180, "y": 365, "y2": 730}
_KEYS = {
    "all": "Store",
    "dow": "Store, DayOfWeek",
    "promo": "Store, Promo",
    "holiday": "Store, is_holiday",
    "dow_promo": "Store, DayOfWeek, Promo",
}


def _recent(split: str, target_row: bool = False, frames: dict[str, int] | None = None) -> str:
    frames = frames or _FRAMES
    full = split != "dow_promo"
    upper = 30 if target_row else 0
    windows, raw, named = [], [], []
    for h, n in frames.items():
        windows.append(
            f"w_{h} AS (PARTITION BY {_KEYS[split]} ORDER BY d "
            f"RANGE BETWEEN {upper + n - 1} PRECEDING AND {upper} PRECEDING)"
            if upper
            else f"w_{h} AS (PARTITION BY {_KEYS[split]} ORDER BY d RANGE BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
        )
        raw += [
            f"count(Sales) OVER w_{h} AS n_{h}",
            f"avg(Sales) OVER w_{h} AS m_{h}",
            f"quantile_cont(Sales, 0.5) OVER w_{h} AS md_{h}",
            f"stddev_samp(Sales) OVER w_{h} AS sd_{h}",
        ]
        p = f"recent_{h}_{split}_"
        named += [
            f"CASE WHEN n_{h} >= 2 THEN m_{h} END AS {p}mean",
            f"CASE WHEN n_{h} >= 2 THEN md_{h} END AS {p}median",
            f"CASE WHEN n_{h} >= 2 THEN round(sd_{h}, 3) END AS {p}std",
            f"CASE WHEN n_{h} >= 2 THEN round((m_{h} - md_{h}) / (sd_{h} + CAST(1e-8 AS DOUBLE)), 6) END AS {p}skew",
        ]
        if full:
            raw += [
                f"quantile_cont(Sales, 0.1) OVER w_{h} AS lo_{h}",
                f"quantile_cont(Sales, 0.9) OVER w_{h} AS hi_{h}",
                f"sum(1 / nullif(Sales, 0)) OVER w_{h} AS r_{h}",
                f"count(nullif(Sales, 0)) OVER w_{h} AS c_{h}",
            ]
            named += [
                f"CASE WHEN n_{h} >= 2 THEN round(lo_{h}, 3) END AS {p}p10",
                f"CASE WHEN n_{h} >= 2 THEN round(hi_{h}, 3) END AS {p}p90",
                f"CASE WHEN n_{h} >= 2 THEN round(sd_{h} / (m_{h} + CAST(1e-8 AS DOUBLE)), 6) END AS {p}cv",
                f"CASE WHEN c_{h} >= 2 THEN round(n_{h} / (r_{h} + CAST(1e-8 AS DOUBLE)), 2) END AS {p}harmonic_mean",
            ]
    base = _with(PANEL, DAYS.replace("SELECT *", "SELECT *, CAST(StateHoliday <> '0' AS INTEGER) AS is_holiday"))
    stats = f"stats AS (SELECT Store, Date, {', '.join(raw)} FROM days WINDOW {', '.join(windows)})"
    names = ", ".join(named)
    if target_row:
        return f"{base}, {stats} SELECT Store, Date, {names} FROM stats"
    return (
        f"{base}, {stats}, named AS (SELECT Store, Date + 30 AS Date, {names} FROM stats) "
        f"SELECT p.Store, p.Date, n.* EXCLUDE (Store, Date) FROM panel p "
        f"LEFT JOIN named n ON n.Store = p.Store AND n.Date = p.Date"
    )


# ---------------------------------------------------------------- events

_EVENTS = """
ev AS (
  SELECT d.*, s.Promo2 FROM days d LEFT JOIN stores s ON s.Store = d.Store)"""


def _since(condition: str) -> str:
    return (
        f"CAST(d - last_value(CASE WHEN {condition} THEN d END IGNORE NULLS) "
        "OVER (PARTITION BY Store ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS INTEGER)"
    )


def _until(condition: str) -> str:
    return (
        f"CAST(first_value(CASE WHEN {condition} THEN d END IGNORE NULLS) "
        "OVER (PARTITION BY Store ORDER BY d ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) - d AS INTEGER)"
    )


_RUNS = """
closed AS (
  SELECT Store, d, CASE WHEN d - lag(d) OVER (PARTITION BY Store ORDER BY d) <= 2 THEN 0 ELSE 1 END AS opens
  FROM days WHERE Open = 0),
runs AS (
  SELECT Store, d, sum(opens) OVER (PARTITION BY Store ORDER BY d) AS run FROM closed),
starts AS (
  SELECT Store, min(d) AS d FROM runs GROUP BY Store, run HAVING count(*) >= 7),
flagged AS (
  SELECT days.*, CAST(starts.d IS NOT NULL AS INTEGER) AS is_refurb_closure
  FROM days LEFT JOIN starts ON starts.Store = days.Store AND starts.d = days.d)"""


def _week_sums(flag: str, prefix: str) -> str:
    return _with(PANEL, DAYS) + f"""
, flags AS (SELECT Store, Date, d, CAST({flag} AS DOUBLE) AS x,
                 row_number() OVER (PARTITION BY Store ORDER BY d) AS rn FROM days)
SELECT Store, Date,
  sum(x) OVER (PARTITION BY Store ORDER BY d ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS {prefix}_this_week,
  sum(x) OVER (PARTITION BY Store ORDER BY d ROWS BETWEEN 13 PRECEDING AND 7 PRECEDING) AS {prefix}_last_week,
  sum(CASE WHEN rn > 7 THEN x END) OVER (PARTITION BY Store ORDER BY d ROWS BETWEEN 1 FOLLOWING AND 7 FOLLOWING)
    AS {prefix}_next_week
FROM flags"""


# ---------------------------------------------------------------- trend

_MONTHS = """
months AS (SELECT Store, date_trunc('month', Date) AS ym, min(d) AS s FROM days GROUP BY ALL)"""


def _ridge(tf: str, n_days: int) -> str:
    """Standardised ridge by covariances and Cramer's rule, on a range join."""
    extra = (
        ", round(w2, 2) AS trend_q_dow_coef, round(w3, 2) AS trend_q_promo_coef" if tf == "q" else ""
    )
    return _with(PANEL, DAYS, _MONTHS) + f"""
, hist AS (
  SELECT m.Store, m.ym, m.s, CAST(h.d - m.s AS DOUBLE) AS x1, CAST(h.DayOfWeek AS DOUBLE) AS x2,
         CAST(h.Promo AS DOUBLE) AS x3, h.Sales AS y
  FROM months m JOIN days h ON h.Store = m.Store AND h.d >= m.s - {n_days + 30} AND h.d < m.s - 30 AND h.Sales > 0),
st AS (
  SELECT Store, ym, s, count(*)::DOUBLE AS n, avg(x1) AS m1, avg(x2) AS m2, avg(x3) AS m3, avg(y) AS my,
    CASE WHEN min(x1) = max(x1) THEN 1 ELSE stddev_pop(x1) END AS s1,
    CASE WHEN min(x2) = max(x2) THEN 1 ELSE stddev_pop(x2) END AS s2,
    CASE WHEN min(x3) = max(x3) THEN 1 ELSE stddev_pop(x3) END AS s3,
    var_pop(x1) AS v1, var_pop(x2) AS v2, var_pop(x3) AS v3,
    covar_pop(x1, x2) AS c12, covar_pop(x1, x3) AS c13, covar_pop(x2, x3) AS c23,
    covar_pop(x1, y) AS c1y, covar_pop(x2, y) AS c2y, covar_pop(x3, y) AS c3y
  FROM hist GROUP BY Store, ym, s HAVING count(*) >= 10),
eq AS (
  SELECT *, n * v1 / (s1 * s1) + 1 AS a11, n * v2 / (s2 * s2) + 1 AS a22, n * v3 / (s3 * s3) + 1 AS a33,
    n * c12 / (s1 * s2) AS a12, n * c13 / (s1 * s3) AS a13, n * c23 / (s2 * s3) AS a23,
    n * c1y / s1 AS b1, n * c2y / s2 AS b2, n * c3y / s3 AS b3 FROM st),
det AS (
  SELECT *, a11 * (a22 * a33 - a23 * a23) - a12 * (a12 * a33 - a23 * a13) + a13 * (a12 * a23 - a22 * a13) AS dt FROM eq),
sol AS (
  SELECT *, (b1 * (a22 * a33 - a23 * a23) - a12 * (b2 * a33 - a23 * b3) + a13 * (b2 * a23 - a22 * b3)) / dt AS w1,
    (a11 * (b2 * a33 - a23 * b3) - b1 * (a12 * a33 - a23 * a13) + a13 * (a12 * b3 - b2 * a13)) / dt AS w2,
    (a11 * (a22 * b3 - b2 * a23) - a12 * (a12 * b3 - b2 * a13) + b1 * (a12 * a23 - a22 * a13)) / dt AS w3 FROM det)
SELECT p.Store, p.Date, round(w1, 2) AS trend_{tf}_slope{extra},
  round(my + w1 * (p.d - sol.s - m1) / s1 + w2 * (p.DayOfWeek - m2) / s2 + w3 * (p.Promo - m3) / s3, 2) AS trend_{tf}_pred
FROM days p LEFT JOIN sol ON sol.Store = p.Store AND sol.ym = date_trunc('month', p.Date)"""


# ---------------------------------------------------------------- stand-in predictors

LAGS = 60


def predictors(n: int = LAGS) -> str:
    """Models 0..49: last sale above zero at least 30 + 7 m days back; 50..: sales exactly 28 + m days back."""
    columns = []
    for m in range(n):
        if m < 50:
            columns.append(
                "coalesce(last_value(nullif(Sales, 0) IGNORE NULLS) OVER (PARTITION BY Store ORDER BY d "
                f"RANGE BETWEEN UNBOUNDED PRECEDING AND {30 + 7 * m} PRECEDING), 0) AS p{m}"
            )
        else:
            columns.append(
                "coalesce(first_value(Sales) OVER (PARTITION BY Store ORDER BY d "
                f"RANGE BETWEEN {28 + m} PRECEDING AND {28 + m} PRECEDING), 0) AS p{m}"
            )
    names = ", ".join(f"p{m}" for m in range(n))
    return f"""
wide AS (SELECT Store, Date, d, Open, Sales, {', '.join(columns)} FROM days),
scored AS (SELECT Store * 100000 + d AS row_id, Open, Sales AS y, {names} FROM wide
           WHERE Date >= (SELECT e FROM edge) AND Open = 1 AND Sales > 0),
preds AS (SELECT row_id, y, CAST(substr(model, 2) AS INTEGER) AS model_id, pred
          FROM (UNPIVOT scored ON {names} INTO NAME model VALUE pred)),
scores AS (SELECT model_id, sqrt(avg(pow((y - pred) / y, 2))) AS rmspe FROM preds GROUP BY model_id),
ranked AS (SELECT model_id, rmspe, row_number() OVER (ORDER BY rmspe, model_id) AS rk FROM scores),
top AS (SELECT * FROM ranked WHERE rk <= 50)"""


_PRED = _with(PANEL, DAYS, BOUNDARY, predictors())
_PAIRS = """
, tp AS (SELECT p.*, t.rk FROM preds p JOIN top t ON t.model_id = p.model_id),
pairs AS (
  SELECT a.model_id AS model_1, b.model_id AS model_2,
         sqrt(avg(pow((a.y - CASE WHEN a.pred = 0 OR b.pred = 0 THEN 0 ELSE 2 / (1 / a.pred + 1 / b.pred) END) / a.y, 2)))
           AS rmspe_ensemble
  FROM tp a JOIN tp b ON b.row_id = a.row_id AND a.rk < b.rk GROUP BY ALL)"""

# The names of the featured frame, built from their parts; a text stays with at most 100 values.
_CANDIDATES = """
shown_texts AS (SELECT p.StateHoliday, s.StoreType, s.Assortment, s.PromoInterval, strftime(p.Date, '%Y-%m-%d') AS DayText
                FROM panel p LEFT JOIN stores s ON s.Store = p.Store),
texts AS (SELECT unnest(['StateHoliday', 'StoreType', 'Assortment', 'PromoInterval', 'DayText']) AS feature,
                 unnest([count(DISTINCT StateHoliday), count(DISTINCT StoreType), count(DISTINCT Assortment),
                         count(DISTINCT PromoInterval), count(DISTINCT DayText)]) AS n FROM shown_texts),
named AS (
  SELECT column_name AS feature FROM (DESCRIBE SELECT * EXCLUDE (Sales, Customers, Open, Store, Date) FROM panel)
  UNION ALL SELECT column_name FROM (DESCRIBE SELECT * EXCLUDE (Store) FROM stores)
  UNION ALL SELECT unnest(['DayText', 'is_holiday', 'day_number'])
  UNION ALL SELECT 'recent_' || h || '_' || s || '_' || t
    FROM (SELECT unnest(['q', 'h', 'y', 'y2']) AS h), (SELECT unnest(['all', 'dow', 'promo', 'holiday', 'dow_promo']) AS s),
         (SELECT unnest(['mean', 'median', 'std', 'skew', 'p10', 'p90', 'cv', 'harmonic_mean']) AS t)
    WHERE s <> 'dow_promo' OR t IN ('mean', 'median', 'std', 'skew')
  UNION ALL SELECT 'trend_' || unnest(['q_pred', 'y_pred', 'q_slope', 'y_slope', 'q_dow_coef', 'q_promo_coef', 'yoy'])
  UNION ALL SELECT 'day_of_' || unnest(['week', 'month', 'year'])
  UNION ALL SELECT unnest(['week_of_year', 'month', 'year', 'is_summer', 'days_into_summer', 'is_refurb_closure'])
  UNION ALL SELECT 'day_in_' || unnest(['promo', 'promo2']) || '_cycle'
  UNION ALL SELECT 'days_since_' || unnest(['promo', 'promo2', 'school_holiday', 'refurb', 'competition'])
  UNION ALL SELECT 'days_until_' || unnest(['promo', 'school_holiday', 'refurb'])
  UNION ALL SELECT k || '_' || w || '_week' FROM (SELECT unnest(['holidays', 'school_holidays']) AS k),
         (SELECT unnest(['this', 'last', 'next']) AS w)),
cand AS (SELECT feature FROM named WHERE feature NOT IN (SELECT feature FROM texts WHERE n > 100))"""

_SUBSETS = """
, sizes AS (SELECT m AS model_id, 20 + CAST('0x' || substr(md5('42|' || m), 1, 8) AS BIGINT) % 41 AS wanted
            FROM range({n}) t(m)),
turns AS (SELECT model_id, feature, wanted,
            row_number() OVER (PARTITION BY model_id ORDER BY md5('42|' || model_id || '|' || feature), feature) AS turn
          FROM sizes CROSS JOIN cand),
subsets AS (SELECT CAST(model_id AS INTEGER) AS model_id, feature FROM turns WHERE turn <= wanted)"""

FAMILY_A = (0, 1, 2, 50, 51)
FAMILY_B = (3, 4, 5, 52, 53)


def _harmonic(ids: tuple[int, ...], table: str) -> str:
    inside = ", ".join(str(i) for i in ids)
    return (
        f"SELECT row_id, any_value(y) AS y, count(*) / sum(1 / greatest(pred, CAST(1e-6 AS DOUBLE))) AS pred "
        f"FROM {table} WHERE model_id IN ({inside}) GROUP BY row_id"
    )


_FAMILIES = f"""
, fam_a AS ({_harmonic(FAMILY_A, 'preds')}), fam_b AS ({_harmonic(FAMILY_B, 'preds')}),
crossed AS (SELECT a.row_id, a.y, CAST(0.985 AS DOUBLE) / (CAST(0.5 AS DOUBLE) / greatest(a.pred, CAST(1e-6 AS DOUBLE))
                 + CAST(0.5 AS DOUBLE) / greatest(b.pred, CAST(1e-6 AS DOUBLE))) AS pred
          FROM fam_a a JOIN fam_b b ON b.row_id = a.row_id)"""

_ALL = _with(PANEL, STORES, FILLED, EXPLORED)
_TRAIN = [
    "Store", "DayOfWeek", "Date", "Sales", "Customers", "Open", "Promo", "StateHoliday", "SchoolHoliday",
]
_DIM = [
    "StoreType", "Assortment", "CompetitionDistance", "CompetitionOpenSinceMonth", "CompetitionOpenSinceYear",
    "Promo2", "Promo2SinceWeek", "Promo2SinceYear", "PromoInterval",
]
_CORR = [
    "Store", "DayOfWeek", "Sales", "Customers", "Promo", "SchoolHoliday", "Year", "Month", "Day", "WeekOfYear",
    "SalePerCustomer", "CompetitionDistance", "CompetitionOpenSinceMonth", "CompetitionOpenSinceYear", "Promo2",
    "Promo2SinceWeek", "Promo2SinceYear", "CompetitionOpen", "PromoOpen",
]


def _describe(by: str, label: str) -> str:
    return f"""
SELECT {by} AS {label}, count(Sales) AS count, round(avg(Sales), 4) AS mean, round(stddev_samp(Sales), 2) AS std, min(Sales) AS min,
  max(Sales) AS max, quantile_cont(Sales, 0.25) AS p25, quantile_cont(Sales, 0.5) AS p50,
  quantile_cont(Sales, 0.75) AS p75 FROM explored GROUP BY 1"""


# ---------------------------------------------------------------- forests

_FOREST_FEATURES = [
    "DayOfWeek", "Promo", "SchoolHoliday", "month", "day_of_month", "days_into_summer",
    "recent_q_all_mean", "recent_q_all_p90", "recent_h_all_mean", "recent_y_all_median",
]


def _forest(days: str, learns: str, asked: str, result: str) -> str:
    """Trees drawn by rule, walked row by row, leaves averaged, forecasts per member.

    ``days`` names the rows with their sales, ``learns`` and ``asked`` choose rows of ``feats``.
    """
    frames = {"q": 90, "h": 180, "y": 365}
    windows = ", ".join(
        f"w_{h} AS (PARTITION BY Store ORDER BY d RANGE BETWEEN {n - 1} PRECEDING AND CURRENT ROW)" for h, n in frames.items()
    )
    wanted = {
        "recent_q_all_mean": ("q", "avg(Sales)"), "recent_q_all_p90": ("q", "quantile_cont(Sales, 0.9)"),
        "recent_h_all_mean": ("h", "avg(Sales)"), "recent_y_all_median": ("y", "quantile_cont(Sales, 0.5)"),
    }
    stats = ", ".join(
        f"CASE WHEN count(Sales) OVER w_{h} >= 2 THEN {f} OVER w_{h} END AS {name}" for name, (h, f) in wanted.items()
    )
    filled = ", ".join(f"coalesce(round(CAST({c} AS DOUBLE), 4), -999)" for c in _FOREST_FEATURES)
    n = len(_FOREST_FEATURES)
    places = ", ".join(str(i) for i, c in enumerate(_FOREST_FEATURES) if not c.startswith("recent_q_"))
    return f"""
, lagged AS (SELECT Store, d + 30 AS d, {stats} FROM {days} WINDOW {windows}),
feats AS (
  SELECT p.*, [{filled}] AS x
  FROM (SELECT *, month(Date) AS month, day(Date) AS day_of_month,
          CASE WHEN month(Date) >= 6 THEN Date - make_date(year(Date), 6, 1) ELSE 0 END AS days_into_summer FROM {days}) p
  LEFT JOIN lagged l ON l.Store = p.Store AND l.d = p.d),
known AS (SELECT *, CAST(round(ln(1 + Sales) / CAST(1e-8 AS DOUBLE)) AS BIGINT) AS label FROM feats WHERE {learns}),
asked AS (SELECT * FROM feats WHERE {asked}),
bounds AS (SELECT f, min(x[f + 1]) AS low, max(x[f + 1]) AS high FROM known CROSS JOIN range({n}) r(f) GROUP BY f),
members AS (SELECT 0 AS m, [{', '.join(map(str, range(n)))}] AS fs UNION ALL SELECT 1, [{', '.join(map(str, range(n)))}]
            UNION ALL SELECT 2, [{places}]),
drawn AS (SELECT m, t, i, fs[(5 * t + 3 * i + m + t * i) % len(fs) + 1] AS f, (3 * t + 5 * i + m) % 7 + 1 AS eighth
          FROM members CROSS JOIN range(5) a(t) CROSS JOIN range(7) b(i)),
nodes AS (SELECT m, t, i, drawn.f, low + (high - low) * eighth / 8 AS cut FROM drawn JOIN bounds ON bounds.f = drawn.f),
walkers AS (SELECT Store, Date, x, m, t FROM (SELECT * FROM known UNION ALL SELECT *, NULL FROM asked)
            CROSS JOIN members CROSS JOIN range(5) a(t)),
walk AS (
  SELECT Store, Date, m, t, 0 AS depth, CAST(0 AS BIGINT) AS i, x FROM walkers
  UNION ALL
  SELECT w.Store, w.Date, w.m, w.t, w.depth + 1, CASE WHEN w.x[n.f + 1] <= n.cut THEN 2 * w.i + 1 ELSE 2 * w.i + 2 END, w.x
  FROM walk w JOIN nodes n ON n.m = w.m AND n.t = w.t AND n.i = w.i WHERE w.depth < 3),
ends AS (SELECT Store, Date, m, t, i FROM walk WHERE depth = 3),
leaf AS (SELECT m, t, i, CAST(sum(label) AS DOUBLE) / count(*) AS v FROM ends JOIN known USING (Store, Date)
         WHERE m <> 1 OR month(Date) BETWEEN 5 AND 9 GROUP BY ALL),
overall AS (SELECT m, t, CAST(sum(label) AS DOUBLE) / count(*) AS v FROM ends JOIN known USING (Store, Date)
            WHERE m <> 1 OR month(Date) BETWEEN 5 AND 9 GROUP BY ALL),
single AS (SELECT e.Store, e.Date, e.m, exp(CAST(1e-8 AS DOUBLE) / 5 * sum(coalesce(l.v, o.v))) - 1 AS pred
           FROM ends e JOIN asked a ON a.Store = e.Store AND a.Date = e.Date
           LEFT JOIN leaf l ON l.m = e.m AND l.t = e.t AND l.i = e.i
           JOIN overall o ON o.m = e.m AND o.t = e.t GROUP BY ALL),
wide AS (SELECT Store, Date, max(pred) FILTER (WHERE m = 0) AS combined, max(pred) FILTER (WHERE m = 1) AS season,
                max(pred) FILTER (WHERE m = 2) AS month_ahead,
                CAST(0.985 AS DOUBLE) * 3 / sum(1 / greatest(pred, CAST(1e-6 AS DOUBLE))) AS pred FROM single GROUP BY ALL),
forecast AS (SELECT asked.*, combined, season, month_ahead, pred FROM asked JOIN wide USING (Store, Date))
{result}"""


def _with_recursive(*parts: str) -> str:
    return _with(*parts).replace("WITH ", "WITH RECURSIVE ", 1)


def _featured_tables(scoring: str) -> str:
    """Each table's features see their own frame only: the train rows, or 500 days of context and the target."""
    parts = []
    # Name, first and last day of the frame, first day of the target; sales are known before ``sold``.
    for name, low, high, start in (
        ("train_featured", "DATE '1900-01-01'", "(SELECT last - 43 FROM ends)", "DATE '1900-01-01'"),
        ("holdout_featured", "(SELECT last - 43 - 500 FROM ends)", "(SELECT last FROM ends)", "(SELECT last - 42 FROM ends)"),
        ("test_featured", "(SELECT last - 500 FROM ends)", "(SELECT last + 42 FROM ends)", "(SELECT last + 1 FROM ends)"),
    ):
        frame = f"""
  SELECT *, CASE WHEN Date <= (SELECT last FROM ends) THEN Sales END AS known FROM days WHERE Date BETWEEN {low} AND {high}"""
        parts.append(
            f"""
SELECT '{name}' AS name, count(*) AS total_rows, min(Date) AS first_date, max(Date) AS last_date, sum(known) AS sales,
  count(h) AS with_harmonic, round(sum(md), 2) AS medians, sum(since) AS days_since_promo, count(yoy) AS with_growth,
  sum(day_number) AS day_numbers
FROM (SELECT f.*, l.h, l.md, g.yoy, CAST(f.Date - (SELECT min(Date) FROM ({frame})) AS DOUBLE) AS day_number,
        CAST(f.Date - last_value(CASE WHEN f.Promo = 1 THEN f.Date END IGNORE NULLS)
          OVER (PARTITION BY f.Store ORDER BY f.d ROWS UNBOUNDED PRECEDING) AS INTEGER) AS since
      FROM ({frame}) f
      LEFT JOIN (SELECT Store, d + 30 AS d,
                   CASE WHEN count(nullif(known, 0)) OVER y2 >= 2 THEN 1 END AS h,
                   CASE WHEN count(known) OVER q >= 2 THEN quantile_cont(known, 0.5) OVER q END AS md
                 FROM ({frame}) WINDOW y2 AS (PARTITION BY Store ORDER BY d RANGE BETWEEN 729 PRECEDING AND CURRENT ROW),
                   q AS (PARTITION BY Store ORDER BY d RANGE BETWEEN 89 PRECEDING AND CURRENT ROW)) l
        ON l.Store = f.Store AND l.d = f.d
      LEFT JOIN (SELECT m.Store, m.ym, avg(h.known) FILTER (WHERE h.d >= m.s - 60 AND h.d < m.s - 30)
                   / avg(h.known) FILTER (WHERE h.d >= m.s - 425 AND h.d < m.s - 395) AS yoy
                 FROM (SELECT Store, date_trunc('month', Date) AS ym, min(d) AS s FROM ({frame}) GROUP BY ALL) m
                 JOIN ({frame}) h ON h.Store = m.Store AND h.d >= m.s - 425 AND h.d < m.s - 30 AND h.known > 0 GROUP BY ALL) g
        ON g.Store = f.Store AND g.ym = date_trunc('month', f.Date)) featured
WHERE Date >= {start}"""
        )
    return _with(PANEL, DAYS, "ends AS (SELECT max(Date) - 42 AS last FROM panel)") + " UNION ALL ".join(parts)


_TEXTS = ("StateHoliday", "StoreType", "Assortment", "PromoInterval")
# What each row's features come from.
_FEATURE_STATEMENTS = (
    "recent_all", "recent_dow", "recent_promo", "recent_holiday", "recent_dow_promo", "calendar_parts", "summer_days",
    "promo_cycles", "days_since_events", "days_until_events", "refurb_starts", "days_around_refurb", "competition_days",
    "holiday_week_counts", "school_week_counts", "trend_yoy", "trend_ridge_q", "trend_ridge_y",
)


def _with_result(statement: str) -> str:
    return f"WITH result AS ({statement})\n"


def _ecdf(column: str) -> str:
    return f"""
, counts AS (SELECT CAST({column} AS DOUBLE) AS x, count(*) AS c FROM shown WHERE {column} IS NOT NULL GROUP BY 1)
SELECT round(x, 6) AS x, round(CAST(sum(c) OVER (ORDER BY x) AS DOUBLE) / sum(c) OVER (), 9) AS y FROM counts"""


_SHOWN = ", shown AS (SELECT *, Sales / nullif(Customers, 0) AS SalePerCustomer FROM panel)"


# Poisson(1) steps of the bootstrap's weights.
_POISSON = [int((2**31 - 1) * sum(math.exp(-1) / math.factorial(j) for j in range(k + 1))) for k in range(9)]


def _mean(value: str, keys: str, error: bool = True) -> str:
    shown = f"{keys}, round(avg({value}), 4) AS mean_{value}, count({value}) AS n"
    if not error:
        return f"SELECT {shown} FROM explored GROUP BY ALL"
    weight = " + ".join(f"(u >= {step})::INTEGER" for step in _POISSON)
    return f"""
, hashed AS (SELECT {keys}, {value} AS x,
    CAST('0x' || substr(md5(Store || '|' || strftime(Date, '%Y-%m-%d')), 1, 8) AS BIGINT) % 2147483647 AS h
  FROM explored WHERE {value} IS NOT NULL),
turns AS (SELECT CAST(r AS BIGINT) AS r, r * 48271 % 2147483647 AS a, r * 69621 % 2147483647 AS b FROM range(1, 1001) t(r)),
mixed AS (SELECT * EXCLUDE (h, a, b), (h * a + b) % 2147483647 AS v FROM hashed CROSS JOIN turns),
drawn AS (SELECT * EXCLUDE (v), v * v % 2147483647 AS u FROM mixed),
weighed AS (SELECT * EXCLUDE (u), {weight} AS w FROM drawn),
replicates AS (SELECT {keys}, r, sum(w * x) / sum(w) AS m FROM weighed GROUP BY ALL HAVING sum(w) > 0),
bounds AS (SELECT {keys}, round(quantile_cont(m, 0.025), 4) AS ci_low, round(quantile_cont(m, 0.975), 4) AS ci_high
  FROM replicates GROUP BY ALL),
means AS (SELECT {shown}, round(stddev_samp({value}) / sqrt(count({value})), 4) AS se_{value} FROM explored GROUP BY ALL)
SELECT means.*, ci_low, ci_high FROM means LEFT JOIN bounds USING ({keys})"""


def statements() -> dict[str, str]:
    candidates = _CANDIDATES
    train, dim = ", ".join(f"p.{c}" for c in _TRAIN), ", ".join(f"s.{c}" for c in _DIM)
    subsets = _SUBSETS.format(n=500)
    pred_subsets = _PRED + _PAIRS + "," + STORES + "," + candidates + _SUBSETS.format(n=LAGS)
    top_ids = """
, best AS (SELECT * FROM pairs ORDER BY rmspe_ensemble, model_1, model_2 LIMIT 10),
ids AS (SELECT model_1 AS model_id FROM best UNION SELECT model_2 FROM best),
combined AS (SELECT DISTINCT feature FROM subsets WHERE model_id IN (SELECT model_id FROM ids))"""
    corr_rows = " UNION ALL ".join(
        f"SELECT '{a}' AS column_1, '{b}' AS column_2, "
        f"round(CASE WHEN stddev_pop({a}) > 0 AND stddev_pop({b}) > 0 THEN corr({a}, {b}) END, 6) AS r FROM explored"
        for i, a in enumerate(_CORR)
        for b in _CORR[:i]
    )
    dim_nulls = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM stores"
        for c in ["Store", *_DIM]
    )
    code_tables = "".join(
        f", k_{c} AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code FROM "
        f"(SELECT DISTINCT coalesce({c}, '-999') AS v FROM joined))"
        for c in ("StateHoliday", "StoreType", "Assortment", "PromoInterval")
    )
    code_joins = " ".join(
        f"JOIN k_{c} ON k_{c}.v = coalesce(j.{c}, '-999')"
        for c in ("StateHoliday", "StoreType", "Assortment", "PromoInterval")
    )
    joined = f", joined AS (SELECT {train}, {dim} FROM panel p LEFT JOIN stores s ON s.Store = p.Store)"
    test_cte = """
, scoring AS (
  SELECT Store * 42 + CAST(Date - (SELECT max(Date) - 41 FROM panel) AS BIGINT) + 1 AS Id, Store, DayOfWeek, Date,
    CASE WHEN (Store + (Date - (SELECT max(Date) - 41 FROM panel))) % 11 <> 0 THEN CAST(Open AS DOUBLE) END AS Open,
    Promo, StateHoliday, SchoolHoliday
  FROM panel WHERE Date >= (SELECT max(Date) - 41 FROM panel))"""

    submission = (
        _with(PANEL, DAYS)
        + test_cte
        + f"""
, base AS (SELECT Store, d, CASE WHEN Date >= (SELECT max(Date) - 41 FROM panel) THEN NULL ELSE Sales END AS Sales, Date FROM days),
lagged AS (SELECT Store, Date, {', '.join(
            f"coalesce(last_value(nullif(Sales, 0) IGNORE NULLS) OVER (PARTITION BY Store ORDER BY d RANGE BETWEEN UNBOUNDED PRECEDING AND {30 + 7 * m} PRECEDING), 0) AS p{m}"
            for m in range(5))} FROM base)
SELECT s.Id, CASE WHEN coalesce(s.Open, 1) = 0 THEN 0 ELSE round(CAST(0.985 AS DOUBLE) * 5 / (
  {' + '.join(f'1 / greatest(p{m}, CAST(1e-6 AS DOUBLE))' for m in range(5))}), 6) END AS Sales
FROM scoring s JOIN lagged l ON l.Store = s.Store AND l.Date = s.Date"""
    )

    forest_job = _with_recursive(PANEL, DAYS, BOUNDARY)
    trainable = "Open = 1 AND Sales > 0 AND Date"

    def holdout_forest(result: str) -> str:
        edge = "(SELECT e FROM edge)"
        return forest_job + _forest("days", f"{trainable} < {edge}", f"{trainable} >= {edge}", result)

    first_scored = "(SELECT max(Date) - 41 FROM panel)"
    out = {
        "forest_holdout": holdout_forest(
            "SELECT Store, Date, Sales, round(combined, 2) AS combined, round(season, 2) AS season, "
            "round(month_ahead, 2) AS month_ahead, round(pred, 2) AS pred FROM forecast"
        ),
        "forest_scores": holdout_forest(
            " UNION ALL ".join(
                f"SELECT '{m}' AS model, round(sqrt(avg(pow((Sales - {m}) / Sales, 2))), 8) AS rmspe FROM forecast"
                for m in ("combined", "season", "month_ahead", "pred")
            )
        ),
        "forest_submission": forest_job
        + test_cte
        + f", unsold AS (SELECT * REPLACE (CASE WHEN Date < {first_scored} THEN Sales END AS Sales) FROM days)"
        + _forest(
            "unsold",
            f"{trainable} < {first_scored}",
            f"Date >= {first_scored}",
            "SELECT s.Id, CASE WHEN coalesce(s.Open, 1) = 0 THEN 0 ELSE round(f.pred, 2) END AS Sales "
            "FROM forecast f JOIN scoring s ON s.Store = f.Store AND s.Date = f.Date",
        ),
        "panel_daily": _with(PANEL) + "SELECT * FROM panel",
        "csv_train_scan": _with(PANEL) + "SELECT * FROM panel",
        "csv_store_scan": _with(STORES) + "SELECT * FROM stores",
        "csv_test_scan": _with(PANEL) + test_cte + "SELECT * FROM scoring",
        "panel_store_left_join": _with(PANEL, STORES)
        + f"SELECT {train}, {dim} FROM panel p LEFT JOIN stores s ON s.Store = p.Store",
        "panel_store_inner_join": _with(PANEL, STORES, FILLED)
        + f"SELECT {train}, {dim} FROM panel p JOIN filled s ON s.Store = p.Store",
        "time_split_counts": _with(PANEL)
        + """
, b AS (SELECT max(Date) - 42 AS e FROM panel)
, parts AS (SELECT 'job_train' AS part, * FROM panel WHERE Date < (SELECT e FROM b)
  UNION ALL SELECT 'job_holdout', * FROM panel WHERE Date >= (SELECT e FROM b)
  UNION ALL SELECT 'explore_train', * FROM panel WHERE Date <= (SELECT e FROM b)
  UNION ALL SELECT 'explore_holdout', * FROM panel WHERE Date > (SELECT e FROM b))
SELECT part, count(*) AS total_rows, count(DISTINCT Store) AS stores, min(Date) AS first_date, max(Date) AS last_date
FROM parts GROUP BY part""",
        "context_union_trim": _with(PANEL)
        + test_cte
        + """
, history AS (SELECT * FROM panel WHERE Date < (SELECT max(Date) - 41 FROM panel)),
cut AS (SELECT * FROM history WHERE Date >= (SELECT max(Date) - 500 FROM history)),
u AS (SELECT CAST(NULL AS BIGINT) AS Id, Store, Date, Open, Promo, Sales FROM cut
      UNION ALL SELECT Id, Store, Date, CAST(coalesce(Open, 1) AS INTEGER), Promo, NULL FROM scoring),
seen AS (SELECT *, CAST(Date - last_value(CASE WHEN Promo = 1 THEN Date END IGNORE NULLS) OVER
      (PARTITION BY Store ORDER BY Date ROWS UNBOUNDED PRECEDING) AS INTEGER) AS days_since_promo,
      count(Sales) OVER (PARTITION BY Store) AS context_rows FROM u)
SELECT Id, Store, Date, Open, Sales, days_since_promo, context_rows FROM seen WHERE Id IS NOT NULL""",
        "trainable_rows": _with(PANEL, STORES, BOUNDARY)
        + """
SELECT 'trainable' AS filter, count(*) AS total_rows, sum(Sales) AS sales FROM panel WHERE Open = 1 AND Sales > 0
UNION ALL SELECT 'explored', count(*), sum(Sales) FROM panel WHERE Open <> 0 AND Sales <> 0
UNION ALL SELECT 'closed', count(*), sum(Sales) FROM panel WHERE Open = 0""",
        "recent_all": _recent("all"),
        "recent_dow": _recent("dow"),
        "recent_promo": _recent("promo"),
        "recent_holiday": _recent("holiday"),
        "recent_dow_promo": _recent("dow_promo"),
        "recent_target_row_key": _recent("dow", target_row=True),
        "calendar_parts": _with(PANEL)
        + """
SELECT Store, Date, CAST(isodow(Date) AS INTEGER) AS day_of_week, CAST(day(Date) AS INTEGER) AS day_of_month,
  CAST(week(Date) AS INTEGER) AS week_of_year, CAST(month(Date) AS INTEGER) AS month,
  CAST(year(Date) AS INTEGER) AS year, CAST(dayofyear(Date) AS INTEGER) AS day_of_year FROM panel""",
        "summer_days": _with(PANEL)
        + """
SELECT Store, Date, CAST(month(Date) IN (6, 7, 8) AS INTEGER) AS is_summer,
  CAST(CASE WHEN month(Date) >= 6 THEN Date - make_date(year(Date), 6, 1) ELSE 0 END AS INTEGER) AS days_into_summer
FROM panel""",
        "promo_cycles": _with(PANEL, STORES)
        + """
SELECT p.Store, Date, CAST((Date - (SELECT min(Date) FROM panel)) % 14 AS INTEGER) AS day_in_promo_cycle,
  CAST((Date - (SELECT min(Date) FROM panel)) % 91 AS INTEGER) AS day_in_promo2_cycle
FROM panel p LEFT JOIN stores s ON s.Store = p.Store""",
        "days_since_events": _with(PANEL, STORES, DAYS, _EVENTS)
        + f"""
SELECT Store, Date, {_since('Promo = 1')} AS days_since_promo, {_since('Promo2 = 1')} AS days_since_promo2,
  {_since('SchoolHoliday = 1')} AS days_since_school_holiday FROM ev""",
        "days_until_events": _with(PANEL, DAYS)
        + f"""
SELECT Store, Date, {_until('Promo = 1')} AS days_until_promo,
  {_until('SchoolHoliday = 1')} AS days_until_school_holiday FROM days""",
        "refurb_starts": _with(PANEL, DAYS)
        + """
, closed AS (SELECT Store, Date, d, coalesce(d - lag(d) OVER w > 2, true) AS opens FROM days WHERE Open = 0
             WINDOW w AS (PARTITION BY Store ORDER BY d)),
numbered AS (SELECT *, sum(CAST(opens AS INTEGER)) OVER (PARTITION BY Store ORDER BY d ROWS UNBOUNDED PRECEDING) AS run
             FROM closed),
sized AS (SELECT *, count(*) OVER (PARTITION BY Store, run) AS n FROM numbered)
SELECT Store, Date, CAST(opens AND n >= 7 AS INTEGER) AS is_refurb_closure FROM sized
UNION ALL SELECT Store, Date, 0 FROM days WHERE Open <> 0""",
        "closure_runs": _with(PANEL, DAYS, _RUNS)
        + "SELECT Store, CAST(min(d) AS INTEGER) AS start_day, count(*) AS closed_rows FROM runs GROUP BY Store, run",
        "days_around_refurb": _with(PANEL, DAYS, _RUNS)
        + f"""
SELECT Store, Date, {_since('is_refurb_closure = 1')} AS days_since_refurb,
  {_until('is_refurb_closure = 1')} AS days_until_refurb FROM flagged""",
        "competition_days": _with(PANEL, STORES)
        + """
SELECT p.Store, Date, CAST(CASE WHEN CompetitionOpenSinceYear IS NULL THEN -1
    WHEN coalesce(CompetitionOpenSinceMonth, 1) > 12 THEN NULL
    ELSE greatest(0, Date - try_cast(CompetitionOpenSinceYear || '-' ||
      lpad(CAST(coalesce(CompetitionOpenSinceMonth, 1) AS VARCHAR), 2, '0') || '-01' AS DATE)) END AS INTEGER)
  AS days_since_competition
FROM panel p LEFT JOIN stores s ON s.Store = p.Store""",
        "holiday_week_counts": _week_sums("StateHoliday <> '0'", "holidays"),
        "school_week_counts": _week_sums("SchoolHoliday", "school_holidays"),
        "trend_yoy": _with(PANEL, DAYS, _MONTHS)
        + """
, g AS (SELECT m.Store, m.ym,
    avg(h.Sales) FILTER (WHERE h.d >= m.s - 60 AND h.d < m.s - 30) AS cur,
    avg(h.Sales) FILTER (WHERE h.d >= m.s - 425 AND h.d < m.s - 395) AS prev
  FROM months m JOIN days h ON h.Store = m.Store AND h.d >= m.s - 425 AND h.d < m.s - 30 AND h.Sales > 0 GROUP BY ALL)
SELECT p.Store, p.Date, round(cur / prev - 1, 8) AS trend_yoy,
  CAST(p.Date - (SELECT min(Date) FROM panel) AS DOUBLE) AS day_number
FROM days p LEFT JOIN g ON g.Store = p.Store AND g.ym = date_trunc('month', p.Date)""",
        "trend_ridge_q": _ridge("q", 90),
        "trend_ridge_y": _ridge("y", 365),
        "null_counts": _with(STORES) + dim_nulls,
        "median_impute": _with(STORES, FILLED) + "SELECT Store, CompetitionDistance FROM filled",
        "fill_typed": _with(STORES)
        + """
SELECT Store, StoreType, Assortment, coalesce(CompetitionDistance, 0) AS CompetitionDistance,
  coalesce(CompetitionOpenSinceMonth, 0) AS CompetitionOpenSinceMonth,
  coalesce(CompetitionOpenSinceYear, 0) AS CompetitionOpenSinceYear, Promo2,
  coalesce(Promo2SinceWeek, 0) AS Promo2SinceWeek, coalesce(Promo2SinceYear, 0) AS Promo2SinceYear,
  coalesce(PromoInterval, 'Unknown') AS PromoInterval FROM stores""",
        "null_implication": _with(STORES)
        + """
SELECT 'Promo2SinceWeek' AS column_name, count(*) FILTER (WHERE Promo2SinceWeek IS NULL AND Promo2 <> 0) AS breaks FROM stores
UNION ALL SELECT 'Promo2SinceYear', count(*) FILTER (WHERE Promo2SinceYear IS NULL AND Promo2 <> 0) FROM stores""",
        "closed_and_zero_sales": _with(PANEL)
        + """
SELECT count(*) FILTER (WHERE Open = 0 AND Sales = 0) AS closed_zero_sales,
  count(*) FILTER (WHERE Open <> 0 AND Sales = 0) AS open_zero_sales, count(*) AS total_rows FROM panel""",
        "sunday_stores": _with(PANEL) + "SELECT DISTINCT Store FROM panel WHERE Open = 1 AND DayOfWeek = 7",
        "table_summary": _with(PANEL)
        + """
SELECT count(*) AS total_rows, count(DISTINCT Store) AS stores, min(Date) AS first_date, max(Date) AS last_date FROM panel""",
        "describe_sales": _ALL + _describe("'all'", "scope"),
        "describe_sales_by_type": _ALL + _describe("StoreType", "StoreType"),
        "describe_competition_distance": _with(STORES)
        + """
SELECT 'all' AS scope, count(CompetitionDistance) AS count, round(avg(CompetitionDistance), 4) AS mean,
  round(stddev_samp(CompetitionDistance), 4) AS std, min(CompetitionDistance) AS min, max(CompetitionDistance) AS max,
  round(quantile_cont(CompetitionDistance, 0.25), 6) AS p25, round(quantile_cont(CompetitionDistance, 0.5), 6) AS p50,
  round(quantile_cont(CompetitionDistance, 0.75), 6) AS p75 FROM stores""",
        "sum_by_type": _ALL
        + "SELECT StoreType, CAST(sum(Customers) AS BIGINT) AS Customers, sum(Sales) AS Sales FROM explored GROUP BY StoreType",
        "mean_sales_month_type_promo": _ALL + _mean("Sales", "Month, StoreType, Promo"),
        "mean_customers_month_type_promo": _ALL + _mean("Customers", "Month, StoreType, Promo"),
        "mean_sale_per_customer_month_type_promo": _ALL + _mean("SalePerCustomer", "Month, StoreType, Promo"),
        "mean_dow_month_type": _ALL + _mean("Sales", "DayOfWeek, Month, StoreType"),
        "mean_dow_promo_promo2": _ALL + _mean("Sales", "DayOfWeek, Promo, Promo2", error=False),
        "open_time_means": _ALL
        + """
SELECT StoreType, round(avg(Sales), 4) AS Sales, round(avg(Customers), 6) AS Customers,
  round(avg(PromoOpen), 4) AS PromoOpen, round(avg(CompetitionOpen), 4) AS CompetitionOpen,
  round(avg(CompetitionOpenKnown), 4) AS CompetitionOpenKnown FROM explored GROUP BY StoreType""",
        "ecdf_sales": _with(PANEL) + _SHOWN + _ecdf("Sales"),
        "ecdf_customers": _with(PANEL) + _SHOWN + _ecdf("Customers"),
        "ecdf_sale_per_customer": _with(PANEL) + _SHOWN + _ecdf("SalePerCustomer"),
        "corr_lower_triangle": _ALL + corr_rows,
        "explored_zero_filled": _ALL
        + "SELECT Store, Date, coalesce(PromoInterval, '0') AS PromoInterval, "
        + ", ".join(
            f"round(coalesce(CAST({c} AS DOUBLE), 0), 6) AS {c}"
            for c in ("SalePerCustomer", "CompetitionDistance", "CompetitionOpen", "CompetitionOpenKnown", "PromoOpen")
        )
        + " FROM explored",
        "log_sales_split": _ALL
        + """
, b AS (SELECT max(Date) - 42 AS e FROM explored)
SELECT Store, Date, round(ln(1 + Sales), 8) AS Sales, CASE WHEN Date > (SELECT e FROM b) THEN 'holdout' ELSE 'train' END AS part
FROM explored""",
        "category_codes": _with(PANEL, STORES)
        + joined
        + code_tables
        + " SELECT j.Store, j.Date, "
        + ", ".join(f"k_{c}.code AS {c}" for c in ("StateHoliday", "StoreType", "Assortment", "PromoInterval"))
        + f" FROM joined j {code_joins}",
        "feature_candidates": _with(PANEL, STORES, candidates) + " SELECT feature FROM cand",
        "random_feature_subsets": _with(PANEL, STORES, candidates)
        + subsets
        + """ SELECT model_id, CAST(count(*) AS INTEGER) AS n_features, string_agg(feature, ',' ORDER BY feature) AS features
FROM subsets GROUP BY model_id""",
        "model_scores": _PRED + "SELECT model_id, round(rmspe, 8) AS rmspe FROM scores",
        "top_models": _PRED + "SELECT model_id, round(rmspe, 8) AS rmspe FROM top",
        "best_pairs": _PRED
        + _PAIRS
        + """
SELECT model_1, model_2, round(s1.rmspe, 8) AS rmspe_single1, round(s2.rmspe, 8) AS rmspe_single2,
  round(rmspe_ensemble, 8) AS rmspe_ensemble
FROM pairs JOIN scores s1 ON s1.model_id = model_1 JOIN scores s2 ON s2.model_id = model_2""",
        "combined_features": pred_subsets + top_ids + " SELECT feature FROM combined",
        "month_ahead_features": pred_subsets
        + top_ids
        + " SELECT feature FROM combined WHERE NOT starts_with(feature, 'recent_q_')",
        "season_rows": _with(PANEL, BOUNDARY)
        + """
SELECT Store, Date, Sales, round(ln(1 + Sales), 8) AS log_Sales FROM panel
WHERE Date < (SELECT e FROM edge) AND month(Date) BETWEEN 5 AND 9 AND Open = 1 AND Sales > 0""",
        "final_ensemble": _PRED
        + f", f AS ({_harmonic(FAMILY_A, 'preds')}) SELECT row_id, y, round(pred * CAST(0.985 AS DOUBLE), 6) AS pred FROM f",
        "cross_ensemble": _PRED + _FAMILIES + "SELECT row_id, y, round(pred, 6) AS pred FROM crossed",
        "score_comparison": _PRED
        + _FAMILIES
        + """
, totals AS (
  SELECT 'family_a' AS model, sqrt(avg(pow((y - pred * CAST(0.985 AS DOUBLE)) / y, 2))) AS rmspe, 3 AS pref FROM fam_a
  UNION ALL SELECT 'family_b', sqrt(avg(pow((y - pred * CAST(0.985 AS DOUBLE)) / y, 2))), 2 FROM fam_b
  UNION ALL SELECT 'cross', sqrt(avg(pow((y - pred) / y, 2))), 1 FROM crossed)
SELECT model, round(rmspe, 8) AS rmspe,
  CAST(model = (SELECT model FROM totals ORDER BY rmspe, pref LIMIT 1) AS INTEGER) AS recommended FROM totals""",
        "submission": submission,
        "submission_file": submission,
        "stored_scores": _with_result(
            holdout_forest(
                " UNION ALL ".join(
                    f"SELECT '{m}' AS model, round(sqrt(avg(pow((Sales - {m}) / Sales, 2))), 8) AS value FROM forecast"
                    for m in ("combined", "season", "month_ahead", "pred")
                )
            )
        )
        + "SELECT model, value, format('{:,.5f}', value) AS shown FROM result UNION ALL SELECT 'unscored', NULL, 'N/A'",
        "feature_presence": _with(PANEL, STORES)
        + """
, names AS (SELECT column_name AS feature FROM (DESCRIBE SELECT p.* EXCLUDE (Sales, Customers, Open, Store, Date) FROM panel p)
            UNION ALL SELECT column_name FROM (DESCRIBE SELECT * EXCLUDE (Store) FROM stores)),"""
        + candidates.strip().rstrip(",")
        + """
SELECT c.feature, CAST(n.feature IS NOT NULL AS INTEGER) AS present
FROM (SELECT feature FROM named WHERE feature <> 'DayText' UNION ALL SELECT 'Weather') c LEFT JOIN names n ON n.feature = c.feature""",
        "featured_tables": _featured_tables(test_cte),
        "submission_summary": _with_result(submission)
        + """SELECT count(*) AS total_rows, count(*) FILTER (WHERE Sales = 0) AS zero_rows,
  min(Sales) AS least, max(Sales) AS most FROM result""",
    }
    out["training_matrix"] = (
        _with(PANEL, STORES)
        + f", joined AS (SELECT {train}, {dim}, CAST(p.StateHoliday <> '0' AS INTEGER) AS is_holiday"
        + " FROM panel p LEFT JOIN stores s ON s.Store = p.Store WHERE p.Open = 1 AND p.Sales > 0)"
        + code_tables
        + "".join(f", f_{name} AS ({out[name]})" for name in _FEATURE_STATEMENTS)
        + ", featured AS (SELECT j.*, "
        + ", ".join(f"f_{name}.* EXCLUDE (Store, Date)" for name in _FEATURE_STATEMENTS)
        + " FROM joined j "
        + " ".join(f"JOIN f_{n} ON f_{n}.Store = j.Store AND f_{n}.Date = j.Date" for n in _FEATURE_STATEMENTS)
        + ") SELECT Store, Date, round(ln(1 + Sales), 8) AS log_Sales, "
        + ", ".join(f"k_{c}.code AS {c}" for c in _TEXTS)
        + f", coalesce(CAST(COLUMNS(j.* EXCLUDE (Store, Date, Sales, Customers, Open, {', '.join(_TEXTS)})) AS DOUBLE), -999.0)"
        + f" FROM featured j {code_joins}"
    )
    return out
