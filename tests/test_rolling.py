"""Rolling statistics against a direct evaluation of every frame."""

import math

import numpy as np
import pytest

from tillcast.operators import rolling

KEYS = {"all": (), "dow": ("dow",), "promo": ("promo",), "holiday": ("hol",), "dow_promo": ("dow", "promo")}


def expected(frame):
    """The eight statistics of a list of sales (None = absent)."""
    x = np.array([v for v in frame if v is not None], dtype=float)
    if len(x) < 2:
        return dict.fromkeys(rolling.FULL_STATS)
    mean, median, std = x.mean(), np.median(x), x.std(ddof=1)
    nonzero = x[x != 0]
    return {
        "mean": mean, "median": median, "std": std,
        "p10": np.quantile(x, 0.1), "p90": np.quantile(x, 0.9),
        "skew": (mean - median) / (std + 1e-8), "cv": std / (mean + 1e-8),
        "harmonic_mean": len(x) / ((1 / nonzero).sum() + 1e-8) if len(nonzero) >= 2 else None,
    }


def close(a, b):
    if a is None or b is None:
        return a is None and b is None
    return math.isclose(a, b, rel_tol=1e-7, abs_tol=1e-6)


@pytest.fixture(scope="module")
def history():
    """Two stores over 800 days: gaps, zero and absent sales, an absent promotion, uneven values."""
    rng = np.random.default_rng(7)
    rows = []
    for store, keep in ((1, 0.95), (2, 0.25)):
        for n in range(800):
            if rng.random() > keep:
                continue
            sales = float(np.round(rng.lognormal(8, 1), 3)) if rng.random() > 0.2 else 0.0
            if rng.random() < 0.03:
                sales = None
            promo = None if rng.random() < 0.02 else int(rng.random() < 0.4)
            rows.append((store, n, dict(Sales=sales, Promo=promo, StateHoliday="a" if rng.random() < 0.03 else "0")))
    return rows


@pytest.mark.parametrize("mode", ["source_row", "target_row"])
def test_every_frame(raw, day, history, mode):
    plain = [
        dict(store=s, n=n, x=o["Sales"], dow=n % 7 + 1, promo=o["Promo"], hol=int(o["StateHoliday"] != "0"))
        for s, n, o in history
    ]
    at = {(r["store"], r["n"]): r for r in plain}
    out = rolling.add_recent_features(raw(history), split_key=mode)
    names = rolling.feature_names()
    assert len(names) == 144 and [c for c in out.columns if c.startswith("recent_")] == names
    got = {(r.Store, (r.Date - day(0)).days): r for r in out.collect()}
    assert got.keys() == at.keys()
    sample = [k for i, k in enumerate(sorted(at)) if i % 5 == 0]
    for store, n in sample:
        source = at.get((store, n - 30)) if mode == "source_row" else at[(store, n)]
        for split, keys in KEYS.items():
            for h, days in rolling.HORIZONS.items():
                if source is None or any(source[k] is None for k in keys):
                    want = dict.fromkeys(rolling.FULL_STATS)
                else:
                    want = expected(
                        [
                            r["x"] for r in plain
                            if r["store"] == store and n - 30 - days < r["n"] <= n - 30
                            and all(r[k] == source[k] for k in keys)
                        ]
                    )
                for stat in rolling.SPLIT_STATS[split]:
                    name = f"recent_{h}_{split}_{stat}"
                    assert close(got[store, n][name], want[stat]), (store, n, name, got[store, n][name], want[stat])


def features_at(df, date, *names):
    row = df.where(df.Date == date).first()
    return [row[n] for n in names]


def test_small_frames(raw, day):
    rows = raw([(1, 0, dict(Sales=0.0)), (1, 1, {}), (1, 2, {}), (1, 30, {}), (1, 31, {}), (1, 32, {}), (1, 40, {})])
    out = rolling.add_recent_features(rows, splits=["all"]).cache()
    assert features_at(out, day(30), "recent_q_all_mean") == [None]  # one observation
    mean, harmonic = features_at(out, day(32), "recent_q_all_mean", "recent_q_all_harmonic_mean")
    assert mean == pytest.approx(200 / 3) and harmonic == pytest.approx(3 / (0.02 + 1e-8))
    assert features_at(out, day(31), "recent_q_all_harmonic_mean") == [None]  # one non-zero sale
    assert features_at(out, day(40), "recent_q_all_mean", "recent_y2_all_p10") == [None, None]  # no row at D - 30


def test_constant_frame_has_zero_spread(raw, day):
    rows = raw([(1, n, dict(Sales=0.1 if n > 100 else 12345.678)) for n in range(400)])
    std, skew, cv = features_at(
        rolling.add_recent_features(rows, splits=["all"]), day(399), "recent_q_all_std", "recent_q_all_skew",
        "recent_q_all_cv",
    )
    assert std == 0.0 and cv == 0.0 and abs(skew) < 1e-3


def test_recent_month_is_never_seen(raw, day):
    rows = [(1, n, dict(Sales=float(n))) for n in range(200)]
    changed = [(s, n, dict(Sales=-1e6) if n > 150 else o) for s, n, o in rows]
    names = rolling.feature_names()
    before, after = (
        rolling.add_recent_features(raw(r)).where(f"Date = date'{day(180)}'").select(*names).first()
        for r in (rows, changed)
    )
    assert before == after and before.recent_q_all_mean is not None


def test_rows_are_sorted_once_and_never_multiplied(raw):
    plan = rolling.add_recent_features(raw([(1, 0, {})]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Sort [") == 1 and "Window" not in plan and "Generate" not in plan


def test_only_wanted_rows_are_worked_out(spark, raw, day, history):
    from pyspark.sql import functions as F

    from tillcast.operators import split
    from tillcast.plans import build

    rows, origin = raw(history), F.lit(day(0))
    asked = split.is_trainable(rows)
    found = build.add_features(rows, origin, wanted=asked)
    names = [c for c in found.columns if c not in ("Store", "Date")]
    few, whole = (
        sorted(map(tuple, split.trainable(df).select("Store", "Date", *names).collect()))
        for df in (found, build.add_features(rows, origin))
    )
    assert str(few) == str(whole) and 0 < len(few) == found.count() < len(history)
    # Struct columns of the other rows are null, so nothing was worked out for them.
    order = rolling.frame_order({"all": []}, {"q": 90}, {"all": ["median", "mean"]}, 30, 0, 2, True)
    read = rows.sortWithinPartitions("Store", "Date").select(asked.alias("asked"), order("Store", F.unix_date("Date"), "Sales", asked).alias("o"))
    assert all((r.o is not None) == bool(r.asked) for r in read.collect())
