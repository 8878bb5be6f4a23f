import numpy as np
import pytest

from tillcast.operators import trend


def ridge(x, y):
    """Standardised ridge with penalty 1 and a free intercept, solved directly."""
    mean, scale = x.mean(0), x.std(0)
    scale[scale == 0] = 1
    z = (x - mean) / scale
    w = np.linalg.solve(z.T @ z + np.eye(x.shape[1]), z.T @ (y - y.mean()))
    return w, lambda rows: y.mean() + ((rows - mean) / scale) @ w


@pytest.mark.parametrize("constant_promo", [False, True])
def test_against_direct_solution(raw, day, constant_promo):
    rng = np.random.default_rng(3)
    rows = []
    for n in range(900):
        if rng.random() < 0.15:
            continue
        promo = 1 if constant_promo else int(rng.random() < 0.4)
        sales = 0.0 if rng.random() < 0.1 else 5000 + 3 * n + 40 * (n % 7) + 700 * promo + rng.normal(0, 150)
        rows.append((1, n, dict(Sales=sales, Promo=promo)))
    got = {(r.Date - day(0)).days: r for r in trend.add_trend_features(raw(rows)).collect()}
    table = np.array([(n, n % 7 + 1, o["Promo"], o["Sales"]) for _, n, o in rows], dtype=float)
    months = {}
    for n in sorted(got):
        months.setdefault((day(n).year, day(n).month), []).append(n)
    checked = 0
    for members in months.values():
        start = members[0]
        for tf, days in (("q", 90), ("y", 365)):
            history = table[(table[:, 0] >= start - days - 30) & (table[:, 0] < start - 30) & (table[:, 3] > 0)]
            if len(history) < 10:
                assert all(got[n][f"trend_{tf}_pred"] is None for n in members)
                continue
            w, predict = ridge(history[:, :3], history[:, 3])
            for n in members:
                row = table[table[:, 0] == n][0, :3]
                assert got[n][f"trend_{tf}_pred"] == pytest.approx(predict(row), rel=1e-8)
                assert got[n][f"trend_{tf}_slope"] == pytest.approx(w[0], rel=1e-6, abs=1e-6)
            if tf == "q":
                assert got[members[0]].trend_q_dow_coef == pytest.approx(w[1], rel=1e-6, abs=1e-6)
                assert got[members[0]].trend_q_promo_coef == pytest.approx(w[2], rel=1e-6, abs=1e-6)
            checked += 1
        current = table[(table[:, 0] >= start - 60) & (table[:, 0] < start - 30) & (table[:, 3] > 0)][:, 3]
        before = table[(table[:, 0] >= start - 425) & (table[:, 0] < start - 395) & (table[:, 3] > 0)][:, 3]
        if len(current) and len(before):
            assert got[members[0]].trend_yoy == pytest.approx(current.mean() / before.mean() - 1)
        else:
            assert got[members[0]].trend_yoy is None
    assert checked > 30


def test_nine_rows_are_too_few(raw, day):
    rows = [(1, n, {}) for n in range(9)] + [(1, 60, {})]
    last = trend.add_trend_features(raw(rows)).where(f"Date = date'{day(60)}'").first()
    assert last.trend_q_pred is None and last.trend_q_slope is None and last.day_number == 60.0


@pytest.mark.parametrize("size", [7, 10_000])
def test_stores_and_months_across_batches(spark, raw, size):
    rng = np.random.default_rng(11)
    rows = {}
    for store, level in ((1, 1e9), (2, 50.0), (3, 4000.0)):
        for n in range(700):
            if rng.random() < 0.9:
                promo = None if rng.random() < 0.05 else int(rng.random() < 0.3)
                rows[store, n] = dict(Sales=None if rng.random() < 0.05 else level + float(rng.integers(0, 40)), Promo=promo)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, size)
    try:
        table = raw([(store, n, over) for (store, n), over in rows.items()])
        together = trend.add_trend_features(table)
        plan = together._jdf.queryExecution().optimizedPlan().toString()
        assert "Window" not in plan and plan.count("Sort [") == 1
        names = ["Store", "Date", *trend.TREND_COLUMNS]
        got = sorted(map(tuple, together.select(*names).collect()))
    finally:
        spark.conf.set(name, before)
    alone = sorted(
        tuple(r) for store in (1, 2, 3) for r in trend.add_trend_features(table.where(f"Store = {store}")).select(*names).collect()
    )
    assert len(got) == len(rows) and sum(r[2] is not None for r in got) > 1500
    for a, b in zip(got, alone):
        assert a[:2] == b[:2]
        assert [x is None for x in a] == [x is None for x in b]
        assert [x for x in a[2:] if x is not None] == pytest.approx([x for x in b[2:] if x is not None], rel=1e-6, abs=1e-6)
