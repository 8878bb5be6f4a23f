import datetime as dt
import random

from pyspark.sql import functions as F

from tillcast.functions import scalars
from tillcast.operators import events
from tillcast.session import by_store


def by_offset(df, day, *names):
    return {((r.Date - day(0)).days if df is not None else 0): tuple(r[n] for n in names) for r in df.collect()}


def test_distances(raw, day):
    df = events.with_day(raw([(1, n, dict(Promo=int(n in (2, 5)))) for n in (0, 1, 2, 4, 5, 9)]))
    df = df.withColumns({"since": events.days_since(F.col("Promo") == 1), "until": events.days_until(F.col("Promo") == 1)})
    assert by_offset(df, day, "since", "until") == {
        0: (None, 2), 1: (None, 1), 2: (0, 0), 4: (2, 1), 5: (0, 0), 9: (4, None)
    }


def test_closures(raw, day):
    closed = [0, 2, 4, 5, 6, 7, 8]          # gaps of two days keep the run: seven rows
    closed += [11, 12, 13, 14, 15, 16]      # a gap of three days splits: six rows
    rows = [(1, n, dict(Open=int(n not in closed))) for n in range(20)]
    rows += [(2, n, dict(Open=0)) for n in range(7)]
    df = events.closure_starts(events.with_day(raw(rows))).where("is_refurb_closure = 1")
    assert sorted((r.Store, r.Date) for r in df.collect()) == [(1, day(0)), (2, day(0))]
    runs = events.closure_runs(events.with_day(raw(rows))).collect()
    assert sorted((r.Store, r.closed_rows) for r in runs) == [(1, 6), (1, 7), (2, 7)]


def test_week_sums_at_the_edges(raw, day):
    values = [1, 2, 4, 8, 16, 32, 64, 128, 256, 512, 1024, 2048]
    rows = [(1, n, dict(SchoolHoliday=v)) for n, v in enumerate(values)] + [(2, n, dict(SchoolHoliday=1)) for n in range(7)]
    df = events.week_sums(events.with_day(raw(rows)), "SchoolHoliday", "s")
    long = by_offset(df.where("Store = 1"), day, "s_this_week", "s_last_week", "s_next_week")
    assert long[0] == (15.0, None, 128.0)
    assert long[3][2] == 128 + 256 + 512 + 1024
    assert long[8] == (sum(values[5:]), 3.0, 512 + 1024 + 2048)
    assert long[11][2] is None
    short = by_offset(df.where("Store = 2"), day, "s_last_week", "s_next_week")
    assert set(short.values()) == {(None, None)}


def test_calendar_scalars(spark):
    dates = [dt.date(2012, 12, 31), dt.date(2015, 5, 31), dt.date(2015, 6, 1), dt.date(2015, 12, 31)]
    df = spark.createDataFrame([(d,) for d in dates], "Date date")
    rows = {
        r.Date: r
        for r in events.summer(events.calendar_parts(df)).collect()
    }
    assert rows[dates[0]].week_of_year == 1 and rows[dates[0]].day_of_week == 1
    assert [rows[d].days_into_summer for d in dates[1:]] == [0, 0, 213]
    assert [rows[d].is_summer for d in dates[1:]] == [0, 1, 0]


def test_competition(spark):
    rows = [(None, 3), (2016, 1), (2014, None), (2014, 13), (2014, 12)]
    df = spark.createDataFrame([(dt.date(2015, 1, 1), y, m) for y, m in rows], "Date date, y int, m int")
    got = [r[0] for r in df.select(scalars.days_since_competition("Date", "y", "m")).collect()]
    assert got == [-1, 0, 365, None, 31]


def test_absent_holiday_counts_as_holiday(spark):
    df = spark.createDataFrame([("0",), ("a",), (None,)], "StateHoliday string")
    assert [r[0] for r in df.select(scalars.holiday_flag()).collect()] == [0, 1, 1]


def test_all_columns(raw):
    df = raw([(1, n, {}) for n in range(40)]).withColumns(
        {"Promo2": F.lit(1), "CompetitionOpenSinceYear": F.lit(2010), "CompetitionOpenSinceMonth": F.lit(2)}
    )
    out = events.add_temporal_features(df)
    assert set(out.columns) - set(df.columns) == {*events.TEMPORAL_COLUMNS, "state_holiday_flag"}
    assert len(events.TEMPORAL_COLUMNS) == 25 and out.count() == 40
    bare = events.add_temporal_features(df.drop("Promo2", "Open", "CompetitionOpenSinceYear"))
    assert not {"days_since_promo2", "is_refurb_closure", "days_since_competition"} & set(bare.columns)


def test_calendar_features_sort_once_each_way(spark, raw, day):
    rows = raw([(store, n, dict(Open=int(n % 11 < 3), Promo=int(n % 5 == 0))) for store in (1, 2) for n in range(60)])
    found = events.ordered_temporal(by_store(rows), F.lit(day(0)))
    # A sort in the order that the rows have already isn't carried out.
    plan = found.sortWithinPartitions("Store", "_day")._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("Sort [") == 2
    got = events.temporal_blocks(by_store(rows), F.lit(day(0)))
    assert "_day" not in got.columns
    starts = got.where("is_refurb_closure = 1").collect()
    assert sorted((r.Store, (r.Date - day(0)).days) for r in starts) == [(s, n) for s in (1, 2) for n in (3, 14, 25, 36, 47)]
    at = got.where(f"Store = 1 and Date = date'{day(20)}'").first()
    assert (at.days_since_refurb, at.days_until_refurb, at.days_since_promo, at.days_until_promo) == (6, 5, 0, 0)


def test_closure_runs_over_random_days(spark, raw, day):
    rng = random.Random(4)
    kept = {(s, n): int(rng.random() > shut) for s, shut in ((1, 0.6), (2, 0.9), (3, 0.2)) for n in range(300) if rng.random() < 0.9}
    rows = raw([(s, n, dict(Open=is_open)) for (s, n), is_open in kept.items()])
    found = events.closure_starts(events.with_day(rows)).where("is_refurb_closure = 1").collect()
    want = set()
    for store in (1, 2, 3):
        run = []
        for n in [*sorted(n for (s, n), is_open in kept.items() if s == store and not is_open), 10_000]:
            if run and n - run[-1] > 2:
                want |= {(store, run[0])} if len(run) >= 7 else set()
                run = []
            run.append(n)
    assert {(r.Store, (r.Date - day(0)).days) for r in found} == want and len(want) > 10
