import datetime as dt

import pytest

from tillcast.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4, memory="8g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def day():
    """Dates by offset from 2015-01-05, a Monday."""
    return lambda n: dt.date(2015, 1, 5) + dt.timedelta(days=n)


RAW = (
    "Store long, DayOfWeek int, Date date, Sales double, Customers int, Open int, Promo int, "
    "StateHoliday string, SchoolHoliday int"
)


@pytest.fixture
def raw(spark, day):
    """Raw rows from (store, day offset, overrides)."""

    def build(rows):
        full = []
        for store, n, over in rows:
            row = dict(Sales=100.0, Customers=10, Open=1, Promo=0, StateHoliday="0", SchoolHoliday=0) | over
            full.append(
                (store, n % 7 + 1, day(n), row["Sales"], row["Customers"], row["Open"], row["Promo"],
                 row["StateHoliday"], row["SchoolHoliday"])
            )
        return spark.createDataFrame(full, RAW)

    return build
