"""Daily store panel, store attributes and scoring rows derived from order lines.

``Store`` is the supplier and ``Date`` the ship date.  Lines are added up per store, day and
order first (the distinct orders need that), then per store and day; both steps combine
map-side and deal by more than the store, so a store with a large share of all lines never
meets in one task.  Afterwards a store has at most one row per calendar day, which bounds
every per-store window in this package by the length of the calendar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillcast.session import by_store

PROMO_DISCOUNT = 8  # percent
SCORING_DAYS = 42


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def calendar_bounds(spark: SparkSession, folder: str) -> tuple[Column, Column]:
    """First and last ship date, both read from one scalar subquery over one narrow scan."""
    first, last = F.to_date(F.min("l_shipdate")).alias("first"), F.to_date(F.max("l_shipdate")).alias("last")
    bounds = read_table(spark, folder, "lineitem").agg(F.struct(first, last).alias("bounds")).scalar()
    return bounds.getField("first"), bounds.getField("last")


def _hundredths(col: str) -> Column:
    return F.round(F.col(col) * 100).cast("bigint")


def daily_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Observed store-days: sales in whole currency units, distinct orders, best discount.

    Money is summed as a whole number of 1/10000 units, so the result does not depend
    on the order in which partial sums meet.
    """
    lines = read_table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("Store"),
        F.to_date("l_shipdate").alias("Date"),
        F.col("l_orderkey"),
        _hundredths("l_discount").alias("discount"),
        (_hundredths("l_extendedprice") * (100 - _hundredths("l_discount"))).alias("amount"),
    )
    return lines.groupBy("Store", "Date").agg(
        F.expr("(sum(amount) + 5000) div 10000").cast("double").alias("Sales"),
        F.count_distinct("l_orderkey").cast("int").alias("Customers"),
        (F.max("discount") >= PROMO_DISCOUNT).cast("int").alias("Promo"),
    )


def densify(daily: DataFrame, first_day: Column, last_day: Column) -> DataFrame:
    """One row per store and calendar day between the two bounds.

    Every observed row generates itself and the closed days up to the store's next
    observed day; the first row also generates the days before it.  No calendar join.
    """
    by_day = Window.partitionBy("Store").orderBy("Date")
    # Placed here, the panel and all per-store windows on it keep this explicit width.
    spans = by_store(daily).withColumns(
        {
            "from_day": F.when(F.lag("Date").over(by_day).isNull(), first_day).otherwise(F.col("Date")),
            "to_day": F.coalesce(F.date_sub(F.lead("Date").over(by_day), 1), last_day),
        }
    )
    days = spans.withColumn("calendar_day", F.explode(F.sequence("from_day", "to_day")))
    observed = F.col("calendar_day") == F.col("Date")
    return days.select(
        "Store",
        F.col("calendar_day").alias("Date"),
        F.when(observed, F.col("Sales")).otherwise(F.lit(0.0)).alias("Sales"),
        F.when(observed, F.col("Customers")).otherwise(F.lit(0)).alias("Customers"),
        observed.cast("int").alias("Open"),
        F.when(observed, F.col("Promo")).otherwise(F.lit(0)).alias("Promo"),
    )


def state_holiday() -> Column:
    month, dom = F.month("Date"), F.dayofmonth("Date")
    return F.when((month == 1) & (dom == 1), "a").when((month == 12) & dom.isin(25, 26), "b").otherwise("0")


def calendar_days(spark: SparkSession, folder: str) -> DataFrame:
    """The panel's days, each once, with the texts that depend on the day alone."""
    first_day, last_day = calendar_bounds(spark, folder)
    days = spark.range(1).select(F.explode(F.sequence(first_day, last_day)).alias("Date"))
    return days.select("Date", state_holiday().alias("StateHoliday"))


def with_calendar(panel: DataFrame) -> DataFrame:
    """Weekday and holiday columns that raw retail files carry."""
    return panel.select(
        "Store",
        (F.weekday("Date") + 1).cast("int").alias("DayOfWeek"),
        "Date",
        "Sales",
        "Customers",
        "Open",
        "Promo",
        state_holiday().alias("StateHoliday"),
        F.month("Date").isin(7, 8).cast("int").alias("SchoolHoliday"),
    )


def store_panel(spark: SparkSession, folder: str) -> DataFrame:
    """The dense panel in the layout of the raw train table."""
    first_day, last_day = calendar_bounds(spark, folder)
    return with_calendar(densify(daily_sales(spark, folder), first_day, last_day))


def store_attributes(spark: SparkSession, folder: str) -> DataFrame:
    """Store dimension in the layout of the raw store table; some attributes are absent on purpose."""
    key = F.col("s_suppkey")
    promo2 = (key % 2).cast("int")
    competitor_known = key % 5 != 0
    interval = F.element_at(
        F.array(F.lit("Jan,Apr,Jul,Oct"), F.lit("Feb,May,Aug,Nov"), F.lit("Mar,Jun,Sept,Dec")),
        (key % 3 + 1).cast("int"),
    )
    supplier = read_table(spark, folder, "supplier")
    nation = read_table(spark, folder, "nation")
    region = read_table(spark, folder, "region")
    return (
        supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select(
            key.alias("Store"),
            F.substring(F.lit("abcd"), F.col("r_regionkey") % 4 + 1, F.lit(1)).alias("StoreType"),
            F.substring(F.lit("abc"), (key % 3 + 1).cast("int"), F.lit(1)).alias("Assortment"),
            F.when(key % 10 != 0, F.abs("s_acctbal")).alias("CompetitionDistance"),
            F.when(competitor_known & (key % 7 != 0), (key % 13 + 1).cast("int")).alias("CompetitionOpenSinceMonth"),
            F.when(competitor_known, (key % 15 + 1990).cast("int")).alias("CompetitionOpenSinceYear"),
            promo2.alias("Promo2"),
            F.when(promo2 == 1, (key % 50 + 1).cast("int")).alias("Promo2SinceWeek"),
            F.when(promo2 == 1, (key % 6 + 1994).cast("int")).alias("Promo2SinceYear"),
            F.when(promo2 == 1, interval).alias("PromoInterval"),
        )
    )


def join_store(facts: DataFrame, stores: DataFrame, how: str = "left") -> DataFrame:
    """Attach store attributes.

    Facts are placed by store already, so the join hashes the store rows of each partition.
    Naming that side also keeps the optimizer from broadcasting the facts, whose size it
    can't see behind the generated calendar days.
    """
    return facts.join(stores.hint("shuffle_hash"), "Store", how)


def _scoring_columns(last_day: Column, days: int) -> tuple[Column, dict[str, Column]]:
    """The first scored day, and ``Id`` and ``Open`` of scoring rows.

    ``Id`` is arithmetic on store and day, so it needs no global numbering.
    ``Open`` is absent on some days, as in raw scoring files.
    """
    first_scored = F.date_sub(last_day, days - 1)
    offset = F.datediff("Date", first_scored)
    opened = F.when((F.col("Store") + offset) % 11 != 0, F.col("Open")).cast("double")
    return first_scored, {"Id": F.col("Store") * days + offset + 1, "Open": opened}


def scoring_split(panel: DataFrame, last_day: Column, days: int = SCORING_DAYS) -> tuple[DataFrame, DataFrame]:
    """History rows and the last ``days`` days as rows to score (``Id``, no Sales, no Customers)."""
    first_scored, own = _scoring_columns(last_day, days)
    names = ["Store", "DayOfWeek", "Date", "Open", "Promo", "StateHoliday", "SchoolHoliday"]
    scored = panel.where(F.col("Date") >= first_scored).withColumns(own).select("Id", *names)
    return panel.where(F.col("Date") < first_scored), scored


def scoring_frame(panel: DataFrame, last_day: Column, days: int = SCORING_DAYS) -> DataFrame:
    """Both parts of ``scoring_split`` as one frame, from one panel: history rows have no ``Id``, scoring rows no sales."""
    first_scored, own = _scoring_columns(last_day, days)
    scored = F.col("Date") >= first_scored
    return panel.withColumns(
        {
            "Id": F.when(scored, own["Id"]),
            "Open": F.when(scored, own["Open"]).otherwise(F.col("Open")),
            "Sales": F.when(~scored, F.col("Sales")),
            "Customers": F.when(~scored, F.col("Customers")),
        }
    )
