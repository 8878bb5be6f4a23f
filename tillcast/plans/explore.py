"""The exploration job: the joined and filled table, and its two parts for evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillcast.operators import exploration, split
from tillcast.sources.panel import join_store


def explored_rows(train: DataFrame, store: DataFrame) -> DataFrame:
    """Open rows with sales, their date parts, filled store attributes and opening times."""
    rows = split.explored(exploration.date_parts(train))
    filled = exploration.fill_typed(exploration.impute_median(store, "CompetitionDistance"))
    return exploration.opening_times(join_store(rows, filled, "inner"))


def build_exploration(train: DataFrame, store: DataFrame, folder: str, fmt: str = "parquet") -> dict[str, str]:
    """Write ``train_store`` and, cut six weeks before the last day, ``train_set`` and ``holdout_set``."""
    spark = train.sparkSession
    paths = {name: f"{folder}/{name}" for name in ("train_store", "train_set", "holdout_set")}

    def write(df: DataFrame, name: str) -> None:
        df.write.mode("overwrite").option("header", True).format(fmt).save(paths[name])

    table = exploration.zero_filled(explored_rows(train, store))
    write(table, "train_store")
    # The parts are cut from the written table, so the rows are built once.
    written = spark.read.schema(table.schema).option("header", True).format(fmt).load(paths["train_store"])
    for name, part in zip(("train_set", "holdout_set"), split.time_split(written, boundary="train")):
        write(part, name)
    return paths
