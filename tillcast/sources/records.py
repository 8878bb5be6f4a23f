"""Small tables that survive a killed driver: each record is a write of its own, whole or absent.

A record lies in a folder named by its key and an order number.  Spark moves a finished write into place
last, so a reader sees all of a record or nothing of it, and a later record of the same key replaces an
earlier one without touching it.  Keys are written by one job at a time; different keys may be written together.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FIT = (
    "kind string, model_id int, rounds int, done boolean, rmspe double, losses array<double>, "
    "features array<string>, nodes string, base double, weight double"
)
VERSION = "path string"
_HEAD = "key string, turn int, "


def _found(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return None


class Records:
    """The latest record of each key, in one folder."""

    def __init__(self, spark: SparkSession, folder: str, schema: str):
        self.spark, self.folder, self.schema = spark, folder, _HEAD + schema
        self.turns: dict[str, int] = {}

    def latest(self) -> dict:
        """Whole records by key; there are as many as the job has fits or versions."""
        found = _found(self.spark, f"{self.folder}/*", self.schema)
        if found is None:
            return {}
        rows = found.groupBy("key").agg(F.max_by(F.struct(*found.columns), "turn").alias("r")).select("r.*").collect()
        self.turns |= {r.key: r.turn for r in rows}
        return {r.key: r for r in rows}

    def put(self, key: str, *values) -> None:
        turn = self.turns.get(key, -1) + 1
        row = self.spark.createDataFrame([(key, turn, *values)], self.schema)
        row.coalesce(1).write.parquet(f"{self.folder}/{key}-{turn}-{uuid.uuid4().hex}")
        self.turns[key] = turn


def new_version(folder: str) -> str:
    """A folder for the next version of what ``folder`` holds; nobody reads it before ``switch``."""
    return f"{folder}/versions/{uuid.uuid4().hex}"


def switch(spark: SparkSession, folder: str, version: str) -> None:
    """Make a finished version the current one, by one record."""
    pointer = Records(spark, f"{folder}/current", VERSION)
    pointer.latest()
    pointer.put("current", version)


def current_version(spark: SparkSession, folder: str) -> str:
    found = Records(spark, f"{folder}/current", VERSION).latest()
    if "current" not in found:
        raise FileNotFoundError(f"{folder} holds no finished version")
    return found["current"].path
