"""Column helpers the text operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where lambdas refer to it many times."""
    return F.element_at(F.transform(F.array(value), body), 1)


def whole(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def words(text: Column) -> Column:
    """Words between blanks; none for null."""
    return F.array_remove(F.split(whole(text), BLANKS), "")
