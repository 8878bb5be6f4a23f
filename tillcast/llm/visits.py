"""Many askers against many rows without copying the rows: rows stay in parts, askers pass by.

Rows are dealt into parts of bounded size, and every asker goes to every part.  A task holds the rows of one part
and reads the askers as a stream, so its memory doesn't depend on how many there are, and what is
copied are the askers, once for each part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parts_of(rows: int, most: int) -> int:
    return max(1, -(-rows // most))


def passing_by(
    rows: DataFrame,
    deal: str,
    askers: DataFrame,
    parts: int,
    hold: Callable[[pa.Table], object],
    answer: Callable[[object, pa.RecordBatch], Iterable[pa.RecordBatch]],
    schema: str,
    at_once: int,
) -> DataFrame:
    """What ``answer`` yields for each part and each batch of at most ``at_once`` askers.

    ``deal`` names the column whose hash places a row; rows and askers may share columns, which must agree in type, and
    each is given its own and nulls for the others'.  ``hold`` prepares the rows of a part once.  A part without rows
    answers nothing.
    """
    part = F.pmod(F.xxhash64(deal), F.lit(parts)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    placed = rows.withColumns({"_part": part, "_asks": F.lit(False)})
    asking = askers.withColumns({"_part": every, "_asks": F.lit(True)})
    meeting = placed.unionByName(asking, allowMissingColumns=True)
    order = ["_part", "_asks", *[c for c in (deal,) if c in rows.columns]]
    meeting = meeting.repartition(parts, "_part").sortWithinPartitions(*order)

    def visit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, gathered, held = None, [], None
        for batch in batches:
            number = batch.column("_part").to_numpy()
            asks = batch.column("_asks").to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((np.diff(number) != 0) | (asks[1:] != asks[:-1])) + 1
            for start, stop in zip([0, *edges], [*edges, len(number)]):
                if start == stop:
                    continue
                if number[start] != now:
                    now, gathered, held = number[start], [], None
                if not asks[start]:
                    gathered.append(batch.slice(start, stop - start))
                    continue
                if held is None and gathered:
                    held, gathered = hold(pa.Table.from_batches(gathered)), []
                if held is None:
                    continue
                for i in range(start, stop, at_once):
                    yield from answer(held, batch.slice(i, min(at_once, stop - i)))

    return meeting.mapInArrow(visit, schema)
