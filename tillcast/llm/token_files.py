"""Token-id files: documents in ascending id order, ids in range-coded, checksummed blocks.

A file is a Parquet folder that Spark writes and commits, so a lost executor costs a task and
never a part of the result.  One row is a segment of whole documents of one range of ids:

    part, segment   place in the file; part is the task's range, segment counts inside it
    doc_ids         64-bit little-endian integers (with doc_known, one byte each: 0 for a null id)
    doc_tokens      32-bit little-endian counts
    n_tokens        ids in the segment
    sizes, checks   bytes and CRC-32 of each block (see range_coder)
    payload         the coded blocks

Segments close after about ``SEGMENT`` ids, which bounds the memory of a task except for a
single longer document.

Defined results: a null or empty text has only the end id; null document ids come first; rows
of one document id are ordered by a hash of their text; an empty table gives a file without segments.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillcast.llm import range_coder
from tillcast.llm.columns import whole
from tillcast.llm.memo import parts
from tillcast.llm.word_ids import loaded

SEGMENT = 1 << 23

_SEGMENTS = (
    "part int, segment int, doc_ids binary, doc_known binary, doc_tokens binary, n_tokens long, "
    "id_bits int, sizes array<long>, checks array<long>, payload binary"
)
_ARROW = pa.schema(
    [("part", pa.int32()), ("segment", pa.int32()), ("doc_ids", pa.binary()), ("doc_known", pa.binary()),
     ("doc_tokens", pa.binary()), ("n_tokens", pa.int64()), ("id_bits", pa.int32()),
     ("sizes", pa.list_(pa.int64())), ("checks", pa.list_(pa.int64())), ("payload", pa.binary())]
)


def write(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text",
    segment_ids: int = SEGMENT,
) -> None:
    """Encode every whole text, add the end id and write the file in ascending order of the document id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = loaded(tokenizer)
        id_bits = min(8 * words.dtype.itemsize, range_coder.ID_BITS)
        part, segment = TaskContext.get().partitionId(), 0
        keys: list[pa.Array] = []
        counts: list[np.ndarray] = []
        held: list[np.ndarray] = []

        def closed() -> pa.RecordBatch:
            ids = np.concatenate(held)
            payload, sizes, checks = range_coder.encode(ids, id_bits)
            known = pa.concat_arrays(keys)
            row = (
                part, segment, known.fill_null(0).to_numpy().astype("<i8").tobytes(),
                known.is_valid().to_numpy(zero_copy_only=False).tobytes(), np.concatenate(counts).astype("<u4").tobytes(),
                len(ids), id_bits, sizes, checks, payload,
            )
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, _ARROW.types)], schema=_ARROW)

        for batch in batches:
            for rows in parts(batch, most=8_000_000):
                ids, edges = words.encode(rows.column(1), end_id)
                keys.append(rows.column(0))
                counts.append(np.diff(edges))
                held.append(ids)
                if sum(map(len, held)) >= segment_ids:
                    yield closed()
                    keys, counts, held, segment = [], [], [], segment + 1
        if held:
            yield closed()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    # The hash spreads the rows of one document id too.
    order = ["doc_id", F.xxhash64(whole(F.col("text")))]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows.mapInArrow(run, _SEGMENTS).write.parquet(path)


def _read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_SEGMENTS).parquet(path)


def _placed(rows: DataFrame, segments: DataFrame) -> DataFrame:
    """Rows with their place in the whole file, from the ids before their segment.

    Payloads stay where they are read; only the rows made of them are joined.  Totals of the
    parts are added up on the driver: one number for each task of the writer.
    """
    totals = segments.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    before, starts = 0, []
    for row in totals:
        starts.append((row["part"], before))
        before += row["n"]
    parts = rows.sparkSession.createDataFrame(starts, "part int, part_start long")
    earlier = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    places = segments.select("part", "segment", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)).alias("inner"))
    places = places.join(parts, "part").select("part", "segment", (F.col("part_start") + F.col("inner")).alias("before"))
    joined = rows.join(places, ["part", "segment"]).withColumn("start", F.col("before") + F.col("start"))
    return joined.drop("part", "segment", "before")


def _decoded(batch: pa.RecordBatch) -> Iterator[tuple[list[pa.Array], np.ndarray, np.ndarray]]:
    """Part, segment, document ids, starts in the segment; then counts and all ids of each segment."""
    for row in batch.to_pylist():
        ids = range_coder.decode(
            row["payload"], np.array(row["sizes"], np.int64), row["checks"], row["n_tokens"]
        )
        keys = [k if known else None for k, known in zip(np.frombuffer(row["doc_ids"], "<i8").tolist(), row["doc_known"])]
        counts = np.frombuffer(row["doc_tokens"], "<u4").astype(np.int64)
        place = [pa.array(np.full(len(counts), row[c], np.int32)) for c in ("part", "segment")]
        yield [*place, pa.array(keys, pa.int64()), pa.array(np.cumsum(counts) - counts)], counts, ids


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and CRC-32 of the ids of every document, from the file alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place, counts, ids in _decoded(batch):
                ends = np.cumsum(counts).tolist()
                raw = memoryview(ids.astype("<u4").tobytes())
                checks = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends, counts.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [*place, pa.array(counts), pa.array(checks, pa.int64())],
                    ["part", "segment", "doc_id", "start", "n_tokens", "ids_crc32"],
                )

    segments = _read(spark, path)
    digests = "part int, segment int, doc_id long, start long, n_tokens long, ids_crc32 long"
    return _placed(segments.mapInArrow(run, digests), segments).select("doc_id", "start", "n_tokens", "ids_crc32")


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start and ids (array of long) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place, counts, ids in _decoded(batch):
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
                lists = pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int64)))
                yield pa.RecordBatch.from_arrays([*place, lists], ["part", "segment", "doc_id", "start", "ids"])

    segments = _read(spark, path)
    rows = segments.mapInArrow(run, "part int, segment int, doc_id long, start long, ids array<long>")
    return _placed(rows, segments).select("doc_id", "start", "ids")
