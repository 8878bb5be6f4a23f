"""Shards by fixed virtual slots.

Records are hashed into a fixed number of virtual slots, bytes and rows are added up per slot, and a
versioned map says which shard holds which slot.  A new map gives the largest slots first to the
shard with the fewest bytes.  Rebalancing edits the last map and writes the next version: slots
leave the fullest shards for the emptiest only where that evens the sizes, so few rows move.

The map is a small table (slots times versions) in the shared folder; every version stays readable.

Law ``bytes``: shard sizes are near equal.  Size of a record: UTF-8 bytes of its text plus one.

Defined results: a null text has size 1 and the CRC of no bytes; repeated rows are placed each;
null document ids are hashed with their text; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillcast.llm.columns import whole
from tillcast.session import shared_folder, stored

SLOTS = 8192
#: A rebalanced map is even to this share of the mean.
EVEN = 0.001

_MAP = "version int, virtual_slot int, shard int, bytes long, slot_rows long, first_row long"


def _bytes(text: Column) -> Column:
    return whole(text).cast("binary")


def records(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32 and virtual_slot of every record; texts go no further."""
    raw = _bytes(F.col(f"`{text}`"))
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32")
    )
    # Text and size in the hash spread rows that share an id.
    slot = F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(slots))
    return rows.withColumn("virtual_slot", slot.cast("int"))


def slot_sizes(placed: DataFrame) -> list[tuple[int, int, int]]:
    """(slot, bytes, rows) of the slots in use; at most the fixed number of slots."""
    sums = placed.groupBy("virtual_slot").agg(F.sum("size"), F.count(F.lit(1)))
    return sorted((row[0], row[1], row[2]) for row in sums.collect())


def first_map(sizes: list[tuple[int, int, int]], shards: int) -> dict[int, int]:
    """Largest slot first, always to the shard with the fewest bytes."""
    heap = [(0, shard) for shard in range(shards)]
    out = {}
    for slot, size, _ in sorted(sizes, key=lambda s: (-s[1], s[0])):
        held, shard = heapq.heappop(heap)
        out[slot] = shard
        heapq.heappush(heap, (held + size, shard))
    return out


def rebalanced(old: dict[int, int], sizes: list[tuple[int, int, int]], shards: int, even: float = EVEN) -> dict[int, int]:
    """The map edited for new sizes or another number of shards; a slot moves only where it evens them."""
    size_of = {slot: size for slot, size, _ in sizes}
    out = {slot: old[slot] for slot in size_of if old.get(slot, shards) < shards}
    held = [0] * shards
    for slot, shard in out.items():
        held[shard] += size_of[slot]
    # Slots without a shard: new ones, and those of shards that are gone.
    for slot in sorted(set(size_of) - set(out), key=lambda s: (-size_of[s], s)):
        shard = min(range(shards), key=lambda i: (held[i], i))
        out[slot] = shard
        held[shard] += size_of[slot]
    owned: list[list[tuple[int, int]]] = [[] for _ in range(shards)]
    for slot, shard in out.items():
        owned[shard].append((size_of[slot], slot))
    allowed = even * sum(held) / shards if shards else 0
    while True:
        full, empty = (f(range(shards), key=lambda i: (held[i], -i)) for f in (max, min))
        gap = held[full] - held[empty]
        # The slot nearest to half the gap; moving it must narrow the gap.
        moving = min(owned[full], key=lambda s: (abs(2 * s[0] - gap), s[1]), default=(gap, -1))
        if gap <= allowed or moving[0] >= gap or moving[0] == 0:
            return out
        owned[full].remove(moving)
        owned[empty].append(moving)
        held[full] -= moving[0]
        held[empty] += moving[0]
        out[moving[1]] = empty


def write_map(spark: SparkSession, path: str, version: int, shard_of: dict[int, int], sizes: list[tuple[int, int, int]]) -> None:
    """One version of the map, with the number of rows that lie before each slot in its shard."""
    before: dict[int, int] = {}
    rows = []
    for slot, size, count in sizes:
        shard = shard_of[slot]
        rows.append((version, slot, shard, size, count, before.get(shard, 0)))
        before[shard] = before.get(shard, 0) + count
    spark.createDataFrame(rows, _MAP).coalesce(1).write.parquet(f"{path}/version={version}")


def read_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.schema(_MAP).parquet(f"{path}/version={version}")


def place(placed: DataFrame, slot_map: DataFrame, law: str = "bytes") -> DataFrame:
    """Shard and gapless place in it of every record, by one version of the map.

    The map has at most the fixed number of slots, so it is broadcast.  Rows are numbered inside
    virtual slots only, so a shard is never sorted as a whole.
    """
    inside = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    numbered = placed.withColumn("number", F.row_number().over(inside) - 1)
    joined = numbered.join(F.broadcast(slot_map), "virtual_slot")
    return joined.select(
        "doc_id", "size", "text_crc32", F.lit(law).alias("law"), "shard",
        (F.col("first_row") + F.col("number")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot", F.col("version").alias("map_version"),
    )


def assign(docs: DataFrame, shards: int = 8, doc_id: str = "doc_id", text: str = "text", slots: int = SLOTS) -> DataFrame:
    """All records placed by version 2 of a map: the first one, and the edit that evens what it left."""
    spark = docs.sparkSession
    placed = stored(records(docs, doc_id, text, slots), "shard-records")
    sizes = slot_sizes(placed)
    path = shared_folder(spark, "slot-map")
    first = first_map(sizes, shards)
    write_map(spark, path, 1, first, sizes)
    write_map(spark, path, 2, rebalanced(first, sizes, shards), sizes)
    return place(placed, read_map(spark, path, 2))


def write_shards(docs: DataFrame, slot_map: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", slots: int = SLOTS) -> None:
    """The documents themselves in one folder per shard; each virtual slot is written by one task."""
    raw = _bytes(F.col(f"`{text}`"))
    hashed = F.xxhash64(F.col(f"`{doc_id}`"), F.crc32(raw), (F.octet_length(raw) + 1).cast("long"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(row.alias("row"), F.pmod(hashed, F.lit(slots)).cast("int").alias("virtual_slot"))
    rows = rows.join(F.broadcast(slot_map.select("virtual_slot", "shard")), "virtual_slot")
    rows.repartition("shard", "virtual_slot").write.partitionBy("shard").parquet(path)
