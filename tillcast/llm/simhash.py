"""SimHash near-duplicates through tables of distances to pivots.

A text's fingerprint takes each bit that is set in over half of its shingles' hashes.  Equal
fingerprints are one from then on.  Two fingerprints that differ in at most three bits agree on one of
four slices of their bits, so they meet in a bucket of that slice.  A bucket of more than
``LIMIT`` fingerprints is cut again by four slices of the bits that are left, down to buckets of 37 equal
bits; beyond that, its rows are dealt into tiles and each two tiles meet in a task of their own.  So a
bucket that a task holds is bounded whatever the data, and no link is lost.

Inside a bucket each fingerprint has a row of the pivot table: its Hamming distances to fixed reference
fingerprints.  By the triangle inequality no coordinate of two linked rows differs by more than three:
rows are sorted by the first coordinate, which ends each one's comparisons early, the
other coordinates discard pairs by their largest difference, and survivors are compared bit by bit.  A
bucket returns a spanning forest of its links, at most one link a row, which ends in alternating stars.

Results for edge cases.  Null, empty and blank texts have the fingerprint zero, linked like
any other; texts of fewer words than a shingle are one shingle.  Texts are read whole; a task holds the
hashes of about 4 MB of text, or of one longer text.  Repeated rows give a row each and are linked, as are
rows without an id; these don't name a component unless it has no other row.  A bit that is set in exactly
half the hashes is 0.  No rows give no rows.  Columns other than the id and the text aren't read, so their
names can't clash.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.llm.components import components
from tillcast.llm.memo import parts
from tillcast.session import shuffle_width, stored

#: Words of a shingle, the hash's seed, and the largest number of differing bits of a link.
SHINGLE, SEED, RADIUS = 3, 42, 3
#: Rows of a bucket or of two tiles that a task compares.
LIMIT = 4096
#: Reference fingerprints of the pivot tables.
PIVOTS = 16
BATCH_BYTES = 4_000_000
#: Links gathered before the rows they connect are no longer compared.
_FOREST = 500_000
_BITS, _CHUNK = 64, 1 << 16


def _hashes(text: str, size: int) -> Iterator[np.ndarray]:
    """Unsigned hashes of the text's shingles, in chunks; A-Z are lowered."""
    from xxhash import xxh64_intdigest

    # As bytes, a text is lowered and split by just these letters and blanks.
    words = text.encode().lower().split()
    if not words:
        return
    joined = b" ".join(words)
    stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], stops[:-1] + 1])[: max(len(words) - size, 0) + 1]
    stops = stops[min(size, len(words)) - 1 :]
    for i in range(0, len(starts), _CHUNK):
        spans = zip(starts[i : i + _CHUNK].tolist(), stops[i : i + _CHUNK].tolist())
        yield np.array([xxh64_intdigest(joined[j:k], SEED) for j, k in spans], np.uint64)


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """Bits that are set in over half of the hashes of the text's shingles, repeats included."""
    votes, n = np.zeros(_BITS, np.int64), 0
    for hashes in _hashes(text or "", size):
        octets = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int(np.packbits(2 * votes > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id and print, the text's fingerprint as a signed long."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in parts(whole, most=BATCH_BYTES):
                prints = [fingerprint(text, size) for text in batch.column(1).to_pylist()]
                signed = pa.array(np.array(prints, np.uint64).view(np.int64))
                yield pa.RecordBatch.from_arrays([batch.column(0), signed], ["doc_id", "print"])

    schema = T.StructType([docs.select("doc_id").schema[0], T.StructField("print", T.LongType())])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _signed(word: int) -> int:
    return word - (1 << _BITS) if word >> (_BITS - 1) else word


def pivots(n: int) -> np.ndarray:
    """Reference fingerprints: words of a fixed pseudo-random sequence."""
    return np.random.PCG64(SEED).random_raw(n)


def slices(depth: int) -> list[list[int]]:
    """Masks of equal bits by depth: each mask of one depth has RADIUS + 1 extensions, four slices of its free bits."""
    levels = [[0]]
    for _ in range(depth):
        masks = []
        for mask in levels[-1]:
            free = [bit for bit in range(_BITS) if not mask >> bit & 1]
            for i in range(RADIUS + 1):
                masks.append(mask | sum(1 << bit for bit in free[i :: RADIUS + 1]))
        levels.append(masks)
    return levels[1:]


def _bucketed(rows: DataFrame, masks: list[int], parent: Column) -> DataFrame:
    """print, slice (number of the mask) and value (the print's bits under it), for each extension of the parent slice."""
    table = F.array(*(F.lit(_signed(mask)) for mask in masks))
    number = F.explode(F.transform(F.sequence(F.lit(0), F.lit(RADIUS)), lambda i: parent * (RADIUS + 1) + i))
    out = rows.select("print", number.alias("slice"))
    return out.select("print", "slice", F.col("print").bitwiseAND(F.element_at(table, F.col("slice") + 1)).alias("value"))


def _cut(rows: DataFrame, masks: list[list[int]], limit: int) -> DataFrame:
    """Bucket rows: print, slice, value, and the tiles (first, second) that meet; -1 and -1 for a whole bucket."""
    whole = [F.lit(-1).alias("first"), F.lit(-1).alias("second")]
    done, parent = [], F.lit(0)
    for depth, level in enumerate(masks):
        rows = stored(_bucketed(rows, level, parent), "simhash-buckets")
        # Sizes are added up before the shuffle; buckets of one are no candidates.
        sizes = rows.groupBy("slice", "value").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
        sized = rows.join(sizes, ["slice", "value"])
        done.append(sized.where(F.col("n") <= limit).select("print", F.lit(depth).alias("depth"), "slice", "value", *whole))
        large = sized.where(F.col("n") > limit)
        if depth + 1 < len(masks):
            rows, parent = stored(large.select("print", "slice"), "simhash-large"), F.col("slice")
            if rows.isEmpty():
                break
            continue
        tiles = F.ceil(2 * F.col("n") / limit).cast("int")
        tile = F.pmod(F.xxhash64("print"), tiles).cast("int")
        other = F.explode(F.sequence(F.lit(0), tiles - 1))
        met = large.select("print", "slice", "value", tile.alias("tile"), other.alias("other"))
        done.append(
            met.select("print", F.lit(depth).alias("depth"), "slice", "value", F.least("tile", "other").alias("first"),
                       F.greatest("tile", "other").alias("second"))
        )
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _roots(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The smallest place each of n places is linked to, directly or not."""
    root = np.arange(n)
    while True:
        ru, rv = root[u], root[v]
        apart = ru != rv
        if not apart.any():
            return root
        u, v, ru, rv = u[apart], v[apart], ru[apart], rv[apart]
        np.minimum.at(root, np.maximum(ru, rv), np.minimum(ru, rv))
        while (root != root[root]).any():
            root = root[root]


def forest(prints: np.ndarray, stops: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is within ``radius`` inside buckets, a spanning forest as (place, place).

    ``prints`` are unsigned, bucket after bucket and in each by distance to the first pivot; ``stops`` has the
    end of each row's bucket.
    """
    n = len(prints)
    table = np.bitwise_count(prints[None, :] ^ pivots(PIVOTS)[:, None]).astype(np.int8)
    root = np.arange(n)
    us, vs, held = [], [], 0
    active, step = np.arange(n), 0
    while len(active):
        step += 1
        active = active[active + step < stops[active]]
        # Rows ascend by the first coordinate: beyond the radius no later row of the bucket is near.
        active = active[table[0][active + step] - table[0][active] <= radius]
        near = active[root[active] != root[active + step]]
        for coordinate in table[1:]:
            near = near[np.abs(coordinate[near] - coordinate[near + step]) <= radius]
        near = near[np.bitwise_count(prints[near] ^ prints[near + step]) <= radius]
        if len(near):
            us.append(near)
            vs.append(near + step)
            held += len(near)
        if held > _FOREST:
            root = _roots(n, np.concatenate([root, *us]), np.concatenate([np.arange(n), *vs]))
            us, vs, held = [], [], 0
    root = _roots(n, np.concatenate([root, *us]), np.concatenate([np.arange(n), *vs]))
    linked = np.flatnonzero(root != np.arange(n))
    return linked, root[linked]


def links(prints: DataFrame, limit: int | None = None, radius: int = RADIUS) -> DataFrame:
    """Pairs (u, v) of distinct fingerprints whose chains connect all that differ in at most ``radius`` bits."""
    buckets = _cut(prints, slices(3), limit or LIMIT)
    reference = F.lit(_signed(int(pivots(1)[0])))
    near = F.bit_count(F.col("print").bitwiseXOR(reference)).alias("near")
    key = ["depth", "slice", "value", "first", "second"]
    width = max(shuffle_width(prints.sparkSession), 1)
    met = buckets.select(*key, near, "print").repartition(width, *key).sortWithinPartitions(*key, "near", "print")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for last, batch in _with_last(batches):
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            columns = [held[c].to_numpy() for c in key]
            change = np.zeros(held.num_rows - 1, bool) if held.num_rows else np.zeros(0, bool)
            for c in columns:
                change |= c[1:] != c[:-1]
            edges = np.flatnonzero(change) + 1
            # The last bucket may go on in the next batch.
            ready = held.num_rows if last else int(edges[-1]) if len(edges) else 0
            if not ready:
                continue
            ends = np.concatenate([edges[edges < ready], [ready]])
            stops = np.repeat(ends, np.diff(ends, prepend=0))
            word = held["print"].to_numpy()[:ready]
            held = held.slice(ready)
            u, v = forest(word.view(np.uint64), stops, radius)
            if len(u):
                yield pa.RecordBatch.from_arrays([pa.array(word[u]), pa.array(word[v])], ["u", "v"])

    return met.mapInArrow(run, "u long, v long")


def _with_last(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[bool, pa.RecordBatch]]:
    """Each batch, after whether none follows."""
    before = None
    for batch in batches:
        if before is not None:
            yield False, before
        before = batch
    if before is not None:
        yield True, before


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id, the smallest id in reach, of each row."""
    rows = stored(fingerprints(docs), "simhash-prints")
    distinct = rows.groupBy("print").agg(F.min("doc_id").alias("least"))
    distinct = stored(distinct, "simhash-distinct")
    joined = components(links(distinct.select("print")))
    root = F.coalesce("v", "print")
    placed = distinct.join(joined.withColumnRenamed("u", "print"), "print", "left").select("print", "least", root.alias("root"))
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = placed.join(least, "root").select("print", "component_id")
    hexadecimal = F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint")
    return rows.join(named, "print").select("doc_id", hexadecimal, "component_id")
