"""Near-duplicate classes by ProbMinHash.

A document is the weighted set of its shingles of five words, each weighing 1 + ln(count), and two
documents are linked when the probability Jaccard similarity of these sets is 0.8 or more.  With
equal weights that is the ordinary Jaccard similarity; the logarithm keeps a phrase that a text
repeats over and over from outweighing the rest of it.

* Sketch: every shingle is a Poisson process whose rate is its weight; its arrivals fall on
  registers at random, and a register keeps the shingle that came first.  A document stops as
  soon as the next arrivals come later than the first ones of all registers.
* Banding: 40 bands of 5 registers.  A pair at 0.8 shares no band with probability 1.3e-7.
* Verification: in each bucket a pivot is compared with every member by their exact similarity.
  Components of the links so far are formed, and buckets that still hold several components go
  on with pivots of their smallest components, until no bucket holds an untested pair of
  different components.  So a large group of copies costs one comparison for each member, no
  bucket is capped, and no link between components is left out.
* Filters before a comparison: bitmaps of the shingles bound the number that two texts without
  repeats share from above, so pairs below 0.8 are excluded for certain; and two bits of each
  register of both documents must differ in at most 60 registers of 200 (30 are expected at 0.8).
  Registers that differ hold the same shingles many times over in a short text, so their bits
  aren't independent: a pair at 0.8 of 4 shingles and the same 4 with one more would fail with
  probability 9e-5.  Texts of fewer than 32 evenly weighing shingles therefore skip the bits; from
  there on a pair at 0.8 fails with probability 5.5e-8 or less.

Equal texts (by their words) are one node from the start.

Defined results: a text without words (null, empty or blank) is a class of its own; a text of one
to four words is one shingle; rows are classed and kept by their id and text, so unrelated texts under
one id both stay, and rows with a null document id take part like others (``classes`` leaves them out,
``all_classes`` doesn't); repeated rows share a class, and ``keep`` leaves one of them, but rows with
neither id nor words all stay; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm.components import components
from tillcast.llm.memo import parts
from tillcast.session import stored

WORDS, SIMILARITY = 5, 0.8
BANDS, ROWS = 40, 5
REGISTERS = BANDS * ROWS
#: Pivots a bucket tests in one pass; more passes follow while pairs are left.
PIVOTS = 256
#: Registers whose two bits may differ.
MOST_DIFFERENT = 60
#: Texts of fewer shingles skip the filter by these bits; unequal weights count as (sum)^2 / sum of squares.
FEW = 32
#: Bits of a shingle bitmap.
OUTLINE = 2048
#: Shingles of texts compared lately that a task keeps.
REMEMBERED = 2_000_000
_PLANES = -(-REGISTERS // 64)  # longs of a bit plane

_MEASURES = ("size", "plain", "spare", "map")

_BLANK = " \t\n\x0b\x0c\r"
_TO_SPACE = str.maketrans({c: " " for c in _BLANK})
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0x100000001B3 * 0x9E3779B1 & 0xFFFFFFFFFFFFFFFF | 1)


def words_of(text: str | None) -> list[str]:
    return [w for w in (text or "").translate(_TO_SPACE).split(" ") if w]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class Hasher:
    """64-bit hashes of words, remembered up to a bound."""

    def __init__(self, limit: int = 500_000):
        self.limit, self.known = limit, {}

    def __call__(self, words: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > self.limit:
            known.clear()
        for word in set(words).difference(known):
            known[word] = xxhash.xxh3_64_intdigest(word)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def shingles(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles (sorted) of a document's word hashes and their weights."""
    n = len(hashes)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0)
    width = min(WORDS, n)
    rolled = hashes[: n - width + 1].copy()
    for j in range(1, width):
        rolled = rolled * _BASE + hashes[j : n - width + 1 + j]
    rolled = np.sort(_mix(rolled + np.uint64(width)))
    first = np.flatnonzero(np.concatenate([[True], rolled[1:] != rolled[:-1]]))
    return rolled[first], 1 + np.log(np.diff(np.append(first, len(rolled))))


def sketch(sets: list[tuple[np.ndarray, np.ndarray]], registers: int = REGISTERS) -> np.ndarray:
    """(documents, registers): for each register the shingle whose arrival came first.

    All documents advance together.  In a pass each shingle that still matters draws as many
    arrivals as fill the registers about once per document.
    """
    sizes = np.array([len(s) for s, _ in sets])
    out = np.zeros(len(sets) * registers, np.uint64)
    if not sizes.sum():
        return out.reshape(len(sets), registers)
    item = np.concatenate([s for s, _ in sets])
    rate = np.concatenate([w for _, w in sets])
    doc = np.repeat(np.arange(len(sets)), sizes)
    # A shingle's arrivals depend on it and its weight alone, not on the document around it.
    draws = np.maximum(1, np.ceil(registers * np.log(registers) / np.maximum(sizes, 1))).astype(np.int64)[doc]
    first = np.full(len(sets) * registers, np.inf)
    time, drawn = np.zeros(len(item)), np.zeros(len(item), np.uint64)
    while len(item):
        ends = np.cumsum(draws)
        which = np.repeat(np.arange(len(item)), draws)
        number = np.arange(ends[-1]) - np.repeat(ends - draws, draws)
        seed = _mix(item[which] + (drawn[which] + number.astype(np.uint64) + np.uint64(1)) * _GOLD)
        # 40 bits for the waiting time, 24 for the register.
        wait = -np.log(((seed >> np.uint64(24)).astype(float) + 0.5) / 2.0**40) / rate[which]
        total = np.cumsum(wait)
        starts = np.concatenate([[0.0], total[ends[:-1] - 1]])
        at = total - starts[which] + time[which]
        register = ((seed & np.uint64(0xFFFFFF)) * np.uint64(registers) >> np.uint64(24)).astype(np.int64)
        cell = doc[which] * registers + register
        early = np.flatnonzero(at < first[cell])
        cell, when, source = cell[early], at[early], which[early]
        np.minimum.at(first, cell, when)
        won = when == first[cell]
        out[cell[won]] = item[source[won]]
        time = at[ends - 1]
        drawn = drawn + draws.astype(np.uint64)
        latest = first.reshape(-1, registers).max(axis=1)
        going = np.flatnonzero(time < latest[doc])
        item, rate, doc, draws = item[going], rate[going], doc[going], draws[going]
        time, drawn = time[going], drawn[going]
    return out.reshape(len(sets), registers)


def band_keys(sketches: np.ndarray) -> np.ndarray:
    """(documents, bands) 64-bit keys."""
    rows = sketches.reshape(len(sketches), BANDS, ROWS)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * _GOLD, rows.shape[:2]).copy()
    for j in range(ROWS):
        keys = _mix(keys + rows[:, :, j])
    return keys.view(np.int64)


def bit_planes(sketches: np.ndarray) -> np.ndarray:
    """Two bits of each register as (documents, longs): the planes of the one, then those of the other."""
    planes = []
    for shift in (7, 29):
        bits = ((sketches >> np.uint64(shift)) & np.uint64(1)).astype(np.uint8)
        padded = np.zeros((len(sketches), _PLANES * 64), np.uint8)
        padded[:, : bits.shape[1]] = bits
        planes.append(np.packbits(padded, axis=1).view(np.int64))
    return np.concatenate(planes, axis=1)


def _alike(a: Column, b: Column) -> Column:
    """Whether few enough registers differ in their two bits (for texts of at least ``FEW`` shingles)."""
    differ = F.lit(0)
    for i in range(_PLANES):
        one, two = (a[j].bitwiseXOR(b[j]) for j in (i, i + _PLANES))
        differ = differ + F.bit_count(one.bitwiseOR(two))
    return differ <= MOST_DIFFERENT


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact probability Jaccard similarity of two weighted sets."""
    (items_a, x_a), (items_b, x_b) = a, b
    if len(items_a) + len(items_b) == x_a.sum() + x_b.sum():  # all weights are one
        shared = len(np.intersect1d(items_a, items_b, assume_unique=True))
        return shared / max(1, len(items_a) + len(items_b) - shared)
    items = np.union1d(items_a, items_b)
    if not len(items):
        return 0.0
    x, y = np.zeros(len(items)), np.zeros(len(items))
    x[np.searchsorted(items, items_a)] = x_a
    y[np.searchsorted(items, items_b)] = x_b
    with np.errstate(divide="ignore"):
        ratio = y / x
    order = np.argsort(ratio)
    ratio, x, y = ratio[order], x[order], y[order]
    # For a shared item with ratio t: sum of max(x_j, y_j / t) over all items.
    up_to = np.concatenate([[0.0], np.cumsum(x)])
    beyond = np.concatenate([np.cumsum(y[::-1])[::-1], [0.0]])
    shared = np.flatnonzero((x > 0) & (y > 0))
    t = ratio[shared]
    edge = np.searchsorted(ratio, t, side="right")
    return float((x[shared] / (up_to[edge] + beyond[edge] / t)).sum())


def _is_few(weights: np.ndarray) -> bool:
    return bool(weights.sum() ** 2 < FEW * (weights**2).sum())


def _node(words: list[str]) -> bytes:
    return hashlib.md5(" ".join(words).encode(), usedforsecurity=False).digest()


def _sketched(docs: DataFrame) -> DataFrame:
    """doc_id, hash, node (null without words), band keys, bit planes and whether the shingles are few of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = Hasher()
        for batch in batches:
            for part in parts(batch, text=2, most=1_000_000):
                split = [words_of(text) for text in part.column(2).to_pylist()]
                flat = hashed([word for words in split for word in words])
                ends = np.cumsum([len(words) for words in split])
                sets = [shingles(flat[e - len(words) : e]) for e, words in zip(ends, split)]
                sketches = sketch(sets)
                keys, bits = band_keys(sketches), bit_planes(sketches)
                nodes = [_node(words) if words else None for words in split]
                lists = [
                    pa.FixedSizeListArray.from_arrays(pa.array(x.reshape(-1)), x.shape[1]).cast(pa.list_(pa.int64()))
                    for x in (keys, bits)
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(nodes, pa.binary()), *lists, pa.array([_is_few(w) for _, w in sets], pa.bool_())],
                    ["doc_id", "hash", "node", "keys", "bits", "few"],
                )

    return docs.mapInArrow(run, "doc_id long, hash long, node binary, keys array<long>, bits array<long>, few boolean")


def _at() -> Column:
    """Where a row is found: its id, or the hash of its text."""
    return F.coalesce("doc_id", "hash")


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """node and text of the wanted (at, node), one row each."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            same = [_node(words_of(text)) == node for text, node in zip(texts, batch.column(0).to_pylist())]
            yield batch.filter(pa.array(same, pa.bool_()))

    rows = docs.withColumn("at", _at()).join(wanted, "at").select("node", "text").mapInArrow(own, "node binary, text string")
    return rows.dropDuplicates(["node"])


def _linked(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs (u, v) whose exact similarity reaches ``least``.  A pivot with many pairs is split by the skew join."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = Hasher()
        known: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}
        held = 0

        def weighted(node: bytes, text: str) -> tuple[np.ndarray, np.ndarray]:
            nonlocal held
            found = known.get(node)
            if found is None:
                found = shingles(hashed(words_of(text)))
                held += len(found[0])
                if held > REMEMBERED:
                    known.clear()
                    held = len(found[0])
                known[node] = found
            return found

        for batch in batches:
            u, v, a, b = (batch.column(i) for i in range(4))
            linked = []
            for u_i, v_i, a_i, b_i in zip(u.to_pylist(), v.to_pylist(), a, b):
                one = known.get(u_i) or weighted(u_i, a_i.as_py())
                two = known.get(v_i) or weighted(v_i, b_i.as_py())
                linked.append(similarity(one, two) >= least - 1e-12)
            yield batch.select([0, 1]).filter(pa.array(linked, pa.bool_()))

    left = texts.select(F.col("node").alias("u"), F.col("text").alias("a"))
    right = texts.select(F.col("node").alias("v"), F.col("text").alias("b"))
    joined = pairs.join(right, "v").join(left, "u").select("u", "v", "a", "b")
    return joined.mapInArrow(run, "u binary, v binary")


def _outlines(texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """For each node the number of its shingles, whether all weigh one, a bitmap of them, and how many
    of them the bitmap doesn't show apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = Hasher()
        for batch in batches:
            sets = [shingles(hashed(words_of(text))) for text in batch.column(1).to_pylist()]
            shown = np.zeros((len(sets), OUTLINE), np.uint8)
            for row, (items, _) in zip(shown, sets):
                row[(items >> np.uint64(64 - int(OUTLINE).bit_length() + 1)).astype(np.int64)] = 1
            size = np.array([len(items) for items, _ in sets], np.int64)
            maps = np.packbits(shown, axis=1).view(np.int64)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(maps.reshape(-1)), maps.shape[1]).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size), pa.array([bool((w == 1).all()) for _, w in sets], pa.bool_()),
                 pa.array(size - shown.sum(axis=1, dtype=np.int64)), lists],
                ["node", "size", "plain", "spare", "map"],
            )

    wanted = texts.join(nodes, "node", "left_semi").select("node", "text")
    return wanted.mapInArrow(run, "node binary, size long, plain boolean, spare long, map array<long>")


def _may_reach(least: float) -> Column:
    """Whether a node and a pivot may reach the similarity, by the most shingles they can share.

    Shared shingles set the same bits; beyond one for each common bit there are at most as many
    as either bitmap doesn't show.
    """
    common = F.least("spare", "pivot_spare")
    for i in range(OUTLINE // 64):
        common = common + F.bit_count(F.col("map")[i].bitwiseAND(F.col("pivot_map")[i]))
    enough = common >= (least - 1e-9) * (F.col("size") + F.col("pivot_size") - common)
    return ~(F.col("plain") & F.col("pivot_plain")) | enough


def _mixed(rooted: DataFrame) -> DataFrame:
    """The rows of buckets that hold several components."""
    several = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    return rooted.join(several.where(F.col("low") != F.col("high")).select("key"), "key", "left_semi")


def _pivots(rooted: DataFrame) -> DataFrame:
    """(key, pivot_node, pivot_root, ...): up to ``PIVOTS`` nodes of each bucket outside its largest
    component, those of small components first."""
    sizes = rooted.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    most = sizes.groupBy("key").agg(F.max(F.struct("n", "root")).alias("most"))
    others = rooted.join(sizes.join(most, "key").where(F.col("root") != F.col("most")["root"]).drop("most"), ["key", "root"])
    rank = F.row_number().over(Window.partitionBy("key").orderBy("n", "root", "node"))
    return others.withColumn("rank", rank).where(F.col("rank") <= PIVOTS).select(
        "key", *[F.col(c).alias(f"pivot_{c}") for c in ("node", "root", "bits", "few", *_MEASURES)]
    )


def _tests(rooted: DataFrame, pivots: DataFrame, least: float) -> DataFrame:
    """Distinct pairs (u, v) of a pivot and a node of another component that may be linked."""
    possible = (
        (F.col("key") == F.col("pivot_key"))
        & (F.col("root") != F.col("pivot_root"))
        & (F.col("few") | F.col("pivot_few") | _alike(F.col("bits"), F.col("pivot_bits")))
        & _may_reach(least)
    )
    pairs = rooted.join(pivots.withColumnRenamed("key", "pivot_key"), possible)
    return pairs.select(F.least("pivot_node", "node").alias("u"), F.greatest("pivot_node", "node").alias("v")).distinct()


def _rooted(buckets: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows with the root of their node's component."""
    named = roots.select(F.col("u").alias("node"), F.col("v").alias("_root"))
    joined = buckets.join(named, "node", "left")
    return joined.withColumn("root", F.coalesce("_root", "node")).drop("_root")


def _placed(docs: DataFrame, doc_id: str, text: str, least: float) -> DataFrame:
    """doc_id, hash of the text, node and root of every row; without words node and root are null."""
    value = F.col(f"`{text}`").cast("string")
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.xxhash64(value).alias("hash"), value.alias("text"))
    sketched = stored(_sketched(rows), "sketches")
    members = sketched.select("doc_id", "hash", "node")
    worded = sketched.where(F.col("node").isNotNull())

    banded = worded.select("node", F.explode("keys").alias("key"))
    several = banded.groupBy("key").agg(F.min("node").alias("pivot"), F.max("node").alias("top"))
    several = stored(several.where(F.col("pivot") != F.col("top")).select("key", "pivot"), "buckets")
    buckets = stored(banded.join(several, "key").select("key", "node", "pivot").distinct(), "buckets")

    nodes = stored(worded.groupBy("node").agg(F.min(_at()).alias("at"), F.first("bits").alias("bits"), F.first("few").alias("few")), "nodes")
    wanted = nodes.join(buckets.select("node").distinct(), "node", "left_semi").select("node", "at")
    texts = stored(_texts(rows, wanted), "texts")

    pairs = buckets.where(F.col("node") != F.col("pivot"))
    pairs = pairs.select(F.col("pivot").alias("u"), F.col("node").alias("v")).distinct()
    for side in ("u", "v"):
        pairs = pairs.join(nodes.select(F.col("node").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in ("bits", "few")]), side)
    likely = F.col("few_u") | F.col("few_v") | _alike(F.col("bits_u"), F.col("bits_v"))
    tested = stored(pairs.where(likely).select("u", "v"), "pairs")
    roots = components(_linked(tested, texts, least))
    open_ = _mixed(_rooted(buckets.where(F.col("node") != F.col("pivot")).select("key", "node"), roots))
    open_ = stored(open_, "open")
    outlines = stored(_outlines(texts, open_.select("node").distinct()), "outlines")
    open_ = open_.join(outlines.join(nodes.select("node", "bits", "few"), "node"), "node")
    while True:
        open_ = stored(_mixed(open_), "open")
        if open_.isEmpty():
            break
        pivots = stored(_pivots(open_), "pivots")
        fresh = stored(_tests(open_, pivots, least).join(tested, ["u", "v"], "left_anti"), "pairs")
        links = stored(_linked(fresh, texts, least), "links")
        tested = tested.unionByName(fresh)
        if not links.isEmpty():
            roots = components(roots.unionByName(links))
        used = pivots.select("key", F.col("pivot_node").alias("node"))
        rest = open_.join(used, ["key", "node"], "left_anti").drop("root")
        open_ = _rooted(rest, roots)

    placed = members.join(roots.select(F.col("u").alias("node"), F.col("v").alias("root")), "node", "left")
    return placed.select("doc_id", "hash", "node", F.coalesce("root", "node").alias("root"))


def all_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id (smallest document id of the class, null where none has one) and node of every row."""
    placed = stored(_placed(docs, doc_id, text, least), "placed")
    least_ids = placed.where(F.col("root").isNotNull()).groupBy("root").agg(F.min("doc_id").alias("class_id"))
    return placed.join(least_ids, "root", "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), "node"
    )


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """The rows of ``all_classes`` with an id."""
    return all_classes(docs, doc_id, text, least).where(F.col("doc_id").isNotNull())


def keep(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """One row of each class, that of the smallest id, with its own columns."""
    placed = stored(_placed(docs, doc_id, text, least), "placed")
    # Rows without an id come last in their class.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), _at().alias("at"), "node", "hash")).alias("first")
    worded = placed.where(F.col("root").isNotNull()).groupBy("root").agg(first).select("first.at", "first.hash")
    blank = placed.where(F.col("root").isNull() & F.col("doc_id").isNotNull()).select(_at().alias("at"), "hash")
    chosen = worded.unionByName(blank).distinct()

    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(
        row.alias("row"), F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text")
    ).withColumn("hash", F.xxhash64("text"))
    kept = rows.withColumn("at", _at()).join(chosen, ["at", "hash"], "left_semi")
    # Repeated rows of one id and text: one stays.
    once = kept.groupBy("at", "hash").agg(F.first("row").alias("row"))
    no_words = ~F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    return once.select("row").unionByName(rows.where(F.col("doc_id").isNull() & no_words).select("row")).select("row.*")
