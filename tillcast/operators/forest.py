"""Forests as node tables, and their scores.

A table ``(model, tree, node, feature, cut, left, right, value)`` holds the trees of several models: a row
goes to ``left`` where its feature is at most ``cut``, else to ``right``; a leaf has no feature.  A model's
score is its base plus its weight times the sum of the leaves a row reaches, one per tree.  The table's
size is a parameter of the fit (rounds times nodes), so tasks get it as arrays and walk all trees of all
models together, a batch of rows at a time.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NODES = "model string, tree int, node int, feature string, cut double, left int, right int, value double"
# Rows that walk all trees at once.
_ROWS = 1024


@dataclass(frozen=True)
class Node:
    node: int
    feature: str | None
    cut: float
    left: int
    right: int
    value: float


@dataclass(frozen=True)
class Forest:
    """Trees of one model; a score is ``base + weight * (sum of leaves)``."""

    trees: list[list[Node]] = field(default_factory=list)
    base: float = 0.0
    weight: float = 1.0

    def first(self, rounds: int) -> Forest:
        return Forest(self.trees[:rounds], self.base, self.weight)

    def rows(self, model: str) -> list[tuple]:
        return [
            (model, t, n.node, n.feature, float(n.cut), n.left, n.right, float(n.value))
            for t, tree in enumerate(self.trees)
            for n in tree
        ]


def node_table(spark: SparkSession, forests: dict[str, Forest]) -> DataFrame:
    rows = [row for name, forest in forests.items() for row in forest.rows(name)]
    return spark.createDataFrame(rows, NODES)


def read_forest(nodes: DataFrame, model: str, base: float = 0.0, weight: float = 1.0) -> Forest:
    """One model of a node table; its size is bounded by the parameters of its fit."""
    trees: dict[int, list[Node]] = {}
    for r in nodes.where(F.col("model") == model).orderBy("tree", "node").collect():
        trees.setdefault(r.tree, []).append(Node(r.node, r.feature, r.cut, r.left, r.right, r.value))
    return Forest([trees[t] for t in sorted(trees)], base, weight)


_SPLIT = re.compile(r"If \(feature (\d+) <= (\S+)\)")
_LEAF = re.compile(r"Predict: (\S+)")


def nodes_of(described: str, names: list[str]) -> list[Node]:
    """Nodes of an MLlib tree from its description, in the order of the text; features are numbers."""
    lines = [line.strip() for line in described.splitlines()[1:] if line.strip()]
    nodes: list[Node] = []

    def read(at: int) -> int:
        """Read the subtree that begins at a line; returns the line after it."""
        number = len(nodes)
        leaf = _LEAF.fullmatch(lines[at])
        if leaf:
            nodes.append(Node(number, None, 0.0, -1, -1, float(leaf[1])))
            return at + 1
        split = _SPLIT.fullmatch(lines[at])
        if not split:
            raise ValueError(f"not a split of a number: {lines[at]}")
        nodes.append(Node(number, None, 0.0, -1, -1, 0.0))
        after = read(at + 1)
        right = len(nodes)
        after = read(after + 1)  # after the line of the other branch
        nodes[number] = Node(number, names[int(split[1])], float(split[2]), number + 1, right, 0.0)
        return after

    if read(0) != len(lines):
        raise ValueError("the description holds more than one tree")
    return nodes


class _Arrays:
    """Trees of several forests side by side, padded to one number of nodes; leaves lead to themselves."""

    def __init__(self, forests: list[Forest], names: list[str]):
        place = {name: i for i, name in enumerate(names)}
        trees = [tree for forest in forests for tree in forest.trees]
        shape = (len(trees), max((len(t) for t in trees), default=1))
        self.feature = np.zeros(shape, np.int32)
        self.cut = np.full(shape, np.inf)
        self.value = np.zeros(shape)
        self.left = np.tile(np.arange(shape[1], dtype=np.int32), (shape[0], 1))
        self.right = self.left.copy()
        for t, tree in enumerate(trees):
            for n in tree:
                self.value[t, n.node] = n.value
                if n.feature is not None:
                    self.feature[t, n.node] = place[n.feature]
                    self.cut[t, n.node], self.left[t, n.node], self.right[t, n.node] = n.cut, n.left, n.right
        self.models = [(f.base, f.weight) for f in forests]
        self.stops = np.cumsum([len(f.trees) for f in forests])

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row in each tree."""
        trees, rows = np.arange(len(self.cut))[None, :], np.arange(len(x))[:, None]
        node = np.zeros((len(x), len(self.cut)), np.int32)
        while True:
            goes_left = x[rows, self.feature[trees, node]] <= self.cut[trees, node]
            after = np.where(goes_left, self.left[trees, node], self.right[trees, node])
            if (after == node).all():
                return node
            node = after

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Rows by models."""
        value = self.value[np.arange(len(self.cut))[None, :], self.leaves(x)]
        starts = [0, *self.stops[:-1]]
        return np.column_stack(
            [base + weight * value[:, a:b].sum(axis=1) for (base, weight), a, b in zip(self.models, starts, self.stops)]
        )


def _over_rows(arrays: _Arrays, compute: str, kind: pa.DataType, ddl: str) -> Callable[[Column], Column]:
    """A column function of the features' array; ``compute`` names the method that gives a row of values."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            n = len(batch)
            x = batch.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 1))
            chunks = [getattr(arrays, compute)(x[i : i + _ROWS]) for i in range(0, n, _ROWS)]
            values = np.concatenate(chunks) if chunks else np.zeros((0, 0))
            offsets = pa.array(np.arange(n + 1) * (values.shape[1] if n else 0), pa.int32())
            yield pa.ListArray.from_arrays(offsets, pa.array(values.ravel(), kind))

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, ddl)


def scores(forests: Iterable[Forest], names: list[str], features: Column) -> Column:
    """Scores of all forests as one array; ``features`` is an array of numbers in the order of ``names``."""
    return _over_rows(_Arrays(list(forests), names), "scores", pa.float64(), "array<double>")(features)


def leaves(forests: Iterable[Forest], names: list[str], features: Column) -> Column:
    """The node in which a row ends, for each tree of each forest in turn."""
    return _over_rows(_Arrays(list(forests), names), "leaves", pa.int32(), "array<int>")(features)


def fit_leaves(
    rows: DataFrame, structures: dict[str, Forest], names: list[str], features: Column, uses: dict[str, Column]
) -> dict[str, Forest]:
    """The same trees with the mean ``label`` of their rows in the leaves, all models in one pass.

    ``uses`` says which rows a model learns from.  A leaf that none of them reaches takes the mean of all of its
    model's rows.  Means are quotients of whole numbers: ``label`` is a long, scaled back by the caller's weight.
    """
    forests = list(structures.values())
    trees = [(name, t) for name, forest in structures.items() for t in range(len(forest.trees))]
    walked = rows.select(
        "label", *[use.alias(f"_use_{name}") for name, use in uses.items()], leaves(forests, names, features).alias("_leaves")
    )
    reached = walked.select("*", F.posexplode("_leaves").alias("at", "node"))
    model = F.element_at(F.array(*[F.lit(name) for name, _ in trees]), F.col("at") + 1)
    used = F.coalesce(*[F.when(model == name, F.col(f"_use_{name}")) for name in uses])
    sums = reached.where(used).groupBy("at", "node").agg(F.sum("label").alias("total"), F.count(F.lit(1)).alias("n"))
    means = {(r["at"], r["node"]): (r["total"], r["n"]) for r in sums.collect()}  # one row per leaf
    out = {name: Forest([], f.base, f.weight) for name, f in structures.items()}
    for at, (name, t) in enumerate(trees):
        tree = structures[name].trees[t]
        found = {n.node: means[at, n.node] for n in tree if (at, n.node) in means}
        total, n_rows = (sum(v[i] for v in found.values()) for i in (0, 1))
        overall = total / n_rows if n_rows else 0.0
        filled = []
        for n in tree:
            value = 0.0
            if n.feature is None:
                value = found[n.node][0] / found[n.node][1] if n.node in found else overall
            filled.append(Node(n.node, n.feature, n.cut, n.left, n.right, value))
        out[name].trees.append(filled)
    return out
