"""Gradient-boosted trees grown on histograms of gradients and hessians.

Every feature is cut into at most 255 bins once and the bins are stored, one byte each. A tree
grows level by level: one aggregation over the stored rows sums gradient, hessian and rows per
(node, feature, bin) for all nodes of a level. What reaches the driver are these sums, whose
number depends on nodes, features and bins but not on rows. A split gains
``GL^2/(HL + l2) + GR^2/(HR + l2) - G^2/(H + l2)``. Of all possible splits up to the greatest depth
the best are taken first, always at a leaf of the tree so far, until the tree has its number of
leaves: the tree that growing leaf by leaf gives, in as many passes as it has levels.

Sums are of whole numbers (multiples of 2**-28), so they do not depend on the order of rows, tasks
or retries, and a fit can be repeated to the last digit.

The margin of a row is its stored one plus those of the trees grown since the table was last
written; every few trees it is written again, in turn to one of two folders. A lost executor costs
the re-reading of its splits, never a chain of trees.

Rows, bins and trees are numpy arrays within tasks (Arrow batches): one pass adds 13 counters per
row, which costs a tenth of exploding each row into 13 in the JVM.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.operators.metrics import class_weights
from basketry.operators.order_stats import value_counts, values_at_ranks
from basketry.params import ModelParams
from basketry.session import materialise, work_dir

UNIT = float(1 << 28)
# A child needs at least this much curvature.
MIN_HESSIAN = 1e-3
# Trees grown before margins are written again.
TREES_PER_TABLE = 8
HELD_CELL = -1
SUMS = "cell int, g bigint, h bigint, n bigint"
BINNED = "bins binary, y tinyint, held boolean, margin double"


@dataclass
class Tree:
    """Nodes in heap order: the children of node i are 2i + 1 (``x <= threshold``) and 2i + 2.

    ``feature`` is -1 at leaves, whose ``value`` is added to the margin.
    """

    feature: np.ndarray
    bin: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    rows: np.ndarray
    depth: int = field(default=0)

    @classmethod
    def blank(cls, depth: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        whole = lambda v, t: np.full(n, v, t)
        return cls(whole(-1, np.int64), whole(0, np.int64), *(whole(0.0, float) for _ in range(3)), whole(0, np.int64), depth)

    def nodes(self, cells: np.ndarray, cuts: np.ndarray, levels: int | None = None) -> np.ndarray:
        """The node each row has reached after ``levels`` steps, or its leaf."""
        node, rows = np.zeros(len(cells), np.int64), np.arange(len(cells))
        for _ in range(self.depth if levels is None else levels):
            f = self.feature[node]
            right = ~(cells[rows, np.maximum(f, 0)] <= cuts[node])
            node = np.where(f >= 0, 2 * node + 1 + right, node)
        return node


# --- bins -------------------------------------------------------------------------


def bin_edges(df: DataFrame, features: Sequence[str], max_bins: int = 255) -> list[np.ndarray]:
    """Upper edges of the bins of each feature, without the last.

    Features of up to ``max_bins`` distinct values are cut halfway between them, others at
    exact, equally spaced percentiles. Nulls and NaN, smaller than any value, have the first bin
    for themselves. At most ``max_bins`` numbers per feature reach the driver.
    """
    known = [F.when(~F.isnan(f), F.col(f).cast("double")) for f in features]
    pairs = F.array(*[F.struct(F.lit(i).alias("feature"), x.alias("x")) for i, x in enumerate(known)])
    counts = materialise(value_counts(df.select(F.explode(pairs).alias("p")).select("p.*"), ["feature"], "x"), "values")
    sizes = counts.groupBy("feature").agg(F.count(F.lit(1)).alias("_d"))
    few = counts.join(F.broadcast(sizes.where(F.col("_d") <= max_bins)), "feature").select("feature", "_v")
    distinct: dict[int, list[float]] = {}
    for r in few.collect():
        distinct.setdefault(r["feature"], []).append(r["_v"])
    edges = [np.zeros(0)] * len(features)
    for i, values in distinct.items():
        v = np.sort(np.array(values))
        edges[i] = (v[:-1] + v[1:]) / 2
    many = counts.join(F.broadcast(sizes.where(F.col("_d") > max_bins)), "feature").drop("_d")
    shares = [k / max_bins for k in range(1, max_bins)]
    ranked: dict[int, dict[int, float]] = {}
    totals: dict[int, int] = {}
    for r in values_at_ranks(many, shares, ["feature"]).collect():
        ranked.setdefault(r["feature"], {})[r["_rank"]] = r["_v"]
        totals[r["feature"]] = r["_total"]
    for i, at in ranked.items():
        place = np.array(shares) * (totals[i] - 1)
        low, high = (np.array([at[int(k)] for k in f(place)]) for f in (np.floor, np.ceil))
        edges[i] = np.unique(low + (high - low) * (place - np.floor(place)))
    return [np.append(-np.inf, e) for e in edges]


def _binned(features: int, edges: list[np.ndarray], margin: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = np.zeros((batch.num_rows, features), np.uint8)
            for i, e in enumerate(edges):
                x = batch.column(i).to_numpy(zero_copy_only=False)
                cells[:, i] = np.searchsorted(e, np.where(np.isnan(x), -np.inf, x), side="left")
            offsets = np.arange(0, batch.num_rows + 1, dtype=np.int32) * features
            bins = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(offsets), pa.py_buffer(cells)])
            start = pa.array(np.full(batch.num_rows, margin))
            yield pa.RecordBatch.from_arrays(
                [bins, batch.column(features), batch.column(features + 1), start], ["bins", "y", "held", "margin"]
            )

    return run


# --- passes -----------------------------------------------------------------------


def _matrix(column: pa.Array, features: int) -> np.ndarray:
    data = column.buffers()[2]
    first = int(np.frombuffer(column.buffers()[1], np.int32)[column.offset]) if len(column) else 0
    n = len(column) * features
    return np.frombuffer(data, np.uint8, n, first).reshape(-1, features) if n else np.zeros((0, features), np.uint8)


def _margins(batch: pa.RecordBatch, cells: np.ndarray, pending: list[Tree]) -> np.ndarray:
    margin = batch.column(3).to_numpy().copy()
    for tree in pending:
        margin += tree.value[tree.nodes(cells, tree.bin)]
    return margin


def _histograms(features: int, bins: int, pending: list[Tree], tree: Tree, level: int, weights: dict[int, float]):
    """Sums per (node of the level, feature, bin); the rows held out give their loss instead."""
    first, width = 2**level - 1, features * bins

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, (first + 1) * width), np.int64)
        held = np.zeros(3, np.int64)
        for batch in batches:
            cells = _matrix(batch.column(0), features)
            y = batch.column(1).to_numpy().astype(float)
            w = np.where(y == 1, weights.get(1, 0.0), weights.get(0, 0.0))
            margin = _margins(batch, cells, pending)
            out = batch.column(2).to_numpy(zero_copy_only=False)
            if level == 0 and out.any():
                # log(1 + exp(m)) - y m, without overflow.
                loss = np.logaddexp(0, margin[out]) - y[out] * margin[out]
                held += [int(np.rint(w[out] * loss * UNIT).sum()), int(np.rint(w[out] * UNIT).sum()), int(out.sum())]
            node = tree.nodes(cells, tree.bin, level) - first
            at = np.flatnonzero(~out & (node >= 0))
            p = 1 / (1 + np.exp(-margin[at]))
            g = np.rint(w[at] * (p - y[at]) * UNIT)
            h = np.rint(w[at] * p * (1 - p) * UNIT)
            for f in range(features):
                cell = node[at] * width + f * bins + cells[at, f]
                # Sums of whole numbers below 2**53 are exact.
                for k, v in enumerate((g, h, None)):
                    total[k] += np.bincount(cell, v, total.shape[1]).astype(np.int64)
        cell = np.flatnonzero(total[2])
        columns = [cell.astype(np.int32), *total[:, cell]]
        if held[2]:
            columns = [np.append(c, v) for c, v in zip(columns, [np.int32(HELD_CELL), *held])]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["cell", "g", "h", "n"])

    return run


def _added(features: int, pending: list[Tree]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margin = _margins(batch, _matrix(batch.column(0), features), pending)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(margin)], batch.schema.names)

    return run


# --- growing ----------------------------------------------------------------------


def _best_splits(sums: np.ndarray, edges: list[np.ndarray], params: ModelParams):
    """Per node of a level: gain, feature and bin of its best split, and sums left and right.

    ``sums`` has shape (3, nodes, features, bins). Ties go to the first feature, then bin.
    """
    left = np.cumsum(sums, axis=3)
    whole = left[:, :, :1, -1:]
    right = whole - left
    l2 = params.l2

    def part(s: np.ndarray) -> np.ndarray:
        g, h = s[0] / UNIT, s[1] / UNIT
        return g * g / (h + l2)

    gain = part(left) + part(right) - part(whole)
    allowed = np.zeros(gain.shape[1:], bool)
    for f, e in enumerate(edges):
        allowed[f, : len(e)] = True
    for side in (left, right):
        allowed = allowed & (side[2] >= params.min_leaf) & (side[1] >= MIN_HESSIAN * UNIT)
    gain = np.where(allowed, gain, -np.inf)
    flat = gain.reshape(len(gain), -1)
    best = flat.argmax(axis=1)
    f, b = np.divmod(best, gain.shape[2])
    at = np.arange(len(gain))
    return flat[at, best], f, b, left[:, at, f, b], right[:, at, f, b]


def _grow(grow_level, edges: list[np.ndarray], params: ModelParams) -> tuple[Tree, float | None]:
    """One tree; ``grow_level(tree, level)`` gives the sums of a level and the loss held out."""
    tree, loss = Tree.blank(params.depth), None
    sums: dict[int, np.ndarray] = {}
    splits: dict[int, tuple[float, int, int]] = {}
    for level in range(params.depth):
        found, held = grow_level(tree, level)
        loss = held if level == 0 else loss
        first = 2**level - 1
        if level == 0:
            sums[0] = found[:, 0, 0].sum(axis=1)
        gain, f, b, left, right = _best_splits(found, edges, params)
        for k in range(len(gain)):
            if gain[k] > 0 and first + k in sums:
                node = first + k
                splits[node] = float(gain[k]), int(f[k]), int(b[k])
                sums[2 * node + 1], sums[2 * node + 2] = left[:, k], right[:, k]
                tree.feature[node], tree.bin[node] = f[k], b[k]
        if not any(n in splits for n in range(first, 2 * first + 1)):
            break
    # Best first among the leaves so far, until the leaves are spent.
    taken, open_nodes = set(), {0} & set(splits)
    while open_nodes and len(taken) + 1 < params.max_leaves:
        node = min(open_nodes, key=lambda n: (-splits[n][0], n))
        taken.add(node)
        open_nodes.remove(node)
        open_nodes |= {2 * node + 1, 2 * node + 2} & set(splits)
    tree.feature[:] = -1
    reached = {0} | {c for n in taken for c in (2 * n + 1, 2 * n + 2)}
    for node in reached:
        g, h, n = sums[node]
        tree.rows[node] = n
        if node in taken:
            gain, f, b = splits[node]
            tree.feature[node], tree.bin[node], tree.threshold[node], tree.gain[node] = f, b, edges[f][b], gain
        else:
            tree.value[node] = -params.learning_rate * (g / UNIT) / (h / UNIT + params.l2)
    return tree, loss


def _stalled(losses: list[float], params: ModelParams) -> bool:
    """Whether none of the last trees improved the held-out loss on that before them."""
    if len(losses) <= params.patience:
        return False
    return min(losses[-params.patience :]) > losses[-params.patience - 1] - params.stop_tol


def fit_trees(df: DataFrame, params: ModelParams = ModelParams(), keys: Sequence[str] = ("client", "date")) -> BoostedTrees:
    """Boost trees on balanced classes.

    Above ``early_stopping_rows`` rows a share ``hold_out`` of them, chosen by a hash of the
    keys (of the features where there are no such columns), is kept from the trees; boosting ends when its loss has not fallen for ``patience`` trees.
    """
    spark, names = df.sparkSession, list(params.features)
    classes = class_weights(df, params.target).collect()
    weights = {int(r["label"]): float(r["weight"]) for r in classes}
    rows = sum(r["rows"] for r in classes)
    keys = [k for k in keys if k in df.columns] or names
    share = round(params.hold_out * 1000) if rows > params.early_stopping_rows else 0
    chosen = F.pmod(F.xxhash64(F.lit(params.seed), *keys), F.lit(1000)) < share
    columns = [F.col(f).cast("double").alias(f) for f in names]
    plain = df.select(*columns, F.col(params.target).cast("tinyint").alias("y"), F.coalesce(chosen, F.lit(False)).alias("held"))
    learned = plain.where(~F.col("held"))
    edges = bin_edges(learned, names, params.max_bins)
    sizes = {r["y"]: r["n"] for r in learned.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    positive, negative = (sizes.get(k, 0) * weights.get(k, 0.0) for k in (1, 0))
    model_names = {"features": names, "trees": []}
    if not positive or not negative:
        # One class only: the margin is as far as a double's probability goes.
        return BoostedTrees.of(model_names | {"start": math.copysign(36.0, positive - negative) if rows else 0.0})
    start = math.log(positive / negative)

    folders = [work_dir(spark, "boosting") for _ in range(2)]
    stored_as = 0

    def store(table: DataFrame) -> DataFrame:
        nonlocal stored_as
        stored_as += 1
        table.write.mode("overwrite").parquet(folders[stored_as % 2])
        return spark.read.schema(BINNED).parquet(folders[stored_as % 2])

    stored = store(plain.mapInArrow(_binned(len(names), edges, start), BINNED))
    trees: list[Tree] = []
    pending: list[Tree] = []
    losses: list[float] = []
    bins = params.max_bins + 1

    def grow_level(tree: Tree, level: int) -> tuple[np.ndarray, float | None]:
        work = _histograms(len(names), bins, list(pending), tree, level, weights)
        sums = stored.mapInArrow(work, SUMS).groupBy("cell").agg(*[F.sum(c).alias(c) for c in "ghn"])
        found = sums.toArrow()
        cell = found["cell"].to_numpy()
        values = np.stack([found[c].to_numpy() for c in "ghn"])
        out = np.zeros((3, 2**level * len(names) * bins), np.int64)
        out[:, cell[cell >= 0]] = values[:, cell >= 0]
        held = values[:, cell == HELD_CELL]
        loss = float(held[0, 0] / held[1, 0]) if held.size else None
        return out.reshape(3, 2**level, len(names), bins), loss

    for _ in range(params.trees):
        tree, loss = _grow(grow_level, edges, params)
        if loss is not None:
            # The loss before this tree.
            losses.append(loss)
            if _stalled(losses, params):
                break
        if tree.feature[0] < 0:
            break
        trees.append(tree)
        pending.append(tree)
        if len(pending) == TREES_PER_TABLE:
            stored = store(stored.mapInArrow(_added(len(names), pending), BINNED))
            pending.clear()
    return BoostedTrees.of(model_names | {"start": start, "trees": [_packed(t) for t in trees]})


# --- model ------------------------------------------------------------------------


def _packed(tree: Tree) -> dict[str, list]:
    """The nodes that exist: leaves and splits, by number."""
    split = tree.feature >= 0
    ids = sorted({0, *(c for n in np.flatnonzero(split).tolist() for c in (2 * n + 1, 2 * n + 2))})
    kept = {"node": ids}
    for name in ("feature", "threshold", "value", "gain", "rows"):
        kept[name] = getattr(tree, name)[ids].tolist()
    return kept


def _unpacked(kept: dict[str, list]) -> Tree:
    depth = (max(kept["node"]) + 1).bit_length() - 1
    tree = Tree.blank(depth)
    for name in ("feature", "threshold", "value", "gain", "rows"):
        getattr(tree, name)[kept["node"]] = kept[name]
    return tree


class BoostedTrees(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted trees. Adds ``rawPrediction``, ``probability`` and ``prediction``; nulls and NaN go left."""

    spec = Param(Params._dummy(), "spec", "features, start and trees as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, spec: str = '{"features": [], "start": 0.0, "trees": []}'):
        super().__init__()
        self._set(spec=spec)

    @classmethod
    def of(cls, content: dict) -> BoostedTrees:
        return cls(spec=json.dumps(content))

    @property
    def content(self) -> dict:
        return json.loads(self.getOrDefault("spec"))

    def table(self, df: DataFrame) -> DataFrame:
        """All nodes as a table: tree, node, feature (null at leaves), threshold, gain, rows, value."""
        content, rows = self.content, []
        for k, tree in enumerate(content["trees"]):
            for node, f, *rest in zip(*(tree[c] for c in ("node", "feature", "threshold", "gain", "rows", "value"))):
                rows.append((k, node, content["features"][f] if f >= 0 else None, *rest))
        kinds = "tree int, node int, feature string, threshold double, gain double, rows bigint, value double"
        return df.sparkSession.createDataFrame(rows, kinds)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        content = self.content
        trees = [_unpacked(t) for t in content["trees"]]
        start = content["start"]

        @F.pandas_udf("double")
        def margin(x: pd.Series) -> pd.Series:
            cells = np.stack(x.to_numpy()) if len(x) else np.zeros((0, len(content["features"])))
            total = np.full(len(x), start)
            for tree in trees:
                total += tree.value[tree.nodes(cells, tree.threshold)]
            return pd.Series(total)

        low = F.lit(float("-inf"))
        row = F.array(*[F.nanvl(F.coalesce(F.col(f).cast("double"), low), low) for f in content["features"]])
        m, p = F.col("_margin"), F.col("_p")
        out = dataset.withColumn("_margin", margin(row)).withColumn("_p", 1 / (1 + F.exp(-m)))
        return out.withColumns(
            {
                "rawPrediction": array_to_vector(F.array(-m, m)),
                "probability": array_to_vector(F.array(1 - p, p)),
                "prediction": (m > 0).cast("double"),
            }
        ).drop("_margin", "_p")
