"""Second-order boosted regression trees with L1, L2 and gamma, grown level by level on mergeable histograms.

Squared loss: a row's gradient is prediction - label, its hessian 1. Features are cut once into at most 255 bins at approximate
quantiles; NULL and NaN have a bin of their own. A level of a tree is one Spark job: tasks sum gradients and rows by
(node, feature, bin), an aggregate adds the tasks' sums up, a window by (node, feature) runs over the bins, and the best split of each
node (at most 2 ** depth rows, a property of the model) comes to the driver. With G and n the sums of a node,
T(G) = sign(G) * max(|G| - l1, 0) and score(G, n) = T(G) ** 2 / (n + l2), a split gains score(left) + score(right) - score(node) and is
made if that is positive and not below gamma, and both sides have ``least_weight`` rows. A leaf says -step * T(G) / (n + l2).

Gradients are summed as integers (units of 2 ** -16), so neither the order of tasks nor a task run again changes a tree. Predictions
so far are kept in a checkpointed table that is written anew every ``INTERVAL`` trees; the trees since then travel with the job.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from waitcast.session import spread

#: Bins of present values; the number after the last is the bin of NULL and NaN.
BINS = 255
UNIT = float(1 << 16)
#: Trees between two checkpoints of the predictions.
INTERVAL = 25
#: Numbers of the rows that carry squared errors instead of gradients: fitted rows, validation rows.
FIT_LOSS, VALIDATION_LOSS = -1, -2


@dataclass(frozen=True)
class Config:
    trees: int
    step: float
    depth: int
    l1: float = 0.0
    l2: float = 1.0
    gamma: float = 0.0
    least_weight: int = 1
    rows: float = 1.0
    tree_columns: float = 1.0
    level_columns: float = 1.0


# The boosted-tree configurations, with their regularisation.
CONFIGS = {
    "xgb_1000_005_8": Config(1000, 0.05, 8, l1=0.5, l2=2.0, gamma=0.1, least_weight=5, rows=0.85, tree_columns=0.85, level_columns=0.85),
    "xgb_1500_002_10": Config(1500, 0.02, 10, l1=0.5, l2=1.0, gamma=0.1, least_weight=2, rows=0.7, tree_columns=0.6),
    "xgb_500_01_8": Config(500, 0.1, 8, l1=0.1, l2=1.0, least_weight=3, rows=0.8, tree_columns=0.8),
    "xgb_500_01_6": Config(500, 0.1, 6, l1=0.1, l2=1.0, least_weight=3, rows=0.8, tree_columns=0.8),
}


@dataclass
class Tree:
    """Nodes as a heap: the children of i are 2i + 1 and 2i + 2. A leaf has feature -1."""

    feature: np.ndarray
    bin: np.ndarray
    missing_left: np.ndarray
    value: np.ndarray
    n: np.ndarray

    @staticmethod
    def empty(depth: int) -> Tree:
        size = (2 << depth) - 1
        return Tree(np.full(size, -1, np.int32), np.zeros(size, np.int32), np.zeros(size, bool), np.zeros(size), np.zeros(size, np.int64))

    def nodes(self, bins: np.ndarray, depth: int) -> np.ndarray:
        """The node in which each row of ``bins`` (rows x features) stands after ``depth`` levels."""
        node = np.zeros(len(bins), np.int64)
        for _ in range(depth):
            feature = self.feature[node]
            b = bins[np.arange(len(bins)), np.maximum(feature, 0)]
            left = np.where(b == BINS, self.missing_left[node], b <= self.bin[node])
            node = np.where(feature >= 0, 2 * node + 2 - left, node)
        return node


@dataclass
class Model:
    columns: list[str]
    cuts: list[np.ndarray]
    base: float
    depth: int
    trees: list[Tree] = field(default_factory=list)
    #: (trees, loss_fit, loss_validation) from no tree to all that were grown; None without validation rows
    losses: list[tuple[int, float, float | None]] = field(default_factory=list)

    def importances(self) -> dict[str, int]:
        """How many splits use each column."""
        used = np.concatenate([t.feature[t.feature >= 0] for t in self.trees]) if self.trees else np.zeros(0, int)
        return dict(zip(self.columns, np.bincount(used, minlength=len(self.columns)).tolist(), strict=True))


def binned(values: list[np.ndarray], cuts: list[np.ndarray]) -> np.ndarray:
    """Bins (rows x features): the number of cuts below the value, BINS for NaN."""
    out = [np.where(np.isnan(v), BINS, np.searchsorted(c, v, side="left")) for v, c in zip(values, cuts, strict=True)]
    return np.stack(out, axis=1).astype(np.uint8)


def sampled_rows(key: np.ndarray, seed: int, tree: int, share: float) -> np.ndarray:
    """Which rows a tree sees, by a hash of their key."""
    if share >= 1:
        return np.ones(len(key), bool)
    with np.errstate(over="ignore"):
        x = key.view(np.uint64) + np.uint64(seed * 1_000_003 + tree + 1) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) / 2.0**64 < share


def sampled_columns(n: int, seed: int, tree: int, level: int, config: Config) -> list[int]:
    """Which features a level of a tree may split: a draw by level from the tree's draw."""
    of_tree = np.random.default_rng([seed, tree]).permutation(n)[:max(1, int(config.tree_columns * n))]
    return sorted(np.random.default_rng([seed, tree, level + 1]).permutation(of_tree)[:max(1, int(config.level_columns * len(of_tree)))].tolist())


def _columns(b: pa.RecordBatch, n_features: int) -> tuple[np.ndarray, ...]:
    """(bins, key, label, is validation, prediction) of a batch of the state table."""
    packed = b.column(0)
    if b.num_rows:
        start = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset]
        bins = np.frombuffer(packed.buffers()[2], np.uint8)[start:start + b.num_rows * n_features].reshape(b.num_rows, n_features)
    else:
        bins = np.zeros((0, n_features), np.uint8)
    return bins, b.column(1).to_numpy(), b.column(2).to_numpy(), b.column(3).to_numpy(zero_copy_only=False), b.column(4).to_numpy()


_STATE = "bins binary, key long, label double, validation boolean, prediction double"


def _with_trees(bins: np.ndarray, prediction: np.ndarray, trees: list[Tree], depth: int) -> np.ndarray:
    for t in trees:
        prediction = prediction + t.value[t.nodes(bins, depth)]
    return prediction


def _prepare(rows: DataFrame, model: Model) -> DataFrame:
    """The state table of rows (key, label, validation, features): their bins, and the mean as prediction."""
    cuts, base = model.cuts, model.base

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = [c.to_numpy(zero_copy_only=False).astype(float) for c in b.columns[3:]]
            bins = pa.array([r.tobytes() for r in binned(values, cuts)], pa.binary())
            yield pa.RecordBatch.from_arrays([bins, *b.columns[:3], pa.array(np.full(b.num_rows, base))],
                                             names=["bins", "key", "label", "validation", "prediction"])

    return rows.mapInArrow(run, _STATE).checkpoint(eager=True)


def _advanced(state: DataFrame, trees: list[Tree], depth: int, n_features: int) -> DataFrame:
    """The state table with the predictions of ``trees`` added, written anew."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bins, _, _, _, prediction = _columns(b, n_features)
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(_with_trees(bins, prediction, trees, depth))], names=b.schema.names)

    return state.mapInArrow(run, _STATE).checkpoint(eager=True)


def _cells(state: DataFrame, since: list[Tree], tree: Tree, number: int, level: int, features: list[int], n_features: int, config: Config,
           seed: int) -> DataFrame:
    """(node, feature, bin, g, n): sums of each task for the nodes of a level; at level 0 also the squared errors so far."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, width = (1 << level) - 1, BINS + 1
        cells = (1 << level) * width
        g, n = (np.zeros((len(features), cells), np.int64) for _ in range(2))
        loss = {FIT_LOSS: [0, 0], VALIDATION_LOSS: [0, 0]}
        for b in batches:
            bins, key, label, validation, prediction = _columns(b, n_features)
            wrong = _with_trees(bins, prediction, since, config.depth) - label
            if not level:
                for part, at in ((FIT_LOSS, ~validation), (VALIDATION_LOSS, validation)):
                    loss[part][0] += int(np.rint(wrong[at] ** 2 * UNIT).astype(np.int64).sum())
                    loss[part][1] += int(at.sum())
            seen = ~validation & sampled_rows(key, seed, number, config.rows)
            node = tree.nodes(bins, level)
            at = np.flatnonzero(seen & (node >= first))
            place, gradient = (node[at] - first) * width, np.rint(wrong[at] * UNIT)
            for i, f in enumerate(features):
                cell = place + bins[at, f]
                # whole numbers below 2 ** 53 within a batch, so sums of doubles are exact
                g[i] += np.bincount(cell, gradient, cells).astype(np.int64)
                n[i] += np.bincount(cell, minlength=cells)
        f, cell = np.nonzero(n)
        out = [cell // width + first, np.array(features, np.int64)[f], cell % width, g[f, cell], n[f, cell]]
        if not level:
            extra = [[part for part in loss], [0, 0], [0, 0], [v[0] for v in loss.values()], [v[1] for v in loss.values()]]
            out = [np.concatenate([a, np.array(x, np.int64)]) for a, x in zip(out, extra, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in out], names=["node", "feature", "bin", "g", "n"])

    return state.mapInArrow(run, "node long, feature long, bin long, g long, n long")


def _score(g: Column, n: Column, config: Config) -> Column:
    shrunk = F.greatest(F.abs(g) - F.lit(config.l1), F.lit(0.0))
    # without rows and without L2: NULL, which is no sound split
    return F.try_divide(shrunk * shrunk, n + F.lit(config.l2))


def _splits(cells: DataFrame, config: Config) -> DataFrame:
    """One row a node: its sums (G, N) and its best split (NULL without one); ties go to the smallest feature, then bin, then missing left."""
    total = cells.repartition("node", "feature").groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("n").alias("n"))
    every = W.partitionBy("node", "feature")
    upto = every.orderBy("bin").rowsBetween(W.unboundedPreceding, W.currentRow)
    missing = F.col("bin") == BINS
    total = total.select("node", "feature", "bin", *[F.sum(c).over(upto).alias(f"{c}_upto") for c in "gn"], *[F.sum(c).over(every).alias(f"{c}_all") for c in "gn"],
                         *[F.coalesce(F.sum(F.when(missing, F.col(c))).over(every), F.lit(0)).alias(f"{c}_missing") for c in "gn"])
    sides = F.explode(F.array(F.lit(True), F.lit(False)))
    both = total.withColumn("missing_left", sides)
    add = F.col("missing_left")
    both = both.withColumns({"gl": F.col("g_upto") + F.when(add, F.col("g_missing")).otherwise(0), "nl": F.col("n_upto") + F.when(add, F.col("n_missing")).otherwise(0)})
    both = both.withColumns({"gr": F.col("g_all") - F.col("gl"), "nr": F.col("n_all") - F.col("nl")})
    unit = F.lit(UNIT)
    gain = _score(F.col("gl") / unit, F.col("nl"), config) + _score(F.col("gr") / unit, F.col("nr"), config) - _score(F.col("g_all") / unit, F.col("n_all"), config)
    both = both.withColumn("gain", gain)
    sound = ~missing & (F.least("nl", "nr") >= max(config.least_weight, 1)) & (F.col("gain") > 0) & (F.col("gain") >= config.gamma)
    split = F.when(sound, F.struct("gain", (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"), "missing_left", "gl", "nl", "gr", "nr"))
    return both.groupBy("node").agg(F.max(split).alias("split"), F.first("g_all").alias("g"), F.first("n_all").alias("n"))


def _leaf(g: float, n: int, config: Config) -> float:
    g = g / UNIT
    return float(-config.step * np.sign(g) * max(abs(g) - config.l1, 0.0) / (n + config.l2)) if n + config.l2 else 0.0


def _cuts(rows: DataFrame, columns: list[str]) -> list[np.ndarray]:
    """At most BINS - 1 cuts a column, from one pass of bounded quantile sketches. The largest value is no cut."""
    at = [i / BINS for i in range(1, BINS)]
    value = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns}
    found = rows.agg(*[F.percentile_approx(v, at, 10_000).alias(f"q{i}") for i, v in enumerate(value.values())],
                     *[F.max(v).alias(f"m{i}") for i, v in enumerate(value.values())]).first()
    cuts = [np.unique(np.array(found[f"q{i}"] or [], float)) for i in range(len(columns))]
    return [c[c < found[f"m{i}"]] if len(c) else c for i, c in enumerate(cuts)]


def fit(df: DataFrame, columns: list[str], label: str, key: str, config: Config, validation: Column | None = None, patience: int | None = None,
        seed: int = 42) -> Model:
    """Trees on the rows of ``df`` that have a label and for which ``validation`` is not true.

    ``key`` names the column whose hash draws the rows of a tree (rows of one key are drawn together; a null key is a key). With
    ``patience``, growing ends when that many trees in a row bring no smaller loss on the validation rows, and the trees up to the
    least loss are kept. Without rows to fit: ValueError. Columns of ``df`` that are not named are not read.
    """
    validation = F.lit(False) if validation is None else validation
    numbers = [F.col(c).cast("double").alias(f"_f{i}") for i, c in enumerate(columns)]
    rows = df.select(F.xxhash64(key).alias("_key"), F.col(label).cast("double").alias("_label"), F.coalesce(validation, F.lit(False)).alias("_part"), *numbers)
    # read three times, and its state once a level: computed once, over all cores
    rows = spread(rows.where("_label IS NOT NULL AND NOT isnan(_label)"))
    fitted = rows.where("NOT _part")
    mean = fitted.agg(F.sum(F.rint(F.col("_label") * UNIT).cast("long")).alias("s"), F.count(F.lit(1)).alias("n")).first()
    if not mean.n:
        raise ValueError("no row to fit")
    model = Model(list(columns), _cuts(fitted, fitted.columns[3:]), mean.s / mean.n / UNIT, config.depth)
    state, since, width = _prepare(rows, model), [], len(columns)
    best, kept = np.inf, 0
    for number in range(config.trees + 1):
        tree, sums = Tree.empty(config.depth), {}
        for level in range(config.depth):
            features = sampled_columns(width, seed, number, level, config)
            found = {r.node: r for r in _splits(_cells(state, since, tree, number, level, features, width, config, seed), config).collect()}
            if not level:
                loss, held_out = (found.pop(part, None) for part in (FIT_LOSS, VALIDATION_LOSS))
                after = held_out.g / held_out.n / UNIT if held_out is not None and held_out.n else None
                model.losses.append((number, loss.g / loss.n / UNIT, after))
                if after is not None and after < best:
                    best, kept = after, number
                if number == config.trees or patience is not None and number - kept >= patience:
                    model.trees = model.trees[:kept] if patience is not None and best < np.inf else model.trees
                    return model
                sums = {0: (found[0].g, found[0].n)} if 0 in found else {0: (0, 0)}
            grown = False
            for node, r in found.items():
                if r.split is not None:
                    tree.feature[node], tree.bin[node], tree.missing_left[node] = -r.split.f, -r.split.b, r.split.missing_left
                    sums[2 * node + 1], sums[2 * node + 2] = (r.split.gl, r.split.nl), (r.split.gr, r.split.nr)
                    grown = True
            if not grown:
                break
        for node, (g, n) in sums.items():
            tree.n[node], tree.value[node] = n, _leaf(g, n, config)
        model.trees.append(tree)
        since.append(tree)
        if len(since) == INTERVAL:
            state, since = _advanced(state, since, config.depth, width), []
    return model


def predict(df: DataFrame, model: Model, name: str = "pred_base") -> DataFrame:
    """``df`` with the prediction of ``model``; missing values go the way learned for them."""
    held = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(values: pd.Series) -> pd.Series:
        m = held.value
        flat = np.array(values.tolist(), float).reshape(len(values), len(m.columns))
        bins = binned([flat[:, i] for i in range(len(m.columns))], m.cuts)
        return pd.Series(_with_trees(bins, np.full(len(bins), m.base), m.trees, m.depth))

    # NULL as NaN, so that the array holds doubles alone
    return df.withColumn(name, run(F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in model.columns])))
