"""Boosted trees for several classes with a softmax objective.

Every round grows one tree per class on the gradients of the softmax loss and
their second-order weights. All trees of a round grow together, level by level:
a level is one aggregation, in which each partition adds its rows up into
histograms (class, node, feature, bin) before they are shuffled. Spark then picks
the best cut of every node from running sums over the bins; only those cuts, one
row per class and node, reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window, functions as F

from reportlens.session import cut_lineage, drop_table

_HIST = "k int, node int, f int, bin int, g double, h double"
_REFRESH = 10  # rounds after which the scores are written anew


def _leaf_scores():
    """A function of (bins, trees): the sum of the leaves per class. It is made
    here so that tasks receive its code along with it."""
    def scores(bins, trees, classes):
        out = np.zeros((len(bins), classes))
        for k, feature, cut, value in trees:
            at = np.zeros(len(bins), np.int64)
            while True:
                inner = feature[at] >= 0
                if not inner.any():
                    break
                rows = np.flatnonzero(inner)
                here = at[rows]
                at[rows] = 2 * here + 1 + (bins[rows, feature[here]] > cut[here])
            out[:, k] += value[at]
        return out
    return scores


def _binned():
    """Bin numbers of values: how many cuts of their feature lie below them."""
    def binned(x, cuts):
        out = np.empty(x.shape, np.int16)
        for f, c in enumerate(cuts):
            out[:, f] = np.searchsorted(c, x[:, f], side="left")
        return out
    return binned


@dataclass
class SoftmaxModel:
    """Fitted trees: (class, feature per node, cut per node, value per node), as
    heaps of nodes. ``losses`` holds the mean log-loss before each round and at
    the end."""

    classes: int
    cuts: list
    trees: list
    start: np.ndarray
    losses: list = field(default_factory=list)

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``probability`` (a vector that sums to one) and ``prediction``."""
        classes, cuts, trees, start, scores, binned = self.classes, self.cuts, self.trees, self.start, _leaf_scores(), _binned()

        @F.pandas_udf("array<double>")
        def probability(x):
            import pandas as pd
            if not len(x):
                return pd.Series([], dtype=object)
            raw = start + scores(binned(np.stack(x.to_numpy()).astype(np.float64), cuts), trees, classes)
            p = np.exp(raw - raw.max(axis=1, keepdims=True))
            return pd.Series(list(p / p.sum(axis=1, keepdims=True)))

        p = df.withColumn("_p", probability(vector_to_array("features")))
        best = F.array_position("_p", F.array_max("_p")) - 1
        return p.withColumn("prediction", best.cast("double")).withColumn("probability", array_to_vector("_p")).drop("_p")


@dataclass
class SoftmaxBoosting:
    """Estimator over ``features`` (vector) and ``label`` (0 .. classes - 1).

    ``subsample`` of the rows and ``columns`` of the features are drawn per
    round and tree from hashes of the row and the seed. ``weight`` names a
    column of row weights. Features are cut at ``bins`` - 1 quantiles.
    """

    classes: int
    rounds: int = 200
    depth: int = 6
    rate: float = 0.1
    subsample: float = 1.0
    columns: float = 1.0
    bins: int = 64
    l2: float = 1.0
    min_child: float = 1.0
    seed: int = 42
    weight: str | None = None

    def fit(self, df: DataFrame) -> SoftmaxModel:
        spark = df.sparkSession
        w = F.col(self.weight).cast("double") if self.weight else F.lit(1.0)
        rows = cut_lineage(df.select(vector_to_array("features").alias("x"), F.col("label").cast("int").alias("y"), w.alias("w")))
        width = rows.select(F.max(F.size("x"))).first()[0] or 0
        cuts = self._cuts(rows, width)
        binned, classes = _binned(), self.classes

        def to_bins(batches):
            for b in batches:
                x = np.array(b.column(0).to_pylist(), np.float64).reshape(b.num_rows, width)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(binned(x, cuts)), pa.list_(pa.int16())), b.column(1), b.column(2),
                     pa.array([[0.0] * classes] * b.num_rows, pa.list_(pa.float64()))], ["bins", "y", "w", "raw"])

        data = cut_lineage(rows.mapInArrow(to_bins, "bins array<smallint>, y int, w double, raw array<double>"))
        prior = {r["y"]: r["w"] for r in data.groupBy("y").agg(F.sum("w").alias("w")).collect()}  # one row per class
        if any(y is None or not 0 <= y < classes for y in prior):
            raise ValueError(f"labels must be 0 to {classes - 1}")
        model = SoftmaxModel(classes, cuts, [], np.zeros(classes))
        rng, fresh = np.random.default_rng(self.seed), []
        for n in range(self.rounds):
            trees, loss = self._grow(data, fresh, width, rng, n)
            model.losses.append(loss)
            model.trees += trees
            fresh += trees
            if (n + 1) % _REFRESH == 0 and n + 1 < self.rounds:
                data, fresh = self._scored(data, fresh), []
        model.losses.append(self._loss(data, fresh))
        return model

    def _cuts(self, rows: DataFrame, width: int):
        shares = F.array(*[F.lit((i + 1) / self.bins) for i in range(self.bins - 1)])
        each = rows.select(F.posexplode("x").alias("f", "v")).groupBy("f").agg(F.percentile_approx("v", shares, F.lit(10_000)).alias("q"))
        found = {r["f"]: r["q"] for r in each.collect()}  # at most ``bins`` numbers per feature
        return [np.unique(np.array(found.get(f) or [], np.float64)) for f in range(width)]

    def _scored(self, data: DataFrame, trees) -> DataFrame:
        """The scores with the leaves of ``trees`` added, as a table in place of ``data``."""
        scores, classes = _leaf_scores(), self.classes

        def add(batches):
            for b in batches:
                bins = np.array(b.column(0).to_pylist(), np.int16).reshape(b.num_rows, -1)
                raw = np.array(b.column(3).to_pylist()).reshape(-1, classes) + scores(bins, trees, classes)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(list(raw), pa.list_(pa.float64()))], b.schema.names)

        out = cut_lineage(data.mapInArrow(add, data.schema))
        drop_table(data)
        return out

    def _loss(self, data: DataFrame, trees) -> float:
        scores, classes = _leaf_scores(), self.classes

        def add(batches):
            for b in batches:
                bins = np.array(b.column(0).to_pylist(), np.int16).reshape(b.num_rows, -1)
                raw = np.array(b.column(3).to_pylist()).reshape(-1, classes) + scores(bins, trees, classes)
                y, w = b.column(1).to_numpy(), b.column(2).to_numpy()
                top = raw.max(axis=1, keepdims=True)
                log = raw[np.arange(len(y)), y] - top[:, 0] - np.log(np.exp(raw - top).sum(axis=1))
                yield pa.RecordBatch.from_arrays([pa.array([float(-(log * w).sum())]), pa.array([float(w.sum())])], ["loss", "w"])

        one = data.mapInArrow(add, "loss double, w double").agg(F.sum("loss") / F.sum("w")).first()[0]
        return float(one) if one is not None else 0.0

    def _grow(self, data: DataFrame, fresh, width: int, rng, n: int):
        """One tree per class: ([(class, feature, cut, value)], log-loss before them)."""
        size = 2 ** (self.depth + 1) - 1
        trees = [(k, np.full(size, -1, np.int64), np.zeros(size, np.int64), np.zeros(size)) for k in range(self.classes)]
        keep = max(1, round(self.columns * width))
        chosen = [np.sort(rng.permutation(width)[:keep]) for _ in trees]
        loss = 0.0
        for level in range(self.depth + 1):
            # The last level needs no cut, only its sums.
            split = level < self.depth
            hist = self._histograms(data, fresh, trees, chosen if split else [c[:1] for c in chosen], level, n)
            cuts = self._best(hist, split)
            if level == 0:
                loss = next((c["loss"] for c in cuts if c["loss"] is not None), 0.0)
            for c in cuts:
                if c["k"] < 0:
                    continue
                k, feature, cut, value = trees[c["k"]]
                value[c["node"]] = -self.rate * c["g"] / (c["h"] + self.l2)
                if split and c["gain"] is not None and c["gain"] > 1e-12:
                    feature[c["node"]], cut[c["node"]] = c["f"], c["bin"]
            if not any((t[1][2 ** level - 1:2 ** (level + 1) - 1] >= 0).any() for t in trees):
                break
        return trees, loss

    def _histograms(self, data: DataFrame, fresh, trees, chosen, level: int, n: int) -> DataFrame:
        """(k, node, f, bin, g, h) of the open nodes of a level. Row k = -1 holds the log-loss and the weight."""
        scores, classes, share, seed = _leaf_scores(), self.classes, self.subsample, self.seed
        first, nodes = 2 ** level - 1, 2 ** level
        bins_of = self.bins

        def add(batches):
            sums = {}
            loss = weight = 0.0
            for b in batches:
                bins = np.array(b.column(0).to_pylist(), np.int16).reshape(b.num_rows, -1)
                if not len(bins):
                    continue
                raw = np.array(b.column(3).to_pylist()).reshape(-1, classes) + scores(bins, fresh, classes)
                y, w = b.column(1).to_numpy(), b.column(2).to_numpy()
                p = np.exp(raw - raw.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                loss -= float((np.log(np.maximum(p[np.arange(len(y)), y], 1e-300)) * w).sum())
                weight += float(w.sum())
                if share < 1:
                    mark = b.column(4).to_numpy().astype(np.uint64) ^ np.uint64(seed * 1_000_003 + n)
                    mark = (mark * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
                    w = np.where(mark < share * (1 << 24), w, 0.0)
                for k, feature, cut, _ in trees:
                    at, live = np.zeros(len(bins), np.int64), w > 0
                    for _ in range(level):  # rows that have reached a leaf stay there
                        live = live & (feature[at] >= 0)
                        at = np.where(live, 2 * at + 1 + (bins[np.arange(len(bins)), np.maximum(feature[at], 0)] > cut[at]), at)
                    rows = np.flatnonzero(live)
                    if not len(rows):
                        continue
                    g = (p[rows, k] - (y[rows] == k)) * w[rows]
                    h = np.maximum(2 * p[rows, k] * (1 - p[rows, k]), 1e-16) * w[rows]
                    node = at[rows] - first
                    for f in chosen[k]:
                        cell = node * bins_of + bins[rows, f]
                        held = sums.setdefault((k, int(f)), np.zeros((2, nodes * bins_of)))
                        held[0] += np.bincount(cell, g, nodes * bins_of)
                        held[1] += np.bincount(cell, h, nodes * bins_of)
            out = [(-1, 0, 0, 0, loss, weight)]
            for (k, f), (g, h) in sums.items():
                for c in np.flatnonzero(h):
                    out.append((k, first + int(c) // bins_of, f, int(c) % bins_of, float(g[c]), float(h[c])))
            kinds = [pa.int32()] * 4 + [pa.float64()] * 2
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(kinds)], ["k", "node", "f", "bin", "g", "h"])

        rows = data.withColumn("mark", F.xxhash64("bins", "y")) if share < 1 else data
        return rows.mapInArrow(add, _HIST).groupBy("k", "node", "f", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))

    def _best(self, hist: DataFrame, split: bool):
        """One row per class and node: its sums and, if asked, its best cut."""
        upto = Window.partitionBy("k", "node", "f").orderBy("bin")  # at most ``bins`` rows
        whole = Window.partitionBy("k", "node", "f")
        run = hist.select("k", "node", "f", "bin", "g", "h", F.sum("g").over(upto).alias("gl"), F.sum("h").over(upto).alias("hl"),
                          F.sum("g").over(whole).alias("gt"), F.sum("h").over(whole).alias("ht"))
        gr, hr = F.col("gt") - F.col("gl"), F.col("ht") - F.col("hl")
        gain = (F.col("gl") ** 2 / (F.col("hl") + self.l2) + gr ** 2 / (hr + self.l2) - F.col("gt") ** 2 / (F.col("ht") + self.l2)) / 2
        ok = (F.col("hl") >= self.min_child) & (hr >= self.min_child) & F.lit(split) & (F.col("k") >= 0)
        run = run.withColumn("gain", F.when(ok, gain))
        best = run.groupBy("k", "node").agg(
            F.max(F.struct("gain", (-F.col("f")).alias("f"), (-F.col("bin")).alias("bin"))).alias("b"),
            F.max(F.struct("f", "gt", "ht")).alias("t"))
        return best.select("k", "node", F.col("t.gt").alias("g"), F.col("t.ht").alias("h"), "b.gain", (-F.col("b.f")).alias("f"),
                           (-F.col("b.bin")).alias("bin"), F.when(F.col("k") < 0, F.col("t.gt") / F.col("t.ht")).alias("loss")).collect()
