"""Gradient-boosted trees that may be held to rise in some features: histograms in Spark, splits on the driver."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: Rows in a block of binned features; rows up to which blocks are held on the driver (some 30 MB), with the same sums.
BLOCK, LOCAL = 1 << 16, 1 << 20
BLOCKS = "bins binary, label binary, weight binary"


@dataclass
class Tree:
    """Nodes as lists: the feature and last bin that go left, the children, and the value; feature -1 is a leaf."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """The node that each row ends in."""
        at = np.zeros(len(bins), np.int64)
        feature, edge, left, right = (np.array(x) for x in (self.feature, self.bin, self.left, self.right))
        while True:
            open_ = np.flatnonzero(feature[at] >= 0)
            if not len(open_):
                return at
            node = at[open_]
            low = bins[open_, feature[node]] <= edge[node]
            at[open_] = np.where(low, left[node], right[node])

    def split(self, node: int, feature: int, edge: int, values: tuple[float, float]) -> tuple[int, int]:
        """Split a leaf; the numbers of its children."""
        pair = len(self.feature), len(self.feature) + 1
        self.feature[node], self.bin[node], self.left[node], self.right[node] = feature, edge, *pair
        for v in values:
            for column, x in zip((self.feature, self.bin, self.left, self.right, self.value), (-1, 0, 0, 0, v), strict=True):
                column.append(x)
        return pair


@dataclass
class Booster:
    """A fitted model: cut points by feature, the base margin, and trees whose values have the learning rate in them."""

    names: list[str]
    cuts: list[list[float]]
    base: float
    trees: list[Tree]

    def binned(self, columns: list[np.ndarray]) -> np.ndarray:
        return np.stack([np.searchsorted(np.array(c), x, "left") for c, x in zip(self.cuts, columns, strict=True)], 1).astype(np.uint8)

    def margins(self, bins: np.ndarray) -> np.ndarray:
        out = np.full(len(bins), self.base)
        for tree in self.trees:
            out += np.array(tree.value)[tree.leaves(bins)]
        return out

    def probability(self) -> Column:
        """The probability as a column over the features."""

        @F.pandas_udf("double")
        def run(*columns: pd.Series) -> pd.Series:
            return pd.Series(1 / (1 + np.exp(-self.margins(self.binned([c.to_numpy(float) for c in columns])))))

        return run(*(F.col(n).cast("double") for n in self.names))

    def described(self) -> dict:
        return {"names": self.names, "cuts": self.cuts, "base": self.base, "trees": [vars(t) for t in self.trees]}

    @classmethod
    def from_description(cls, told: dict) -> Booster:
        return cls(told["names"], told["cuts"], told["base"], [Tree(**t) for t in told["trees"]])


def _histogram(bins: np.ndarray, g: np.ndarray, h: np.ndarray, at: np.ndarray, nodes: list[int], width: int) -> np.ndarray:
    """Sums of g and h by node, feature and bin."""
    place = np.full(max(nodes) + 1, -1)
    place[nodes] = np.arange(len(nodes))
    row = np.where(at <= max(nodes), place[np.minimum(at, max(nodes))], -1)
    some = row >= 0
    bins, g, h, row = bins[some], g[some], h[some], row[some]
    out = np.zeros((len(nodes), bins.shape[1], width, 2))
    for f in range(bins.shape[1]):
        key = row * width + bins[:, f]
        for k, x in enumerate((g, h)):
            out[:, f, :, k] = np.bincount(key, x, len(nodes) * width).reshape(len(nodes), width)
    return out


class _Blocks:
    """The training rows as blocks, on the driver where they are few, else in Spark."""

    def __init__(self, rows: DataFrame, model: Booster, label: str, weight: str, width: int):
        self.model, self.width, self.features = model, width, len(model.names)

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(batch.num_columns)]
                for a in range(0, batch.num_rows, BLOCK):
                    part = [c[a : a + BLOCK] for c in columns]
                    made = (model.binned(part[:-2]).tobytes(), part[-2].astype("<f8").tobytes(), part[-1].astype("<f8").tobytes())
                    yield pa.RecordBatch.from_arrays([pa.array([m], pa.binary()) for m in made], names=["bins", "label", "weight"])

        cast = [F.col(c).cast("double") for c in (*model.names, label, weight)]
        self.blocks = rows.select(*cast).mapInArrow(pack, BLOCKS).persist()
        self.local = [self.read(r) for r in self.blocks.collect()] if rows.count() <= LOCAL else None

    def read(self, r) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.frombuffer(r["bins"], np.uint8).reshape(-1, self.features), np.frombuffer(r["label"], "<f8"), np.frombuffer(r["weight"], "<f8")

    def slopes(self, block: tuple, seed: int, subsample: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bins, g, h) of the logistic loss; rows left out of a round by their content's hash have none."""
        bins, y, w = block
        p = 1 / (1 + np.exp(-self.model.margins(bins)))
        if subsample < 1:
            mixed = (bins.astype(np.uint64) @ (np.arange(1, bins.shape[1] + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))) + np.uint64(seed * 0xBF58476D1CE4E5B9 % (1 << 64))
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            w = w * ((mixed >> np.uint64(11)) / 2.0**53 < subsample)
        return bins, w * (p - y), w * p * (1 - p)

    def sums(self, made, tree: Tree, nodes: list[int]) -> np.ndarray:
        """The histogram of nodes over all rows; made is what round() gave."""
        width, shape = self.width, (len(nodes), self.features, self.width, 2)
        if self.local is not None:
            return sum((_histogram(b, g, h, tree.leaves(b), nodes, width) for b, g, h in made), np.zeros(shape))
        features = self.features

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(shape)
            for batch in batches:
                for r in batch.to_pylist():
                    bins = np.frombuffer(r["bins"], np.uint8).reshape(-1, features)
                    total += _histogram(bins, np.frombuffer(r["g"], "<f8"), np.frombuffer(r["h"], "<f8"), tree.leaves(bins), nodes, width)
            yield pa.RecordBatch.from_arrays([pa.array(range(len(nodes)), pa.int32()), pa.array([t.tobytes() for t in total], pa.binary())], names=["node", "sums"])

        def add(table: pa.Table) -> pa.Table:
            total = sum(np.frombuffer(s, "<f8") for s in table.column("sums").to_pylist())
            return pa.table([table.column("node").slice(0, 1), pa.array([total.tobytes()], pa.binary())], names=["node", "sums"])

        found = made.mapInArrow(count, "node int, sums binary").groupBy("node").applyInArrow(add, "node int, sums binary").collect()
        out = np.zeros(shape)
        for r in found:  # a row a node
            out[r["node"]] = np.frombuffer(r["sums"], "<f8").reshape(shape[1:])
        return out

    def round(self, seed: int, subsample: float):
        if self.local is not None:
            return [self.slopes(b, seed, subsample) for b in self.local]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for r in batch.to_pylist():
                    _, g, h = self.slopes(self.read(r), seed, subsample)
                    yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in (r["bins"], g.tobytes(), h.tobytes())], names=["bins", "g", "h"])

        return self.blocks.mapInArrow(run, "bins binary, g binary, h binary").persist()

    def __getstate__(self) -> dict:
        return {k: v for k, v in vars(self).items() if k not in ("blocks", "local")}


def _best(sums: np.ndarray, low: float, high: float, rising: np.ndarray, allowed: np.ndarray, reg: float, child: float) -> tuple[float, int, int, float, float]:
    """(gain, feature, bin, left value, right value) of the best split of a node whose values must lie in low..high."""
    total = sums[0].sum(0)
    value = lambda g, h: np.clip(-g / (h + reg), low, high)
    score = lambda g, h, v: -(g * v + 0.5 * (h + reg) * v * v)
    left = np.cumsum(sums, axis=1)[:, :-1]
    gl, hl = left[..., 0], left[..., 1]
    gr, hr = total[0] - gl, total[1] - hl
    vl, vr = value(gl, hl), value(gr, hr)
    gain = score(gl, hl, vl) + score(gr, hr, vr) - score(*total, value(*total))
    ok = (hl >= child) & (hr >= child) & allowed[:, None] & ~(rising[:, None] & (vl > vr))
    gain = np.where(ok, gain, -np.inf)
    f, b = np.unravel_index(int(gain.argmax()), gain.shape)
    return float(gain[f, b]), int(f), int(b), float(vl[f, b]), float(vr[f, b])


def fit(rows: DataFrame, names: list[str], rising: list[bool], label: str = "label", weight: str = "weight", rounds: int = 40, depth: int = 5, rate: float = 0.1, width: int = 64, reg: float = 1.0, child: float = 1e-3, gain: float = 0.0, subsample: float = 1.0, columns: float = 1.0, seed: int = 42) -> Booster:
    """Trees on the logistic loss, grown level by level; in a feature that is to rise the probability never falls.

    A split on such a feature is taken only where the left value is not above the right, and all values below stay on
    their side of the middle of the two, so every tree rises, and so do sums of them. Features are cut at up to width - 1
    quantiles. Each level is one pass over blocks that sums histograms; to the driver come nodes x features x bins of them.
    An empty table or one class gives a constant.
    """
    quantiles = rows.select(*(F.col(n).cast("double").alias(n) for n in names)).approxQuantile(names, [k / width for k in range(1, width)], 0.001)
    count = rows.agg(F.sum(F.col(weight) * F.col(label)), F.sum(weight)).first()
    share = min(max((count[0] or 0.0) / (count[1] or 1.0), 1e-6), 1 - 1e-6)
    model = Booster(list(names), [sorted(set(q)) for q in quantiles], float(np.log(share / (1 - share))), [])
    if not count[0] or count[0] == count[1]:
        return model
    blocks, chance, held = _Blocks(rows, model, label, weight, width), np.random.default_rng(seed), np.array(rising)
    try:
        for k in range(rounds):
            tree, made, bounds = Tree(), blocks.round(seed + k, subsample), {0: (-np.inf, np.inf)}
            allowed = chance.random(len(names)) < columns
            allowed[chance.integers(len(names))] = True
            level = [0]
            for _ in range(depth):
                sums, following = blocks.sums(made, tree, level), []
                for node, s in zip(level, sums, strict=True):
                    best, f, b, vl, vr = _best(s, *bounds[node], held, allowed, reg, child)
                    if best <= gain + 1e-12:
                        continue
                    low, high = bounds[node]
                    pair = tree.split(node, f, b, (vl, vr))
                    middle = (vl + vr) / 2
                    bounds[pair[0]], bounds[pair[1]] = ((low, middle), (middle, high)) if held[f] else ((low, high), (low, high))
                    following += pair
                level = following
                if not level:
                    break
            if not isinstance(made, list):
                made.unpersist()
            if len(tree.feature) == 1:
                break
            tree.value = [v * rate for v in tree.value]
            model.trees.append(tree)
    finally:
        blocks.blocks.unpersist()
    return model
