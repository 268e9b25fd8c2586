"""Boosted regression trees with second-order gain, several fits in one series of jobs.

Rows are reduced to bins of their features. Every level of a tree is decided from sums of gradient and curvature
per (fit, node, feature, bin); Spark adds them up over all rows. As soon as the rows of a node number at most
``task_rows``, the node's whole subtree is grown inside one task, and a fit that starts with so few rows is boosted
to its end there, so that many small fits share one job. Gradients are whole multiples of a power of two: their
sums are exact, and the trees are equal whichever way, in whatever order and over however many tasks they are grown.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbcast.functions.ordered import running_totals_of
from kerbcast.schemas import COUNT
from kerbcast.session import fresh_path, written

#: Rows whose sums stay exact in doubles; also the largest ``task_rows`` and the largest batch.
EXACT_ROWS = 1 << 20
#: Rows of a block, which a task handles at once; fewer than half of those whose sums stay exact.
BLOCK_ROWS = 1 << 16
#: Bytes of a level's sums that come to the driver from all tasks at once; larger ones are added up by a shuffle.
DIRECT_BYTES = 16_000_000
#: Most combinations of bins of features that are counted together.
PACK_CELLS = 1 << 11
#: A gain must exceed this.
LEAST_GAIN = 1e-6
#: Trees after which the predictions of a fit spread over many tasks are written again.
REWRITE_EVERY = 20

NODE = np.dtype([
    ("id", "<i8"), ("feature", "<i2"), ("bin", "<i2"), ("missing_left", "?"), ("value", "<f8"), ("gain", "<f8"),
    ("cover", "<f8"),
])


@dataclass(frozen=True)
class Boosted:
    """Size and regularisation of the trees.

    ``penalty`` is added to the curvature of every leaf, ``least_weight`` is the least curvature of a child, ``bins``
    the number of value bins per feature; ``task_rows`` bounds the rows one task grows trees from, never the result.
    """

    trees: int = 300
    depth: int = 9
    rate: float = 0.05
    bins: int = 256
    penalty: float = 1.0
    least_weight: float = 1.0
    task_rows: int = 1 << 17

    def __post_init__(self):
        if not 1 <= self.task_rows <= EXACT_ROWS or not 2 <= self.bins < 1 << 15 or not 1 <= self.depth <= 30:
            raise ValueError(f"out of range: {self}")


@dataclass(frozen=True)
class Fit:
    """Rows to learn from and what to learn; rows without target or with a weight of 0 or null are left out."""

    rows: DataFrame
    features: tuple[str, ...]
    target: str = COUNT
    weight: str | None = None
    log_target: bool = False


@dataclass(frozen=True)
class Layout:
    """Where the bins of each feature lie in one flat row; each feature has a last slot for missing values."""

    sizes: tuple[int, ...]
    missing: bool
    cut: np.ndarray = field(init=False)
    base: np.ndarray = field(init=False)
    slot: np.ndarray = field(init=False)
    feature: np.ndarray = field(init=False)
    bin: np.ndarray = field(init=False)
    #: Features whose bins are counted together: as a joint table of few cells, or one feature alone.
    packs: tuple[tuple[int, ...], ...] = field(init=False)

    def __post_init__(self):
        packs: list[list[int]] = []
        for f in sorted(range(len(self.sizes)), key=lambda f: -self.sizes[f]):
            fitting = (p for p in packs if math.prod(self.sizes[k] + 1 for k in [*p, f]) <= PACK_CELLS)
            found = next(fitting, None)
            if found is None:
                packs.append([f])
            else:
                found.append(f)
        object.__setattr__(self, "packs", tuple(map(tuple, packs)))
        starts = self.starts
        parts = [(starts[f] + i, starts[f], starts[f] + b, f, i) for f, b in enumerate(self.sizes) for i in range(b)]
        for name, values in zip(("cut", "base", "slot", "feature", "bin"), zip(*parts)):
            object.__setattr__(self, name, np.array(values, dtype=np.int64))

    @property
    def starts(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum([b + 1 for b in self.sizes])]).astype(np.int64)

    @property
    def width(self) -> int:
        return int(self.starts[-1])


@dataclass(frozen=True)
class Setting:
    """What a task has to know of one fit."""

    layout: Layout
    base: float
    #: Gradients and curvatures are counted in units of 2 ** -bits.
    gradient_bits: int
    weight_bits: int
    rows: int
    #: The weight of all rows, if they have the same.
    weight: float | None = None

    @property
    def curvature(self) -> float | None:
        """The curvature of every row in whole units, if all rows have the same."""
        return None if self.weight is None else float(np.rint(self.weight * 2.0**self.weight_bits))


# --- inside a task -----------------------------------------------------------------------------------------------

def gradients(setting: Setting, margin: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weighted gradient and curvature of the squared error in whole units."""
    return (np.rint(w * (margin - y) * 2.0**setting.gradient_bits),
            np.rint(w * 2.0**setting.weight_bits))


def joint_sums(
    layout: Layout, bins: np.ndarray, place: np.ndarray, nodes: int, measures: Sequence[np.ndarray | None]
) -> list[list[np.ndarray]]:
    """Per pack of features the sums of each measure (None: number of rows) per node and combination of bins."""
    out, place, index = [], place.astype(np.int64, copy=False), np.empty(len(bins), dtype=np.int64)
    for pack in layout.packs:
        code, cells = bins[:, pack[0]], layout.sizes[pack[0]] + 1
        for f in pack[1:]:
            code, cells = code * np.int16(layout.sizes[f] + 1) + bins[:, f], cells * (layout.sizes[f] + 1)
        np.multiply(place, cells, out=index)
        np.add(index, code, out=index)
        out.append([np.bincount(index, m, nodes * cells)[:nodes * cells] for m in measures])
    return out


def flat_sums(layout: Layout, nodes: int, joint: list[list[np.ndarray]]) -> list[np.ndarray]:
    """The same per node and flat bin, as whole numbers."""
    starts = layout.starts
    out = [np.empty((nodes, layout.width), dtype=np.int64) for _ in joint[0]]
    for pack, sums in zip(layout.packs, joint):
        shape = [nodes, *(layout.sizes[f] + 1 for f in pack)]
        for total, cells in zip(out, sums):
            cells = cells.reshape(shape)
            for at, f in enumerate(pack, 1):
                total[:, starts[f]:starts[f + 1]] = cells.sum(axis=tuple(k for k in range(1, len(shape)) if k != at))
    return out


def histograms(
    layout: Layout, bins: np.ndarray, place: np.ndarray, nodes: int, *measures: np.ndarray | None
) -> list[np.ndarray]:
    """Sums of each measure (None: number of rows) per node and flat bin, as whole numbers."""
    return flat_sums(layout, nodes, joint_sums(layout, bins, place, nodes, measures))


def _sides(layout: Layout, sums: np.ndarray) -> np.ndarray:
    """Sum left of every cut, first with missing values on the right, then (if there are any) on the left."""
    upto = np.cumsum(sums, axis=1)
    left = upto[:, layout.cut] - upto[:, layout.base] + sums[:, layout.base]
    return np.concatenate([left, left + sums[:, layout.slot]], axis=1) if layout.missing else left


def best_splits(setting: Setting, spec: Boosted, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
    """(feature or -1, bin, missing_left, gain, column of the chosen cut) per node; of equal gains the first."""
    layout = setting.layout
    span = slice(layout.starts[0], layout.starts[1])
    unit_g, unit_h = 2.0**-setting.gradient_bits, 2.0**-setting.weight_bits
    all_g, all_h = (x[:, span].sum(axis=1)[:, None] for x in (g, h))
    left_g, left_h = _sides(layout, g), _sides(layout, h)

    def score(sum_g, sum_h):
        return np.square(sum_g * unit_g) / (sum_h * unit_h + spec.penalty)

    with np.errstate(divide="ignore", invalid="ignore"):
        gain = score(left_g, left_h) + score(all_g - left_g, all_h - left_h) - score(all_g, all_h)
    least = spec.least_weight / unit_h
    gain[(left_h < least) | (all_h - left_h < least) | np.isnan(gain)] = -np.inf
    chosen = gain.argmax(axis=1)
    top = gain[np.arange(len(gain)), chosen]
    cut = chosen % len(layout.cut)
    feature = np.where(top > LEAST_GAIN, layout.feature[cut], -1)
    return feature, layout.bin[cut], chosen >= len(layout.cut), top, chosen


def node_records(setting: Setting, spec: Boosted, ids, sum_g, sum_h, split=None) -> np.ndarray:
    """Records of nodes with the given sums; without ``split`` all are leaves."""
    nodes = np.zeros(len(ids), dtype=NODE)
    nodes["id"] = ids
    nodes["cover"] = sum_h * 2.0**-setting.weight_bits
    nodes["value"] = -spec.rate * (sum_g * 2.0**-setting.gradient_bits) / (nodes["cover"] + spec.penalty)
    nodes["feature"] = -1
    if split is not None:
        feature, cut, missing_left, gain, _ = split
        inner = feature >= 0
        for name, values in (("feature", feature), ("bin", cut), ("missing_left", missing_left), ("gain", gain)):
            nodes[name][inner] = values[inner]
    return nodes


class Turns:
    """Where the rows go right: those whose bin, less the lowest such bin, is below a node's span.

    Bins are counted modulo 2 ** 16, so bins below the lowest one come out above every span. The slot of missing
    values lies above all bins; it is within the span unless missing values go left. The span of a leaf is empty.
    """

    def __init__(self, layout: Layout, nodes: np.ndarray):
        inner = nodes["feature"] >= 0
        self.feature = np.where(inner, nodes["feature"], 0).astype(np.int64)
        low = np.where(inner, nodes["bin"].astype(np.int64) + 1, 0)
        top = np.array(layout.sizes, dtype=np.int64)[self.feature] + ~nodes["missing_left"]
        self.low = low.astype(np.uint16)
        self.span = np.where(inner, np.maximum(top - low, 0), 0).astype(np.uint16)

    def right(self, bins: np.ndarray, offset: np.ndarray, place: np.ndarray) -> np.ndarray:
        """``bins``: all bins in one row; ``offset``: where each row begins there; ``place``: its node."""
        index = self.feature.take(place)
        index += offset
        value = bins.take(index)
        value -= self.low.take(place)
        return value < self.span.take(place)


def _flat(bins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All bins in one row, and where each row begins there."""
    return np.ascontiguousarray(bins).reshape(-1).view(np.uint16), np.arange(len(bins)) * bins.shape[1]


def goes_left(layout: Layout, bins: np.ndarray, nodes: np.ndarray, place: np.ndarray | None = None) -> np.ndarray:
    """Whether each row goes left at its node, the one at ``place`` (None: its own one); of no meaning at leaves."""
    return ~Turns(layout, nodes).right(*_flat(bins), np.arange(len(bins)) if place is None else place)


def grow(
    setting: Setting, spec: Boosted, bins: np.ndarray, g: np.ndarray, h: np.ndarray, root: int = 1, level: int = 0
) -> tuple[np.ndarray, np.ndarray]:
    """The subtree below ``root`` from its rows, and the value each row ends with."""
    ids, place = np.array([root], dtype=np.int64), np.zeros(len(bins), dtype=np.int64)
    rows, value, grown = np.arange(len(bins)), np.zeros(len(bins)), []
    while len(ids):
        split = None
        if level < spec.depth:
            if setting.curvature is None:
                sums = histograms(setting.layout, bins, place, len(ids), g, h)
            else:
                sums = histograms(setting.layout, bins, place, len(ids), g, None)
                sums[1] *= int(setting.curvature)
            split = best_splits(setting, spec, *sums)
        sums = (np.bincount(place, x, len(ids)) for x in (g, h))
        nodes = node_records(setting, spec, ids, *sums, split)
        grown.append(nodes)
        inner = nodes["feature"] >= 0
        stays = ~inner[place]
        value[rows[stays]] = nodes["value"][place[stays]]
        rows, bins, g, h, place = (x[~stays] for x in (rows, bins, g, h, place))
        right = ~goes_left(setting.layout, bins, nodes, place)
        place = 2 * (np.cumsum(inner) - 1)[place] + right
        ids = (2 * ids[inner][:, None] + np.array([0, 1])).ravel()
        level += 1
    return np.concatenate(grown), value


def boost(setting: Setting, spec: Boosted, bins: np.ndarray, y: np.ndarray, w: np.ndarray) -> Iterator[np.ndarray]:
    """All trees of a fit from its rows."""
    margin = np.full(len(y), setting.base)
    for _ in range(spec.trees):
        nodes, value = grow(setting, spec, bins, *gradients(setting, margin, y, w))
        margin += value
        yield nodes


class Tree:
    """Nodes with the places of their children, for walking rows down."""

    def __init__(self, nodes: np.ndarray):
        self.nodes = nodes = np.sort(nodes, order="id")
        ids, inner = nodes["id"], nodes["feature"] >= 0
        here = np.arange(len(nodes))
        self.left, self.right = (np.where(inner, np.searchsorted(ids, 2 * ids + side), here) for side in (0, 1))

    def leaves(self, layout: Layout, bins: np.ndarray) -> np.ndarray:
        """Place of the leaf each row ends in."""
        at, ids = np.zeros(len(bins), dtype=np.int64), self.nodes["id"]
        turns, (flat, offset) = Turns(layout, self.nodes), _flat(bins)
        for _ in range(int(ids[-1]).bit_length() - int(ids[0]).bit_length()):
            right = turns.right(flat, offset, at)
            at = self.left.take(at)  # a leaf: itself; the right child stands behind the left one
            at += right
        return at

    def values(self, layout: Layout, bins: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(self.nodes["value"]).take(self.leaves(layout, bins))


def binned(cuts: Sequence[np.ndarray], columns: Iterable[np.ndarray]) -> np.ndarray:
    """Bin of each value: the number of cuts not above it; missing values get the slot behind the last bin."""
    out = [np.where(np.isnan(x), len(c) + 1, np.searchsorted(c, x, side="right")) for c, x in zip(cuts, columns)]
    return np.stack(out, axis=1).astype(np.int16)


def _bins_of(column, features: int) -> np.ndarray:
    """The int16 rows packed in a column of equally long bytes."""
    return np.frombuffer(b"".join(column), dtype="<i2").reshape(-1, features)


# --- the model ---------------------------------------------------------------------------------------------------

@dataclass
class BoostedModel:
    """Trees over bins; ``cuts`` are the lower ends of all bins but the first."""

    features: tuple[str, ...]
    cuts: list[np.ndarray]
    layout: Layout
    base: float
    trees: list[np.ndarray]

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``_prediction``; null and NaN go the way each node learned for missing values."""
        trees, model = [Tree(n) for n in self.trees], self

        @F.pandas_udf("double")
        def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            for batch in batches:
                bins = binned(model.cuts, batch.to_numpy(dtype=float, na_value=np.nan).T)
                margin = np.full(len(bins), model.base)
                for tree in trees:
                    margin += tree.values(model.layout, bins)
                yield pd.Series(margin)

        columns = F.struct(*[F.col(f).cast("double").alias(f) for f in self.features])
        return df.withColumn("_prediction", score(columns))

    def gains(self) -> np.ndarray:
        """Mean gain of the splits on each feature, as shares of their sum."""
        nodes = np.concatenate([n[n["feature"] >= 0] for n in self.trees] or [np.empty(0, dtype=NODE)])
        total, splits = (np.bincount(nodes["feature"], x, len(self.features)) for x in (nodes["gain"], None))
        mean = np.divide(total, splits, out=np.zeros(len(total)), where=splits > 0)
        return mean / mean.sum() if mean.sum() else mean


# --- all fits ----------------------------------------------------------------------------------------------------

def _cells(fits: Sequence[Fit]) -> DataFrame:
    """(fit, x, y, w) of all fits, written once."""
    parts = []
    for i, f in enumerate(fits):
        y = F.col(f.target).cast("double")
        x = [F.nanvl(F.col(c).cast("double"), F.lit(None)) for c in f.features]
        parts.append(f.rows.select(
            F.lit(i).alias("fit"), F.array(*x).alias("x"), (F.log1p(y) if f.log_target else y).alias("y"),
            (F.col(f.weight).cast("double") if f.weight else F.lit(1.0)).alias("w"),
        ))
    rows = reduce(DataFrame.unionAll, parts)
    return written(rows.where("y IS NOT NULL AND NOT isnan(y) AND w > 0"), "boosting-rows")


def _cuts(cells: DataFrame, fits: Sequence[Fit], spec: Boosted) -> list[list[np.ndarray]]:
    """Lower ends of the bins behind the first, per fit and feature.

    A feature with at most ``bins`` values has a bin per value; else bins hold about equally many rows. To the
    driver come at most ``bins`` numbers per fit and feature.
    """
    spread = cells.select("fit", F.posexplode("x").alias("f", "value")).where("value IS NOT NULL")
    long = spread.select(F.concat_ws(":", "fit", "f").alias("feature"), "value")
    values = written(long.distinct(), "boosting-values")
    wide = [r["feature"] for r in values.groupBy("feature").count().where(F.col("count") > spec.bins).collect()]
    lows = [values.where(~F.col("feature").isin(wide)).select("feature", F.col("value").alias("low"))]
    if wide:
        totals = running_totals_of(long.where(F.col("feature").isin(wide)))
        share = F.floor((F.col("n_upto") - F.col("n")) * spec.bins / F.col("n_total"))
        lows.append(totals.groupBy("feature", share.alias("share")).agg(F.min("value").alias("low")).drop("share"))
    cuts = [[np.empty(0)] * len(f.features) for f in fits]
    found: dict[str, list[float]] = {}
    for row in reduce(DataFrame.unionAll, lows).collect():
        found.setdefault(row["feature"], []).append(row["low"])
    for name, starts in found.items():
        fit, f = map(int, name.split(":"))
        cuts[fit][f] = np.array(sorted(starts)[1:])
    return cuts


def _settings(cells: DataFrame, cuts: list[list[np.ndarray]]) -> list[Setting]:
    """Base value, units and size of every fit: one row per fit comes to the driver."""
    exact = "decimal(38,12)"
    found = {r["fit"]: r for r in cells.groupBy("fit").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.abs("y")).alias("y"), F.max("w").alias("w"), F.min("w").alias("least_w"),
        F.sum((F.col("w") * F.col("y")).cast(exact)).cast("double").alias("wy"),
        F.sum(F.col("w").cast(exact)).cast("double").alias("sum_w"),
        F.max(F.exists("x", F.isnull)).alias("gap"),
    ).collect()}
    out = []
    for i, fit_cuts in enumerate(cuts):
        row = found.get(i)
        layout = Layout(tuple(len(c) + 1 for c in fit_cuts), bool(row and row["gap"]))
        if row is None:
            out.append(Setting(layout, 0.0, 0, 0, 0))
            continue

        def bits(largest: float) -> int:
            room = math.ceil(math.log2(largest)) if largest > 0 else 0
            return min(52 - room - EXACT_ROWS.bit_length(), 61 - room - int(row["n"]).bit_length())

        base = row["wy"] / row["sum_w"] if row["sum_w"] else 0.0
        out.append(Setting(layout, base, bits(4 * row["w"] * row["y"]), bits(row["w"]), row["n"],
                           row["w"] if row["w"] == row["least_w"] else None))
    return out


def fit_all(fits: Sequence[Fit], spec: Boosted | None = None) -> list[BoostedModel]:
    """One model per fit. A fit without rows predicts 0."""
    spec = spec or Boosted()
    if not fits:
        return []
    cells = _cells(fits)
    cuts = _cuts(cells, fits, spec)
    settings = _settings(cells, cuts)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fit = batch.column(0).to_numpy()
            for i in np.unique(fit):
                part = batch.filter(pa.array(fit == i))
                x = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(part.num_rows, -1)
                packed = [r.tobytes() for r in binned(cuts[i], x.T).astype("<i2")]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(packed, pa.binary()), part.column(2), part.column(3),
                     pa.array(np.full(part.num_rows, settings[i].base))],
                    ["fit", "bins", "y", "w", "margin"])

    rows = written(cells.mapInArrow(pack, "fit int, bins binary, y double, w double, margin double"), "boosting-bins")
    small = [i for i, s in enumerate(settings) if 0 < s.rows <= spec.task_rows]
    large = [i for i, s in enumerate(settings) if s.rows > spec.task_rows]
    trees: dict[int, list[np.ndarray]] = {i: [] for i in range(len(fits))}
    if small:
        trees |= _boost_in_tasks(rows.where(F.col("fit").isin(small)), settings, spec)
    if large:
        trees |= _boost_by_levels(rows.where(F.col("fit").isin(large)), settings, spec, large)
    return [BoostedModel(tuple(f.features), cuts[i], settings[i].layout, settings[i].base, trees[i])
            for i, f in enumerate(fits)]


def _boost_in_tasks(rows: DataFrame, settings: list[Setting], spec: Boosted) -> dict[int, list[np.ndarray]]:
    """Whole fits, each in one task; every group has at most ``task_rows`` rows."""

    def whole(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        setting = settings[key[0]]
        bins = _bins_of(group["bins"], len(setting.layout.sizes))
        grown = boost(setting, spec, bins, group["y"].to_numpy(), group["w"].to_numpy())
        return pd.DataFrame([(key[0], t, nodes.tobytes()) for t, nodes in enumerate(grown)],
                            columns=["fit", "tree", "nodes"])

    fits = rows.select("fit").distinct().count()
    # More partitions than fits, so that few fits share one.
    dealt = rows.select("fit", "bins", "y", "w").repartition(8 * fits, "fit")
    found = dealt.groupBy("fit").applyInPandas(whole, "fit int, tree int, nodes binary").collect()
    out: dict[int, list[np.ndarray]] = {}
    for row in sorted(found, key=lambda r: (r["fit"], r["tree"])):
        out.setdefault(row["fit"], []).append(np.frombuffer(bytes(row["nodes"]), dtype=NODE))
    return out


#: Rows of one fit as arrays: fit, bins, target, weight (None: the one weight all rows have), margin.
Block = tuple[int, np.ndarray, np.ndarray, np.ndarray | None, np.ndarray]


def _blocks(rows: DataFrame, shared: Broadcast) -> RDD:
    """The rows as blocks, which are read, routed and advanced without a plan or a row object each."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[pa.RecordBatch]] = {}

        def block(fit: int) -> pa.RecordBatch:
            part = pa.Table.from_batches(held.pop(fit))
            packed = [b"".join(part.column(1).to_pylist()), *(part.column(c).to_numpy().tobytes() for c in (2, 3, 4))]
            if shared.value[fit].weight is not None:
                packed[2] = b""
            return pa.RecordBatch.from_arrays(
                [pa.array([fit], pa.int32()), *(pa.array([x], pa.binary()) for x in packed)],
                ["fit", "bins", "y", "w", "margin"])

        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK_ROWS):
                batch = whole.slice(at, BLOCK_ROWS)
                fit = batch.column(0).to_numpy()
                for i in np.unique(fit).tolist():
                    held.setdefault(i, []).append(batch.filter(pa.array(fit == i)))
                    if sum(b.num_rows for b in held[i]) >= BLOCK_ROWS:
                        yield block(i)
        for i in list(held):
            yield block(i)

    def unpacked(row) -> Block:
        setting = shared.value[row["fit"]]
        y, w, margin = (np.frombuffer(bytes(row[c]), dtype="<f8") for c in ("y", "w", "margin"))
        bins = _bins_of([bytes(row["bins"])], len(setting.layout.sizes))
        return row["fit"], bins, y, w if setting.weight is None else None, margin

    found = rows.mapInArrow(gather, "fit int, bins binary, y binary, w binary, margin binary").rdd.map(unpacked)
    parts = max(found.getNumPartitions(), rows.sparkSession.sparkContext.defaultParallelism)

    def dealt(part: int, blocks: Iterator[Block]) -> Iterator[tuple[int, Block]]:
        return (((part + k) % parts, block) for k, block in enumerate(blocks))

    # Files are of any sizes; every level waits for the task with the most rows.
    return found.mapPartitionsWithIndex(dealt).partitionBy(parts, int).values()


def _boost_by_levels(
    rows: DataFrame, settings: list[Setting], spec: Boosted, large: list[int]
) -> dict[int, list[np.ndarray]]:
    """All large fits in step: a job per level while nodes are large, one more for all subtrees that fit a task.

    The blocks of a tree's margins stay with the executors until the next tree has theirs; every so many trees they
    are written, so that a lost one is not made anew from the first tree on.
    """
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(settings)
    trees: dict[int, list[np.ndarray]] = {i: [] for i in large}
    before, blocks = None, _blocks(rows, shared).persist(StorageLevel.MEMORY_AND_DISK)
    for t in range(1, spec.trees + 1):
        grown = _one_tree_each(blocks, shared, spec, large)
        for i in large:
            trees[i].append(grown[i])
        if before is not None:
            before.unpersist()
        before, blocks = blocks, _advanced(blocks, shared, grown)
        if t % REWRITE_EVERY == 0 and t < spec.trees:
            path = fresh_path(spark, "boosting-margins")
            blocks.saveAsPickleFile(path, 1)
            # Read back in as many tasks as before, however the files are split.
            blocks = spark.sparkContext.pickleFile(path).coalesce(before.getNumPartitions())
        blocks.persist(StorageLevel.MEMORY_AND_DISK)
    for held in (before, blocks):
        if held is not None:
            held.unpersist()
    return trees


def _advanced(blocks: RDD, shared: Broadcast, grown: dict[int, np.ndarray]) -> RDD:
    """The blocks with the newest tree of each fit added to their margins."""

    def add(part: Iterator[Block]) -> Iterator[Block]:
        trees = {i: Tree(nodes) for i, nodes in grown.items()}
        for fit, bins, y, w, margin in part:
            yield fit, bins, y, w, margin + trees[fit].values(shared.value[fit].layout, bins)

    return blocks.mapPartitions(add)


def _one_tree_each(blocks: RDD, shared: Broadcast, spec: Boosted, large: list[int]) -> dict[int, np.ndarray]:
    """The next tree of every fit. Splits come to the driver, one row per node; sums and rows do not."""
    nodes: dict[int, list[np.ndarray]] = {i: [] for i in large}
    wide: dict[int, list[int]] = {i: [1] for i in large}
    narrow: dict[int, list[int]] = {i: [] for i in large}
    level = 0
    while any(wide.values()):
        decided = _level(blocks, shared, spec, nodes, wide)
        following: dict[int, list[int]] = {i: [] for i in large}
        level += 1
        for i, (record, *children), *counts in decided:
            nodes[i].append(np.array([record]))
            if record["feature"] < 0:
                continue
            for child, count in zip(children, counts):
                if level == spec.depth:
                    nodes[i].append(np.array([child]))
                else:
                    (following if count > spec.task_rows else narrow)[i].append(int(child["id"]))
        wide = following
    if any(narrow.values()):
        for i, grown in _subtrees(blocks, shared, spec, nodes, narrow):
            nodes[i].append(grown)
    return {i: np.concatenate(nodes[i]) for i in large}


def _router(nodes: dict[int, list[np.ndarray]], ends: dict[int, list[int]]) -> Callable[[int], Tree]:
    """The unfinished tree of a fit; nodes still open are its leaves."""

    def of(fit: int) -> Tree:
        open_nodes = np.zeros(len(ends[fit]), dtype=NODE)
        open_nodes["id"], open_nodes["feature"] = ends[fit], -1
        known = nodes[fit]
        ids = {int(n["id"][0]) for n in known} | set(ends[fit])
        lost = [c for n in known if n["feature"][0] >= 0 for c in (2 * int(n["id"][0]), 2 * int(n["id"][0]) + 1)
                if c not in ids]
        others = np.zeros(len(lost), dtype=NODE)
        others["id"], others["feature"] = lost, -1
        return Tree(np.concatenate([*known, open_nodes, others]))

    return of


def _open(ends: dict[int, list[int]]) -> tuple[list[tuple[int, int]], dict[int, tuple[np.ndarray, int]]]:
    """(fit, id) of the open nodes; of each fit the ids, ascending, and the place of its first one."""
    keys = [(fit, node) for fit, ids in ends.items() for node in sorted(ids)]
    first = {fit: next(k for k, key in enumerate(keys) if key[0] == fit) for fit, ids in ends.items() if ids}
    return keys, {fit: (np.sort(np.array(ends[fit], dtype=np.int64)), k) for fit, k in first.items()}


def _places(tree: Tree, ids: np.ndarray) -> np.ndarray:
    """For each node of the tree its place among ``ids``, or the number of ``ids`` if it is not there."""
    place = np.minimum(np.searchsorted(ids, tree.nodes["id"]), len(ids) - 1)
    return np.where(ids[place] == tree.nodes["id"], place, len(ids))


def _measures(setting: Setting, y: np.ndarray, w: np.ndarray | None, margin: np.ndarray) -> tuple[np.ndarray, ...]:
    """Gradients, and curvatures if they differ."""
    if w is not None:
        return gradients(setting, margin, y, w)
    g = margin - y
    g *= setting.weight
    g *= 2.0**setting.gradient_bits
    return (np.rint(g, out=g),)


def _level(
    blocks: RDD, shared: Broadcast, spec: Boosted, nodes: dict[int, list[np.ndarray]], wide: dict[int, list[int]]
) -> list[tuple[int, np.ndarray, int, int]]:
    """(fit, nodes, rows left, rows right) of all wide nodes, decided from the sums of all rows.

    ``nodes`` are the node and its two children as leaves, which they are if the tree may grow no deeper.
    """
    tree_of = _router(nodes, wide)
    trees = {i: tree_of(i) for i, open_ids in wide.items() if open_ids}
    keys, places = _open(wide)

    def sums(part: Iterator[Block]) -> Iterator[tuple[int, np.ndarray]]:
        totals: dict[int, list[list[np.ndarray]]] = {}
        place_of = {i: _places(tree, places[i][0]) for i, tree in trees.items()}
        for fit, bins, *arrays in part:
            if fit not in trees:
                continue
            setting, n_open = shared.value[fit], len(places[fit][0])
            place = place_of[fit].take(trees[fit].leaves(setting.layout, bins))
            measures = _measures(setting, *arrays)
            nodes_here = n_open + 1  # the last one takes the rows that are elsewhere
            if 2 * np.count_nonzero(place < n_open) < len(place):
                here, nodes_here = np.flatnonzero(place < n_open), n_open
                place, bins, *measures = (x.take(here, axis=0) for x in (place, bins, *measures))
            new = joint_sums(setting.layout, bins, place, nodes_here, (*measures, None))
            new = [[x[:len(x) // nodes_here * n_open] for x in pack] for pack in new]
            if fit not in totals:
                totals[fit] = [[x.astype(np.int64) for x in pack] for pack in new]
            else:
                for a, b in ((a, b) for total, pack in zip(totals[fit], new) for a, b in zip(total, pack)):
                    np.add(a, b, out=a, casting="unsafe")  # whole numbers
        for fit, joint in totals.items():
            flat = flat_sums(shared.value[fit].layout, len(places[fit][0]), joint)
            for k in np.flatnonzero(flat[-1].any(axis=1)).tolist():
                yield places[fit][1] + k, np.stack([x[k] for x in flat])

    def choose(found: tuple[int, np.ndarray]) -> tuple[int, np.ndarray, int, int]:
        (fit, node_id), (g, *h, n) = keys[found[0]], found[1][:, None, :]
        setting = shared.value[fit]
        layout = setting.layout
        h = h[0] if h else n * int(setting.curvature)
        split = best_splits(setting, spec, g, h)
        span = slice(layout.starts[0], layout.starts[1])
        all_g, all_h, all_n = (x[0, span].sum() for x in (g, h, n))
        left_g, left_h, left_n = (_sides(layout, x)[0, split[4][0]] for x in (g, h, n))
        node = node_records(setting, spec, [node_id], np.array([all_g]), np.array([all_h]), split)
        children = node_records(setting, spec, [2 * node_id, 2 * node_id + 1], np.array([left_g, all_g - left_g]),
                                np.array([left_h, all_h - left_h]))
        return fit, np.concatenate([node, children]), int(left_n), int(all_n - left_n)

    partial, tasks = blocks.mapPartitions(sums), blocks.getNumPartitions()
    if 24 * tasks * sum(shared.value[fit].layout.width for fit, _ in keys) > DIRECT_BYTES:
        return partial.reduceByKey(np.add, max(1, min(len(keys), tasks))).map(choose).collect()
    total: dict[int, np.ndarray] = {}
    for k, found in partial.collect():
        total[k] = total[k] + found if k in total else found
    return [choose(found) for found in total.items()]


def _subtrees(
    blocks: RDD, shared: Broadcast, spec: Boosted, nodes: dict[int, list[np.ndarray]], narrow: dict[int, list[int]]
) -> list[tuple[int, np.ndarray]]:
    """(fit, nodes) of the subtrees below all narrow nodes, each grown in one task from at most ``task_rows`` rows."""
    tree_of = _router(nodes, narrow)
    trees = {i: tree_of(i) for i, open_ids in narrow.items() if open_ids}
    keys, places = _open(narrow)

    def routed(part: Iterator[Block]) -> Iterator[tuple[int, tuple[np.ndarray, ...]]]:
        for fit, *arrays in part:
            if fit not in trees:
                continue
            ids, first = places[fit]
            setting = shared.value[fit]
            place = _places(trees[fit], ids).take(trees[fit].leaves(setting.layout, arrays[0]))
            here = np.flatnonzero(place < len(ids))
            place, *moved = (x.take(here, axis=0) for x in (place, arrays[0], *_measures(setting, *arrays[1:])))
            order = np.argsort(place, kind="stable")
            cuts = np.searchsorted(place[order], np.arange(len(ids) + 1))
            for k, (a, b) in enumerate(zip(cuts.tolist(), cuts.tolist()[1:])):
                if a < b:
                    yield first + k, tuple(x[order[a:b]] for x in moved)

    def finish(group: tuple[int, Iterable[tuple[np.ndarray, ...]]]) -> tuple[int, np.ndarray]:
        fit, root = keys[group[0]]
        setting = shared.value[fit]
        bins, g, *h = (np.concatenate(x) for x in zip(*group[1]))
        h = h[0] if h else np.full(len(g), setting.curvature)
        return fit, grow(setting, spec, bins, g, h, root, root.bit_length() - 1)[0]

    dealt = min(len(keys), 4 * blocks.getNumPartitions())
    return blocks.mapPartitions(routed).groupByKey(max(1, dealt)).map(finish).collect()
