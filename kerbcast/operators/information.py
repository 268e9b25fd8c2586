"""Mutual information by nearest neighbours, without comparing all rows with all.

For every row the distance to its k-th nearest neighbour in the plane of feature and target (the larger of the two
differences) is found exactly: rows are dealt into cells of a tree of cuts, neighbours are searched inside the cell,
and a row whose search square crosses the cell's border asks the cells it touches for nearer ones. Then the rows that
are nearer than that in the feature alone, and in the target alone, are counted from ranks. Coordinates are whole
numbers, so distances and counts are exact and independent of how the rows were dealt.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbcast.functions.ordered import running_totals_of
from kerbcast.functions.scalars import as_value, clean_number
from kerbcast.session import written

#: Rows of a cell, on average; the largest number of cells per feature; rows sampled per cell to place the cuts.
CELL_ROWS, MOST_CELLS, SAMPLED = 1024, 4096, 24
#: Standard deviations are counted in units of 2 ** -UNIT_BITS; values beyond 2 ** 14 deviations are brought to it.
UNIT_BITS, REACH = 46, 2.0**14
#: Ties are broken by noise of this share of the mean absolute value.
NOISE = 1e-10
FAR = np.iinfo(np.int64).max


def _normal(keys: Sequence[str], salt: str) -> Column:
    """A normal deviate that depends on the key and the salt only."""
    first, second = (
        (F.shiftrightunsigned(F.xxhash64(*keys, F.lit(salt), F.lit(i)), 11).cast("double") + 0.5) / 2.0**53 for i in (1, 2))
    return F.sqrt(-2.0 * F.ln(first)) * F.cos(2.0 * math.pi * second)


def lattice_points(df: DataFrame, features: Sequence[str], target: str, keys: Sequence[str]) -> DataFrame:
    """(feature, row, x, y): both columns in population deviations, with noise, as whole numbers; nulls count as 0."""
    columns = [*features, target]
    values = {c: F.coalesce(clean_number(F.col(c)), F.lit(0.0)) for c in columns}
    scales = as_value(df.agg(*[
        F.struct(F.stddev_pop(v).alias("s"), F.avg(F.abs(v)).alias("m")).alias(f"c{i}")
        for i, v in enumerate(values.values())]))

    def placed(i: int, c: str) -> Column:
        spread = F.when(F.col(f"_scale.c{i}.s") > 0, F.col(f"_scale.c{i}.s")).otherwise(1.0)
        noise = NOISE * F.greatest(F.lit(1.0), F.col(f"_scale.c{i}.m") / spread) * _normal(keys, c)
        scaled = F.greatest(F.lit(-REACH), F.least(F.lit(REACH), values[c] / spread + noise))
        return F.round(scaled * 2.0**UNIT_BITS).cast("long")

    pairs = F.array(*[
        F.struct(F.lit(f).alias("feature"), placed(i, f).alias("x")) for i, f in enumerate(features)])
    rows = df.withColumn("_scale", scales).select(
        F.monotonically_increasing_id().alias("row"), placed(len(features), target).alias("y"), F.inline(pairs))
    return written(rows.select("feature", "row", "x", "y"), "lattice-points")


# --- cells -------------------------------------------------------------------------------------------------------

class Cuts:
    """Cells of the plane: a tree of cuts at medians of a sample, each across the longer side of its points."""

    def __init__(self, sample: np.ndarray, cells: int):
        self.axis, self.at, self.children, self.boxes = [], [], [], []
        whole = np.array([[-FAR, FAR], [-FAR, FAR]], dtype=np.int64)
        self._grow(sample, cells, whole)

    def _grow(self, points: np.ndarray, cells: int, box: np.ndarray) -> int:
        node = len(self.axis)
        for store in (self.axis, self.at, self.children, self.boxes):
            store.append(None)
        self.boxes[node], self.axis[node] = box, -1
        if cells > 1 and len(points) > 1:
            axis = int(np.argmax(points.max(axis=0).astype(float) - points.min(axis=0).astype(float)))
            at = int(np.sort(points[:, axis])[len(points) // 2])
            left = points[:, axis] < at
            if left.any():
                low, high = box.copy(), box.copy()
                low[axis, 1], high[axis, 0] = at - 1, at
                self.axis[node], self.at[node] = axis, at
                self.children[node] = (self._grow(points[left], cells // 2, low),
                                       self._grow(points[~left], cells - cells // 2, high))
        return node

    def cell_of(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), dtype=np.int64)
        open_ = [(0, np.arange(len(points)))]
        while open_:
            node, rows = open_.pop()
            if self.axis[node] < 0:
                out[rows] = node
                continue
            left = points[rows, self.axis[node]] < self.at[node]
            open_ += [(c, r) for c, r in zip(self.children[node], (rows[left], rows[~left])) if len(r)]
        return out

    def touched(self, points: np.ndarray, reach: np.ndarray, home: int) -> Iterator[tuple[int, np.ndarray]]:
        """(cell, rows) of the cells other than ``home`` that hold places nearer than ``reach``."""
        open_ = [(0, np.arange(len(points)))]
        while open_:
            node, rows = open_.pop()
            box, near = self.boxes[node], np.ones(len(rows), dtype=bool)
            for axis in (0, 1):
                place = points[rows, axis].astype(float)
                # Differences of more than 2 ** 53 are far beyond any exact comparison that matters here.
                gap = np.maximum(np.maximum(float(box[axis, 0]) - place, place - float(box[axis, 1])), 0)
                near &= gap * (1 - 1e-12) <= reach[rows]
            rows = rows[near]
            if not len(rows) or node == home:
                continue
            if self.axis[node] < 0:
                yield node, rows
            else:
                open_ += [(c, rows) for c in self.children[node]]


def nearest(points: np.ndarray, among: np.ndarray, k: int, itself: bool) -> np.ndarray:
    """[points, k] least distances, ascending; FAR where there are fewer. With ``itself`` the points are ``among``."""
    out = np.full((len(points), k), FAR, dtype=np.int64)
    step = max(1, (1 << 21) // max(1, len(among)))
    for at in range(0, len(points), step):
        part = points[at:at + step]
        gaps = np.maximum(np.abs(part[:, None, 0] - among[None, :, 0]), np.abs(part[:, None, 1] - among[None, :, 1]))
        if itself:
            gaps[np.arange(len(part)), at + np.arange(len(part))] = FAR
        have = min(k, gaps.shape[1])
        if have:
            out[at:at + step, :have] = np.sort(np.partition(gaps, have - 1, axis=1)[:, :have], axis=1)
    return out


def neighbour_distances(points: DataFrame, k: int, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(feature, row, x, y, distance) to the k-th nearest other row of the feature.

    The cuts come from a sample of at most ``SAMPLED * MOST_CELLS`` rows per feature; they decide where rows are
    compared, not which. Groups are cells, whose squares are searched in blocks.
    """
    sizes = {r["feature"]: r["n"] for r in points.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}
    cells = {f: min(MOST_CELLS, max(1, n // cell_rows)) for f, n in sizes.items()}
    share = max((min(1.0, SAMPLED * cells[f] / n) for f, n in sizes.items()), default=1.0)
    chance = F.pmod(F.xxhash64("row"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1
    sample = points.where(chance).select("feature", "x", "y").toPandas()
    cuts = {f: Cuts(g[["x", "y"]].to_numpy(dtype=np.int64), cells[f]) for f, g in sample.groupby("feature")}
    empty = Cuts(np.empty((0, 2), dtype=np.int64), 1)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for feature, part in batch.groupby("feature"):
                yield part.assign(cell=cuts.get(feature, empty).cell_of(part[["x", "y"]].to_numpy(dtype=np.int64)))

    dealt = written(points.mapInPandas(deal, "feature string, row long, x long, y long, cell long"), "dealt-points")

    def inside(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        tree, place = cuts.get(key[0], empty), group[["x", "y"]].to_numpy(dtype=np.int64)
        near = nearest(place, place, k, True)
        asked: list[list[int]] = [[] for _ in range(len(place))]
        for cell, rows in tree.touched(place, near[:, -1].astype(float), int(key[1])):
            for row in rows:
                asked[row].append(cell)
        lists = {n: pd.Series(list(v), index=group.index, dtype=object) for n, v in (("near", near), ("asked", asked))}
        return group.assign(**lists)[["feature", "row", "x", "y", "near", "asked"]]

    schema = "feature string, row long, x long, y long, near array<long>, asked array<long>"
    own = written(dealt.groupBy("feature", "cell").applyInPandas(inside, schema), "near-inside")
    asking = own.select("feature", "row", "x", "y", F.explode("asked").alias("cell"), F.col("near")[k - 1].alias("reach"))

    def outside(key: tuple, queries: pd.DataFrame, group: pd.DataFrame) -> pd.DataFrame:
        found = nearest(queries[["x", "y"]].to_numpy(dtype=np.int64), group[["x", "y"]].to_numpy(dtype=np.int64), k, False)
        better = found[:, 0] < queries["reach"].to_numpy(dtype=np.int64)
        out = queries[better][["feature", "row"]].astype({"feature": object, "row": np.int64})
        return out.assign(near=pd.Series(list(found[better]), index=out.index, dtype=object))

    more = (asking.groupBy("feature", "cell").cogroup(dealt.groupBy("feature", "cell"))
            .applyInPandas(outside, "feature string, row long, near array<long>"))
    others = more.groupBy("feature", "row").agg(F.flatten(F.collect_list("near")).alias("others"))
    every = F.array_sort(F.concat("near", F.coalesce("others", F.array().cast("array<bigint>"))))
    return own.join(others, ["feature", "row"], "left").select(
        "feature", "row", "x", "y", every[k - 1].alias("distance"))


# --- counts along one axis ---------------------------------------------------------------------------------------

def digamma(n: Column) -> Column:
    """The digamma function of a whole number from 1 on: the series at n + 12 and twelve steps down."""
    high = n.cast("double") + 12.0
    square = 1.0 / (high * high)
    series = F.ln(high) - 0.5 / high - square * (1 / 12 - square * (1 / 120 - square * (1 / 252 - square / 240)))
    for j in range(12):
        series = series - 1.0 / (n.cast("double") + float(j))
    return series


def neighbour_information(
    df: DataFrame, features: Sequence[str], target: str, keys: Sequence[str], k: int = 3, cell_rows: int = CELL_ROWS
) -> DataFrame:
    """(feature, mutual_information) in nats, not below 0, from the distances to the k-th nearest neighbours.

    Columns are divided by their population deviation; nulls count as 0; ties are broken by noise that depends on the
    row's ``keys``. With at most ``k`` rows the information is 0; without rows there is no feature.
    """
    points = lattice_points(df, features, target, keys)
    found = written(neighbour_distances(points, k, cell_rows).where(F.col("distance") < FAR), "neighbour-distances")
    # Strictly nearer; a row whose neighbours are equal to it counts the rows equal to it.
    reach = F.greatest(F.col("distance") - 1, F.lit(0))
    asked = found.select(
        "feature", "row",
        F.inline(F.array(*[
            F.struct(axis.alias("axis"), (F.col(c) - reach - 1).alias("below"), (F.col(c) + reach).alias("upto"))
            for axis, c in ((F.concat(F.lit("x:"), F.col("feature")), "x"), (F.lit("y"), "y"))])))
    asked = written(asked, "neighbour-ranges")
    one = points.agg(F.min("feature").alias("f")).first()["f"]
    values = points.select(F.concat(F.lit("x:"), F.col("feature")).alias("feature"), F.col("x").alias("value")).unionAll(
        points.where(F.col("feature") == one).select(F.lit("y"), "y"))
    ends = asked.select(F.col("axis").alias("feature"), F.explode(F.array("below", "upto")).alias("value"))
    ranks = written(running_totals_of(
        values.withColumn("here", F.lit(1)).unionAll(ends.withColumn("here", F.lit(0))), ["here"]).select(
            F.col("feature").alias("axis"), "value", F.col("here_upto").alias("rank")), "neighbour-ranks")

    def at(name: str) -> DataFrame:
        return ranks.select("axis", F.col("value").alias(name), F.col("rank").alias(f"{name}_rank"))

    counted = asked.join(at("below"), ["axis", "below"]).join(at("upto"), ["axis", "upto"])
    near = F.col("upto_rank") - F.col("below_rank")
    sums = counted.groupBy("feature").agg(F.sum(digamma(near)).alias("s"), (F.count(F.lit(1)) / 2).cast("long").alias("n"))
    value = digamma(F.col("n")) + digamma(F.lit(k)) - F.col("s") / F.col("n")
    every = points.select("feature").distinct()
    return every.join(sums, "feature", "left").select(
        "feature", F.greatest(F.lit(0.0), F.coalesce(value, F.lit(0.0))).alias("mutual_information"))
