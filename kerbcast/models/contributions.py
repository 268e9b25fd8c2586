"""Exact contributions of features to the predictions of boosted trees.

A feature's contribution is its Shapley value in the game whose players are the features of a row; features outside a
coalition are averaged over, by the weight of the training rows on either side of each split. In a tree the value is
an integral over the unit interval of a product with one factor per feature on the way to a leaf. The product is a
polynomial of a degree below the tree's depth, so a few Gauss-Legendre points integrate it exactly, and one walk down
and up each tree gives the values of all features for a whole batch of rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbcast.models.boosting import BoostedModel, Tree, binned, goes_left

#: Rows walked at once in a task.
ROWS_AT_ONCE = 2048


def _depth(nodes: np.ndarray) -> int:
    return int(nodes["id"].max()).bit_length() - 1


def _expected(tree: Tree, node: int = 0) -> float:
    """Mean value of the leaves below a node by the weight of their rows."""
    nodes = tree.nodes
    if nodes["feature"][node] < 0:
        return float(nodes["value"][node])
    children = (tree.left[node], tree.right[node])
    return sum(_expected(tree, c) * nodes["cover"][c] for c in children) / sum(nodes["cover"][c] for c in children)


def base_value(model: BoostedModel) -> float:
    """The prediction when nothing is known of a row."""
    return model.base + sum(_expected(Tree(n)) for n in model.trees)


def shapley(model: BoostedModel, bins: np.ndarray, trees: Sequence[Tree]) -> np.ndarray:
    """[rows, features] of contributions; with ``base_value`` they add up to the prediction."""
    out = np.zeros((len(bins), len(model.features)))
    points = {}
    for tree in trees:
        nodes, depth = tree.nodes, _depth(tree.nodes)
        if not depth:
            continue
        if depth not in points:
            # n points integrate polynomials up to degree 2 n - 1; the product has at most degree depth - 1.
            x, w = np.polynomial.legendre.leggauss(-(-depth // 2))
            points[depth] = ((x + 1) / 2, w / 2)
        u, w = points[depth]

        def walk(node: int, product: np.ndarray, known: dict[int, tuple[np.ndarray, float]]) -> np.ndarray:
            """The sum over the leaves below of value times product, after adding what its splits contribute."""
            record = nodes[node]
            if record["feature"] < 0:
                return product * record["value"]
            feature, total = int(record["feature"]), np.zeros_like(product)
            left = goes_left(model.layout, bins, np.broadcast_to(record, len(bins)))
            children = (tree.left[node], tree.right[node])
            weight = sum(float(nodes["cover"][c]) for c in children)
            follows, share = known.get(feature, (np.ones(len(bins)), 1.0))
            factor = share * (1 - u) + follows[:, None] * u
            for child, here in zip(children, (left, ~left)):
                goes, part = follows * here, share * float(nodes["cover"][child]) / weight
                narrower = part * (1 - u) + goes[:, None] * u
                below = walk(child, product / factor * narrower, known | {feature: (goes, part)})
                # The leaves below count with the deepest split on the feature, no longer with the one above.
                out[:, feature] += (goes - part) * (below / narrower @ w) - (follows - share) * (below / factor @ w)
                total += below
            return total

        walk(0, np.ones((len(bins), len(u))), {})
    return out


def tree_contributions(model: BoostedModel, df: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Per row ``base_value`` and ``contribution_*`` of every feature, which add up to the prediction of the fitted
    target (its logarithm, if that was fitted). Missing values go the way the splits learned."""
    trees = [Tree(n) for n in model.trees]

    @F.pandas_udf("array<double>")
    def values(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for batch in batches:
            bins = binned(model.cuts, batch.to_numpy(dtype=float, na_value=np.nan).T)
            parts = [shapley(model, bins[at:at + ROWS_AT_ONCE], trees) for at in range(0, len(bins), ROWS_AT_ONCE)]
            yield pd.Series(list(np.concatenate(parts)) if parts else [], dtype=object)

    columns = F.struct(*[F.col(f).cast("double").alias(f) for f in model.features])
    found = df.select(*carry, F.lit(base_value(model)).alias("base_value"), values(columns).alias("_values"))
    return found.select(*carry, "base_value", *[
        F.col("_values")[i].alias(f"contribution_{f}") for i, f in enumerate(model.features)])
