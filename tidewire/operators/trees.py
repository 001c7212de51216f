"""Rows walked through decision trees: a batch of rows goes down one tree at a time, level by level.

The workers get this module by value, and of the trees plain arrays, so they need no package.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows that go down together: enough for whole arrays to pay, few enough to stay in a cache.
_ROWS = 10_000


def packed(nodes: pa.Table) -> dict:
    """Nodes of some trees (see ``model.forest_table``) as arrays, children as places in them.

    A leaf has feature -1; ``leaves`` holds its shares and a one. The last place stands for
    whatever is not there, such as a child that is not among the nodes, and counts nothing.
    """
    count = nodes.num_rows
    column = lambda name, none=0: nodes[name].combine_chunks().fill_null(none).to_numpy(zero_copy_only=False)
    tree = column("tree").astype(np.int64) << 32
    ids = tree | column("node")
    order = np.argsort(ids, kind="stable")
    ids = ids[order]

    def place(wanted: np.ndarray) -> np.ndarray:
        at = np.searchsorted(ids, wanted)
        return np.where(ids[np.minimum(at, count - 1)] == wanted, at, count).astype(np.int32)

    feature = np.append(column("feature", -1)[order], -1).astype(np.int32)
    leaf, of = feature[:-1] < 0, tree[order]
    children = np.full((count + 1, 2), count, np.int32)
    for side, name in enumerate(("left_child", "right_child")):
        children[:-1, side] = place(of + column(name)[order])
    shares = _matrix(nodes["shares"].combine_chunks())[order]
    leaves = np.zeros((count + 1, shares.shape[1] + 1))
    leaves[:-1][leaf] = np.column_stack([shares, np.ones(count)])[leaf]

    threshold = np.append(column("threshold", np.nan)[order], np.nan)
    listed = np.flatnonzero(~leaf & np.isnan(threshold[:-1]))
    accepted = np.full(count + 1, -1, np.int32)
    accepted[listed] = np.arange(len(listed))
    return {
        "roots": place(np.unique(of)),
        "feature": feature,
        "threshold": threshold,
        "children": children.ravel(),
        "leaves": leaves,
        "accepted": accepted,
        "values": _matrix(nodes["left_values"].combine_chunks().take(pa.array(order[listed]))),
        "width": int(feature.max(initial=0)) + 1,
    }


def _matrix(lists: pa.Array, least: int = 0) -> np.ndarray:
    """Lists of numbers as rows of a matrix, as wide as the longest one and ``least``.

    What a list lacks is not a number, which no comparison holds for.
    """
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False)
    width = max(least, int(sizes.max(initial=0)))
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.full((len(sizes), width), np.nan)
    out[np.arange(width) < sizes[:, None]] = values
    return out


def reached(rows: np.ndarray, forest: dict) -> np.ndarray:
    """For each row, the sum over trees of the shares at its leaf, then the number of trees."""
    feature, threshold, children = forest["feature"], forest["threshold"], forest["children"]
    accepted, values, leaves = forest["accepted"], forest["values"], forest["leaves"]
    flat, starts = rows.ravel(), np.arange(len(rows)) * rows.shape[1]
    everyone, ends = np.arange(len(rows)), np.empty(len(rows), np.int32)
    sums = np.zeros((len(rows), leaves.shape[1]))
    for root in forest["roots"]:
        here, at = everyone, np.full(len(rows), root, np.int32)
        while len(here):
            split = feature.take(at)
            ended = split < 0
            if ended.any():
                ends[here[ended]] = at[ended]
                going = np.flatnonzero(~ended)
                here, at, split = here.take(going), at.take(going), split.take(going)
            value = flat.take(starts.take(here) + split)
            right = ~(value <= threshold.take(at))
            listed = accepted.take(at)
            among = np.flatnonzero(listed >= 0)
            if len(among):
                right[among] = (value.take(among)[:, None] != values.take(listed.take(among), 0)).all(1)
            at = children.take(2 * at + right)
        sums += leaves.take(ends, 0)
    return sums


def walked(features: DataFrame, key: str, shared) -> DataFrame:
    """(key, _sums): what ``reached`` finds for each row of (key, features) in a broadcast of
    ``packed`` trees."""
    kind = features.select(key, F.array(F.lit(0.0)).alias("_sums")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                part = batch.slice(start, _ROWS)
                sums = reached(_matrix(part.column(1), forest["width"]), forest)
                offsets = pa.array(np.arange(len(sums) + 1) * sums.shape[1], pa.int32())
                lists = pa.ListArray.from_arrays(offsets, pa.array(sums.ravel()))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], names=[key, "_sums"])

    return features.select(key, "features").mapInArrow(run, kind)
