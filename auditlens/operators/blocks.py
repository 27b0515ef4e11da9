"""Sums of fixed-size arrays over a whole table."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def array_total(rows: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], np.ndarray], shape: tuple[int, ...], depth: int = 3) -> np.ndarray:
    """Sum of ``work(batches)`` over all tasks.

    ``work`` turns the Arrow batches of a task into one array of ``shape``, however many rows there
    are. A task sends one packed block, and blocks are added in a tree, so neither the driver nor one
    task takes in a block from every other.
    """

    def scan(batches):
        block = np.ascontiguousarray(work(batches), "<f8")
        yield pa.RecordBatch.from_arrays([pa.array([block.tobytes()], pa.binary())], ["block"])

    blocks = rows.mapInArrow(scan, "block binary").rdd.map(lambda row: np.frombuffer(row[0], "<f8"))
    if blocks.getNumPartitions() == 0:
        return np.zeros(shape)
    return blocks.treeReduce(np.add, depth).reshape(shape)
