"""Topics of dirty strings: Gamma-Poisson factorisation of hashed character n-grams.

The counts of a value's n-grams are Poisson with means h W: W has one row of n-gram probabilities per
topic, h is what the value has of each topic, with a Gamma prior. Both are found by multiplicative
updates. For fixed W the update of h belongs to one value alone and has a single optimum, so a
value's weights follow from its text and W: equal texts get equal rows, unseen texts are encoded like
any other, and no weights are kept between rounds. For fixed h the update of W is a sum over values,
which tasks add up as blocks of topics x cells. N-grams are hashed into a fixed number of cells, so no
vocabulary exists anywhere. The objective falls in every round.
"""

from __future__ import annotations

import base64
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlens.operators.blocks import array_total
from auditlens.operators.ordering import with_lookup
from auditlens.session import stored

CELLS = 4096
GRAMS = (2, 3, 4)
SHAPE, SCALE = 1.1, 1.0  # of the Gamma prior
INNER, TOLERANCE = 200, 1e-7
FLOOR = 1e-12


def gram_counts(text: str, cells: int = CELLS, grams: tuple[int, ...] = GRAMS) -> tuple[np.ndarray, np.ndarray]:
    """Cells and counts of the n-grams of a text, lower-cased and set between blanks."""
    marked = f" {text.lower().strip()} "
    found = [zlib.crc32(marked[i : i + n].encode("utf-8", "replace")) % cells for n in grams for i in range(len(marked) - n + 1)]
    return np.unique(np.array(found, np.int32), return_counts=True)


def _sparse(texts: list[str], cells: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row starts, cells, counts) of texts; every text has at least the gram of its blanks."""
    parts = [gram_counts(t, cells) for t in texts]
    start = np.cumsum([0, *[len(c) for c, _ in parts]])[:-1]
    return start, np.concatenate([c for c, _ in parts]), np.concatenate([n for _, n in parts]).astype(float)


def weights_of(matrix: np.ndarray, start: np.ndarray, cell: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Optimal topic weights of each row: updates until they stand still."""
    topics = len(matrix)
    row = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(cell))))
    part = matrix.T[cell]
    h = np.repeat(np.add.reduceat(count, start)[:, None] / topics, topics, axis=1)
    for _ in range(INNER):
        mean = (h[row] * part).sum(1)
        new = (SHAPE - 1 + h * np.add.reduceat((count / mean)[:, None] * part, start)) / (1 + 1 / SCALE)
        still = np.abs(new - h).max(initial=0) <= TOLERANCE * max(1.0, np.abs(h).max(initial=0))
        h = new
        if still:
            break
    return h


@dataclass
class TopicModel:
    """Fitted topics: rows of n-gram probabilities, and the objective after each round."""

    matrix: np.ndarray
    objective: list[float]

    def weights(self, texts: list[str]) -> np.ndarray:
        return weights_of(self.matrix, *_sparse(texts, self.matrix.shape[1])) if texts else np.zeros((0, len(self.matrix)))

    def encode(self, df: DataFrame, col: str, prefix: str | None = None) -> DataFrame:
        """Add ``<col>_topic_<i>``. Distinct texts are encoded once and joined; missing ones get 0."""
        matrix, topics = df.sparkSession.sparkContext.broadcast(self.matrix), len(self.matrix)
        names = [f"{prefix or col}_topic_{i}" for i in range(topics)]

        def scan(batches):
            model = TopicModel(matrix.value, [])
            for batch in batches:
                w = model.weights(batch.column(0).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(w[:, i]) for i in range(topics)]], ["_text", *names])

        texts = df.select(F.col(f"`{col}`").cast("string").alias("_text")).filter("_text IS NOT NULL").distinct()
        found = texts.mapInArrow(scan, ", ".join(["_text string", *[f"`{n}` double" for n in names]]))
        joined = with_lookup(df.withColumn("_text", F.col(f"`{col}`").cast("string")), found, ["_text"], "left")
        return joined.drop("_text").fillna(0.0, names)

    def state(self) -> dict:
        """Plain values for a metadata file."""
        packed = base64.b64encode(zlib.compress(np.ascontiguousarray(self.matrix, "<f8").tobytes())).decode()
        return {"topics": len(self.matrix), "cells": self.matrix.shape[1], "matrix": packed, "objective": self.objective}

    @staticmethod
    def from_state(state: dict) -> TopicModel:
        flat = np.frombuffer(zlib.decompress(base64.b64decode(state["matrix"])), "<f8")
        return TopicModel(flat.reshape(state["topics"], state["cells"]), list(state["objective"]))


def fit_topics(train: DataFrame, col: str, topics: int = 30, iterations: int = 20, cells: int = CELLS, seed: int = 42, tolerance: float = 1e-4) -> TopicModel:
    """Topics of a text column over all rows of ``train``; a value counts as often as it occurs.

    The matrix (topics x cells numbers) is sent out each round and comes back as a sum of blocks.
    Rounds end when the objective falls by less than ``tolerance`` of itself.
    """
    values = train.select(F.col(f"`{col}`").cast("string").alias("value")).filter("value IS NOT NULL").groupBy("value").agg(F.count("*").alias("n"))

    def count(batches):
        for batch in batches:
            parts = [gram_counts(t, cells) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array([c for c, _ in parts], pa.list_(pa.int32())), pa.array([k.astype(np.int32) for _, k in parts], pa.list_(pa.int32()))],
                ["n", "cells", "counts"],
            )

    rows = stored(values.mapInArrow(count, "n long, cells array<int>, counts array<int>"), "grams")

    def sparse(batch):
        size = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
        flat = [batch.column(i).flatten().to_numpy(zero_copy_only=False) for i in (1, 2)]
        return batch.column(0).to_numpy().astype(float), np.cumsum(size) - size, flat[0], flat[1].astype(float)

    def totals(batches):
        out = np.zeros(cells)
        for batch in batches:
            if batch.num_rows:
                n, start, cell, count = sparse(batch)
                out += np.bincount(cell, np.repeat(n, np.diff(np.append(start, len(cell)))) * count, cells)
        return out

    everywhere = array_total(rows, totals, (cells,))
    noise = np.random.default_rng(seed).gamma(1.0, size=(topics, cells))
    matrix = (everywhere + FLOOR) * noise
    matrix /= matrix.sum(1, keepdims=True)
    objective: list[float] = []
    for _ in range(iterations):
        shared = train.sparkSession.sparkContext.broadcast(matrix)

        def update(batches):
            w, out, loss = shared.value, np.zeros((topics, cells)), 0.0  # noqa: B023
            for batch in batches:
                if not batch.num_rows:
                    continue
                n, start, cell, count = sparse(batch)
                h = weights_of(w, start, cell, count)
                row = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(cell))))
                part = h[row] * w.T[cell]
                mean = part.sum(1)
                share = (n[row] * count / mean)[:, None] * part
                for k in range(topics):
                    out[k] += np.bincount(cell, share[:, k], cells)
                loss -= float((n[row] * count * np.log(mean)).sum())
                loss += float((n[:, None] * (h * (1 + 1 / SCALE) - (SHAPE - 1) * np.log(h))).sum())
            return np.append(out.ravel(), loss)

        total = array_total(rows, update, (topics * cells + 1,))
        shared.unpersist()
        objective.append(float(total[-1]))
        fresh = total[:-1].reshape(topics, cells) + FLOOR
        matrix = fresh / fresh.sum(1, keepdims=True)
        if len(objective) > 1 and objective[-2] - objective[-1] < tolerance * abs(objective[-2]):
            break
    return TopicModel(matrix, objective)
