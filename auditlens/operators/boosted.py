"""Margins of fitted boosted trees, a whole Arrow batch of rows at a time.

The ML stages score a row by building its vector and calling some functions on it, which costs
most of the time when rows are repeated for explanations. Here the columns of a batch stay columns.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.feature import OneHotEncoderModel, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from auditlens.session import fresh_path


class Trees(NamedTuple):
    """Leaves of all trees as bits. ``tables`` has one table per input: for every place of a value among
    the ``edges`` (or for every known text, and one for others) the leaves of every tree that it leaves
    open. What all inputs leave open is the leaf of the row.
    A table's row is ``words`` x trees numbers of 64 bits; ``values`` is trees x 64 ``words``."""

    edges: list[np.ndarray]
    tables: list[np.ndarray]
    values: np.ndarray
    words: int


def encoded_inputs(model: PipelineModel) -> tuple[list[str], dict[str, list[str]]] | None:
    """Numbers and texts (with their known values) in the order of the vector's slots, if the model
    is boosted trees behind ``encode.vector_stages``."""
    *made, last = model.stages
    if not made or not isinstance(last, GBTClassificationModel) or not isinstance(made[-1], VectorAssembler):
        return None
    *coded, assemble = made
    if assemble.getHandleInvalid() != "keep" or assemble.getOutputCol() != last.getFeaturesCol():
        return None
    if not coded:
        return assemble.getInputCols(), {}
    if [type(s) for s in coded] != [StringIndexerModel, OneHotEncoderModel]:
        return None
    index, hot = coded
    if index.getHandleInvalid() != "keep" or not hot.getDropLast() or hot.getInputCols() != index.getOutputCols():
        return None
    cols, n = assemble.getInputCols(), len(hot.getOutputCols())
    if cols[-n:] != hot.getOutputCols() or set(cols[:-n]) & {*index.getOutputCols(), *hot.getOutputCols()}:
        return None
    return cols[:-n], {c: list(values) for c, values in zip(index.getInputCols(), index.labelsArray)}


def fitted_trees(model: GBTClassificationModel, n_numeric: int, sizes: list[int]) -> Trees | None:
    """The trees from their saved form, over ``n_numeric`` numbers and texts with ``sizes`` known values;
    None if a split is not of that kind."""
    spark = SparkSession.active()
    path = fresh_path(spark, "trees")
    model.write().overwrite().save(path)
    rows = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").orderBy("treeID", "id").collect()
    slots = [(n_numeric + i, v) for i, size in enumerate(sizes) for v in range(size)]
    trees: dict[int, list] = {}
    for r in rows:  # a tree's nodes are numbered from 0
        trees.setdefault(r["treeID"], []).append(r)
    leaves: list[list[float]] = []
    closed: list[list[tuple]] = [[] for _ in range(n_numeric + len(sizes))]  # tree, edge or text, leaves closed beyond it and before

    def walk(tree, nodes, r) -> tuple[int, int] | None:
        """Range of the leaves below a node."""
        mine = leaves[tree]
        if r["leftChild"] < 0:
            mine.append(r["prediction"])
            return len(mine) - 1, len(mine)
        split, sides = r["split"], [nodes[r["leftChild"]], nodes[r["rightChild"]]]
        at, given = split["featureIndex"], split["leftCategoriesOrThreshold"]
        if (at < n_numeric) != (split["numCategories"] < 0) or at >= n_numeric and (split["numCategories"] != 2 or len(given) != 1):
            return None
        if at >= n_numeric and given[0] == 1.0:
            sides.reverse()  # 0 first
        first = walk(tree, nodes, sides[0])
        second = first and walk(tree, nodes, sides[1])
        if not second:
            return None
        where, value = (at, given[0]) if at < n_numeric else slots[at - n_numeric]
        closed[where].append((tree, value, first, second))
        return first[0], second[1]

    for tree, nodes in enumerate(trees[t] for t in sorted(trees)):
        leaves.append([])
        if not walk(tree, nodes, nodes[0]):
            return None
    words = -(-max(map(len, leaves)) // 64)
    full, n = (1 << 64 * words) - 1, len(leaves)
    edges, tables = [], []
    for i, those in enumerate(closed):
        found = sorted({v for _, v, *_ in those}) if i < n_numeric else list(range(sizes[i - n_numeric]))
        left = [[(1 << len(mine)) - 1 for mine in leaves] for _ in range(len(found) + 1)]
        at = {v: k for k, v in enumerate(found)}
        for tree, value, *sides in those:
            place, (beyond, before) = at[value], [full & ~((1 << hi) - (1 << lo)) for lo, hi in sides]
            for k, row in enumerate(left):
                row[tree] &= beyond if (k > place if i < n_numeric else k == place) else before
        edges.append(np.array(found, float))
        tables.append(np.array([[m >> 64 * w & (1 << 64) - 1 for w in range(words) for m in row] for row in left], np.uint64))
    weights = model.treeWeights
    values = np.zeros((n, 64 * words))
    for tree, mine in enumerate(leaves):
        values[tree, : len(mine)] = np.array(mine) * weights[tree]
    return Trees(edges, tables, values, words)


STEP_WORDS = 1 << 16  # of the rows scored at a time: their bits stay in the processor's cache


def margin_column(trees: Trees, numeric: list[str], texts: dict[str, list[str]]) -> Column:
    """The raw margin as a column. Missing numbers go beyond every edge and unknown or missing
    texts have all their slots at 0, as in the ML stages."""

    n, width = trees.values.shape
    first, step = np.arange(n) * width - 1023, max(16, STEP_WORDS // (n * trees.words))

    def margins(places):
        bits = trees.tables[0].take(places[0], axis=0)
        for table, place in zip(trees.tables[1:], places[1:]):
            bits &= table.take(place, axis=0)
        at = bits.astype(float).view(np.int64) >> 52  # the exponent of a power of two, 0 of an empty word
        leaf = at[:, :n]
        for w in range(1, trees.words):
            word = at[:, w * n : (w + 1) * n]
            leaf = np.where(word > 0, word + 64 * w, leaf)
        return trees.values.take(leaf + first).sum(1)

    @F.arrow_udf("double")
    def margin(*cols: pa.Array) -> pa.Array:
        places = [np.searchsorted(edge, c.to_numpy(zero_copy_only=False)) for c, edge in zip(cols[: len(numeric)], trees.edges)]
        for c, values in zip(cols[len(numeric) :], texts.values()):
            code = pc.index_in(c, pa.array(values, c.type))
            places.append(pc.fill_null(code, len(values)).to_numpy(zero_copy_only=False))
        out = np.empty(len(cols[0]))
        for at in range(0, len(out), step):
            out[at : at + step] = margins([p[at : at + step] for p in places])
        return pa.array(out)

    return margin(*[F.col(f"`{c}`").cast("double") for c in numeric], *[F.col(f"`{c}`").cast("string") for c in texts])
