"""Boosted trees for two classes, grown a level at a time from sums over places of the inputs.

The parameters, the model and the algorithm (the first tree fits the labels as -1 and 1, the others the
gradients of the logistic loss, splits take most off the squared error) are those of Spark's classifier,
whose own fit passes rows as objects from the root again, in many jobs a round. Here tasks keep their rows
as small numbers, with node and margin beside them, about 50 bytes a row for ten bytes of inputs. Few rows
stay in one task for all rounds. More are dealt to tasks that keep them in files of their executor, and a
job a level adds up their sums; files that are lost are made again from the blocks and the trees so far.
"""

from __future__ import annotations

import json
import math
import shutil
import tempfile
import time
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlens.operators.forest import _MIX1, _mixed, drawn_slots, fit_inputs
from auditlens.session import fresh_path, stored

CHUNK = 1 << 16  # rows of one step of a task
TASK_ROWS = 3_000_000  # rows beyond which several tasks pay for a job a level
TRIES = 3  # how often lost rows are set up again
UNIT = float(1 << 18)  # residuals are multiples of 1 / UNIT of their range, so sums are exact in any order
COUNT = float(1 << 36)  # a row counts in the bits above the sum of a chunk
CELLS = 2048  # most cells of two columns that are counted together
PAIR_ROWS = 20_000  # rows from which that pays
DEEPEST = 10
GAIN_LEAST = 1e-12


@dataclass
class Layout:
    """Columns of small numbers: places among ``edges``, then bundles of 0/1 slots of which no row has two
    (0 is none, j the j-th). A candidate is a split: row j of ``left`` tells which numbers of all columns
    go left, ``column`` and ``right`` the numbers of its own column that go right."""

    sizes: list[int]
    left: np.ndarray
    slot: np.ndarray
    column: np.ndarray
    right: np.ndarray
    cut: np.ndarray


def layout_of(edges: dict[int, np.ndarray], bundles: list[list[int]]) -> Layout:
    sizes = [*[len(e) + 1 for e in edges.values()], *[len(b) + 1 for b in bundles]]
    starts = np.concatenate([[0], np.cumsum(sizes)])
    found = []  # slot, column, cut, numbers that go right
    for column, (slot, mine) in enumerate(edges.items()):
        found += [(slot, column, cut, range(cut + 1, len(mine) + 1)) for cut in range(len(mine))]
    for column, bundle in enumerate(bundles, len(edges)):
        found += [(slot, column, -1, [code]) for code, slot in enumerate(bundle, 1)]
    left, right = np.zeros((len(found), starts[-1])), np.zeros((len(found) + 1, 256), bool)  # the last: all left
    for j, (_, column, _, beyond) in enumerate(found):
        left[j, starts[column] : starts[column + 1]] = 1
        left[j, [starts[column] + b for b in beyond]] = 0
        right[j, list(beyond)] = True
    slot, column, cut = (np.array([f[i] for f in found], np.int64) for i in range(3))
    return Layout(sizes, left, slot, np.append(column, 0), right, cut)


def bundled(together: np.ndarray) -> list[list[int]]:
    """Runs of slots of which no two are 1 in the same row."""
    out: list[list[int]] = []
    for j in range(len(together)):
        if out and len(out[-1]) < 255 and not together[j, out[-1]].any():
            out[-1].append(j)
        else:
            out.append([j])
    return out


def counted_together(sizes: list[int], most: int) -> list[list[int]]:
    """Columns that share one count of cells, their number at most ``most`` where there are several."""
    out: list[list[int]] = []
    for c, size in enumerate(sizes):
        if out and len(out[-1]) < 2 and sizes[out[-1][0]] * size <= most:
            out[-1].append(c)
        else:
            out.append([c])
    return out


@dataclass
class Tree:
    """Nodes of a tree, node i with children 2i + 1 and 2i + 2; ``pick`` is -1 in a leaf."""

    pick: np.ndarray
    n: np.ndarray
    s: np.ndarray
    gain: np.ndarray


def best_candidates(n: np.ndarray, s: np.ndarray, layout: Layout, may: np.ndarray, least_rows: float, least_gain: float):
    """For sums (nodes, numbers of all columns) of rows and residuals: per node the candidate that takes
    most off the squared error (-1 if none), its gain a row, and rows and residuals to its left."""
    first = slice(0, layout.sizes[0])
    rows, total = n[:, first].sum(1, keepdims=True), s[:, first].sum(1, keepdims=True)
    ln = n @ layout.left.T
    ls = s @ layout.left.T
    # the columns of other candidates are 0 in a row of ``left``
    rn, rs = rows - ln, total - ls
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (ls * ls / ln + rs * rs / rn - total * total / rows) / rows
    gain[~((ln >= least_rows) & (rn >= least_rows) & may[:, layout.slot])] = -np.inf
    pick, node = gain.argmax(1), np.arange(len(gain))
    most = gain[node, pick]
    good = most > least_gain
    return np.where(good, pick, -1), np.where(good, most, 0.0), ln[node, pick], ls[node, pick]


def residuals(sign: np.ndarray, margin: np.ndarray) -> np.ndarray:
    """The gradient of the logistic loss over 4, in units."""
    return np.rint(sign * UNIT / (1.0 + np.exp(np.minimum(2.0 * sign * margin, 700.0))))


def in_sample(ids: np.ndarray, tree: int, seed: int, share: float) -> np.ndarray:
    """Whether each row is in a tree's sample, whichever task asks."""
    key = _mixed(np.array([seed * 1_000_003 + tree + 1], np.uint64))
    x = (ids ^ key) * _MIX1
    x = (x ^ (x >> np.uint64(32))) * _MIX1
    return (x >> np.uint64(32)) < np.uint64(int(share * 2**32))


@dataclass
class Held:
    """Rows of a task in arrays, the last three with a copy for every other step: a step that is done again
    reads what it read before."""

    ids: np.ndarray
    sign: np.ndarray
    flat: np.ndarray
    joint: np.ndarray
    weight: np.ndarray
    margin: np.ndarray
    node: np.ndarray
    done: np.ndarray  # tree and level of the last step

    @staticmethod
    def empty(n: int, columns: int, groups: int, depth: int, make: Callable = lambda name, kind, shape: np.zeros(shape, kind)) -> Held:
        kinds = {"ids": (np.uint64, (n,)), "sign": (np.int8, (n,)), "flat": (np.uint8, (n, columns)), "joint": (np.uint16, (groups, n)), "weight": (float, (n,)),
                 "margin": (float, (2, n)), "node": (np.uint8 if depth <= 8 else np.uint16, (2, n)), "done": (np.int64, (2,))}
        return Held(**{name: make(name, *kind) for name, kind in kinds.items()})

    @staticmethod
    def in_folder(folder: str, mode: str, n: int, columns: int, groups: int, depth: int) -> Held:
        def make(name, kind, shape):
            return np.memmap(f"{folder}/{name}", kind, mode, shape=shape) if n or name == "done" else np.zeros(shape, kind)

        return Held.empty(n, columns, groups, depth, make)


@dataclass
class Steps:
    """What tasks do with their rows."""

    sizes: list[int]
    column: np.ndarray  # of a candidate; the last stands for no split
    right: np.ndarray
    groups: list[list[int]]
    depth: int
    row_share: float
    seed: int

    def fill(self, held: Held, blocks: Iterator[tuple], hot: int, bundles: list[list[int]]) -> None:
        """Rows of the blocks into the arrays."""
        lo, numbers = 0, len(self.sizes) - len(bundles)
        for block, n, y, places, bits in blocks:
            rows = slice(lo, lo := lo + n)
            held.ids[rows] = _mixed((np.uint64(block) << np.uint64(20)) + np.arange(n, dtype=np.uint64))
            held.sign[rows] = np.unpackbits(np.frombuffer(y, np.uint8), count=n) * 2.0 - 1.0
            held.flat[rows, :numbers] = np.frombuffer(places, np.uint8).reshape(n, numbers)
            one = np.unpackbits(np.frombuffer(bits, np.uint8), count=n * hot).reshape(n, hot)
            for c, b in enumerate(bundles, numbers):
                held.flat[rows, c] = (one[:, b] * np.arange(1, len(b) + 1)).sum(1)
            for cell, g in zip(held.joint, self.groups):
                cell[rows] = held.flat[rows, g[0]]
                if len(g) == 2:
                    cell[rows] = cell[rows] * np.uint16(self.sizes[g[1]]) + held.flat[rows, g[1]]
        held.done[:] = -1, self.depth - 1

    def chunks(self, held: Held) -> list[slice]:
        return [slice(lo, min(lo + CHUNK, len(held.ids))) for lo in range(0, len(held.ids), CHUNK)]

    def moved(self, held: Held, rows: slice, level: int, picks: np.ndarray) -> np.ndarray:
        """Nodes of a chunk below a level, by the candidates of its nodes."""
        flat = held.flat[rows]
        at = np.arange(0, flat.size, flat.shape[1])
        if level == 0:
            return self.right[picks[0]].take(flat.ravel().take(at + self.column[picks[0]])).astype(np.int64)
        mine = held.node[level % 2, rows].astype(np.int64)
        own = flat.ravel().take(at + self.column.take(picks).take(mine))
        return 2 * mine + self.right.ravel().take((picks * 256).take(mine) + own)

    def weighed(self, held: Held, rows: slice, tree: int) -> None:
        sign = held.sign[rows].astype(float)
        r = residuals(sign, held.margin[tree % 2, rows]) if tree else sign * UNIT
        held.weight[rows] = np.where(in_sample(held.ids[rows], tree, self.seed, self.row_share), r + COUNT, 0.0)

    def sums(self, held: Held, tree: int, level: int, picks: np.ndarray | None, ends: np.ndarray | None) -> tuple[np.ndarray, np.ndarray] | None:
        """Rows and residuals by node of a level and number of all columns, below the root those of left
        children only. ``picks`` are the candidates of the nodes above, ``ends`` what the last tree adds
        to the margins. None if the rows are not where the step begins."""
        before = (tree, level - 1) if level else (tree - 1, self.depth - 1)
        if tuple(held.done) not in (before, (tree, level)):
            return None
        nodes, starts = 1 << level, np.concatenate([[0], np.cumsum(self.sizes)])
        n, s = np.zeros((2, nodes, starts[-1]))
        for rows in self.chunks(held):
            if level:
                mine = self.moved(held, rows, level - 1, picks)
                held.node[level % 2, rows] = mine
            else:
                if tree:
                    held.margin[tree % 2, rows] = held.margin[1 - tree % 2, rows] + ends.take(self.moved(held, rows, self.depth - 1, picks))
                self.weighed(held, rows, tree)
            w = held.weight[rows]
            for group, cell in zip(self.groups, held.joint):
                shape = [nodes, *[self.sizes[c] for c in group]]
                size = math.prod(shape[1:])
                total = np.bincount(mine * size + cell[rows] if level else cell[rows], w, nodes * size).reshape(shape)
                for k, c in enumerate(group):
                    part = total if len(group) == 1 else total.sum(2 - k)
                    count = np.floor(part / COUNT + 0.5)
                    n[:, starts[c] : starts[c + 1]] += count
                    s[:, starts[c] : starts[c + 1]] += part - count * COUNT
        held.done[:] = tree, level
        return (n[::2], s[::2]) if level else (n, s)

    def replayed(self, held: Held, tree: int, level: int, picks: list[list[np.ndarray]], ends: list[np.ndarray]) -> None:
        """Bring new rows to where they are after a step, by the candidates of all levels so far."""
        for rows in self.chunks(held):
            held.margin[:, rows] = 0.0
            for t in range(tree + 1):
                for at in range(self.depth if t < tree else level):
                    mine = self.moved(held, rows, at, picks[t][at])
                    if at + 1 < self.depth:
                        held.node[(at + 1) % 2, rows] = mine
                if t < tree:
                    held.margin[:, rows] = held.margin[0, rows] + ends[t].take(mine)
            self.weighed(held, rows, tree)
        held.done[:] = tree, level


@dataclass
class Growth:
    """What makes trees of sums."""

    layout: Layout
    rounds: int
    depth: int
    rate: float
    slot_share: int
    slots: int
    least_rows: int
    least_gain: float
    seed: int

    def trees(self, sums: Callable) -> list[Tree]:
        layout, depth, width = self.layout, self.depth, sum(self.layout.sizes)
        out, picks, ends = [], None, None
        for t in range(self.rounds):
            scale = (1.0 if t == 0 else 4.0) / UNIT
            least = max(self.least_gain / scale**2, GAIN_LEAST * UNIT**2)
            tree = Tree(*[np.full((2 << depth) - 1, v) for v in (-1, 0.0, 0.0, 0.0)])
            for level in range(depth):
                nodes, lo = 1 << level, (1 << level) - 1
                ln, ls = sums(t, level, picks, ends)
                if level == 0:
                    n, s = ln, ls
                    tree.n[0], tree.s[0] = n[0, : layout.sizes[0]].sum(), s[0, : layout.sizes[0]].sum()
                else:  # the right children have what their parents have beside the left ones
                    n, s = (np.stack([part, above - part], 1).reshape(nodes, width) for part, above in ((ln, n), (ls, s)))
                may = np.zeros((nodes, self.slots), bool)
                np.put_along_axis(may, drawn_slots(self.seed, t, level, self.slots, self.slot_share).T, True, 1)
                pick, gain, ln, ls = best_candidates(n, s, layout, may, self.least_rows, least)
                if level:
                    pick[np.repeat(tree.pick[(nodes >> 1) - 1 : lo] < 0, 2)] = -1
                own, split = slice(lo, lo + nodes), pick >= 0
                tree.pick[own], tree.gain[own] = pick, np.where(split, gain * scale**2, 0.0)
                child = 2 * np.flatnonzero(split) + 2 * lo + 1
                tree.n[child], tree.s[child] = ln[split], ls[split]
                tree.n[child + 1], tree.s[child + 1] = tree.n[own][split] - ln[split], tree.s[own][split] - ls[split]
                picks = np.where(split, pick, len(layout.slot))
            with np.errstate(divide="ignore", invalid="ignore"):
                value = tree.s * scale / tree.n
            for level in range(1, depth + 1):  # what a leaf passes on has its value
                own = np.arange((1 << level) - 1, (2 << level) - 1)
                above = (own - 1) // 2
                value[own] = np.where(tree.pick[above] < 0, value[above], value[own])
            ends = value[(1 << depth) - 1 :] * (self.rate if t else 1.0)
            tree.s *= scale
            out.append(tree)
        return out


class Dealt:
    """Rows in files of the executors, a folder a task. What makes the folders is kept as an RDD of their
    names, so steps go where the files are, and a lost executor's are made again."""

    def __init__(self, pairs: RDD, rows: list[int], steps: Steps, hot: int, bundles: list[list[int]]):
        self.pairs, self.rows, self.steps, self.rest = pairs, rows, steps, (hot, bundles)
        self.shape = len(steps.sizes), len(steps.groups), steps.depth
        self.past: tuple[list, list] = [], []
        self._set_up()

    def _set_up(self) -> None:
        rows, steps, rest, shape = self.rows, self.steps, self.rest, self.shape

        def filled(blocks):
            folder, n = tempfile.mkdtemp(prefix="boosting-"), rows[TaskContext.get().partitionId()]
            steps.fill(Held.in_folder(folder, "w+", n, *shape), (b for _, b in blocks), *rest)
            yield folder, n

        self.folders = self.pairs.partitionBy(len(rows), lambda k: k).mapPartitions(filled, True).persist(StorageLevel.MEMORY_AND_DISK)

    def _each(self, work: Callable) -> list:
        shape = self.shape

        def one(folders):
            for folder, n in folders:
                found = work(Held.in_folder(folder, "r+", n, *shape))
                yield found and zlib.compress(found[0].astype(np.int32).tobytes() + found[1].astype(np.int64).tobytes(), 1)

        for left in reversed(range(TRIES)):
            try:
                return self.folders.mapPartitions(one).collect()
            except Py4JJavaError:  # a task was put where its files are not
                if not left:
                    raise
                self.folders.unpersist()
                self._set_up()

    def sums(self, tree: int, level: int, picks: np.ndarray | None, ends: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        steps, (known, added) = self.steps, self.past
        before = (tree, level - 1) if level else (tree - 1, steps.depth - 1)
        if level == 0:
            known.append([])
        if tree or level:
            known[before[0]].append(picks)
        if tree and level == 0:
            added.append(ends)

        def replay(held):
            if tuple(held.done) not in (before, (tree, level)):
                steps.replayed(held, *before, known, added)

        for _ in range(TRIES):
            found = self._each(lambda held: steps.sums(held, tree, level, picks, ends))
            if None not in found:
                break
            self._each(replay)
        else:
            raise RuntimeError("rows of a fit were lost again and again")
        shape = max(1, (1 << level) // 2), sum(steps.sizes)
        n, s = np.zeros((2, *shape))
        for raw in map(zlib.decompress, found):
            n += np.frombuffer(raw, np.int32, n.size).reshape(shape)
            s += np.frombuffer(raw, np.int64, s.size, 4 * n.size).reshape(shape)
        return n, s

    def end(self) -> None:
        self.folders.foreach(lambda kept: shutil.rmtree(kept[0], ignore_errors=True))
        self.folders.unpersist()


def slot_share(strategy: str, slots: int) -> int:
    """Number of slots that may split a node, by Spark's names or a share or a number."""
    named = {"auto": slots, "all": slots, "sqrt": math.ceil(math.sqrt(slots)), "log2": max(1, math.ceil(math.log2(slots))), "onethird": math.ceil(slots / 3)}
    if strategy in named:
        return named[strategy]
    return min(slots, int(strategy)) if strategy.isdigit() else math.ceil(float(strategy) * slots)


class BoostedTrees(GBTClassifier):
    """Spark's classifier with another fit. What it does not know (weights, a validation column, texts as
    one slot of codes, very deep trees) goes to Spark's."""

    def _fit(self, dataset: DataFrame) -> GBTClassificationModel:
        get = self.getOrDefault
        attrs = dataset.schema[get("featuresCol")].metadata.get("ml_attr", {}).get("attrs", {})
        hot, numeric = (sorted(a["idx"] for a in attrs.get(kind, [])) for kind in ("binary", "numeric"))
        odd = any(self.isSet(p) for p in ("weightCol", "validationIndicatorCol", "thresholds", "leafCol")) or get("minWeightFractionPerNode") > 0
        if odd or attrs.keys() - {"binary", "numeric"} or not hot + numeric or get("maxDepth") not in range(1, DEEPEST + 1) or get("maxBins") > 256:
            return super()._fit(dataset)
        x, y = vector_to_array(get("featuresCol")), F.col(f"`{get('labelCol')}`").cast("double")
        rows = dataset.select(y.alias("y"), x.alias("x"))
        total, wrong = rows.agg(F.count("*"), F.count_if(F.coalesce(~F.col("y").isin(0.0, 1.0), F.lit(True)))).first()
        if wrong or not total:
            raise ValueError("boosted trees need rows, and a label of 0 or 1 in every row")
        numbers = rows.select(*[F.col("x")[i].alias(f"x{i}") for i in numeric])
        edges = dict(zip(numeric, fit_inputs(numbers, numbers.columns, [], get("maxBins")).edges))
        edges = {i: e[~np.isnan(e)] for i, e in edges.items()}
        blocks = stored(coded(rows, edges, hot), "boosting-rows")
        together = np.zeros((len(hot), len(hot)), bool)
        known = blocks.select("id", "rows", "together").collect()
        for block in known:
            together |= np.unpackbits(np.frombuffer(block["together"], np.uint8), count=together.size).reshape(together.shape).astype(bool)
        bundles = bundled(together)
        layout = layout_of(edges, [[hot[j] for j in b] for b in bundles])
        trees = self._grown(blocks, known, total, layout, bundles, len(hot)) if len(layout.slot) else None
        if trees is None:  # no input has two values
            return super()._fit(dataset)
        return self._kept(dataset.sparkSession, trees, layout, edges, len(hot) + len(numeric))

    def _grown(self, blocks: DataFrame, known: list, total: int, layout: Layout, bundles: list[list[int]], hot: int) -> list[Tree]:
        get = self.getOrDefault
        slots = len(layout.sizes) - len(bundles) + hot
        groups = counted_together(layout.sizes, CELLS if total >= PAIR_ROWS else 0)
        steps = Steps(layout.sizes, layout.column, layout.right, groups, get("maxDepth"), get("subsamplingRate"), get("seed"))
        growth = Growth(layout, get("maxIter"), get("maxDepth"), get("stepSize"), slot_share(get("featureSubsetStrategy"), slots), slots, get("minInstancesPerNode"), get("minInfoGain"), get("seed"))
        tasks = blocks.sparkSession.sparkContext.defaultParallelism if total > TASK_ROWS else 1
        order = sorted(known, key=lambda b: (-b["rows"], b["id"]))
        turn = {b["id"]: i % tasks for i, b in enumerate(order)}  # blocks by size, one to every task in turn
        pairs = blocks.select("id", "rows", "y", "places", "bits").rdd.map(lambda r: (turn[r[0]], tuple(r)))
        if tasks == 1:

            def whole(those):
                held = Held.empty(total, len(steps.sizes), len(groups), steps.depth)
                steps.fill(held, (b for _, b in those), hot, bundles)
                return growth.trees(lambda *step: steps.sums(held, *step))

            return pairs.coalesce(1).mapPartitions(whole).collect()
        dealt = Dealt(pairs, [sum(b["rows"] for b in order if turn[b["id"]] == i) for i in range(tasks)], steps, hot, bundles)
        try:
            return growth.trees(dealt.sums)
        finally:
            dealt.end()

    def _kept(self, spark: SparkSession, trees: list[Tree], layout: Layout, edges: dict[int, np.ndarray], slots: int) -> GBTClassificationModel:
        """The trees in the saved form of Spark's model, read by Spark. Impurities are not known (NaN),
        the gains are."""
        path, params = fresh_path(spark, "boosted"), {p.name: v for p, v in self._paramMap.items()}
        meta = {"timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "defaultParamMap": {"impurity": self.getOrDefault("impurity")}}
        rows = [row for t, tree in enumerate(trees) for row in node_rows(t, tree, layout, edges)]
        spark.createDataFrame(rows, NODES).coalesce(1).write.parquet(f"{path}/data")
        of_tree = {"class": "org.apache.spark.ml.regression.DecisionTreeRegressionModel", **meta, "paramMap": {k: v for k, v in params.items() if k in TREE_PARAMS}}
        own = [(t, json.dumps({**of_tree, "uid": f"{self.uid}_{t}"}), 1.0 if t == 0 else float(self.getOrDefault("stepSize"))) for t in range(len(trees))]
        spark.createDataFrame(own, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
        whole = {"class": "org.apache.spark.ml.classification.GBTClassificationModel", **meta, "uid": self.uid, "paramMap": params, "numFeatures": slots, "numTrees": len(trees)}
        spark.createDataFrame([(json.dumps(whole),)], "value string").coalesce(1).write.text(f"{path}/metadata")
        return GBTClassificationModel.load(path)


TREE_PARAMS = {"checkpointInterval", "featuresCol", "labelCol", "maxDepth", "minInfoGain", "minInstancesPerNode", "seed"}
NODES = ("treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, gain: double, "
         "leftChild: int, rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>")


def node_rows(number: int, tree: Tree, layout: Layout, edges: dict[int, np.ndarray]) -> list[tuple]:
    """The nodes of a tree in preorder, as Spark numbers them."""
    out: list[tuple] = []

    def walk(i: int) -> int:
        mine, pick = len(out), int(tree.pick[i])
        out.append(())
        split, sides, gain = (-1, [], -1), (-1, -1), -1.0
        if pick >= 0:
            slot, cut = int(layout.slot[pick]), int(layout.cut[pick])
            split = (slot, [float(edges[slot][cut])], -1) if cut >= 0 else (slot, [0.0], 2)
            sides, gain = (walk(2 * i + 1), walk(2 * i + 2)), float(tree.gain[i])
        n, s = float(tree.n[i]), float(tree.s[i])
        out[mine] = (number, (mine, s / n if n else 0.0, math.nan, [n, s, math.nan], int(n), gain, *sides, split))
        return mine

    walk(0)
    return out


def coded(rows: DataFrame, edges: dict[int, np.ndarray], hot: list[int]) -> DataFrame:
    """Blocks of up to ``CHUNK`` rows: labels and 0/1 slots as bits, numbers as places (missing ones
    beyond every edge), and which 0/1 slots are 1 in the same row."""

    def block(held: list[pa.RecordBatch], number: int) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        n, y = table.num_rows, table.column(0).to_numpy()
        x = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in table.column(1).chunks]).reshape(n, -1)
        places = np.column_stack([np.searchsorted(e, x[:, i]) for i, e in edges.items()] or [np.zeros((n, 0))]).astype(np.uint8)
        one = x[:, hot] == 1.0
        together = one.T.astype(np.float32) @ one.astype(np.float32) > 0
        parts = [np.packbits(y == 1.0), places, np.packbits(one), np.packbits(together)]
        columns = [pa.array([number], pa.int64()), pa.array([n], pa.int32()), *[pa.array([p.tobytes()], pa.binary()) for p in parts]]
        return pa.RecordBatch.from_arrays(columns, ["id", "rows", "y", "places", "bits", "together"])

    def work(batches):
        number, held, size = TaskContext.get().partitionId() << 20, [], 0
        for batch in batches:
            for lo in range(0, batch.num_rows, CHUNK):
                part = batch.slice(lo, CHUNK)
                if size + part.num_rows > CHUNK:
                    yield block(held, number)
                    number, held, size = number + 1, [], 0
                held.append(part)
                size += part.num_rows
        if size:
            yield block(held, number)

    return rows.mapInArrow(work, "id long, rows int, y binary, places binary, bits binary, together binary")
