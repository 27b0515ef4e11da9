"""Random forests of regression trees, grown a level at a time from sums over all rows.

Rows are kept as small numbers: the place of a number among the edges of its column, or the code of a
text. One pass a level adds up, for every open node, labels by place of the inputs drawn for it. The sums
of the tasks meet by tree and run of nodes, and the best split is taken there: only splits reach the
driver, at most 2^depth a tree, and the memory of a task does not grow with its rows.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlens.operators.encode import fit_categories
from auditlens.session import stored

CHUNK = 1 << 16  # rows of one step of a task
RUN = 64  # nodes whose sums meet in one group
TASK_ROWS = 2_000_000  # every task sends sums of all open nodes, so tasks are few
QUANTILES = 2048
STEP = 4096  # rows scored at a time
GAIN_LEAST = 1e-12  # of the spread of the labels: what rounding alone can make

_chance = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(16)])
#: Poisson draws of mean 1 for 16 random bits.
POISSON = np.searchsorted(_chance, (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.float64)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def row_draws(mixed_ids: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row is in a tree's sample (with replacement), whichever task asks."""
    key = _mixed(np.array([seed * 1_000_003 + tree + 1], np.uint64))
    x = (mixed_ids ^ key) * _MIX1
    x = (x ^ (x >> np.uint64(32))) * _MIX2
    return POISSON.take((x >> np.uint64(48)).astype(np.int64))


def drawn_slots(seed: int, tree: int, level: int, slots: int, share: int) -> np.ndarray:
    """(share, nodes): the slots that may split each node of a level."""
    order = np.random.default_rng([seed, tree, level]).random((1 << level, slots)).argsort(1)
    return np.ascontiguousarray(order[:, :share].T)


@dataclass
class Inputs:
    """Columns in the order of their slots: a number has one, a text one for each known value."""

    numeric: list[str]
    edges: list[np.ndarray]
    values: dict[str, list[str]]

    @property
    def slots(self) -> int:
        return len(self.numeric) + sum(map(len, self.values.values()))

    def names(self) -> list[str]:
        return [*self.numeric, *[f"{c}_oh_{v}" for c, known in self.values.items() for v in known]]

    def columns(self) -> list[Column]:
        return [*[F.col(f"`{c}`").cast("double") for c in self.numeric], *[F.col(f"`{c}`").cast("string") for c in self.values]]

    def places(self, cols: list[pa.Array]) -> list[np.ndarray]:
        """Missing numbers go beyond every edge; unknown and missing texts have no slot."""
        n = len(self.numeric)
        out = [np.searchsorted(edge, c.to_numpy(zero_copy_only=False)) for c, edge in zip(cols[:n], self.edges)]
        for c, known in zip(cols[n:], self.values.values()):
            out.append(pc.fill_null(pc.index_in(c, pa.array(known, c.type)), len(known)).to_numpy(zero_copy_only=False))
        return [p.astype(np.int32) for p in out]

    def flat(self, places: list[np.ndarray]) -> np.ndarray:
        """The places of all slots, row after row."""
        out, n = np.empty((len(places[0]), self.slots), np.uint8), len(self.numeric)
        for i, p in enumerate(places[:n]):
            out[:, i] = p
        at = n
        for p, known in zip(places[n:], self.values.values()):
            out[:, at : at + len(known)] = p[:, None] == np.arange(len(known))
            at += len(known)
        return out.ravel()


def cut_values(values: np.ndarray, counts: np.ndarray, bins: int) -> np.ndarray:
    """At most ``bins`` - 1 edges halfway between neighbours of the sorted ``values``, all of them if they
    are no more, else as near as can be to equal parts. After a value with the rows of several parts, the
    next values are cut one by one until the parts are made up for."""
    if len(values) <= bins:
        return (values[1:] + values[:-1]) / 2
    below, stride, out = counts.cumsum(), counts.sum() / bins, []
    for i in range(1, len(values)):
        target = stride * (len(out) + 1)
        if len(out) < bins - 1 and abs(below[i - 1] - target) < abs(below[i] - target):
            out.append((values[i - 1] + values[i]) / 2)
    return np.array(out, float)


def fit_inputs(train: DataFrame, numeric: list[str], text: list[str], bins: int) -> Inputs:
    """Edges that cut a number into ``bins`` parts of about equal rows, or between all its values if it has
    no more. Parts are made from ``QUANTILES`` quantiles of all rows."""
    x = {c: F.when(~F.isnan(F.col(f"`{c}`").cast("double")), F.col(f"`{c}`").cast("double")) for c in numeric}
    parts = F.array(*[F.lit((k + 0.5) / QUANTILES) for k in range(QUANTILES)])
    edges = []
    if numeric:
        row = train.agg(*[f for c in numeric for f in (F.approx_count_distinct(x[c]), F.percentile_approx(x[c], parts, 10_000))]).first()
    for i, c in enumerate(numeric):
        values, counts = np.unique(np.array(row[2 * i + 1] or [], float), return_counts=True)
        if row[2 * i] <= 2 * bins:  # an estimate; quantiles may miss rare values
            own = sorted(r[0] for r in train.select(x[c].alias("x")).filter("x IS NOT NULL").distinct().collect())
            if len(own) <= bins:
                values, counts = np.array(own, float), np.ones(len(own))
        edges.append(cut_values(values, counts, bins))
    return Inputs(list(numeric), edges, fit_categories(train, text))


def _walk(flat, at, feature, cut, depth: int) -> np.ndarray:
    """Nodes of the rows that begin at places ``at`` of ``flat``; leaves pass rows on to their left."""
    node = np.zeros(len(at), np.int64)
    for _ in range(depth):
        right = flat.take(at + feature.take(node)) > cut.take(node)
        node = 2 * node + 1 + right
    return node


@dataclass
class Forest:
    """Fitted trees as arrays: node i has children 2i + 1 (place <= ``cut``) and 2i + 2; a leaf has cut 255."""

    inputs: Inputs
    depth: int
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    def column(self) -> Column:
        inputs, depth, feature, cut = self.inputs, self.depth, self.feature, self.cut
        ends = np.ascontiguousarray(self.value[:, (1 << depth) - 1 :])

        @F.arrow_udf("double")
        def prediction(*cols: pa.Array) -> pa.Array:
            places, slots = inputs.places(cols), inputs.slots
            out = np.zeros(len(places[0]))
            for lo in range(0, len(out), STEP):
                flat = inputs.flat([p[lo : lo + STEP] for p in places])
                at = np.arange(0, len(flat), slots)
                for f, c, v in zip(feature, cut, ends):
                    out[lo : lo + STEP] += v.take(_walk(flat, at, f, c, depth) - (len(v) - 1))
            return pa.array(out / len(feature))

        return prediction(*inputs.columns())

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``prediction``, the mean over the trees."""
        return df.withColumn("prediction", self.column())

    def importances(self) -> dict[str, float]:
        """Share of the gain per slot, every tree counting alike."""
        total = np.zeros(self.inputs.slots)
        for f, g in zip(self.feature, self.gain):
            if g.sum() > 0:
                total += np.bincount(f, weights=g / g.sum(), minlength=len(total))
        return dict(zip(self.inputs.names(), (total / (total.sum() or 1.0)).tolist()))

    def save(self, spark: SparkSession, path: str) -> str:
        state = {"numeric": self.inputs.numeric, "edges": [e.tolist() for e in self.inputs.edges], "values": self.inputs.values, "depth": self.depth}
        state |= {c: getattr(self, c).tolist() for c in ("feature", "cut", "value", "gain")}
        spark.createDataFrame([(json.dumps(state),)], "value string").coalesce(1).write.mode("overwrite").text(path)
        return path

    @staticmethod
    def load(spark: SparkSession, path: str) -> Forest:
        state = json.loads(spark.read.text(path, wholetext=True).first()[0])
        inputs = Inputs(state["numeric"], [np.array(e, float) for e in state["edges"]], state["values"])
        return Forest(inputs, state["depth"], np.array(state["feature"], np.int64), np.array(state["cut"], np.uint8), np.array(state["value"]), np.array(state["gain"]))


def best_splits(n: np.ndarray, s: np.ndarray, least: float):
    """For sums (drawn inputs, nodes, places) of weights and labels: per node its rows, its mean and the
    input, place, mean left and right and gain of the split that takes most off the squared error; input
    -1 where none takes off more than ``least`` a row."""
    rows, label = n[0].sum(1), s[0].sum(1)
    ln, ls = n.cumsum(2)[:, :, :-1], s.cumsum(2)[:, :, :-1]
    rn, rs = rows[None, :, None] - ln, label[None, :, None] - ls
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = ls**2 / ln + rs**2 / rn - (label**2 / rows)[None, :, None]
        gain = np.where((ln > 0.5) & (rn > 0.5), gain, -np.inf).transpose(1, 0, 2)
        flat = gain.reshape(len(rows), -1)
        best, node = flat.argmax(1), np.arange(len(rows))
        pick, cut = np.divmod(best, gain.shape[2])
        most = flat[node, best]
        left, right = (ls / ln)[pick, node, cut], (rs / rn)[pick, node, cut]
        mean = label / rows
    return rows, mean, np.where(most > least * rows, pick, -1), cut, left, right, most


@dataclass
class ForestRegressor:
    """Forest of ``trees`` on samples drawn with replacement; a third of the slots may split a node."""

    label: str = "score"
    trees: int = 100
    depth: int = 10
    bins: int = 32
    seed: int = 42

    def fit(self, train: DataFrame, numeric: list[str], text: list[str]) -> Forest:
        spark, label = train.sparkSession, F.col(f"`{self.label}`").cast("double")
        inputs = fit_inputs(train, numeric, text, self.bins)
        n, mean, spread, known = train.agg(F.count("*"), F.avg(label), F.var_pop(label), F.count(label)).first()
        if not n or known < n or not inputs.slots:
            raise ValueError("a forest needs rows, inputs and a label in every row")
        cores = spark.sparkContext.defaultParallelism
        dealt = train.select(label.alias("y"), *[c.alias(f"c{i}") for i, c in enumerate(inputs.columns())]).repartition(cores * math.ceil(n / (cores * TASK_ROWS)))
        names = [f"c{i}" for i in range(len(inputs.columns()))]

        def coded(batches):
            for batch in batches:
                columns = [batch.column(0), pa.array(batch.column(1).to_numpy() - mean), *inputs.places(batch.columns[2:])]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], ["id", "y", *names])

        rows = dealt.select(F.monotonically_increasing_id().alias("id"), "y", *names).mapInArrow(coded, "id long, y double, " + ", ".join(f"{c} int" for c in names))
        rows = stored(rows, "forest-rows")
        nodes = (1 << self.depth) - 1
        feature, cut = np.zeros((self.trees, nodes), np.int64), np.full((self.trees, nodes), 255, np.uint8)
        gain, value = np.zeros((self.trees, nodes)), np.zeros((self.trees, 2 * nodes + 1))
        growing = np.zeros((self.trees, 2 * nodes + 1), bool)
        growing[:, 0] = True
        for level in range(self.depth):
            lo, hi = (1 << level) - 1, (1 << level + 1) - 1
            if not growing[:, lo:hi].any():
                break
            found = self._level(rows, inputs, feature, cut, growing, level, GAIN_LEAST * (spread or 0.0)).toPandas()
            tree, node = found["tree"].to_numpy(), found["node"].to_numpy()
            if level == 0:
                value[tree, node] = found["mean"]
            split = found[found["slot"] >= 0]
            tree, node = split["tree"].to_numpy(), split["node"].to_numpy()
            feature[tree, node], cut[tree, node], gain[tree, node] = split["slot"], split["cut"], split["gain"]
            for child, side in ((2 * node + 1, "left"), (2 * node + 2, "right")):
                value[tree, child], growing[tree, child] = split[side], True
        for level in range(1, self.depth + 1):  # what a leaf passes on has its value
            own = np.arange((1 << level) - 1, (1 << level + 1) - 1)
            value[:, own] = np.where(growing[:, own], value[:, own], value[:, (own - 1) // 2])
        return Forest(inputs, self.depth, feature, cut, value + mean, gain)

    def _level(self, rows: DataFrame, inputs: Inputs, feature, cut, growing, level: int, least: float) -> DataFrame:
        """The best split of every open node of a level."""
        shared = rows.sparkSession.sparkContext.broadcast((feature, cut, growing))
        trees, bins, seed, slots, width = self.trees, self.bins, self.seed, inputs.slots, 1 << level
        share = math.ceil(slots / 3) if trees > 1 else slots

        def chunks(batches):
            held, size = [], 0
            for batch in batches:
                held.append(batch)
                if (size := size + batch.num_rows) >= CHUNK:
                    yield pa.Table.from_batches(held).combine_chunks()
                    held, size = [], 0
            if size:
                yield pa.Table.from_batches(held).combine_chunks()

        def sums(batches):
            feature, cut, growing = shared.value
            picks = [drawn_slots(seed, t, level, slots, share) for t in range(trees)]
            n, s = np.zeros((2, trees, share, width * bins))
            for table in chunks(batches):
                ids = _mixed(table.column("id").to_numpy().view(np.uint64))
                y, flat = table.column("y").to_numpy(), inputs.flat([c.to_numpy() for c in table.columns[2:]])
                for t in range(trees):
                    weight = row_draws(ids, t, seed)
                    those = np.flatnonzero(weight)
                    at = those * slots
                    node = _walk(flat, at, feature[t], cut[t], level)
                    still = growing[t].take(node)
                    if not still.all():
                        those, at, node = those[still], at[still], node[still]
                    weight, node = weight.take(those), node - (width - 1)
                    labels, first = weight * y.take(those), node * bins
                    for j, pick in enumerate(picks[t]):
                        cell = first + flat.take(at + pick.take(node))
                        n[t, j] += np.bincount(cell, weight, width * bins)
                        s[t, j] += np.bincount(cell, labels, width * bins)
            for t in range(trees):
                out = []
                for run in range(0, width, RUN):
                    mine, label = (a[t].reshape(share, width, bins)[:, run : run + RUN].ravel() for a in (n, s))
                    at = np.flatnonzero(mine)
                    if len(at):
                        out.append((t, run, at.astype(np.int32).tobytes(), mine[at].tobytes(), label[at].tobytes()))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()))], ["tree", "run", "at", "n", "s"])

        def best(key, group):
            tree, run = (k.as_py() for k in key)
            shape = share, min(RUN, width - run), bins
            at = np.concatenate([np.frombuffer(b, np.int32) for b in group.column("at").to_pylist()])
            n, s = (np.bincount(at, np.concatenate([np.frombuffer(b) for b in group.column(c).to_pylist()]), math.prod(shape)).reshape(shape) for c in ("n", "s"))
            weight, mean, pick, cut, left, right, gain = best_splits(n, s, least)
            node = np.arange(len(weight))
            slot = np.where(pick >= 0, drawn_slots(seed, tree, level, slots, share)[pick, run + node], -1)
            columns = [np.full(len(node), tree), width - 1 + run + node, slot, cut]
            table = pa.table([pa.array(c.astype(np.int32)) for c in columns] + [pa.array(c) for c in (mean, left, right, gain)], ["tree", "node", "slot", "cut", "mean", "left", "right", "gain"])
            return table.filter(pa.array(weight > 0))

        sent = rows.mapInArrow(sums, "tree int, run int, at binary, n binary, s binary")
        return sent.groupBy("tree", "run").applyInArrow(best, "tree int, node int, slot int, cut int, mean double, left double, right double, gain double")
