"""Black-box model, surrogates and what they reveal about themselves."""

from __future__ import annotations

import json
import math

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from auditlens.functions.expr import ratio
from auditlens.operators.blocks import array_total
from auditlens.operators.boosting import BoostedTrees
from auditlens.operators.encode import feature_names, fit_limits, vector_stages
from auditlens.operators.forest import ForestRegressor
from auditlens.operators.metrics import regression_fit
from auditlens.operators.scorers import ExprScorer
from auditlens.session import fresh_path, stored


TASK_ROWS = 500_000  # training rows of one partition; Spark keeps about 450 bytes a row of them


def fit_model(train: DataFrame, estimator, numeric: list[str], text: list[str], task_rows: int = TASK_ROWS) -> PipelineModel:
    """Fitted pipeline. A fit keeps its rows in memory and passes over them many times, and a few MB of a
    file hold millions of rows: beyond ``task_rows`` rows a partition they are dealt to more of them."""
    parts = math.ceil(train.count() / task_rows)
    if parts > 1 and parts > train.rdd.getNumPartitions():
        train = train.repartition(parts)
    return Pipeline(stages=[*vector_stages(numeric, text), estimator]).fit(train)


def black_box(
    label: str = "target",
    rounds: int = 800,
    depth: int = 7,
    rate: float = 0.08,
    row_share: float = 0.85,
    column_share: str = "0.85",
    min_gain: float = 0.0,
    min_rows: int = 3,
    seed: int = 42,
) -> BoostedTrees:
    """Boosted-tree classifier with the parameters of Spark's. ``min_gain`` plays the part of a split
    penalty; L1 / L2 penalties on leaf weights have no twin in Spark."""
    return BoostedTrees(
        labelCol=label,
        featuresCol="features",
        maxIter=rounds,
        maxDepth=depth,
        stepSize=rate,
        subsamplingRate=row_share,
        featureSubsetStrategy=column_share,
        minInfoGain=min_gain,
        minInstancesPerNode=min_rows,
        checkpointInterval=10,
        seed=seed,
    )


def linear_surrogate(label: str = "score") -> LinearRegression:
    return LinearRegression(labelCol=label, featuresCol="features", solver="normal")


def tree_surrogate(label: str = "score", depth: int = 6, min_leaf: int = 50) -> DecisionTreeRegressor:
    """Spark has no minimum split size; a node below twice ``min_leaf`` cannot split anyway."""
    return DecisionTreeRegressor(
        labelCol=label, featuresCol="features", maxDepth=depth, minInstancesPerNode=min_leaf, leafCol="leaf"
    )


def forest_surrogate(label: str = "score", trees: int = 100, depth: int = 10, seed: int = 42) -> ForestRegressor:
    """Spark's own forest keeps every row as objects and passes them node by node from the root, some
    microseconds per row, tree and level; this one has its bins, draws and splits over sums of arrays."""
    return ForestRegressor(label=label, trees=trees, depth=depth, seed=seed)


def linear_fit(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line with one feature, in one aggregate."""
    sums = df.agg(
        ratio(F.regr_sxy(y, x), F.regr_sxx(y, x)).alias("slope"),
        F.regr_avgy(y, x).alias("_y"),
        F.regr_avgx(y, x).alias("_x"),
        F.regr_count(y, x).alias("n"),
    )
    return sums.select("slope", (F.col("_y") - F.col("slope") * F.col("_x")).alias("intercept"), "n")


def importance_table(model: PipelineModel, scored: DataFrame) -> DataFrame:
    """(feature, importance): coefficients by absolute value, or impurity importances."""
    last = model.stages[-1]
    values = last.featureImportances if hasattr(last, "featureImportances") else last.coefficients
    names = feature_names(scored)
    rows = [(n, float(v), abs(float(v))) for n, v in zip(names, values.toArray())]
    spark = scored.sparkSession
    return spark.createDataFrame(rows, "feature string, value double, importance double").orderBy(
        F.col("importance").desc(), "feature"
    )


def importance_by_column(importance: DataFrame, text: list[str]) -> DataFrame:
    """(feature, importance) per table column: the 0/1 slots of a text column are added up."""
    column = F.col("feature")
    for c in text:
        column = F.when(F.col("feature").startswith(f"{c}_oh_"), F.lit(c)).otherwise(column)
    return importance.groupBy(column.alias("feature")).agg(F.sum("importance").alias("importance"))


def tree_summary(model: PipelineModel, spark) -> DataFrame:
    tree = model.stages[-1]
    leaves = (tree.numNodes + 1) // 2
    return spark.createDataFrame(
        [(tree.depth, leaves, tree.numNodes)], "depth int, n_leaves int, n_nodes int"
    )


def tree_nodes(model: PipelineModel, spark) -> DataFrame:
    """The nodes of a fitted tree as rows, read from its saved form.

    A split is either a ``threshold`` (left: at or below it) or, on a feature with categories (0/1
    slots have two), the ``left_categories``. ``leaf`` is the number that ``leafCol`` gives.
    """
    path = fresh_path(spark, "tree")
    model.stages[-1].write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    if "nodeData" in nodes.columns:
        nodes = nodes.select("nodeData.*")
    split, inner = F.col("split"), F.col("leftChild") >= 0
    numbered = Window.orderBy(F.when(~inner, 0).otherwise(1), "id")  # the nodes of one tree
    return nodes.select(
        F.col("id").alias("node_id"),
        (~inner).alias("is_leaf"),
        "prediction",
        "impurity",
        F.when(inner, split["featureIndex"]).alias("feature_index"),
        F.when(inner & (split["numCategories"] < 0), split["leftCategoriesOrThreshold"][0]).alias("threshold"),
        F.when(inner & (split["numCategories"] >= 0), split["leftCategoriesOrThreshold"]).alias("left_categories"),
        F.when(inner & (split["numCategories"] >= 0), split["numCategories"]).alias("n_categories"),
        F.when(inner, F.col("leftChild")).alias("left_id"),
        F.when(inner, F.col("rightChild")).alias("right_id"),
        F.when(~inner, F.row_number().over(numbered) - 1).cast("int").alias("leaf"),
    )


PATHS = """
WITH RECURSIVE paths (node_id, steps) AS (
  SELECT 0, CAST(array() AS ARRAY<STRUCT<feature_index: INT, above: DOUBLE, upto: DOUBLE, categories: ARRAY<DOUBLE>>>)
  UNION ALL
  SELECT side.child, array_append(p.steps, named_struct(
      'feature_index', n.feature_index,
      'above', CASE WHEN NOT side.is_left THEN n.threshold END,
      'upto', CASE WHEN side.is_left THEN n.threshold END,
      'categories', CASE WHEN n.n_categories IS NULL THEN NULL WHEN side.is_left THEN n.left_categories
        ELSE array_except(transform(sequence(0, n.n_categories - 1), i -> CAST(i AS DOUBLE)), n.left_categories) END))
  FROM paths p JOIN {nodes} n ON n.node_id = p.node_id
  LATERAL VIEW inline(array(named_struct('child', n.left_id, 'is_left', true), named_struct('child', n.right_id, 'is_left', false))) side AS child, is_left
  WHERE NOT n.is_leaf
)
SELECT n.leaf, n.prediction, p.steps FROM paths p JOIN {nodes} n ON n.node_id = p.node_id WHERE n.is_leaf
"""


def tree_rules(model: PipelineModel, scored: DataFrame) -> DataFrame:
    """One row per leaf: prediction, conditions and the rule as text.

    Root-to-leaf paths come from a recursive query over the node table; conditions on one feature
    are merged into an interval (``above``, ``upto``] or the set of ``categories`` that are left.
    ``scored`` has the feature vector, whose slots give the names.
    """
    spark = scored.sparkSession
    names = feature_names(scored)
    nodes = stored(tree_nodes(model, spark), "nodes")
    paths = stored(spark.sql(PATHS, nodes=nodes), "paths")
    steps = paths.select("leaf", "prediction", F.explode_outer("steps").alias("s")).select("leaf", "prediction", "s.*")
    both = F.reduce("sets", F.element_at("sets", 1), lambda a, b: F.array_intersect(a, b))
    merged = (
        steps.groupBy("leaf", "prediction", "feature_index")
        .agg(F.max("above").alias("above"), F.min("upto").alias("upto"), F.collect_list("categories").alias("sets"))
        .withColumn("categories", F.when(F.size("sets") > 0, F.array_sort(both)))
        .withColumn("feature", F.get(F.array(*[F.lit(n) for n in names]), F.col("feature_index")))
    )
    number = lambda c: F.col(c).cast("string")
    text = F.concat_ws(
        " and ",
        F.when(F.col("above").isNotNull(), F.concat_ws(" > ", "feature", number("above"))),
        F.when(F.col("upto").isNotNull(), F.concat_ws(" <= ", "feature", number("upto"))),
        F.when(F.col("categories").isNotNull(), F.concat(F.col("feature"), F.lit(" in {"), F.array_join(F.col("categories").cast("array<string>"), ", "), F.lit("}"))),
    )
    condition = F.when(F.col("feature_index").isNotNull(), F.struct("feature_index", "feature", "above", "upto", "categories", text.alias("text")))
    rules = merged.groupBy("leaf", "prediction").agg(F.array_sort(F.collect_list(condition)).alias("conditions"))
    return rules.select("leaf", "prediction", F.size("conditions").alias("n_conditions"), "conditions", F.array_join("conditions.text", " and ").alias("rule"))


def rule_leaves(scored: DataFrame, rules: DataFrame, id_col: str) -> DataFrame:
    """(id, leaf, prediction) by applying the rules to the rows: which leaf's conditions a row meets.
    The conditions of all rules travel as one array; a tree of depth d has at most 2^d of them."""
    x = vector_to_array("features")
    listed = rules.agg(F.collect_list(F.struct("leaf", "prediction", "conditions"))).scalar()

    def meets(c):
        v = F.get("_x", c["feature_index"])
        above = c["above"].isNull() | (v > c["above"])
        upto = c["upto"].isNull() | (v <= c["upto"])
        return above & upto & (c["categories"].isNull() | F.array_contains(c["categories"], v))

    rows = scored.select(id_col, x.alias("_x"), listed.alias("_rules"))
    hit = F.filter("_rules", lambda rule: F.forall(rule["conditions"], meets))
    return rows.select(id_col, F.inline(F.transform(hit, lambda rule: F.struct(rule["leaf"].alias("leaf"), rule["prediction"].alias("prediction")))))


def leaf_summary(scored: DataFrame, label: str) -> DataFrame:
    """Rows, prediction and mean label per leaf of a tree surrogate."""
    return scored.groupBy(F.col("leaf").cast("int").alias("leaf")).agg(
        F.count("*").alias("n"), F.avg("prediction").alias("prediction"), F.avg(label).alias("mean_label")
    )


class AdditiveModel:
    """Gaussian additive model: cubic splines of numbers plus linear 0/1 terms of texts."""

    def __init__(self, numeric, categories, limits, splines, penalty, coefficients):
        self.numeric = numeric
        self.categories = categories
        self.limits = limits
        self.splines = splines
        self.penalty = penalty
        self.coefficients = coefficients

    def predict(self, cols: dict[str, Column]) -> Column:
        """On every knot segment the weighted splines add up to one cubic, so a number costs
        one CASE and three multiplications."""
        weights = [float(w) for w in self.coefficients]
        total, at = F.lit(weights[0]), 1
        for c in self.numeric:
            lo, hi = self.limits[c]
            segments = self.splines - 3
            x = cols[c].cast("double")
            t = (F.least(F.greatest(x, F.lit(lo)), F.lit(hi)) - F.lit(lo)) * F.lit(segments / (hi - lo) if hi > lo else 0.0)
            curve = None
            for k in range(segments):
                a, b, d, e = SEGMENT @ weights[at + k : at + k + 4]
                u = t - F.lit(float(k))
                cubic = F.lit(float(a)) + u * (F.lit(float(b)) + u * (F.lit(float(d)) + u * F.lit(float(e))))
                if k == segments - 1:
                    curve = cubic if curve is None else curve.otherwise(cubic)
                else:
                    below = t < F.lit(float(k + 1))
                    curve = F.when(below, cubic) if curve is None else curve.when(below, cubic)
            total = total + F.when(x.isNotNull(), curve)
            at += self.splines
        for c, values in self.categories.items():
            term = F.lit(0.0)
            for v in reversed(values):
                term = F.when(cols[c] == v, F.lit(weights[at + values.index(v)])).otherwise(term)
            total = total + term
            at += len(values)
        return total

    def scorer(self) -> ExprScorer:
        return ExprScorer([*self.numeric, *self.categories], self.predict)

    def save(self, spark: SparkSession, path: str) -> str:
        """Write the model through Spark, so that any storage Spark reaches will do."""
        state = {"numeric": self.numeric, "categories": self.categories, "limits": self.limits, "splines": self.splines}
        state |= {"penalty": float(self.penalty), "coefficients": [float(w) for w in self.coefficients]}
        spark.createDataFrame([(json.dumps(state),)], "value string").coalesce(1).write.mode("overwrite").text(path)
        return path

    @staticmethod
    def load(spark: SparkSession, path: str) -> AdditiveModel:
        state = json.loads(spark.read.text(path, wholetext=True).first()[0])
        limits = {c: tuple(v) for c, v in state["limits"].items()}
        coefficients = np.array(state["coefficients"])
        return AdditiveModel(state["numeric"], state["categories"], limits, state["splines"], state["penalty"], coefficients)


# Powers of the position inside a segment (rows: 1, u, u^2, u^3) of the four splines alive there.
SEGMENT = np.array([[1, 4, 1, 0], [-3, 0, 3, 0], [3, -6, 3, 0], [-1, 3, -3, 1]]) / 6.0


def cross_products(df: DataFrame, numeric, categories, limits, splines: int, label: str) -> np.ndarray:
    """[X y]'[X y] over all rows, one pass.

    Each task builds the design of its Arrow batches and adds up their matrix products; the blocks
    of the tasks are added in a tree. Only the (p+1)^2 cells reach the driver.
    """
    size = 2 + splines * len(numeric) + sum(len(v) for v in categories.values())
    powers = SEGMENT

    def design(batch):
        blocks = [np.ones((len(batch), 1))]
        for c in numeric:
            lo, hi = limits[c]
            segments = splines - 3
            scale = segments / (hi - lo) if hi > lo else 0.0
            t = (np.clip(batch[c].to_numpy(dtype=float), lo, hi) - lo) * scale
            k = np.minimum(t.astype(int), segments - 1)
            alive = np.vander(t - k, 4, increasing=True) @ powers
            block = np.zeros((len(batch), splines))
            for j in range(4):
                block[np.arange(len(batch)), k + j] = alive[:, j]
            blocks.append(block)
        for c, values in categories.items():
            text = batch[c].to_numpy()
            blocks += [(text == v).astype(float)[:, None] for v in values]
        blocks.append(batch[label].to_numpy(dtype=float)[:, None])
        return np.hstack(blocks)

    def gram(batches):
        total = np.zeros((size, size))
        for batch in batches:
            if batch.num_rows:
                block = design(batch.to_pandas())
                total += block.T @ block
        return total

    rows = df.select(*[F.col(c).cast("double").alias(c) for c in numeric], *categories, F.col(label).cast("double").alias(label))
    return array_total(rows.na.drop("any", subset=[*numeric, label]), gram, (size, size))


def _penalty_matrix(numeric, categories, splines, size) -> np.ndarray:
    """Second differences of each spline's coefficients; a ridge for linear terms."""
    out = np.zeros((size, size))
    diff = np.diff(np.eye(splines), n=2, axis=0)
    at = 1
    for _ in numeric:
        out[at : at + splines, at : at + splines] = diff.T @ diff
        at += splines
    for values in categories.values():
        for _ in values:
            out[at, at] = 1.0
            at += 1
    return out


def fit_additive(
    train: DataFrame,
    test: DataFrame,
    numeric: list[str],
    categories: dict[str, list[str]],
    label: str = "score",
    splines: int = 8,
    penalties: tuple[float, ...] = (0.01, 0.1, 1.0),
) -> tuple[AdditiveModel, DataFrame]:
    """Fit for every penalty and keep the best test R2.

    The cross products are computed once for all penalties, and all candidates are scored in
    one pass over the test rows. Returns the best model and rows (penalty, r2, n_samples, edf, gcv):
    effective degrees of freedom, the trace of the hat matrix, and the generalised cross-validation
    error of the training rows, both from the cross products alone.
    """
    limits = fit_limits(train, numeric)
    cols = {c: F.col(c) for c in [*numeric, *categories]}
    gram = cross_products(train, numeric, categories, limits, splines, label)
    xx, xy, yy, n = gram[:-1, :-1], gram[:-1, -1], gram[-1, -1], gram[0, 0]
    penalty = _penalty_matrix(numeric, categories, splines, len(xy))
    candidates, quality = [], []
    for lam in penalties:
        system = xx + lam * penalty + 1e-6 * np.eye(len(xy))
        weights = np.linalg.solve(system, xy)
        candidates.append(AdditiveModel(numeric, categories, limits, splines, lam, weights))
        edf = float(np.trace(np.linalg.solve(system, xx)))
        rss = max(float(yy - 2 * weights @ xy + weights @ xx @ weights), 0.0)
        quality.append((float(lam), edf, float(n * rss / (n - edf) ** 2) if n > edf else None))
    scored = test.select(
        F.col(label).alias("_y"),
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(float(m.penalty)).alias("penalty"), m.predict(cols).alias("_p"))
                    for m in candidates
                ]
            )
        ),
    )
    fits = regression_fit(scored, "_y", "_p", ["penalty"]).select("penalty", "r2", "n_samples").collect()  # one row per penalty
    best = max(fits, key=lambda r: (r["r2"], -r["penalty"]))["penalty"]
    found = {r["penalty"]: r for r in fits}
    rows = [(lam, found[lam]["r2"], found[lam]["n_samples"], edf, gcv) for lam, edf, gcv in quality]
    table = train.sparkSession.createDataFrame(rows, "penalty double, r2 double, n_samples long, edf double, gcv double")
    return next(m for m in candidates if float(m.penalty) == best), table
