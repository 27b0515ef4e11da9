"""Own fit of boosted trees against plain loops, Spark's fit, several tasks, lost files and odd rows."""

import os
import shutil

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from auditlens.operators import boosting, models
from auditlens.operators.scorers import MLScorer
from auditlens.plans import modelling
from auditlens.session import fresh_path
from auditlens.sources import tables


def table(spark, n=2000):
    x, k = (F.col("id") * 7919 % 1009).cast("double"), F.col("id") * 31 % 6
    made = spark.range(n).select("id", x.alias("x"), k.alias("k"), F.format_string("t%d", F.col("id") % 4).alias("t"), F.lit("u").alias("u"))
    chance = F.col("x") / 2000 + F.when(F.col("t") == "t1", 0.3).otherwise(0.0) + F.col("k") / 40
    return made.withColumn("g", (F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000 < chance).cast("int"))


def fit(df, text=("t", "u"), **options):
    return models.fit_model(df, models.black_box(label="g", **options), ["x", "k"], list(text))


def nodes(spark, model):
    path = fresh_path(spark, "nodes")
    model.stages[-1].write().overwrite().save(path)
    rows = spark.read.parquet(f"{path}/data").selectExpr("treeID", "nodeData.id", "nodeData.prediction", "nodeData.gain", "nodeData.rawCount", "nodeData.split").collect()
    return sorted(rows, key=lambda r: r[:2])


def loss(df, model):
    p = vector_to_array("probability")[1]
    return model.transform(df).agg(F.avg(-F.log(F.when(F.col("g") == 1, p).otherwise(1 - p)))).first()[0]


def test_registered_black_box_has_the_rounds_of_a_full_study(spark, small):
    trees = modelling.fitted_black_box(spark, small).stages[-1]
    assert trees.getNumTrees == 800 and trees.treeWeights == [1.0] + [0.08] * 799
    assert max(t.depth for t in trees.trees) == 7


def test_importance_scores_all_trees(spark, small):
    scorer = modelling.black_box_scorer(spark, small, output="margin")
    assert scorer._trees.values.shape == (800, 128) and scorer._trees.words == 2
    df = modelling.prepared(spark, small)
    want = scorer.model.transform(df).select("loan_id", (2 * vector_to_array("rawPrediction")[1]).alias("m"))
    wrong = F.count_if(F.abs(F.col("m") - F.col("score")) > 1e-12)
    assert scorer.score(df).select("loan_id", "score").join(want, "loan_id").agg(F.count("*") - df.count(), wrong).first() == (0, 0)
    own = {name: sum(bin(int(word)).count("1") for word in row) for name, row in (("all open", scorer._trees.tables[0][0]), ("of a row", np.bitwise_and.reduce([t[0] for t in scorer._trees.tables])))}
    assert own["of a row"] == 800 < own["all open"]  # one leaf of every tree


def test_trees_equal_those_of_plain_loops(spark):
    """All rows and all slots: every split by trying all, labels first and then gradients."""
    df = table(spark, 500).withColumn("x", F.floor(F.col("x") / 50).cast("double"))
    model = fit(df, rounds=3, depth=3, row_share=1.0, column_share="all")
    rows = df.collect()
    x = np.array([[r["x"], r["k"], *[r["t"] == f"t{j}" for j in range(4)], 1.0] for r in rows], float)
    sign = np.array([2.0 * r["g"] - 1 for r in rows])
    margin = np.zeros(len(rows))

    def grown(mine, y, depth):
        best = (1e-10, None)
        for j in range(x.shape[1]) if depth else []:
            for cut in np.unique(x[mine, j])[:-1]:
                low = mine & (x[:, j] <= cut)
                high = mine & ~low
                if min(low.sum(), high.sum()) >= 3:
                    gain = y[mine].var() - (low.sum() * y[low].var() + high.sum() * y[high].var()) / mine.sum()
                    best = max(best, (gain, (low, high)), key=lambda b: b[0] - 1e-9 * (b is not best))
        if best[1] is None:
            return np.where(mine, y[mine].mean(), 0.0)
        return sum(grown(part, y, depth - 1) for part in best[1])

    for t in range(3):
        y = sign if t == 0 else 4 * sign / (1 + np.exp(2 * sign * margin))
        margin += (0.08 if t else 1.0) * grown(np.ones(len(rows), bool), y, 3)
    got = {r["id"]: r["m"] for r in model.transform(df).select("id", vector_to_array("rawPrediction")[1].alias("m")).collect()}
    assert np.abs(margin - [got[r["id"]] for r in rows]).max() < 1e-5


def test_fit_is_as_good_as_that_of_spark_and_does_not_use_it(spark, monkeypatch):
    df = table(spark).cache()
    own = models.black_box(label="g", rounds=15, depth=4)
    theirs = GBTClassifier(**{p.name: v for p, v in own._paramMap.items()})
    want = loss(df, models.fit_model(df, theirs, ["x", "k"], ["t", "u"]))
    monkeypatch.setattr(GBTClassifier, "_fit", None)
    model = fit(df, rounds=15, depth=4)
    assert isinstance(model.stages[-1], GBTClassificationModel) and model.stages[-1].getNumTrees == 15
    assert abs(loss(df, model) - want) < 0.02
    shares = model.stages[-1].featureImportances.toArray()
    assert shares.sum() == pytest.approx(1) and shares[0] == max(shares) and shares[6] == 0
    assert 0.82 < np.mean([r["rawCount"] for r in nodes(spark, model) if r["id"] == 0]) / 2000 < 0.88  # drawn rows
    again = tables.load_model(tables.save_model(model, fresh_path(spark, "boosted")))
    assert nodes(spark, again) == nodes(spark, model) and again.stages[-1].getMaxDepth() == 4


def test_tasks_and_lost_files_change_nothing(spark, monkeypatch):
    df = table(spark).repartition(5).cache()
    df.count()
    whole = nodes(spark, fit(df, rounds=4, depth=3))
    monkeypatch.setattr(boosting, "TASK_ROWS", 100)
    assert nodes(spark, fit(df, rounds=4, depth=3)) == whole
    folders, plain = [], boosting.Dealt.sums

    def losing(self, tree, level, *rest):
        if (tree, level) in ((1, 0), (2, 2), (3, 1)):
            folders.append([f for f, _ in self.folders.collect()])
            if tree == 1:
                shutil.rmtree(folders[-1][0])  # not there: all is set up again
            else:
                np.memmap(f"{folders[-1][0]}/done", np.int64, "r+", shape=(2,))[:] = -1, 2  # as made again by Spark
        return plain(self, tree, level, *rest)

    monkeypatch.setattr(boosting.Dealt, "sums", losing)
    assert nodes(spark, fit(df, rounds=4, depth=3)) == whole
    assert set(folders[1]) == set(folders[2]) != set(folders[0]) and len(folders[0]) == spark.sparkContext.defaultParallelism
    assert not any(map(os.path.exists, folders[2]))


def test_slots_that_are_never_1_together_share_a_column():
    together = np.array([[1, 0, 0, 0], [0, 1, 0, 0], [0, 0, 1, 1], [0, 0, 1, 1]], bool)
    assert boosting.bundled(together) == [[0, 1, 2], [3]]
    assert boosting.counted_together([32, 32, 32, 6], 1024) == [[0, 1], [2, 3]] and boosting.counted_together([32, 40], 1024) == [[0], [1]]


def test_odd_rows(spark):
    df = table(spark, 300).withColumn("x", F.when(F.col("id") % 7 == 0, float("nan")).when(F.col("id") % 7 == 1, None).otherwise(F.col("x")))
    twice = df.unionByName(df).withColumn("t", F.when(F.col("id") % 5 > 0, F.col("t")))
    model = fit(twice, rounds=3, depth=3)
    got = MLScorer(model, ["x", "k", "t", "u"]).score(twice)
    assert got.filter("score > 0 and score < 1").count() == 600
    flat = fit(df.withColumn("x", F.lit(1.0)).withColumn("k", F.lit(2)).withColumn("t", F.lit("a")), rounds=2, depth=2)
    assert flat.transform(df).select("prediction").distinct().count() == 1
    for bad in (df.limit(0), df.withColumn("g", F.when(F.col("id") > 3, F.col("g"))), df.withColumn("g", F.col("g") + 1)):
        with pytest.raises(Exception):
            fit(bad, rounds=2, depth=2)
