"""The forest against plain loops, Spark's own forest and odd rows."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from auditlens.operators import forest, models
from auditlens.operators.encode import vector_stages
from auditlens.operators.metrics import regression_fit
from auditlens.session import fresh_path


def table(spark, n=3000):
    x, k = (F.col("id") * 7919 % 1009).cast("double"), F.col("id") * 31 % 6
    made = spark.range(n).select("id", x.alias("x"), k.alias("k"), F.format_string("t%d", F.col("id") % 4).alias("t"))
    return made.withColumn("y", F.when(F.col("x") < 400, 1.0).otherwise(F.col("k") / 2) + F.when(F.col("t") == "t1", 3.0).otherwise(0.0))


def r2(df):
    return regression_fit(df, "y", "prediction").first()["r2"]


def test_best_split_equals_every_split_tried():
    rng = np.random.default_rng(3)
    n, s = np.zeros((2, 2, 3, 8))
    rows = [(rng.integers(3), rng.integers(8), rng.integers(8), rng.integers(1, 4), rng.normal()) for _ in range(60)]
    for node, a, b, w, y in rows:
        for slot, place in enumerate((a, b)):
            n[slot, node, place] += w
            s[slot, node, place] += w * y
    weight, mean, pick, cut, left, right, gain = forest.best_splits(n, s, 1e-12)
    for node in range(3):
        mine = np.array([(a, b, w, y) for at, a, b, w, y in rows if at == node])
        w, y = mine[:, 2], mine[:, 3]

        def error(part):
            return (w[part] * (y[part] - np.average(y[part], weights=w[part])) ** 2).sum() if part.any() else np.inf

        tried = {(slot, c): error(mine[:, slot] <= c) + error(mine[:, slot] > c) for slot in (0, 1) for c in range(7)}
        assert min(tried.values()) == pytest.approx(tried[pick[node], cut[node]])
        assert gain[node] == pytest.approx(error(w > 0) - min(tried.values()))
        low = mine[:, pick[node]] <= cut[node]
        assert (mean[node], left[node], right[node]) == pytest.approx(tuple(np.average(y[p], weights=w[p]) for p in (w > 0, low, ~low)))
        assert weight[node] == w.sum()


def test_edges_use_all_parts_beside_a_heavy_value():
    assert forest.cut_values(np.array([1.0, 2.0, 4.0]), np.array([9, 1, 1]), 4).tolist() == [1.5, 3.0]
    even = forest.cut_values(np.arange(100.0), np.ones(100), 4)
    assert even.tolist() == [24.5, 49.5, 74.5]
    heavy = forest.cut_values(np.arange(100.0), np.where(np.arange(100) == 0, 300, 1), 8)
    assert len(heavy) == 7 and heavy[0] == 0.5 and (np.diff(heavy) > 0).all()
    assert forest.cut_values(np.array([]), np.array([]), 4).tolist() == []


def test_fit_is_as_good_as_that_of_spark_and_does_not_use_it(spark, monkeypatch):
    df = table(spark).cache()
    theirs = Pipeline(stages=[*vector_stages(["x", "k"], ["t"]), RandomForestRegressor(labelCol="y", numTrees=30, maxDepth=8, seed=1)]).fit(df).transform(df)
    want = r2(theirs)
    monkeypatch.setattr(RandomForestRegressor, "_fit", None)
    model = models.forest_surrogate(label="y", trees=30, depth=8, seed=1).fit(df, ["x", "k"], ["t"])
    got = model.transform(df)
    assert got.columns == [*df.columns, "prediction"] and got.count() == 3000
    assert r2(got) > want - 0.03
    shares = model.importances()
    assert sum(shares.values()) == pytest.approx(1) and max(shares, key=shares.get) == "t_oh_t1" and list(shares)[:2] == ["x", "k"]
    again = forest.Forest.load(spark, model.save(spark, fresh_path(spark, "forest")))
    assert r2(again.transform(df)) == r2(got)


def test_one_tree_is_the_tree_of_its_sample(spark):
    """With all inputs in every node, leaves are means over drawn rows of one cell of the inputs."""
    df = spark.createDataFrame([(float(i % 3), "ab"[i // 3 % 2], float(10 * (i % 3) + i // 3 % 2)) for i in range(600)], "x double, t string, y double")
    got = models.forest_surrogate(label="y", trees=1, depth=4).fit(df, ["x"], ["t"]).transform(df)
    assert got.filter(F.abs(F.col("y") - F.col("prediction")) > 1e-9).count() == 0


def test_draws_follow_the_poisson_law_and_differ_between_trees():
    ids = forest._mixed(np.arange(100_000, dtype=np.uint64))
    a, b = (forest.row_draws(ids, t, 42) for t in (0, 1))
    assert a.mean() == pytest.approx(1, abs=0.02) and a.var() == pytest.approx(1, abs=0.03) and (a == 0).mean() == pytest.approx(np.exp(-1), abs=0.01)
    assert abs(np.corrcoef(a, b)[0, 1]) < 0.02 and (forest.row_draws(ids[5:9], 0, 42) == a[5:9]).all()


def test_odd_rows(spark):
    df = table(spark, 400)
    model = models.forest_surrogate(label="y", trees=5, depth=3).fit(df, ["x", "k"], ["t"])
    odd = spark.createDataFrame([(float("nan"), None, None), (None, 3, "unseen"), (1e300, -5, "t1")], "x double, k long, t string")
    got = [r["prediction"] for r in model.transform(odd).collect()]
    assert all(0 <= p <= 6 for p in got) and got[0] < got[2]
    flat = models.forest_surrogate(label="one", trees=3, depth=3).fit(df.withColumn("one", F.lit(0.1)), ["x"], [])
    assert {r[0] for r in flat.transform(df).select(F.round("prediction", 12)).distinct().collect()} == {0.1} and not flat.gain.any()
    for bad in (df.limit(0), df.withColumn("y", F.when(F.col("id") > 3, F.col("y")))):
        with pytest.raises(ValueError):
            models.forest_surrogate(label="y", trees=2, depth=2).fit(bad, ["x"], ["t"])
