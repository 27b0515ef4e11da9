"""Scores of boosted trees by batches are those of the ML stages."""

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from auditlens.operators import models
from auditlens.operators.explain import dependence
from auditlens.operators.scorers import MLScorer


def table(spark, n=600):
    x = F.when(F.col("id") % 11 != 0, ((F.col("id") * 7) % 53).cast("double"))
    t = F.when(F.col("id") % 13 != 0, F.format_string("t%d", F.col("id") % 4))
    made = spark.range(n).select("id", x.alias("x"), ((F.col("id") * 5) % 31).alias("k"), t.alias("t"), F.lit("u").alias("u"))
    return made.withColumn("g", ((F.coalesce("x", F.lit(9.0)) + F.col("k") + F.when(F.col("t") == "t1", 20).otherwise(0)) % 60 > 30).cast("int"))


@pytest.fixture(scope="module", params=[["t", "u"], []])
def fitted(request, spark):
    df = table(spark)
    return models.fit_model(df.na.drop(), models.black_box(label="g", rounds=6, depth=5), ["x", "k"], request.param), request.param


def test_scores_equal_those_of_the_stages(spark, fitted):
    model, text = fitted
    new = spark.createDataFrame([(-1, float("nan"), 3, "t1", "u", 0), (-2, None, 40, "unseen", None, 1), (-3, 1e300, -5, None, "u", 1)], "id long, x double, k long, t string, u string, g int")
    df = table(spark).unionByName(new).withColumn("score", F.lit("old"))
    want = {r["id"]: r for r in model.transform(df).select("id", vector_to_array("probability")[1].alias("p"), (2 * vector_to_array("rawPrediction")[1]).alias("m")).collect()}
    for output, name in (("score", "p"), ("margin", "m")):
        scored = MLScorer(model, ["x", "k", *text], output=output).score(df)
        assert "ArrowEvalPython" in scored._jdf.queryExecution().executedPlan().toString()
        got = {r["id"]: r["score"] for r in scored.collect()}
        assert scored.columns == df.columns and len(got) == 603
        assert all(abs(got[i] - want[i][name]) < 1e-12 for i in got)


def test_repeated_rows_pass_no_vectors(spark, fitted):
    model, text = fitted
    curve = dependence.partial_dependence(table(spark).na.drop(), MLScorer(model, ["x", "k", *text]), ["x", "k", *text])
    assert "UDF(struct" not in curve._jdf.queryExecution().executedPlan().toString()
    assert curve.filter("feature = 'k'").count() == 20


def test_other_pipelines_keep_their_stages(spark):
    df = table(spark).na.drop()
    model = models.fit_model(df.withColumn("score", F.col("x")), models.tree_surrogate(depth=3, min_leaf=5), ["x", "k"], ["t"])
    assert MLScorer(model, ["x", "k", "t"]).score(df).filter("score is not null").count() == df.count()
