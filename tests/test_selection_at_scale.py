"""Selection, samples, positions, densities, topics, encoders and rules beyond the small cases."""

import math
import random

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from auditlens.operators import clean, models, profile, topics
from auditlens.operators.blocks import array_total
from auditlens.operators.encoder import TableEncoder
from auditlens.operators.explain import local_linear
from auditlens.operators.ordering import exact_quantiles, global_positions, hash_sample
from auditlens.operators.scorers import ExprScorer
from auditlens.session import fresh_path


def skewed(spark, n=30_000):
    """Half of the rows share one value, a tenth another; the rest spread over many scales."""
    u = F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 1_000_003.0
    x = F.when(F.col("id") % 2 == 0, 1.0).when(F.col("id") % 10 == 1, 1.5).otherwise(F.exp(20 * u - 10))
    return spark.range(n).select("id", x.alias("x"), (F.col("id") % 3).alias("k"), (-x * x).alias("y"))


@pytest.mark.parametrize("most", [3, 40, 1_000])
def test_selection_narrows_to_the_exact_ranks(spark, most):
    df = skewed(spark).cache()
    probs = [0.0, 0.001, 0.25, 0.2501, 0.5, 0.75, 0.95, 1.0]
    at = F.array(*[F.lit(p) for p in probs])
    got = {r["feature"]: r["q"] for r in exact_quantiles(df, ["x", "y"], probs, most=most).collect()}
    for c in ("x", "y"):
        assert got[c] == pytest.approx(df.select(F.percentile(c, at)).first()[0], rel=1e-12)
    keyed = exact_quantiles(df, ["x"], probs, keys=["k"], most=most)
    true = {r["k"]: r["q"] for r in df.groupBy("k").agg(F.percentile("x", at).alias("q")).collect()}
    rows = keyed.collect()
    assert len(rows) == 3 and all(r["q"] == pytest.approx(true[r["k"]], rel=1e-12) for r in rows)
    df.unpersist()


def test_selection_with_infinite_ends(spark):
    df = spark.createDataFrame([(v,) for v in [float("-inf")] * 5 + [1.0, 2.0, 3.0] * 40 + [float("inf")] * 5], "x double")
    (row,) = exact_quantiles(df, ["x"], [0.0, 0.5, 1.0], most=1).collect()
    assert row["q"][1] == 2.0


def test_sample_is_the_rows_of_smallest_hashes(spark):
    df = spark.range(40_000).select(F.col("id"), F.lit(1).alias("v"))
    for n in (1, 100, 5_000, 39_999, 40_000, 50_000):
        got = sorted(r["id"] for r in hash_sample(df, "id", n, 7).collect())
        from auditlens.functions.expr import hash_unit

        want = sorted(r["id"] for r in df.orderBy(hash_unit("id", F.lit(7)), "id").limit(n).collect())
        assert got == want


def test_positions_follow_the_order_and_are_balanced(spark):
    names = ["same prefix " + format(i * 7919 % 100_003, "08d") for i in range(20_000)]
    df = spark.createDataFrame([(n, i * 2**40) for i, n in enumerate(names)], "name string, at long").repartition(5)
    got = global_positions(df, ["name"], "pos")
    place = {n: i for i, n in enumerate(sorted(names))}
    assert all(place[r["name"]] == r["pos"] for r in got.collect())
    sizes = [r["count"] for r in got.withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()]
    assert max(sizes) < 2 * len(names) / len(sizes)


def test_repeated_names_with_sparse_positions(spark):
    rows = [(i * 2**45, "a b" if i % 3 else "c") for i in range(300)]
    got = clean.unique_clean_names(spark.createDataFrame(rows, "at long, name string"), "name", "at").collect()
    assert len({r["clean_name"] for r in got}) == 300
    assert {r["clean_name"] for r in got if r["name"] == "c"} == {"c", *[f"c_{i}" for i in range(1, 100)]}


@pytest.mark.parametrize("scale", [1e6, 1.0, 1e-6])
def test_density_follows_the_scale_of_its_values(spark, scale):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(3, 1, 400), rng.normal(9, 0.5, 200)]) * scale
    df = spark.createDataFrame([("g", float(v)) for v in x] + [("h", 1.0), (None, 2.0)], "g string, x double")
    got = profile.density_curve(df, "x", "g").orderBy("grid_pos").collect()
    h = x.std(ddof=1) * len(x) ** -0.2
    at = np.array([r["grid_value"] for r in got])
    direct = np.exp(-(((at[:, None] - x) / h) ** 2) / 2).sum(1) / (len(x) * h * math.sqrt(2 * math.pi))
    assert len(got) == 200 and np.allclose([r["density"] for r in got], direct, rtol=1e-3, atol=1e-6 * direct.max())


def test_associations_of_many_columns_with_missing_cells(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 40))
    x[:, 1] = x[:, 0] * 1e6 + 5e8
    x[:, 2] = 7.0
    x[rng.random(x.shape) < 0.1] = np.nan
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) for r in x], ", ".join(f"c{i} double" for i in range(40)))
    got = {(r["feature_x"], r["feature_y"]): r["correlation"] for r in profile.correlations(df, df.columns).collect()}
    assert len(got) == 40 * 39 // 2 and got["c0", "c2"] is None
    for i, j in ((0, 1), (3, 4), (5, 39)):
        both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
        assert got[f"c{i}", f"c{j}"] == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-9)


def test_blocks_add_up_over_empty_and_many_partitions(spark):
    df = spark.range(1000).repartition(37)
    work = lambda batches: np.array([[sum(float(b.column(0).to_numpy().sum()) for b in batches)]])
    assert array_total(df, work, (1, 1))[0, 0] == 999 * 500
    assert array_total(df.filter("id < 0"), work, (1, 1))[0, 0] == 0


# -- topics and encoders -------------------------------------------------------------------------


def dirty(spark, seed=1):
    rng = random.Random(seed)
    stems = ["registered nurse", "software engineer", "truck driver", "school teacher", "sales manager"]

    def typo(s):
        i = rng.randrange(len(s))
        return rng.choice([s, s[:i] + s[i + 1 :], s[:i] + rng.choice("aeiou") + s[i:], s.upper(), s + " " + rng.choice(["sr", "jr", "ii"])])

    rows = [(i, (k := rng.randrange(5)), typo(stems[k]) if rng.random() < 0.97 else None) for i in range(600)]
    return spark.createDataFrame(rows, "id long, kind int, title string")


def test_topics_separate_kinds_and_encode_unseen_texts(spark):
    df = dirty(spark)
    model = topics.fit_topics(df, "title", topics=5, iterations=15)
    assert all(b < a for a, b in zip(model.objective, model.objective[1:])) and len(model.objective) > 2
    coded = model.encode(df, "title").toPandas()
    w = coded[[f"title_topic_{i}" for i in range(5)]].to_numpy()
    assert (w >= 0).all() and (w[coded.title.isna()] == 0).all()
    known = coded[coded.title.notna()]
    assert known.groupby("title")[[f"title_topic_{i}" for i in range(5)]].nunique().to_numpy().max() == 1
    best = w.argmax(1)
    share = np.mean([np.bincount(best[(coded.kind == k) & coded.title.notna()]).max() / ((coded.kind == k) & coded.title.notna()).sum() for k in range(5)])
    assert share > 0.8
    unseen = model.weights(["REGISTERED nurze", "registered nurse", ""])
    assert unseen[0].argmax() == unseen[1].argmax() and np.isfinite(unseen).all()


def test_weights_are_the_optimum_of_their_text():
    rng = np.random.default_rng(2)
    matrix = rng.gamma(1.0, size=(4, 64))
    matrix /= matrix.sum(1, keepdims=True)
    start, cell, count = topics._sparse(["some text", "other"], 64)
    h = topics.weights_of(matrix, start, cell, count)

    def loss(h, i):
        at = slice(start[i], start[i + 1] if i + 1 < len(start) else None)
        mean = h @ matrix[:, cell[at]]
        return -(count[at] * np.log(mean)).sum() + (h * (1 + 1 / topics.SCALE) - (topics.SHAPE - 1) * np.log(h)).sum()

    for i in range(2):
        near = [loss(h[i] * np.exp(rng.normal(0, 0.02, 4)), i) for _ in range(200)]
        assert loss(h[i], i) <= min(near) + 1e-9


def test_encoder_is_fitted_once_kept_and_applied_to_new_rows(spark):
    df = dirty(spark).withColumn("group", F.concat(F.lit("g"), F.col("kind").cast("string"))).withColumn("y", F.col("kind") * 2.0 + F.col("id") % 7)
    train, other = df.filter("id < 400"), df.filter("id >= 400").withColumn("group", F.when(F.col("id") % 5 == 0, "new").otherwise(F.col("group")))
    encoder = TableEncoder(numeric=["id"], text=["group", "title"], limit=10, topics=4, iterations=5)
    model = Pipeline(stages=[encoder, LinearRegression(featuresCol="encoded", labelCol="y", regParam=0.01)]).fit(train)
    path = fresh_path(spark, "pipeline")
    model.write().overwrite().save(path)
    again = PipelineModel.load(path)
    columns = model.stages[0].columns()
    assert again.stages[0].columns() == columns
    assert columns == ["id", *[f"group_g{i}" for i in range(5)], *[f"title_topic_{i}" for i in range(4)]]
    a = {r["id"]: r for r in model.transform(other).collect()}
    b = {r["id"]: r for r in again.transform(other).collect()}
    assert len(a) == 200 and all(a[i]["prediction"] == b[i]["prediction"] for i in a)
    assert all(sum(r[f"group_g{i}"] for i in range(5)) == (r["group"] != "new") for r in a.values())
    kept = TableEncoder.load(_saved(encoder, spark))
    assert kept.getOrDefault("topics") == 4 and kept.getOrDefault("text") == ["group", "title"]


def _saved(stage, spark):
    path = fresh_path(spark, "stage")
    stage.write().overwrite().save(path)
    return path


# -- models --------------------------------------------------------------------------------------


def test_rules_merge_conditions_on_one_feature_and_on_categories(spark):
    rng = random.Random(3)
    rows = []
    for i in range(3000):
        x, g = rng.random() * 10, rng.choice("abc")
        rows.append((i, x, rng.random(), g, (5.0 if 3 < x <= 6 else 0.0) + (2.0 if g == "b" else 0.0)))
    df = spark.createDataFrame(rows, "id long, x double, noise double, g string, score double")
    model = models.fit_model(df, models.tree_surrogate(depth=3, min_leaf=20), ["x", "noise"], ["g"])
    scored = model.transform(df)
    rules = models.tree_rules(model, scored).collect()
    assert sorted(r["leaf"] for r in rules) == list(range(len(rules)))
    features = [[c["feature"] for c in r["conditions"]] for r in rules]
    assert all(len(f) == len(set(f)) for f in features)  # merged
    middle = [c for r in rules for c in r["conditions"] if c["feature"] == "x" and c["above"] is not None and c["upto"] is not None]
    assert any(2.7 < c["above"] < 3.3 and 5.7 < c["upto"] < 6.3 for c in middle)
    assert any(c["categories"] for r in rules for c in r["conditions"] if c["feature"].startswith("g_oh_"))
    hit = models.rule_leaves(scored, spark.createDataFrame(rules), "id").join(scored.select("id", F.col("leaf").cast("int").alias("own")), "id")
    assert hit.count() == 3000 and hit.filter("leaf != own").isEmpty()


def test_rules_of_a_tree_without_a_split(spark):
    df = spark.createDataFrame([(i, float(i), 1.0) for i in range(30)], "id long, x double, score double")
    model = models.fit_model(df, models.tree_surrogate(depth=3, min_leaf=5), ["x"], [])
    (rule,) = models.tree_rules(model, model.transform(df)).collect()
    assert rule["leaf"] == 0 and rule["conditions"] == [] and rule["rule"] == ""


def test_additive_model_satisfies_its_normal_equations(spark):
    rng = np.random.default_rng(6)
    rows = [(float(a), float(b), "uv"[int(c)], float(np.sin(a) + 0.5 * b * b + c)) for a, b, c in zip(rng.uniform(0, 6, 800), rng.normal(size=800), rng.integers(0, 2, 800))]
    df = spark.createDataFrame(rows, "a double, b double, g string, score double")
    model, table = models.fit_additive(df, df, ["a", "b"], {"g": ["u", "v"]}, penalties=(0.01, 10.0))
    gram = models.cross_products(df, ["a", "b"], {"g": ["u", "v"]}, model.limits, 8, "score")
    pull = gram[:-1, -1] - gram[:-1, :-1] @ model.coefficients
    back = (model.penalty * models._penalty_matrix(["a", "b"], {"g": ["u", "v"]}, 8, len(pull)) + 1e-6 * np.eye(len(pull))) @ model.coefficients
    assert np.allclose(pull, back, atol=1e-6)
    edf = {r["penalty"]: r["edf"] for r in table.collect()}
    assert 4 < edf[10.0] < edf[0.01] < 18 and all(r["gcv"] > 0 for r in table.collect())
    again = models.AdditiveModel.load(spark, model.save(spark, fresh_path(spark, "additive")))
    assert again.categories == model.categories and np.array_equal(again.coefficients, model.coefficients)


def test_local_models_of_a_text_with_very_many_values(spark):
    """More values than the limit of constants: drawn by a join; the text decides the score."""
    df = spark.range(3000).select("id", (F.col("id") % 17).cast("double").alias("x"), F.concat(F.lit("t"), (F.col("id") % 1500).cast("string")).alias("t"))
    scorer = ExprScorer(["x", "t"], lambda c: F.when(c["t"] == "t7", 5.0).otherwise(0.0) + 0 * c["x"])
    few = df.filter("id IN (7, 8, 1507)")
    rows = local_linear.local_explanations(df, few, scorer, "id", samples=400).collect()
    weight = {(r["id"], r["feature"]): r["weight"] for r in rows}
    assert len(weight) == 6 and weight[7, "t"] == weight[7, "t"] and weight[7, "t"] > 0.5 > abs(weight[8, "t"])


def test_local_models_of_128_features(spark):
    names = [f"f{i}" for i in range(128)]
    df = spark.range(500).select("id", *[(F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1000)) / 1000).alias(c) for i, c in enumerate(names)])
    scorer = ExprScorer(names, lambda c: 3 * c["f5"] + c["f77"])
    rows = local_linear.local_explanations(df, df.limit(2), scorer, "id", samples=1000, shown=2).collect()
    assert len(rows) == 4 and {r["feature"] for r in rows if r["rank"] == 1} == {"f5"}
