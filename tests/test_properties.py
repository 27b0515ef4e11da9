"""Properties that hold whatever the data, and fitted models against planted signals."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from auditlens.functions.expr import hash_long
from auditlens.operators import fairness, metrics, models, split
from auditlens.operators.explain import dependence, local_linear, permutation, shapley
from auditlens.operators.scorers import ExprScorer, MLScorer
from auditlens.plans import catalogue
from auditlens.plans.frames import audited
from auditlens.sources.loans import (
    ADDITIVE,
    ID,
    SCORER,
    SCORER_INPUTS,
    SCORER_NUMERIC,
    TEST_YEARS,
    complete_loans,
)
from tests.compare import difference, duck


@pytest.fixture(scope="module")
def df(spark, small):
    return complete_loans(spark, small)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 20), st.integers(0, 1)), min_size=2, max_size=30))
def test_auc_is_rank_based(spark, pairs):
    frame = spark.createDataFrame([(s / 20, y) for s, y in pairs], "score double, target int")
    plain = metrics.roc_auc(frame).first()[0]
    mapped = metrics.roc_auc(frame.withColumn("score", F.col("score") * 0.5 + 0.25)).first()[0]
    assert plain == mapped
    ones = [s for s, y in pairs if y == 1]
    zeros = [s for s, y in pairs if y == 0]
    if ones and zeros:
        wins = sum((a > b) + 0.5 * (a == b) for a in ones for b in zeros)
        assert plain == pytest.approx(wins / len(ones) / len(zeros))


def test_metrics_do_not_depend_on_partitions(df):
    one = metrics.roc_auc(df.coalesce(1)).first()[0]
    assert metrics.roc_auc(df.repartition(8)).first()[0] == one


def test_curves_average_to_partial_dependence(df):
    grid = dependence.curve_grid(df, ["dti"])
    mean = dependence.partial_dependence(df, SCORER, ["dti"], grid)
    envelope = dependence.curve_envelope(dependence.individual_curves(df, SCORER, ["dti"], ID))
    both = mean.join(envelope, ["feature", "grid_pos"])
    assert both.count() == len(grid)
    assert both.agg(F.max(F.abs(F.col("value") - F.col("mean_value")))).first()[0] < 1e-12


def test_dependence_of_an_additive_scorer_is_its_term(df):
    curve = dependence.partial_dependence(df, ADDITIVE, ["dti"]).collect()
    assert {round(r["value"] - 0.06 * r["num"], 9) for r in curve}.__len__() == 1


def test_unused_feature_has_no_importance(df):
    scorer = ExprScorer(["dti", "int_rate"], lambda c: c["int_rate"] / 10 + 0 * c["dti"])
    out = permutation.importance_by_r2(
        df.withColumn("own", F.col("int_rate") / 10), scorer, ID, "own", ["dti", "int_rate"], repeats=2
    )
    got = {r["feature"]: r["importance_mean"] for r in out.collect()}
    assert got["dti"] == 0 and got["int_rate"] > 1


def test_every_donor_is_used_once(df):
    keep = ExprScorer(["loan_id"], lambda c: c["loan_id"])
    runs = permutation.shuffled_scores(df, keep, ID, "target", [ID], 3, bucket_rows=100)
    want = sorted(r[0] for r in df.select(ID).collect())
    for repeat in (1, 2, 3):
        assert sorted(r["score"] for r in runs.filter(F.col("repeat") == repeat).collect()) == want


def test_sampled_attributions_add_up_and_match_the_exact_ones(df):
    bg = shapley.background(df, ID)
    wide = shapley.sampled_attributions(df, ADDITIVE, ID, bg)
    total = sum((F.col(f"phi_{f}") for f in SCORER_INPUTS), F.col("base_value"))
    joined = ADDITIVE.score(df.drop("score")).join(wide, ID)
    assert joined.agg(F.max(F.abs(total - F.col("score")))).first()[0] < 1e-9
    exact = shapley.additive_attributions(df, ADDITIVE, ID, bg)
    both = wide.join(exact.select(ID, *[F.col(f"phi_{f}").alias(f"e_{f}") for f in SCORER_INPUTS]), ID)
    gaps = both.agg(*[F.max(F.abs(F.col(f"phi_{f}") - F.col(f"e_{f}"))) for f in SCORER_INPUTS]).first()
    assert max(gaps) < 1e-9


def test_an_ignored_feature_has_no_attribution(df):
    scorer = ExprScorer(["dti", "pct_protected", "int_rate"], lambda c: c["int_rate"] * c["dti"] + F.sin(c["dti"]))
    wide = shapley.sampled_attributions(df, scorer, ID, shapley.background(df, ID))
    row = wide.agg(F.max(F.abs("phi_pct_protected")), F.max(F.abs("phi_dti"))).first()
    assert row[0] == 0 and row[1] > 1
    total = F.col("base_value") + F.col("phi_dti") + F.col("phi_pct_protected") + F.col("phi_int_rate")
    joined = scorer.score(df.drop("score")).join(wide, ID)
    assert joined.agg(F.max(F.abs(total - F.col("score")))).first()[0] < 1e-9


def test_attributions_of_two_features_are_the_shapley_values(df):
    """With two features and one walk each way per pair of background rows, by the definition."""
    scorer = ExprScorer(["dti", "int_rate"], lambda c: c["int_rate"] * c["dti"])
    bg = shapley.background(df, ID, rows=6)
    wide = {r[ID]: r for r in shapley.sampled_attributions(df.orderBy(ID).limit(40), scorer, ID, bg).collect()}
    rows, back = df.orderBy(ID).limit(40).collect(), sorted(bg.collect(), key=lambda r: r[ID])
    places = shapley.walks(["dti", "int_rate"], len(back), 42)
    shift = {r[ID]: r["h"] for r in df.select(ID, hash_long(ID, F.lit(42)).alias("h")).collect()}
    for x in rows:
        phi = 0.0
        for i, b in enumerate(back):
            first = places[(i + shift[x[ID]]) % len(back)][0] == 1  # dti first
            phi += (x["dti"] - b["dti"]) * (b["int_rate"] if first else x["int_rate"])
        assert wide[x[ID]]["phi_dti"] == pytest.approx(phi / len(back), abs=1e-9)


def test_margin_of_a_fitted_classifier_is_the_logit_of_its_score(df):
    train = split.by_years(df, "issue_d", TEST_YEARS)
    model = models.fit_model(train, models.black_box(rounds=3, depth=3), SCORER_NUMERIC, ["grade"])
    inputs = [*SCORER_NUMERIC, "grade"]
    p = MLScorer(model, inputs).score(df).select(ID, F.col("score").alias("p"))
    m = MLScorer(model, inputs, output="margin").score(df).select(ID, F.col("score").alias("m"))
    assert p.join(m, ID).agg(F.max(F.abs(F.col("p") - 1 / (1 + F.exp(-F.col("m")))))).first()[0] < 1e-12
    with pytest.raises(ValueError):
        MLScorer(model, inputs, output="odds")


def test_parity_ratio_times_majority_is_minority(spark, small):
    r = fairness.fairness_metrics(audited(spark, small)).first()
    assert r["DI"] * r["selection_rate_maj"] == pytest.approx(r["selection_rate_min"])
    assert r["SPD"] == pytest.approx(r["selection_rate_min"] - r["selection_rate_maj"])
    assert r["EO_TPR_diff"] == r["EOdds_TPR_diff"]


def test_local_weights_find_the_only_input(df):
    scorer = ExprScorer(["int_rate", "dti"], lambda c: c["int_rate"] / 10 + 0 * c["dti"])
    few = df.orderBy(ID).limit(5)
    out = local_linear.local_explanations(df, few, scorer, ID, samples=300).collect()
    assert len(out) == 10 and all(r["feature"] == "int_rate" for r in out if r["rank"] == 1)


def test_additive_model_recovers_a_curve(df):
    frame = split.by_years(df, "issue_d", TEST_YEARS).withColumn(
        "y", F.sin(F.col("dti") / 8) + F.when(F.col("grade") == "5-LOW", 1.0).otherwise(0.0)
    )
    train, test = frame.filter("split = 'train'"), frame.filter("split = 'test'")
    model, table = models.fit_additive(train, test, ["dti"], {"grade": ["1-URGENT", "5-LOW"]}, label="y")
    assert all(r["r2"] > 0.97 for r in table.collect())
    scored = model.scorer().score(test.drop("score"))
    assert metrics.regression_fit(scored, "y", "score").first()["r2"] > 0.97


def test_tree_surrogate_explains_the_score(df):
    train = split.by_years(df, "issue_d", TEST_YEARS)
    model = models.fit_model(train, models.tree_surrogate(depth=6, min_leaf=5), SCORER_NUMERIC, ["grade"])
    scored = MLScorer(model, [*SCORER_NUMERIC, "grade"]).score(df.withColumnRenamed("score", "actual"))
    assert metrics.regression_fit(scored, "actual", "score").first()["r2"] > 0.6
    assert np.isclose(models.importance_table(model, model.transform(df)).agg(F.sum("importance")).first()[0], 1.0)


@pytest.mark.parametrize("name", catalogue.oracle_sql())
def test_query_equals_sql(spark, small, name):
    sql = catalogue.oracle_sql()[name]
    assert difference(catalogue.queries()[name](spark, small), duck(small), sql) is None
