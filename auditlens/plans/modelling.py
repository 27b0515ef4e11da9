"""Black box, surrogates, model store."""

from __future__ import annotations

from pyspark.sql import functions as F

from auditlens.functions.expr import decide, sigmoid
from auditlens.operators import metrics, models, split, stability
from auditlens.operators.encode import fit_categories
from auditlens.operators.explain import dependence, local_linear, permutation, shapley
from auditlens.operators.fairness import QUARTILE_LABELS
from auditlens.operators.metrics import fidelity
from auditlens.operators.ordering import hash_sample, with_quartiles
from auditlens.operators.scorers import MLScorer
from auditlens.plans.frames import rounded
from auditlens.plans.registry import query
from auditlens.plans.sql import on_loans, r
from auditlens.session import fresh_path, stored, stored_once
from auditlens.sources import tables
from auditlens.sources.loans import ID, SCORER_NUMERIC, TEST_YEARS, complete_loans

TEXT = ["grade", "home_ownership"]
ROUNDS, DEPTH, RATE = 800, 7, 0.08


def prepared(spark, sf_dir):
    """Loans with their split, written once per session: fits read them many times."""
    cols = [ID, "issue_d", *SCORER_NUMERIC, "funded_amnt", *TEXT, "score", "target"]
    make = lambda: split.by_years(complete_loans(spark, sf_dir).select(*cols), "issue_d", TEST_YEARS)
    return stored_once(spark, sf_dir, "prepared", make)


def train_of(df):
    return df.filter("split = 'train'")


_models: dict[tuple[str, str], str] = {}


def fitted_black_box(spark, sf_dir):
    """The boosted trees of the training years, fitted once per session and source and kept in the
    model store, with the rounds, depth and rate of a full study."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _models:
        estimator = models.black_box(rounds=ROUNDS, depth=DEPTH, rate=RATE)
        model = models.fit_model(train_of(prepared(spark, sf_dir)), estimator, SCORER_NUMERIC, TEXT)
        _models[key] = tables.save_model(model, fresh_path(spark, "black-box"))
    return tables.load_model(_models[key])


INPUTS = [*SCORER_NUMERIC, *TEXT]


def black_box_scorer(spark, sf_dir, output="score"):
    return MLScorer(fitted_black_box(spark, sf_dir), INPUTS, output=output)


def fitted(df, estimator):
    return models.fit_model(train_of(df), estimator, SCORER_NUMERIC, TEXT)


@query(
    "model_linear_one_feature",
    on_loans(f"SELECT {r('regr_slope(score, dti)')} AS slope, {r('regr_intercept(score, dti)')} AS intercept, regr_count(score, dti)::BIGINT AS n FROM ok"),
)
def model_linear_one_feature(spark, sf_dir):
    return rounded(models.linear_fit(complete_loans(spark, sf_dir), "dti", "score"))


@query("model_score_from_margin", on_loans(f"SELECT loan_id, {r('1.0::DOUBLE/(1.0::DOUBLE+exp(-margin))')} AS score FROM ok"))
def model_score_from_margin(spark, sf_dir):
    return rounded(complete_loans(spark, sf_dir).select(ID, sigmoid("margin").alias("score")))


@query("model_linear_surrogate")
def model_linear_surrogate(spark, sf_dir):
    df = prepared(spark, sf_dir)
    return fidelity(fitted(df, models.linear_surrogate()).transform(df), "score", "prediction")


@query("model_tree_surrogate")
def model_tree_surrogate(spark, sf_dir):
    df = prepared(spark, sf_dir)
    return fidelity(fitted(df, models.tree_surrogate(depth=6, min_leaf=50)).transform(df), "score", "prediction")


@query("model_shallow_tree_surrogate")
def model_shallow_tree_surrogate(spark, sf_dir):
    df = prepared(spark, sf_dir)
    return fidelity(fitted(df, models.tree_surrogate(depth=4, min_leaf=10)).transform(df), "score", "prediction")


@query("model_forest_surrogate")
def model_forest_surrogate(spark, sf_dir):
    df = prepared(spark, sf_dir)
    forest = models.forest_surrogate(trees=100, depth=10).fit(train_of(df), SCORER_NUMERIC, TEXT)
    return fidelity(forest.transform(df), "score", "prediction")


@query("model_black_box")
def model_black_box(spark, sf_dir):
    return models_scored(prepared(spark, sf_dir), fitted_black_box(spark, sf_dir))


@query(
    "model_black_box_checks",
    on_loans("SELECT count(*) AS n, true AS in_range, true AS ranks_targets, true AS separates FROM ok"),
)
def model_black_box_checks(spark, sf_dir):
    """Scores of the fitted black box are probabilities, rank targets better than chance on the test
    years, and separate the training rows at least as well."""
    df = prepared(spark, sf_dir)
    scored = stored(models_scored(df, fitted_black_box(spark, sf_dir), "split"), "fitted-scores")
    auc = {r["split"]: r["auc"] for r in metrics.roc_auc(scored, ["split"]).collect()}
    ok = F.min((F.col("score") >= 0) & (F.col("score") <= 1))
    return scored.agg(F.count("*").alias("n"), ok.alias("in_range"), F.lit(auc["test"] > 0.5).alias("ranks_targets"), F.lit(auc["train"] >= auc["test"]).alias("separates"))


@query("model_fitted_dependence")
def model_fitted_dependence(spark, sf_dir):
    """Partial dependence of the fitted black box over the test years, all inputs."""
    test = prepared(spark, sf_dir).filter("split = 'test'")
    return rounded(dependence.partial_dependence(test, black_box_scorer(spark, sf_dir), INPUTS))


@query("model_fitted_curves")
def model_fitted_curves(spark, sf_dir):
    """Individual curves of the fitted black box for 1,000 sampled rows of the test years."""
    test = prepared(spark, sf_dir).filter("split = 'test'")
    return rounded(dependence.individual_curves(test, black_box_scorer(spark, sf_dir), SCORER_NUMERIC, ID, rows=1000))


@query("model_fitted_local_linear")
def model_fitted_local_linear(spark, sf_dir):
    """Local models of the fitted black box around five loans of the test years, 5,000 samples each."""
    df = prepared(spark, sf_dir)
    chosen = df.filter("split = 'test'").orderBy(ID).limit(5)
    return local_linear.local_explanations(train_of(df), chosen, black_box_scorer(spark, sf_dir), ID)


@query("model_fitted_group_dependence")
def model_fitted_group_dependence(spark, sf_dir):
    """Partial dependence of the fitted black box inside each protected quartile of the test years."""
    test = with_quartiles(prepared(spark, sf_dir).filter("split = 'test'"), "pct_protected", QUARTILE_LABELS, "group")
    return rounded(dependence.group_dependence(test, black_box_scorer(spark, sf_dir), INPUTS, "group"))


@query("model_fitted_importance")
def model_fitted_importance(spark, sf_dir):
    """Permutation importance of the fitted black box over the test years."""
    test = prepared(spark, sf_dir).filter("split = 'test'")
    return permutation.importance_by_f1(test, black_box_scorer(spark, sf_dir), ID, "target", INPUTS, threshold=0.3)


@query("model_threshold_stability")
def model_threshold_stability(spark, sf_dir):
    """Fit, threshold of the best F1 on the training years, quality per test year at it."""
    df = prepared(spark, sf_dir)
    scored = stored(models_scored(df, fitted_black_box(spark, sf_dir), "issue_d", "split"), "fitted-scores")
    cut = metrics.best_f1_threshold(train_of(scored)).first()["threshold"]
    decided = scored.filter("split = 'test'").withColumn("y_hat", decide("score", cut))
    return rounded(stability.quality_by_year(decided, "issue_d").withColumn("threshold", F.lit(cut)))


def models_scored(df, model, *keep):
    return MLScorer(model, INPUTS).score(df).select(ID, "target", "score", *keep)


@query("model_batch_scoring")
def model_batch_scoring(spark, sf_dir):
    """Class and probability from a logistic-loss tree ensemble loaded from the model store."""
    scored = models_scored(prepared(spark, sf_dir), fitted_black_box(spark, sf_dir))
    return scored.withColumn("y_hat", (F.col("score") >= 0.5).cast("int"))


@query("model_store_round_trip", on_loans("SELECT CAST(0 AS DOUBLE) AS max_difference, count(*) AS n FROM ok"))
def model_store_round_trip(spark, sf_dir):
    """Largest score difference between a model and its reloaded copy."""
    df = prepared(spark, sf_dir)
    model = fitted(df, models.tree_surrogate(depth=4, min_leaf=10))
    again = tables.load_model(tables.save_model(model, fresh_path(spark, "model")))
    a = model.transform(df).select(ID, F.col("prediction").alias("a"))
    b = again.transform(df).select(ID, F.col("prediction").alias("b"))
    return a.join(b, ID).agg(F.max(F.abs(F.col("a") - F.col("b"))).alias("max_difference"), F.count("*").alias("n"))


@query("model_additive_surrogate")
def model_additive_surrogate(spark, sf_dir):
    """Additive model of splines and 0/1 terms; rows are its fidelity on train and test."""
    df = prepared(spark, sf_dir)
    train = train_of(df)
    best, _ = models.fit_additive(train, df.filter("split = 'test'"), SCORER_NUMERIC, fit_categories(train, TEXT))
    scored = best.scorer().score(df.withColumnRenamed("score", "actual"))
    return fidelity(scored, "actual", "score").withColumn("penalty", F.lit(float(best.penalty)))


@query("model_penalty_search")
def model_penalty_search(spark, sf_dir):
    df = prepared(spark, sf_dir)
    _, table = models.fit_additive(train_of(df), df.filter("split = 'test'"), SCORER_NUMERIC, {})
    return table


@query("model_coefficients")
def model_coefficients(spark, sf_dir):
    df = prepared(spark, sf_dir)
    model = fitted(df, models.linear_surrogate())
    return models.importance_table(model, model.transform(df))


@query("model_impurity_importance")
def model_impurity_importance(spark, sf_dir):
    df = prepared(spark, sf_dir)
    model = fitted(df, models.tree_surrogate())
    return models.importance_table(model, model.transform(df))


@query("model_tree_summary")
def model_tree_summary(spark, sf_dir):
    return models.tree_summary(fitted(prepared(spark, sf_dir), models.tree_surrogate(depth=4, min_leaf=10)), spark)


def shallow_tree(df):
    return fitted(df, models.tree_surrogate(depth=4, min_leaf=10))


@query("model_tree_nodes")
def model_tree_nodes(spark, sf_dir):
    return models.tree_nodes(shallow_tree(prepared(spark, sf_dir)), spark)


@query("model_tree_rules")
def model_tree_rules(spark, sf_dir):
    """One row per leaf with its merged conditions."""
    df = prepared(spark, sf_dir)
    model = shallow_tree(df)
    return models.tree_rules(model, model.transform(df))


@query("model_rules_applied", on_loans("SELECT count(*) AS n_rows, count(*) AS n_same_leaf, CAST(0 AS DOUBLE) AS max_difference FROM ok"))
def model_rules_applied(spark, sf_dir):
    """Rows whose only matching rule is the leaf that the tree itself puts them in."""
    df = prepared(spark, sf_dir)
    model = shallow_tree(df)
    scored = model.transform(df)
    rules = stored(models.tree_rules(model, scored), "rules")
    by_rule = models.rule_leaves(scored, rules, ID).groupBy(ID).agg(F.count("*").alias("k"), F.max("leaf").alias("rule_leaf"), F.max("prediction").alias("p"))
    both = scored.select(ID, "leaf", "prediction").join(by_rule, ID, "left")
    same = (F.col("k") == 1) & (F.col("rule_leaf") == F.col("leaf").cast("int"))
    return both.agg(F.count("*").alias("n_rows"), F.count_if(same).alias("n_same_leaf"), F.max(F.abs(F.col("p") - F.col("prediction"))).alias("max_difference"))


LEAF_CHECK = """SELECT CAST({depth} AS INTEGER) AS depth, (SELECT count(*) FROM ok WHERE issue_d NOT IN (1999,2000,2001)) AS n_rows, CAST(0 AS DOUBLE) AS max_difference, true AS large_enough, true AS pure_bound"""


@query("model_leaf_checks", on_loans(" UNION ALL ".join(LEAF_CHECK.format(depth=d) for d in (4, 6))))
def model_leaf_checks(spark, sf_dir):
    """Over the training rows of both tree surrogates: leaf sizes add up to the rows, a leaf predicts
    its mean, no leaf is below the minimum, and there are at most 2^depth leaves."""
    df = prepared(spark, sf_dir)
    parts = []
    for depth, least in ((4, 10), (6, 50)):
        model = fitted(df, models.tree_surrogate(depth=depth, min_leaf=least))
        leaves = models.leaf_summary(model.transform(train_of(df)), "score")
        gap = F.max(F.abs(F.col("prediction") - F.col("mean_label")))
        checks = [F.sum("n").alias("n_rows"), (F.round(gap, 9) + 0.0).alias("max_difference"), (F.min("n") >= least).alias("large_enough"), (F.count("*") <= 2**depth).alias("pure_bound")]
        parts.append(leaves.agg(*checks).select(F.lit(depth).alias("depth"), "*"))
    return parts[0].unionByName(parts[1])


@query("model_additive_store_round_trip", on_loans("SELECT CAST(0 AS DOUBLE) AS max_difference, count(*) AS n FROM ok"))
def model_additive_store_round_trip(spark, sf_dir):
    """Largest difference between an additive model and its reloaded copy."""
    df = prepared(spark, sf_dir)
    train = train_of(df)
    model, _ = models.fit_additive(train, df.filter("split = 'test'"), SCORER_NUMERIC, fit_categories(train, TEXT))
    again = models.AdditiveModel.load(spark, model.save(spark, fresh_path(spark, "additive")))
    cols = {c: F.col(c) for c in model.scorer().inputs}
    return df.agg(F.max(F.abs(model.predict(cols) - again.predict(cols))).alias("max_difference"), F.count("*").alias("n"))


@query("model_fitted_attributions")
def model_fitted_attributions(spark, sf_dir):
    """Margin-scale attributions of the fitted black box for 2,000 sampled rows of the test years."""
    df = prepared(spark, sf_dir)
    scorer = black_box_scorer(spark, sf_dir, output="margin")
    test = df.filter("split = 'test'")
    explained = hash_sample(test, ID, 2000, 42)
    return rounded(shapley.sampled_attributions(explained, scorer, ID, shapley.background(train_of(df), ID)))


@query("model_subgroup_stability")
def model_subgroup_stability(spark, sf_dir):
    """Fit, threshold of the best F1 on the training years, quality per subgroup of the test years:
    grades, home ownership, and quartiles of income and amount."""
    df = prepared(spark, sf_dir)
    scored = stored(models_scored(df, fitted_black_box(spark, sf_dir), "split", "grade", "home_ownership", "annual_inc", "funded_amnt"), "fitted-scores")
    cut = metrics.best_f1_threshold(train_of(scored)).first()["threshold"]
    test = scored.filter("split = 'test'").withColumn("y_hat", decide("score", cut))
    named = stability.quality_by_subgroup(test, {c: c for c in TEXT})
    bands = {"annual_inc": ("income_quartile", stability.INCOME_LABELS), "funded_amnt": ("loan_amount_quartile", stability.AMOUNT_LABELS)}
    return rounded(named.unionByName(stability.quality_by_quartile(test, bands)).withColumn("threshold", F.lit(cut)))


@query("model_leaf_rows")
def model_leaf_rows(spark, sf_dir):
    df = prepared(spark, sf_dir)
    return fitted(df, models.tree_surrogate(depth=4, min_leaf=10)).transform(df).select(ID, "leaf", "prediction")


@query("model_leaf_summary")
def model_leaf_summary(spark, sf_dir):
    df = prepared(spark, sf_dir)
    return models.leaf_summary(fitted(df, models.tree_surrogate(depth=4, min_leaf=10)).transform(df), "score")
