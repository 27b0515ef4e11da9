"""Hand-computed tables for edge cases."""

import math

import pytest
from pyspark.sql import functions as F

from auditlens import session
from auditlens.functions import tails
from auditlens.functions.expr import clean_name, cubic_basis
from auditlens.operators import clean, compare, encode, fairness, metrics, models, profile
from auditlens.operators.ordering import exact_quantiles, fit_quantiles, with_quartiles


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_auc_counts_ties_half(spark):
    df = spark.createDataFrame([(0.2, 0), (0.5, 1), (0.5, 0), (0.8, 1)], "score double, target int")
    assert rows(metrics.roc_auc(df)) == [(0.875,)]


def test_auc_of_one_class_is_null(spark):
    df = spark.createDataFrame([(0.1 * i, 1) for i in range(4)], "score double, target int")
    assert rows(metrics.roc_auc(df)) == [(None,)]


def test_calibration_bins_are_right_closed(spark):
    df = spark.createDataFrame([(0.0,), (0.1,), (0.1000001,), (1.0,)], "s double")
    assert [r[0] for r in df.select(fairness.calibration_bin("s")).collect()] == [None, 1, 2, 10]


def test_yates_correction_applies_to_two_by_two(spark):
    cells = spark.createDataFrame([("a", 10, 20), ("b", 30, 40)], "group string, n0 long, n1 long")
    out = fairness.independence_statistics(cells).first()
    # E = 12, 18, 28, 42 and |O - E| = 2, so (2 - 0.5)^2 times the sum of 1/E
    expected = 1.5**2 * (1 / 12 + 1 / 18 + 1 / 28 + 1 / 42)
    assert out["dof"] == 1 and out["chi2"] == pytest.approx(expected)


def test_one_decision_class_is_degenerate(spark):
    cells = spark.createDataFrame([(g, 5, 0) for g in "abcd"], "group string, n0 long, n1 long")
    out = fairness.independence_statistics(cells).first()
    assert (out["chi2"], out["dof"], out["degenerate"]) == (0.0, 0, True)
    assert tails.chi2_tail(0.0, 0) == 1.0


def test_tails_match_tables():
    assert tails.chi2_tail(3.841458820694124, 1) == pytest.approx(0.05, abs=1e-10)
    assert tails.chi2_tail(7.814727903251179, 3) == pytest.approx(0.05, abs=1e-10)
    assert tails.chi2_tail(18.307038053275146, 10) == pytest.approx(0.05, abs=1e-10)
    assert tails.t_tail(2.228138852, 10) == pytest.approx(0.025, abs=1e-8)
    assert tails.t_tail(-2.228138852, 10) == pytest.approx(0.975, abs=1e-8)
    assert tails.t_tail(1.644853627, 1e9) == pytest.approx(0.05, abs=1e-6)


def test_names_are_cleaned_and_made_unique(spark):
    names = ["1 year", "< 1 year", "emp[1]", "emp(1)", "42", ""]
    df = spark.createDataFrame(list(enumerate(names)), "i long, name string")
    cleaned = [r[0] for r in df.orderBy("i").select(clean_name(F.col("name"), F.col("i"))).collect()]
    assert cleaned == ["1_year", "1_year", "emp_1", "emp_1", "feature_4", "feature_5"]
    unique = clean.unique_clean_names(df, "name", "i").orderBy("i").select("clean_name")
    assert [r[0] for r in unique.collect()] == ["1_year", "1_year_1", "emp_1", "emp_1_1", "feature_4", "feature_5"]
    wide = spark.createDataFrame([(1, 2, 3)], ["a b", "a_b_1", "a[b"])
    assert clean.with_clean_columns(wide).columns == ["a_b", "a_b_1", "a_b_2"]


def test_dirty_numbers(spark):
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame([(nan,), (inf,), (-inf,), (None,), (0.0,)], "x double")
    assert rows(clean.infinite_to_null(df)) == [(None,)] * 4 + [(0.0,)]
    assert rows(clean.non_finite_to_zero(df)) == [(0.0,)] * 5
    assert rows(clean.drop_missing(df)) == [(0.0,)]
    assert rows(clean.non_finite_counts(df)) == [("x", 1, 2, 1)]


def test_constant_feature(spark):
    df = spark.createDataFrame([(5.0, 0.1 * i) for i in range(8)], "x double, score double")
    assert rows(with_quartiles(df, "x", list("abcd"), "q").select("q").distinct()) == [("a",)]
    assert profile.correlation_ranking(df, ["x"], [], "score").count() == 0


def test_unknown_category_is_all_zero(spark):
    train = spark.createDataFrame([("a",), ("b",)], "c string")
    test = spark.createDataFrame([("z",), (None,), ("b",)], "c string")
    assert rows(encode.one_hot(test, encode.fit_categories(train, ["c"]), [])) == [(0, 0), (0, 0), (0, 1)]


def test_small_groups_are_left_out(spark):
    sizes = {"a": 9, "b": 10, "c": 49, "d": 50}
    df = spark.createDataFrame([(g,) for g, n in sizes.items() for _ in range(n)], "g string")
    for least, kept in ((10, "bcd"), (50, "d")):
        assert sorted(r["g"] for r in clean.supported_groups(df, ["g"], least).collect()) == list(kept)


@pytest.mark.parametrize("most", [5, 10**6])
def test_quantiles_equal_the_exact_aggregate(spark, most):
    df = spark.range(20000).select(
        (F.pmod(F.xxhash64("id"), F.lit(3000)) / 7).alias("x"), (F.col("id") % 3).alias("k"), F.lit(2.0).alias("flat")
    )
    probs = [0.0, 0.05, 0.25, 0.5, 0.9, 1.0]
    want = df.select(F.percentile("x", F.array(*[F.lit(p) for p in probs]))).first()[0]
    got = exact_quantiles(df, ["x", "flat"], probs, most=most).collect()
    assert {r["feature"]: r["q"] for r in got}["x"] == pytest.approx(want, abs=1e-9)
    assert {r["feature"]: r["q"] for r in got}["flat"] == [2.0] * 6
    keyed = exact_quantiles(df, ["x"], [0.25, 0.5], keys=["k"], most=most)
    true = {r["k"]: r["q"] for r in df.groupBy("k").agg(F.expr("percentile(x, array(0.25, 0.5)) q")).collect()}
    for r in keyed.collect():
        assert r["q"] == pytest.approx(true[r["k"]], abs=1e-9)


def test_quantiles_of_an_empty_column(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert fit_quantiles(df, ["x"], [0.5]) == {"x": [None]}


def test_spline_basis_adds_up_to_one(spark):
    df = spark.range(50).select((F.col("id") / 7).alias("x"))
    total = sum(cubic_basis(F.col("x"), 0.0, 7.0, 8), F.lit(0.0))
    assert all(math.isclose(r[0], 1.0) for r in df.select(total).collect())


def test_binary_groups_take_the_first_value_as_minority(spark):
    df = spark.createDataFrame([("x ",), ("y",), ("y",)], "g string")
    assert [r[0] for r in fairness.with_groups(df, "g").select("group").collect()] == ["minority", "majority", "majority"]


def test_auc_of_scores_that_hardly_differ(spark):
    frame = spark.createDataFrame([(0.5 + i * 1e-8, int(i >= 10)) for i in range(20)], "score double, target int")
    assert metrics.roc_auc(frame).first()[0] == 1.0
    assert metrics.best_f1_threshold(frame).first()["threshold"] == 0.5 + 10 * 1e-8


def test_unique_names_keep_every_row(spark):
    frame = spark.createDataFrame([("a", 1), ("a", 2), ("a_1", 3), (None, 4), ("b", 5)], "name string, at int")
    got = clean.unique_clean_names(frame, "name", "at").collect()
    assert len({r["clean_name"] for r in got}) == len(got) == 5
    assert {r["at"]: r["clean_name"] for r in got} == {1: "a", 2: "a_1", 3: "a_1_1", 4: "feature_4", 5: "b"}


def test_fit_uses_the_same_rows_in_every_term(spark):
    frame = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (9.0, None)], "y double, p double")
    got = metrics.regression_fit(frame, "y", "p").first()
    assert (got["n_samples"], got["mse"], got["r2"]) == (2, 0.5, -1.0)


def test_equal_means_without_variance_are_equivalent(spark):
    sides = "struct<group string, n long, mean_score double, var_score double>".replace("struct<", "").rstrip(">")
    frame = spark.createDataFrame([(("a", 5, 0.3, 0.0), ("b", 6, 0.3, 0.0))], f"mino struct<{_typed(sides)}>, maj struct<{_typed(sides)}>")
    got = fairness.equivalence_test(frame).first()
    assert got["p_value"] == 0.0 and got["result"] == "Equivalence Accepted"


def _typed(fields):
    return ", ".join(f.replace(" ", ": ", 1) for f in fields.split(", "))


def test_ranking_needs_the_overall_test(spark):
    rows = [("x", 0.9, True, 0.5), ("y", 0.01, False, 0.5)]
    frame = spark.createDataFrame(rows, "feature string, p_value double, restored boolean, overall_p double")
    got = {r["feature"]: r for r in fairness.candidate_ranking(frame, ["x", "y", "z"]).collect()}
    assert not any(r["is_candidate"] for r in got.values()) and got["z"]["max_p_value"] == 0.0
    sure = fairness.candidate_ranking(frame.withColumn("overall_p", F.lit(0.001))).collect()
    assert {r["feature"] for r in sure if r["is_candidate"]} == {"x"}


def test_one_hot_of_a_column_with_many_values(spark):
    frame = spark.range(120).select(F.concat(F.lit("v"), "id").alias("c"))
    assert len(encode.one_hot(frame, encode.fit_categories(frame, ["c"]), []).columns) == 120


def test_specific_features_are_those_of_one_list_only(spark):
    a = spark.createDataFrame([("dti", 3.0), ("int_rate", 2.0), ("grade", 1.0)], "feature string, importance double")
    b = spark.createDataFrame([("dti", 0.9), ("open_acc", 0.5), ("grade", 0.4)], "feature string, correlation double")
    assert sorted(rows(compare.specific_features(a, b))) == [("int_rate", "first"), ("open_acc", "second")]
    assert sorted(rows(compare.common_features(a, b))) == [("dti",), ("grade",)]


def test_slots_of_a_text_add_up_to_its_column(spark):
    slots = spark.createDataFrame([("dti", 0.5), ("grade_oh_a", 0.2), ("grade_oh_b", 0.1), ("grade_ohm", 0.2)], "feature string, importance double")
    got = {r["feature"]: round(r["importance"], 9) for r in models.importance_by_column(slots, ["grade"]).collect()}
    assert got == {"dti": 0.5, "grade": 0.3, "grade_ohm": 0.2}


def test_working_folder_without_a_setting(spark):
    """In local mode a folder is made once per application; elsewhere the setting is required."""

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        applicationId = "app-of-a-test"
        master = "local[2]"

        def setCheckpointDir(self, path):
            self.path = path

    class Session:
        conf, sparkContext = Conf(), Context()

    first = session.shared_dir(Session)
    assert first == session.shared_dir(Session) == Session.sparkContext.path
    Session.sparkContext.master = "local-cluster[2,1,1024]"
    with pytest.raises(ValueError):
        session.shared_dir(Session)


def test_attributes_are_chosen_by_name_then_by_size(spark):
    df = spark.createDataFrame([(i, i % 3, "x" if i % 2 else "y") for i in range(40)], "id long, Race_Desc int, kind string")
    assert fairness.choose_protected(df, "kind") == "kind"
    assert fairness.choose_protected(df, "absent") == "Race_Desc"
    assert fairness.choose_protected(df.withColumnRenamed("Race_Desc", "target")) == "kind"
    with pytest.raises(ValueError):
        fairness.choose_protected(df.select("id"))
