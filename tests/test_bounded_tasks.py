"""Plans whose tasks must not grow with the table."""

import pytest
from pyspark.sql import functions as F

from auditlens.operators import models, profile
from auditlens.operators.explain import dependence, local_linear, shapley
from auditlens.operators.scorers import ExprScorer


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def mixed(spark, n=400):
    x = (F.col("id") % 37).cast("double")
    return spark.range(n).select("id", x.alias("x"), F.format_string("t%d", F.col("id") % 3).alias("t"), (F.col("id") % 2).alias("g"))


@pytest.mark.parametrize("keys", [[], ["g"]])
def test_dependence_never_sorts_the_repeated_rows(spark, keys):
    scorer = ExprScorer(["x", "t"], lambda c: c["x"] / 10 + F.when(c["t"] == "t1", 1.0).otherwise(0.0))
    curve = dependence.partial_dependence(mixed(spark), scorer, ["x", "t"], keys=keys)
    assert "SortAggregate" not in plan(curve) and "Sort [" not in plan(curve)
    rows = curve.collect()
    assert len(rows) == 23 * (2 if keys else 1)
    texts = {r["text"] for r in rows if r["feature"] == "t"}
    assert texts == {"t0", "t1", "t2"} and all((r["num"] is None) == (r["feature"] == "t") for r in rows)


@pytest.fixture
def dealt_tables(monkeypatch):
    """Numbers of partitions that operators ask for, as they ask."""
    from pyspark.sql.classic.dataframe import DataFrame

    asked, plain = [], DataFrame.repartition

    def noted(self, parts, *by):
        asked.append(parts)
        return plain(self, parts, *by)

    monkeypatch.setattr(DataFrame, "repartition", noted)
    return asked


def test_fit_deals_rows_that_a_file_holds_in_one_piece(spark, dealt_tables):
    df = mixed(spark).coalesce(1)
    again = [models.fit_model(df, models.black_box(label="g", rounds=2, depth=2), ["x"], ["t"], task_rows=n) for n in (50, 400)]
    assert dealt_tables == [8]  # 400 rows, 50 a task; one partition holds 400
    assert all(m.transform(df).count() == 400 for m in again)


def test_black_box_keeps_no_table_of_node_ids():
    assert not models.black_box().getCacheNodeIds()


def test_waterfall_sorts_a_bounded_number_of_lines_in_a_task(spark, dealt_tables):
    ids = spark.range(300).select(F.col("id"), F.lit(0.5).alias("base_value"))
    phi = F.array(*[F.struct(F.lit(f"f{j:02d}").alias("feature"), (F.pmod(F.col("id") * (j + 3), F.lit(11)) - 5.0).alias("phi")) for j in range(16)])
    long = ids.select("id", "base_value", F.inline(phi))
    order = ["id", "step"]
    whole, parted = (shapley.waterfall(long, "id", task_rows=n).orderBy(*order).collect() for n in (10_000, 300))
    assert dealt_tables == [16] and whole == parted and len(whole) == 300 * 15


def test_ranks_are_put_together_by_a_bounded_number_of_rows(spark, dealt_tables):
    df = mixed(spark).withColumn("y", F.pmod(F.col("id") * 7, F.lit(19)).cast("double"))
    whole, parted = (sorted(profile.mid_ranks(df, ["x", "y"], "id", task_rows=n).collect()) for n in (10_000, 50))
    assert 16 in dealt_tables and whole == parted and len(whole) == 400


def test_samples_of_local_models_never_move(spark, dealt_tables):
    df = mixed(spark).withColumn("x", F.when(F.col("id") % 29 != 0, F.col("x")))
    twice = df.limit(20).unionByName(df.limit(5))
    scorer = ExprScorer(["x", "t"], lambda c: F.coalesce(c["x"], F.lit(0.0)) / 10 + F.when(c["t"] == "t1", 1.0).otherwise(0.0))
    fits = [local_linear.local_explanations(df, twice, scorer, "id", samples=50, task_samples=n) for n in (10_000, 25)]
    assert dealt_tables[-2:] == [8, 50]  # 25 rows, 50 samples each
    assert all(plan(f).count("Exchange hashpartitioning(id") == 1 and "Aggregate" not in plan(f) for f in fits)
    whole, parted = ({(r["id"], r["feature"]): r["weight"] for r in f.collect()} for f in fits)
    assert len(whole) == 40 and whole.keys() == parted.keys()
    assert all(abs(whole[k] - parted[k]) < 1e-9 for k in whole)


def test_walks_are_scored_side_by_side(spark):
    scorer = ExprScorer(["x", "y", "z"], lambda c: c["x"] * c["y"] + c["z"])
    df = mixed(spark, 60).select("id", "x", (F.col("id") % 5.0).alias("y"), (F.col("id") % 3.0).alias("z"))
    wide = shapley.sampled_attributions(df, scorer, "id", shapley.background(df, "id", rows=10))
    assert plan(wide).count("Generate ") == 1  # background rows; prefixes are columns
    total = wide.join(scorer.score(df), "id").agg(F.max(F.abs(F.col("base_value") + F.col("phi_x") + F.col("phi_y") + F.col("phi_z") - F.col("score"))))
    assert total.first()[0] < 1e-9 and wide.count() == 60
