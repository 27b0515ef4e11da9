"""Comparison of explanations and surrogates. Inputs are small: a row per feature or model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlens.functions.expr import ratio


def common_features(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select("feature").intersect(b.select("feature"))


def specific_features(a: DataFrame, b: DataFrame) -> DataFrame:
    """Features in one list only, with the side they are on."""
    only = lambda x, y, side: x.select("feature").join(y.select("feature"), "feature", "left_anti").distinct().withColumn("side", F.lit(side))  # noqa: E731,E501
    return only(a, b, "first").unionByName(only(b, a, "second"))


def fidelity_table(models: DataFrame) -> DataFrame:
    """Rows (model, r2) with the best model, the gap to it and whether the model is best."""
    best = models.agg(F.max_by(F.struct("model", "r2"), F.struct("r2", "model"))).scalar()
    return (
        models.withColumn("_b", best)
        .select(
            "model",
            "r2",
            F.col("_b.model").alias("best_model"),
            (F.col("r2") - F.col("_b.r2")).alias("gap"),
            (F.col("model") == F.col("_b.model")).alias("is_best"),
        )
    )


def easier_or_harder(models: DataFrame, first: str, second: str) -> DataFrame:
    """Whether the second model is easier to imitate than the first."""
    pick = lambda m: F.max(F.when(F.col("model") == m, F.col("r2")))
    both = models.agg(pick(first).alias("first_r2"), pick(second).alias("second_r2"))
    gap = F.col("second_r2") - F.col("first_r2")
    return both.withColumn("gap", gap).withColumn("verdict", F.when(gap > 0, "easier").otherwise("harder"))


def improvement(models: DataFrame, over: str) -> DataFrame:
    """Absolute and relative improvement of every model over another one."""
    base = models.agg(F.max(F.when(F.col("model") == over, F.col("r2")))).scalar()
    return models.withColumn("_base", base).select(
        "model",
        "r2",
        (F.col("r2") - F.col("_base")).alias("gain"),
        (ratio(F.col("r2") - F.col("_base"), F.col("_base")) * 100).alias("gain_percent"),
    )


def fidelity_verdict(models: DataFrame) -> DataFrame:
    r = F.col("r2")
    return models.withColumn("verdict", F.when(r > 0.6, "success").when(r > 0.4, "improvement").otherwise("failure"))


def summary_record(first_models: DataFrame, second_models: DataFrame, first_top: DataFrame, second_top: DataFrame) -> DataFrame:
    """Best R2 of either study, their gap, common and specific features, recommendation."""
    best = lambda m: m.agg(F.max("r2")).scalar()
    listed = lambda d: d.agg(F.sort_array(F.collect_set("feature"))).scalar()
    a, b = listed(first_top), listed(second_top)
    one = first_models.limit(1).select(
        best(first_models).alias("first_best_r2"),
        best(second_models).alias("second_best_r2"),
        F.sort_array(F.array_intersect(a, b)).alias("common_features"),
        F.sort_array(F.array_except(b, a)).alias("second_specific"),
    )
    gap = F.col("second_best_r2") - F.col("first_best_r2")
    return one.withColumn("fidelity_gap", gap).withColumn(
        "recommendation", F.when(gap > 0, "second").otherwise("first")
    )


def importance_comparison(permuted: DataFrame, builtin: DataFrame) -> DataFrame:
    """Permutation against built-in importance: full outer join, ranks and their difference."""
    from pyspark.sql import Window

    rank = lambda c: F.rank().over(Window.partitionBy(F.lit(0)).orderBy(F.col(c).desc()))
    a = permuted.select("feature", F.col("importance_mean").alias("permutation_importance"))
    b = builtin.select("feature", F.col("importance").alias("builtin_importance"))
    a = a.withColumn("permutation_rank", rank("permutation_importance"))
    b = b.withColumn("builtin_rank", rank("builtin_importance"))
    return a.join(b, "feature", "full_outer").withColumn(
        "rank_difference", F.col("permutation_rank") - F.col("builtin_rank")
    )
