"""Permutation importance over all rows.

Rows are hashed into buckets of about ``bucket_rows`` rows and put in hash order. In every
(feature, repeat) each row takes the feature from the row that stands a drawn distance
further in its bucket: a random derangement, with every donor used once. The rows move
once; all features and repeats reuse that one shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlens.functions.expr import constant_rows, decide, hash_long, ratio
from auditlens.operators.metrics import weighted_f1

BUCKET_ROWS = 2000


def shuffled_scores(
    df: DataFrame,
    scorer,
    id_col: str,
    label: str,
    features: list[str],
    repeats: int,
    seed: int = 42,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Rows (feature, repeat, label, score); repeat 0 (no feature) is the untouched table.

    ``id_col`` must be unique: then the hash spreads rows evenly and a bucket stays near
    ``bucket_rows`` whatever the other columns hold.
    """
    buckets = df.agg(F.greatest(F.lit(1), F.ceil(F.count("*") / bucket_rows)).cast("long")).scalar()
    inputs = list(dict.fromkeys([*scorer.inputs, *features]))
    columns = list(dict.fromkeys([id_col, label, *inputs]))
    hashed = df.select(*columns, hash_long(id_col, F.lit(seed)).alias("_h")).withColumn(
        "_bucket", F.pmod(F.col("_h"), buckets)
    )
    every = [{"feature": f, "repeat": r} for f in features for r in range(1, repeats + 1)]
    runs = constant_rows([{"feature": None, "repeat": 0}, *every], "feature string, repeat int")
    gathered = hashed.groupBy("_bucket").agg(
        F.array_sort(F.collect_list(F.struct("_h", *columns))).alias("_rows")
    )
    size = F.size("_rows")
    step = F.when(
        F.col("feature").isNotNull() & (size > 1),
        1 + F.pmod(hash_long("_bucket", "feature", "repeat", F.lit(seed)), size - 1),
    ).otherwise(F.lit(0))
    run = gathered.select("_bucket", "_rows", F.inline(runs)).withColumn("_step", step.cast("int"))
    rotated = F.concat(
        F.slice("_rows", F.col("_step") + 1, F.size("_rows")), F.slice("_rows", F.lit(1), F.col("_step"))
    )
    # the bucket itself is not kept beside its rows: they would each carry a copy
    pairs = run.select(
        "feature", "repeat", F.inline(F.arrays_zip(F.col("_rows").alias("_row"), rotated.alias("_donor")))
    )
    shifted = []
    for c in inputs:
        own, given = F.col(f"_row.{c}"), F.col(f"_donor.{c}")
        shifted.append((F.when(F.col("feature") == c, given).otherwise(own) if c in features else own).alias(c))
    mixed = pairs.select("feature", "repeat", F.col(f"_row.{label}").alias(label), *shifted)
    return scorer.score(mixed).select("feature", "repeat", label, "score")


def _importance(metric: DataFrame) -> DataFrame:
    """Baseline minus permuted metric; population std over repeats. ``metric`` has
    |features| x repeats + 1 rows."""
    gathered = metric.agg(
        F.max(F.when(F.col("repeat") == 0, F.col("_metric"))).alias("_base"),
        F.collect_list(F.when(F.col("repeat") > 0, F.struct("feature", "repeat", "_metric"))).alias("_items"),
    )
    drop = F.col("_base") - F.col("_metric")
    return (
        gathered.select("_base", F.inline("_items"))
        .groupBy("feature")
        .agg(F.avg(drop).alias("importance_mean"), F.stddev_pop(drop).alias("importance_std"))
    )


def importance_by_f1(df, scorer, id_col, label, features, repeats=5, threshold=0.5, **options) -> DataFrame:
    """Drop of the support-weighted F1."""
    runs = shuffled_scores(df, scorer, id_col, label, features, repeats, **options)
    y, p = F.col(label), decide("score", threshold)
    counts = runs.groupBy("feature", "repeat").agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
    )
    return _importance(weighted_f1(counts).withColumnRenamed("weighted_f1", "_metric"))


def importance_by_r2(df, scorer, id_col, label, features, repeats=10, **options) -> DataFrame:
    """Drop of R2 against a continuous label."""
    runs = shuffled_scores(df, scorer, id_col, label, features, repeats, **options)
    err = F.col(label) - F.col("score")
    fit = runs.groupBy("feature", "repeat").agg(F.avg(err * err).alias("_mse"), F.var_pop(label).alias("_v"))
    return _importance(fit.withColumn("_metric", 1 - ratio("_mse", "_v")))


def importance_summary(importance: DataFrame) -> DataFrame:
    """Rows (feature, importance_mean, level) with the table's mean, std, max, min, and the
    verdict 'high' above mean + 1 std, 'near zero' at or below 0.001. One row per feature."""
    stats = importance.agg(
        F.struct(
            F.avg("importance_mean").alias("mean"),
            F.stddev_samp("importance_mean").alias("std"),
            F.max("importance_mean").alias("max"),
            F.min("importance_mean").alias("min"),
        )
    ).scalar()
    x = F.col("importance_mean")
    return (
        importance.withColumn("_s", stats)
        .select(
            "feature",
            "importance_mean",
            F.col("_s.mean").alias("mean"),
            F.col("_s.std").alias("std"),
            F.col("_s.max").alias("max"),
            F.col("_s.min").alias("min"),
            F.when(x > F.col("_s.mean") + F.col("_s.std"), "high")
            .when(x <= 0.001, "near zero")
            .otherwise("normal")
            .alias("level"),
        )
    )


def importance_tier(importance: DataFrame) -> DataFrame:
    x = F.col("importance_mean")
    return importance.withColumn("tier", F.when(x > 0.01, "strong").when(x >= 0.005, "medium").otherwise("weak"))
