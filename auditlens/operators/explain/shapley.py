"""Shapley attributions and the tables drawn from them."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from auditlens.functions.expr import hash_long, hash_unit, ratio
from auditlens.operators.ordering import TASK_ROWS, dealt, hash_sample
from auditlens.operators.scorers import AdditiveScorer

BACKGROUND_ROWS = 100


def background(df: DataFrame, id_col: str, rows: int = BACKGROUND_ROWS, seed: int = 42) -> DataFrame:
    """Sampled reference rows, in the order of their hashes in one partition: sums over them do not
    depend on how the table was split. At most some hundred."""
    few = hash_sample(df, id_col, rows, seed)
    return few.orderBy(hash_unit(id_col, F.lit(seed)), id_col).limit(rows)


def additive_attributions(df: DataFrame, scorer: AdditiveScorer, id_col: str, reference: DataFrame) -> DataFrame:
    """Exact Shapley values of an additive scorer: term minus its mean over ``reference``.

    Wide rows (id, base_value, phi_<feature>...), one per input row, no shuffle.
    """
    terms = scorer.terms({c: F.col(f"`{c}`") for c in scorer.inputs})
    means = reference.agg(*[F.avg(t).alias(f) for f, t in terms.items()]).first()
    base = scorer.intercept + sum(means)
    return df.select(
        id_col,
        F.lit(base).alias("base_value"),
        *[(t - F.lit(means[f])).alias(f"phi_{f}") for f, t in terms.items()],
        *[F.col(f"`{c}`") for c in scorer.inputs],
    )


def walks(features: list[str], rows: int, seed: int) -> list[list[int]]:
    """Place (from 1) of every feature in the order of each walk. Orders are drawn from md5; an odd
    walk goes the order of the walk before it in reverse."""
    out = []
    for w in range(rows):
        order = sorted(features, key=lambda f: hashlib.md5(f"{w // 2}|{f}|{seed}".encode()).hexdigest())
        if w % 2:
            order.reverse()
        out.append([order.index(f) + 1 for f in features])
    return out


def sampled_attributions(df: DataFrame, scorer, id_col: str, reference: DataFrame, seed: int = 42) -> DataFrame:
    """Shapley values of any scorer by paired coalition regression.

    The coalitions of a walk are the prefixes of an order, those of its pair the prefixes of the
    reversed order, which are the complements. In coordinates of prefix sums the Gram matrix of the
    kernel-weighted least squares over such a pair, constrained to add up to score minus base, is
    diagonal and the same constant for every pair, so the solution needs no solve: an attribution is
    the mean difference of the score with and without the feature along the walks, a sum per row.

    Every row goes one walk from every background row, and its id shifts which walk that is, so each
    background row and each walk is used once per row. Hence attributions add up to score minus
    base_value, the mean score of the whole background; an additive scorer gets its exact values; and
    a feature that the scorer ignores gets 0, its two sums being the same numbers in the same order.

    Explode factor rows of ``reference``. A walk begins at its background row and ends at the row itself,
    whose scores are taken once for all walks; the prefixes between them are scored side by side. A
    row's walks lie in one task and are added up before the shuffle. ``reference`` is at most some
    hundred rows and travels as one array; ``id_col`` is unique.
    """
    features = scorer.inputs
    given = scorer.score(reference.select(F.col(id_col).alias("_id"), *[F.col(f).alias(f"_x{i}") for i, f in enumerate(features)], *features))
    rows = given.agg(F.array_sort(F.collect_list(F.struct("_id", *[f"_x{i}" for i in range(len(features))], F.col("score").alias("_s"))))).scalar()
    n = reference.count()
    places = F.expr("array(" + ", ".join(f"array({', '.join(map(str, w))})" for w in walks(features, n, seed)) + ")")
    own = [F.col(f).alias(f"_x{i}") for i, f in enumerate(features)]
    named = df.select(F.col(id_col).alias("_id"), *own, hash_long(id_col, F.lit(seed)).alias("_h"), *features)
    start = scorer.score(named).select("_id", *[f"_x{i}" for i in range(len(features))], "_h", F.col("score").alias("_last"), rows.alias("_bg"))
    met = start.select("*", F.posexplode("_bg").alias("_r", "_b"))
    walk = met.withColumn("_p", F.get(places, F.pmod(F.col("_r") + F.col("_h"), F.lit(n)).cast("int"))).drop("_bg")
    place = [F.get("_p", F.lit(i)) for i in range(len(features))]
    for k in range(1, len(features)):
        mixed = [F.when(p <= k, F.col(f"_x{i}")).otherwise(F.col(f"_b._x{i}")).alias(f) for i, (f, p) in enumerate(zip(features, place))]
        walk = scorer.score(walk.select("*", *mixed)).withColumnRenamed("score", f"_s{k}").drop(*features)
    scores = F.array(F.col("_b._s"), *[F.col(f"_s{k}") for k in range(1, len(features))], F.col("_last"))
    scored = walk.select("_id", "_p", scores.alias("_s"))
    sums = scored.groupBy("_id").agg(
        F.sum(F.get("_s", F.lit(0))).alias("_base"),
        *[F.sum(F.get("_s", p)).alias(f"_with{i}") for i, p in enumerate(place)],
        *[F.sum(F.get("_s", p - 1)).alias(f"_without{i}") for i, p in enumerate(place)],
    )
    mean = [((F.col(f"_with{i}") - F.col(f"_without{i}")) / n).alias(f"phi_{f}") for i, f in enumerate(features)]
    return sums.select(F.col("_id").alias(id_col), (F.col("_base") / n).alias("base_value"), *mean)


def long_attributions(wide: DataFrame, features: list[str], id_col: str) -> DataFrame:
    """Rows (id, base_value, feature, phi)."""
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"`phi_{f}`").alias("phi")) for f in features])
    return wide.select(id_col, "base_value", F.inline(pairs))


def attribution_importance(long: DataFrame) -> DataFrame:
    return long.groupBy("feature").agg(
        F.avg(F.abs("phi")).alias("importance"), F.avg("phi").alias("mean_shap"), F.stddev_pop("phi").alias("std_shap")
    )


def direction_table(importance: DataFrame) -> DataFrame:
    m = F.col("mean_shap")
    return importance.withColumn("direction", F.when(m > 0, "INCREASES").otherwise("DECREASES"))


def direction_counts(importance: DataFrame) -> DataFrame:
    """Number and share of features that raise, lower or leave the mean."""
    m = F.col("mean_shap")
    return importance.agg(
        F.count_if(m > 0).alias("n_increasing"),
        F.count_if(m < 0).alias("n_decreasing"),
        (F.count_if(m > 0) / F.count("*")).alias("share_increasing"),
        (F.count_if(m < 0) / F.count("*")).alias("share_decreasing"),
    )


def top_factors(importance: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` most important features of either sign. ``importance`` has one row per feature."""
    m = F.col("mean_shap")
    signed = importance.filter(m != 0).withColumn("side", F.when(m > 0, "raising").otherwise("lowering"))
    order = Window.partitionBy("side").orderBy(F.round("importance", 9).desc(), "feature")
    return signed.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def attribution_statistics(long: DataFrame, k: int = 10) -> DataFrame:
    """Variance share of the ``k`` most important features, overall mean and std, base value."""
    per = long.groupBy("feature").agg(
        F.count("*").alias("n"),
        F.avg(F.abs("phi")).alias("importance"),
        F.avg("phi").alias("m"),
        F.var_pop("phi").alias("v"),
        F.avg("base_value").alias("b"),
    )
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("importance")).alias("i"), "feature", "v")))
    one = per.agg(
        ranked.alias("r"),
        F.sum("v").alias("total"),
        (F.sum(F.col("m") * F.col("n")) / F.sum("n")).alias("mean_shap"),
        F.sum(F.col("n") * (F.col("v") + F.col("m") * F.col("m"))).alias("ss"),
        F.sum("n").alias("n"),
        F.avg("b").alias("base_value"),
    )
    top = F.aggregate(F.slice("r", 1, k), F.lit(0.0), lambda acc, x: acc + x["v"])
    return one.select(
        ratio(top, F.col("total")).alias("top_variance_share"),
        "mean_shap",
        F.sqrt(F.col("ss") / F.col("n") - F.col("mean_shap") * F.col("mean_shap")).alias("std_shap"),
        "base_value",
    )


def waterfall(long: DataFrame, id_col: str, shown: int = 15, task_rows: int = TASK_ROWS) -> DataFrame:
    """Contributions of each row, largest first, with the running total from the base value.
    Beyond ``shown`` lines the rest is summed in one last line. Partitions are one row's features;
    a task sorts about ``task_rows`` of them."""
    long = dealt(long, id_col, long.count(), task_rows)
    order = Window.partitionBy(id_col).orderBy(F.round(F.abs("phi"), 9).desc(), "feature")
    size = Window.partitionBy(id_col)
    ranked = long.withColumn("_rank", F.row_number().over(order)).withColumn("_size", F.count("*").over(size))
    rest = (F.col("_size") > shown) & (F.col("_rank") >= shown)
    lines = (
        ranked.withColumn("step", F.when(rest, F.lit(shown)).otherwise(F.col("_rank")))
        .withColumn("label", F.when(rest, F.lit("other features")).otherwise(F.col("feature")))
        .groupBy(id_col, "step", "label")
        .agg(F.sum("phi").alias("phi"), F.max("base_value").alias("base_value"))
    )
    running = Window.partitionBy(id_col).orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn("running_total", F.col("base_value") + F.sum("phi").over(running))


def dependence_pairs(wide: DataFrame, features: list[str], values: list[str], id_col: str, k: int = 10) -> DataFrame:
    """(feature value, attribution) of every row for the ``k`` most important features.
    ``values`` are the numeric ones; others carry their text."""
    pairs = F.array(
        *[
            F.struct(
                F.lit(f).alias("feature"),
                (F.col(f"`{f}`") if f in values else F.lit(None)).cast("double").alias("num"),
                (F.lit(None) if f in values else F.col(f"`{f}`")).cast("string").alias("text"),
                F.col(f"`phi_{f}`").alias("phi"),
            )
            for f in features
        ]
    )
    best = attribution_importance(long_attributions(wide, features, id_col))
    best = best.orderBy(F.round("importance", 9).desc(), "feature").limit(k).select("feature")
    # ``best`` has at most k rows
    return wide.select(id_col, F.inline(pairs)).join(F.broadcast(best), "feature", "left_semi")
