"""Classification and regression quality. Every metric takes a list of group columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from auditlens.functions.expr import ratio, ratio0
from auditlens.operators.ordering import running_totals
from auditlens.session import stored

# Thresholds of the sweep.
SWEEP = [0.10, 0.15, 0.20, 0.25, 0.30, 0.35, 0.40, 0.45, 0.50, 0.55, 0.60, 0.65, 0.70, 0.75, 0.80, 0.85]


def regression_fit(df: DataFrame, actual: str, predicted: str, keys: list[str] = ()) -> DataFrame:
    """R2 = 1 - SSE/SST, MSE and MAE in one pass."""
    err = F.col(actual) - F.col(predicted)
    return (
        df.filter(F.col(actual).isNotNull() & F.col(predicted).isNotNull())  # the same rows in every term
        .groupBy(*keys)
        .agg(
            F.count("*").alias("n_samples"),
            F.avg(err * err).alias("mse"),
            F.avg(F.abs(err)).alias("mae"),
            F.var_pop(actual).alias("_v"),
        )
        .select(*keys, "n_samples", (1 - ratio("mse", "_v")).alias("r2"), "mse", "mae")
    )


def fidelity(df: DataFrame, actual: str, predicted: str, split: str = "split") -> DataFrame:
    """R2 on train and test and the gap between them, one row."""
    per = regression_fit(df, actual, predicted, [split])
    pick = lambda name: F.max(F.when(F.col(split) == name, F.col("r2")))
    return per.agg(pick("train").alias("r2_train"), pick("test").alias("r2_test")).withColumn(
        "overfit_gap", F.col("r2_train") - F.col("r2_test")
    )


def confusion(df: DataFrame, keys: list[str] = (), target: str = "target", decision: str = "y_hat") -> DataFrame:
    y, p = F.col(target), F.col(decision)
    return df.groupBy(*keys).agg(
        F.count("*").alias("n_samples"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
    )


def with_rates(counts: DataFrame) -> DataFrame:
    """Accuracy, precision, recall, F1 (0 for an empty denominator) and the AUC of hard labels."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return (
        counts.withColumn("accuracy", ratio(tp + tn, tp + tn + fp + fn))
        .withColumn("precision", ratio0(tp, tp + fp))
        .withColumn("recall", ratio0(tp, tp + fn))
        .withColumn("f1", ratio0(2 * tp, 2 * tp + fp + fn))
        .withColumn("balanced_auc", (ratio(tp, tp + fn) + ratio(tn, tn + fp)) / 2)
        .withColumn("default_rate", ratio(tp + fn, tp + tn + fp + fn))
    )


def class_report(df: DataFrame, keys: list[str] = (), target: str = "target", decision: str = "y_hat") -> DataFrame:
    """Per class precision, recall, F1, support; then macro and weighted means (rows
    'macro avg', 'weighted avg') from the same four counts."""
    keys = list(keys)
    c = confusion(df, keys, target, decision)

    def line(name, hit, over, miss):
        hit, over, miss = F.col(hit), F.col(over), F.col(miss)
        return F.struct(
            F.lit(name).alias("label"),
            ratio0(hit, hit + over).alias("precision"),
            ratio0(hit, hit + miss).alias("recall"),
            ratio0(2 * hit, 2 * hit + over + miss).alias("f1"),
            (hit + miss).alias("support"),
        )

    both = c.select(*keys, line("0", "tn", "fn", "fp").alias("a"), line("1", "tp", "fp", "fn").alias("b"))
    n = F.col("a.support") + F.col("b.support")

    def mean(name, weight):
        part = lambda f: weight(F.col(f"a.{f}"), F.col(f"b.{f}")).alias(f)
        return F.struct(F.lit(name).alias("label"), part("precision"), part("recall"), part("f1"), n.alias("support"))

    macro = mean("macro avg", lambda x, y: (x + y) / 2)
    weighted = mean("weighted avg", lambda x, y: ratio0(x * F.col("a.support") + y * F.col("b.support"), n))
    return both.select(*keys, F.inline(F.array(F.col("a"), F.col("b"), macro, weighted)))


def weighted_f1(counts: DataFrame) -> DataFrame:
    """Support-weighted F1 from confusion counts; classes without support weigh nothing."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    f1_pos = ratio0(2 * tp, 2 * tp + fp + fn)
    f1_neg = ratio0(2 * tn, 2 * tn + fn + fp)
    value = ratio(f1_pos * (tp + fn) + f1_neg * (tn + fp), tp + tn + fp + fn)
    return counts.withColumn("weighted_f1", value)


def score_counts(df: DataFrame, keys: list[str] = (), score: str = "score", target: str = "target") -> DataFrame:
    """Positives and negatives per distinct score, in bins that follow the data.

    Sampled splitters cut the scores into as many ranges as there are shuffle partitions, so
    scores that crowd together are spread like any others. The counts are written with their
    bins: a splitter drawn anew could move a bin between two uses.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = (
        df.select(*keys, F.col(score).cast("double").alias("score"), F.col(target).alias("_y"))
        .groupBy(*keys, "score")
        .agg(F.count_if(F.col("_y") == 1).alias("pos"), F.count_if(F.col("_y") == 0).alias("neg"))
        .repartitionByRange(parts, "score")
    )
    return stored(counts.withColumn("_bin", F.spark_partition_id()), "scores")


def curve_counts(df: DataFrame, keys: list[str] = (), score: str = "score", target: str = "target") -> DataFrame:
    """Cumulated positives and negatives at or above every distinct score."""
    keys = list(keys)
    return running_totals(
        score_counts(df, keys, score, target), keys, "_bin", "score", ["pos", "neg"], descending=True
    ).drop("_bin")


def roc_auc(df: DataFrame, keys: list[str] = (), score: str = "score", target: str = "target") -> DataFrame:
    """Area under the ROC curve, ties counted half; NULL for a one-class group."""
    keys = list(keys)
    c = curve_counts(df, keys, score, target)
    above = F.col("cum_pos") - F.col("pos")
    wins = F.col("neg").cast("double") * (above + F.col("pos") / 2)
    return (
        c.groupBy(*keys)
        .agg(F.sum(wins).alias("_w"), F.max("tot_pos").alias("_p"), F.max("tot_neg").alias("_n"))
        .select(*keys, ratio(F.col("_w"), F.col("_p").cast("double") * F.col("_n")).alias("auc"))
    )


def roc_curve(df: DataFrame, keys: list[str] = (), score: str = "score", target: str = "target") -> DataFrame:
    """Rows (threshold, fpr, tpr), one per distinct score; groups with one class are left out."""
    keys = list(keys)
    c = curve_counts(df, keys, score, target).filter((F.col("tot_pos") > 0) & (F.col("tot_neg") > 0))
    return c.select(
        *keys,
        F.col("score").alias("threshold"),
        (F.col("cum_neg") / F.col("tot_neg")).alias("fpr"),
        (F.col("cum_pos") / F.col("tot_pos")).alias("tpr"),
    )


def precision_recall_curve(
    df: DataFrame, keys: list[str] = (), score: str = "score", target: str = "target"
) -> DataFrame:
    c = curve_counts(df, list(keys), score, target)
    return c.select(
        *keys,
        F.col("score").alias("threshold"),
        (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
        ratio("cum_pos", "tot_pos").alias("recall"),
    )


def best_f1_threshold(df: DataFrame, keys: list[str] = (), score: str = "score", target: str = "target") -> DataFrame:
    """Threshold with the highest F1 on the precision-recall curve; the lowest wins ties."""
    keys = list(keys)
    p, r = F.col("precision"), F.col("recall")
    curve = precision_recall_curve(df, keys, score, target)
    # F1 rounded to 12 digits so that equal values tie whatever the division order
    f1 = F.round(2 * (p * r) / (p + r + 1e-8), 12)
    best = curve.withColumn("f1", f1).groupBy(*keys).agg(
        F.max_by(F.struct("threshold", "f1", "precision", "recall"), F.struct(F.col("f1"), -F.col("threshold"))).alias("b")
    )
    return best.select(*keys, "b.*")


def threshold_sweep(
    df: DataFrame, thresholds: list[float] = SWEEP, keys: list[str] = (), score: str = "score", target: str = "target"
) -> DataFrame:
    """Metrics at each threshold. Rows are counted once by the number of thresholds they
    reach; the sweep itself works on those few counts."""
    keys = list(keys)
    reached = sum(((F.col(score) >= t).cast("int") for t in thresholds), F.lit(0))
    cells = (
        df.withColumn("_level", reached)
        .groupBy(*keys, "_level")
        .agg(F.count_if(F.col(target) == 1).alias("pos"), F.count_if(F.col(target) == 0).alias("neg"))
    )
    levels = F.array(*[F.struct(F.lit(i + 1).alias("_k"), F.lit(t).alias("threshold")) for i, t in enumerate(thresholds)])
    at = F.col("_level") >= F.col("_k")
    counts = (
        cells.select(*cells.columns, F.inline(levels))
        .groupBy(*keys, "threshold")
        .agg(
            F.sum(F.when(at, F.col("pos")).otherwise(0)).alias("tp"),
            F.sum(F.when(at, F.col("neg")).otherwise(0)).alias("fp"),
            F.sum(F.when(at, 0).otherwise(F.col("pos"))).alias("fn"),
            F.sum(F.when(at, 0).otherwise(F.col("neg"))).alias("tn"),
        )
    )
    return with_rates(counts).select(
        *keys, "threshold", F.col("f1").alias("f1_score"), "accuracy", "precision", "recall"
    )


def best_of_sweep(sweep: DataFrame, k: int = 5) -> DataFrame:
    return sweep.orderBy(F.round("f1_score", 12).desc(), "threshold").limit(k)


def group_quality(
    df: DataFrame, keys: list[str], least: int, score: str = "score", target: str = "target", decision: str = "y_hat"
) -> DataFrame:
    """n, accuracy, AUC, precision, recall, F1 and default rate per group with enough rows."""
    rates = with_rates(confusion(df, keys, target, decision)).filter(F.col("n_samples") >= least)
    auc = roc_auc(df, keys, score, target)
    return rates.join(auc, keys).select(
        *keys, "n_samples", "accuracy", "auc", "precision", "recall", "f1", "default_rate"
    )
