"""Stability of a model over years and subgroups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditlens.operators.metrics import group_quality
from auditlens.operators.ordering import QUARTILES, fit_quantiles, with_quartiles

# Quartile labels and limits of the verdict.
INCOME_LABELS = ["Q1", "Q2", "Q3", "Q4"]
AMOUNT_LABELS = ["Low", "Medium", "High", "Very High"]
GOOD, MODERATE = 0.05, 0.1
YEAR_ROWS, SUBGROUP_ROWS = 10, 50


def with_year(df: DataFrame, col: str, out: str = "year") -> DataFrame:
    """Year from a number or a date / timestamp column."""
    kind = df.schema[col].dataType
    dated = isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType))
    return df.withColumn(out, F.year(col) if dated else F.col(col).cast("int"))


def quality_by_year(df: DataFrame, date_col: str, least: int = YEAR_ROWS) -> DataFrame:
    return group_quality(with_year(df, date_col).filter(F.col("year").isNotNull()), ["year"], least)


def subgroup_rows(df: DataFrame, cols: dict[str, str]) -> DataFrame:
    """Unpivot columns to (subgroup, value) next to score, label and decision; missing values
    are left out. ``cols`` maps column to subgroup name. Explode factor len(cols), and only
    four narrow columns go into the partial aggregates."""
    pairs = F.array(
        *[F.struct(F.lit(name).alias("subgroup"), F.col(c).cast("string").alias("value")) for c, name in cols.items()]
    )
    return df.select("score", "target", "y_hat", F.inline(pairs)).filter(F.col("value").isNotNull())


def quality_by_subgroup(df: DataFrame, cols: dict[str, str], least: int = SUBGROUP_ROWS) -> DataFrame:
    return group_quality(subgroup_rows(df, cols), ["subgroup", "value"], least)


def most_frequent(df: DataFrame, col: str, k: int = 5) -> DataFrame:
    """The ``k`` most frequent values; the value breaks ties."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n"))
    return counts.orderBy(F.col("n").desc(), col).limit(k)


def quality_of_frequent(df: DataFrame, col: str, k: int = 5, least: int = SUBGROUP_ROWS) -> DataFrame:
    # ``most_frequent`` has at most k rows
    kept = df.join(F.broadcast(most_frequent(df, col, k).select(col)), col, "left_semi")
    return quality_by_subgroup(kept, {col: col}, least)


def quality_by_quartile(df: DataFrame, cols: dict[str, tuple[str, list[str]]], least: int = SUBGROUP_ROWS) -> DataFrame:
    """``cols`` maps column to (subgroup name, four labels). One fit gives the edges of all columns."""
    edges, marked = fit_quantiles(df, list(cols), QUARTILES), df
    for c, (name, labels) in cols.items():
        marked = with_quartiles(marked, c, labels, f"_{name}", edges=edges[c])
    return quality_by_subgroup(marked, {f"_{name}": name for name, _ in cols.values()}, least)


MEASURES = ["auc", "precision", "f1"]


def variation(quality: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Mean, std (n-1) and range of AUC, precision and F1 over periods or within a family."""
    aggs = []
    for m in MEASURES:
        aggs += [
            F.avg(m).alias(f"{m}_mean"),
            F.stddev_samp(m).alias(f"{m}_std"),
            (F.max(m) - F.min(m)).alias(f"{m}_range"),
        ]
    return quality.groupBy(*keys).agg(F.count("*").alias("n_groups"), *aggs)


def outliers(quality: DataFrame, keys: list[str], sigmas: float = 2.0) -> DataFrame:
    """Rows whose AUC lies more than ``sigmas`` standard deviations from the mean of its family.
    ``quality`` has one row per group."""
    w = Window.partitionBy(*keys)
    return (
        quality.withColumn("auc_mean", F.avg("auc").over(w))
        .withColumn("auc_std", F.stddev_samp("auc").over(w))
        .filter(F.abs(F.col("auc") - F.col("auc_mean")) > sigmas * F.col("auc_std"))
    )


def verdict(varied: DataFrame) -> DataFrame:
    """GOOD / MODERATE / POOR from the AUC standard deviation."""
    s = F.col("auc_std")
    return varied.withColumn("verdict", F.when(s < GOOD, "GOOD").when(s < MODERATE, "MODERATE").otherwise("POOR"))
