"""Cleaning and projection."""

from __future__ import annotations

import itertools
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlens.functions import expr as X
from auditlens.operators.ordering import global_positions, with_lookup
from auditlens.session import stored

# Columns that are never features.
NOT_FEATURES = ["Unnamed: 0", "Predictions", "Predicted probabilities", "target"]


def drop_columns(df: DataFrame, names: list[str] = NOT_FEATURES) -> DataFrame:
    return df.drop(*names)


def floating_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if X.is_floating(f.dataType)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if X.is_numeric(f.dataType)]


def infinite_to_null(df: DataFrame) -> DataFrame:
    """NaN and +-inf of every floating column become NULL, the one form of 'missing'."""
    return df.withColumns({c: X.finite_or_null(c) for c in floating_columns(df)})


def non_finite_to_zero(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    return df.withColumns({c: X.finite_or_zero(c) for c in (cols or floating_columns(df))})


def drop_missing(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop rows with a missing value in any column, or in ``subset`` only."""
    return infinite_to_null(df).na.drop("any", subset=subset)


def non_finite_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Rows (feature, n_nan, n_inf, n_null) in one pass."""
    cols = cols or floating_columns(df)
    aggs = []
    for i, c in enumerate(cols):
        aggs += [
            F.count_if(F.isnan(c)).alias(f"a{i}"),
            F.count_if(X.is_infinite(c)).alias(f"b{i}"),
            F.count_if(F.col(c).isNull()).alias(f"c{i}"),
        ]
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                F.col(f"a{i}").alias("n_nan"),
                F.col(f"b{i}").alias("n_inf"),
                F.col(f"c{i}").alias("n_null"),
            )
            for i, c in enumerate(cols)
        ]
    )
    return df.agg(*aggs).select(F.inline(rows))


def fill_constant(df: DataFrame, value: float, cols: list[str]) -> DataFrame:
    return df.na.fill(value, subset=cols)


def with_outcome(df: DataFrame, score: str, target: str, threshold: float, keep: list[str] = ()) -> DataFrame:
    """Typed (score, target, y_hat); fails early when a column is missing."""
    absent = [c for c in (score, target) if c not in df.columns]
    if absent:
        raise ValueError(f"missing columns: {absent}")
    s = F.col(score).cast("double")
    return df.select(
        *keep, s.alias("score"), F.col(target).cast("int").alias("target"), X.decide(s, threshold).alias("y_hat")
    )


def unique_clean_names(df: DataFrame, name: str, position: str, out: str = "clean_name") -> DataFrame:
    """Sanitised texts; repeats get the suffix ``_1``, ``_2``, ... in order of ``position``, and a
    suffixed name that another row has already is suffixed again, until all names differ. The
    first row of a name keeps it; a missing text is named by its position.

    An occurrence's number is its position among all rows ordered by name less that of the name's
    first row, so neither one name nor the way positions are spread decides the size of a task.
    """
    clean = F.coalesce(X.clean_name(F.col(name), F.col(position)), F.concat(F.lit("feature_"), F.col(position).cast("string")))
    names = df.withColumn(out, clean)
    while True:
        placed = stored(global_positions(names, [out, position], "_at"), "names")
        repeated = placed.groupBy(out).agg(F.min("_at").alias("_first"), F.count("*").alias("_n")).filter("_n > 1")
        if repeated.isEmpty():
            return placed.drop("_at")
        nth = F.col("_at") - F.col("_first")
        again = F.when(nth > 0, F.concat_ws("_", F.col(out), nth.cast("string"))).otherwise(F.col(out))
        names = with_lookup(placed, repeated, [out], "left").withColumn(out, again).drop("_at", "_first", "_n")


def with_clean_columns(df: DataFrame) -> DataFrame:
    """Rename the columns of a frame to unique identifier-safe names (schema work only)."""
    used: set[str] = set()
    renamed = []
    for i, old in enumerate(df.columns):
        text = re.sub(X.UNDERSCORES, "_", re.sub(X.NON_WORD, "_", re.sub(X.BRACKETS, "_", old))).strip("_")
        stem = text if text and not re.match(X.ONLY_DIGITS, text) else f"feature_{i}"
        choices = itertools.chain([stem], (f"{stem}_{k}" for k in itertools.count(1)))
        new = next(n for n in choices if n not in used)
        used.add(new)
        renamed.append(new)
    return df.toDF(*renamed)


def normalised_text(c: str) -> Column:
    return F.trim(F.col(c).cast("string"))


def keep_repeated_classes(df: DataFrame, label: str, least: int = 2) -> DataFrame:
    """Rows whose class occurs at least ``least`` times."""
    counts = df.groupBy(label).agg(F.count("*").alias("_n")).filter(F.col("_n") >= least)
    return with_lookup(df, counts, [label], "left_semi")


def supported_groups(df: DataFrame, keys: list[str], least: int) -> DataFrame:
    """Group sizes with at least ``least`` rows."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("n_samples"))
    return counts.filter(F.col("n_samples") >= least)


def row_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns per named processing stage."""
    parts = [
        d.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("stage"), "n_rows", F.lit(len(d.columns)).cast("long").alias("n_columns")
        )
        for name, d in stages.items()
    ]
    return reduce(DataFrame.unionByName, parts)
