"""Frames shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlens.functions.expr import decide, tidy
from auditlens.operators.clean import floating_columns
from auditlens.operators.fairness import QUARTILE_LABELS
from auditlens.operators.ordering import with_quartiles
from auditlens.session import stored_once
from auditlens.sources.loans import complete_loans


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complete loans with the decision at 0.5."""
    return complete_loans(spark, sf_dir).withColumn("y_hat", decide("score", 0.5))


def audited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored loans with the protected quartile group, fitted and written once."""
    make = lambda: with_quartiles(scored(spark, sf_dir), "pct_protected", QUARTILE_LABELS, "group")
    return stored_once(spark, sf_dir, "audited", make)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """All floating columns rounded for comparison."""
    return df.withColumns({c: tidy(F.col(c), digits) for c in floating_columns(df)})
