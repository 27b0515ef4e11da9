"""Train / test splits that do not depend on partitioning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlens.functions.expr import hash_unit
from auditlens.operators.ordering import stratified_cut


def by_years(df: DataFrame, year: str, test_years: list[int], out: str = "split") -> DataFrame:
    return df.withColumn(out, F.when(F.col(year).isin(test_years), "test").otherwise("train"))


def by_hash(df: DataFrame, id_col: str, fraction: float = 0.8, seed: int = 42, out: str = "split") -> DataFrame:
    return df.withColumn(out, F.when(hash_unit(id_col, F.lit(seed)) < fraction, "train").otherwise("test"))


def stratified(df: DataFrame, label: str, id_col: str, fraction: float = 0.8, seed: int = 42) -> DataFrame:
    return stratified_cut(df, label, id_col, fraction, seed)
