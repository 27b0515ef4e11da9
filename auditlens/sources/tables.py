"""Table sources and sinks."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header. Give the schema: inferring it costs a pass over the files."""
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def read_csv_indexed(
    spark: SparkSession, path: str, schema: T.StructType | None = None, id_col: str = "row_id"
) -> DataFrame:
    """CSV whose first, usually nameless, column is the row id. A schema must include it."""
    df = read_csv(spark, path, schema)
    first, *rest = df.columns
    return df.select(F.col(f"`{first}`").cast("long").alias(id_col), *[F.col(f"`{c}`") for c in rest])


def write_scored(df: DataFrame, path: str, fmt: str = "parquet", score: str = "score") -> None:
    """All features together with the black-box score under its exchange name."""
    out = df.withColumnRenamed(score, "y_pred_bb")
    writer = out.write.mode("overwrite")
    writer.option("header", True).csv(path) if fmt == "csv" else writer.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Small result table (metrics, importances): one CSV file with a header.

    One output file means one task, so the size is bounded by the kind of table: a row per
    metric or per feature.
    """
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def preview(df: DataFrame, id_col: str, n: int = 5) -> DataFrame:
    return df.orderBy(id_col).limit(n)
