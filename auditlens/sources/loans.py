"""The loan table derived from the order, line, customer and nation tables.

One row per order. Line averages use integer sums, so they do not depend on the order of
summation; the label is drawn from an md5 of the key. Orders without lines keep NULL
features.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlens.functions.expr import hash_long, sigmoid
from auditlens.operators.scorers import AdditiveScorer, ExprScorer
from auditlens.session import fresh_path

ID = "loan_id"
NUMERIC = ["issue_d", "funded_amnt", "int_rate", "dti", "open_acc", "annual_inc", "pct_protected"]
STRINGS = ["grade", "home_ownership", "purpose"]
FEATURES = NUMERIC + STRINGS
TEST_YEARS = [1999, 2000, 2001]


def main_terms(c: dict) -> dict:
    """Additive part of the margin, one term per feature."""
    return {
        "int_rate": 0.45 * (c["int_rate"] - 5.0),
        "dti": 0.06 * (c["dti"] - 25.0),
        "pct_protected": 0.25 * (c["pct_protected"] - 4.0),
        "annual_inc": -0.00008 * (c["annual_inc"] - 4500.0),
        "grade": F.when(c["grade"] == "1-URGENT", -0.6).when(c["grade"] == "5-LOW", 0.8).otherwise(0.0),
    }


INTERCEPT = -1.6
SCORER_INPUTS = ["int_rate", "dti", "pct_protected", "annual_inc", "grade"]
SCORER_NUMERIC = ["int_rate", "dti", "pct_protected", "annual_inc"]


def _margin(c: dict):
    total = F.lit(INTERCEPT)
    for term in main_terms(c).values():
        total = total + term
    return total + 0.03 * (c["int_rate"] - 5.0) * (c["dti"] - 25.0)


SCORER = ExprScorer(SCORER_INPUTS, lambda c: sigmoid(_margin(c)))
MARGIN_SCORER = ExprScorer(SCORER_INPUTS, _margin)
ADDITIVE = AdditiveScorer(SCORER_INPUTS, main_terms, INTERCEPT)


LOAN_SCHEMA = (
    f"{ID} long, issue_d int, funded_amnt double, int_rate double, dti double, open_acc long, annual_inc double, "
    "pct_protected double, grade string, home_ownership string, purpose string, margin double, score double, target int"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derive_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents = lambda c: F.round(F.col(c) * 100).cast("long")
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.sum(cents("l_discount")).alias("sd"),
            F.sum(cents("l_tax")).alias("st"),
            F.sum(F.col("l_quantity").cast("long")).alias("sq"),
            F.count("*").alias("n_lines"),
        )
    )
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer")
    nations = table(spark, sf_dir, "nation")
    base = (
        orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left")
        .join(customers, orders.o_custkey == customers.c_custkey)
        .join(nations, customers.c_nationkey == nations.n_nationkey)
        .select(
            F.col("o_orderkey").alias(ID),
            F.year("o_orderdate").alias("issue_d"),
            F.col("o_totalprice").alias("funded_amnt"),
            (F.col("sd") / F.col("n_lines")).alias("int_rate"),
            (F.col("sq") / F.col("n_lines")).alias("dti"),
            F.col("n_lines").alias("open_acc"),
            F.col("c_acctbal").alias("annual_inc"),
            (F.col("st") / F.col("n_lines")).alias("pct_protected"),
            F.col("o_orderpriority").alias("grade"),
            F.col("c_mktsegment").alias("home_ownership"),
            F.col("n_name").alias("purpose"),
        )
    )
    draw = hash_long(ID, digits=8).cast("double") / 4294967296.0
    return (
        base.withColumn("margin", _margin({c: F.col(c) for c in SCORER_INPUTS}))
        .withColumn("score", F.round(sigmoid(F.col("margin")), 10))
        .withColumn("target", F.when(draw < sigmoid(F.col("margin")), 1).otherwise(0))
    )


_written: dict[tuple[str, str], str] = {}


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loan table, written once per session and source to the shared folder.

    An audit starts from one flat table that many plans scan: written columns can be pruned
    and filters pushed down, the four-way join runs once, and its result outlives executors.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _written:
        path = fresh_path(spark, "loans")
        # explanations repeat rows: the table is dealt evenly, at least one file per core
        parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
        derive_loans(spark, sf_dir).repartition(parts).write.parquet(path)
        _written[key] = path
    return spark.read.schema(LOAN_SCHEMA).parquet(_written[key])


def complete_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loans without a missing value in any column."""
    return loans(spark, sf_dir).na.drop("any")
