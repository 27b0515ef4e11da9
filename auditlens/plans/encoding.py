"""Feature encoding queries, fitted on the training years and applied to all rows."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from auditlens.operators import encode, split
from auditlens.operators.encoder import TableEncoder
from auditlens.operators.topics import fit_topics
from auditlens.plans.frames import rounded
from auditlens.plans.registry import query
from auditlens.plans.sql import on_loans, r
from auditlens.session import fresh_path
from auditlens.sources.loans import ID, TEST_YEARS, complete_loans, loans, table
from auditlens.sources.tables import save_model

TRAIN_SQL = "tr AS (SELECT * FROM loans WHERE issue_d NOT IN (1999,2000,2001))"
CATEGORIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def train_of(df):
    return split.by_years(df, "issue_d", TEST_YEARS).filter("split = 'train'")


@query(
    "encode_median_imputation",
    on_loans(
        f"WITH {TRAIN_SQL}, m AS (SELECT quantile_cont(dti, 0.5) AS a, quantile_cont(int_rate, 0.5) AS b FROM tr) "
        f"SELECT loan_id, {r('coalesce(dti, (SELECT a FROM m))', 9)} AS dti, {r('coalesce(int_rate, (SELECT b FROM m))', 9)} AS int_rate FROM loans"
    ),
)
def encode_median_imputation(spark, sf_dir):
    df = loans(spark, sf_dir)
    return rounded(encode.impute_median(df.select(ID, "dti", "int_rate"), ["dti", "int_rate"], train_of(df)), 9)


GAPS_SQL = (
    "gp AS (SELECT loan_id, issue_d, CASE WHEN loan_id % 6 = 0 THEN NULL ELSE grade END AS grade, "
    "CASE WHEN loan_id % 9 = 0 THEN NULL ELSE home_ownership END AS home_ownership FROM loans), "
    "gt AS (SELECT * FROM gp WHERE issue_d NOT IN (1999,2000,2001))"
)


def with_gaps(spark, sf_dir):
    """Categories with missing values planted by key."""
    k = F.col(ID)
    return loans(spark, sf_dir).select(
        ID,
        "issue_d",
        F.when(k % 6 != 0, F.col("grade")).alias("grade"),
        F.when(k % 9 != 0, F.col("home_ownership")).alias("home_ownership"),
    )


@query(
    "encode_most_frequent_imputation",
    on_loans(
        f"WITH {GAPS_SQL} SELECT loan_id, issue_d, coalesce(grade, (SELECT grade FROM gt WHERE grade IS NOT NULL GROUP BY grade ORDER BY count(*) DESC, grade LIMIT 1)) AS grade, "
        "coalesce(home_ownership, (SELECT home_ownership FROM gt WHERE home_ownership IS NOT NULL GROUP BY home_ownership ORDER BY count(*) DESC, home_ownership LIMIT 1)) AS home_ownership FROM gp"
    ),
)
def encode_most_frequent_imputation(spark, sf_dir):
    df = with_gaps(spark, sf_dir)
    return encode.impute_most_frequent(df, ["grade", "home_ownership"], train_of(df))


@query(
    "encode_standardise",
    on_loans(
        f"WITH {TRAIN_SQL}, s AS (SELECT avg(dti) AS a, stddev_pop(dti) AS b, avg(funded_amnt) AS c, stddev_pop(funded_amnt) AS d FROM tr) "
        f"SELECT loan_id, {r('(dti-a)/b')} AS dti, {r('(funded_amnt-c)/d')} AS funded_amnt FROM loans, s"
    ),
)
def encode_standardise(spark, sf_dir):
    df = loans(spark, sf_dir)
    cols = ["dti", "funded_amnt"]
    return rounded(encode.standardise(df.select(ID, *cols), cols, train_of(df)))


ONE_HOT_SQL = ", ".join(f"CASE WHEN grade = '{v}' THEN 1 ELSE 0 END AS \"grade_{v}\"" for v in CATEGORIES)


@query("encode_one_hot", on_loans(f"WITH {GAPS_SQL} SELECT loan_id, {ONE_HOT_SQL} FROM gp"))
def encode_one_hot(spark, sf_dir):
    df = with_gaps(spark, sf_dir)
    return encode.one_hot(df, encode.fit_categories(train_of(df), ["grade"]), [ID])


@query(
    "encode_aligned_columns",
    on_loans(
        "SELECT loan_id, CASE WHEN grade='5-LOW' THEN 1 ELSE 0 END AS \"grade_5-LOW\", 0 AS \"grade_6-NEVER\", "
        "CASE WHEN grade='1-URGENT' THEN 1 ELSE 0 END AS \"grade_1-URGENT\" FROM ok"
    ),
)
def encode_aligned_columns(spark, sf_dir):
    df = complete_loans(spark, sf_dir)
    hot = encode.one_hot(df, encode.fit_categories(df, ["grade"]), [ID])
    return encode.align(hot, ["grade_5-LOW", "grade_6-NEVER", "grade_1-URGENT"], [ID])


def _spline_sql(j: int) -> str:
    d = f"abs(t-({j - 1}.0::DOUBLE))"
    return (
        f"CASE WHEN {d} < 1 THEN (4.0::DOUBLE-6.0::DOUBLE*{d}*{d}+3.0::DOUBLE*{d}*{d}*{d})/6 "
        f"WHEN {d} < 2 THEN (2.0::DOUBLE-{d})*(2.0::DOUBLE-{d})*(2.0::DOUBLE-{d})/6 ELSE 0.0::DOUBLE END"
    )


@query(
    "encode_spline_basis",
    on_loans(
        "WITH m AS (SELECT min(dti) AS lo, max(dti) AS hi FROM ok), kn AS (SELECT loan_id, (dti-lo)/((hi-lo)/5.0::DOUBLE) AS t FROM ok, m) "
        f"SELECT loan_id, {', '.join(f'{r(_spline_sql(j), 9)} AS dti_s{j}' for j in range(8))} FROM kn"
    ),
)
def encode_spline_basis(spark, sf_dir):
    df = complete_loans(spark, sf_dir)
    limits = encode.fit_limits(df, ["dti"])
    return rounded(encode.spline_columns(df.select(ID, "dti"), ["dti"], limits).drop("dti"), 9)


def _slots_sql(c: str) -> str:
    values = f"(SELECT list(v ORDER BY v) FROM (SELECT DISTINCT {c} AS v FROM tr WHERE {c} IS NOT NULL))"
    return f"list_transform({values}, lambda x: CASE WHEN x = {c} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)"


@query(
    "encode_column_transformer",
    on_loans(
        f"WITH {TRAIN_SQL} SELECT loan_id, list_concat(list_concat([dti::DOUBLE, int_rate::DOUBLE], "
        f"{_slots_sql('grade')}), {_slots_sql('home_ownership')}) AS features FROM ok"
    ),
)
def encode_column_transformer(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array

    df = complete_loans(spark, sf_dir)
    fitted = Pipeline(stages=encode.vector_stages(["dti", "int_rate"], ["grade", "home_ownership"])).fit(train_of(df))
    return fitted.transform(df).select(ID, vector_to_array("features").alias("features"))


PART_TEXT = ["p_type", "p_brand", "p_name"]


def part_encoder(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part, TableEncoder(numeric=["p_size", "p_retailprice"], text=PART_TEXT).fit(part)


@query("encode_automatic")
def encode_automatic(spark, sf_dir):
    part, model = part_encoder(spark, sf_dir)
    return model.transform(part).select("p_partkey", *[F.col(f"`{c}`") for c in model.columns()])


@query(
    "encode_automatic_columns",
    "SELECT p_partkey, p_size, round(p_retailprice, 6) + CAST(0 AS DOUBLE) AS p_retailprice, "
    "list_sort(['p_brand_' || p_brand, 'p_type_' || p_type]) AS hot FROM part",
)
def encode_automatic_columns(spark, sf_dir):
    """The numbers and the 0/1 columns that are set, of the automatic encoding."""
    part, model = part_encoder(spark, sf_dir)
    hot = [c for c in model.columns() if c.startswith(("p_type_", "p_brand_"))]
    named = F.array(*[F.when(F.col(f"`{c}`") == 1, F.lit(c)) for c in hot])
    return rounded(model.transform(part).select("p_partkey", "p_size", "p_retailprice", F.array_sort(F.array_compact(named)).alias("hot")))


@query(
    "encode_store_round_trip",
    on_loans("SELECT count(*) AS n, CAST(0 AS DOUBLE) AS max_difference, true AS same_columns, true AS fits FROM ok WHERE issue_d IN (1999,2000,2001)"),
)
def encode_store_round_trip(spark, sf_dir):
    """Encoder and regression fitted on the training years as one pipeline, saved, loaded and applied
    to the test years: largest difference of the predictions, and whether they explain the score."""
    df = complete_loans(spark, sf_dir)
    encoder = TableEncoder(numeric=["int_rate", "dti", "pct_protected", "annual_inc"], text=["grade", "home_ownership", "purpose"], limit=10, topics=8)
    model = Pipeline(stages=[encoder, LinearRegression(featuresCol="encoded", labelCol="score")]).fit(train_of(df))
    again = PipelineModel.load(save_model(model, fresh_path(spark, "encoder")))
    test = split.by_years(df, "issue_d", TEST_YEARS).filter("split = 'test'")
    a = model.transform(test).select(ID, "score", F.col("prediction").alias("a"))
    b = again.transform(test).select(ID, F.col("prediction").alias("b"))
    gap = F.max(F.abs(F.col("a") - F.col("b"))).alias("max_difference")
    same = F.lit(model.stages[0].columns() == again.stages[0].columns()).alias("same_columns")
    return a.join(b, ID).agg(F.count("*").alias("n"), gap, same, (F.corr("a", "score") > 0.5).alias("fits"))


@query("encode_topic_features")
def encode_topic_features(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return fit_topics(part, "p_name").encode(part, "p_name")


@query(
    "encode_topic_checks",
    "SELECT count(*) AS n_rows, count(DISTINCT p_name) AS n_texts, count(DISTINCT p_name) AS n_encodings, "
    "CAST(0 AS BIGINT) AS n_negative, true AS falls FROM part",
)
def encode_topic_checks(spark, sf_dir):
    """Equal texts get equal weights and different ones different weights, none is negative, and the
    objective falls in every round."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    model = fit_topics(part, "p_name")
    weights = [F.col(f"p_name_topic_{i}") for i in range(len(model.matrix))]
    falls = all(b < a for a, b in zip(model.objective, model.objective[1:]))
    coded = model.encode(part, "p_name").select("p_name", F.array(*weights).alias("w"))
    low = F.count_if(F.exists("w", lambda x: x < 0))
    return coded.agg(F.count("*").alias("n_rows"), F.countDistinct("p_name").alias("n_texts"), F.countDistinct("w").alias("n_encodings"), low.alias("n_negative"), F.lit(falls).alias("falls"))
