"""Sources, sinks, cleaning and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from auditlens.functions import expr as X
from auditlens.operators import clean, split
from auditlens.operators.ordering import fit_quantiles, hash_sample
from auditlens.operators.scorers import heuristic_score
from auditlens.plans.frames import audited, rounded, scored
from auditlens.plans.registry import query
from auditlens.plans.sql import on_loans, r, unit
from auditlens.session import fresh_path
from auditlens.sources import tables
from auditlens.sources.loans import ID, TEST_YEARS, complete_loans, loans, table

NAN, INF = float("nan"), float("inf")

# Missing and infinite values planted by key, so that every cleaning rule has work.
DIRTY_SQL = """dirty AS (SELECT loan_id, target,
  CASE WHEN loan_id % 7 = 0 THEN 'nan'::DOUBLE WHEN loan_id % 11 = 0 THEN 'infinity'::DOUBLE
       WHEN loan_id % 13 = 0 THEN '-infinity'::DOUBLE ELSE dti END AS dti,
  CASE WHEN loan_id % 5 = 0 THEN 'nan'::DOUBLE ELSE int_rate END AS int_rate,
  annual_inc, grade FROM loans)"""


def dirty(spark, sf_dir):
    k = F.col(ID)
    dti = (
        F.when(k % 7 == 0, NAN).when(k % 11 == 0, INF).when(k % 13 == 0, -INF).otherwise(F.col("dti"))
    )
    rate = F.when(k % 5 == 0, NAN).otherwise(F.col("int_rate"))
    return loans(spark, sf_dir).select(
        ID, "target", dti.alias("dti"), rate.alias("int_rate"), "annual_inc", "grade"
    )


def on_dirty(body: str) -> str:
    return on_loans(f"WITH {DIRTY_SQL} {body}")


@query(
    "source_csv_scan",
    on_loans(
        f"SELECT loan_id, issue_d, {r('funded_amnt')} AS funded_amnt, {r('int_rate')} AS int_rate, grade, purpose, "
        f"{r('score')} AS score, target FROM ok"
    ),
)
def source_csv_scan(spark, sf_dir):
    df = complete_loans(spark, sf_dir).select(
        ID, "issue_d", "funded_amnt", "int_rate", "grade", "purpose", "score", "target"
    )
    path = fresh_path(spark, "csv")
    df.write.option("header", True).csv(path)
    return rounded(tables.read_csv(spark, path, df.schema))


@query("source_csv_row_id", on_loans("SELECT loan_id AS row_id, grade, score, target FROM ok"))
def source_csv_row_id(spark, sf_dir):
    df = complete_loans(spark, sf_dir).select(F.col(ID).alias("_c0"), "grade", "score", "target")
    path = fresh_path(spark, "csv")
    df.write.option("header", True).csv(path)
    return tables.read_csv_indexed(spark, path, df.schema)


@query(
    "sink_scored_table",
    on_loans(f"SELECT loan_id, grade, {r('dti')} AS dti, {r('score')} AS y_pred_bb FROM ok"),
)
def sink_scored_table(spark, sf_dir):
    path = fresh_path(spark, "scored")
    tables.write_scored(complete_loans(spark, sf_dir).select(ID, "grade", "dti", "score"), path)
    return rounded(spark.read.parquet(path))


@query("source_preview", on_loans(f"SELECT loan_id, issue_d, grade, {r('dti')} AS dti, {r('score')} AS score, target FROM ok ORDER BY loan_id LIMIT 5"))
def source_preview(spark, sf_dir):
    df = complete_loans(spark, sf_dir).select(ID, "issue_d", "grade", "dti", "score", "target")
    return rounded(tables.preview(df, ID, 5))


@query(
    "clean_feature_projection",
    on_loans(
        f"SELECT loan_id, issue_d, {r('funded_amnt')} AS funded_amnt, {r('int_rate')} AS int_rate, {r('dti')} AS dti, "
        f"open_acc, {r('annual_inc')} AS annual_inc, {r('pct_protected')} AS pct_protected, grade, home_ownership, purpose FROM ok"
    ),
)
def clean_feature_projection(spark, sf_dir):
    return rounded(clean.drop_columns(complete_loans(spark, sf_dir), ["target", "score", "margin", "Predictions"]))


FINITE_DTI = "dti IS NOT NULL AND NOT isnan(dti) AND NOT isinf(dti)"
FINITE_RATE = "int_rate IS NOT NULL AND NOT isnan(int_rate) AND NOT isinf(int_rate)"


@query(
    "clean_drop_missing",
    on_dirty(
        f"SELECT loan_id, {r('dti')} AS dti, {r('int_rate')} AS int_rate, grade, target FROM dirty "
        f"WHERE {FINITE_DTI} AND {FINITE_RATE}"
    ),
)
def clean_drop_missing(spark, sf_dir):
    return rounded(clean.drop_missing(dirty(spark, sf_dir)).drop("annual_inc"))


@query(
    "clean_drop_missing_feature",
    on_dirty(f"SELECT loan_id, {r('dti')} AS dti, grade, target FROM dirty WHERE {FINITE_DTI}"),
)
def clean_drop_missing_feature(spark, sf_dir):
    return rounded(clean.drop_missing(dirty(spark, sf_dir), ["dti"]).drop("int_rate", "annual_inc"))


@query(
    "clean_infinite_to_null",
    on_dirty(
        f"SELECT loan_id, CASE WHEN {FINITE_DTI} THEN {r('dti')} END AS dti, "
        f"CASE WHEN {FINITE_RATE} THEN {r('int_rate')} END AS int_rate FROM dirty"
    ),
)
def clean_infinite_to_null(spark, sf_dir):
    return rounded(clean.infinite_to_null(dirty(spark, sf_dir).select(ID, "dti", "int_rate")))


@query(
    "clean_non_finite_to_zero",
    on_dirty(
        f"SELECT loan_id, CASE WHEN {FINITE_DTI} THEN {r('dti')} ELSE 0.0::DOUBLE END AS dti, "
        f"CASE WHEN {FINITE_RATE} THEN {r('int_rate')} ELSE 0.0::DOUBLE END AS int_rate FROM dirty"
    ),
)
def clean_non_finite_to_zero(spark, sf_dir):
    return rounded(clean.non_finite_to_zero(dirty(spark, sf_dir).select(ID, "dti", "int_rate")))


@query(
    "clean_non_finite_counts",
    on_dirty(
        " UNION ALL ".join(
            f"SELECT '{c}' AS feature, count(*) FILTER (WHERE isnan({c})) AS n_nan, "
            f"count(*) FILTER (WHERE isinf({c})) AS n_inf, count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM dirty"
            for c in ("dti", "int_rate", "annual_inc")
        )
    ),
)
def clean_non_finite_counts(spark, sf_dir):
    return clean.non_finite_counts(dirty(spark, sf_dir))


@query(
    "clean_fill_constant",
    on_loans(f"SELECT loan_id, coalesce({r('dti')}, 0.0::DOUBLE) AS dti, coalesce({r('int_rate')}, 0.0::DOUBLE) AS int_rate FROM loans"),
)
def clean_fill_constant(spark, sf_dir):
    df = loans(spark, sf_dir).select(ID, "dti", "int_rate")
    return rounded(clean.fill_constant(df, 0.0, ["dti", "int_rate"]))


@query(
    "clean_fill_median",
    on_loans(f"SELECT loan_id, {r('coalesce(dti, (SELECT quantile_cont(dti, 0.5) FROM loans))')} AS dti FROM loans"),
)
def clean_fill_median(spark, sf_dir):
    df = loans(spark, sf_dir)
    middle = fit_quantiles(df, ["dti"], [0.5])["dti"][0]
    return rounded(df.select(ID, F.coalesce(F.col("dti"), F.lit(middle)).alias("dti")))


@query("clean_binary_label", on_loans("SELECT loan_id, CASE WHEN target >= 0.5 THEN 1 ELSE 0 END AS label FROM ok"))
def clean_binary_label(spark, sf_dir):
    return complete_loans(spark, sf_dir).select(ID, X.decide("target", 0.5).alias("label"))


@query("clean_decision", on_loans("SELECT loan_id, CASE WHEN score >= 0.3 THEN 1 ELSE 0 END AS y_hat FROM ok"))
def clean_decision(spark, sf_dir):
    return complete_loans(spark, sf_dir).select(ID, X.decide("score", 0.3).alias("y_hat"))


@query("clean_outcome_projection", on_loans("SELECT loan_id, score, target, y_hat FROM sc"))
def clean_outcome_projection(spark, sf_dir):
    return clean.with_outcome(complete_loans(spark, sf_dir), "score", "target", 0.5, keep=[ID])


SANITISE = (
    "trim(regexp_replace(regexp_replace(regexp_replace({0}, '[<>\\[\\](){{}}]', '_', 'g'), '[^a-zA-Z0-9_]', '_', 'g'),"
    " '_+', '_', 'g'), '_')"
)


def sanitise_sql(text: str, position: str) -> str:
    s = SANITISE.format(text)
    return f"CASE WHEN {s} = '' OR regexp_full_match({s}, '[0-9]+') THEN 'feature_'||{position} ELSE {s} END"


@query("clean_text_names", f"SELECT doc_id, {sanitise_sql('text', 'doc_id')} AS clean_name FROM documents")
def clean_text_names(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", X.clean_name(F.col("text"), F.col("doc_id")).alias("clean_name"))


@query(
    "clean_unique_names",
    f"WITH b AS (SELECT p_partkey, {sanitise_sql('p_name', 'p_partkey')} AS base FROM part), "
    "n AS (SELECT *, row_number() OVER (PARTITION BY base ORDER BY p_partkey) - 1 AS k FROM b) "
    "SELECT p_partkey, CASE WHEN k = 0 THEN base ELSE base||'_'||k END AS clean_name FROM n",
)
def clean_unique_names(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return clean.unique_clean_names(part, "p_name", "p_partkey").select("p_partkey", "clean_name")


@query(
    "clean_normalised_groups",
    on_loans("SELECT loan_id, trim(CAST(issue_d AS VARCHAR)) AS year_text, trim(' '||grade||'  ') AS grade_text FROM ok"),
)
def clean_normalised_groups(spark, sf_dir):
    padded = complete_loans(spark, sf_dir).withColumn("padded", F.concat(F.lit(" "), F.col("grade"), F.lit("  ")))
    return padded.select(
        ID, clean.normalised_text("issue_d").alias("year_text"), clean.normalised_text("padded").alias("grade_text")
    )


@query(
    "clean_clip",
    on_loans(f"SELECT loan_id, {r('least(greatest(int_rate/10, 0.0::DOUBLE), 1.0::DOUBLE)')} AS clipped FROM ok"),
)
def clean_clip(spark, sf_dir):
    return rounded(complete_loans(spark, sf_dir).select(ID, X.clip(F.col("int_rate") / 10, 0.0, 1.0).alias("clipped")))


@query(
    "score_heuristic",
    on_loans(
        "WITH m AS (SELECT quantile_cont(annual_inc, 0.5) AS q FROM loans) SELECT loan_id, "
        + r(
            "least(greatest(coalesce(dti,0)/50*0.1::DOUBLE + coalesce(open_acc,0)*0.2::DOUBLE"
            " - coalesce(annual_inc,(SELECT q FROM m))/100000*0.1::DOUBLE, 0.0::DOUBLE), 1.0::DOUBLE)",
            9,
        )
        + " AS score FROM loans"
    ),
)
def score_heuristic(spark, sf_dir):
    df = loans(spark, sf_dir)
    middle = fit_quantiles(df, ["annual_inc"], [0.5])["annual_inc"][0]
    filled = df.select(
        ID,
        (F.coalesce(F.col("dti"), F.lit(0.0)) / 50).alias("dti"),
        F.coalesce(F.col("open_acc"), F.lit(0)).alias("delinq_2yrs"),
        F.coalesce(F.col("annual_inc"), F.lit(middle)).alias("annual_inc"),
    )
    return rounded(filled.select(ID, heuristic_score().alias("score")), 9)


@query(
    "clean_repeated_classes",
    on_loans(
        "SELECT loan_id, open_acc FROM ok WHERE open_acc IN (SELECT open_acc FROM ok GROUP BY open_acc HAVING count(*) > 1)"
    ),
)
def clean_repeated_classes(spark, sf_dir):
    return clean.keep_repeated_classes(complete_loans(spark, sf_dir).select(ID, "open_acc"), "open_acc")


@query(
    "sample_rows",
    on_loans(f"SELECT loan_id, score FROM ok ORDER BY {unit('loan_id', '42')}, loan_id LIMIT 5000"),
)
def sample_rows(spark, sf_dir):
    return hash_sample(complete_loans(spark, sf_dir).select(ID, "score"), ID, 5000, 42)


@query(
    "sample_background_rows",
    on_loans(f"SELECT loan_id FROM ok ORDER BY {unit('loan_id', '43')}, loan_id LIMIT 100"),
)
def sample_background_rows(spark, sf_dir):
    return hash_sample(complete_loans(spark, sf_dir).select(ID), ID, 100, 43)


@query(
    "clean_supported_groups",
    on_loans("SELECT issue_d, grade, count(*) AS n_samples FROM ok GROUP BY issue_d, grade HAVING count(*) >= 450"),
)
def clean_supported_groups(spark, sf_dir):
    return clean.supported_groups(complete_loans(spark, sf_dir), ["issue_d", "grade"], 450)


@query(
    "clean_guarded_division",
    on_loans(
        f"SELECT purpose, {r('CASE WHEN sum(y_hat) <> 0 THEN sum(y_hat*target)*1.0::DOUBLE/sum(y_hat) END')} AS precision_or_null, "
        f"{r('CASE WHEN count(*) FILTER (WHERE score >= 0.97) = 0 THEN 0.0::DOUBLE ELSE (count(*) FILTER (WHERE score >= 0.97 AND target=1))*1.0::DOUBLE/(count(*) FILTER (WHERE score >= 0.97)) END')} AS precision_or_zero "
        "FROM sc GROUP BY purpose"
    ),
)
def clean_guarded_division(spark, sf_dir):
    high = F.col("score") >= 0.97
    sums = scored(spark, sf_dir).groupBy("purpose").agg(
        F.sum("y_hat").alias("n"),
        F.sum(F.col("y_hat") * F.col("target")).alias("tp"),
        F.count_if(high).alias("n_high"),
        F.count_if(high & (F.col("target") == 1)).alias("tp_high"),
    )
    return rounded(
        sums.select(
            "purpose",
            X.ratio("tp", "n").alias("precision_or_null"),
            X.ratio0("tp_high", "n_high").alias("precision_or_zero"),
        )
    )


@query(
    "clean_missing_groups",
    on_loans(
        'WITH g AS (SELECT CASE WHEN int_rate IS NOT NULL THEN CASE WHEN int_rate > 5 THEN \'high\' ELSE \'low\' END END AS rate_group FROM loans) '
        "SELECT rate_group, count(*) AS n FROM g WHERE rate_group IS NOT NULL GROUP BY rate_group"
    ),
)
def clean_missing_groups(spark, sf_dir):
    rate = F.col("int_rate")
    group = F.when(rate.isNotNull(), F.when(rate > 5, "high").otherwise("low"))
    df = loans(spark, sf_dir).select(group.alias("rate_group"))
    return df.filter(F.col("rate_group").isNotNull()).groupBy("rate_group").agg(F.count("*").alias("n"))


@query(
    "clean_row_counts",
    on_loans(
        "SELECT 'raw' AS stage, count(*) AS n_rows, 14::BIGINT AS n_columns FROM loans UNION ALL "
        "SELECT 'complete', count(*), 14::BIGINT FROM ok UNION ALL SELECT 'grouped', count(*), 16::BIGINT FROM aud"
    ),
)
def clean_row_counts(spark, sf_dir):
    return clean.row_counts(
        {"raw": loans(spark, sf_dir), "complete": complete_loans(spark, sf_dir), "grouped": audited(spark, sf_dir)}
    )


@query(
    "split_by_years",
    on_loans("SELECT loan_id, issue_d, CASE WHEN issue_d IN (1999,2000,2001) THEN 'test' ELSE 'train' END AS split FROM ok"),
)
def split_by_years(spark, sf_dir):
    return split.by_years(complete_loans(spark, sf_dir).select(ID, "issue_d"), "issue_d", TEST_YEARS)


@query(
    "split_by_hash",
    on_loans(f"SELECT loan_id, CASE WHEN {unit('loan_id', '42')} < 0.8 THEN 'train' ELSE 'test' END AS split FROM ok"),
)
def split_by_hash(spark, sf_dir):
    return split.by_hash(complete_loans(spark, sf_dir).select(ID), ID)


@query(
    "split_stratified",
    on_loans(
        f"""WITH o AS (SELECT loan_id, target, row_number() OVER (PARTITION BY target ORDER BY {unit('loan_id', '42')}, loan_id) AS k,
        count(*) OVER (PARTITION BY target) AS n FROM ok)
        SELECT loan_id, target, CASE WHEN k <= round(0.8*n) THEN 'train' ELSE 'test' END AS split FROM o"""
    ),
)
def split_stratified(spark, sf_dir):
    return split.stratified(complete_loans(spark, sf_dir).select(ID, "target"), "target", ID)
