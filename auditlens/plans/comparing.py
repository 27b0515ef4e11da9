"""Comparison queries: which features and which surrogates agree.

The two studies compared here are the attribution ranking and the correlation ranking of
the loan scorer, and lines with one feature each as surrogates.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from auditlens.operators import compare, models, profile
from auditlens.plans.explaining import F1_IMPORTANCE, PHI_SQL, f1_importance, phi_importance
from auditlens.plans.frames import rounded
from auditlens.plans.modelling import TEXT, fitted, prepared
from auditlens.plans.profiling import RANKING_SQL
from auditlens.plans.registry import query
from auditlens.plans.sql import on_loans, r
from auditlens.session import stored
from auditlens.sources.loans import NUMERIC, STRINGS, complete_loans

TOP = 3
TOPS_SQL = f"""{PHI_SQL}, ta AS (SELECT feature FROM ai ORDER BY round(importance, 9) DESC, feature LIMIT {TOP}),
rk AS ({RANKING_SQL}), tb AS (SELECT feature FROM rk WHERE NOT isnan(correlation) ORDER BY round(correlation, 9) DESC, feature LIMIT {TOP})"""


def tops(spark, sf_dir):
    a = profile.top_features(phi_importance(spark, sf_dir), "importance", TOP)
    ranking = profile.correlation_ranking(complete_loans(spark, sf_dir), NUMERIC, STRINGS, "score")
    return a, profile.top_features(ranking, "correlation", TOP)


@query("compare_common_features", on_loans(f"WITH {TOPS_SQL} SELECT feature FROM ta INTERSECT SELECT feature FROM tb"))
def compare_common_features(spark, sf_dir):
    return compare.common_features(*tops(spark, sf_dir))


@query(
    "compare_specific_features",
    on_loans(
        f"WITH {TOPS_SQL} SELECT feature, 'first' AS side FROM ta WHERE feature NOT IN (SELECT feature FROM tb) UNION ALL "
        "SELECT feature, 'second' FROM tb WHERE feature NOT IN (SELECT feature FROM ta)"
    ),
)
def compare_specific_features(spark, sf_dir):
    return compare.specific_features(*tops(spark, sf_dir))


LINES = ["int_rate", "dti", "pct_protected", "annual_inc"]
LINES_SQL = "ms AS (" + " UNION ALL ".join(f"SELECT 'line {c}' AS model, regr_r2(score, {c}) AS r2 FROM ok" for c in LINES) + ")"


def lines(spark, sf_dir):
    """R2 of the least-squares line on each feature, all from one pass."""
    df = complete_loans(spark, sf_dir)
    fits = df.agg(*[F.regr_r2("score", c).alias(c) for c in LINES])
    rows = F.array(*[F.struct(F.lit(f"line {c}").alias("model"), F.col(c).alias("r2")) for c in LINES])
    return fits.select(F.inline(rows))


@query(
    "compare_fidelity_table",
    on_loans(
        f"WITH {LINES_SQL}, b AS (SELECT model AS bm, r2 AS br FROM ms ORDER BY r2 DESC, model DESC LIMIT 1) "
        f"SELECT model, {r('r2')} AS r2, bm AS best_model, {r('r2-br')} AS gap, model = bm AS is_best FROM ms, b"
    ),
)
def compare_fidelity_table(spark, sf_dir):
    return rounded(compare.fidelity_table(lines(spark, sf_dir)))


@query(
    "compare_easier_or_harder",
    on_loans(
        f"WITH {LINES_SQL}, p AS (SELECT max(r2) FILTER (WHERE model='line dti') AS a, max(r2) FILTER (WHERE model='line int_rate') AS b FROM ms) "
        f"SELECT {r('a')} AS first_r2, {r('b')} AS second_r2, {r('b-a')} AS gap, CASE WHEN b-a > 0 THEN 'easier' ELSE 'harder' END AS verdict FROM p"
    ),
)
def compare_easier_or_harder(spark, sf_dir):
    return rounded(compare.easier_or_harder(lines(spark, sf_dir), "line dti", "line int_rate"))


@query(
    "compare_improvement",
    on_loans(
        f"WITH {LINES_SQL}, b AS (SELECT r2 AS br FROM ms WHERE model='line dti') SELECT model, {r('r2')} AS r2, {r('r2-br')} AS gain, {r('(r2-br)/br*100')} AS gain_percent FROM ms, b"
    ),
)
def compare_improvement(spark, sf_dir):
    return rounded(compare.improvement(lines(spark, sf_dir), "line dti"))


@query(
    "compare_fidelity_verdict",
    on_loans(
        f"WITH {LINES_SQL} SELECT model, {r('r2')} AS r2, CASE WHEN r2 > 0.6 THEN 'success' WHEN r2 > 0.4 THEN 'improvement' ELSE 'failure' END AS verdict FROM ms"
    ),
)
def compare_fidelity_verdict(spark, sf_dir):
    return rounded(compare.fidelity_verdict(lines(spark, sf_dir)))


@query(
    "compare_summary_record",
    on_loans(
        f"""WITH {TOPS_SQL}, {LINES_SQL}, p AS (SELECT max(r2) FILTER (WHERE model IN ('line dti','line annual_inc')) AS a,
        max(r2) FILTER (WHERE model IN ('line int_rate','line pct_protected')) AS b FROM ms)
        SELECT {r('a')} AS first_best_r2, {r('b')} AS second_best_r2,
        coalesce((SELECT string_agg(feature, ',' ORDER BY feature) FROM ta WHERE feature IN (SELECT feature FROM tb)), '') AS common_features,
        coalesce((SELECT string_agg(feature, ',' ORDER BY feature) FROM tb WHERE feature NOT IN (SELECT feature FROM ta)), '') AS second_specific,
        {r('b-a')} AS fidelity_gap, CASE WHEN b-a > 0 THEN 'second' ELSE 'first' END AS recommendation FROM p"""
    ),
)
def compare_summary_record(spark, sf_dir):
    m = lines(spark, sf_dir)
    first = m.filter(F.col("model").isin("line dti", "line annual_inc"))
    second = m.filter(F.col("model").isin("line int_rate", "line pct_protected"))
    out = compare.summary_record(first, second, *tops(spark, sf_dir))
    return rounded(out.withColumns({c: F.array_join(c, ",") for c in ("common_features", "second_specific")}))


@query("compare_permutation_builtin")
def compare_permutation_builtin(spark, sf_dir):
    """Permutation importance of the scorer beside the impurity importance of its tree surrogate,
    column by column."""
    df = prepared(spark, sf_dir)
    model = fitted(df, models.tree_surrogate())
    builtin = models.importance_by_column(models.importance_table(model, model.transform(df)), TEXT)
    return compare.importance_comparison(f1_importance(spark, sf_dir), builtin)


@query(
    "compare_permutation_side",
    on_loans(
        f"""WITH {F1_IMPORTANCE}, k AS (SELECT feature, importance_mean AS v FROM im)
        SELECT feature, {r('v')} AS permutation_importance, CAST(rank() OVER (ORDER BY v DESC) AS INTEGER) AS permutation_rank,
          CAST(1 AS DOUBLE) AS builtin_total, CAST(5 AS BIGINT) AS n_met FROM k"""
    ),
)
def compare_permutation_side(spark, sf_dir):
    """The permutation side of the comparison, the built-in side's total, and how many features meet."""
    both = stored(compare_permutation_builtin(spark, sf_dir), "comparison")
    total = both.agg(F.round(F.sum("builtin_importance"), 9)).scalar()
    met = both.agg(F.count_if(F.col("permutation_rank").isNotNull() & F.col("builtin_rank").isNotNull())).scalar()
    mine = both.filter(F.col("permutation_rank").isNotNull())
    return rounded(mine.select("feature", "permutation_importance", "permutation_rank", total.alias("builtin_total"), met.alias("n_met")))
