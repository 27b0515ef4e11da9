"""Profiling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from auditlens.operators import profile
from auditlens.operators.ordering import with_quartiles
from auditlens.operators.stability import INCOME_LABELS
from auditlens.plans.frames import audited, rounded, scored
from auditlens.plans.registry import query
from auditlens.plans.sql import bucket, edges, on_loans, r
from auditlens.sources.loans import FEATURES, ID, NUMERIC, STRINGS, complete_loans, loans


def union(parts) -> str:
    return " UNION ALL ".join(parts)


@query(
    "profile_describe",
    on_loans(
        union(
            f"SELECT '{c}' AS feature, count({c}) AS count, {r(f'avg({c})')} AS mean, {r(f'stddev_samp({c})')} AS std, "
            f"{r(f'CAST(min({c}) AS DOUBLE)')} AS min, {r(f'quantile_cont({c}, 0.25)', 9)} AS q25, {r(f'quantile_cont({c}, 0.5)', 9)} AS q50, "
            f"{r(f'quantile_cont({c}, 0.75)', 9)} AS q75, {r(f'CAST(max({c}) AS DOUBLE)')} AS max FROM loans"
            for c in ("score", "funded_amnt", "dti", "int_rate")
        )
    ),
)
def profile_describe(spark, sf_dir):
    out = profile.describe(loans(spark, sf_dir), ["score", "funded_amnt", "dti", "int_rate"])
    fine = {c: F.round(c, 9) for c in ("q25", "q50", "q75")}
    return out.select(
        "feature", "count", *[(F.round(c, 6) + 0.0).alias(c) for c in ("mean", "std", "min", "max")],
        *[(v + 0.0).alias(c) for c, v in fine.items()],
    )


def _profile_sql(c: str) -> str:
    numeric = c in NUMERIC
    num = f"CAST({c} AS DOUBLE)" if numeric else "CAST(NULL AS DOUBLE)"
    top = "" if numeric else f"(SELECT {c} FROM loans WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"
    top_n = "" if numeric else f"(SELECT count(*) FROM loans WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"
    return (
        f"SELECT '{c}' AS feature, '{'numeric' if numeric else 'text'}' AS kind, {r(f'avg({num})')} AS mean, "
        f"{r(f'stddev_samp({num})')} AS std, count(*) FILTER (WHERE {c} IS NULL) AS n_missing, count(DISTINCT {c}) AS n_distinct, "
        f"{top or 'CAST(NULL AS VARCHAR)'} AS top_value, {top_n or 'CAST(NULL AS BIGINT)'} AS top_count, "
        f"count(*) FILTER (WHERE {num} = 0) AS n_zeros, {r(f'min({num})')} AS min, {r(f'max({num})')} AS max FROM loans"
    )


@query("profile_table", on_loans(union(_profile_sql(c) for c in FEATURES)))
def profile_table(spark, sf_dir):
    return rounded(profile.table_profile(loans(spark, sf_dir), FEATURES))


@query(
    "profile_correlations",
    on_loans(
        union(
            f"SELECT '{a}' AS feature_x, '{b}' AS feature_y, {r(f'corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))')} AS correlation FROM ok"
            for i, a in enumerate([*NUMERIC, "score"])
            for b in [*NUMERIC, "score"][i + 1 :]
        )
    ),
)
def profile_correlations(spark, sf_dir):
    return rounded(profile.correlations(complete_loans(spark, sf_dir), [*NUMERIC, "score"]))


RANKED = ["funded_amnt", "int_rate", "dti", "open_acc", "annual_inc", "score"]
RANKS_SQL = "rk AS (SELECT " + ", ".join(f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0::DOUBLE AS {c}" for c in RANKED) + " FROM ok)"


@query(
    "profile_rank_correlations",
    on_loans(
        f"WITH {RANKS_SQL} "
        + union(f"SELECT '{a}' AS feature_x, '{b}' AS feature_y, {r(f'corr({a}, {b})')} AS correlation FROM rk" for i, a in enumerate(RANKED) for b in RANKED[i + 1 :])
    ),
)
def profile_rank_correlations(spark, sf_dir):
    return rounded(profile.rank_correlations(complete_loans(spark, sf_dir), RANKED, ID))


def _cramers_sql(a: str, b: str) -> str:
    return (
        f"SELECT '{a}' AS feature_x, '{b}' AS feature_y, {r(f'sqrt(greatest(sum(n*n/(x.k*y.k::DOUBLE)) - 1, 0) / (least(count(DISTINCT c.{a}), count(DISTINCT c.{b})) - 1))')} AS cramers_v "
        f"FROM (SELECT {a}, {b}, count(*) AS n FROM ok GROUP BY ALL) c JOIN (SELECT {a}, count(*) AS k FROM ok GROUP BY ALL) x ON x.{a} = c.{a} "
        f"JOIN (SELECT {b}, count(*) AS k FROM ok GROUP BY ALL) y ON y.{b} = c.{b}"
    )


@query("profile_text_associations", on_loans(union(_cramers_sql(a, b) for i, a in enumerate(STRINGS) for b in STRINGS[i + 1 :])))
def profile_text_associations(spark, sf_dir):
    return rounded(profile.text_associations(complete_loans(spark, sf_dir), STRINGS))


@query(
    "profile_value_counts",
    on_loans(f"SELECT purpose, count(*) AS n, {r('count(*)*1.0::DOUBLE/(SELECT count(*) FROM ok)')} AS fraction FROM ok GROUP BY purpose"),
)
def profile_value_counts(spark, sf_dir):
    return rounded(profile.value_counts(complete_loans(spark, sf_dir), "purpose"))


@query(
    "profile_label_distribution",
    on_loans(
        "SELECT 'target' AS label, target AS value, count(*) AS n FROM sc GROUP BY target UNION ALL "
        "SELECT 'y_hat', y_hat, count(*) FROM sc GROUP BY y_hat"
    ),
)
def profile_label_distribution(spark, sf_dir):
    both = F.array(*[F.struct(F.lit(c).alias("label"), F.col(c).alias("value")) for c in ("target", "y_hat")])
    return scored(spark, sf_dir).select(F.inline(both)).groupBy("label", "value").agg(F.count("*").alias("n"))


@query(
    "profile_distinct_counts",
    on_loans(union(f"SELECT '{c}' AS feature, count(DISTINCT {c}) AS n_distinct FROM loans" for c in FEATURES)),
)
def profile_distinct_counts(spark, sf_dir):
    return profile.distinct_counts(loans(spark, sf_dir), FEATURES)


@query(
    "profile_distinct_values",
    on_loans(
        union(
            [
                f"SELECT '{c}' AS feature, {c} AS text, CAST(NULL AS DOUBLE) AS num, count(*) AS n FROM ok GROUP BY {c}"
                for c in STRINGS
            ]
            + ["SELECT 'issue_d', CAST(NULL AS VARCHAR), CAST(issue_d AS DOUBLE), count(*) FROM ok GROUP BY issue_d"]
        )
    ),
)
def profile_distinct_values(spark, sf_dir):
    return profile.distinct_values(complete_loans(spark, sf_dir), [*STRINGS, "issue_d"])


@query(
    "profile_quartile_bins",
    on_loans(
        f"WITH q AS (SELECT {edges('annual_inc')} AS e FROM ok) SELECT loan_id, {bucket('annual_inc', '(SELECT e FROM q)')} AS bucket, "
        f"'Q'||{bucket('annual_inc', '(SELECT e FROM q)')} AS label FROM ok"
    ),
)
def profile_quartile_bins(spark, sf_dir):
    return with_quartiles(complete_loans(spark, sf_dir), "annual_inc", INCOME_LABELS, "label", "bucket").select(
        ID, "bucket", "label"
    )


@query("profile_contingency", on_loans('SELECT "group", y_hat, count(*) AS n FROM aud GROUP BY "group", y_hat'))
def profile_contingency(spark, sf_dir):
    return profile.contingency(audited(spark, sf_dir), "group", "y_hat")


@query(
    "profile_group_means",
    on_loans(
        f"SELECT CASE WHEN grouping(grade) = 1 THEN 'overall' ELSE grade END AS grade, count(*) AS n, {r('avg(score)')} AS mean_value "
        "FROM ok GROUP BY GROUPING SETS ((grade), ())"
    ),
)
def profile_group_means(spark, sf_dir):
    return rounded(profile.group_means(complete_loans(spark, sf_dir), "grade", "score"))


def _codes(c: str) -> str:
    return (
        f"SELECT '{c}' AS feature, abs(corr(CAST(k AS DOUBLE), score)) AS correlation FROM "
        f"(SELECT score, CASE WHEN {c} IS NULL THEN -1 ELSE dense_rank() OVER (ORDER BY {c}) - 1 END AS k FROM ok)"
    )


RANKING_SQL = union(
    [f"SELECT '{c}' AS feature, abs(corr(coalesce(CAST({c} AS DOUBLE), 0), score)) AS correlation FROM ok" for c in NUMERIC]
    + [_codes(c) for c in STRINGS]
)


@query(
    "profile_feature_ranking",
    on_loans(
        f"WITH k AS ({RANKING_SQL}) SELECT feature, {r('correlation')} AS correlation FROM k "
        "WHERE NOT isnan(correlation) ORDER BY round(correlation, 9) DESC, feature LIMIT 6"
    ),
)
def profile_feature_ranking(spark, sf_dir):
    ranking = profile.correlation_ranking(complete_loans(spark, sf_dir), NUMERIC, STRINGS, "score")
    return rounded(profile.top_features(ranking, "correlation", 6))


def _bins(x: str, lo: str, hi: str, n: int) -> str:
    return f"CAST(least(greatest(floor(({x}-{lo})/(({hi}-{lo})/{n}.0::DOUBLE)), 0), {n - 1}) AS INTEGER)"


@query(
    "profile_group_histogram",
    on_loans(
        f"""WITH m AS (SELECT min(score) AS lo, max(score) AS hi FROM aud),
        c AS (SELECT "group", {_bins('score', '(SELECT lo FROM m)', '(SELECT hi FROM m)', 30)} AS bin, count(*) AS n FROM aud GROUP BY ALL),
        w AS (SELECT lo, (hi-lo)/30.0::DOUBLE AS w FROM m)
        SELECT "group", bin, {r('(SELECT lo FROM w)+bin*(SELECT w FROM w)')} AS bin_start, n,
        {r('n/((sum(n) OVER (PARTITION BY "group"))*(SELECT w FROM w))')} AS density FROM c"""
    ),
)
def profile_group_histogram(spark, sf_dir):
    return rounded(profile.histogram(audited(spark, sf_dir), "score", 30, ["group"]))


@query(
    "profile_histogram",
    on_loans(
        f"""WITH m AS (SELECT min(score) AS lo, max(score) AS hi FROM ok),
        c AS (SELECT {_bins('score', '(SELECT lo FROM m)', '(SELECT hi FROM m)', 50)} AS bin, count(*) AS n FROM ok GROUP BY ALL),
        w AS (SELECT lo, (hi-lo)/50.0::DOUBLE AS w FROM m)
        SELECT bin, {r('(SELECT lo FROM w)+bin*(SELECT w FROM w)')} AS bin_start, n,
        {r('n/((SELECT count(*) FROM ok)*(SELECT w FROM w))')} AS density FROM c"""
    ),
)
def profile_histogram(spark, sf_dir):
    return rounded(profile.histogram(complete_loans(spark, sf_dir), "score", 50))


@query(
    "profile_density_curve",
    on_loans(
        f"""WITH s AS (SELECT "group" AS g, count(*) AS n, stddev_samp(score)*pow(count(*)::DOUBLE, -0.2) AS h, min(score) AS lo, max(score) AS hi FROM aud GROUP BY ALL),
        a AS (SELECT g, (score-lo)/(h/64) AS t FROM aud JOIN s ON aud."group" = s.g),
        b AS (SELECT g, floor(t) AS b, count(*)-sum(t-floor(t)) AS near, sum(t-floor(t)) AS far FROM a GROUP BY ALL),
        c AS (SELECT g, b, sum(m) AS m FROM (SELECT g, b, near AS m FROM b UNION ALL SELECT g, b+1, far FROM b) GROUP BY ALL),
        p AS (SELECT s.*, i AS grid_pos, lo+i*((hi-lo)/199.0::DOUBLE) AS x FROM s, range(200) t(i))
        SELECT p.g AS "group", CAST(grid_pos AS INTEGER) AS grid_pos, {r('max(x)')} AS grid_value,
        {r('coalesce(sum(m*exp(-((x-lo)/h-b/64)*((x-lo)/h-b/64)/2)) FILTER (WHERE abs((x-lo)/h-b/64) <= 8), 0)/max(n*h*sqrt(2*pi()))')} AS density
        FROM p JOIN c ON p.g = c.g GROUP BY p.g, grid_pos"""
    ),
)
def profile_density_curve(spark, sf_dir):
    return rounded(profile.density_curve(audited(spark, sf_dir), "score", "group"))


@query(
    "profile_box_summary",
    on_loans(
        f"""WITH q AS (SELECT "group" AS g, quantile_cont(score, [0.25,0.5,0.75]) AS q FROM aud GROUP BY ALL),
        j AS (SELECT g, score, q[1] AS q1, q[2] AS q2, q[3] AS q3, score BETWEEN q[1]-1.5*(q[3]-q[1]) AND q[3]+1.5*(q[3]-q[1]) AS inside
              FROM aud JOIN q ON aud."group" = q.g)
        SELECT g AS "group", {r('max(q1)', 9)} AS q1, {r('max(q2)', 9)} AS median, {r('max(q3)', 9)} AS q3,
        {r('min(score) FILTER (WHERE inside)', 9)} AS whisker_low, {r('max(score) FILTER (WHERE inside)', 9)} AS whisker_high,
        count(*) FILTER (WHERE NOT inside) AS n_outliers FROM j GROUP BY g"""
    ),
)
def profile_box_summary(spark, sf_dir):
    return rounded(profile.box_summary(audited(spark, sf_dir), "score", "group"), 9)


@query(
    "profile_score_range",
    on_loans(
        union(
            f"SELECT '{c}' AS feature, {r(f'min({c})')} AS min, {r(f'max({c})')} AS max, {r(f'avg({c})')} AS mean FROM ok"
            for c in ("score", "margin")
        )
    ),
)
def profile_score_range(spark, sf_dir):
    return rounded(profile.value_range(complete_loans(spark, sf_dir), ["score", "margin"]))


def _open_bin(x: str, n: int) -> str:
    """Cell of width 1 / n without limits; 1 itself ends the last cell of [0, 1]."""
    return f"CAST(CASE WHEN {x} = 1 THEN {n - 1} ELSE floor({x}/(1.0::DOUBLE/{n})) END AS INTEGER)"


@query(
    "profile_predicted_actual",
    on_loans(
        f"""WITH l AS (SELECT regr_slope(score, dti) AS b, regr_intercept(score, dti) AS a FROM ok),
        p AS (SELECT score AS x, a + b*dti AS y FROM ok, l)
        SELECT {_open_bin('x', 50)} AS x_bin, {_open_bin('y', 50)} AS y_bin, count(*) AS n
        FROM p GROUP BY ALL"""
    ),
)
def profile_predicted_actual(spark, sf_dir):
    df = complete_loans(spark, sf_dir)
    line = df.agg(F.struct(F.regr_slope("score", "dti").alias("b"), F.regr_intercept("score", "dti").alias("a"))).scalar()
    both = df.select("score", (line["a"] + line["b"] * F.col("dti")).alias("predicted"))
    return profile.joint_histogram(both, "score", "predicted", 50)


@query(
    "profile_group_distribution",
    on_loans(f'SELECT "group", count(*) AS n, {r("count(*)*1.0::DOUBLE/(SELECT count(*) FROM aud)")} AS fraction FROM aud GROUP BY "group"'),
)
def profile_group_distribution(spark, sf_dir):
    return rounded(profile.value_counts(audited(spark, sf_dir), "group"))


