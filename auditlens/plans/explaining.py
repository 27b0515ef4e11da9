"""Explanation queries: dependence, individual curves, permutation, attributions."""

from __future__ import annotations

from pyspark.sql import functions as F

from auditlens.operators import encode, profile, split
from auditlens.operators.explain import dependence, local_linear, permutation, shapley
from auditlens.operators.scorers import AdditiveScorer
from auditlens.plans.frames import rounded
from auditlens.plans.registry import query
from auditlens.plans.sql import draw, margin, model, on_loans, r, unit
from auditlens.session import fresh_path
from auditlens.sources import tables
from auditlens.sources.loans import (
    ADDITIVE,
    FEATURES,
    ID,
    MARGIN_SCORER,
    SCORER,
    SCORER_INPUTS,
    SCORER_NUMERIC,
    TEST_YEARS,
    complete_loans,
)

ARGUMENT = {"int_rate": "int_rate", "dti": "dti", "pct_protected": "pct", "annual_inc": "inc", "grade": "grade"}


def even_sql(features, points: int) -> str:
    last = points - 1
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST(i AS INTEGER) AS grid_pos, CASE WHEN i={last} THEN hi ELSE lo+i*((hi-lo)/{last}) END AS num, CAST(NULL AS VARCHAR) AS text "
        f"FROM (SELECT CAST(min({c}) AS DOUBLE) AS lo, CAST(max({c}) AS DOUBLE) AS hi FROM ok), range({points}) t(i)"
        for c in features
    )


def text_sql(c: str, first: int) -> str:
    return (
        f"SELECT '{c}' AS feature, CAST(row_number() OVER (ORDER BY {c})-1 AS INTEGER) AS grid_pos, CAST(NULL AS DOUBLE) AS num, {c} AS text "
        f"FROM (SELECT DISTINCT {c} FROM ok ORDER BY {c} LIMIT {first})"
    )


def swapped_model() -> str:
    """The scorer with the row's grid feature overwritten."""
    args = {}
    for c, a in ARGUMENT.items():
        args[a if a != "int_rate" else "int_rate"] = f"(CASE WHEN feature='{c}' THEN {'text' if c == 'grade' else 'num'} ELSE {c} END)"
    return model(**args)


def curve_sql(grid: str, source: str, keys: str = "", having: str = "") -> str:
    head = f"{keys}, " if keys else ""
    return (
        f"gr AS ({grid}), sp AS (SELECT {head}feature, grid_pos, num, text, {swapped_model()} AS v FROM {source}, gr), "
        f"cu AS (SELECT {head}feature, grid_pos, max(num) AS num, max(text) AS text, count(*) AS n, avg(v) AS value FROM sp "
        f"GROUP BY {head}feature, grid_pos {having})"
    )


GRID_SQL = (
    even_sql([c for c in FEATURES if c not in ("issue_d", "grade", "home_ownership", "purpose")], 20)
    + " UNION ALL SELECT 'issue_d', CAST(row_number() OVER (ORDER BY issue_d)-1 AS INTEGER), CAST(issue_d AS DOUBLE), NULL FROM (SELECT DISTINCT issue_d FROM ok) UNION ALL "
    + " UNION ALL ".join(text_sql(c, 15) for c in ("grade", "home_ownership", "purpose"))
)


@query("explain_dependence_grid", on_loans(f"WITH g AS ({GRID_SQL}) SELECT feature, grid_pos, {r('num')} AS num, text FROM g"))
def explain_dependence_grid(spark, sf_dir):
    return rounded(dependence.grid_frame(spark, dependence.fit_grid(complete_loans(spark, sf_dir), FEATURES)))


CURVES = curve_sql(even_sql(SCORER_NUMERIC, 20) + " UNION ALL " + text_sql("grade", 15), "ok")


@query(
    "explain_partial_dependence",
    on_loans(f"WITH {CURVES} SELECT feature, grid_pos, {r('num')} AS num, text, n, {r('value')} AS value FROM cu"),
)
def explain_partial_dependence(spark, sf_dir):
    return rounded(dependence.partial_dependence(complete_loans(spark, sf_dir), SCORER, SCORER_INPUTS))


@query(
    "explain_curve_points_cleaned",
    on_loans(
        f"WITH {CURVES}, h AS (SELECT feature, grid_pos, num AS grid_value, CASE WHEN value < 0.2 THEN NULL ELSE value END AS value FROM cu) "
        f"SELECT feature, grid_pos, {r('grid_value')} AS grid_value, {r('value')} AS value FROM h WHERE value IS NOT NULL"
    ),
)
def explain_curve_points_cleaned(spark, sf_dir):
    """Points of the curve whose value is missing go together with their grid value."""
    curve = dependence.partial_dependence(complete_loans(spark, sf_dir), SCORER, SCORER_INPUTS)
    holed = curve.select(
        "feature", "grid_pos", F.col("num").alias("grid_value"), F.when(F.col("value") >= 0.2, F.col("value")).alias("value")
    )
    return rounded(holed.filter(F.col("value").isNotNull()))


MEAN_ROW = (
    "mr AS (SELECT avg(int_rate) AS int_rate, avg(dti) AS dti, avg(pct_protected) AS pct_protected, avg(annual_inc) AS annual_inc, "
    "(SELECT grade FROM ok GROUP BY grade ORDER BY count(*) DESC, grade LIMIT 1) AS grade FROM ok)"
)


@query(
    "explain_dependence_at_mean",
    on_loans(
        f"WITH {MEAN_ROW}, gr AS ({even_sql(SCORER_NUMERIC, 50)}) SELECT feature, grid_pos, {r('num')} AS grid_value, {r(swapped_model())} AS value FROM mr, gr"
    ),
)
def explain_dependence_at_mean(spark, sf_dir):
    return rounded(dependence.dependence_at_mean(complete_loans(spark, sf_dir), SCORER, SCORER_NUMERIC))


def _position(p: float) -> str:
    return f"least(greatest(n*{p}::DOUBLE + {0.4 + p * 0.2 - 1}::DOUBLE, 0), n-1)"


def _at(h: str) -> str:
    return f"(a[CAST(floor({h}) AS BIGINT)+1] + (a[CAST(ceil({h}) AS BIGINT)+1]-a[CAST(floor({h}) AS BIGINT)+1])*({h}-floor({h})))"


ICE_GRID = " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, CAST(i AS INTEGER) AS grid_pos, CASE WHEN i=99 THEN hi ELSE lo+i*((hi-lo)/99) END AS num, CAST(NULL AS VARCHAR) AS text
    FROM (SELECT {_at(_position(0.05))} AS lo, {_at(_position(0.95))} AS hi, d FROM (SELECT list({c} ORDER BY {c}) AS a, count(*) AS n, count(DISTINCT {c}) AS d FROM ok)),
    range(100) t(i) WHERE d > 99
    UNION ALL SELECT '{c}', CAST(row_number() OVER (ORDER BY v)-1 AS INTEGER), v, NULL FROM (SELECT DISTINCT {c} AS v FROM ok)
    WHERE (SELECT count(DISTINCT {c}) FROM ok) <= 99"""
    for c in SCORER_NUMERIC
)


@query(
    "explain_individual_curves",
    on_loans(
        f"WITH gr AS ({ICE_GRID}), s AS (SELECT * FROM ok ORDER BY {unit('loan_id', '42')}, loan_id LIMIT 1000) "
        f"SELECT loan_id, feature, grid_pos, {r('num')} AS grid_value, {r(swapped_model())} AS value FROM s, gr"
    ),
)
def explain_individual_curves(spark, sf_dir):
    """Curves of 1,000 sampled rows; the grid comes from all rows."""
    return rounded(dependence.individual_curves(complete_loans(spark, sf_dir), SCORER, SCORER_NUMERIC, ID, rows=1000))


@query(
    "explain_curve_envelope",
    on_loans(
        f"WITH gr AS ({ICE_GRID}), c AS (SELECT feature, grid_pos, num, {swapped_model()} AS v FROM ok, gr) "
        f"SELECT feature, grid_pos, {r('max(num)')} AS grid_value, {r('avg(v)')} AS mean_value, {r('stddev_pop(v)')} AS std_value, "
        f"{r('min(v)')} AS min_value, {r('max(v)')} AS max_value FROM c GROUP BY feature, grid_pos"
    ),
)
def explain_curve_envelope(spark, sf_dir):
    """Individual curves of every row, summed up per grid point."""
    curves = dependence.individual_curves(complete_loans(spark, sf_dir), SCORER, SCORER_NUMERIC, ID)
    return rounded(dependence.curve_envelope(curves))


# --- permutation ---------------------------------------------------------------------


def permuted_sql(repeats: int) -> str:
    values = ",".join(f"('{c}')" for c in SCORER_INPUTS)
    args = {a: f"(CASE WHEN feature='{c}' THEN d_{c} ELSE {c} END)" for c, a in ARGUMENT.items()}
    donors = ", ".join(f"d.{c} AS d_{c}" for c in SCORER_INPUTS)
    mine = ", ".join(f"a.{c}" for c in SCORER_INPUTS)
    return f"""nb AS (SELECT greatest(1, CAST(ceil(count(*)/2000.0::DOUBLE) AS BIGINT)) AS b FROM ok),
    bk AS (SELECT *, {draw('loan_id', '42')} AS h, {draw('loan_id', '42')} % (SELECT b FROM nb) AS bucket FROM ok),
    ps AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY h, loan_id)-1 AS pos, count(*) OVER (PARTITION BY bucket) AS m FROM bk),
    rn AS (SELECT feature, i AS rep FROM (VALUES {values}) f(feature), range(1, {repeats + 1}) t(i)),
    st AS (SELECT bucket, feature, rep, 1 + {draw('bucket', 'feature', 'rep', '42')} % (m-1) AS step FROM (SELECT DISTINCT bucket, m FROM ps), rn),
    pm AS (SELECT a.target, a.margin, {mine}, {donors}, st.feature, st.rep FROM ps a JOIN st ON st.bucket=a.bucket
      JOIN ps d ON d.bucket=a.bucket AND d.pos=(a.pos+st.step)%a.m
      UNION ALL SELECT target, margin, {', '.join(SCORER_INPUTS)}, {', '.join(SCORER_INPUTS)}, '', 0 FROM ok),
    sm AS (SELECT feature, rep, target, 1.0::DOUBLE/(1.0::DOUBLE+exp(-margin)) AS own, {model(**args)} AS s FROM pm)"""


F1_METRIC = """mt AS (SELECT feature, rep, (2.0::DOUBLE*tp/(2*tp+fp+fn)*(tp+fn) + 2.0::DOUBLE*tn/(2*tn+fn+fp)*(tn+fp))/n AS metric FROM (
  SELECT feature, rep, count(*) AS n, count(*) FILTER (WHERE target=0 AND s<0.5) AS tn, count(*) FILTER (WHERE target=0 AND s>=0.5) AS fp,
  count(*) FILTER (WHERE target=1 AND s<0.5) AS fn, count(*) FILTER (WHERE target=1 AND s>=0.5) AS tp FROM sm GROUP BY feature, rep))"""
R2_METRIC = "mt AS (SELECT feature, rep, 1-avg((own-s)*(own-s))/var_pop(own) AS metric FROM sm GROUP BY feature, rep)"
DROPS = (
    "im AS (SELECT feature, avg(b-metric) AS importance_mean, stddev_pop(b-metric) AS importance_std FROM mt, "
    "(SELECT metric AS b FROM mt WHERE rep=0) WHERE rep>0 GROUP BY feature)"
)
F1_IMPORTANCE = f"{permuted_sql(5)}, {F1_METRIC}, {DROPS}"


def f1_importance(spark, sf_dir):
    return permutation.importance_by_f1(complete_loans(spark, sf_dir), SCORER, ID, "target", SCORER_INPUTS)


@query(
    "explain_permutation_f1",
    on_loans(f"WITH {F1_IMPORTANCE} SELECT feature, {r('importance_mean')} AS importance_mean, {r('importance_std')} AS importance_std FROM im"),
)
def explain_permutation_f1(spark, sf_dir):
    return rounded(f1_importance(spark, sf_dir))


@query(
    "explain_permutation_r2",
    on_loans(
        f"WITH {permuted_sql(10)}, {R2_METRIC}, {DROPS} SELECT feature, {r('importance_mean')} AS importance_mean, {r('importance_std')} AS importance_std FROM im"
    ),
)
def explain_permutation_r2(spark, sf_dir):
    df = complete_loans(spark, sf_dir)
    own = SCORER.score(df).withColumnRenamed("score", "own")
    return rounded(permutation.importance_by_r2(own, SCORER, ID, "own", SCORER_INPUTS))


@query(
    "explain_importance_summary",
    on_loans(
        f"""WITH {F1_IMPORTANCE}, s AS (SELECT avg(importance_mean) AS m, stddev_samp(importance_mean) AS sd, max(importance_mean) AS hi, min(importance_mean) AS lo FROM im)
        SELECT feature, {r('importance_mean')} AS importance_mean, {r('m')} AS mean, {r('sd')} AS std, {r('hi')} AS max, {r('lo')} AS min,
        CASE WHEN importance_mean > m+sd THEN 'high' WHEN importance_mean <= 0.001 THEN 'near zero' ELSE 'normal' END AS level FROM im, s"""
    ),
)
def explain_importance_summary(spark, sf_dir):
    return rounded(permutation.importance_summary(f1_importance(spark, sf_dir)))


@query(
    "explain_importance_tiers",
    on_loans(
        f"WITH {F1_IMPORTANCE} SELECT feature, {r('importance_mean')} AS importance_mean, CASE WHEN importance_mean > 0.01 THEN 'strong' "
        "WHEN importance_mean >= 0.005 THEN 'medium' ELSE 'weak' END AS tier FROM im"
    ),
)
def explain_importance_tiers(spark, sf_dir):
    return rounded(permutation.importance_tier(f1_importance(spark, sf_dir)).drop("importance_std"))


@query(
    "explain_top_importance",
    on_loans(
        f"WITH {F1_IMPORTANCE} SELECT feature, {r('importance_mean')} AS importance_mean FROM im ORDER BY round(im.importance_mean, 9) DESC, feature LIMIT 3"
    ),
)
def explain_top_importance(spark, sf_dir):
    top = profile.top_features(f1_importance(spark, sf_dir).drop("importance_std"), "importance_mean", 3)
    return rounded(top)


# --- attributions --------------------------------------------------------------------

TERMS = {
    "int_rate": "0.45::DOUBLE*(int_rate-5.0::DOUBLE)",
    "dti": "0.06::DOUBLE*(dti-25.0::DOUBLE)",
    "pct_protected": "0.25::DOUBLE*(pct_protected-4.0::DOUBLE)",
    "annual_inc": "-0.00008::DOUBLE*(annual_inc-4500.0::DOUBLE)",
    "grade": "CASE grade WHEN '1-URGENT' THEN -0.6::DOUBLE WHEN '5-LOW' THEN 0.8::DOUBLE ELSE 0.0::DOUBLE END",
}
WIDE_TERMS = TERMS | {
    "open_acc": "0.02::DOUBLE*(open_acc-4.0::DOUBLE)",
    "funded_amnt": "0.000002::DOUBLE*(funded_amnt-150000.0::DOUBLE)",
}
del WIDE_TERMS["grade"]
LEVELS = {
    "grade": {"1-URGENT": -0.6, "2-HIGH": -0.2, "3-MEDIUM": 0.1, "4-NOT SPECIFIED": 0.3, "5-LOW": 0.8},
    "home_ownership": {"AUTOMOBILE": 0.05, "BUILDING": -0.15, "FURNITURE": 0.25, "HOUSEHOLD": -0.35, "MACHINERY": 0.45},
}
WIDE_TERMS |= {f"{c}_{v}": f"CASE WHEN {c}='{v}' THEN {w}::DOUBLE ELSE 0.0::DOUBLE END" for c, levels in LEVELS.items() for v, w in levels.items()}


def wide_terms(cols: dict) -> dict:
    """Terms of a scorer over numbers and the 0/1 columns of texts: sixteen inputs."""
    numbers = {
        "int_rate": 0.45 * (cols["int_rate"] - 5.0),
        "dti": 0.06 * (cols["dti"] - 25.0),
        "pct_protected": 0.25 * (cols["pct_protected"] - 4.0),
        "annual_inc": -0.00008 * (cols["annual_inc"] - 4500.0),
        "open_acc": 0.02 * (cols["open_acc"] - 4.0),
        "funded_amnt": 0.000002 * (cols["funded_amnt"] - 150000.0),
    }
    return numbers | {f"{c}_{v}": cols[f"{c}_{v}"] * F.lit(w) for c, levels in LEVELS.items() for v, w in levels.items()}


WIDE = AdditiveScorer(list(WIDE_TERMS), wide_terms, -1.6)


def phi_sql(terms: dict[str, str]) -> str:
    """Background, attributions and importances of an additive scorer as CTEs."""
    total = "+".join(f'"m_{c}"' for c in terms)
    return (
        f"bg AS (SELECT * FROM ok ORDER BY {unit('loan_id', '42')}, loan_id LIMIT 100), bm AS (SELECT "
        + ", ".join(f'avg({t}) AS "m_{c}"' for c, t in terms.items())
        + " FROM bg), ph AS ("
        + " UNION ALL ".join(f"SELECT loan_id, -1.6::DOUBLE+{total} AS base_value, '{c}' AS feature, ({t})-\"m_{c}\" AS phi FROM ok, bm" for c, t in terms.items())
        + "), ai AS (SELECT feature, avg(abs(phi)) AS importance, avg(phi) AS mean_shap, stddev_pop(phi) AS std_shap, count(*) AS n, var_pop(phi) AS v FROM ph GROUP BY feature)"
    )


WIDE_SQL = phi_sql(WIDE_TERMS)
PHI_SQL = (
    f"bg AS (SELECT * FROM ok ORDER BY {unit('loan_id', '42')}, loan_id LIMIT 100), bm AS (SELECT "
    + ", ".join(f"avg({t}) AS m_{c}" for c, t in TERMS.items())
    + " FROM bg), ph AS ("
    + " UNION ALL ".join(
        f"SELECT loan_id, -1.6::DOUBLE+m_int_rate+m_dti+m_pct_protected+m_annual_inc+m_grade AS base_value, '{c}' AS feature, ({t})-m_{c} AS phi FROM ok, bm"
        for c, t in TERMS.items()
    )
    + "), ai AS (SELECT feature, avg(abs(phi)) AS importance, avg(phi) AS mean_shap, stddev_pop(phi) AS std_shap, count(*) AS n, var_pop(phi) AS v FROM ph GROUP BY feature)"
)


def wide_phi(spark, sf_dir):
    df = complete_loans(spark, sf_dir)
    return shapley.additive_attributions(df, ADDITIVE, ID, shapley.background(df, ID))


def sixteen_phi(spark, sf_dir):
    """Attributions of the scorer with sixteen inputs."""
    df = complete_loans(spark, sf_dir)
    coded = df.withColumns(encode.hot_columns({c: list(levels) for c, levels in LEVELS.items()}))
    quoted = shapley.additive_attributions(coded, WIDE, ID, shapley.background(coded, ID))
    return quoted


def long_phi(spark, sf_dir):
    return shapley.long_attributions(wide_phi(spark, sf_dir), SCORER_INPUTS, ID)


def phi_importance(spark, sf_dir):
    return shapley.attribution_importance(long_phi(spark, sf_dir))


@query(
    "explain_additive_attributions",
    on_loans(f"WITH {PHI_SQL} SELECT loan_id, {r('base_value')} AS base_value, feature, {r('phi')} AS phi FROM ph"),
)
def explain_additive_attributions(spark, sf_dir):
    return rounded(long_phi(spark, sf_dir))


def _mixed(c: str) -> str:
    return f"CASE WHEN p_{c} <= k THEN ok.{c} ELSE bg.{c} END AS {c}"


WALKS = f"""bg AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY loan_id) - 1 AS r FROM (SELECT * FROM ok ORDER BY {unit('loan_id', '42')}, loan_id LIMIT 100)),
  od AS (SELECT w, feature, row_number() OVER (PARTITION BY w ORDER BY md5((w // 2) || '|' || feature || '|42')) AS p
    FROM range(100) t(w), (VALUES {", ".join(f"('{c}')" for c in SCORER_INPUTS)}) f(feature)),
  pl AS (SELECT w, {", ".join(f"max(CASE WHEN feature = '{c}' THEN CASE WHEN w % 2 = 0 THEN p ELSE {len(SCORER_INPUTS) + 1} - p END END) AS p_{c}" for c in SCORER_INPUTS)}
    FROM od GROUP BY w),
  wk AS MATERIALIZED (SELECT h, r, k, pl.* FROM range(100) a(h), range(100) b(r), range({len(SCORER_INPUTS) + 1}) c(k) JOIN pl ON pl.w = (r + h) % 100),
  mx AS (SELECT ok.loan_id, k, {", ".join(f"p_{c}" for c in SCORER_INPUTS)}, {", ".join(_mixed(c) for c in SCORER_INPUTS)}
    FROM (SELECT *, {draw('loan_id', '42')} % 100 AS h FROM ok) ok JOIN wk ON wk.h = ok.h JOIN bg ON bg.r = wk.r),
  vs AS (SELECT *, {margin()} AS s FROM mx)"""


def _difference(c: str) -> str:
    value = f"(sum(s) FILTER (WHERE p_{c} = k) - sum(s) FILTER (WHERE p_{c} = k + 1)) / 100"
    return f"{r(value, 11)} AS phi_{c}"


@query(
    "explain_sampled_attributions",
    on_loans(
        f"WITH {WALKS} SELECT loan_id, {r('sum(s) FILTER (WHERE k = 0) / 100', 11)} AS base_value, "
        f"{', '.join(_difference(c) for c in SCORER_INPUTS)} FROM vs GROUP BY loan_id"
    ),
)
def explain_sampled_attributions(spark, sf_dir):
    df = complete_loans(spark, sf_dir)
    return rounded(shapley.sampled_attributions(df, MARGIN_SCORER, ID, shapley.background(df, ID)), 11)


IMPORTANCE_OUT = f"feature, {r('importance')} AS importance, {r('mean_shap')} AS mean_shap, {r('std_shap')} AS std_shap"


@query("explain_attribution_importance", on_loans(f"WITH {PHI_SQL} SELECT {IMPORTANCE_OUT} FROM ai"))
def explain_attribution_importance(spark, sf_dir):
    return rounded(phi_importance(spark, sf_dir))


@query("sink_importance_table", on_loans(f"WITH {PHI_SQL} SELECT {IMPORTANCE_OUT} FROM ai"))
def sink_importance_table(spark, sf_dir):
    path = fresh_path(spark, "importance")
    table = phi_importance(spark, sf_dir)
    tables.write_csv(table.orderBy(F.col("importance").desc(), "feature"), path)
    return rounded(tables.read_csv(spark, path, table.schema))


@query(
    "explain_direction",
    on_loans(f"WITH {PHI_SQL} SELECT feature, {r('mean_shap')} AS mean_shap, CASE WHEN mean_shap > 0 THEN 'INCREASES' ELSE 'DECREASES' END AS direction FROM ai"),
)
def explain_direction(spark, sf_dir):
    return rounded(shapley.direction_table(phi_importance(spark, sf_dir)).drop("importance", "std_shap"))


@query(
    "explain_direction_counts",
    on_loans(
        f"WITH {PHI_SQL} SELECT count(*) FILTER (WHERE mean_shap > 0) AS n_increasing, count(*) FILTER (WHERE mean_shap < 0) AS n_decreasing, "
        f"{r('count(*) FILTER (WHERE mean_shap > 0)*1.0::DOUBLE/count(*)')} AS share_increasing, {r('count(*) FILTER (WHERE mean_shap < 0)*1.0::DOUBLE/count(*)')} AS share_decreasing FROM ai"
    ),
)
def explain_direction_counts(spark, sf_dir):
    return rounded(shapley.direction_counts(phi_importance(spark, sf_dir)))


@query(
    "explain_top_factors",
    on_loans(
        f"""WITH {PHI_SQL}, s AS (SELECT *, CASE WHEN mean_shap > 0 THEN 'raising' ELSE 'lowering' END AS side FROM ai WHERE mean_shap <> 0),
        k AS (SELECT *, row_number() OVER (PARTITION BY side ORDER BY round(importance, 9) DESC, feature) AS rank FROM s)
        SELECT {IMPORTANCE_OUT}, side, CAST(rank AS INTEGER) AS rank FROM k WHERE rank <= 5"""
    ),
)
def explain_top_factors(spark, sf_dir):
    return rounded(shapley.top_factors(phi_importance(spark, sf_dir)))


@query(
    "explain_attribution_statistics",
    on_loans(
        f"""WITH {WIDE_SQL}, t AS (SELECT v FROM ai ORDER BY round(importance, 9) DESC, feature LIMIT 10)
        SELECT {r('(SELECT sum(v) FROM t)/(SELECT sum(v) FROM ai)')} AS top_variance_share, {r('avg(phi)')} AS mean_shap, {r('stddev_pop(phi)')} AS std_shap,
        {r('avg(base_value)')} AS base_value FROM ph"""
    ),
)
def explain_attribution_statistics(spark, sf_dir):
    return rounded(shapley.attribution_statistics(shapley.long_attributions(sixteen_phi(spark, sf_dir), WIDE.inputs, ID)))


@query(
    "explain_waterfall",
    on_loans(
        f"""WITH {WIDE_SQL}, k AS (SELECT *, row_number() OVER (PARTITION BY loan_id ORDER BY round(abs(phi), 9) DESC, feature) AS rk, count(*) OVER (PARTITION BY loan_id) AS sz FROM ph),
        l AS (SELECT loan_id, CASE WHEN sz > 15 AND rk >= 15 THEN 15 ELSE rk END AS step, CASE WHEN sz > 15 AND rk >= 15 THEN 'other features' ELSE feature END AS label,
          sum(phi) AS phi, max(base_value) AS base_value FROM k GROUP BY ALL)
        SELECT loan_id, CAST(step AS INTEGER) AS step, label, {r('phi', 9)} AS phi, {r('base_value', 9)} AS base_value,
        {r('base_value + sum(phi) OVER (PARTITION BY loan_id ORDER BY step)', 9)} AS running_total FROM l"""
    ),
)
def explain_waterfall(spark, sf_dir):
    return rounded(shapley.waterfall(shapley.long_attributions(sixteen_phi(spark, sf_dir), WIDE.inputs, ID), ID), 9)


def _value_sql(c: str) -> str:
    for text in LEVELS:
        if c.startswith(f"{text}_"):
            return f"CASE WHEN {text}='{c.removeprefix(text + '_')}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"
    return f"CAST({c} AS DOUBLE)"


VALUES_SQL = "CASE ph.feature " + " ".join(f"WHEN '{c}' THEN {_value_sql(c)}" for c in WIDE_TERMS) + " END"


@query(
    "explain_attribution_pairs",
    on_loans(
        f"""WITH {WIDE_SQL}, t AS (SELECT feature FROM ai ORDER BY round(importance, 9) DESC, feature LIMIT 10)
        SELECT ph.loan_id, ph.feature, {r(VALUES_SQL)} AS num, CAST(NULL AS VARCHAR) AS text, {r('phi')} AS phi
        FROM ph JOIN t ON ph.feature=t.feature JOIN ok ON ok.loan_id=ph.loan_id"""
    ),
)
def explain_attribution_pairs(spark, sf_dir):
    pairs = shapley.dependence_pairs(sixteen_phi(spark, sf_dir), WIDE.inputs, WIDE.inputs, ID)
    return rounded(pairs.select(ID, "feature", "num", "text", "phi"))


@query(
    "explain_attribution_ranking",
    on_loans(f"WITH {PHI_SQL} SELECT feature, {r('importance')} AS importance FROM ai ORDER BY round(ai.importance, 9) DESC, feature LIMIT 20"),
)
def explain_attribution_ranking(spark, sf_dir):
    return rounded(profile.top_features(phi_importance(spark, sf_dir).select("feature", "importance"), "importance", 20))


@query(
    "explain_attribution_histogram",
    on_loans(
        f"""WITH {PHI_SQL}, m AS (SELECT min(phi) AS lo, max(phi) AS hi, count(*) AS n FROM ph),
        c AS (SELECT CAST(least(greatest(floor((phi-(SELECT lo FROM m))/(((SELECT hi FROM m)-(SELECT lo FROM m))/50.0::DOUBLE)), 0), 49) AS INTEGER) AS bin, count(*) AS k FROM ph GROUP BY ALL)
        SELECT bin, {r('lo + bin*((hi-lo)/50.0::DOUBLE)')} AS bin_start, k AS n, {r('k/(n*((hi-lo)/50.0::DOUBLE))')} AS density FROM c, m"""
    ),
)
def explain_attribution_histogram(spark, sf_dir):
    return rounded(profile.histogram(long_phi(spark, sf_dir), "phi", 50))


@query("explain_local_linear")
def explain_local_linear(spark, sf_dir):
    """Local models around every loan of the test years."""
    df = split.by_years(complete_loans(spark, sf_dir), "issue_d", TEST_YEARS)
    train, test = df.filter("split = 'train'"), df.filter("split = 'test'")
    return local_linear.local_explanations(train, test, SCORER, ID, samples=200)


@query("explain_local_linear_chosen")
def explain_local_linear_chosen(spark, sf_dir):
    """Local models around five loans of the test years, with 5,000 samples each."""
    df = split.by_years(complete_loans(spark, sf_dir), "issue_d", TEST_YEARS)
    train, test = df.filter("split = 'train'"), df.filter("split = 'test'")
    return local_linear.local_explanations(train, test.orderBy(ID).limit(5), SCORER, ID, samples=5000)
