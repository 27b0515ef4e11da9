"""Group fairness queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from auditlens.operators import fairness, metrics, profile
from auditlens.operators.explain import dependence
from auditlens.plans.explaining import curve_sql, even_sql
from auditlens.plans.frames import audited, rounded, scored
from auditlens.plans.quality import CELLS, auc_sql
from auditlens.plans.registry import query
from auditlens.plans.sql import bucket, edges, on_loans, r
from auditlens.session import fresh_path
from auditlens.sources import tables
from auditlens.sources.loans import FEATURES, ID, SCORER, SCORER_INPUTS, complete_loans

CANDIDATE_COLS = ["loan_id", *FEATURES]
DISTINCT_SQL = "d AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {i} AS position, count(DISTINCT {c}) AS n_distinct FROM ok" for i, c in enumerate(CANDIDATE_COLS)
) + ")"


def _candidates_sql(least, most):
    return on_loans(
        f"WITH {DISTINCT_SQL}, k AS (SELECT * FROM d WHERE n_distinct BETWEEN {least} AND {most}) "
        "SELECT feature, position, n_distinct, position = (SELECT min(position) FROM k) AS chosen FROM k"
    )


@query("fairness_protected_attribute", _candidates_sql(2, 10))
def fairness_protected_attribute(spark, sf_dir):
    return fairness.protected_candidates(complete_loans(spark, sf_dir), CANDIDATE_COLS, 2, 10)


@query("fairness_protected_fallback", _candidates_sql(0, 8))
def fairness_protected_fallback(spark, sf_dir):
    return fairness.protected_candidates(complete_loans(spark, sf_dir), CANDIDATE_COLS, 0, 8)


@query(
    "fairness_protected_choice",
    on_loans(
        f"WITH {DISTINCT_SQL}, k AS (SELECT feature FROM d WHERE n_distinct BETWEEN 2 AND 10 ORDER BY position LIMIT 1) "
        "SELECT 'named' AS asked, 'purpose' AS chosen UNION ALL SELECT 'known', 'Ethnicity' UNION ALL SELECT 'neither', feature FROM k"
    ),
)
def fairness_protected_choice(spark, sf_dir):
    """The attribute chosen when one is named, when a column has a known name, and when neither holds."""
    df = complete_loans(spark, sf_dir)
    known = df.withColumnRenamed("home_ownership", "Ethnicity")
    found = [("named", fairness.choose_protected(known, "purpose")), ("known", fairness.choose_protected(known, "absent")), ("neither", fairness.choose_protected(df))]
    return spark.createDataFrame(found, "asked string, chosen string")


@query(
    "fairness_listed_groups",
    on_loans("SELECT loan_id, CASE WHEN trim(grade) IN ('1-URGENT','2-HIGH') THEN 'minority' ELSE 'majority' END AS \"group\" FROM ok"),
)
def fairness_listed_groups(spark, sf_dir):
    return fairness.with_groups(complete_loans(spark, sf_dir).select(ID, "grade"), "grade", ["1-URGENT", "2-HIGH"]).drop("grade")


@query(
    "fairness_binary_groups",
    on_loans("SELECT loan_id, CASE WHEN y_hat = 0 THEN 'minority' ELSE 'majority' END AS \"group\" FROM sc"),
)
def fairness_binary_groups(spark, sf_dir):
    return fairness.with_groups(scored(spark, sf_dir).select(ID, "y_hat"), "y_hat").drop("y_hat")


@query("fairness_quartile_groups", on_loans('SELECT loan_id, "group" FROM aud'))
def fairness_quartile_groups(spark, sf_dir):
    return fairness.with_protected(complete_loans(spark, sf_dir), "pct_protected").select(ID, "group")


TOTALS_SQL = """gt AS (SELECT "group" AS g, count(*) AS n, count(*) FILTER (WHERE y_hat=1) AS sel, count(*) FILTER (WHERE target=1) AS pos,
  count(*) FILTER (WHERE target=1 AND y_hat=1) AS tp, count(*) FILTER (WHERE target=0 AND y_hat=1) AS fp, avg(score) AS ms, var_samp(score) AS vs
  FROM aud GROUP BY "group"),
o2 AS (SELECT *, row_number() OVER (ORDER BY n DESC, g) AS k FROM gt), mj AS (SELECT * FROM o2 WHERE k=1), mn AS (SELECT * FROM o2 WHERE k=2),
pr AS (SELECT mn.g AS ng, mj.g AS jg, mn.sel*1.0::DOUBLE/mn.n AS nr, mj.sel*1.0::DOUBLE/mj.n AS jr, mn.tp*1.0::DOUBLE/mn.pos AS nt, mj.tp*1.0::DOUBLE/mj.pos AS jt,
  mn.fp*1.0::DOUBLE/(mn.n-mn.pos) AS nf, mj.fp*1.0::DOUBLE/(mj.n-mj.pos) AS jf, mn.n AS nn, mj.n AS jn, mn.ms AS nm, mj.ms AS jm, mn.vs AS nv, mj.vs AS jv FROM mn, mj)"""

CAL_SQL = """cb AS (SELECT "group" AS g, CASE WHEN score<=0 THEN NULL WHEN score<=0.1 THEN 1 WHEN score<=0.2 THEN 2 WHEN score<=0.3 THEN 3
  WHEN score<=0.4 THEN 4 WHEN score<=0.5 THEN 5 WHEN score<=0.6 THEN 6 WHEN score<=0.7 THEN 7 WHEN score<=0.8 THEN 8 WHEN score<=0.9 THEN 9
  WHEN score<=1.0 THEN 10 END AS b, count(*) AS n, avg(score) AS s, avg(target) AS t FROM aud GROUP BY ALL),
cal AS (SELECT g, avg(abs(t-s)) AS e FROM cb WHERE n >= 20 AND b IS NOT NULL GROUP BY g)"""


@query("fairness_top_groups", on_loans(f"WITH {TOTALS_SQL} SELECT ng AS group_minority, jg AS group_majority, nn AS n_minority, jn AS n_majority FROM pr"))
def fairness_top_groups(spark, sf_dir):
    pair = fairness.top_two(fairness.group_totals(audited(spark, sf_dir)))
    return pair.select(
        F.col("mino.group").alias("group_minority"),
        F.col("maj.group").alias("group_majority"),
        F.col("mino.n").alias("n_minority"),
        F.col("maj.n").alias("n_majority"),
    )


PARITY_OUT = f"""ng AS group_minority, jg AS group_majority, {r('nr')} AS selection_rate_min, {r('jr')} AS selection_rate_maj, {r('nr-jr')} AS "SPD",
  {r('nr/jr')} AS "DI" """
ODDS_OUT = f"""{r('nt-jt')} AS "EO_TPR_diff", {r('nt-jt')} AS "EOdds_TPR_diff", {r('nf-jf')} AS "EOdds_FPR_diff" """


def parity(spark, sf_dir):
    return rounded(fairness.parity(fairness.top_two(fairness.group_totals(audited(spark, sf_dir)))))


@query("fairness_parity", on_loans(f"WITH {TOTALS_SQL} SELECT {PARITY_OUT} FROM pr"))
def fairness_parity(spark, sf_dir):
    return parity(spark, sf_dir).drop("EO_TPR_diff", "EOdds_TPR_diff", "EOdds_FPR_diff")


@query("fairness_odds", on_loans(f"WITH {TOTALS_SQL} SELECT {ODDS_OUT} FROM pr"))
def fairness_odds(spark, sf_dir):
    return parity(spark, sf_dir).select("EO_TPR_diff", "EOdds_TPR_diff", "EOdds_FPR_diff")


@query(
    "fairness_named_groups",
    on_loans(
        f"""WITH {TOTALS_SQL}, p AS (SELECT a.g AS ng, b.g AS jg, a.sel*1.0::DOUBLE/a.n AS nr, b.sel*1.0::DOUBLE/b.n AS jr FROM gt a, gt b
        WHERE a.g='Q4_high' AND b.g='Q1_low') SELECT {PARITY_OUT} FROM p"""
    ),
)
def fairness_named_groups(spark, sf_dir):
    pair = fairness.named_pair(fairness.group_totals(audited(spark, sf_dir)), "Q4_high", "Q1_low")
    return rounded(fairness.parity(pair)).drop("EO_TPR_diff", "EOdds_TPR_diff", "EOdds_FPR_diff")


@query("fairness_calibration", on_loans(f'WITH {CAL_SQL} SELECT g AS "group", {r("e")} AS calibration_error FROM cal'))
def fairness_calibration(spark, sf_dir):
    return rounded(fairness.calibration_error(audited(spark, sf_dir)))


RECORD_SQL = f"""WITH {TOTALS_SQL}, {CAL_SQL} SELECT {PARITY_OUT}, {ODDS_OUT},
  {r('(SELECT e FROM cal WHERE g=ng)')} AS calibration_min, {r('(SELECT e FROM cal WHERE g=jg)')} AS calibration_maj FROM pr"""


CHOSEN_SQL = "WITH au2 AS (SELECT sc.*, CAST(issue_d AS VARCHAR) AS \"group\" FROM sc), " + RECORD_SQL.removeprefix("WITH ").replace("FROM aud", "FROM au2")


@query("fairness_chosen_metrics", on_loans(CHOSEN_SQL.replace("ng AS group_minority", "'issue_d' AS attribute, ng AS group_minority")))
def fairness_chosen_metrics(spark, sf_dir):
    """The audit of an attribute that nobody named: chosen, grouped, and put through all metrics."""
    df = scored(spark, sf_dir)
    chosen = fairness.choose_protected(df)
    record = fairness.fairness_metrics(fairness.with_protected(df, chosen))
    return rounded(record.withColumn("attribute", F.lit(chosen)))


@query("fairness_metrics", on_loans(RECORD_SQL))
def fairness_metrics(spark, sf_dir):
    return rounded(fairness.fairness_metrics(audited(spark, sf_dir)))


@query(
    "sink_metric_table",
    on_loans(
        f"""WITH {TOTALS_SQL}, {CAL_SQL}, m AS (
        SELECT 'SPD' AS metric, nr-jr AS value FROM pr UNION ALL SELECT 'DI', nr/jr FROM pr UNION ALL SELECT 'selection_rate_min', nr FROM pr
        UNION ALL SELECT 'selection_rate_maj', jr FROM pr UNION ALL SELECT 'EO_TPR_diff', nt-jt FROM pr UNION ALL SELECT 'EOdds_TPR_diff', nt-jt FROM pr
        UNION ALL SELECT 'EOdds_FPR_diff', nf-jf FROM pr UNION ALL SELECT 'Calibration_abs_error__'||g, e FROM cal, pr WHERE g=ng OR g=jg)
        SELECT metric, {r('value')} AS value FROM m"""
    ),
)
def sink_metric_table(spark, sf_dir):
    from auditlens.session import stored

    record = stored(fairness.fairness_metrics(audited(spark, sf_dir)), "metrics")
    path = fresh_path(spark, "metrics")
    tables.write_csv(fairness.flat_metrics(record), path)
    back = tables.read_csv(spark, path)
    values = [c for c in back.columns if not c.startswith("group_m")]
    pairs = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in values])
    return rounded(back.select(F.inline(pairs)))


TOST_SQL = f"""{TOTALS_SQL}, tt AS (SELECT *, nm-jm AS d, nn+jn-2 AS dof, sqrt(((nn-1)*nv+(jn-1)*jv)/(nn+jn-2)*(1.0::DOUBLE/nn+1.0::DOUBLE/jn)) AS se FROM pr),
  tv AS (SELECT *, (d+0.1::DOUBLE)/se AS tl, (d-0.1::DOUBLE)/se AS tu FROM tt)"""


@query(
    "fairness_equivalence_statistics",
    on_loans(
        f"WITH {TOST_SQL} SELECT ng AS group_minority, jg AS group_majority, {r('d')} AS mean_diff, 0.1::DOUBLE AS delta, dof, {r('tl')} AS t_lower, "
        f"{r('tu')} AS t_upper, CASE WHEN least(tl, -tu) > 1.6448536 + (1.6448536^3 + 1.6448536)/(4*dof) THEN 'Equivalence Accepted' "
        "ELSE 'Equivalence Rejected' END AS result FROM tv"
    ),
)
def fairness_equivalence_statistics(spark, sf_dir):
    pair = fairness.top_two(fairness.group_totals(audited(spark, sf_dir)))
    return rounded(fairness.equivalence_test(pair).drop("p_value"))


SIMPSON = "CASE WHEN i = 0 OR i = 2000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"


def student_sql(t: str, dof: str) -> str:
    """Upper tail of Student's t by Simpson's rule on its density."""
    scale = f"exp(lgamma(({dof}+1)/2.0::DOUBLE) - lgamma({dof}/2.0::DOUBLE)) / sqrt({dof}*pi())"
    area = f"(SELECT sum({SIMPSON} * pow(1 + pow(abs({t})*i/2000, 2)/{dof}, -({dof}+1)/2.0::DOUBLE)) * abs({t})/2000/3 FROM range(2001) s(i))"
    return f"(0.5::DOUBLE - sign({t}) * {scale} * {area})"


def chi2_tail_sql(x: str, dof: str) -> str:
    """Upper tail of chi-squared by Simpson's rule; with u = sqrt(x) the density has no pole."""
    u = f"(sqrt({x})*i/2000)"
    density = f"CASE WHEN {u} = 0 AND {dof} > 1 THEN 0 ELSE exp(CASE WHEN {dof} > 1 THEN ({dof}-1)*ln({u}) ELSE 0 END - {u}*{u}/2 - ({dof}/2.0::DOUBLE-1)*ln(2) - lgamma({dof}/2.0::DOUBLE)) END"
    return f"CASE WHEN {dof} = 0 THEN 1 ELSE greatest(1 - (SELECT sum({SIMPSON} * {density}) * sqrt({x})/2000/3 FROM range(2001) s(i)), 0) END"


@query(
    "fairness_equivalence_test",
    on_loans(
        f"WITH {TOST_SQL}, tp AS (SELECT *, greatest({student_sql('tl', 'dof')}, {student_sql('(-tu)', 'dof')}) AS p FROM tv) "
        f"SELECT ng AS group_minority, jg AS group_majority, {r('d')} AS mean_diff, 0.1::DOUBLE AS delta, dof, {r('tl')} AS t_lower, {r('tu')} AS t_upper, "
        f"{r('p')} AS p_value, CASE WHEN p < 0.05 THEN 'Equivalence Accepted' ELSE 'Equivalence Rejected' END AS result FROM tp"
    ),
)
def fairness_equivalence_test(spark, sf_dir):
    return rounded(fairness.equivalence_test(fairness.top_two(fairness.group_totals(audited(spark, sf_dir)))))


def chi2_sql(source: str, keys: str) -> str:
    """Chi-squared per key by summing over all cells of the contingency table."""
    by = f"PARTITION BY {keys}" if keys else ""
    head, tail = (f"{keys}, ", f"GROUP BY {keys}") if keys else ("", "")
    return f"""SELECT {head}sum(n) AS n, CASE WHEN min(c1)=0 OR min(c0)=0 THEN 0 ELSE sum(gap*gap*nt/(n*c1) + gap*gap*nt/(n*c0)) END AS chi2,
      CASE WHEN min(c1)=0 OR min(c0)=0 THEN 0 ELSE count(*)-1 END AS dof, (min(c1)=0 OR min(c0)=0) AS degenerate
      FROM (SELECT *, CASE WHEN k=2 THEN greatest(abs(n1-n*c1*1.0::DOUBLE/nt)-0.5, 0) ELSE abs(n1-n*c1*1.0::DOUBLE/nt) END AS gap FROM (
        SELECT *, sum(n1) OVER ({by}) AS c1, sum(n-n1) OVER ({by}) AS c0, sum(n) OVER ({by}) AS nt, count(*) OVER ({by}) AS k FROM (
          SELECT {head}"group" AS g, count(*) AS n, sum(y_hat) AS n1 FROM {source} GROUP BY {head}"group"))) {tail} HAVING count(*) >= 2"""


CHI_OUT = f"CAST(n AS BIGINT) AS n_samples, {r('chi2')} AS chi2, CAST(dof AS INTEGER) AS dof, degenerate"


@query("fairness_independence", on_loans(f"WITH x AS ({chi2_sql('aud', '')}) SELECT {CHI_OUT}, {r(chi2_tail_sql('chi2', 'dof'))} AS p_value FROM x"))
def fairness_independence(spark, sf_dir):
    return rounded(fairness.independence_test(audited(spark, sf_dir)))


@query(
    "fairness_independence_two_groups",
    on_loans(
        f"""WITH tw AS (SELECT CASE WHEN grade='1-URGENT' THEN 'minority' ELSE 'majority' END AS "group", home_ownership, y_hat FROM sc),
        x AS ({chi2_sql('tw', 'home_ownership')}) SELECT home_ownership, {CHI_OUT} FROM x"""
    ),
)
def fairness_independence_two_groups(spark, sf_dir):
    df = fairness.with_groups(scored(spark, sf_dir), "grade", ["1-URGENT"])
    return rounded(fairness.independence_statistics(fairness.decision_cells(df, ["home_ownership"]), ["home_ownership"]))


CANDIDATES = ["issue_d", "funded_amnt", "int_rate", "dti", "open_acc", "annual_inc", "grade", "home_ownership", "purpose"]
WIDE = ["funded_amnt", "int_rate", "dti", "open_acc", "annual_inc"]


def _value(c: str) -> str:
    return f"CAST({c} AS VARCHAR)"


CANDIDATE_SQL = (
    "ed AS (SELECT " + ", ".join(f"{edges(c)} AS {c}_e, count(DISTINCT {c}) AS {c}_n" for c in WIDE) + " FROM aud), cr AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, "
        + (f"CASE WHEN {c}_n > 10 THEN 'q'||{bucket(c, c + '_e')} ELSE {_value(c)} END" if c in WIDE else _value(c))
        + ' AS value, "group", y_hat FROM aud, ed'
        for c in CANDIDATES
    )
    + f"), x AS ({chi2_sql('cr', 'feature, value')})"
)


@query("fairness_candidate_statistics", on_loans(f"WITH {CANDIDATE_SQL} SELECT feature, value, {CHI_OUT} FROM x"))
def fairness_candidate_statistics(spark, sf_dir):
    return rounded(fairness.candidate_statistics(audited(spark, sf_dir), CANDIDATES))


TESTED_SQL = f"{CANDIDATE_SQL}, al AS ({chi2_sql('aud', '')}), ov AS (SELECT {chi2_tail_sql('chi2', 'dof')} AS overall FROM al), te AS (SELECT *, {chi2_tail_sql('chi2', 'dof')} AS p FROM x)"


@query(
    "fairness_candidate_variables",
    on_loans(f"WITH {TESTED_SQL} SELECT feature, value, {CHI_OUT}, {r('p')} AS p_value, p >= 0.05 AS restored, {r('overall')} AS overall_p FROM te, ov"),
)
def fairness_candidate_variables(spark, sf_dir):
    return rounded(fairness.candidate_variables(audited(spark, sf_dir), CANDIDATES))


@query(
    "fairness_candidate_ranking",
    on_loans(
        f"WITH {TESTED_SQL}, named AS (SELECT * FROM (VALUES {', '.join(f'({c!r})' for c in CANDIDATES)}) v(feature)) "
        f"SELECT named.feature, {r("coalesce(max(p), 0)")} AS max_p_value, coalesce(bool_or(p >= 0.05 AND overall < 0.05), false) AS is_candidate, "
        "count(*) FILTER (WHERE p >= 0.05) AS n_restored FROM named LEFT JOIN te ON te.feature = named.feature CROSS JOIN ov GROUP BY named.feature"
    ),
)
def fairness_candidate_ranking(spark, sf_dir):
    return rounded(fairness.candidate_ranking(fairness.candidate_variables(audited(spark, sf_dir), CANDIDATES), CANDIDATES))


@query(
    "fairness_score_level",
    on_loans(
        f"""SELECT CASE WHEN grouping("group")=1 THEN 'overall' ELSE "group" END AS "group", count(*) AS n, {r('avg(score)')} AS mean_value
        FROM aud GROUP BY GROUPING SETS (("group"), ())"""
    ),
)
def fairness_score_level(spark, sf_dir):
    return rounded(profile.group_means(audited(spark, sf_dir), "group", "score"))


@query("fairness_group_confusion", on_loans(f'SELECT "group", {CELLS} FROM aud GROUP BY "group"'))
def fairness_group_confusion(spark, sf_dir):
    return metrics.confusion(audited(spark, sf_dir), ["group"])


@query(
    "fairness_group_roc",
    on_loans(
        f"""WITH a AS ({auc_sql('aud', '"group"')}), g AS (SELECT "group", score, sum(target) AS pos, sum(1-target) AS neg FROM aud GROUP BY ALL),
        c AS (SELECT "group", score AS threshold, sum(pos) OVER w AS cp, sum(neg) OVER w AS cn, sum(pos) OVER (PARTITION BY "group") AS tp,
          sum(neg) OVER (PARTITION BY "group") AS tn FROM g WINDOW w AS (PARTITION BY "group" ORDER BY score DESC ROWS UNBOUNDED PRECEDING))
        SELECT c."group", {r('threshold')} AS threshold, {r('cn*1.0::DOUBLE/tn')} AS fpr, {r('cp*1.0::DOUBLE/tp')} AS tpr, {r('auc')} AS auc
        FROM c JOIN a ON c."group" = a."group" WHERE tp > 0 AND tn > 0"""
    ),
)
def fairness_group_roc(spark, sf_dir):
    return rounded(fairness.roc_by_group(audited(spark, sf_dir)))


GROUP_GRID = even_sql(["int_rate", "dti", "pct_protected", "annual_inc"], 10) + (
    " UNION ALL SELECT 'grade', CAST(row_number() OVER (ORDER BY grade)-1 AS INTEGER), NULL, grade FROM (SELECT DISTINCT grade FROM aud ORDER BY grade LIMIT 12)"
)


def group_curves(spark, sf_dir):
    return dependence.group_dependence(audited(spark, sf_dir), SCORER, SCORER_INPUTS, "group")


GROUP_CURVES = curve_sql(GROUP_GRID.replace("FROM ok", "FROM aud"), "aud", '"group"', "HAVING count(*) >= 30")


@query(
    "fairness_group_dependence",
    on_loans(f'WITH {GROUP_CURVES} SELECT "group", feature, grid_pos, {r("num")} AS num, "text", n, {r("value")} AS value FROM cu'),
)
def fairness_group_dependence(spark, sf_dir):
    return rounded(group_curves(spark, sf_dir))


@query(
    "fairness_dependence_disparity",
    on_loans(
        f"""WITH {GROUP_CURVES}, m AS (SELECT feature, "group" AS g, avg(value) AS m FROM cu GROUP BY ALL)
        SELECT feature, count(*) AS n_groups, {r('max(m)-min(m)')} AS max_group_difference, {r('stddev_pop(m)')} AS std_group_difference,
        {r("max(m) FILTER (WHERE g='Q1_low')")} AS mean_q1, {r("max(m) FILTER (WHERE g='Q4_high')")} AS mean_q4 FROM m GROUP BY feature"""
    ),
)
def fairness_dependence_disparity(spark, sf_dir):
    out = dependence.dependence_disparity(group_curves(spark, sf_dir), "group")
    return rounded(
        out.withColumn("mean_q1", F.col("group_means")["Q1_low"])
        .withColumn("mean_q4", F.col("group_means")["Q4_high"])
        .drop("group_means")
    )
