"""Quality metrics and stability queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlens.operators import metrics, split, stability
from auditlens.plans.frames import rounded, scored
from auditlens.plans.registry import query
from auditlens.plans.sql import bucket, edges, on_loans, r
from auditlens.sources.loans import ID, TEST_YEARS, complete_loans, table

CELLS = (
    "count(*) AS n_samples, count(*) FILTER (WHERE target=0 AND y_hat=0) AS tn, count(*) FILTER (WHERE target=0 AND y_hat=1) AS fp, "
    "count(*) FILTER (WHERE target=1 AND y_hat=0) AS fn, count(*) FILTER (WHERE target=1 AND y_hat=1) AS tp"
)
ACCURACY = "(tp+tn)*1.0::DOUBLE/(tp+tn+fp+fn)"
PRECISION = "CASE WHEN tp+fp=0 THEN 0.0::DOUBLE ELSE tp*1.0::DOUBLE/(tp+fp) END"
RECALL = "CASE WHEN tp+fn=0 THEN 0.0::DOUBLE ELSE tp*1.0::DOUBLE/(tp+fn) END"
F1 = "CASE WHEN 2*tp+fp+fn=0 THEN 0.0::DOUBLE ELSE 2.0::DOUBLE*tp/(2*tp+fp+fn) END"


def with_line(spark, sf_dir):
    """Loans with a one-feature line as a cheap surrogate and the split by years."""
    df = split.by_years(complete_loans(spark, sf_dir).select(ID, "issue_d", "dti", "score"), "issue_d", TEST_YEARS)
    line = df.filter("split = 'train'").agg(
        F.struct(F.regr_slope("score", "dti").alias("b"), F.regr_intercept("score", "dti").alias("a"))
    ).scalar()
    return df.withColumn("predicted", line["a"] + line["b"] * F.col("dti"))


LINE_SQL = """sp AS (SELECT *, CASE WHEN issue_d IN (1999,2000,2001) THEN 'test' ELSE 'train' END AS split FROM ok),
l AS (SELECT regr_slope(score, dti) AS b, regr_intercept(score, dti) AS a FROM sp WHERE split='train'),
ln AS (SELECT sp.*, a + b*dti AS predicted FROM sp, l),
fit AS (SELECT split, count(*) AS n_samples, 1 - avg((score-predicted)*(score-predicted))/var_pop(score) AS r2,
  avg((score-predicted)*(score-predicted)) AS mse, avg(abs(score-predicted)) AS mae FROM ln GROUP BY split)"""


@query(
    "quality_regression",
    on_loans(f"WITH {LINE_SQL} SELECT split, n_samples, {r('r2')} AS r2, {r('mse', 9)} AS mse, {r('mae', 9)} AS mae FROM fit"),
)
def quality_regression(spark, sf_dir):
    fit = metrics.regression_fit(with_line(spark, sf_dir), "score", "predicted", ["split"])
    return fit.select("split", "n_samples", (F.round("r2", 6) + 0.0).alias("r2"), F.round("mse", 9).alias("mse"), F.round("mae", 9).alias("mae"))


@query(
    "quality_fidelity",
    on_loans(
        f"WITH {LINE_SQL}, p AS (SELECT max(r2) FILTER (WHERE split='train') AS a, max(r2) FILTER (WHERE split='test') AS b FROM fit) "
        f"SELECT {r('a')} AS r2_train, {r('b')} AS r2_test, {r('a-b')} AS overfit_gap FROM p"
    ),
)
def quality_fidelity(spark, sf_dir):
    return rounded(metrics.fidelity(with_line(spark, sf_dir), "score", "predicted"))


@query("quality_confusion", on_loans(f"SELECT {CELLS} FROM sc"))
def quality_confusion(spark, sf_dir):
    return metrics.confusion(scored(spark, sf_dir))


@query(
    "quality_rates",
    on_loans(
        f"WITH c AS (SELECT {CELLS} FROM sc) SELECT {r(ACCURACY)} AS accuracy, {r(PRECISION)} AS precision, {r(RECALL)} AS recall, "
        f"{r(F1)} AS f1 FROM c"
    ),
)
def quality_rates(spark, sf_dir):
    return rounded(metrics.with_rates(metrics.confusion(scored(spark, sf_dir))).select("accuracy", "precision", "recall", "f1"))


@query(
    "quality_weighted_f1",
    on_loans(
        f"WITH c AS (SELECT {CELLS} FROM sc) SELECT "
        + r("(2.0::DOUBLE*tp/(2*tp+fp+fn)*(tp+fn) + 2.0::DOUBLE*tn/(2*tn+fn+fp)*(tn+fp))/n_samples")
        + " AS weighted_f1 FROM c"
    ),
)
def quality_weighted_f1(spark, sf_dir):
    return rounded(metrics.weighted_f1(metrics.confusion(scored(spark, sf_dir))).select("weighted_f1"))


@query(
    "quality_class_report",
    on_loans(
        f"""WITH c AS (SELECT {CELLS} FROM sc),
        k AS (SELECT '0' AS label, tn*1.0::DOUBLE/(tn+fn) AS precision, tn*1.0::DOUBLE/(tn+fp) AS recall, 2.0::DOUBLE*tn/(2*tn+fn+fp) AS f1, tn+fp AS support FROM c
              UNION ALL SELECT '1', tp*1.0::DOUBLE/(tp+fp), tp*1.0::DOUBLE/(tp+fn), 2.0::DOUBLE*tp/(2*tp+fp+fn), tp+fn FROM c)
        SELECT label, {r('precision')} AS precision, {r('recall')} AS recall, {r('f1')} AS f1, support FROM k
        UNION ALL SELECT 'macro avg', {r('avg(precision)')}, {r('avg(recall)')}, {r('avg(f1)')}, CAST(sum(support) AS BIGINT) FROM k
        UNION ALL SELECT 'weighted avg', {r('sum(precision*support)/sum(support)')}, {r('sum(recall*support)/sum(support)')},
        {r('sum(f1*support)/sum(support)')}, CAST(sum(support) AS BIGINT) FROM k"""
    ),
)
def quality_class_report(spark, sf_dir):
    return rounded(metrics.class_report(scored(spark, sf_dir)))


def auc_sql(source: str, keys: str = "") -> str:
    """Mann-Whitney statistic from average ranks, one row per key."""
    by = f"PARTITION BY {keys}" if keys else ""
    head, tail = (f"{keys}, ", f"GROUP BY {keys}") if keys else ("", "")
    return (
        f"SELECT {head}CASE WHEN sum(target)=0 OR sum(1-target)=0 THEN NULL ELSE (sum(CASE WHEN target=1 THEN rk END) - sum(target)*(sum(target)+1)/2.0::DOUBLE)"
        f"/(sum(target)*1.0::DOUBLE*sum(1-target)) END AS auc FROM (SELECT *, rank() OVER ({by} ORDER BY score) "
        f"+ (count(*) OVER (PARTITION BY {keys + ', ' if keys else ''}score) - 1)/2.0::DOUBLE AS rk FROM {source}) {tail}"
    )


@query("quality_roc_auc", on_loans(f"WITH a AS ({auc_sql('sc')}) SELECT {r('auc')} AS auc FROM a"))
def quality_roc_auc(spark, sf_dir):
    return rounded(metrics.roc_auc(scored(spark, sf_dir)))


@query(
    "quality_hard_label_auc",
    on_loans(f"WITH c AS (SELECT {CELLS} FROM sc) SELECT {r('(tp*1.0::DOUBLE/(tp+fn)+tn*1.0::DOUBLE/(tn+fp))/2')} AS balanced_auc FROM c"),
)
def quality_hard_label_auc(spark, sf_dir):
    return rounded(metrics.with_rates(metrics.confusion(scored(spark, sf_dir))).select("balanced_auc"))


CURVE_SQL = """g AS (SELECT score, sum(target) AS pos, sum(1-target) AS neg FROM sc GROUP BY score),
cv AS (SELECT score AS threshold, sum(pos) OVER w AS cp, sum(neg) OVER w AS cn, sum(pos) OVER () AS tp, sum(neg) OVER () AS tn
  FROM g WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING))"""


@query(
    "quality_roc_curve",
    on_loans(f"WITH {CURVE_SQL} SELECT {r('threshold')} AS threshold, {r('cn*1.0::DOUBLE/tn')} AS fpr, {r('cp*1.0::DOUBLE/tp')} AS tpr FROM cv"),
)
def quality_roc_curve(spark, sf_dir):
    return rounded(metrics.roc_curve(scored(spark, sf_dir)))


@query(
    "quality_precision_recall_curve",
    on_loans(f"WITH {CURVE_SQL} SELECT {r('threshold')} AS threshold, {r('cp*1.0::DOUBLE/(cp+cn)')} AS precision, {r('cp*1.0::DOUBLE/tp')} AS recall FROM cv"),
)
def quality_precision_recall_curve(spark, sf_dir):
    return rounded(metrics.precision_recall_curve(scored(spark, sf_dir)))


@query(
    "quality_best_f1_threshold",
    on_loans(
        f"""WITH {CURVE_SQL}, p AS (SELECT threshold, cp*1.0::DOUBLE/(cp+cn) AS precision, cp*1.0::DOUBLE/tp AS recall FROM cv),
        f AS (SELECT *, round(2*(precision*recall)/(precision+recall+1e-8::DOUBLE), 12) AS f1 FROM p)
        SELECT {r('f.threshold')} AS threshold, {r('f1')} AS f1, {r('precision')} AS precision, {r('recall')} AS recall FROM f ORDER BY f.f1 DESC, f.threshold LIMIT 1"""
    ),
)
def quality_best_f1_threshold(spark, sf_dir):
    return rounded(metrics.best_f1_threshold(scored(spark, sf_dir)))


SWEEP_SQL = f"""t AS (SELECT unnest([{','.join(f'{x:.2f}::DOUBLE' for x in metrics.SWEEP)}]) AS threshold),
cs AS (SELECT threshold, count(*) FILTER (WHERE target=0 AND score<threshold) AS tn, count(*) FILTER (WHERE target=0 AND score>=threshold) AS fp,
  count(*) FILTER (WHERE target=1 AND score<threshold) AS fn, count(*) FILTER (WHERE target=1 AND score>=threshold) AS tp FROM sc, t GROUP BY threshold),
sw AS (SELECT threshold, {F1} AS f1_score, {ACCURACY} AS accuracy, {PRECISION} AS precision, {RECALL} AS recall FROM cs)"""
SWEEP_OUT = f"threshold, {r('f1_score')} AS f1_score, {r('accuracy')} AS accuracy, {r('precision')} AS precision, {r('recall')} AS recall"


@query("quality_threshold_sweep", on_loans(f"WITH {SWEEP_SQL} SELECT {SWEEP_OUT} FROM sw"))
def quality_threshold_sweep(spark, sf_dir):
    return rounded(metrics.threshold_sweep(scored(spark, sf_dir)))


@query(
    "quality_best_of_sweep",
    on_loans(f"WITH {SWEEP_SQL} SELECT {SWEEP_OUT} FROM sw ORDER BY round(sw.f1_score, 12) DESC, threshold LIMIT 5"),
)
def quality_best_of_sweep(spark, sf_dir):
    return rounded(metrics.best_of_sweep(metrics.threshold_sweep(scored(spark, sf_dir))))


# --- stability -----------------------------------------------------------------------


def quality_sql(source: str, keys: str, least: int) -> str:
    """Full-precision metrics per key, to be aliased and rounded by the caller."""
    on = " AND ".join(f"c.{k.strip()} = a.{k.strip()}" for k in keys.split(","))
    names = ", ".join(f"c.{k.strip()}" for k in keys.split(","))
    return (
        f"SELECT {names}, n_samples, {ACCURACY} AS accuracy, auc, {PRECISION} AS precision, {RECALL} AS recall, {F1} AS f1, "
        f"(tp+fn)*1.0::DOUBLE/n_samples AS default_rate FROM (SELECT {keys}, {CELLS} FROM {source} GROUP BY {keys} HAVING count(*) >= {least}) c "
        f"JOIN ({auc_sql(source, keys)}) a ON {on}"
    )


QUALITY_OUT = (
    f"n_samples, {r('accuracy')} AS accuracy, {r('auc')} AS auc, {r('precision')} AS precision, {r('recall')} AS recall, "
    f"{r('f1')} AS f1, {r('default_rate')} AS default_rate"
)
YEARS_SQL = f"yr AS (SELECT *, issue_d AS year FROM sc), yq AS ({quality_sql('yr', 'year', 10)})"


@query("stability_by_year", on_loans(f"WITH {YEARS_SQL} SELECT year, {QUALITY_OUT} FROM yq"))
def stability_by_year(spark, sf_dir):
    return rounded(stability.quality_by_year(scored(spark, sf_dir), "issue_d"))


@query("stability_year_of_date", "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders")
def stability_year_of_date(spark, sf_dir):
    return stability.with_year(table(spark, sf_dir, "orders"), "o_orderdate").select("o_orderkey", "year")


SUBGROUPS_SQL = (
    "sg AS (SELECT 'grade' AS subgroup, grade AS value, score, target, y_hat FROM sc UNION ALL "
    f"SELECT 'home_ownership', home_ownership, score, target, y_hat FROM sc), sq AS ({quality_sql('sg', 'subgroup, value', 50)})"
)


def by_subgroup(spark, sf_dir):
    return stability.quality_by_subgroup(scored(spark, sf_dir), {"grade": "grade", "home_ownership": "home_ownership"})


@query("stability_by_subgroup", on_loans(f"WITH {SUBGROUPS_SQL} SELECT subgroup, value, {QUALITY_OUT} FROM sq"))
def stability_by_subgroup(spark, sf_dir):
    return rounded(by_subgroup(spark, sf_dir))


@query(
    "stability_frequent_purposes",
    on_loans(
        f"""WITH t AS (SELECT purpose FROM sc GROUP BY purpose ORDER BY count(*) DESC, purpose LIMIT 5),
        sg AS (SELECT 'purpose' AS subgroup, purpose AS value, score, target, y_hat FROM sc WHERE purpose IN (SELECT purpose FROM t)),
        sq AS ({quality_sql('sg', 'subgroup, value', 50)}) SELECT subgroup, value, {QUALITY_OUT} FROM sq"""
    ),
)
def stability_frequent_purposes(spark, sf_dir):
    return rounded(stability.quality_of_frequent(scored(spark, sf_dir), "purpose"))


def _labels(x: str, q: str, labels) -> str:
    return f"CASE {bucket(x, q)} WHEN 1 THEN '{labels[0]}' WHEN 2 THEN '{labels[1]}' WHEN 3 THEN '{labels[2]}' ELSE '{labels[3]}' END"


QUARTILE_SQL = f"""iq AS (SELECT {edges('annual_inc')} AS a, {edges('funded_amnt')} AS b FROM sc),
sg AS (SELECT 'income_quartile' AS subgroup, {_labels('annual_inc', '(SELECT a FROM iq)', stability.INCOME_LABELS)} AS value, score, target, y_hat FROM sc
  UNION ALL SELECT 'loan_amount_quartile', {_labels('funded_amnt', '(SELECT b FROM iq)', stability.AMOUNT_LABELS)}, score, target, y_hat FROM sc),
sq AS ({quality_sql('sg', 'subgroup, value', 50)})"""


def by_quartile(spark, sf_dir):
    return stability.quality_by_quartile(
        scored(spark, sf_dir),
        {
            "annual_inc": ("income_quartile", stability.INCOME_LABELS),
            "funded_amnt": ("loan_amount_quartile", stability.AMOUNT_LABELS),
        },
    )


@query("stability_by_quartile", on_loans(f"WITH {QUARTILE_SQL} SELECT subgroup, value, {QUALITY_OUT} FROM sq"))
def stability_by_quartile(spark, sf_dir):
    return rounded(by_quartile(spark, sf_dir))


VARIATION_OUT = ", ".join(
    f"{r(f'avg({m})')} AS {m}_mean, {r(f'stddev_samp({m})')} AS {m}_std, {r(f'max({m})-min({m})')} AS {m}_range"
    for m in ("auc", "precision", "f1")
)


@query(
    "stability_variation",
    on_loans(
        f"WITH {YEARS_SQL}, {SUBGROUPS_SQL}, u AS (SELECT 'year' AS family, auc, precision, f1 FROM yq UNION ALL SELECT subgroup, auc, precision, f1 FROM sq) "
        f"SELECT family, count(*) AS n_groups, {VARIATION_OUT} FROM u GROUP BY family"
    ),
)
def stability_variation(spark, sf_dir):
    years = stability.quality_by_year(scored(spark, sf_dir), "issue_d").withColumn("family", F.lit("year"))
    groups = by_subgroup(spark, sf_dir).withColumnRenamed("subgroup", "family")
    cols = ["family", *stability.MEASURES]
    both = reduce(DataFrame.unionByName, [years.select(cols), groups.select(cols)])
    return rounded(stability.variation(both, ["family"]))


@query(
    "stability_outliers",
    on_loans(
        f"""WITH pg AS (SELECT 'purpose' AS subgroup, purpose AS value, score, target, y_hat FROM sc), pz AS ({quality_sql('pg', 'subgroup, value', 50)}),
        o AS (SELECT *, avg(auc) OVER () AS m, stddev_samp(auc) OVER () AS s FROM pz)
        SELECT value, {r('auc')} AS auc, {r('m')} AS auc_mean, {r('s')} AS auc_std FROM o WHERE abs(auc-m) > 1.5*s"""
    ),
)
def stability_outliers(spark, sf_dir):
    quality = stability.quality_by_subgroup(scored(spark, sf_dir), {"purpose": "purpose"})
    return rounded(stability.outliers(quality, ["subgroup"], 1.5).select("value", "auc", "auc_mean", "auc_std"))


@query(
    "stability_verdict",
    on_loans(
        f"""WITH {YEARS_SQL}, {SUBGROUPS_SQL}, v AS (SELECT 'temporal' AS kind, stddev_samp(auc) AS s FROM yq UNION ALL
        SELECT 'subgroup', stddev_samp(auc) FROM sq)
        SELECT kind, {r('s')} AS auc_std, CASE WHEN s < 0.05 THEN 'GOOD' WHEN s < 0.1 THEN 'MODERATE' ELSE 'POOR' END AS verdict FROM v"""
    ),
)
def stability_verdict(spark, sf_dir):
    parts = [
        stability.variation(stability.quality_by_year(scored(spark, sf_dir), "issue_d")).withColumn("kind", F.lit("temporal")),
        stability.variation(by_subgroup(spark, sf_dir)).withColumn("kind", F.lit("subgroup")),
    ]
    both = reduce(DataFrame.unionByName, parts)
    return rounded(stability.verdict(both).select("kind", "auc_std", "verdict"))
