"""Group fairness: protected groups, metrics, significance tests, candidate causes.

Everything starts from one aggregate per protected group; rows are never split into
per-group tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auditlens.functions.expr import is_numeric, ratio
from auditlens.functions.tails import chi2_p, student_p
from auditlens.operators.metrics import roc_auc, roc_curve
from auditlens.operators.ordering import QUARTILES, bucket_index, fit_quantiles, with_quartiles
from auditlens.operators.profile import bounded_distinct_counts

# Names looked for first, columns never protected, quartile labels, bin edges
# of the calibration, minimum rows of a bin, test margins.
KNOWN_PROTECTED = ["ethnicity", "race", "ethnic", "ethnic_group", "ethnicgroup", "race_desc", "ethnicity_desc"]
NEVER_PROTECTED = ["target", "Predictions", "Predicted probabilities", "score"]
QUARTILE_LABELS = ["Q1_low", "Q2", "Q3", "Q4_high"]
CALIBRATION_EDGES = [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]
CALIBRATION_ROWS = 20
DELTA, ALPHA = 0.1, 0.05


def protected_candidates(df: DataFrame, cols: list[str], least: int = 2, most: int = 10) -> DataFrame:
    """Columns with ``least`` to ``most`` distinct values in table order, the first one marked."""
    allowed = [c for c in cols if c not in NEVER_PROTECTED]
    counts = bounded_distinct_counts(df, allowed, most)
    fits = [(c, i, counts[c]) for i, c in enumerate(allowed) if least <= counts[c] <= most]
    rows = [(*fit, i == 0) for i, fit in enumerate(fits)]
    return df.sparkSession.createDataFrame(rows, "feature string, position int, n_distinct long, chosen boolean")


def choose_protected(df: DataFrame, wanted: str | None = None, least: int = 2, most: int = 10) -> str:
    """The given name, else a known name, else the first column with few distinct values."""
    if wanted in df.columns:
        return wanted
    lower = {c.lower(): c for c in df.columns}
    for name in KNOWN_PROTECTED:
        if name in lower:
            return lower[name]
    row = protected_candidates(df, df.columns, least, most).filter("chosen").first()
    if row is None:
        raise ValueError("no protected attribute found")
    return row["feature"]


def with_groups(df: DataFrame, col: str, minority: list[str] | None = None, out: str = "group") -> DataFrame:
    """Listed values become 'minority'; of exactly two values the alphabetically first does;
    anything else is kept as it is."""
    value = F.trim(F.col(col).cast("string"))
    if minority:
        return df.withColumn(out, F.when(value.isin(minority), "minority").otherwise("majority"))
    few = df.select(value.alias("v")).filter(F.col("v").isNotNull()).distinct().orderBy("v").limit(3)
    values = [r["v"] for r in few.collect()]
    if len(values) == 2:
        value = F.when(value.isNotNull(), F.when(value == values[0], "minority").otherwise("majority"))
    return df.withColumn(out, value)


def with_protected(df: DataFrame, col: str, minority: list[str] | None = None, out: str = "group") -> DataFrame:
    """Quartiles of a number with more than ten distinct values, else groups of its values."""
    if is_numeric(df.schema[col].dataType):
        if bounded_distinct_counts(df, [col], 10)[col] > 10:
            return with_quartiles(df, col, QUARTILE_LABELS, out)
    return with_groups(df, col, minority, out)


def group_totals(df: DataFrame, group: str = "group") -> DataFrame:
    """One row per protected group with every count the group metrics need."""
    y, p = F.col("target"), F.col("y_hat")
    return (
        df.filter(F.col(group).isNotNull())
        .groupBy(F.col(group).alias("group"))
        .agg(
            F.count("*").alias("n"),
            F.count_if(p == 1).alias("selected"),
            F.count_if(y == 1).alias("positives"),
            F.count_if((y == 1) & (p == 1)).alias("tp"),
            F.count_if((y == 0) & (p == 1)).alias("fp"),
            F.avg("score").alias("mean_score"),
            F.var_samp("score").alias("var_score"),
        )
    )


def top_two(totals: DataFrame) -> DataFrame:
    """One row: the two most frequent groups, majority first; the name breaks ties."""
    two = totals.orderBy(F.col("n").desc(), "group").limit(2)
    both = two.agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("_o"), "group", *[c for c in totals.columns if c != "group"]))).alias("g"))
    return both.select(F.col("g")[0].alias("maj"), F.get("g", F.lit(1)).alias("mino")).filter(F.col("mino").isNotNull())


def named_pair(totals: DataFrame, minority: str, majority: str) -> DataFrame:
    """The same one-row form for two groups given by name."""
    pick = lambda g: F.max(F.when(F.col("group") == g, F.struct((-F.col("n")).alias("_o"), *totals.columns)))
    return totals.agg(pick(majority).alias("maj"), pick(minority).alias("mino")).filter(
        F.col("maj").isNotNull() & F.col("mino").isNotNull()
    )


def parity(pair: DataFrame) -> DataFrame:
    """Selection rates, parity difference and ratio, TPR and FPR differences."""
    rate = lambda g: F.col(f"{g}.selected") / F.col(f"{g}.n")
    tpr = lambda g: ratio(f"{g}.tp", f"{g}.positives")
    fpr = lambda g: ratio(F.col(f"{g}.fp"), F.col(f"{g}.n") - F.col(f"{g}.positives"))
    return pair.select(
        F.col("mino.group").alias("group_minority"),
        F.col("maj.group").alias("group_majority"),
        rate("mino").alias("selection_rate_min"),
        rate("maj").alias("selection_rate_maj"),
        (rate("mino") - rate("maj")).alias("SPD"),
        ratio(rate("mino"), rate("maj")).alias("DI"),
        (tpr("mino") - tpr("maj")).alias("EO_TPR_diff"),
        (tpr("mino") - tpr("maj")).alias("EOdds_TPR_diff"),
        (fpr("mino") - fpr("maj")).alias("EOdds_FPR_diff"),
    )


def calibration_bin(score: str) -> Column:
    """1..10, right-closed; a score of exactly 0 lies in no bin."""
    s = F.col(score)
    out = F.when(s <= CALIBRATION_EDGES[0], None)
    for i, edge in enumerate(CALIBRATION_EDGES[1:], start=1):
        out = out.when(s <= edge, i)
    return out


def calibration_error(df: DataFrame, group: str = "group", least: int = CALIBRATION_ROWS) -> DataFrame:
    """Rows (group, calibration_error): mean |rate - mean score| over supported bins."""
    bins = (
        df.filter(F.col(group).isNotNull())
        .groupBy(F.col(group).alias("group"), calibration_bin("score").alias("bin"))
        .agg(F.count("*").alias("n"), F.avg("score").alias("s"), F.avg("target").alias("r"))
        .filter((F.col("n") >= least) & F.col("bin").isNotNull())
    )
    return bins.groupBy("group").agg(F.avg(F.abs(F.col("r") - F.col("s"))).alias("calibration_error"))


def fairness_metrics(df: DataFrame, group: str = "group") -> DataFrame:
    """The full one-row record of the two most frequent groups."""
    record = parity(top_two(group_totals(df, group)))
    cal = calibration_error(df, group)
    low = cal.select(F.col("group").alias("group_minority"), F.col("calibration_error").alias("calibration_min"))
    high = cal.select(F.col("group").alias("group_majority"), F.col("calibration_error").alias("calibration_maj"))
    return record.join(low, "group_minority", "left").join(high, "group_majority", "left")


def flat_metrics(record: DataFrame) -> DataFrame:
    """Record for the CSV sink: the calibration columns carry the group name. Reads one row."""
    row = record.first()
    names = {
        "calibration_min": f"Calibration_abs_error__{row['group_minority']}",
        "calibration_maj": f"Calibration_abs_error__{row['group_majority']}",
    }
    return record.select(
        "group_minority",
        "group_majority",
        *[c for c in record.columns if c not in names and not c.startswith("group_m")],
        *[F.col(old).alias(new) for old, new in names.items()],
    )


def equivalence_statistics(pair: DataFrame, delta: float = DELTA) -> DataFrame:
    """Two one-sided pooled t statistics at +-delta on the mean score; NULL below two rows.
    Without any variance they are infinite, with the sign of their numerator."""
    n1, n2 = F.col("mino.n"), F.col("maj.n")
    dof = n1 + n2 - 2
    pooled = ((n1 - 1) * F.col("mino.var_score") + (n2 - 1) * F.col("maj.var_score")) / dof
    enough = (n1 >= 2) & (n2 >= 2)
    se = F.sqrt(pooled * (1 / n1 + 1 / n2))
    diff = F.col("mino.mean_score") - F.col("maj.mean_score")
    endless = lambda x: F.when(x > 0, float("inf")).when(x < 0, float("-inf"))
    statistic = lambda x: F.when(se == 0, endless(x)).otherwise(ratio(x, se))
    return pair.select(
        F.col("mino.group").alias("group_minority"),
        F.col("maj.group").alias("group_majority"),
        F.when(enough, diff).alias("mean_diff"),
        F.lit(delta).alias("delta"),
        F.when(enough, dof).alias("dof"),
        F.when(enough, statistic(diff + delta)).alias("t_lower"),
        F.when(enough, statistic(diff - delta)).alias("t_upper"),
    )


def equivalence_test(pair: DataFrame, delta: float = DELTA, alpha: float = ALPHA) -> DataFrame:
    """TOST: equivalence holds if both one-sided tests reject, so the larger p decides."""
    stats = equivalence_statistics(pair, delta)
    tail = lambda t: F.when(F.abs(t) == float("inf"), F.when(t > 0, 0.0).otherwise(1.0)).otherwise(student_p(t, F.col("dof").cast("double")))
    p_lower, p_upper = tail(F.col("t_lower")), tail(-F.col("t_upper"))
    tested = stats.withColumn("p_value", F.greatest(p_lower, p_upper))
    return tested.withColumn(
        "result",
        F.when(F.col("dof").isNull(), "Not enough data for test.")
        .when(F.col("p_value") < alpha, "Equivalence Accepted")
        .otherwise("Equivalence Rejected"),
    )


def independence_statistics(cells: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Chi-squared of protected group against decision, per key.

    ``cells`` holds rows (keys, group, n0, n1) with the decision counts. Yates' correction
    applies when there is one degree of freedom; with one decision class the statistic is 0
    (flag ``degenerate``). Keys with fewer than two groups are left out.
    """
    keys = list(keys)
    w = Window.partitionBy(*keys)
    n = F.col("n0") + F.col("n1")
    wide = cells.withColumn("_c0", F.sum("n0").over(w)).withColumn("_c1", F.sum("n1").over(w))
    wide = wide.withColumn("_k", F.count("*").over(w))
    total = F.col("_c0") + F.col("_c1")
    degenerate = (F.col("_c0") == 0) | (F.col("_c1") == 0)
    e0, e1 = n * F.col("_c0") / total, n * F.col("_c1") / total
    gap = F.abs(F.col("n1") - e1)
    gap = F.when(F.col("_k") == 2, gap - F.least(F.lit(0.5), gap)).otherwise(gap)
    part = F.when(degenerate, F.lit(0.0)).otherwise(gap * gap / e0 + gap * gap / e1)
    return (
        wide.withColumn("_part", part)
        .withColumn("_flat", degenerate)
        .groupBy(*keys)
        .agg(
            F.sum(n).alias("n_samples"),
            F.sum("_part").alias("chi2"),
            F.max(F.when(F.col("_flat"), 0).otherwise(F.col("_k") - 1)).cast("int").alias("dof"),
            F.max("_flat").alias("degenerate"),
            F.count("*").alias("_groups"),
        )
        .filter(F.col("_groups") >= 2)
        .drop("_groups")
    )


def decision_cells(df: DataFrame, keys: list[str], group: str = "group") -> DataFrame:
    p = F.col("y_hat")
    return (
        df.filter(F.col(group).isNotNull())
        .groupBy(*keys, F.col(group).alias("group"))
        .agg(F.count_if(p == 0).alias("n0"), F.count_if(p == 1).alias("n1"))
    )


def independence_test(df: DataFrame, group: str = "group") -> DataFrame:
    stats = independence_statistics(decision_cells(df, [], group))
    return stats.withColumn("p_value", chi2_p(F.col("chi2"), F.col("dof").cast("double")))


def candidate_statistics(df: DataFrame, features: list[str], group: str = "group") -> DataFrame:
    """Chi-squared inside every value of every feature, in one aggregate.

    Numbers with more than ten distinct values are cut into quartiles ('q1'..'q4'). Explode
    factor len(features); rows collapse to (feature, value, group) counts before the shuffle.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    numeric = [c for c in features if is_numeric(types[c])]
    sizes = bounded_distinct_counts(df, numeric, 10) if numeric else {}
    wide = [c for c in numeric if sizes[c] > 10]
    edges = fit_quantiles(df, wide, QUARTILES) if wide else {}
    entries = []
    for c in features:
        text = F.col(c).cast("string")
        if c in wide:
            text = F.concat(F.lit("q"), bucket_index(F.col(c).cast("double"), edges[c]).cast("string"))
        entries.append(F.struct(F.lit(c).alias("feature"), text.alias("value")))
    rows = df.select(group, "y_hat", F.inline(F.array(*entries))).filter(F.col("value").isNotNull())
    return independence_statistics(decision_cells(rows, ["feature", "value"], group), ["feature", "value"])


def candidate_variables(df: DataFrame, features: list[str], group: str = "group", alpha: float = ALPHA) -> DataFrame:
    """Per feature value: p-value inside the subset and whether fairness is restored there
    (p >= alpha). Only meaningful when the overall test rejects: ``overall_p`` tells."""
    overall = independence_test(df, group).select("p_value").scalar()
    tests = candidate_statistics(df, features, group)
    tests = tests.withColumn("p_value", chi2_p(F.col("chi2"), F.col("dof").cast("double")))
    return tests.withColumn("restored", F.col("p_value") >= alpha).withColumn("overall_p", overall)


def candidate_ranking(candidates: DataFrame, features: list[str] = (), alpha: float = ALPHA) -> DataFrame:
    """Features by their largest conditional p-value. Nothing is a candidate unless the overall
    test rejects; a feature of ``features`` without a valid subset has p = 0."""
    found = candidates.groupBy("feature").agg(
        F.max("p_value").alias("max_p_value"),
        F.max(F.col("restored") & (F.col("overall_p") < alpha)).alias("is_candidate"),
        F.count_if("restored").alias("n_restored"),
    )
    if not features:
        return found
    listed = candidates.sparkSession.createDataFrame([(f,) for f in features], "feature string")
    return listed.join(found, "feature", "left").fillna({"max_p_value": 0.0, "is_candidate": False, "n_restored": 0})


def roc_by_group(df: DataFrame, group: str = "group") -> DataFrame:
    """ROC points with the AUC of their group; one-class groups are skipped."""
    known = df.filter(F.col(group).isNotNull())
    return roc_curve(known, [group]).join(roc_auc(known, [group]), group)
