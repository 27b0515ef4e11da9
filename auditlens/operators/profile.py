"""Profiling: summaries, distinct values, histograms, densities, feature ranking."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlens.functions.expr import is_numeric, ratio, uniform_bin
from auditlens.operators.blocks import array_total
from auditlens.operators.ordering import (
    TASK_ROWS,
    dealt,
    exact_quantiles,
    global_positions,
    long_values,
    running_totals,
    with_lookup,
)
from auditlens.session import stored


def describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """count, mean, std (n-1), min, quartiles, max per column."""
    moments = long_values(df, cols).groupBy("feature").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    return moments.join(q, "feature").select(
        "feature",
        "count",
        "mean",
        "std",
        "min",
        F.col("q")[0].alias("q25"),
        F.col("q")[1].alias("q50"),
        F.col("q")[2].alias("q75"),
        "max",
    )


def domain_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows (feature, text, num, n): every distinct value with its count.

    Strings are in ``text``, numbers in ``num``. Duplicates collapse before the shuffle.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    pairs = []
    for c in cols:
        numeric = is_numeric(types[c])
        pairs.append(
            F.struct(
                F.lit(c).alias("feature"),
                (F.lit(None) if numeric else F.col(c)).cast("string").alias("text"),
                (F.col(c) if numeric else F.lit(None)).cast("double").alias("num"),
            )
        )
    return df.select(F.inline(F.array(*pairs))).groupBy("feature", "text", "num").agg(F.count("*").alias("n"))


def distinct_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """Exact number of distinct non-missing values per column."""
    seen = F.col("text").isNotNull() | F.col("num").isNotNull()
    return domain_counts(df, cols).groupBy("feature").agg(F.count_if(seen).alias("n_distinct"))


def distinct_values(df: DataFrame, cols: list[str]) -> DataFrame:
    return domain_counts(df, cols).filter(F.col("text").isNotNull() | F.col("num").isNotNull())


def bounded_distinct_counts(df: DataFrame, cols: list[str], cap: int) -> dict[str, int]:
    """Distinct non-missing values per column: exact up to ``cap``, otherwise some number above it.

    A sketch of all columns rules out the wide ones first, so their values are never
    shuffled; the exact count runs over the columns that may be small. One number per column
    reaches the driver.
    """
    loose = max(100, 4 * cap)
    rough = df.agg(*[F.approx_count_distinct(c, 0.05).alias(c) for c in cols]).first().asDict()
    small = [c for c in cols if rough[c] <= loose]
    if small:
        exact = {c: 0 for c in small}
        exact.update((r["feature"], r["n_distinct"]) for r in distinct_counts(df, small).collect())
        rough.update(exact)
    return rough


def table_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per column: kind, missing, distinct, most frequent text, zeros, mean, std, min, max."""
    types = {f.name: f.dataType for f in df.schema.fields}
    seen = F.col("text").isNotNull() | F.col("num").isNotNull()
    values = domain_counts(df, cols).groupBy("feature").agg(
        F.sum(F.when(seen, 0).otherwise(F.col("n"))).alias("n_missing"),
        F.count_if(seen).alias("n_distinct"),
        F.min_by("text", F.when(F.col("text").isNotNull(), F.struct(-F.col("n"), F.col("text")))).alias("top_value"),
        F.max(F.when(F.col("text").isNotNull(), F.col("n"))).alias("top_count"),
        F.sum(F.when(F.col("num") == 0, F.col("n")).otherwise(0)).alias("n_zeros"),
        F.min("num").alias("min"),
        F.max("num").alias("max"),
    )
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double") if is_numeric(types[c]) else F.lit(None).cast("double")
        aggs += [F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}")]
    rows = [
        F.struct(
            F.lit(c).alias("feature"),
            F.lit("numeric" if is_numeric(types[c]) else "text").alias("kind"),
            F.col(f"m{i}").alias("mean"),
            F.col(f"s{i}").alias("std"),
        )
        for i, c in enumerate(cols)
    ]
    moments = df.agg(*aggs).select(F.inline(F.array(*rows)))
    # both sides have one row per column name
    return F.broadcast(moments).join(values, "feature")


def pearson(x, y):
    """Correlation aggregate that is NULL for a constant; ``corr`` fails on one in ANSI mode."""
    both = x.isNotNull() & y.isNotNull()
    spread = F.stddev_pop(F.when(both, x)) * F.stddev_pop(F.when(both, y))
    return ratio(F.covar_pop(x, y), spread)


def correlations(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation of every pair of columns over the rows where both have a value.

    Columns are standardised, missing cells set to 0, and four products of the matrix and its mask
    (counts, sums, squares, cross products) give every pair's moments. Each task adds up its own, and
    these blocks are added in a tree: 4 x columns^2 numbers, whatever the number of rows.
    """
    x = [F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in cols]
    first = df.agg(*[f(v) for v in x for f in (F.avg, F.stddev_pop)]).first()
    mean = np.array([v if v is not None else 0.0 for v in first[::2]])
    scale = np.array([v or 1.0 for v in first[1::2]])
    p = len(cols)

    def work(batches):
        total = np.zeros((4, p, p))
        for batch in batches:
            values = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns], axis=1).reshape(-1, p)
            there = ~np.isnan(values)
            z, m = np.where(there, (values - mean) / scale, 0.0), there.astype(float)
            total += np.stack([m.T @ m, z.T @ m, (z * z).T @ m, z.T @ z])
        return total

    count, sums, squares, cross = array_total(df.select(*[v.alias(f"_{i}") for i, v in enumerate(x)]), work, (4, p, p))
    rows = []
    for i in range(p):
        for j in range(i + 1, p):
            n, value = count[i, j], None
            if n > 0:
                a, b = sums[i, j] / n, sums[j, i] / n
                va, vb = squares[i, j] / n - a * a, squares[j, i] / n - b * b
                if va > 1e-9 * squares[i, j] / n and vb > 1e-9 * squares[j, i] / n:
                    value = float((cross[i, j] / n - a * b) / math.sqrt(va * vb))
            rows.append((cols[i], cols[j], value))
    return df.sparkSession.createDataFrame(rows, "feature_x string, feature_y string, correlation double")


def mid_ranks(df: DataFrame, cols: list[str], id_col: str, task_rows: int = TASK_ROWS) -> DataFrame:
    """(id, columns): every value replaced by its mean rank among the column's values, equal values
    sharing one. Ranks come from counts per distinct value in ranges of sampled splitters, and a row's
    ranks are put together in tasks of about ``task_rows`` of them."""
    long = long_values(df, cols, keep=[id_col])
    counts = long.groupBy("feature", "value").agg(F.count("*").alias("n")).repartitionByRange("feature", "value")
    counts = stored(counts.withColumn("_bin", F.spark_partition_id()), "values")
    rank = F.col("cum_n") - F.col("n") + (F.col("n") + 1) / 2
    ranks = running_totals(counts, ["feature"], "_bin", "value", ["n"]).select("feature", "value", rank.alias("rank"))
    ranked = dealt(with_lookup(long, ranks, ["feature", "value"]), id_col, df.count() * len(cols), task_rows)
    return ranked.groupBy(id_col).agg(*[F.max(F.when(F.col("feature") == c, F.col("rank"))).alias(c) for c in cols])


def rank_correlations(df: DataFrame, cols: list[str], id_col: str) -> DataFrame:
    """Spearman correlation of every pair of columns; ``id_col`` is unique."""
    return correlations(stored(mid_ranks(df, cols, id_col), "ranks"), cols)


def text_associations(df: DataFrame, cols: list[str]) -> DataFrame:
    """Cramer's V of every pair of text columns, NULL where one has a single value.

    Rows collapse to one cell per pair of values before the shuffle; margins are sums of cells.
    """
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1 :]]
    entries = [F.struct(F.lit(a).alias("feature_x"), F.lit(b).alias("feature_y"), F.col(a).cast("string").alias("x"), F.col(b).cast("string").alias("y")) for a, b in pairs]
    key = ["feature_x", "feature_y"]
    rows = df.select(F.inline(F.array(*entries))).filter(F.col("x").isNotNull() & F.col("y").isNotNull())
    cells = stored(rows.groupBy(*key, "x", "y").agg(F.count("*").alias("n")), "cells")
    side = lambda v: cells.groupBy(*key, v).agg(F.sum("n").alias(f"n_{v}"))
    met = with_lookup(with_lookup(cells, side("x"), [*key, "x"]), side("y"), [*key, "y"])
    share = F.col("n") * F.col("n") / (F.col("n_x") * F.col("n_y"))
    phi = met.groupBy(*key).agg(F.sum(share).alias("_s"))
    sizes = cells.groupBy(*key).agg(F.countDistinct("x").alias("_r"), F.countDistinct("y").alias("_c"))
    least = F.least("_r", "_c") - 1
    value = F.when(least > 0, F.sqrt(F.greatest(F.col("_s") - 1, F.lit(0.0)) / least))
    return phi.join(sizes, key).select(*key, value.alias("cramers_v"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows (col, n, fraction), a missing value being its own row."""
    total = df.agg(F.count("*")).scalar()
    return df.groupBy(col).agg(F.count("*").alias("n")).withColumn("fraction", F.col("n") / total)


def contingency(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.groupBy(a, b).agg(F.count("*").alias("n"))


def group_means(df: DataFrame, group: str, value: str) -> DataFrame:
    """Mean per group and over all rows (row 'overall') in one grouping-sets pass."""
    return (
        df.rollup(group)
        .agg(F.grouping(group).alias("_all"), F.count("*").alias("n"), F.avg(value).alias("mean_value"))
        .select(F.when(F.col("_all") == 1, "overall").otherwise(F.col(group)).alias(group), "n", "mean_value")
    )


def value_range(df: DataFrame, cols: list[str]) -> DataFrame:
    return long_values(df, cols).groupBy("feature").agg(
        F.min("value").alias("min"), F.max("value").alias("max"), F.avg("value").alias("mean")
    )


def histogram(df: DataFrame, col: str, bins: int, keys: list[str] = ()) -> DataFrame:
    """Counts and densities over ``bins`` equal bins shared by all groups. Densities add up
    to one within each group."""
    keys = list(keys)
    lo, hi = df.agg(F.min(col).cast("double"), F.max(col).cast("double")).first()
    if lo is None:
        lo = hi = 0.0
    counts = (
        df.filter(F.col(col).isNotNull())
        .withColumn("bin", uniform_bin(F.col(col), lo, hi, bins))
        .groupBy(*keys, "bin")
        .agg(F.count("*").alias("n"))
    )
    width = (hi - lo) / bins if hi > lo else 1.0
    if keys:
        totals = counts.groupBy(*keys).agg(F.sum("n").alias("_t"))
        counts = counts.join(totals, keys)
        total = F.col("_t")
    else:
        total = counts.agg(F.sum("n")).scalar()
    return counts.select(
        *keys,
        "bin",
        (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_start"),
        "n",
        (F.col("n") / (total * F.lit(width))).alias("density"),
    )


def open_bin(value: Column, bins: int) -> Column:
    """Cell of width 1 / ``bins``, without limits; 1 itself ends the last cell of [0, 1]."""
    return F.when(value == 1, bins - 1).otherwise(F.floor(value / F.lit(1.0 / bins))).cast("int")


def joint_histogram(df: DataFrame, x: str, y: str, bins: int) -> DataFrame:
    """Counts over a grid of bins x bins cells on [0, 1]^2: the scatter of two scores over all
    rows. The grid goes on beyond: values outside have cells below 0 or from ``bins`` on."""
    cell = lambda c: open_bin(F.col(c), bins)
    return (
        df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
        .groupBy(cell(x).alias("x_bin"), cell(y).alias("y_bin"))
        .agg(F.count("*").alias("n"))
    )


CELLS = 64  # cells per bandwidth
REACH = 8  # bandwidths after which a kernel ends


def density_curve(df: DataFrame, col: str, key: str, points: int = 200) -> DataFrame:
    """Gaussian kernel density per group on ``points`` positions from the group's minimum to
    its maximum, Scott bandwidth.

    Rows are counted on a grid tied to each group's bandwidth, whatever the scale of its values: a
    row between two grid points counts for both in proportion (linear binning), and a grid point
    serves only the positions that its kernel reaches. So the work after the count is bounded by
    cells within reach of a position, and does not grow with the rows.
    """
    x = F.col(col).cast("double")
    data = df.select(key, x.alias("_x")).filter(F.col("_x").isNotNull() & ~F.isnan("_x"))
    stats = data.groupBy(key).agg(
        F.count("*").alias("_n"), F.stddev_samp("_x").alias("_s"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi")
    )
    stats = stored(stats.filter(F.col("_s") > 0).withColumn("_h", F.col("_s") * F.pow(F.col("_n").cast("double"), F.lit(-0.2))), "bandwidths")
    at = (F.col("_x") - F.col("_lo")) / (F.col("_h") / CELLS)
    cells = data.join(stats, key).groupBy(key, F.floor(at).alias("_b")).agg(F.count("*").alias("_c"), F.sum(at - F.floor(at)).alias("_f"))
    halves = F.array(F.struct(F.col("_b"), (F.col("_c") - F.col("_f")).alias("_m")), F.struct((F.col("_b") + 1).alias("_b"), F.col("_f").alias("_m")))
    weights = cells.select(key, F.inline(halves)).groupBy(key, "_b").agg(F.sum("_m").alias("_m"))
    step = (F.col("_hi") - F.col("_lo")) / (points - 1)
    side = lambda reach: (F.col("_b") / CELLS + reach) * F.col("_h") / step
    first = F.greatest(F.ceil(side(-REACH)), F.lit(0)).cast("int")
    last = F.least(F.floor(side(REACH)), F.lit(points - 1)).cast("int")
    met = weights.join(stats, key).withColumn("_first", first).withColumn("_last", last).filter("_first <= _last")
    met = met.withColumn("grid_pos", F.explode(F.sequence("_first", "_last")))
    z = F.col("grid_pos") * step / F.col("_h") - F.col("_b") / CELLS
    sums = met.groupBy(key, "grid_pos").agg(F.sum(F.col("_m") * F.exp(-z * z / 2)).alias("_k"))
    grid = stats.withColumn("grid_pos", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    scale = F.col("_n") * F.col("_h") * math.sqrt(2 * math.pi)
    return grid.join(sums, [key, "grid_pos"], "left").select(
        key, "grid_pos", (F.col("_lo") + F.col("grid_pos") * step).alias("grid_value"), (F.coalesce("_k", F.lit(0.0)) / scale).alias("density")
    )


def box_summary(df: DataFrame, col: str, key: str) -> DataFrame:
    """Quartiles, whiskers at 1.5 IQR and number of outliers per group."""
    q = exact_quantiles(df, [col], [0.25, 0.5, 0.75], keys=[key]).select(
        key, F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3")
    )
    joined = with_lookup(df.select(key, F.col(col).alias("_x")), q, [key])
    iqr = F.col("q3") - F.col("q1")
    low, high = F.col("q1") - 1.5 * iqr, F.col("q3") + 1.5 * iqr
    inside = (F.col("_x") >= low) & (F.col("_x") <= high)
    return joined.groupBy(key).agg(
        F.max("q1").alias("q1"),
        F.max("median").alias("median"),
        F.max("q3").alias("q3"),
        F.min(F.when(inside, F.col("_x"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("_x"))).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"),
    )


def correlation_ranking(df: DataFrame, numeric: list[str], text: list[str], score: str) -> DataFrame:
    """Rows (feature, correlation): absolute Pearson correlation with the score.

    Missing numbers count as 0; texts are coded by their sorted position, missing as -1.
    Texts are reduced to one row per distinct value before the codes are assigned, so the
    codes never have to be joined back to the rows. Constant features are dropped.
    """
    s = F.col(score)
    aggs = [pearson(F.coalesce(F.col(c).cast("double"), F.lit(0.0)), s).alias(f"r{i}") for i, c in enumerate(numeric)]
    rows = [F.struct(F.lit(c).alias("feature"), F.abs(F.col(f"r{i}")).alias("correlation")) for i, c in enumerate(numeric)]
    parts = []
    if numeric:
        parts.append(df.agg(*aggs).select(F.inline(F.array(*rows))))
    if text:
        pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("value")) for c in text])
        cells = (
            df.filter(s.isNotNull())
            .select(s.alias("_s"), F.inline(pairs))
            .groupBy("feature", "value")
            .agg(F.count("*").alias("n"), F.sum("_s").alias("s"), F.sum(F.col("_s") * F.col("_s")).alias("ss"))
        )
        placed = stored(global_positions(cells, [F.col("feature"), F.col("value").asc_nulls_last()], "_at"), "codes")
        first = placed.groupBy("feature").agg(F.min("_at").alias("_first"))
        coded = placed.join(F.broadcast(first), "feature")  # one row per column name
        code = F.when(F.col("value").isNull(), F.lit(-1.0)).otherwise((F.col("_at") - F.col("_first")).cast("double"))
        sums = coded.groupBy("feature").agg(
            F.sum("n").cast("double").alias("n"),
            F.sum(code * F.col("n")).alias("c"),
            F.sum(code * code * F.col("n")).alias("cc"),
            F.sum("s").alias("s"),
            F.sum("ss").alias("ss"),
            F.sum(code * F.col("s")).alias("cs"),
        )
        n = F.col("n")
        cov = F.col("cs") - F.col("c") * F.col("s") / n
        var_c, var_s = F.col("cc") - F.col("c") * F.col("c") / n, F.col("ss") - F.col("s") * F.col("s") / n
        parts.append(sums.select("feature", F.abs(ratio(cov, F.sqrt(var_c * var_s))).alias("correlation")))
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return out.filter(F.col("correlation").isNotNull() & ~F.isnan("correlation"))


def top_features(ranking: DataFrame, value: str, k: int) -> DataFrame:
    """The ``k`` largest values; the name breaks ties."""
    return ranking.orderBy(F.round(value, 9).desc(), "feature").limit(k)
