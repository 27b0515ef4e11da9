"""Partial dependence, individual curves and their grids.

One plan for all features, grid values and groups: every row is repeated for the grid
(a literal array of |features| x |grid| entries at most), one column is overwritten,
the row is scored and falls into a partial aggregate at once. Nothing is shuffled but the
curve points. The aggregate holds numbers only: a text in it would make Spark sort all
repeated rows instead of hashing them. The grid's values are put beside the few points after.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlens.functions.expr import constant_rows, is_numeric
from auditlens.operators.encode import fit_limits, fit_modes
from auditlens.operators.ordering import fit_quantiles, hash_sample
from auditlens.operators.profile import bounded_distinct_counts, distinct_values


class GridPoint(NamedTuple):
    feature: str
    grid_pos: int
    num: float | None
    text: str | None


GRID_SCHEMA = "feature string, grid_pos int, num double, text string"


def fit_grid(
    df: DataFrame,
    features: list[str],
    few: int = 10,
    first: int | None = 15,
    points: int = 20,
    percentiles: tuple[float, float] | None = None,
    plotting: tuple[float, float] = (1.0, 1.0),
) -> list[GridPoint]:
    """The grid of every feature, at most len(features) x max(first, few, points) entries.

    Texts and numbers with at most ``few`` distinct values: the sorted values, the ``first``
    of them. Other numbers: ``points`` even steps over the range, or between ``percentiles``.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    numeric = [c for c in features if is_numeric(types[c])]
    text = [c for c in features if c not in numeric]
    sizes = bounded_distinct_counts(df, numeric, few) if numeric else {}
    small = [c for c in numeric if sizes[c] <= few]
    wide = [c for c in numeric if sizes[c] > few]
    values: dict[str, list] = {c: [] for c in text + small}
    if text:
        tops = []
        for c in text:
            known = df.filter(F.col(c).isNotNull()).select(F.lit(c).alias("feature"), F.col(c).alias("value"))
            known = known.distinct().orderBy("value")
            tops.append(known.limit(first) if first else known)
        for r in reduce(DataFrame.unionByName, tops).collect():
            values[r["feature"]].append(r["value"])
    if small:
        for r in distinct_values(df, small).collect():
            values[r["feature"]].append(r["num"])
    grid = []
    for c in text + small:
        for i, v in enumerate(sorted(values[c])[:first]):
            grid.append(GridPoint(c, i, None, v) if c in text else GridPoint(c, i, float(v), None))
    if wide:
        ends = fit_quantiles(df, wide, list(percentiles), plotting=plotting) if percentiles else fit_limits(df, wide)
        for c in wide:
            grid += [GridPoint(c, i, float(v), None) for i, v in enumerate(np.linspace(*ends[c], points))]
    return grid


def grid_frame(spark: SparkSession, grid: list[GridPoint]) -> DataFrame:
    return spark.createDataFrame(grid, GRID_SCHEMA)


def grid_array(grid: list[GridPoint]) -> Column:
    """The grid as one constant array of structs."""
    return constant_rows([p._asdict() for p in grid], GRID_SCHEMA)


def overwritten(df: DataFrame, features: list[str], schema) -> DataFrame:
    """Replace each row's ``feature`` by the grid value beside it."""
    types = {f.name: f.dataType for f in schema.fields}
    made = {}
    for c in features:
        new, old = (F.col("num"), F.col(c).cast("double")) if is_numeric(types[c]) else (F.col("text"), F.col(c))
        made[c] = F.when(F.col("feature") == c, new).otherwise(old)
    return df.withColumns(made)


def partial_dependence(
    df: DataFrame,
    scorer,
    features: list[str],
    grid: list[GridPoint] | None = None,
    keys: list[str] = (),
    least: int = 0,
) -> DataFrame:
    """Rows (keys, feature, grid_pos, num, text, n, value): mean score with the feature fixed,
    over all rows or per group with at least ``least`` rows. Missing curve points go together
    with their grid value."""
    keys = list(keys)
    grid = fit_grid(df, features) if grid is None else grid
    needed = list(dict.fromkeys([*keys, *scorer.inputs, *features]))
    points = grid_array(grid)
    spread = df.select(*needed, F.posexplode(points).alias("_at", "_point")).select(*needed, "_at", "_point.feature", "_point.num", "_point.text")
    scored = scorer.score(overwritten(spread, features, df.schema))
    curve = scored.groupBy(*keys, "_at").agg(F.count("*").alias("n"), F.avg("score").alias("value"))
    kept = curve.filter(F.col("value").isNotNull() & ~F.isnan("value"))
    kept = kept.filter(F.col("n") >= least) if least else kept
    found = kept.withColumn("_point", F.get(points, F.col("_at")))
    return found.select(*keys, "_point.feature", "_point.grid_pos", "_point.num", "_point.text", "n", "value")


def dependence_at_mean(df: DataFrame, scorer, features: list[str], points: int = 50) -> DataFrame:
    """Curve of one artificial row: numbers at their mean, texts at their most frequent value."""
    types = {f.name: f.dataType for f in df.schema.fields}
    numeric = [c for c in scorer.inputs if is_numeric(types[c])]
    text = [c for c in scorer.inputs if c not in numeric]
    mode = fit_modes(df, text) if text else {}
    grid = fit_grid(df, features, few=0, points=points)
    centre = df.agg(*[F.avg(c).alias(c) for c in numeric]).withColumns({c: F.lit(mode[c]) for c in text})
    spread = centre.select(*scorer.inputs, F.inline(grid_array(grid)))
    scored = scorer.score(overwritten(spread, features, centre.schema))
    return scored.select("feature", "grid_pos", F.col("num").alias("grid_value"), F.col("score").alias("value"))


# Percentile range, plotting positions and resolution of individual curves.
CURVE_PERCENTILES = (0.05, 0.95)
CURVE_PLOTTING = (0.4, 0.4)
CURVE_POINTS = 100


def curve_grid(df: DataFrame, features: list[str], points: int = CURVE_POINTS) -> list[GridPoint]:
    return fit_grid(
        df, features, few=points - 1, first=None, points=points, percentiles=CURVE_PERCENTILES, plotting=CURVE_PLOTTING
    )


def individual_curves(
    df: DataFrame,
    scorer,
    features: list[str],
    id_col: str,
    rows: int | None = None,
    seed: int = 42,
    points: int = CURVE_POINTS,
) -> DataFrame:
    """Rows (id, feature, grid_pos, grid_value, value): one curve per row and feature. The grid
    comes from all rows; ``rows`` limits the curves to a hash sample."""
    grid = curve_grid(df, features, points)
    base = df if rows is None else hash_sample(df, id_col, rows, seed)
    needed = list(dict.fromkeys([id_col, *scorer.inputs, *features]))
    spread = base.select(*needed, F.inline(grid_array(grid)))
    scored = scorer.score(overwritten(spread, features, df.schema))
    return scored.select(
        id_col, "feature", "grid_pos", F.col("num").alias("grid_value"), F.col("score").alias("value")
    )


def curve_envelope(curves: DataFrame) -> DataFrame:
    """Mean, spread and range of the individual curves at every grid point."""
    return curves.groupBy("feature", "grid_pos").agg(
        F.max("grid_value").alias("grid_value"),
        F.avg("value").alias("mean_value"),
        F.stddev_pop("value").alias("std_value"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
    )


def group_dependence(
    df: DataFrame, scorer, features: list[str], group: str, points: int = 10, few: int = 8, first: int = 12, least: int = 30
) -> DataFrame:
    """Partial dependence inside each protected group, one grid for all groups."""
    grid = fit_grid(df, features, few=few, first=first, points=points)
    inside = df.filter(F.col(group).isNotNull())
    return partial_dependence(inside, scorer, features, grid, keys=[group], least=least)


def dependence_disparity(curves: DataFrame, group: str) -> DataFrame:
    """How far the group means of a feature's curves lie apart; needs two groups."""
    means = curves.groupBy("feature", group).agg(F.avg("value").alias("_m"))
    return (
        means.groupBy("feature")
        .agg(
            F.count("*").alias("n_groups"),
            (F.max("_m") - F.min("_m")).alias("max_group_difference"),
            F.stddev_pop("_m").alias("std_group_difference"),
            F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(group), F.col("_m"))))).alias("group_means"),
        )
        .filter(F.col("n_groups") >= 2)
    )
