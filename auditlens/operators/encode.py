"""Feature encoding fitted on one table and applied to another."""

from __future__ import annotations

from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlens.functions.expr import cubic_basis
from auditlens.operators.ordering import fit_quantiles

ONE_HOT_LIMIT = 40


def impute_median(df: DataFrame, cols: list[str], train: DataFrame) -> DataFrame:
    """Fill missing numbers with the exact median of ``train``."""
    medians = fit_quantiles(train, cols, [0.5])
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(medians[c][0])) for c in cols})


def fit_modes(train: DataFrame, cols: list[str]) -> dict[str, str | None]:
    """Most frequent value per column, the smallest one on ties."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in cols])
    best = (
        train.select(F.inline(pairs))
        .filter(F.col("value").isNotNull())
        .groupBy("feature", "value")
        .agg(F.count("*").alias("n"))
        .groupBy("feature")
        .agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("value"))
    )
    found = {r["feature"]: r["value"] for r in best.collect()}
    return {c: found.get(c) for c in cols}


def impute_most_frequent(df: DataFrame, cols: list[str], train: DataFrame) -> DataFrame:
    mode = fit_modes(train, cols)
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(mode[c])) for c in cols})


def standardise(df: DataFrame, cols: list[str], train: DataFrame) -> DataFrame:
    """(x - mean) / population standard deviation of ``train``; a constant is only centred."""
    fit = train.agg(
        *[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]
    ).first()
    return df.withColumns({c: (F.col(c) - F.lit(fit[f"m_{c}"])) / F.lit(fit[f"s_{c}"] or 1.0) for c in cols})


def fit_categories(train: DataFrame, cols: list[str]) -> dict[str, list[str]]:
    """Sorted distinct values per column, from one pass; each becomes a column of the result, so
    a text with very many values belongs to ``topics.fit_topics``."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in cols])
    out: dict[str, list[str]] = {c: [] for c in cols}
    if cols:
        for feature, value in train.select(F.inline(pairs)).filter("value IS NOT NULL").distinct().collect():
            out[feature].append(value)
    return {c: sorted(values) for c, values in out.items()}


def hot_columns(categories: dict[str, list[str]]) -> dict[str, Column]:
    """0/1 columns ``<column>_<value>``; unknown or missing gives all 0."""
    return {f"{c}_{v}": F.coalesce((F.col(f"`{c}`") == v).cast("int"), F.lit(0)) for c, values in categories.items() for v in values}


def one_hot(df: DataFrame, categories: dict[str, list[str]], keep: list[str]) -> DataFrame:
    """One 0/1 column ``<column>_<value>`` per trained value; unknown or missing gives all 0."""
    return df.select(*keep, *[made.alias(name) for name, made in hot_columns(categories).items()])


def align(df: DataFrame, trained: list[str], keep: list[str]) -> DataFrame:
    """Exactly the trained columns in their order: absent ones are 0, extra ones go."""
    have = set(df.columns)
    return df.select(*keep, *[F.col(f"`{c}`") if c in have else F.lit(0).alias(c) for c in trained])


Limits = dict[str, tuple[float, float]]


def spline_columns(df: DataFrame, cols: list[str], limits: Limits, splines: int = 8) -> DataFrame:
    """Add ``<column>_s<j>``: cubic B-splines on uniform knots between the trained limits."""
    made = {}
    for c in cols:
        for j, b in enumerate(cubic_basis(F.col(c), *limits[c], splines)):
            made[f"{c}_s{j}"] = b
    return df.withColumns(made)


def fit_limits(train: DataFrame, cols: list[str]) -> Limits:
    """Minimum and maximum per column, one pass."""
    row = train.agg(*[f(F.col(c).cast("double")) for c in cols for f in (F.min, F.max)]).first()
    return {c: (row[2 * i], row[2 * i + 1]) for i, c in enumerate(cols)}


def vector_stages(numeric: list[str], text: list[str], out: str = "features") -> list:
    """Spark ML stages for a numeric + categorical table; unknown texts become all-zero."""
    index = StringIndexer(
        inputCols=text, outputCols=[f"{c}_ix" for c in text], stringOrderType="alphabetAsc", handleInvalid="keep"
    )
    hot = OneHotEncoder(
        inputCols=[f"{c}_ix" for c in text], outputCols=[f"{c}_oh" for c in text], dropLast=True
    )
    assemble = VectorAssembler(inputCols=[*numeric, *[f"{c}_oh" for c in text]], outputCol=out, handleInvalid="keep")
    return ([index, hot] if text else []) + [assemble]


def feature_names(df: DataFrame, col: str = "features") -> list[str]:
    """Names of the vector slots, from the ML attributes of the column."""
    attrs = df.schema[col].metadata["ml_attr"]["attrs"]
    slots = [a for group in attrs.values() for a in group]
    return [a.get("name", f"slot_{a['idx']}") for a in sorted(slots, key=lambda a: a["idx"])]
