"""Local linear explanations: a weighted ridge model around every explained row.

All explained rows and all their perturbed samples are one exploded plan. The explained rows are
dealt and sorted by id before they are repeated, so an instance's samples follow each other and never
move. Samples are added up per agreement pattern; an instance's patterns (at most as many as its
samples) become its normal equations, and the equations of a whole Arrow batch are solved at once.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditlens.functions.expr import constant_rows, is_numeric
from auditlens.operators.encode import ONE_HOT_LIMIT
from auditlens.operators.ordering import QUARTILES, bucket_index, fit_quantiles, global_positions
from auditlens.operators.profile import bounded_distinct_counts
from auditlens.session import stored

SAMPLES = 5000
SHOWN = 10
TASK_SAMPLES = 10_000_000  # samples of one task
PATTERN_BITS = 62  # features in one number of a pattern


class Bin(NamedTuple):
    """One quartile of a number or one value of a narrow text, with its cumulative share."""

    code: str
    upto: float
    mean: float | None
    std: float | None
    lo: float | None
    hi: float | None


def fit_bins(train: DataFrame, numeric: list[str], narrow: list[str], edges) -> dict[str, list[Bin]]:
    """Shares and moments per bin: 4 rows per number and below ``ONE_HOT_LIMIT`` per narrow text
    reach the driver."""
    null = F.lit(None).cast("double")
    entries = [
        F.struct(
            F.lit(c).alias("feature"),
            bucket_index(F.col(c).cast("double"), edges[c]).cast("string").alias("code"),
            F.col(c).cast("double").alias("x"),
        )
        for c in numeric
    ] + [F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("code"), null.alias("x")) for c in narrow]
    out: dict[str, list[Bin]] = {c: [] for c in [*numeric, *narrow]}
    if not entries:
        return out
    rows = (
        train.select(F.inline(F.array(*entries)))
        .filter(F.col("code").isNotNull())
        .groupBy("feature", "code")
        .agg(F.count("*").alias("n"), F.avg("x"), F.stddev_pop("x"), F.min("x"), F.max("x"))
        .collect()
    )
    for c in out:
        mine = sorted((r for r in rows if r["feature"] == c), key=lambda r: r["code"])
        total, seen = sum(r["n"] for r in mine), 0
        for r in mine:
            seen += r["n"]
            out[c].append(Bin(r["code"], seen / total, *list(r)[3:]))
    return out


def _position(bins: list[Bin], u: Column) -> Column:
    """Zero-based position of the first bin whose cumulative share exceeds ``u``."""
    uptos = constant_rows([b.upto for b in bins[:-1]], "double")
    if len(bins) > 8:
        return F.size(F.filter(uptos, lambda c: c <= u))
    return sum(((u >= F.lit(b.upto)).cast("int") for b in bins[:-1]), F.lit(0))


def _look(values: list, at: Column) -> Column:
    """Constant of a bin by position, which keeps the generated code short enough to compile."""
    return F.get(constant_rows(values, "double"), at)


def _scales(bins: list[Bin]) -> list[float]:
    return [(b.std or 1.0) / 1.702 for b in bins]


def _chance(bins: list[Bin], at: Column, u: Column) -> Column:
    """Draw between the distribution function's values at the ends of a bin."""
    lows, spans = [], []
    for b, scale in zip(bins, _scales(bins)):
        low, high = (1.0 / (1.0 + math.exp(-(v - b.mean) / scale)) for v in (b.lo, b.hi))
        lows.append(low)
        spans.append(high - low)
    return _look(lows, at) + u * _look(spans, at)


def _inside(bins: list[Bin], at: Column, p: Column) -> Column:
    """Draw within a bin: a normal cut to [lo, hi], by the logistic approximation of its
    distribution function (scale 1.702), which inverts in closed form."""
    scales = [scale if b.std else 0.0 for b, scale in zip(bins, _scales(bins))]
    value = _look([b.mean for b in bins], at) + _look(scales, at) * F.log(p / (1.0 - p))
    return F.least(F.greatest(value, _look([b.lo for b in bins], at)), _look([b.hi for b in bins], at))


def _unit(*parts) -> Column:
    """Reproducible draw from [0, 1)."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(2**53))


def _from_rows(drawn: DataFrame, train: DataFrame, c: str, u: Column, out: str) -> DataFrame:
    """Add the value of a random training row: the rows with a value are numbered in the order of
    their values, and the drawn number is joined. No list of values is ever made."""
    values = train.select(F.col(c).cast("string").alias(out)).filter(F.col(out).isNotNull())
    numbered = stored(global_positions(values, [out], "_row"), "values")
    n = numbered.count()
    return drawn.withColumn("_row", F.floor(u * n).cast("long")).join(numbered, "_row", "left").drop("_row")


FITS = "feature string, weight double, rank int, intercept double, local_r2 double"


def _solver(features: list[str], id_col: str, shown: int):
    """Fits from samples that are sorted by instance."""
    by_name = np.argsort(features, kind="stable")
    width = 0.75 * math.sqrt(len(features))
    numbers = -(-len(features) // PATTERN_BITS)
    bits = [np.arange(min(PATTERN_BITS, len(features) - i * PATTERN_BITS)) for i in range(numbers)]

    def fitted(kind, ids, *rows):
        codes, (n, known, y, yy) = rows[:numbers], rows[numbers:]
        z = np.hstack([code[:, None] >> bit & 1 for code, bit in zip(codes, bits)]).astype(float)
        y, yy = (np.where(known > 0, v, np.nan) for v in (y, yy))  # a pattern without any score
        start = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
        x = np.hstack([np.ones((len(z), 1)), z])
        w = np.sqrt(np.exp(-(len(features) - z.sum(1)) / width**2))
        gram = np.empty((len(start), x.shape[1], x.shape[1]))
        for i, (lo, hi) in enumerate(zip(start, [*start[1:], len(x)])):
            gram[i] = x[lo:hi].T @ (x[lo:hi] * (w * n)[lo:hi, None])
        xy, syy = np.add.reduceat(x * (w * y)[:, None], start), np.add.reduceat(w * yy, start)
        total = gram[:, 0, 0]
        mean, centre = gram[:, 0, 1:] / total[:, None], xy[:, 0] / total
        xx = gram[:, 1:, 1:] - total[:, None, None] * mean[:, :, None] * mean[:, None, :]
        xy = xy[:, 1:] - (total * centre)[:, None] * mean
        spread = syy - total * centre**2
        coef = np.linalg.solve(xx + np.eye(len(features)), xy[:, :, None])[:, :, 0]
        sse = spread - 2 * (coef * xy).sum(1) + np.einsum("ij,ijk,ik->i", coef, xx, coef)
        intercept = centre - (coef * mean).sum(1)
        r2 = np.where(spread > 0, 1 - sse / np.where(spread > 0, spread, 1), np.nan)
        best = by_name[np.argsort(-np.abs(coef[:, by_name]), axis=1, kind="stable")[:, :shown]]
        k, m = best.shape
        columns = [pa.array(np.repeat(ids[start], m), kind), pa.array(np.array(features, object)[best.ravel()], pa.string()), pa.array(np.take_along_axis(coef, best, 1).ravel()),
                   pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), k)), pa.array(np.repeat(intercept, m)), pa.array(np.repeat(r2, m), mask=np.repeat(np.isnan(r2), m))]
        return pa.RecordBatch.from_arrays(columns, [id_col, "feature", "weight", "rank", "intercept", "local_r2"])

    def patterns(start, ids, codes, counts):
        """Rows of one instance and one pattern added up, in the order of the instances."""
        instance = np.cumsum(start) - 1
        key = instance
        for code in codes:
            dense = np.unique(code, return_inverse=True)[1]
            key = key * (dense.max() + 1) + dense
        _, first, key = np.unique(key, return_index=True, return_inverse=True)
        return [ids[first], *(code[first] for code in codes), *(np.bincount(key, weights=v) for v in counts)]

    def solve(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            at, *codes = batch.columns[: 1 + numbers]
            ids = np.array(at.to_pylist(), object) if at.null_count else at.to_numpy(zero_copy_only=False)
            counts = [c.to_numpy(zero_copy_only=False) for c in batch.columns[1 + numbers :]]
            if len(counts) == 1:  # samples, each a pattern of its own
                known = batch.columns[-1].is_valid().to_numpy(zero_copy_only=False)
                y = np.where(known, counts[0], 0.0)
                counts = [np.ones(len(y)), known.astype(float), y, y * y]
            rows = [ids, *(c.to_numpy() for c in codes), *counts]
            if held is not None:
                rows = [np.concatenate(pair) for pair in zip(held, rows)]
            rows = patterns(np.r_[True, rows[0][1:] != rows[0][:-1]], rows[0], rows[1 : 1 + numbers], rows[1 + numbers :])
            new = rows[0][1:] != rows[0][:-1]
            last = int(np.flatnonzero(new)[-1]) + 1 if new.any() else 0
            if last:
                yield fitted(at.type, *(r[:last] for r in rows))
            held = [r[last:] for r in rows]  # one instance, which may go on
        if held is not None:
            yield fitted(at.type, *held)

    return solve


def local_explanations(
    train: DataFrame,
    instances: DataFrame,
    scorer,
    id_col: str,
    samples: int = SAMPLES,
    shown: int = SHOWN,
    seed: int = 42,
    task_samples: int = TASK_SAMPLES,
) -> DataFrame:
    """Rows (id, feature, weight, rank, intercept, local_r2): the ``shown`` largest weights.

    Samples agree with the explained row in a feature when they fall in its quartile (or have
    its text); agreement is the regressor, the scorer's value the response. Sample 0 is the row
    itself. Explode factor: ``samples`` per instance, about ``task_samples`` in a task. Numbers and texts below ``ONE_HOT_LIMIT``
    values are drawn from constants; a text with more takes the value of a random training row by a
    join. A missing value of the explained row agrees with nothing but itself.
    """
    features = scorer.inputs
    types = {f.name: f.dataType for f in train.schema.fields}
    numeric = [c for c in features if is_numeric(types[c])]
    text = [c for c in features if c not in numeric]
    counts = bounded_distinct_counts(train, text, ONE_HOT_LIMIT) if text else {}
    narrow = [c for c in text if counts[c] < ONE_HOT_LIMIT]
    edges = fit_quantiles(train, numeric, QUARTILES) if numeric else {}
    bins = fit_bins(train, numeric, narrow, edges)
    own = {c: bucket_index(F.col(c).cast("double"), edges[c]) - 1 for c in numeric}
    base = instances.select(id_col, *[F.col(c).alias(f"x_{c}") for c in features], *[b.cast("int").alias(f"own_{c}") for c, b in own.items()])
    wide = [c for c in text if c not in narrow]
    if not wide:
        parts = max(math.ceil(instances.count() * samples / task_samples), instances.sparkSession.sparkContext.defaultParallelism)
        base = base.repartition(parts, id_col).sortWithinPartitions(id_col)
    drawn = base.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(samples - 1))))
    unit = {c: _unit(id_col, "_s", F.lit(2 * i), F.lit(seed)) for i, c in enumerate(features)}
    for c in wide:
        drawn = _from_rows(drawn, train, c, unit[c], f"t_{c}")
    # every draw is a column of its own, so that no branch of an expression hashes again
    drawn = drawn.withColumns({f"u_{c}": unit[c] for c in [*numeric, *narrow]} | {f"v_{c}": _unit(id_col, "_s", F.lit(2 * i + 1), F.lit(seed)) for i, c in enumerate(features) if c in numeric})
    first = F.col("_s") == 0
    places = {f"at_{c}": F.when(first, F.col(f"own_{c}")).otherwise(_position(bins[c], F.col(f"u_{c}"))) for c in numeric}
    places |= {f"t_{c}": F.get(constant_rows([b.code for b in bins[c]], "string"), _position(bins[c], F.col(f"u_{c}"))) for c in narrow}
    drawn = drawn.withColumns(places) if places else drawn
    drawn = drawn.withColumns({f"p_{c}": _chance(bins[c], F.col(f"at_{c}"), F.col(f"v_{c}")) for c in numeric})
    made, agree = {}, []
    for c in features:
        if c in numeric:
            at = F.col(f"at_{c}")
            value = _inside(bins[c], at, F.col(f"p_{c}"))
            made[c] = F.when(first, F.col(f"x_{c}").cast("double")).otherwise(value)
            agree.append(at.eqNullSafe(F.col(f"own_{c}")))
        else:
            made[c] = F.when(first, F.col(f"x_{c}")).otherwise(F.col(f"t_{c}"))
            agree.append(first | F.col(f"t_{c}").eqNullSafe(F.col(f"x_{c}")))
    codes = {}
    for at in range(0, len(agree), PATTERN_BITS):
        codes[f"_z{at}"] = sum((F.when(z, F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, z in enumerate(agree[at : at + PATTERN_BITS])), F.lit(0).cast("long"))
    ordered = scorer.score(drawn.withColumns({**made, **codes}).select(id_col, *codes, *made)).select(id_col, *codes, F.col("score").cast("double").alias("_y"))
    if wide:
        # the join has moved the samples: they are added up per pattern before they meet again
        patterns = ordered.groupBy(id_col, *codes).agg(
            F.count("*").cast("double").alias("_n"),
            F.count("_y").cast("double").alias("_known"),
            F.sum("_y").alias("_y"),
            F.sum(F.col("_y") * F.col("_y")).alias("_yy"),
        )
        ordered = patterns.repartition(F.col(id_col)).sortWithinPartitions(id_col)
    kind = instances.schema[id_col].dataType.simpleString()
    return ordered.mapInArrow(_solver(features, id_col, shown), f"`{id_col}` {kind}, {FITS}")
