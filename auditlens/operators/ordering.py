"""Ordered totals, exact quantiles and exact rank cuts without a single ordered partition.

Everything that needs a global order (curves, AUC, quantiles, stratified cuts) goes through
two levels: totals per bin (few rows, map-side combined), then a window inside each bin.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auditlens.functions.expr import hash_long, hash_unit
from auditlens.session import stored

CUT_BINS = 65536
SAMPLE_CELLS = 1000


def with_lookup(df: DataFrame, side: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join a big table to a small aggregate of unproven size.

    The aggregate is written first, so Spark knows its size before it plans the join: it is
    broadcast below ``spark.sql.autoBroadcastJoinThreshold`` and joined by shuffle (with
    AQE's skew handling) above it. The big table is not shuffled just to find out.
    """
    return df.join(stored(side, "lookup"), on, how)


TASK_ROWS = 500_000  # rows of one task where they are sorted or kept by key


def dealt(df: DataFrame, by: str, rows: int, task_rows: int = TASK_ROWS) -> DataFrame:
    """``df`` of about ``rows`` rows, hashed by ``by`` to as many partitions as keep each near ``task_rows``.

    What groups or ranks by that key afterwards moves nothing again, and the memory of a task stays the
    same however many rows there are; the session's number of partitions does not follow the table.
    """
    parts = math.ceil(rows / task_rows)
    return df if parts <= 1 else df.repartition(max(parts, df.sparkSession.sparkContext.defaultParallelism), by)


def running_totals(
    df: DataFrame, keys: list[str], bin_col: str, order_col: str, measures: list[str], descending: bool = False
) -> DataFrame:
    """Add ``cum_<m>`` (inclusive, in order) and ``tot_<m>`` (whole key) for every measure.

    ``df`` must be aggregated, one row per (keys, order_col), and ``bin_col`` a monotone
    function of ``order_col``. The largest task sorts one (keys, bin). The join is null-safe:
    NULL keys stay, and no pushed-down null filter keeps Spark from reusing the aggregate's
    shuffle for both sides.
    """
    direction = (lambda c: F.col(c).desc()) if descending else (lambda c: F.col(c).asc())
    before = Window.partitionBy(*keys).orderBy(direction(bin_col)).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    per_bin = df.groupBy(*keys, bin_col).agg(*[F.sum(m).alias(f"_s_{m}") for m in measures])
    on = [*keys, bin_col]
    offsets = per_bin.select(
        *[F.col(k).alias(f"_k_{k}") for k in on],
        *[F.coalesce(F.sum(f"_s_{m}").over(before), F.lit(0)).alias(f"_o_{m}") for m in measures],
        *[F.sum(f"_s_{m}").over(whole).alias(f"tot_{m}") for m in measures],
    )
    inside = (
        Window.partitionBy(*keys, bin_col)
        .orderBy(direction(order_col))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in on))
    return df.join(offsets, same).select(
        *df.columns,
        *[(F.col(f"_o_{m}") + F.sum(m).over(inside)).alias(f"cum_{m}") for m in measures],
        *[F.col(f"tot_{m}") for m in measures],
    )


def global_positions(df: DataFrame, order: list, out: str) -> DataFrame:
    """Add the zero-based position of every row in the given order, without one sorted task.

    Sampled splitters cut the rows into ranges of about equal size, whatever the values look like;
    a row's place in its range and the number of rows in the ranges before make its position. The
    ranges are written, so that splitters drawn anew cannot move a row between two uses. Rows that
    ``order`` does not tell apart get consecutive positions.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_order_id", F.monotonically_increasing_id())
    ranged = stored(ranged.withColumn("_range", F.shiftright("_order_id", 33)), "positions")
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    place = F.col("_before") + F.col("_order_id").bitwiseAND(F.lit((1 << 33) - 1))
    return with_lookup(ranged, offsets, ["_range"]).withColumn(out, place).drop("_order_id", "_range", "_before")


def long_values(df: DataFrame, cols: list[str], keys: list[str] = (), keep: list[str] = ()) -> DataFrame:
    """Unpivot numeric columns to (keys, keep, feature, value); missing values are left out."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in cols]
    )
    out = df.select(*keys, *keep, F.inline(pairs))
    return out.filter(F.col("value").isNotNull() & ~F.isnan("value"))


SKETCH_SIZE = 4000  # KLL parameter: rank error far below 0.1 %, 80 kB per column
STEPS = 500  # a sketch is read at so many steps; one of them is several times that error
MOST = 100_000  # distinct values that are ranked one by one inside a bracket
SALTS = 256


def _sketched(rows: DataFrame, by: list[str], inside: Column, counts: list[Column]) -> DataFrame:
    """Rows (by, counts, _d, _e): counts, and of the values inside their range, how many distinct
    ones there are, and quantiles at even steps from mergeable sketches.

    Sketches merge in two steps, so no task has to take in one per input partition.
    """
    names = [f"_c{i}" for i in range(len(counts))]
    value = F.when(inside, F.col("value"))
    parts = rows.groupBy(*by, (F.spark_partition_id() % SALTS).alias("_salt")).agg(
        *[F.sum(c.cast("long")).alias(n) for c, n in zip(counts, names)],
        F.min(value).alias("_min"),
        F.max(value).alias("_max"),
        F.hll_sketch_agg(F.when(inside, F.xxhash64("value"))).alias("_h"),
        F.kll_sketch_agg_double(value, SKETCH_SIZE).alias("_k"),
    )
    whole = parts.groupBy(*by).agg(
        *[F.sum(n).alias(n) for n in names],
        F.min("_min").alias("_min"),
        F.max("_max").alias("_max"),
        F.hll_sketch_estimate(F.hll_union_agg("_h")).alias("_d"),
        F.kll_merge_agg_double("_k").alias("_k"),
    )
    read = F.kll_sketch_get_quantile_double("_k", F.array(*[F.lit(i / STEPS) for i in range(STEPS + 1)]))
    return whole.withColumn("_e", F.when(F.col("_min").isNotNull(), read)).drop("_k")  # an empty sketch cannot be read


def _narrowed(place: Column, size: Column, most: int) -> tuple[Column, Column]:
    """Next bracket around the ``place``-th of ``size`` sketched values: one to two steps to either
    side, or the whole range if they are few."""
    at = (place + 0.5) / F.nullif(size, F.lit(0)) * STEPS
    step = lambda i: F.get("_e", F.least(F.greatest(i, F.lit(0)), F.lit(STEPS)).cast("int"))
    few = F.col("_d") <= most
    return F.when(few, F.col("_min")).otherwise(step(F.floor(at) - 1)), F.when(few, F.col("_max")).otherwise(step(F.ceil(at) + 1))


def exact_quantiles(
    df: DataFrame,
    cols: list[str],
    probs: list[float],
    keys: list[str] = (),
    most: int = MOST,
    plotting: tuple[float, float] = (1.0, 1.0),
) -> DataFrame:
    """Linearly interpolated quantiles: rows (keys, feature, n, q array<double>).

    ``plotting`` (a, b) sets the position n p + a + p (1 - a - b), counted from 1: (1, 1) is
    the usual linear rule, (0.4, 0.4) the approximately unbiased one.

    Exact selection at any size, keyed or not: ``percentile`` would gather every distinct value in
    one task. A mergeable sketch brackets each wanted rank, a pass counts exactly what lies below,
    on and between the ends and sketches anew inside, and the bracket narrows (or moves, if the
    rank lies outside) until it holds about ``most`` distinct values; only those are ranked, per
    bracket. Each round shrinks a bracket some hundred times. Ends are tested for equality on their
    own, so a value with any share of the rows ends the search. State between rounds is written: a
    recomputed sketch could move a bracket between two tasks. With keys, NULL keys are left out.
    """
    by = [*keys, "feature"]
    data = long_values(df, cols, list(keys))
    for k in keys:
        data = data.filter(F.col(k).isNotNull())
    whole = stored(_sketched(data, by, F.lit(True), [F.lit(1)]).withColumnRenamed("_c0", "n"), "sketches")
    wanted = F.array(*[F.struct(F.lit(j).alias("_j"), h.cast("long").alias("_rank")) for j, p in enumerate(probs) for h in _ranks(F.col("n"), p, plotting)])
    ranks = whole.select(*by, "n", "_min", "_max", "_d", "_e", F.inline(F.array_distinct(wanted)))
    low, high = _narrowed(F.col("_rank"), F.col("n"), most)
    found = F.when(F.col("_rank") == 0, F.col("_min")).when(F.col("_rank") == F.col("n") - 1, F.col("_max"))
    state = ranks.select(
        *by, "n", "_j", "_rank", F.col("_min").alias("_from"), F.col("_max").alias("_to"), low.alias("_a"), high.alias("_b"),
        found.alias("_value"), F.when(F.col("_d") <= most, F.lit(0).cast("long")).alias("_below"),
    )
    state = stored(state, "brackets")
    target = [*by, "n", "_j", "_rank"]
    while True:
        open_ = F.col("_value").isNull() & F.col("_below").isNull()
        todo, done = state.filter(open_), state.filter(~open_)
        if todo.isEmpty():
            break
        v, a, b = F.col("value"), F.col("_a"), F.col("_b")
        met = data.join(stored(todo, "lookup"), by).select(*target, "_from", "_to", "_a", "_b", "value")
        inside = (v > a) & (v < b)
        got = _sketched(met, [*target, "_from", "_to", "_a", "_b"], inside, [(v < a), (v == a), inside, (v == b)])
        below, on_a, between, on_b = (F.col(f"_c{i}") for i in range(4))
        place = F.col("_rank") - below - on_a
        left, on_left = F.col("_rank") < below, (F.col("_rank") < below + on_a) & (F.col("_rank") >= below)
        right, on_right = place >= between + on_b, (place >= between) & (place < between + on_b)
        here = (place >= 0) & (place < between)
        low, high = _narrowed(place, between, most)
        state = got.select(
            *target,
            F.when(here, a).when(right, b).otherwise(F.col("_from")).alias("_from"),
            F.when(here, b).when(left, a).otherwise(F.col("_to")).alias("_to"),
            F.when(here, low).when(right, b).when(left, F.col("_from")).alias("_a"),
            F.when(here, high).when(left, a).when(right, F.col("_to")).alias("_b"),
            F.when(on_left, a).when(on_right, b).alias("_value"),
            F.when(here & (F.col("_d") <= most), below + on_a).alias("_below"),
        )
        state = stored(state.unionByName(done), "brackets")
    few = state.filter(F.col("_value").isNull())
    brackets = few.select(*by, "_a", "_b").distinct()
    kept = data.join(stored(brackets, "lookup"), by).filter((F.col("value") >= F.col("_a")) & (F.col("value") <= F.col("_b")))
    counted = kept.groupBy(*by, "_a", "_b", "value").agg(F.count("*").alias("_c"))
    upto = Window.partitionBy(*by, "_a", "_b").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)  # at most about ``most`` rows
    summed = counted.withColumn("_upto", F.sum("_c").over(upto))
    place = F.col("_rank") - F.col("_below")
    hit = (F.col("_upto") - F.col("_c") <= place) & (place < F.col("_upto"))
    ranked = few.drop("_value").join(summed, [*by, "_a", "_b"]).filter(hit).select(*target, F.col("value").alias("_value"))
    values = state.filter(F.col("_value").isNotNull()).select(*target, "_value").unionByName(ranked)
    n, picks = F.col("n"), []
    for j, p in enumerate(probs):
        h = _position(n, p, plotting)
        lo, hi = (F.max(F.when((F.col("_j") == j) & (F.col("_rank") == r.cast("long")), F.col("_value"))) for r in _ranks(n, p, plotting))
        picks.append((lo + (hi - lo) * (h - F.floor(h))))
    return values.groupBy(*by, "n").agg(F.array(*picks).alias("q"))


def _ranks(rows: Column, p: float, plotting: tuple[float, float]) -> tuple[Column, Column]:
    h = _position(rows, p, plotting)
    return F.floor(h), F.ceil(h)


def _position(rows: Column, p: float, plotting: tuple[float, float]) -> Column:
    """Zero-based fractional rank of quantile ``p`` among ``rows`` values."""
    a, b = plotting
    if (a, b) == (1.0, 1.0):
        return (rows - 1) * F.lit(float(p))
    raw = rows * F.lit(float(p)) + F.lit(a + p * (1 - a - b) - 1)
    return F.least(F.greatest(raw, F.lit(0.0)), rows - 1.0)


def fit_quantiles(df: DataFrame, cols: list[str], probs: list[float], **options) -> dict[str, list[float]]:
    """Fit step: the quantiles of each column (len(cols) x len(probs) numbers reach the driver).
    A column without values yields NULLs."""
    found = {r["feature"]: r["q"] for r in exact_quantiles(df, cols, probs, **options).collect()}
    return {c: list(found.get(c, [None] * len(probs))) for c in cols}


QUARTILES = [0.0, 0.25, 0.5, 0.75, 1.0]


def bucket_index(value: Column, edges: list[float]) -> Column:
    """1-based right-closed bucket of ``value``; the lowest value is inside bucket 1.

    An edge equal to the one before it is dropped. Both sides are rounded to 9 digits.
    """
    x = F.round(value, 9)
    index = F.lit(1)
    for previous, edge in zip(edges, edges[1:-1]):
        if edge is not None and round(edge, 9) > round(previous, 9):
            index = index + (x > F.lit(round(edge, 9))).cast("int")
    return F.when(value.isNotNull(), index)


def with_quartiles(
    df: DataFrame, col: str, labels: list[str], out: str, index_out: str | None = None, edges: list[float] | None = None
) -> DataFrame:
    """Label every row with the quartile of ``col``: a fit of the edges (unless given), then a projection."""
    edges = edges or fit_quantiles(df, [col], QUARTILES)[col]
    marked = df.withColumn("_bucket", bucket_index(F.col(col).cast("double"), edges))
    names = F.array(*[F.lit(x) for x in labels])
    marked = marked.withColumn(out, F.when(F.col("_bucket").isNotNull(), F.get(names, F.col("_bucket") - 1)))
    if index_out:
        marked = marked.withColumn(index_out, F.col("_bucket"))
    return marked.drop("_bucket")


def stratified_cut(
    df: DataFrame, label: str, id_col: str, fraction: float, seed: int, out: str = "split", bins: int = CUT_BINS
) -> DataFrame:
    """Exact stratified split: in every class the ``round(fraction * n)`` rows with the
    smallest hash become 'train', the others 'test'.

    Class counts per hash bin decide all rows but those of the one bin that holds the cut;
    only that bin is ranked row by row. No row is shuffled except those.
    """
    digits = 16**13 // bins
    marked = df.withColumn("_h", hash_long(id_col, F.lit(seed))).withColumn(
        "_b", F.floor(F.col("_h") / digits).cast("int")
    )
    per_bin = marked.groupBy(label, "_b").agg(F.count("*").alias("_c"))
    before = Window.partitionBy(label).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(label)
    cuts = (
        per_bin.withColumn("_below", F.coalesce(F.sum("_c").over(before), F.lit(0)))
        .withColumn("_take", F.round(F.sum("_c").over(whole) * F.lit(fraction)).cast("long"))
        .filter((F.col("_below") < F.col("_take")) & (F.col("_take") <= F.col("_below") + F.col("_c")))
        .select(label, F.col("_b").alias("_cut"), (F.col("_take") - F.col("_below")).alias("_rest"))
    )
    joined = with_lookup(marked, cuts, [label], "left")
    within = Window.partitionBy(label, "_b").orderBy("_h", id_col)
    edge = (
        joined.filter(F.col("_b") == F.col("_cut"))
        .withColumn("_rank", F.row_number().over(within))
        .withColumn(out, F.when(F.col("_rank") <= F.col("_rest"), "train").otherwise("test"))
        .drop("_rank")
    )
    clear = joined.filter(F.col("_cut").isNull() | (F.col("_b") != F.col("_cut"))).withColumn(
        out, F.when(F.col("_b") < F.col("_cut"), "train").otherwise("test")
    )
    return clear.unionByName(edge).drop("_h", "_b", "_cut", "_rest")


def hash_sample(df: DataFrame, id_col: str, n: int, seed: int) -> DataFrame:
    """Reproducible sample of ``n`` rows without replacement: the smallest hashes win.

    Counts per hash cell decide all rows but those of the one cell that holds the cut, and only
    that cell is ranked. Cells reach as far as the sample should by the number of rows, with room to
    spare; if that is short after all, they reach on. A task sends its share of the sample.
    """
    marked = df.withColumn("_h", hash_unit(id_col, F.lit(seed)))
    total = df.count()
    if total <= n:
        return df
    reach = (n + 6 * n**0.5 + 10) / total
    while True:
        reach = min(1.0, reach)
        width = reach / SAMPLE_CELLS
        near = marked.filter(F.col("_h") <= reach) if reach < 1 else marked
        cell = F.floor(F.col("_h") / width).cast("int")
        counts = sorted((r["_cell"], r["n"]) for r in near.groupBy(cell.alias("_cell")).agg(F.count("*").alias("n")).collect())
        if sum(c for _, c in counts) >= n:
            break
        reach *= 2
    below, cut = 0, 0
    for cut, c in counts:
        if below + c >= n:
            break
        below += c
    order = Window.orderBy("_h", id_col)  # the rows of one cell
    edge = near.filter(cell == cut).withColumn("_nth", F.row_number().over(order)).filter(F.col("_nth") <= n - below)
    return near.filter(cell < cut).unionByName(edge.drop("_nth")).drop("_h")
