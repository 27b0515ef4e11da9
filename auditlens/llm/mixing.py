"""Mixing sources to target weights by min-cost flow.

Documents are added up by membership pattern (the set of sources that claim them), so the flow
network has one node per pattern and one per source, whatever the number of documents. A
pattern gives its words once at no cost, and each further repetition at a rising cost (convex,
so early repetitions are used up first); sources take up to their quotas. What the flow takes
from a pattern is then taken from its documents: whole passes over all of them, and a last
partial pass over the documents that come first in a seeded order. The end of that pass is
found on sums over ranges of the order, refined twice, never by sorting a source.

Defined results: a null text has size 0 and is taken 0 words of; a null source is a source of
its own, last in order; sizes that add to 0 give targets 0; rows with the same doc_id share
their place in the order and are taken alike; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from auditlens.llm.packed import stored, thrifty, tuned
from auditlens.llm.text import column_bytes, slices, word_spans

# Weights of the sources in their order, repeating; the limit of repetition.
WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
SEED = "mix-1"
BITS, LEVEL_BITS = 60, 12
SALTS = 64


def source_targets(sizes: dict[str | None, int], weights=WEIGHTS, most: int = MAX_REPEAT) -> dict[str | None, float]:
    """Shares of all words by weight; what a source cannot hold (``most`` times its size) goes
    to the others by weight."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, total_weight, targets = float(sum(sizes.values())), sum(weight.values()), {}
    for s in sorted(names, key=lambda s: (most * sizes[s] / weight[s], s is None, s or "")):
        level = left / total_weight
        targets[s] = min(level * weight[s], float(most * sizes[s]))
        if targets[s] < level * weight[s]:  # a full source leaves the sharing
            left, total_weight = left - targets[s], total_weight - weight[s]
    return targets


def route(patterns: dict[tuple, int], quotas: dict, most: int = MAX_REPEAT) -> dict[tuple, dict]:
    """Words from each pattern to each of its sources: a min-cost flow that fills the quotas.

    Successive cheapest augmenting paths. Pass k over a pattern costs k - 1 a word.
    """
    names = list(patterns)
    members = {s: [p for p in names if s in p] for s in quotas}
    taken = {p: 0 for p in names}
    flow: dict[tuple, dict] = {p: dict.fromkeys(p, 0) for p in names}

    def pass_of(p):  # (cost of the next word, words left at that cost)
        k = taken[p] // patterns[p] if patterns[p] else most
        return (k, patterns[p] * (k + 1) - taken[p]) if k < most else (None, 0)

    for source in sorted(quotas, key=lambda s: (len(members[s]), s is None, s or "")):
        need = quotas[source]
        while need > 0:
            # cheapest way to give one more word to `source`: through patterns, taking words
            # over from other sources, which are made good from patterns of theirs
            best, back, heap, order = {source: 0}, {}, [(0, 0, source)], 1
            found = None
            while heap:
                cost, _, s = heapq.heappop(heap)
                if cost > best[s] or (found is not None and cost >= found[0]):
                    continue
                for p in members[s]:
                    step, room = pass_of(p)
                    if step is not None and (found is None or cost + step < found[0]):
                        found = (cost + step, room, s, p)
                    for t in p:
                        if t != s and flow[p][t] > 0 and cost < best.get(t, np.inf):
                            best[t], back[t] = cost, (s, p)
                            heapq.heappush(heap, (cost, order, t))
                            order += 1
            if found is None:
                break
            _, amount, s, p = found
            amount = min(amount, need)
            path, t = [], s
            while t != source:
                prior, via = back[t]
                path.append((via, t, prior))
                t = prior
            amount = min([amount, *(flow[via][t] for via, t, _ in path)])
            taken[p] += amount
            flow[p][s] += amount
            for via, t, prior in path:
                flow[via][t] -= amount
                flow[via][prior] += amount
            need -= amount
    return flow


def _sized(docs: DataFrame, sources: str) -> DataFrame:
    """doc_id, sources, size and place in the seeded order."""

    def count(batches):
        for batch in batches:
            data, offsets = column_bytes(batch.column(2))
            n = [np.zeros(0, np.int64)]
            for lo, hi in slices(offsets):
                _, _, rows = word_spans(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                n.append(np.diff(rows))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.concatenate(n))], ["doc_id", "pattern", "size"])

    keyed = docs.select(F.col("doc_id").cast("long"), F.to_json(F.array_sort(F.array_distinct(sources)), {"ignoreNullFields": "false"}).alias("pattern"), "text")
    sized = keyed.mapInArrow(thrifty(count), "doc_id long, pattern string, size long")
    return sized.withColumn("place", place(F.col("doc_id")))


def place(doc_id):
    """60 bits of a digest of seed and id: the seeded order."""
    digest = F.md5(F.concat(F.lit(SEED + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, BITS // 4), 16, 10).cast("long")


def _met(rows: DataFrame, todo: DataFrame) -> DataFrame:
    """Rows with what is to be done for their pattern; a source of very many rows is split."""
    salt = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))
    return rows.withColumn("salt", F.pmod("place", F.lit(SALTS))).join(todo.withColumn("salt", salt), ["pattern", "salt"])


def _ends(sized: DataFrame, rest: list[tuple[str, int]]) -> DataFrame:
    """(pattern, end): the last pass of a pattern takes the places below ``end``."""
    spark = sized.sparkSession
    todo = spark.createDataFrame(rest or [], "pattern string, rest long").withColumn("before", F.lit(0).cast("long")).withColumn("prefix", F.lit(0).cast("long"))
    rows = sized.filter("size > 0")
    for level in (1, 2):
        shift = BITS - level * LEVEL_BITS
        cell = F.shiftright("place", shift)
        inside = _met(rows, todo).filter(F.shiftright(cell, LEVEL_BITS) == F.col("prefix"))
        sums = inside.groupBy("pattern", "rest", "before", cell.alias("cell")).agg(F.sum("size").alias("n"))
        upto = F.sum("n").over(Window.partitionBy("pattern").orderBy("cell"))
        sums = sums.withColumn("upto", F.col("before") + upto)
        # the cell in which the rest is reached (the last one if it never is)
        todo = sums.groupBy("pattern", "rest").agg(
            F.coalesce(F.min_by(F.struct("cell", (F.col("upto") - F.col("n")).alias("b")), F.when(F.col("upto") >= F.col("rest"), F.col("cell"))),
                       F.max_by(F.struct("cell", (F.col("upto") - F.col("n")).alias("b")), "cell")).alias("x")
        ).select("pattern", "rest", F.col("x.b").alias("before"), F.col("x.cell").alias("prefix"))
        todo = stored(todo, "mix-cells")
    last = _met(rows, todo).filter(F.shiftright("place", BITS - 2 * LEVEL_BITS) == F.col("prefix"))
    units = last.groupBy("pattern", "rest", "before", "place").agg(F.sum("size").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("pattern").orderBy("place")) + F.col("before")
    # a document is taken if more than half of it lies before the end
    taken = 2 * upto - F.col("n") <= 2 * F.col("rest")
    inner = units.withColumn("taken", taken).groupBy("pattern").agg(F.max(F.when(F.col("taken"), F.col("place") + 1)).alias("end"))
    cell = F.shiftleft(F.col("prefix"), BITS - 2 * LEVEL_BITS)
    return todo.select("pattern", cell.alias("start")).join(inner, "pattern", "left").select("pattern", F.coalesce("end", "start").alias("end"))


def mix_documents(docs: DataFrame, sources: str = "sources", weights=WEIGHTS, most: int = MAX_REPEAT) -> DataFrame:
    """doc_id, pattern, size, taken, place of every row of ``docs`` (doc_id, text, an array column
    of sources), and beside it the tables of the plan."""
    return _mixed(docs, sources, weights, most)[0]


def _mixed(docs: DataFrame, sources: str, weights=WEIGHTS, most: int = MAX_REPEAT):
    spark = tuned(docs.sparkSession)
    sized = stored(_sized(docs, sources), "mix-sizes")
    patterns = {p: int(n) for p, n in sized.groupBy("pattern").agg(F.sum("size")).collect()}
    members = {p: tuple(json.loads(p)) for p in patterns if p is not None}
    sizes: dict = {}
    for p, own in members.items():
        for s in own:
            sizes[s] = sizes.get(s, 0) + patterns[p]
    targets = source_targets(sizes, weights, most)
    quotas = {s: int(np.floor(t + 0.5)) for s, t in targets.items()}
    flow = route({own: patterns[p] for p, own in members.items()}, quotas, most)
    plan, rest = [], []
    for p, own in members.items():
        words = sum(flow[own].values())
        passes = words // patterns[p] if patterns[p] else 0
        plan.append((p, passes))
        rest.append((p, words - passes * patterns[p]))
    passes = spark.createDataFrame(plan or [], "pattern string, passes long").join(_ends(sized, rest), "pattern", "left")
    passes = stored(passes, "mix-plan")
    repeats = F.coalesce("passes", F.lit(0)) + (F.col("place") < F.coalesce("end", F.lit(0))).cast("long")
    mixed = sized.join(passes, "pattern", "left").select("doc_id", "pattern", "size", "place", repeats.alias("repeats"))
    return mixed.withColumn("taken", F.col("size") * F.col("repeats")), members, sizes, targets, passes


def mix_by_source(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken of documents with one ``source`` each."""
    mixed, members, sizes, targets, _ = _mixed(docs.withColumn("__mix_sources", F.array("source")), "__mix_sources")
    rows = [(pattern, sizes[s], round(targets[s], 6)) for pattern, (s,) in members.items()]  # patterns as Spark wrote them
    table = docs.sparkSession.createDataFrame(rows or [], "pattern string, source_size long, target double")
    return mixed.join(table, "pattern", "left").select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` as the mix takes them: left out, once, or repeated."""
    *_, passes = _mixed(docs.withColumn("__mix_sources", F.array("source")), "__mix_sources")
    pattern = F.to_json(F.array("source"), {"ignoreNullFields": "false"})
    kept = docs.withColumns({"__mix_pattern": pattern, "__mix_place": place(F.col("doc_id").cast("long"))})
    kept = kept.join(passes.withColumnsRenamed({"pattern": "__mix_pattern", "passes": "__mix_passes", "end": "__mix_end"}), "__mix_pattern", "left")
    repeats = F.coalesce("__mix_passes", F.lit(0)) + (F.col("__mix_place") < F.coalesce("__mix_end", F.lit(0))).cast("long")
    return kept.select(*docs.columns, F.explode(F.sequence(F.lit(1), F.greatest(repeats, F.lit(1)))).alias("__mix_copy"), repeats.alias("__mix_repeats")).filter("__mix_repeats > 0").select(*docs.columns)


ORACLE_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         ('0x' || substr(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, {BITS // 4}))::BIGINT AS place
  FROM documents),
named AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM sized GROUP BY source),
levels AS (
  SELECT *, row_number() OVER (ORDER BY {MAX_REPEAT} * source_size / w, source IS NULL, source) AS rk,
         (sum(source_size) OVER () - coalesce(sum({MAX_REPEAT} * source_size) OVER before, 0))::DOUBLE
            / (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS level
  FROM named
  WINDOW before AS (ORDER BY {MAX_REPEAT} * source_size / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
shared AS (
  SELECT source, source_size, w,
         (SELECT level FROM levels WHERE level * w <= {MAX_REPEAT} * source_size ORDER BY rk LIMIT 1) AS level FROM levels),
targets AS (
  SELECT source, source_size, least(level * w, {MAX_REPEAT} * source_size::DOUBLE) AS target FROM shared),
plans AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target + 0.5) AS BIGINT) // source_size ELSE 0 END AS passes,
         CASE WHEN source_size > 0 THEN CAST(floor(target + 0.5) AS BIGINT) % source_size ELSE 0 END AS rest FROM targets),
ordered AS (
  SELECT s.*, p.source_size, p.target, p.passes, p.rest,
         sum(size) OVER (PARTITION BY s.source ORDER BY place ROWS UNBOUNDED PRECEDING) AS upto
  FROM sized s JOIN plans p ON s.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, round(target, 6) AS target,
       CAST(size * (passes + CASE WHEN size > 0 AND 2 * upto - size <= 2 * rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM ordered
"""
