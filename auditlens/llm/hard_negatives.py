"""Hard negatives of anchors by slot-decomposed selection.

Every anchor has positives, its best-scoring rows of the same label, and each positive wants the best
rows of other labels inside a window of scores below its own. The windows of one anchor overlap, but
the positives' scores (the upper limits) cut the axis into disjoint slots. Tasks keep the first k
rows of every slot, lists merge by (anchor, slot), and a pass from the lowest slot to the highest
merges each slot with what lies below it: after slot i it holds the first k rows of all scores up to
the limit i, from which the window's lower limit only cuts a tail. So one scan answers all windows.

The stated anchors meet all rows in blocks: rows go to groups by id, anchors to blocks of
``ANCHOR_ROWS``, and a cell of one group and one block streams the rows past the anchors, with only
k rows per anchor and slot in memory. Scores are integers: the products are taken in doubles where
width and largest component keep them exact, in 64-bit integers otherwise (a score must fit a long).

Defined results: rows without id, label or vector, or with a null or non-finite component take no
part; shorter vectors count as filled up with zeros; for one anchor, rows of one id with equal score
count once, so repeated rows change nothing; an anchor repeated with another vector is an anchor of
its own; a row of the anchor's id is never its positive or negative; an empty table or no anchors
give an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auditlens.llm.packed import row_blocks, stored, tuned, unpack

SCALE = 256
ANCHOR_ROWS = 32_768
GROUP_ROWS = 1 << 20
LEAST_GROUP_ROWS, SPREAD = 4_096, 16
TILE = 1 << 20
FOUND_DDL = "anchor_id long, content long, slot int, score long, vec_id long"


def scored_rows(vectors: DataFrame, label: Column) -> DataFrame:
    """vec_id, label, x (integers) of the rows that take part."""
    fine = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    whole = F.transform("embedding", lambda v: F.floor(v.cast("double") * SCALE).cast("long"))
    rows = vectors.filter(F.col("vec_id").isNotNull() & label.isNotNull() & F.col("embedding").isNotNull() & fine)
    return rows.select(F.col("vec_id").cast("long"), label.cast("long").alias("label"), whole.alias("x"))


def _matrix(column: pa.ChunkedArray, width: int, kind) -> np.ndarray:
    lists = column.combine_chunks()
    size, flat = lists.value_lengths().to_numpy(zero_copy_only=False), lists.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lists), width), kind)
    out[np.arange(width) < size[:, None]] = flat
    return out


def lowest(kind):
    return -np.inf if kind is np.float64 else np.iinfo(kind).min


class _Best:
    """The first k (score descending, id ascending) of every (anchor, slot) so far."""

    def __init__(self, anchors: int, slots: int, k: int, kind):
        self.k, self.slots, self.least = k, slots, np.full(anchors * slots, lowest(kind))
        self.rows = [np.zeros(0, np.int64), np.zeros(0, kind), np.zeros(0, np.int64)]
        self.waiting, self.size = [], 0

    def add(self, anchor: np.ndarray, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        at = anchor * self.slots + slot
        near = score >= self.least[at]
        self.waiting.append((at[near], score[near], ids[near]))
        self.size += int(near.sum())
        if self.size > TILE // 4:
            self.settle()

    def settle(self) -> None:
        at, score, ids = (np.concatenate(c) for c in zip(self.rows, *self.waiting))
        order = np.lexsort((ids, -score, at))
        at, score, ids = at[order], score[order], ids[order]
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1]) | (score[1:] != score[:-1]) | (ids[1:] != ids[:-1])
        at, score, ids = at[new], score[new], ids[new]
        place = np.arange(len(at)) - np.searchsorted(at, at)
        self.least[at[place == self.k - 1]] = score[place == self.k - 1]
        kept = place < self.k
        self.rows, self.waiting, self.size = [at[kept], score[kept], ids[kept]], [], 0


def _search(width: int, exact: bool, k: int, limits: int):
    """Scan of cells in order, anchors before rows. ``limits`` 0: rows of the same label, one slot;
    otherwise rows of other labels in slots below the anchors' limits."""
    kind = np.float64 if exact else np.int64

    def scan(batches):
        cell, anchors, best = None, [], None

        def found():
            if best is not None:
                best.settle()
                at, score, ids = best.rows
                row, slot = at // best.slots, at % best.slots
                columns = [table["vec_id"][row], table["content"][row], slot.astype(np.int32), score.astype(np.int64), ids]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [c.split()[0] for c in FOUND_DDL.split(", ")])

        for batch in batches:
            for here, is_row, block in zip(*(batch.column(c) for c in ("cell", "is_row", "block"))):
                if here.as_py() != cell:
                    yield from found()
                    cell, anchors, best = here.as_py(), [], None
                if not is_row.as_py():
                    anchors.append(block)
                    continue
                if not anchors:  # a block without anchors
                    continue
                if best is None:
                    got = unpack(anchors)
                    table = {c: got.column(c).to_numpy() for c in ("vec_id", "label", "content")}
                    table["x"] = _matrix(got.column("x"), width, kind)
                    if limits:
                        upper = got.column("limits").combine_chunks()
                        size = upper.value_lengths().to_numpy(zero_copy_only=False)
                        table["upper"] = np.full((len(size), limits), lowest(kind))
                        table["upper"][np.arange(limits) < size[:, None]] = upper.flatten().to_numpy(zero_copy_only=False)
                        table["low"] = np.array([-(-4 * min(v) // 5) for v in upper.to_pylist()], kind)
                    best = _Best(len(table["label"]), limits or 1, k, kind)
                rows = unpack([block])
                ids, label, x = rows.column("vec_id").to_numpy(), rows.column("label").to_numpy(), _matrix(rows.column("x"), width, kind)
                step = max(1, TILE // len(table["label"]))
                for lo in range(0, len(ids), step):
                    score = table["x"] @ x[lo : lo + step].T
                    same = table["label"][:, None] == label[lo : lo + step]
                    if limits:
                        wanted = ~same & (score >= table["low"][:, None]) & (score <= table["upper"][:, :1])
                    else:
                        wanted = same & (score >= best.least[:, None])
                    wanted &= table["vec_id"][:, None] != ids[lo : lo + step]
                    anchor, at = np.nonzero(wanted)
                    if len(anchor):
                        hit = score[anchor, at]
                        slot = (table["upper"][anchor] >= hit[:, None]).sum(1) - 1 if limits else 0
                        best.add(anchor, slot, hit, ids[lo + at])
        yield from found()

    return scan


def _first(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return rows.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _merged(k: int):
    """Windows of every anchor: its slots merged from the lowest upwards."""

    def merge(batches):
        for batch in batches:
            out = []
            for anchor, positives, kept in zip(*(batch.column(c).to_pylist() for c in ("anchor_id", "positives", "kept"))):
                slots = [[] for _ in positives]
                for row in kept:
                    slots[row["slot"]].append((-row["score"], row["vec_id"]))
                below: list[tuple[int, int]] = []
                for i in range(len(positives) - 1, -1, -1):
                    below = sorted(slots[i] + below)[:k]
                    score, chosen = positives[i]["score"], positives[i]["vec_id"]
                    inside = [(-s, v) for s, v in below if -100 * s >= 80 * score]
                    out += [(anchor, chosen, rank, v, score, s) for rank, (s, v) in enumerate(inside, 1)]
            yield pa.RecordBatch.from_pylist([dict(zip(MINED.names, r)) for r in out], MINED)

    return merge


MINED = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("rank", pa.int32()), ("negative_id", pa.int64()),
                   ("positive_score", pa.int64()), ("negative_score", pa.int64())])
MINED_DDL = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mined(vectors: DataFrame, anchors: Column, label: Column, k: int = 5) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id and both scores, for the rows that the condition
    ``anchors`` on vec_id chooses; ``label`` is an expression over ``vectors``."""
    tuned(vectors.sparkSession)
    rows = scored_rows(vectors, label)
    content = F.xxhash64("label", "x").alias("content")
    asked = stored(rows.filter(anchors).select("vec_id", "label", "x", content).distinct(), "anchors")
    shape = rows.agg(F.count("*"), F.max(F.size("x")), F.max(F.coalesce(F.array_max(F.transform("x", F.abs)), F.lit(0)))).first()
    n, width, largest = shape[0], max(1, shape[1] or 0), shape[2] or 0
    exact = width * largest * largest < 1 << 53
    groups = max(1, -(-n // GROUP_ROWS), min(SPREAD, -(-n // LEAST_GROUP_ROWS)))
    blocks = stored(row_blocks(rows, groups), "rows")

    def scan(chosen: DataFrame, slots: int) -> DataFrame:
        spread = max(1, -(-chosen.count() // ANCHOR_ROWS))
        every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
        left = row_blocks(chosen, spread).select(F.col("part").alias("a"), every(groups).alias("r"), F.lit(False).alias("is_row"), "block")
        right = blocks.select(every(spread).alias("a"), F.col("part").alias("r"), F.lit(True).alias("is_row"), "block")
        cells = left.unionByName(right).select((F.col("a").cast("long") * groups + F.col("r")).alias("cell"), "is_row", "block")
        cells = cells.repartition(groups * spread, "cell").sortWithinPartitions("cell", "is_row")
        return cells.mapInArrow(_search(width, exact, k, slots), FOUND_DDL)

    key = ["anchor_id", "content"]
    positives = stored(_first(scan(asked, 0), key, k), "positives").filter("score >= 0")  # below 0 the window is empty
    lists = positives.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("rank", "score", "vec_id"))).alias("positives"))
    limits = lists.select(F.col("anchor_id").alias("vec_id"), "content", F.col("positives.score").alias("limits"))
    limited = stored(asked.join(limits, ["vec_id", "content"]), "limits")
    negatives = _first(scan(limited, k), [*key, "slot"], k)
    kept = negatives.groupBy(*key).agg(F.collect_list(F.struct("slot", "score", "vec_id")).alias("kept"))
    return kept.join(lists, key).select("anchor_id", "positives", "kept").mapInArrow(_merged(k), MINED_DDL)


ORACLE_SQL = """
WITH part AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * v::DOUBLE) FOR v IN embedding] AS x
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([v FOR v IN embedding IF v IS NULL OR isnan(v) OR isinf(v)]) = 0
), met AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same,
    list_inner_product(a.x, b.x)::BIGINT AS score
  FROM part a JOIN part b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), positive AS (
  SELECT anchor_id, vec_id, score FROM met WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
  n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positive p JOIN met n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) <= 5
"""
