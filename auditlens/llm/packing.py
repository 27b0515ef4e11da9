"""Packing of documents into sequences of a fixed number of tokens by minimum bin slack.

A document is the ids of its text and an end id. One longer than a sequence is cut into pieces of
full length, of which the first may be shorter. Only the lengths of pieces matter to the packing,
and there are at most as many of them as a sequence has tokens, so the plan is made from one count
per length: the largest piece left opens a sequence, a subset-sum over the lengths still at hand
(one bit per sum, one layer of bits per length, each length as often as it is at hand) finds the
fullest combination that goes with it, and that combination is taken as often as the counts allow.
While it is feasible it stays the fullest, for the choice only shrinks; each time some length runs
short, so there are some thousand steps whatever the number of documents.

Pieces are numbered within their length without a sort: each task numbers its own, and counts per
(task, length) give the offset. The plan gives ranges of these numbers their sequences. The result
is written between, so a task that runs again changes nothing.

Ids are those of the byte-level merges in a rank file (byte strings by rank), split by its pattern.

Defined results: a null or empty text is the end id alone; equal rows are packed each; a null doc_id
stays; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import zlib

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from auditlens.llm.packed import stored, tuned

SEQUENCE = 1024
END = 2
_RANK_BITS = 48

PIECE_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, place long"


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, end) of the pieces of a document of ``n`` tokens."""
    first = n - (-(-n // size) - 1) * size
    edges = [0, *range(first, n + 1, size)]
    return list(zip(edges, edges[1:]))


def _layer(below: int, length: int, times: int, mask: int) -> int:
    """Sums that are reachable with up to ``times`` more pieces of ``length``."""
    step = 1
    while times > 0:
        below |= below << (length * min(step, times))
        times, step = times - step, step * 2
    return below & mask


def plan(counts: dict[int, int], size: int) -> list[tuple[dict[int, int], int]]:
    """(pieces per length of a sequence, number of such sequences), the fullest combinations first
    for the largest piece that is left."""
    lengths, mask = sorted(counts), (1 << (size + 1)) - 1
    left = [counts[x] for x in lengths]
    layers, valid, steps = [1] + [0] * len(lengths), 0, []

    def settle(upto: int) -> None:
        nonlocal valid
        for i in range(valid, upto):
            layers[i + 1] = _layer(layers[i], lengths[i], min(left[i], size // lengths[i]), mask)
        valid = max(valid, upto)

    for top in range(len(lengths) - 1, -1, -1):
        while left[top]:
            settle(top)
            seed = lengths[top]
            room, times = size - seed, min(left[top] - 1, size // seed - 1)
            sums = _layer(layers[top], seed, times, mask) & ((1 << (room + 1)) - 1)
            rest = sums.bit_length() - 1
            taken = {}
            for i in range(top, -1, -1):
                if not rest:
                    break
                most = min(times if i == top else left[i], rest // lengths[i])
                k = next(k for k in range(most, -1, -1) if layers[i] >> (rest - k * lengths[i]) & 1)
                if k:
                    taken[i], rest = k, rest - k * lengths[i]
            taken[top] = taken.get(top, 0) + 1
            runs = min(left[i] // k for i, k in taken.items())
            for i, k in taken.items():
                before = min(left[i], size // lengths[i])
                left[i] -= k * runs
                if min(left[i], size // lengths[i]) != before:
                    valid = min(valid, i)
            steps.append(({lengths[i]: k for i, k in taken.items()}, runs))
    return steps


def ranges(steps: list[tuple[dict[int, int], int]]) -> dict[str, np.ndarray]:
    """The plan as ranges of (length, number within the length), in their order."""
    used: dict[int, int] = {}
    rows, base = [], 0
    for pieces, runs in steps:
        offset = 0
        for length, times in sorted(pieces.items(), reverse=True):
            first = used.get(length, 0)
            rows.append(((length << _RANK_BITS) + first, base, times, offset))
            used[length] = first + times * runs
            offset += length * times
        base += runs
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return dict(zip(("first", "base", "times", "offset"), table.T.copy()))


def pieces(docs: DataFrame, ranks: str, pattern: str, special: dict[str, int], size: int = SEQUENCE, end: int = END, keep_ids: bool = False) -> DataFrame:
    """Pieces of every row of ``docs`` (doc_id, text), numbered per task and length; with
    ``keep_ids`` also their ids."""
    spark = tuned(docs.sparkSession)
    with open(ranks, "rb") as f:
        source = spark.sparkContext.broadcast(f.read())  # the vocabulary of one tokenizer

    def encode(batches):
        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, source.value.splitlines())}
        encoder = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=merges, special_tokens=special)
        part, seen = TaskContext.get().partitionId(), np.zeros(size + 1, np.int64)
        for batch in batches:
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                tokens = np.array([*encoder.encode(text or "", allowed_special="all"), end], "<u4")
                for j, (a, b) in enumerate(cut(len(tokens), size)):
                    row.append(i)
                    piece.append(j)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(tokens[a:b].tobytes()))
                    if keep_ids:
                        ids.append(tokens[a:b].astype(np.int32))
            lengths = np.array(length, np.int64)
            order = np.argsort(lengths, kind="stable")
            first = np.searchsorted(lengths[order], lengths[order])
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order)) - first
            place += seen[lengths]
            seen += np.bincount(lengths, minlength=size + 1)
            columns = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(lengths),
                       pa.array(crc, pa.int64()), pa.array(np.full(len(row), part, np.int32)), pa.array(place)]
            if keep_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names)

    ddl = PIECE_DDL + (", ids array<int>" if keep_ids else "")
    names = [c.split()[0] for c in ddl.split(", ")]
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(encode, ddl)


def packed(cuts: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """``cuts`` (as from ``pieces``) with sequence_id and offset in place of part and place."""
    cuts = stored(cuts, "pieces")
    per_task = stored(cuts.groupBy("part", "length").agg(F.count("*").alias("n")), "lengths")
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # one row per length
    found = cuts.sparkSession.sparkContext.broadcast(ranges(plan(counts, size)))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_task.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    columns = [c for c in cuts.columns if c not in ("part", "place")]
    numbered = cuts.join(stored(offsets, "offsets"), ["part", "length"]).select(*columns, (F.col("place") + F.col("before")).alias("number"))
    wanted = [*columns, "sequence_id", "offset"]

    def settle(batches):
        table = found.value
        for batch in batches:
            length, number = (batch.column(c).to_numpy() for c in ("length", "number"))
            code = (length << _RANK_BITS) + number
            at = np.searchsorted(table["first"], code, "right") - 1
            nth = code - table["first"][at]
            sequence, slot = table["base"][at] + nth // table["times"][at], nth % table["times"][at]
            arrays = [batch.column(c) for c in columns] + [pa.array(sequence), pa.array(table["offset"][at] + slot * length)]
            yield pa.RecordBatch.from_arrays(arrays, wanted)

    kinds = {f.name: f.dataType.simpleString() for f in cuts.schema.fields}
    return numbered.mapInArrow(settle, ", ".join([*(f"{c} {kinds[c]}" for c in columns), "sequence_id long", "offset long"]))


def sequences(placed: DataFrame) -> DataFrame:
    """sequence_id, n_tokens, ids and the documents in it, from packed pieces that keep their ids."""
    row = F.struct("offset", "doc_id", "piece", "start", "length", "ids")
    inside = placed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(row)).alias("all"))
    parts = F.transform("all", lambda p: F.struct(p["doc_id"].alias("doc_id"), p["piece"].alias("piece"), p["start"].alias("start"), p["length"].alias("length")))
    ids = F.flatten(F.transform("all", lambda p: p["ids"]))
    return inside.select("sequence_id", F.size(ids).alias("n_tokens"), ids.alias("ids"), parts.alias("documents"))
