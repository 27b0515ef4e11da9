"""Quality rules: base counts of each text, and a hashed n-gram log-likelihood ratio.

Two multinomials over hashed byte n-grams are counted: one over the trusted target (documents
that ``labels`` marks with quality 1), one over the whole raw corpus. A document's verdict is
its mean log ratio per n-gram against a fixed threshold, so every document is judged alike
and reruns agree.

Defined results: a null or empty text has zero counts, fails the base rule and is not kept;
repeated rows get equal rows; without trusted documents every log ratio is 0 and the verdict
is True; a text shorter than one n-gram has a mean log ratio of 0; columns beyond the named
ones are ignored by ``quality_scores`` and kept by ``quality_filter``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlens.llm.packed import BLOCK_DDL, scatter, thrifty, thrifty_group, tuned, unpack
from auditlens.llm.text import column_bytes, mix, running, slices, span_hash, window_hash, word_hashes

NGRAM = 3
BUCKETS = 1 << 16
THRESHOLD = -0.3
SMOOTHING = 0.5
MIN_WORDS = 50
# The characters that count as symbols.
SYMBOLS = b"#*$%&|<>"

_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[list(SYMBOLS)] = 1

SCORES_DDL = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, mean_log_ratio double"
)


def _buckets(data: np.ndarray, offsets: np.ndarray, n: int, buckets: int):
    """Bucket of each n-gram inside one text, and the row it belongs to."""
    h = (window_hash(running(data), n) % np.uint64(buckets)).astype(np.int64)
    lengths = np.maximum(np.diff(offsets) - n + 1, 0)
    row = np.repeat(np.arange(len(lengths)), lengths)
    at = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(offsets[:-1], lengths)
    return h[at], row


def sliced(column: pa.Array):
    """(bytes, offsets from 0) of the runs of rows of a text column."""
    data, offsets = column_bytes(column)
    for lo, hi in slices(offsets):
        yield data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]


COUNT = pa.schema([("bucket", pa.int64()), ("n", pa.int64())])
RANGE = 4096


def bucket_counts(docs: DataFrame, n: int = NGRAM, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over all texts; each task adds up, and sends one block per range of buckets."""

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part, at in sliced(batch.column(0)):
                h, _ = _buckets(part, at, n, buckets)
                total += np.bincount(h, minlength=buckets)
        hit = np.flatnonzero(total)
        yield from scatter(iter([((hit // RANGE).astype(np.int32), pa.Table.from_arrays([pa.array(hit), pa.array(total[hit])], schema=COUNT))]))

    def add(group: pa.Table) -> pa.Table:
        rows = unpack(group.column("block"))
        return rows.group_by("bucket").aggregate([("n", "sum")]).rename_columns(["bucket", "n"]).cast(COUNT)

    return docs.select("text").mapInArrow(thrifty(count), BLOCK_DDL).groupBy("part").applyInArrow(thrifty_group(add), "bucket long, n long")


def log_ratios(trusted: DataFrame, corpus: DataFrame, n: int = NGRAM, buckets: int = BUCKETS) -> np.ndarray:
    """Smoothed log ratio of each bucket: ``buckets`` values, whatever the input."""

    def dense(counts: DataFrame) -> np.ndarray:
        out = np.zeros(buckets)
        for bucket, k in counts.collect():
            out[bucket] = k
        return out

    target, raw = dense(bucket_counts(trusted, n, buckets)), dense(bucket_counts(corpus, n, buckets))
    if not target.sum():
        return np.zeros(buckets)
    share = lambda c: np.log((c + SMOOTHING) / (c.sum() + SMOOTHING * buckets))
    return share(target) - share(raw)


def _dup_lines(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text, per text."""
    breaks = np.flatnonzero(data == 10)
    row = np.searchsorted(offsets, breaks, "right") - 1
    start = np.concatenate([offsets[:-1], breaks + 1])
    end = np.concatenate([breaks, offsets[1:]])
    row = np.concatenate([np.arange(len(offsets) - 1), row])
    order = np.lexsort((start, row))
    start, row = start[order], row[order]
    end = np.sort(end)
    solid = np.concatenate([[0], np.cumsum((data != 32) & ((data < 9) | (data > 13)))])
    keep = solid[end] > solid[start]
    start, end, row = start[keep], end[keep], row[keep]
    sums = running(data)
    key = span_hash(sums, start, end)
    order = np.lexsort((key, row))
    same = (np.diff(key[order]) == 0) & (np.diff(row[order]) == 0)
    return np.bincount(row[order][1:][same], minlength=len(offsets) - 1)


def _repeat_words(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Words inside 3-word windows that stand twice or more in their text, per text."""
    n = len(hashes)
    row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    if n < 3:
        return np.zeros(len(rows) - 1, np.int64)
    base = np.uint64(0x9E3779B97F4A7C15)
    key = mix(((hashes[:-2] * base + hashes[1:-1]) * base + hashes[2:]) ^ mix(row[:-2].astype(np.uint64)))
    inside = np.flatnonzero(row[:-2] == row[2:])
    order = inside[np.argsort(key[inside], kind="stable")]
    same = np.diff(key[order]) == 0
    again = np.zeros(n + 3, bool)
    twice = np.concatenate([order[1:][same], order[:-1][same]])
    for j in range(3):
        again[twice + j] = True
    return np.bincount(row[again[:n]], minlength=len(rows) - 1)


def text_counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The base counts of consecutive texts."""
    hashes, start, end, rows = word_hashes(data, offsets, lower=False)
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    word_points = np.concatenate([[0], np.cumsum(points[end] - points[start])])
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[data])])
    return {
        "n_words": np.diff(rows),
        "word_chars": np.diff(word_points[rows]),
        "n_symbols": np.diff(symbols[offsets]),
        "n_dup_lines": _dup_lines(data, offsets),
        "n_repeat_words": _repeat_words(hashes, rows),
    }


def judged(data: np.ndarray, offsets: np.ndarray, weights: np.ndarray, n: int, threshold: float) -> dict[str, np.ndarray]:
    """Counts, mean log ratio and verdicts of consecutive texts."""
    counts = text_counts(data, offsets)
    h, row = _buckets(data, offsets, n, len(weights))
    rows = len(offsets) - 1
    mean = np.bincount(row, weights[h], minlength=rows) / np.maximum(np.bincount(row, minlength=rows), 1)
    words = counts["n_words"]
    failed = (words < MIN_WORDS) | (100 * counts["n_repeat_words"] > 50 * words)
    return counts | {"base_failed": failed, "kept": ~failed & (mean >= threshold), "mean_log_ratio": mean}


def quality_scores(
    docs: DataFrame, trusted: DataFrame, n: int = NGRAM, buckets: int = BUCKETS, threshold: float = THRESHOLD
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): base counts, verdicts and the mean log ratio."""
    tuned(docs.sparkSession)
    weights = log_ratios(trusted, docs, n, buckets)
    names = [f.split()[0] for f in SCORES_DDL.split(", ")]

    def score(batches):
        for batch in batches:
            got = [judged(part, at, weights, n, threshold) for part, at in sliced(batch.column(1))]
            if got:
                columns = [pa.array(np.concatenate([g[k] for g in got])) for k in names[1:]]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(thrifty(score), SCORES_DDL)


def trusted_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents that the labels mark with quality 1."""
    marked = labels.filter("quality = 1").select("doc_id").distinct().hint("merge")  # one plan at every size
    return docs.select("doc_id", "text").join(marked, "doc_id", "left_semi")


def quality_filter(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns; the verdict of a row
    depends on its text alone, so it is taken in the same pass over the rows."""
    tuned(docs.sparkSession)
    weights = log_ratios(trusted, docs)
    schema = docs.schema
    at_text = docs.columns.index("text")

    def keep(batches):
        for batch in batches:
            got = [judged(part, at, weights, NGRAM, THRESHOLD)["kept"] for part, at in sliced(batch.column(at_text))]
            if got:
                yield batch.filter(pa.array(np.concatenate(got)))

    return docs.mapInArrow(thrifty(keep), schema)
