"""Language identification by a linear-chain conditional random field over words.

Every word gets a language: its prefixes, suffixes, byte n-grams and its entry in a learned lexicon
of frequent words speak for languages, and learned transitions tie neighbours, so a passage in
another language inside a text is labelled as such. Forward-backward over the whole text gives each
word's probabilities; the text's language is the one with the largest sum, and the score its share.

The field is fitted on a documented bounded sample: at most about ``SAMPLE_ROWS`` labelled rows per
language, by hash. Its training sequences are code-switched: runs of ``RUN`` words of different
texts follow each other in a hashed order. The likelihood is maximised by full-batch steps, with
the same forward-backward.

Defined results: a text that is null or has no letter is ``und`` with score 0, and so is every text
if no row is labelled; equal sums go to the smaller language by code point; repeated rows get
equal rows; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlens.llm.packed import tuned
from auditlens.llm.text import column_bytes, mix, running, span_hash, word_hashes

SAMPLE_ROWS = 250
RUN = 24
SEQUENCE = 96
CELLS = 1 << 16
LEXICON = 1 << 14
LEXICON_TEXTS = 3
STEPS = 20
RATE, DECAY = 0.3, 1e-6
AFFIXES = (1, 2, 3, 4)
NGRAM = 3


def word_cells(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cell, word) for the affixes and n-grams of words."""
    cells, words, every = [], [], np.arange(len(start))

    def add(kind, a, b, word):
        cells.append(mix(span_hash(sums, a, b) + np.uint64(kind)) % np.uint64(CELLS))
        words.append(word)

    for k in AFFIXES:
        add(k, start, np.minimum(start + k, end), every)
        add(16 + k, np.maximum(end - k, start), end, every)
    n = np.maximum(end - start - NGRAM + 1, 0)
    word = np.repeat(every, n)
    a = np.repeat(start, n) + np.arange(len(word)) - np.repeat(np.cumsum(n) - n, n)
    add(32, a, a + NGRAM, word)
    return np.concatenate(cells).astype(np.int64), np.concatenate(words)


class _Words:
    """Distinct words of consecutive texts with their features."""

    def __init__(self, column: pa.Array):
        self.data, self.offsets = column_bytes(column)
        lo = self.offsets[0] if len(self.offsets) else 0
        self.data, self.offsets = self.data[lo : self.offsets[-1]], self.offsets - lo
        hashes, start, end, self.rows = word_hashes(self.data, self.offsets)
        self.key, first, self.which = np.unique(hashes, return_index=True, return_inverse=True)
        self.cell, self.word = word_cells(running(self.data, lower=True), start[first], end[first])

    def in_lexicon(self, lexicon: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, word) of the distinct words that the lexicon has."""
        if not len(lexicon) or not len(self.key):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(lexicon, self.key), len(lexicon) - 1)
        hit = np.flatnonzero(lexicon[at] == self.key)
        return at[hit], hit

    def emissions(self, model: dict) -> np.ndarray:
        """Evidence of each distinct word for each language."""
        entry, word = self.in_lexicon(model["lexicon"])
        out = np.empty((len(self.key), model["cells"].shape[1]))
        for k in range(out.shape[1]):
            out[:, k] = np.bincount(self.word, model["cells"][self.cell, k], len(self.key))
            out[word, k] += model["entries"][entry, k]
        return out


def _forward_backward(e: np.ndarray, step: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Probabilities of each word's languages. ``e``: emission factors in order of place, then
    text (longest first); ``count``: texts that have each place; ``step``: transition factors."""
    at = np.concatenate([[0], np.cumsum(count)])
    alpha, beta = np.empty_like(e), np.ones_like(e)
    back = step.T.copy()
    for t, n in enumerate(count):
        a, z = at[t], at[t] + n
        now = e[a:z] if t == 0 else (alpha[at[t - 1] : at[t - 1] + n] @ step) * e[a:z]
        now /= now.sum(1, keepdims=True)
        alpha[a:z] = now
    for t in range(len(count) - 1, 0, -1):
        n = count[t]
        b = (beta[at[t] : at[t] + n] * e[at[t] : at[t] + n]) @ back
        b /= b.sum(1, keepdims=True)
        beta[at[t - 1] : at[t - 1] + n] = b
    p = alpha * beta
    p /= p.sum(1, keepdims=True)
    return p


def _fit_chain(e: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sequences of equal length (place, sequence, language): word probabilities and the
    expected number of each transition."""
    count = np.full(e.shape[0], e.shape[1])
    p = _forward_backward(e.reshape(-1, e.shape[2]), step, count).reshape(e.shape)
    alpha, expected = e[0] / e[0].sum(1, keepdims=True), np.zeros_like(step)
    beta = np.ones_like(e)
    for t in range(e.shape[0] - 1, 0, -1):
        beta[t - 1] = (beta[t] * e[t]) @ step.T
        beta[t - 1] /= beta[t - 1].sum(1, keepdims=True)
    for t in range(1, e.shape[0]):
        right = e[t] * beta[t]
        pair = alpha[:, :, None] * step[None] * right[:, None, :]
        expected += (pair / pair.sum((1, 2), keepdims=True)).sum(0)
        alpha = (alpha @ step) * e[t]
        alpha /= alpha.sum(1, keepdims=True)
    return p, expected


def fit(texts: pa.Array, labels: list[str]) -> dict:
    """The field for whole labelled texts."""
    languages = sorted(set(labels))
    y = np.array([languages.index(x) for x in labels])
    words = _Words(texts)
    row = np.repeat(np.arange(len(labels)), np.diff(words.rows))
    texts_with = np.bincount(np.unique(words.which.astype(np.int64) * len(labels) + row) // max(len(labels), 1), minlength=len(words.key))
    often = np.flatnonzero(texts_with >= LEXICON_TEXTS)
    often = often[np.lexsort((words.key[often], -texts_with[often]))][:LEXICON]
    lexicon = np.sort(words.key[often])
    # code-switched sequences: runs of words in hashed order, cut into equal lengths
    run = (np.arange(len(row)) - words.rows[row]) // RUN
    key = mix(mix(row.astype(np.uint64)) + run.astype(np.uint64))
    order = np.argsort(key, kind="stable")
    length = min(SEQUENCE, len(order))
    whole = len(order) // max(length, 1)
    order = np.resize(order, (whole + (whole * length < len(order))) * length).reshape(-1, length).T
    token, target = words.which[order], y[row[order]]
    n = len(languages)
    entry, word = words.in_lexicon(lexicon)
    model = {"languages": languages, "lexicon": lexicon, "cells": np.zeros((CELLS, n)), "entries": np.zeros((len(lexicon), n)), "step": np.zeros((n, n))}
    truth = np.zeros((len(words.key), n))
    for k in range(n):
        truth[:, k] = np.bincount(token[target == k], minlength=len(words.key))
    seen = np.zeros((n, n))
    np.add.at(seen, (target[:-1], target[1:]), 1)
    size = token.size
    state = {k: (np.zeros_like(model[k]), np.zeros_like(model[k])) for k in ("cells", "entries", "step")}
    for i in range(1, STEPS + 1):
        e = words.emissions(model)
        e = np.exp(e - e.max(1, keepdims=True))
        p, expected = _fit_chain(e[token], np.exp(model["step"]))
        found = np.stack([np.bincount(token.ravel(), p[..., k].ravel(), len(words.key)) for k in range(n)], axis=1)
        off = (truth - found) / size
        grads = {"step": (seen - expected) / size, "cells": np.empty((CELLS, n)), "entries": np.empty((len(lexicon), n))}
        for k in range(n):
            grads["cells"][:, k] = np.bincount(words.cell, off[words.word, k], CELLS)
            grads["entries"][:, k] = np.bincount(entry, off[word, k], len(lexicon))
        for name, (mean, square) in state.items():  # steps scaled by the gradient's own size
            g = grads[name] - DECAY * model[name]
            mean += 0.1 * (g - mean)
            square += 0.05 * (g * g - square)
            model[name] += RATE / np.sqrt(i) * (mean / (1 - 0.9**i)) / (np.sqrt(square / (1 - 0.95**i)) + 1e-7)
    model["cells"], model["entries"] = model["cells"].astype(np.float32), model["entries"].astype(np.float32)
    return model


def has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    low = data | 32
    ascii_letters = np.concatenate([[0], np.cumsum((low >= 97) & (low <= 122))])
    out = np.diff(ascii_letters[offsets]) > 0
    for i in np.flatnonzero(~out):
        out[i] = any(c.isalpha() for c in data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace"))
    return out


def word_languages(model: dict, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Probabilities of each word's languages, in text order; rows' first words; has a letter."""
    words = _Words(column)
    e = words.emissions(model)
    e = np.exp(e - e.max(1, keepdims=True)) if len(e) else e
    length = np.diff(words.rows)
    longest = np.argsort(-length, kind="stable")
    rank = np.empty(len(length), np.int64)
    rank[longest] = np.arange(len(length))
    row = np.repeat(np.arange(len(length)), length)
    place = np.arange(len(row)) - words.rows[row]
    order = np.lexsort((rank[row], place))
    p = np.empty((len(row), e.shape[1]))
    p[order] = _forward_backward(e[words.which[order]], np.exp(model["step"]), np.bincount(place))
    return p, words.rows, has_letter(words.data, words.offsets)


def sample(docs: DataFrame) -> DataFrame:
    """Labelled rows of the learning folds, by hash, about SAMPLE_ROWS for each language."""
    counts = docs.groupBy("lang").count().collect()
    pick = F.lit(False)
    for lang, n in counts:
        share = int((1 << 30) * min(1.0, SAMPLE_ROWS / n))
        pick |= (F.col("lang") == lang) & (F.pmod(F.xxhash64("doc_id", F.lit("lang")), F.lit(1 << 30)) < share)
    return docs.filter(pick)


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of ``docs`` (doc_id, text, lang)."""
    spark = tuned(docs.sparkSession)
    doc_id = F.col("doc_id").cast("long")
    fold = F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(3))
    docs = docs.select(doc_id.alias("doc_id"), "text", "lang", (fold == 1).alias("held_out"))
    rows = sample(docs.filter("NOT held_out AND lang IS NOT NULL AND text IS NOT NULL")).select("doc_id", "text", "lang").toArrow().sort_by("doc_id")
    known = fit(rows.column("text").combine_chunks(), rows.column("lang").to_pylist()) if rows.num_rows else None
    model = spark.sparkContext.broadcast(known)

    def label(batches):
        for batch in batches:
            n, known = batch.num_rows, model.value
            lang, score = ["und"] * n, np.zeros(n)
            if known and n:
                p, first, letters = word_languages(known, batch.column(2))
                row = np.repeat(np.arange(n), np.diff(first))
                sums = np.stack([np.bincount(row, p[:, k], n) for k in range(p.shape[1])], axis=1)
                best = sums.argmax(1)
                score = np.where(letters, sums.max(1) / np.maximum(sums.sum(1), 1e-300), 0.0)
                lang = [known["languages"][b] if has else "und" for b, has in zip(best, letters)]
            columns = [batch.column(0), batch.column(1), pa.array(lang, pa.string()), pa.array(np.minimum(score, 1.0))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "lang_pred", "score"])

    return docs.select("doc_id", "held_out", "text").mapInArrow(label, "doc_id long, held_out boolean, lang_pred string, score double")
