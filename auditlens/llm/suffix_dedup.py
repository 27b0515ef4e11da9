"""Repeated passages: every byte covered by a string of ``width`` bytes that also starts elsewhere.

A suffix array over every byte would move hundreds of bytes per byte of text. Here only
suffixes that can matter are sorted:

1. Anchors. Of the ``width`` bytes of a window, the gram (``gram`` bytes) with the smallest
   hash is its anchor, the leftmost of equal ones. Equal windows have equal anchors at equal
   offsets, so a window can only be repeated if its anchor's gram is.
2. An anchor's context is all bytes that its windows can touch. Contexts that stand twice
   make all their windows repeated. Grams with several different contexts stay open.
3. Suffix sort of the open contexts: they are dealt by sampled splitters over their leading
   bytes (``repartitionByRange`` on the suffix from the anchor), so equal leading tokens meet;
   inside a bucket they are sorted token by token, only ties going on to the next token
   (multikey quicksort in whole arrays), to the right of the anchor and, reversed, to its
   left. Common prefixes of neighbours then tell for every offset which windows are equal.
4. Across boundaries: a gram with more than ``bucket`` different contexts would be one task's
   work. Its windows are compared across buckets by their own hash.

Positions are judged on the input; matches never cross texts.

Defined results: a null text is empty; a text shorter than ``width`` bytes keeps all bytes;
repeated rows are occurrences of each other, so a repeated long text is removed in every row;
an empty table gives an empty result; other columns are ignored by ``repeated_passages`` and
kept by ``without_passages``. Rows are told apart by a 64-bit hash of doc_id and text.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from auditlens.llm.packed import BLOCK_DDL, parts_of, row_blocks, scatter, stored, thrifty, thrifty_group, tuned, unpack
from auditlens.llm.text import column_bytes, mix, running, slices, span_hash, window_hash

WIDTH = 200
GRAM = 64
BUCKET = 4096
_SPAN = 1 << 20
_LOW = np.uint64(_SPAN - 1)


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    have, step = values, 1
    while step * 2 <= width:
        have = np.minimum(have[:-step], have[step:])
        step *= 2
    return np.minimum(have[: len(have) - (width - step)], have[width - step :]) if width > step else have


def anchors(data: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and gram hashes of the anchors of one text, in order."""
    reach, at, got = width - gram + 1, [], []
    for lo in range(0, max(len(data) - width + 1, 0), _SPAN - width):
        part = data[lo : lo + _SPAN]
        if len(part) < width:
            break
        h = window_hash(running(part), gram)
        least = _sliding_least((h & ~_LOW) | np.arange(len(h), dtype=np.uint64), reach) & _LOW
        where = least[np.concatenate([[True], least[1:] != least[:-1]])].astype(np.int64)
        at.append(where + lo)
        got.append(h[where])
    if not at:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    where, first = np.unique(np.concatenate(at), return_index=True)
    return where, np.concatenate(got)[first]


def _context(at: np.ndarray, length: int, width: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of all windows that can have their anchor at ``at``."""
    return np.maximum(at - (width - gram), 0), np.minimum(at + width, length)


ANCHOR = pa.schema([("gram", pa.uint64()), ("ctx", pa.uint64()), ("uid", pa.int64()), ("at", pa.int64()), ("twice", pa.bool_())])
STATE = pa.schema([("uid", pa.int64()), ("at", pa.int64()), ("state", pa.int8())])
FULL, OPEN, FULL_OPEN, WIDE, FULL_WIDE = 1, 2, 3, 4, 5


KIND_DDL = "kind int, " + BLOCK_DDL
COMBINE = 500_000


def _anchor_blocks(keyed: DataFrame, width: int, gram: int, parts: int) -> DataFrame:
    """Blocks of anchors by gram (kind 0). Contexts that a task meets twice are repeated
    already: their states go straight to their texts (kind 1) and one anchor stands for them,
    so a passage of very many texts stays a few rows for each task."""

    def blocks(kind, part, table):
        for batch in scatter(iter([(part, table)])):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(batch.num_rows, kind, np.int32)), *batch.columns], ["kind", "part", "block"])

    def combined(got):
        h, ctx, ids, at = (np.concatenate(c) for c in zip(*got))
        order = np.lexsort((ctx, h))
        h, ctx, ids, at = h[order], ctx[order], ids[order], at[order]
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (ctx[1:] != ctx[:-1])])
        copies = np.bincount(np.cumsum(new) - 1)
        twice = (copies > 1)[np.cumsum(new) - 1]
        columns = [pa.array(h[new]), pa.array(ctx[new]), pa.array(ids[new]), pa.array(at[new]), pa.array(copies > 1)]
        yield from blocks(0, (mix(h[new]) % np.uint64(parts)).astype(np.int32), pa.Table.from_arrays(columns, schema=ANCHOR))
        ids, at = ids[twice], at[twice]
        states = pa.Table.from_arrays([pa.array(ids), pa.array(at), pa.array(np.full(len(at), FULL, np.int8))], schema=STATE)
        yield from blocks(1, (mix(ids.view(np.uint64)) % np.uint64(parts)).astype(np.int32), states)

    def scan(batches):
        got, size = [], 0
        for batch in batches:
            uid = batch.column(0).to_numpy()
            data, offsets = column_bytes(batch.column(1))
            for i in range(len(uid)):
                text = data[offsets[i] : offsets[i + 1]]
                at, h = anchors(text, width, gram)
                if not len(at):
                    continue
                lo, hi = _context(at, len(text), width, gram)
                ctx = span_hash(running(text), lo, hi) ^ mix((at - lo).astype(np.uint64))
                got.append((h, ctx, np.full(len(at), uid[i]), at))
                size += len(at)
                if size >= COMBINE:
                    yield from combined(got)
                    got, size = [], 0
        if got:
            yield from combined(got)

    return keyed.select("uid", "text").mapInArrow(thrifty(scan), KIND_DDL)


def _states(parts: int, bucket: int):
    """Anchors of repeated grams: with a repeated context, with an open one, or both (one
    occurrence then stands for its context in the comparison)."""

    def judge(group: pa.Table) -> pa.Table:
        rows = unpack(group.column("block"))
        g, c, uid, at, twice = (rows.column(k).to_numpy() for k in ANCHOR.names)
        order = np.lexsort((at, uid, c, g))
        g, c, uid, at, twice = g[order], c[order], uid[order], at[order], twice[order]
        head = np.concatenate([[True], g[1:] != g[:-1]])
        new = head | np.concatenate([[True], c[1:] != c[:-1]])
        ctx_of = np.cumsum(new) - 1
        gram_of = np.cumsum(head) - 1
        copies = (np.bincount(ctx_of) + np.bincount(ctx_of, twice))[ctx_of]
        contexts = np.bincount(gram_of[new])[gram_of]
        full = copies > 1
        shows = new & (contexts > 1)
        wide = contexts > bucket
        state = full * FULL + shows * np.where(wide, WIDE, OPEN)
        hit = np.flatnonzero(state)
        part = (mix(uid[hit].view(np.uint64)) % np.uint64(parts)).astype(np.int32)
        table = pa.Table.from_arrays([pa.array(uid[hit]), pa.array(at[hit]), pa.array(state[hit].astype(np.int8))], schema=STATE)
        sent = list(scatter(iter([(part, table)])))
        return pa.Table.from_batches(sent) if sent else pa.table({"part": pa.array([], pa.int32()), "block": pa.array([], pa.binary())})

    return judge


TEXT = pa.schema([("uid", pa.int64()), ("text", pa.large_binary())])


def _text_blocks(keyed: DataFrame, parts: int) -> DataFrame:
    def scan(batches):
        def tables():
            for batch in batches:
                uid = batch.column(0)
                data, offsets = column_bytes(batch.column(1))
                text = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(uid), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)])
                part = (mix(uid.to_numpy().view(np.uint64)) % np.uint64(parts)).astype(np.int32)
                yield part, pa.Table.from_arrays([uid, text], schema=TEXT)

        yield from scatter(tables())

    return keyed.select("uid", "text").mapInArrow(thrifty(scan), BLOCK_DDL)


def _texts(group: pa.Table) -> dict[int, np.ndarray]:
    rows = unpack(group.column("block"))
    if rows is None:
        return {}
    out = {}
    for chunk in rows.to_batches():
        data, offsets = column_bytes(chunk.column(1))
        for i, uid in enumerate(chunk.column(0).to_pylist()):
            out[uid] = data[offsets[i] : offsets[i + 1]]
    return out


FOUND_DDL = "kind int, uid long, at long, lo long, hi long, lead binary, tail binary"


def _open_contexts(width: int, gram: int):
    """Removed spans of repeated contexts (kind 0), open contexts as (suffix from the anchor,
    reversed text before it) (kind 1), and those of wide grams (kind 2)."""

    def cut(states: pa.Table, texts: pa.Table) -> pa.Table:
        got = unpack(states.column("block"))
        have = _texts(texts) if got is not None else {}
        out = {k: [] for k in ("kind", "uid", "at", "lo", "hi", "lead", "tail")}

        def add(*row):
            for k, v in zip(out, row):
                out[k].append(v)

        if got is not None:
            uids, ats, state = (got.column(k).to_numpy() for k in STATE.names)
            order = np.lexsort((-state, ats, uids))  # an anchor's fuller state comes first
            uids, ats, state = uids[order], ats[order], state[order]
            once = np.concatenate([[True], (uids[1:] != uids[:-1]) | (ats[1:] != ats[:-1])])
            uids, ats, state = uids[once], ats[once], state[once]
            head = np.flatnonzero(np.concatenate([[True], uids[1:] != uids[:-1]])) if len(uids) else []
            for a, b in zip(head, [*head[1:], len(uids)]):
                uid, text = int(uids[a]), have.get(int(uids[a]))
                lo, hi = _context(ats[a:b], len(text), width, gram)
                full = (state[a:b] & FULL) > 0
                for s, e in zip(*_merged(lo[full], hi[full])):
                    add(0, uid, 0, int(s), int(e), None, None)
                for i in np.flatnonzero(state[a:b] > FULL):
                    at, kind = int(ats[a + i]), 2 if state[a + i] >= WIDE else 1
                    add(kind, uid, at, int(lo[i]), int(hi[i]), text[at : hi[i]].tobytes(), text[lo[i] : at][::-1].tobytes())
        types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        return pa.Table.from_arrays([pa.array(out[k], t) for k, t in zip(out, types)], list(out))

    return cut


def _merged(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open spans, in order."""
    if not len(lo):
        return lo, hi
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    new = np.concatenate([[True], lo[1:] > hi[:-1]])
    return lo[new], hi[np.concatenate([new[1:], [True]])]


def _sorted_classes(strings: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorts strings by multikey quicksort over tokens of 8 bytes: rows that are still tied go
    on to the next token. Gives the order, and the common prefix of each with its predecessor
    (at most ``depth``; shorter strings never match beyond their end)."""
    n = len(strings)
    width = -(-depth // 8) * 8
    raw = np.frombuffer(b"".join(s[:depth].ljust(width, b"\0") for s in strings), np.uint8).reshape(n, width)
    tokens = np.ascontiguousarray(raw).view(">u8").astype(np.uint64)
    order, start = np.arange(n), np.zeros(n, np.int64)  # start: first place of a row's run of ties
    for d in range(width // 8):
        run = np.bincount(start, minlength=n)[start]
        tied = np.flatnonzero(run > 1)
        if not len(tied):
            break
        key = tokens[order[tied], d]
        inner = np.lexsort((key, start[tied]))
        order[tied], key, group = order[tied][inner], key[inner], start[tied]
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (group[1:] != group[:-1])])
        start[tied] = tied[np.flatnonzero(new)][np.cumsum(new) - 1]
    length = np.array([min(len(s), depth) for s in strings])[order]
    lcp = np.zeros(n, np.int64)
    if n > 1:
        differs = raw[order[1:]] != raw[order[:-1]]
        first = np.where(differs.any(1), differs.argmax(1), width)
        lcp[1:] = np.minimum(first, np.minimum(length[1:], length[:-1]))
    return order, lcp


def _classes(strings: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order, lcp = _sorted_classes(strings, depth)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return order, lcp, place


def _compare_bucket(width: int, gram: int):
    """Removed spans (uid, lo, hi) from the open contexts of one bucket."""
    left = width - gram

    def compare(batches):
        got = list(batches)
        if not got:
            return
        rows = pa.Table.from_batches(got)
        uid, at = (rows.column(k).to_numpy() for k in ("uid", "at"))
        lead, tail = (rows.column(k).to_pylist() for k in ("lead", "tail"))
        n = len(uid)
        if n < 2:
            return
        _, right_lcp, right = _classes(lead, width)
        _, left_lcp, back = _classes(tail, left)
        lead_len, tail_len = np.array([len(s) for s in lead]), np.array([len(s) for s in tail])
        got = []
        for i in range(left + 1):  # windows that begin i bytes before the anchor
            fits = np.flatnonzero((tail_len >= i) & (lead_len >= width - i))
            if len(fits) < 2:
                continue
            key = np.cumsum(right_lcp < width - i)[right[fits]] * (n + 1) + np.cumsum(left_lcp < i)[back[fits]]
            _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
            hit = fits[count[inverse] > 1]
            got.append((uid[hit], at[hit] - i))
        yield from _spans(got, width)

    return compare


def _spans(got: list, width: int):
    """Batches of merged spans from (uid, window start) pairs."""
    if got:
        uid, lo = (np.concatenate(c) for c in zip(*got))
        order = np.lexsort((lo, uid))
        uid, lo = uid[order], lo[order]
        if len(uid):
            new = np.concatenate([[True], (uid[1:] != uid[:-1]) | (lo[1:] > lo[:-1] + width)])
            end = np.concatenate([new[1:], [True]])
            yield pa.RecordBatch.from_arrays([pa.array(uid[new]), pa.array(lo[new]), pa.array(lo[end] + width)], ["uid", "lo", "hi"])


WINDOW = pa.schema([("key", pa.uint64()), ("uid", pa.int64()), ("lo", pa.int64())])


def _window_blocks(wide: DataFrame, width: int, parts: int) -> DataFrame:
    """Every window of the contexts of wide grams, dealt by its own hash."""

    def scan(batches):
        def tables():
            for batch in batches:
                for uid, lo, lead, tail in zip(*(batch.column(k).to_pylist() for k in ("uid", "lo", "lead", "tail"))):
                    h = window_hash(running(np.frombuffer(tail[::-1] + lead, np.uint8)), width)
                    columns = [pa.array(h), pa.array(np.full(len(h), uid)), pa.array(np.arange(len(h)) + lo)]
                    yield (mix(h) % np.uint64(parts)).astype(np.int32), pa.Table.from_arrays(columns, schema=WINDOW)

        yield from scatter(tables())

    return wide.mapInArrow(thrifty(scan), BLOCK_DDL)


def _compare_windows(width: int):
    def compare(group: pa.Table) -> pa.Table:
        rows = unpack(group.column("block"))
        key, uid, lo = (rows.column(k).to_numpy() for k in WINDOW.names)
        order = np.lexsort((lo, uid, key))
        key, uid, lo = key[order], uid[order], lo[order]
        new = np.ones(len(key), bool)  # contexts of one text overlap: a window is itself once
        new[1:] = (key[1:] != key[:-1]) | (uid[1:] != uid[:-1]) | (lo[1:] != lo[:-1])
        key, uid, lo = key[new], uid[new], lo[new]
        _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
        hit = count[inverse] > 1
        spans = list(_spans([(uid[hit], lo[hit])], width))
        return pa.Table.from_batches(spans) if spans else pa.table({k: pa.array([], pa.int64()) for k in ("uid", "lo", "hi")})

    return compare


SPAN_DDL = "uid long, lo long, hi long"


def row_uid() -> Column:
    return F.xxhash64(F.col("doc_id"), F.coalesce("text", F.lit("")))


def repeated_spans(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, bucket: int = BUCKET) -> DataFrame:
    """(part, uid, lo, hi): byte spans to remove; spans of one text may overlap."""
    spark = tuned(docs.sparkSession)
    parts = parts_of(spark)
    keyed = docs.select(row_uid().alias("uid"), "text")
    blocks = stored(_anchor_blocks(keyed, width, gram, parts), "anchors")
    judged = blocks.filter("kind = 0").groupBy("part").applyInArrow(thrifty_group(_states(parts, bucket)), BLOCK_DDL)
    states = judged.union(blocks.filter("kind = 1").select("part", "block"))
    texts = _text_blocks(keyed, parts)
    cut = states.groupBy("part").cogroup(texts.groupBy("part")).applyInArrow(thrifty_group(_open_contexts(width, gram)), FOUND_DDL)
    found = stored(cut, "contexts")
    opened = found.filter("kind = 1").select("uid", "at", "lead", "tail")
    leading = F.substring("lead", 1, gram)
    buckets = opened.repartitionByRange(parts, leading).mapInArrow(thrifty(_compare_bucket(width, gram)), SPAN_DDL)
    wide = _window_blocks(found.filter("kind = 2").select("uid", "lo", "lead", "tail"), width, parts)
    across = wide.groupBy("part").applyInArrow(thrifty_group(_compare_windows(width)), SPAN_DDL)
    return stored(found.filter("kind = 0").select("uid", "lo", "hi").union(buckets).union(across), "spans")


def _kept(text: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, int]:
    keep = np.ones(len(text), bool)
    lo, hi = _merged(lo, hi)
    for a, b in zip(lo, hi):
        keep[a:b] = False
    return keep, len(lo)


def _grouped_spans(group: pa.Table) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    rows = unpack(group.column("block"))
    if rows is None:
        return {}
    uid, lo, hi = (rows.column(k).to_numpy() for k in ("uid", "lo", "hi"))
    order = np.argsort(uid, kind="stable")
    uid, lo, hi = uid[order], lo[order], hi[order]
    head = np.flatnonzero(np.concatenate([[True], uid[1:] != uid[:-1]])) if len(uid) else []
    return {int(uid[a]): (lo[a:b], hi[a:b]) for a, b in zip(head, [*head[1:], len(uid)])}


def _rows_with_spans(docs: DataFrame, spans: DataFrame, work, ddl: str, parts: int) -> DataFrame:
    """Applies ``work(rows, {uid: spans})`` to the rows of each destination."""
    rows = row_blocks(docs.select(row_uid().alias("_uid"), *[F.col(f"`{c}`") for c in docs.columns]), parts)

    def both(left: pa.Table, right: pa.Table) -> pa.Table:
        got = unpack(left.column("block"))
        return work(got, _grouped_spans(right))

    return rows.groupBy("part").cogroup(row_blocks(spans, parts).groupBy("part")).applyInArrow(thrifty_group(both), ddl)


RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])
RESULT_DDL = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def repeated_passages(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, bucket: int = BUCKET) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): what is removed, and the digest of the rest."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")

    def work(rows: pa.Table | None, spans: dict) -> pa.Table:
        out = []
        for chunk in rows.to_batches() if rows is not None else []:
            data, offsets = column_bytes(chunk.column(2))
            for i, (uid, doc) in enumerate(zip(chunk.column(0).to_pylist(), chunk.column(1).to_pylist())):
                text = data[offsets[i] : offsets[i + 1]]
                keep, n = _kept(text, *spans[uid]) if uid in spans else (None, 0)
                rest = text if keep is None else text[keep]
                out.append((doc, len(text), len(text) - len(rest), n, hashlib.sha256(rest.tobytes()).hexdigest()))
        columns = list(zip(*out)) if out else [[]] * 5
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, RESULT)], schema=RESULT)

    spark = tuned(docs.sparkSession)
    return _rows_with_spans(docs, repeated_spans(docs, width, gram, bucket), work, RESULT_DDL, parts_of(spark))


def without_passages(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text``; characters that a cut would split go
    whole. ``n_chars``, if there, follows the new text."""
    columns, schema = docs.columns, docs.schema
    at_text = columns.index("text") + 1

    def work(rows: pa.Table | None, spans: dict) -> pa.Table:
        done = []
        for chunk in rows.to_batches() if rows is not None else []:
            data, offsets = column_bytes(chunk.column(at_text))
            texts = []
            for i, uid in enumerate(chunk.column(0).to_pylist()):
                text = data[offsets[i] : offsets[i + 1]]
                if uid in spans:
                    keep, _ = _kept(text, *spans[uid])
                    first = np.flatnonzero((text & 0xC0) != 0x80)
                    if len(first):  # a character stays only with all its bytes
                        keep = np.repeat(np.logical_and.reduceat(keep, first), np.diff(np.append(first, len(text))))
                    text = text[keep]
                texts.append(text.tobytes().decode("utf-8"))
            text = pa.array(texts, pa.string())
            changed = {"text": text, "n_chars": pa.array([len(t) for t in texts])}
            arrays = [changed[c].cast(chunk.column(c).type) if c in changed else chunk.column(c) for c in columns]
            done.append(pa.RecordBatch.from_arrays(arrays, columns))
        return pa.Table.from_batches(done) if done else empty

    empty = to_arrow_schema(schema).empty_table()
    spark = tuned(docs.sparkSession)
    return _rows_with_spans(docs, repeated_spans(docs, width), work, schema, parts_of(spark))
