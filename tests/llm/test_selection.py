"""Prefix trie, hard negatives and packing against brute force, with odd rows."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tokenizers
from pyspark.sql import functions as F

from auditlens.llm import hard_negatives, packing, prefix_trie

CONVERSATIONS = "conv_id long, turn long, role string, text string, shard int, key string, n long"
VECTORS = "vec_id long, embedding array<float>, label int, score double, x string, part int"
DOCS = "doc_id long, text string, length int, part int, offset long"
RANKS, SPECIAL = public_tokenizers.path("byte_bpe_50k.tiktoken"), {"<|endoftext|>": 50256}


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# -- prefix trie ---------------------------------------------------------------------------------


def brute_trie(rows):
    """Rows of the trie of (conv_id, turn, role, text), turns of one number by digest."""
    def digest(t):
        return hashlib.sha256(f"{len(t[0])}:{t[0]}{t[1]}".encode()).digest()[:16]

    own = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, digest((role or "", text or "")), (role or "", text or "")))
    own = {c: [t[-1] for t in sorted(v)] for c, v in own.items()}
    paths = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        paths[c] = tuple(own.get(c - int(math.fmod(c, 100)), [])[:h] + own[c][h:])
    members = collections.defaultdict(list)
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    out = []
    for p, m in members.items():
        below = [q for q in members if q[: len(p)] == p]
        saved = sum((len(members[q]) - 1) * len(q[-1][1]) for q in below if q)
        ends = ",".join(str(c) for c in sorted(m) if len(paths[c]) == len(p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], sum(not children[q] for q in below), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


TRIE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def conversations(seed):
    rng = random.Random(seed)
    rows = []
    for c in list(range(60)) + [100, 103, 250, 251, 305, -7, -100, 10**12]:
        n = rng.choice([0, 1, 1, 2, 3, 5, 7, 12])
        same = rng.random() < 0.5
        for t in range(n or 1):
            text = f"t{t}" if same else rng.choice(["a", "bb", "", "é" * 9, None])
            rows.append((c, t if rng.random() < 0.95 else None, rng.choice(["user", "user", None]), text, 1, "k", 2))
    rows += [(3, 0, "user", "again", 1, "k", 2)] * 2 + [(None, 1, "user", "x", 1, "k", 2), (77, None, None, None, None, None, None)]
    rows += [(500 + i, t, "user", f"long {t}", 1, "k", 2) for i in range(9) for t in range(40 + i % 3)]
    return rows


@pytest.mark.parametrize("seed,segment,shard_rows", [(1, 64, 20_000), (2, 2, 7), (3, 5, 11), (4, 1, 40)])
def test_trie_equals_brute_force(spark, monkeypatch, seed, segment, shard_rows):
    monkeypatch.setattr(prefix_trie, "SEGMENT", segment)
    monkeypatch.setattr(prefix_trie, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(prefix_trie, "TURN_ROWS", 50)
    monkeypatch.setattr(prefix_trie, "PIECE_IDS", 2)
    rows = conversations(seed)
    df = spark.createDataFrame(rows, CONVERSATIONS).repartition(3)
    got = prefix_trie.conversation_trie(df)
    assert got.columns == TRIE
    assert rows_of(got, *TRIE) == brute_trie([r[:4] for r in rows])


def test_trie_of_one_conversation_copied_many_times(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SHARD_ROWS", 30)
    rows = [(100 * i, t, "user", "same" if t < 3 or i % 3 else f"own {i}", 1, "k", 2) for i in range(200) for t in range(5)]
    got = prefix_trie.conversation_trie(spark.createDataFrame(rows, CONVERSATIONS))
    assert rows_of(got, *TRIE) == brute_trie([r[:4] for r in rows])


def test_trie_of_nothing(spark):
    assert prefix_trie.conversation_trie(spark.createDataFrame([], CONVERSATIONS)).count() == 0
    only_null = spark.createDataFrame([(None, 1, "user", "x", 1, "k", 2)], CONVERSATIONS)
    assert prefix_trie.conversation_trie(only_null).count() == 0


# -- hard negatives ------------------------------------------------------------------------------


def brute_negatives(rows, k=5):
    def usable(r):
        return r[0] is not None and r[1] is not None and r[2] is not None and all(v is not None and math.isfinite(v) for v in r[1])

    part = {(r[0], (r[2] + 1) % 10 if r[0] % 7 == 0 else r[2], tuple(math.floor(256 * float(np.float32(v))) for v in r[1])) for r in rows if usable(r)}
    out = []
    for a in part:
        if a[0] % 100:
            continue
        near = collections.defaultdict(set)
        for b in part:
            if b[0] != a[0]:
                near[a[1] == b[1]].add((-sum(p * q for p, q in zip(a[2], b[2])), b[0]))
        negatives = sorted(near[False])
        for s, v in sorted(near[True])[:k]:
            inside = [n for n in negatives if 80 * -s <= 100 * -n[0] <= 100 * -s][:k]
            out += [(a[0], v, i, n[1], -s, -n[0]) for i, n in enumerate(inside, 1)]
    return sorted(out, key=repr)


MINED = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def vectors(seed, scale=1.0):
    rng = random.Random(seed)
    rows = []
    for i in range(700):
        x = [rng.gauss(0.3, 0.2) * scale for _ in range(6)]
        if rng.random() < 0.3:
            x = [round(v * 4) / 4 for v in x]
        rows.append((i, x, rng.randrange(4), 1.0, "e", 1))
    rows += rows[:40] + rows[100:101]  # repeated rows
    rows += [(200, [1.0, 2.0], 1, 0.0, "s", 1), (300, [], 1, 0.0, "s", 1), (9000, None, 1, 0.0, "n", 1), (9100, [1.0, None], 1, 0.0, "n", 1), (9200, [float("nan")] * 6, 1, 0.0, "n", 1),
             (9300, [float("inf")] * 6, 1, 0.0, "n", 1), (9400, [1.0] * 6, None, 0.0, "n", 1), (None, [1.0] * 6, 1, 0.0, "n", 1), (9500, [0.0] * 6, 2, 0.0, "z", 1)]
    return rows


def mined(df):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mined(df, F.col("vec_id") % 100 == 0, label)


@pytest.mark.parametrize("seed,scale,anchor_rows,tile", [(1, 1.0, 32_768, 1 << 20), (2, 1.0, 3, 64), (3, 1e7, 4, 256)])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, seed, scale, anchor_rows, tile):
    """The last case needs scores beyond the range in which doubles are exact."""
    monkeypatch.setattr(hard_negatives, "ANCHOR_ROWS", anchor_rows)
    monkeypatch.setattr(hard_negatives, "LEAST_GROUP_ROWS", 60)
    monkeypatch.setattr(hard_negatives, "TILE", tile)
    rows = vectors(seed, scale)
    got = mined(spark.createDataFrame(rows, VECTORS).repartition(5))
    assert got.columns == MINED
    assert rows_of(got, *MINED) == brute_negatives(rows)


def test_hard_negatives_of_nothing(spark):
    assert mined(spark.createDataFrame([], VECTORS)).count() == 0
    assert mined(spark.createDataFrame([(5, [1.0], 1, 0.0, "n", 1)], VECTORS)).count() == 0  # no anchor
    assert mined(spark.createDataFrame([(0, [1.0], 1, 0.0, "n", 1)], VECTORS)).count() == 0  # no other row


# -- packing -------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    tokenizer = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def texts():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("aeiounrstl") for _ in range(rng.randint(1, 8)))
    out = [" ".join(word() for _ in range(rng.choice([1, 3, 20, 90, 300]))) for _ in range(120)]
    return out + [None, "", " ", "\n\n  x", "é 日本語 👍🏽", "a\x00b", "<|endoftext|> x <|endoftext|>", "x" * 40_000, " ".join(word() for _ in range(3_000)), out[0], out[0]]


@pytest.mark.parametrize("size", [1024, 40])
def test_packing_is_whole_gapless_and_tight(spark, library, size):
    rows = [(i, t, 1, 1, 1) for i, t in enumerate(texts())] + [(None, "no id", 1, 1, 1), (0, texts()[0], 1, 1, 1)]
    df = spark.createDataFrame(rows, DOCS).repartition(4)
    got = packing.packed(packing.pieces(df, RANKS, public_tokenizers.PATTERN, SPECIAL, size=size), size)
    want = collections.Counter()
    for i, t, *_ in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        n = -(-len(ids) // size)
        edges = [0, *range(len(ids) - (n - 1) * size, len(ids) + 1, size)]
        for j, (a, b) in enumerate(zip(edges, edges[1:])):
            want[(i, j, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    placed = [tuple(r) for r in got.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset").collect()]
    assert collections.Counter(r[:5] for r in placed) == want
    sequences = collections.defaultdict(list)
    for r in placed:
        sequences[r[5]].append((r[6], r[3]))
    for inside in sequences.values():
        at = 0
        for offset, length in sorted(inside):
            assert offset == at
            at += length
        assert at <= size
    total = sum(r[3] for r in placed)
    assert len(sequences) <= -(-total // size) * 1.02 + 1


def test_packing_plan_finds_a_perfect_fit():
    counts = {700: 4, 600: 2, 424: 2, 324: 4, 200: 0, 1024: 7}
    steps = packing.plan({k: v for k, v in counts.items() if v}, 1024)
    assert sum(n for _, n in steps) == 13 and all(sum(a * b for a, b in p.items()) == 1024 for p, _ in steps)
    used = collections.Counter()
    for pieces, n in steps:
        used.update({a: b * n for a, b in pieces.items()})
    assert used == collections.Counter({k: v for k, v in counts.items() if v})


@pytest.mark.parametrize("seed", range(6))
def test_packing_combination_is_the_fullest(seed):
    """The first sequence holds the largest piece and the best sum that goes with it."""
    rng = random.Random(seed)
    pieces = [rng.randint(1, 60) for _ in range(9)]
    first = packing.plan(dict(collections.Counter(pieces)), 100)[0][0]
    rest = sorted(pieces)[:-1]
    best = max(s for m in range(1 << len(rest)) if (s := sum(x for i, x in enumerate(rest) if m >> i & 1)) <= 100 - max(pieces))
    assert sum(a * b for a, b in first.items()) == max(pieces) + best


def test_packing_of_nothing_and_sequences_of_ids(spark, library):
    nothing = spark.createDataFrame([], DOCS)
    assert packing.packed(packing.pieces(nothing, RANKS, public_tokenizers.PATTERN, SPECIAL)).count() == 0
    df = spark.createDataFrame([(1, "one two", 1, 1, 1), (2, "three", 1, 1, 1), (3, None, 1, 1, 1)], DOCS)
    kept = packing.packed(packing.pieces(df, RANKS, public_tokenizers.PATTERN, SPECIAL, keep_ids=True))
    (row,) = packing.sequences(kept).collect()
    texts = {1: "one two", 2: "three", 3: ""}
    want = [x for d in row["documents"] for x in [*library.encode(texts[d["doc_id"]], add_special_tokens=False).ids, 2]]
    assert row["ids"] == want and row["n_tokens"] == len(want)
