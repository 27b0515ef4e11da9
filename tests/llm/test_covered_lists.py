"""Lists whose pairs are all taken are not walked again."""

import numpy as np
import pyarrow as pa

from auditlens.llm import ngram_join
from auditlens.llm.packed import pack
from tests.llm import brute


def test_lists_that_neighbours_cover_are_done():
    key = np.repeat(np.array([1, 2, 3], np.uint64), [2, 3, 4])
    columns = [pa.array(key), pa.array(np.arange(9)), pa.array(np.full(9, 100, np.int32)), pa.array(np.zeros(9, np.int32))]
    block = pack(pa.Table.from_arrays(columns, schema=ngram_join.ENTRY))
    rows = ngram_join._met(14, 80)(pa.table({"block": pa.array([block], pa.binary())})).to_pylist()
    assert {r["key"] for r in rows if r["kind"] == 2} == {3}
    assert sorted((r["a"], r["b"]) for r in rows if r["kind"] == 1) == [(0, 1), (2, 3), (2, 4), (3, 4), (5, 6), (5, 7), (6, 7), (6, 8), (7, 8)]


def test_only_lists_with_pairs_left_out_come_again():
    sets = [np.arange(100 * i, 100 * i + 100, dtype=np.uint64) for i in range(3)]
    bits = [ngram_join.parity_bits(sets[i]) for i in (0, 0, 0, 0, 1, 1, 2, 2)]  # equal bitmaps allow pairs
    columns = {"key": [1] * 4 + [2] * 4, "a": range(8), "n": [100] * 8, "root": range(8), "bits": bits}
    types = {"key": pa.int64(), "a": pa.int64(), "n": pa.int32(), "root": pa.int64(), "bits": pa.binary()}
    group = pa.table({c: pa.array(list(v), types[c]) for c, v in columns.items()})
    for every, pairs, again in ((False, 3 + 2, [1]), (True, 6 + 2, [])):
        rows = ngram_join._crossing(14, 80, every)(group).to_pylist()
        assert [r["key"] for r in rows if r["key"] is not None] == again
        assert len([r for r in rows if r["key"] is None]) == pairs


def test_links_between_near_copies_that_differ_everywhere(spark):
    rng, rows = np.random.default_rng(5), []
    for g in range(6):
        base = [f"g{g}w{i}" for i in range(120)]
        for _ in range(9):
            words = list(base)
            for at in rng.choice(len(words), rng.integers(1, 6), replace=False):
                words[at] = f"x{rng.integers(1 << 30)}"
            rows.append((len(rows), " ".join(words)))
    got = ngram_join.ngram_components(spark.createDataFrame(rows, "doc_id long, text string"))
    found = sorted(tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect())
    assert found == sorted(brute.components(rows))
