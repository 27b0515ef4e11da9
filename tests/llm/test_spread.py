"""How index blocks of the neighbours are dealt."""

import numpy as np

from auditlens.llm import neighbours


def test_full_bucket_is_spread_by_its_count():
    rng = np.random.default_rng(4)
    n = 2_400_000
    bucket = rng.integers(0, 1 << 16, n).astype(np.uint64)
    bucket[: n // 3] = 77
    per_table = n // neighbours.INDEX_ROWS
    fan = neighbours.fans(np.bincount(bucket.astype(np.int64), minlength=1 << 16), per_table)
    part = neighbours.dealt(bucket, np.arange(n) * 8, fan, per_table)
    assert np.bincount(part.astype(np.int64)).max() < 1.5 * neighbours.INDEX_ROWS  # 8 fixed parts: 100,000 rows and more
