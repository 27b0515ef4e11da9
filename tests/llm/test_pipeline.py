"""The whole pipeline against brute force, on a small fixture, and the driver's contract."""

import hashlib
import random
import subprocess
import sys

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from auditlens.llm import mixing, queries
from tests.llm import brute
from tests.llm.test_operators import prose


def fixture_rows():
    rng, rows = random.Random(11), []
    passage = prose(77, 70)
    for i in range(60):
        w = prose(1000 + i % 45, 120).split()
        if i >= 45:  # near copies of the first fifteen
            w[rng.randrange(len(w))] = "edited"
        text = " ".join(w)
        if i % 9 == 0:
            text += " " + passage
        rows.append((i, text if i % 13 else "too short", "en", ["s1", "s2", "s3", None][min(i % 7, 3)], len(text)))
    return rows


def mixed(rows):
    """How often each (doc_id, text, source) is taken."""
    size = {d: len(brute.words(t)) for d, t, _ in rows}
    sources = sorted({s for _, _, s in rows}, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sources)}
    total = {s: sum(size[d] for d, _, t in rows if t == s) for s in sources}
    target, open_sources, left = {}, set(sources), float(sum(total.values()))
    while True:
        share = {s: left * weight[s] / sum(weight[t] for t in open_sources) for s in open_sources}
        full = [s for s in open_sources if share[s] > 3 * total[s]]
        if not full:
            target |= share
            break
        for s in full:
            target[s] = 3.0 * total[s]
            left -= target[s]
            open_sources.remove(s)
    out = {}
    for s in sources:
        words = int(target[s] + 0.5)
        passes, rest = divmod(words, total[s]) if total[s] else (0, 0)
        upto = 0
        place = lambda d: int(hashlib.md5(f"{mixing.SEED}:{d}".encode()).hexdigest()[:15], 16)
        for d in sorted((d for d, _, t in rows if t == s), key=place):
            upto += size[d]
            out[d] = passes + (size[d] > 0 and 2 * upto - size[d] <= 2 * rest)
    return out


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    path = str(tmp_path_factory.mktemp("tables"))
    rows = fixture_rows()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(r[0], 1, 0) for r in rows], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    yield path
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_pipeline_equals_brute_force(spark, folder):
    rows = [(d, t, s) for d, t, _, s, _ in fixture_rows() if len(brute.words(t)) >= 50]
    roots = brute.linked([brute.shingles(t) for _, t, _ in rows])
    first = {}
    for (d, _, _), r in zip(rows, roots):
        first.setdefault(r, d)
    rows = [r for r in rows if r[0] in first.values()]
    texts = []
    all_texts = [(d, t.encode()) for d, t, _ in rows]
    for (d, t, s), (_, b) in zip(rows, all_texts):
        gone = bytearray(len(b))
        for i in range(len(b) - 199):
            if sum(other.count(b[i : i + 200]) for _, other in all_texts) > 1:
                gone[i : i + 200] = b"\1" * 200
        texts.append((d, bytes(x for x, g in zip(b, gone) if not g).decode(), s))
    own, want = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), []
    taken = mixed(texts)
    for d, t, _ in texts:
        ids = own.encode(t, add_special_tokens=False).ids
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), own.decode(ids, skip_special_tokens=False))]
        want += [(d, len(ids), *digests)] * taken[d]
    got = corpus_pipeline.run(spark, folder)
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 20


def test_stages_take_empty_tables_and_keep_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns and out.count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == 0


def test_one_query_for_each_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14)) and set(queries.ORACLES) <= set(queries.QUERIES)


def test_nothing_else_imports_the_package():
    code = "import sys, auditlens.plans.catalogue; assert not any(m.startswith('auditlens.llm') for m in sys.modules)"
    assert subprocess.run([sys.executable, "-c", code]).returncode == 0
