"""Approximate nearest neighbours by multi-index hashing.

Vectors become binary codes: principal directions of a bounded sample, turned by a learned rotation
that lies closest to the corners of the cube (iterative quantisation), then signs. A code is cut
into substrings, and each has an index of its own over every vector. Two codes that differ in at
most r bits differ in at most floor(r / m) bits of one of their m substrings, so probing all
buckets that near in each index finds every code within r. What is found is reranked by exact
distances of the original vectors. The radius is learned on the sample: the Hamming distance
within which ``COVERED`` of true neighbours lie. A query that finds too few goes through all buckets.

Indexes are blocks of rows dealt by bucket (a full bucket is spread by id over as many blocks as
its measured count asks for), queries are blocks too,
and every query block meets every index block: no task holds all queries or a whole index. Of
equal vectors only as many copies as an answer can hold are searched, those with the smallest ids,
and equal queries are searched once.

Defined results: vectors that are null, all zero, of another length than most, or with null or
non-finite components take no part, nor do rows without an id; a row is its id, so repeated rows
count once, and of an id's different vectors the smallest counts; fewer candidates than k are
all returned; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from auditlens.llm.packed import pack, stored, tuned, unpack
from auditlens.llm.text import mix

SAMPLE = 8_000
SAMPLE_QUERIES = 400
COVERED = 0.985
BITS = 64
SUBSTRING = 16
INDEX_ROWS = 20_000
QUERY_ROWS = 2_048
ROTATIONS = 30


def fit_codes(x: np.ndarray, k: int, seed: int = 7) -> dict:
    """Directions, rotation and search radius from a sample of vectors."""
    mean = x.mean(0)
    bits = min(BITS, x.shape[1])
    _, vectors = np.linalg.eigh(np.cov((x - mean).T).reshape(x.shape[1], -1) if len(x) > 1 else np.eye(x.shape[1]))
    z = (x - mean) @ vectors[:, ::-1][:, :bits]
    rotation = np.linalg.qr(np.random.default_rng(seed).normal(size=(bits, bits)))[0]
    for _ in range(ROTATIONS):
        u, _, v = np.linalg.svd(np.where(z @ rotation >= 0, 1.0, -1.0).T @ z)
        rotation = (u @ v).T
    model = {"mean": mean, "matrix": vectors[:, ::-1][:, :bits] @ rotation, "bits": bits, "radius": bits}
    if len(x) > 10 * k:
        codes, queries = encode(model, x), np.arange(0, len(x), max(1, len(x) // SAMPLE_QUERIES))
        norm, distances = (x * x).sum(1), []
        for q in queries:
            near = norm - 2 * (x @ x[q])
            near[q] = np.inf
            distances.append(np.bitwise_count(codes[np.argpartition(near, k)[:k]] ^ codes[q]))
        model["radius"] = int(np.quantile(np.concatenate(distances), COVERED, method="higher"))
    return model


def encode(model: dict, x: np.ndarray) -> np.ndarray:
    signs = (x - model["mean"]) @ model["matrix"] >= 0
    return (signs.astype(np.uint64) << np.arange(model["bits"], dtype=np.uint64)).sum(1, dtype=np.uint64)


def substrings(bits: int) -> list[tuple[int, int]]:
    """(first bit, length) of each substring."""
    m = max(1, bits // SUBSTRING)
    edges = [bits * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _bucket(codes: np.ndarray, first: int, length: int) -> np.ndarray:
    return (codes >> np.uint64(first)) & np.uint64((1 << length) - 1)


def fans(counts: np.ndarray, per_table: int) -> np.ndarray:
    """Blocks over which buckets with so many rows are spread: an eighth of INDEX_ROWS each."""
    return np.clip(-(-8 * counts // INDEX_ROWS), 1, per_table)


def dealt(bucket: np.ndarray, ids: np.ndarray, fan: np.ndarray, per_table: int) -> np.ndarray:
    """Block of each row; the blocks of one bucket are neighbours, so they all differ."""
    return (mix(bucket) % np.uint64(per_table) + mix(ids.view(np.uint64)) % fan[bucket.astype(np.int64)].astype(np.uint64)) % np.uint64(per_table)


def probe(model: dict, table: int, index: dict, code: np.uint64, radius: int) -> np.ndarray:
    """Rows of one index block within the radius that earlier substrings do not find."""
    parts = substrings(model["bits"])
    near = model["bits"] if radius >= model["bits"] else radius // len(parts)
    first, length = parts[table]
    open_bucket = np.bitwise_count(index["buckets"] ^ _bucket(code, first, length)) <= near
    rows = np.flatnonzero(open_bucket[index["which"]])
    rows = rows[np.bitwise_count(index["codes"][rows] ^ code) <= radius]
    for earlier in parts[:table]:
        rows = rows[np.bitwise_count(_bucket(index["codes"][rows], *earlier) ^ _bucket(code, *earlier)) > near]
    return rows


FOUND_DDL = "vector long, vec_id long, score double"


def _searcher(model: dict, k: int, radius: int):
    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        rows, queries = unpack(left.column("block")), unpack(right.column("block"))
        if rows is not None and queries is not None:
            table = left.column("table")[0].as_py()
            ids, codes = rows.column("vec_id").to_numpy(), rows.column("code").to_numpy()
            x = _matrix(rows.column("x"))
            buckets, which = np.unique(_bucket(codes, *substrings(model["bits"])[table]), return_inverse=True)
            index = {"codes": codes, "buckets": buckets, "which": which}
            qx = _matrix(queries.column("x"))
            for key, code, q in zip(queries.column("vector").to_pylist(), queries.column("code").to_numpy(), qx):
                hit = probe(model, table, index, code, radius)
                far = np.sqrt(((x[hit] - q) ** 2).sum(1))
                if len(hit) > k:  # the k-th distance and its ties
                    near = far <= np.partition(far, k - 1)[k - 1]
                    hit, far = hit[near], far[near]
                best = np.lexsort((ids[hit], far))[:k]
                out.append((np.full(len(best), key), ids[hit[best]], far[best]))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()))], ["vector", "vec_id", "score"])

    return search


def _matrix(column) -> np.ndarray:
    """Rows of little-endian floats as doubles."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.stack([np.frombuffer(v.as_buffer(), np.float32) for v in flat]).astype(np.float64) if len(flat) else np.zeros((0, 1))


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the vectors that take part."""
    x = F.col("embedding")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long"), x.cast("array<float>").alias("embedding"))
    rows = rows.filter(F.col("vec_id").isNotNull() & x.isNotNull() & fine & F.exists(x, lambda v: v != 0))
    length = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("embedding") == (length[0] if length else 0))


def nearest(vectors: DataFrame, queries, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest other rows of each row that the condition
    ``queries`` on vec_id chooses."""
    spark = tuned(vectors.sparkSession)
    rows = usable(vectors).groupBy("vec_id").agg(F.min("embedding").alias("embedding")).withColumn("vector", F.xxhash64("embedding"))
    copies = Window.partitionBy("vector").orderBy("vec_id")
    searched = stored(rows.withColumn("copy", F.row_number().over(copies)).filter(F.col("copy") <= k + 1), "vectors")
    asked = rows.filter(queries).select(F.col("vec_id").alias("query_id"), "vector").distinct()
    n = searched.count()
    wanted = searched.filter("copy = 1").select("vector", "embedding").join(asked.select("vector").distinct(), "vector", "left_semi")
    wanted = stored(wanted, "queries")
    digest = F.pmod(F.xxhash64("vec_id", F.lit("sample")), F.lit(1 << 30))
    drawn = searched.filter(digest < int((1 << 30) * min(1.0, SAMPLE / max(n, 1)))).select("vec_id", "embedding").toArrow().sort_by("vec_id")
    if not drawn.num_rows:
        return asked.select("query_id", F.lit(1).alias("rank"), F.lit(0).cast("long").alias("vec_id"), F.lit(0.0).alias("score")).limit(0)
    model = fit_codes(np.array(drawn.column("embedding").to_pylist(), np.float64), k)
    tables, per_table = len(substrings(model["bits"])), max(1, -(-n // INDEX_ROWS))
    query_blocks = max(1, -(-wanted.count() // QUERY_ROWS))

    def flat(column) -> tuple[np.ndarray, pa.Array]:
        values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(len(column), -1)
        return values.astype(np.float64), pa.array([v.tobytes() for v in values], pa.binary())

    def count(batches):
        pieces = substrings(model["bits"])
        have = [np.zeros(1 << length, np.int64) for _, length in pieces]
        for batch in batches:
            if batch.num_rows:
                codes = encode(model, flat(batch.column(0))[0])
                for n, piece in zip(have, pieces):
                    n += np.bincount(_bucket(codes, *piece).astype(np.int64), minlength=len(n))
        for t, n in enumerate(have):
            full = np.flatnonzero(n)
            columns = [pa.array(np.full(len(full), t, np.int32)), pa.array(full), pa.array(n[full])]
            yield pa.RecordBatch.from_arrays(columns, ["table", "bucket", "n"])

    sizes = searched.select("embedding").mapInArrow(count, "table int, bucket long, n long").groupBy("table", "bucket").agg(F.sum("n").alias("n"))
    large = sizes.filter(F.col("n") * 8 > INDEX_ROWS).toArrow()  # few: they add up to the rows
    fan = [np.ones(1 << length, np.int64) for _, length in substrings(model["bits"])]
    for t, bucket, n in zip(*(large.column(c).to_pylist() for c in ("table", "bucket", "n"))):
        fan[t][bucket] = fans(np.array(n), per_table)

    def index(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, raw = flat(batch.column(1))
            codes, ids = encode(model, x), batch.column(0).to_numpy()
            block = pa.table({"vec_id": batch.column(0), "code": pa.array(codes), "x": raw})
            for t, piece in enumerate(substrings(model["bits"])):
                part = dealt(_bucket(codes, *piece), ids, fan[t], per_table)
                for p in np.unique(part):
                    rows = block.filter(pa.array(part == p))
                    yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), pa.array([int(p)], pa.int32()), pa.array([pack(rows)], pa.binary())], ["table", "part", "block"])

    def ask(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, raw = flat(batch.column(1))
            block = pa.table({"vector": batch.column(0), "code": pa.array(encode(model, x)), "x": raw})
            part = mix(batch.column(0).to_numpy().view(np.uint64)) % np.uint64(query_blocks)
            for p in np.unique(part):
                yield pa.RecordBatch.from_arrays([pa.array([int(p)], pa.int32()), pa.array([pack(block.filter(pa.array(part == p)))], pa.binary())], ["asked", "block"])

    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    blocks = stored(searched.select("vec_id", "embedding").mapInArrow(index, "table int, part int, block binary"), "index")
    keys = ["table", "part", "asked"]

    def search(some: DataFrame, radius: int, only: int) -> DataFrame:
        sent = some.mapInArrow(ask, "asked int, block binary").withColumn("table", every(only)).withColumn("part", every(per_table))
        met = blocks.filter(F.col("table") < only).withColumn("asked", every(query_blocks))
        found = met.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInArrow(_searcher(model, k + 1, radius), FOUND_DDL)
        best = Window.partitionBy("vector").orderBy("score", "vec_id")
        return found.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k + 1).drop("place")

    found = stored(search(wanted, model["radius"], tables), "found")
    short = wanted.join(found.groupBy("vector").count().filter(F.col("count") > min(k, n - 1)).select("vector"), "vector", "left_anti")
    short = stored(short, "short")
    if not short.isEmpty():  # all buckets of one index: every vector
        found = found.join(short.select("vector"), "vector", "left_anti").union(search(short, model["bits"], 1))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    answers = asked.join(found, "vector").filter("vec_id != query_id")
    return answers.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
