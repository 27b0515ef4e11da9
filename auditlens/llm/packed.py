"""Shuffles of packed blocks: many small values travel as one compressed Arrow block per
(task, destination). Destinations come from hashes, so no key is one destination, and every
sender has combined its own equal keys before."""

from __future__ import annotations

import ctypes
import gc
import inspect
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from auditlens.llm.text import forget_tables, mix
from auditlens.session import fresh_path

BLOCK = pa.schema([("part", pa.int32()), ("block", pa.binary())])
BLOCK_DDL = "part int, block binary"
FLUSH_BYTES = 16 << 20


def release_memory() -> None:
    """Give memory back to the system: Python workers stay alive between tasks and stages. What an
    earlier task brought along is a cycle of functions and their tables until it is collected."""
    forget_tables()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # absent outside glibc
    if trim:
        trim(0)


def thrifty(scan):
    """``scan`` of Arrow batches that releases its memory at its end."""

    def scanned(batches):
        yield from scan(batches)
        release_memory()

    return scanned


def thrifty_group(work):
    """``work`` on a group (one or two tables) that releases its memory at its end."""

    def one(group):
        out = work(group)
        release_memory()
        return out

    def two(left, right):
        out = work(left, right)
        release_memory()
        return out

    return one if len(inspect.signature(work).parameters) == 1 else two


def tuned(spark: SparkSession) -> SparkSession:
    """Smaller Arrow batches bound a Python worker's memory; results do not change."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1500")
    return spark


def parts_of(spark: SparkSession) -> int:
    """Number of destinations: the session's shuffle partitions, which are set by input size."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: lineage ends there, an executor may go."""
    path = fresh_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def swept(spark: SparkSession) -> None:
    """Have the shuffle files of finished steps removed: Spark does so once the driver's garbage
    collection finds their plans gone, which in a long job may be after the disks are full."""
    spark.sparkContext._jvm.System.gc()


def pack(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def unpack(blocks) -> pa.Table | None:
    """One table from the blocks of a group; None if there is none."""
    got = [pa.ipc.open_stream(b.as_buffer() if isinstance(b, pa.Scalar) else b).read_all() for b in blocks]
    return pa.concat_tables(got) if got else None


def scatter(tables: Iterator[tuple[np.ndarray, pa.Table]]) -> Iterator[pa.RecordBatch]:
    """Blocks for (destination of each row, rows), sent whenever enough has come together."""
    waiting: list[tuple[np.ndarray, pa.Table]] = []
    size = 0
    for part, table in itertools.chain(tables, [(None, None)]):
        if table is not None:
            waiting.append((part, table))
            size += table.nbytes
        if waiting and (table is None or size >= FLUSH_BYTES):
            part = np.concatenate([p for p, _ in waiting])
            rows = pa.concat_tables([t for _, t in waiting]).combine_chunks()
            waiting, size = [], 0
            order = np.argsort(part, kind="stable")
            rows, part = rows.take(pa.array(order)), part[order]
            cut = np.flatnonzero(np.diff(part, prepend=part[:1] - 1)) if len(part) else []
            for lo, hi in zip(cut, [*cut[1:], len(part)]):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(part[lo])], pa.int32()), pa.array([pack(rows.slice(lo, hi - lo))], pa.binary())], schema=BLOCK
                )


def row_blocks(rows: DataFrame, parts: int) -> DataFrame:
    """Whole rows as blocks, dealt by their first column, a 64-bit key."""

    def scan(batches):
        def tables():
            for batch in batches:
                yield (mix(batch.column(0).to_numpy().view(np.uint64)) % np.uint64(parts)).astype(np.int32), pa.Table.from_batches([batch])

        yield from scatter(tables())

    return rows.mapInArrow(thrifty(scan), BLOCK_DDL)
