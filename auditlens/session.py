"""Session helpers: builder for local runs, and the shared working folder of a cluster."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", name: str = "auditlens", memory: str = "12g") -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tune(spark)
    return spark


def tune(spark: SparkSession) -> None:
    """Settings the explanation plans count on; they change speed, never results.

    The JVM does not compile methods above 8,000 bytes of bytecode. Plans that explode rows
    and score them can exceed that when fused into one method, and then run interpreted,
    tens of times slower. Below the limit Spark splits such a stage into small methods.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


_made: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one, kept for the application, only
    in local mode (the setting itself cannot be changed in a running session)."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
    app = spark.sparkContext.applicationId
    if app not in _made:
        _made[app] = tempfile.mkdtemp(prefix="auditlens-")
        spark.sparkContext.setCheckpointDir(_made[app])
    return _made[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/auditlens/{label}-{uuid.uuid4().hex}"


_once: dict[tuple[str, str, str], tuple[str, object]] = {}


def stored_once(spark: SparkSession, source: str, label: str, make) -> DataFrame:
    """``make()`` written to the shared folder once per session and source, and read from there."""
    key = (spark.sparkContext.applicationId, source, label)
    if key not in _once:
        df, path = make(), fresh_path(spark, label)
        df.write.parquet(path)
        _once[key] = path, df.schema
    path, schema = _once[key]
    return spark.read.schema(schema).parquet(path)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as parquet to the shared folder and read it back: cuts the lineage,
    and the result outlives any executor."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
