"""Session construction and reliable materialisation of stages."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


#: Longer methods are interpreted by the JVM (HotSpot's HugeMethodLimit). The joins of the transaction grain in one
#: generated method are longer; with this limit Spark generates one method an operator instead.
METHOD_LIMIT, COMPILED_BYTES = "spark.sql.codegen.hugeMethodLimit", "8000"


def build_session(app: str = "costloom", master: str | None = None,
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings the jobs assume (AQE on, UTC, no UI)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        METHOD_LIMIT: COMPILED_BYTES,
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def compile_joins(spark: SparkSession) -> None:
    """Lowers Spark's default limit on generated methods to what the JVM compiles; another setting stays."""
    if spark.conf.get(METHOD_LIMIT) == "65535":
        spark.conf.set(METHOD_LIMIT, COMPILED_BYTES)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; only a local session may fall back
    to a scratch folder of its own."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master == "local" or sc.master.startswith("local["):
        path = tempfile.mkdtemp(prefix="costloom-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        sc.setCheckpointDir(path)
        return sc.getCheckpointDir()
    raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")


def stage_root(spark: SparkSession) -> str:
    return ensure_checkpoint_dir(spark).rstrip("/") + "/costloom-stages"


#: Paths that the session owns: one list for each open ``stages`` block, innermost last.
_BLOCKS: list[list[str]] = []


@contextmanager
def stages(spark: SparkSession) -> Iterator[list[str]]:
    """Every stage that is written inside the block is removed at its end, so frames that read
    one must be consumed before. Blocks may stand in each other; an inner one keeps its own."""
    _BLOCKS.append([])
    try:
        yield _BLOCKS[-1]
    finally:
        remove_stages(spark, _BLOCKS.pop())


def own(spark: SparkSession, path: str) -> str:
    """Gives a path below the stage folder to the open ``stages`` block. What no block or job
    removes goes when the driver ends: the file system deletes it as it closes."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)
    if _BLOCKS:
        _BLOCKS[-1].append(path)
    return path


def materialize(df: DataFrame, name: str = "stage", kept: list[str] | None = None, codec: str = "snappy") -> DataFrame:
    """Cut lineage by writing the stage as Parquet under the shared checkpoint folder and
    reading it back. Unlike an RDD checkpoint, the re-read prunes columns, pushes filters
    and carries size statistics; and a lost executor costs a re-read, not a recompute.
    The path is appended to ``kept`` so a job can remove it when it is done; an open ``stages``
    block and the end of the driver remove it too."""
    path = f"{stage_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path, compression=codec)
    own(df.sparkSession, path)
    if kept is not None:
        kept.append(path)
    return df.sparkSession.read.parquet(path)


def remove_stages(spark: SparkSession, paths: list[str]) -> None:
    """Delete staged tables once their readers are done (Hadoop FileSystem API,
    so it works on any shared store the checkpoint folder lives on)."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    while paths:
        path = jvm.org.apache.hadoop.fs.Path(paths.pop())
        fs = path.getFileSystem(conf)
        fs.delete(path, True)
        fs.cancelDeleteOnExit(path)


def under_broadcast_threshold(df: DataFrame) -> bool:
    """Whether Spark's estimate of the frame (file sizes, for a stage) is under the session's
    broadcast threshold. Reads the optimised plan only."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return limit > 0 and int(str(size)) <= int(limit)
