"""Spark session and shared-storage helpers.

Everything that must outlive a task (lineage cuts, staged tables, stream checkpoints)
goes under the folder the cluster names in ``spark.checkpoint.dir``. Only when that
setting is absent (a laptop, a unit test) do we create one ourselves.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Session settings the operators assume: UTC wall clock (date parts, epoch bounds),
# adaptive execution for runtime coalescing / skew splits / broadcast conversion.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Would put a filter below every explode of a computed array, which computes the array a second time.
    "spark.sql.optimizer.excludedRules": "org.apache.spark.sql.catalyst.optimizer.InferFiltersFromGenerate",
    # Rows handed to Python at once: whole texts may be long, and a worker holds a batch more than once.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def get_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "waka",
                driver_memory: str | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if driver_memory:   # local mode: the driver JVM is the only executor
        builder = builder.config("spark.driver.memory", driver_memory)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> None:
    """Apply the session settings operators rely on to an existing session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    rule, name = BASE_CONF["spark.sql.optimizer.excludedRules"], "spark.sql.optimizer.excludedRules"
    excluded = spark.conf.get(name, "") or ""
    if rule not in excluded:
        spark.conf.set(name, f"{excluded},{rule}" if excluded else rule)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BASE_CONF["spark.sql.execution.arrow.maxRecordsPerBatch"])
    checkpoint_root(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and staged tables.

    Read from the session (``spark.checkpoint.dir``); only if unset, as in tests,
    set a fresh local one.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            root = tempfile.mkdtemp(prefix="waka-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/waka/{name}-{uuid.uuid4().hex[:12]}"


_SCRATCH: list[str] = []      # folders that materialize has written, oldest first


def scratch_mark() -> int:
    """How many folders materialize has written so far."""
    return len(_SCRATCH)


def drop_scratch(spark: SparkSession, mark: int, keep: int = 0) -> None:
    """Delete what materialize has written since ``mark``, but for the last ``keep`` folders. Frames that read a deleted folder can't be used again."""
    last = len(_SCRATCH) - keep
    for path in _SCRATCH[mark:last]:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    del _SCRATCH[mark:max(mark, last)]


#: The JVM never compiles a method of more bytecode than this; it interprets it, row by row.
METHOD_LIMIT = "8000"


@contextmanager
def compiled_methods(spark: SparkSession):
    """For actions on dozens of computed columns. A stage whose generated method would be too long for the JVM's compiler runs as
    separate operators, whose projections are split into short methods, instead of as one interpreted method."""
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, METHOD_LIMIT)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def materialize(df, name: str = "stage"):
    """Cut lineage by writing ``df`` once as parquet under the shared checkpoint folder
    and reading it back (a reliable ``checkpoint()`` computes its input twice unless it
    is also cached; a written table computes it once)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    _SCRATCH.append(path)
    return spark.read.schema(df.schema).parquet(path)
