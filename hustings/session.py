"""Session, tables and the folder that all executors share."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def local_session(app: str = "hustings", cores: str = "*", **conf: str) -> SparkSession:
    """A session for tests and benches; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table by name."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir; where it is unset, as in tests on a local master, one of our own.

    A folder of the driver's own machine is of no use to executors elsewhere, so off a local master the setting must be there.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if not named:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors share: the master is {master}")
        named = tempfile.mkdtemp(prefix="hustings-")
        atexit.register(shutil.rmtree, named, True)
        spark.conf.set(CHECKPOINT_DIR, named)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut by a checkpoint in the shared folder, which survives the loss of an executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """``df`` in as many partitions as there are cores if it is read in fewer, as a table of one small file is; else as it is.

    For what costs much more to work on than to shuffle.  A large input has more partitions than cores and isn't touched.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 2 * df._jdf.rdd().getNumPartitions() <= cores else df
