"""Session helpers shared by tests, bench and the query registry."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: str | int = "*", app: str = "loomset") -> SparkSession:
    """A local session for tests and bench. On a cluster use the one you are given."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # small test tables should still use all cores after a shuffle
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.extraJavaOptions", "-Xss8m")
        .getOrCreate()
    )


#: set to true to deal out the rows of small single files, as the bench does
SPREAD = "spark.loomset.spreadSmallFiles"


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees, as the cluster names it in spark.checkpoint.dir.

    Only a local master may fall back to a temporary folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    already = context.getCheckpointDir()
    if already:
        return already
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    path = tempfile.mkdtemp(prefix="loomset-")
    context.setCheckpointDir(path)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: survives the loss of executors."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def written_table(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back, so later stages start from files."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Rows of one small file over all cores of this machine, where the session asks for it with SPREAD.

    Only the bench does, whose tables are single row groups; on a cluster no shuffle is ever added.
    """
    spark = df.sparkSession
    return df.repartition(spark.sparkContext.defaultParallelism) if spark.conf.get(SPREAD, "false") == "true" else df
