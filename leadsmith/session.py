"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "leadsmith") -> SparkSession:
    """Build (or reuse) a session with UTC time, AQE and Arrow on, UI off.

    On a cluster the master and the checkpoint folder come from the launcher;
    locally (tests, bench) we fill in only what is unset.
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        # call-site capture costs milliseconds per Column call when building wide rule projections
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # rule projections are wide: keep generated methods small enough for the JIT (HotSpot
        # does not compile methods over 8000 bytes; larger stages fall back to split codegen)
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
    )
    launched = "PYSPARK_GATEWAY_PORT" in os.environ  # by spark-submit, whose settings hold
    if master or not launched:
        builder = builder.master(master or f"local[{cpus}]")
    if shuffle_partitions or not launched:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
    if not launched:
        builder = builder.config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "4g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    small_methods(spark)
    ensure_checkpoint_dir(spark)
    return spark


def small_methods(spark: SparkSession) -> None:
    """Let stages whose generated method the JIT would refuse fall back to split code."""
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a scratch one only if unset.

    On a cluster ``spark.checkpoint.dir`` names shared storage and is left alone;
    tests and local runs get a fresh folder under the system temp directory.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on the cluster file system)")
        current = tempfile.mkdtemp(prefix="leadsmith-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back: its work is done
    once, its lineage is cut, and later reads take only the columns they need."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
