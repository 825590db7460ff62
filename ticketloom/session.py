"""Session settings the jobs rely on, and the shared folder they may write to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# What the jobs rely on. Sizing, shuffle partition counts among it, belongs to the
# cluster.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # On by default, but here a hot day is split by it, so it is not left to chance.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # A task that scans day files meets few days, so it can keep one writer per
    # day open instead of sorting all its rows by day before writing.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # A store of daily loads is thousands of folders to list; a task for each of them
    # takes longer than the listing.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    # A load leaves a few large files among many small ones. By Spark's 4 MB a file, tasks
    # get as many files each, and one of them all the large ones; by this, as many bytes.
    "spark.sql.files.openCostInBytes": "262144",
}


def build_session(app_name: str = "ticketloom") -> SparkSession:
    """A session for spark-submit: master and sizing come from the submit command."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in JOB_CONF.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(cpus: int | str = "*", app_name: str = "ticketloom-local") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in JOB_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_job_conf(spark: SparkSession) -> SparkSession:
    """Put the job settings on a session that somebody else built."""
    for key, value in JOB_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in spark.checkpoint.dir.

    A machine-local folder is made only for a local master that names none.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="ticketloom-"))
    return context.getCheckpointDir().rstrip("/")


def new_work_dir(spark: SparkSession, label: str) -> str:
    """A fresh, not yet existing folder under the shared one."""
    return f"{shared_dir(spark)}/ticketloom-{label}-{uuid.uuid4().hex}"
