"""Session settings for tests and benchmarks, and the shared scratch folder."""

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: str | int = "*", app: str = "tieout", **extra: str) -> SparkSession:
    """A local session. On a cluster the submitted session is used as it is.

    Only settings a cluster would also carry are changed: UTC, and adaptive execution
    with its skew handling. Shuffle partitions are the upper bound AQE coalesces from.
    """
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        fresh = tempfile.mkdtemp(prefix="run-")
        atexit.register(shutil.rmtree, fresh, ignore_errors=True)  # this session's own
        spark.conf.set("spark.checkpoint.dir", fresh)
        return fresh
    raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; never reused, so a retry cannot see old files."""
    return f"{shared_dir(spark)}/tieout-{label}-{uuid.uuid4().hex}"
