"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", app: str = "ticketlake", memory: str = "12g") -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8" if cores == "*" else str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists on whichever file system the path names."""
    name = spark._jvm.org.apache.hadoop.fs.Path(path)
    return name.getFileSystem(spark._jsc.hadoopConfiguration()).exists(name)


@cache
def _local_base(application: str) -> str:
    return tempfile.mkdtemp(prefix="ticketlake-")


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new, empty folder name under the cluster's shared checkpoint folder.

    Tables that cut lineage go here, so they outlive any executor. Only a local
    session without ``spark.checkpoint.dir`` may fall back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):  # a local-cluster has executors of its own
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = _local_base(spark.sparkContext.applicationId)
    return f"{base.rstrip('/')}/ticketlake/{purpose}-{uuid.uuid4().hex}"
