"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks. On a cluster, bring your own."""
    spark = (SparkSession.builder.master(f"local[{cores}]").appName("corpusforge")
             .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.adaptive.enabled", "true")
             # The JVM does not compile larger methods, which slows down scoring
             # with many rewards.
             .config("spark.sql.codegen.hugeMethodLimit", "8000")
             .config("spark.ui.enabled", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new path below the cluster's checkpoint folder.

    Only a local session may fall back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="corpusforge-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
