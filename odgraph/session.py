"""Session-level helpers: the shared checkpoint folder and scratch outputs.

The library never builds a session.  Reliable checkpoints and intermediate
tables go to the folder the cluster names in ``spark.checkpoint.dir``; only
when nothing is configured and the master is local (tests, laptops) does the
library pick a local folder itself.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting it from the conf if needed."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: iterative operators need a shared, "
            "reliable folder (HDFS/S3/...) for checkpoints on a cluster"
        )
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="odgraph-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/odgraph-out/{name}-{uuid.uuid4().hex[:12]}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete every table this application wrote with :func:`scratch_path`; call it
    when the results that read them are saved."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_dir(spark).rstrip('/')}/odgraph-out")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
