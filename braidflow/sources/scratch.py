"""Places for files that a query writes and reads again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: The folder of a session on one machine that names none, as in tests.
_OWN: list[str] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder that the driver and all executors share, below ``spark.checkpoint.dir``.

    A session whose tasks run in the driver's own process (``local``) may leave that unset and gets a temporary folder.
    On a cluster there is no such folder, so it must be set.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or ""
    if not base:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if not _OWN:
            _OWN.append(f"file://{tempfile.mkdtemp(prefix='braidflow-')}")
        base = _OWN[0]
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, place: str) -> None:
    """Delete such a folder once nothing reads it any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
