"""Session for local runs, and the scratch folder that cluster runs share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_ROOTS: dict[str, str] = {}


def local_session(cores: str = "8", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the benchmark. A cluster job brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidecast")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master may go without the setting; it gets one temporary folder
    per application. On a cluster an executor could not see such a folder, so the
    missing setting is an error there.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    app = context.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = _drop_at_exit(spark, tempfile.mkdtemp(prefix="tidecast-"))
    return _LOCAL_ROOTS[app]


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path under the scratch root, dropped when the session ends."""
    return _drop_at_exit(spark, f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}")


def _drop_at_exit(spark: SparkSession, path: str) -> str:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(location)
    return path
