"""Session settings, the shared work folder, and shipping the package to workers."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Set only where a job builds its own session; a session handed to the operators
# keeps the settings its cluster gave it.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Lets the archive source skip records by type while it reads.
    "spark.sql.python.filterPushdown.enabled": "true",
}

_shipped: dict[str, str] = {}
_made: dict[str, str] = {}


def build_session(app_name: str, conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers wherever the driver started.

    Done once per application. A cluster job that already passes the package with
    ``--py-files`` loses nothing by it.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    stem = os.path.join(tempfile.mkdtemp(prefix="pagevane-"), "pagevane")
    archive = shutil.make_archive(
        stem, "zip", root_dir=os.path.dirname(package), base_dir=os.path.basename(package)
    )
    spark.sparkContext.addPyFile(archive)
    _shipped[app] = archive


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors all reach, from ``spark.checkpoint.dir``.

    On a cluster it must be named: a folder of one machine would lose stream offsets and can't
    be read by other executors. Only in local mode (tests, a laptop) is one made here.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not re.match(r"local(\[[^,\]]*(,[^\]]*)?\])?$", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _made:
        _made[app] = tempfile.mkdtemp(prefix="pagevane-checkpoint-")
    return _made[app]


def scratch_dir(spark: SparkSession) -> str:
    """A new folder name for tables of this session in the shared folder; removed when Python ends."""
    path = f"{shared_dir(spark).rstrip('/')}/pagevane-scratch-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is None:
        return
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder, so a lost executor costs no recomputation."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)
