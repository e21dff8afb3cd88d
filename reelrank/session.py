"""Session and shared-storage helpers."""

from __future__ import annotations

import contextlib
import hashlib
import io
import os
import re
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Iterator

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "reelrank") -> SparkSession:
    """Session for tests and the bench. On a cluster the caller's session is used instead."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``reelrank`` importable in the executors' Python workers.

    Operators that run pandas code on executors (cogrouped block products, streaming state)
    pickle functions of this package by reference. On a cluster the package is normally given to
    ``spark-submit --py-files``; when the caller did not, this zips the package in memory once
    per application, writes it into the shared checkpoint folder and registers it with
    ``addPyFile`` (every executor fetches it from there).
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    files = sorted(os.path.join(d, f) for d, _, fs in os.walk(pkg) for f in fs if f.endswith(".py"))
    buf = io.BytesIO()
    digest = hashlib.sha1()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for f in files:
            with open(f, "rb") as fh:
                data = fh.read()
            digest.update(f.encode() + data)
            zf.writestr(os.path.join("reelrank", os.path.relpath(f, pkg)), data)
    target = f"{checkpoint_root(spark)}/reelrank/pyfiles/reelrank-{digest.hexdigest()[:12]}.zip"
    jvm = sc._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(target)
    fs = hpath.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        out = fs.create(hpath, True)
        try:
            out.write(bytearray(buf.getvalue()))
        finally:
            out.close()
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster-wide shared folder (``spark.checkpoint.dir``).

    A session that names none gets a scratch folder only where the driver and its one executor
    are the same process (master ``local[…]``, as in tests); on a cluster it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
        if root:  # the folder that was set holds one of the context's own
            root = root.rsplit("/", 1)[0]
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="reelrank-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under this application's part of the shared checkpoint folder."""
    return f"{_scratch(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def _scratch(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark)}/reelrank/{spark.sparkContext.applicationId}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete every table this application wrote under the shared folder, once the results that read
    them are stored."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_scratch(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_CLEANING: dict[str, int] = {"depth": 0}
_CLEANING_LOCK = threading.Lock()


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Writes in here delete their shuffle files as soon as they are done, not when the driver happens to collect
    its garbage. The session's own setting comes back afterwards, also with several threads in here."""
    with _CLEANING_LOCK:
        if not _CLEANING["depth"]:
            _CLEANING["was"] = spark.conf.get(_CLEANUP, None)
            spark.conf.set(_CLEANUP, "true")
        _CLEANING["depth"] += 1
    try:
        yield
    finally:
        with _CLEANING_LOCK:
            _CLEANING["depth"] -= 1
            if not _CLEANING["depth"]:
                if _CLEANING["was"] is None:
                    spark.conf.unset(_CLEANUP)
                else:
                    spark.conf.set(_CLEANUP, _CLEANING["was"])


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop FileSystem of the path (works for hdfs/s3/file)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def list_subdirs(spark: SparkSession, path: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return []
    return [s.getPath().getName() for s in fs.listStatus(hpath) if s.isDirectory()]


__all__ = ["build_session", "checkpoint_root", "drop_scratch", "ship_package", "shared_path", "path_exists",
           "list_subdirs", "shuffles_dropped"]
