"""Spark sessions.

On a cluster the session comes from the submitter; the library sets nothing on
it, save for the time of a lake job (:func:`tidy_shuffles`).  :func:`local_session`
is for tests and the benchmark.
"""

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "8g",
}


def local_session(cpus: int | str = 8, **settings) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("cdrlake")
    for key, value in (SETTINGS | {"spark.sql.shuffle.partitions": str(cpus)} | settings).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_tidying: dict[str, list] = {}
_lock = threading.Lock()


@contextmanager
def tidy_shuffles(spark: SparkSession) -> Iterator[None]:
    """While open, the shuffle files of each query go when it ends, not when the driver collects its garbage.

    A job of many writes would otherwise hold the shuffles of all of them on disk.  May be
    nested and open in several threads; the last to leave restores what was set.
    """
    session = spark._jsparkSession.sessionUUID()
    with _lock:
        if session not in _tidying:
            _tidying[session] = [0, spark.conf.get(TIDY, None)]
            spark.conf.set(TIDY, "true")
        _tidying[session][0] += 1
    try:
        yield
    finally:
        with _lock:
            _tidying[session][0] -= 1
            if not _tidying[session][0]:
                before = _tidying.pop(session)[1]
                spark.conf.unset(TIDY) if before is None else spark.conf.set(TIDY, before)


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder under the shared folder of the cluster.

    The cluster names it in ``spark.checkpoint.dir``.  Only where that is unset and the
    master is local, as in tests, a local temporary folder is used.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/cdrlake/{purpose}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return os.path.join(tempfile.mkdtemp(prefix="cdrlake-"), purpose)
