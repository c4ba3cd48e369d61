"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

# Counts over the whole history never drop state, so the store must live on
# disk, and upload only what changed at each commit.
STATE_STORE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Shuffle files go when the statement that made them ends, not when the driver happens to
# collect its garbage.
SHUFFLE_CLEANUP_CONF = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is tuned for.

    The functions of the library work in any session; this one only saves the
    caller from repeating the settings. On a cluster leave ``master`` to
    ``spark-submit`` and pass ``spark.checkpoint.dir``.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    for name, value in {**STATE_STORE_CONF, **conf}.items():
        builder = builder.config(name, value)
    if master:
        builder = builder.master(master)
    return builder.getOrCreate()


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Set runtime options for the block only.

    A streaming query copies the session's options when it starts, so the
    caller's own options can be put back right after.
    """
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that every executor can reach.

    It lies under ``spark.checkpoint.dir``. Where that is unset, a local
    session gets a temporary folder and a cluster gets an error: a folder of
    one machine would be lost with that machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    base = base or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="keybrook-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A ``shared_folder`` that is removed when the session's JVM ends."""
    folder = shared_folder(spark, purpose)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or a folder with all that is in it, if there is one."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
