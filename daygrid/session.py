"""What the library needs from the Spark session."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"
_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session may go without the setting: its single machine is then the whole cluster.
    """
    folder = spark.conf.get(_CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(_CHECKPOINT_DIR)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"{_CHECKPOINT_DIR} must name a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="daygrid-")
    return _local_folders[app]


def new_work_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def delete_work_folder(spark: SparkSession, path: str) -> None:
    """Remove a path made by ``new_work_folder``, on whatever file system it is."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def empty_files(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """Path and modification time (milliseconds) of files without bytes; Spark's own listings leave them out.

    The names are listed on the driver, as every file scan does; only the empty files' names are kept.
    """
    glob = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = glob.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(glob) or ()
    empty = [status for status in found if status.getLen() == 0 and not status.isDirectory()]
    named = [(status.getPath().toString(), status.getPath().getName(), status.getModificationTime()) for status in empty]
    return [(path, changed) for path, name, changed in named if not name.startswith(("_", "."))]


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings for the length of a block, then as they were."""
    before = {name: spark.conf.get(name) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
