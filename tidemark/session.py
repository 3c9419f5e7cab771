"""Session set-up and the shared work folder."""

from __future__ import annotations

import tempfile
import time
import uuid
from functools import cache

from pyspark.sql import SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"

# 128 MiB of input per task, both for scans and after a shuffle.
_TASK_BYTES = 128 * 1024 * 1024


def shuffle_partitions(input_bytes: int, cores: int) -> int:
    """Shuffle partitions that keep a partition near 128 MiB, at least one per core.

    AQE only merges small partitions, it never makes more of them, so the number set
    here has to fit the largest shuffle of the job.
    """
    return max(cores, -(-input_bytes // _TASK_BYTES))


def get_session(app: str, input_bytes: int | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job of this package relies on.

    Master, memory and executors come from spark-submit. ``input_bytes`` sizes the
    shuffles; without it the cluster's own setting stays.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.files.maxPartitionBytes", str(_TASK_BYTES))
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    if input_bytes is not None:
        cores = spark.sparkContext.defaultParallelism
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions(input_bytes, cores)))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by the cluster.

    Only a local master without that setting gets a folder of its own.
    """
    configured = spark.conf.get(_CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {_CHECKPOINT_DIR} to a folder every executor can reach")
    return _own_dir(context.applicationId)


@cache
def _own_dir(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"tidemark-{application}-")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new folder name below the shared folder; nothing is created yet."""
    return f"{shared_dir(spark)}/tidemark/{label}-{uuid.uuid4().hex}"


def expire_work(spark: SparkSession, older_than_seconds: int, label: str | None = None) -> list[str]:
    """Scheduled: deletes folders of :func:`fresh_dir` that nothing has been added to for so long; returns their names.

    Jobs leave their intermediate tables there, because a result may still have to be read from them. With ``label`` only folders
    that were made under it.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/tidemark")
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(root):
        return []
    bound, gone = int((time.time() - older_than_seconds) * 1000), []
    for folder in files.listStatus(root):
        name = folder.getPath().getName()
        if label is not None and name.rpartition("-")[0] != label:
            continue
        inside = [x.getModificationTime() for x in files.listStatus(folder.getPath())] if folder.isDirectory() else []
        if max([folder.getModificationTime(), *inside]) < bound and files.delete(folder.getPath(), True):
            gone.append(name)
    return sorted(gone)
