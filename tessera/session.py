"""Session helpers: building a session for tests/bench and finding shared scratch space."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job in this library relies on. ANSI mode makes casts strict
# (a value that does not fit raises), which is what the import contract needs.
SESSION_DEFAULTS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_session(
    master: str | None = None,
    app_name: str = "tessera",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    On a cluster the launcher normally provides the session; this is for tests,
    the bench and local runs. ``spark.checkpoint.dir`` is left as the environment
    set it; see :func:`shared_dir` for sessions without it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Intermediate tables and lineage cuts go here, never to a machine-local
    temporary folder. Only a local-mode session without the setting gets a
    temporary folder of its own (as in tests).
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        base = tempfile.mkdtemp(prefix="tessera-ckpt-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base


_scratch: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder for one intermediate table.

    The table lives until :func:`release_scratch`, since results read from it lazily.
    """
    path = f"{shared_dir(spark).rstrip('/')}/tessera-scratch/{name}-{uuid.uuid4().hex[:12]}"
    _scratch.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release_scratch(spark: SparkSession) -> int:
    """Remove the intermediate tables that this application made so far; how many there were.

    Call it once the results that read them are written or collected.
    """
    paths = _scratch.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        delete_created(spark, path)
    return len(paths)


@contextmanager
def shuffle_files_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query that begins in the block go when it ends, and not when the driver next collects its garbage.

    For writes: what they read again is the written table.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def delete_created(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table this library created under the scratch root.

    Refuses any path outside ``<spark.checkpoint.dir>/tessera-scratch/``, so it
    can only ever remove the library's own uniquely named outputs.
    """
    root = shared_dir(spark).rstrip("/") + "/tessera-scratch/"
    if not path.startswith(root) or len(path) <= len(root):
        raise ValueError(f"not a scratch path of this library: {path}")
    fs, jpath = hadoop_fs(spark, path)
    fs.delete(jpath, True)


def hadoop_fs(spark: SparkSession, path: str):
    """The Hadoop FileSystem that owns ``path`` (driver-side metadata calls only)."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return jpath.getFileSystem(conf), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = hadoop_fs(spark, path)
    return bool(fs.exists(jpath))
