"""Session helpers: building a session and finding the shared folder."""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; cluster sizing stays with spark-submit.

    Keyword names use ``__`` for dots: ``spark__sql__shuffle__partitions="64"``.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session (tests, laptops) may go without the setting; it
    then gets a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    own = tempfile.mkdtemp(prefix="folioscope-")
    spark.sparkContext.setCheckpointDir(own)
    spark.conf.set("spark.checkpoint.dir", own)
    return own


_run: ContextVar[str | None] = ContextVar("run folder", default=None)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the run folder, or else the shared one, that nothing has been written to yet."""
    return f"{_run.get() or shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def remove_path(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def run_folder(spark: SparkSession, name: str = "run") -> Iterator[str]:
    """Everything stored within the block goes to one folder, which is deleted when the block ends.

    Frames that read stored tables must be written elsewhere, or not be used any more, by then.
    """
    path = fresh_path(spark, name)
    outer = _run.set(path)
    try:
        yield path
    finally:
        _run.reset(outer)
        remove_path(spark, path)
