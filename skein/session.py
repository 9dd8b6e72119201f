"""Session construction shared by the bench, the tests and interactive use."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "skein", cpus: int | str = "*", shuffle_partitions: int | None = None, **extra: str) -> SparkSession:
    """A local session with adaptive execution on and the clock pinned to UTC.

    On a cluster the submitter's own settings win: only what is unset is set here.
    """
    builder = (
        SparkSession.builder.appName(app)
        .master(f"local[{cpus}]")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", extra.pop("driver_memory", "8g"))
        .config("spark.ui.showConsoleProgress", "false")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in extra.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in spark.checkpoint.dir. Only where that is unset on one machine (local runs, tests) a folder is made and named there."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="skein-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


#: Paths that this process has made in the shared folder, in order.
_made: list[str] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    _made.append(f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}")
    return _made[-1]


def _sweep_at_exit() -> None:
    """Results are read lazily from scratch tables, so those of queries go when the driver ends. What can't be removed then, as the session is gone, is in the shared folder under these names."""
    spark = SparkSession.getActiveSession()
    for path in _made:
        if path.startswith("file://") or spark is not None:
            with contextlib.suppress(Exception):
                remove(spark, path)


atexit.register(_sweep_at_exit)


def mark() -> int:
    """A place in the list of scratch paths, for sweep."""
    return len(_made)


def sweep(spark: SparkSession, since: int, keep: str) -> None:
    """Removes what was made since a mark, but for one path. What reads the others has to be done."""
    for path in _made[since:]:
        if path != keep:
            remove(spark, path)
    _made[since:] = [keep]


def written(df: DataFrame, name: str = "cut") -> DataFrame:
    """df, written to the shared folder and read again: its lineage ends there, and a lost executor costs nothing."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a path of the shared folder, whatever file system it is on."""
    if path.startswith("file://"):
        shutil.rmtree(path[7:], ignore_errors=True)
        return
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
