"""Session settings, and tables written to the folder that a cluster shares."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, app: str = "loamwork", **conf: str) -> SparkSession:
    """A session on this machine, for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the session.

    Where it is unset and the master is local (as in tests), a temporary folder is
    made and set; on a cluster without the setting this raises, since a folder of one
    machine would lose the data of the others.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="loamwork-")
        spark.conf.set("spark.checkpoint.dir", path)
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


_recording: ContextVar[list[str] | None] = ContextVar("recording", default=None)


@contextmanager
def steps_into(paths: list[str]) -> Iterator[None]:
    """Add to ``paths`` what new_path() names inside, so that its user can delete it.

    Each user has a list of its own; tables of other users are not touched. In nested
    uses the innermost list gets the paths.
    """
    before = _recording.set(paths)
    try:
        yield
    finally:
        _recording.reset(before)


def new_path(spark: SparkSession, tag: str) -> str:
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    paths = _recording.get()
    if paths is not None:
        paths.append(path)
    return path


def delete_paths(spark: SparkSession, paths: list[str]) -> None:
    """Delete the tables at ``paths`` and empty the list.

    Only when no DataFrame that reads those tables is used any more.
    """
    while paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(paths[-1])
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
        paths.pop()


def materialise(df: DataFrame, tag: str = "step") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    It cuts the lineage: what follows survives lost executors by reading the files,
    and reads only the columns it needs.
    """
    spark = df.sparkSession
    path = new_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
