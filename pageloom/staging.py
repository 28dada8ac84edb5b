"""Tables written once to the cluster's shared folder and read back.

A staged table cuts lineage, so a lost executor re-reads files instead of
repeating the parse, and it lets several branches share one pass over the input.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_own_dirs: dict[str, str] = {}  # of local sessions without the setting, by application


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    Only a local session may leave it unset; it then gets a folder of its own.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = tempfile.mkdtemp(prefix="pageloom-")
    return _own_dirs[app]


def stage_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def set_to(spark: SparkSession, name: str, value: object) -> Iterator[None]:
    """A setting of the session meanwhile, unless ``value`` is None; afterwards it is as it was."""
    before = spark.conf.get(name)
    if value is not None:
        spark.conf.set(name, str(value))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def released(spark: SparkSession, release: bool = True) -> AbstractContextManager[None]:
    """Shuffle files of what is written meanwhile go as soon as it is written, if ``release``."""
    return set_to(spark, RELEASE, "true" if release else None)


def stage(df: DataFrame, name: str, schema: StructType | None = None, release: bool = False) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and return a scan of it, which knows its ``staged_path``.

    With ``release`` Spark deletes the shuffle files that led to it as soon as it is written, not at the driver's next collection of garbage.
    """
    spark = df.sparkSession
    path = stage_path(spark, name)
    with released(spark, release):
        df.write.parquet(path)
    out = spark.read.schema(schema or df.schema).parquet(path)
    out.staged_path = path
    return out


def drop_path(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def drop_staged(df: DataFrame) -> None:
    """Delete the files behind a table from :func:`stage` once nothing reads it any more."""
    drop_path(df.sparkSession, df.staged_path)
