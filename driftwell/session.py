"""Session settings the operators rely on, and the shared folder for cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

REQUIRED_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",  # last key wins
}


def configure(spark: SparkSession) -> SparkSession:
    for name, value in REQUIRED_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a scratch folder only on a local master."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    made = tempfile.mkdtemp(prefix="driftwell-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


_scope: ContextVar[str] = ContextVar("scope", default="tables")


def materialize(df: DataFrame, label: str, scope: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts lineage, survives lost executors, and gives the planner real sizes.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/driftwell/{scope or _scope.get()}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession):
    """Tables materialized inside are dropped at the end: for jobs that repeat, like micro-batches.

    Yields a ``materialize`` for results that outlive the block.
    """
    outer, name = _scope.get(), f"scratch-{uuid.uuid4().hex}"
    token = _scope.set(name)
    try:
        yield lambda df, label: materialize(df, label, outer)
    finally:
        _scope.reset(token)
        remove(spark, f"{shared_dir(spark)}/driftwell/{name}")


def _file_system(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _file_system(spark, path)
    return files.exists(place)


def make_folder(spark: SparkSession, path: str) -> None:
    files, place = _file_system(spark, path)
    files.mkdirs(place)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    files, place = _file_system(spark, path)
    return [status.getPath().getName() for status in files.listStatus(place)]


def remove(spark: SparkSession, path: str) -> None:
    files, place = _file_system(spark, path)
    files.delete(place, True)
