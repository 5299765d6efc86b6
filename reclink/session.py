"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the operators are planned for. Hot join keys are split by the adaptive skew join, also where the
# split costs one more exchange; small sides are broadcast only when their measured size is under the threshold. Where all
# parts of one side are small, it is hashed and the other side is not sorted. Long projections are split into methods that
# the virtual machine compiles; it runs methods of over 8,000 bytes uncompiled.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the adaptive settings and pin the session time zone."""
    for key, value in ADAPTIVE.items():
        spark.conf.set(key, value)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@lru_cache(maxsize=1)
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="reclink-")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary folder only for a local master that names none."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return _local_dir()
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in this application's part of the shared folder."""
    return f"{_own_dir(spark)}/{name}-{uuid.uuid4().hex}"


_SCOPE: ContextVar[str] = ContextVar("scope", default="")


def _own_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/reclink/{spark.sparkContext.applicationId}{_SCOPE.get()}"


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """What scratch and cut write inside goes when the block ends; the block must store the results that read it."""
    before = _SCOPE.set(f"{_SCOPE.get()}/run-{uuid.uuid4().hex}")
    try:
        yield
    finally:
        release(spark)
        _SCOPE.reset(before)


def release(spark: SparkSession) -> None:
    """Delete what this application, or the open scope, wrote by scratch and cut, when the last result that reads it is stored."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_own_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write the table to the shared folder and read it back, so that lost executors do not replay its lineage."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
