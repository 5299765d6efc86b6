"""The queue of files to import."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reclink.schemas import FINISHED, NEEDS_IMPORTING

EVENT = "struct<Records:array<struct<s3:struct<bucket:struct<name:string>,object:struct<key:string>>>>>"


def decode_object_events(events: DataFrame, body: str = "body") -> DataFrame:
    """One (bucket, object) row per record of a storage event; keys are URL-encoded with + for a space."""
    records = F.from_json(F.col(body), EVENT)["Records"]
    # An undecodable key stays as it was sent.
    return events.select(F.explode(records).alias("r")).select(
        F.col("r.s3.bucket.name").alias("bucket"),
        F.coalesce(F.try_url_decode("r.s3.object.key"), F.col("r.s3.object.key")).alias("object"),
    )


def register_import(queue: DataFrame, names: DataFrame, now: Column) -> DataFrame:
    """Append files to the queue as waiting."""
    added = names.select(
        "bucket", "object", F.lit(NEEDS_IMPORTING).alias("status"), now.alias("created"), now.alias("modified")
    )
    return queue.unionByName(added)


def pending_imports(queue: DataFrame, n: int = 1) -> DataFrame:
    """The first n waiting files, oldest first."""
    return queue.where(F.col("status") == NEEDS_IMPORTING).orderBy("created", "bucket", "object").limit(n)


def finish_imports(queue: DataFrame, done: DataFrame, now: Column) -> DataFrame:
    """Mark the loaded files as finished."""
    loaded = done.select(F.col("bucket").alias("_b"), F.col("object").alias("_o")).distinct().withColumn("_hit", F.lit(True))
    same = queue["bucket"].eqNullSafe(loaded["_b"]) & (queue["object"] == loaded["_o"])
    hit = F.col("_hit") & (F.col("status") == NEEDS_IMPORTING)
    return queue.join(loaded, same, "left").select(
        "bucket",
        "object",
        F.when(hit, F.lit(FINISHED)).otherwise(F.col("status")).alias("status"),
        "created",
        F.when(hit, now).otherwise(F.col("modified")).alias("modified"),
    )
