"""What several text operators share: words, Arrow batches of bounded size, and bounded label samples."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a longest run of characters other than space and the control characters from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"

# Rows handed to Python at a time. Batches of the default 10,000 rows of long text would not fit a worker.
BATCH_ROWS = 256


def words(text: str) -> list[bytes]:
    """Words of a text as UTF-8; splitting bytes splits at exactly the six separators of WORD."""
    return text.encode().split()


def map_rows(df: DataFrame, rows: Callable[[Iterator[dict]], Iterator[dict]], schema: str) -> DataFrame:
    """Pass each partition through a generator of dictionaries, in Arrow batches of at most BATCH_ROWS rows."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    target = spark.createDataFrame([], schema).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(target)
        read = (dict(zip(batch.schema.names, values)) for batch in batches for values in _rows_of(batch))
        kept: list[dict] = []
        for row in rows(read):
            kept.append(row)
            if len(kept) >= BATCH_ROWS:
                yield pa.RecordBatch.from_pylist(kept, schema=arrow)
                kept = []
        if kept:
            yield pa.RecordBatch.from_pylist(kept, schema=arrow)

    return df.mapInArrow(run, target)


def _rows_of(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(column.to_pylist() for column in batch.columns))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def crc_fold(folds: int) -> Column:
    """Remainder of the checksum of doc_id as text; null for a null id."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """At most per_class documents of each label value 0 and 1, as (text, n_chars, label) rows.

    Ids are drawn by the order of their hashes, so a rerun draws the same ones. Only the ids, at most 2 * per_class of
    them, are broadcast; the texts are met in one scan without a shuffle. A document whose labels contradict each other,
    or whose id or label is null, is not drawn.
    """
    marked = (
        labels.where(F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min(label).cast("int").alias("_low"), F.max(label).cast("int").alias("_high"))
        .where(F.col("_low") == F.col("_high"))
        .select(F.col("doc_id").alias("_id"), F.col("_low").alias("label"))
    )

    def drawn(value: int) -> DataFrame:
        return marked.where(F.col("label") == value).orderBy(F.xxhash64("_id"), "_id").limit(per_class)

    chosen = drawn(0).unionByName(drawn(1))
    plain = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("n_chars").cast("long").alias("n_chars"))
    return plain.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("text", "n_chars", "label")
