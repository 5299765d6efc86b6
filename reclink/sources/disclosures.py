"""Disclosure files: read, map headers, type, number, resume."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reclink.functions.text import as_column
from reclink.schemas import CASE_STATUSES, DISCLOSURE_KINDS, HEADER_ALIASES, SOURCE_DISCLOSURE

# Rows numbered inside one window group.
NUMBERING_CHUNK = 1 << 20


# Quoted cells may hold line breaks, so a CSV file is read by one task; many files give the parallelism.
CSV = {"header": True, "inferSchema": False, "multiLine": True, "escape": '"', "enforceSchema": False}


def read_disclosure(spark: SparkSession, path: str | list[str], fmt: str = "csv", multi_line: bool = True) -> DataFrame:
    """Read files with one header row in common; every cell of a text file stays text.

    Without `multi_line` a line break ends a row even inside quotes, and large files are split among tasks.
    """
    if fmt == "csv":
        return spark.read.options(**{**CSV, "multiLine": multi_line}).csv(path)
    return spark.read.format(fmt).load(path)


def target_name(header: str, valid: Iterable[str], aliases: Mapping[str, str]) -> str | None:
    name = header.lower()
    return name if name in valid else aliases.get(name)


def normalize_headers(
    df: DataFrame,
    valid: Iterable[str] = DISCLOSURE_KINDS,
    aliases: Mapping[str, str] = HEADER_ALIASES,
    keep: Iterable[str] = (),
) -> DataFrame:
    """Map headers onto the declared names and drop the rest; of two headers for one name the right-most wins.

    `keep` names columns that are no headers of the file and stay as they are.
    """
    source = {}
    for position, header in enumerate(df.columns):
        name = header if header in keep else target_name(header, valid, aliases)
        if name:
            source[name] = position
    placed = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return placed.select(*[F.col(f"_{position}").alias(name) for name, position in source.items()])


def unknown_headers(
    df: DataFrame, valid: Iterable[str] = DISCLOSURE_KINDS, aliases: Mapping[str, str] = HEADER_ALIASES
) -> DataFrame:
    """Headers without a declared name, with the number of filled cells each one drops."""
    unknown = [(i, h.lower()) for i, h in enumerate(df.columns) if target_name(h, valid, aliases) is None]
    if not unknown:
        return df.sparkSession.createDataFrame([], "header string, filled bigint")
    placed = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    counts = placed.agg(*[F.count(f"_{i}").alias(f"_{i}") for i, _ in unknown])
    rows = F.array(*[F.struct(F.lit(h).alias("header"), F.col(f"_{i}").alias("filled")) for i, h in unknown])
    return counts.select(F.inline(rows))


def _typed(kind: str, cell: Column) -> Column:
    text = F.trim(cell.cast("string"))
    if kind == "flag":
        word = F.lower(text)
        return F.when(word.isin("y", "yes", "true", "t", "1"), True).when(
            word.isin("n", "no", "false", "f", "0"), False
        )
    if kind == "day":
        return text.try_cast("date")
    if kind == "stamp":
        return text.try_cast("timestamp_ntz")
    if kind == "amount":
        number = text.try_cast("decimal(18,2)")
        return F.when(number >= 0, number)
    if kind == "count":
        number = text.try_cast("int")
        return F.when(number >= 0, number)
    if kind == "code":
        return F.when(F.length(cell) <= 10, cell)
    if kind == "status":
        return F.when(cell.isin(*CASE_STATUSES), cell)
    return cell.cast("string")


def cast_to_schema(df: DataFrame, kinds: Mapping[str, str] = DISCLOSURE_KINDS) -> tuple[DataFrame, DataFrame]:
    """Typed rows, and one reject row per cell that its rule refused. Columns without a rule pass through."""
    typed = df.withColumns({c: _typed(kinds[c], F.col(c)) for c in df.columns if c in kinds})
    ruled = [c for c in df.columns if kinds.get(c, "text") not in ("text", "time")]
    kept = [c for c in ("file_name", "file_row", "case_number") if c in df.columns]
    if not ruled:
        return typed, df.select(*kept).limit(0).withColumns({"column": F.lit(""), "value": F.lit("")})
    cells = [
        F.when(
            F.col(c).isNotNull() & (F.trim(F.col(c).cast("string")) != "") & _typed(kinds[c], F.col(c)).isNull(),
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")),
        )
        for c in ruled
    ]
    refused = F.filter(F.array(*cells), lambda cell: cell.isNotNull())
    rejects = df.select(*kept, F.inline(refused))
    return typed, rejects


def number_rows(df: DataFrame, group: str, position: str, name: str = "row_number") -> DataFrame:
    """1-based row number per group in order of a whole-number position.

    A group may be most of the table, so rows are numbered inside chunks of the position range, and a chunk starts after
    the rows counted in the chunks before it. Rows without a position come last, in no stated order.
    """
    chunk = F.floor(F.col(position) / NUMBERING_CHUNK).alias("_chunk")
    counts = df.groupBy(group, chunk).agg(F.count("*").alias("_n"))
    before = Window.partitionBy(group).orderBy(F.col("_chunk").asc_nulls_last())
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col(group).alias("_group"),
        F.col("_chunk").alias("_start_chunk"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
    )
    inside = F.row_number().over(Window.partitionBy(group, "_chunk").orderBy(position))
    numbered = df.select("*", chunk).withColumn("_inside", inside)
    joined = numbered.join(
        starts, numbered[group].eqNullSafe(starts["_group"]) & numbered["_chunk"].eqNullSafe(starts["_start_chunk"])
    )
    return joined.select(*df.columns, (F.col("_start") + F.col("_inside")).cast("int").alias(name))


def add_provenance(
    df: DataFrame, file_name: Column | str = "file_name", position: str = "position", seen: str = "received_date"
) -> DataFrame:
    """Source, file name, 1-based row number in the file, and both seen dates from the received date."""
    named = df.withColumn("file_name", as_column(file_name))
    numbered = number_rows(named, "file_name", position, "file_row")
    return numbered.withColumns(
        {"source": F.lit(SOURCE_DISCLOSURE), "first_seen": F.col(seen), "last_seen": F.col(seen)}
    )


def resume_offset(loaded: DataFrame, files: DataFrame) -> DataFrame:
    """Last loaded row per file, and whether the file is complete. `files` counts rows with the header."""
    last = loaded.groupBy("file_name").agg(F.max("file_row").alias("last"))
    offset = F.coalesce(F.col("last"), F.lit(0))
    return files.join(last, "file_name", "left").select(
        "file_name",
        offset.alias("next_row"),
        ((offset > 0) & (offset + 1 >= F.col("n_rows"))).alias("done"),
    )


def import_remaining(incoming: DataFrame, loaded: DataFrame) -> DataFrame:
    """Incoming rows that lie after the last loaded row of their file."""
    last = loaded.groupBy("file_name").agg(F.max("file_row").alias("_last"))
    rest = F.col("file_row") > F.coalesce(F.col("_last"), F.lit(0))
    return incoming.join(last, "file_name", "left").where(rest).select(*incoming.columns)


def write_snapshot(df: DataFrame, path: str) -> str:
    """Write a table as a new version folder in one atomic job."""
    df.write.mode("errorifexists").parquet(path)
    return path
