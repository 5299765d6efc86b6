"""Registry of queries, and SQL with the adapters as common table expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reclink.session import configure
from reclink.sources.adapters import ADAPTERS, BASE, Tables, dependencies

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Steps of the checking SQL, written for DuckDB; each may use base tables, adapters and other steps.
STEPS: dict[str, str] = {}


def sql(body: str) -> str:
    """One statement: the body, with all tables it needs in front."""
    texts = {**ADAPTERS, **STEPS}
    needed: dict[str, str] = {}

    def visit(text: str) -> None:
        for name in dependencies(text):
            if name not in BASE and name not in needed:
                visit(texts[name])
                needed[name] = texts[name]

    visit(body)
    filled = {name: text.format(**{d: d for d in dependencies(text)}) for name, text in needed.items()}
    front = ", ".join(f"{name} as materialized ({text})" for name, text in filled.items())
    main = body.format(**{d: d for d in dependencies(body)})
    return f"with {front} {main}" if front else main


def plain(df: DataFrame) -> DataFrame:
    """Dates as text, lists as joined text, decimals as numbers: types both engines print alike."""
    out = {}
    for field in df.schema:
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            out[field.name] = F.col(field.name).cast("date").cast("string")
        elif isinstance(field.dataType, T.ArrayType):
            out[field.name] = F.array_join(field.name, ",")
        elif isinstance(field.dataType, T.DecimalType):
            out[field.name] = F.col(field.name).cast("double")
        elif isinstance(field.dataType, T.DoubleType):
            out[field.name] = F.round(F.col(field.name), 6)
    return df.withColumns(out) if out else df


def query(name: str, body: str | None = None):
    """Register a function of the tables under a name, with its checking SQL if there is one."""

    def register(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return plain(build(Tables(spark, sf_dir)))

        assert name not in QUERIES, name
        QUERIES[name] = run
        if body is not None:
            ORACLES[name] = body
        return build

    return register
