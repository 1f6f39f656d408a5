"""Keeps each runnable query next to the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chatloom.plans.positions import spread

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if key in QUERIES:
            raise ValueError(f"query {key} registered twice")
        QUERIES[key] = fn
        if sql:
            ORACLE[key] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str, key: str, *cols: str) -> DataFrame:
    """A table read for CPU-heavy work: only the named columns, spread over all task slots."""
    return spread(table(spark, sf_dir, name).select(key, *cols), key)


def sql_draw(text: str) -> str:
    """DuckDB twin of :func:`chatloom.functions.seeded.digest32`."""
    return f"(('0x' || substr(md5({text}), 1, 8))::BIGINT)"


def sql_seeded(seed: int, salt: str, id_sql: str) -> str:
    """DuckDB twin of :func:`chatloom.functions.seeded.draw`."""
    return sql_draw(f"'{seed}:{salt}:' || {id_sql}")


def sql_choice(options: list[str], draw_sql: str) -> str:
    """DuckDB twin of :func:`chatloom.functions.seeded.pick` for a literal list."""
    return f"{sql_list(options)}[{draw_sql} % {len(options)} + 1]"


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sql_list(values: list[str]) -> str:
    return "[" + ", ".join(sql_text(v) for v in values) + "]"
