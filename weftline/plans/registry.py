"""Named queries and their SQL twins.

SQL texts name tables as $documents; Spark reads them as Parquet files of the given folder, DuckDB as its views.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_TABLE = re.compile(r"\$(region|nation|customer|supplier|part|orders|lineitem|events|documents|embeddings|pages|benchmark|labels|conversations)\b")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound(sql: str, sf_dir: str) -> str:
    return _TABLE.sub(lambda m: f"parquet.`{sf_dir}/{m[1]}.parquet`", sql)


def oracle(sql: str) -> str:
    return _TABLE.sub(r"\1", sql)


def query(name: str, sql: str | None = None) -> Callable:
    """Registers a function (spark, sf_dir) -> DataFrame, with DuckDB SQL for the same rows."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"two queries are called {name}")
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return f

    return add


def sql_query(name: str, spark_sql: str, duck_sql: str | None = None) -> None:
    """Registers a query that Spark SQL states; duck_sql where DuckDB needs other words."""
    query(name, duck_sql or spark_sql)(lambda spark, sf_dir: spark.sql(bound(spark_sql, sf_dir)))
