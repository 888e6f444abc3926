"""The registered queries: a Spark plan and, where SQL can say the same, its SQL text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return keep


def derive(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Derived input columns from engine-neutral expression texts."""
    return df.selectExpr(*[f"{text.format(text='string')} AS {name}" for name, text in columns.items()])


def derive_sql(columns: dict[str, str], source: str) -> str:
    """The same derived columns as a SQL select."""
    return "SELECT " + ", ".join(f"{text.format(text='VARCHAR')} AS {name}" for name, text in columns.items()) + f" FROM {source}"


def load_all() -> None:
    from . import (  # noqa: F401
        calibration_queries,
        chart_queries,
        closed_form_queries,
        cleaning_queries,
        model_queries,
        quality_queries,
        reader_queries,
        record_queries,
        split_queries,
    )
