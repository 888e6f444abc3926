"""Writers. Tables are written in parallel; only one-row documents become a single file."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: tuple[str, ...] = ()) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    elif fmt == "json":
        writer.json(path)
    else:
        raise ValueError(f"unknown format {fmt}")


def write_summary_json(document: DataFrame, path: str) -> None:
    """A one-row nested document; NULL fields are kept."""
    document.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)
