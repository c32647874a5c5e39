"""Writers. Every one writes a folder of part files in parallel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def sink_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def sink_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def sink_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
