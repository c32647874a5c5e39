"""Readers for the file kinds the operators start from."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def scan_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Header CSV, quote-aware, empty field = null. Without a schema the types are inferred (one extra scan)."""
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", False)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def scan_json(
    spark: SparkSession, path: str, schema: StructType | str | None = None, multi_line: bool = False
) -> DataFrame:
    """JSON records. Line-delimited files split across tasks; ``multi_line`` is for one array per file."""
    reader = spark.read.option("multiLine", multi_line)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def scan_parquet_recent(spark: SparkSession, path: str, ts_col: str, key: str, n: int = 1000) -> DataFrame:
    """Newest ``n`` rows; the top-n runs per partition before one merge."""
    return spark.read.parquet(path).orderBy(F.col(ts_col).desc(), F.col(key).desc()).limit(n)


def scan_documents(
    spark: SparkSession, path: str, suffixes: Sequence[str] = ("txt", "md", "py")
) -> DataFrame:
    """Whole-file text of a folder tree: ``(path, content)``; files that are not UTF-8 are left out."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.{" + ",".join(suffixes) + "}")
        .load(path)
    )
    return files.select("path", F.try_validate_utf8(F.col("content").cast("string")).alias("content")).filter(
        F.col("content").isNotNull()
    )


def register_table(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Make ``df`` queryable as ``name``, replacing an earlier registration."""
    df.createOrReplaceTempView(name)
    return spark.table(name)


def run_sql(spark: SparkSession, sql: str, args: dict[str, Any] | None = None) -> DataFrame:
    return spark.sql(sql, args=args or {})


def table_catalog(tables: dict[str, DataFrame], samples: int = 3) -> DataFrame:
    """One row per table column: table, column, position, type and the values of the ``samples`` smallest rows.

    Rows are ordered by all columns from the left, so every run shows the same sample (a top-n, no full sort).
    """
    parts = []
    for name, df in tables.items():
        cols = df.columns
        head = df.orderBy(*cols).limit(samples).agg(F.array_sort(F.collect_list(F.struct(*cols))).alias("rows"))
        meta = F.array(
            *[
                F.struct(
                    F.lit(name).alias("table"), F.lit(c).alias("column"), F.lit(i).alias("position"),
                    F.lit(t).alias("type"), F.col("rows").getField(c).cast("array<string>").alias("sample_values"),
                )
                for i, (c, t) in enumerate(df.dtypes)
            ]
        )
        parts.append(head.select(F.inline(meta)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# Statement words that change data.
WRITE_WORDS = ("DROP", "DELETE", "TRUNCATE", "UPDATE", "INSERT")


def sql_history_audit(history: DataFrame, query_col: str = "query") -> DataFrame:
    """Add ``unsafe`` and ``matched``: write words found anywhere in the upper-cased statement."""
    up = F.upper(F.col(query_col))
    matched = F.filter(
        F.array(*[F.when(up.contains(w), F.lit(w)) for w in WRITE_WORDS]), lambda w: w.isNotNull()
    )
    return history.withColumn("matched", F.array_join(matched, ",")).withColumn("unsafe", F.col("matched") != "")


def parse_timestamps(df: DataFrame, c: str, fmt: str | None = None) -> DataFrame:
    """String to timestamp without zone; unparsable text becomes null."""
    parsed = F.try_to_timestamp(F.col(c), F.lit(fmt)) if fmt else F.try_to_timestamp(F.col(c))
    return df.withColumn(c, parsed.cast("timestamp_ntz"))
