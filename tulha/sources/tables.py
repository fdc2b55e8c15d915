"""Catalogue: which tables a layer holds and a profile of each."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_tables(spark: SparkSession, databases: list[str]) -> list[str]:
    """Qualified table names of the databases, in name order."""
    return sorted(
        f"{db}.{row.tableName}"
        for db in databases
        for row in spark.sql(f"SHOW TABLES IN `{db}`").collect()
        if not row.isTemporary
    )


def profile_table(df: DataFrame, name: str, loaded_at: str = "_ingest_ts") -> DataFrame:
    """Rows, columns, share of NULL cells and latest load of one table, in one pass."""
    data = [c for c in df.columns if not c.startswith("_")]
    nulls = sum((F.count_if(F.col(f"`{c}`").isNull()) for c in data), F.lit(0))
    latest = F.max(loaded_at) if loaded_at in df.columns else F.lit(None).cast("timestamp_ntz")
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        nulls.cast("bigint").alias("null_cells"),
        latest.alias("last_ingest_ts"),
    ).select(
        F.lit(name).alias("table_name"),
        "n_rows",
        F.lit(len(data)).alias("n_columns"),
        F.when(F.col("n_rows") > 0, F.round(F.col("null_cells") / (F.col("n_rows") * max(len(data), 1)), 6)).alias("null_ratio"),
        "last_ingest_ts",
    )


def table_inventory(spark: SparkSession, databases: list[str]) -> DataFrame:
    """The profile of every table found, one row each."""
    names = list_tables(spark, databases)
    if not names:
        raise ValueError(f"no tables in {databases}")
    return reduce(DataFrame.unionByName, [profile_table(spark.table(n), n.split(".", 1)[1]) for n in names])
