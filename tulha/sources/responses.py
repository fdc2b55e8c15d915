"""Landed responses of a statistics service: survey list, metadata, periods, data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tulha.functions.names import computed_once

# Shapes of the JSON documents.
BLOCK_SCHEMA = (
    "struct<variavel:string, unidade:string, resultados:array<struct<"
    "classificacoes:array<struct<id:string, nome:string, categoria:map<string,string>>>,"
    "series:array<struct<localidade:struct<id:string, nome:string>, serie:map<string,string>>>>>>"
)
DATA_SCHEMA = f"array<{BLOCK_SCHEMA}>"
CATALOGUE_SCHEMA = "array<struct<id:string, nome:string, agregados:array<struct<id:string, nome:string>>>>"
METADATA_SCHEMA = (
    "struct<id:string, variaveis:array<struct<id:string>>, classificacoes:array<struct<id:string>>,"
    "nivelTerritorial:struct<Administrativo:array<string>>>"
)
PERIODS_SCHEMA = "array<struct<id:string>>"


def read_landed_text(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    """Landed documents as `(body, source_file)`: one per line, or one per file."""
    return spark.read.text(path, wholetext=whole_file).select(
        F.col("value").alias("body"), F.col("_metadata.file_name").alias("source_file")
    )


def parse_body(df: DataFrame, schema: str, body: str = "body", into: str = "parsed") -> DataFrame:
    """Add the parsed document, parsed once per row; a body that is no such JSON gives NULL."""
    return computed_once(df, into, F.from_json(body, schema, {"mode": "PERMISSIVE"}))
