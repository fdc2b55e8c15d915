"""Silver layer: typed columns, one row per natural key, pseudonyms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def typed(df: DataFrame, contract: Mapping[str, str], rejected: str = "_rejeitadas") -> DataFrame:
    """Cast text columns by contract; `rejected` lists the columns whose text did not parse."""
    cast = {c: F.col(c).try_cast(t) for c, t in contract.items()}
    failed = F.array_compact(
        F.array(*[F.when(F.col(c).isNotNull() & cast[c].isNull(), F.lit(c)) for c in contract])
    )
    others = [c for c in df.columns if c not in contract]
    return df.select(*others, *[e.alias(c) for c, e in cast.items()], failed.alias(rejected))


def split_typed(df: DataFrame, contract: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Rows that meet the contract, and the original rows that do not, with the failing columns."""
    kept = df.select("*", F.struct(*df.columns).alias("_origem"))
    done = typed(kept, contract)
    good = done.where(F.size("_rejeitadas") == 0).drop("_rejeitadas", "_origem")
    bad = done.where(F.size("_rejeitadas") > 0).select("_origem.*", "_rejeitadas")
    return good, bad


def latest_by_key(
    df: DataFrame, key: Sequence[str], order: Sequence[str] = ("_ingest_ts", "_source_file")
) -> DataFrame:
    """One row per natural key: the latest load, then the greater file name, then the row that hashes higher.

    `row_number` = 1 lets Spark keep one row per key in every map task before
    the shuffle, so a key that fills a third of the table stays cheap.
    """
    newest = Window.partitionBy(*key).orderBy(*[F.desc_nulls_last(c) for c in order], F.desc(F.xxhash64(F.to_json(F.struct(*df.columns)))))
    return df.withColumn("_rn", F.row_number().over(newest)).where("_rn = 1").drop("_rn")


def pseudonym(value: Column, salt: Column) -> Column:
    """Salted SHA-256 of a personal value; NULL stays NULL."""
    return F.sha2(F.concat(salt, value.cast("string")), 256)


def pseudonymised(df: DataFrame, columns: Sequence[str], salt: str) -> DataFrame:
    """Replace personal columns by pseudonyms.

    The salt comes in as a row of a joined one-row table, not as a literal, so
    that no plan or event log shows it.
    """
    if not salt:
        raise ValueError("a salt is required")
    row = df.sparkSession.createDataFrame([(salt,)], "_salt string")
    return df.join(F.broadcast(row)).withColumns({c: pseudonym(F.col(c), F.col("_salt")) for c in columns}).drop("_salt")
