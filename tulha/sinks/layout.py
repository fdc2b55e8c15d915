"""File layout: partitioned and compressed writes, compaction."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Sequence
from functools import reduce
from operator import and_

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tulha.functions.names import file_path
from tulha.session import fresh_path
from tulha.sinks.evolve import create_table, overwrite_partitions, quoted, rebalanced, rename_table

# Compression by layer.
CODEC = {"bronze": "snappy", "silver": "snappy", "gold": "zstd"}


def write_layer(
    df: DataFrame, path: str, layer: str, partition_by: Sequence[str] = (), mode: str = "errorifexists"
) -> None:
    """Write Parquet with the layer's compression, laid out by `partition_by`."""
    writer = rebalanced(df, partition_by).write.mode(mode).option("compression", CODEC[layer])
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_layer_table(df: DataFrame, table: str, layer: str, partition_by: Sequence[str] = ()) -> None:
    """The same as a new catalogue table."""
    create_table(df if partition_by else rebalanced(df), table, partition_by=partition_by, compression=CODEC[layer])


def table_layout(spark: SparkSession, table: str) -> tuple[str, list[str], dict[str, str]]:
    """Format, partition columns and writer options of a table, as the catalogue has them."""
    facts = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(table)}").collect()}
    stored = re.findall(r"([\w.]+)=([^,\]]*)", facts.get("Storage Properties", ""))
    options = {k: v for k, v in stored if k != "serialization.format"}
    return facts["Provider"], [c.name for c in spark.catalog.listColumns(table) if c.isPartition], options


def _contents(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows and an order-free sum of row hashes, by partition."""
    row = F.xxhash64(*[F.to_json(F.struct(*sorted(df.columns)))]).cast("decimal(38,0)")
    return df.groupBy(*partition_by).agg(F.count(F.lit(1)).alias("n"), F.sum(row).alias("checksum"))


def table_files(spark: SparkSession, table: str) -> DataFrame:
    """`pasta` (the folder below the table's, as `uf=SP/ano=2020`), `caminho` and `n_bytes` of every Parquet file; a listing, no content is read."""
    return folder_files(spark, next(r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(table)}").collect() if r.col_name == "Location"))


def folder_files(spark: SparkSession, folder: str) -> DataFrame:
    """The same of a folder's Parquet files."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(folder)
    home = spark._jvm.org.apache.hadoop.fs.Path(folder)
    home = home.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(home).toString()
    below = F.substring(F.col("path"), F.lit(len(home) + 2), F.length("path"))
    return listed.select(F.regexp_extract(below, "^(.*)/[^/]*$", 1).alias("pasta"), F.col("path").alias("caminho"), F.col("length").alias("n_bytes"))


def pack_files(files: DataFrame, target_bytes: int) -> DataFrame:
    """`pasta`, `caminho`, `n_bytes` and `grupo`: each folder's files packed first-fit, the largest first, into groups of the target size.

    One folder's file names are taken together; a file over the target is a group by itself.
    """

    def first_fit(names: pd.DataFrame) -> pd.DataFrame:
        room: list[int] = []
        places = []
        ordered = names.sort_values(["n_bytes", "caminho"], ascending=[False, True])
        for size in ordered["n_bytes"]:
            place = next((i for i, left in enumerate(room) if size <= left), len(room))
            if place == len(room):
                room.append(max(target_bytes, size))
            room[place] -= size
            places.append(place)
        return ordered.assign(grupo=places)

    return files.groupBy("pasta").applyInPandas(first_fit, "pasta string, caminho string, n_bytes long, grupo int")


def compact_small_files(spark: SparkSession, table: str, target_bytes: int = 128 << 20) -> DataFrame:
    """Rewrite the partitions of a table whose files pack into fewer of the target size; the others keep their files.

    Returns per partition folder: files before and after, and whether it was
    rewritten. Sizes come from a listing. Rows go by their file's group, so a
    group is one task and one file; they are staged, compared with the old rows
    by count and checksum per partition, and then replace those partitions only.
    """
    using, partition_by, options = table_layout(spark, table)
    if not partition_by or using != "parquet":
        raise ValueError(f"{table} is not a partitioned Parquet table; compact_table rewrites it whole")
    plan_path, staged = fresh_path(spark, "arquivos"), fresh_path(spark, "compactada")
    pack_files(table_files(spark, table), target_bytes).write.parquet(plan_path)
    plan = spark.read.parquet(plan_path)
    folders = plan.groupBy("pasta").agg(F.count(F.lit(1)).alias("arquivos_antes"), F.countDistinct("grupo").alias("n_grupos"))
    small = folders.where("n_grupos < arquivos_antes")
    groups = small.agg(F.sum("n_grupos")).first()[0]
    if groups:
        wanted = plan.join(small.select("pasta"), "pasta", "left_semi").select("caminho", "pasta", "grupo")
        # The listing and the scan may write a path with one or three slashes.
        plain = lambda c: F.regexp_replace(c, "^file:/+", "/")
        rows = spark.table(table).select("*", plain(file_path()).alias("caminho"))
        rows = rows.join(wanted.withColumn("caminho", plain(F.col("caminho"))), "caminho").repartition(groups, "pasta", "grupo").drop("caminho", "pasta", "grupo")
        rows.write.partitionBy(*partition_by).options(**options).parquet(staged)
        if folder_files(spark, staged).select("pasta").distinct().count() != small.count():
            raise RuntimeError(f"compaction of {table} did not find the rows of every partition")
        new = spark.read.schema(spark.table(table).schema).parquet(staged)
        touched = new.select(*partition_by).distinct()
        same = [F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}")) for c in partition_by]
        old = spark.table(table).alias("_old").join(touched.alias("_new"), reduce(and_, same), "left_semi")
        wrong = _contents(old, partition_by).withColumn("lado", F.lit(1)).unionByName(_contents(new, partition_by).withColumn("lado", F.lit(-1)))
        wrong = wrong.groupBy(*partition_by, "n", "checksum").agg(F.sum("lado").alias("lados")).where("lados <> 0").count()
        if wrong:
            raise RuntimeError(f"compaction of {table} changed {wrong} partitions")
        overwrite_partitions(spark, new, table)
        spark.catalog.refreshTable(table)
    after = table_files(spark, table).groupBy("pasta").agg(F.count(F.lit(1)).alias("arquivos_depois"))
    return folders.join(after, "pasta").select("pasta", "arquivos_antes", "arquivos_depois", (F.col("n_grupos") < F.col("arquivos_antes")).alias("reescrita"))


def compact_table(spark: SparkSession, table: str, keep_old: str | None = None) -> str:
    """Rewrite a table of many small files into files of the advisory size.

    Format, partition columns and codec are the table's own. Rows go to a new
    table which then takes the old name; the old files stay under the returned
    name, which no other table has, until the caller drops it. Rows and
    checksums are compared by partition before the swap; a rewrite that fails
    or differs is dropped and the table stays as it was.
    """
    using, partition_by, options = table_layout(spark, table)
    mark = uuid.uuid4().hex[:8]
    old, new = keep_old or f"{table}_small_{mark}", f"{table}_compacted_{mark}"
    if spark.catalog.tableExists(old):
        raise ValueError(f"{old} exists already")
    rows = spark.table(table)
    try:
        create_table(rows if partition_by else rebalanced(rows), new, using, partition_by, **options)
        before, after = _contents(rows, partition_by), _contents(spark.table(new), partition_by)
        wrong = before.exceptAll(after).count() + after.exceptAll(before).count()
        if wrong:
            raise RuntimeError(f"compaction of {table} changed {wrong} partitions")
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {quoted(new)}")
        raise
    rename_table(spark, table, old)
    rename_table(spark, new, table)
    return old


def _ordinal(column: str, type_name: str, shared: int) -> Column:
    """A number that grows with the value: of text, the seven bytes behind the `shared` first ones."""
    if type_name == "string":
        return F.conv(F.rpad(F.hex(F.substring(F.col(column).cast("binary"), shared + 1, 7)), 14, "0"), 16, 10).cast("long").cast("double")
    if type_name in ("date", "timestamp", "timestamp_ntz"):
        return F.unix_micros(F.col(column).cast("timestamp")).cast("double")
    return F.col(column).cast("double")


def _shared_bytes(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """How many first bytes all texts of a column share: those that the least and the greatest share."""
    if not columns:
        return {}
    ends = df.agg(*[f(c).alias(f"{n}_{i}") for i, c in enumerate(columns) for n, f in (("a", F.min), ("b", F.max))]).first()
    texts = {c: [(ends[f"{n}_{i}"] or "").encode() for n in "ab"] for i, c in enumerate(columns)}
    return {c: len(os.path.commonprefix(pair)) for c, pair in texts.items()}


def interleaved(ranks: Sequence[Column], bits: int) -> Column:
    """One number of the ranks' bits by turns, the highest first: neighbours in it are near in every rank."""
    places = [(rank, i, i * len(ranks) + len(ranks) - 1 - turn) for turn, rank in enumerate(ranks) for i in range(bits)]
    return reduce(lambda a, b: a.bitwiseOR(b), [F.shiftleft(F.shiftright(rank, i).bitwiseAND(1).cast("long"), to) for rank, i, to in places])


def _place(number: Column, bounds: Sequence[float], first: int = 0) -> Column:
    """How many of the sorted bounds are not above a number, by halving: a few compiled comparisons a row."""
    if not bounds:
        return F.lit(first)
    middle = len(bounds) // 2
    return F.when(number >= bounds[middle], _place(number, bounds[middle + 1 :], first + middle + 1)).otherwise(_place(number, bounds[:middle], first))


def with_z_order(df: DataFrame, columns: Sequence[str], bits: int = 6, into: str = "_z") -> DataFrame:
    """The rows with the interleaved key of several columns; each counts by its share of the rows below, so skewed ones spread as even ones do.

    One pass finds 2^bits - 1 approximate quantiles per column, which is all the
    driver gets, after one for the ends of texts. A NULL comes first. A value
    that fills several quantiles takes that many ranks, so each column uses the
    whole range.
    """
    if not columns or bits * len(columns) > 62:
        raise ValueError("the key takes 62 bits at most, of one column at least")
    types = dict(df.dtypes)
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    shared = _shared_bytes(df, [c for c in columns if types[c] == "string"])
    numbers = {f"_n{i}": _ordinal(c, types[c], shared.get(c, 0)) for i, c in enumerate(columns)}
    numbered = df.withColumns(numbers)
    found = numbered.agg(*[F.percentile_approx(n, shares, 1 << (bits + 4)).alias(n) for n in numbers]).first()
    ranks = [F.when(F.col(n).isNull(), 0).otherwise(_place(F.col(n), found[n] or [])) for n in numbers]
    return numbered.withColumn(into, interleaved(ranks, bits)).drop(*numbers)


def write_clustered(df: DataFrame, table: str, columns: Sequence[str], files: int, layer: str = "silver", bits: int = 6, row_group_bytes: int = 128 << 20) -> None:
    """Write a table whose files and row groups each span little of every column, so that statistics prune filters on any of them.

    Rows are dealt to `files` ranges of the key and sorted by it in each. Unlike
    partition folders, no value gets a folder, so columns of many values serve.
    """
    ranged = with_z_order(df, columns, bits).repartitionByRange(files, "_z", *columns).sortWithinPartitions("_z", *columns).drop("_z")
    create_table(ranged, table, compression=CODEC[layer], **{"parquet.block.size": str(row_group_bytes)})
