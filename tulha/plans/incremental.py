"""Incremental flows: what has landed since the last run, each file once, whatever fails in between.

The file source's progress log is the ledger: a trigger's files are recorded
under its number before they are read, and the number is committed after all is
written. Everything a trigger writes is laid out by that number and replaces what
the same number wrote before. So a trigger that failed anywhere, between two
tables or before its commit, is run again with the same files and adds nothing
twice, and a run without new files reads none.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tulha.functions.names import file_name
from tulha.functions.values import period_year
from tulha.operators.observations import flatten_observations
from tulha.operators.quality import with_lineage
from tulha.operators.quarantine import mark_blocks, reconciled, split_marked
from tulha.operators.silver import latest_by_key, split_typed
from tulha.plans.ingest import REJECTS, TEXT_FORMATS, drop_folder
from tulha.session import fresh_path
from tulha.sinks.evolve import add_columns, compare_schemas, create_table, overwrite_partitions, quoted, rebalanced, write_keyed
from tulha.sources.delimited import read_landed_file
from tulha.sources.mixed import bad_lines, good_lines, mark_mixed_headers

#: The column of a trigger's number, the ledger table's suffix, and the silver table's column of hash buckets.
BATCH, LEDGER, BUCKET = "_lote", "_arquivos", "_balde"
_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def run_landed(
    spark: SparkSession, folder: str, checkpoint: str, load: Callable[[int, Mapping[str, int]], None], glob: str = "*", files_per_trigger: int = 1000
) -> int:
    """Call `load` with the number and the new files (path to bytes) of each trigger until nothing is left; returns the files seen.

    The files' content is not read here; the driver gets `files_per_trigger`
    paths at most. `load` must replace what it wrote for the same number.
    """
    stream = (
        spark.readStream.format("binaryFile")
        .schema(_FILE_SCHEMA)
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_trigger)
        .load(folder)
        .select("path", "length")
    )
    seen: list[int] = []

    def each(batch: DataFrame, number: int) -> None:
        files = {r.path: r.length for r in batch.collect()}
        if files:
            load(number, files)
            seen.append(len(files))

    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return sum(seen)


def _as_globs(files: Mapping[str, int]) -> list[str]:
    """Paths as the readers take them: characters that would be patterns are escaped."""
    return [re.sub(r"([\\*?\[\]{}])", r"\\\1", path) for path in files]


def _keep_ledger(spark: SparkSession, table: str, number: int, files: Mapping[str, int], at: str, counts: DataFrame) -> None:
    """A row per file of the trigger, with the counts (by `_source_file`) of what it gave."""
    listed = spark.createDataFrame([(path.rsplit("/", 1)[-1], path, size) for path, size in files.items()], "_source_file string, caminho string, n_bytes long")
    rows = listed.join(counts, "_source_file", "left").fillna(0).withColumn("_ingest_ts", F.lit(at).cast("timestamp_ntz"))
    write_keyed(spark, rows, table + LEDGER, BATCH, number)


def ingest_incremental(spark: SparkSession, folder: str, extension: str, table: str, checkpoint: str, ingest_ts: str, files_per_trigger: int = 1000, glob: str = "*") -> int:
    """Portal files of one dataset that landed since the last run, into its bronze table; returns how many.

    Text files are read by their own headers; lines that do not fit go to
    `<table>_rejeitadas`. Rows keep their file, and the trigger's number in
    `_lote`. `<table>_arquivos` has a row per file: bytes, rows and rejects.
    """
    kind = extension.lower().lstrip(".")

    def load(number: int, files: Mapping[str, int]) -> None:
        paths = _as_globs(files)
        lineage = lambda df: with_lineage(df.withColumnRenamed("_source_file", "_file"), f"lote-{number}", ingest_ts, F.col("_file")).drop("_file")
        if kind in TEXT_FORMATS:
            marked, values = mark_mixed_headers(spark, paths, *TEXT_FORMATS[kind])
            write_keyed(spark, lineage(good_lines(marked, values)), table, BATCH, number)
            write_keyed(spark, lineage(bad_lines(marked).withColumnRenamed("_motivo", "motivo")), table + REJECTS, BATCH, number)
        else:
            write_keyed(spark, lineage(read_landed_file(spark, paths, extension, source_file="_source_file")), table, BATCH, number)
        counts = _counted(spark, table, number, "n_linhas")
        if kind in TEXT_FORMATS:
            counts = counts.join(_counted(spark, table + REJECTS, number, "n_rejeitadas"), "_source_file", "full_outer")
        _keep_ledger(spark, table, number, files, ingest_ts, counts)

    return run_landed(spark, folder, checkpoint, load, glob, files_per_trigger)


def _counted(spark: SparkSession, table: str, number: int, name: str) -> DataFrame:
    """Rows per file of one trigger; only its folder is read."""
    return spark.table(table).where(F.col(BATCH) == number).groupBy("_source_file").agg(F.count(F.lit(1)).alias(name))


def ingest_incremental_responses(
    spark: SparkSession, folder: str, table: str, rejects_table: str, checkpoint: str, ingest_ts: str, dataset_id: str = "agregado_id", files_per_trigger: int = 1000, glob: str = "*.json"
) -> int:
    """Landed responses (JSON lines of dataset id and body) since the last run; returns how many files.

    Blocks that can be read become observations, laid out by trigger and
    dataset; others go to the rejects table. `<table>_arquivos` says per file how
    many blocks its responses hold and how many of them were loaded and rejected.
    """

    def load(number: int, files: Mapping[str, int]) -> None:
        landed = spark.read.schema(f"`{dataset_id}` string, body string").json(_as_globs(files)).select(dataset_id, "body", file_name().alias("source_file"))
        staged = fresh_path(spark, "marked")
        mark_blocks(landed, size="n_blocos").write.parquet(staged)
        marked = spark.read.parquet(staged)
        good, bad = split_marked(marked)
        lineage = lambda df: with_lineage(df, f"lote-{number}", ingest_ts, F.col("source_file")).drop("source_file")
        rows = lineage(flatten_observations(good, dataset_id=dataset_id, keep=["source_file"])).withColumn("ano", period_year(F.col("periodo")))
        write_keyed(spark, rows, table, BATCH, number, partition_by=["agregado_id"])
        write_keyed(spark, lineage(bad.drop("n_blocos")), rejects_table, BATCH, number)
        counts = reconciled(marked, ["source_file"], "n_blocos").drop("conferido").withColumnRenamed("source_file", "_source_file")
        columns = ["_source_file", "n_esperados", "n_carregados", "n_rejeitados", "n_respostas"]
        _keep_ledger(spark, table, number, files, ingest_ts, counts.select(*columns))
        drop_folder(spark, staged)

    return run_landed(spark, folder, checkpoint, load, glob, files_per_trigger)


def merge_latest(spark: SparkSession, rows: DataFrame, table: str, key: Sequence[str], order: Sequence[str] = ("_ingest_ts", "_source_file"), buckets: int = 64) -> list[int]:
    """Bring new rows into a table of the latest row per key; returns the buckets that were rewritten.

    The table is laid out by a hash of the key. Only buckets that new rows fall
    into are read, merged and replaced; the files of all others stay. The merge
    is staged first, so a failure leaves the table as it was, and merging the
    same rows twice changes nothing. New columns are added, another type is
    refused. The number of buckets is fixed when the table is made; the driver
    gets one number per bucket.
    """
    placed = rows.withColumn(BUCKET, F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))
    if not spark.catalog.tableExists(table):
        create_table(latest_by_key(placed, key, order), table, partition_by=[BUCKET])
        spark.sql(f"ALTER TABLE {quoted(table)} SET TBLPROPERTIES ('baldes' = '{buckets}')")
        return sorted(r[BUCKET] for r in spark.table(table).select(BUCKET).distinct().collect())
    made_with = next((r.value for r in spark.sql(f"SHOW TBLPROPERTIES {quoted(table)}").collect() if r.key == "baldes"), None)
    if made_with is not None and int(made_with) != buckets:
        raise ValueError(f"{table} was made with {made_with} buckets, not {buckets}")
    diff = compare_schemas(spark.table(table).schema, placed.schema)
    if diff.conflicts:
        raise ValueError(f"{table} holds other types in {[c.column for c in diff.conflicts]}")
    if diff.added:
        add_columns(spark, table, diff.added)
    touched = sorted(r[BUCKET] for r in placed.select(BUCKET).distinct().collect())
    if not touched:
        return []
    held = spark.table(table).where(F.col(BUCKET).isin(touched))
    staged = fresh_path(spark, "mesclada")
    latest_by_key(held.unionByName(placed, allowMissingColumns=True), key, order).write.parquet(staged)
    overwrite_partitions(spark, rebalanced(spark.read.parquet(staged).select(*spark.table(table).columns), [BUCKET]), table)
    drop_folder(spark, staged)
    return touched


def ingest_silver_incremental(spark: SparkSession, bronze: str, silver_table: str, contract: Mapping[str, str], key: Sequence[str], buckets: int = 64) -> list[int]:
    """The bronze triggers that silver has not seen, typed by contract and merged; returns their numbers.

    What silver has seen is kept in `<silver>_lotes`, a row per trigger, written
    after the merge. Rows with a cell that does not parse go to
    `<silver>_rejeitadas`, laid out by trigger.
    """
    seen_table = f"{silver_table}_lotes"
    numbers = {r[BATCH] for r in spark.sql(f"SELECT DISTINCT {BATCH} FROM {quoted(bronze)}").collect()}
    if spark.catalog.tableExists(seen_table):
        numbers -= {r[BATCH] for r in spark.table(seen_table).select(BATCH).collect()}
    for number in sorted(numbers):
        good, bad = split_typed(spark.table(bronze).where(F.col(BATCH) == number).drop(BATCH), contract)
        touched = merge_latest(spark, good, silver_table, key, buckets=buckets)
        write_keyed(spark, bad, silver_table + REJECTS, BATCH, number)
        write_keyed(spark, spark.createDataFrame([(len(touched),)], "n_baldes long"), seen_table, BATCH, number)
    return sorted(numbers)
