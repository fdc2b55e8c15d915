"""The two ingestion flows: landed portal files and landed statistical responses."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tulha.functions.values import period_year
from tulha.operators.observations import dataset_view, flatten_observations, published_labels
from tulha.operators.quality import lineage_rows, with_lineage
from tulha.operators.quarantine import mark_blocks, split_marked
from tulha.operators.silver import latest_by_key, split_typed
from tulha.session import fresh_path
from tulha.sinks.evolve import WriteReport, quoted, recover_ghost_table, replace_table, write_evolving
from tulha.sources.delimited import read_landed_file
from tulha.sources.mixed import bad_lines, good_lines, mark_mixed_headers


# Separator and encoding of the text formats that are read file by file.
TEXT_FORMATS = {"txt": (";", "ISO-8859-1"), "csv": (",", "UTF-8")}
REJECTS, LABELS = "_rejeitadas", "_rotulos"


def ingest_file(
    spark: SparkSession,
    path: str,
    extension: str,
    table: str,
    batch_id: str,
    ingest_ts: str,
    source_file: str | None = None,
    recreate_ghost: bool = False,
    **options,
) -> WriteReport:
    """One landed file, or folder of files of one dataset, into its bronze table.

    Text files are read by their own headers and land as text; lines that do
    not fit go to `<table>_rejeitadas` with file and reason, after the rows. The
    write of the rows counts them, so files without any are not read again.
    Options (a schema, inference, quoting) choose Spark's own CSV reader, for
    files of one header. Each row keeps its file's name unless `source_file`
    gives one. `recreate_ghost` recreates a table whose files are proved gone.
    """
    kind = extension.lower().lstrip(".")
    marked, seen = None, Observation()
    if kind in TEXT_FORMATS and not options:
        marked, values = mark_mixed_headers(spark, path, *TEXT_FORMATS[kind])
        df = good_lines(marked.observe(seen, F.count_if(F.col("_motivo").isNotNull()).alias("n_rejeitadas")), values)
    else:
        df = read_landed_file(spark, path, extension, source_file="_source_file", **options)
    origin = F.col("_source_file") if source_file is None else F.lit(source_file)
    rows = with_lineage(df.withColumn("_file", origin).drop("_source_file"), batch_id, ingest_ts, F.col("_file")).drop("_file")
    report = recover_ghost_table(spark, rows, table, allow_drop=True) if recreate_ghost else write_evolving(spark, rows, table)
    if marked is not None and seen.get["n_rejeitadas"]:
        kept = bad_lines(marked).select("line", F.col("_motivo").alias("motivo"), (F.col("_source_file") if source_file is None else F.lit(source_file)).alias("_file"))
        write_evolving(spark, with_lineage(kept, batch_id, ingest_ts, F.col("_file")).drop("_file"), table + REJECTS)
    return report


def ingest_listing(
    spark: SparkSession,
    items: Sequence[Mapping[str, str]],
    database: str,
    batch_id: str,
    ingest_ts: str,
    at_once: int = 8,
    **options,
) -> list[WriteReport]:
    """Every file of a listing (`tabela`, `path`, `extensao`) into its own table, in one session.

    Files are independent jobs, submitted `at_once` at a time so that small
    ones share the cluster; files of one table follow each other in listing
    order. A file that fails does not stop the others: failures are raised
    together at the end, naming each. An empty listing is an error, as a page
    without links is one that was not understood.
    """
    if not items:
        raise ValueError("the listing names no files")
    by_table: dict[str, list[Mapping[str, str]]] = {}
    for item in items:
        by_table.setdefault(item["tabela"], []).append(item)

    def load(table_items: list[Mapping[str, str]]) -> tuple[list[WriteReport], list[str]]:
        done, failed = [], []
        for item in table_items:
            try:
                name = f"{database}.{item['tabela']}"
                done.append(ingest_file(spark, item["path"], item["extensao"], name, batch_id, ingest_ts, **options))
            except Exception as failure:
                failed.append(f"{item['tabela']} ({item['path']}): {failure}")
        return done, failed

    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}")
    with ThreadPoolExecutor(at_once) as pool:
        outcomes = list(pool.map(load, by_table.values()))
    failed = [text for _, texts in outcomes for text in texts]
    if failed:
        raise RuntimeError(f"{len(failed)} of {len(items)} files failed: " + "; ".join(failed))
    return [report for reports, _ in outcomes for report in reports]


def ingest_responses(
    spark: SparkSession,
    responses: DataFrame,
    table: str,
    batch_id: str,
    ingest_ts: str,
    rejects_table: str,
    dataset_id: str = "agregado_id",
    keep: Sequence[str] = (),
) -> tuple[WriteReport | None, WriteReport]:
    """Landed `(dataset id, body)` rows into one observations table, laid out by dataset and year.

    Responses are taken block by block: a block of another shape goes to the
    rejects table with its position and a reason, and the others go on. A load
    without a single observation writes none and reports None for it. Bodies
    are parsed once: the marked blocks are staged in the shared folder, all
    writes start from there, and the staged files go at the end. Rows are
    written before rejects. The labels of the load's dimensions are kept in
    `<table>_rotulos`, so that views need not read the observations for them.
    """
    staged = fresh_path(spark, "marked")
    mark_blocks(responses).write.parquet(staged, compression="zstd")
    marked = spark.read.parquet(staged)
    good, bad = split_marked(marked)
    rows = flatten_observations(good, dataset_id=dataset_id, keep=[*keep, "source_file"])
    loaded = with_lineage(rows, batch_id, ingest_ts, F.col("source_file")).drop("source_file").withColumn("ano", period_year(F.col("periodo")))
    report = None
    if not loaded.isEmpty():
        report = write_evolving(spark, loaded, table, partition_by=["agregado_id", "ano"])
        add_labels(spark, published_labels(good, dataset_id=dataset_id), table)
    rejects = write_evolving(spark, with_lineage(bad, batch_id, ingest_ts, F.col("source_file")), rejects_table)
    drop_folder(spark, staged)
    return report, rejects


def add_labels(spark: SparkSession, found: DataFrame, table: str) -> None:
    """Append the dimension labels that the labels table of `table` lacks: a row per dataset and classification."""
    name = table + LABELS
    if spark.catalog.tableExists(name):
        found = found.join(spark.table(name), ["agregado_id", "rotulo"], "left_anti")
    write_evolving(spark, found, name)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of intermediates that this run made."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def register_dataset_views(spark: SparkSession, table: str, names: Mapping[str, str]) -> None:
    """A SQL view per dataset, `names[dataset id]`, with the dataset's own dimension columns.

    Labels come from the labels table, or, where a table has none, from one pass
    over it. The views are lazy and each reads only its dataset's folder.
    """
    labelled = table + LABELS
    if spark.catalog.tableExists(labelled):
        pairs = spark.table(labelled)
    else:
        pairs = spark.table(table).select("agregado_id", F.explode("dimensoes.rotulo").alias("rotulo")).distinct()
    found = pairs.where(F.col("agregado_id").isin(list(names))).groupBy("agregado_id").agg(F.array_sort(F.collect_set("rotulo")).alias("rotulos"))
    labels = {r.agregado_id: r.rotulos for r in found.collect()}
    for dataset, name in names.items():
        dataset_view(spark.table(table), dataset, labels.get(dataset, [])).createOrReplaceTempView(name)


def register_catalogue_views(spark: SparkSession, table: str, catalogue: DataFrame) -> list[str]:
    """A view per aggregate of the catalogue, under the table name it gives; returns the names.

    An empty catalogue is an error: its filters no longer match what is published.
    """
    names = {r.agregado_id: r.tabela for r in catalogue.select("agregado_id", "tabela").collect()}
    if not names:
        raise ValueError("the catalogue names no aggregate")
    register_dataset_views(spark, table, names)
    return sorted(names.values())


def ingest_silver(
    spark: SparkSession, bronze: str, silver_table: str, contract: Mapping[str, str], key: Sequence[str], lineage_table: str, layer: str = "silver"
) -> dict[str, int]:
    """A bronze table typed by contract and cut to the latest row per key, as a silver table; returns what the write counted.

    Rows with a cell that does not parse go to `<silver>_rejeitadas`. The counts
    are observed on the write itself. Rows per file and batch of both layers
    replace the table's entries in the lineage table.
    """
    good, bad = split_typed(spark.table(bronze), contract)
    seen = Observation("silver")
    latest = latest_by_key(good, key)
    replace_table(latest.observe(seen, F.count(F.lit(1)).alias("n_linhas"), F.count_if(F.isnull("_batch_id")).alias("n_sem_lote")), silver_table)
    replace_table(bad, silver_table + REJECTS)
    rows = lineage_rows({"bronze": spark.table(bronze), layer: spark.table(silver_table)}).withColumn("tabela", F.lit(silver_table))
    if spark.catalog.tableExists(lineage_table):
        rows = spark.table(lineage_table).where(F.col("tabela") != silver_table).unionByName(rows)
        staged = fresh_path(spark, "linhagem")
        rows.write.parquet(staged)
        rows = spark.read.parquet(staged)
    replace_table(rows, lineage_table)
    return seen.get
