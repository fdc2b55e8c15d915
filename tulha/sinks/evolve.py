"""Schema-evolving table writes.

The path is chosen from the two schemas before anything is written: create,
append, add columns then append, or set the old table aside and start anew.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime, timezone
from threading import Lock

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_FORMAT = "parquet"

# Fixed value: shape of the backup table's time suffix, in UTC.
BACKUP_SUFFIX = "_bkp_%Y%m%d_%H%M%S"

# What the optional `widen` policy accepts: an incoming type and the wider table types it fits.
WIDER = {
    "tinyint": {"smallint", "int", "bigint"},
    "smallint": {"int", "bigint"},
    "int": {"bigint"},
    "float": {"double"},
}


@dataclass(frozen=True)
class TypeConflict:
    """A column whose incoming type is not the table's."""

    column: str
    held: T.DataType
    brought: T.DataType


@dataclass
class SchemaDiff:
    """What an incoming schema brings against a table's; `renamed` maps names that differ in case only."""

    added: list[T.StructField] = field(default_factory=list)
    conflicts: list[TypeConflict] = field(default_factory=list)
    absent: list[str] = field(default_factory=list)
    renamed: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class WriteReport:
    """Which path a write took."""

    table: str
    path: str
    added: list[str] = field(default_factory=list)
    conflicts: list[TypeConflict] = field(default_factory=list)
    backup: str | None = None


def compare_schemas(table: T.StructType, incoming: T.StructType, case_sensitive: bool = False) -> SchemaDiff:
    """Added columns, type conflicts, absent columns and spellings that differ in case only.

    Types are compared by their spelling, which leaves out nullability at every
    depth: a stored table is nullable throughout.
    """
    fold = (lambda name: name) if case_sensitive else str.lower
    unmet = {fold(f.name): f for f in table}
    diff = SchemaDiff()
    for brought in incoming:
        held = unmet.pop(fold(brought.name), None)
        if held is None:
            diff.added.append(brought)
            continue
        if held.name != brought.name:
            diff.renamed[brought.name] = held.name
        if held.dataType.simpleString() != brought.dataType.simpleString():
            diff.conflicts.append(TypeConflict(held.name, held.dataType, brought.dataType))
    diff.absent.extend(f.name for f in unmet.values())
    return diff


def quoted(name: str) -> str:
    """A qualified name with every part in back quotes."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def rebalanced(df: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """Spread rows by `columns` so each partition value lands in few files.

    A rebalance lets Spark split a value that holds much of the data and merge
    the small ones, by measured size; a plain repartition would put a hot
    value into one task.
    """
    return df.hint("rebalance", *columns)


#: Files a task of a partitioned write keeps open. Rebalanced rows have few partition values in a task.
OPEN_WRITERS = 16
_writes_lock, _writes, _before = Lock(), [], []


@contextmanager
def open_writers(spark: SparkSession) -> Iterator[None]:
    """Partitioned writes inside keep a file open per value instead of sorting a task's rows in memory by it.

    A slice of the shuffle is bounded in compressed bytes, so its sorted rows
    may need many times that; rows that go straight to their files do not. A task with
    more values than open files sorts what is left.
    """
    setting = "spark.sql.maxConcurrentOutputFileWriters"
    # Loads run in threads of one session: the first one in sets it, the last one out restores it.
    with _writes_lock:
        if not _writes:
            _before.append(spark.conf.get(setting))
            spark.conf.set(setting, str(OPEN_WRITERS))
        _writes.append(1)
    try:
        yield
    finally:
        with _writes_lock:
            _writes.pop()
            if not _writes:
                spark.conf.set(setting, _before.pop())


def create_table(df: DataFrame, table: str, using: str = DEFAULT_FORMAT, partition_by: Sequence[str] = (), **options: str) -> None:
    """Write `df` as a new table, replacing none."""
    if partition_by:
        df = rebalanced(df, partition_by)
    writer = df.write.format(using).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with open_writers(df.sparkSession):
        writer.saveAsTable(table)


def _append(spark: SparkSession, df: DataFrame, table: str) -> None:
    """Append by column name; table columns that `df` lacks become NULL."""
    partitions = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    if partitions:
        df = rebalanced(df, [c for c in partitions if c in df.columns])
    with open_writers(spark):
        spark.sql(f"INSERT INTO {quoted(table)} BY NAME SELECT * FROM {{incoming}}", incoming=df)


def _free_backup_name(spark: SparkSession, table: str, now: datetime) -> str:
    """Backup name for this second; a counter follows when it is taken."""
    base = table + now.astimezone(timezone.utc).strftime(BACKUP_SUFFIX)
    name, n = base, 1
    while spark.catalog.tableExists(name):
        n += 1
        name = f"{base}_{n}"
    return name


def rename_table(spark: SparkSession, old: str, new: str) -> None:
    """Rename a table. Where the catalogue leaves partitions at the old path, one statement finds them below the new one."""
    spark.sql(f"ALTER TABLE {quoted(old)} RENAME TO {quoted(new)}")
    if any(c.isPartition for c in spark.catalog.listColumns(new)):
        spark.sql(f"REPAIR TABLE {quoted(new)} SYNC PARTITIONS")


def write_evolving(
    spark: SparkSession,
    df: DataFrame,
    table: str,
    using: str = DEFAULT_FORMAT,
    partition_by: Sequence[str] = (),
    widen: bool = False,
    now: datetime | None = None,
    **options: str,
) -> WriteReport:
    """Write one load to a bronze table and say which path it took.

    A type conflict wins over new columns. The conflict path renames the old
    table to a backup and then creates the new one: these are two catalogue
    steps, so a reader may find no table in between, and a failure in between
    leaves the backup whole. The incoming rows are written to a staging table
    first, so a load that fails to compute touches nothing. With `widen`,
    columns that are only narrower than the table's are cast up instead.
    """
    if "." in table:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(table.rsplit('.', 1)[0])}")
    if not spark.catalog.tableExists(table):
        create_table(df, table, using, partition_by, **options)
        return WriteReport(table, "create")

    sensitive = spark.conf.get("spark.sql.caseSensitive") == "true"
    diff = compare_schemas(spark.table(table).schema, df.schema, sensitive)
    df = df.withColumnsRenamed(diff.renamed)
    if widen and diff.conflicts:
        fits = {c.column: c.held for c in diff.conflicts if c.held.simpleString() in WIDER.get(c.brought.simpleString(), ())}
        df = df.withColumns({name: df[name].cast(held) for name, held in fits.items()})
        diff = compare_schemas(spark.table(table).schema, df.schema, sensitive)

    if diff.conflicts:
        staging = f"{table}_staging_{(now or datetime.now(timezone.utc)).strftime('%Y%m%d%H%M%S%f')}"
        create_table(df, staging, using, partition_by, **options)
        backup = _free_backup_name(spark, table, now or datetime.now(timezone.utc))
        rename_table(spark, table, backup)
        rename_table(spark, staging, table)
        return WriteReport(table, "recreate", conflicts=diff.conflicts, backup=backup)

    if diff.added:
        add_columns(spark, table, diff.added)
    _append(spark, df, table)
    return WriteReport(table, "add_columns" if diff.added else "append", added=[f.name for f in diff.added])


def write_keyed(spark: SparkSession, df: DataFrame, table: str, key: str, value: int, partition_by: Sequence[str] = ()) -> WriteReport:
    """One batch of a table laid out by the batch's number: rows that the same batch wrote before are replaced.

    So a batch that is run again, after whatever failure, leaves the table as
    one run does. Schemas evolve as in `write_evolving`; on a type conflict the
    batches before stay in the backup.
    """
    if "." in table:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(table.rsplit('.', 1)[0])}")
    layout = [key, *partition_by]
    marked = df.withColumn(key, F.lit(value).cast("long"))
    if not spark.catalog.tableExists(table):
        create_table(marked, table, partition_by=layout)
        return WriteReport(table, "create")
    diff = compare_schemas(spark.table(table).schema, marked.schema, spark.conf.get("spark.sql.caseSensitive") == "true")
    if diff.conflicts:
        return write_evolving(spark, marked, table, partition_by=layout)
    if diff.added:
        add_columns(spark, table, diff.added)
    rows = rebalanced(df.withColumnsRenamed(diff.renamed), partition_by)
    place = ", ".join([f"{quoted_column(key)} = {value}", *map(quoted_column, partition_by)])
    with open_writers(spark):
        spark.sql(f"INSERT OVERWRITE {quoted(table)} PARTITION ({place}) BY NAME SELECT * FROM {{incoming}}", incoming=rows)
    return WriteReport(table, "add_columns" if diff.added else "replace", added=[f.name for f in diff.added])


def add_columns(spark: SparkSession, table: str, added: Sequence[T.StructField]) -> None:
    columns = ", ".join(f"{quoted_column(f.name)} {f.dataType.simpleString()}" for f in added)
    spark.sql(f"ALTER TABLE {quoted(table)} ADD COLUMNS ({columns})")


def overwrite_partitions(spark: SparkSession, df: DataFrame, table: str) -> None:
    """Replace the partitions that `df` has rows for, by column name; all others keep their files."""
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        spark.sql(f"INSERT OVERWRITE {quoted(table)} BY NAME SELECT * FROM {{incoming}}", incoming=df)
    finally:
        spark.conf.set(setting, before)


def quoted_column(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


# Error conditions that say a table's files, not its rows or types, are the trouble.
MISSING_FILES = {"PATH_NOT_FOUND", "FAILED_READ_FILE.FILE_NOT_EXIST"}
FILE_FORMATS = {"parquet", "orc", "csv", "json"}


def table_files_missing(spark: SparkSession, table: str) -> bool:
    """True when the catalogue knows the table but its folder or files are gone."""
    try:
        spark.sql(f"REFRESH TABLE {quoted(table)}")
        known = spark.table(table)
        facts = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(table)}").collect()}
        if facts.get("Provider") in FILE_FORMATS:
            # A missing folder reads as an empty table by name, but is an error by path.
            spark.read.schema(known.schema).format(facts["Provider"]).load(facts["Location"]).limit(1).collect()
        known.limit(1).collect()
    except PySparkException as failure:
        if failure.getCondition() in MISSING_FILES:
            return True
        raise
    return False


def recover_ghost_table(
    spark: SparkSession, df: DataFrame, table: str, allow_drop: bool = False, using: str = DEFAULT_FORMAT, partition_by: Sequence[str] = ()
) -> WriteReport:
    """Recreate a catalogue entry whose files are gone.

    Only with `allow_drop`, and only when a read proves the files missing;
    any other failure is raised and no data is dropped.
    """
    if not spark.catalog.tableExists(table) or not table_files_missing(spark, table):
        return write_evolving(spark, df, table, using, partition_by)
    if not allow_drop:
        raise RuntimeError(f"files of {table} are gone; pass allow_drop to recreate it")
    layout = partition_by or [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    spark.sql(f"DROP TABLE IF EXISTS {quoted(table)}")
    create_table(df, table, using, layout)
    return WriteReport(table, "recover")


def replace_table(df: DataFrame, table: str, using: str = DEFAULT_FORMAT, **options: str) -> None:
    """Full refresh of reference data."""
    df.write.format(using).mode("overwrite").option("overwriteSchema", "true").options(**options).saveAsTable(table)
