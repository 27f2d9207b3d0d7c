"""Incremental tables as Parquet folders: append if absent, upsert, pointers, temporal ledgers; publication by rename."""

from __future__ import annotations

import datetime
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class PublicationBlocked(RuntimeError):
    """The publication's state does not allow what was asked."""


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


_POINTER = "_CURRENT"


def _write_pointer(spark: SparkSession, path: str, version: str) -> None:
    """Name the table's version; readers see the old name or the new one, never none."""
    fs, folder = _fs(spark, path)
    path_of, jvm = spark._jvm.org.apache.hadoop.fs.Path, spark._jvm
    staged = path_of(folder, f".{_POINTER}-{uuid.uuid4().hex}")
    out = fs.create(staged, True)
    try:
        out.write(version.encode())
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(folder).toUri(), spark._jsc.hadoopConfiguration())
    renames = jvm.java.lang.reflect.Array.newInstance(jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 1)
    renames[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(staged, path_of(folder, _POINTER), renames)


def current_path(spark: SparkSession, path: str) -> str:
    """Where a table's rows are: the version that its pointer names, or the folder itself where it has none."""
    fs, folder = _fs(spark, path)
    pointer = spark._jvm.org.apache.hadoop.fs.Path(folder, _POINTER)
    if not fs.exists(pointer):
        return path
    stream = fs.open(pointer)
    try:
        name = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return f"{path}/{name}"


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(current_path(spark, path))


def replace(df: DataFrame, path: str, keep: int = 2) -> None:
    """A new version of the table, written whole before the pointer moves to it.

    A crash leaves the old version in force. The last `keep` versions stay, so plans that read the one before go on.
    """
    spark = df.sparkSession
    fs, folder = _fs(spark, path)
    before = sorted((f.getModificationTime(), f.getPath().getName()) for f in fs.listStatus(folder) if f.getPath().getName().startswith("version-")) if fs.exists(folder) else []
    version = f"version-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{version}")
    _write_pointer(spark, path, version)
    for _, name in before[: max(0, len(before) + 1 - keep)]:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(folder, name), True)


def append_if_absent(new: DataFrame, path: str, key: list[str]) -> None:
    """Rows whose key the table has not; keys repeated within the batch are an error, as which row stays would be open.

    new is evaluated once, into a staging folder. Only stored rows within the batch's range of its first key column are
    looked at, which Parquet's statistics skip by row group.
    """
    spark = new.sparkSession
    fs, _ = _fs(spark, path)
    staging = f"{path}.staging-{uuid.uuid4().hex}"
    new.write.parquet(staging)
    try:
        staged = spark.read.schema(new.schema).parquet(staging)
        if not staged.groupBy(*key).count().filter("count > 1").isEmpty():
            raise ValueError(f"keys {key} repeat within the batch")
        if exists(spark, path):
            first = F.col(key[0])
            low, high = staged.agg(F.min(first), F.max(first)).first()
            near = first.isNull() if low is None else first.isNull() | first.between(low, high)
            staged = staged.join(read(spark, path).filter(near).select(*key), key, "left_anti")
        staged.write.mode("append").parquet(current_path(spark, path))
    finally:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(staging), True)


def upsert(new: DataFrame, path: str, key: list[str]) -> None:
    """Rows of the same key give way to the new ones; the others stay."""
    spark = new.sparkSession
    if exists(spark, path):
        new = new.unionByName(read(spark, path).join(new.select(*key), key, "left_anti"), allowMissingColumns=True)
    replace(new, path)


def delete_rows(spark: SparkSession, path: str, key: str, values: list[str]) -> None:
    """Take rows out of a table, as a retry does with what a failed run left."""
    replace(read(spark, path).filter(~F.col(key).isin(values) | F.col(key).isNull()), path)


def update_from(table: DataFrame, found: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """table with the columns that found has for a key; others keep theirs."""
    new = found.select(*key, *(F.col(c).alias(f"__{c}") for c in columns))
    joined = table.join(new, key, "left")
    return joined.select(*(F.coalesce(f"__{c}", c).alias(c) if c in columns else F.col(c) for c in table.columns))


def stage(df: DataFrame, name: str) -> DataFrame:
    """df written once to the folder that the session shares, and read back: what several later plans read.

    It survives lost executors. The folder is the session's checkpoint folder; where it names none, one of the machine on a
    local master, else one in the warehouse.
    """
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        local = spark.sparkContext.master.startswith("local") and not spark.sparkContext.master.startswith("local-cluster")
        folder = f"file://{tempfile.gettempdir()}/evidentia-checkpoints" if local else f"{spark.conf.get('spark.sql.warehouse.dir')}/evidentia-checkpoints"
    path = f"{folder.rstrip('/')}/evidentia-stage/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class RefreshProhibited(RuntimeError):
    """The table keeps history and is not to be built anew."""


def forbid_refresh(spark: SparkSession, path: str, full_refresh: bool) -> None:
    """Guard of a ledger: a full refresh would lose what it alone remembers."""
    if full_refresh and exists(spark, path):
        raise RefreshProhibited(path)


def view(df: DataFrame, name: str) -> None:
    """A name for a plan in the session's catalog; it is evaluated wherever it is read."""
    df.createOrReplaceTempView(name)


def schema_name(folder: str | None, target: str, default: str = "main") -> str:
    """Where a model goes: its folder's own schema, else the target's, without a prefix of either."""
    return (folder or target or default).strip().lower()


def catalog_columns(spark: SparkSession) -> DataFrame:
    """Columns of all tables and views that the session knows."""
    rows = [(t.database or "", t.name, c.name, c.dataType) for t in spark.catalog.listTables() for c in spark.catalog.listColumns(t.name)]
    return spark.createDataFrame(rows, "table_schema string, table_name string, column_name string, data_type string")


def audited(df: DataFrame, now: datetime.datetime, name: str = "recorded_at") -> DataFrame:
    """df with the time of its run, taken once by the driver: evaluated again, a plan gives the same."""
    return df.withColumn(name, F.lit(now))


def publish_pointer(spark: SparkSession, path: str, name: str, key: str) -> None:
    upsert(spark.createDataFrame([(name, key)], "name string, published_key string"), path, ["name"])


def publication_action(assignments: int, current: int, eligible: int) -> str:
    """What a run may do: PUBLISH once, NO_OP when all of it is current; else it is blocked."""
    if assignments == 0:
        return "PUBLISH"
    if current == 0:
        return "REACTIVATION_BLOCKED"
    return "NO_OP" if assignments == current == eligible else "INCOMPLETE_BLOCKED"


def prepublication_action(existing: int, proposed: int, eligible: int) -> str:
    return "PASS" if existing or proposed == eligible else "INCOMPLETE_BLOCKED"


def close_and_open(ledger: DataFrame, proposed: DataFrame, key: str, run_key: str, now) -> DataFrame:
    """The ledger with other runs' current rows closed and this run's rows opened."""
    stale = F.col("is_current") & (F.col("run_key") != run_key)
    closed = ledger.withColumn("valid_to", F.when(stale, F.lit(now)).otherwise(F.col("valid_to"))).withColumn("is_current", F.col("is_current") & ~stale)
    known = ledger.filter(F.col("run_key") == run_key).select(key)
    opened = proposed.join(known, key, "left_anti").withColumns({"run_key": F.lit(run_key), "valid_from": F.lit(now), "valid_to": F.lit(None).cast("timestamp"), "is_current": F.lit(True)})
    return closed.unionByName(opened.select(*closed.columns))


def publish_assignments(ledger: DataFrame, proposed: DataFrame, key: str, run_key: str, eligible: int, now) -> DataFrame:
    mine = ledger.filter(F.col("run_key") == run_key).agg(F.count("*").alias("n"), F.count_if("is_current").alias("c")).first()
    action = publication_action(mine.n, mine.c, eligible)
    if action == "NO_OP":
        return ledger
    if action != "PUBLISH" or prepublication_action(mine.n, proposed.count(), eligible) != "PASS":
        raise PublicationBlocked(action if action != "PUBLISH" else "INCOMPLETE_BLOCKED")
    return close_and_open(ledger, proposed, key, run_key, now)
