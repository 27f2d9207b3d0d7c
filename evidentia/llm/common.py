"""What the training-data operators share: word rules, scratch tables, partition counts."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import time
import uuid
import zlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word rule: space and U+0009 to U+000D.
SPACES = " \t\n\x0b\f\r"
SPACE_CLASS = r"[ \x09-\x0D]"


_CACHES: dict[str, Callable[[], object]] = {}


def owns(name: str, clear: Callable[[], object]) -> None:
    """An operator's memory in a worker process, and how to let go of it."""
    _CACHES[name] = clear


def trim() -> None:
    """Give freed memory back, which else stays with a worker process as long as that lives."""
    with contextlib.suppress(AttributeError, OSError):
        ctypes.CDLL(None).malloc_trim(0)


def alone(name: str) -> None:
    """Workers serve one operator after another: let go of what the others remember."""
    for owner, clear in _CACHES.items():
        if owner != name:
            clear()
    trim()


class Names(dict):
    """64-bit names of words, made as they come and remembered up to a bound."""

    def __init__(self, make: Callable[[bytes], int], most: int = 400_000):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, word: bytes) -> int:
        name = self.make(word)
        if len(self) < self.most:
            self[word] = name
        return name


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """Array of the words of a text; empty for a text without any."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_CLASS + "+"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fold_of(doc_id: int, folds: int) -> int:
    """crc32 of the id's decimal text, modulo folds."""
    return zlib.crc32(str(doc_id).encode()) % folds


def fold_column(name: str, folds: int) -> Column:
    return F.crc32(F.col(name).cast("string").cast("binary")) % folds


def shared_dir(spark: SparkSession) -> str:
    """The shared scratch folder that the session names; where it names none, a local one on a local master, else one in the warehouse."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        local = spark.sparkContext.master.startswith("local") and not spark.sparkContext.master.startswith("local-cluster")
        found = f"file://{tempfile.gettempdir()}/evidentia-checkpoints" if local else f"{spark.conf.get('spark.sql.warehouse.dir')}/evidentia-checkpoints"
    return found.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/evidentia-scratch/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def bounded_batches(spark: SparkSession, rows: int = 256) -> None:
    """Keep Arrow batches small enough for very long texts; it holds for the session from then on."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, rows)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of plans that are done with; it does when the driver's garbage is collected.

    The second round finds what listeners still held in the first.
    """
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(1)


def scratch_table(df: DataFrame, name: str, codec: str = "zstd", large: bool = False, options: dict[str, str] | None = None) -> DataFrame:
    """df written once to the shared folder and read back: cuts the lineage and survives lost executors.

    large: much was shuffled to make it, which is freed at once.

    Tables stay until `drop_scratch` or the folder's own clean-up removes them, as results are read lazily.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**(options or {})).option("compression", codec).parquet(path)
    if large:
        free_shuffles(spark)
    table = spark.read.schema(df.schema).parquet(path)
    table._scratch_path = path
    return table


def drop_tables(*tables: DataFrame) -> None:
    """Remove scratch tables that no unread result depends on."""
    for table in tables:
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table._scratch_path)
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def drop_scratch(spark: SparkSession) -> None:
    """Remove this application's scratch tables; call it only when no unread result depends on them."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/evidentia-scratch/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def spread(spark: SparkSession, units: int, per_task: int, most: int = 1 << 24) -> int:
    """Partitions for so many units at so many a task; never fewer than the session's shuffle partitions, or more than most."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(most, -(-units // per_task)))


#: Sizes from here on are a plan's way to say that it does not know.
_UNKNOWN_BYTES = 1 << 50


def table_bytes(df: DataFrame, column: str = "text") -> int:
    """What the plan's statistics say of df's size, which for a table just read is that of its files; else half the text's bytes."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size < _UNKNOWN_BYTES:
        return size
    return (df.agg(F.sum(F.octet_length(F.col(column).cast("string")))).first()[0] or 0) // 2


def tokenizer_path(name: str) -> str:
    """A vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)
