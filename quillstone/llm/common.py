"""What several operators of this folder share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: The white space of all word rules here: space and U+0009 to U+000D.
WHITE = r"[\x20\x09-\x0D]"

#: Tables of at most so many rows and bytes may be broadcast; larger ones go through a shuffle join.
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 64 << 20
#: Parts into which a hot key's rows are dealt.
SALTS = 16


#: What frees the memory that a Python worker keeps for an operator between tasks, by operator.
_KEPT: dict[str, Callable[[], object]] = {}


def take_over(name: str, free: Callable[[], object] | None = None) -> None:
    """Called where a task of operator name begins: frees what other operators keep in this Python worker.

    Spark uses its workers again for later stages, so what one stage keeps would else lie beside the
    next one's.  free empties what name itself will keep, and is called by the next operator.
    """
    others = [k for k in _KEPT if k != name]
    for k in others:
        _KEPT.pop(k)()
    if others:
        gc.collect()
        pa.default_memory_pool().release_unused()
        if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
            libc.malloc_trim(0)
    if free is not None:
        _KEPT[name] = free


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def word_count(text: Column) -> Column:
    """Words are maximal runs of anything but WHITE; null has none.

    Every word start is a non-white character after white space or at the start, so counting
    needs one replacement and no array.
    """
    squeezed = F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "x")
    return F.coalesce(F.length(squeezed) - F.length(F.translate(squeezed, "x", "")), F.lit(0)).cast("long")


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names.  Only a local session, as in tests, may go without: it gets a temporary one."""
    sc = spark.sparkContext
    have = sc._jsc.sc().getCheckpointDir()
    if have.isDefined():
        return have.get()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="quillstone-checkpoint-"))
    return sc._jsc.sc().getCheckpointDir().get()


def free_shuffles(spark: SparkSession) -> None:
    """Has Spark remove the shuffle files and broadcasts that nothing refers to any more.

    Spark learns of these when the driver's memory is collected, which may be long after the work that needed them; until then the
    files of one job lie on the executors' disks beside the next one's.
    """
    gc.collect()
    spark._jvm.System.gc()


def delete_folder(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def file_order() -> Column:
    """A number that puts the rows of files written by one job in the order in which they were written.

    Files are named by their task and their number in it, and Parquet rows know their place in a file; readers take files
    in any order.  Works on a frame read from Parquet.
    """
    name = F.col("_metadata.file_name")
    part = lambda pattern: F.coalesce(F.try_to_number(F.regexp_extract(name, pattern, 1), F.lit("9999999999")).cast("long"), F.lit(0))
    return F.shiftleft(part(r"^part-(\d+)-") * 1000 + part(r"-c(\d+)\."), 33).bitwiseOR(F.col("_metadata.row_index"))


def cut(df: DataFrame) -> DataFrame:
    """Writes df to the shared checkpoint folder and goes on from there; survives lost executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


@contextlib.contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Work that is run inside hands rows to Python so many at a time, where each row is large."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def few(df: DataFrame) -> bool:
    """Whether df's counted rows and bytes are within the limits of a broadcast.  Callers pass cut() frames, so the count is cheap."""
    held = [F.octet_length(f.name) for f in df.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    held += [F.size(f.name) * 8 for f in df.schema if isinstance(f.dataType, T.ArrayType)]
    size = sum((F.coalesce(F.sum(x), F.lit(0)) for x in held), F.lit(0))
    n, more = df.agg(F.count("*"), size).first()
    return n <= BROADCAST_ROWS and more + 16 * n * len(df.columns) <= BROADCAST_BYTES


def bounded(df: DataFrame) -> DataFrame:
    """df with a broadcast hint if it is few, else df as it is."""
    return F.broadcast(df) if few(df) else df


def join_few(rows: DataFrame, of: DataFrame, key: Column, of_key: Column, spread: Column) -> DataFrame:
    """rows left join of (one row a key): by broadcast if of is few, else salted by spread (0 to SALTS - 1), so that a hot key's rows are dealt to many tasks."""
    if few(of):
        return rows.join(F.broadcast(of), key == of_key, "left")
    of = of.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("__spread", spread).join(of, (key == of_key) & (F.col("__spread") == F.col("__salt")), "left").drop("__salt", "__spread")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
