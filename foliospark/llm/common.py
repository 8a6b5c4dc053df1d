"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.sizes import input_bytes, spread

#: The ASCII white space of the word rules: blank, \t, \n, \v, \f, \r.
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
SPACE_CLASS = r"[\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, from spark.checkpoint.dir.

    Only a local session may go without it: it gets a folder of its own.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and the executors share")
    made = tempfile.mkdtemp(prefix="foliospark-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write df to the shared folder and read it again: lineage ends there, so a lost executor
    costs no more than a read, and a plan that uses df twice computes it once."""
    path = f"{shared_dir(df.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.__dict__["_folder"] = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete what materialise wrote for these tables (others are left alone). Nothing that is still to be computed may read them."""
    for df in tables:
        if folder := df.__dict__.get("_folder"):
            jvm = df.sparkSession.sparkContext._jvm
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def words(text: Column) -> Column:
    """Words of [^\\x20\\x09-\\x0D]+ in order; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS), "")


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the doc_id as text, modulo n; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


#: Bytes of input (as its sources count them) for each shuffled piece of work that is held in memory at once.
PIECE_BYTES = 8 << 20


def pieces(df: DataFrame, least: int = 1) -> int:
    """How many pieces to deal df to: by its bytes, and at least `least` for each shuffle partition."""
    return max(least * shuffle_width(df.sparkSession), -(-input_bytes(df) // PIECE_BYTES))


def compact(df: DataFrame) -> DataFrame:
    """df, to be written: where the session's shuffle partitions are many times what its input asks for, its rows are dealt to two
    partitions a core, or to as many as its input has pieces. What computes df keeps all its partitions.

    On a local file system without Hadoop's native library each file that is written costs several processes, forked from the
    executor, whose memory they share until they begin.
    """
    few = max(2 * df.sparkSession.sparkContext.defaultParallelism, -(-input_bytes(df) // PIECE_BYTES))
    return df.repartition(few) if 4 * few <= shuffle_width(df.sparkSession) else df


def small_table(spark: SparkSession, rows: list[tuple], **columns: pa.DataType) -> DataFrame:
    """A few rows from the driver. They go as Arrow: lists of rows would start Python workers on the executors, which then stay."""
    return spark.createDataFrame(pa.table([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(columns.values())], list(columns)))
