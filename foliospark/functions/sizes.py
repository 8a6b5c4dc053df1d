"""How large an input is, as the optimizer knows it without a job, and what follows for its parallelism."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: An input with fewer bytes than this for each core has fewer row groups than there are cores.
SPLIT_BYTES = 16 << 20
#: So many bytes of files of texts make a piece whose words' counts fit a small table.
PIECE_BYTES = 8 << 20


def input_bytes(df: DataFrame) -> int:
    """Bytes of the tables that df reads, by the optimizer's statistics of its leaves. Leaves of unknown size count as none."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(n for n in sizes if n < 1 << 60)


def spread(df: DataFrame) -> DataFrame:
    """df, dealt to all cores if it is so small, and in so few files, that these would keep only some cores busy; any other input is
    left as it is. No job runs."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 0 < input_bytes(df) < cores * SPLIT_BYTES and len(df.inputFiles()) < cores else df


def dealt(df: DataFrame) -> DataFrame:
    """df, dealt to pieces of PIECE_BYTES of its input where the parts that it is read in may be larger: for steps whose tasks keep a
    table of all that they read. No job runs."""
    pieces = -(-input_bytes(df) // PIECE_BYTES)
    return df.repartition(pieces) if pieces > df.sparkSession.sparkContext.defaultParallelism else df
