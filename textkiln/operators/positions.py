"""Global order without a single-partition window.

``row_number()`` or a running ``sum`` over an unpartitioned window sends the
whole table through one task.  ``ordered_offsets`` instead

1. range-partitions the rows on the order keys (balanced by Spark's sampled
   bounds; equal keys never straddle partitions) and sorts inside each
   partition,
2. computes the exclusive running total of a weight inside each partition
   with Arrow (one pass, no shuffle),
3. sums each partition (one row per partition), turns those sums into start
   offsets over a table whose size is the partition count, and broadcasts it.

Range bounds are sampled per exchange (the sample seed depends on the RDD
id), so two branches over the same input may cut differently.  The partition-
local table is therefore written once to the shared folder
(it is narrow: order keys, weight and the caller's payload) and both the
totals and the final join read it.  The order keys must be a total order
(unique), otherwise ties get an arbitrary order.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textkiln.session import materialised

_PID = "_tk_pid"
_LOCAL = "_tk_local"
_W = "_tk_w"


def _local_cumsum(batches):
    pid = TaskContext.get().partitionId()
    running = 0
    for batch in batches:
        w = batch.column(_W)
        w = pc.fill_null(w, 0)
        incl = pc.cumulative_sum(w)
        excl = pc.subtract(incl, w)
        local = pc.add(excl, pa.scalar(running, pa.int64()))
        if len(batch):
            running += int(incl[-1].as_py())
        yield pa.RecordBatch.from_arrays(
            list(batch.columns) + [pa.array([pid] * len(batch), pa.int32()), local],
            names=list(batch.schema.names) + [_PID, _LOCAL],
        )


def ordered_offsets(
    df: DataFrame,
    order: list[Column | str],
    weight: Column | str | None = None,
    out: str = "offset",
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``out`` = sum of ``weight`` over all rows strictly before this row in
    ``order`` (0-based row index when ``weight`` is None)."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    w = F.lit(1).cast("long") if weight is None else (F.col(weight) if isinstance(weight, str) else weight).cast("long")
    staged = df.withColumn(_W, w).repartitionByRange(n, *order).sortWithinPartitions(*order)
    schema = T.StructType(staged.schema.fields + [
        T.StructField(_PID, T.IntegerType()),
        T.StructField(_LOCAL, T.LongType()),
    ])
    local = materialised(staged.mapInArrow(_local_cumsum, schema), "offsets")
    totals = local.groupBy(_PID).agg(F.sum(_W).alias("_tk_tot"))
    # Window over one row per partition: bounded by the partition count.
    starts = totals.select(
        _PID,
        F.coalesce(
            F.sum("_tk_tot").over(Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0).cast("long"),
        ).alias("_tk_start"),
    )
    return (
        local.join(F.broadcast(starts), _PID, "left")
        .withColumn(out, F.coalesce(F.col("_tk_start"), F.lit(0).cast("long")) + F.col(_LOCAL))
        .drop(_PID, _LOCAL, _W, "_tk_start")
    )


def row_index(df: DataFrame, order: list[Column | str], out: str = "row_idx", num_partitions: int | None = None) -> DataFrame:
    """0-based global row number in ``order``."""
    return ordered_offsets(df, order, None, out, num_partitions)


def group_offsets(
    df: DataFrame,
    group: list[str],
    order: list[Column | str],
    weight: Column | str | None = None,
    out: str = "offset",
    num_partitions: int | None = None,
) -> DataFrame:
    """Running sum of ``weight`` over the rows strictly before this one inside
    its ``group`` (0-based rank when ``weight`` is None).

    A window partitioned by the group sorts a whole group in one task, so one
    hot group holding a third of the rows is one task.  Here the rows are
    numbered globally in ``(group, order)`` over balanced range partitions
    (a hot group spans many of them), and each group's start -- the smallest
    global offset in it, one row per group after a partial aggregate -- is
    subtracted.  Group keys must be non-null."""
    glob = ordered_offsets(df, [*group, *order], weight, "_tk_goff", num_partitions)
    starts = glob.groupBy(*group).agg(F.min("_tk_goff").alias("_tk_gstart"))
    return (
        glob.join(starts, group)
        .withColumn(out, F.col("_tk_goff") - F.col("_tk_gstart"))
        .drop("_tk_goff", "_tk_gstart")
    )
