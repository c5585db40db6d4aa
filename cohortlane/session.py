"""Session-level helpers: lineage cuts, size-checked broadcasts, numbering without a global sort task."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from .errors import DataContractError

#: A side is broadcast only after its rows were counted and found to be at most this many.
BROADCAST_ROWS = 500_000


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder that ``spark.checkpoint.dir`` names.

    Where none is named, a session inside one machine gets a new folder there; on a cluster that is an error,
    as executors could not read each other's files.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise DataContractError("Name a folder that all executors share in spark.checkpoint.dir.")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="cohortlane-checkpoint-"))
    return context.getCheckpointDir()


def cut(frame: DataFrame) -> DataFrame:
    """Write a frame to the checkpoint folder and read it back.

    This ends its lineage, survives lost executors, and tells Catalyst the exact size of what follows, so
    that a small result is broadcast and a large one is not.
    """
    path = f"{scratch_folder(frame.sparkSession)}/{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def local_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A frame of configuration values. Known at planning time, so it needs no job of its own."""
    fields = T.StructType.fromDDL(schema).fields
    if len(rows) > 1000 or any(isinstance(f.dataType, T.ArrayType) for f in fields):
        return spark.createDataFrame(rows, schema)
    names = ", ".join(f.name for f in fields)
    filled = rows or [(None,) * len(fields)]
    values = {f"v{i}_{j}": value for i, row in enumerate(filled) for j, value in enumerate(row)}
    lines = [
        "(" + ", ".join(f"cast(:v{i}_{j} as {f.dataType.simpleString()})" for j, f in enumerate(fields)) + ")"
        for i in range(len(filled))
    ]
    frame = spark.sql(f"select * from values {', '.join(lines)} as t({names})", args=values)
    return frame if rows else frame.filter(F.lit(False))


def broadcast_if_small(frame: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast after counting; beyond the limit leave the join to Catalyst and AQE.

    The count stops early: it never looks at more than ``limit + 1`` rows.
    """
    return F.broadcast(frame) if frame.limit(limit + 1).count() <= limit else frame


def all_true(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, columns, F.lit(True))


def any_true(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, columns, F.lit(False))


def numbered(frame: DataFrame, keys: list[str], order: list[Column], name: str) -> DataFrame:
    """``row_number`` within ``keys``, without putting a whole key into one task.

    Rows are range-partitioned on (keys, order), so a hot key spreads over many partitions. Each row gets
    its place inside its partition; the rows of the same key in earlier partitions are then added from a
    table of (partition, key) counts, which has at most one row per partition and key.
    """
    order_columns = [F.col(k).asc() for k in keys] + order
    place = frame.repartitionByRange(*order_columns).sortWithinPartitions(*order_columns)
    place = place.withColumn("_at", F.monotonically_increasing_id())
    place = cut(
        place.withColumn("_part", F.shiftright("_at", 33)).withColumn(
            "_at", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
        )
    )
    counts = place.groupBy("_part", *keys).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_part", *keys, (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift")
    )
    joined = place.alias("p").join(
        broadcast_if_small(offsets).alias("o"),
        on=(F.col("p._part") == F.col("o._part"))
        & all_true([F.col(f"p.{k}").eqNullSafe(F.col(f"o.{k}")) for k in keys]),
    )
    kept = [F.col(f"p.{c}") for c in frame.columns]
    return joined.select(*kept, (F.col("p._at") + F.col("o._shift") + 1).cast(T.LongType()).alias(name))


def running_total(frame: DataFrame, keys: list[str], order: list[Column], weight: str, name: str) -> DataFrame:
    """Running sum of ``weight`` within ``keys``, spread over range partitions like ``numbered``."""
    order_columns = [F.col(k).asc() for k in keys] + order
    spread = cut(frame.repartitionByRange(*order_columns).withColumn("_part", F.spark_partition_id()))
    sums = spread.groupBy("_part", *keys).agg(F.sum(weight).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_part", *keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    inside = Window.partitionBy("_part", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    joined = spread.withColumn("_upto", F.sum(weight).over(inside)).join(
        broadcast_if_small(offsets), ["_part", *keys]
    )
    return joined.select(*frame.columns, (F.col("_upto") + F.col("_shift")).alias(name))
