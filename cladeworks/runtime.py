"""Session helpers shared by every operator: table reads, lineage cuts, size-checked broadcasts, global order."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A side of a join is broadcast only if its counted rows and its estimated bytes stay within these bounds.
BROADCAST_ROWS, BROADCAST_BYTES = 100_000, 32 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a temporary one only on a local master, where none is configured (tests)."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not (context.master == "local" or context.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="cladeworks-checkpoint-"))
    return context._jsc.sc().getCheckpointDir().get()


def materialize(df: DataFrame) -> DataFrame:
    """Compute once and cut the lineage; the rows live in the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def sized(dim: DataFrame, rows: int | None = None, bound: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast if ``dim`` has at most ``bound`` rows and few bytes, both measured in one pass; else leave the join to AQE.

    ``dim`` is computed for the measure and again for the join, so what is dear to compute comes materialized.
    ``rows`` is its count, if that is known to be small.
    """
    if rows is not None and rows > bound:
        return dim
    wide = [F.coalesce(F.length(F.to_json(F.struct(c))), F.lit(0)) for c, t in dim.dtypes if "<" in t or t == "binary"]
    wide += [F.coalesce(F.length(c), F.lit(0)) for c, t in dim.dtypes if t == "string"]
    if rows is not None and not wide:
        return F.broadcast(dim)
    n, total = dim.limit(bound + 1).agg(F.count("*"), F.sum(sum(wide, F.lit(0)).cast("long"))).first()
    return F.broadcast(dim) if n <= bound and (total or 0) <= BROADCAST_BYTES else dim


def ranged(df: DataFrame, *order: Column) -> DataFrame:
    """``df`` in a global order without a task that sees all rows: ``_part`` numbers its ranges, ``_nth`` the rows inside, both from 0."""
    rows = materialize(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_m", F.monotonically_increasing_id()))
    return rows.select(*df.columns, F.shiftright("_m", 33).alias("_part"), F.col("_m").bitwiseAND((1 << 33) - 1).alias("_nth"))


def numbered(df: DataFrame, name: str, *order: Column) -> DataFrame:
    """``df`` with its rows numbered from 1 in a global order; only a row a range is summed in one task."""
    rows = ranged(df, *order)
    ranges = rows.groupBy("_part").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.join(sized(ranges.select("_part", before.alias("_before"))), "_part").select(*df.columns, (F.col("_before") + F.col("_nth") + 1).alias(name))
