"""Steps 2 and 3 as a stream: addresses arrive as files, counts are kept up to date.

Later steps need statistics over all cells, so they run in batch on what the stream has written.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cladeworks import schemas
from cladeworks.operators.molecules import count_addresses, filter_mismatches

COUNTED = "cell_barcode string, umi string, lineage_barcode string, read_count long, kind string, batch long"


def stream_addresses(spark: SparkSession, folder: str, files: int | None = None) -> DataFrame:
    """Addresses as files arrive in ``folder``, at most ``files`` a batch."""
    reader = spark.readStream.schema(schemas.ADDRESS).option("sep", "\t")
    return (reader if files is None else reader.option("maxFilesPerTrigger", files)).csv(folder)


def stream_molecules(addresses: DataFrame, max_mismatches: int) -> DataFrame:
    """Running read counts per cell, UMI and lineage; the state has a row for each molecule."""
    return count_addresses(filter_mismatches(addresses, max_mismatches))


def stream_reads_per_cell(addresses: DataFrame, time_col: str, window: str = "1 minute", delay: str = "5 minutes") -> DataFrame:
    """Reads per cell and window of arrival; the watermark bounds the state."""
    return addresses.withWatermark(time_col, delay).groupBy(F.window(time_col, window), "cell_barcode").agg(F.count("*").alias("reads"))


def write_counts(counts: DataFrame, checkpoint: str, sink: str, fold_every: int = 20) -> StreamingQuery:
    """Start the stream on what has arrived; each batch adds only the molecules whose count it changed.

    A batch has a folder of its own, which a rerun after a failure replaces by the same rows. Before every
    ``fold_every``-th batch those so far are folded into one, so what readers see stays in proportion to the molecules.
    """

    def put(batch: DataFrame, n: int) -> None:
        if n and n % fold_every == 0:
            fold_counts(batch.sparkSession, sink, n)
        batch.write.mode("overwrite").parquet(f"{sink}/kind=changed/batch={n}")

    return counts.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(put).trigger(availableNow=True).start()


def current_counts(spark: SparkSession, sink: str, below: int | None = None) -> DataFrame:
    """The latest count of each molecule; with ``below``, as of the batches before that one."""
    rows = spark.read.schema(COUNTED).parquet(sink)
    rows = rows if below is None else rows.where(F.col("batch") < below)
    return rows.groupBy("cell_barcode", "umi", "lineage_barcode").agg(F.max_by("read_count", "batch").alias("read_count"))


def fold_counts(spark: SparkSession, sink: str, below: int) -> None:
    """One folder in place of those of the batches before ``below``. Not beside a running batch of these.

    The old folders go only when the new one is written. A fold that fails leaves rows that are right as of their batch,
    so readers see the same counts before, after and between.
    """
    old = spark.read.schema(COUNTED).parquet(sink).where(F.col("batch") < below).select("kind", "batch").distinct().collect()  # a row a folder
    if len(old) < 2:
        return
    last = max(r.batch for r in old)
    current_counts(spark, sink, below).write.parquet(f"{sink}/kind=folded-{uuid.uuid4().hex}/batch={last}")
    paths = spark._jvm.org.apache.hadoop.fs
    for r in old:
        path = paths.Path(f"{sink}/kind={r.kind}/batch={r.batch}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
