"""Quality reports: retention of reads, and cumulative molecules per cell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cladeworks.runtime import ranged, sized


def record_count(spark: SparkSession, path: str) -> int:
    """Records of a file: lines, or a quarter of them for gzipped FASTQ."""
    lines = spark.read.text(path).count()
    return lines // 4 if path.endswith(".fastq.gz") else lines


def retention(original: Column, processed: Column) -> Column:
    """Percent that is left; 0 of nothing."""
    return F.when(original == 0, 0.0).otherwise(processed / F.nullif(original, F.lit(0)) * 100)


def molecules_per_cell(addresses: DataFrame, cell: str = "cell_barcode", gene: str = "gene") -> DataFrame:
    return addresses.groupBy(F.col(cell).alias("barcode")).agg(F.count("*").alias("molecules"), F.countDistinct(gene).alias("genes"))


def cumulative_histogram(cells: DataFrame) -> DataFrame:
    """Cells by falling molecules with the cumulative share and running means: sums over range-sorted parts and inside each."""
    rows = ranged(cells.select("barcode", "molecules", "genes"), F.desc("molecules"), F.col("barcode"))
    parts = rows.groupBy("_part").agg(F.count("*").alias("n"), F.sum("molecules").alias("m"), F.sum("genes").alias("g"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row a part
    ahead = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before")
    parts = parts.select("_part", ahead("n"), ahead("m"), ahead("g"), F.sum("m").over(Window.partitionBy()).alias("all"))
    up_to = Window.partitionBy("_part").orderBy("_nth").rowsBetween(Window.unboundedPreceding, 0)
    running = rows.join(sized(parts), "_part").withColumns({
        "n": F.col("n_before") + F.col("_nth") + 1, "m": F.col("m_before") + F.sum("molecules").over(up_to), "g": F.col("g_before") + F.sum("genes").over(up_to),
    })
    return running.select("barcode", "molecules", "genes", (F.col("m") / F.col("all")).alias("cum_fraction"), (F.col("m") / F.col("n")).alias("mean_molecules"), (F.col("g") / F.col("n")).alias("mean_genes"))


def cells_before_and_after(before: DataFrame, after: DataFrame, cell: str = "cell_barcode") -> DataFrame:
    """``(before, after, lost)``: distinct cells of a step's input and output, and those that it drops."""
    one, two = (df.select(F.col(cell).alias("cell")).distinct() for df in (before, after))
    both = one.withColumn("b", F.lit(1)).join(two.withColumn("a", F.lit(1)), "cell", "full")
    return both.agg(F.count("b").alias("before"), F.count("a").alias("after"), F.count_if(F.col("a").isNull()).alias("lost"))
