"""Noise filter of corrected counts, and the Poisson check of lineages per cell."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cladeworks.config import NoiseParams
from cladeworks.functions.statistics import PoissonFit, fit_truncated_poisson
from cladeworks.runtime import materialize, sized


def noise_statistics(corrected: DataFrame, p: NoiseParams = NoiseParams()) -> DataFrame:
    """``corrected`` with normalised counts, rank, expected count, deviation and z score.

    Cells with fewer than ``min_group_size`` rows have no z. Where all values of cells with as many
    lineages are equal, the deviation is 0 and so is z. Ranks of equal counts go by barcode.
    """
    cell = Window.partitionBy("cell_barcode")
    df = corrected.withColumn("normalized_umi_count", F.col("umi_count") / F.nullif(F.sum("umi_count").over(cell), F.lit(0)) * p.target_sum)
    df = df.withColumn("log_normalized_umi_count", F.log1p("normalized_umi_count"))
    by_size = cell.orderBy(F.desc("log_normalized_umi_count"), "corrected_lineage_barcode")
    df = df.withColumn("rank", F.row_number().over(by_size).cast("double"))
    df = df.withColumns({
        "expected_count": F.avg(F.when(F.col("rank") <= p.top_n, F.col("log_normalized_umi_count"))).over(cell),
        "lineage_count": F.size(F.collect_set("corrected_lineage_barcode").over(cell)).cast("long"),
        "is_small_group": F.count("*").over(cell) < p.min_group_size,
    })
    # The deviation needs all cells of one lineage count; those are few keys, so it is summed first and joined.
    spread = df.groupBy("lineage_count").agg(F.stddev_samp("log_normalized_umi_count").alias("std_dev"), (F.max("log_normalized_umi_count") == F.min("log_normalized_umi_count")).alias("level"))
    df = df.join(sized(materialize(spread)), "lineage_count", "left")
    z = (F.col("log_normalized_umi_count") - F.col("expected_count")) / F.nullif(F.col("std_dev"), F.lit(0.0))
    lone = (F.col("std_dev") == 0) | F.col("level")
    df = df.withColumn("z_score", F.when(F.col("is_small_group") | F.col("std_dev").isNull(), F.lit(None).cast("double")).when(lone, 0.0).otherwise(z))
    return df.select(*corrected.columns, "normalized_umi_count", "log_normalized_umi_count", "rank", "expected_count", "lineage_count", "std_dev", "is_small_group", "z_score")


def filter_noise(corrected: DataFrame, p: NoiseParams = NoiseParams()) -> DataFrame:
    """Rows with \\|z\\| below the threshold; ``lineage_count`` is counted anew."""
    kept = noise_statistics(corrected, p).where(F.col("z_score").isNotNull() & (F.abs("z_score") < p.z_threshold))
    return kept.withColumn("lineage_count", F.size(F.collect_set("corrected_lineage_barcode").over(Window.partitionBy("cell_barcode"))).cast("long"))


def lineage_histogram(filtered: DataFrame) -> DataFrame:
    """Cells by number of lineages."""
    cells = filtered.select("cell_barcode", "lineage_count").distinct()
    return cells.groupBy("lineage_count").agg(F.count("*").alias("cells"))


def poisson_quality(filtered: DataFrame) -> PoissonFit:
    """Fit over the histogram, which has a row for each number of lineages that occurs."""
    return fit_truncated_poisson({r[0]: r[1] for r in lineage_histogram(filtered).collect()})
