"""Differential enrichment of clones between two conditions, relative to an earlier timepoint."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladeworks.config import EnrichmentParams
from cladeworks.functions.statistics import benjamini_hochberg, exact_median, with_fisher_p
from cladeworks.runtime import materialize

#: Output columns, in the order that readers of the file expect.
COLUMNS = ["Clone_ID", "T0_size", "Control_size", "Treated_size", "FC_control", "FC_treated", "Log2_FC_ratio", "p_value", "q_value", "Status"]


def clone_sizes(clones: DataFrame, weights: DataFrame | None = None) -> DataFrame:
    """``(clone_id, size)``: UMIs of the clone's barcodes, 0 for unknown ones, or without weights its number of barcodes.

    A barcode of several clones counts in full for each.
    """
    if weights is None:
        return clones.groupBy("clone_id").agg(F.countDistinct("barcode").alias("size"))
    return clones.join(weights, "barcode", "left").groupBy("clone_id").agg(F.sum(F.coalesce("weight", F.lit(0))).cast("long").alias("size"))


def sizes_by_t0(best: DataFrame, sizes: DataFrame) -> DataFrame:
    """``(clone_id, size)`` of T0 clones: the sum of the sizes of the clones matched to them."""
    met = best.select("T1_clone_id", F.col("T0_clone_id").alias("clone_id")).join(sizes.withColumnRenamed("clone_id", "T1_clone_id"), "T1_clone_id", "left")
    return met.groupBy("clone_id").agg(F.sum(F.coalesce("size", F.lit(0))).cast("long").alias("size"))


def run_enrichment(t0: DataFrame, control: DataFrame, treated: DataFrame, p: EnrichmentParams = EnrichmentParams()) -> DataFrame:
    """A row a T0 clone, by q, p and clone. The test's table has 1 added to each count, whatever the pseudocount."""
    side = lambda df, name: df.select("clone_id", F.col("size").alias(name))
    df = side(t0, "T0_size").join(side(control, "Control_size"), "clone_id", "left").join(side(treated, "Treated_size"), "clone_id", "left").na.fill(0, ["Control_size", "Treated_size"])
    fold = lambda c: (F.col(c) + p.pseudocount) / (F.col("T0_size") + p.pseudocount)
    df = df.withColumns({"FC_control": fold("Control_size"), "FC_treated": fold("Treated_size")})
    whole = lambda c: F.col(c).cast("long") + 1
    df = materialize(df.withColumn("Log2_FC_ratio", F.log2(F.col("FC_treated") / F.col("FC_control"))))
    df = materialize(with_fisher_p(df, whole("T0_size"), whole("Control_size"), whole("T0_size"), whole("Treated_size"), "p_value"))
    df = benjamini_hochberg(df.withColumnRenamed("clone_id", "Clone_ID"), "p_value", "q_value")
    sure, ratio = F.col("q_value") < p.fdr_threshold, F.col("Log2_FC_ratio")
    status = F.when(sure & (ratio > p.log2fc_threshold), "Enriched").when(sure & (ratio < -p.log2fc_threshold), "Depleted").otherwise("Neutral")
    return df.withColumn("Status", status).select(*COLUMNS).orderBy("q_value", "p_value", "Clone_ID")


def enrichment_summary(results: DataFrame) -> DataFrame:
    ratio = F.col("Log2_FC_ratio")
    no_control, no_treated = F.col("Control_size") == 0, F.col("Treated_size") == 0
    return results.agg(
        F.count("*").alias("clones"), *[F.count_if(F.col("Status") == s).alias(s.lower()) for s in ("Enriched", "Depleted", "Neutral")],
        F.avg(ratio).alias("mean"), F.lit(exact_median(results, "Log2_FC_ratio")).cast("double").alias("median"), F.stddev_samp(ratio).alias("std"), F.min(ratio).alias("min"), F.max(ratio).alias("max"),
        F.count_if(no_control).alias("absent_control"), F.count_if(no_treated).alias("absent_treated"), F.count_if(no_control & no_treated).alias("absent_both"),
    )


def top_clones(results: DataFrame, status: str, n: int = 10) -> DataFrame:
    """The clones of a status with the strongest ratio."""
    order = F.asc("Log2_FC_ratio") if status == "Depleted" else F.desc("Log2_FC_ratio")
    return results.where(F.col("Status") == status).orderBy(order, "Clone_ID").limit(n)


def top_changed(results: DataFrame, n: int = 10) -> DataFrame:
    """The strongest clones of both statuses."""
    return top_clones(results, "Enriched", n).unionByName(top_clones(results, "Depleted", n))


def plot_points(results: DataFrame) -> DataFrame:
    """Coordinates of the volcano, MA and trajectory plots, and log sizes of the heat map."""
    log_of = lambda c, least: F.log2(F.greatest(F.col(c), F.lit(least)))
    size = lambda c: F.log2(F.col(c) + 1)
    return results.select(
        "Clone_ID", "Status", "Log2_FC_ratio", (-F.log10(F.greatest("q_value", F.lit(1e-300)))).alias("neg_log10_q"),
        F.log2(F.greatest((F.col("Control_size") + F.col("Treated_size")) / 2, F.lit(0.5))).alias("mean_log2_size"),
        log_of("FC_control", 1e-10).alias("log2_fc_control"), log_of("FC_treated", 1e-10).alias("log2_fc_treated"),
        size("T0_size").alias("log2_t0"), size("Control_size").alias("log2_control"), size("Treated_size").alias("log2_treated"),
    )


def ratio_histogram(results: DataFrame, bins: int = 80) -> DataFrame:
    """Clones by bin of the ratio over its range."""
    low, high = results.agg(F.min("Log2_FC_ratio"), F.max("Log2_FC_ratio")).first()
    width = ((high - low) / bins or 1.0) if low is not None else 1.0
    bin_ = F.least(F.floor((F.col("Log2_FC_ratio") - F.lit(low or 0.0)) / width), F.lit(bins - 1)).cast("int")
    return results.groupBy(bin_.alias("bin")).agg(F.count("*").alias("clones"))
