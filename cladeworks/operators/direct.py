"""Cells of a later timepoint matched to cells of an earlier one, barcodes one to one."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cladeworks.config import DirectParams
from cladeworks.functions.statistics import exact_median
from cladeworks.operators import blocks
from cladeworks.operators.similarity import hamming_pairs
from cladeworks.runtime import materialize, numbered

NO_MATCH = "NO_MATCH"


def cells_of(corrected: DataFrame) -> DataFrame:
    """``(cell, barcodes, umis)``: repeated rows of a barcode are summed."""
    summed = corrected.groupBy(F.col("cell_barcode").alias("cell"), F.col("corrected_lineage_barcode").alias("barcode")).agg(F.sum("umi_count").alias("umi"))
    return summed.groupBy("cell").agg(F.array_sort(F.collect_list("barcode")).alias("barcodes"), F.map_from_entries(F.collect_list(F.struct("barcode", "umi"))).alias("umis"), F.sum("umi").alias("total"))


def _pairs(near: DataFrame, new: DataFrame, old: DataFrame, p: DirectParams) -> DataFrame:
    """``(t1_cell, t0_cell, matched, mean_distance, shared, ...)`` of pairs that reach the thresholds, with both cells' numbers of barcodes and UMIs.

    Cells meet block by block, so no row is made for a barcode that a pair shares, nor for a pair below the thresholds.
    """
    named = lambda df: materialize(numbered(df.select("cell", "umis", F.size("barcodes").alias("n"), "total"), "id", F.col("cell")))
    new, old = named(new), named(old)
    rows = lambda df: df.select("id", F.explode("umis").alias("barcode", "value"))
    facts = lambda df: df.select("id", F.array(F.col("n").cast("long"), F.col("total").cast("long")).alias("facts"))
    judge = blocks.one_to_one(p.min_matched_barcodes, p.jaccard_threshold, p.use_umi_weighting, p.top_n)
    found = blocks.compare(rows(new), facts(new), rows(old), facts(old), near, judge, "t1 long, t0 long, matched long, distance long, shared long")
    side = lambda df, n: df.select(F.col("id").alias(n), F.col("cell").alias(f"{n}_cell"), F.col("n").alias(f"{n}_n"), F.col("total").alias(f"{n}_total"))
    pairs = found.join(side(new, "t1"), "t1").join(side(old, "t0"), "t0")
    return pairs.withColumn("matched", F.col("matched").cast("int")).withColumn("mean_distance", F.col("distance") / F.col("matched"))


def match_cells(t0: DataFrame, t1: DataFrame, p: DirectParams = DirectParams()) -> DataFrame:
    """Ranked matches of every T1 cell; a T1 cell without one has a row of placeholders.

    Inputs are corrected counts. Only barcodes of equal length compare. Candidate pairs take barcode
    matches greedily by (distance, T1, T0). With UMI weights, threshold and rank use the weighted score.
    Scores are ranked as they are and rounded for output.
    """
    old, new = materialize(cells_of(t0)), materialize(cells_of(t1))
    near = materialize(hamming_pairs(t1.select("corrected_lineage_barcode"), t0.select("corrected_lineage_barcode"), p.hamming_threshold, strict_length=True))
    pairs = _pairs(near, new, old, p)
    union = F.col("t0_n") + F.col("t1_n") - F.col("matched")
    weighted_union = F.col("t0_total") + F.col("t1_total") - F.col("shared")
    pairs = pairs.withColumns({
        "jaccard": F.when(union > 0, F.col("matched") / F.nullif(union, F.lit(0))).otherwise(0.0),
        "weighted": F.when(weighted_union > 0, F.col("shared") / F.nullif(weighted_union, F.lit(0).cast("long"))).otherwise(0.0),
    })
    score = "weighted" if p.use_umi_weighting else "jaccard"
    order = Window.partitionBy("t1_cell").orderBy(F.desc(score), F.desc("matched"), "mean_distance", "t0_cell")
    ranked = pairs.where(F.col(score) >= p.jaccard_threshold).withColumn("match_rank", F.row_number().over(order))
    if p.top_n:
        ranked = ranked.where(F.col("match_rank") <= p.top_n)
    ranked = materialize(ranked)
    extra = {"umi_weighted_similarity": F.round("weighted", 6)} if p.use_umi_weighting else {}
    text = lambda c: F.array_join(c, ";")
    side = lambda df, n: df.select(F.col("cell").alias(f"{n}_cell"), F.col("barcodes").alias(f"{n}_barcodes"))
    rows = ranked.join(side(new, "t1"), "t1_cell").join(side(old, "t0"), "t0_cell").select(
        F.col("t0_cell").alias("T0_cell_barcode"), text("t0_barcodes").alias("T0_barcodes"), F.size("t0_barcodes").alias("T0_barcode_count"), F.col("t1_cell").alias("T1_cell_barcode"), text("t1_barcodes").alias("T1_barcodes"), F.size("t1_barcodes").alias("T1_barcode_count"),
        F.col("matched").alias("matched_barcodes"), F.round("jaccard", 6).alias("jaccard_similarity"), *[c.alias(n) for n, c in extra.items()], "match_rank",
    )
    alone = new.join(ranked.select(F.col("t1_cell").alias("cell")).distinct(), "cell", "left_anti")
    rest = alone.select(
        F.lit(NO_MATCH).alias("T0_cell_barcode"), F.lit(NO_MATCH).alias("T0_barcodes"), F.lit(0).alias("T0_barcode_count"), F.col("cell").alias("T1_cell_barcode"), text("barcodes").alias("T1_barcodes"), F.size("barcodes").alias("T1_barcode_count"),
        F.lit(0).alias("matched_barcodes"), F.lit(0.0).alias("jaccard_similarity"), *[F.lit(0.0).alias(n) for n in extra], F.lit(1).alias("match_rank"),
    )
    return rows.unionByName(rest)


def match_summary(matches: DataFrame) -> DataFrame:
    """Counts of matched and unmatched T1 cells, and the spread of the best similarities."""
    hit = (F.col("match_rank") == 1) & (F.col("matched_barcodes") > 0)
    matches = materialize(matches.select("match_rank", "matched_barcodes", F.when(hit, F.col("jaccard_similarity")).alias("best")))
    score = F.col("best")
    return matches.agg(F.count_if(hit).alias("matched"), F.count_if(F.col("matched_barcodes") == 0).alias("unmatched"), F.avg(score).alias("mean"), F.lit(exact_median(matches, "best")).cast("double").alias("median"), F.min(score).alias("min"), F.max(score).alias("max"))


def validate_counts(corrected: DataFrame) -> None:
    """Raise ``ValueError`` unless counts are there, whole and not negative, and no barcode is missing."""
    wanted = {"cell_barcode", "corrected_lineage_barcode", "umi_count"}
    if missing := wanted.difference(corrected.columns):
        raise ValueError(f"missing columns: {', '.join(sorted(missing))}")
    bad = F.col("cell_barcode").isNull() | (F.col("cell_barcode") == "") | F.col("corrected_lineage_barcode").isNull() | (F.col("corrected_lineage_barcode") == "") | F.expr("try_cast(umi_count as bigint)").isNull() | (F.expr("try_cast(umi_count as double)") < 0)
    n, wrong = corrected.agg(F.count("*"), F.count_if(bad)).first()
    if not n or wrong:
        raise ValueError(f"{wrong} of {n} rows are not valid counts")
