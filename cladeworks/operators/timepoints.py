"""Clones of a later timepoint matched to clones of an earlier one by fuzzy Jaccard similarity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cladeworks.config import TimepointParams
from cladeworks.functions.statistics import exact_median
from cladeworks.operators import blocks
from cladeworks.operators.similarity import hamming_pairs
from cladeworks.runtime import materialize, numbered

#: T0 clones that own a barcode at most where pairs are listed; beyond it clones meet in blocks.
COMMON_OWNERS = 64


def explode_clones(clone_barcodes: DataFrame) -> DataFrame:
    """``(clone_id, barcode)`` from ``(cloneID, clone_barcode)`` with barcodes joined by underscores."""
    return clone_barcodes.select(F.col("cloneID").alias("clone_id"), F.explode(F.split("clone_barcode", "_")).alias("barcode")).distinct()


def umi_weights(filtered: DataFrame) -> DataFrame:
    return filtered.groupBy(F.col("corrected_lineage_barcode").alias("barcode")).agg(F.sum("umi_count").alias("weight"))


def _sized(clones: DataFrame, weights: DataFrame | None, name: str) -> DataFrame:
    rows = clones if weights is None else clones.join(weights, "barcode", "left")
    weight = F.lit(1.0) if weights is None else F.coalesce("weight", F.lit(1)).cast("double")
    each = Window.partitionBy("clone_id")
    return rows.select(F.col("clone_id").alias(f"{name}_clone_id"), F.col("barcode").alias(f"{name}_barcode"), weight.alias(f"{name}_weight"), F.count("*").over(each).alias(f"num_{name}_barcodes"), F.sum(weight).over(each).alias(f"{name}_total"))


def _similarity(matched: Column) -> Column:
    return matched / F.nullif(F.col("num_T1_barcodes") + F.col("num_T0_barcodes") - matched, F.lit(0).cast("long"))


def _candidates(near: DataFrame, t0: DataFrame, t1: DataFrame, top_n: int) -> DataFrame:
    """``(T1_clone_id, T0_clone_id)``: the best ``top_n`` pairs of each T1 clone, without meeting at barcodes that many T0 clones own.

    Where every barcode is rare the pairs that they tie are listed and counted. Else clones meet block by block, and a tile's best leave the task.
    """
    owners = t0.groupBy("T0_barcode").agg(F.count("*").alias("owners"))
    tagged = near.join(owners.select("T0_barcode", (F.col("owners") > COMMON_OWNERS).alias("common")), "T0_barcode").select("T1_barcode", "T0_barcode", "common")
    rare = tagged.join(t1.select("T1_clone_id", "T1_barcode", "num_T1_barcodes"), "T1_barcode").join(t0.select("T0_clone_id", "T0_barcode", "num_T0_barcodes"), "T0_barcode")
    sizes = [F.first(c).alias(c) for c in ("num_T1_barcodes", "num_T0_barcodes")]
    tied = rare.groupBy("T1_clone_id", "T0_clone_id").agg(F.countDistinct("T1_barcode").alias("matched"), *sizes)
    nth = Window.partitionBy("T1_clone_id").orderBy(F.desc("least"), "T0_clone_id")
    tied = tied.withColumn("least", _similarity(F.col("matched"))).withColumn("nth", F.row_number().over(nth))
    if not tagged.where("common").limit(1).count():  # the scores are whole
        return tied.where(F.col("nth") <= top_n).select("T1_clone_id", "T0_clone_id")
    named = lambda df, n: materialize(numbered(df.groupBy(f"{n}_clone_id").agg(F.first(f"num_{n}_barcodes").alias("n")), "id", F.col(f"{n}_clone_id")))
    new, old = named(t1, "T1"), named(t0, "T0")
    rows = lambda df, ids, n: df.join(ids, f"{n}_clone_id").select("id", F.col(f"{n}_barcode").alias("barcode"), F.lit(0).alias("value"))
    facts = lambda ids: ids.select("id", F.array(F.col("n").cast("long")).alias("facts"))
    links = near.select(F.col("T1_barcode").alias("b1"), F.col("T0_barcode").alias("b2"), "distance")
    found = blocks.compare(rows(t1, new, "T1"), facts(new), rows(t0, old, "T0"), facts(old), links, blocks.most_similar(top_n), "t1 long, t0 long, matched long")
    side = lambda ids, n, c: ids.select(F.col("id").alias(c), f"{n}_clone_id", F.col("n").alias(f"num_{n}_barcodes"))
    best = found.join(side(new, "T1", "t1"), "t1").join(side(old, "T0", "t0"), "t0").withColumn("least", _similarity(F.col("matched"))).withColumn("nth", F.row_number().over(nth))
    return best.where(F.col("nth") <= top_n).select("T1_clone_id", "T0_clone_id")


def match_clones(t0: DataFrame, t1: DataFrame, p: TimepointParams = TimepointParams(), t0_weights: DataFrame | None = None, t1_weights: DataFrame | None = None) -> DataFrame:
    """Up to ``top_n`` matches a T1 clone, best first; inputs as ``explode_clones`` gives them.

    Similarity counts distinct T1 barcodes that match, over the union's size, so several T1 barcodes may
    match one T0 barcode and it can exceed 1. UMI weights add a column and do not rank. Ties go to the
    lesser T0 clone. Only pairs that may be among the best are put together.
    """
    near = materialize(hamming_pairs(t1.select("barcode"), t0.select("barcode"), p.hamming_threshold).toDF("T1_barcode", "T0_barcode", "distance"))
    new, old = materialize(_sized(t1, t1_weights, "T1")), materialize(_sized(t0, t0_weights, "T0"))
    met = _candidates(near, old, new, p.top_n).join(new, "T1_clone_id").join(near, "T1_barcode").join(old, ["T0_clone_id", "T0_barcode"])
    # A pair's barcodes are deduplicated on each side before they are counted and weighed.
    side = lambda n: F.collect_set(F.struct(f"{n}_barcode", f"{n}_weight")).alias(n)
    pairs = met.groupBy("T1_clone_id", "T0_clone_id").agg(side("T1"), side("T0"), *[F.first(c).alias(c) for c in ("num_T1_barcodes", "num_T0_barcodes", "T1_total", "T0_total")])
    pairs = pairs.withColumn("num_matched_barcodes", F.size("T1").cast("long"))
    weigh = lambda n: F.aggregate(n, F.lit(0.0), lambda s, x: s + x[f"{n}_weight"])
    total = F.col("T1_total") + F.col("T0_total")
    pairs = pairs.withColumns({
        "similarity_score": _similarity(F.col("num_matched_barcodes")),
        "umi_weighted_score": F.when(total > 0, (weigh("T1") + weigh("T0")) / F.nullif(total, F.lit(0.0))).otherwise(0.0),
    }).where("similarity_score is not null")
    best = Window.partitionBy("T1_clone_id").orderBy(F.desc("similarity_score"), "T0_clone_id")
    ranked = pairs.withColumn("match_rank", F.row_number().over(best)).where(F.col("match_rank") <= p.top_n)
    weighted = ["umi_weighted_score"] if p.weight_by_umi else []
    return ranked.select("T1_clone_id", "T0_clone_id", "similarity_score", *weighted, "num_matched_barcodes", "num_T1_barcodes", "num_T0_barcodes", "match_rank")


def best_matches(ranked: DataFrame) -> DataFrame:
    """The first match of each T1 clone, whatever its similarity."""
    return ranked.where("match_rank = 1").drop("match_rank")


def unmatched_clones(ranked: DataFrame, t1: DataFrame, p: TimepointParams = TimepointParams()) -> DataFrame:
    """T1 clones whose best match is below the threshold, and those without candidates (T0 null, score 0)."""
    best = best_matches(ranked)
    below = best.where(F.col("similarity_score") < p.similarity_threshold).select("T1_clone_id", "T0_clone_id", "similarity_score")
    none = t1.select(F.col("clone_id").alias("T1_clone_id")).distinct().join(best.select("T1_clone_id"), "T1_clone_id", "left_anti")
    return below.unionByName(none.select("T1_clone_id", F.lit(None).cast("long").alias("T0_clone_id"), F.lit(0.0).alias("similarity_score")))


def match_statistics(ranked: DataFrame, t1: DataFrame, p: TimepointParams = TimepointParams()) -> DataFrame:
    """One row of counts and of mean, median, population deviation and range of the best similarities."""
    all_t1 = materialize(t1.select(F.col("clone_id").alias("T1_clone_id")).distinct().join(best_matches(ranked).select("T1_clone_id", "similarity_score"), "T1_clone_id", "left"))
    score = F.col("similarity_score")
    return all_t1.agg(
        F.count("*").alias("t1_clones"), F.count(score).alias("with_candidates"), F.count_if(score >= p.similarity_threshold).alias("matched"),
        F.avg(score).alias("mean_similarity"), F.lit(exact_median(all_t1, "similarity_score")).cast("double").alias("median_similarity"), F.stddev_pop(score).alias("std_similarity"), F.min(score).alias("min_similarity"), F.max(score).alias("max_similarity"),
    )


def similarity_histogram(best: DataFrame, bins: int = 20) -> DataFrame:
    """Best matches by bin of their similarity from 0 to 1; what exceeds 1 is in the last."""
    bin_ = F.least(F.floor(F.col("similarity_score") * bins), F.lit(bins - 1)).cast("int")
    return best.groupBy(bin_.alias("bin")).agg(F.count("*").alias("clones"))


def matched_sizes(best: DataFrame, p: TimepointParams = TimepointParams()) -> DataFrame:
    """Points of the plot of matched clones' sizes: matches by both numbers of barcodes, with their mean similarity; as many rows as there are sizes."""
    matched = best.where(F.col("similarity_score") >= p.similarity_threshold)
    return matched.groupBy("num_T0_barcodes", "num_T1_barcodes").agg(F.count("*").alias("clones"), F.avg("similarity_score").alias("similarity_score"))


def top_match_grid(ranked: DataFrame, clones: int = 30) -> DataFrame:
    """Similarities of the most similar best matches as a grid: a row a T1 clone, a column a T0 clone, 0 where there is none."""
    top = best_matches(ranked).orderBy(F.desc("similarity_score"), "T1_clone_id").limit(clones).select("T1_clone_id")
    cells = ranked.join(F.broadcast(top), "T1_clone_id", "left_semi")  # ``clones`` rows
    return cells.groupBy("T1_clone_id").pivot("T0_clone_id").agg(F.first("similarity_score")).na.fill(0.0)
