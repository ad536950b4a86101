"""Final tables and texts of matching, enrichment and the Poisson check. File names are fixed values that readers expect."""

from __future__ import annotations

from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeworks.config import EnrichmentParams, TimepointParams
from cladeworks.functions.statistics import PoissonFit
from cladeworks.operators import enrichment, timepoints
from cladeworks.sources import tables


def poisson_report(fit: PoissonFit) -> str:
    """The fit, and observed and expected cells for each number of lineages."""
    row = {k: v for k, v in asdict(fit).items() if not isinstance(v, list)}
    lines = [f"{v}\t{seen}\t{want:.2f}" for v, seen, want in zip(fit.values, fit.empirical, fit.expected, strict=True)]
    return tables.report("Lineages per cell", row) + "\n".join(["lineages\tobserved\texpected", *lines, ""])


def write_matching(spark: SparkSession, ranked: DataFrame, t1: DataFrame, p: TimepointParams, out: str) -> None:
    """Ranked and best matches, unmatched clones, the grid of the best, statistics, the histogram of similarities and the sizes of matched clones."""
    tables.write_tsv(ranked.orderBy("T1_clone_id", "match_rank"), f"{out}/ranked_matches.txt", header=True)
    best = timepoints.best_matches(ranked)
    tables.write_tsv(best.orderBy("T1_clone_id"), f"{out}/best_matches.txt", header=True)
    tables.write_tsv(timepoints.unmatched_clones(ranked, t1, p).orderBy("T1_clone_id"), f"{out}/unmatched_clones.txt", header=True)
    tables.write_tsv(timepoints.top_match_grid(ranked).orderBy("T1_clone_id"), f"{out}/top_matches.txt", header=True, single=True)
    tables.write_tsv(timepoints.similarity_histogram(best, 50).orderBy("bin"), f"{out}/similarity_histogram.txt", header=True, single=True)
    tables.write_tsv(timepoints.matched_sizes(best, p).orderBy("num_T0_barcodes", "num_T1_barcodes"), f"{out}/matched_sizes.txt", header=True)
    row = asdict(p) | timepoints.match_statistics(ranked, t1, p).first().asDict()
    tables.write_text(spark, tables.report("Matches of clones", row), f"{out}/matching_statistics.txt")


def top_lists(results: DataFrame, n: int = 10) -> str:
    """The strongest clones of both statuses as text."""
    parts = []
    for status in ("Enriched", "Depleted"):
        rows = enrichment.top_clones(results, status, n).collect()  # n rows
        lines = [f"{r.Clone_ID}\t{r.T0_size}\t{r.Control_size}\t{r.Treated_size}\t{r.Log2_FC_ratio:.4f}\t{r.q_value:.4g}" for r in rows]
        parts.append("\n".join([f"Top {status.lower()} clones", "clone\tT0\tcontrol\ttreated\tlog2 ratio\tq", *lines, ""]))
    return "\n".join(parts)


def write_enrichment(spark: SparkSession, results: DataFrame, p: EnrichmentParams, out: str) -> None:
    """All results and those of each status, the data of the plots, and a summary with the strongest clones."""
    order = ("q_value", "p_value", "Clone_ID")
    tables.write_tsv(results.orderBy(*order), f"{out}/differential_enrichment_results.txt", header=True)
    for status in ("Enriched", "Depleted", "Neutral"):
        tables.write_tsv(results.where(F.col("Status") == status).orderBy(*order), f"{out}/{status.lower()}_clones.txt", header=True)
    tables.write_tsv(enrichment.plot_points(results).orderBy("Clone_ID"), f"{out}/plot_points.txt", header=True)
    tables.write_tsv(enrichment.ratio_histogram(results).orderBy("bin"), f"{out}/ratio_histogram.txt", header=True, single=True)
    tables.write_tsv(enrichment.plot_points(enrichment.top_changed(results, 20)).orderBy("Status", "Clone_ID"), f"{out}/heatmap.txt", header=True, single=True)
    row = asdict(p) | enrichment.enrichment_summary(results).first().asDict()
    tables.write_text(spark, tables.report("Differential enrichment", row) + "\n" + top_lists(results), f"{out}/summary_statistics.txt")
