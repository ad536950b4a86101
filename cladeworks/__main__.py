"""Command line: ``python -m cladeworks COMMAND ...``; each command reads files and writes ordered tables and a report.

Paths may be in any store that Spark reads. Every output is a folder named like the file that it stands for.
"""

from __future__ import annotations

import argparse
import json
import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeworks import schemas
from cladeworks.config import BARCODE_LENGTH, CAPTURE_SEQUENCE, TECHNOLOGIES, CloneParams, DirectParams, EnrichmentParams, NoiseParams, TimepointParams
from cladeworks.operators import clones, direct, enrichment, noise, qc, timepoints
from cladeworks.plans import reports
from cladeworks.plans.pipeline import STEPS, Inputs, Pipeline, PipelineParams, retention_report, save
from cladeworks.runtime import materialize
from cladeworks.sources import tables


def _share(text: str) -> float:
    value = float(text)
    if not 0 <= value <= 1:
        raise argparse.ArgumentTypeError(f"{text} is not between 0 and 1")
    return value


def _whole(least: int) -> Callable[[str], int]:
    def parse(text: str) -> int:
        if (value := int(text)) < least:
            raise argparse.ArgumentTypeError(f"{text} is less than {least}")
        return value

    return parse


def _noise_options(p: argparse.ArgumentParser) -> None:
    p.add_argument("--top-n", type=_whole(1), default=1, help="lineages of a cell that make its expected count")
    p.add_argument("--z-threshold", type=float, default=2.0)
    p.add_argument("--min-group-size", type=_whole(1), default=5)


def _clone_options(p: argparse.ArgumentParser) -> None:
    p.add_argument("--clone-hamming", type=_whole(0), default=2, help="distance of barcodes that tie two cells")
    p.add_argument("--full", action="store_true", help="report near matches also where a pair has exact ones")
    p.add_argument("--force-hamming-all", action="store_true")
    p.add_argument("--max-lineage-count", type=_whole(1), default=None)


def _match_options(p: argparse.ArgumentParser) -> None:
    p.add_argument("--hamming-threshold", type=_whole(0), default=2)
    p.add_argument("--similarity-threshold", type=_share, default=0.8)
    p.add_argument("--top-n-matches", type=_whole(1), default=5)
    p.add_argument("--weight-by-umi", action="store_true")


def _enrichment_options(p: argparse.ArgumentParser) -> None:
    p.add_argument("--pseudocount", type=float, default=1.0)
    p.add_argument("--fdr-threshold", type=_share, default=0.05)
    p.add_argument("--log2fc-threshold", type=float, default=1.0)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="cladeworks", description=__doc__.splitlines()[0])
    commands = top.add_subparsers(dest="command", required=True)

    p = commands.add_parser("pipeline", help="reads to clones, and on to matches and enrichment")
    p.add_argument("--fastq1", required=True)
    p.add_argument("--fastq2", required=True)
    p.add_argument("--prefix", required=True, help="what read ids start with: instrument, run and flow cell")
    p.add_argument("--technology", choices=sorted(TECHNOLOGIES), required=True)
    p.add_argument("--whitelist", required=True)
    p.add_argument("--allowed", required=True, help="cells to keep, one or three columns")
    p.add_argument("--out", default="run")
    p.add_argument("--sample", default="sample", help="name of the condition")
    p.add_argument("--capture", default=CAPTURE_SEQUENCE)
    p.add_argument("--barcode-length", type=_whole(1), default=BARCODE_LENGTH)
    p.add_argument("--max-mismatches", type=_whole(0), default=0)
    p.add_argument("--min-reads", type=_whole(0), default=1)
    p.add_argument("--max-distance", type=_whole(1), default=3, help="Levenshtein distance of clustering")
    p.add_argument("--cluster-buckets", type=_whole(1), default=1, help="parts of the cells that clustering writes one by one")
    p.add_argument("--resume", action="store_true", help="keep the parts that an earlier run with the same options finished")
    p.add_argument("--t0-clones")
    p.add_argument("--t0-filtered")
    p.add_argument("--control-clones")
    p.add_argument("--control-filtered")
    p.add_argument("--t0-counts", help="corrected counts of the earlier timepoint, for direct matches")
    p.add_argument("--start", type=int, choices=range(1, len(STEPS) + 1), default=1)
    p.add_argument("--stop", type=int, choices=range(1, len(STEPS) + 1), default=10)
    for options in (_noise_options, _clone_options, _match_options, _enrichment_options):
        options(p)

    p = commands.add_parser("reads", help="records of a processed file as a share of the original's")
    for name in ("original", "processed", "out"):
        p.add_argument(f"--{name}", required=True)

    p = commands.add_parser("cells", help="molecules and genes by cell, cumulated")
    p.add_argument("--addresses", required=True, help="lines of cell barcode, UMI and gene")
    p.add_argument("--out", required=True)

    p = commands.add_parser("clones", help="corrected counts to clones, within one condition or across two")
    p.add_argument("--counts", required=True)
    p.add_argument("--other-counts", help="a second condition: clones then hold cells of both")
    p.add_argument("--source", default="T0")
    p.add_argument("--other-source", default="T1")
    p.add_argument("--all-pairs", action="store_true", help="also list pairs without a match; grows with the square of the cells")
    p.add_argument("--out", required=True)
    _noise_options(p)
    _clone_options(p)

    p = commands.add_parser("match-timepoints", help="clones of a later timepoint to clones of an earlier one")
    for side in ("t0", "t1"):
        p.add_argument(f"--{side}-clones", required=True)
        p.add_argument(f"--{side}-filtered")
    p.add_argument("--out", required=True)
    _match_options(p)

    p = commands.add_parser("direct", help="cells of later conditions to cells of an earlier one")
    p.add_argument("--t0", required=True, help="corrected counts")
    p.add_argument("--condition", action="append", required=True, metavar="NAME=PATH", help="corrected counts of a later condition; may be given more than once")
    p.add_argument("--out", required=True)
    p.add_argument("--hamming-threshold", type=_whole(0), default=2)
    p.add_argument("--jaccard-threshold", type=_share, default=0.6)
    p.add_argument("--min-matched-barcodes", type=_whole(1), default=2)
    p.add_argument("--top-n-matches", type=_whole(0), default=0, help="0 keeps all")
    p.add_argument("--use-umi-weighting", action="store_true")

    p = commands.add_parser("enrich", help="clones that one of two conditions has more of")
    for side in ("t0", "control", "treated"):
        p.add_argument(f"--{side}-clones", required=True)
        p.add_argument(f"--{side}-filtered")
    p.add_argument("--control-matches", help="best matches to T0; worked out if not given")
    p.add_argument("--treated-matches", help="best matches to T0; worked out if not given")
    p.add_argument("--hamming-threshold", type=_whole(0), default=2)
    p.add_argument("--out", required=True)
    _enrichment_options(p)
    return top


def _read(spark: SparkSession, read: Callable[[SparkSession, str], DataFrame], path: str | None) -> DataFrame | None:
    return read(spark, path) if path else None


def _clone_params(a: argparse.Namespace) -> CloneParams:
    return CloneParams(a.clone_hamming, not a.full, a.force_hamming_all, a.max_lineage_count)


def _noise_params(a: argparse.Namespace) -> NoiseParams:
    return NoiseParams(a.top_n, a.z_threshold, a.min_group_size)


def _match_params(a: argparse.Namespace) -> TimepointParams:
    return TimepointParams(a.hamming_threshold, a.similarity_threshold, a.top_n_matches, a.weight_by_umi)


def run_pipeline(spark: SparkSession, a: argparse.Namespace) -> None:
    filtered = lambda path: _read(spark, tables.read_counts, path)
    inputs = Inputs(
        tables.read_fastq(spark, a.fastq1), tables.read_fastq(spark, a.fastq2), tables.read_whitelist(spark, a.whitelist), tables.read_allow_list(spark, a.allowed),
        _read(spark, tables.read_clone_barcodes, a.t0_clones), filtered(a.t0_filtered), _read(spark, tables.read_clone_barcodes, a.control_clones), filtered(a.control_filtered), filtered(a.t0_counts),
    )
    params = PipelineParams(
        a.prefix, a.technology, a.max_mismatches, a.min_reads, a.max_distance, a.sample, _noise_params(a), _clone_params(a), _match_params(a),
        EnrichmentParams(a.pseudocount, a.fdr_threshold, a.log2fc_threshold), capture=a.capture, barcode_length=a.barcode_length, cluster_buckets=a.cluster_buckets,
    )
    run = Pipeline(spark, f"{a.out}/steps", inputs, params, a.resume)
    run.run(a.start, a.stop)
    save(run, a.out)
    if a.start <= 3 <= a.stop:
        tables.write_tsv(retention_report(run), f"{a.out}/retention.tsv", header=True, single=True)
    tables.write_text(spark, run.run_log(), f"{a.out}/run_log.json")


def _ordered(df: DataFrame, path: str, *order: str | Column) -> None:
    tables.write_tsv(df.orderBy(*order), path, header=True)


def run_clones(spark: SparkSession, a: argparse.Namespace) -> None:
    p = _clone_params(a)
    prepared = []
    for path, source in ((a.counts, a.source), (a.other_counts, a.other_source)):
        if path:
            kept = materialize(noise.filter_noise(tables.read_counts(spark, path), _noise_params(a)))
            _ordered(kept, f"{a.out}/{source}_filtered.tsv", "cell_barcode", "rank")
            tables.write_text(spark, reports.poisson_report(noise.poisson_quality(kept)), f"{a.out}/{source}_poisson.txt")
            prepared.append(materialize(clones.prepare_cells(kept, source, p.max_lineage_count)))
    one, two = prepared[0], prepared[1] if len(prepared) > 1 else None
    groups = materialize(clones.clone_groups(one, two, p))
    pairs = materialize((clones.all_pairs if a.all_pairs else clones.clone_pairs)(one, two, p))
    every = one if two is None else one.unionByName(two)
    _ordered(clones.clone_counts(groups, clones.clone_barcodes(every, groups)), f"{a.out}/cloneID_cloneBarcode.tsv", "cloneID")
    _ordered(clones.clone_cells(groups), f"{a.out}/cloneID_cellBarcode.tsv", "cloneID", "cell_barcode")
    _ordered(pairs, f"{a.out}/clone_pairs.tsv", *clones.PAIR)
    _ordered(clones.graph_edges(pairs), f"{a.out}/clone_graph_edges.tsv", "node1", "node2")
    _ordered(clones.graph_nodes(groups), f"{a.out}/clone_graph_nodes.tsv", "source_condition", "cell_barcode")
    tables.write_graph(clones.graph_nodes(groups), clones.graph_edges(pairs), f"{a.out}/clone_graph.json")
    hubs = clones.hub_cells(groups)
    _ordered(hubs, f"{a.out}/hub_cells.tsv", F.desc("degree"), "cell_barcode")
    row = clones.graph_statistics(groups).first().asDict() | {"hubs": hubs.count()}
    tables.write_text(spark, tables.report("Clones", row), f"{a.out}/clone_statistics.txt")


def run_match(spark: SparkSession, a: argparse.Namespace) -> None:
    p = _match_params(a)
    t0, t1 = (timepoints.explode_clones(tables.read_clone_barcodes(spark, path)) for path in (a.t0_clones, a.t1_clones))
    weights = [None if path is None else timepoints.umi_weights(tables.read_counts(spark, path)) for path in (a.t0_filtered, a.t1_filtered)] if p.weight_by_umi else [None, None]
    ranked = materialize(timepoints.match_clones(t0, t1, p, *weights))
    reports.write_matching(spark, ranked, t1, p, a.out)


def run_direct(spark: SparkSession, a: argparse.Namespace) -> None:
    p = DirectParams(a.hamming_threshold, a.jaccard_threshold, a.min_matched_barcodes, a.top_n_matches, a.use_umi_weighting)
    t0 = tables.read_counts(spark, a.t0)
    for item in a.condition:
        name, found, path = item.partition("=")
        if not found:
            raise SystemExit(f"--condition {item}: NAME=PATH is expected")
        matches = materialize(direct.match_cells(t0, tables.read_counts(spark, path), p))
        tables.write_matches(matches, f"{a.out}/T0_to_{name}_direct_matches.csv")
        tables.write_text(spark, tables.report(f"Direct matches of {name}", direct.match_summary(matches).first().asDict()), f"{a.out}/T0_to_{name}_summary.txt")


def run_enrich(spark: SparkSession, a: argparse.Namespace) -> None:
    sets = {s: materialize(timepoints.explode_clones(tables.read_clone_barcodes(spark, getattr(a, f"{s}_clones")))) for s in ("t0", "control", "treated")}
    weights = {s: None if getattr(a, f"{s}_filtered") is None else timepoints.umi_weights(tables.read_counts(spark, getattr(a, f"{s}_filtered"))) for s in sets}
    sizes = {s: enrichment.clone_sizes(sets[s], weights[s]) for s in sets}
    for s in ("control", "treated"):
        given = getattr(a, f"{s}_matches")
        best = tables.read_clone_map(spark, given) if given else timepoints.best_matches(timepoints.match_clones(sets["t0"], sets[s], TimepointParams(a.hamming_threshold)))
        sizes[s] = enrichment.sizes_by_t0(best, sizes[s])
    p = EnrichmentParams(a.pseudocount, a.fdr_threshold, a.log2fc_threshold)
    reports.write_enrichment(spark, materialize(enrichment.run_enrichment(sizes["t0"], sizes["control"], sizes["treated"], p)), p, a.out)


def run_reads(spark: SparkSession, a: argparse.Namespace) -> None:
    """How many records of a file a later file still has."""
    original, processed = (qc.record_count(spark, path) for path in (a.original, a.processed))
    percent = processed / original * 100 if original else 0.0
    tables.write_text(spark, tables.report("Reads", {"original": original, "processed": processed, "percent": percent}), f"{a.out}/reads.txt")


def run_cells(spark: SparkSession, a: argparse.Namespace) -> None:
    """Cells by falling molecules with cumulative share and running means, from lines of barcode, UMI and gene."""
    cells = qc.molecules_per_cell(tables.read_words(spark, a.addresses, schemas.GENE_ADDRESS, exact=False), "barcode")
    rows = materialize(qc.cumulative_histogram(cells))
    order = (F.desc("molecules"), "barcode")
    _ordered(rows.select("barcode", "molecules", F.format_string("%f", "cum_fraction").alias("cum_fraction")), f"{a.out}/cumulative_histogram.tsv", *order)
    _ordered(rows, f"{a.out}/cell_curves.tsv", *order)


COMMANDS = {"reads": run_reads, "cells": run_cells, "pipeline": run_pipeline, "clones": run_clones, "match-timepoints": run_match, "direct": run_direct, "enrich": run_enrich}


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"cladeworks {a.command}").config("spark.sql.adaptive.enabled", "true").getOrCreate()
    began = time.time()
    COMMANDS[a.command](spark, a)
    log = {"command": a.command, "arguments": {k: v for k, v in vars(a).items() if k != "command"}, "duration_seconds": round(time.time() - began, 3)}
    tables.write_text(spark, json.dumps(log), f"{a.out}/command.json")


if __name__ == "__main__":
    main()
