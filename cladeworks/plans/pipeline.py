"""The steps as one resumable plan.

Steps are functions from DataFrames to a DataFrame. What is expensive or final is written as Parquet under
the run's folder, and a run that starts later reads it from there; everything else stays lazy.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cladeworks.config import BARCODE_LENGTH, CAPTURE_SEQUENCE, CloneParams, DirectParams, EnrichmentParams, NoiseParams, TimepointParams
from cladeworks.operators import clones, cluster, direct, enrichment, molecules, noise, timepoints
from cladeworks.plans import reports
from cladeworks.runtime import materialize
from cladeworks.sources import tables


@dataclass(frozen=True)
class PipelineParams:
    prefix: str = ""
    technology: str = "10xv3"
    max_mismatches: int = 0
    min_reads: int = 1
    max_distance: int = 3
    source: str = "T1"
    noise: NoiseParams = field(default_factory=NoiseParams)
    clones: CloneParams = field(default_factory=CloneParams)
    timepoints: TimepointParams = field(default_factory=TimepointParams)
    enrichment: EnrichmentParams = field(default_factory=EnrichmentParams)
    direct: DirectParams = field(default_factory=DirectParams)
    capture: str = CAPTURE_SEQUENCE
    barcode_length: int = BARCODE_LENGTH
    #: Parts of the cells that the clustering step writes one by one, so that a run can resume inside it.
    cluster_buckets: int = 1


@dataclass
class Inputs:
    """Tables that a run starts from; the last ones only matter for steps 11 to 14."""

    read1: DataFrame | None = None
    read2: DataFrame | None = None
    whitelist: DataFrame | None = None
    allowed: DataFrame | None = None
    t0_clones: DataFrame | None = None
    t0_filtered: DataFrame | None = None
    control_clones: DataFrame | None = None
    control_filtered: DataFrame | None = None
    t0_counts: DataFrame | None = None


STEPS = ["addresses", "filtered_addresses", "molecules", "collapsed", "recounted", "translated", "umi_counts", "corrections", "corrected", "clones", "matches", "enrichment", "direct_matches", "cross_clones"]
#: Steps whose rows are counted while a later step is written.
OBSERVED = {"filtered_addresses", "molecules", "collapsed", "translated"}
#: Steps whose result is written and can be resumed from.
WRITTEN = {"addresses", "umi_counts", "corrections", "corrected", "clones", "matches", "enrichment", "direct_matches", "cross_clones"}


class Pipeline:
    """Runs steps ``start`` to ``stop`` (1 to 14) under ``folder``; results are in ``tables``, what was counted on the way in ``metrics``.

    With ``resume`` the clustering step keeps the buckets of cells that an earlier run with the same parameters finished.
    """

    def __init__(self, spark: SparkSession, folder: str, inputs: Inputs, params: PipelineParams = PipelineParams(), resume: bool = False):
        self.spark, self.folder, self.inputs, self.params, self.resume = spark, folder, inputs, params, resume
        self.tables: dict[str, DataFrame] = {}
        self.metrics: dict[str, dict[str, int]] = {}
        self.log: list[dict] = []
        self._watched: dict[str, Observation] = {}

    def _steps(self) -> dict[str, Callable[[], DataFrame]]:
        i, p, t = self.inputs, self.params, self.table
        return {
            "addresses": lambda: molecules.extract_addresses(i.read1, i.read2, p.prefix, p.capture, p.barcode_length, self._watch("addresses")),
            "filtered_addresses": lambda: molecules.filter_mismatches(t("addresses"), p.max_mismatches),
            "molecules": lambda: molecules.count_addresses(t("filtered_addresses")),
            "collapsed": lambda: molecules.collapse_barcodes(t("molecules"), p.technology),
            "recounted": lambda: molecules.recount(t("collapsed")),
            "translated": lambda: molecules.translate_cells(t("recounted"), i.whitelist, i.allowed, p.min_reads, "line" if "line" in i.whitelist.columns else None),
            "umi_counts": lambda: molecules.umi_counts(t("translated")),
            "corrections": self._corrections,
            "corrected": lambda: molecules.correct_counts(t("umi_counts"), t("corrections")),
            "clones": self._clones,
            "matches": self._matches,
            "enrichment": self._enrichment,
            "direct_matches": lambda: direct.match_cells(i.t0_counts, t("corrected"), p.direct),
            "cross_clones": self._cross_clones,
        }

    def table(self, name: str) -> DataFrame:
        """A step's result: of this run, else as an earlier run wrote it, else planned now."""
        if name not in self.tables:
            if name == "corrections":
                self.tables[name] = self._read_corrections()
            elif name in WRITTEN:
                self.tables[name] = self.spark.read.parquet(f"{self.folder}/{name}")
            else:
                self.tables[name] = self._steps()[name]()
        return self.tables[name]

    def _watch(self, name: str) -> Observation:
        self._watched[name] = Observation()
        return self._watched[name]

    def _marks(self) -> set[int]:
        """Buckets of the clustering step that were finished with the present parameters."""
        try:
            return {int(r[0]) for r in self.spark.read.text(f"{self.folder}/corrections_done/*").select(F.split("value", " ")).collect() for r in r if r[1] == self._cluster_key()}
        except AnalysisException:  # no bucket is done
            return set()

    def _cluster_key(self) -> str:
        return f"{self.params.max_distance}/{self.params.cluster_buckets}"

    def _corrections(self) -> DataFrame:
        """Clusters bucket by bucket of cells. A bucket is marked when it is written; a run that resumes leaves marked ones as they are."""
        n, counts = self.params.cluster_buckets, self.table("umi_counts")
        done = self._marks() if self.resume else set()
        for k in range(n):
            if k not in done:
                part = counts.where(F.pmod(F.xxhash64("cellbc"), F.lit(n)) == k)
                tables.write_text(self.spark, f"{k} unfinished", f"{self.folder}/corrections_done/{k}")
                cluster.cluster_lineages(part, self.params.max_distance).write.mode("overwrite").parquet(f"{self.folder}/corrections/{k}")
                tables.write_text(self.spark, f"{k} {self._cluster_key()}", f"{self.folder}/corrections_done/{k}")
        return self._read_corrections()

    def _read_corrections(self) -> DataFrame:
        if missing := set(range(self.params.cluster_buckets)) - self._marks():
            raise ValueError(f"{len(missing)} of {self.params.cluster_buckets} buckets of corrections are not finished with these parameters")
        return self.spark.read.parquet(*[f"{self.folder}/corrections/{k}" for k in range(self.params.cluster_buckets)])

    def _filtered(self) -> DataFrame:
        return noise.filter_noise(self.table("corrected"), self.params.noise)

    def _clones(self) -> DataFrame:
        filtered = self._filtered()
        prepared = clones.prepare_cells(filtered, self.params.source, self.params.clones.max_lineage_count)
        groups = clones.clone_groups(prepared, p=self.params.clones, degrees=False).drop("degree")
        return groups.join(clones.clone_barcodes(prepared, groups), "cloneID", "left")

    def _cross_clones(self) -> DataFrame:
        """Clones of cells of this run and of the earlier timepoint together."""
        p = self.params
        old = clones.prepare_cells(noise.filter_noise(self.inputs.t0_counts, p.noise), "T0", p.clones.max_lineage_count)
        return clones.clone_groups(old, clones.prepare_cells(self._filtered(), p.source, p.clones.max_lineage_count), p.clones)

    def _own(self) -> DataFrame:
        return timepoints.explode_clones(self.table("clones").select("cloneID", "clone_barcode").distinct())

    def _matches(self) -> DataFrame:
        p, t0 = self.params.timepoints, timepoints.explode_clones(self.inputs.t0_clones)
        weights = (timepoints.umi_weights(self.inputs.t0_filtered), timepoints.umi_weights(self._filtered())) if p.weight_by_umi and self.inputs.t0_filtered is not None else (None, None)
        return timepoints.match_clones(t0, self._own(), p, *weights)

    def _enrichment(self) -> DataFrame:
        i = self.inputs
        t0, control = timepoints.explode_clones(i.t0_clones), timepoints.explode_clones(i.control_clones)
        weigh = lambda f: None if f is None else timepoints.umi_weights(f)
        against = timepoints.best_matches(timepoints.match_clones(t0, control, self.params.timepoints))
        treated = enrichment.sizes_by_t0(timepoints.best_matches(self.table("matches")), enrichment.clone_sizes(self._own(), weigh(self._filtered()) if i.t0_filtered is not None else None))
        return enrichment.run_enrichment(enrichment.clone_sizes(t0, weigh(i.t0_filtered)), enrichment.sizes_by_t0(against, enrichment.clone_sizes(control, weigh(i.control_filtered))), treated, self.params.enrichment)

    def _missing(self, steps: list[str]) -> list[str]:
        """Inputs that the steps need and the run has not."""
        needs = {"addresses": ["read1", "read2"], "translated": ["whitelist", "allowed"], "matches": ["t0_clones"], "enrichment": ["t0_clones", "control_clones"], "direct_matches": ["t0_counts"], "cross_clones": ["t0_counts"]}
        return sorted({n for s in steps for n in needs.get(s, []) if getattr(self.inputs, n) is None})

    def run(self, start: int = 1, stop: int = 10) -> dict[str, DataFrame]:
        if not 1 <= start <= stop <= len(STEPS):
            raise ValueError(f"steps run from 1 to {len(STEPS)}")
        if missing := self._missing(STEPS[start - 1 : stop]):
            raise ValueError(f"missing inputs: {', '.join(missing)}")
        for name in STEPS[start - 1 : stop]:
            began = time.time()
            df = self._steps()[name]()
            if name in OBSERVED:
                df = df.observe(self._watch(name), F.count("*").alias("rows"))
            if name in WRITTEN:
                if name != "corrections":
                    df.write.mode("overwrite").parquet(f"{self.folder}/{name}")
                    df = self.spark.read.parquet(f"{self.folder}/{name}")
                # What was planned since the last written step ran with this one.
                self.metrics |= {step: watched.get for step, watched in self._watched.items()}
                self._watched = {}
            self.tables[name] = df
            self.log.append({"step": name, "written": name in WRITTEN, "seconds": round(time.time() - began, 3)})
        return self.tables

    def run_log(self) -> str:
        steps = [s | ({"counts": self.metrics[s["step"]]} if s["step"] in self.metrics else {}) for s in self.log]
        return json.dumps({"parameters": asdict(self.params), "steps": steps, "duration_seconds": round(sum(s["seconds"] for s in self.log), 3)}, indent=2)


def retention_report(pipeline: Pipeline) -> DataFrame:
    """Rows left after each of the first three steps, as a share of the addresses; what the run has counted is not counted again."""
    from cladeworks.operators.qc import retention

    counted = {s: m["emitted" if s == "addresses" else "rows"] for s, m in pipeline.metrics.items()}
    counts = [(s, counted[s] if s in counted else pipeline.table(s).count()) for s in STEPS[:3]]
    df = pipeline.spark.createDataFrame([(s, n, counts[0][1]) for s, n in counts], "step string, rows long, original long")
    return df.withColumn("percent", retention(F.col("original"), F.col("rows")))


#: The order of the final tables; a minus sign is for falling values.
ORDERS = {
    "umi_counts": ["-unique_umi_count", "cellbc", "lineage_barcode"], "corrections": ["cell_barcode", "canonical_sequence", "sequence_in_cluster"],
    "corrected": ["-umi_count", "cell_barcode", "corrected_lineage_barcode"], "cross_clones": ["cloneID", "source_condition", "cell_barcode"],
}


def save(pipeline: Pipeline, folder: str) -> None:
    """Tab-separated finals of a run, in order, with the reports of matching and enrichment."""
    got, p = pipeline.tables, pipeline.params
    for name, order in ORDERS.items():
        if name in got:
            columns = [F.desc(c[1:]) if c.startswith("-") else F.col(c) for c in order]
            tables.write_tsv(got[name].orderBy(*columns), f"{folder}/{name}.tsv", header=True)
    if "clones" in got:
        rows = got["clones"]
        tables.write_tsv(rows.groupBy("cloneID", "clone_barcode").agg(F.count("*").alias("count")).orderBy("cloneID"), f"{folder}/cloneID_cloneBarcode.tsv", header=True)
        kept = materialize(pipeline._filtered())
        tables.write_tsv(kept.orderBy("cell_barcode", "rank"), f"{folder}/filtered.tsv", header=True)
        tables.write_text(pipeline.spark, reports.poisson_report(noise.poisson_quality(kept)), f"{folder}/poisson.txt")
        tables.write_tsv(clones.clone_cells(rows).orderBy("cloneID", "cell_barcode"), f"{folder}/cloneID_cellBarcode.tsv", header=True)
    if "matches" in got:
        reports.write_matching(pipeline.spark, got["matches"], pipeline._own(), p.timepoints, folder)
    if "enrichment" in got:
        reports.write_enrichment(pipeline.spark, got["enrichment"], p.enrichment, folder)
    if "direct_matches" in got:
        tables.write_matches(got["direct_matches"], f"{folder}/direct_matches.csv")
