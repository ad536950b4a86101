"""From reads to counted, repaired, translated and corrected molecules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from cladeworks.config import BARCODE_LENGTH, CAPTURE_SEQUENCE, CELL_BASES, TECHNOLOGIES, UMI_BASES
from cladeworks.functions.sequences import wsn_mismatches
from cladeworks.runtime import materialize, sized


def pair_reads(read1: DataFrame, read2: DataFrame, prefix: str, capture: str = CAPTURE_SEQUENCE, length: int = BARCODE_LENGTH) -> DataFrame:
    """All candidate addresses with ``found`` and ``paired`` flags.

    Inputs are ``(ord, id, seq)``; reads are paired by ordinal, and ids (after ``prefix``) must agree.
    The lineage barcode is the ``length`` bases before the first capture sequence.
    """
    strip = lambda c: F.split_part(F.split_part(c, F.lit(" "), F.lit(1)), F.lit(prefix), F.lit(2))
    one = read1.select("ord", strip(F.col("id")).alias("id1"), F.substring("seq", 1, CELL_BASES).alias("cell_barcode"), F.substring("seq", CELL_BASES + 1, UMI_BASES).alias("umi"))
    at = F.instr(F.col("seq"), capture)
    two = read2.select("ord", strip(F.col("id")).alias("id2"), (at > 0).alias("found"), F.when(at > length, F.substring(F.col("seq"), at - length, F.lit(length))).alias("lineage_barcode"))
    # Both mates go through one exchange; of each ordinal there is one of either.
    columns = ["id1", "cell_barcode", "umi", "id2", "found", "lineage_barcode"]
    # They are dealt before they are grouped: on the reading side there is nothing to put together, so nothing is sorted there.
    both = one.unionByName(two, allowMissingColumns=True).repartition("ord").groupBy("ord").agg(*[F.max(c).alias(c) for c in columns]).where("found is not null")
    return both.withColumn("paired", F.col("id1") == F.col("id2")).withColumn("mismatches", wsn_mismatches(F.col("lineage_barcode")))


def extract_addresses(read1: DataFrame, read2: DataFrame, prefix: str, capture: str = CAPTURE_SEQUENCE, length: int = BARCODE_LENGTH, observation: Observation | None = None) -> DataFrame:
    """Addresses of reads whose mates agree and that hold a barcode; ``observation`` gets the counters of the extraction when they are computed."""
    pairs = pair_reads(read1, read2, prefix, capture, length)
    if observation is not None:
        pairs = pairs.observe(observation, *_counters())
    kept = pairs.where("lineage_barcode is not null and paired")
    return kept.select(F.col("id2").alias("readid"), "cell_barcode", "umi", "lineage_barcode", "mismatches")


def extraction_counters(read1: DataFrame, read2: DataFrame, prefix: str, capture: str = CAPTURE_SEQUENCE, length: int = BARCODE_LENGTH) -> DataFrame:
    return pair_reads(read1, read2, prefix, capture, length).agg(*_counters())


def _counters() -> list[Column]:
    whole = F.col("lineage_barcode").isNotNull()
    return [
        F.count("*").alias("reads"), F.count_if("found").alias("with_capture"), F.count_if(whole).alias("with_barcode"),
        F.count_if(whole & F.col("paired")).alias("emitted"), F.count_if(whole & (F.col("mismatches") > 0)).alias("with_mismatches"), F.count_if(whole & ~F.coalesce("paired", F.lit(False))).alias("unpaired"),
    ]


def filter_mismatches(addresses: DataFrame, most: int) -> DataFrame:
    return addresses.where(F.col("mismatches") <= most)


def count_addresses(addresses: DataFrame) -> DataFrame:
    """Reads per cell, UMI and lineage."""
    return addresses.groupBy("cell_barcode", "umi", "lineage_barcode").agg(F.count("*").alias("read_count"))


def recount(molecules: DataFrame) -> DataFrame:
    """Sums of reads after cell or UMI sequences were rewritten."""
    return molecules.groupBy("cell_barcode", "umi", "lineage_barcode").agg(F.sum("read_count").alias("read_count"))


def altered_barcodes(molecules: DataFrame, technology: str, least: int = 20, share: float = 0.9) -> DataFrame:
    """``(bc_old, bc_new)`` of cell barcodes that lack a base.

    A barcode whose UMIs nearly all end in T is one base short. One such with at least ``least`` address
    rows triggers its family, the four barcodes that differ in the last base, and every member of the
    family with the share goes, however few rows it has.
    """
    umi_at, cell_at, _ = TECHNOLOGIES[technology]
    usable = _usable(molecules)
    ends = F.substring("umi", umi_at + 1, 1) == "T"
    cells = usable.groupBy("cell_barcode").agg(F.count("*").alias("n"), F.count_if(ends).alias("t"))
    cells = cells.withColumn("high", F.col("t") / F.col("n") > share).withColumn("family", F.substring("cell_barcode", 1, cell_at))
    last = F.substring("cell_barcode", cell_at + 1, 1)
    member = (F.length("cell_barcode") == cell_at + 1) & last.isin("A", "C", "G", "T")
    cells = cells.withColumn("triggered", F.max(F.col("high") & (F.col("n") >= least)).over(Window.partitionBy("family")))
    return cells.where(member & F.col("high") & F.col("triggered")).select(F.col("cell_barcode").alias("bc_old"), F.col("family").alias("bc_new"))


def _usable(molecules: DataFrame) -> DataFrame:
    return molecules.where(~F.contains("cell_barcode", F.lit("N")) & ~F.contains("cell_barcode", F.lit("GGGGG")))


def collapse_barcodes(molecules: DataFrame, technology: str) -> DataFrame:
    """Molecules with repaired barcodes: the cell barcode's last base becomes the UMI's first. Rows are not summed yet."""
    umi_at, cell_at, cell_length = TECHNOLOGIES[technology]
    altered = altered_barcodes(molecules, technology).select(F.col("bc_old").alias("cell_barcode"), F.lit(True).alias("altered"))
    rows = _usable(molecules).join(sized(materialize(altered)), "cell_barcode", "left")
    rewrite = F.col("altered").isNotNull() | (F.length("cell_barcode") != cell_length)
    return rows.select(
        F.when(rewrite, F.substring("cell_barcode", 1, cell_at)).otherwise(F.col("cell_barcode")).alias("cell_barcode"),
        F.when(rewrite, F.concat(F.substring("cell_barcode", cell_at + 1, 1), F.substring("umi", 1, umi_at))).otherwise(F.col("umi")).alias("umi"),
        "lineage_barcode", "read_count",
    )


def translate_cells(molecules: DataFrame, whitelist: DataFrame, allowed: DataFrame, min_reads: int, order: str | None = None) -> DataFrame:
    """Molecules with more than ``min_reads`` reads whose cell is in the whitelist and allowed, under its translated name.

    Of a feature barcode that is listed twice the last line counts, by ``order`` if given.
    """
    gex = F.max_by("cell_barcode_gex", order) if order else F.max("cell_barcode_gex")
    names = whitelist.groupBy("cell_barcode_feature").agg(gex.alias("gex")).withColumnRenamed("cell_barcode_feature", "cell_barcode")
    kept = molecules.where(F.col("read_count") > min_reads).join(sized(materialize(names)), "cell_barcode").where("gex is not null")
    allow = allowed.select(F.col("cell_barcode_gex").alias("gex")).distinct()
    return kept.join(sized(materialize(allow)), "gex", "left_semi").select(F.col("gex").alias("cell_barcode"), "umi", "lineage_barcode", "read_count")


def umi_counts(molecules: DataFrame) -> DataFrame:
    """Distinct UMIs per cell and lineage, with the cell's totals. A UMI under two lineages counts in both."""
    # Two aggregates by growing keys; the window over a cell's lineages reuses the partitioning by cell.
    each = molecules.groupBy("cell_barcode", "lineage_barcode").agg(F.countDistinct("umi").alias("unique_umi_count"))
    cell = Window.partitionBy("cell_barcode")
    return each.select(
        F.col("cell_barcode").alias("cellbc"), "lineage_barcode", "unique_umi_count",
        F.sum("unique_umi_count").over(cell).alias("total_unique_umis"), F.count("*").over(cell).alias("total_unique_lineage_barcodes"),
    )


def correct_counts(counts: DataFrame, corrections: DataFrame) -> DataFrame:
    """UMIs summed under corrected lineages; a lineage without a correction is its own. Keys are (cell, sequence)."""
    fixes = corrections.groupBy("cell_barcode", "sequence_in_cluster").agg(F.max("canonical_sequence").alias("canonical"))
    fixes = fixes.toDF("cellbc", "lineage_barcode", "canonical")
    joined = counts.join(fixes, ["cellbc", "lineage_barcode"], "left")
    summed = joined.groupBy(F.col("cellbc").alias("cell_barcode"), F.coalesce("canonical", "lineage_barcode").alias("corrected_lineage_barcode")).agg(F.sum("unique_umi_count").alias("umi_count"))
    return with_totals(summed)


def with_totals(summed: DataFrame) -> DataFrame:
    cell = Window.partitionBy("cell_barcode")
    return summed.withColumns({"total_molecules_per_cell": F.sum("umi_count").over(cell), "total_lineages_per_cell": F.count("*").over(cell)})


def lost_cells(before: DataFrame, after: DataFrame) -> DataFrame:
    """Cells of ``before`` (``cellbc``) that ``after`` (``cell_barcode``) lacks."""
    return before.select(F.col("cellbc").alias("cell_barcode")).distinct().join(after.select("cell_barcode").distinct(), "cell_barcode", "left_anti")


def single_lineage_fraction(corrected: DataFrame) -> DataFrame:
    """The share of rows, not cells, whose cell has one lineage."""
    return corrected.agg(F.avg((F.col("total_lineages_per_cell") == 1).cast("double")).alias("single_lineage_fraction"))
