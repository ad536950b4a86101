"""Column types of every hand-off between stages. Barcodes are strings whatever they look like."""

from __future__ import annotations

from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

_KINDS = {"string": StringType(), "int": IntegerType(), "long": LongType(), "double": DoubleType()}


def _schema(ddl: str) -> StructType:
    """Without a session, which ``StructType.fromDDL`` needs."""
    return StructType([StructField(name, _KINDS[kind]) for name, kind in (x.split() for x in ddl.split(","))])


ADDRESS = _schema("readid string, cell_barcode string, umi string, lineage_barcode string, mismatches int")
MOLECULE = _schema("cell_barcode string, umi string, lineage_barcode string, read_count long")
ALTERED = _schema("bc_old string, bc_new string")
WHITELIST = _schema("cell_barcode_gex string, cell_barcode_feature string")
ALLOW_LIST = _schema("cell_barcode_gex string, molecules_count long, genes_count long")
UMI_COUNTS = _schema("cellbc string, lineage_barcode string, unique_umi_count long, total_unique_umis long, total_unique_lineage_barcodes long")
CORRECTIONS = _schema("cell_barcode string, canonical_sequence string, sequence_in_cluster string")
CORRECTED = _schema("cell_barcode string, corrected_lineage_barcode string, umi_count long, total_molecules_per_cell long, total_lineages_per_cell long")
CLONE_BARCODES = _schema("cloneID long, clone_barcode string")
CLONE_CELLS = _schema("cloneID long, cell_barcode string")
BEST_MATCHES = _schema("T1_clone_id long, T0_clone_id long, similarity_score double, num_matched_barcodes long, num_T1_barcodes long, num_T0_barcodes long")
GENE_ADDRESS = _schema("barcode string, umi string, gene string")
