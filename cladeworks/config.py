"""Parameters with their defaults."""

from __future__ import annotations

from dataclasses import dataclass

#: For each technology, the place of the UMI's last base, of the cell barcode's last base, and the cell barcode's length.
TECHNOLOGIES = {
    "DropSeqv1": (7, 11, 12),
    "10xv2": (9, 15, 16),
    "CiteSeq5v2": (9, 15, 16),
    "DropSeqv2": (8, 11, 12),
    "PearSeq": (8, 11, 12),
    "10xv3": (11, 15, 16),
    "CiteSeq3v3": (11, 15, 16),
    "CiteSeqTSB": (11, 15, 16),
}
#: Fixed values of the read layout.
CAPTURE_SEQUENCE = "GCTCACCTATTAGCGGCTAAGG"
BARCODE_LENGTH = 84
CELL_BASES, UMI_BASES = 16, 12


@dataclass(frozen=True)
class NoiseParams:
    top_n: int = 1
    z_threshold: float = 2.0
    min_group_size: int = 5
    target_sum: float = 1e4


@dataclass(frozen=True)
class CloneParams:
    hamming_threshold: int = 2
    quick_mode: bool = True
    force_hamming_all: bool = False
    max_lineage_count: int | None = None


@dataclass(frozen=True)
class TimepointParams:
    hamming_threshold: int = 2
    similarity_threshold: float = 0.8
    top_n: int = 5
    weight_by_umi: bool = False


@dataclass(frozen=True)
class DirectParams:
    hamming_threshold: int = 2
    jaccard_threshold: float = 0.6
    min_matched_barcodes: int = 2
    top_n: int = 0
    use_umi_weighting: bool = False

    def __post_init__(self):
        if self.hamming_threshold < 0 or self.min_matched_barcodes < 1 or self.top_n < 0 or not 0 <= self.jaccard_threshold <= 1:
            raise ValueError(f"parameters out of range: {self}")


@dataclass(frozen=True)
class EnrichmentParams:
    pseudocount: float = 1.0
    fdr_threshold: float = 0.05
    log2fc_threshold: float = 1.0
