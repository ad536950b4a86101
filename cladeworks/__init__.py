"""cladeworks: a Spark-first engine for lineage-barcode analytics."""

__version__ = "0.1.0"
