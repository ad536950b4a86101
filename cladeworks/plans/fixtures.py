"""Barcode-shaped inputs from the driver's tables, as SQL that Spark and DuckDB both run.

A supplier is a cell, a line item a read: its cell barcode, UMI and lineage barcode are base-4 numbers.
Suppliers of one class draw from the same lineages. Some reads carry an error at a free base, which makes
sequences one substitution apart, and some an error at a fixed base, which is a mismatch of the pattern.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeworks.config import CAPTURE_SEQUENCE
from cladeworks.runtime import ensure_checkpoint_dir, read_table
from cladeworks.sources import tables

CLASSES = 40


def _spread(e: str) -> str:
    return f"((({e}) * 2654435761) % 4294967296)"


#: The code of each group of four bits: two bases, or a triplet of the pattern.
_TWO_BASES = "".join("ACGT"[n & 3] + "ACGT"[n >> 2] for n in range(16))
_TRIPLETS = "".join("AT"[n & 1] + "GC"[n >> 1 & 1] + "ACGT"[n >> 2] for n in range(16))


def _coded(e: str, groups: int, table: str) -> str:
    """``groups`` times four bits of ``e``, each as its entry of ``table``."""
    size = len(table) // 16
    return "concat(" + ", ".join(f"substr('{table}', cast((({e}) >> {4 * i}) & 15 as int) * {size} + 1, {size})" for i in range(groups)) + ")"


def _base4(e: str, n: int) -> str:
    return _coded(e, n // 2, _TWO_BASES)


def _wsn(e: str, triplets: int = 8) -> str:
    return _coded(e, triplets, _TRIPLETS)


_SEED = f"(l_suppkey % {CLASSES}) * 100 + l_partkey % (7 + l_suppkey % 13) + 1"
_FREE = "(3 * (l_orderkey % 8) + 3)"

READS = f"""
SELECT CAST(l_orderkey * 8 + l_linenumber AS STRING) AS readid, {_base4(_spread("l_suppkey"), 16)} AS cell_barcode, {_base4("l_orderkey * 8 + l_linenumber", 12)} AS umi,
  CASE WHEN l_linenumber = 1 AND l_orderkey % 5 = 0 THEN concat(substr(s, 1, cast({_FREE} - 1 as int)), translate(substr(s, cast({_FREE} as int), 1), 'ACGT', 'CGTA'), substr(s, cast({_FREE} + 1 as int)))
       WHEN l_linenumber = 2 AND l_orderkey % 7 = 0 THEN concat('G', substr(s, 2)) ELSE s END AS lineage_barcode, l_returnflag AS condition
FROM (SELECT l_orderkey, l_linenumber, l_suppkey, l_returnflag, {_wsn(_spread(_SEED))} AS s FROM lineitem_source) x
"""

WHITELIST = f"SELECT {_base4(_spread('s_suppkey + 100000'), 16)} AS cell_barcode_gex, {_base4(_spread('s_suppkey'), 16)} AS cell_barcode_feature FROM supplier_source WHERE s_suppkey % 10 <> 0"
ALLOWED = f"SELECT {_base4(_spread('s_suppkey + 100000'), 16)} AS cell_barcode_gex FROM supplier_source WHERE s_acctbal > 0"
#: Ends of UMIs that make two of a family's barcodes short ones.
SHORT = """
SELECT CASE WHEN k < 3 THEN concat('ACGTACGTACGTACG', substr('ACG', k + 1, 1)) ELSE cell_barcode END AS cell_barcode,
  CASE WHEN k < 2 THEN concat(substr(umi, 1, 11), 'T') ELSE umi END AS umi, lineage_barcode, read_count
FROM (SELECT *, cast(length(umi) + ascii(substr(umi, 1, 1)) + ascii(substr(umi, 2, 1)) * 3 + ascii(substr(umi, 3, 1)) * 7 AS int) % 16 AS k FROM molecules) y
"""


#: Reads as the two mates of a run: a barcode of 84 bases before the capture sequence; some lack it, some start too late, some ids differ.
PREFIX = "I:R:F:"
LONG_BARCODE = "concat(lineage_barcode, lineage_barcode, lineage_barcode, substr(lineage_barcode, 1, 12))"
_NO = "CAST(readid AS BIGINT)"
MATES = f"""
SELECT {_NO} AS number, concat('{PREFIX}', readid, ' 1:N:0') AS id1, concat(cell_barcode, umi, 'TTTT') AS seq1,
  concat('{PREFIX}', readid, CASE WHEN {_NO} % 11 = 0 THEN '9' ELSE '' END, ' 2:N:0') AS id2,
  CASE WHEN {_NO} % 13 = 0 THEN concat('AC', {LONG_BARCODE}, 'AATT') WHEN {_NO} % 17 = 0 THEN concat(lineage_barcode, '{CAPTURE_SEQUENCE}', 'AA') ELSE concat('AC', {LONG_BARCODE}, '{CAPTURE_SEQUENCE}', 'AA') END AS seq2
FROM reads
"""


def _views(sql: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {n: read_table(spark, sf_dir, n.removesuffix("_source")) for n in ("lineitem_source", "supplier_source") if n in sql}
    for n in names:
        sql = sql.replace(n, f"{{{n}}}")
    return spark.sql(sql, **names)


def reads(spark: SparkSession, sf_dir: str, condition: str | None = None) -> DataFrame:
    df = _views(READS, spark, sf_dir)
    return df if condition is None else df.where(df.condition == condition)


def whitelist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _views(WHITELIST, spark, sf_dir)


def allowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _views(ALLOWED, spark, sf_dir)


def short_molecules(spark: SparkSession, molecules: DataFrame) -> DataFrame:
    return spark.sql(SHORT.replace("FROM molecules", "FROM {molecules}"), molecules=molecules)


def corrected(spark: SparkSession, sf_dir: str, condition: str | None = None) -> DataFrame:
    """Corrected counts of one condition (A, N or R), as the correction step would leave them."""
    from cladeworks.operators.molecules import with_totals

    rows = reads(spark, sf_dir, condition)
    return with_totals(rows.groupBy("cell_barcode", F.col("lineage_barcode").alias("corrected_lineage_barcode")).agg(F.countDistinct("umi").alias("umi_count")))


def folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder for a file that a query writes and reads."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def dealt_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads in ranges of their number. Line items are dealt before their sequences are made, in as many partitions as configured, as these rows are small."""
    lines = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_returnflag")
    lines = lines.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), F.expr("l_orderkey * 8 + l_linenumber"))
    return spark.sql(READS.replace("lineitem_source", "{lines}"), lines=lines)


def fastq(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Both mates, written as FASTQ (the second gzipped) and read back."""
    mates, out = spark.sql(MATES.replace("FROM reads", "FROM {reads}"), reads=dealt_reads(spark, sf_dir)), []
    for i, compression in ((1, "none"), (2, "gzip")):
        path = folder(spark, f"read{i}")
        tables.write_fastq(mates.selectExpr("number", "seq1", "seq2", f"id{i} AS id", f"seq{i} AS seq"), path, ["number", "seq1", "seq2"], compression, dealt=True)
        out.append(tables.read_fastq(spark, path))
    return out[0], out[1]


def sql(text: str) -> str:
    """A fixture for DuckDB."""
    return text.replace("lineitem_source", "lineitem").replace("supplier_source", "supplier")


def corrected_sql(condition: str | None = None) -> str:
    where = "" if condition is None else f" WHERE condition = '{condition}'"
    return f"""SELECT *, sum(umi_count) OVER (PARTITION BY cell_barcode)::BIGINT AS total_molecules_per_cell, count(*) OVER (PARTITION BY cell_barcode) AS total_lineages_per_cell
FROM (SELECT cell_barcode, lineage_barcode AS corrected_lineage_barcode, count(DISTINCT umi) AS umi_count FROM reads{where} GROUP BY ALL)"""
