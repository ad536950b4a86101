"""Clustering of a cell's lineage barcodes by message passing.

After Zorita, Cusco and Filion (2015): by falling count, a sequence joins a neighbour within a Levenshtein
distance that is at least ``ratio`` times as abundant; the most abundant member names the cluster. Ties go
to the greater count, then the lesser sequence. The reference implementation is a binary that is not at
hand, so equality to the byte is not claimed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cladeworks.operators.components import connected_components


def neighbour_pairs(counts: DataFrame, max_distance: int, ratio: float = 1.0) -> DataFrame:
    """Pairs of a cell's sequences within the distance, the more abundant, ``ratio`` times at least, as ``parent``.

    A child cut into ``max_distance + 1`` segments has one that the parent holds unchanged. Before segment i
    there are at most i edits and after it at most ``max_distance - i``, which bounds how far it is shifted
    (Li, Deng, Wang and Feng 2011). So segments and shifted substrings are joined, per cell and length of the
    child, and no cell compares all of its sequences. Children no longer than the distance have no
    segments; there are few such sequences, and these meet by length.
    """
    d, n = max_distance, max_distance + 1
    base = counts.select(F.col("cellbc").alias("cell"), F.col("lineage_barcode").alias("seq"), F.col("unique_umi_count").alias("n")).withColumn("len", F.length("seq"))
    cut = lambda i, size: F.floor(size * i / n).cast("int")
    child = base.toDF("cell", "child", "child_n", "len")
    long_ones, short_ones = child.where(F.col("len") > d), child.where(F.col("len") <= d)
    pieces = F.array(*[F.substring("child", cut(i, F.col("len")) + 1, cut(i + 1, F.col("len")) - cut(i, F.col("len"))) for i in range(n)])
    segments = long_ones.select("*", F.posexplode(pieces).alias("at", "piece"))

    lengths = child.select("cell", F.col("len").alias("child_len")).distinct()
    parent = base.toDF("cell", "parent", "parent_n", "parent_len").join(lengths, "cell").where(F.abs(F.col("parent_len") - F.col("child_len")) <= d)
    more = F.col("parent_len") - F.col("child_len")

    def shifted(i: int):
        begin, size = cut(i, F.col("child_len")), cut(i + 1, F.col("child_len")) - cut(i, F.col("child_len"))
        low, high = F.greatest(F.lit(-i), more - (d - i), -begin), F.least(F.lit(i), more + (d - i), F.col("parent_len") - size - begin)
        places = F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda k: F.struct(F.lit(i).alias("at"), F.substring("parent", begin + k + 1, size).alias("piece")))

    held = parent.where(F.col("child_len") > d).select("cell", "parent", "parent_n", F.col("child_len").alias("len"), F.explode(F.array_distinct(F.flatten(F.array(*[shifted(i) for i in range(n)])))).alias("s")).select("cell", "parent", "parent_n", "len", "s.*")
    above = (F.col("parent_n") >= ratio * F.col("child_n")) & ((F.col("parent_n") > F.col("child_n")) | ((F.col("parent_n") == F.col("child_n")) & (F.col("parent") < F.col("child"))))
    columns = ["cell", "child", "child_n", "parent", "parent_n"]
    near = F.levenshtein("child", "parent", d) >= 0
    found = segments.join(held, ["cell", "len", "at", "piece"]).where(above).select(*columns).where(near).distinct()
    few = short_ones.join(parent.where(F.col("child_len") <= d).withColumnRenamed("child_len", "len"), ["cell", "len"]).where(above).where(near).select(*columns)
    return found.unionByName(few)


def cluster_lineages(counts: DataFrame, max_distance: int, ratio: float = 5.0) -> DataFrame:
    """``(cell_barcode, canonical_sequence, sequence_in_cluster)`` of all sequences, those alone included."""
    best = Window.partitionBy("cell", "child").orderBy(F.desc("parent_n"), "parent")
    links = neighbour_pairs(counts, max_distance, ratio).withColumn("nth", F.row_number().over(best)).where("nth = 1")
    node = lambda seq: F.concat_ws("|", F.col("cell"), F.col(seq))
    parts = connected_components(links.select(node("parent").alias("src"), node("child").alias("dst")))
    rows = counts.select(F.col("cellbc").alias("cell"), F.col("lineage_barcode").alias("seq"), F.col("unique_umi_count").alias("n"))
    rows = rows.withColumn("node", node("seq")).join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    top = Window.partitionBy("cell", "component").orderBy(F.desc("n"), "seq")
    return rows.select(F.col("cell").alias("cell_barcode"), F.first("seq").over(top).alias("canonical_sequence"), F.col("seq").alias("sequence_in_cluster"))
