"""Clone assignment: cells that share lineage barcodes, exactly or nearly, form components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cladeworks.config import CloneParams
from cladeworks.operators import blocks, pairs
from cladeworks.operators.components import connected_components
from cladeworks.operators.similarity import hamming_pairs
from cladeworks.runtime import materialize, numbered

HUB_DEGREE = 10
#: Classes that own a barcode at most where they are listed; beyond it classes meet in blocks.
LISTED_OWNERS = 64
#: Pairs of classes that a task lists, and the tasks at most; beyond both a task lists more, and spills.
LISTED_TOGETHER, LISTED_PARTS = 1 << 18, 2048
#: The columns that name a pair, in the order that readers of the files expect.
PAIR = ["source_condition_1", "cell_barcode_1", "source_condition_2", "cell_barcode_2"]


def prepare_cells(filtered: DataFrame, source: str, max_lineage_count: int | None = None) -> DataFrame:
    """``(source, cell, barcode, umi, rank, barcodes)``; barcodes of one count rank by sequence."""
    kept = filtered if max_lineage_count is None else filtered.where(F.col("lineage_count") < max_lineage_count)
    cell = Window.partitionBy("cell_barcode")
    return kept.select(
        F.lit(source).alias("source"), F.col("cell_barcode").alias("cell"), F.col("corrected_lineage_barcode").alias("barcode"), F.col("umi_count").cast("double").alias("umi"),
        F.row_number().over(cell.orderBy(F.desc("umi_count"), "corrected_lineage_barcode")).cast("double").alias("rank"), F.count("*").over(cell).alias("barcodes"),
    )


def clone_pairs(one: DataFrame, two: DataFrame | None = None, p: CloneParams = CloneParams(), texts: bool = True) -> DataFrame:
    """Pairs of cells that share a barcode, within one prepared input or across two. Quick mode reports exact matches alone where a pair has any.

    Without ``texts`` the column of the matches themselves is left out.
    """
    found = pairs.listed(one, two, p, texts=texts)
    return found if texts else found.drop("matched_barcode_pairs")


def all_pairs(one: DataFrame, two: DataFrame | None = None, p: CloneParams = CloneParams(), texts: bool = True) -> DataFrame:
    """Every pair of cells, matched or not, with the least distance observed: quadratic output."""
    found = pairs.listed(one, two, p, every=True, texts=texts)
    return found if texts else found.drop("matched_barcode_pairs")


def node_id(source: str | Column, cell: str | Column) -> Column:
    return F.concat_ws("|", source, cell)


def _classes(prepared: DataFrame) -> DataFrame:
    """``(source, cell, class, barcodes)``: cells with the same set of barcodes are one class, as they have the same matches."""
    cells = prepared.groupBy("source", "cell").agg(F.array_sort(F.collect_set("barcode")).alias("barcodes"))
    return cells.withColumn("class", F.md5(F.concat_ws("|", "source", F.array_join("barcodes", "_"))))


def clone_groups(one: DataFrame, two: DataFrame | None = None, p: CloneParams = CloneParams(), degrees: bool = True) -> DataFrame:
    """``(cloneID, source_condition, cell_barcode, clone_size, degree)`` of prepared cells; cells without a match are clones of one.

    No pair of cells is listed: a class of cells is tied to its barcodes and each barcode to those near it,
    so the links are linear in the rows however many cells share a lineage. Across two inputs only
    barcodes with a near one on the other side tie cells. Clones are numbered by falling size, then by
    their least (source, cell).
    """
    sides = [one] if two is None else [one, two]
    cells = [materialize(_classes(x)) for x in sides]
    near = materialize(hamming_pairs(one.select("barcode"), sides[-1].select("barcode"), p.hamming_threshold))
    owned = [x.select("class", F.explode("barcodes").alias("barcode")).distinct() for x in cells]
    node = lambda i, c: F.concat(F.lit(f"{i}|"), F.col(c))
    last = len(sides) - 1
    edges = near.where("b1 < b2" if two is None else "true").select(node(0, "b1").alias("src"), node(last, "b2").alias("dst"))
    for i, (rows, b) in enumerate(zip(owned, ("b1", "b2"), strict=False)):
        tied = rows if two is None else rows.join(near.select(F.col(b).alias("barcode")).distinct(), "barcode", "left_semi")
        edges = edges.unionByName(tied.select(node("class", "class").alias("src"), node(i, "barcode").alias("dst")))
    parts = connected_components(edges).where(F.col("node").startswith("class|")).select(F.substring("node", 7, 32).alias("class"), "component")
    every = cells[0] if two is None else cells[0].unionByName(cells[1])
    named = every.join(parts, "class", "left")
    # A cell of a class without links is alone, even if the class has more cells.
    named = named.withColumn("component", F.coalesce("component", F.concat_ws("|", F.lit("cell"), "source", "cell")))
    if degrees:
        named = named.join(_class_degrees(cells, owned, near), "class", "left")
    named = materialize(named.withColumn("degree", F.coalesce("degree", F.lit(0).cast("long")) if degrees else F.lit(None).cast("long")).drop("barcodes"))
    sizes = named.groupBy("component").agg(F.count("*").alias("clone_size"), F.min(F.struct("source", "cell")).alias("first"))
    sizes = numbered(sizes, "cloneID", F.desc("clone_size"), F.col("first"))
    return named.join(sizes, "component").select("cloneID", F.col("source").alias("source_condition"), F.col("cell").alias("cell_barcode"), "clone_size", "degree")


def _class_degrees(cells: list[DataFrame], owned: list[DataFrame], near: DataFrame) -> DataFrame:
    """``(class, degree)``: matched cells of a cell, on either side."""
    if len(cells) == 1:  # a class meets itself, but a cell is not its own match
        return _met_cells(owned[0], near, cells[0], owned[0]).select("class", (F.col("degree") - 1).alias("degree"))
    back = near.select(F.col("b2").alias("b1"), F.col("b1").alias("b2"), "distance")
    return _met_cells(owned[0], near, cells[1], owned[1]).unionByName(_met_cells(owned[1], back, cells[0], owned[0]))


def _met_cells(classes: DataFrame, near: DataFrame, cells: DataFrame, owned: DataFrame) -> DataFrame:
    """``(class, degree)``: the cells that own a barcode near one of the class's. No pair of classes meets at a barcode that many own.

    Where every barcode has few owners these are listed; else classes meet block by block, and a block's count leaves the task.
    """
    sizes = cells.groupBy("class").agg(F.count("*").alias("n"))
    owners = lambda df, b, n: df.groupBy(F.col("barcode").alias(b)).agg(F.count("*").alias(n))
    met = near.join(owners(classes, "b1", "n1"), "b1").join(owners(owned, "b2", "n2"), "b2")
    most, pairs_met = met.agg(F.max(F.greatest("n1", "n2")), F.sum(F.col("n1").cast("double") * F.col("n2"))).first()
    named = lambda df: materialize(df.select("class").distinct().withColumn("id", F.monotonically_increasing_id()))
    ours = named(classes)
    theirs = ours if owned is classes else named(owned)
    rows = lambda df, ids: df.join(ids, "class").select("id", "barcode", F.lit(0).alias("value"))
    counted = theirs.join(sizes, "class")
    if (most or 0) <= LISTED_OWNERS:
        found = _listed(rows(classes, ours), near, rows(owned, theirs).join(counted.select("id", "n"), "id"), int(pairs_met or 0))
    else:
        facts = counted.select("id", F.array("n").alias("facts"))
        found = blocks.compare(rows(classes, ours), ours.select("id", F.array().cast("array<bigint>").alias("facts")), rows(owned, theirs), facts, near, blocks.count_met, "id long, n long")
    return found.groupBy("id").agg(F.sum("n").alias("degree")).join(ours, "id").select("class", "degree")


def _listed(ours: DataFrame, near: DataFrame, theirs: DataFrame, met: int) -> DataFrame:
    """``(id, other, n)``: each pair of classes that meets, once. Of the ``met`` pairs about ``LISTED_TOGETHER`` are made in a task, and as many told apart.

    There are many times as many pairs as bytes that the join reads, so its partitions are not left to be joined by size.
    """
    parts = max(1, min(-(-met // LISTED_TOGETHER), LISTED_PARTS))
    one = ours.withColumnRenamed("barcode", "b1").join(near, "b1").select("id", "b2").repartition(parts, "b2")
    two = theirs.select(F.col("barcode").alias("b2"), F.col("id").alias("other"), "n").repartition(parts, "b2")
    return one.join(two, "b2").select("id", "other", "n").repartition(parts, "id").distinct()


def hub_cells(groups: DataFrame, degree: int = HUB_DEGREE) -> DataFrame:
    """Cells with more matches than a clone of ordinary size explains."""
    return groups.where(F.col("degree") > degree)


def clone_barcodes(prepared: DataFrame, groups: DataFrame) -> DataFrame:
    """``(cloneID, clone_barcode)``: the sorted union of the clone's barcodes."""
    keys = groups.select("cloneID", F.col("source_condition").alias("source"), F.col("cell_barcode").alias("cell"))
    return prepared.join(keys, ["source", "cell"]).groupBy("cloneID").agg(F.array_join(F.array_sort(F.collect_set("barcode")), "_").alias("clone_barcode"))


def clone_cells(groups: DataFrame) -> DataFrame:
    return groups.select("cloneID", "cell_barcode")


def clone_counts(groups: DataFrame, barcodes: DataFrame) -> DataFrame:
    return groups.groupBy("cloneID").agg(F.count("*").alias("count")).join(barcodes, "cloneID", "left")


def matched_cells(one: DataFrame, two: DataFrame | None = None, p: CloneParams = CloneParams(), side: int | None = None) -> DataFrame:
    """``(cell_barcode, source_condition)`` of the cells of matched pairs; ``side`` 1 or 2 takes one side only across two inputs.

    A cell has a match if one of its barcodes is near one of the other side, or within one input near one that another cell owns, so no pair is listed.
    """
    near = materialize(hamming_pairs(one.select("barcode"), (one if two is None else two).select("barcode"), p.hamming_threshold))
    if two is None:
        owners = one.groupBy(F.col("barcode").alias("b2")).agg(F.min("cell").alias("least"), F.max("cell").alias("most"))
        met = near.join(owners, "b2").groupBy(F.col("b1").alias("barcode")).agg(F.min("least").alias("least"), F.max("most").alias("most"))
        ends = [one.join(met, "barcode").where("least <> cell or most <> cell")]
    else:
        ends = [rows.join(near.select(F.col(f"b{i}").alias("barcode")).distinct(), "barcode", "left_semi") for i, rows in ((1, one), (2, two)) if side in (None, i)]
    ends = [x.select(F.col("cell").alias("cell_barcode"), F.col("source").alias("source_condition")) for x in ends]
    return (ends[0].unionByName(ends[1]) if len(ends) == 2 else ends[0]).distinct()


def graph_nodes(groups: DataFrame) -> DataFrame:
    return groups.select("cell_barcode", "source_condition", "degree", F.concat(F.lit("Clone_"), F.col("cloneID").cast("string")).alias("assigned_clone_id"))


def graph_edges(pairs: DataFrame) -> DataFrame:
    return pairs.where("is_clone").select(
        node_id(PAIR[0], PAIR[1]).alias("node1"), node_id(PAIR[2], PAIR[3]).alias("node2"), "num_matches", "num_exact_matches", "num_hamming_matches", "best_hamming_distance", "mean_match_confidence",
        F.coalesce("mean_match_confidence", F.lit(0.0)).alias("edge_weight"),
    )


def graph_statistics(groups: DataFrame) -> DataFrame:
    """Counts of the graph; each link of it is in the degree of two cells."""
    sizes = groups.groupBy("cloneID").agg(F.count("*").alias("n"), F.sum("degree").alias("ends"))
    return sizes.agg(F.count("*").alias("components"), F.max("n").alias("largest"), F.count_if(F.col("n") == 1).alias("singletons"), F.sum("n").alias("cells"), F.coalesce(F.sum("ends") / 2, F.lit(0)).cast("long").alias("edges"))


def exact_set_clones(filtered: DataFrame, max_lineage_count: int | None = None) -> DataFrame:
    """The older rule: cells with the same list of barcodes are a clone. ``(cloneID, clone_barcode, cell_barcode, cells)``."""
    kept = filtered if max_lineage_count is None else filtered.where(F.col("lineage_count") < max_lineage_count)
    cells = kept.groupBy("cell_barcode").agg(F.array_join(F.array_sort(F.collect_list("corrected_lineage_barcode")), "_").alias("clone_barcode"))
    clones = cells.groupBy("clone_barcode").agg(F.count("*").alias("cells"))
    clones = numbered(clones, "cloneID", F.desc("cells"), F.col("clone_barcode"))
    return cells.join(clones, "clone_barcode").select("cloneID", "clone_barcode", "cell_barcode", "cells")
